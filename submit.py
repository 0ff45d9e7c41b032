"""Jobs for spark-submit: publish, speed, batch, upkeep and view.

    spark-submit submit.py publish --root ROOT --model comment --records PATH --option ...
    spark-submit submit.py speed  --root ROOT --option kafka.bootstrap.servers=HOST:PORT
    spark-submit submit.py batch  --root ROOT
    spark-submit submit.py upkeep --root ROOT
    spark-submit submit.py view   --root ROOT --table windowed_comments
"""

from __future__ import annotations

import argparse

from tallyrill.models import MODELS, SERVING
from tallyrill.plans.batch import run_batch
from tallyrill.plans.layout import Job
from tallyrill.plans.speed import drain, renew_full, run_speed, tend
from tallyrill.plans.upkeep import run_upkeep
from tallyrill.plans.view import follow
from tallyrill.session import build_session
from tallyrill.sources.serving import Serving
from tallyrill.sources.topics import Topics


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=["publish", "speed", "batch", "upkeep", "view"])
    parser.add_argument("--root", required=True, help="folder shared by all executors")
    parser.add_argument("--topics", default="kafka", help="kafka, or parquet for file topics")
    parser.add_argument("--topic-root", help="folder of file topics")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--model", choices=sorted(MODELS), default="submission")
    parser.add_argument("--records", help="Parquet records to publish")
    parser.add_argument("--bucket-size", type=int, default=Job.bucket_size)
    parser.add_argument("--watermark")
    parser.add_argument("--generation", type=int, help="of new checkpoints; by default the next")
    parser.add_argument("--sources", nargs="+", choices=sorted(MODELS), default=list(Job.sources),
                        help="topics to land")
    parser.add_argument("--store-format", help="connector of an external keyed store")
    parser.add_argument("--store-option", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--every", help="trigger interval, such as '5 seconds'; of a view, seconds")
    parser.add_argument("--land-every", help="the same for landing, by default 5 minutes")
    parser.add_argument("--strict", action="store_true", help="stop landing at a bad record")
    parser.add_argument("--once", action="store_true", help="process what is there, then stop")
    parser.add_argument("--by-table", action="store_true", help="one query per windowed table")
    parser.add_argument("--cumulative", action="store_true", help="rank all landed records")
    parser.add_argument("--table", choices=sorted(SERVING), default="windowed_submissions")
    return parser.parse_args()


def _options(given: list[str]) -> dict[str, str]:
    return dict(option.split("=", 1) for option in given)


def main() -> None:
    args = arguments()
    spark = build_session(f"activity-{args.job}")
    once = {"availableNow": True} if args.once else None
    streams = args.job == "speed"
    every = {"processingTime": args.every} if args.every and streams else None
    land_every = {"processingTime": args.land_every} if args.land_every else None
    job = Job(
        root=args.root,
        topics=Topics(args.topics, args.topic_root, _options(args.option)),
        bucket_size=args.bucket_size,
        watermark=args.watermark,
        generation=args.generation,
        sources=tuple(args.sources),
        store=Serving(format=args.store_format, options=_options(args.store_option))
        if args.store_format else None,
        trigger=once or every,
        land_trigger=once or land_every,
        mode="FAILFAST" if args.strict else "PERMISSIVE",
    )
    if args.job == "publish":
        job.topics.publish(spark.read.parquet(args.records), MODELS[args.model])
    elif args.job == "speed":
        queries = run_speed(spark, job, args.by_table)
        if args.once:
            drain(queries)
            renew_full(spark, job, queries)
        else:
            tend(spark, job, queries)
    elif args.job == "batch":
        print("run", run_batch(spark, job, args.cumulative))
    elif args.job == "upkeep":
        run_upkeep(spark, job)
    else:
        seconds = float(args.every.split()[0]) if args.every else None
        follow(spark, job, SERVING[args.table], lambda rows: rows.show(100, False), seconds)


if __name__ == "__main__":
    main()
