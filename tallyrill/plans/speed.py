"""Speed layer: land every topic and keep the windowed serving tables up to date."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyrill.functions.codec import decode
from tallyrill.models import EVENT_TIME, UNIQUE_ACTIVE, TopicModel
from tallyrill.operators.windows import (
    all_kinds,
    split_activity,
    windowed_active,
    windowed_activity,
    windowed_count,
)
from tallyrill.plans.layout import Job
from tallyrill.sources.landed import read_root
from tallyrill.sources.roots import Root, after, open_next, roots
from tallyrill.streaming.sinks import land, upsert_stream


def start_landing(spark: SparkSession, job: Job) -> list[StreamingQuery]:
    """One landing query per topic, into the open root of its table."""
    return [_land(spark, job, model, roots(spark, f"{job.landed}/{source}")[-1])
            for source, model in job.models.items()]


def _land(spark: SparkSession, job: Job, model: TopicModel, root: Root) -> StreamingQuery:
    new = after(root.start) if root.start else None
    raw = job.topics.read_stream(spark, model, new, root.source_offsets)
    return land(
        decode(raw, model, bucket_size=job.bucket_size, mode=job.mode),
        model,
        root.path,
        job.checkpoint(f"land_{model.source}{root.suffix}"),
        job.landing,
    )


def _is_full(spark: SparkSession, job: Job, query: StreamingQuery) -> bool:
    """Whether a landing query's root holds the files of its micro-batches.

    Micro-batches without records leave no file. A new root's stream has many of them where a
    topic is kept as files, since such a topic is passed over from its beginning.
    """
    progress = query.lastProgress
    if not query.name.startswith("land_") or progress is None or progress.batchId + 1 < job.root_batches:
        return False
    model = job.models[query.name.removeprefix("land_")]
    root = roots(spark, f"{job.landed}/{model.source}")[-1]
    return len(read_root(spark, model, root).inputFiles()) >= job.root_batches


def hand_over(spark: SparkSession, job: Job, query: StreamingQuery) -> Root:
    """Stop a landing query and open the root in which landing is to go on.

    The new root begins behind what the old one has committed, which may be more than the query
    has told, never less. What was read and not committed is read again for the new root.
    """
    progress = query.lastProgress
    query.stop()
    model = job.models[query.name.removeprefix("land_")]
    table = f"{job.landed}/{model.source}"
    rows = read_root(spark, model, roots(spark, table)[-1])
    # One row per broker partition.
    reached = {r["partition"]: r["last"] for r in rows.groupBy("partition").agg(F.max("offset").alias("last")).collect()}
    told = progress.sources[0].endOffset if job.topics.format == "kafka" else None
    return open_next(spark, table, reached, told)


def renew_full(spark: SparkSession, job: Job, queries: list[StreamingQuery]) -> list[StreamingQuery]:
    """The queries; those whose root is full give way to one that lands in the next root, if they were running."""
    out = []
    for query in queries:
        if _is_full(spark, job, query):
            active, name = query.isActive, query.name
            root = hand_over(spark, job, query)
            if active:
                query = _land(spark, job, job.models[name.removeprefix("land_")], root)
        out.append(query)
    return out


def tend(spark: SparkSession, job: Job, queries: list[StreamingQuery], every: float = 30.0) -> None:
    """Keep the speed layer running, with new landing roots when the time has come; a failure is raised."""
    while all(query.isActive for query in queries):
        queries = renew_full(spark, job, queries)
        time.sleep(every)
    for query in queries:
        if not query.isActive:
            query.awaitTermination()


def _activity(spark: SparkSession, job: Job, model: TopicModel) -> DataFrame:
    """Time and key of a topic's records; no other field is parsed."""
    return decode(job.topics.read_stream(spark, model), model, [EVENT_TIME, job.key])


def start_stats(spark: SparkSession, job: Job) -> list[StreamingQuery]:
    """All windowed tables from one query: each topic is read, shuffled and kept in state once."""
    sides = {kind: _activity(spark, job, job.ranked[s]) for s, kind in job.kinds.items()}
    activity = windowed_activity(
        sides, EVENT_TIME, job.key, job.size, watermark=job.watermark, rsd=job.rsd
    )
    kinds = list(sides)
    return [
        upsert_stream(
            activity,
            job.serving,
            lambda batch: split_activity(batch, kinds),
            [*(f"windowed_{kind}" for kind in kinds), UNIQUE_ACTIVE.name],
            "windowed_activity",
            job.checkpoint("windowed_activity"),
            job.generation,
            job.trigger,
        )
    ]


def start_stats_by_table(spark: SparkSession, job: Job) -> list[StreamingQuery]:
    """One query per windowed table, so that each can be stopped and restarted alone."""
    sides = {kind: _activity(spark, job, job.ranked[s]) for s, kind in job.kinds.items()}
    results = {
        f"windowed_{kind}": windowed_count(side, EVENT_TIME, job.size, watermark=job.watermark)
        for kind, side in sides.items()
    }
    union = all_kinds(list(sides.values()), EVENT_TIME, job.key, job.watermark)
    results[UNIQUE_ACTIVE.name] = windowed_active(union, EVENT_TIME, job.key, job.size, rsd=job.rsd)
    return [
        upsert_stream(
            updates,
            job.serving,
            lambda batch, name=name: {name: batch},
            [name],
            name,
            job.checkpoint(name),
            job.generation,
            job.trigger,
        )
        for name, updates in results.items()
    ]


def run_speed(spark: SparkSession, job: Job, by_table: bool = False) -> list[StreamingQuery]:
    """Start the speed layer and return its queries; ``tend`` keeps them going, ``drain`` waits for their end."""
    stats = start_stats_by_table if by_table else start_stats
    return start_landing(spark, job) + stats(spark, job)


def drain(queries: list[StreamingQuery]) -> None:
    """Wait for queries started with an ``availableNow`` trigger; a failure is raised."""
    for query in queries:
        query.awaitTermination()
