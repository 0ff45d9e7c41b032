"""Registered queries that run streams to the end of their input.

Each writes the tables' records as topics of files into a scratch folder, runs the speed
layer over them and returns what the landed or serving tables then hold.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrill.catalog import bindings as b
from tallyrill.functions.codec import decode
from tallyrill.models import (
    COMMENT,
    SUBMISSION,
    TRENDING,
    UNIQUE_ACTIVE,
    WINDOWED_COMMENTS,
    WINDOWED_SUBMISSIONS,
    ServingTable,
)
from tallyrill.operators.windows import both_kinds, windowed_active
from tallyrill.plans.batch import current_ranking, run_batch
from tallyrill.plans.layout import Job
from tallyrill.plans.speed import (
    drain,
    renew_full,
    run_speed,
    start_landing,
    start_stats,
)
from tallyrill.session import job_session, scratch, sweeping
from tallyrill.sources import files
from tallyrill.sources.landed import read_landed
from tallyrill.sources.roots import roots
from tallyrill.sources.topics import Topics


# A micro-batch is the unit of recovery, so a large topic is read in several of them. No result
# depends on where they are cut.
BATCH_BYTES = str(1 << 40)
# Longer than the half of the events that comes first spans, shorter than all of them.
DELAY = "20 days"


def _job(spark: SparkSession, ev: DataFrame, **settings) -> Job:
    root = scratch(spark)
    return Job(
        root,
        Topics("parquet", f"{root}/topics", {"maxBytesPerTrigger": BATCH_BYTES}),
        trigger={"availableNow": True},
        **settings,
    )


def _feed(job: Job, ev: DataFrame) -> None:
    for model in b.MODELS_USED:
        job.topics.publish(b.event_records(ev, model), model)


def _shuffled_halves(ev: DataFrame) -> list[DataFrame]:
    """All events in two waves that both span the whole time, so the second comes late."""
    first = F.xxhash64("event_id") > 0
    return [ev.where(first), ev.where(~first)]


def _drop_topics(spark: SparkSession, job: Job) -> None:
    """The encoded copies are as large as the tables, and read to the end by now."""
    files.remove(spark, job.topics.root)


def _shown(spark: SparkSession, job: Job, table: ServingTable) -> DataFrame:
    return job.serving.latest(spark, table).withColumn(
        "window", F.col("window").cast("timestamp_ntz")
    )


def st_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decoded stream itself, kept as plain Parquet."""
    ev = b.events(spark, sf_dir)
    job, streams = _job(spark, ev), job_session(spark)
    _feed(job, ev)
    out = f"{job.root}/decoded"
    decoded = decode(job.topics.read_stream(streams, COMMENT), COMMENT).select(
        "id", "subreddit", "link_id", "body", "created_utc", "offset", "offset_batch", "topic"
    )
    query = decoded.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", job.checkpoint("decode")
    ).trigger(availableNow=True).start()
    drain([query])
    _drop_topics(spark, job)
    rows = spark.read.schema(decoded.schema).parquet(out)
    return rows.withColumn("created_utc", F.col("created_utc").cast("timestamp_ntz"))


def st_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed in two batches and read back from the root."""
    ev = b.events(spark, sf_dir)
    job, streams = _job(spark, ev), job_session(spark)
    for wave in _shuffled_halves(ev):
        _feed(job, wave)
        drain(start_landing(streams, job))
    _drop_topics(spark, job)
    rows = read_landed(spark, SUBMISSION, f"{job.landed}/submission")
    return rows.select(
        "id", "subreddit", "title", "selftext", "over_18", "offset", "partition",
        F.col("created_utc").cast("timestamp_ntz").alias("created_utc"),
        (F.col("offset_batch") == F.col("_offset_batch")).alias("same_bucket"),
    )


def st_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed in two waves of offsets, the second one in a root of its own, and read as one table."""
    ev = b.events(spark, sf_dir)
    job, streams = _job(spark, ev, root_batches=1), job_session(spark)
    later = b.second_half(ev)
    for wave in (ev.where(~later), ev.where(later)):
        _feed(job, wave)
        queries = start_landing(streams, job)
        drain(queries)
        renew_full(streams, job, queries)
    _drop_topics(spark, job)
    table = f"{job.landed}/submission"
    if [root.number for root in roots(spark, table)] != [0, 1, 2]:
        raise RuntimeError("landing did not go on in a new root")
    rows = read_landed(spark, SUBMISSION, table)
    return rows.select(
        "id", "subreddit", "title", "selftext", "over_18", "offset", "partition",
        F.col("created_utc").cast("timestamp_ntz").alias("created_utc"),
        (F.col("offset_batch") == F.col("_offset_batch")).alias("same_bucket"),
    )


def st_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windowed submissions, all input in one wave."""
    ev = b.events(spark, sf_dir)
    job, streams = _job(spark, ev), job_session(spark)
    _feed(job, ev)
    drain(start_stats(streams, job))
    _drop_topics(spark, job)
    return _shown(spark, job, WINDOWED_SUBMISSIONS)


def st_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second half of the offsets arrives first; without a watermark nothing is lost."""
    ev = b.events(spark, sf_dir)
    job, streams = _job(spark, ev, size="1 hour"), job_session(spark)
    later = b.second_half(ev)
    for wave in (ev.where(later), ev.where(~later)):
        _feed(job, wave)
        drain(start_stats(streams, job))
    _drop_topics(spark, job)
    return _shown(spark, job, WINDOWED_COMMENTS)


def st_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a watermark: what is older than the delay when the first half comes is dropped."""
    ev = b.events(spark, sf_dir)
    job = _job(spark, ev, size="1 hour", watermark=DELAY)
    streams, later = job_session(spark), b.second_half(ev)
    for wave in (ev.where(later), ev.where(~later)):
        _feed(job, wave)
        drain(start_stats(streams, job))
    _drop_topics(spark, job)
    return _shown(spark, job, WINDOWED_COMMENTS)


def st_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows over the union of both streams, without the approximate column."""
    ev = b.events(spark, sf_dir)
    job, streams = _job(spark, ev), job_session(spark)
    _feed(job, ev)
    drain(start_stats(streams, job))
    _drop_topics(spark, job)
    return _shown(spark, job, UNIQUE_ACTIVE).drop("active_subreddits")


def st_active_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the stream's approximate count keeps to its bound, per hour."""
    ev = b.events(spark, sf_dir)
    job, streams = _job(spark, ev, size="1 hour"), job_session(spark)
    _feed(job, ev)
    drain(start_stats(streams, job))
    _drop_topics(spark, job)
    exact = windowed_active(both_kinds(b.submissions(ev), b.comments(ev)), size="1 hour", exact=True)
    exact = exact.select("date", "window", F.col("active_subreddits").alias("exact"))
    both = _shown(spark, job, UNIQUE_ACTIVE).join(exact, ["date", "window"])
    return both.select("date", "window", "exact", b.within_bound("active_subreddits", "exact"))


def st_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last batch is run again, as after a crash between its writes and its commit."""
    ev = b.events(spark, sf_dir)
    job, streams = _job(spark, ev), job_session(spark)
    _feed(job, ev)
    drain(start_stats(streams, job))
    commits = f"{job.checkpoint('windowed_activity')}/generation=0/commits"
    last = max((n for n in files.children(spark, commits) if n.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        files.remove(spark, f"{commits}/{name}")
    before = job.serving.parts(spark, WINDOWED_SUBMISSIONS)
    again = start_stats(streams, job)
    drain(again)
    # A replay leaves a part of its own in the place of the first attempt's.
    if job.serving.parts(spark, WINDOWED_SUBMISSIONS) == before:
        raise RuntimeError("the batch was not run again")
    _drop_topics(spark, job)
    return _shown(spark, job, WINDOWED_SUBMISSIONS)


def st_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stopped between two waves that fill the same windows; counts go on from the checkpoint."""
    ev = b.events(spark, sf_dir)
    job, streams = _job(spark, ev, size="1 hour"), job_session(spark)
    for wave in _shuffled_halves(ev):
        _feed(job, wave)
        drain(start_stats(streams, job))
    _drop_topics(spark, job)
    return _shown(spark, job, WINDOWED_SUBMISSIONS)


def st_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second generation counts all input anew; the first one is refused from then on."""
    ev = b.events(spark, sf_dir)
    job, streams = _job(spark, ev, size="1 hour"), job_session(spark)
    first, second = _shuffled_halves(ev)
    _feed(job, first)
    drain(start_stats(streams, job))
    _feed(job, second)
    drain(start_stats(streams, replace(job, generation=1)))
    try:
        start_stats(streams, replace(job, generation=0))
    except ValueError:
        _drop_topics(spark, job)
        return _shown(spark, job, WINDOWED_SUBMISSIONS)
    raise RuntimeError("an old generation went on")


def st_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five queries at once: two landings and one per windowed table."""
    ev = b.events(spark, sf_dir)
    job, streams = _job(spark, ev), job_session(spark)
    _feed(job, ev)
    drain(run_speed(streams, job, by_table=True))
    _drop_topics(spark, job)
    measures = {
        "submissions": _shown(spark, job, WINDOWED_SUBMISSIONS),
        "comments": _shown(spark, job, WINDOWED_COMMENTS),
        "both": _shown(spark, job, UNIQUE_ACTIVE).withColumnRenamed(
            "submissions_and_comments", "count"
        ),
    }
    shown = [
        rows.select("date", "window", "count", F.lit(name).alias("measure"))
        for name, rows in measures.items()
    ]
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


def speed_and_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both layers over two waves of offsets; the second batch run ranks the second wave."""
    ev = b.events(spark, sf_dir)
    job, streams = _job(spark, ev), job_session(spark)
    later = b.second_half(ev)
    for wave in (ev.where(~later), ev.where(later)):
        _feed(job, wave)
        drain(run_speed(streams, job))
        run_batch(spark, job)
    _drop_topics(spark, job)
    return current_ranking(spark, job).withColumn(
        "last_update", F.col("last_update").cast("timestamp_ntz")
    )


def overtaken_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over roots of landed records, with a ranking that a run wrote which another one overtook."""
    ev = b.events(spark, sf_dir)
    job, streams = _job(spark, ev, root_batches=1), job_session(spark)
    later = b.second_half(ev)
    for run_id, wave in enumerate((ev.where(~later), ev.where(later)), 1):
        _feed(job, wave)
        queries = start_landing(streams, job)
        drain(queries)
        renew_full(streams, job, queries)
        if run_batch(spark, job) != run_id:
            raise RuntimeError(f"run {run_id} did not commit")
        stalled = job.serving.latest(spark, TRENDING).withColumn("total", F.col("total") + 1)
        job.serving.upsert(stalled, TRENDING, run_id, replace=False)
    _drop_topics(spark, job)
    return current_ranking(spark, job).withColumn(
        "last_update", F.col("last_update").cast("timestamp_ntz")
    )


QUERIES = {
    f.__name__: sweeping(f)
    for f in (
        st_decode, st_land, st_roots, st_upsert, st_late, st_watermark, st_active,
        st_active_bound, st_replay, st_restart, st_generation, st_all,
        speed_and_batch, overtaken_batch,
    )
}
