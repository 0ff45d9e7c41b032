"""Batch layer: rank the keys of the records landed since the last run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrill.models import EVENT_TIME, OFFSET_LOG_SCHEMA, TRENDING
from tallyrill.operators.ranking import kind_counts, rank
from tallyrill.plans.layout import Job
from tallyrill.sources import offsets
from tallyrill.sources.landed import read_since


def updates(spark: SparkSession, job: Job, cumulative: bool = False) -> DataFrame:
    """Source, kind, position, time and key of all records past the logged positions.

    The files are listed when this is called, so all jobs of a run see the same records.
    """
    positions = {} if cumulative else offsets.positions(offsets.read_log(spark, job.offsets))
    return reduce(
        DataFrame.unionByName,
        [
            read_since(spark, model, f"{job.landed}/{source}", positions.get(source, {})).select(
                F.lit(source).alias("source"),
                F.lit(job.kinds[source]).alias("kind"),
                "partition",
                "offset_batch",
                "offset",
                EVENT_TIME,
                job.key,
            )
            for source, model in job.ranked.items()
        ],
    )


def progress(found: DataFrame) -> DataFrame:
    """Per source and partition: last bucket, last offset, and latest time in microseconds."""
    return found.groupBy("source", "partition").agg(
        F.max("offset_batch").alias("offset_batch"),
        F.max("offset").alias("offset"),
        F.max(F.unix_micros(EVENT_TIME)).alias("latest"),
    )


def pending(spark: SparkSession, job: Job) -> DataFrame:
    """The sources that have landed records past their positions, and how many; from one scan."""
    found = updates(spark, job)
    return found.groupBy("source").agg(F.count(F.lit(1)).alias("updates"))


def run_batch(spark: SparkSession, job: Job, cumulative: bool = False) -> int | None:
    """Process what has landed since the last run; return the run's id, None without updates.

    Two narrow scans: offsets and times shrink to one row per broker partition, which the
    driver holds; keys are counted and ranked. The run claims its id before it writes, and its
    entry in the offset log commits it and names its part of the ranking. A run that finds the
    id claimed fails and changes nothing; a crashed run's claim is taken over once it is
    ``job.stale_claim`` seconds old. Should the crashed one go on after all, its entry finds the
    place taken, and its part of the ranking has no name.
    """
    run_id = offsets.last_run(spark, job.offsets) + 1
    found = updates(spark, job, cumulative)
    reached = progress(found).collect()
    if not reached:
        return None

    claim = offsets.claim(spark, job.offsets, run_id, job.stale_claim)
    try:
        named = job.serving.written(spark, TRENDING, offsets.parts(spark, job.offsets), run_id - 1)
        latest = max((r["latest"] for r in reached if r["latest"] is not None), default=None)
        if latest is not None:
            kinds = tuple(job.kinds.values())
            counts = kind_counts(found, job.key, kinds)
            ranking = rank(counts, F.timestamp_micros(F.lit(latest)), job.key, kinds, job.top)
            part = job.serving.upsert(ranking, TRENDING, run_id, replace=False)
            named = [*named, part] if part else named

        entry = [(r["source"], r["partition"], r["offset_batch"], r["offset"]) for r in reached]
        schema = OFFSET_LOG_SCHEMA.removesuffix(", run_id bigint")
        claim.require(spark)
        offsets.append(spark, job.offsets, spark.createDataFrame(entry, schema), run_id, named)
    finally:
        claim.release(spark)
    return run_id


def ranking_table(spark: SparkSession, job: Job) -> DataFrame:
    """The ranking table: every key ever ranked, as of its last committed run.

    An external store keeps no versions: it shows what was written last, committed or not.
    """
    if job.serving.format:
        return job.serving.latest(spark, TRENDING)
    last, named = offsets.last_run(spark, job.offsets), offsets.parts(spark, job.offsets)
    return job.serving.latest(spark, TRENDING, upto=last, only=named)


def current_ranking(spark: SparkSession, job: Job) -> DataFrame:
    """Only the keys ranked by the last run that ranked any; in an external store, by the latest time."""
    if job.serving.format:
        rows = job.serving.latest(spark, TRENDING)
        return rows.where(F.col("last_update") == rows.agg(F.max("last_update")).scalar())
    last, named = offsets.last_run(spark, job.offsets), offsets.parts(spark, job.offsets)
    rows = job.serving.versions(spark, TRENDING, named).where(F.col("version") <= last)
    newest = rows.agg(F.max("version")).scalar()
    return rows.where(F.col("version") == newest).select(TRENDING.columns)
