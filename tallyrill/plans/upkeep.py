"""Upkeep: compact serving tables and drop old offset log entries."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallyrill.models import SERVING, TRENDING
from tallyrill.plans.layout import Job
from tallyrill.sources import offsets


def run_upkeep(spark: SparkSession, job: Job, keep_runs: int = 10) -> None:
    """Run while no batch run is under way."""
    named = offsets.parts(spark, job.offsets)
    for table in SERVING.values():
        job.serving.compact(spark, table, named if table == TRENDING else None)
    offsets.prune(spark, job.offsets, keep_runs)
