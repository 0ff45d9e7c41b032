"""View layer: the series a chart shows, refreshed from a serving table."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrill.models import TRENDING, ServingTable
from tallyrill.operators.series import (
    ALLOWANCE,
    DEPTH,
    WINDOW_SECONDS,
    latest_n,
    look_back,
    refresh,
    with_mean,
)
from tallyrill.plans.batch import current_ranking
from tallyrill.plans.layout import Job
from tallyrill.session import scratch
from tallyrill.sources import files
from tallyrill.sources.serving import Serving


def as_series(rows: DataFrame, table: ServingTable) -> DataFrame:
    """Window and measures of a windowed table, the measures named y1, y2."""
    measures = [F.col(c).alias(f"y{i}") for i, c in enumerate(table.values, start=1)]
    return rows.select("window", *measures)


def refresh_view(
    spark: SparkSession,
    serving: Serving,
    table: ServingTable,
    held: DataFrame | None = None,
    n: int = DEPTH,
    allowance: int = ALLOWANCE,
    window_seconds: int = WINDOW_SECONDS,
    folder: str | None = None,
) -> DataFrame:
    """The held series brought up to date, its last ``n`` windows.

    Without a held series the whole table is read, later only the look-back. The result is
    written below ``folder`` (by default the shared one) and read again, so a view can be
    refreshed for as long as it runs.
    """
    if held is None or held.isEmpty():
        series = latest_n(as_series(serving.read_since(spark, table), table), n).orderBy("window")
    else:
        newer = look_back(held, allowance, window_seconds)
        series = refresh(held, as_series(serving.read_since(spark, table, newer), table), n)
    path = f"{folder}/{uuid.uuid4().hex}" if folder else scratch(spark)
    series.coalesce(1).write.parquet(path)
    return spark.read.schema(series.schema).parquet(path).orderBy("window")


def follow(
    spark: SparkSession,
    job: Job,
    table: ServingTable,
    show: Callable[[DataFrame], None],
    every: float | None = None,
    rounds: int | None = None,
) -> None:
    """Show a table again and again: a series with its mean, of which only the look-back is read
    after the first time, or the current ranking. Once without ``every``; else for ``rounds``, or ever."""
    folder, held, turn = f"{job.root}/views/{uuid.uuid4().hex}", None, 0
    try:
        while True:
            if table == TRENDING:
                show(current_ranking(spark, job).orderBy("total", "subreddit", ascending=[False, True]))
            else:
                held = refresh_view(spark, job.serving, table, held, folder=f"{folder}/{turn}")
                files.remove(spark, f"{folder}/{turn - 1}")
                show(view_lines(held))
            turn += 1
            if every is None or turn == rounds:
                return
            time.sleep(every)
    finally:
        files.remove(spark, folder)


def view_lines(series: DataFrame) -> DataFrame:
    """The series with the mean of its first measure on every row."""
    return with_mean(series, "y1")
