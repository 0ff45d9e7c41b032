"""Series shown by a view: look-back, merge, last windows and mean."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEPTH = 100
ALLOWANCE = 20
WINDOW_SECONDS = 5


def position(series: DataFrame, window: str = "window") -> DataFrame:
    """Last window of the series, as one row."""
    return series.agg(F.max(window).alias("max_ts"))


def look_back(
    series: DataFrame, allowance: int = ALLOWANCE, window_seconds: int = WINDOW_SECONDS
) -> Column:
    """Windows later than ``allowance`` windows before the last one of the series.

    The bound is one scalar, subtraction included, so the comparison reaches a Parquet scan.
    """
    span = F.lit(timedelta(seconds=allowance * window_seconds))
    last = position(series)
    return F.col("window") > last.select(F.col("max_ts") - span).scalar()


def merge_max(held: DataFrame, read: DataFrame, window: str = "window") -> DataFrame:
    """Rows of both series, the largest value of each measure per window."""
    measures = [c for c in held.columns if c != window]
    return held.unionByName(read).groupBy(window).agg(*[F.max(m).alias(m) for m in measures])


def latest_n(series: DataFrame, n: int = DEPTH, window: str = "window") -> DataFrame:
    """The last ``n`` windows."""
    return series.orderBy(F.desc(window)).limit(n)


def with_mean(series: DataFrame, measure: str = "y1") -> DataFrame:
    """The mean of a measure over the whole series, on every row; null for an empty series."""
    return series.withColumn("mean", series.agg(F.avg(measure)).scalar())


def refresh(held: DataFrame, read: DataFrame, n: int = DEPTH) -> DataFrame:
    """Merge newly read rows into the held series and keep its last windows, in order."""
    return latest_n(merge_max(held, read), n).orderBy("window")
