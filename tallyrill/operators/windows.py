"""Time-window aggregates; the same functions serve batch tables and streams.

A row is labelled with the end of its window and the date of that end. Rows without a
time belong to no window. Without a watermark late rows are never dropped and state is
kept for good; production streams should set one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrill.operators.ranking import KINDS, tag_union

SIZE = "5 seconds"
RSD = 0.05


def _grouped(df: DataFrame, ts: str, size: str, slide: str | None, watermark: str | None):
    if watermark:
        df = df.withWatermark(ts, watermark)
    return df.groupBy(F.window(ts, size, slide or size))


def _labelled(windowed: DataFrame, *measures: str) -> DataFrame:
    end = F.col("window.end")
    return windowed.select(F.to_date(end).alias("date"), end.alias("window"), *measures)


def windowed_count(
    df: DataFrame,
    ts: str = "created_utc",
    size: str = SIZE,
    slide: str | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Rows per window: date, window, count."""
    counted = _grouped(df, ts, size, slide, watermark).agg(F.count(F.lit(1)).alias("count"))
    return _labelled(counted, "count")


def _distinct(key: str, exact: bool, rsd: float) -> Column:
    return F.count_distinct(key) if exact else F.approx_count_distinct(key, rsd)


def windowed_active(
    df: DataFrame,
    ts: str = "created_utc",
    key: str = "subreddit",
    size: str = SIZE,
    slide: str | None = None,
    watermark: str | None = None,
    exact: bool = False,
    rsd: float = RSD,
) -> DataFrame:
    """Distinct keys and non-null keys per window. ``exact`` works on batch tables only."""
    active = _grouped(df, ts, size, slide, watermark).agg(
        _distinct(key, exact, rsd).alias("active_subreddits"),
        F.count(key).alias("submissions_and_comments"),
    )
    return _labelled(active, "active_subreddits", "submissions_and_comments")


def both_kinds(
    submissions: DataFrame,
    comments: DataFrame,
    ts: str = "created_utc",
    key: str = "subreddit",
    watermark: str | None = None,
) -> DataFrame:
    """Time and key of two tables or streams; a watermark is set on each side first."""
    return all_kinds([submissions, comments], ts, key, watermark)


def all_kinds(
    sides: list[DataFrame], ts: str = "created_utc", key: str = "subreddit", watermark: str | None = None
) -> DataFrame:
    """The same of any number of tables or streams."""
    sides = [side.select(ts, key) for side in sides]
    if watermark:
        sides = [side.withWatermark(ts, watermark) for side in sides]
    return reduce(DataFrame.unionByName, sides)


def windowed_activity(
    sides: dict[str, DataFrame],
    ts: str = "created_utc",
    key: str = "subreddit",
    size: str = SIZE,
    slide: str | None = None,
    watermark: str | None = None,
    rsd: float = RSD,
) -> DataFrame:
    """Rows per kind, distinct keys and non-null keys per window, in one pass over all kinds.

    One shuffle and one state row per window serve every windowed table; see
    ``split_activity``.
    """
    if watermark:
        sides = {kind: side.withWatermark(ts, watermark) for kind, side in sides.items()}
    return windowed_activity_tagged(
        tag_union(sides, ts, key), tuple(sides), ts, key, size, slide, rsd
    )


def windowed_activity_tagged(
    tagged: DataFrame,
    kinds: tuple[str, ...] = KINDS,
    ts: str = "created_utc",
    key: str = "subreddit",
    size: str = SIZE,
    slide: str | None = None,
    rsd: float = RSD,
) -> DataFrame:
    """The same of one table with a ``kind`` column."""
    counted = _grouped(tagged, ts, size, slide, None).agg(
        *[F.count_if(F.col("kind") == kind).alias(kind) for kind in kinds],
        _distinct(key, False, rsd).alias("active_subreddits"),
        F.count(key).alias("submissions_and_comments"),
    )
    return _labelled(counted, *kinds, "active_subreddits", "submissions_and_comments")


def split_activity(activity: DataFrame, kinds: list[str]) -> dict[str, DataFrame]:
    """The windowed tables contained in the result of ``windowed_activity``."""
    tables = {
        f"windowed_{kind}": activity.where(F.col(kind) > 0).select(
            "date", "window", F.col(kind).alias("count")
        )
        for kind in kinds
    }
    tables["unique_active_subreddits"] = activity.select(
        "date", "window", "active_subreddits", "submissions_and_comments"
    )
    return tables
