"""Ranking of the most active keys over several kinds of records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOP = 25
KEY = "subreddit"
KINDS = ("submissions", "comments")


def tag_union(sides: dict[str, DataFrame], *columns: str) -> DataFrame:
    """The named columns (by default the key) of all sides, each row tagged with its kind."""
    tagged = [
        side.select(*(columns or (KEY,)), F.lit(kind).alias("kind"))
        for kind, side in sides.items()
    ]
    return reduce(DataFrame.unionByName, tagged)


def pivot_counts(
    tagged: DataFrame, key: str = KEY, kinds: tuple[str, ...] = KINDS
) -> DataFrame:
    """Count per key and kind, one column per kind, absent kinds as 0.

    Kinds are listed, so no job looks for them and none can be missing.
    """
    return tagged.groupBy(key).pivot("kind", list(kinds)).count().fillna(0, subset=list(kinds))


def latest_time(sides: dict[str, DataFrame], ts: str = "created_utc") -> DataFrame:
    """Latest time over all sides: one row, null if no row has a time."""
    times = reduce(DataFrame.unionByName, [side.select(ts) for side in sides.values()])
    return times.agg(F.max(ts).alias("last_update"))


def kind_counts(tagged: DataFrame, key: str = KEY, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """Count per key and kind from conditional counts: one shuffle where a pivot needs two.

    A hot key shrinks to one row per task before that shuffle.
    """
    return tagged.groupBy(key).agg(
        *[F.count_if(F.col("kind") == kind).alias(kind) for kind in kinds]
    )


def rank(
    counts: DataFrame,
    last_update: Column,
    key: str = KEY,
    kinds: tuple[str, ...] = KINDS,
    n: int = TOP,
) -> DataFrame:
    """Top ``n`` keys by the total over all kinds; ties go to the smaller key."""
    total = reduce(lambda a, b: a + b, [F.col(kind) for kind in kinds])
    return (
        counts.where(F.col(key).isNotNull())
        .select(key, *kinds, total.alias("total"))
        .orderBy(F.desc("total"), F.asc(key))
        .limit(n)
        .withColumn("last_update", last_update)
    )


def trending(
    sides: dict[str, DataFrame], key: str = KEY, ts: str = "created_utc", n: int = TOP
) -> DataFrame:
    """The ``n`` keys with most records over all sides, stamped with the latest record time."""
    return trending_tagged(tag_union(sides, key, ts), tuple(sides), key, ts, n)


def trending_tagged(
    tagged: DataFrame,
    kinds: tuple[str, ...] = KINDS,
    key: str = KEY,
    ts: str = "created_utc",
    n: int = TOP,
) -> DataFrame:
    """The same ranking of one table with a ``kind`` column. Empty if no record has a time.

    Keys and times are separate scans of separate columns, so times are not shuffled.
    """
    last_update = tagged.agg(F.max(ts)).scalar()
    ranked = rank(kind_counts(tagged, key, kinds), last_update, key, kinds, n)
    return ranked.where(F.col("last_update").isNotNull())
