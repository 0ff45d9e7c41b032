"""Connected components of a graph of any size, by alternating star contractions on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrill.llm.store import written


def _smallest(edges: DataFrame) -> DataFrame:
    """For each u the smallest of u and its neighbours v; partial minima keep hot nodes small."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(key, label) for every node of edges (u, v): label is the smallest key of its component.

    Large-star links larger neighbours to the smallest one, small-star the smaller ones; both
    keep connectivity, and what no longer changes is a star around each smallest key. Each round
    is written to the shared folder, so lineage stays short and lost executors cost one round.
    """
    now = written(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(),
        "edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_smallest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = _smallest(large)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now = written(small, "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    own = now.select(F.col("v").alias("key"), F.col("v").alias("label")).distinct()
    return now.select(F.col("u").alias("key"), F.col("v").alias("label")).unionByName(own)
