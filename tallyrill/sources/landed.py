"""Landed tables: Parquet below ``root/<source>/_partition=P/_offset_batch=N``.

The files hold each record's struct once. Reading adds the flattened fields as
projections, so a query still scans only the fields it names. A table that has landed for
long has several roots (see ``roots``), which are read as one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrill.functions.codec import malformed
from tallyrill.models import EVENT_TIME, UNREADABLE, TopicModel, stored_schema
from tallyrill.sources import files
from tallyrill.sources.offsets import Position
from tallyrill.sources.roots import Root, roots

DIRECTORIES = ["_partition", "_offset_batch"]


def to_stored(decoded: DataFrame, model: TopicModel) -> DataFrame:
    """The columns kept on disk; directory columns are copies, so a leaf read keeps the values.

    Whether a record is unreadable is settled here, where it is parsed, so that readers need
    one flag and not every field for it.
    """
    columns = {"_partition": F.col("partition"), UNREADABLE: malformed(model)}
    return decoded.withColumns(columns).select(stored_schema(model).names)


def write_landed(decoded: DataFrame, model: TopicModel, root: str) -> None:
    """Land a batch table. Keep it apart from a streamed root, whose commit log hides it."""
    to_stored(decoded, model).write.mode("append").partitionBy(*DIRECTORIES).parquet(root)


def read_stored(spark: SparkSession, model: TopicModel, root: str) -> DataFrame:
    """Every landed record, malformed ones included; empty before the first landing."""
    return _read_roots(spark, model, roots(spark, root))


def _read_roots(spark: SparkSession, model: TopicModel, some: list[Root]) -> DataFrame:
    return reduce(DataFrame.unionByName, [read_root(spark, model, root) for root in some])


def read_root(spark: SparkSession, model: TopicModel, root: Root) -> DataFrame:
    """The records of one root.

    Reading the root honours the file sink's commit log and still prunes directories.
    """
    if not files.exists(spark, root.path):
        return empty_landed(spark, model)
    rows = _flatten(spark.read.schema(stored_schema(model)).parquet(root.path), model)
    held = root.holds()
    return rows if held is None else rows.where(held)


def _flatten(stored: DataFrame, model: TopicModel) -> DataFrame:
    flat = [F.col("value").getField(n).alias(n) for n in model.keys if n != EVENT_TIME]
    return stored.select("*", *flat)


def read_landed(spark: SparkSession, model: TopicModel, root: str) -> DataFrame:
    """Landed records without the malformed ones."""
    return read_stored(spark, model, root).where(~F.col(UNREADABLE))


def empty_landed(spark: SparkSession, model: TopicModel) -> DataFrame:
    """Typed stand-in for a source that has no updates."""
    return _flatten(spark.createDataFrame([], stored_schema(model)), model)


def since(positions: dict[int, Position]) -> Column:
    """Rows past the given positions; a partition without one counts from its start.

    Three conjuncts: an exact one on directory columns alone, which prunes; a coarse one
    on the lowest offset, which reaches the Parquet scan and skips row groups already
    processed; and the exact offset test. Positions are looked up in array literals
    indexed by partition, so the predicate does not grow with the number of partitions.
    """
    if not positions:
        return F.lit(True)
    size = max(positions) + 1
    buckets = [positions[p].offset_batch if p in positions else -1 for p in range(size)]
    offsets = [positions[p].offset if p in positions else -1 for p in range(size)]

    def beyond_known(values: list[int], partition: str) -> Column:
        literal = F.array(*[F.lit(v).cast("bigint") for v in values])
        return F.coalesce(F.get(literal, F.col(partition)), F.lit(-1).cast("bigint"))

    return (
        (F.col("_offset_batch") >= beyond_known(buckets, "_partition"))
        & ((F.col("offset") > min(offsets)) | (F.col("partition") >= size))
        & (F.col("offset") > beyond_known(offsets, "partition"))
    )


def read_since(
    spark: SparkSession, model: TopicModel, root: str, positions: dict[int, Position]
) -> DataFrame:
    """Landed records not yet processed, malformed ones included: they have offsets too.

    Closed roots that are processed to their end are not listed, so the time this takes depends
    on the open root and on what is new, not on all that ever landed.
    """
    known = {p: x.offset for p, x in positions.items()}
    left = [r for r in roots(spark, root) if not r.done(known)]
    return _read_roots(spark, model, left).where(since(positions))
