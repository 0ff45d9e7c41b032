"""Keyed serving tables as versioned Parquet.

Each write adds a directory ``part=<version>-<attempt>`` whose rows carry their version; the
row of a key is the one with the highest version. Only directories that Spark has committed
are read. Writing a version again adds a directory and then drops the version's older ones,
so a replayed batch changes nothing and hides nothing meanwhile. One writer per table: a
stream of an older generation is refused, and of batch runs only the parts count that the
offset log names, which the methods here take as ``only``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrill.models import ServingTable
from tallyrill.sources import files

# Batch ids below this many share a stream generation.
GENERATION = 1 << 40


def stream_version(generation: int, batch_id: int) -> int:
    """Version of a micro-batch. A new checkpoint restarts its ids, so it needs a new generation."""
    return generation * GENERATION + batch_id


def _version(part: str) -> int | None:
    """A part's version; None for a compacted part."""
    return None if part.startswith("c") else int(part.split("-")[0])


@dataclass(frozen=True)
class Serving:
    """The serving tables below ``root``, or in an external keyed store.

    With ``format`` set, rows are written and read through that connector, whose store
    replaces rows by key itself; it has no versions and needs no compaction.
    """

    root: str = ""
    format: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def path(self, table: ServingTable) -> str:
        return f"{self.root}/{table.name}"

    def upsert(
        self, df: DataFrame, table: ServingTable, version: int, replace: bool = True
    ) -> str | None:
        """Replace the rows of the keys in ``df`` and return the new part's name.

        Rows without a full key are left out. With ``replace``, older parts of this version go.
        """
        keyed = df.select(table.columns).dropna(subset=list(table.keys))
        if self.format:
            writer = keyed.write.format(self.format).options(**self.options)
            writer.option("table", table.name).mode("append").save()
            return None
        spark = df.sparkSession
        part = f"{version}-{uuid.uuid4().hex[:8]}"
        stamped = keyed.withColumn("version", F.lit(version).cast("bigint"))
        stamped.write.parquet(f"{self.path(table)}/part={part}")
        for old in self._all_parts(spark, table) if replace else []:
            if old != part and _version(old) == version:
                files.remove(spark, f"{self.path(table)}/part={old}")
        return part

    def _all_parts(self, spark: SparkSession, table: ServingTable) -> list[str]:
        names = files.children(spark, self.path(table))
        return [n.removeprefix("part=") for n in names if n.startswith("part=")]

    def parts(
        self, spark: SparkSession, table: ServingTable, only: list[str] | None = None
    ) -> list[str]:
        """The committed parts, found in one call. Few, once the table has been compacted.

        ``only`` leaves out written parts that it doesn't name; compacted ones always count.
        """
        done = files.matching(spark, f"{self.path(table)}/part=*/_SUCCESS")
        found = [p.split("/")[-2].removeprefix("part=") for p in done]
        return [p for p in found if only is None or p in only or _version(p) is None]

    def written(
        self, spark: SparkSession, table: ServingTable, only: list[str] | None, upto: int
    ) -> list[str]:
        """The committed parts that are not compacted, as of version ``upto``."""
        if self.format:
            return []
        found = [(p, _version(p)) for p in self.parts(spark, table, only)]
        return [p for p, v in found if v is not None and v <= upto]

    def next_generation(self, spark: SparkSession, tables: list[ServingTable]) -> int:
        """A generation above those of all stored rows and of what was begun.

        Names of parts tell: the newest version is never compacted into a part without one.
        """
        if self.format:
            return 0
        versions = [_version(p) for t in tables for p in self._all_parts(spark, t)]
        return max((v // GENERATION + 1 for v in versions if v is not None), default=0)

    def versions(
        self, spark: SparkSession, table: ServingTable, only: list[str] | None = None
    ) -> DataFrame:
        """Every stored row with its version; empty before the first write."""
        schema = f"{table.schema}, version bigint, part string"
        if self.format:
            raise ValueError("an external store keeps no versions")
        paths = [f"{self.path(table)}/part={p}" for p in self.parts(spark, table, only)]
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", self.path(table)).parquet(*paths)

    def latest(
        self, spark: SparkSession, table: ServingTable, upto: int | None = None,
        only: list[str] | None = None,
    ) -> DataFrame:
        """Current row per key, or the row as of version ``upto``, which an external store has not.

        Filters on key columns pass below the aggregate into the Parquet scan.
        """
        if self.format and upto is not None:
            raise ValueError("an external store keeps no versions")
        if self.format:
            reader = spark.read.format(self.format).options(**self.options)
            return reader.option("table", table.name).load().select(table.columns)
        rows = self.versions(spark, table, only)
        if upto is not None:
            rows = rows.where(F.col("version") <= upto)
        return latest_rows(rows, table).select(table.columns)

    def read_since(
        self, spark: SparkSession, table: ServingTable, newer: Column | None = None
    ) -> DataFrame:
        """All current rows, or those that meet a look-back predicate."""
        rows = self.latest(spark, table)
        return rows if newer is None else rows.where(newer)

    def compact(
        self, spark: SparkSession, table: ServingTable, only: list[str] | None = None
    ) -> None:
        """Rewrite the latest rows, with their versions, into one part and drop the rest.

        The newest version stays apart, since its stream may write it again. A row keeps
        its version, so a crash between rewriting and dropping leaves only duplicates.
        A reader that had listed a dropped part must read again. Parts that ``only`` doesn't
        name are dropped too, if one that it names is as new.
        """
        if self.format:
            return
        parts = self.parts(spark, table, only)
        newest = max((_version(p) for p in parts if not p.startswith("c")), default=-1)
        for part in set(self.parts(spark, table)) - set(parts):
            if _version(part) <= newest:
                files.remove(spark, f"{self.path(table)}/part={part}")
        written = sorted((p for p in parts if not p.startswith("c")), key=_version)
        compacted = [p for p in parts if p.startswith("c")]
        covered = written[:-1] + compacted
        if len(covered) < 2:
            return
        rows = self.versions(spark, table).where(F.col("part").isin(covered))
        number = max((int(p[1:]) for p in compacted), default=0) + 1
        latest_rows(rows, table).repartitionByRange(*table.order_by).sortWithinPartitions(
            *table.order_by
        ).write.parquet(f"{self.path(table)}/part=c{number}")
        for part in covered:
            files.remove(spark, f"{self.path(table)}/part={part}")


def latest_rows(rows: DataFrame, table: ServingTable) -> DataFrame:
    """Row of the highest version per key, with that version.

    One ``max_by`` per column over a plain number keeps this a hash aggregate.
    """
    return rows.groupBy(*table.keys).agg(
        *[F.max_by(c, "version").alias(c) for c in table.values],
        F.max("version").alias("version"),
    )
