"""Landing roots: a landed table as a row of directories, of which only the last one grows.

Spark lists what a stream has landed through the sink's commit log, which has an entry for every
file ever landed. So a table goes on in a new root, with a log and a checkpoint of its own, once
enough micro-batches have landed in the last one. The first root is the table's own path, later
ones have a number behind it. A root opens with the positions that the one before it had reached,
and that is also where the one before it ends: whatever lies past them there is not read, so each
record counts once, even if an old query should go on landing.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tallyrill.sources import files

_FROM = "_from.json"


@dataclass(frozen=True)
class Root:
    """One directory of a landed table.

    ``start`` and ``end`` are the last offset per broker partition before it and in it; the open
    root has no end. ``source_offsets`` is where the source's stream goes on, in its own words.
    """

    path: str
    number: int = 0
    start: dict[int, int] = field(default_factory=dict)
    end: dict[int, int] | None = None
    source_offsets: str | None = None

    @property
    def suffix(self) -> str:
        return f".{self.number}" if self.number else ""

    def holds(self) -> Column | None:
        """Which rows count as this root's; None if all do."""
        rows = after(self.start) if self.start else None
        if self.end is None:
            return rows
        before = ~after(self.end)
        return before if rows is None else rows & before

    def done(self, offsets: dict[int, int]) -> bool:
        """True if nothing in this root is past the given last offsets."""
        return self.end is not None and all(offsets.get(p, -1) >= o for p, o in self.end.items())


def after(offsets: dict[int, int]) -> Column:
    """Rows past the last offset of their broker partition; all rows of other partitions.

    A coarse conjunct on the lowest offset reaches the Parquet scan, as the lookup does not.
    """
    if not offsets:
        return F.lit(True)
    size = max(offsets) + 1
    known = F.array(*[F.lit(offsets.get(p, -1)).cast("bigint") for p in range(size)])
    last = F.coalesce(F.get(known, F.col("partition")), F.lit(-1).cast("bigint"))
    lowest = min(offsets.get(p, -1) for p in range(size))
    return ((F.col("offset") > lowest) | (F.col("partition") >= size)) & (F.col("offset") > last)


def roots(spark: SparkSession, table: str) -> list[Root]:
    """The roots of a landed table, the open one last."""
    parent, name = table.rsplit("/", 1)
    numbers = [n.removeprefix(f"{name}.") for n in files.children(spark, parent) if n.startswith(f"{name}.")]
    found = [Root(table)]
    for number in sorted(int(n) for n in numbers if n.isdigit()):
        path = f"{table}.{number}"
        opened = json.loads(files.read(spark, f"{path}/{_FROM}"))
        start = {int(p): o for p, o in opened["positions"].items()}
        found[-1] = Root(**{**found[-1].__dict__, "end": start})
        found.append(Root(path, number, start, None, opened["source_offsets"]))
    return found


def open_next(
    spark: SparkSession, table: str, reached: dict[int, int], source_offsets: str | None = None
) -> Root:
    """Close the open root at the positions reached and open the next one, both by one rename."""
    last = roots(spark, table)[-1]
    number = last.number + 1
    start = {**last.start, **reached}
    aside = f"{table.rsplit('/', 1)[0]}/_opening-{uuid.uuid4().hex}"
    files.create(spark, f"{aside}/{_FROM}", json.dumps({"positions": start, "source_offsets": source_offsets}))
    if not files.move_new(spark, aside, f"{table}.{number}"):
        files.remove(spark, aside)
        raise ValueError(f"{table}.{number} is open already")
    return Root(f"{table}.{number}", number, start, None, source_offsets)
