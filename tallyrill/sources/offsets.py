"""Offset log: how far each source and partition has been processed, one entry per run.

A run is committed by its log entry and by nothing else. Every entry carries the position
of all partitions known so far, so only the last one is ever read. An entry is written aside
and takes its name by a rename that replaces nothing, so of two runs with one id one commits.
It also names the parts of the ranking that count, so what a run that was overtaken writes is
never read. A run first claims its id with a file that only one can create; who finds it taken
stops. The claim of a crashed run may be taken over once it is old enough.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrill.models import OFFSET_LOG_SCHEMA
from tallyrill.sources import files


class RunCommitted(RuntimeError):
    """Another run has already committed this run id."""


class RunClaimed(RuntimeError):
    """Another run works under this run id."""


# Holds the names of the ranking's parts, in an entry.
_PARTS = "_parts"
# Seconds after which a claim counts as a crashed run's. Longer than any run may take.
STALE = 6 * 3600.0


@dataclass(frozen=True)
class Position:
    offset_batch: int
    offset: int


def last_run(spark: SparkSession, path: str) -> int:
    """Id of the last committed run, 0 before the first."""
    entries = [p.split("/")[-2] for p in files.matching(spark, f"{path}/run_id=*/_SUCCESS")]
    return max((int(e.split("=")[1]) for e in entries), default=0)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The entry of the last committed run; an empty table of the same schema before the first."""
    last = last_run(spark, path)
    if not last:
        return spark.createDataFrame([], OFFSET_LOG_SCHEMA)
    reader = spark.read.schema(OFFSET_LOG_SCHEMA).option("basePath", path)
    return reader.parquet(f"{path}/run_id={last}")


def latest(log: DataFrame) -> DataFrame:
    """Last bucket and offset per source and partition."""
    return log.groupBy("source", "partition").agg(
        F.max("offset_batch").alias("offset_batch"), F.max("offset").alias("offset")
    )


def positions(log: DataFrame) -> dict[str, dict[int, Position]]:
    """Latest positions by source and partition. One small row per broker partition."""
    found: dict[str, dict[int, Position]] = {}
    for row in latest(log).collect():
        found.setdefault(row["source"], {})[row["partition"]] = Position(
            row["offset_batch"], row["offset"]
        )
    return found


def reached(updates: DataFrame) -> DataFrame:
    """Last bucket and offset in ``updates``, per source and partition."""
    return latest(updates)


def require_open(spark: SparkSession, path: str, run_id: int) -> None:
    """Fail if another run has taken this id, as when two runs overlap."""
    if files.exists(spark, f"{path}/run_id={run_id}/_SUCCESS"):
        raise RunCommitted(f"run {run_id} is already in {path}")


@dataclass(frozen=True)
class Claim:
    """A run id taken by this run."""

    path: str
    run_id: int
    token: str

    @property
    def file(self) -> str:
        return f"{self.path}/_claim-{self.run_id}"

    def require(self, spark: SparkSession) -> None:
        """Fail if the id has been committed, or the claim taken over."""
        require_open(spark, self.path, self.run_id)
        if files.read(spark, self.file) != self.token:
            raise RunClaimed(f"the claim of run {self.run_id} was taken over")

    def release(self, spark: SparkSession) -> None:
        if files.read(spark, self.file) == self.token:
            files.remove(spark, self.file)


def claim(spark: SparkSession, path: str, run_id: int, stale: float = STALE) -> Claim:
    """Take a run id, by one atomic create; fail while another run holds it or has committed it."""
    taken = Claim(path, run_id, uuid.uuid4().hex)
    if not files.create(spark, taken.file, taken.token):
        # An old claim is moved aside under the name of its holder, so two that find it stale
        # cannot both take it, and neither can move the other's new claim unseen.
        holder = files.read(spark, taken.file)
        old = holder is not None and files.age(spark, taken.file) > stale
        if not old or not files.move(spark, taken.file, f"{path}/_stale-{holder}"):
            raise RunClaimed(f"run {run_id} is under way in {path}")
        if not files.create(spark, taken.file, taken.token):
            raise RunClaimed(f"run {run_id} is under way in {path}")
    try:
        taken.require(spark)
    except RunCommitted:
        taken.release(spark)
        raise
    return taken


def append(
    spark: SparkSession, path: str, current: DataFrame, run_id: int, parts: list[str] | None = None
) -> None:
    """Commit a run: the positions in ``current``, and those of all other partitions as before.

    ``parts`` are the parts of the ranking that count from now on; without it, all do.
    """
    require_open(spark, path, run_id)
    known = read_log(spark, path).drop("run_id")
    aside, entry = f"{path}/_attempt-{uuid.uuid4().hex}", f"{path}/run_id={run_id}"
    # One row per broker partition: a single small file.
    latest(known.unionByName(current)).coalesce(1).write.parquet(aside)
    if parts is not None:
        files.create(spark, f"{aside}/{_PARTS}", "\n".join(parts))
    if not files.move_new(spark, aside, entry):
        _set_aside(spark, path, entry)
        if not files.move_new(spark, aside, entry):
            files.remove(spark, aside)
            raise RunCommitted(f"run {run_id} is already in {path}")


def _set_aside(spark: SparkSession, path: str, entry: str) -> None:
    """Make room where an entry was begun in its own place and never finished."""
    stray = f"{path}/_stale-{uuid.uuid4().hex}"
    if not files.exists(spark, f"{entry}/_SUCCESS") and files.move(spark, entry, stray):
        if files.exists(spark, f"{stray}/_SUCCESS"):  # finished in between
            files.move_new(spark, stray, entry)


def parts(spark: SparkSession, path: str) -> list[str] | None:
    """The ranking's parts that the last committed run names; None if it names none."""
    text = files.read(spark, f"{path}/run_id={last_run(spark, path)}/{_PARTS}")
    return None if text is None else text.split()


def prune(spark: SparkSession, path: str, keep: int = 10) -> None:
    """Drop all but the last ``keep`` committed entries, claims that were taken over and entries
    that never took their place. Run while no batch run is under way."""
    last = last_run(spark, path)
    for name in files.children(spark, path):
        if name.startswith(("_stale-", "_attempt-")):
            files.remove(spark, f"{path}/{name}")
        if name.startswith("run_id=") and int(name.split("=")[1]) <= last - keep:
            files.remove(spark, f"{path}/{name}")
