"""Session set-up and the shared folder for scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import SparkSession

from tallyrill.sources import files

# Changelog checkpoints upload a batch's changes instead of whole state files. Concurrent
# writers let a landing task that meets few buckets write them without sorting its records.
STREAM_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def build_session(app: str, **conf: str) -> SparkSession:
    """Session with the settings every job relies on; ``conf`` adds to or overrides them."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**STREAM_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def job_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session beside ``spark`` (same cluster, own SQL settings) for streams.

    Spark fixes the number of state partitions when a stateful query first starts. It is
    ``state_partitions``, or else what the session shuffles into.
    """
    job = spark.newSession()
    for key, value in STREAM_CONF.items():
        job.conf.set(key, value)
    shuffles = state_partitions or spark.conf.get("spark.sql.shuffle.partitions")
    job.conf.set("spark.sql.shuffle.partitions", str(shuffles))
    return job


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tallyrill-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


_made: list[str] = []


def scratch(spark: SparkSession) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_folder(spark)}/tallyrill/{uuid.uuid4().hex}"
    _made.append(path)
    return path


def sweeping(query: Callable) -> Callable:
    """The query; each call removes what its last one left in scratch paths, since that is read by then."""
    left: list[str] = []

    @wraps(query)
    def run(spark: SparkSession, *args):
        for path in left:
            files.remove(spark, path)
        first = len(_made)
        try:
            return query(spark, *args)
        finally:
            left[:] = _made[first:]
            del _made[first:]

    return run
