"""Files of an operator's own format in the folder that all executors share.

Tasks write whole files under names of their own; the table of names that Spark commits says which
of them count, so what lost or repeated attempts leave behind is never read.
"""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

import tallyrill
from tallyrill.session import scratch


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a Parquet table in the shared folder: computed once, kept if executors go."""
    path = f"{scratch(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _release() -> None:
    """Give back to the system what this Python worker has freed: it lives on for tasks of any kind."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim:
        trim(0)


def tidy(task: Callable) -> Callable:
    """The task over batches, which gives back what it has freed when it ends."""

    @wraps(task)  # with its type hints
    def run(batches):
        try:
            yield from task(batches)
        finally:
            _release()

    return run


#: Bytes of files that one task reads back, about.
READ_BYTES = 64 << 20


def reading_tasks(spark: SparkSession, n_rows: int, n_bytes: int) -> int:
    """Tasks that read files back: by their size, but so many at least that all cores have some, and a row each at most."""
    return max(1, min(n_rows, max(-(-n_bytes // READ_BYTES), spark.sparkContext.defaultParallelism)))


class FileStore:
    """A folder by path or URI, usable on the driver and in tasks."""

    def __init__(self, root: str):
        self.root = root

    @classmethod
    def fresh(cls, spark: SparkSession, name: str) -> FileStore:
        return cls(f"{scratch(spark)}/{name}")

    def _open(self):
        root = self.root if "://" in self.root or self.root.startswith("file:") else f"file://{self.root}"
        if root.startswith("file:/") and not root.startswith("file://"):
            root = "file://" + root[5:]
        return pafs.FileSystem.from_uri(root)

    def create(self, suffix: str):
        """A new file's name and its open stream; close the stream before naming the file to anyone."""
        fs, folder = self._open()
        fs.create_dir(folder, recursive=True)
        name = uuid.uuid4().hex + suffix
        return name, fs.open_output_stream(f"{folder}/{name}", compression=None)

    def read(self, name: str):
        """A file for random reads."""
        fs, folder = self._open()
        return fs.open_input_file(f"{folder}/{name}")


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this library's Python files to the executors, once per application.

    Tasks import it by name; Spark serves the archive, so no folder need be shared or installed.
    Whole texts also want smaller Arrow batches than Spark's own; a session that has set theirs keeps it.
    """
    sc = spark.sparkContext
    if spark.conf.get(_BATCH) == "67108864b":  # as Spark has it
        spark.conf.set(_BATCH, "8m")
    if getattr(sc, "_tallyrill_shipped", False):
        return
    package = Path(tallyrill.__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tallyrill-")) / "tallyrill.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._tallyrill_shipped = True
