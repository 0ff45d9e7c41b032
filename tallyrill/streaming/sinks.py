"""Stream sinks: landing, keyed serving tables and the console."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tallyrill.models import SERVING, ServingTable, TopicModel
from tallyrill.sources import files
from tallyrill.sources.landed import DIRECTORIES, to_stored
from tallyrill.sources.serving import Serving, stream_version

Trigger = dict[str, object]

ROWS_PER_FILE = 1_000_000


def _start(writer: DataStreamWriter, name: str, checkpoint: str, trigger: Trigger | None):
    writer = writer.queryName(name).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def land(
    decoded: DataFrame,
    model: TopicModel,
    root: str,
    checkpoint: str,
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """Append a decoded stream to Parquet, one directory per partition and offset bucket.

    Each record is landed exactly once. Rows that could not be read are landed too, with
    their text, so no second reader of the topic is needed to keep them.
    """
    writer = (
        to_stored(decoded, model)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", root)
        .partitionBy(*DIRECTORIES)
    )
    return _start(writer, f"land_{model.source}", checkpoint, trigger)


def upsert_stream(
    updates: DataFrame,
    serving: Serving,
    split: Callable[[DataFrame], dict[str, DataFrame]],
    tables: list[str],
    name: str,
    checkpoint: str,
    generation: int | None = None,
    trigger: Trigger | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> StreamingQuery:
    """Write the changed rows of every micro-batch into serving tables, by key.

    ``split`` gives the rows of each of ``tables`` by its name. A checkpoint belongs to a
    generation, above all that are stored when it is made: by default the last one with a
    checkpoint goes on, and where there is none the next one begins. A checkpoint below the
    newest generation stored is refused, and a query that runs stops at its next batch once there
    is a newer one: its rows would never be shown. One file holds about ``rows_per_file`` rows.
    """
    spark, served = updates.sparkSession, [SERVING[t] for t in tables]
    generation = _generation(spark, serving, served, checkpoint, generation)

    def write(batch: DataFrame, batch_id: int) -> None:
        version = stream_version(generation, batch_id)
        _require_newest(spark, serving, served, generation)
        batch.persist()
        try:
            # The cached rows fill as many partitions as the state; a batch needs few files.
            n_files = math.ceil(batch.count() / rows_per_file)
            if n_files:
                for table_name, rows in split(batch.coalesce(n_files)).items():
                    serving.upsert(rows, SERVING[table_name], version)
        finally:
            batch.unpersist()

    writer = updates.writeStream.outputMode("update").foreachBatch(write)
    return _start(writer, name, f"{checkpoint}/generation={generation}", trigger)


def _generation(
    spark: SparkSession,
    serving: Serving,
    tables: list[ServingTable],
    checkpoint: str,
    wanted: int | None,
) -> int:
    """The generation of a checkpoint that goes on, or of one that begins."""
    names = [n for n in files.children(spark, checkpoint) if n.startswith("generation=")]
    begun = {int(n.split("=")[1]) for n in names}
    if wanted in begun or wanted is None and begun:
        chosen = max(begun) if wanted is None else wanted
        _require_newest(spark, serving, tables, chosen)
        return chosen
    following = serving.next_generation(spark, tables)
    if wanted is not None and wanted < following:
        raise ValueError(f"generation {wanted} has no checkpoint, and {following - 1} is stored already")
    return following if wanted is None else wanted


def _require_newest(
    spark: SparkSession, serving: Serving, tables: list[ServingTable], generation: int
) -> None:
    newest = serving.next_generation(spark, tables) - 1
    if generation < newest:
        raise ValueError(f"generation {newest} is stored already, so {generation} cannot go on")


def to_console(updates: DataFrame, trigger: Trigger | None = None) -> StreamingQuery:
    """Print updates, for debugging."""
    writer = updates.writeStream.format("console").outputMode("update")
    return (writer.trigger(**trigger) if trigger else writer).start()
