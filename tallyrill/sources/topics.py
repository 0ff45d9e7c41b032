"""Topics: a Kafka broker, or directories of Kafka-shaped Parquet rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyrill.functions.codec import encode, topic_rows
from tallyrill.models import TOPIC_SCHEMA, TopicModel


@dataclass(frozen=True)
class Topics:
    """Where topics live.

    ``format='kafka'`` needs the Kafka connector on the classpath and passes ``options``
    on: bound each batch with ``maxOffsetsPerTrigger``, and set ``minPartitions`` to split
    the offset range of a hot broker partition over several tasks. ``format='parquet'``
    reads ``root/<topic>``, where ``maxBytesPerTrigger`` bounds a batch.
    """

    format: str = "kafka"
    root: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def path(self, model: TopicModel) -> str:
        return f"{self.root}/{model.topic}"

    def read_stream(
        self, spark: SparkSession, model: TopicModel, after: Column | None = None,
        source_offsets: str | None = None,
    ) -> DataFrame:
        """The topic's raw records; from the latest offset unless the options say otherwise.

        A new checkpoint that goes on where another one ended begins at ``source_offsets``, as a
        broker's stream reports them, and takes the rows that meet ``after``.
        """
        reader = spark.readStream.format(self.format).options(**self.options)
        if self.format == "kafka":
            if source_offsets:
                reader = reader.option("startingOffsets", source_offsets)
            rows = reader.option("subscribe", model.topic).load()
        else:
            rows = reader.schema(TOPIC_SCHEMA).load(self.path(model))
        return rows if after is None else rows.where(after)

    def publish(
        self, df: DataFrame, model: TopicModel, checkpoint: str | None = None
    ) -> StreamingQuery | None:
        """Encode records, a table or a stream, and send them to the topic without a key.

        Topics kept as files have no broker to place a record, so there ``df`` needs the
        columns ``partition``, ``offset`` and ``timestamp`` beside the model's fields.
        """
        if self.format == "kafka":
            records, options = encode(df, model), self.options
        else:
            records, options = topic_rows(df, model), {"path": self.path(model)}
        if df.isStreaming:
            writer = records.writeStream.format(self.format).options(**options)
            return writer.option("checkpointLocation", checkpoint).start()
        records.write.format(self.format).options(**options).mode("append").save()
        return None
