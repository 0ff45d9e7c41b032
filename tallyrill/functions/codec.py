"""JSON encoding and decoding of topic records, with Spark's own JSON functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrill.functions.scalars import BUCKET_SIZE, epoch_to_ts, offset_bucket
from tallyrill.models import CORRUPT, EVENT_TIME, TopicModel


def record_value(model: TopicModel) -> Column:
    """The model's fields as UTF-8 JSON; nulls are written, ``to_str`` fields become text."""
    fields = [
        F.col(name).cast("string").alias(name) if name in model.to_str else F.col(name)
        for name in model.keys
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).cast("binary")


def encode(df: DataFrame, model: TopicModel) -> DataFrame:
    """One keyless topic record per row, ready for a Kafka sink."""
    return df.select(record_value(model).alias("value"), F.lit(model.topic).alias("topic"))


def topic_rows(df: DataFrame, model: TopicModel, *beside: str) -> DataFrame:
    """Kafka-shaped rows from records that bring their partition, offset and timestamp.

    The columns ``beside`` the record are kept as they are.
    """
    return df.select(
        F.lit(None).cast("binary").alias("key"),
        record_value(model).alias("value"),
        F.lit(model.topic).alias("topic"),
        F.col("partition").cast("int"),
        F.col("offset").cast("bigint"),
        F.col("timestamp").cast("timestamp"),
        F.lit(0).alias("timestampType"),
        *beside,
    )


def decode(
    topic: DataFrame,
    model: TopicModel,
    fields: Sequence[str] | None = None,
    bucket_size: int = BUCKET_SIZE,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """Decode topic rows; add bucket columns, the flattened fields and the event time.

    ``fields`` decodes only those fields and adds no corrupt-record column; use it where
    rejects do not matter, as in window counts. Mode ``FAILFAST`` stops on a bad record.
    """
    schema = model.schema_of(list(fields or model.keys))
    names = list(schema.names)
    options = {"mode": mode}
    strict = mode == "FAILFAST"
    if fields is None and not strict:
        schema = schema.add(CORRUPT, "string")
        options["columnNameOfCorruptRecord"] = CORRUPT

    text = F.col("value").cast("string")
    # The one-element explode keeps filters on decoded fields above the parser. Pushed
    # below it, as for a plain projection, they would parse every record a second time.
    parsed = topic.select(
        *[c for c in topic.columns if c != "value"],
        text.alias("_text"),
        F.explode(F.array(F.from_json(text, schema, options))).alias("_parsed"),
    )
    value = F.col("_parsed")
    added = [
        offset_bucket("offset", bucket_size).alias("_offset_batch"),
        offset_bucket("offset", bucket_size).alias("offset_batch"),
    ]
    if fields is None:
        # The parser passes over empty text in either mode.
        empty = F.raise_error(F.lit("empty record")) if strict else F.col("_text")
        found = F.lit(None) if strict else value.getField(CORRUPT)
        unread = F.when(value.isNull(), F.coalesce(empty.cast("string"), F.lit("")))
        added.append(unread.otherwise(found).alias(CORRUPT))
        value = value if strict else value.dropFields(CORRUPT)
    for name in names:
        field = F.col("_parsed").getField(name)
        added.append((epoch_to_ts(field) if name == EVENT_TIME else field).alias(name))
    return parsed.select(
        *[value.alias("value") if c == "value" else F.col(c) for c in topic.columns], *added
    )


def malformed(model: TopicModel) -> Column:
    """True for a record of which nothing could be read. Needs the corrupt-record column."""
    unread = F.col(CORRUPT).isNotNull()
    for name in model.keys:
        unread = unread & F.col("value").getField(name).isNull()
    return unread


def good_records(decoded: DataFrame, model: TopicModel) -> DataFrame:
    """Decoded records without the malformed ones; partly readable ones stay."""
    return decoded.where(~malformed(model))


def rejects(decoded: DataFrame) -> DataFrame:
    """Every record that did not fit its model, with its text as received."""
    return decoded.where(F.col(CORRUPT).isNotNull()).select(
        "topic", "partition", "offset", "timestamp", F.col(CORRUPT).alias("record")
    )
