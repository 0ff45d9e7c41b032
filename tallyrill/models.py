"""Declared record models, topic and landed schemas, and serving tables.

Schemas are fixed and declared here; nothing is inferred from data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TYPES = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}

EVENT_TIME = "created_utc"
CORRUPT = "_corrupt_record"
# Landed with each record: nothing of it could be read.
UNREADABLE = "_unreadable"


@dataclass(frozen=True)
class TopicModel:
    """One record kind: its source name, typed fields, and fields sent as strings."""

    source: str
    fields: tuple[tuple[str, str], ...]
    to_str: tuple[str, ...] = ()

    @property
    def topic(self) -> str:
        return self.source.title() + "Producer"

    @property
    def keys(self) -> list[str]:
        return [name for name, _ in self.fields]

    @property
    def spark_schema(self) -> T.StructType:
        return self.schema_of(self.keys)

    def schema_of(self, names: list[str]) -> T.StructType:
        """Schema of some of the fields, in declared order."""
        return T.StructType(
            [T.StructField(n, TYPES[t], True) for n, t in self.fields if n in names]
        )


# Field names, types and string-coerced fields of the four topics.
SUBMISSION = TopicModel(
    "submission",
    (
        ("id", "string"),
        ("subreddit", "string"),
        ("subreddit_subscribers", "integer"),
        ("title", "string"),
        ("author", "string"),
        ("created_utc", "double"),
        ("over_18", "boolean"),
        ("selftext", "string"),
    ),
    ("subreddit", "author"),
)
COMMENT = TopicModel(
    "comment",
    (
        ("id", "string"),
        ("subreddit", "string"),
        ("link_id", "string"),
        ("author", "string"),
        ("created_utc", "double"),
        ("body", "string"),
    ),
    ("subreddit", "author"),
)
SUBREDDIT = TopicModel(
    "subreddit",
    (
        ("id", "string"),
        ("display_name", "string"),
        ("description", "string"),
        ("created_utc", "double"),
        ("over18", "boolean"),
        ("subscribers", "integer"),
    ),
)
REDDITOR = TopicModel(
    "redditor",
    (("id", "string"), ("name", "string"), ("created_utc", "double")),
)

MODELS = {m.source: m for m in (SUBMISSION, COMMENT, SUBREDDIT, REDDITOR)}


def model_of(name: str) -> TopicModel:
    """Look a model up by source name ('comment') or topic name ('CommentProducer')."""
    by_topic = {m.topic: m for m in MODELS.values()}
    return MODELS.get(name) or by_topic[name]


# The columns a Kafka source yields.
TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)


def stored_schema(model: TopicModel) -> T.StructType:
    """Columns of the landed Parquet files plus their two directory columns."""
    schema = T.StructType()
    for field in TOPIC_SCHEMA:
        schema.add(field.name, model.spark_schema if field.name == "value" else field.dataType)
    return (
        schema.add("offset_batch", T.LongType())
        .add(EVENT_TIME, T.TimestampType())
        .add(CORRUPT, T.StringType())
        .add(UNREADABLE, T.BooleanType())
        .add("_partition", T.IntegerType())
        .add("_offset_batch", T.LongType())
    )


OFFSET_LOG_SCHEMA = "source string, partition int, offset_batch bigint, offset bigint, run_id bigint"


@dataclass(frozen=True)
class ServingTable:
    """A keyed table: the last version written for a key is its row."""

    name: str
    schema: str
    keys: tuple[str, ...]
    order_by: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [part.split()[0] for part in self.schema.split(", ")]

    @property
    def values(self) -> list[str]:
        return [c for c in self.columns if c not in self.keys]


# Names, columns and keys of the serving tables.
WINDOWED_SUBMISSIONS = ServingTable(
    "windowed_submissions",
    "date date, window timestamp, count bigint",
    ("date", "window"),
    ("date", "window"),
)
WINDOWED_COMMENTS = ServingTable(
    "windowed_comments",
    "date date, window timestamp, count bigint",
    ("date", "window"),
    ("date", "window"),
)
UNIQUE_ACTIVE = ServingTable(
    "unique_active_subreddits",
    "date date, window timestamp, active_subreddits bigint, submissions_and_comments bigint",
    ("date", "window"),
    ("date", "window"),
)
TRENDING = ServingTable(
    "trending_subreddits",
    "subreddit string, submissions bigint, comments bigint, total bigint, last_update timestamp",
    ("subreddit",),
    ("subreddit",),
)
SERVING = {
    t.name: t for t in (WINDOWED_SUBMISSIONS, WINDOWED_COMMENTS, UNIQUE_ACTIVE, TRENDING)
}
