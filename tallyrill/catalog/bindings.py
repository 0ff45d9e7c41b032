"""How the driver's tables stand in for topics: see FIXTURES.md."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrill.functions.codec import decode, topic_rows
from tallyrill.models import COMMENT, SUBMISSION, TopicModel
from tallyrill.operators.windows import RSD

PARTITIONS = 3
KIND_OF = {"submission": "purchase", "comment": "view", "subreddit": "signup"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the columns that operators expect of records."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        F.col("user_id").cast("string").alias("subreddit"),
        F.col("ts").alias("created_utc"),
        F.col("event_id").alias("offset"),
        (F.col("event_id") % PARTITIONS).cast("int").alias("partition"),
        "value",
        "props",
    )


def submissions(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == "purchase")


def comments(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == "view")


def kinds(ev: DataFrame) -> dict[str, DataFrame]:
    return {"submissions": submissions(ev), "comments": comments(ev)}


def tagged(ev: DataFrame) -> DataFrame:
    """Both kinds as one tagged table, so that the events are scanned once."""
    kind = F.when(F.col("event_type") == "purchase", "submissions").otherwise("comments")
    both = ev.where(F.col("event_type").isin("purchase", "view"))
    return both.select("subreddit", "created_utc", kind.alias("kind"))


def within_bound(approximate: str, exact: str) -> Column:
    """Few keys may share a register, which alone exceeds the relative bound."""
    off = F.abs(F.col(approximate) - F.col(exact))
    return (off <= F.greatest(F.lit(2.0), 4 * RSD * F.col(exact))).alias("within_bound")


def second_half(ev: DataFrame) -> Column:
    """True past the middle offset: what a second run finds."""
    return F.col("offset") > ev.agg((F.floor(F.max("offset") / 2))).scalar()


def as_record(ev: DataFrame, model: TopicModel) -> DataFrame:
    """Events as records of a model, with the broker's columns beside them."""
    seconds = F.unix_micros(F.col("created_utc").cast("timestamp")) / 1e6
    values = {
        "id": F.col("event_id").cast("string"),
        "subreddit": F.col("subreddit"),
        "subreddit_subscribers": F.lit(None).cast("int"),
        "title": F.col("event_type"),
        "author": F.lit(None).cast("string"),
        "created_utc": seconds,
        "over_18": F.col("value") > 20,
        "selftext": F.col("props"),
        "link_id": F.col("event_type"),
        "body": F.col("props"),
        "display_name": F.col("subreddit"),
        "description": F.col("props"),
        "over18": F.col("value") > 20,
        "subscribers": F.lit(None).cast("int"),
        "name": F.col("subreddit"),
    }
    return ev.select(
        "partition",
        "offset",
        F.col("created_utc").cast("timestamp").alias("timestamp"),
        *[values[name].alias(name) for name in model.keys],
    )


def event_records(ev: DataFrame, model: TopicModel) -> DataFrame:
    """The events of a model's kind, as its records."""
    return as_record(ev.where(F.col("event_type") == KIND_OF[model.source]), model)


def decoded_events(ev: DataFrame, model: TopicModel, bucket_size: int) -> DataFrame:
    return decode(topic_rows(event_records(ev, model), model), model, bucket_size=bucket_size)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as submissions without a time; the whole text goes through."""
    return table(spark, sf_dir, "documents").select(
        F.lit(0).alias("partition"),
        F.col("doc_id").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.col("doc_id").cast("string").alias("id"),
        F.col("source").alias("subreddit"),
        F.col("n_chars").cast("int").alias("subreddit_subscribers"),
        F.lit(None).cast("string").alias("title"),
        F.col("lang").alias("author"),
        F.lit(None).cast("double").alias("created_utc"),
        (F.col("n_chars") > 1000).alias("over_18"),
        F.col("text").alias("selftext"),
    )


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as comments without a time."""
    return table(spark, sf_dir, "conversations").select(
        F.lit(0).alias("partition"),
        F.col("conv_id").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        F.lit(None).cast("string").alias("subreddit"),
        F.col("conv_id").cast("string").alias("link_id"),
        F.col("role").alias("author"),
        F.lit(None).cast("double").alias("created_utc"),
        F.col("text").alias("body"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as activity: part as key, line status as kind, ship date as time."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("subreddit"),
        F.when(F.col("l_linestatus") == "O", "submissions").otherwise("comments").alias("kind"),
        F.col("l_shipdate").alias("created_utc"),
    )


MODELS_USED = (SUBMISSION, COMMENT)
