"""Builders shared by the tests."""

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tallyrill.models import COMMENT, SUBMISSION, TOPIC_SCHEMA
from tallyrill.plans.layout import Job
from tallyrill.plans.speed import drain
from tallyrill.sources.topics import Topics

DAY = datetime(2024, 1, 1)
DAY_SECONDS = 1704067200


def at(seconds):
    return DAY + timedelta(seconds=seconds)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def topic_of(spark, texts, model=SUBMISSION, partition=0, first_offset=0):
    """Kafka-shaped rows from JSON texts."""
    data = [
        (None, None if t is None else bytearray(t.encode()), model.topic, partition,
         first_offset + i, DAY, 0)
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(data, TOPIC_SCHEMA)


def record(key, seconds, **fields):
    when = None if seconds is None else float(DAY_SECONDS + seconds)
    return json.dumps({"subreddit": key, "created_utc": when, **fields})


def file_job(root, **settings):
    settings.setdefault("trigger", {"availableNow": True})
    settings.setdefault("bucket_size", 1000)
    settings.setdefault("topics", Topics("parquet", f"{root}/topics"))
    return Job(root, **settings)


def feed(spark, job, submissions=(), comments=(), partition=0, first_offset=0):
    """One file per topic; topics without records still get their folder."""
    for model, texts in ((SUBMISSION, submissions), (COMMENT, comments)):
        rows = topic_of(spark, texts, model, partition, first_offset)
        rows.coalesce(1).write.mode("append").parquet(job.topics.path(model))


def run(queries):
    drain(queries)


def seconds_of(df):
    """Window ends as seconds of the test day, with the other columns."""
    others = [c for c in df.columns if c not in ("date", "window")]
    seconds = (F.unix_seconds("window") - DAY_SECONDS).alias("window")
    return {r[0]: tuple(r)[1:] if len(others) > 1 else r[1]
            for r in df.select(seconds, *others).collect()}
