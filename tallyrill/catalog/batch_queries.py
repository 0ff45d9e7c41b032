"""Registered queries on batch tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrill.catalog import bindings as b
from tallyrill.functions.codec import decode, encode, malformed, topic_rows
from tallyrill.functions.scalars import epoch_to_ts, offset_bucket
from tallyrill.models import (
    COMMENT,
    CORRUPT,
    REDDITOR,
    SUBMISSION,
    SUBREDDIT,
    WINDOWED_COMMENTS,
    TopicModel,
)
from tallyrill.operators import ranking, series, windows
from tallyrill.plans.batch import current_ranking, pending, run_batch
from tallyrill.plans.layout import Job
from tallyrill.session import scratch, sweeping
from tallyrill.sources import landed, offsets
from tallyrill.sources.serving import Serving
from tallyrill.sources.topics import Topics

HOUR = "1 hour"


# Windows


def win_submissions_5s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.windowed_count(b.submissions(b.events(spark, sf_dir)))


def win_comments_5s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.windowed_count(b.comments(b.events(spark, sf_dir)))


def win_all_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.windowed_count(b.events(spark, sf_dir), size=HOUR)


def win_sliding_1h_15m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.windowed_count(b.events(spark, sf_dir), size=HOUR, slide="15 minutes")


def win_lines_7d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.windowed_count(b.lines(spark, sf_dir), size="7 days")


def active_exact_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.windowed_active(b.events(spark, sf_dir), size=HOUR, exact=True)


def active_approx_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the approximate count keeps to its bound, per hour."""
    ev = b.events(spark, sf_dir)
    exact = windows.windowed_active(ev, size=HOUR, exact=True).withColumnRenamed("active_subreddits", "exact")
    both = windows.windowed_active(ev, size=HOUR).join(exact, ["date", "window", "submissions_and_comments"])
    return both.select("date", "window", "exact", b.within_bound("active_subreddits", "exact"))


def active_approx_error_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the approximate count keeps to its error bound, per day."""
    ev = b.events(spark, sf_dir)
    per_day = ev.groupBy(F.window("created_utc", "1 day")).agg(
        F.approx_count_distinct("subreddit", windows.RSD).alias("approx"),
        F.count_distinct("subreddit").alias("exact"),
    )
    close = F.abs(F.col("approx") - F.col("exact")) <= 4 * windows.RSD * F.col("exact")
    return per_day.select(F.col("window.end").alias("window"), "exact", close.alias("within_bound"))


def activity_5s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-pass aggregate behind the speed layer, without its approximate column."""
    activity = windows.windowed_activity_tagged(b.tagged(b.events(spark, sf_dir)))
    return activity.drop("active_subreddits")


# Ranking


def tag_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.tag_union(b.kinds(b.events(spark, sf_dir)))


def pivot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.pivot_counts(b.tagged(b.events(spark, sf_dir)))


def latest_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.latest_time(b.kinds(b.events(spark, sf_dir)))


def trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.trending_tagged(b.tagged(b.events(spark, sf_dir)))


def trending_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.trending_tagged(b.lines(spark, sf_dir))


def trending_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking of a second run, which starts past the middle offset."""
    ev = b.events(spark, sf_dir)
    return ranking.trending(b.kinds(ev.where(b.second_half(ev))))


def trending_one_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = b.events(spark, sf_dir)
    return ranking.trending({"submissions": b.submissions(ev), "comments": _no_comments(spark)})


def trending_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch run over records without a time ranks none, but saves its positions."""
    root = scratch(spark)
    job = Job(root, Topics("parquet", f"{root}/topics"))
    for model, rows in ((SUBMISSION, b.documents(spark, sf_dir)), (COMMENT, b.conversations(spark, sf_dir))):
        decoded = decode(topic_rows(rows, model), model, bucket_size=job.bucket_size)
        landed.write_landed(decoded, model, f"{job.landed}/{model.source}")
    run_batch(spark, job)
    saved = offsets.latest(offsets.read_log(spark, job.offsets))
    ranked = current_ranking(spark, job).agg(F.count(F.lit(1)).alias("ranked"))
    return saved.select("source", "partition", "offset", ranked.scalar().alias("ranked"))


def empty_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = b.events(spark, sf_dir)
    return ranking.tag_union({"submissions": b.submissions(ev), "comments": _no_comments(spark)})


def _no_comments(spark: SparkSession) -> DataFrame:
    empty = landed.empty_landed(spark, COMMENT)
    return empty.withColumn("created_utc", F.col("created_utc").cast("timestamp_ntz"))


# Landed data and offsets


def _landed(spark: SparkSession, ev: DataFrame, root: str, models: tuple[TopicModel, ...]):
    for model in models:
        decoded = b.decoded_events(ev, model, Job.bucket_size)
        landed.write_landed(decoded, model, f"{root}/{model.source}")


def _half_processed(spark: SparkSession, log: str, root: str, models, ev: DataFrame) -> None:
    """Log a first run that reached the middle offset of each source."""
    half = ~b.second_half(ev)
    for run_id, model in enumerate(models, start=1):
        stored = landed.read_stored(spark, model, f"{root}/{model.source}").where(half)
        reached = offsets.reached(stored.withColumn("source", F.lit(model.source)))
        offsets.append(spark, log, reached, run_id)


def scan_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a landed table, log half of it as processed, read the rest."""
    ev, root = b.events(spark, sf_dir), scratch(spark)
    _landed(spark, ev, root, (SUBMISSION,))
    _half_processed(spark, f"{root}/offsets", root, (SUBMISSION,), ev)
    at = offsets.positions(offsets.read_log(spark, f"{root}/offsets"))["submission"]
    rows = landed.read_since(spark, SUBMISSION, f"{root}/submission", at)
    return rows.select("id", "subreddit", "selftext", "offset", "partition")


def discover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two sources one is processed to the middle, of the other half has been landed since."""
    ev, root = b.events(spark, sf_dir), scratch(spark)
    job = Job(root, Topics("parquet", f"{root}/topics"))
    _landed(spark, ev, job.landed, (SUBMISSION,))
    _landed(spark, ev.where(b.second_half(ev)), job.landed, (COMMENT,))
    _half_processed(spark, job.offsets, job.landed, (SUBMISSION,), ev)
    return pending(spark, job)


def _positions(ev: DataFrame) -> DataFrame:
    return offsets.reached(
        ev.select("partition", "offset", F.col("event_type").alias("source"),
                  offset_bucket("offset").alias("offset_batch"))
    )


def offset_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev, log = b.events(spark, sf_dir), scratch(spark)
    offsets.append(spark, log, _positions(ev), 1)
    return offsets.read_log(spark, log)


def offset_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs: all kinds up to the middle, then the rest of two kinds."""
    ev, log = b.events(spark, sf_dir), scratch(spark)
    later = b.second_half(ev)
    offsets.append(spark, log, _positions(ev.where(~later)), 1)
    offsets.append(
        spark, log, _positions(ev.where(later & F.col("event_type").isin("purchase", "view"))), 2
    )
    return offsets.latest(offsets.read_log(spark, log))


def bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.events(spark, sf_dir).select("offset", offset_bucket("offset").alias("offset_batch"))


def epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fractional epoch seconds to whole-second timestamps."""
    ev = b.events(spark, sf_dir)
    seconds = F.unix_micros(F.col("created_utc").cast("timestamp")) / 1e6
    return ev.select("event_id", epoch_to_ts(seconds).cast("timestamp_ntz").alias("created_utc"))


# Codec


def encode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded records taken apart again as plain JSON text."""
    encoded = encode(b.documents(spark, sf_dir), SUBMISSION)
    text = F.col("value").cast("string")
    # All members read as text, so the check does not lean on the declared types.
    parsed = F.from_json(text, ", ".join(f"{k} string" for k in SUBMISSION.keys))
    return encoded.select(
        "topic",
        F.size(F.json_object_keys(text)).cast("bigint").alias("n_keys"),
        F.explode(F.array(parsed)).alias("r"),
    ).select(
        "topic", "n_keys", "r.id", "r.subreddit", "r.subreddit_subscribers", "r.title",
        "r.author", "r.over_18", "r.selftext",
    )


def decode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = topic_rows(b.documents(spark, sf_dir), SUBMISSION)
    return decode(topic, SUBMISSION).select(
        "topic", "offset", "offset_batch", "id", "subreddit", "subreddit_subscribers", "title",
        "author", "over_18", "selftext",
    )


def decode_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = topic_rows(b.conversations(spark, sf_dir), COMMENT)
    return decode(topic, COMMENT).select("id", "subreddit", "link_id", "author", "body")


def decode_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON the events carry, decoded by a model of its own."""
    model = TopicModel("props", (("k", "integer"),))
    topic = b.events(spark, sf_dir).select("offset", F.col("props").cast("binary").alias("value"))
    return decode(topic, model).select("offset", "k")


def decode_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records damaged in several ways, by event type: which are rejects, which stay records."""
    records = b.as_record(b.events(spark, sf_dir), SUBMISSION)
    whole = topic_rows(records, SUBMISSION, "title")
    text, kind = F.col("value").cast("string"), F.col("title")
    damaged = (
        F.when(kind == "error", F.substring(text, 1, 30))
        .when(kind == "signup", F.lit(""))
        .when(kind == "click", F.regexp_replace(text, '"over_18":(true|false)', '"over_18":"x"'))
        .otherwise(text)
    )
    whole = whole.withColumn("value", damaged.cast("binary")).drop("title")
    decoded = decode(whole, SUBMISSION)
    parts = F.array_compact(
        F.array(
            F.when(F.col(CORRUPT).isNotNull(), F.lit("reject")),
            F.when(~malformed(SUBMISSION), F.lit("record")),
        )
    )
    return decoded.select("offset", F.explode(parts).alias("part"))


# Serving tables and series


def _hourly(df: DataFrame) -> DataFrame:
    timed = df.withColumn("created_utc", F.col("created_utc").cast("timestamp"))
    return windows.windowed_count(timed, size=HOUR)


def _shown(rows: DataFrame) -> DataFrame:
    return rows.withColumn("window", F.col("window").cast("timestamp_ntz"))


def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of purchases, then hours of views over them: the later row of a key stays."""
    ev, store = b.events(spark, sf_dir), Serving(scratch(spark))
    store.upsert(_hourly(b.submissions(ev)), WINDOWED_COMMENTS, 1)
    store.upsert(_hourly(b.comments(ev)), WINDOWED_COMMENTS, 2)
    return _shown(store.latest(spark, WINDOWED_COMMENTS))


def compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with hours of signups as a third version, read after compaction."""
    ev, store = b.events(spark, sf_dir), Serving(scratch(spark))
    store.upsert(_hourly(b.submissions(ev)), WINDOWED_COMMENTS, 1)
    store.upsert(_hourly(b.comments(ev)), WINDOWED_COMMENTS, 2)
    store.upsert(_hourly(ev.where(F.col("event_type") == "signup")), WINDOWED_COMMENTS, 3)
    store.compact(spark, WINDOWED_COMMENTS)
    return _shown(store.latest(spark, WINDOWED_COMMENTS))


def lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows read again when a view refreshes: those after its position less the allowance."""
    store = Serving(scratch(spark))
    store.upsert(_hourly(b.events(spark, sf_dir)), WINDOWED_COMMENTS, 1)
    newer = series.look_back(store.latest(spark, WINDOWED_COMMENTS), window_seconds=3600)
    return _shown(store.read_since(spark, WINDOWED_COMMENTS, newer))


def _series(counts: DataFrame) -> DataFrame:
    return counts.select("window", F.col("count").alias("y1"))


def merge_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = b.events(spark, sf_dir)
    held, read = (_series(windows.windowed_count(side, size=HOUR)) for side in b.kinds(ev).values())
    return series.merge_max(held, read)


def latest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.latest_n(_series(windows.windowed_count(b.events(spark, sf_dir))))


def mean_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.with_mean(latest_n(spark, sf_dir))


def view_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A held series of purchases refreshed by the counts of all events, with its mean."""
    ev = b.events(spark, sf_dir)
    held = series.latest_n(_series(windows.windowed_count(b.submissions(ev), size=HOUR)))
    return series.with_mean(series.refresh(held, _series(windows.windowed_count(ev, size=HOUR))))


QUERIES = {
    f.__name__: sweeping(f)
    for f in (
        win_submissions_5s, win_comments_5s, win_all_1h, win_sliding_1h_15m, win_lines_7d,
        active_exact_1h, active_approx_1h,
        active_approx_error_1d, activity_5s, tag_union, pivot_counts, latest_time,
        trending, trending_lines, trending_since, trending_one_kind, trending_null, empty_side,
        scan_since, discover, offset_append, offset_latest, bucket, epoch, decode_props,
        decode_conversations, decode_rejects, upsert, compact, lookback, merge_max, latest_n,
        mean_line, view_refresh,
    )
} | {"encode": encode_documents, "decode": decode_documents}
