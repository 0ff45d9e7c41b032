import json

import pytest
from helpers import topic_of
from pyspark.sql import functions as F

from tallyrill.functions.codec import decode, encode, good_records, record_value, rejects
from tallyrill.functions.scalars import epoch_to_ts, offset_bucket
from tallyrill.models import COMMENT, CORRUPT, MODELS, REDDITOR, SUBMISSION, TopicModel, model_of

# A small model with one field of each kind.
MIXED = TopicModel(
    "mixed",
    (("s", "string"), ("i", "integer"), ("created_utc", "double"), ("b", "boolean")),
    ("s",),
)


def _decoded(spark, *texts, **options):
    return decode(topic_of(spark, texts, MIXED), MIXED, **options)


def _values(spark, text):
    row = _decoded(spark, text).select("value.*", CORRUPT).first()
    return (row["s"], row["i"], row["created_utc"], row["b"]), row[CORRUPT]


def test_topic_names_and_lookup():
    assert [m.topic for m in MODELS.values()] == [
        "SubmissionProducer", "CommentProducer", "SubredditProducer", "RedditorProducer",
    ]
    assert model_of("CommentProducer") is COMMENT is model_of("comment")
    assert all(f.nullable for f in SUBMISSION.spark_schema)
    assert REDDITOR.spark_schema.simpleString() == "struct<id:string,name:string,created_utc:double>"


def test_timestamp_fields_have_a_type():
    model = TopicModel("timed", (("t", "timestamp"),))
    assert model.spark_schema.simpleString() == "struct<t:timestamp>"


@pytest.mark.parametrize(
    "text, values, corrupt",
    [
        ('{"s":"x","i":1,"created_utc":2.5,"b":true}', ("x", 1, 2.5, True), False),
        ('{"s":"x","extra":9}', ("x", None, None, None), False),
        ('{"s":7}', ("7", None, None, None), False),
        ('{"created_utc":2}', (None, None, 2.0, None), False),
        ('{"s":"x","i":1.5}', ("x", None, None, None), True),
        ('{"s":"x","i":"1"}', ("x", None, None, None), True),
        ('{"s":"x","b":"yes"}', ("x", None, None, None), True),
        ('{"s":"x","i":3000000000}', ("x", None, None, None), True),
        ('{"s":{"q":1}}', ('{"q":1}', None, None, None), False),
        ('{"s":"x","i":', (None, None, None, None), True),
        ("[]", (None, None, None, None), True),
        ("null", (None, None, None, None), True),
        ("", (None, None, None, None), True),
        ("{}", (None, None, None, None), False),
    ],
)
def test_decode_compatibility(spark, text, values, corrupt):
    got, marked = _values(spark, text)
    assert got == values
    assert (marked == text) if corrupt else (marked is None)


def test_malformed_records_are_left_out_but_kept_as_rejects(spark):
    texts = ['{"s":"x"}', '{"s":"x","i":"bad"}', '{"s":', "", "null", "[]", None, "{}"]
    decoded = _decoded(spark, *texts)
    good = [r.offset for r in good_records(decoded, MIXED).orderBy("offset").collect()]
    bad = [(r.offset, r.record) for r in rejects(decoded).orderBy("offset").collect()]
    assert good == [0, 1, 7]
    assert bad == [(1, texts[1]), (2, '{"s":'), (3, ""), (4, "null"), (5, "[]"), (6, "")]


@pytest.mark.parametrize("text", ['{"s":', '{"i":"x"}', "[]", "", None])
def test_fail_fast_stops_on_a_bad_record(spark, text):
    with pytest.raises(Exception, match="MALFORMED_RECORD|empty record"):
        _decoded(spark, text, mode="FAILFAST").collect()


def test_fail_fast_changes_no_good_record(spark):
    texts = ['{"s":"x","created_utc":2}', "{}", '{"s":7,"b":true}']
    strict = _decoded(spark, *texts, mode="FAILFAST")
    assert strict.dtypes == _decoded(spark, *texts).dtypes
    assert strict.collect() == _decoded(spark, *texts).collect()


def test_decoding_some_fields_agrees_with_decoding_all(spark):
    texts = ['{"s":"x","created_utc":1.5}', '{"s":"x","created_utc":1.5,"i":"bad"}',
             '{"created_utc":1.5,"s":"x', "", "null", '{"created_utc":"1"}']
    some = _decoded(spark, *texts, fields=["created_utc", "s"])
    every = _decoded(spark, *texts)
    columns = ["offset", "created_utc", "s"]
    assert some.select(columns).collect() == every.select(columns).collect()
    assert CORRUPT not in some.columns


def test_decode_parses_each_record_once(spark):
    windowed = _decoded(spark, '{"s":"x"}', fields=["created_utc"]).groupBy(
        F.window("created_utc", "5 seconds")
    ).count()
    plan = windowed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    assert "Python" not in plan


def test_decoded_columns(spark):
    columns = _decoded(spark, '{"s":"x"}').columns
    assert columns == [
        "key", "value", "topic", "partition", "offset", "timestamp", "timestampType",
        "_offset_batch", "offset_batch", CORRUPT, "s", "i", "created_utc", "b",
    ]


def test_encode_writes_nulls_and_coerces(spark):
    df = spark.createDataFrame([(5, None, 1577836807.5, True)],
                               "s int, i int, created_utc double, b boolean")
    row = encode(df, MIXED).first()
    assert json.loads(bytes(row["value"])) == {
        "s": "5", "i": None, "created_utc": 1577836807.5, "b": True,
    }
    assert row["topic"] == "MixedProducer"


def test_text_survives_the_round_trip(spark):
    text = 'é "quoted" \\ back\nslash\ttab   \U0001f600 {"a":1}'
    df = spark.createDataFrame([(text, 1, 1.25, None)],
                               "s string, i int, created_utc double, b boolean")
    topic = df.select(record_value(MIXED).alias("value"), F.lit(0).cast("bigint").alias("offset"))
    row = decode(topic, MIXED).first()
    assert (row["s"], row["i"], row["value"]["created_utc"], row["b"]) == (text, 1, 1.25, None)


@pytest.mark.parametrize(
    "offset, size, bucket",
    [(0, 1000, 0), (999, 1000, 0), (1000, 1000, 1000), (2_999_999, 1000, 2_999_000),
     (3_000_000_123, 1000, 3_000_000_000), (3_000_000_123, 10**6, 3_000_000_000), (57, 10, 50)],
)
def test_bucket(spark, offset, size, bucket):
    row = spark.range(1).select(offset_bucket(F.lit(offset), size).alias("b"))
    assert row.first()["b"] == bucket and row.dtypes == [("b", "bigint")]


@pytest.mark.parametrize(
    "seconds, text",
    [(1577836807.9, "2020-01-01 00:00:07"), (-1.5, "1969-12-31 23:59:59"), (0.0, "1970-01-01 00:00:00"),
     (None, None), (1e18, None), (float("nan"), None), (float("inf"), None), (-1e12, None)],
)
def test_epoch(spark, seconds, text):
    df = spark.createDataFrame([(seconds,)], "s double")
    assert df.select(epoch_to_ts("s").cast("string").alias("t")).first()["t"] == text


def test_bytes_that_are_not_utf8_do_not_stop_decoding(spark):
    good = bytearray(b'{"s":"x"}')
    rows = [(bytearray(b'{"s":"\xff"}'), 0), (bytearray(b"\xff\xfe"), 1), (good, 2)]
    topic = spark.createDataFrame(rows, "value binary, offset bigint")
    kept = good_records(decode(topic, MIXED), MIXED)
    assert [r.offset for r in kept.orderBy("offset").collect()] == [0, 2]


def test_records_of_many_kinds_survive_both_ways(spark):
    rows = [("k", 1, 2.5, True), (None, None, None, None), ("", -1, -0.5, False)]
    df = spark.createDataFrame(rows, "s string, i int, created_utc double, b boolean")
    topic = df.select(record_value(MIXED).alias("value"), F.lit(0).cast("bigint").alias("offset"))
    back = decode(topic, MIXED).select("s", "i", "value.created_utc", "b")
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(map(repr, rows))
