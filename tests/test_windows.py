from datetime import date

import pytest
from helpers import DAY, at, rows_of, seconds_of
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyrill.operators.windows import (
    both_kinds,
    split_activity,
    windowed_active,
    windowed_activity,
    windowed_count,
)

SCHEMA = "created_utc timestamp, subreddit string"


def _df(spark, *rows):
    return spark.createDataFrame([(None if s is None else at(s), k) for s, k in rows], SCHEMA)


def test_borders_and_null_times(spark):
    df = _df(spark, (4.999, "a"), (5, "a"), (9.5, "b"), (None, "c"))
    assert seconds_of(windowed_count(df)) == {5: 1, 10: 2}


def test_a_window_ending_at_midnight_belongs_to_the_next_day(spark):
    row = windowed_count(_df(spark, (86399, "a"))).first()
    assert (row["date"], row["window"]) == (date(2024, 1, 2), at(86400))


def test_columns_and_types(spark):
    assert windowed_count(_df(spark, (1, "a"))).dtypes == [
        ("date", "date"), ("window", "timestamp"), ("count", "bigint"),
    ]


def test_sliding_windows_overlap(spark):
    df = _df(spark, (7, "a"))
    assert seconds_of(windowed_count(df, size="10 seconds", slide="5 seconds")) == {10: 1, 15: 1}


def test_null_keys_count_for_rows_but_not_for_activity(spark):
    df = _df(spark, (1, "a"), (2, None), (3, "a"), (4, "b"))
    assert seconds_of(windowed_count(df)) == {5: 4}
    assert seconds_of(windowed_active(df, exact=True)) == {5: (2, 3)}
    assert seconds_of(windowed_active(df)) == {5: (2, 3)}


def test_one_pass_gives_the_same_tables(spark):
    sub = _df(spark, (1, "a"), (2, None), (6, "b"), (12, "a"))
    com = _df(spark, (3, "b"), (17, "c"), (None, "c"))
    tables = split_activity(
        windowed_activity({"submissions": sub, "comments": com}), ["submissions", "comments"]
    )
    assert rows_of(tables["windowed_submissions"]) == rows_of(windowed_count(sub))
    assert rows_of(tables["windowed_comments"]) == rows_of(windowed_count(com))
    both = both_kinds(sub, com)
    assert rows_of(tables["unique_active_subreddits"]) == rows_of(windowed_active(both))


def test_partial_aggregation_comes_before_the_shuffle(spark):
    plan = windowed_count(_df(spark, (1, "a")))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_count")
    assert "Sort" not in plan


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.sampled_from("abc")), min_size=1, max_size=30))
def test_counts_against_python(spark, rows):
    expected = {}
    for second, key in rows:
        end = (second // 5 + 1) * 5
        keys = expected.setdefault(end, [])
        keys.append(key)
    got = seconds_of(windowed_active(_df(spark, *rows), exact=True))
    assert got == {end: (len(set(keys)), len(keys)) for end, keys in expected.items()}


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_short_windows_do_not_depend_on_the_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        counted = seconds_of(windowed_count(spark.createDataFrame([(DAY, "a")], SCHEMA)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert counted == {5: 1}
