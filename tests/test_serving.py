from datetime import date
from pathlib import Path

import pytest
from helpers import at, seconds_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyrill.models import SERVING, TRENDING, UNIQUE_ACTIVE, WINDOWED_COMMENTS
from tallyrill.operators.series import look_back
from tallyrill.sources import files
from tallyrill.sources.serving import Serving, stream_version


def _windows(spark, counts):
    rows = [(date(2024, 1, 1), at(s), c) for s, c in counts.items()]
    return spark.createDataFrame(rows, WINDOWED_COMMENTS.schema)


@pytest.fixture
def store(root):
    return Serving(root)


def _put(spark, store, version, counts):
    store.upsert(_windows(spark, counts), WINDOWED_COMMENTS, version)


def _now(spark, store):
    return seconds_of(store.latest(spark, WINDOWED_COMMENTS))


def test_tables():
    assert {n: (t.keys, t.values) for n, t in SERVING.items()} == {
        "windowed_submissions": (("date", "window"), ["count"]),
        "windowed_comments": (("date", "window"), ["count"]),
        "unique_active_subreddits":
            (("date", "window"), ["active_subreddits", "submissions_and_comments"]),
        "trending_subreddits":
            (("subreddit",), ["submissions", "comments", "total", "last_update"]),
    }


def test_later_versions_replace_rows_by_key(spark, store):
    assert _now(spark, store) == {}
    _put(spark, store, 1, {5: 1, 10: 2})
    _put(spark, store, 2, {10: 7, 15: 3})
    assert _now(spark, store) == {5: 1, 10: 7, 15: 3}
    assert seconds_of(store.latest(spark, WINDOWED_COMMENTS, upto=1)) == {5: 1, 10: 2}


def test_a_replayed_version_changes_nothing(spark, store):
    _put(spark, store, 1, {5: 1})
    _put(spark, store, 2, {5: 4})
    _put(spark, store, 2, {5: 4})
    assert _now(spark, store) == {5: 4}
    assert store.versions(spark, WINDOWED_COMMENTS).count() == 2


def test_a_new_generation_outranks_the_old_one(spark, store):
    _put(spark, store, stream_version(0, 900), {5: 1})
    _put(spark, store, stream_version(1, 0), {5: 2})
    assert _now(spark, store) == {5: 2}


def test_rows_without_a_key_are_not_stored(spark, store):
    rows = spark.createDataFrame([(None, 1, 1, 2, at(0)), ("a", 1, 0, 1, at(0))], TRENDING.schema)
    store.upsert(rows, TRENDING, 1)
    assert [r.subreddit for r in store.latest(spark, TRENDING).collect()] == ["a"]


def test_look_back_reaches_the_scan(spark, store):
    _put(spark, store, 1, {s: s for s in range(5, 500, 5)})
    held = spark.createDataFrame([(at(490),), (at(400),)], "window timestamp")
    rows = store.read_since(spark, WINDOWED_COMMENTS, look_back(held))
    # 390 is 100 seconds before 490, and the bound itself is not read.
    assert sorted(seconds_of(rows)) == list(range(395, 500, 5))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(window,ScalarSubquery" in plan
    assert "SortAggregate" not in plan


def test_empty_writes_are_harmless(spark, store):
    _put(spark, store, 1, {})
    assert _now(spark, store) == {}
    _put(spark, store, 2, {5: 1})
    assert _now(spark, store) == {5: 1}


def _parts(spark, path):
    return [n.removeprefix("part=").split("-")[0] for n in files.children(spark, path)]


def test_parts_that_are_not_committed_are_not_read(spark, store):
    _put(spark, store, 1, {5: 1})
    path = store.path(WINDOWED_COMMENTS)
    rows = store.versions(spark, WINDOWED_COMMENTS).drop("part").withColumn("version", F.lit(9).cast("long"))
    rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/part=9-torn")
    assert _now(spark, store) == {5: 1}


def test_a_replay_hides_nothing_before_it_is_complete(spark, store, monkeypatch):
    _put(spark, store, 1, {5: 1})
    _put(spark, store, 2, {5: 2})
    seen = []
    remove = files.remove
    monkeypatch.setattr(files, "remove", lambda s, path: (seen.append(_now(spark, store)), remove(s, path)))
    _put(spark, store, 2, {5: 2})
    assert seen == [{5: 2}] and _now(spark, store) == {5: 2}
    assert _parts(spark, store.path(WINDOWED_COMMENTS)) == ["1", "2"]


def test_the_next_generation_is_above_all_stored(spark, store):
    tables = [WINDOWED_COMMENTS, UNIQUE_ACTIVE]
    assert store.next_generation(spark, tables) == 0
    _put(spark, store, stream_version(3, 7), {5: 1})
    assert store.next_generation(spark, tables) == 4


def test_external_stores_have_no_versions(spark, root):
    store = Serving(format="parquet", options={"path": f"{root}/out"})
    for read in (lambda: store.versions(spark, TRENDING), lambda: store.latest(spark, TRENDING, upto=1)):
        with pytest.raises(ValueError):
            read()


def test_compaction_keeps_the_view_and_the_newest_part(spark, store):
    for version in range(1, 6):
        _put(spark, store, version, {5: version, 5 * version: version})
    before = _now(spark, store)
    store.compact(spark, WINDOWED_COMMENTS)
    path = store.path(WINDOWED_COMMENTS)
    assert _parts(spark, path) == ["5", "c1"]
    assert _now(spark, store) == before
    _put(spark, store, 6, {5: 60})
    store.compact(spark, WINDOWED_COMMENTS)
    assert _parts(spark, path) == ["6", "c2"]
    assert _now(spark, store) == {**before, 5: 60}
    store.compact(spark, WINDOWED_COMMENTS)
    assert _parts(spark, path) == ["6", "c2"]


def test_a_crash_while_dropping_compacted_parts(spark, store, monkeypatch):
    for version in range(1, 5):
        _put(spark, store, version, {5: version, 5 * version: version})
    before = _now(spark, store)
    dropped = []

    def crash(spark, path):
        dropped.append(path)
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(files, "remove", crash)
        with pytest.raises(OSError):
            store.compact(spark, WINDOWED_COMMENTS)
    assert dropped and _now(spark, store) == before
    store.compact(spark, WINDOWED_COMMENTS)
    assert _now(spark, store) == before


def test_a_compacted_row_never_outranks_a_newer_one(spark, store):
    _put(spark, store, 1, {5: 1})
    _put(spark, store, 2, {10: 2})
    _put(spark, store, 3, {5: 3})
    store.compact(spark, WINDOWED_COMMENTS)
    assert _now(spark, store) == {5: 3, 10: 2}


def test_two_measures_stay_together(spark, store):
    for version, row in enumerate([(5, 9), (7, 8)], start=1):
        rows = spark.createDataFrame([(date(2024, 1, 1), at(5), *row)], UNIQUE_ACTIVE.schema)
        store.upsert(rows, UNIQUE_ACTIVE, version)
    assert seconds_of(store.latest(spark, UNIQUE_ACTIVE)) == {5: (7, 8)}


def test_other_stores_hold_plain_rows(spark, root):
    store = Serving(format="parquet", options={"path": f"{root}/out"})
    _put(spark, store, 1, {5: 1})
    assert sorted(spark.read.parquet(f"{root}/out").columns) == ["count", "date", "window"]
    store.compact(spark, WINDOWED_COMMENTS)
    assert _now(spark, store) == {5: 1}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dictionaries(st.integers(1, 6), st.integers(0, 99), max_size=4), min_size=1, max_size=4))
def test_latest_against_python(spark, tmp_path_factory, writes):
    store = Serving(str(tmp_path_factory.mktemp("serving")))
    expected = {}
    for version, counts in enumerate(writes):
        _put(spark, store, version, {5 * s: c for s, c in counts.items()})
        expected.update({5 * s: c for s, c in counts.items()})
    assert _now(spark, store) == expected
    store.compact(spark, WINDOWED_COMMENTS)
    assert _now(spark, store) == expected




def test_a_thousand_parts_are_found_in_one_call(spark, store, monkeypatch):
    _put(spark, store, 1, {5: 1})
    path = store.path(WINDOWED_COMMENTS)
    for version in range(2, 1002):
        part = Path(path) / f"part={version}-x"
        part.mkdir()
        if version % 2:
            (part / "_SUCCESS").touch()
    calls, opened = [], files._open
    monkeypatch.setattr(files, "_open", lambda s, p: (calls.append(p), opened(s, p))[1])
    assert len(store.parts(spark, WINDOWED_COMMENTS)) == 501
    assert len(calls) == 1


def test_parts_that_are_not_named_are_left_out(spark, store):
    _put(spark, store, 1, {5: 1})
    named = store.upsert(_windows(spark, {5: 2}), WINDOWED_COMMENTS, 2, replace=False)
    other = store.upsert(_windows(spark, {5: 3}), WINDOWED_COMMENTS, 2, replace=False)
    first = next(p for p in store.parts(spark, WINDOWED_COMMENTS) if p.startswith("1-"))
    assert seconds_of(store.latest(spark, WINDOWED_COMMENTS, only=[first, named])) == {5: 2}
    assert seconds_of(store.latest(spark, WINDOWED_COMMENTS, only=[first, other])) == {5: 3}
    store.compact(spark, WINDOWED_COMMENTS, [first, named])
    assert sorted(store.parts(spark, WINDOWED_COMMENTS)) == sorted([first, named])
