from datetime import date

from helpers import at

from tallyrill.models import UNIQUE_ACTIVE, WINDOWED_COMMENTS
from tallyrill.operators import series
from tallyrill.plans.view import refresh_view, view_lines
from tallyrill.sources.serving import Serving


def _series(spark, counts):
    rows = [(at(s), c) for s, c in counts.items()]
    return spark.createDataFrame(rows, "window timestamp, y1 bigint")


def _plain(df):
    return {(r["window"] - at(0)).seconds: r["y1"] for r in df.collect()}


def test_merge_takes_the_larger_count(spark):
    merged = series.merge_max(_series(spark, {5: 5, 10: 7}), _series(spark, {5: 6, 10: 7, 15: 2}))
    assert _plain(merged) == {5: 6, 10: 7, 15: 2}


def test_latest_windows(spark):
    assert _plain(series.latest_n(_series(spark, {s: s for s in range(50)}), 3)) == {47: 47, 48: 48, 49: 49}


def test_mean_on_every_row_and_none_for_an_empty_series(spark):
    rows = series.with_mean(_series(spark, {5: 1, 10: 2})).collect()
    assert [r["mean"] for r in rows] == [1.5, 1.5]
    empty = series.with_mean(_series(spark, {}))
    assert empty.collect() == [] and dict(empty.dtypes)["mean"] == "double"


def test_refresh_is_in_order(spark):
    fresh = series.refresh(_series(spark, {5: 1, 10: 1}), _series(spark, {20: 1, 15: 1}), 3)
    assert list(_plain(fresh)) == [10, 15, 20]


def test_mean_reuses_the_aggregation(spark, root):
    # Counts behind the series are shuffled once, for the rows and for their mean.
    counted = spark.range(1000).selectExpr("id % 50 as window").groupBy("window").count()
    lines = series.with_mean(series.latest_n(counted, 10), "count")
    lines.collect()
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def _put(spark, store, version, counts, table=WINDOWED_COMMENTS):
    rows = [(date(2024, 1, 1), at(s), *([c] if table is WINDOWED_COMMENTS else c))
            for s, c in counts.items()]
    store.upsert(spark.createDataFrame(rows, table.schema), table, version)


def test_view_reads_all_then_only_the_look_back(spark, root):
    store = Serving(root)
    _put(spark, store, 1, {s: 1 for s in range(5, 305, 5)})
    view = refresh_view(spark, store, WINDOWED_COMMENTS, n=50)
    assert _plain(view) == {s: 1 for s in range(55, 305, 5)}
    # 300 is the position. 205 is looked at again; 200 is 100 seconds back, so it is not.
    _put(spark, store, 2, {305: 9, 205: 5, 200: 7})
    view = refresh_view(spark, store, WINDOWED_COMMENTS, view, n=50)
    assert _plain(view) == {**{s: 1 for s in range(60, 305, 5)}, 205: 5, 305: 9}
    lines = view_lines(view).collect()
    assert {r["mean"] for r in lines} == {(48 + 5 + 9) / 50}
    assert [r["window"] for r in lines] == sorted(r["window"] for r in lines)


def test_view_of_two_measures(spark, root):
    store = Serving(root)
    _put(spark, store, 1, {5: (2, 3), 10: (1, 1)}, UNIQUE_ACTIVE)
    view = view_lines(refresh_view(spark, store, UNIQUE_ACTIVE))
    assert view.columns == ["window", "y1", "y2", "mean"]
    assert [tuple(r)[1:] for r in view.collect()] == [(2, 3, 1.5), (1, 1, 1.5)]


def test_view_of_an_empty_table(spark, root):
    store = Serving(root)
    view = refresh_view(spark, store, WINDOWED_COMMENTS)
    assert view.count() == 0
    _put(spark, store, 1, {5: 1})
    assert _plain(refresh_view(spark, store, WINDOWED_COMMENTS, view)) == {5: 1}
