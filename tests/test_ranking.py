from helpers import at, rows_of
from pyspark.sql import functions as F

from tallyrill.models import COMMENT
from tallyrill.operators import ranking
from tallyrill.sources.landed import empty_landed

SCHEMA = "created_utc timestamp, subreddit string"


def _df(spark, *rows):
    return spark.createDataFrame([(None if s is None else at(s), k) for s, k in rows], SCHEMA)


def _sides(spark, submissions=(), comments=()):
    return {"submissions": _df(spark, *submissions), "comments": _df(spark, *comments)}


def test_totals_order_and_ties(spark):
    sides = _sides(spark, [(1, "a"), (2, "b"), (3, "c")], [(4, "c"), (9, "b"), (5, "d")])
    got = [tuple(r) for r in ranking.trending(sides, n=3).collect()]
    assert got == [("b", 1, 1, 2, at(9)), ("c", 1, 1, 2, at(9)), ("a", 1, 0, 1, at(9))]


def test_the_time_is_the_latest_of_all_keys_not_of_the_ranked(spark):
    sides = _sides(spark, [(1, "a"), (2, "a")], [(50, "b")])
    assert ranking.trending(sides, n=1).first()["last_update"] == at(50)


def test_one_kind_only(spark):
    sides = {"submissions": _df(spark, (1, "a")), "comments": empty_landed(spark, COMMENT)}
    assert rows_of(ranking.trending(sides)) == [("a", 1, 0, 1, at(1))]
    pivoted = ranking.pivot_counts(ranking.tag_union(sides))
    assert rows_of(pivoted) == [("a", 1, 0)]


def test_null_keys_are_not_ranked(spark):
    sides = _sides(spark, [(1, None), (2, None), (3, "a")])
    assert rows_of(ranking.trending(sides)) == [("a", 1, 0, 1, at(3))]


def test_no_times_no_ranking(spark):
    assert ranking.trending(_sides(spark, [(None, "a")], [(None, "b")])).isEmpty()
    assert ranking.trending(_sides(spark)).isEmpty()
    assert rows_of(ranking.latest_time(_sides(spark))) == [(None,)]


def test_latest_time_of_sides_with_different_columns(spark):
    sides = {"submissions": _df(spark, (7, "a")).withColumn("more", F.lit(1)),
             "comments": _df(spark, (9, "a"))}
    assert ranking.latest_time(sides).first()[0] == at(9)


def test_union_keeps_duplicates(spark):
    tagged = ranking.tag_union(_sides(spark, [(1, "a"), (1, "a")], [(1, "a")]))
    assert rows_of(tagged) == [("a", "comments"), ("a", "submissions"), ("a", "submissions")]


def test_plan_has_one_keyed_shuffle_and_no_full_sort(spark):
    ranked = ranking.trending(_sides(spark, [(1, "a")], [(2, "b")]))
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "TakeOrderedAndProject" in plan and "Sort " not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_conditional_counts_agree_with_the_pivot(spark):
    tagged = ranking.tag_union(_sides(spark, [(1, "a"), (2, "b")], [(4, "b"), (5, None)]))
    assert rows_of(ranking.kind_counts(tagged)) == rows_of(ranking.pivot_counts(tagged))
