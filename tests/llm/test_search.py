import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrill.llm import impact_search


def brute(rows, every, k):
    whole = {}
    ok = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ok.append((i, [math.floor(256 * x) for x in v]))
    for i, v in ok:
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in ok if j != i)[:k]
            whole[i] = [(j, -s) for s, j in best]
    return whole


@pytest.mark.parametrize("block, levels, queries, few", [(4096, 16, 16_384, 64), (7, 2, 3, 1), (16, 1, 16_384, 1)])
def test_matches_brute_force(spark, monkeypatch, block, levels, queries, few):
    for name, value in (("BLOCK", block), ("LEVELS", levels), ("QUERIES", queries), ("FEW", few), ("BATCH", 4)):
        monkeypatch.setattr(impact_search, name, value)
    r = random.Random(block)
    rows = [(i, [float(np.float32(r.gauss(0, 1))) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, [r.choice([-1.0, 0.0, 0.5])] * 6) for i in range(30)]  # ties
    rows += [(300, None), (310, [1.0, None]), (320, [float("nan")] * 6), (330, [float("inf")] * 6), (None, [1.0] * 6),
             (340, []), (350, [1.0, 2.0]), (360, [3.0] * 9), (370, [1000.0] * 6), (371, [-1000.0] * 6), (201, [0.5] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).withColumn("rank", F.lit("x"))
    got = {}
    for x in impact_search.search(df.repartition(3), F.col("vec_id") % 10 == 0, k=5).orderBy("query_id", "rank").collect():
        got.setdefault(x["query_id"], []).append((x["vec_id"], x["score"]))
        assert x["rank"] == len(got[x["query_id"]])
    assert got == brute(rows, 10, 5)


@pytest.mark.parametrize("times", [2, 9])
def test_repeated_query_ids(spark, monkeypatch, times):
    monkeypatch.setattr(impact_search, "FEW", 1)
    r = random.Random(times)
    rows = [(i, [float(np.float32(r.gauss(0, 1))) for _ in range(6)]) for i in range(1, 200)]
    rows = [x for x in rows if x[0] % 50]
    lower, upper = [3.0, -2.0, 1.0, 2.0, 1.5, 2.5], [3.5, -2.0, 1.0, 2.0, 1.5, 2.5]
    rows += [(100, upper), *[(100, lower)] * (times - 1)]
    want = sorted((-sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(lower, v)), i) for i, v in rows if i != 100)[:5]
    for turn in (rows, rows[::-1]):
        df = spark.createDataFrame(turn, "vec_id long, embedding array<float>").coalesce(1)
        got = impact_search.search(df, F.col("vec_id") % 50 == 0, k=5).orderBy("rank").collect()
        assert [(-x["score"], x["vec_id"]) for x in got] == want and {x["query_id"] for x in got} == {100}


def test_few_or_no_candidates(spark):
    def of(rows):
        return spark.createDataFrame(rows, "vec_id long, embedding array<float>")

    alone = impact_search.search(of([(0, [1.0])]), F.col("vec_id") % 10 == 0)
    assert alone.count() == 0
    two = impact_search.search(of([(0, [1.0]), (1, [2.0])]), F.col("vec_id") % 10 == 0).collect()
    assert [tuple(r) for r in two] == [(0, 1, 1, 256 * 512)]
    assert impact_search.search(of([]), F.col("vec_id") % 10 == 0).count() == 0
    assert impact_search.search(of([(1, [1.0])]), F.col("vec_id") % 10 == 0).count() == 0
    assert impact_search.search(of([(0, None), (10, [])]), F.col("vec_id") % 10 == 0).count() == 0


def test_rows_left_out_of_rescoring_are_proven(monkeypatch):
    r = np.random.default_rng(4)
    vectors = r.integers(-300, 300, (500, 12))
    queries = r.integers(-300, 300, (40, 12))
    monkeypatch.setattr(impact_search, "FEW", 20)
    index = impact_search.ImpactIndex(vectors)
    left = 0
    for q, rows in index.possible(queries, 5, np.full(40, -np.inf)):
        exact = vectors @ queries[q]
        assert set(np.argsort(-exact, kind="stable")[:5]) <= set(rows.tolist())
        left += len(vectors) - len(rows)
    assert left > 40 * 300


def test_any_number_of_query_files_takes_one_pass(spark, monkeypatch):
    r = random.Random(3)
    rows = [(i, [float(np.float32(r.gauss(0, 1))) for _ in range(5)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(2)
    for queries, held in ((2, 10), (7, 1000)):
        monkeypatch.setattr(impact_search, "QUERIES", queries)
        monkeypatch.setattr(impact_search, "HELD", held)
        monkeypatch.setattr(impact_search, "BLOCK", 8)
        found = impact_search.search(df, F.col("vec_id") % 5 == 0, k=3)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("MapInArrow") == 1 and "Union" not in plan
        got = {}
        for x in found.orderBy("query_id", "rank").collect():
            got.setdefault(x["query_id"], []).append((x["vec_id"], x["score"]))
        assert got == brute(rows, 5, 3)
