import hashlib
import random

import duckdb
import numpy as np
import pytest

from tallyrill.llm import repeats as R


def covered(texts, length):
    """Per text which bytes a string of ``length`` covers that starts at two places or more."""
    places = {}
    for i, t in enumerate(texts):
        for p in range(len(t) - length + 1):
            places.setdefault(t[p : p + length], []).append((i, p))
    out = [bytearray(len(t)) for t in texts]
    for found in places.values():
        for i, p in found if len(found) > 1 else ():
            out[i][p : p + length] = b"\1" * length
    return out


def expected(texts, length):
    texts = [(t or "").encode() for t in texts]
    rows = []
    for data, cover in zip(texts, covered(texts, length)):
        runs = sum(1 for k, c in enumerate(cover) if c and (k == 0 or not cover[k - 1]))
        rows.append((len(data), sum(cover), runs, bytes(b for b, c in zip(data, cover) if not c)))
    return rows


def check(docs, texts, length=24, gram=8, **settings):
    out = R.without_repeats(docs(list(enumerate(texts))), length=length, gram=gram, **settings)
    rows = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in out.collect()}
    assert [rows[i] for i in range(len(texts))] == expected(texts, length)


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(5)
    words = ["alpha", "bêta", "gamma ", "x", "qq\n", "日本"]
    out = [" ".join(pick.choice(words) for _ in range(pick.randint(0, 70))) for _ in range(50)]
    return [*out, out[0], out[1][:90] + "!" + out[1][90:], None, "", "a" * 300, "ab" * 200, "a" * 300, out[3] + out[4]]


@pytest.mark.parametrize("hot", [10_000, 4])
def test_repeated_bytes_like_brute_force(docs, texts, hot):
    check(docs, texts, hot=hot)


def test_texts_longer_than_a_slice(docs, texts, monkeypatch):
    long = "".join(t or "" for t in texts)
    monkeypatch.setattr(R, "SLICE", 500)
    raw = np.frombuffer(long.encode(), np.uint8)
    windows = []
    for part, at, _, base in R._slices(R.pa.array([long, None, "short"]), 24):
        s = R._Segments(part, at, 24, 8)
        windows += [int(b) for a, e in zip(s.start, s.end) for b in range(a + base[0], e + base[0] + 1) if len(at) == 2]
    assert sorted(windows) == list(range(len(raw) - 23))


def test_a_passage_in_a_third_of_all_texts(docs, monkeypatch):
    pick = random.Random(2)

    def noise(n):
        return "".join(pick.choice("abcdefgh ") for _ in range(n))

    passage = noise(70)
    texts = [noise(60) + (passage if i % 3 == 0 else "") + noise(40) for i in range(90)]
    check(docs, texts, hot=10)
    check(docs, texts)
    monkeypatch.setattr(R, "SPREAD", 4)
    check(docs, texts)


def test_columns_like_brute_force():
    pick = random.Random(1)
    for _ in range(200):
        base = [bytes(pick.choice(b"ab") for _ in range(30)) for _ in range(3)]
        rows = set()
        for _ in range(pick.randint(2, 12)):
            a = pick.randint(0, 10)
            s = bytearray(pick.choice(base)[a : pick.randint(a + 6, 28)])
            if pick.random() < 0.6:
                s[pick.randrange(len(s))] = 99
            rows.add((bytes(s), 12 - a))
        rows = sorted(rows)
        got = R.repeated_columns([s for s, _ in rows], np.array([k for _, k in rows]), 6)
        for i, (s, k) in enumerate(rows):
            for p in range(len(s) - 5):
                other = [(t, p - k + m) for j, (t, m) in enumerate(rows) if j != i]
                assert got[i][p] == any(0 <= q <= len(t) - 6 and t[q : q + 6] == s[p : p + 6] for t, q in other)


def test_lengths_of_the_contract(docs):
    pick = random.Random(3)
    passage = "".join(pick.choice("abcdefghij ") for _ in range(400))
    texts = ["x" + passage + "y", "z" + passage, passage[:399], passage[1:] + "!", "é" * 250]
    check(docs, texts, length=R.LENGTH, gram=R.GRAM)


def test_no_rows_and_null_or_repeated_ids(docs):
    assert R.without_repeats(docs([])).count() == 0
    rows = R.without_repeats(docs([(None, "b" * 30), (7, "b" * 30), (7, "c")]), length=24, gram=8).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in rows) == [(0, 30), (7, 0), (7, 30)]


def test_the_query_gives_digests_of_what_stays(spark, tmp_path):
    text = "".join(random.Random(4).choices("abcdef", k=450))
    spark.createDataFrame([(1, text), (2, text[:420] + "?"), (3, None)], "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in R.op12_column_wise_repeats(spark, str(tmp_path)).collect()}
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        assert sorted(db.sql(R.ORACLE).fetchall()) == sorted(tuple(r) for r in rows.values())
    assert rows[1]["kept_sha256"] == hashlib.sha256(text[420:].encode()).hexdigest()
    assert (rows[2]["n_removed"], rows[2]["n_spans"], rows[3]["n_bytes"]) == (420, 1, 0)
    assert rows[3]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
