import random
import sys

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tallyrill.llm import tokens, toxicity
from tests.llm.test_documents import base_spans, brute_windows, components


def test_the_subpackage_is_registered():
    names = set(queries())
    assert {f"op{n}_" for n in range(1, 14)} == {n.split("_")[0] + "_" for n in names if n.startswith("op")and n[2].isdigit()}
    assert "pipeline" in names and set(oracle_sql()) <= names


def table(spark, folder):
    r = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    rows, labels = [], []
    for i in range(400):
        text = [r.choice(words) for _ in range(r.randint(12, 50))]
        if i % 4 == 0:
            for _ in range(4):
                text.insert(r.randrange(len(text)), f"nasty{r.randrange(8)}")
        if i % 50 == 7:
            text += ["token=abcdef123456"]
        if i % 50 == 9:
            text += [f"bench{j}" for j in range(12)]
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(i % 4 == 0)))
    rows += [(1000 + i, rows[i][1] + " tail") for i in range(0, 400, 9)]
    rows += [(2000, None), (2001, ""), (2002, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, " ".join(f"bench{j}" for j in range(12)))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, items


def test_each_stage_does_its_work_and_keeps_the_columns(spark, tmp_path):
    folder = str(tmp_path)
    docs, items = table(spark, folder)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = sorted(((r["doc_id"], r["text"]) for r in docs.collect()))
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.dtypes == docs.dtypes
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        kept[name] = before, docs
    before, after = kept["toxicity"]
    ids = {r["doc_id"] for r in after.collect()}
    model = toxicity.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    scored = toxicity.score(spark.read.parquet(f"{folder}/documents.parquet"), model, ["doc_id"]).where("predicted = 0")
    assert ids == {r["row"]["doc_id"] for r in scored.collect()}
    assert sum(i % 4 == 0 for i in ids if i < 400) < 5 and sum(i % 4 != 0 for i in ids if i < 400) > 295
    before, after = kept["near_duplicates"]
    want = sorted((d, t) for (d, t), (_, n, c) in zip(before, sorted(components(before), key=lambda x: x[0])) if n == 0 or c == d)
    assert sorted((r["doc_id"], r["text"]) for r in after.collect()) == want and len(want) < len(before)
    before, after = kept["decontamination"]
    want = [(d, t) for d, t in before if not brute_windows(t, items)[1]]
    assert sorted((r["doc_id"], r["text"]) for r in after.collect()) == want and len(want) < len(before)
    before, after = kept["secrets"]
    assert [d for d, _ in before] == sorted(r["doc_id"] for r in after.collect())
    assert not any(base_spans(r["text"]) for r in after.collect()) and any(base_spans(t) for _, t in before)
    for r in after.collect():
        assert r["n_chars"] == len(r["text"] or "")
    before, after = kept["packing"]
    assert {r["doc_id"] for r in after.collect()} == {d for d, _ in before}


def test_run_gives_what_the_stages_give(spark, tmp_path):
    folder = str(tmp_path)
    table(spark, folder)
    got = queries()["pipeline"](spark, folder)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    per = got.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert 250 < len(per) < 320 and all(r["sum(length)"] == r["max(doc_tokens)"] for r in per)


def test_packing_leaves_room_for_what_earlier_stages_hold(spark, docs, monkeypatch):
    given = {}
    monkeypatch.setattr(corpus_pipeline.packing, "pack", lambda docs, path, **settings: given.update(settings))
    corpus_pipeline.pack_sequences(spark, docs([]), "")
    held = tokens._Pieces(lambda piece: bytes(12), given["pieces"])
    most = 0
    for i in range(3 * given["pieces"] - 1):  # both halves are full at the end
        held[f"word{i}"]
    for half in (held, held.old):
        most += sys.getsizeof(half) + sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in half.items())
    assert 2 * most < 100 << 20  # an encoder has two such memories
