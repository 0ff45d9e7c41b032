import json
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyrill.llm import token_files as TF
from tallyrill.llm import tokens
from tallyrill.llm.packing import pack
from tallyrill.llm.store import READ_BYTES, FileStore, reading_tasks
from tallyrill.llm.tokens import Encoder

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ODD = [
    "", " a", "a  b", "a\n\nb", "x<|endoftext|> b <|startoftext|>c", "it's I'll don't", "ééÉ ß ÀÉ", "é x́ y", "ΑΣ ΣΑΣ b",
    "日本 語 text", "a\tb c", "12 345 a1b2", "... ,, a.,", "Hi. there, you.\nNew line, ok.", "İ x", "ſ K a", "😀 a😀 b",
    "\r\n a", "µ ª º x", "a\x00b c", "a b", "foo.\nBar", " a b", "a\x85 b",
]


@pytest.fixture(scope="module", params=FILES)
def both(request):
    path = public_tokenizers.path(request.param)
    return Encoder(path), Tokenizer.from_file(path)


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_odd_texts_get_the_librarys_ids(both):
    for text in ODD:
        assert np.frombuffer(both[0].encode(text), "<u4").tolist() == ids(both[1], text), repr(text)


@given(st.text(alphabet="abEéßñ.,' \n1日́\xa0Σ", max_size=30))
@settings(max_examples=300, deadline=None)
def test_any_text_gets_the_librarys_ids(both, text):
    assert np.frombuffer(both[0].encode(text), "<u4").tolist() == ids(both[1], text)


def test_memory_of_pieces_is_bounded(monkeypatch):
    from tallyrill.llm import tokens

    monkeypatch.setattr(tokens, "PIECES", 3)
    path = public_tokenizers.path(FILES[0])
    encoder, tokenizer = Encoder(path), Tokenizer.from_file(path)
    for n in range(20):
        text = f"word{'a' * n} b, c\nd"
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids(tokenizer, text)
        assert len(encoder.after_space) <= 3 and len(encoder.after_space.old) <= 3


@pytest.mark.parametrize("bits", [1, 7, 8, 16, 17, 32])
def test_bits_round_trip(bits):
    x = np.random.default_rng(1).integers(0, 1 << bits, 1001, dtype=np.uint64).astype(np.uint32)
    packed = TF.pack_bits(x, bits)
    assert len(packed) == -(-1001 * bits // 8)
    assert (TF.unpack_bits(packed, bits, 1001) == x).all()


def test_files_give_back_documents_in_order(spark, docs, tmp_path, monkeypatch):
    rows = [(5, "One two."), (None, "null id"), (2, None), (2, ""), (9, "x " * 3000), (5, "One two."), (-1, "minus")]
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    store = FileStore(str(tmp_path / "files"))
    files = TF.write_tokens(docs(rows), store, path)
    got = sorted(map(tuple, TF.read_tokens(files, store).collect()), key=lambda r: r[1])
    at = 0
    assert [r[0] for r in got] == [None, -1, 2, 2, 5, 5, 9]
    for doc, start, n, crc in got:
        assert start == at
        at += n
        want = {zlib.crc32(np.array(ids(tokenizer, t) + [1], "<u4").tobytes()) for i, t in rows if i == doc}
        assert crc in want


def test_a_file_gives_any_range(tmp_path, monkeypatch):
    monkeypatch.setattr(TF, "BLOCK", 8)
    x = np.arange(100, dtype="<u4")
    store = FileStore(str(tmp_path))
    name, out = store.create(".tokens")
    writer = TF.TokenFileWriter(out, 7)
    for a, b in ((0, 3), (3, 3), (3, 90), (90, 100)):
        writer.add(a, x[a:b].tobytes())
    writer.close()
    with store.read(name) as file:
        read = TF.TokenFile(file)
        for a, b in ((0, 100), (5, 6), (7, 17), (99, 100), (4, 4)):
            assert read.ids(a, b).tolist() == x[a:b].tolist()
        assert [(d, s, i.tolist()) for d, s, i in read.documents()] == [
            (0, 0, [0, 1, 2]), (3, 3, []), (3, 3, list(range(3, 90))), (90, 90, list(range(90, 100)))]


def test_no_documents_make_no_files(spark, docs, tmp_path):
    store = FileStore(str(tmp_path / "none"))
    files = TF.write_tokens(docs([]), store, public_tokenizers.path("word_bpe_49k.json"))
    assert files.count() == 0 and TF.read_tokens(files, store).count() == 0


def check_pieces(rows, pieces, window, tokenizer, end_id):
    """Every id of every row is in one piece, and every sequence is gapless."""
    want = sorted((d is not None, d or 0, tuple(ids(tokenizer, t) + [end_id])) for d, t in rows)
    by_sequence = {}
    for p in pieces:
        raw = np.frombuffer(p["ids"], "<u4")
        assert len(raw) == p["length"] and zlib.crc32(p["ids"]) == p["ids_crc32"]
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert 0 < at <= window
    lengths = sorted((p["doc_id"] is not None, p["doc_id"] or 0, p["start"], tuple(np.frombuffer(p["ids"], "<u4"))) for p in pieces)
    assert sum(len(x[3]) for x in lengths) == sum(len(x[2]) for x in want)
    assert sorted(i for x in lengths for i in x[3]) == sorted(i for x in want for i in x[2])
    return by_sequence


@pytest.mark.parametrize("n, open_windows", [(0, 4), (1, 1), (40, 1), (300, 4), (300, 64)])
def test_packing_places_every_id_once(spark, docs, n, open_windows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = np.random.default_rng(n)
    rows = [(i, " ".join(["word"] * int(rng.integers(0, 90)))) for i in range(n)]
    rows += [(None, "null id"), (7, None), (7, ""), (7, "again"), (7, "again"), (8, "long " * 500)] if n else []
    got = pack(docs(rows).repartition(3), path, window=64, open_windows=open_windows, with_ids=True).collect()
    sequences = check_pieces(rows, [r.asDict() for r in got], 64, Tokenizer.from_file(path), 0)
    ids_all = sum(p["length"] for p in got)
    if n >= 300 and open_windows >= 4:
        assert len(sequences) * 64 <= 1.05 * ids_all + 64
    unique = {}
    for p in got:
        if p["doc_id"] is not None and p["doc_id"] < 7:
            unique.setdefault(p["doc_id"], []).append((p["start"], p["length"], p["doc_tokens"]))
    for parts in unique.values():
        at = 0
        for start, length, total in sorted(parts):
            assert start == at
            at += length
        assert at == total


@pytest.mark.parametrize("name, change", [
    (FILES[1], lambda s: s["normalizer"]["normalizers"][1].update(content="_")),
    (FILES[1], lambda s: s["pre_tokenizer"]["pretokenizers"][0].update(pattern={"Regex": r"\S"})),
    (FILES[0], lambda s: s.update(truncation={"direction": "Right", "max_length": 3, "strategy": "LongestFirst", "stride": 0})),
])
def test_files_that_only_look_alike_go_to_the_library(tmp_path, name, change):
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        spec = json.load(f)
    change(spec)
    path = str(tmp_path / "t.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(spec, f)
    encoder, tokenizer = Encoder(path), Tokenizer.from_file(path)
    for text in ODD + ["some plain words. And more of them\nhere"]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids(tokenizer, text), repr(text)


def test_an_encoder_is_at_hand_while_the_timer_empties_the_memory():
    path = public_tokenizers.path(FILES[0])
    with tokens.encoder(path):
        pass
    with tokens.encoder(path) as own:
        tokens._forget()
        assert own.encode("a b") == Encoder(path).encode("a b")


def test_pieces_are_where_they_say(spark, docs):
    """Each piece against the ids that the library gives its whole document."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = [None, "", "one", "x" * 9000, "é 日本 " * 700, *[f"word{i} " * (i * 37 % 400) + "end" for i in range(60)]]
    pieces = pack(docs(list(enumerate(texts))).repartition(4), path, window=256, open_windows=3, with_ids=True).collect()
    sequences = {}
    for p in pieces:
        whole = ids(tokenizer, texts[p["doc_id"]]) + [0]
        part = whole[p["start"] : p["start"] + p["length"]]
        assert np.frombuffer(p["ids"], "<u4").tolist() == part and len(part) == p["length"] > 0
        assert p["ids_crc32"] == zlib.crc32(p["ids"]) and p["doc_tokens"] == len(whole)
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for doc, text in enumerate(texts):
        mine = sorted((p["start"], p["length"]) for p in pieces if p["doc_id"] == doc)
        assert [a for a, _ in mine] == [sum(n for _, n in mine[:i]) for i in range(len(mine))]
        assert sum(n for _, n in mine) == len(ids(tokenizer, text)) + 1
    for parts in sequences.values():
        assert [a for a, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 256


def test_files_are_read_back_in_tasks_by_their_size(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    assert reading_tasks(spark, 0, 0) == 1 and reading_tasks(spark, 1, 1 << 40) == 1
    assert reading_tasks(spark, 1 << 20, 0) == cores and reading_tasks(spark, 1 << 20, 1 << 40) == (1 << 40) // READ_BYTES
    files = spark.createDataFrame([(i, f"f{i}", 1, 1) for i in range(50)], "part long, file string, n_docs long, n_ids long")
    plan = TF.read_tokens(files, FileStore(str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert f", {cores}), REPARTITION_BY_NUM" in plan
