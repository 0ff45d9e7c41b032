import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from tallyrill.llm import alignment as A
from tallyrill.llm.store import FileStore

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "The cat sat on the mat.", "The cat sat on the mat.", "the mat, the mat\nand antidisestablishmentarianism", None, "", " lead", "tail ",
    "two  spaces", "<|endoftext|> and </s> <s>", "▁ odd", "a▁b", "日本語のテキスト", "😀 a😀b", "éa été ½ ﬁ", "a\tb\r\nc", "\n\nx",
    "x" * 700, "1234567 89", "The  cat", "á b", "nul\x00 y", "Ünïcödé straße, naïve cafés.\nThe cat sat", "a", "don't we'll I'm", "​ z",
    "ж" * 40 + " мир", "a.b,c;d:e!f?g", "http://x.y/z?q=1&r=2", "The cat sat on the dog.",
]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def letters():
    """Byte of each letter of byte-level BPE, found by the library's own pre-tokenizer."""
    own = {}
    for b in range(128):
        (shown, _), *_ = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(b))
        own[shown] = b
    for c in map(chr, range(128, 0x20000)):
        if 0xD800 <= ord(c) < 0xE000:
            continue
        (shown, _), *_ = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(c)
        own.update(zip(shown, c.encode()))
    return own


LETTERS = letters()


def groups(text, tokenizers):
    """Groups of (A ids, B ids); none if either side's bytes are not those of the text behind a space."""
    if not text:
        return []
    a, b = tokenizers
    e = a.encode(" " + text, add_special_tokens=False)
    left = [(i, bytes(LETTERS[c] for c in a.id_to_token(i))) for i in e.ids]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    if not b"".join(x for _, x in left) == b"".join(x for _, x in right) == (" " + text).encode():
        return []
    out, p, q = [([], [])], 0, 0
    while left or right:
        if p <= q:
            i, x = left.pop(0)
            out[-1][0].append(i)
            p += len(x)
        else:
            i, x = right.pop(0)
            out[-1][1].append(i)
            q += len(x)
        if p == q:
            out.append(([], []))
    return out[:-1]


def brute(texts, tokenizers):
    all_groups = [groups(t, tokenizers) for t in texts]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in all_groups]
    count = Counter(pair for own in links for pair in own)
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    rows = []
    for g, own in zip(all_groups, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        rows.append((
            sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(own.values()),
            sum(n for p, n in own.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in own.items()),
            hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return rows, count, best


def result(spark, docs, rows, n_parts=3):
    store = FileStore.fresh(spark, "alignment")
    runs, merged = A.aligned(docs(rows).repartition(n_parts), store, A_PATH, B_PATH)
    out = [tuple(r) for r in A.contributions(runs, merged, store).collect()]
    return out, merged, store


def test_like_brute_force(spark, docs, tokenizers):
    out, merged, store = result(spark, docs, list(enumerate(TEXTS)))
    rows, count, best = brute(TEXTS, tokenizers)
    assert sorted(out) == [(i, *row) for i, row in enumerate(rows)]
    pairs = {(r["a"], r["b"]): (r["documents"], r["best"]) for r in A.pair_counts(merged, store).collect()}
    assert pairs == {p: (n, best[p[0]] == n) for p, n in count.items()}


def test_many_runs_and_several_merges(spark, docs, tokenizers, monkeypatch):
    texts = [" ".join(TEXTS[0].split()[: i % 5 + 1]) + f" {i % 7}" for i in range(60)]
    store = FileStore.fresh(spark, "alignment")
    units, held, frames = A.Units(A_PATH, B_PATH), A._Run(), []
    for i, text in enumerate(texts):
        held.add([i], units.find([units.cut(text)]), units)
        if i % 4 == 3:
            frames.append(held.write(store, units))
            held = A._Run()
    runs = spark.createDataFrame(A.pa.Table.from_batches(frames)).select("radix", "file", "at", "sizes")
    monkeypatch.setattr(A, "FAN_IN", 4)
    merged = A.merge_runs(runs, store)
    assert merged.groupBy("radix").count().where("count > 1").count() == 0
    out = A.contributions(runs, merged, store).collect()
    assert sorted(map(tuple, out)) == [(i, *row) for i, row in enumerate(brute(texts, tokenizers)[0])]


def test_forgotten_words_change_nothing(tokenizers, monkeypatch):
    units = A.Units(A_PATH, B_PATH)
    first = [units.strings[i] for i in units.find([units.cut(TEXTS[21])])[0].tolist()]
    units.clear()
    units.find([units.cut(TEXTS[2])])
    assert [units.strings[i] for i in units.find([units.cut(TEXTS[21])])[0].tolist()] == first


def test_null_and_repeated_ids_and_no_rows(spark, docs, tokenizers):
    rows = [(None, TEXTS[0]), (3, TEXTS[0]), (3, TEXTS[2])]
    out, _, _ = result(spark, docs, rows)
    want = brute([t for _, t in rows], tokenizers)[0]
    assert sorted(out, key=repr) == sorted(((i, *w) for (i, _), w in zip(rows, want)), key=repr)
    assert result(spark, docs, [])[0] == []


def test_a_very_long_text(spark, docs, tokenizers):
    text = " ".join(f"word{i % 977} {'ab' * (i % 5)}z" for i in range(20_000)) + " " + "é" * 3000
    out, _, _ = result(spark, docs, [(1, text), (2, text[:5000])], 2)
    assert sorted(out) == [(i, *row) for i, row in enumerate(brute([text, text[:5000]], tokenizers)[0], 1)]
