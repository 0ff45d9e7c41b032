"""Benchmark windows in texts, by a Wu-Manber search over words.

A word is [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ with A-Z in lower case. The patterns are all runs of
``window`` words of the benchmark items, and the whole of an item with fewer. Patterns of one length
are searched together: a table over hashes of blocks of two words says how far the search may skip,
the patterns whose last block stands at a position are taken from buckets of that block's hash, and
the bytes of the words confirm each occurrence. Long texts are searched in many lanes side by side.

Spark makes the patterns from the items and drops repeated ones. Blocks of about MAX_PATTERNS are written
as tables of numbers to the shared folder, some twenty megabytes each. The rows are passed over once: a task
searches each batch of texts for one block after the other and holds one block's tables, so memory does
not grow with the number of patterns and no text is written.

Nulls: a null text has no words and is clean; items with a null text or id give no patterns, nor do
items without words. Item ids are whole numbers. Repeated items count once. Repeated rows each get their result. An empty
benchmark leaves every text clean; empty documents give no rows.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import _parse_datatype_string

from tallyrill.llm.store import FileStore, tidy, written
from tallyrill.llm.words import PUNCTUATION, chunks, grams, grams_at, hashes, spans

WINDOW = 10
MAX_PATTERNS = 200_000
#: Positions of one lane of the search.
LANE = 256

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_TO_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").translate(_TO_LOWER))


class Patterns:
    """Patterns of one length with their shift table and suffix buckets, all as arrays of numbers."""

    ARRAYS = ("suffix", "whole", "shift", "text", "text_at", "items", "items_at")

    def __init__(self, length: int, arrays: dict[str, np.ndarray]):
        self.length, self.block = length, min(2, length)
        for name in self.ARRAYS:
            setattr(self, name, arrays[name])
        self.mask = np.uint64(len(self.shift) - 1)

    @classmethod
    def of(cls, windows: list[tuple[str, ...]], items: list[list[int]]) -> Patterns:
        length = len(windows[0])
        block = min(2, length)
        texts = [" ".join(w).encode() for w in windows]
        raw = np.frombuffer(b" ".join(texts), np.uint8)
        start, end, _ = spans(raw, np.array([0, len(raw)]), PUNCTUATION)
        words = hashes(raw, start, end)
        first = np.arange(len(windows)) * length
        suffix = grams_at(words, first + length - block, block)
        order = np.argsort(suffix, kind="stable")
        mask = (1 << max(10, (8 * len(words)).bit_length())) - 1
        shift = np.full(mask + 1, min(length - block + 1, 255), np.uint8)
        for back in range(length - block + 1):
            at = (grams_at(words, first + length - block - back, block) & np.uint64(mask)).astype(np.int64)
            np.minimum.at(shift, at, np.uint8(min(back, 255)))

        def ends(values: list) -> np.ndarray:
            return np.cumsum([0, *map(len, values)])

        texts, items = [texts[i] for i in order], [items[i] for i in order]
        return cls(length, {
            "suffix": suffix[order], "whole": grams_at(words, first, length)[order], "shift": shift,
            "text": np.frombuffer(b"".join(texts), np.uint8), "text_at": ends(texts),
            "items": np.array([i for some in items for i in some], np.int64), "items_at": ends(items)})

    def items_of(self, pattern: int) -> list[int]:
        return self.items[self.items_at[pattern] : self.items_at[pattern + 1]].tolist()

    def search(self, raw, words, start, end, first, last) -> Iterator[tuple[int, int]]:
        """(place of the first word, pattern) of each occurrence; words of text t are first[t] to last[t]."""
        low, high = first + self.length - 1, last
        fits = np.flatnonzero(high > low)
        lanes = [np.arange(low[t], high[t], LANE) for t in fits]
        if not lanes:
            return
        until = np.concatenate([np.minimum(x + LANE, high[t]) for x, t in zip(lanes, fits)])
        at = np.concatenate(lanes)
        found = []
        back = self.block - 1
        while len(at):
            block = grams_at(words, at - back, self.block)
            shift = self.shift[(block & self.mask).astype(np.int64)]
            stop = shift == 0
            if stop.any():
                found.append((at[stop], block[stop]))
            at = at + np.maximum(shift, 1)
            more = at < until
            at, until = at[more], until[more]
        if not found:
            return
        at, block = (np.concatenate(x) for x in zip(*found))
        low = np.searchsorted(self.suffix, block, "left")
        count = np.searchsorted(self.suffix, block, "right") - low
        pattern = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at = np.repeat(at, count) - self.length + 1
        same = grams_at(words, at, self.length) == self.whole[pattern]
        at, pattern = at[same], pattern[same]
        known: dict[tuple[int, bytes], bool] = {}
        text = raw.tobytes() if len(at) else b""
        for a, p in zip(at.tolist(), pattern.tolist()):
            key = p, text[start[a] : end[a + self.length - 1]]
            if key not in known:
                found = b" ".join([text[start[i] : end[i]].lower() for i in range(a, a + self.length)])
                known[key] = found == self.text[self.text_at[p] : self.text_at[p + 1]].tobytes()
            if known[key]:
                yield a, p


def tables(windows: dict[tuple[str, ...], list[int]]) -> list[Patterns]:
    """One table for each length of window."""
    by: dict[int, list[tuple[str, ...]]] = {}
    for w in windows:
        by.setdefault(len(w), []).append(w)
    return [Patterns.of(ws, [windows[w] for w in ws]) for _, ws in sorted(by.items())]


def save(made: list[Patterns], store: FileStore) -> str:
    """The name of a new file with the tables."""
    name, out = store.create(".patterns")
    with out:
        arrays = {f"{p.length}:{a}": getattr(p, a) for p in made for a in p.ARRAYS}
        held = io.BytesIO()
        np.savez(held, **arrays)
        out.write(held.getbuffer())
    return name


def load(store: FileStore, name: str) -> list[Patterns]:
    with store.read(name) as file:
        arrays = np.load(io.BytesIO(file.read()))
        lengths = sorted({int(k.split(":")[0]) for k in arrays.files})
        return [Patterns(n, {a: arrays[f"{n}:{a}"] for a in Patterns.ARRAYS}) for n in lengths]


def _windows(window: int) -> object:
    """(words, item) of each window, the words with a space between."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                n = max(1, len(words) - window + 1) if words else 0
                for a in range(0, n, 50_000):
                    some = [" ".join(words[i : i + window]) for i in range(a, min(n, a + 50_000))]
                    yield pa.record_batch(
                        [pa.array(some, pa.string()), pa.array([item] * len(some), pa.int64())], names=["words", "item"])

    return run


def pattern_blocks(benchmark: DataFrame, window: int, item_id: str, text: str) -> Iterator[dict]:
    """Windows to item ids, about MAX_PATTERNS at a time, dealt by a hash; the driver holds one block."""
    items = benchmark.select(benchmark[item_id].cast("long").alias("item"), benchmark[text].alias("text"))
    rows = items.dropna().distinct().mapInArrow(_windows(window), "words string, item long")
    rows = written(rows.groupBy("words").agg(F.collect_set("item").alias("items")), "windows")
    blocks = max(1, -(-rows.count() // MAX_PATTERNS))
    for block in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == block).toArrow()
        yield {tuple(w.split(" ")): i for w, i in zip(part["words"].to_pylist(), part["items"].to_pylist())}


#: The tables that this Python worker used last, by file.
_held: dict[str, list[Patterns]] = {}


def _tables_of(store: FileStore, name: str) -> list[Patterns]:
    if name not in _held:
        _held.clear()
        _held[name] = load(store, name)
    return _held[name]


def search(texts: pa.Array, store: FileStore, blocks: list[str]) -> tuple[list[int], list[list], list[list[int]]]:
    """Number of words, spans of words in any window, and item ids, of each text; one block's tables at a time."""
    n_words = [0] * len(texts)
    found: list[list] = [[] for _ in n_words]
    items: list[set[int]] = [set() for _ in n_words]
    for name in blocks or [""]:
        made = _tables_of(store, name) if name else []
        for base, raw, at in chunks(texts):
            start, end, place = spans(raw, at, PUNCTUATION)
            words = hashes(raw, start, end)
            first, last = place[:-1], place[1:]
            hit = np.zeros(len(words) + 1, np.int64)
            of: set[int] = set()
            for p in made:
                for a, which in p.search(raw, words, start, end, first, last):
                    hit[a] += 1
                    hit[a + p.length] -= 1
                    doc = int(np.searchsorted(place, a, "right")) - 1
                    of.add(doc)
                    items[base + doc].update(p.items_of(which))
            inside = np.cumsum(hit[:-1]) > 0
            n_words[base : base + len(first)] = (last - first).tolist()
            for t in of:
                found[base + t] = _merged(found[base + t] + _true_runs(inside[first[t] : last[t]]))
    return n_words, found, [sorted(i) for i in items]


def _find(store: FileStore, blocks: list[str]) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, found, items = search(batch.column("text"), store, blocks)
            yield pa.record_batch([
                batch.column("row"), pa.array(n_words, pa.int64()),
                pa.array([[{"start": a, "end": b} for a, b in s] for s in found], _SPANS),
                pa.array(items, pa.list_(pa.int64())),
            ], names=["row", "n_words", "spans", "items"])

    return run


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_SPANS_DDL = "array<struct<start:bigint,end:bigint>>"


def _true_runs(x: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], x.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def find_windows(
    docs: DataFrame, benchmark: DataFrame, *, keep: list[str], text: str = "text",
    window: int = WINDOW, item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """For every row: row (a struct of the columns in ``keep``), n_words, n_hit, spans of words, items."""
    store, blocks = _written_blocks(docs.sparkSession, benchmark, window, item_id, item_text)
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), docs[text].alias("text"))
    schema = T.StructType([rows.schema["row"], *_parse_datatype_string(f"n_words long, spans {_SPANS_DDL}, items array<bigint>").fields])
    out = rows.mapInArrow(tidy(_find(store, blocks)), schema)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("row", "n_words", hit.alias("n_hit"), "spans", "items")


def _written_blocks(
    spark: SparkSession, benchmark: DataFrame, window: int, item_id: str, item_text: str
) -> tuple[FileStore, list[str]]:
    store = FileStore.fresh(spark, "patterns")
    return store, [save(tables(w), store) for w in pattern_blocks(benchmark, window, item_id, item_text) if w]


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` without any benchmark window. Only the text goes to Python, only a number comes back."""
    store, blocks = _written_blocks(docs.sparkSession, benchmark, WINDOW, "item_id", "text")

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([len(s) for s in search(pa.array(texts, pa.string(), from_pandas=True), store, blocks)[1]])

    n_spans = F.pandas_udf(tidy(run), "long")
    return docs.where(n_spans(docs[text]) == 0)


def op2_wu_manber_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents."""
    found = find_windows(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
        keep=["doc_id"])
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT DISTINCT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS t
  FROM b WHERE len(w) > 0),
s AS (SELECT doc_id, len(w) AS n, w, unnest(range(1, len(w) + 1)) AS i FROM d),
h AS (SELECT s.doc_id, s.i, p.m, p.item_id FROM s JOIN (SELECT DISTINCT m FROM p) l ON s.i + l.m - 1 <= s.n
  JOIN p ON p.m = l.m AND p.t = array_to_string(s.w[s.i:s.i + l.m - 1], ' ')),
x AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM h) GROUP BY 1),
y AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN x USING (doc_id) LEFT JOIN y USING (doc_id)
"""
