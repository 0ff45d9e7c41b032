"""Byte strings of a given length that occur twice or more anywhere in a corpus, by column-wise construction.

Each text is cut into segments: runs of LENGTH-byte windows that have one anchor, the first of the GRAM-byte strings in
the window with the smallest hash. Equal windows have equal anchors at one distance, so it is enough to compare
segments of one anchor, laid over one another at it. An anchor that only one place of the corpus
has is never looked at again; where an anchor's segments are all one string, they repeat as a whole. What is left goes to
tasks by anchor, each distinct segment once.

There the segments are the documents of a column-wise construction: column by column from the right, one
symbol of every segment is put before its suffix, and a stable sort by that symbol turns the order of all
suffixes that begin one column further right into the order of those that begin here. The symbols in that order are the column's
Burrows-Wheeler transform; the common prefix of two neighbours grows by one where their symbols agree, from
the least of the common prefixes between them. Where it reaches LENGTH, both windows that begin here repeat. Since segments
are aligned, suffixes are compared with those of their own column only, so the transform is positional: a round costs
time in proportion to the segments, not to all that was inserted before. Rounds are as many as a segment is long (below 2 * LENGTH),
whatever the length of the documents. Columns lie one after the other in a matrix that is filled from the
sorted shuffle, a bounded batch of whole anchors at a time. Anchors with more than HOT places are split: their
windows are told apart by 128-bit hashes, which are counted by a pre-aggregated shuffle.

Anchors are known by 43 bits of a hash, which costs time only where two share them, as bytes are compared. Segments are told
apart by 128 bits, those of an anchor that has one segment only by 64. Nulls: a null text is empty; a null id stays null. Texts shorter than LENGTH have no windows. Very long texts are
cut into overlapping slices, so memory does not grow with them. Repeated rows and exact copies repeat as a whole. An empty table gives no rows.
Ties do not arise. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrill.llm.gram_join import _bitmap
from tallyrill.llm.store import tidy, written
from tallyrill.llm.words import mix, utf8

LENGTH = 400
GRAM = 96
#: Places of one anchor beyond which its windows are counted one by one.
HOT = 10_000
#: Places of one anchor that meet its segments' verdicts in one part of a join.
SPREAD = 2_000
#: Bytes of texts cut at once; longer texts are cut in slices of so many.
SLICE = 1 << 19
#: Bytes of segments laid out at once.
BATCH_BYTES = 8 << 20

_PLACE = 20
_RNG = np.random.default_rng(20250211)
_VALUES = _RNG.integers(1, 1 << 63, (2, 256), dtype=np.uint64) | np.uint64(1)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Sums:
    """Hashes of any parts of some bytes, from running sums of a polynomial modulo 2**64."""

    def __init__(self, raw: np.ndarray, which: int):
        power, self.inverse = _tables(which)
        self.total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_VALUES[which][raw] * power[: len(raw)], out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.inverse[start])


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(which: int) -> tuple[np.ndarray, np.ndarray]:
    if which not in _TABLES:
        n = 2 * SLICE + 1
        _TABLES[which] = _powers(n, _BASES[which]), _powers(n, pow(_BASES[which], -1, 1 << 64))
    return _TABLES[which]


def _slices(texts: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of texts of about SLICE bytes: bytes, where each text begins and the last ends, their places, and the
    position in its text at which each begins. A longer text comes in slices that overlap by length - 1."""
    raw, at = utf8(texts)
    first = 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + SLICE, "right")) - 1)
        if at[last] - at[first] <= SLICE:
            n = last - first
            yield raw[at[first] : at[last]], at[first : last + 1] - at[first], np.arange(first, last), np.zeros(n, np.int64)
        else:
            size = int(at[first + 1] - at[first])
            for begin in range(0, size - length + 1, SLICE - length + 1):
                part = raw[at[first] + begin : at[first] + min(size, begin + SLICE)]
                yield part, np.array([0, len(part)]), np.array([first]), np.array([begin])
        first = last


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` values."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.int64).max, np.int64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


class _Segments:
    """The segments of one run of texts: anchor, two hashes, first and last window, bytes before the anchor."""

    def __init__(self, raw: np.ndarray, at: np.ndarray, length: int, gram: int):
        self.raw, self.length = raw, length
        fits = np.zeros(len(raw) + 1, np.int64)  # windows that begin here end in the same text
        low, high = at[:-1], np.maximum(at[:-1], at[1:] - length + 1)
        np.add.at(fits, low, 1)
        np.add.at(fits, high, -1)
        fits = np.cumsum(fits[:-1]) > 0
        empty = np.zeros(0, np.int64)
        self.start = self.end = self.anchor = self.lead = empty
        self.h1 = self.h2 = empty
        if len(raw) < length or not fits.any():
            return
        one, two = _Sums(raw, 0), _Sums(raw, 1)
        places = np.arange(len(raw) - gram + 1)
        hashed = one.of(places, places + gram) >> np.uint64(_PLACE)
        marks = (hashed << np.uint64(_PLACE) | places.astype(np.uint64)).view(np.int64) & np.int64(2**63 - 1)
        least = _least(marks, length - gram + 1)
        windows = np.flatnonzero(fits[: len(least)])
        least = least[windows]
        # The place is part of the value, so a new place, text or gap begins a new segment.
        cut = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (windows[1:] != windows[:-1] + 1)]))
        self.start = windows[cut]
        self.end = windows[np.append(cut[1:], len(windows)) - 1]
        self.anchor = least[cut] >> _PLACE
        self.lead = (least[cut] & (1 << _PLACE) - 1) - self.start
        lead = mix(self.lead.astype(np.uint64))
        self.h1 = (one.of(self.start, self.end + length) ^ lead).view(np.int64)
        self.h2 = (two.of(self.start, self.end + length) + lead).view(np.int64)

    def bytes_of(self, chosen: np.ndarray) -> list[bytes]:
        data = self.raw.tobytes()
        return [data[a : b + self.length] for a, b in zip(self.start[chosen].tolist(), self.end[chosen].tolist())]


_PLACES_DDL = "k1 long, k2 long, anchor long, h1 long, h2 long, start long, windows int"


def _cut_task(length: int, gram: int):
    """Every segment of every text, with the hashes that name text and segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (batch.column(i).to_numpy() for i in (0, 1))
            for raw, at, texts, base in _slices(batch.column(2), length):
                s = _Segments(raw, at, length, gram)
                if len(s.start):
                    own = np.searchsorted(at, s.start, "right") - 1
                    start = s.start - at[own] + base[own]
                    columns = [k1[texts[own]], k2[texts[own]], s.anchor, s.h1, s.h2, start, (s.end - s.start + 1).astype(np.int32)]
                    yield pa.record_batch([pa.array(c) for c in columns],
                                          names=["k1", "k2", "anchor", "h1", "h2", "start", "windows"])

    return run


def _passes(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys & (len(words) * 32 - 1)
    return (words[place >> 5] >> (place & 31).astype(np.uint32)) & 1 > 0


_SEGMENT = pa.schema([("anchor", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("lead", pa.int32()),
                      ("bytes", pa.binary()), ("hot", pa.bool_())])
_SEGMENT_DDL = "anchor long, h1 long, h2 long, lead int, bytes binary, hot boolean"


def _fetch_task(length: int, gram: int, mixed, hot, seen_most: int = 1 << 18):
    """The bytes of segments whose anchor passes the filter, once a task (again after ``seen_most`` others).

    An anchor that passes the other filter too counts as hot, in every task alike.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for raw, at, _, _ in _slices(batch.column(0), length):
                s = _Segments(raw, at, length, gram)
                if not len(s.start):
                    continue
                passed = np.flatnonzero(_passes(mixed.value, s.anchor))
                chosen = []
                for i, key in zip(passed.tolist(), zip(s.h1[passed].tolist(), s.h2[passed].tolist())):
                    if key not in seen:
                        seen.add(key)
                        chosen.append(i)
                if len(seen) > seen_most:
                    seen.clear()
                for a in range(0, len(chosen), 10_000):
                    c = np.array(chosen[a : a + 10_000], np.int64)
                    columns = [s.anchor[c], s.h1[c], s.h2[c], s.lead[c].astype(np.int32), s.bytes_of(c), _passes(hot.value, s.anchor[c])]
                    yield pa.record_batch([pa.array(x, f.type) for x, f in zip(columns, _SEGMENT)], schema=_SEGMENT)

    return run


def repeated_columns(segments: list[bytes], leads: np.ndarray, length: int) -> list[np.ndarray]:
    """For each segment, whether the window that begins at each of its bytes occurs in another one, laid at its anchor.

    Column by column from the right: ``order`` holds the segments by the suffix that begins in the last column,
    ``common`` the prefix that each shares with the one before. Equal strings must not be given twice.
    """
    n = len(segments)
    sizes = np.array([len(s) for s in segments], np.int64)
    shift = int(leads.max()) - leads  # columns before a segment's first byte
    width = int((shift + sizes).max())
    rows = np.zeros((n, width), np.uint8)
    for row, s, data in zip(rows, shift.tolist(), segments):
        row[s : s + len(data)] = np.frombuffer(data, np.uint8)
    columns = np.ascontiguousarray(rows.T)  # one column after the other
    del rows
    begins = np.zeros(width + 1, bool)
    begins[shift] = True
    found = np.zeros((width, n), bool)
    ends = shift + sizes
    by_end = np.argsort(-ends, kind="stable")
    entered = 0
    order, common = np.zeros(0, np.int64), np.zeros(0, np.int32)
    for x in range(width - 1, -1, -1):
        more = entered
        while more < n and ends[by_end[more]] == x + 1:
            more += 1
        if more > entered:  # empty suffixes come first and share nothing
            order = np.concatenate([by_end[entered:more], order])
            common = np.concatenate([np.zeros(more - entered, np.int32), common])
            if more - entered < len(common):
                common[more - entered] = 0
            entered = more
        if begins[x + 1]:  # segments that begin further right are done
            stay = np.flatnonzero(shift[order] <= x)
            if len(stay):
                # Who stays shares with the one before it the least of all between them.
                common = np.minimum.reduceat(common[: stay[-1] + 1], np.append(0, stay[:-1] + 1))
            order, common = order[stay], common[: len(stay)]
        if not len(order):
            continue
        symbols = columns[x, order]
        sort = np.argsort(symbols, kind="stable")
        ranked = symbols[sort]
        same = np.flatnonzero(ranked[1:] == ranked[:-1]) + 1
        fresh = np.zeros(len(order), np.int32)
        if len(same):
            # From behind the suffix before, to this one, in the order of the column further right.
            bounds = np.empty(2 * len(same), np.int64)
            bounds[0::2], bounds[1::2] = sort[same - 1] + 1, sort[same] + 1
            padded = np.append(common, np.int32(0))
            fresh[same] = np.minimum.reduceat(padded, bounds)[0::2] + 1
        order, common = order[sort], np.minimum(fresh, length)
        hits = np.flatnonzero(common >= length)
        if len(hits):
            found[x, order[hits]] = True
            found[x, order[hits - 1]] = True
    return [found[s : s + k - length + 1, i] for i, (s, k) in enumerate(zip(shift.tolist(), sizes.tolist()))]


_VERDICT = pa.schema([("anchor", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()),
                      ("from", pa.list_(pa.int32())), ("to", pa.list_(pa.int32()))])
_VERDICT_DDL = "anchor long, h1 long, h2 long, `from` array<int>, `to` array<int>"


def _runs(flags: np.ndarray) -> tuple[list[int], list[int]]:
    edges = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    return np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()


def _compare_task(length: int):
    """Repeated windows of the segments of each anchor; rows come sorted by anchor and hashes."""

    def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if len(rows) < 2:
            return
        flags = repeated_columns([r[4] for r in rows], np.array([r[3] for r in rows], np.int64), length)
        out = [(r[0], r[1], r[2], *_runs(f)) for r, f in zip(rows, flags) if f.any()]
        if out:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), _VERDICT)], schema=_VERDICT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group, size, before = [], [], 0, None
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if row[:3] == before:
                    continue
                if before is not None and row[0] != before[0]:
                    if len(group) > 1:  # a lone segment has nothing to repeat
                        held += group
                    group = []
                    if size >= BATCH_BYTES:
                        yield from solve(held)
                        held, size = [], 0
                before = row[:3]
                group.append(row)
                size += 2 * length
        yield from solve(held + (group if len(group) > 1 else []))

    return run


_WINDOW_DDL = "w1 long, w2 long, anchor long, h1 long, h2 long, at int"


def _window_task(length: int):
    """Two hashes of every window of each segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, h1, h2, data in zip(*[batch.column(i).to_pylist() for i in (0, 1, 2, 4)]):
                raw = np.frombuffer(data, np.uint8)
                at = np.arange(len(raw) - length + 1)
                columns = [_Sums(raw, i).of(at, at + length).view(np.int64) for i in (0, 1)]
                columns += [np.full(len(at), x, np.int64) for x in (anchor, h1, h2)] + [at.astype(np.int32)]
                yield pa.record_batch([pa.array(c) for c in columns], names=["w1", "w2", "anchor", "h1", "h2", "at"])

    return run


def _hot_verdicts(segments: DataFrame, length: int) -> DataFrame:
    """The same verdicts for anchors with many places: windows that two segments have, by their hashes."""
    windows = segments.mapInArrow(_window_task(length), _WINDOW_DDL)
    spread = [f(c).alias(f"{c}_{f.__name__}") for c in ("h1", "h2") for f in (F.min, F.max)]
    twice = windows.groupBy("w1", "w2").agg(*spread).where("h1_min <> h1_max or h2_min <> h2_max").select("w1", "w2")
    own = windows.join(twice, ["w1", "w2"], "left_semi").groupBy("anchor", "h1", "h2").agg(F.collect_set("at").alias("at"))
    return own.select("anchor", "h1", "h2", F.col("at").alias("from"), F.transform("at", lambda i: i + 1).alias("to"))


def _named(docs: DataFrame, text: str) -> DataFrame:
    """Texts with two hashes that name them."""
    value = F.coalesce(docs[text], F.lit(""))
    return docs.select(F.xxhash64(value).alias("k1"), F.xxhash64(F.lit(7), value).alias("k2"), value.alias("text"))


def repeated_spans(docs: DataFrame, *, text: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """k1, k2 (hashes that name a text) and spans: which bytes of it a string that also starts elsewhere covers.

    Spans are pairs of first byte and end, as found, in no order; they may overlap. Texts without any are left out.
    """
    named = _named(docs, text)
    places = written(named.mapInArrow(tidy(_cut_task(length, gram)), _PLACES_DDL), "places")
    anchors = places.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("h1").alias("low"), F.max("h1").alias("high"))
    anchors = anchors.where("n > 1").select("anchor", F.expr("low <> high").alias("mixed"), (F.col("n") > hot).alias("hot"),
        F.ceil(F.col("n") / SPREAD).cast("int").alias("parts"))
    anchors = written(anchors, "anchors")
    shared = written(places.join(anchors, "anchor"), "shared")

    # Only anchors with different segments need their bytes; the few others that pass the filter are found alike or alone.
    key = F.col("anchor").alias("key")
    mixed, often = anchors.where("mixed").select(key), anchors.where("mixed and hot").select(key)
    task = tidy(_fetch_task(length, gram, _bitmap(mixed), _bitmap(often)))
    fetched = named.select("text").mapInArrow(task, _SEGMENT_DDL)
    some_hot = not often.isEmpty()
    fetched = written(fetched, "segments") if some_hot else fetched
    dealt = fetched.where("not hot").drop("hot").repartition("anchor").sortWithinPartitions("anchor", "h1", "h2")
    verdicts = dealt.mapInArrow(_compare_task(length), _VERDICT_DDL)
    if some_hot:
        verdicts = verdicts.unionByName(_hot_verdicts(fetched.where("hot"), length))
    verdicts = written(verdicts, "verdicts")

    # A segment that two places have repeats as a whole. Segments that many places have come once for each part of them.
    keys = ["anchor", "h1", "h2"]
    known = shared.where("mixed").groupBy(*keys).agg(F.count("*").alias("n"), F.max("parts").alias("parts"))
    known = known.join(verdicts, keys, "left").where("n > 1 or `from` is not null")
    known = known.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    own = shared.dropDuplicates(["k1", "k2", "start"])
    whole = F.array(F.struct(F.col("start").alias("from"), (F.col("start") + F.col("windows") + (length - 1)).alias("to")))
    some = F.transform(F.arrays_zip("from", "to"), lambda s: F.struct(
        (F.col("start") + s["from"]).alias("from"), (F.col("start") + s["to"] + (length - 1)).alias("to")))
    alike = own.where("not mixed").select("k1", "k2", whole.alias("spans"))
    spread = own.where("mixed").withColumn("part", F.pmod(F.xxhash64("k1", "k2"), F.col("parts")).cast("int"))
    partly = spread.join(known, [*keys, "part"]).select("k1", "k2", F.when(F.col("n") > 1, whole).otherwise(some).alias("spans"))
    spans = alike.unionByName(partly)
    return spans.groupBy("k1", "k2").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _kept_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their spans: bytes, removed ones, maximal removed runs, and what is kept."""
    for batch in batches:
        rows = []
        for doc, text, spans in zip(*[c.to_pylist() for c in batch.columns]):
            data = text.encode()
            kept, at, removed, runs = [], 0, 0, 0
            begin = end = None
            for s in sorted((s["from"], s["to"]) for s in spans or ()):
                if end is None or s[0] > end:
                    if end is not None:
                        removed, runs = removed + end - begin, runs + 1
                        kept.append(data[at:begin])
                        at = end
                    begin, end = s
                else:
                    end = max(end, s[1])
            if end is not None:
                removed, runs = removed + end - begin, runs + 1
                kept.append(data[at:begin])
                at = end
            kept.append(data[at:])
            rows.append((doc, len(data), removed, runs, b"".join(kept)))
        kinds = [pa.int64()] * 4 + [pa.binary()]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 5, kinds)],
                              names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def without_repeats(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and ``kept``, the bytes that stay, of every row."""
    spans = repeated_spans(docs, text=text, length=length, gram=gram, hot=hot)
    value = F.coalesce(docs[text], F.lit(""))
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), value.alias("text"),
                       F.xxhash64(value).alias("k1"), F.xxhash64(F.lit(7), value).alias("k2"))
    joined = rows.join(written(spans, "spans"), ["k1", "k2"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_kept_task, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op12_column_wise_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of repeated 400-byte strings."""
    out = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT r, p, md5_number(substr(h, 2 * p + 1, 800)) AS k FROM (SELECT r, h, unnest(range(greatest(n - 399, 0))) AS p FROM d)),
hit AS (SELECT r, p FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
g AS (SELECT r, p, sum(new) OVER (PARTITION BY r ORDER BY p) AS i
  FROM (SELECT r, p, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + 400 THEN 0 ELSE 1 END AS new FROM hit)),
s AS (SELECT r, i, min(p) AS a, max(p) + 400 AS b FROM g GROUP BY r, i),
k AS (SELECT r, i, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY i), 0) AS before FROM s),
x AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY i) AS head
  FROM k JOIN d USING (r) GROUP BY r)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN x USING (r)
"""
