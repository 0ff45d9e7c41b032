"""Links between the tokens of two tokenizers over the same bytes, counted by external sorting.

Each text is encoded by a byte-level BPE (side A, of a space and the text) and by a sentencepiece model
(side B, which adds the space itself). Byte offsets where tokens of both sides end cut it into groups; every
A token of a group is linked with every B token of it. A pair of ids counts the documents that hold it linked.

Counting spills. A task turns its documents into records (A id, B id, document, links) and writes
them as sorted runs of about RECORDS, cut by radix (the leading bits of the A id) into zstd frames. Of each radix
the runs' pairs, which carry how many documents of the run hold them, are merged by a k-way heap, FAN_IN runs at a
time, so a pair that a third of all documents hold is one entry a run. They come in order of the A id, so its
highest count is known when its last pair has passed. At last each run streams its records past the
merged counts and adds up what its documents get; as a run has whole documents, nothing is shuffled back.
The committed table of frames says which files count; those of lost or repeated attempts are never read.

Words between single spaces and line breaks are encoded once a task, since neither side has tokens across them;
texts with other white space, and those that normalisation changes, are encoded whole.

Nulls: a null or empty text has no tokens; a null id stays null. Repeated rows and rows with one id are documents
of their own. A very long text is one run at least, however long; groups of thousands of tokens are
linked by distinct ids and their numbers. Ties: all partners with the highest count are best. An empty table gives no rows. Other
columns are not read. Vocabularies may have up to 65,536 ids a side.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrill.llm.store import FileStore, tidy, written
from tallyrill.llm.tokens import _byte_letters, _regular

#: Records held before a run is written.
RECORDS = 2_000_000
#: Parts that the A ids are cut into.
RADIX = 128
#: Runs that one heap merges.
FAN_IN = 256
#: Words remembered by a task; all go when there are more.
WORDS = 600_000
#: Texts that are cut into words at once, in characters.
CHARS = 2_000_000
_LONG = 64

_ROW = pa.schema([
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])
_ROW_DDL = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
            "groups_sha256 string")
_FRAME = pa.schema([("radix", pa.int32()), ("file", pa.string()), ("at", pa.int64()), ("sizes", pa.list_(pa.int64()))])
_FRAME_DDL = "radix int, file string, at long, sizes array<long>"
#: Radix of the frame with a run's documents.
_DOCUMENTS = -1


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after the other."""
    return np.arange(sizes.sum()) + np.repeat(starts - _starts(sizes)[:-1], sizes)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All values one after the other, and the number in each list."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of an almost sorted array, and how often each is there."""
    keys = np.sort(keys, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.diff(first, append=len(keys))


class Units:
    """Pieces of text that tokens of neither side cross, each with its tokens, groups and links.

    A unit is what side A reads: a space or line break and what follows it.
    """

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = {c: i for i, c in _byte_letters().items()}
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << 16:
            raise ValueError("a vocabulary has more than 65,536 ids")
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        # Ids as they are written, with what may follow.
        ids = list(map(str, range(max(len(self.a_bytes), len(self.b_bytes)))))
        self.texts = np.array([[i + after for i in ids] for after in ",|;\n"], object)
        # Words can be told apart only if no B piece goes on behind a space or line break.
        self.splits = not any(b" " in t.lstrip(b" ") or (b"\n" in t and len(t) > 1) for t in self.b_bytes)
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.strings: list[str | None] = []
        self.counts = [np.zeros((0, 5), np.int64)]  # n_a, n_b, n_groups, n_links, records
        self.keys, self.weights = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        self.extra = 0

    @property
    def full(self) -> bool:
        return len(self.strings) > WORDS or self.extra > 1 << 26

    def table(self) -> np.ndarray:
        """n_a, n_b, n_groups, n_links and number of records of each unit."""
        if len(self.counts) > 1:
            self.counts = [np.concatenate(self.counts)]
        return self.counts[0]

    def records(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of all units, as A id and B id in one number, and how often each is linked in the unit."""
        if len(self.keys) > 1:
            self.keys, self.weights = [np.concatenate(self.keys)], [np.concatenate(self.weights)]
        return self.keys[0], self.weights[0]

    def cut(self, text: str) -> list[str]:
        """The units of a text."""
        if not self.splits or not _regular(text):
            return [" " + text]
        first, *lines = text.split("\n")
        out = [" " + w for w in first.split(" ")]
        for line in lines:
            word, *words = line.split(" ")
            out.append("\n" + word)
            out += [" " + w for w in words]
        return out

    def find(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The places of each text's units, which are made where they are new."""
        known = self.places
        new = list(dict.fromkeys(u for units in texts for u in units if u not in known))
        if new:
            known.update(zip(new, range(len(self.strings), len(self.strings) + len(new))))
            self._make(new)
        out = [np.fromiter(map(known.__getitem__, units), np.int64, len(units)) for units in texts]
        for u in new:
            if len(u) > _LONG:
                self.extra += 4 * len(u)
                del known[u]
        return out

    def _encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = [e.ids for e in self.a.encode_batch(units, add_special_tokens=False)]
        # Side B adds a space before what it reads: that of the unit, or one before the line break.
        b = self.b.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        return a, [ids if u[0] == " " else ids[1:] for u, ids in zip(units, b)]

    def _make(self, units: list[str]) -> None:
        a, b = self._encode(units)
        raw = [u.encode() for u in units]
        good = self._whole(a, b, raw)
        counts = np.zeros((len(units), 5), np.int64)
        strings: list[str | None] = [None] * len(units)
        if good.any():
            if not good.all():
                keep = np.flatnonzero(good).tolist()
                a, b, raw = [a[i] for i in keep], [b[i] for i in keep], [raw[i] for i in keep]
            made, texts = self._links(a, b, np.array([len(r) for r in raw]))
            counts[good] = made
            for place, text in zip(np.flatnonzero(good).tolist(), texts):
                strings[place] = text
        self.counts.append(counts)
        self.strings += strings

    def _whole(self, a: list[list[int]], b: list[list[int]], raw: list[bytes]) -> np.ndarray:
        """Which units both sides tokenize to their own bytes."""
        known, sizes = b"".join(raw), np.array([len(r) for r in raw])
        for ids, own, kinds in ((a, self.a_bytes, self.a_sizes), (b, self.b_bytes, self.b_sizes)):
            flat, n = _flat(ids)
            ends = np.concatenate([[0], np.cumsum(kinds[flat])])[np.cumsum(n)]
            if not np.array_equal(ends, np.cumsum(sizes)) or b"".join(map(own.__getitem__, flat.tolist())) != known:
                return np.array([b"".join(map(self.a_bytes.__getitem__, x)) == r == b"".join(map(self.b_bytes.__getitem__, y))
                                 for x, y, r in zip(a, b, raw)])
        return np.ones(len(raw), bool)

    def _links(self, a: list[list[int]], b: list[list[int]], sizes: np.ndarray) -> tuple[np.ndarray, list[str]]:
        """Counts and written groups of units that both sides tokenize to their own bytes; pairs are added."""
        (ids_a, n_a), (ids_b, n_b) = _flat(a), _flat(b)
        ends_a, ends_b = np.cumsum(self.a_sizes[ids_a]), np.cumsum(self.b_sizes[ids_b])
        common = ends_a[ends_b[np.searchsorted(ends_b, ends_a)] == ends_a]  # both rise to the same end
        in_a, in_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        last = np.searchsorted(common, np.cumsum(sizes))  # the last group of each unit
        n_groups = np.diff(last, prepend=-1)
        unit = np.repeat(np.arange(len(a)), n_groups)  # of each group
        links = np.bincount(in_a, minlength=len(common)) * np.bincount(in_b, minlength=len(common))

        # Distinct ids of a group and how often each occurs there, so that large groups stay small.
        (own_a, times_a), (own_b, times_b) = _distinct(in_a << 16 | ids_a), _distinct(in_b << 16 | ids_b)
        kinds_b = np.bincount(own_b >> 16, minlength=len(common))
        partners = kinds_b[own_a >> 16]
        other = _ranges(_starts(kinds_b)[own_a >> 16], partners)
        keys = (np.repeat(own_a & 0xFFFF, partners) << 16 | own_b[other] & 0xFFFF).astype(np.uint32)
        self.keys.append(keys)
        self.weights.append(np.repeat(times_a, partners) * times_b[other])

        def per_unit(of: np.ndarray, values: np.ndarray) -> np.ndarray:
            out = np.zeros(len(a), np.int64)
            np.add.at(out, of, values)
            return out

        counts = np.stack([n_a, n_b, n_groups, per_unit(unit, links), per_unit(unit[own_a >> 16], partners)], 1)
        ends = np.zeros(len(common), bool)
        ends[last] = True
        return counts, self._written(ids_a, ids_b, in_a, in_b, ends)

    def _written(self, ids_a, ids_b, in_a: np.ndarray, in_b: np.ndarray, ends: np.ndarray) -> list[str]:
        """a1,a2|b1;a3|b2,b3 of each unit; ``ends`` are the groups that end one."""
        of_a, of_b = np.bincount(in_a, minlength=len(ends)), np.bincount(in_b, minlength=len(ends))
        last_a, last_b = (np.append(g[1:] != g[:-1], True) for g in (in_a, in_b))
        parts = np.empty(len(ids_a) + len(ids_b), object)
        parts[np.arange(len(ids_a)) + _starts(of_b)[in_a]] = self.texts[np.where(last_a, 1, 0), ids_a]
        after_b = np.where(last_b, np.where(ends[in_b], 3, 2), 0)
        parts[np.arange(len(ids_b)) + _starts(of_a)[in_b + 1]] = self.texts[after_b, ids_b]
        return "".join(parts.tolist()).split("\n")[:-1]


def _pack(*arrays: np.ndarray) -> list[bytes]:
    squeeze = zstandard.ZstdCompressor(level=1)
    return [squeeze.compress(x.tobytes()) for x in arrays]


def _unpack(raw: bytes, sizes: list[int], *kinds: str) -> list[np.ndarray]:
    loose, at, out = zstandard.ZstdDecompressor(), 0, []
    for size, kind in zip(sizes, kinds):
        out.append(np.frombuffer(loose.decompress(raw[at : at + size]), kind))
        at += size
    return out


class _Frames:
    """A file of frames being written, and the rows that tell where they are."""

    def __init__(self, store: FileStore):
        self.name, self.out = store.create(".run")
        self.at, self.rows = 0, []

    def add(self, radix: int, parts: list[bytes]) -> None:
        self.rows.append((radix, self.name, self.at, [len(p) for p in parts]))
        for p in parts:
            self.out.write(p)
            self.at += len(p)

    def close(self) -> pa.RecordBatch:
        self.out.close()
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*self.rows), _FRAME)], schema=_FRAME)


def _read(file, at: int, sizes: list[int]) -> bytes:
    file.seek(at)
    return file.read(sum(sizes))


class _Run:
    """Documents whose records are not yet written."""

    def __init__(self):
        self.rows, self.pending, self.size = [], [], 0

    def add(self, ids: list, places: list[np.ndarray | None], units: Units) -> None:
        """Documents by their id and the places of their units (none: no tokens)."""
        table = units.table()
        for doc, at in zip(ids, places):
            strings = [] if at is None else [units.strings[i] for i in at.tolist()]
            if at is None or None in strings:
                self.rows.append((doc, 0, 0, 0, 0, ""))
                continue
            n_a, n_b, n_groups, n_links, _ = table[at].sum(axis=0).tolist()
            text = hashlib.sha256(";".join(strings).encode()).hexdigest()
            own, times = np.unique(at, return_counts=True)
            self.pending.append((np.full(len(own), len(self.rows), np.uint32), own, times))
            self.size += int(table[own, 4].sum())
            self.rows.append((doc, n_a, n_b, n_groups, n_links, text))

    def write(self, store: FileStore, units: Units) -> pa.RecordBatch:
        """The run as one file."""
        frames = _Frames(store)
        if self.pending:
            docs, own, times = (np.concatenate(x) for x in zip(*self.pending))
            sizes = units.table()[:, 4]
            keys, weights = units.records()
            at = _ranges(_starts(sizes)[own], sizes[own])
            weights = weights[at] * np.repeat(times, sizes[own])
            order = keys[at].astype(np.uint64) << np.uint64(32) | np.repeat(docs, sizes[own])
            sort = np.argsort(order, kind="stable")
            order, weights = order[sort], weights[sort]
            first = np.flatnonzero(np.concatenate([[True], order[1:] != order[:-1]]))
            order, weights = order[first], np.add.reduceat(weights, first)
            keys, docs = (order >> np.uint64(32)).astype("<u4"), (order & np.uint64(0xFFFFFFFF)).astype("<u4")
            pair = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            holders = np.diff(pair, append=len(keys)).astype("<u4")
            pairs = keys[pair]
            bounds = np.searchsorted(pairs.astype(np.int64), (np.arange(RADIX + 1) * (1 << 32) // RADIX))
            for r in range(RADIX):
                a, b = bounds[r], bounds[r + 1]
                if a < b:
                    x, y = pair[a], pair[b] if b < len(pair) else len(keys)
                    frames.add(r, _pack(pairs[a:b], holders[a:b], docs[x:y], weights[x:y].astype("<i8")))
        columns = list(zip(*self.rows))
        zero = [0] * len(self.rows)
        table = pa.table([pa.array(c, f.type) for c, f in zip([*columns[:5], zero, zero, columns[5]], _ROW)], schema=_ROW)
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, _ROW) as stream:
            stream.write_table(table)
        frames.add(_DOCUMENTS, [zstandard.ZstdCompressor(level=1).compress(out.getvalue().to_pybytes())])
        return frames.close()


def _write_runs(store: FileStore, a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, held = Units(a_path, b_path), _Run()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            first = 0
            while first < len(ids):
                last, chars = first, 0
                while last < len(ids) and (last == first or chars < CHARS):
                    chars += len(texts[last] or "")
                    last += 1
                cuts = [units.cut(t) if t else [] for t in texts[first:last]]
                places = [p if len(p) else None for p in units.find(cuts)]
                held.add(ids[first:last], places, units)
                first = last
                if held.size + len(held.rows) >= RECORDS or units.full:
                    yield held.write(store, units)
                    held = _Run()
                    if units.full:
                        units.clear()
        if held.rows:
            yield held.write(store, units)

    return run


def _stream(store: FileStore, row: dict) -> Iterator[tuple[int, int]]:
    """Pairs of one run and radix, in order, each with its number of documents."""
    with store.read(row["file"]) as file:
        raw = _read(file, row["at"], row["sizes"][:2])
    keys, holders = _unpack(raw, row["sizes"], "<u4", "<u8" if len(row["sizes"]) == 3 else "<u4")
    return zip(keys.tolist(), holders.tolist())


def _merged(rows: list[dict], store: FileStore) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of some runs, how many documents hold each, and whether none of its A id has more.

    The heap gives pairs by A id, so an A id's pairs are together and its highest count follows at their end.
    """
    keys, counts, best = [], [], []
    side, begun, before, highest = None, 0, None, 0

    def settle() -> None:
        best.extend([c == highest for c in counts[begun:]])

    for key, n in heapq.merge(*[_stream(store, row) for row in rows]):
        if key == before:
            counts[-1] += n
        else:
            if key >> 16 != side:
                settle()
                side, begun, highest = key >> 16, len(keys), 0
            keys.append(key)
            counts.append(n)
            before = key
        highest = max(highest, counts[-1])
    settle()
    return np.array(keys, "<u4"), np.array(counts, "<u8"), np.array(best, "u1")


def _merge_task(store: FileStore):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        frames = _Frames(store)
        frames.add(key[0].as_py(), _pack(*_merged(table.select(_FRAME.names).to_pylist(), store)))
        return pa.Table.from_batches([frames.close()])

    return run


def merge_runs(frames: DataFrame, store: FileStore) -> DataFrame:
    """The table of one merged frame for each radix: pairs, their counts, and which are best."""
    frames = frames.where(F.col("radix") != _DOCUMENTS)
    while True:
        many = frames.groupBy("radix").count().agg(F.max("count")).first()[0] or 0
        groups = -(-many // FAN_IN)
        # Groups of about FAN_IN files each; the last round has one group a radix.
        group = F.pmod(F.xxhash64("file"), F.lit(max(1, 2 * groups if groups > 1 else 1)))
        # So many tasks, however few rows: a row stands for a frame.
        dealt = frames.withColumn("group", group).repartition(RADIX, "radix", "group")
        merged = dealt.groupBy("radix", "group").applyInArrow(_merge_task(store), _FRAME_DDL)
        frames = written(merged, "merged")
        if groups <= 1:
            return frames


def _give_back(store: FileStore, merged: dict[int, tuple]):
    """Each run's documents with what the counts give them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in batch.to_pylist()]
        for row in rows:
            with store.read(row["file"]) as file:
                frames = {f["radix"]: f for f in row["frames"]}
                own = frames.pop(_DOCUMENTS)
                raw = zstandard.ZstdDecompressor().decompress(_read(file, own["at"], own["sizes"]))
                table = pa.ipc.open_stream(raw).read_all()
                best, total = (np.zeros(len(table), np.int64) for _ in range(2))
                for radix, frame in sorted(frames.items()):
                    keys, holders, docs, weights = _unpack(
                        _read(file, frame["at"], frame["sizes"]), frame["sizes"], "<u4", "<u4", "<u4", "<i8")
                    name, at, sizes = merged[radix]
                    with store.read(name) as other:
                        all_keys, counts, is_best = _unpack(_read(other, at, sizes), sizes, "<u4", "<u8", "u1")
                    place = np.searchsorted(all_keys, keys)
                    np.add.at(total, docs, weights * np.repeat(counts[place].astype(np.int64), holders))
                    np.add.at(best, docs, weights * np.repeat(is_best[place].astype(np.int64), holders))
            table = table.set_column(5, "n_best", pa.array(best)).set_column(6, "count_sum", pa.array(total))
            yield from table.to_batches(max_chunksize=10_000)

    return run


def aligned(
    docs: DataFrame, store: FileStore, a_path: str, b_path: str, *, doc_id: str = "doc_id", text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The tables of run frames and of merged frames: all records and all counts are in the store."""
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    runs = written(rows.mapInArrow(tidy(_write_runs(store, a_path, b_path)), _FRAME_DDL), "runs")
    return runs, merge_runs(runs, store)


def contributions(runs: DataFrame, merged: DataFrame, store: FileStore) -> DataFrame:
    """Every document with its tokens, groups, links, how many are best, and the sum of their counts."""
    # One row per radix.
    places = {r["radix"]: (r["file"], r["at"], list(r["sizes"])) for r in merged.collect()}
    files = runs.groupBy("file").agg(F.collect_list(F.struct("radix", "at", "sizes")).alias("frames"))
    n_files = runs.where(F.col("radix") == _DOCUMENTS).count()
    return files.repartition(max(1, n_files)).mapInArrow(_give_back(store, places), _ROW_DDL)


def pair_counts(merged: DataFrame, store: FileStore) -> DataFrame:
    """a, b, documents and whether none of the A id's pairs has more, for every linked pair of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with store.read(row["file"]) as file:
                    raw = _read(file, row["at"], row["sizes"])
                keys, counts, best = _unpack(raw, row["sizes"], "<u4", "<u8", "u1")
                yield pa.record_batch(
                    [pa.array((keys >> 16).astype(np.int32)), pa.array((keys & 0xFFFF).astype(np.int32)),
                     pa.array(counts.astype(np.int64)), pa.array(best.astype(bool))],
                    names=["a", "b", "documents", "best"])

    return merged.repartition(RADIX).mapInArrow(run, "a int, b int, documents long, best boolean")


def op11_external_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, byte-level BPE against sentencepiece."""
    import public_tokenizers

    store = FileStore.fresh(spark, "alignment")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    runs, merged = aligned(
        docs, store, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return contributions(runs, merged, store)
