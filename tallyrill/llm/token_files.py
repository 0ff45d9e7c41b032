"""Token ids in files of fixed-width bit packing, with offsets for random access.

A file holds the ids of a run of documents, each id in the fewest bits that the vocabulary needs:

    b"FWTOK1\\n\\0", blocks, footer, length of the footer (u64), b"FWTOK1\\n\\0"

A block packs BLOCK ids (the last one fewer), lowest bit first, and begins on a whole byte. The
footer is JSON: bits, n_ids, the byte offset of each block, and place and length of three arrays
before it: document ids (i64), the end of each document in ids (u64), and which ids are null (u1).

Documents are dealt by ranges of their id, so files follow one another in ascending order; the
committed table of files says which count. Nulls: a null text is empty, a null id comes first.
Repeated rows are all written, ties in id ordered by a hash of the text. A very long text lies in many blocks of
one file. An empty table makes no files.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyrill.llm.store import FileStore, reading_tasks, written
from tallyrill.llm.tokens import Encoder, encoder

MAGIC = b"FWTOK1\n\0"
BLOCK = 1 << 16
END_ID = 1


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Ids below 2**bits, lowest bit first, padded to a whole byte."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids[:, None] >> np.arange(bits, dtype=ids.dtype)) & 1
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(raw: bytes, bits: int, n: int) -> np.ndarray:
    """The first n ids of a block."""
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f"<u{bits // 8}", n).astype(np.uint32)
    spread = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return spread.astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


class TokenFileWriter:
    """Writes one file to an open stream, a block at a time."""

    def __init__(self, out, bits: int):
        self.out, self.bits = out, bits
        self.pending, self.size = [], 0
        self.blocks, self.at, self.n_ids = [], len(MAGIC), 0
        self.docs, self.ends = [], []
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(doc_id)
        self.n_ids += len(ids) // 4
        self.ends.append(self.n_ids)
        self.pending.append(ids)
        self.size += len(ids)
        if self.size >= 16 * BLOCK:
            self._write(False)

    def _write(self, rest: bool) -> None:
        raw = b"".join(self.pending)
        whole = len(raw) if rest else len(raw) - len(raw) % (4 * BLOCK)
        for a in range(0, whole, 4 * BLOCK):
            packed = pack_bits(np.frombuffer(raw[a : min(whole, a + 4 * BLOCK)], "<u4"), self.bits)
            self.blocks.append(self.at)
            self.out.write(packed)
            self.at += len(packed)
        self.pending = [raw[whole:]]
        self.size = len(raw) - whole

    def close(self) -> None:
        self._write(True)
        places = {}
        for name, array in (
            ("doc_ids", np.array([d or 0 for d in self.docs], "<i8")),
            ("ends", np.array(self.ends, "<u8")),
            ("missing", np.array([d is None for d in self.docs], "u1")),
        ):
            places[name] = [self.at, len(array)]
            self.out.write(array.tobytes())
            self.at += array.nbytes
        footer = json.dumps({"bits": self.bits, "n_ids": self.n_ids, "blocks": self.blocks, **places}).encode()
        self.out.write(footer + len(footer).to_bytes(8, "little") + MAGIC)
        self.out.close()


class TokenFile:
    """Random access to one file."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        tail = self._read(size - 16, 16)
        if tail[8:] != MAGIC or self._read(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a token file")
        length = int.from_bytes(tail[:8], "little")
        self.footer = json.loads(self._read(size - 16 - length, length))
        self.bits, self.n_ids = self.footer["bits"], self.footer["n_ids"]
        self.doc_ids, self.ends = self._array("doc_ids", "<i8"), self._array("ends", "<u8").astype(np.int64)
        self.missing = self._array("missing", "u1").astype(bool)

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def _array(self, name: str, kind: str) -> np.ndarray:
        at, n = self.footer[name]
        return np.frombuffer(self._read(at, n * np.dtype(kind).itemsize), kind)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids from start to before end, from the blocks that hold them."""
        parts = []
        for b in range(start // BLOCK, -(-end // BLOCK)):
            n = min(BLOCK, self.n_ids - b * BLOCK)
            block = unpack_bits(self._read(self.footer["blocks"][b], -(-n * self.bits // 8)), self.bits, n)
            parts.append(block[max(0, start - b * BLOCK) : end - b * BLOCK])
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(id, start in the file, ids) of each document, each block read about once."""
        held, ids = (0, 0), np.zeros(0, np.uint32)
        start = 0
        for doc, gone, end in zip(self.doc_ids.tolist(), self.missing.tolist(), self.ends.tolist()):
            if end > held[1]:
                low, high = start - start % BLOCK, min(self.n_ids, max(end, start + 8 * BLOCK))
                held, ids = (low, high), self.ids(low, high)
            yield None if gone else doc, start, ids[start - held[0] : end - held[0]]
            start = end


def _write_task(store: FileStore, path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(path) as tokens:
            yield from write_all(tokens, batches)

    def write_all(tokens: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bits = max(1, (max(tokens.vocabulary, end_id + 1) - 1).bit_length())
        end, out = np.uint32(end_id).tobytes(), None
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if out is None:
                    name, stream = store.create(".tokens")
                    out = TokenFileWriter(stream, bits)
                out.add(doc, tokens.encode(text) + end)
        if out is not None:
            out.close()
            yield pa.record_batch(
                [pa.array([TaskContext.get().partitionId()]), pa.array([name]),
                 pa.array([len(out.docs)]), pa.array([out.n_ids])],
                names=["part", "file", "n_docs", "n_ids"])

    return run


def write_tokens(
    docs: DataFrame, store: FileStore, tokenizer: str, *,
    doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID,
) -> DataFrame:
    """Write the files; returns the committed table of them: part, file, n_docs, n_ids."""
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie")
    rows = rows.sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    files = rows.mapInArrow(
        _write_task(store, tokenizer, end_id), "part long, file string, n_docs long, n_ids long")
    return written(files, "token-files")


def read_tokens(files: DataFrame, store: FileStore, with_ids: bool = False) -> DataFrame:
    """Every document from the files: doc_id, start, n_tokens, ids_crc32, and the ids if asked for."""
    # One row per file: the sums that place files behind one another are as few as tasks that wrote.
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    size = files.agg(F.count("*").alias("files"), F.coalesce(F.sum("n_ids"), F.lit(0)).alias("ids")).first()
    # A row stands for a whole file, so Spark can't tell how many tasks they need.
    tasks = reading_tasks(files.sparkSession, size["files"], 2 * size["ids"])
    placed = files.select("file", "part", before.alias("before")).repartitionByRange(tasks, "part").select("file", "before")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with store.read(row["file"]) as file:
                    rows = []
                    for doc, start, ids in TokenFile(file).documents():
                        raw = ids.astype("<u4").tobytes()
                        rows.append((doc, row["before"] + start, len(ids), zlib.crc32(raw), raw if with_ids else None))
                        if len(rows) >= 10_000:
                            yield _rows(rows)
                            rows = []
                    yield _rows(rows)

    out = placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
    return out if with_ids else out.drop("ids")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.binary()]
    columns = list(zip(*rows)) or [[]] * 5
    return pa.record_batch(
        [pa.array(c, t) for c, t in zip(columns, kinds)], names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])


def op3_bit_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids, written to files and read back from them."""
    import public_tokenizers

    store = FileStore.fresh(spark, "tokens")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_tokens(write_tokens(docs, store, public_tokenizers.path("word_bpe_49k.json")), store)
