"""Bounded-space online packing of token ids into sequences of a fixed window.

Every task reads its documents once and keeps a fixed number of open windows. A document's ids
fill whole windows first; what remains goes into the open window that it leaves least room in
(best fit). When none has room, the fullest one takes the head of it, if the piece is worth a cut,
and is emitted. The windows left open at the end of the tasks are merged by the same rule in
groups of tasks, then groups of groups, so no task ever sees more than a fixed number of them.

Nulls: a null text is empty and gives the end id alone; null ids are kept. Repeated rows are packed
each on their own. A very long text fills many windows, one after the other. Ties go to the window opened first. An empty table gives no pieces. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrill.llm.store import written
from tallyrill.llm.tokens import Encoder, encoder

WINDOW = 1024
#: Open windows per task, and tasks whose left-over windows are merged at once.
OPEN = 64
FAN_IN = 32
#: A document is cut to fill a window only if both parts have at least so many ids.
LEAST_PIECE = 16
END_ID = 0

_SHIFT = 1 << 24  # sequences of one task; a task of a round is numbered above them
_ROUND = 1 << 56

_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
    ("task", pa.int64()), ("open", pa.bool_()), ("ids", pa.binary()),
])
_DDL = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
        "offset long, task long, open boolean, ids binary")


class Windows:
    """The open windows of one task, by free space; emit(content) takes those that are done."""

    def __init__(self, window: int, most: int, emit: Callable[[list], None]):
        self.window, self.most, self.emit = window, most, emit
        self.open: list[tuple[int, int, list]] = []  # free space, a number that breaks ties, content
        self.made = 0

    def room(self, length: int) -> int | None:
        """Where the best fit for so many ids is; None if nothing has room."""
        at = bisect.bisect_left(self.open, length, key=lambda w: w[0])
        return at if at < len(self.open) else None

    def fullest(self) -> int:
        return self.open[0][0] if self.open else 0

    def place(self, length: int, item) -> None:
        """Put an item where it fits best, in a new window if need be."""
        at = self.room(length)
        if at is None and len(self.open) >= self.most:
            self.emit(self.open.pop(0)[2])
        free, number, content = (self.window, self.made, []) if at is None else self.open.pop(at)
        self.made += at is None
        content.append(item)
        if free == length:
            self.emit(content)
        else:
            bisect.insort(self.open, (free - length, number, content), key=lambda w: w[:2])

    def fill(self, item) -> None:
        """Complete the fullest window with an item exactly as long as its room."""
        content = self.open.pop(0)[2]
        content.append(item)
        self.emit(content)

    def rest(self) -> list[list]:
        return [content for _, _, content in self.open]


def _pack_task(path: str, end_id: int, window: int, most: int, with_ids: bool, pieces: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(path, pieces) as tokens:
            yield from pack_all(tokens, batches)

    def pack_all(tokens: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        rows, sequence = [], task * _SHIFT
        end = np.uint32(end_id).tobytes()

        def emit(content: list, still_open: bool = False) -> None:
            nonlocal sequence
            offset = 0
            for doc, start, length, crc, total, ids in content:
                rows.append((doc, start, length, crc, total, sequence, offset, task, still_open, ids))
                offset += length
            sequence += 1

        windows = Windows(window, most, emit)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = tokens.encode(text) + end
                total, start = len(ids) // 4, 0

                def piece(length, doc=doc, ids=ids, total=total):
                    part = ids[4 * start : 4 * (start + length)]
                    return doc, start, length, zlib.crc32(part), total, part if with_ids else None

                while total - start >= window:
                    emit([piece(window)])
                    start += window
                while start < total:
                    left, space = total - start, windows.fullest()
                    cut = (windows.room(left) is None and len(windows.open) >= most
                           and space >= LEAST_PIECE and left - space >= LEAST_PIECE)
                    if cut:
                        windows.fill(piece(space))
                    else:
                        windows.place(left, piece(left))
                    start += space if cut else left
                if len(rows) >= 10_000:
                    yield _batch(rows)
                    rows.clear()
        for content in windows.rest():
            emit(content, True)
        if rows:
            yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*rows), _PIECES)], schema=_PIECES)


def _merge_group(window: int, most: int, turn: int, last: bool):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """Windows of one group of tasks, placed in new windows, the longest first."""
        group, rows = key[0].as_py(), []
        sequence = turn * _ROUND + group * _SHIFT
        found: dict[int, list[dict]] = {}
        for row in table.select(_PIECES.names).to_pylist():
            found.setdefault(row["sequence_id"], []).append(row)

        def emit(content: list, still_open: bool = False) -> None:
            nonlocal sequence
            base = 0
            for length, pieces in content:
                for p in sorted(pieces, key=lambda p: p["offset"]):
                    rows.append({**p, "sequence_id": sequence, "offset": base + p["offset"],
                                 "task": group, "open": still_open})
                base += length
            sequence += 1

        sized = [(sum(p["length"] for p in pieces), number, pieces) for number, pieces in found.items()]
        windows = Windows(window, most, emit)
        for length, _, pieces in sorted(sized, key=lambda x: (-x[0], x[1])):
            windows.place(length, (length, pieces))
        for content in windows.rest():
            emit(content, not last)
        return pa.Table.from_pylist(rows, schema=_PIECES)

    return run


def pack(
    docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text",
    end_id: int = END_ID, window: int = WINDOW, open_windows: int = OPEN, with_ids: bool = False, pieces: int | None = None,
) -> DataFrame:
    """Every document's ids, with the end id, as pieces of sequences of at most ``window`` ids.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with
    ``with_ids`` its ids as little-endian unsigned 32-bit integers. ``pieces`` bounds the pieces of text that a task
    remembers, which changes its memory and speed only.
    """
    source = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    packed = source.mapInArrow(_pack_task(tokenizer, end_id, window, open_windows, with_ids, pieces), _DDL)
    pieces = written(packed, "pieces")
    done, turn = [pieces.where("not open")], 0
    tasks = pieces.agg(F.max("task")).first()[0] or 0
    while True:
        turn, tasks = turn + 1, tasks // FAN_IN
        left = pieces.where("open").withColumn("group", F.floor(F.col("task") / FAN_IN))
        merged = left.groupBy("group").applyInArrow(
            _merge_group(window, open_windows, turn, tasks == 0), _DDL)
        if tasks == 0:
            done.append(merged)
            break
        pieces = written(merged, "pieces")
        done.append(pieces.where("not open"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("task", "open", *([] if with_ids else ["ids"]))


def op9_bounded_space_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 ids."""
    import public_tokenizers

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
