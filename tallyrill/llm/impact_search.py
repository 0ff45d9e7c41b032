"""Exact top-k inner products by an impact-ordered index, read score at a time.

Components are whole numbers, floor(SCALE * x). A dimension's postings hold each vector with its
distance from the middle of the dimension's range; a segment holds those whose distance falls into
one of LEVELS quantised impacts, on one side. Each task indexes its vectors in blocks of BLOCK and
answers a batch of queries together: segments are read by descending impact (largest distance in
the segment times the largest weight a query gives the dimension), and each adds one quantised
amount to the scores of its vectors. What a score still can change by is bounded by the impacts
that are left and by what quantisation took. A query stops only on proof, when few enough vectors can
still be among its k best; those are rescored exactly, and nothing else is ever returned.

Queries lie in files of about QUERIES in the shared folder, which Spark's tasks write. A task indexes HELD of its
vectors, reads the files one after the other, and gives the k best of those vectors for each query, with a floor that
rises as its blocks go by. So there is one pass over the vectors however many queries there are, and a task holds one file of queries and
HELD vectors. The k best of all follow by Spark's grouped limit.

Vectors that are null, or hold null or non-finite components, take no part; others may differ in
length, missing components count as 0. Rows with a null id are neither queries nor candidates; rows
with the query's id are not its candidates; of other repeated rows each takes part. A query id that
several rows hold asks once, with the first of their vectors in ascending order of components, a
shorter one filled up with 0. Very long vectors are indexed whole. Other columns are not read, whatever their names. Ties go to the smaller id. Scores must fit 64 bits. Without queries or vectors there are no rows.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyrill.llm.store import FileStore, written

SCALE = 256
TOP = 5
EVERY = 50
BLOCK = 4096
LEVELS = 16
#: Queries of one file, and of one batch in a task.
QUERIES = 16_384
BATCH = 256
#: Vectors that a task holds at once.
HELD = 32 * BLOCK
#: How often a batch looks for proof, and how many possible members are worth rescoring.
CHECKS = 4
FEW = 64


def whole(ids: pa.Array, vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of whole numbers, one length, of the rows that take part."""
    keep_ids, rows = [], []
    for i, v in zip(ids.to_pylist(), vectors):
        if i is None or not v.is_valid:
            continue
        x = v.values
        if x.null_count:
            continue
        x = np.floor(SCALE * np.asarray(x.to_numpy(zero_copy_only=False), np.float64))
        if np.isfinite(x).all():
            keep_ids.append(i)
            rows.append(x.astype(np.int64))
    width = max(map(len, rows), default=0)
    out = np.zeros((len(rows), width), np.int64)
    for r, x in enumerate(rows):
        out[r, : len(x)] = x
    return np.array(keep_ids, np.int64), out


def widened(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] >= width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


class ImpactIndex:
    """Segments of one block of vectors."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        low, high = vectors.min(0), vectors.max(0)
        self.middle = (low + high) / 2
        self.half = (high - low) / 2
        self.error = np.zeros(vectors.shape[1])
        self.segments: list[tuple[int, float, float, np.ndarray]] = []  # dimension, largest distance, amount, rows
        for d in np.flatnonzero(self.half):
            away = vectors[:, d] - self.middle[d]
            level = np.minimum((np.abs(away) * (LEVELS / self.half[d])).astype(np.int64), LEVELS - 1)
            code = np.where(away < 0, -1 - level, level)
            order = np.argsort(code, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(code[order])) + 1):
                least, most = away[rows].min(), away[rows].max()
                self.segments.append((int(d), float(max(abs(least), abs(most))), float(least + most) / 2, rows))
                self.error[d] = max(self.error[d], (most - least) / 2)

    def possible(self, queries: np.ndarray, k: int, floor: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """For each query (its place) the rows that may be among its k best and reach ``floor``."""
        weights = queries.astype(np.float64)
        size = np.abs(weights)
        heavy = size.max(0)
        order = sorted(self.segments, key=lambda s: -s[1] * heavy[s[0]])
        left = np.zeros((len(order) + 1, len(heavy)))  # largest distance per dimension from a place on
        for i in range(len(order) - 1, -1, -1):
            left[i] = left[i + 1]
            left[i, order[i][0]] = max(left[i, order[i][0]], order[i][1])
        # A little more than any rounding of 32-bit sums of this size.
        slack = size @ self.error + 1.2e-7 * (weights.shape[1] + 2) * (size @ (self.half + np.abs(self.middle)) + 1)
        scores = np.tile((weights @ self.middle).astype(np.float32), (len(self.vectors), 1))
        active = np.arange(len(queries))
        checks = {round(len(order) * (c + 1) / CHECKS) for c in range(CHECKS)} | {len(order)}
        for i in range(len(order) + 1):
            if i in checks:
                reach = size[active] @ left[i] + slack[active]
                n = len(self.vectors)
                best = np.partition(scores, n - k, 0)[n - k] - reach if n >= k else np.full(len(active), -np.inf)
                may = scores >= np.maximum(best, floor[active] - 0.5) - reach
                done = (may.sum(0) <= FEW) | (i == len(order))
                for q in np.flatnonzero(done):
                    yield int(active[q]), np.flatnonzero(may[:, q])
                if done.any():
                    active, scores = active[~done], np.ascontiguousarray(scores[:, ~done])
                if not len(active):
                    return
            if i < len(order):
                d, _, amount, rows = order[i]
                scores[rows] += (amount * weights[active, d]).astype(np.float32)


def _best(blocks: list[tuple[np.ndarray, ImpactIndex]], query_ids: np.ndarray, query_rows: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """The k best rows of these blocks for each query."""
    best: list[list[tuple[int, int]]] = [[] for _ in query_ids]  # (-score, id), ascending
    floor = np.full(len(query_ids), -np.inf)
    for block_ids, index in blocks:
        block = index.vectors
        rows = query_rows
        if rows.shape[1] > block.shape[1]:  # what the block lacks counts as 0
            rows = rows[:, : block.shape[1]]
        rows = widened(rows, block.shape[1])
        for b in range(0, len(query_ids), BATCH):
            part = rows[b : b + BATCH]
            # More than k: the query's own rows, however many the block holds, may be among them.
            own = np.isin(block_ids, query_ids[b : b + BATCH])
            most = int(np.unique(block_ids[own], return_counts=True)[1].max(initial=0))
            for q, found in index.possible(part, k + most, floor[b : b + BATCH]):
                found = found[block_ids[found] != query_ids[b + q]]
                if not len(found):
                    continue
                exact = block[found] @ part[q]
                merged = best[b + q] + list(zip((-exact).tolist(), block_ids[found].tolist()))
                best[b + q] = sorted(merged)[:k]
                if len(best[b + q]) == k:
                    floor[b + q] = -best[b + q][-1][0]
    out = [(int(q), i, -s) for q, found in zip(query_ids, best) for s, i in found]
    for a in range(0, len(out), 50_000):
        yield pa.record_batch(
            [pa.array(c, pa.int64()) for c in zip(*out[a : a + 50_000])], names=["query_id", "vec_id", "score"])


def _search(store: FileStore, files: list[str], k: int, block: int, held: int):
    """For each query the k best of every ``held`` rows of a task."""

    def answers(blocks: list) -> Iterator[pa.RecordBatch]:
        for name in files:
            with store.read(name) as file:
                arrays = np.load(io.BytesIO(file.read()))
                yield from _best(blocks, arrays["ids"], arrays["rows"], k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, n = [], 0
        for batch in batches:
            ids, vectors = whole(batch.column(0), batch.column(1))
            for a in range(0, len(ids), block):
                blocks.append((ids[a : a + block], ImpactIndex(vectors[a : a + block])))
                n += len(blocks[-1][0])
                if n >= held:
                    yield from answers(blocks)
                    blocks, n = [], 0
        if blocks:
            yield from answers(blocks)

    return run


def _write_queries(store: FileStore):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        ids, rows = whole_rows(table["vec_id"], table["whole"])
        name, out = store.create(".queries")
        held = io.BytesIO()
        np.savez(held, ids=ids, rows=rows)
        with out:
            out.write(held.getbuffer())
        return pa.table({"file": [name]})

    return run


def whole_rows(ids: pa.ChunkedArray, rows: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and equally long lists of whole numbers as arrays."""
    values = rows.combine_chunks().flatten().to_numpy()
    return ids.to_numpy(), values.reshape(len(ids), -1) if len(ids) else np.zeros((0, 0), np.int64)


def write_queries(asked: DataFrame, store: FileStore) -> list[str]:
    """Names of files with the queries, each id once, dealt by a hash of the id."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = asked.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(fine)
    rows = rows.select("vec_id", F.transform("embedding", lambda x: F.floor(SCALE * x.cast("double"))).alias("whole"))
    size = rows.agg(F.count_distinct("vec_id").alias("n"), F.max(F.size("whole")).alias("width")).first()
    if not size["n"]:
        return []
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(size["width"]) - F.size("whole"))
    rows = rows.groupBy("vec_id").agg(F.min(F.concat("whole", zeros)).alias("whole"))
    files = -(-size["n"] // QUERIES)
    block = F.pmod(F.xxhash64("vec_id"), F.lit(files))
    named = rows.withColumn("block", block).groupBy("block").applyInArrow(_write_queries(store), "file string")
    return [r["file"] for r in written(named, "queries").collect()]


def search(
    vectors: DataFrame, is_query: Column, *, k: int = TOP, vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows for each row that ``is_query`` holds for."""
    store = FileStore.fresh(vectors.sparkSession, "queries")
    columns = [vectors[vec_id].cast("long").alias("vec_id"), vectors[embedding].alias("embedding")]
    files = write_queries(vectors.where(is_query).select(*columns), store)
    found = vectors.select(*columns).mapInArrow(
        _search(store, files, k, BLOCK, HELD), "query_id long, vec_id long, score long")
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op7_impact_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows for every fiftieth vector."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(vectors, F.col("vec_id") % EVERY == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
