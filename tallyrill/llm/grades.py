"""Quality grades by ordinal cumulative-link regression on hashed text.

One weight per hashed feature is shared by all grades, and ordered thresholds part them:
P(grade > k) = logistic(weights * features - threshold k). This gives each text an expected grade and
the probability of every tail, by which texts are selected.

Features are words ([^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+, A-Z in lower case), the last three bytes of
strings between white space, and how many words repeat the one before; each family has values whose
squares sum to at most 1, so length does not matter. At most about SAMPLE labelled rows are learned
from, chosen by a hash of the id. They are learned in parts: every task improves the shared weights on
its rows by adaptive gradients, and the driver averages what the tasks return, ROUNDS times. What
comes to the driver is as large as the model times the parts, whatever the size of the tables.

Nulls: a null or empty text has no features and gets the grade that thresholds alone give. Rows of
labels with a null are left out; of several labels for an id the lowest counts. A null id is never
held out. Repeated rows are graded alike. Very long texts are graded whole.
Ties in a grade stay. Without labelled rows every text gets grade 0; an empty table of documents gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyrill.llm.store import written
from tallyrill.llm.words import PUNCTUATION, SPACE, chunks, hashes, spans

#: Labelled rows that are learned from, about, and the parts that learn side by side.
SAMPLE = 24_000
PARTS = 8
ROUNDS = 5
#: Gradient steps of a part in a round, and texts of one step.
STEPS = 150
MINIBATCH = 128
RATE = 0.5
PULL = 1e-5
FOLDS = 5
HELD_OUT = 0
#: Weights of each of the two hashed families; one more is for repeats.
SLOTS = 1 << 16


@dataclass
class Model:
    weights: np.ndarray
    first: float  # the lowest threshold
    steps: np.ndarray  # logarithms of what parts each from the next

    def thresholds(self) -> np.ndarray:
        return self.first + np.concatenate([[0.0], np.cumsum(np.exp(self.steps))])

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) of each text for every k but the last."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds(), -40, 40)))


def features(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, slot, value), sorted by text."""
    n = len(at) - 1
    out = []
    start, end, place = spans(raw, at, PUNCTUATION)
    words, text = hashes(raw, start, end), np.repeat(np.arange(n), np.diff(place))
    out.append(_family(text, words, n, 0))
    same = np.flatnonzero((words[1:] == words[:-1]) & (text[1:] == text[:-1])) + 1
    repeats = np.bincount(text[same], minlength=n)
    rows = np.flatnonzero(repeats)
    out.append((rows, np.full(len(rows), 2 * SLOTS), np.sqrt(repeats[rows] / np.diff(place)[rows])))
    start, end, place = spans(raw, at, SPACE)
    out.append(_family(np.repeat(np.arange(n), np.diff(place)), hashes(raw, np.maximum(start, end - 3), end), n, SLOTS))
    rows, slots, values = (np.concatenate(x) for x in zip(*out))
    order = np.argsort(rows, kind="stable")
    return rows[order], slots[order], values[order]


def _family(text: np.ndarray, hashed: np.ndarray, n: int, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    slot = (hashed & np.uint64(SLOTS - 1)).astype(np.int64)
    found, count = np.unique(text * SLOTS + slot, return_counts=True)
    rows = found // SLOTS
    total = np.bincount(text, minlength=n)
    return rows, base + found % SLOTS, np.sqrt(count / total[rows])


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, grade, slots, values) of labelled texts."""
    for batch in batches:
        for first, raw, at in chunks(batch.column(2)):
            rows, slots, values = features(raw, at)
            cut = np.searchsorted(rows, np.arange(len(at)))
            yield pa.record_batch([
                batch.column(0).slice(first, len(at) - 1), batch.column(1).slice(first, len(at) - 1),
                pa.array([slots[a:b].astype("<i4").tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                pa.array([values[a:b].astype("<f4").tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
            ], names=["part", "grade", "slots", "values"])


def improve(model: Model, grades: np.ndarray, cut: np.ndarray, slots: np.ndarray, values: np.ndarray, rate: float) -> Model:
    """STEPS adaptive gradient steps on the negative log-likelihood; text i is cut[i] to cut[i + 1]."""
    w, first, steps = model.weights.copy(), model.first, model.steps.copy()
    seen_w, seen_t = np.full(len(w), 1e-2), np.full(1 + len(steps), 1e-2)
    order = np.random.default_rng(7)
    sizes = np.diff(cut)
    done = 0
    while done < STEPS:
        shuffled = order.permutation(len(grades))
        for a in range(0, len(grades), MINIBATCH):
            done += 1
            rows = shuffled[a : a + MINIBATCH]
            size = sizes[rows]
            pick = np.repeat(cut[rows] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            text, x, v = np.repeat(np.arange(len(rows)), size), slots[pick], values[pick]
            score = np.bincount(text, w[x] * v, len(rows))
            edges = np.concatenate([[-np.inf], Model(w, first, steps).thresholds(), [np.inf]])
            y = grades[rows]
            up = 1 / (1 + np.exp(-np.clip(score - edges[y], -40, 40)))
            down = 1 / (1 + np.exp(-np.clip(score - edges[y + 1], -40, 40)))
            up, down = np.where(y == 0, 1.0, up), np.where(y == len(edges) - 2, 0.0, down)
            likely = np.maximum(up - down, 1e-9)
            by_score = -(1 - up - down)
            g = np.bincount(x, by_score[text] * v, len(w)) / len(rows) + PULL * w
            t = np.zeros(len(edges))
            np.add.at(t, y, up * (1 - up) / likely)
            np.add.at(t, y + 1, -down * (1 - down) / likely)
            t = t[1:-1] / len(rows)
            # The first threshold moves all of them, a step those behind it.
            by = np.concatenate([[t.sum()], [t[i + 1 :].sum() * np.exp(steps[i]) for i in range(len(steps))]])
            seen_w += g * g
            seen_t += by * by
            w -= rate * g / np.sqrt(seen_w)
            move = rate * by / np.sqrt(seen_t)
            first, steps = first - move[0], steps - move[1:]
    return Model(w, float(first), steps)


def _learn(model: Model, rate: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("slots", "ascending"), ("values", "ascending"), ("grade", "ascending")])
        slots = [np.frombuffer(x, "<i4") for x in table["slots"].to_pylist()]
        cut = np.concatenate([[0], np.cumsum([len(x) for x in slots])]).astype(np.int64)
        values = np.frombuffer(b"".join(table["values"].to_pylist()), "<f4").astype(np.float64)
        grades = table["grade"].to_numpy().astype(np.int64)
        got = improve(model, grades, cut, np.concatenate(slots).astype(np.int64), values, rate)
        return pa.table({
            "n": pa.array([len(grades)], pa.int64()), "weights": pa.array([got.weights.tobytes()], pa.binary()),
            "first": pa.array([got.first]), "steps": pa.array([got.steps.tobytes()], pa.binary())})

    return run


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def fit(docs: DataFrame, labels: DataFrame, grade: Column, n_grades: int, *, doc_id: str = "doc_id", text: str = "text") -> Model | None:
    """The model of ``grade``, whole numbers from 0, an expression over ``labels``; None without labelled rows."""
    marks = labels.select(labels[doc_id].cast("long").alias("id"), grade.cast("int").alias("grade")).dropna()
    marks = marks.where((fold(F.col("id")) != HELD_OUT) & F.col("grade").between(0, n_grades - 1))
    share = max(1, round(min(1.0, SAMPLE / max(marks.count(), 1)) * (1 << 20)))
    marks = marks.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share)
    # About SAMPLE rows of two numbers, whatever the size of the tables.
    marks = F.broadcast(marks.groupBy("id").agg(F.min("grade").alias("grade")))
    rows = docs.select(docs[doc_id].cast("long").alias("id"), docs[text].alias("text")).join(marks, "id")
    part = F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(PARTS)).cast("int").alias("part")
    rows = written(rows.select(part, "grade", "text").mapInArrow(
        _featured, "part int, grade int, slots binary, values binary"), "graded")
    if rows.isEmpty():
        return None
    counts = {r["grade"]: r["count"] for r in rows.groupBy("grade").count().collect()}
    above = [sum(c for g, c in counts.items() if g > k) / sum(counts.values()) for k in range(n_grades - 1)]
    at = np.array([-np.log(max(p, 1e-3) / max(1 - p, 1e-3)) for p in above])
    model = Model(np.zeros(2 * SLOTS + 1), float(at[0]), np.log(np.maximum(np.diff(at), 0.1)))
    for turn in range(ROUNDS):
        got = rows.groupBy("part").applyInArrow(
            _learn(model, RATE / (1 + turn)), "n long, weights binary, first double, steps binary").toArrow().to_pylist()
        share = np.array([g["n"] for g in got]) / sum(g["n"] for g in got)
        model = Model(
            sum(s * np.frombuffer(g["weights"]) for s, g in zip(share, got)), float(sum(s * g["first"] for s, g in zip(share, got))),
            sum(s * np.frombuffer(g["steps"]) for s, g in zip(share, got)))
    return model


def _grade(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = block.value
        for batch in batches:
            tails = [np.zeros((0, len(model.steps) + 1))]
            for _, raw, at in chunks(batch.column(1)):
                rows, slots, values = features(raw, at)
                tails.append(model.tails(np.bincount(rows, model.weights[slots] * values, len(at) - 1)))
            tails = np.concatenate(tails)
            yield pa.record_batch(
                [batch.column(0), pa.array(list(tails), pa.list_(pa.float64()))], names=["row", "tails"])

    return run


def graded(docs: DataFrame, model: Model | None, n_grades: int, keep: list[str], text: str = "text") -> DataFrame:
    """row (a struct of the columns in ``keep``), tails (P(grade > k)) and expected_grade for every row."""
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), docs[text].alias("text"))
    if model is None:
        out = rows.select("row", F.array_repeat(F.lit(0.0), n_grades - 1).alias("tails"))
    else:
        out = rows.mapInArrow(_grade(docs.sparkSession.sparkContext.broadcast(model)), T.StructType([
            T.StructField("row", rows.schema["row"].dataType), T.StructField("tails", T.ArrayType(T.DoubleType()))]))
    return out.withColumn("expected_grade", F.aggregate("tails", F.lit(0.0), lambda a, b: a + b))


def select(docs: DataFrame, model: Model | None, n_grades: int, least: int, probability: float) -> DataFrame:
    """The rows of ``docs`` that have grade ``least`` or more with at least that probability."""
    found = graded(docs, model, n_grades, docs.columns)
    return found.where(F.element_at("tails", least) >= probability).select("row.*")


def op8_cumulative_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades of all documents: 0 poor, 1 good but toxic, 2 good. Selected: grade 1 or more is likelier than not."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("toxic") == 0, 2)
    found = graded(docs, fit(docs, labels, grade, 3), 3, ["doc_id"])
    held = F.coalesce(fold(F.col("row.doc_id")) == HELD_OUT, F.lit(False)).alias("held_out")
    return found.select(
        "row.doc_id", held, "expected_grade", F.element_at("tails", 1).alias("at_least_1"),
        F.element_at("tails", 2).alias("at_least_2"), (F.element_at("tails", 1) >= 0.5).alias("selected"))
