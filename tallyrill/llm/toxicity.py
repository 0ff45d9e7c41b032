"""Toxicity by class-conditional Kneser-Ney models of expressions.

An expression is a word ([^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+, A-Z in lower case); it backs off to its
first six bytes, these to the first four, and these to shared counts. Each level's estimate for a
class takes a fixed discount off the documents of the class that hold the expression, and gives what
is taken to the next level. How an expression's share is split below is told by shared backoff counts, the
continuation counts of Kneser-Ney: how many different words precede it in the whole corpus, labelled or not. They are
gathered as bits of CONTEXTS classes of preceding words, by hash, and corrected for words that share a class. An expression that a single
text holds has estimates of its own like any other. Expressions that neither class holds differ by a
constant only, whatever they are.

A text is described by its length-normalised difference of toxic and ordinary log-likelihood, by the
largest such difference of any RUN words in a row, and by its TOP largest ones; a logistic curve over
these, fitted on labelled rows that the counts don't hold, gives the score. Labels of at most about
SAMPLE rows are used, chosen by a hash of the id; counts over the corpus cover every text.

Nulls: a null or empty text has no words and gets the score of a text with a difference of nothing. A
null id is never held out. Rows of labels with a null are left out; of several labels the highest
counts. Repeated rows are scored alike. Very long texts are scored whole, in time proportional to their length. Without
labels of both classes every score is 0; an empty table of documents gives no rows. Other columns
stay as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrill.llm.store import tidy
from tallyrill.llm.words import PUNCTUATION, chunks, hashes, mix, spans

#: Labelled rows that are learned from, about; the fold that is never learned from.
SAMPLE = 24_000
FOLDS = 5
HELD_OUT = 0
#: The fold whose rows fit the curve; the others give the counts.
CURVE = 4
DISCOUNT = 0.75
#: Bytes of an expression at each level; the first is the whole.
LEVELS = (1 << 62, 6, 4)
#: Classes of preceding words, as bits.
CONTEXTS = 256
RUN = 24
TOP = 3


def _levels(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Each word's hash at each level. A short word is itself there, apart from longer ones that begin alike."""
    whole = hashes(raw, start, end)
    return [whole] + [np.where(end - start <= n, whole, hashes(raw, start, np.minimum(end, start + n)))
                      for n in LEVELS[1:]]


def _before(words: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The hash of the word before each one; 0 where a text begins."""
    out = np.zeros(len(words), np.uint64)
    out[1:] = words[:-1]
    out[place[:-1][place[:-1] < len(words)]] = 0
    return out


def _new(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Places of the first occurrence of each key in each text."""
    order = np.lexsort((keys, text))
    a, b = keys[order], text[order]
    first = np.ones(len(a), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order[first]


_COUNTED_DDL = "level int, hash long, parent long, ordinary int, toxic int"


def _summed(level: int, keys: np.ndarray, parents: np.ndarray, toxic: np.ndarray) -> pa.RecordBatch:
    keys, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    bad = np.bincount(inverse, toxic, len(keys)).astype(np.int32)
    good = (np.bincount(inverse, minlength=len(keys)) - bad).astype(np.int32)
    columns = [np.full(len(keys), level, np.int32), keys.view(np.int64), parents[first].view(np.int64), good, bad]
    return pa.record_batch([pa.array(c) for c in columns], names=["level", "hash", "parent", "ordinary", "toxic"])


def _count(batches: Iterator[pa.RecordBatch], most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """In how many texts of each class each expression occurs, with what it backs off to."""
    held: list[list[tuple]] = [[] for _ in range(len(LEVELS))]
    size = 0
    for batch in batches:
        toxic = batch.column(1).to_numpy(zero_copy_only=False)
        for base, raw, at in chunks(batch.column(0)):
            start, end, place = spans(raw, at, PUNCTUATION)
            text = np.repeat(np.arange(len(at) - 1), np.diff(place))
            levels = _levels(raw, start, end)
            for n, x in enumerate(levels):
                new = _new(x, text)
                parent = levels[n + 1][new] if n + 1 < len(LEVELS) else np.zeros(len(new), np.uint64)
                held[n].append((x[new], parent, toxic[base + text[new]]))
                size += len(new)
            if size > most:
                yield from (_summed(n, *(np.concatenate(c) for c in zip(*h))) for n, h in enumerate(held) if h)
                held, size = [[] for _ in range(len(LEVELS))], 0
    yield from (_summed(n, *(np.concatenate(c) for c in zip(*h))) for n, h in enumerate(held) if h)


@dataclass
class Model:
    """Per level the known expressions, sorted, and their difference of log probabilities."""

    keys: list[np.ndarray]
    values: list[np.ndarray] = field(default_factory=list)
    falls: list[float] = field(default_factory=list)
    curve: np.ndarray | None = None

    def differences(self, levels: list[np.ndarray]) -> np.ndarray:
        """Each word's difference, from the first level that knows it."""
        out = np.full(len(levels[0]), sum(self.falls))
        for n in range(len(levels) - 1, -1, -1):
            if len(self.keys[n]):
                at = np.minimum(np.searchsorted(self.keys[n], levels[n]), len(self.keys[n]) - 1)
                known = self.keys[n][at] == levels[n]
                out[known] = self.values[n][at[known]] + sum(self.falls[:n])
        return out


_BITS_DDL = "level int, place long, " + ", ".join(f"b{i} long" for i in range(CONTEXTS // 64))


def _contexts(block) -> object:
    """For each known expression the classes of words that precede it, as bits, per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = block.value
        bits = [np.zeros((len(k), CONTEXTS // 8), np.uint8) for k in keys]
        for batch in batches:
            for _, raw, at in chunks(batch.column(0)):
                start, end, place = spans(raw, at, PUNCTUATION)
                levels = _levels(raw, start, end)
                kinds = (mix(_before(levels[0], place)) % np.uint64(CONTEXTS)).astype(np.int64)
                for n, x in enumerate(levels):
                    if not len(keys[n]):
                        continue
                    p = np.minimum(np.searchsorted(keys[n], x), len(keys[n]) - 1)
                    known = keys[n][p] == x
                    seen = p[known] * CONTEXTS + kinds[known]
                    np.bitwise_or.at(bits[n].reshape(-1), seen >> 3, (1 << (seen & 7)).astype(np.uint8))
        for n, b in enumerate(bits):
            held = np.flatnonzero(b.any(axis=1))
            numbers = b[held].view("<i8")
            for a in range(0, len(held), 50_000):
                part = slice(a, a + 50_000)
                yield pa.record_batch(
                    [pa.array(np.full(len(held[part]), n, np.int32)), pa.array(held[part]),
                     *[pa.array(np.ascontiguousarray(numbers[part, i])) for i in range(numbers.shape[1])]],
                    names=["level", "place", *[f"b{i}" for i in range(numbers.shape[1])]])

    return run


def distinct(classes: np.ndarray) -> np.ndarray:
    """About how many different words leave so many of CONTEXTS classes occupied."""
    return -CONTEXTS * np.log(1 - np.minimum(classes, CONTEXTS - 0.5) / CONTEXTS)


def _scores(block) -> object:
    """A column function: features and score of texts."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = block.value
        for texts in batches:
            column = pa.array(texts, pa.string(), from_pandas=True)
            rows = np.concatenate([np.zeros((0, 3))] + [features(model, raw, at) for _, raw, at in chunks(column)])
            score = np.zeros(len(rows)) if model.curve is None else curve(model.curve, rows)
            yield pd.DataFrame({"mean": rows[:, 0], "run": rows[:, 1], "top": rows[:, 2], "score": score})

    return F.pandas_udf(tidy(run), "mean double, run double, top double, score double")


def features(model: Model, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    start, end, place = spans(raw, at, PUNCTUATION)
    d = model.differences(_levels(raw, start, end)) - sum(model.falls)
    total = np.concatenate([[0.0], np.cumsum(d)])
    out = np.zeros((len(at) - 1, 3))
    for t in range(len(at) - 1):
        a, b = place[t], place[t + 1]
        if b > a:
            n = min(RUN, b - a)
            runs = total[a + n : b + 1] - total[a : b + 1 - n]
            k = min(TOP, b - a)
            out[t] = (total[b] - total[a]) / (b - a), runs.max() / n, np.partition(d[a:b], b - a - k)[b - a - k :].sum() / TOP
    return out


def _design(rows: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(rows)), rows])


def curve(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_design(rows) @ weights, -40, 40)))


def fit_curve(rows: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method, with a small pull towards nothing."""
    x, w = _design(rows), np.zeros(rows.shape[1] + 1)
    pull = np.diag([1e-6] + [1e-2] * rows.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + pull, x.T @ (toxic - p) - pull @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


BOTH = ("ordinary", "toxic")


def estimate(table: list[dict], shared: list[np.ndarray], totals: dict) -> tuple[list[np.ndarray], list[float]]:
    """Differences of log probabilities, level by level from the last, and what each fall to the next adds.

    ``table`` has hash, parent, ordinary and toxic of each level's expressions, ``shared`` how many words precede
    them, and ``totals`` the sum of counts and the number of expressions of each level and class.
    """
    values: list[np.ndarray] = [np.zeros(0)] * len(table)
    falls = [0.0] * len(table)
    below = np.zeros(0, np.uint64)
    probability: dict[str, np.ndarray] = {}
    for n in range(len(table) - 1, -1, -1):
        rows, share = table[n], np.maximum(shared[n], 1)
        parts = []
        for c in BOTH:
            total, kinds = totals[n, c]
            fall = DISCOUNT * kinds / max(total, 1)
            lower = share / max(share.sum(), 1)
            if n + 1 < len(table):  # every expression's parent is known one level below
                at = np.searchsorted(below, rows["parent"])
                lower = probability[c][at] * np.minimum(1, share / np.maximum(shared[n + 1], 1)[at])
            parts.append((c, np.maximum(rows[c] - DISCOUNT, 0) / max(total, 1) + fall * lower, max(fall, 1e-12)))
        probability = {c: p for c, p, _ in parts}
        values[n] = np.log(probability["toxic"]) - np.log(probability["ordinary"])
        fall = {c: f for c, _, f in parts}
        falls[n] = float(np.log(fall["toxic"]) - np.log(fall["ordinary"]))
        below = rows["hash"]
    return values, falls


def fold(doc_id) -> object:
    return F.crc32(doc_id.cast("string")) % FOLDS


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model | None:
    """The model, small enough for every task; None without labelled rows of both classes."""
    sc = docs.sparkSession.sparkContext
    marks = labels.select(labels[doc_id].cast("long").alias("id"), labels[label].cast("int").alias("toxic")).dropna()
    marks = marks.where(fold(F.col("id")) != HELD_OUT)
    n = marks.count()
    share = max(1, round(min(1.0, SAMPLE / max(n, 1)) * (1 << 20)))
    marks = marks.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share)
    # About SAMPLE rows of two numbers, whatever the size of the tables.
    marks = F.broadcast(marks.groupBy("id").agg(F.least(F.max("toxic"), F.lit(1)).alias("toxic")))
    rows = docs.select(docs[doc_id].cast("long").alias("id"), docs[text].alias("text")).join(marks, "id")

    counted = rows.where(fold(F.col("id")) != CURVE).select("text", "toxic").mapInArrow(tidy(_count), _COUNTED_DDL)
    counted = counted.groupBy("level", "hash").agg(
        F.max("parent").alias("parent"), *[F.sum(c).cast("int").alias(c) for c in BOTH])
    counted = counted.cache()
    sums = counted.groupBy("level").agg(
        *[F.sum(c).alias(c) for c in BOTH], *[F.count_if(F.col(c) > 0).alias(f"{c}_kinds") for c in BOTH]).collect()
    totals = {(r["level"], c): (r[c], r[f"{c}_kinds"]) for r in sums for c in BOTH}
    known = counted.toArrow()
    counted.unpersist()
    if not all(totals.get((0, c), (0, 0))[0] for c in BOTH):
        return None

    table = []
    for level in range(len(LEVELS)):
        part = known.filter(pa.compute.equal(known["level"], level))
        order = np.argsort(part["hash"].to_numpy().view(np.uint64))
        table.append({c: part[c].to_numpy()[order] for c in known.column_names})
        table[-1] |= {c: table[-1][c].view(np.uint64) for c in ("hash", "parent")}
    del known
    model = Model([t["hash"] for t in table])
    keys = sc.broadcast(model.keys)
    # The classes that precede an expression anywhere come together as bits; the driver gets a number for each known one.
    seen = docs.select(docs[text].alias("text")).mapInArrow(tidy(_contexts(keys)), _BITS_DDL)
    numbers = [f"b{i}" for i in range(CONTEXTS // 64)]
    seen = seen.groupBy("level", "place").agg(*[F.bit_or(c).alias(c) for c in numbers])
    seen = seen.select("level", "place", sum((F.bit_count(c) for c in numbers), F.lit(0)).cast("int").alias("n")).toArrow()
    shared = [np.zeros(len(k)) for k in model.keys]
    for level, own in enumerate(shared):
        part = seen.filter(pa.compute.equal(seen["level"], level))
        own[part["place"].to_numpy()] = distinct(part["n"].to_numpy())
    keys.unpersist()
    values, model.falls = estimate(table, shared, totals)
    model.values = [v.astype(np.float32) for v in values]
    del table, shared, seen

    marked = rows.where(fold(F.col("id")) == CURVE).select("toxic", "text")
    block = sc.broadcast(model)
    seen = marked.select(F.col("toxic").alias("row"), _scores(block)("text").alias("of")).select("row", "of.*")
    seen = seen.orderBy("row", "mean", "run", "top").toArrow().to_pandas()
    block.unpersist()
    if seen["row"].nunique() < 2:
        return None
    model.curve = fit_curve(seen[["mean", "run", "top"]].to_numpy(), seen["row"].to_numpy(float))
    return model


def score(docs: DataFrame, model: Model | None, keep: list[str], text: str = "text") -> DataFrame:
    """row (a struct of the columns in ``keep``), score and predicted for every row."""
    row = F.struct(*[docs[c] for c in keep]).alias("row")
    if model is None:
        return docs.select(row, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    # Only the text goes to Python and only numbers come back.
    of = _scores(docs.sparkSession.sparkContext.broadcast(model))(docs[text])["score"]
    out = docs.select(row, of.alias("score"))
    return out.select("row", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_ordinary(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not toxic."""
    return score(docs, fit(docs, labels), docs.columns).where("predicted = 0").select("row.*")


def op5_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held = F.coalesce(fold(F.col("row.doc_id")) == HELD_OUT, F.lit(False)).alias("held_out")
    return score(docs, model, ["doc_id"]).select("row.doc_id", held, "score", "predicted")
