"""The estimates of the toxicity models against a plain computation."""

import math
import random
import re
import zlib

import numpy as np
import pytest

from tallyrill.llm import toxicity as X
from tallyrill.llm.words import PUNCTUATION, hashes, mix, spans


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+".encode(), (text or "").lower().encode())


def key(word):
    raw = np.frombuffer(word, np.uint8)
    return hashes(raw, np.array([0]), np.array([len(raw)]))[0]


def kind(word):
    """The class of a preceding word; a text's first word has nothing before it."""
    return int(mix(np.array([0 if word is None else key(word)], np.uint64))[0] % np.uint64(X.CONTEXTS))


def expected(texts, toxic):
    """Difference of each word of ``toxic``'s texts (place: class), from counts made word by word."""
    counts = [{0: {}, 1: {}} for _ in X.LEVELS]
    before = [{} for _ in X.LEVELS]
    for i, text in enumerate(texts):
        words = words_of(text)
        for n, size in enumerate(X.LEVELS):
            for previous, w in zip([None, *words], words):
                before[n].setdefault(w[:size], set()).add(kind(previous))
            if i in toxic:
                own = counts[n][toxic[i]]
                for w in {w[:size] for w in words}:
                    own[w] = own.get(w, 0) + 1
    known = [set(c[0]) | set(c[1]) for c in counts]
    preceded = [{w: max(1.0, -X.CONTEXTS * math.log(1 - min(len(before[n][w]), X.CONTEXTS - 0.5) / X.CONTEXTS)) for w in known[n]}
                for n in range(len(X.LEVELS))]

    def probability(word, n, c):
        w, own = word[: X.LEVELS[n]], counts[n][c]
        total = sum(own.values())
        if n + 1 == len(X.LEVELS):
            lower = preceded[n][w] / sum(preceded[n].values())
        else:
            lower = probability(word, n + 1, c) * min(1, preceded[n][w] / preceded[n + 1][word[: X.LEVELS[n + 1]]])
        return max(own.get(w, 0) - X.DISCOUNT, 0) / total + X.DISCOUNT * len(own) / total * lower

    return {w: math.log(probability(w, 0, 1) / probability(w, 0, 0)) for w in known[0]}


def test_estimates_like_a_plain_computation(spark, docs):
    r = random.Random(6)
    words = [f"{a}{b}" for a in ("stein", "walde", "achlich", "é", "x") for b in ("", "er", "keiten", "ß", "1")]
    texts = [" ".join(r.choices(words[:15] if i % 3 else words[8:], k=r.randint(1, 25))) for i in range(240)]
    labels = {i: int(i % 3 == 0) for i in range(0, 240) if i % 4}
    frame = spark.createDataFrame([(i, 1, t) for i, t in labels.items()], "doc_id long, quality int, toxic int")
    model = X.fit(docs(list(enumerate(texts))).repartition(3), frame)
    held = {i: t for i, t in labels.items() if zlib.crc32(str(i).encode()) % X.FOLDS not in (X.HELD_OUT, X.CURVE)}
    want = expected(texts, held)
    assert len(want) == len(words) and len(model.keys[0]) == len(words)
    for word, difference in want.items():
        raw = np.frombuffer(word, np.uint8)
        start, end, _ = spans(raw, np.array([0, len(raw)]), PUNCTUATION)
        assert model.differences(X._levels(raw, start, end))[0] == pytest.approx(difference, abs=1e-4), word


def test_classes_of_preceding_words_tell_their_number():
    r = np.random.default_rng(1)
    for n in (1, 5, 60, 300):
        classes = [len(set(r.integers(0, X.CONTEXTS, n))) for _ in range(200)]
        assert abs(X.distinct(np.array(classes)).mean() - n) < 0.05 * n + 0.1
    assert np.isfinite(X.distinct(np.array([X.CONTEXTS]))).all()
