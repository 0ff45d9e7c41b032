import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyrill.llm import words as W

TEXT = st.text(alphabet="aAbB zZ9.\n\t,é ñ 日\x0b\x1c!_", max_size=60)


@given(st.lists(st.one_of(TEXT, st.none()), max_size=6))
@settings(max_examples=150, deadline=None)
def test_words_are_those_of_the_patterns(texts):
    raw, at = W.utf8(pa.array(texts, pa.string()))
    lower = [("" if t is None else t).translate({c: c + 32 for c in range(65, 91)}) for t in texts]
    for separator, pattern in ((W.SPACE, r"[^\x20\x09-\x0D]+"), (W.PUNCTUATION, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        start, end, place = W.spans(raw, at, separator)
        hashed = W.hashes(raw, start, end)
        seen = {}
        for i, t in enumerate(lower):
            want = re.findall(pattern, t)
            assert place[i + 1] - place[i] == len(want)
            for j, word in enumerate(want):
                a, b = start[place[i] + j], end[place[i] + j]
                assert raw[a:b].tobytes().lower() == word.encode()
                assert seen.setdefault(word, hashed[place[i] + j]) == hashed[place[i] + j]
        assert len(set(seen.values())) == len(seen)


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


@given(st.lists(TEXT, min_size=2, max_size=5))
@settings(max_examples=100, deadline=None)
def test_shingle_sets_overlap_as_the_words_do(texts):
    sets = dict(W.shingle_sets(pa.array(texts, pa.string()), 5))
    for a in range(len(texts)):
        for b in range(len(texts)):
            assert len(np.intersect1d(sets[a], sets[b])) == len(shingles(texts[a]) & shingles(texts[b]))


@pytest.mark.parametrize("limit", [1, 40])
def test_chunks_cover_sliced_arrays_and_long_texts(monkeypatch, limit):
    monkeypatch.setattr(W, "CHUNK_BYTES", limit)
    texts = pa.array(["skipped", "a b", None, "", "c " * 50, "dé"]).slice(1)
    got = [(first + i, raw[at[i] : at[i + 1]].tobytes().decode())
           for first, raw, at in W.chunks(texts) for i in range(len(at) - 1)]
    assert got == [(i, t or "") for i, t in enumerate(texts.to_pylist())]
