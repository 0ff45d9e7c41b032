"""Words and word shingles of Arrow text batches as 64-bit hashes, without a Python step per word.

A word's hash is a polynomial in its bytes modulo 2**64, with random byte values and an odd
base; a shingle's hash mixes the hashes of its words in order. Two different sequences collide
with a chance of about 2**-60. Callers that must be exact compare texts or words afterwards, or
say what such a collision would change.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text hashed at once; a text longer than this is hashed alone.
CHUNK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_RNG = np.random.default_rng(20240501)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_MULTIPLIERS = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)

#: Byte classes: True where a byte separates words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: What [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ leaves out once A-Z are lower case.
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[0x00:0x30] = PUNCTUATION[0x3A:0x41] = PUNCTUATION[0x5B:0x61] = True
PUNCTUATION[0x7B:0x80] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_VALUE = _BYTE[_LOWER]


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POWER = _powers(CHUNK_BYTES + 1, _BASE)
_INVERSE = _powers(CHUNK_BYTES + 1, pow(_BASE, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column (null: empty) and the position at which each text begins, and the end."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def spans(raw: np.ndarray, at: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of each word, and the number of words before each text; no word crosses texts."""
    inside = ~separator[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = at[(at > 0) & (at < len(raw))]
    begins[cuts] = inside[cuts]
    start = np.flatnonzero(begins)
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[cuts - 1] = inside[cuts - 1]
    return start, np.flatnonzero(ends) + 1, np.searchsorted(start, at)


def hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, A-Z taken as lower case."""
    if not len(start):
        return np.zeros(0, np.uint64)
    n = len(raw)
    power, inverse = (_POWER, _INVERSE) if n < len(_POWER) else (
        _powers(n + 1, _BASE), _powers(n + 1, pow(_BASE, -1, 1 << 64)))
    value = _VALUE[raw]
    value *= power[:n]
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(value, out=total[1:])
    return mix((total[end] - total[start]) * inverse[start])


def chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts of about CHUNK_BYTES: the first text's place, the bytes, the positions."""
    raw, at = utf8(texts)
    first = 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + CHUNK_BYTES, "right")) - 1)
        yield first, raw[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of each run of k words, in order."""
    n = len(words) - k + 1
    out = np.zeros(max(n, 0), np.uint64)
    for i in range(k if n > 0 else 0):
        out += words[i : i + n] * _MULTIPLIERS[i]
    return mix(out)


def grams_at(words: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k words from each of some places."""
    out = np.zeros(len(at), np.uint64)
    for i in range(k):
        out += words[at + i] * _MULTIPLIERS[i]
    return mix(out)


def shingle_sets(texts: pa.Array, k: int, separator: np.ndarray = SPACE) -> Iterator[tuple[int, np.ndarray]]:
    """The place of each text with its sorted distinct k-word shingles; fewer words are one shingle, none are none."""
    for first, raw, at in chunks(texts):
        start, end, before = spans(raw, at, separator)
        words = hashes(raw, start, end)
        runs = grams(words, k)
        for i in range(len(at) - 1):
            a, b = before[i], before[i + 1]
            if b - a >= k:
                yield first + i, np.unique(runs[a : b - k + 1])
            elif b > a:
                short = words[a:b] * _MULTIPLIERS[: b - a]
                yield first + i, mix(np.array([short.sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64))
            else:
                yield first + i, np.zeros(0, np.uint64)
