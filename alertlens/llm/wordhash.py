"""Words and word shingles of Arrow text columns as 64-bit hashes, in numpy.

A word's hash is a polynomial over its lower-cased bytes, taken for all words
at once from one running sum; a shingle's hash mixes the hashes of its words.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

_RATIO = np.uint64(0x9E3779B97F4A7C15)
#: texts are taken in slices of about so many bytes, one text at least
SLICE_BYTES = 1 << 17


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _byte_values() -> np.ndarray:
    b = np.arange(256, dtype=np.uint64)
    b[65:91] += np.uint64(32)
    return mix((b + np.uint64(1)) * _RATIO)


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64."""
    if len(_POWERS[0]) < n:
        size, base = 1 << (n - 1).bit_length(), 0x5851F42D4C957F2D
        for k, b in enumerate((base, pow(base, -1, 1 << 64))):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of slices of a text column; null is empty."""
    texts = pa.array(texts, pa.string()) if not isinstance(texts, pa.Array) else texts.cast(pa.string())
    texts = texts.fill_null("") if texts.null_count else texts
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset: texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1)
        yield first, data[offsets[first]: offsets[last]], offsets[first: last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, first byte of each word, number of words before each text and in all)."""
    inside = np.empty(len(data) + 1, bool)
    inside[:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
    inside[-1] = False
    begins, ends = inside[:-1].copy(), inside[:-1].copy()
    begins[1:] &= ~inside[:-2]
    ends &= ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    begins[cut] = inside[cut]
    ends[cut - 1] = inside[cut - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    up, down = _powers(len(data) + 1)
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_byte_values()[data] * up[: len(data)], dtype=np.uint64, out=run[1:])
    hashes = mix((run[end + 1] - run[start]) * down[start] + (end - start).astype(np.uint64) * _RATIO)
    return hashes, start, np.searchsorted(start, offsets)


def shingles(hashes: np.ndarray, at: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Distinct shingle hashes of each text: of `width` words, or of the whole text if it is shorter."""
    n = len(hashes)
    rolled = np.zeros(n, np.uint64)
    if n >= width:
        rolled = hashes[: n - width + 1].copy()
        for k in range(1, width):
            rolled = mix(rolled * _RATIO + hashes[k: n - width + 1 + k])
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= width:
            yield np.unique(rolled[a: b - width + 1])
        elif b > a:
            whole = np.uint64(b - a)
            for h in hashes[a:b]:
                whole = mix(np.array([whole * _RATIO + h + np.uint64(1)], np.uint64))[0]
            yield np.array([whole], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def text_shingles(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, distinct shingle hashes) of every text of a column, in order."""
    with np.errstate(over="ignore"):
        for first, data, offsets in slices(texts):
            hashes, _, at = words(data, offsets)
            yield from enumerate(shingles(hashes, at, width), first)
