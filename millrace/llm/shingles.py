"""Vectorised word shingles straight from Arrow's text buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_CODE = np.zeros(256, np.uint64)
for _c in b"0123456789_abcdefghijklmnopqrstuvwxyz":
    _CODE[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _CODE[_c] = _c + 32
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
BLOCK = 1 << 20
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * _STEP[0]
    x = (x ^ (x >> np.uint64(27))) * _STEP[1]
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > BLOCK + (1 << 16):
        return _power(_BASE, n), _power(_INV, n)
    if not _POWERS:
        _POWERS["up"], _POWERS["down"] = _power(_BASE, BLOCK + (1 << 16)), _power(_INV, BLOCK + (1 << 16))
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _power(b: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, b, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def blocks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of the rows' texts) for runs of rows of about BLOCK bytes; nulls count as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK, "right")) - 1)
        yield i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word (maximal run of ASCII letters, digits and underscores, in lower case)."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    code = _CODE[data]
    is_word = code > 0
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    first = first[:-1]
    start = is_word.copy()
    start[1:] &= ~is_word[:-1] | first[1:]
    end = is_word.copy()
    end[:-1] &= ~is_word[1:] | first[1:]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    up, down = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(code * up, out=sums[1:])
    h = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * _STEP[2])
    return h, np.searchsorted(offsets, s, "right") - 1


def shingle_sets(texts: pa.Array, width: int, least_words: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row, words, sorted distinct hashes of its runs of ``width`` words) of each row with enough words."""
    for at, data, offsets in blocks(texts):
        h, row = word_hashes(data, offsets)
        rows = len(offsets) - 1
        counts = np.bincount(row, minlength=rows)
        ends = np.cumsum(counts)
        if len(h) < width:
            continue
        sh = np.zeros(len(h) - width + 1, np.uint64)
        for k in range(width):
            sh += h[k : len(h) - width + 1 + k] * _STEP[k % 5] * np.uint64(2 * (k // 5) + 1)
        sh = mix(sh)
        for r in np.flatnonzero(counts >= max(least_words, width)):
            yield at + int(r), int(counts[r]), np.unique(sh[ends[r] - counts[r] : ends[r] - width + 1])
