"""Word and shingle hashes of whole texts, over Arrow columns.

Words are runs of bytes other than ASCII white space, with A-Z in lower case. A word's hash is
a polynomial of its bytes, taken for all words of a block of texts at once: each byte times a
power of its place in the block, summed per word, times the inverse power of the word's start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20  # bytes of text hashed at once; a longer text is a block of its own
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUE = np.arange(1, 257, dtype=np.uint64)
_VALUE[65:91] += 32
_VALUE[_SPACE] = 0


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLES = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(BLOCK, n)
    if size not in _TABLES:
        if size > BLOCK:
            return _powers(_BASE, size), _powers(_INVERSE, size)
        _TABLES[size] = _powers(_BASE, size), _powers(_INVERSE, size)
    return _TABLES[size]


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of the rows) of blocks of a string column; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + BLOCK, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a block, and where each text's words begin (one entry more than texts)."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    space = _SPACE[data]
    start = ~space
    start[1:] &= space[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    start[heads] = ~space[heads]
    starts = np.flatnonzero(start)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    powers, inverses = _tables(len(data))
    sums = np.add.reduceat(_VALUE[data] * powers[: len(data)], starts)
    return mixed(sums * inverses[starts]), np.searchsorted(starts, offsets)


_FACTORS = _powers(0xD1342543DE82EF95, 16)


def joined(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words, by its first word."""
    total = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        total += words[i : len(words) - n + 1 + i] * _FACTORS[i]
    return mixed(total)


def text_shingles(words: np.ndarray, n: int = 5) -> np.ndarray:
    """The distinct shingles of one text, sorted; fewer than ``n`` words are one shingle."""
    if not len(words):
        return words
    return np.unique(joined(words, n)) if len(words) >= n else joined(words, len(words)) + np.uint64(len(words))
