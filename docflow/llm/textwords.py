"""Vectorised word hashing over Arrow text batches (numpy, inside Spark tasks).

Texts are handled as UTF-8 bytes. Every word of a block of documents gets a 64-bit hash
from one pass of prefix sums: a word's value is the sum of a random number per byte times
a power of an odd base, shifted back to the word's start, then mixed with its length.
Equal words have equal hashes in every task. Blocks hold a bounded number of bytes, so
the temporaries stay small however many rows a batch has; one long text is one block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20240917)).integers(1, 1 << 63, 256, dtype=np.uint64)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: letters, digits and every byte of a non-ASCII character
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
#: everything but space, tab, line feed, vertical tab, form feed, carriage return
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[32, 9, 10, 11, 12, 13]] = False

_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every bit of a 64-bit value over all bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = ((n >> 16) + 1) << 16
        _powers.clear()
        for base in (_BASE, _BASE_INV):
            steps = np.full(size, base & _MASK, dtype=np.uint64)
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers[0], _powers[1]


@dataclass
class Words:
    """Words of a block: hash, byte range, and for each document its first word's index."""

    hashes: np.ndarray  # uint64, one for each word
    begin: np.ndarray  # byte offsets in the block
    end: np.ndarray
    first: np.ndarray  # n_docs + 1: document i has words first[i]:first[i + 1]
    doc_begin: np.ndarray  # byte offset of each document in the block, n_docs + 1

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words_of(data: np.ndarray, doc_offsets: np.ndarray, word_bytes: np.ndarray) -> Words:
    """Words of the documents ``data[doc_offsets[i]:doc_offsets[i+1]]``, A-Z lower-cased."""
    data = _LOWER[data]
    n = len(data)
    inside = word_bytes[data]
    starts = inside.copy()
    ends = inside.copy()
    if n:
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cut = doc_offsets[(doc_offsets > 0) & (doc_offsets < n)]
        starts[cut] = inside[cut]
        ends[cut - 1] = inside[cut - 1]
    begin = np.flatnonzero(starts)
    end = np.flatnonzero(ends) + 1
    up, down = _power_tables(n + 1)
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_VALUES[data] * up[:n], out=sums[1:])
    value = (sums[end] - sums[begin]) * down[begin]
    hashes = mix(value ^ ((end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    first = np.searchsorted(begin, doc_offsets)
    return Words(hashes, begin, end, first, doc_offsets)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Rolling hash of every k consecutive words: position i covers words i .. i+k-1."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    step = np.uint64(0xA24BAED4963EE407)
    for j in range(k):
        out = out * step + hashes[j : j + n]
    return mix(out)


def hash_text(text: str, word_bytes: np.ndarray) -> np.ndarray:
    """Word hashes of one text (for templates, benchmark items and tests)."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    return words_of(raw, np.array([0, len(raw)]), word_bytes).hashes


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into blocks of about ``limit`` bytes.

    Yields (first row, row after the last, bytes, byte offset of each row and the end).
    A null text has no bytes. A text longer than the limit is a block of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offset_buf, data_buf = column.buffers()
    offsets = np.frombuffer(offset_buf, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.empty(0, dtype=np.uint8)
    row = 0
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        stop = min(max(stop, row + 1), n)
        yield row, stop, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop
