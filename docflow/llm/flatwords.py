"""Distinct words of Arrow text columns, and tables of lists kept in flat numpy arrays (inside Spark tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def text_parts(column: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text; a longer text is a range of its own, a null has no bytes."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    row, n = 0, len(size)
    while row < n:
        before = ends[row] - size[row]
        stop = max(row + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield row, stop
        row = stop


def split_column(texts: pa.Array, separator: str) -> tuple[np.ndarray, pa.Array]:
    """(first word of each row and the end, words) of a string column without nulls; an empty text is one empty word."""
    lists = pc.split_pattern(texts, separator)
    edges = lists.offsets.to_numpy().astype(np.int64)
    return edges - edges[0], lists.flatten()


def numbered(words: pa.Array) -> tuple[np.ndarray, list[str]]:
    """(number of each word, the distinct words)."""
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()


class FlatLists:
    """Lists of whole numbers in one array; list i is ``values[start[i]:start[i] + size[i]]``."""

    def __init__(self, dtype):
        self.values = np.empty(1 << 16, dtype=dtype)
        self.start = np.empty(1 << 14, dtype=np.int64)
        self.size = np.empty(1 << 14, dtype=np.int64)
        self.lists = self.used = 0

    @staticmethod
    def _room(array: np.ndarray, need: int) -> np.ndarray:
        if need <= len(array):
            return array
        grown = np.empty(max(need, len(array) * 3 // 2), dtype=array.dtype)
        grown[: len(array)] = array
        return grown

    def extend(self, values: np.ndarray, sizes: np.ndarray) -> None:
        """Append lists that stand one after another in ``values``."""
        n, m = len(sizes), len(values)
        self.values = self._room(self.values, self.used + m)
        self.start = self._room(self.start, self.lists + n)
        self.size = self._room(self.size, self.lists + n)
        self.values[self.used : self.used + m] = values
        self.size[self.lists : self.lists + n] = sizes
        self.start[self.lists : self.lists + n] = self.used + np.cumsum(sizes) - sizes
        self.used += m
        self.lists += n

    def gather(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values of the lists ``which`` one after another, their sizes)."""
        size = self.size[which]
        return self.values[spread(self.start[which], size)], size


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] numbers), start[1], ...: places of ranges one after another."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(start - (ends - size), size)


_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9], dtype=np.uint64)
_SHORT = 16  # bytes that the first eight and the last eight of a word hold
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1] * (_SHORT - 7), dtype=np.uint64)


class WordTable:
    """Words and a list of whole numbers for each, in flat arrays.

    A word of up to 16 bytes is known exactly by its length, its first eight and its last eight bytes, so a block of
    words is looked up by numpy in a table of hashed slots; longer words are kept in a dictionary.
    """

    def __init__(self, dtype):
        self.ids = FlatLists(dtype)
        self.slots = np.full(1 << 10, -1, dtype=np.int32)
        self.head, self.tail, self.size, self.uses = (np.zeros(1 << 10, dtype=t) for t in (np.uint64, np.uint64, np.uint8, np.int32))
        self.long: dict[bytes, int] = {}

    def __len__(self) -> int:
        return self.ids.lists

    def words(self) -> list[bytes]:
        """The words, in the order of their numbers."""
        long = {number: word for word, number in self.long.items()}
        out = []
        for n, (head, tail, size) in enumerate(zip(self.head[: len(self)].tolist(), self.tail.tolist(), self.size.tolist())):
            word = head.to_bytes(8, "little")
            out.append(long[n] if n in long else word[:size] if size <= 8 else word + tail.to_bytes(8, "little")[_SHORT - size :])
        return out

    @staticmethod
    def parts(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last eight bytes of words of up to 16; ``data`` goes on for eight bytes behind the last word."""
        eight = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))
        head = eight[begin] & _FIRST[size]
        tail = np.zeros(len(begin), dtype=np.uint64)
        on = np.flatnonzero(size > 8)
        tail[on] = eight[begin[on] + size[on] - 8]
        return head, tail

    def _slot(self, head: np.ndarray, tail: np.ndarray, size: np.ndarray) -> np.ndarray:
        x = head ^ (tail * _MIX[0]) ^ size.astype(np.uint64)
        x = (x ^ (x >> np.uint64(32))) * _MIX[1]
        return ((x ^ (x >> np.uint64(29))) * _MIX[0] >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def _find(self, head: np.ndarray, tail: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Number of each short word, -1 for an unknown one."""
        at = self._slot(head, tail, size)
        out = self.slots[at]
        left = np.flatnonzero((self.head[out] != head) | (self.tail[out] != tail) | (self.size[out] != size))
        left = left[out[left] >= 0]
        while len(left):
            at[left] = (at[left] + 1) & (len(self.slots) - 1)
            got = out[left] = self.slots[at[left]]
            left = left[(got >= 0) & ((self.head[got] != head[left]) | (self.tail[got] != tail[left]) | (self.size[got] != size[left]))]
        return out

    def _place(self, numbers: np.ndarray) -> None:
        """Put short words, all different and none known, into free slots."""
        at = self._slot(self.head[numbers], self.tail[numbers], self.size[numbers])
        while len(numbers):
            free = self.slots[at] < 0
            self.slots[at[free]] = numbers[free]  # of several the last one stays
            left = self.slots[at] != numbers
            numbers, at = numbers[left], (at[left] + 1) & (len(self.slots) - 1)

    def find(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Number of each word, -1 for an unknown one."""
        short = size <= _SHORT
        if short.all():
            return self._find(*self.parts(data, begin, size), size)
        out = np.empty(len(begin), dtype=np.int32)
        out[short] = self._find(*self.parts(data, begin[short], size[short]), size[short])
        raw, on = memoryview(data), ~short
        out[on] = [self.long.get(bytes(raw[a : a + n]), -1) for a, n in zip(begin[on].tolist(), size[on].tolist())]
        return out

    def add(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray, values: np.ndarray, sizes: np.ndarray) -> None:
        """Words that are not known, all different, each with its list; they are numbered in this order."""
        first, end = len(self), len(self) + len(begin)
        self.ids.extend(values, sizes)
        for name in ("head", "tail", "size", "uses"):
            setattr(self, name, FlatLists._room(getattr(self, name), end))
        short = np.flatnonzero(size <= _SHORT)
        self.head[first:end], self.tail[first:end], self.uses[first:end] = 0, 0, 0
        self.head[first + short], self.tail[first + short] = self.parts(data, begin[short], size[short])
        self.size[first:end] = np.minimum(size, 255)
        raw = memoryview(data)
        for k in np.flatnonzero(size > _SHORT).tolist():
            self.long[bytes(raw[begin[k] : begin[k] + size[k]])] = first + k
        if 2 * end > len(self.slots):
            self.slots = np.full(1 << (2 * end).bit_length(), -1, dtype=np.int32)
            self._place(np.flatnonzero(self.size[:end] <= _SHORT).astype(np.int32))
        else:
            self._place((first + short).astype(np.int32))

    def used(self, numbers: np.ndarray) -> None:
        """One more part of text holds these words."""
        seen = np.zeros(len(self), dtype=bool)
        seen[numbers] = True
        self.uses[: len(self)] += seen

    def forget(self, most: int, numbers: int) -> None:
        """Keep at most so many words and numbers: those in more parts of text than the others."""
        uses, lists = self.uses[: len(self)], self.ids.size[: len(self)]
        least = 2
        while True:
            keep = uses >= least
            if keep.sum() <= most and lists[keep].sum() <= numbers:
                break
            least *= 2
        which = np.flatnonzero(keep)
        new = np.cumsum(keep) - 1
        ids = FlatLists(self.ids.values.dtype)
        ids.extend(*self.ids.gather(which))
        self.ids, self.long = ids, {w: int(new[n]) for w, n in self.long.items() if keep[n]}
        self.head, self.tail, self.size, self.uses = (FlatLists._room(x[which], 1 << 10) for x in (self.head, self.tail, self.size, self.uses))
        self.slots = np.full(max(1 << 10, 1 << (2 * len(which)).bit_length()), -1, dtype=np.int32)
        self._place(np.flatnonzero(self.size[: len(which)] <= _SHORT).astype(np.int32))


def sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sum of values[edges[i]:edges[i + 1]] for every i (empty ranges: 0)."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[edges[1:]] - total[edges[:-1]]
