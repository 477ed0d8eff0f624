"""Benchmark decontamination with an FM-index over each shard of training text.

A shard is a bounded block of documents inside a task. Its words become symbols of the
benchmark's vocabulary; a run of words that no benchmark item has, and a document's end, is one
separator, which no search crosses. The shard's suffixes are sorted, their preceding symbols
(the Burrows-Wheeler string) go into a wavelet matrix, and all test windows are searched
backwards at once by its ranks. Occurrences are located through sampled suffix positions: a walk
to the preceding suffix ends at the next sample. Spans that overlap or touch are merged.

A benchmark of at most ``ITEM_BYTES`` of text and ids is one broadcast. The windows of a larger one
are made by tasks in blocks of ``ITEM_BYTES`` and written to the shared folder (one that pyarrow
reads: a mounted folder, HDFS or an object store); each shard is searched for one block after another,
read when its turn comes and not kept, so neither the driver nor a worker holds the whole. Words
are compared by 64-bit hashes.

Defined results: a null or empty text has no words and stays as it is; an item without words has
no window; items that share an id are one item; a null item id counts as the empty string;
repeated documents are judged each; an empty table on either side is allowed; other columns are
passed over, whatever their names.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from docflow.llm.common import read_documents, read_table
from docflow.llm.textwords import ALNUM, hash_text, text_blocks, words_of
from docflow.session import scratch_path

WINDOW = 10
SHARD_BYTES = 2 << 20
ITEM_BYTES = 16 << 20
SAMPLE = 16


@dataclass
class Windows:
    """Distinct windows of a block of items: symbols (0 pads short ones at the end), lengths, and the items of each."""

    vocabulary: np.ndarray
    symbols: np.ndarray
    length: np.ndarray
    item_first: np.ndarray
    items: np.ndarray
    item_ids: list[str]


def windows_of(items: list[tuple[str, str]], width: int = WINDOW) -> Windows:
    hashed = [hash_text(text or "", ALNUM) for _, text in items]
    vocabulary = np.unique(np.concatenate(hashed)) if hashed else np.empty(0, dtype=np.uint64)
    rows, owner = [], []
    for number, words in enumerate(hashed):
        if not len(words):
            continue
        s = np.searchsorted(vocabulary, words) + 1
        if len(s) <= width:
            block = np.zeros((1, width), dtype=np.int64)
            block[0, : len(s)] = s
        else:
            block = np.lib.stride_tricks.sliding_window_view(s, width)
        rows.append(block)
        owner.append(np.full(len(block), number))
    ids = [i or "" for i, _ in items]
    if not rows:
        return Windows(vocabulary, np.empty((0, width), dtype=np.int64), np.empty(0, dtype=np.int64), np.zeros(1, dtype=np.int64), np.empty(0, dtype=np.int64), ids)
    distinct, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
    which, owner = which.ravel(), np.concatenate(owner)
    order = np.argsort(which, kind="stable")
    first = np.searchsorted(which[order], np.arange(len(distinct) + 1))
    return Windows(vocabulary, distinct, (distinct > 0).sum(axis=1), first, owner[order], ids)


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Sorted suffixes of ``s``, which ends with a separator (0); separators differ from each other, in order of place.

    Prefix doubling: a suffix's rank is the first place of its group, and only groups with
    several suffixes are sorted again.
    """
    n = len(s)
    zero = np.flatnonzero(s == 0)
    start = np.searchsorted(np.sort(s), s)  # first place of each symbol's group
    rank = start.astype(np.int64)
    rank[zero] = np.arange(len(zero))
    tied = np.flatnonzero(s != 0)
    h = 1
    while len(tied):
        key = rank[tied] * n + rank[tied + h]
        order = np.argsort(key, kind="stable")
        tied, key = tied[order], key[order]
        old = rank[tied]
        new_group = np.r_[True, old[1:] != old[:-1]]
        new_key = np.r_[True, key[1:] != key[:-1]]
        at = np.arange(len(tied))
        fresh = old + np.maximum.accumulate(np.where(new_key, at, 0)) - np.maximum.accumulate(np.where(new_group, at, 0))
        rank[tied] = fresh
        alone = new_key & np.r_[new_key[1:], True]
        tied = tied[~alone]
        h *= 2
    out = np.empty(n, dtype=np.int64)
    out[rank] = np.arange(n)
    return out


class Wavelet:
    """Wavelet matrix: rank of a symbol before a place, for arrays of symbols and places."""

    def __init__(self, seq: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols).bit_length())
        self.ones, self.zeros = [], []
        for level in reversed(range(self.levels)):
            bit = (seq >> level) & 1
            ones = np.zeros(len(seq) + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(seq) - int(ones[-1]))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        lo, hi = np.zeros_like(place), place
        for level, ones, zeros in zip(reversed(range(self.levels)), self.ones, self.zeros):
            bit = ((symbol >> level) & 1).astype(bool)
            lo1, hi1 = ones[lo], ones[hi]
            lo = np.where(bit, zeros + lo1, lo - lo1)
            hi = np.where(bit, zeros + hi1, hi - hi1)
        return hi - lo


class FMIndex:
    def __init__(self, s: np.ndarray, symbols: int):
        order = suffix_array(s)
        before = s[order - 1]  # of place 0: the last separator
        self.before = before
        self.tree = Wavelet(before, symbols)
        self.count = np.searchsorted(np.sort(s), np.arange(symbols + 2))
        # a sample at every SAMPLE-th place and behind every separator, which the walk can't cross
        sampled = (order % SAMPLE == 0) | (before == 0)
        self.sample_rank = np.r_[0, np.cumsum(sampled)]
        self.samples = order[sampled].astype(np.int32)
        self.sampled = sampled

    def search(self, symbols: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix range of every window, searched from its last symbol to its first."""
        lo, hi = np.zeros(len(symbols), dtype=np.int64), np.zeros(len(symbols), dtype=np.int64)
        last = symbols[np.arange(len(symbols)), length - 1]
        lo[:], hi[:] = self.count[last], self.count[last + 1]
        live = np.flatnonzero(lo < hi)
        for step in range(2, int(length.max(initial=0)) + 1):
            live = live[lo[live] < hi[live]]
            on = live[length[live] >= step]
            if not len(on):
                break
            c = symbols[on, length[on] - step]
            lo[on] = self.count[c] + self.tree.rank(c, lo[on])
            hi[on] = self.count[c] + self.tree.rank(c, hi[on])
        return lo, np.maximum(lo, hi)

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Place in the shard of every suffix row."""
        row, steps = row.copy(), np.zeros(len(row), dtype=np.int64)
        walking = np.flatnonzero(~self.sampled[row])
        while len(walking):
            r = row[walking]
            c = self.before[r]
            row[walking] = self.count[c] + self.tree.rank(c, r)
            steps[walking] += 1
            walking = walking[~self.sampled[row[walking]]]
        return self.samples[self.sample_rank[row]] + steps


def shard_symbols(hashes: np.ndarray, first: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of a shard with separators, and for each the index of its word (-1 for separators)."""
    if not len(vocabulary) or not len(hashes):
        return np.zeros(1, dtype=np.int64), np.full(1, -1)
    at = np.searchsorted(vocabulary, hashes)
    at[at == len(vocabulary)] = 0
    known = np.flatnonzero(vocabulary[at] == hashes)
    doc = np.searchsorted(first, known, side="right")
    cut = np.flatnonzero((np.diff(known) > 1) | (np.diff(doc) > 0)) + 1
    cut = np.r_[cut, len(known)]
    return np.insert(at[known] + 1, cut, 0), np.insert(known, cut, -1)


def find(hashes: np.ndarray, first: np.ndarray, blocks: Iterator[Windows]) -> tuple[np.ndarray, dict[int, set[str]]]:
    """Hit words of a shard, and the item ids found in each document (by its number in the shard)."""
    edge = np.zeros(len(hashes) + 1, dtype=np.int64)
    items: dict[int, set[str]] = {}
    for w in blocks:
        s, word = shard_symbols(hashes, first, w.vocabulary)
        if not len(w.symbols) or len(s) < 2:
            continue
        index = FMIndex(s, len(w.vocabulary))
        lo, hi = index.search(w.symbols, w.length)
        sizes = hi - lo
        window = np.repeat(np.arange(len(sizes)), sizes)
        if not len(window):
            continue
        rows = np.arange(len(window)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + lo[window]
        place = word[index.locate(rows)]
        np.add.at(edge, place, 1)
        np.add.at(edge, place + w.length[window], -1)
        doc = np.searchsorted(first, place, side="right") - 1
        for d, k in np.unique(np.column_stack([doc, window]), axis=0).tolist():
            own = items.setdefault(d, set())
            own.update(w.item_ids[i] for i in w.items[w.item_first[k] : w.item_first[k + 1]])
    return np.cumsum(edge[:-1]) > 0, items


def without_spans(raw: bytes, begin: np.ndarray, end: np.ndarray, hit: np.ndarray) -> str:
    """A text without its runs of hit words (the white space and punctuation around a run stays)."""
    edges = np.flatnonzero(np.diff(np.r_[0, hit.view(np.int8), 0]))
    parts, at = [], 0
    for lo, hi in zip(edges[::2], edges[1::2]):
        parts.append(raw[at : begin[lo]])
        at = end[hi - 1]
    parts.append(raw[at:])
    return b"".join(parts).decode("utf-8", "surrogatepass")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a file in the shared folder (a plain path, or a URI of a store that pyarrow reads)."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def item_blocks(benchmark: DataFrame, width: int = WINDOW, limit: int | None = None) -> tuple[list, list[str]]:
    """The windows of the benchmark: one broadcast if it fits one block, otherwise files in the shared folder.

    Tasks make the files, so the driver sees their paths only. A task that runs again writes
    files of other names, and only those of the run that counted are listed.
    """
    limit = limit or ITEM_BYTES
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").filter(F.octet_length("text") > 0)
    size = items.agg(F.sum(F.octet_length("text") + F.coalesce(F.octet_length("item_id"), F.lit(0)))).first()[0] or 0
    if size <= limit:
        return [spark.sparkContext.broadcast(windows_of([tuple(r) for r in items.collect()], width))], []
    root = scratch_path(spark, "benchmark_windows")

    def store(block: list[tuple[str, str]]) -> pa.RecordBatch:
        path = f"{root}/{uuid.uuid4().hex}"
        system, inner = _open(path)
        system.create_dir(inner.rpartition("/")[0], recursive=True)
        with system.open_output_stream(inner) as out:
            out.write(pickle.dumps(windows_of(block, width), protocol=5))
        return pa.RecordBatch.from_arrays([pa.array([path])], names=["path"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = [], 0
        for batch in batches:
            for item in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if block and size + len(item[1]) > limit:
                    yield store(block)
                    block, size = [], 0
                block.append(item)
                size += len(item[1])
        if block:
            yield store(block)

    blocks = -(-size // limit)
    return [], sorted(r[0] for r in items.coalesce(blocks).mapInArrow(run, "path string").collect())


def read_blocks(shared: list, paths: list[str]) -> Iterator[Windows]:
    """The blocks one after another; those in files are read each time and not kept."""
    yield from (b.value for b in shared)
    for path in paths:
        system, inner = _open(path)
        with system.open_input_stream(inner) as source:
            yield pickle.loads(source.read())


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, keep_text: bool = False) -> DataFrame:
    """One row for each document: n_words, n_hit, n_items, items_sha256, contaminated.

    With ``keep_text`` the input's columns come first (but for those of the new names), ``text`` without
    the merged spans of hit words.
    """
    shared, paths = item_blocks(benchmark, width)
    new = [StructField("n_words", LongType()), StructField("n_hit", LongType()), StructField("n_items", LongType()), StructField("items_sha256", StringType()), StructField("contaminated", BooleanType())]
    source = docs.drop(*[f.name for f in new]) if keep_text else docs.select("doc_id", "text")
    at = source.columns.index("text")
    kept = [f for f in source.schema.fields if keep_text or f.name == "doc_id"]
    schema = StructType([*kept, *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(at), SHARD_BYTES):
                w = words_of(data, offsets, ALNUM)
                hit, items = find(w.hashes, w.first, read_blocks(shared, paths))
                hits = np.r_[0, np.cumsum(hit)]
                n_hit = hits[w.first[1:]] - hits[w.first[:-1]]
                found = [sorted(items.get(i, ())) for i in range(hi - lo)]
                part = batch.slice(lo, hi - lo)
                if keep_text:
                    columns = list(part.columns)
                    if n_hit.any():
                        texts = columns[at].to_pylist()
                        for i in np.flatnonzero(n_hit).tolist():
                            a, b = w.first[i], w.first[i + 1]
                            base = offsets[i]
                            texts[i] = without_spans(data[base : offsets[i + 1]].tobytes(), w.begin[a:b] - base, w.end[a:b] - base, hit[a:b])
                        columns[at] = pa.array(texts, columns[at].type)
                else:
                    columns = [part.column(0)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *columns, pa.array(np.diff(w.first), pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in found], pa.int64()),
                        pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in found]), pa.array(n_hit > 0),
                    ],
                    names=schema.names,
                )

    return source.mapInArrow(run, schema)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    return decontaminate(read_documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
