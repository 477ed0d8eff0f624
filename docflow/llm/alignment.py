"""Alignment of two tokenizers over a corpus, by coalescing the byte intervals of their tokens.

The tokens of both tokenizers are intervals of the same bytes (a space, then the text). All
intervals are sorted by start; a group ends where a start reaches the running maximum of the ends,
so tokens that overlap share a group. Every A-B pair in a group is a link.

Neither tokenizer merges across a space between two words (A cuts there, and no piece of B holds a
space behind another character), nor across one line feed between words. So a text is a sequence of
units, one for each word, and only distinct units reach the tokenizers, many at a time. Texts with
other white space are cut by a stricter rule, into longer units. The tokens' bytes are held
against the unit's bytes; a text with a unit that differs has no tokens.

A block is about ``BLOCK_BYTES`` of text. Its documents leave the first pass with numbers of
units, and the block with its distinct id pairs and how many of its documents hold each, so what
is counted and joined corpus-wide is a row for each block and pair, not for each link.
The counts return to their block, which sums them for each unit and then for each document.

Defined results: a null or empty text, or one whose tokens' bytes differ, has zeros and ''; a
repeated row is another document; a null doc_id stays null; an empty table gives no rows; other
columns are never read, whatever their names. A text is held whole by one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from docflow.llm.common import read_documents
from docflow.llm.flatwords import FlatLists, numbered, split_column, spread, sums, text_parts
from docflow.session import scratch_path

BLOCK_BYTES = 1 << 23
#: Units that a worker remembers, and bytes of text given to a tokenizer at once.
REMEMBERED = 300_000
LESSON_BYTES = 1 << 16
#: Links made at once while pairs are counted.
LINKS_AT_ONCE = 1 << 20

_SHIFT = 32
_CUT = re.compile(r"(?<! )(?= \S)")
#: First bytes of a word that surely is no white space.
_OPENS = np.zeros(256, dtype=bool)
_OPENS[0x21:0x7F] = _OPENS[0x80:] = True
_OPENS[[0xC2, 0xE1, 0xE2, 0xE3]] = False


def byte_of_symbol() -> dict[str, int]:
    """Byte of every symbol of a byte-level vocabulary: printable Latin-1 stands for itself, other bytes for 256 and up."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """Tokenizer A: ids and the bytes of each id."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = True
        table = byte_of_symbol()
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.bytes = [b""] * self.tokenizer.get_vocab_size()
        for token, k in self.tokenizer.get_vocab().items():
            self.bytes[k] = token.encode() if token in special else bytes(map(table.__getitem__, token))

    def ids(self, text: str) -> list[int]:
        """Ids of a text that begins with its space."""
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids


class Pieces:
    """Tokenizer B: ids and the bytes of each id."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=model)
        self.bytes = []
        for k in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(k)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(k) else piece.replace("▁", " ").encode())

    def ids(self, text: str) -> list[int]:
        """Ids of a text that begins with its space, which the tokenizer adds itself."""
        return self.model.encode(text[1:], num_threads=1)


def coalesce(ends_a: np.ndarray, ends_b: np.ndarray, begin_a: np.ndarray, begin_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of every A and every B interval: groups break where a start reaches the running maximum of the ends."""
    start, end = np.concatenate([begin_a, begin_b]), np.concatenate([ends_a, ends_b])
    kind = np.repeat(np.array([0, 1]), [len(ends_a), len(ends_b)])
    order = np.lexsort((kind, start))
    reach = np.maximum.accumulate(end[order])
    fresh = np.r_[True, start[order][1:] >= reach[:-1]] if len(order) else np.empty(0, dtype=bool)
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(fresh) - 1
    return group[: len(ends_a)], group[len(ends_a) :]


def runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first of each run of equal keys in that order); the last key sorts first."""
    order = np.lexsort(keys)
    fresh = np.zeros(len(order), dtype=bool)
    if len(order):
        fresh[0] = True
        for k in keys:
            fresh[1:] |= np.diff(k[order]) != 0
    return order, np.flatnonzero(fresh)


def linked_pairs(ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, owner_a: np.ndarray, groups: int) -> tuple[np.ndarray, ...]:
    """(owner, pair, links) of the distinct id pairs of each owner, in order of owner and pair."""
    n_b = np.bincount(group_b, minlength=groups)
    first_b = np.cumsum(n_b) - n_b
    made = np.cumsum(n_b[group_a])
    found, lo = [], 0
    while lo < len(ids_a):
        hi = max(lo + 1, int(np.searchsorted(made, (made[lo - 1] if lo else 0) + LINKS_AT_ONCE, side="right")))
        g = group_a[lo:hi]
        pair = (np.repeat(ids_a[lo:hi], n_b[g]) << _SHIFT) | ids_b[spread(first_b[g], n_b[g])]
        owner = np.repeat(owner_a[lo:hi], n_b[g])
        order, first = runs(pair, owner)
        found.append((owner[order][first], pair[order][first], np.diff(np.r_[first, len(order)])))
        lo = hi
    if not found:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(3))
    owner, pair, links = (np.concatenate(x) for x in zip(*found))
    order, first = runs(pair, owner)
    return owner[order][first], pair[order][first], np.add.reduceat(links[order], first)


class Units:
    """Aligned units: token, group and link counts, group text and distinct pairs of each."""

    def __init__(self, tokenizer_json: str, model: bytes):
        self.a, self.b = ByteLevel(tokenizer_json), Pieces(model)
        self.len_a, self.len_b = (np.array([len(x) for x in t.bytes], dtype=np.int64) for t in (self.a, self.b))
        self.decimal = np.array([str(k) for k in range(max(len(self.len_a), len(self.len_b)))], dtype=object)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.text: list[str] = []
        self.counts = FlatLists(np.int64)  # n_a, n_b, n_groups, n_links, bad
        self.pairs, self.links = FlatLists(np.int64), FlatLists(np.int64)

    def numbers(self, keys: list[str]) -> np.ndarray:
        new = [k for k in keys if k not in self.number]
        if new:
            if len(self.number) + len(new) > REMEMBERED and self.number:
                self.forget()
                new = keys
            self._learn(new)
        return np.fromiter(map(self.number.__getitem__, keys), dtype=np.int64, count=len(keys))

    def _learn(self, keys: list[str]) -> None:
        alone, lesson, size = [], [], 0
        for k in keys:
            if k[-1].isspace() or k[0] == " " or (k[0] == "\n" and (len(k) < 2 or k[1].isspace())):
                alone.append(k)
                continue
            lesson.append(k)
            size += len(k) + 1
            if size >= LESSON_BYTES:
                self._lesson(lesson)
                lesson, size = [], 0
        self._lesson(lesson)
        for k in alone:
            self._one(k)

    def _lesson(self, keys: list[str]) -> None:
        """Units one after another in one text, behind a first word that is dropped again."""
        if not keys:
            return
        lead = " a"
        units = [lead, *(k if k[0] == "\n" else " " + k for k in keys)]
        raw = [u.encode("utf-8", "surrogatepass") for u in units]
        edges = np.cumsum([len(r) for r in raw])
        whole, text = b"".join(raw), "".join(units)
        ids = [np.array(t.ids(text), dtype=np.int64) for t in (self.a, self.b)]
        same = all(b"".join(map(t.bytes.__getitem__, i.tolist())) == whole for t, i in zip((self.a, self.b), ids))
        ends = [np.cumsum(n[i]) for n, i in zip((self.len_a, self.len_b), ids)]
        if same and all(np.isin(edges, e).all() for e in ends):
            keep = [e > edges[0] for e in ends]
            self._add(keys, edges[1:] - edges[0], *(x for k, i, e in zip(keep, ids, ends) for x in (i[k], e[k] - edges[0])))
            return
        for k in keys:
            self._one(k)

    def _one(self, key: str) -> None:
        """A unit tokenised by itself; one that begins with a line feed stands behind a word that is dropped again."""
        lead = " a" if key[0] == "\n" else ""
        unit = key if key[0] in " \n" else " " + key
        raw = (lead + unit).encode("utf-8", "surrogatepass")
        ids = [np.array(t.ids(lead + unit), dtype=np.int64) for t in (self.a, self.b)]
        good = all(b"".join(map(t.bytes.__getitem__, i.tolist())) == raw for t, i in zip((self.a, self.b), ids))
        if not good:
            self.number[key] = len(self.number)
            self.text.append("")
            self.counts.extend(np.array([0, 0, 0, 0, 1]), np.array([5]))
            self.pairs.extend(np.empty(0, dtype=np.int64), np.array([0]))
            self.links.extend(np.empty(0, dtype=np.int64), np.array([0]))
            return
        ends = [np.cumsum(n[i]) for n, i in zip((self.len_a, self.len_b), ids)]
        keep = [e > len(lead) for e in ends]
        self._add([key], np.array([len(raw) - len(lead)]), *(x for k, i, e in zip(keep, ids, ends) for x in (i[k], e[k] - len(lead))))

    def _add(self, keys: list[str], edges: np.ndarray, ids_a: np.ndarray, ends_a: np.ndarray, ids_b: np.ndarray, ends_b: np.ndarray) -> None:
        """Remember units that end at ``edges``, given the tokens of all of them one after another."""
        begin_a, begin_b = ends_a - self.len_a[ids_a], ends_b - self.len_b[ids_b]
        group_a, group_b = coalesce(ends_a, ends_b, begin_a, begin_b)
        unit_a, unit_b = (np.searchsorted(edges, b, side="right") for b in (begin_a, begin_b))
        groups = int(group_a[-1]) + 1
        n = len(keys)
        n_a, n_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        unit_of_group = np.empty(groups, dtype=np.int64)
        unit_of_group[group_a] = unit_a
        links = np.zeros(n, dtype=np.int64)
        np.add.at(links, unit_of_group, n_a * n_b)
        counts = np.column_stack([np.bincount(unit_a, minlength=n), np.bincount(unit_b, minlength=n), np.bincount(unit_of_group, minlength=n), links, np.zeros(n, dtype=np.int64)])
        # group texts of all units, written in one go: every id is followed by the sign that its successor asks for
        place = np.concatenate([2 * group_a, 2 * group_b + 1])
        order = np.argsort(place, kind="stable")
        place, unit = place[order], np.concatenate([unit_a, unit_b])[order]
        step, onward = np.diff(place), np.diff(unit) > 0
        sign = np.array([",", "|", ";", "\n"], dtype=object)[np.where(onward, 3, np.where(step == 0, 0, np.where(place[:-1] % 2 == 0, 1, 2)))]
        written = np.empty(2 * len(order) - 1, dtype=object)
        written[0::2] = self.decimal[np.concatenate([ids_a, ids_b])[order]]
        written[1::2] = sign
        self.text += "".join(written.tolist()).split("\n")
        owner, pair, times = linked_pairs(ids_a, ids_b, group_a, group_b, unit_a, groups)
        sizes = np.bincount(owner, minlength=n)
        at = len(self.number)
        self.number.update(zip(keys, range(at, at + n)))
        self.counts.extend(counts.ravel(), np.full(n, 5))
        self.pairs.extend(pair, sizes)
        self.links.extend(times, sizes)


def unit_keys(text: str) -> list[str]:
    """Units of any text, cut before a space that follows no space and stands before a word. Keys drop the space of ' word'."""
    if not text:
        return []
    return [u if u[1:2] in (" ", "\n", "") else u[1:] for u in _CUT.split(" " + text) if u]


def units_of(texts: pa.Array, units: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows in the order used, first unit of each and the end, unit numbers) of texts without nulls."""
    edges, words = split_column(pc.replace_substring(texts, "\n", " \n"), " ")
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    raw = words.buffers()[2]
    data = np.concatenate([np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, dtype=np.uint8), np.zeros(2, dtype=np.uint8)])
    size, first, second = np.diff(offsets), data[offsets[:-1]], data[offsets[:-1] + 1]
    plain = (size > 0) & (_OPENS[first] | ((first == 10) & (size > 1) & _OPENS[second]))
    odd = sums(~plain, edges) > 0
    easy = words.filter(pa.array(np.repeat(~odd, np.diff(edges))))
    which, keys = numbered(easy)
    rest = [unit_keys(t) for t in texts.filter(pa.array(odd)).to_pylist()]
    more: dict[str, int] = {}
    rest_which = [more.setdefault(k, len(keys) + len(more)) for ks in rest for k in ks]
    # a word of the plain texts may be a unit of the others too: both numbers lead to one unit
    number = units.numbers(list(dict.fromkeys([*keys, *more])))
    of_key = dict(zip(dict.fromkeys([*keys, *more]), number.tolist())) if more else None
    lookup = number if of_key is None else np.array([of_key[k] for k in [*keys, *more]], dtype=np.int64)
    occurrences = np.concatenate([which, np.array(rest_which, dtype=np.int64)]).astype(np.int64)
    sizes = np.concatenate([np.diff(edges)[~odd], np.array([len(ks) for ks in rest], dtype=np.int64)]).astype(np.int64)
    rows = np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])
    return rows, np.r_[0, np.cumsum(sizes)], lookup[occurrences] if len(occurrences) else occurrences


@dataclass
class Block:
    """What a block of documents leaves the first pass with (documents in the order of ``rows``)."""

    rows: np.ndarray
    counts: np.ndarray  # n_a, n_b, n_groups, n_links of each document
    groups: list[str]
    units: list[bytes]  # for each document, numbers of its distinct units in the block
    times: list[bytes]  # and how often each occurs
    pairs: np.ndarray  # distinct id pairs of the block
    docs: np.ndarray  # documents of the block that hold each
    sizes: np.ndarray  # distinct pairs of each unit
    unit_pairs: np.ndarray  # their numbers
    unit_links: np.ndarray  # and links


def align_block(texts: pa.Array, units: Units) -> Block:
    rows, edges, occurrences = units_of(texts, units)
    n = len(rows)
    used, local = np.unique(occurrences.astype(np.int32), return_inverse=True)
    local = local.astype(np.int32)
    counts, _ = units.counts.gather(used)
    counts = counts.reshape(-1, 5)
    bad = sums(counts[local, 4], edges) > 0
    totals = np.column_stack([np.where(bad, 0, sums(counts[local, k], edges)) for k in range(4)])
    text = [units.text[k] for k in used.tolist()]
    groups = []
    for k in range(n):
        part = local[edges[k] : edges[k + 1]].tolist()
        groups.append("" if bad[k] or not part else hashlib.sha256(";".join([text[j] for j in part]).encode()).hexdigest())
    owner = np.repeat(np.arange(n), np.diff(edges))
    good = ~bad[owner]
    key, times = np.unique(owner[good] * np.int64(max(len(used), 1)) + local[good], return_counts=True)
    doc, unit = np.divmod(key, max(len(used), 1))
    pair, sizes = units.pairs.gather(used)
    links, _ = units.links.gather(used)
    pairs, unit_pairs = np.unique(pair, return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    docs = np.zeros(len(pairs), dtype=np.int64)
    cut = np.searchsorted(doc, np.arange(n + 1))
    made = np.r_[0, np.cumsum(sizes[unit])]
    lo = 0
    while lo < n:  # documents a few at a time: the pairs of one document count once
        hi = max(lo + 1, int(np.searchsorted(made[cut], made[cut[lo]] + LINKS_AT_ONCE, side="right")) - 1)
        part = slice(cut[lo], cut[hi])
        held = unit_pairs[spread(starts[unit[part]], sizes[unit[part]])]
        held = np.unique(np.repeat(doc[part], sizes[unit[part]]) * max(len(pairs), 1) + held)
        docs += np.bincount(held % max(len(pairs), 1), minlength=len(pairs))
        lo = hi
    seen = docs > 0  # pairs of texts without tokens are in no document
    renumber = np.cumsum(seen) - 1
    kept = seen[unit_pairs]
    unit_of_pair = np.repeat(np.arange(len(used)), sizes)[kept]
    as_bytes = [[x[cut[k] : cut[k + 1]].astype("<i4").tobytes() for k in range(n)] for x in (unit, times)]
    return Block(rows, totals, groups, *as_bytes, pairs[seen], docs[seen], np.bincount(unit_of_pair, minlength=len(used)), renumber[unit_pairs[kept]], links[kept])


_units: list[tuple[tuple[int, int], Units]] = []


def _worker_units(tokenizer_json: str, model: bytes) -> Units:
    """The unit table of this Python worker, which Spark uses for many tasks."""
    key = (hash(tokenizer_json), hash(model))
    if not _units or _units[0][0] != key:
        _units[:] = [(key, Units(tokenizer_json, model))]
    return _units[0][1]


def align(docs: DataFrame, tokenizer_json: str, model: bytes, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """First pass: a row for each document; the first row of a block also holds the block's pairs and units."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((tokenizer_json, model))  # files of fixed size
    id_field = StructField("doc_id", docs.schema["doc_id"].dataType)
    longs = [StructField(k, LongType()) for k in ("n_a", "n_b", "n_groups", "n_links")]
    schema = StructType([
        id_field, *longs, StructField("groups_sha256", StringType()), StructField("block", LongType()), StructField("units", BinaryType()), StructField("times", BinaryType()),
        StructField("pairs", ArrayType(LongType())), StructField("docs", ArrayType(LongType())),
        StructField("sizes", BinaryType()), StructField("unit_pairs", BinaryType()), StructField("unit_links", BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _worker_units(*shared.value)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = batch.column(0), pc.fill_null(batch.column(1), "")
            for lo, hi in text_parts(texts, block_bytes):
                b = align_block(texts.slice(lo, hi - lo), units)
                n = len(b.rows)
                head = lambda x, kind: pa.array([x, *[None] * (n - 1)], kind)
                arrays = [
                    ids.slice(lo, hi - lo).take(pa.array(b.rows)), *(pa.array(c) for c in b.counts.T), pa.array(b.groups, pa.string()), pa.array(np.full(n, number)),
                    pa.array(b.units, pa.binary()), pa.array(b.times, pa.binary()), head(b.pairs, pa.list_(pa.int64())), head(b.docs, pa.list_(pa.int64())),
                    *(head(x.astype("<i4").tobytes(), pa.binary()) for x in (b.sizes, b.unit_pairs, b.unit_links)),
                ]
                number += 1
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """in_block, pair, count (documents that hold the pair, corpus-wide), best (the highest count of the pair's A id)."""
    held = aligned.filter(F.col("pairs").isNotNull()).select("block", F.inline(F.arrays_zip("pairs", "docs")))
    held = held.withColumnRenamed("pairs", "pair")
    counts = held.groupBy("pair").agg(F.sum("docs").alias("count")).withColumn("a", F.shiftright("pair", _SHIFT))
    top = counts.groupBy("a").agg(F.max("count").alias("top"))
    rated = counts.join(top, "a").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))
    return held.join(rated, "pair").select(F.col("block").alias("in_block"), "pair", "count", "best")


def weigh(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Second pass: n_best and count_sum of every document, from the counts of its block's pairs."""
    fields = [aligned.schema["doc_id"], *(aligned.schema[k] for k in ("n_a", "n_b", "n_groups", "n_links")), StructField("n_best", LongType()), StructField("count_sum", LongType()), aligned.schema["groups_sha256"]]
    schema = StructType(fields)

    def run(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        n = docs.num_rows
        ints = lambda raw: np.frombuffer(raw, dtype="<i4").astype(np.int64)
        head = docs.filter(pc.is_valid(docs["pairs"])).select(["pairs", "sizes", "unit_pairs", "unit_links"]).to_pylist()[0]
        sizes, unit_pairs, unit_links = (ints(head[k]) for k in ("sizes", "unit_pairs", "unit_links"))
        order = np.argsort(pairs["pair"].to_numpy())
        rank = np.searchsorted(pairs["pair"].to_numpy()[order], np.array(head["pairs"], dtype=np.int64))
        edges = np.r_[0, np.cumsum(sizes)]
        unit, times = (ints(b"".join(docs[k].to_pylist())) for k in ("units", "times"))
        cut = np.r_[0, np.cumsum(pc.binary_length(docs["units"]).to_numpy() // 4)]
        found = []
        for name in ("best", "count"):
            value = pairs[name].to_numpy().astype(np.int64)[order][rank]
            found.append(pa.array(sums(times * sums(unit_links * value[unit_pairs], edges)[unit], cut)))
        return pa.table([*(docs[f.name].combine_chunks() for f in fields[:5]), *found, docs["groups_sha256"].combine_chunks()], names=schema.names)

    return aligned.groupBy("block").cogroup(counts.groupBy("in_block")).applyInArrow(run, schema)


def align_tokenizers(docs: DataFrame, tokenizer_json: str, model: bytes, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    spark = docs.sparkSession
    path = scratch_path(spark, "aligned")
    align(docs, tokenizer_json, model, block_bytes).write.option("compression", "zstd").parquet(path)
    aligned = spark.read.parquet(path)
    return weigh(aligned, pair_counts(aligned))


def tokenizer_files(a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model") -> tuple[str, bytes]:
    import public_tokenizers

    with open(public_tokenizers.path(a), encoding="utf-8") as f, open(public_tokenizers.path(b), "rb") as g:
        return f.read(), g.read()


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, by the byte-level and the piece tokenizer."""
    return align_tokenizers(read_documents(spark, sf_dir), *tokenizer_files())
