"""Best-fit packing of tokenised documents under several capacities at once.

Texts become token ids inside the tasks; what is shuffled is one small row for each piece.
Pieces as long as a sequence are sequences by themselves. The others are dealt at random to
groups of about ``GROUP_SEQUENCES`` sequences, and each group is packed on its own by vector
best-fit, longest piece first: among the open bins in which the piece fits under every
capacity (tokens, documents, attention cost), the one with the best score takes it. The score
is the weighted norm of what would be left (``norm``, smallest wins) or the weighted dot
product of need and room (``dot``, largest wins). A group leaves about one bin partly empty,
so the loss is below one part in GROUP_SEQUENCES, at any size of the corpus.

Defined results: a null or empty text is one piece with the end token only; rows that repeat
are packed each; an empty table gives no rows; other columns are ignored, whatever their
names; a null doc_id stays null.
"""

from __future__ import annotations

import itertools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from docflow.llm.common import on_cluster_disk, read_documents
from docflow.llm.flatwords import FlatLists, WordTable, spread, sums, text_parts
from docflow.llm.textwords import _LOWER, text_blocks

MAX_TOKENS = 4096
END_ID = 1
GROUP_SEQUENCES = 2048
GROUP_ROWS = 1 << 17
#: Words that a worker remembers, and bytes of text handled at once.
REMEMBERED = 300_000
PART_BYTES = 1 << 20

# kinds of bytes; a word with an OTHER byte stays as it is
OTHER, LETTER, MARK, DIGIT, LATIN, BLANK = range(6)
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[*range(65, 91), *range(97, 123)]] = LETTER
_KIND[list(b"!\"#$%&()*+,-./:;=?@[\\]^_`{|}~")] = MARK  # neither the apostrophe of a contraction nor the < of a special token
_KIND[48:58] = DIGIT
_KIND[[0xC3, 0xC4]] = LATIN  # first byte of U+00C0 to U+013F
_BLANKS = np.zeros(256, dtype=bool)
_BLANKS[[10, 32]] = True
_KIND[_BLANKS] = BLANK
#: Small ASCII and Latin letters up to U+012F, whose case and class no Unicode version changes.
SMALL_LETTERS = re.compile(f"[a-z{''.join(c for c in map(chr, range(0xDF, 0x130)) if c.islower())}]+").fullmatch


def words_between(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte of each word, its size, first word of each text and the end) of texts with blanks between words."""
    inside = np.zeros(len(data) + 1, dtype=bool)
    np.logical_not(_BLANKS[data], out=inside[1:])
    edge = inside[1:] != inside[:-1]
    cut = offsets[(offsets > 0) & (offsets < len(data))]
    both = np.unique(cut[inside[cut] & inside[cut + 1]])  # a word ends and another begins
    edges = np.flatnonzero(edge)
    if len(both):
        edges = np.insert(edges, np.searchsorted(edges, both).repeat(2), both.repeat(2))
    if len(edges) % 2:
        edges = np.r_[edges, len(data)]
    begin = edges[::2]
    return begin, edges[1::2] - begin, np.searchsorted(begin, offsets)


def plain_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the words with a space between letters, digits and punctuation, and with small letters.

    This is what the tokenizer itself does to ASCII and the Latin letters up to U+012F, whose case and composition depend on
    no neighbour. A word that holds anything else is left as it is.
    """
    kind = _KIND[data]
    pair = np.flatnonzero(kind == LATIN)
    second = data[pair + 1]
    letter = np.where(data[pair] == 0xC3, (second != 0x97) & (second != 0xB7), second < 0xB0)
    kind[pair] = kind[pair + 1] = np.where(letter, LETTER, OTHER)
    out = _LOWER[data]
    other = np.flatnonzero(kind == OTHER)
    if len(other):
        row = np.unique(np.searchsorted(offsets, other, side="right") - 1)
        whole = np.zeros(len(offsets) - 1, dtype=bool)
        whole[row] = True
        whole = np.repeat(whole, np.diff(offsets))
        np.copyto(out, data, where=whole)
        kind[whole] = OTHER
        letter &= ~whole[pair]
    pair, second = pair[letter], second[letter]
    big = np.where(data[pair] == 0xC3, (second < 0x9F) * 32, 1 - second % 2)
    out[pair + 1] = second + big.astype(np.uint8)
    border = np.flatnonzero((kind[1:] != kind[:-1]) & (kind[1:] != OTHER) & (kind[:-1] != OTHER)) + 1
    return np.insert(out, border, 32), offsets + np.searchsorted(border, offsets)


class WordIds:
    """Token ids of texts, by white-space separated words kept in one flat table.

    The tokenizer drops white space and never merges across it, so a text's ids are the ids of
    its words in order. A new word is cut by ``plain_runs``, and a second table keeps the runs: few are new, and each
    reaches the tokenizer once while it is remembered. A run of small letters goes to the tokenizer's model at once,
    as nothing in it is left to normalise or to split. A full table keeps the words that were
    used most often, by parts of text, and forgets the others.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task on every core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.model = self.tokenizer.model
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes_of = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x130)}
        self.words, self.runs = WordTable(np.uint32), WordTable(np.uint32)

    @property
    def ids(self) -> FlatLists:
        return self.words.ids

    @property
    def number(self) -> dict[str, int]:
        """The remembered words of texts."""
        return {w.decode(): n for n, w in enumerate(self.words.words())}

    def _numbers(self, table: WordTable, data: np.ndarray, begin: np.ndarray, size: np.ndarray, learn) -> np.ndarray:
        """Number of every word; ``learn`` gives the ids and their counts for the words that the table doesn't hold."""
        found = table.find(data, begin, size)
        new = np.flatnonzero(found < 0)
        if len(new):
            own, distinct = _distinct(data, begin[new], size[new])
            if len(table) + len(distinct) > REMEMBERED or table.ids.used > 8 * REMEMBERED:
                table.forget(REMEMBERED // 2, 4 * REMEMBERED)
                found = table.find(data, begin, size)
                new = np.flatnonzero(found < 0)
                own, distinct = _distinct(data, begin[new], size[new])
            place = np.empty(len(distinct), dtype=np.int64)
            place[own] = new
            found[new] = len(table) + own
            table.add(data, begin[place], size[place], *learn(distinct))
        table.used(found)
        return found

    def _ids_of_runs(self, runs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        own = [()] * len(runs)
        others = []
        tokenize = self.model.tokenize
        for k, w in enumerate(runs.to_pylist()):
            if SMALL_LETTERS(w):
                own[k] = [t.id for t in tokenize(w if w.isascii() else w.translate(self.bytes_of))]
            else:
                others.append((k, w))
        for at in range(0, len(others), 4096):
            part = others[at : at + 4096]
            for (k, _), e in zip(part, self.tokenizer.encode_batch_fast([w for _, w in part], add_special_tokens=False)):
                own[k] = e.ids
        return np.fromiter(itertools.chain.from_iterable(own), dtype=np.uint32), np.fromiter(map(len, own), dtype=np.int64, count=len(own))

    def _ids_of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        _, _, data, offsets = next(text_blocks(words, 1 << 62))
        data, offsets = plain_runs(data, offsets)
        begin, size, first = words_between(data, offsets)
        data = np.r_[data, np.zeros(8, dtype=np.uint8)]
        found = self._numbers(self.runs, data, begin, size, self._ids_of_runs)
        ids, sizes = self.runs.ids.gather(found)
        return ids, sums(sizes, first)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, first id of each text and the end); no text is null."""
        if not len(texts):
            return np.empty(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)
        _, _, data, offsets = next(text_blocks(texts, 1 << 62))
        begin, size, first = words_between(data, offsets)
        data = np.r_[data, np.zeros(8, dtype=np.uint8)]
        found = self._numbers(self.words, data, begin, size, self._ids_of_words)
        ids, sizes = self.words.ids.gather(found)
        return ids, np.r_[0, np.cumsum(sums(sizes, first))]


def _distinct(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(number of each word among the distinct ones, the distinct words)."""
    edges = np.r_[0, np.cumsum(size)]
    wide = edges[-1] >= 1 << 31
    flat = pa.Array.from_buffers(
        pa.large_string() if wide else pa.string(), len(begin), [None, pa.py_buffer(edges.astype(np.int64 if wide else np.int32)), pa.py_buffer(data[spread(begin, size)])]
    )
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


_words: list[tuple[int, WordIds]] = []


def _worker_words(tokenizer_json: str) -> WordIds:
    """The word table of this Python worker, which Spark uses for many tasks."""
    if not _words or _words[0][0] != hash(tokenizer_json):
        _words[:] = [(hash(tokenizer_json), WordIds(tokenizer_json))]
    return _words[0][1]


def pieces(docs: DataFrame, tokenizer_json: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, as bytes) of every piece of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # a file of fixed size
    id_field = StructField("doc_id", docs.schema["doc_id"].dataType)
    fields = [id_field, StructField("piece", IntegerType()), StructField("start", LongType()), StructField("length", LongType()), StructField("ids_crc32", LongType())]
    if keep_ids:
        fields.append(StructField("ids", BinaryType()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _worker_words(shared.value)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for row, stop in text_parts(texts, PART_BYTES):
                ids, edges = words.encode(texts.slice(row, stop - row))
                raw = memoryview(np.insert(ids, edges[1:], end_id).astype("<u4", copy=False)).cast("B")
                begin = edges[:-1] + np.arange(stop - row)
                length = np.diff(edges) + 1
                count = -(-length // max_tokens)
                owner = np.repeat(np.arange(stop - row), count)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * max_tokens
                size = np.minimum(length[owner] - start, max_tokens)
                lo = 4 * (begin[owner] + start)
                own = [raw[a:b] for a, b in zip(lo.tolist(), (lo + 4 * size).tolist())]
                crc = np.fromiter(map(zlib.crc32, own), dtype=np.int64, count=len(own))
                arrays = [batch.column(0).take(pa.array(row + owner)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(size), pa.array(crc)]
                if keep_ids:
                    arrays.append(pa.array([bytes(x) for x in own], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

    return docs.select("doc_id", "text").mapInArrow(cut, StructType(fields))


def best_fit(need: np.ndarray, capacity: np.ndarray, weights: np.ndarray, rule: str = "norm") -> np.ndarray:
    """Bin number of every item. need: items x kinds, capacity: kinds; items that fit no bin alone are an error.

    Items go largest first kind first; a bin leaves the search once the smallest item left has no room in it.
    """
    n = len(need)
    if n == 0:
        return np.empty(0, dtype=np.int64)
    if (need > capacity).any():
        raise ValueError("an item is larger than a bin")
    share = need / capacity
    order = np.lexsort((np.arange(n), -need[:, 0]))
    smallest = np.minimum.accumulate(share[order][::-1], axis=0)[::-1]  # least need of each kind among the items left
    out = np.empty(n, dtype=np.int64)
    room = np.ones((256, share.shape[1]))
    name = np.zeros(256, dtype=np.int64)
    open_bins = made = 0
    slack = 1e-12
    for step, item in enumerate(order):
        d = share[item]
        if step % 64 == 0 and open_bins:
            keep = (room[:open_bins] + slack >= smallest[step]).all(axis=1)
            left = int(keep.sum())
            room[:left], name[:left] = room[:open_bins][keep], name[:open_bins][keep]
            open_bins = left
        after = room[:open_bins] - d
        score = (after * after) @ weights if rule == "norm" else -(room[:open_bins] @ (weights * d))
        score[(after < -slack).any(axis=1)] = np.inf
        best = int(score.argmin()) if open_bins else -1
        if best < 0 or score[best] == np.inf:
            if open_bins == len(room):
                room = np.concatenate([room, np.ones_like(room)])
                name = np.concatenate([name, np.zeros_like(name)])
            best, open_bins = open_bins, open_bins + 1
            room[best], name[best] = 1.0, made
            made += 1
        room[best] -= d
        out[item] = name[best]
    return out


def scarcity(need: np.ndarray, capacity: np.ndarray) -> np.ndarray:
    """Weight of each kind: the bins that its sum alone would fill, the scarcest kind 1."""
    bins = need.sum(axis=0) / capacity
    return bins / max(bins.max(initial=0.0), 1e-300)


def pack(
    cut: DataFrame,
    max_tokens: int = MAX_TOKENS,
    max_documents: int = MAX_TOKENS,
    max_attention: int = MAX_TOKENS**2,
    weights: tuple[float, float, float] | None = None,
    rule: str = "norm",
) -> DataFrame:
    """``sequence_id`` and ``offset`` for every piece (attention cost of a piece: its length squared).

    Every capacity holds in every sequence. A piece that exceeds one alone is an error, but for one of ``max_tokens``,
    which is a sequence by itself. Without ``weights`` each kind weighs as scarce as it is in the group.
    """
    cut = on_cluster_disk(cut.withColumn("row_number", F.monotonically_increasing_id()))
    total = cut.agg(F.sum("length").alias("tokens"), F.count("*").alias("rows")).first()
    groups = max(1, -(-(total["tokens"] or 0) // (max_tokens * GROUP_SEQUENCES)), -(-total["rows"] // GROUP_ROWS))
    full = F.col("length") >= F.lit(max_tokens)
    alone = cut.filter(full).withColumn("sequence_id", -F.col("row_number") - F.lit(1)).withColumn("offset", F.lit(0).cast("long"))
    rest = cut.filter(~full).withColumn("pack_group", F.pmod(F.xxhash64("row_number"), F.lit(groups)).cast("int"))
    schema = StructType([*cut.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    capacity = np.array([max_tokens, max_documents, max_attention], dtype=float)

    def fill(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("row_number", ignore_index=True)
        length = group["length"].to_numpy(dtype=float)
        need = np.column_stack([length, np.ones(len(length)), length * length])
        bins = best_fit(need, capacity, scarcity(need, capacity) if weights is None else np.array(weights), rule)
        order = np.lexsort((np.arange(len(bins)), bins))
        sizes = group["length"].to_numpy()[order]
        before = np.cumsum(sizes) - sizes
        first = np.r_[True, bins[order][1:] != bins[order][:-1]] if len(bins) else np.empty(0, dtype=bool)
        offset = np.empty(len(bins), dtype=np.int64)
        offset[order] = before - np.repeat(before[first], np.diff(np.r_[np.flatnonzero(first), len(bins)]))
        group["sequence_id"] = int(key[0]) * (1 << 32) + bins
        group["offset"] = offset
        return group[[f.name for f in schema.fields]]

    packed = rest.groupBy("pack_group").applyInPandas(fill, schema)
    return alone.select(*schema.names).unionByName(packed).drop("row_number")


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return pack(pieces(read_documents(spark, sf_dir), tokenizer_file()))
