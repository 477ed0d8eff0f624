"""Unigram token counts by a count-only Viterbi search.

An Aho-Corasick automaton lists every vocabulary piece that ends at a position; dynamic
programming keeps the best score and the number of pieces there, and no path. The rules are
those of the unigram tokenizer: a space is written as the mark U+2581 and a text starts with
one; a later candidate replaces an earlier one only with a strictly higher score, and candidates
come in order of their start, so the longest piece wins a tie; a character that is no piece of
its own may be unknown, at 10 below the lowest score; neighbouring unknown characters are one
unknown piece, which counts as its UTF-8 bytes where the vocabulary has all bytes.

No piece holds the mark behind another character, so no path crosses the start of a run of
marks, and a text is the sum of its words. Words are counted once while they are cached.
A vocabulary with pieces across that border is searched over whole texts.

Defined results: a null or empty text has 0 tokens; a null doc_id stays null; repeated rows
are counted each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructField, StructType

from docflow.llm.common import read_documents

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 500_000
CACHED_CHARS = 64


class UnigramCounter:
    """Counts pieces of texts; ``pieces`` are (text, score) in id order, ``unknown`` the id of the unknown piece."""

    def __init__(self, pieces: list[tuple[str, float]], unknown: int):
        import ahocorasick

        self.auto = ahocorasick.Automaton()
        self.vocabulary = {}
        for i, (piece, score) in enumerate(pieces):
            self.vocabulary[piece] = i
            if piece:
                self.auto.add_word(piece, (len(piece), score, i == unknown))
        self.auto.make_automaton()
        self.unknown_score = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.all_bytes = all(f"<0x{b:02X}>" in self.vocabulary for b in range(256))
        self.separable = not any(MARK in piece.lstrip(MARK) for piece, _ in pieces)
        self.cache: dict[str, int] = {}

    def _flush(self, run: str) -> int:
        if not run:
            return 0
        return len(run.encode("utf-8", "surrogatepass")) if self.all_bytes and run not in self.vocabulary else 1

    def search(self, text: str) -> int:
        """Pieces on the best path. State of a position: score, pieces before the open run of unknowns, start of that run (-1: none)."""
        n = len(text)
        score: list[float | None] = [None] * (n + 1)
        count = [0] * (n + 1)
        run = [-1] * (n + 1)
        score[0] = 0.0
        matches = self.auto.iter(text)
        end, match = next(matches, (n, None))
        for at in range(n):
            best, source, unknown, single = None, at, True, False
            while end == at:  # longest first, so in order of their start
                length, gain, is_unknown = match
                start = at + 1 - length
                single = single or length == 1
                if score[start] is not None:
                    total = score[start] + gain
                    if best is None or total > best:
                        best, source, unknown = total, start, is_unknown
                end, match = next(matches, (n, None))
            if not single and score[at] is not None:
                total = score[at] + self.unknown_score
                if best is None or total > best:
                    best, source, unknown = total, at, True
            to = at + 1
            score[to] = best
            if unknown:
                count[to] = count[source]
                run[to] = run[source] if run[source] >= 0 else source
            else:
                closed = self._flush(text[run[source] : source]) if run[source] >= 0 else 0
                count[to] = count[source] + closed + 1
        return count[n] + (self._flush(text[run[n] :]) if run[n] >= 0 else 0)

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace(" ", MARK)
        if not text.startswith(MARK):
            text = MARK + text
        if not self.separable:
            return self.search(text)
        total = 0
        cache = self.cache
        for word in words(text):
            pieces = cache.get(word)
            if pieces is None:
                pieces = self.search(word)
                if len(word) <= CACHED_CHARS:
                    if len(cache) >= CACHED_WORDS:
                        cache.clear()
                    cache[word] = pieces
            total += pieces
        return total


def words(text: str) -> list[str]:
    """A marked text cut before every run of marks."""
    if MARK + MARK not in text:
        return [MARK + w for w in text[1:].split(MARK)]
    return re.findall(f"{MARK}+[^{MARK}]*", text)


def count_tokens(docs: DataFrame, pieces: list[tuple[str, float]], unknown: int = 0) -> DataFrame:
    """doc_id, n_tokens. The vocabulary is a file of fixed size and goes to every executor."""
    shared = docs.sparkSession.sparkContext.broadcast((pieces, unknown))
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("n_tokens", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = UnigramCounter(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                counts = [counter.count(t) if t else 0 for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64())], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a public sentencepiece file, in id order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents under the 32k public vocabulary, read as a unigram model."""
    import public_tokenizers

    return count_tokens(read_documents(spark, sf_dir), vocabulary(public_tokenizers.path("piece_bpe_32k.model")))
