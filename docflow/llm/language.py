"""Language of a text by a string kernel: presence of byte n-grams, Nystroem landmarks, kernel ridge regression.

A text is the set of its distinct grams of one to ``ORDER`` bytes, over lower-cased Latin letters,
bytes of other characters, and one sign for everything else (also before and behind the text). The
blended-spectrum presence kernel of two texts is the number of grams they share, divided by the
geometric mean of their numbers of grams. ``LANDMARKS`` texts span the model: with K the kernel
of the training texts with them and M that of the landmarks, one ridge regression for each language
(target 1 in it, 0 elsewhere) solves (K'K + ridge M) a = K'y. A batch of texts is a presence matrix over
the landmarks' grams; its product with the landmarks' matrix, scaled, is the kernel, and the kernel's product with ``a``
is the score of every language. The highest wins, and the score is its value cut to 0..1.

Bounds of the model: ``SAMPLE`` training texts (equal texts of one language count once), taken by the hash of the text, the
first ones of every language in turn, and ``LANDMARKS`` of them, those under ``LANDMARK_BYTES`` first. Scoring covers whole texts.

Defined results: a null text or one without a letter is ``und`` with score 0, as is every text when nothing can be learned;
equal scores go to the first language in order; a text that shares no gram with a landmark has score 0; a null doc_id
is in fold 0; a repeated row is scored like the first; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from docflow.llm.common import label_fold, on_cluster_disk, read_documents
from docflow.llm.textwords import text_blocks

ORDER = 3
SAMPLE = 4096
LANDMARKS = 256
LANDMARK_BYTES = 1 << 14
RIDGE = 0.1
UNKNOWN = "und"
#: Cells of a presence matrix.
CELLS = 1 << 22

#: Code of every byte: 0 for what is neither a Latin letter nor part of another character.
_CODE = np.zeros(256, dtype=np.int32)
_CODE[65:91] = _CODE[97:123] = np.arange(1, 27)
_CODE[128:] = np.arange(27, 155)
_LETTERS = 155
#: First number of the grams of each length; one more than all of them last.
_FIRST = np.cumsum([0, *(_LETTERS**k for k in range(1, ORDER + 1))])


class Grams:
    """Distinct grams of texts, by their numbers."""

    def __init__(self) -> None:
        self.last = np.zeros(_FIRST[-1], dtype=np.int32)

    def of(self, column: pa.Array) -> Iterator[np.ndarray]:
        """Numbers of the distinct grams of each text of a column, in order of first use; grams without any letter don't count."""
        for _, _, data, offsets in text_blocks(column):
            signs = np.insert(_CODE[data], offsets, 0)
            kinds = [signs]
            for _ in range(ORDER - 1):
                kinds.append(kinds[-1][:-1] * _LETTERS + signs[len(kinds) :])
            for k in range(len(offsets) - 1):
                lo, hi = offsets[k] + k, offsets[k + 1] + k + 2
                all_grams = np.concatenate([g[lo : max(hi - n, lo)] + _FIRST[n] for n, g in enumerate(kinds)])
                all_grams = all_grams[~np.isin(all_grams, _FIRST[:-1])] if len(all_grams) < 64 else self._lettered(all_grams)
                place = np.arange(len(all_grams), dtype=np.int32)
                self.last[all_grams] = place
                yield all_grams[self.last[all_grams] == place]

    @staticmethod
    def _lettered(grams: np.ndarray) -> np.ndarray:
        keep = grams != _FIRST[0]
        for first in _FIRST[1:-1]:
            keep &= grams != first
        return grams[keep]


@dataclass
class Landmarks:
    """Grams of the landmarks (sorted) and which of them each landmark has, as bits."""

    grams: np.ndarray
    bits: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, sets: list[np.ndarray]) -> Landmarks:
        grams = np.unique(np.concatenate([*sets, np.empty(0, dtype=np.int64)])).astype(np.int64)
        has = np.zeros((len(sets), len(grams)), dtype=bool)
        for k, own in enumerate(sets):
            has[k, np.searchsorted(grams, own)] = True
        return cls(grams, np.packbits(has, axis=1), np.array([len(s) for s in sets], dtype=np.float64))


class Kernel:
    """Kernel of texts with the landmarks, by products of presence matrices."""

    def __init__(self, marks: Landmarks):
        self.grams, self.size = Grams(), marks.size
        self.width = len(marks.grams)
        self.has = np.unpackbits(marks.bits, axis=1, count=self.width).astype(np.float32)
        self.column = np.full(_FIRST[-1], -1, dtype=np.int32)
        self.column[marks.grams] = np.arange(self.width)
        self.rows = max(1, min(512, CELLS // max(self.width, 1)))

    def of(self, column: pa.Array) -> Iterator[np.ndarray]:
        """Rows of the kernel matrix, some texts at a time."""
        present = np.zeros((self.rows, self.width), dtype=np.float32)
        sizes: list[int] = []
        for own in self.grams.of(column):
            at = self.column[own]
            present[len(sizes), at[at >= 0]] = 1.0
            sizes.append(len(own))
            if len(sizes) == self.rows:
                yield self._scaled(present, sizes)
                present[:] = 0.0
                sizes = []
        if sizes:
            yield self._scaled(present[: len(sizes)], sizes)

    def _scaled(self, present: np.ndarray, sizes: list[int]) -> np.ndarray:
        shared = (present @ self.has.T).astype(np.float64)  # counts: exact in single precision up to 2**24 grams
        return shared / np.sqrt(np.maximum(np.outer(np.array(sizes, dtype=np.float64), self.size), 1.0))


@dataclass
class Model:
    marks: Landmarks | None
    languages: list[str]
    weights: np.ndarray


def training_sample(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """lang, text, turn: the first texts of every language by hash, language by language in turn."""
    keyed = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text", F.xxhash64("text", "lang").alias("hash"))
    distinct = keyed.select("lang", "hash").distinct()
    # only hashes are ranked, and a task keeps its first ones of each language before the shuffle
    ranked = distinct.withColumn("turn", F.row_number().over(Window.partitionBy("lang").orderBy("hash"))).filter(F.col("turn") <= sample)
    chosen = ranked.orderBy("turn", "hash").limit(sample)
    held = keyed.join(F.broadcast(chosen), ["lang", "hash"])  # ``sample`` rows at most
    return held.groupBy("turn", "lang").agg(F.min("text").alias("text"))


def learn(docs: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Model of ``docs(text, lang)``; all of them may be learned from."""
    texts = on_cluster_disk(training_sample(docs, sample))
    order = texts.select("lang", "turn", (F.octet_length("text") > LANDMARK_BYTES).alias("long")).collect()  # ``sample`` small rows
    first = sorted(order, key=lambda r: (r["long"], r["turn"], r["lang"]))[:landmarks]
    if not first:
        return Model(None, [], np.empty((0, 0)))
    context = docs.sparkSession.sparkContext
    names = {(r["lang"], r["turn"]) for r in first}
    mark = F.struct("lang", "turn").isin([F.struct(F.lit(lang).alias("lang"), F.lit(turn).alias("turn")) for lang, turn in sorted(names)])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in batches:
            own = [np.sort(g).astype("<i4").tobytes() for g in grams.of(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary())], names=["grams"])

    marks = Landmarks.of(sorted((np.frombuffer(bytes(r.grams), dtype="<i4").astype(np.int64) for r in texts.filter(mark).select("text").mapInArrow(sets, "grams binary").collect()), key=lambda g: (len(g), g.tolist())))
    shared = context.broadcast(marks)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = Kernel(shared.value)
        for batch in batches:
            own = [r.astype("<f8").tobytes() for part in kernel.of(batch.column(1)) for r in part]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary())], names=["lang", "kernel"])

    got = sorted((r.lang, bytes(r.kernel)) for r in texts.select("lang", "text").mapInArrow(rows, "lang string, kernel binary").collect())  # sample x landmarks numbers
    k = np.array([np.frombuffer(raw, dtype="<f8") for _, raw in got])
    languages = sorted({lang for lang, _ in got})
    y = (np.array([lang for lang, _ in got])[:, None] == np.array(languages)[None, :]).astype(np.float64)
    has = np.unpackbits(marks.bits, axis=1, count=len(marks.grams)).astype(np.float64)
    m = (has @ has.T) / np.sqrt(np.maximum(np.outer(marks.size, marks.size), 1.0))
    return Model(marks, languages, ridge_solution(k, m, y, ridge))


def ridge_solution(k: np.ndarray, m: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """a that minimises |K a - y|^2 + ridge a'M a (a small multiple of the unit matrix keeps it solvable for equal landmarks)."""
    left = k.T @ k + ridge * m
    left += np.eye(len(m)) * 1e-9 * max(np.trace(left) / max(len(m), 1), 1e-9)
    return np.linalg.solve(left, k.T @ y)


def classify(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs``, with lang_pred and score."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    schema = StructType([*(docs.schema[k] for k in keep), StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel, languages = None, shared.value.languages
        for batch in batches:
            kept, text = batch.columns[: len(keep)], batch.column(len(keep))
            known = batch.column(len(keep) + 1).to_numpy(zero_copy_only=False)
            if languages:
                kernel = kernel or Kernel(shared.value.marks)
                value = np.concatenate([np.empty((0, len(languages))), *(part @ shared.value.weights for part in kernel.of(text))])
                best = value.argmax(axis=1)
                score = np.where(known, np.clip(value[np.arange(len(best)), best], 0.0, 1.0), 0.0)
                name = [languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())]
            else:
                score, name = np.zeros(batch.num_rows), [UNKNOWN] * batch.num_rows
            yield pa.RecordBatch.from_arrays([*kept, pa.array(name, pa.string()), pa.array(score)], names=schema.names)

    return docs.select(*keep, "text", letters).mapInArrow(run, schema)


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; a third of them by the fold of doc_id is held out of the training."""
    docs = read_documents(spark, sf_dir)
    held_out = (label_fold(F.col("doc_id"), 3) == 1).cast(BooleanType()).alias("held_out")
    model = learn(docs.filter(label_fold(F.col("doc_id"), 3) != 1).select("text", "lang"))
    return classify(docs.select("doc_id", held_out, "text"), model, ["doc_id", "held_out"])
