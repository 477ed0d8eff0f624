"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each document becomes a short vector of statistics (logarithms of sizes, arcsine-scaled shares,
repetition, entropy). For each class the training rows give count, sum and sum of outer products,
added up by Spark, so the fit sees every training row and the driver only two matrices. A class
covariance is shrunk towards the pooled one and towards a multiple of the identity, and factored
once by Cholesky. A score is the logistic of the difference of the two Mahalanobis log-densities,
with the class priors, flattened by a temperature, the more the fewer words
the statistics come from.

Defined results: a null or empty text has the statistics of no bytes and is scored like any
other; without training rows of both classes the score is the share of class 1 (0.5 with none);
documents are scored each, repeated ids too; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from docflow.llm.common import label_fold, on_cluster_disk, read_documents, read_table
from docflow.llm.textwords import NON_SPACE, grams, text_blocks, words_of

SHRINK_POOLED = 0.1
SHRINK_IDENTITY = 0.02
TEMPERATURE = 10.0
SHORT_WORDS = 50.0  # the statistics of a document of so few words are noise for one half

_CLASSES = {
    "lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58), "space": [32], "line": [10], "other_space": [9, 11, 12, 13],
    "stop": [33, 44, 46, 58, 59, 63], "quote": [34, 39, 40, 41, 45], "symbol": [35, 36, 37, 38, 42, 43, 47, 60, 61, 62, 64, 92, 94, 95, 96, 123, 124, 125, 126],
    "wide": range(128, 256),
}
_CLASS_OF = np.zeros(256, dtype=np.int64)
for _n, _members in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_members)] = _n + 1
_N_CLASSES = len(_CLASSES) + 1
FEATURES = [
    "log_bytes", "log_words", "log_lines", *(f"share_{c}" for c in _CLASSES), "word_length", "word_length_spread", "distinct_words",
    "top_word", "repeated_pairs", "repeated_grams", "repeated_lines", "line_words", "stopped_words", "capital_words", "entropy", "adjacent_repeats",
]


def _share(x: np.ndarray | float) -> np.ndarray | float:
    """Variance-stabilising transform of a share."""
    return np.arcsin(np.sqrt(np.clip(x, 0.0, 1.0)))


def _repeated(values: np.ndarray) -> tuple[float, float]:
    """Share of values beyond the first of their kind, and share of the commonest."""
    if not len(values):
        return 0.0, 0.0
    counts = np.diff(np.flatnonzero(np.r_[True, np.diff(np.sort(values)) != 0, True]))
    return 1.0 - len(counts) / len(values), counts.max() / len(values)


_NOT_LINE = np.ones(256, dtype=bool)
_NOT_LINE[10] = False


def block_statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Feature rows of the documents of a block."""
    docs = len(offsets) - 1
    out = np.zeros((docs, len(FEATURES)))
    words = words_of(data, offsets, NON_SPACE)
    lines = words_of(data, offsets, _NOT_LINE)
    length = words.end - words.begin
    last = data[words.end - 1] if len(length) else np.empty(0, dtype=np.uint8)
    head = data[words.begin] if len(length) else np.empty(0, dtype=np.uint8)
    stopped = np.isin(last, [33, 46, 63])
    capital = (head >= 65) & (head <= 90)
    for i in range(docs):
        raw = data[offsets[i] : offsets[i + 1]]
        n = max(1, len(raw))
        a, b = words.first[i], words.first[i + 1]
        own, size = words.hashes[a:b], length[a:b]
        count = max(1, len(own))
        line = lines.hashes[lines.first[i] : lines.first[i + 1]]
        by_byte = np.bincount(raw, minlength=256)
        by_class = np.bincount(_CLASS_OF, weights=by_byte, minlength=_N_CLASSES)[1:]
        p = by_byte[by_byte > 0] / n
        twice, top = _repeated(own)
        out[i] = (
            np.log1p(len(raw)), np.log1p(len(own)), np.log1p(len(line)), *_share(by_class / n),
            np.log1p(size.mean()) if len(size) else 0.0, np.log1p(size.std()) if len(size) else 0.0, _share(1.0 - twice), _share(top),
            _share(_repeated(grams(own, 2))[0]), _share(_repeated(grams(own, 4))[0]), _share(_repeated(line)[0]), np.log1p(len(own) / max(1, len(line))),
            _share(stopped[a:b].sum() / count), _share(capital[a:b].sum() / count), -(p * np.log(p)).sum(),
            _share((own[1:] == own[:-1]).sum() / count),
        )
    return out


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and its feature vector."""
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("features", ArrayType(DoubleType(), False))])
    kind = pa.list_(pa.field("element", pa.float64(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(1)):
                flat = pa.array(block_statistics(data, offsets).ravel())
                edges = pa.array(np.arange(hi - lo + 1, dtype=np.int32) * len(FEATURES))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(edges, flat, type=kind)], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def moments(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and sum of outer products of each class, added up by Spark (``labelled``: label int, features)."""
    d = len(FEATURES)
    schema = "label int, part long, value double"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.asarray(batch.column(1).flatten()).reshape(-1, d)
            x = np.column_stack([np.ones(len(x)), x])
            for c in np.unique(label).tolist():
                own = x[label == c]
                sums[c] = sums.get(c, 0) + own.T @ own
        for c, m in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m.size, c, dtype=np.int32)), pa.array(np.arange(m.size)), pa.array(m.ravel())], names=["label", "part", "value"])

    total = labelled.select("label", "features").mapInArrow(partial, schema).groupBy("label", "part").agg(F.sum("value").alias("value"))
    out: dict[int, np.ndarray] = {}
    for r in total.collect():  # two small matrices
        out.setdefault(r["label"], np.zeros((d + 1) ** 2))[r["part"]] = r["value"]
    full = {c: m.reshape(d + 1, d + 1) for c, m in out.items()}
    return {c: (m[0, 0], m[0, 1:], m[1:, 1:]) for c, m in full.items()}


@dataclass
class Discriminant:
    """Scale of the features, and for both classes mean, inverse Cholesky factor and constant of the log-density."""

    center: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    constants: list[float]
    temperature: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), self.prior)
        words = np.maximum(np.expm1(x[:, FEATURES.index("log_words")]), 1.0)
        x = (x - self.center) / self.scale
        density = [k - 0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) for m, f, k in zip(self.means, self.factors, self.constants)]
        log_odds = np.log(self.prior) - np.log1p(-self.prior)
        z = (density[1] - density[0]) / (self.temperature * (1.0 + SHORT_WORDS / words)) + log_odds
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit(
    parts: dict[int, tuple[float, np.ndarray, np.ndarray]], pooled: float = SHRINK_POOLED, identity: float = SHRINK_IDENTITY, temperature: float = TEMPERATURE
) -> Discriminant:
    d = len(FEATURES)
    n = {c: parts[c][0] if c in parts else 0.0 for c in (0, 1)}
    prior = (n[1] + 0.5) / (n[0] + n[1] + 1.0)
    if min(n.values()) < 2:
        return Discriminant(np.zeros(d), np.ones(d), [], [], [], temperature, prior)
    total = sum(n.values())
    center = sum(parts[c][1] for c in (0, 1)) / total
    variance = sum(np.diag(parts[c][2]) for c in (0, 1)) / total - center**2
    scale = np.sqrt(np.maximum(variance, 1e-8))
    means, covs = [], []
    for c in (0, 1):
        mean = parts[c][1] / n[c]
        cov = parts[c][2] / n[c] - np.outer(mean, mean)
        means.append((mean - center) / scale)
        covs.append(cov / np.outer(scale, scale))
    both = (n[0] * covs[0] + n[1] * covs[1]) / total
    factors, constants = [], []
    for cov in covs:
        cov = (1 - pooled) * cov + pooled * both
        cov = (1 - identity) * cov + identity * max(np.trace(cov) / d, 1e-3) * np.eye(d)
        lower = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(lower))
        constants.append(-float(np.log(np.diag(lower)).sum()))
    return Discriminant(center, scale, means, factors, constants, temperature, prior)


def score_statistics(features: DataFrame, model: Discriminant) -> DataFrame:
    """``score`` for every row that has a feature vector."""
    shared = features.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*features.schema.fields, StructField("score", DoubleType())])
    at = features.columns.index("features")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column(at).flatten()).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.score(x))], names=schema.names)

    return features.mapInArrow(run, schema)


def train_rows(features: DataFrame, labels: DataFrame, column: str, modulus: int, held_out: int) -> DataFrame:
    """Labelled feature rows outside the held-out fold; several labels of one id all count."""
    own = labels.filter(F.col(column).isin(0, 1)).select("doc_id", F.col(column).cast("int").alias("label"))
    own = own.filter(label_fold(F.col("doc_id"), modulus) != held_out)
    return features.select("doc_id", "features").join(own, "doc_id")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents; fold 2 of 4 is never trained on."""
    features = on_cluster_disk(statistics(read_documents(spark, sf_dir)))
    labels = read_table(spark, sf_dir, "labels")
    model = fit(moments(train_rows(features, labels, "quality", 4, 2)))
    out = score_statistics(features, model)
    return out.select(
        "doc_id", (label_fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )
