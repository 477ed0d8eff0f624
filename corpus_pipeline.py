"""Training-corpus pipeline: toxicity, near duplicates, benchmark decontamination, personal data, packing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame. It works on all rows that the stage
before it left, and all but the last return the columns of ``documents``. ``run`` writes every
stage's result as Parquet in the shared folder and reads it again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm import decontaminate, neardup, packing, pii, toxicity
from docflow.llm.common import mark_members, on_cluster_disk, read_documents, read_table, ship_package
from docflow.session import scratch_path

#: Score from which a document counts as toxic.
TOXIC = 0.7


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns asked for, ``n_chars`` again the length of ``text``."""
    out = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in columns else docs
    return out.select(*columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold, unchanged; those at or above it go."""
    ship_package(spark)
    model = toxicity.learn(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter(F.col("toxicity") < TOXIC).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8): that with the smallest doc_id.

    Of rows that share the kept doc_id the smallest stays, by text (null first) and then by the other columns;
    rows without a doc_id have no group and stay.
    """
    ship_package(spark)
    judged = neardup.near_duplicates(docs, width=5, percent=80).filter(F.col("doc_id").isNotNull())
    ids = on_cluster_disk(judged.groupBy("doc_id").agg(F.count("*").alias("rows"), F.max("kept").alias("kept")))
    touched = ids.filter("not kept or rows > 1")
    # most documents have no copy: a filter of fixed size lets them pass, and only the others are shuffled
    marked = mark_members(docs, "doc_id", touched.select("doc_id"), "__touched")
    doubtful = marked.filter("__touched").drop("__touched").join(ids.filter("kept").select("doc_id", F.col("rows").alias("__rows")), "doc_id")
    once = doubtful.filter("__rows = 1").select(*docs.columns)
    first = F.min(F.struct("text", *[c for c in docs.columns if c not in ("doc_id", "text")])).alias("__first")
    several = doubtful.filter("__rows > 1").groupBy("doc_id").agg(first).select("doc_id", "__first.*").select(*docs.columns)
    return marked.filter("not __touched").select(*docs.columns).unionByName(once).unionByName(several)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the spans that benchmark windows of ten words hit; those with nothing else go."""
    ship_package(spark)
    out = decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"), keep_text=True)
    out = out.filter((F.col("n_words") == 0) | (F.col("n_hit") < F.col("n_words")))
    return _with_length(out, docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every span of personal data replaced by its kind."""
    return _with_length(pii.redact(docs), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of at most 4096 tokens."""
    ship_package(spark)
    return packing.pack(packing.pieces(docs, packing.tokenizer_file()))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", remove_benchmark),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: SQL can express neither the trained stages nor the forest; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all of ``documents``."""
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
