"""License scan by diagonal voting.

Every rolling k-gram of a document's words is matched with the k-grams of license templates.
A match of document position p with template position t votes for the diagonal p - t; a copy
of the template at word s fills diagonal s, and a copy with a few words more or less fills
neighbouring diagonals. Votes are ordered by diagonal, and diagonals at most a small band apart
are merged: words inserted, deleted or replaced between two parts of a copy move the later part by
the difference in words, and votes on near diagonals of one template lie in one region of the
document. The share of the template's positions that a merged span covers, each counted once, is
its score.

Tasks emit only the grams that a bit table of the templates' grams lets through (a filter
without false negatives, of fixed size), with their words; the join with the template table
compares hash and words, so every vote is a verified match. The templates are a fixed list.
A template of fewer than k words is one gram of its own length.

Defined results: a null or empty text has no words, no places and no labels; rows with equal or
null ids stay rows of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from docflow.llm.common import read_documents
from docflow.llm.textwords import ALNUM, grams, hash_text, text_blocks, words_of

K = 3
BAND = 3
COVERAGE = 0.5
TABLE_BITS = 20


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    whole: bool  # True: every exact place counts (base); False: coverage decides


# Base phrases and the usual wording of license notices.
BASE = [
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
]
NOTICES = [
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", False),
    Template("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", False),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", False),
    Template("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", False),
    Template("gpl-3", "licensed under the gnu general public license version 3", False),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", False),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", False),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", False),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", False),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", False),
]


def template_grams(templates: list[Template], k: int = K) -> list[tuple]:
    """(template, gram length, position, gram hash, gram words) of every gram of every template."""
    rows = []
    for number, t in enumerate(templates):
        words = t.text.split()
        size = min(k, len(words))
        for at, h in enumerate(grams(hash_text(t.text, ALNUM), size).view(np.int64).tolist()):
            rows.append((number, size, at, h, " ".join(words[at : at + size])))
    return rows


def matching_grams(docs: DataFrame, rows: list[tuple]) -> DataFrame:
    """doc_id, n_words, row key and the grams (position, length, hash, words) that may be a template's."""
    table = np.zeros(1 << TABLE_BITS, dtype=bool)
    hashes = np.array([r[3] for r in rows], dtype=np.int64).view(np.uint64)
    table[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
    sizes = sorted({r[1] for r in rows})
    shared = docs.sparkSession.sparkContext.broadcast((np.packbits(table), sizes))
    gram = StructType([StructField("pos", LongType()), StructField("size", IntegerType()), StructField("gram", LongType()), StructField("words", StringType())])
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("n_words", LongType()), StructField("found", ArrayType(gram))])
    arrow = pa.list_(pa.struct([("pos", pa.int64()), ("size", pa.int32()), ("gram", pa.int64()), ("words", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, sizes = shared.value
        bits = np.unpackbits(packed).view(bool)
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(1)):
                w = words_of(data, offsets, ALNUM)
                found: list[list[dict]] = [[] for _ in range(hi - lo)]
                for size in sizes:
                    g = grams(w.hashes, size)
                    at = np.flatnonzero(bits[(g >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
                    doc = np.searchsorted(w.first, at, side="right") - 1
                    inside = at + size <= w.first[doc + 1]
                    for p, d in zip(at[inside].tolist(), doc[inside].tolist()):
                        text = " ".join(data[w.begin[p + j] : w.end[p + j]].tobytes().decode("utf-8", "replace") for j in range(size))
                        found[d].append({"pos": p - int(w.first[d]), "size": size, "gram": int(g[p : p + 1].view(np.int64)[0]), "words": ascii_lower(text)})
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(w.first), pa.int64()), pa.array(found, arrow)], names=schema.names
                )

    return docs.select("doc_id", "text").mapInArrow(run, schema).withColumn("row_key", F.monotonically_increasing_id())


_FOLD = {c: c + 32 for c in range(65, 91)}


def ascii_lower(text: str) -> str:
    return text.translate(_FOLD)


def scan(docs: DataFrame, base: list[Template], notices: list[Template], k: int = K, band: int = BAND, coverage: float = COVERAGE) -> DataFrame:
    """One row for each document: n_words, base places, labels, score and the verified spans (label, first word, end word, coverage)."""
    spark = docs.sparkSession
    templates = [*base, *notices]
    rows = template_grams(templates, k)
    total = {n: sum(1 for r in rows if r[0] == n) for n in range(len(templates))}
    listed = spark.createDataFrame(
        [(*r, templates[r[0]].label, templates[r[0]].whole, total[r[0]]) for r in rows],
        "template int, size int, tpos int, gram long, words string, label string, whole boolean, grams_total int",
    )
    found = matching_grams(docs, rows).select("row_key", "doc_id", "n_words", F.explode_outer("found").alias("m"))
    found = found.select("row_key", "doc_id", "n_words", "m.pos", "m.size", "m.gram", "m.words")
    joined = found.join(F.broadcast(listed), ["size", "gram", "words"], "left")
    doc = ["row_key", "doc_id", "n_words"]
    votes = joined.withColumn("diagonal", F.col("pos") - F.col("tpos"))
    order = Window.partitionBy("row_key", "template").orderBy("diagonal")
    # exact places of base phrases are single diagonals; neighbours merge only for notices
    reach = F.when(F.col("whole"), 0).otherwise(band)
    far = F.col("diagonal") - F.lag("diagonal").over(order) > reach
    starts = F.when(F.coalesce(far, F.lit(True)), 1).otherwise(0)
    merged = votes.withColumn("start", starts).withColumn("group", F.sum("start").over(order))
    # a template position that several diagonals cover counts once
    spans = merged.groupBy(*doc, "template", "label", "whole", "grams_total", "group").agg(
        F.count_distinct("tpos").alias("covered"), F.min("pos").alias("first"), F.max(F.col("pos") + F.col("size")).alias("end"), F.min("diagonal").alias("diagonal")
    )
    spans = spans.withColumn("coverage", F.col("covered") / F.col("grams_total")).withColumn("place", F.col("whole") & (F.col("covered") == F.col("grams_total")))
    hit = F.col("place") | (~F.col("whole") & (F.col("coverage") >= F.lit(coverage)))
    span = F.struct("label", "first", "end", "coverage")
    return spans.groupBy(*doc).agg(
        F.count(F.when(F.col("place"), 1)).alias("n_base"),
        F.min(F.when(F.col("place"), F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("place"), F.col("diagonal"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("place"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(hit, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(hit | ~F.col("whole"), F.col("coverage"))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(hit, span))).alias("spans"),
    )


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of all documents, from the base phrases and the usual notices."""
    out = scan(read_documents(spark, sf_dir), BASE, NOTICES)
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
