"""Registered queries of the subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docflow.llm.alignment import op13_tokenizer_alignment
from docflow.llm.decontaminate import op2_decontamination
from docflow.llm.embeddings import op4_embedding_dedup
from docflow.llm.hardnegatives import op11_hard_negatives
from docflow.llm.language import op12_language
from docflow.llm.licenses import op9_licenses
from docflow.llm.neardup import op3_minhash_dedup
from docflow.llm.packing import op8_packing
from docflow.llm.pii import op10_pii
from docflow.llm.quality import op5_quality
from docflow.llm.sharding import op1_sharding
from docflow.llm.token_counts import op7_token_counts
from docflow.llm.toxicity import op6_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_decontamination": op2_decontamination,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_quality": op5_quality,
    "op6_toxicity": op6_toxicity,
    "op7_token_counts": op7_token_counts,
    "op8_packing": op8_packing,
    "op9_licenses": op9_licenses,
    "op10_pii": op10_pii,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_language": op12_language,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP2 = f"""
    WITH doc AS (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents
    ), item AS (
        SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM benchmark
    ), item_start AS (
        SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM item WHERE len(w) > 0
    ), wanted AS (
        SELECT DISTINCT item, array_to_string(w[s : s + 9], ' ') AS gram, least(len(w), 10) AS width FROM item_start
    ), doc_start AS (
        SELECT r, w, width, unnest(range(1, len(w) - width + 2)) AS s FROM doc, (SELECT DISTINCT width FROM wanted) WHERE len(w) >= width
    ), hits AS (
        SELECT r, s, d.width, item FROM (SELECT r, s, width, array_to_string(w[s : s + width - 1], ' ') AS gram FROM doc_start) d
        JOIN wanted USING (gram, width)
    ), hit_words AS (
        SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + width)) AS p FROM hits) GROUP BY r
    ), hit_items AS (
        SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM doc LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""

_OP11 = """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), s AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
        FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
    ), pos AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM pos JOIN s USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
    QUALIFY rank <= 5
"""

ORACLE: dict[str, str] = {"op2_decontamination": _OP2, "op11_hard_negatives": _OP11}
