"""DuckDB SQL equivalents of the registered queries, over the flat driver tables.

Each statement computes from `orders`, `lineitem`, `customer`, `events` what the
Spark query computes from the nested documents built out of the same tables.
Column names and types match the Spark output.
"""

from __future__ import annotations

LABEL = "Thương lượng"  # fixed value, written out: the oracle shares nothing with the code it checks

_REQ = """
    SELECT l_orderkey,
           string_agg(concat_ws(', ', l_returnflag, l_linestatus), ', '
                      ORDER BY l_linenumber, l_returnflag, l_linestatus) AS requirement,
           string_agg(CAST(l_linenumber AS VARCHAR), ', '
                      ORDER BY l_linenumber, l_returnflag, l_linestatus) AS benefit
    FROM lineitem GROUP BY l_orderkey
"""

_JOBS = f"""
    SELECT o.o_orderkey AS id,
           o.o_orderpriority AS title,
           o.o_orderstatus AS content,
           o.o_custkey AS owned_id,
           o.o_orderpriority AS skills,
           '/jobs/' || CAST(o.o_orderkey AS VARCHAR) AS url,
           r.requirement,
           r.benefit,
           o.o_orderdate AS inserted_at,
           o.o_orderdate + INTERVAL 1 DAY AS updated_at,
           CASE WHEN o.o_orderstatus = 'O' THEN '{LABEL}' ELSE o.o_orderstatus END AS salary
    FROM orders o LEFT JOIN ({_REQ}) r ON o.o_orderkey = r.l_orderkey
"""

_COMPANIES = """
    SELECT c_custkey AS id,
           'logo/' || CAST(c_custkey AS VARCHAR) AS image,
           c_name AS name,
           c_mktsegment AS size,
           CAST(c_nationkey AS VARCHAR) AS num_employees,
           c_mktsegment AS industry,
           CAST(c_nationkey AS VARCHAR) AS nationality,
           CASE WHEN c_acctbal > 0 THEN c_name END AS address,
           '/companies/' || CAST(c_custkey AS VARCHAR) AS url,
           TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey) AS inserted_at,
           TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey) + INTERVAL 1 DAY AS updated_at
    FROM customer
"""

_UPSERT = """
    SELECT user_id,
           arg_max_null(event_type, (ts, event_id)) AS event_type,
           arg_max_null(value, (ts, event_id)) AS value,
           arg_max_null(props, (ts, event_id)) AS props,
           min(ts) AS inserted_at,
           max(ts) AS updated_at
    FROM events GROUP BY user_id
"""


def _field(name: str) -> str:
    return (
        f"arg_max_null(CASE WHEN value < 2.0 THEN NULL ELSE event_id END, (ts, event_id)) "
        f"FILTER (WHERE event_type = '{name}') AS {name}"
    )


_FIELDS = f"""
    SELECT user_id,
           {', '.join(_field(f) for f in ('click', 'error', 'purchase', 'signup', 'view'))},
           min(ts) AS inserted_at,
           max(ts) AS updated_at
    FROM events GROUP BY user_id
"""

_JOBS_SQL = f"SELECT * FROM ({_JOBS})"

ORACLE: dict[str, str] = {
    "json_decode": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
    """,
    "flatten_left": f"SELECT id, requirement FROM ({_JOBS})",
    "flatten_inner": f"""
        SELECT id, title, content, owned_id, skills, o.o_orderstatus AS salary, url, requirement,
               inserted_at, updated_at
        FROM ({_JOBS}) j JOIN orders o ON o.o_orderkey = j.id
        WHERE requirement IS NOT NULL
    """,
    "salary_label": f"SELECT id, salary FROM ({_JOBS})",
    "epoch_millis": f"SELECT id, inserted_at, updated_at FROM ({_JOBS})",
    "explode_requirements": """
        SELECT l_orderkey AS id,
               row_number() OVER (PARTITION BY l_orderkey
                                  ORDER BY l_linenumber, l_returnflag, l_linestatus) - 1 AS pos,
               concat_ws(', ', l_returnflag, l_linestatus) AS requirement
        FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
    """,
    "collect_concat": f"""
        SELECT l_orderkey AS id, requirement FROM ({_REQ})
        WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
    """,
    "left_join_details": f"SELECT id, title, requirement, benefit FROM ({_JOBS})",
    "company_projection": _COMPANIES,
    "scan_collection": _COMPANIES,
    "insert_feed": """
        SELECT user_id AS _id, event_id, event_type, ts FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id NULLS FIRST) AS rn FROM events
        ) WHERE rn = 1
    """,
    "page_unwrap": """
        SELECT c_custkey AS _id, c_name AS display_name, CAST(floor(c_custkey / 100) AS INTEGER) AS page
        FROM customer
    """,
    "ingest_pages": """
        SELECT c_custkey AS _id,
               CASE WHEN c_acctbal <= 0 THEN c_mktsegment ELSE c_name END AS display_name,
               c_mktsegment AS company_size,
               CAST(c_nationkey AS VARCHAR) AS nationalities_str,
               TIMESTAMP '2024-02-01 00:00:00' AS inserted_at,
               CASE WHEN c_acctbal <= 0 THEN TIMESTAMP '2024-02-02 00:00:00'
                    ELSE TIMESTAMP '2024-02-01 00:00:00' END AS updated_at
        FROM customer
    """,
    "upsert_latest": _UPSERT,
    "upsert_incremental": _UPSERT,
    "upsert_fields": _FIELDS,
    "jobs_batch": _JOBS_SQL,
    "jobs_stream": _JOBS_SQL,
    "stream_documents": """
        SELECT o_orderkey AS id, o_orderpriority AS title, o_orderstatus AS content, o_custkey AS owned_id,
               '/jobs/' || CAST(o_orderkey AS VARCHAR) AS url
        FROM orders
    """,
    "jsonl_sink": _JOBS_SQL,
}
ORACLE["inner_join_requirements"] = ORACLE["flatten_inner"]
ORACLE["upsert_open_fields"] = """
    SELECT user_id, field, value, inserted_at, updated_at FROM (
        SELECT user_id, event_type AS field,
               arg_max_null(CASE WHEN value < 2.0 THEN NULL ELSE event_id END, (ts, event_id)) AS value
        FROM events GROUP BY user_id, event_type
    ) JOIN (SELECT user_id, min(ts) AS inserted_at, max(ts) AS updated_at FROM events GROUP BY user_id) USING (user_id)
"""
ORACLE["ingest_pages_stream"] = ORACLE["ingest_pages"]
ORACLE["insert_feed_stream"] = ORACLE["insert_feed"]
ORACLE["ingest_partial_pages"] = ORACLE["ingest_pages"]
ORACLE["stream_restart"] = _JOBS_SQL
ORACLE["stream_quarantine"] = """
    SELECT 'valid' AS kind, o_orderkey AS id, NULL::VARCHAR AS raw_value, NULL::VARCHAR AS reason FROM orders
    UNION ALL
    SELECT 'quarantine', NULL, '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}', 'missing_or_invalid_key'
    FROM events
"""
ORACLE["batch_quarantine"] = ORACLE["stream_quarantine"]
ORACLE["store_feed"] = """
    SELECT CASE WHEN c_acctbal > 0 THEN 'update' ELSE 'insert' END AS "operationType",
           c_custkey AS _id, c_mktsegment AS display_name
    FROM customer
"""
