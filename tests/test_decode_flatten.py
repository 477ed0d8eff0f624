"""Job-document edge cases (FIXTURES.md section 1) through decode, flatten and the jobs table."""

import datetime as dt


from docflow.functions.columns import NEGOTIABLE_LABEL
from docflow.operators.decode import decode_documents, parse
from docflow.operators.flatten import attach_text, collect_concat, explode_elements, flatten_text
from docflow.plans.jobs import jobs_batch_table, jobs_table
from docflow.schemas import JOB_SCHEMA, JOBS_BATCH_COLUMNS, JOBS_STREAM_COLUMNS

ROWS = {
    1: '{"_id":1,"requirements_arr":[{"value":["x","y"]},{"value":["z",null]}],'
    '"benefits":[{"value":"b1"},{"value":null}],"salary":{"is_negotiable":"1","value":"v1"}}',
    2: '{"_id":2,"requirements_arr":[],"benefits":[],"salary":{"is_negotiable":"0","value":"v2"}}',
    3: '{"_id":3,"salary":null}',
    4: '{"_id":4,"requirements_arr":[{"value":null},null],"benefits":[null],'
    '"salary":{"is_negotiable":1,"value":"v4"}}',
    5: '{"_id":5,"salary":{"is_negotiable":true,"value":"v5"}}',
    6: '{"_id":6,"requirements_arr":[{"value":"notarray"}],"benefits":[{"value":["p","q"]}]}',
    7: '{"_id":"7","title":"string id"}',
    8: '{"_id":8,"inserted_at":{"$date":"2024-01-01T00:00:00Z"}}',
    12: '{"_id":12,"inserted_at":{"$date":1726358400123},"skills_str":"Java, SQL"}',
}
BAD = ["not json", None, '{"_id":9,"title":"trunc']


def _table(spark, text_df, lines):
    valid, quarantine = decode_documents(text_df(lines), JOB_SCHEMA)
    return {r["id"]: r for r in jobs_table(valid).collect()}, quarantine


def test_jobs_table_edge_rows(spark, text_df):
    out, quarantine = _table(spark, text_df, list(ROWS.values()) + BAD)
    assert set(out) == {1, 2, 3, 4, 5, 6, 8, 12}
    assert (out[1].requirement, out[1].benefit, out[1].salary) == ("x, y, z", "b1, ", NEGOTIABLE_LABEL)
    assert (out[2].requirement, out[2].benefit, out[2].salary) == (None, None, "v2")
    assert (out[3].requirement, out[3].benefit, out[3].salary) == (None, None, None)
    assert (out[4].requirement, out[4].benefit, out[4].salary) == (", ", "", NEGOTIABLE_LABEL)
    assert out[5].salary == "v5"  # boolean true is not the integer 1, and does not throw
    assert (out[6].requirement, out[6].benefit, out[6].salary) == ("", '["p","q"]', None)
    assert out[8].inserted_at is None
    assert out[12].inserted_at == dt.datetime(2024, 9, 15, 0, 0, 0, 123000)
    assert out[12].skills == "Java, SQL"
    assert list(jobs_table(parse(text_df([ROWS[1]]), JOB_SCHEMA)).columns) == JOBS_STREAM_COLUMNS
    q = quarantine.collect()
    assert len(q) == 4  # string id, non-JSON, NULL, truncated
    assert {r.raw_value for r in q} == {ROWS[7], "not json", None, '{"_id":9,"title":"trunc'}
    assert {r.reason for r in q if r.raw_value is None} == {"null_input"}


def test_duplicate_ids_keep_their_own_text(spark, text_df):
    out = jobs_table(parse(text_df([ROWS[1], ROWS[1]]), JOB_SCHEMA)).collect()
    assert [r.requirement for r in out] == ["x, y, z", "x, y, z"]
    assert [r.benefit for r in out] == ["b1, ", "b1, "]


def test_batch_variant_drops_missing_requirements(spark, text_df):
    docs = parse(text_df([ROWS[1], ROWS[2], ROWS[3], ROWS[4]]), JOB_SCHEMA)
    out = jobs_batch_table(docs)
    assert out.columns == JOBS_BATCH_COLUMNS
    got = {r.id: (r.requirement, r.salary) for r in out.collect()}
    assert got == {1: ("x, y, z", "v1"), 4: (", ", "v4")}
    drop = flatten_text(docs, "requirements_arr", "req", missing="drop")
    assert sorted(r._id for r in drop.collect()) == [1, 4]


def test_row_local_flatten_has_no_exchange(spark, text_df):
    docs = parse(text_df([ROWS[1], ROWS[2]]), JOB_SCHEMA)
    plan = jobs_table(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_flatten_equals_aggregate_shape(spark, text_df):
    """Row-local flatten == explode + ordered collect + left join, on unique ids."""
    lines = [ROWS[k] for k in (1, 2, 3, 4, 6)]
    docs = parse(text_df(lines), JOB_SCHEMA)
    a = {r._id: r.t for r in flatten_text(docs, "requirements_arr", "t").select("_id", "t").collect()}
    agg = collect_concat(explode_elements(docs, "_id", "requirements_arr"), "_id", "text", out="t")
    b = {r._id: r.t for r in attach_text(docs.select("_id"), agg, "_id", "left").collect()}
    assert a == b


def test_collect_concat_orders_across_buckets(spark):
    n = 1000
    rows = [(1, i, f"v{i}") for i in reversed(range(n))] + [(2, 0, "only")]
    df = spark.createDataFrame(rows, "k long, pos int, text string").repartition(7)
    got = {r.k: r.text for r in collect_concat(df, "k", "text", bucket=64).collect()}
    assert got[1] == ", ".join(f"v{i}" for i in range(n))
    assert got[2] == "only"


def test_explode_positions(spark, text_df):
    docs = parse(text_df([ROWS[1], ROWS[4]]), JOB_SCHEMA)
    got = sorted((r._id, r.pos, r.text) for r in explode_elements(docs, "_id", "requirements_arr").collect())
    assert got == [(1, 0, "x, y"), (1, 1, "z"), (4, 0, ""), (4, 1, "")]


def test_binary_payload_is_cast(spark):
    from docflow.operators.decode import as_text

    df = spark.createDataFrame([(bytearray(ROWS[1].encode()),)], "value binary")
    out = jobs_table(parse(as_text(df), JOB_SCHEMA)).collect()
    assert out[0].requirement == "x, y, z"


def test_pruned_schema_decodes_same(spark, text_df):
    from docflow.schemas import JOB_FIELDS_USED, prune

    small = prune(JOB_SCHEMA, JOB_FIELDS_USED)
    assert "applied" not in small.fieldNames()
    assert small["requirements_arr"].dataType.elementType.fieldNames() == ["value"]
    lines = [ROWS[k] for k in (1, 2, 3, 4, 5, 6, 8, 12)]
    a = jobs_table(parse(text_df(lines), JOB_SCHEMA)).collect()
    b = jobs_table(parse(text_df(lines), small)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
