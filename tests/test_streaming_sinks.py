"""File-source stream with availableNow, restart, batch replay, quarantine; file sinks."""

import json
import os

from docflow.functions.columns import NEGOTIABLE_LABEL
from docflow.plans.jobs import jobs_table
from docflow.schemas import JOB_SCHEMA
from docflow.session import scratch_path
from docflow.sinks.files import committed_versions, read_store, write_batch, write_jsonl, write_store
from docflow.sinks.jdbc import jdbc_properties, write_jdbc
from docflow.sources.stream import kafka_options, stream_documents
from docflow.streaming.runner import decode_to_files, run_stream

DOC1 = '{"_id":1,"requirements_arr":[{"value":["x","y"]}],"salary":{"is_negotiable":"1","value":"v"}}'
DOC2 = '{"_id":2,"benefits":[{"value":"b"}],"salary":{"is_negotiable":"0","value":"v2"}}'


def _land(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def _run(spark, src_dir, out, bad, chk):
    src = stream_documents(spark, "text", src_dir)
    q = run_stream(src, decode_to_files(JOB_SCHEMA, jobs_table, out, bad), chk, trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None
    return q


def test_stream_restart_and_quarantine(spark):
    base = scratch_path(spark, "t_stream")
    src, out, bad, chk = (f"{base}/{x}" for x in ("src", "out", "bad", "chk"))
    _land(src, "a.txt", [DOC1, "not json"])
    _run(spark, src, out, bad, chk)
    got = {r.id: (r.requirement, r.salary, r.batch_id) for r in spark.read.parquet(out).collect()}
    assert got == {1: ("x, y", NEGOTIABLE_LABEL, 0)}
    assert [r.raw_value for r in spark.read.parquet(bad).collect()] == ["not json"]
    # restart without new input: no new batch
    _run(spark, src, out, bad, chk)
    assert spark.read.parquet(out).count() == 1
    # new file forms batch 1 only
    _land(src, "b.txt", [DOC2])
    _run(spark, src, out, bad, chk)
    got = {r.id: r.batch_id for r in spark.read.parquet(out).collect()}
    assert got == {1: 0, 2: 1}


def test_replayed_batch_id_is_idempotent(spark, text_df):
    base = scratch_path(spark, "t_replay")
    fn = decode_to_files(JOB_SCHEMA, jobs_table, f"{base}/out", f"{base}/bad")
    batch = text_df([DOC1, DOC2])
    fn(batch, 0)
    fn(batch, 0)
    fn(text_df([DOC2]), 1)
    out = spark.read.parquet(f"{base}/out")
    assert sorted((r.id, r.batch_id) for r in out.collect()) == [(1, 0), (2, 0), (2, 1)]


def test_write_batch_replaces_only_its_partition(spark):
    path = scratch_path(spark, "t_batch")
    write_batch(spark.range(3), path, 0)
    write_batch(spark.range(5), path, 1)
    write_batch(spark.range(2), path, 0)
    counts = {r.batch_id: r["count"] for r in spark.read.parquet(path).groupBy("batch_id").count().collect()}
    assert counts == {0: 2, 1: 5}


def test_jsonl_round_trip_keeps_utf8(spark, text_df):
    path = scratch_path(spark, "t_jsonl")
    from docflow.operators.decode import parse

    table = jobs_table(parse(text_df([DOC1, DOC2]), JOB_SCHEMA))
    write_jsonl(table, path, single_file=True)
    back = spark.read.schema(table.schema).json(path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, table.collect()))
    raw = "".join(open(os.path.join(path, f), encoding="utf-8").read() for f in os.listdir(path) if f.endswith(".json"))
    assert NEGOTIABLE_LABEL in raw
    assert json.loads(raw.splitlines()[0])["id"] in (1, 2)


def test_versioned_store(spark):
    root = scratch_path(spark, "t_store")
    assert read_store(spark, root) is None
    assert write_store(spark, spark.range(3), root) == 1
    assert write_store(spark, spark.range(4), root) == 2
    assert committed_versions(spark, root) == [1, 2]
    assert read_store(spark, root).count() == 4


def test_connector_option_builders(spark):
    opts = kafka_options("broker:9092", "db.jobs", max_offsets_per_trigger=1000)
    assert opts["subscribe"] == "db.jobs" and opts["startingOffsets"] == "earliest"
    assert opts["maxOffsetsPerTrigger"] == "1000"
    assert jdbc_properties("u", "p", "org.postgresql.Driver") == {
        "user": "u", "password": "p", "driver": "org.postgresql.Driver"
    }
    try:
        write_jdbc(spark.range(1), "jdbc:none", "t", mode="merge")
    except ValueError:
        pass
    else:
        raise AssertionError("bad mode accepted")


def test_jsonl_keeps_microseconds(spark):
    import datetime as dt

    from docflow.sinks.files import JSON_TIME_OPTIONS

    path = scratch_path(spark, "t_jsonl_us")
    ts = dt.datetime(2024, 1, 1, 3, 30, 4, 729045)
    df = spark.createDataFrame([(1, ts)], "id int, t timestamp_ntz")
    write_jsonl(df, path)
    back = spark.read.schema(df.schema).options(**JSON_TIME_OPTIONS).json(path).collect()
    assert back[0].t == ts


def test_batch_function_accepts_binary_value(spark):
    base = scratch_path(spark, "t_binary")
    fn = decode_to_files(JOB_SCHEMA, jobs_table, f"{base}/out", f"{base}/bad")
    kafka_like = spark.createDataFrame(
        [(b"k", bytearray(DOC1.encode()), "topic", 0, 0)], "key binary, value binary, topic string, partition int, offset long"
    )
    fn(kafka_like, 0)
    assert [r.id for r in spark.read.parquet(f"{base}/out").collect()] == [1]
