"""Schema inference over all documents: the type rule, conflicts, what is put aside."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docflow.session import scratch_path
from docflow.sources.inferred import decode_inferred, infer_schema, scan_inferred


def kinds(inferred):
    return {f.name: f.dataType.simpleString() for f in inferred.schema.fields}


def test_rule_for_types(text_df):
    docs = [
        {"i": 1, "d": 1, "e": 1.5, "t": "x", "o": {"$date": 5, "p q": [1]}, "mixed": 1, "deep": {"a": [{"x": 1}]}, "void": None, "empty": {}, "none": []},
        {"i": 2**40, "d": 1.25, "e": 1e300, "o": {"$date": None}, "mixed": {"k": [1]}, "deep": {"a": [{"x": "s", "y": True}]}, "none": None, "a`b.c": 1},
    ]
    got = infer_schema(text_df([json.dumps(d) for d in docs]))
    assert kinds(got) == {
        "i": "bigint", "d": "decimal(22,2)", "e": "double", "t": "string", "o": "struct<$date:bigint,p q:array<bigint>>", "mixed": "string",
        "deep": "struct<a:array<struct<x:string,y:boolean>>>", "void": "string", "empty": "string", "none": "array<string>", "a`b.c": "bigint",
    }
    assert set(got.conflicts) == {"mixed", "deep.a[].x"}


def test_conflicting_values_keep_their_text(text_df):
    values = [1, 1.5, "1", True, None, [1, "a"], {"k": None}]
    docs, bad, inferred = decode_inferred(text_df([json.dumps({"_id": k, "v": v}) for k, v in enumerate(values)]))
    assert inferred.conflicts == ("v",) and bad.count() == 0
    assert {r._id: r.v for r in docs.collect()} == {0: "1", 1: "1.5", 2: "1", 3: "true", 4: None, 5: '[1,"a"]', 6: '{"k":null}'}


def test_rare_fields_and_conflicts_are_found_without_sampling(spark):
    rows = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") == 29999, F.lit('{"_id":29999,"n":"late","rare":{"x":1}}')).otherwise(F.to_json(F.struct(F.col("id").alias("_id"), F.lit(7).alias("n")))).alias("value")
    )
    got = infer_schema(rows)
    assert kinds(got) == {"_id": "bigint", "n": "string", "rare": "struct<x:bigint>"} and got.conflicts == ("n",)


def test_what_is_no_object_is_kept_aside(spark, text_df):
    lines = ['{"_id":1}', "5", "[1]", "bad{", None, '"text"', "null", '{"_id":2,"_id":3}']
    docs, bad, _ = decode_inferred(text_df(lines))
    assert [r._id for r in docs.collect()] == [1]
    assert sorted((r.reason, r.raw_value or "") for r in bad.collect()) == [
        ("malformed", "bad{"), ("malformed", '{"_id":2,"_id":3}'), ("not_an_object", '"text"'), ("not_an_object", "5"), ("not_an_object", "[1]"), ("not_an_object", "null"), ("null_input", "")
    ]
    for none in (["5"], [], ["{}"], [None]):
        with pytest.raises(ValueError):
            infer_schema(text_df(none) if none else spark.createDataFrame([], "value string"))


def test_scan_registers_a_view_and_shuffles_types_only(spark, text_df):
    path = scratch_path(spark, "t_inferred")
    text_df(['{"_id":1,"tags":["a","b"]}', '{"_id":2,"tags":null}']).write.text(path)
    docs, _, inferred = scan_inferred(spark, path, view="t_inferred_view")
    assert spark.sql("SELECT sum(_id), sum(size(tags)) FROM t_inferred_view WHERE tags IS NOT NULL").first()[:] == (1, 2)
    assert isinstance(inferred.schema["tags"].dataType.elementType, StringType)
    assert "Exchange" not in docs._jdf.queryExecution().executedPlan().toString()
    assert docs._jdf.queryExecution().executedPlan().toString().count("from_json") == 1
