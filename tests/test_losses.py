"""Fields that a typed decode loses, against plain Python."""

import json
import random

from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, MapType, StringType, StructField, StructType

from docflow.operators.losses import decode_errors, parse_with_losses

SCHEMA = StructType([
    StructField("_id", LongType()), StructField("n", IntegerType()), StructField("t", StringType()), StructField("b", BooleanType()),
    StructField("o", StructType([StructField("$date", LongType()), StructField("x y", StringType())])),
    StructField("items", ArrayType(StructType([StructField("id", IntegerType()), StructField("tags", ArrayType(StringType()))]))),
    StructField("nums", ArrayType(IntegerType())), StructField("m", MapType(StringType(), IntegerType())),
])


def lost(text_df, lines):
    return sorted((r._id, r.path, r.raw_value) for r in decode_errors(text_df(lines), SCHEMA).collect())


def test_each_kind_of_loss(text_df):
    docs = [
        {"_id": 1, "n": 1, "t": 5, "b": True, "o": {"$date": 1}, "items": [{"id": 1, "tags": ["a"]}], "nums": [1], "m": {"k": 1}, "surplus": "x"},
        {"_id": 2, "n": "1", "b": "yes", "o": {"$date": "soon", "x y": {"k": 1}}},
        {"_id": 3, "n": 2**40, "o": [1], "items": {"id": 1}, "nums": "1", "m": [1]},
        {"_id": 4, "items": [{"id": "z", "tags": ["a", None, 5]}, {"id": 2, "tags": "a"}, None], "n": None, "o": None},
        {"_id": 5, "nums": [1, "q", 3], "m": {"a": 1, "b": "x"}},
    ]
    assert lost(text_df, [json.dumps(d) for d in docs]) == [
        (2, "$.b", '"yes"'), (2, "$.n", '"1"'), (2, "$.o.$date", '"soon"'),
        (3, "$.items", '{"id":1}'), (3, "$.m", "[1]"), (3, "$.n", str(2**40)), (3, "$.nums", '"1"'), (3, "$.o", "[1]"),
        (4, "$.items[0].id", '"z"'), (4, "$.items[1].tags", '"a"'),
        (5, "$.m", '{"a":1,"b":"x"}'), (5, "$.nums", '[1,"q",3]'),
    ]


def walk(raw, typed, path):
    """Losses of a value that is in the document (None: absent or null), in plain Python."""
    if raw is None:
        return []
    if typed is None:
        return [(path, raw)]
    if isinstance(typed, dict):
        return [x for k, v in typed.items() for x in walk(raw.get(k), v, f"{path}.{k}")]
    if isinstance(typed, list):
        return [x for i, v in enumerate(raw) for x in walk(v, typed[i], f"{path}[{i}]")]
    return []


def test_many_documents_against_plain_python(text_df):
    rng = random.Random(4)
    leaf = lambda: rng.choice([None, 1, 2**40, 1.5, "x", "7", True, [], {}, [1, "a"], {"id": 1}, {"$date": 3}])
    item = lambda: rng.choice([leaf(), {"id": leaf(), "tags": leaf()}, {"id": 3, "tags": ["a", leaf()]}])
    docs = []
    for k in range(400):
        doc = {"_id": k, "n": leaf(), "t": leaf(), "b": leaf(), "o": rng.choice([leaf(), {"$date": leaf(), "x y": leaf()}]), "items": rng.choice([leaf(), [item() for _ in range(rng.randint(0, 3))]]), "nums": leaf(), "m": leaf(), "more": leaf()}
        docs.append({f: v for f, v in doc.items() if f == "_id" or rng.random() < 0.7})
    rows = parse_with_losses(text_df([json.dumps(d) for d in docs]), SCHEMA).collect()
    assert len(rows) == 400 and sum(len(r.lost) for r in rows) > 300
    for r in rows:
        typed = {k: v for k, v in r.asDict(recursive=True).items() if k != "lost"}
        want = [(p, json.dumps(v, separators=(",", ":"))) for p, v in walk(docs[r._id], typed, "$")]
        assert [(x.path, x.raw_value) for x in r.lost] == want


def test_unreadable_text_nulls_and_lost_keys(text_df):
    assert lost(text_df, ["bad{", '{"_id":"x","n":1}', "5", "[]", '[{"_id":9}]']) == [(None, "$", "5"), (None, "$", "[]"), (None, "$", '[{"_id":9}]'), (None, "$", "bad{"), (None, "$._id", '"x"')]
    assert lost(text_df, [None, "{}", '{"_id":1}', "null"]) == []


def test_one_decode_and_no_shuffle(text_df):
    plan = decode_errors(text_df(['{"_id":1}']), SCHEMA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1 and plan.count("try_parse_json") + plan.count("parse_json") <= 2 and "Exchange" not in plan


def test_field_names_that_a_path_cannot_spell(text_df):
    names = ["a.b", "x y", "a[0]", "it's", 'q"', " lead", "größe"]
    schema = StructType([StructField("_id", LongType()), StructField("o", StructType([StructField(n, IntegerType()) for n in names]))])
    text = [json.dumps({"_id": 1, "o": {n: "lost" for n in names}}), json.dumps({"_id": 2, "o": {n: 1 for n in names}}), json.dumps({"_id": 3, "o": {n: None for n in names}, "a": "x"})]
    got = [(r._id, r.path, r.raw_value) for r in decode_errors(text_df(text), schema).collect()]
    assert got == [(1, f"$.o.{n}", '"lost"') for n in names]


def test_documents_of_the_query_are_built_once(spark):
    from docflow.queries_documents import q_decode_errors

    plan = q_decode_errors(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1 and plan.count("collect_list(i") == 1
