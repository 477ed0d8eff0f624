"""Property: row-local flatten == explode + ordered aggregate + left join, for unique ids.

Random documents cover NULL / empty arrays, NULL elements, NULL inner values and
scalar vs array `value` fields. One Spark job per example batch keeps it fast.
"""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from docflow.operators.decode import parse
from docflow.operators.flatten import attach_text, collect_concat, explode_elements, flatten_text
from docflow.schemas import JOB_SCHEMA

text = st.one_of(st.none(), st.text(alphabet="abcxyz ,", max_size=4))
req_elem = st.one_of(st.none(), st.fixed_dictionaries({"value": st.one_of(st.none(), st.lists(text, max_size=4))}))
ben_elem = st.one_of(st.none(), st.fixed_dictionaries({"value": text}))
arrays = lambda e: st.one_of(st.none(), st.lists(e, max_size=6))
docs = st.lists(st.tuples(arrays(req_elem), arrays(ben_elem)), min_size=1, max_size=25)


def _doc(i, req, ben):
    d = {"_id": i}
    if req is not None:
        d["requirements_arr"] = req
    if ben is not None:
        d["benefits"] = ben
    return json.dumps(d)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(docs)
def test_row_local_equals_aggregate_shape(spark, batch):
    lines = [(_doc(i, r, b),) for i, (r, b) in enumerate(batch)]
    d = parse(spark.createDataFrame(lines, "value string"), JOB_SCHEMA)
    for arr in ("requirements_arr", "benefits"):
        local = flatten_text(d, arr, "t").select("_id", "t")
        agg = collect_concat(explode_elements(d, "_id", arr), "_id", "text", out="t", bucket=2)
        joined = attach_text(d.select("_id"), agg, "_id", "left")
        a = sorted(map(tuple, local.collect()), key=repr)
        b = sorted(map(tuple, joined.collect()), key=repr)
        assert a == b, arr
