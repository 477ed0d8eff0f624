"""Plan-shape checks for the scale claims in the README (executed plans, sf0.001)."""

import re

from docflow.operators.decode import parse
from docflow.operators.flatten import collect_concat, explode_elements
from docflow.plans.jobs import jobs_batch_table, jobs_table
from docflow.schemas import JOB_SCHEMA
from docflow.sources import driver_tables as dt
from docflow.sources.feed import insert_feed

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    p = qe.executedPlan().toString()
    if "== Final Plan ==" in p:
        p = p.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return p


def test_documents_are_decoded_once(spark):
    docs = parse(dt.job_json(spark, SF), JOB_SCHEMA)
    for table in (jobs_table(docs), jobs_batch_table(docs)):
        assert len(re.findall(r"from_json\(", _plan(table))) == 1


def test_document_build_has_no_join(spark):
    p = _plan(dt.job_documents(spark, SF))
    assert "SortMergeJoin" not in p and "BroadcastHashJoin" not in p
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 2


def test_collect_concat_combines_before_each_shuffle(spark):
    ex = explode_elements(parse(dt.job_json(spark, SF), JOB_SCHEMA), "_id", "requirements_arr")
    p = _plan(collect_concat(ex, "_id", "text"))
    assert p.count("partial_collect_list") >= 2


def test_feed_tagging_uses_no_window(spark):
    p = _plan(insert_feed(dt.change_events(spark, SF)))
    assert "Window" not in p
