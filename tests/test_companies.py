"""Company projection (FIXTURES.md section 3): first address or NULL, never an error."""

from pyspark.sql.types import Row

from docflow.plans.companies import companies_table
from docflow.schemas import COMPANIES_COLUMNS, COMPANY_SCHEMA


def test_first_address(spark):
    rows = [
        Row(_id=1, addresses=Row(full_addresses=["p", "q"])),
        Row(_id=2, addresses=Row(full_addresses=[])),
        Row(_id=3, addresses=Row(full_addresses=None)),
        Row(_id=4, addresses=None),
    ]
    full = [
        {f.name: getattr(r, f.name, None) for f in COMPANY_SCHEMA.fields} for r in rows
    ]
    df = spark.createDataFrame([tuple(d[f.name] for f in COMPANY_SCHEMA.fields) for d in full], COMPANY_SCHEMA)
    out = companies_table(spark, df, view="t_companies")
    assert out.columns == COMPANIES_COLUMNS
    assert {r.id: r.address for r in out.collect()} == {1: "p", 2: None, 3: None, 4: None}


def test_scan_with_inferred_schema(spark):
    """Collections can also be scanned with an inferred schema, as a document store reads them."""
    from docflow.session import scratch_path
    from docflow.sinks.files import write_jsonl
    from docflow.sources import driver_tables as dt
    from docflow.sources.collection import scan_collection

    path = scratch_path(spark, "t_infer")
    write_jsonl(dt.company_documents(spark, "/root/testdata/sf0.001"), path)
    docs = scan_collection(spark, "json", path, options={"samplingRatio": "0.5"}, view="t_inferred")
    out = companies_table(spark, docs, view="t_inferred")
    assert out.columns == COMPANIES_COLUMNS
    got = {r.id: r.address for r in out.collect()}
    assert len(got) == 150 and got[0] == "Customer#000000000"
