"""Change events of a store when several versions carry one crawl time."""

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from docflow.plans.ingest import pages_batch_writer
from docflow.session import scratch_path
from docflow.sinks.keyed_store import store_changes

DOC = StructType([StructField("id", LongType()), StructField("name", StringType())])


def test_update_at_an_equal_crawl_time_is_an_event(spark):
    root = scratch_path(spark, "same_time_store")
    write = pages_batch_writer(root, DOC, ["name"], buckets=2)

    def batch(number, page, body):
        df = spark.createDataFrame([(page, body)], "page int, body string")
        write(df.withColumn("crawled_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")), number)
        return sorted((r.operationType, r.fullDocument._id, r.fullDocument.doc) for r in store_changes(spark, root, "_id").collect())

    assert len(batch(0, 1, '{"data":[{"id":1,"name":"a","x":1},{"id":2,"name":"b","x":2},{"id":3,"name":"c"}]}')) == 3
    second = batch(1, 2, '{"data":[{"id":1,"name":"z"},{"id":2,"y":5},{"x":2,"name":"b","id":2},{"id":3,"name":"c"}]}')
    assert [(kind, i) for kind, i, _ in second] == [("update", 1), ("update", 2)]
    assert second[0][2]["name"] == "z" and second[0][2]["x"] == "1" and second[1][2]["y"] == "5"
    assert batch(2, 3, '{"data":[{"y":5,"x":2,"name":"b","id":2},{"id":3,"name":"c"}]}') == []
