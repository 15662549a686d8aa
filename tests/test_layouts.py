"""Every write layout reports and keeps all rows, none included."""

import pytest
from pyspark.sql import functions as F

from docindex.sources.store import json_documents, read_index, write_documents

LAYOUTS = [{}, {"rebalance": True}, {"shards": 4}, {"shards": 4, "salt": 3}, {"bulk_size": 10}]


@pytest.mark.parametrize("layout", LAYOUTS, ids=str)
@pytest.mark.parametrize("rows", [0, 1000])
def test_layout(spark, root, layout, rows):
    lines = spark.range(0, rows, 1, 4).select(F.when(
        F.col("id") % 10 == 9, F.lit("broken")).otherwise(
        F.format_string('{"_index":"i%d","n":%d}', F.col("id") % 3, "id")).alias("value"))
    done = write_documents(json_documents(lines), root, **layout)
    assert (done.records, done.rejected) == (rows * 9 // 10, rows // 10)
    docs = read_index(spark, root, "es://_all")
    assert docs.count() == done.records
    assert docs.agg(F.sum(F.octet_length("_source"))).first()[0] == (done.bytes or None)


@pytest.mark.parametrize("layout", LAYOUTS, ids=str)
def test_layout_of_filtered_out_rows(spark, root, layout):
    lines = spark.range(100).select(F.lit("{}").alias("value"), "id").repartition(3).where("id > 500").select("value")
    done = write_documents(json_documents(lines), root, **layout)
    assert (done.records, done.bytes, done.rejected) == (0, 0, 0)
