"""Clustered indices give the same documents and read few row groups."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from docindex.sources.store import compact, read_index, write_records

ROWS = 60_000


def scanned(docs):
    """Rows that the scans of an answer passed on, and the answer's rows."""
    rows = docs.collect()
    leaves = docs._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(k).metrics().get("numOutputRows").get().value() for k in range(leaves.size())), rows


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    """Every tenth document is routed by itself, a third has one routing value, the rest has 1,000."""
    path = str(tmp_path_factory.mktemp("clustered"))
    k = F.col("id")
    rows = spark.range(0, ROWS, 1, 8).select(
        F.sha2(k.cast("string"), 256).alias("key"), "id",
        F.when(k % 10 == 0, None).when(k % 3 == 0, "hot").otherwise(F.format_string("r%04d", F.pmod(F.xxhash64("id"), F.lit(1000)))).alias("route"))
    write_records(rows, f"{path}/plain", "es://a/b", id_field="key", routing_field="route")
    for order in ("routing", "id"):
        compact(spark, f"{path}/plain", f"{path}/{order}", cluster=order, row_group_bytes=64 << 10)
    return path


@pytest.mark.parametrize("order", ["routing", "id"])
def test_clusters_hold_the_same_documents(spark, clustered, order):
    columns = ["_id", "_routing", "_source", "id", "route"]
    got, want = (read_index(spark, f"{clustered}/{r}", "es://a/b").select(columns) for r in (order, "plain"))
    assert got.count() == ROWS == got.select("_id").distinct().count()
    assert got.exceptAll(want).isEmpty()


def test_a_routed_read_skips_row_groups(spark, clustered):
    values = ["r0007", "r0500", "none"]
    read, rows = scanned(read_index(spark, f"{clustered}/routing", "es://a/b", routing=values))
    want = read_index(spark, f"{clustered}/plain", "es://a/b").where(F.col("route").isin(values))
    assert sorted(r["_id"] for r in rows) == sorted(r["_id"] for r in want.collect()) != []
    assert read < ROWS / 10


def test_documents_without_a_value_are_routed_by_their_id(spark, clustered):
    own = read_index(spark, f"{clustered}/plain", "es://a/b").where("_routing IS NULL").orderBy("id").first()["_id"]
    read, rows = scanned(read_index(spark, f"{clustered}/routing", "es://a/b", routing=own))
    assert [r["_id"] for r in rows] == [own]
    assert read < ROWS / 10


def test_a_hot_value_is_cut(spark, clustered):
    files = glob.glob(f"{clustered}/routing/**/*.parquet", recursive=True)
    groups = [pq.ParquetFile(f).metadata for f in files]
    assert max(m.row_group(k).num_rows for m in groups for k in range(m.num_row_groups)) < ROWS / 10
    assert read_index(spark, f"{clustered}/routing", "es://a/b", routing="hot").count() == sum(k % 3 == 0 and k % 10 > 0 for k in range(ROWS))


@pytest.mark.parametrize("order", ["routing", "id"])
def test_a_look_up_by_id_skips_row_groups(spark, clustered, order):
    plain = read_index(spark, f"{clustered}/plain", "es://a/b").where("id IN (5, 30000)")
    ids = [r["_id"] for r in plain.collect()]
    read, rows = scanned(read_index(spark, f"{clustered}/{order}", "es://a/b", query={"ids": {"values": ids}}))
    assert sorted(r["_id"] for r in rows) == sorted(ids)
    assert read < ROWS / 10


def test_an_empty_index_and_an_unknown_order(spark, root):
    none = spark.createDataFrame([], "k string, r string")
    write_records(none, root, "es://a/b", id_field="k", routing_field="r")
    compact(spark, root, root + "-c", cluster="routing")
    assert read_index(spark, root + "-c", "es://a/b", routing="x").count() == 0
    with pytest.raises(ValueError, match="unknown order"):
        compact(spark, root, root + "-d", cluster="size")
