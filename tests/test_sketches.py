"""Stored sketches against exact counts."""

from pyspark.sql import functions as F

from docindex.operators.profile import cardinality
from docindex.sources import sketches
from docindex.sources.store import read_index, write_records

FIELDS = ["kind", "n"]


def near(spark, root, locator):
    exact = {r["field"]: r["values"] for r in cardinality(read_index(spark, root, locator), FIELDS).collect()}
    got = {r["field"]: r["values"] for r in sketches.cardinality(spark, root, FIELDS, locator).collect()}
    assert got.keys() == exact.keys()
    return all(abs(got[f] - exact[f]) <= 0.03 * exact[f] for f in FIELDS)


def test_sketches_merge_over_writes_and_notice_replaced_documents(spark, root):
    for k in range(3):
        rows = spark.range(20_000 * k, 20_000 * k + 30_000).select("id", F.when(F.col("id") % 5 > 0, (F.col("id") % 5).cast("string")).alias("kind"), F.col("id").alias("n"))
        write_records(rows, root, f"es://x{k % 2}/t?id=id")
    sketches.build(spark, root, FIELDS)
    assert all(near(spark, root, locator) for locator in ("es://_all", "es://x0", "es://x1"))
    # Most of one write goes: what is left is sketched again, whether stored or not.
    write_records(spark.range(20_000, 49_000).select("id", F.lit("new").alias("kind"), F.lit(7).cast("long").alias("n")), root, "es://x1/t?id=id")
    assert near(spark, root, "es://x1")
    sketches.build(spark, root, FIELDS)
    _, missing = sketches._known(spark, root, FIELDS, "es://_all")
    assert missing.isEmpty() and near(spark, root, "es://_all")


def test_stored_sketches_are_read_instead_of_documents(spark, root):
    write_records(spark.range(100).select("id", F.lit("a").alias("kind"), F.col("id").alias("n")), root, "es://x/t?id=id")
    sketches.build(spark, root, FIELDS)
    plan = sketches.cardinality(spark, root, FIELDS)._jdf.queryExecution().optimizedPlan().toString()
    assert "_source" not in plan and "_seq" not in plan
    assert sketches.cardinality(spark, root + "-none", FIELDS).count() == 0
