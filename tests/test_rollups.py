"""Stored cells give the facets that the documents give."""

import pytest
from pyspark.sql import functions as F

from docindex.operators import facets
from docindex.sources import log, rollups
from docindex.sources.store import read_index, write_records

CELLS = rollups.Rollup("ts", "hour", ("k",), (("v", "long"),))


def rows(spark, low, high, factor=1):
    i = F.col("id")
    return spark.range(low, high).select(
        i.alias("n"), F.when(i % 11 > 0, F.concat(F.lit("k"), i % 4)).alias("k"), F.when(i % 7 > 0, i * factor).alias("v"),
        F.when(i % 13 > 0, F.timestamp_seconds(i * 5000).cast("timestamp_ntz")).alias("ts"))


def alike(got, want):
    got, want = (sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr) for df in (got, want))
    assert got == want != []


def test_cells_after_updates(spark, root):
    write_records(rows(spark, 0, 300), root, "es://a/b", id_field="n")
    rollups.build(spark, root, CELLS)
    write_records(rows(spark, 290, 500, 3), root, "es://a/b", id_field="n")
    write_records(rows(spark, 500, 600), root, "es://c/b", id_field="n")
    for _ in range(2):  # with cells to make, then with all of them stored
        docs, cells = read_index(spark, root, "es://a,c/b"), rollups.cells(spark, root, CELLS, "es://a,c/b")
        for interval in ("hour", "day", "week", "month"):
            alike(rollups.date_histogram(cells, CELLS, interval, "v"), facets.date_histogram(docs, "ts", interval, "v"))
        alike(rollups.date_histogram(cells, CELLS, "day", zone="Europe/Paris"), facets.date_histogram(docs, "ts", "day", zone="Europe/Paris"))
        alike(rollups.terms_stats(cells, CELLS, "k", "v", order="total"), facets.terms_stats(docs, "k", "v", order="total"))
        first = F.col("k") == "k1"
        one = facets.statistical(docs, "v", first).select("count", "total", "min", "max", "mean", F.col("sum_of_squares").cast("long").alias("sum_of_squares"))
        alike(rollups.statistical(cells, CELLS, "v", first), one)
        rollups.build(spark, root, CELLS)
    assert "_source" not in cells._jdf.queryExecution().optimizedPlan().toString()


def test_a_second_build_adds_nothing(spark, root):
    write_records(rows(spark, 0, 50), root, "es://a/b", id_field="n")
    for _ in range(2):
        rollups.build(spark, root, CELLS)
        assert len(log.Folder(spark, root).names(f"{CELLS.folder}/places")) == 1


def test_intervals_that_cells_do_not_make(spark, root):
    write_records(rows(spark, 0, 50), root, "es://a/b", id_field="n")
    cells = rollups.cells(spark, root, CELLS)
    for options in ({"interval": "minute"}, {"interval": "2h"}, {"interval": "day", "zone": "Asia/Kolkata"}):
        with pytest.raises(ValueError, match="whole cells"):
            rollups.date_histogram(cells, CELLS, **options)
    with pytest.raises(ValueError, match="interval"):
        rollups.Rollup("ts", "week")
