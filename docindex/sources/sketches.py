"""Distinct values of fields from stored sketches that merge over writes and indices.

A sketch per field and write is stored once; the number of distinct values of any scope is
the union of its writes' sketches, so neither documents nor values are read again. A sketch
cannot forget: a write from which later ones took documents out is sketched anew from what
is left of it, as is a write that nobody has sketched yet.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from docindex.functions.records import _q
from docindex.locator import Locator
from docindex.sources import catalog, log
from docindex.sources.store import read_index

#: Logarithm of a sketch's buckets: a standard error of 0.8 %.
BUCKETS = 14

STORED = T.StructType([
    T.StructField("_index", T.StringType()), T.StructField("_type", T.StringType()), T.StructField("_try", T.StringType()),
    T.StructField("gone", T.LongType()), T.StructField("field", T.StringType()), T.StructField("sketch", T.BinaryType()),
])
PLACE = ["_index", "_type", "_try"]


def _places(spark: SparkSession, root: str, locator: Locator | str) -> dict[tuple[str, str, str], int]:
    """Places in scope, and how many rows the log says were taken out of each."""
    state = log.state(spark, root)
    found = {p.place: 0 for s, p in catalog.segments(spark, root, locator, state).items() if s.kind != catalog.REJECTED}
    for deletion in state.deletions:
        for place, n in deletion.rows:
            if place in found:
                found[place] += n
    return found


def _printed(field: str) -> Column:
    """A missing value prints an empty line, as in the exact count; a sketch leaves empty text out, so each has a mark in front."""
    return F.concat(F.lit("="), F.coalesce(F.col(_q(field)).cast("string"), F.lit("")))


def _fresh(spark: SparkSession, root: str, fields: list[str], locator: Locator | str, places: DataFrame) -> DataFrame:
    """Sketches of some places from their documents, all fields in one pass."""
    docs = read_index(spark, root, locator, q="*", with_place=True).join(F.broadcast(places), PLACE)
    row = docs.groupBy(*PLACE, "gone").agg(*[F.hll_sketch_agg(_printed(f), BUCKETS).alias(f"_s{k}") for k, f in enumerate(fields)])
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_s{k}").alias("sketch")) for k, f in enumerate(fields)])
    return row.select(*PLACE, "gone", F.explode(each).alias("e")).select(*PLACE, "gone", "e.*")


def _stored(spark: SparkSession, root: str) -> DataFrame:
    names = log.Folder(spark, root).names("_sketches")
    if not names:
        return spark.createDataFrame([], STORED)
    return spark.read.schema(STORED).parquet(*[f"{root}/_sketches/{n}" for n in names])


def _known(spark: SparkSession, root: str, fields: list[str], locator: Locator | str) -> tuple[DataFrame, DataFrame]:
    """Stored sketches that still hold for the scope, one per place and field, and the places that need new ones."""
    places = spark.createDataFrame([(*p, n) for p, n in _places(spark, root, locator).items()], T.StructType(STORED.fields[:4]))
    # One row for each write of the scope, as in the log.
    known = _stored(spark, root).where(F.col("field").isin(fields)).join(F.broadcast(places), [*PLACE, "gone"], "left_semi")
    known = known.groupBy(*PLACE, "gone", "field").agg(F.first("sketch").alias("sketch"))
    whole = known.groupBy(*PLACE, "gone").agg(F.count("*").alias("n")).where(F.col("n") == len(fields))
    return known.join(F.broadcast(whole), [*PLACE, "gone"], "left_semi"), places.join(whole, [*PLACE, "gone"], "left_anti")


def build(spark: SparkSession, root: str, fields: list[str], locator: Locator | str = "es://_all") -> None:
    """Store the sketches that the scope lacks."""
    _, missing = _known(spark, root, fields, locator)
    if not missing.isEmpty():
        _fresh(spark, root, fields, locator, missing).write.parquet(f"{root}/_sketches/{uuid.uuid4().hex}")


def cardinality(spark: SparkSession, root: str, fields: list[str], locator: Locator | str = "es://_all") -> DataFrame:
    """About how many distinct printed values each field has in a scope: (field, values)."""
    known, missing = _known(spark, root, fields, locator)
    every = known.select("field", "sketch")
    if not missing.isEmpty():
        every = every.unionByName(_fresh(spark, root, fields, locator, missing).select("field", "sketch"))
    return every.groupBy("field").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("values"))
