"""Facets from stored partial aggregates that merge over writes and indices.

A rollup keeps, per write, interval and keys, how many documents there are and of each value
its number, sum, least, greatest and sum of squares: figures that add up exactly for exact
types. A facet over any coarser interval, over keys or over everything adds up cells and
reads no documents. As with sketches, a cell cannot forget: a write from which later ones
took documents out is rolled up anew from what is left, as is one that nobody has yet.

Documents without a time or without a key have cells with nulls. An index without documents
gives no cells. A key is a field of single values; lists are not taken apart.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import astuple, dataclass
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from docindex.functions.records import _q
from docindex.functions.times import bucket_start
from docindex.locator import Locator
from docindex.operators import facets
from docindex.sources import log
from docindex.sources.sketches import PLACE, _places
from docindex.sources.store import read_index

#: Intervals that cells may have, in seconds; each begins and ends with the coarser ones.
BASES = {"minute": 60, "hour": 3600, "day": 86400}
COARSER = {"minute": {"minute", "hour", "day"}, "hour": {"hour", "day"}, "day": {"day"}}
CALENDAR = {"week", "month", "quarter", "year"}
FIGURES = ("n", "sum", "min", "max", "squares")

COVERED = T.StructType([
    *[T.StructField(c, T.StringType()) for c in PLACE], T.StructField("gone", T.LongType()), T.StructField("build", T.StringType()),
])


@dataclass(frozen=True)
class Rollup:
    """What cells hold: ``values`` are pairs of a field and the type it is added up in."""

    time: str
    interval: str = "hour"
    keys: tuple[str, ...] = ()
    values: tuple[tuple[str, str], ...] = ()

    def __post_init__(self) -> None:
        if self.interval not in BASES:
            raise ValueError(f"the interval of a rollup must be one of {tuple(BASES)}")

    @property
    def folder(self) -> str:
        return "_rollups/" + hashlib.sha256(repr(astuple(self)).encode()).hexdigest()[:16]


def _figure(k: int, name: str) -> str:
    return f"_v{k}_{name}"


def _aggregates(rollup: Rollup) -> list[Column]:
    found = [F.count("*").alias("docs")]
    for k, (field, dtype) in enumerate(rollup.values):
        v = F.col(_q(field)).cast(dtype)
        figures = (F.count(v), F.sum(v), F.min(v), F.max(v), F.sum(v * v))
        found += [c.alias(_figure(k, name)) for name, c in zip(FIGURES, figures)]
    return found


def _added(rollup: Rollup) -> list[Column]:
    """Cells of several writes as one."""
    found = [F.sum("docs").alias("docs")]
    for k, _ in enumerate(rollup.values):
        merge = {"min": F.min, "max": F.max}
        found += [merge.get(name, F.sum)(_figure(k, name)).alias(_figure(k, name)) for name in FIGURES]
    return found


def _fresh(spark: SparkSession, root: str, rollup: Rollup, locator: Locator | str, places: DataFrame) -> DataFrame:
    # One row for each write of the scope, as in the log.
    docs = read_index(spark, root, locator, q="*", with_place=True).join(F.broadcast(places), PLACE)
    bucket = bucket_start(F.col(_q(rollup.time)), rollup.interval).alias("bucket")
    keys = [F.col(_q(k)).alias(f"_k{i}") for i, k in enumerate(rollup.keys)]
    return docs.groupBy(*PLACE, "gone", bucket, *keys).agg(*_aggregates(rollup))


def _known(spark: SparkSession, root: str, rollup: Rollup, locator: Locator | str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Places in scope whose cells are stored (each with one build of them), places that lack cells, and all builds."""
    places = spark.createDataFrame([(*p, n) for p, n in _places(spark, root, locator).items()], T.StructType(COVERED.fields[:4]))
    # A build's list of places is written last, so a build that was cut off is not seen.
    builds = log.Folder(spark, root).names(f"{rollup.folder}/places")
    if not builds:
        return spark.createDataFrame([], COVERED), places, []
    stored = spark.read.schema(COVERED).parquet(*[f"{root}/{rollup.folder}/places/{b}" for b in builds])
    have = stored.join(places, [*PLACE, "gone"], "left_semi").groupBy(*PLACE, "gone").agg(F.min("build").alias("build"))
    return have, places.join(have, [*PLACE, "gone"], "left_anti"), builds


def build(spark: SparkSession, root: str, rollup: Rollup, locator: Locator | str = "es://_all") -> None:
    """Store the cells that the scope lacks."""
    _, missing, _ = _known(spark, root, rollup, locator)
    if missing.isEmpty():
        return
    name = uuid.uuid4().hex
    _fresh(spark, root, rollup, locator, missing).withColumn("build", F.lit(name)).write.parquet(f"{root}/{rollup.folder}/cells/{name}")
    missing.withColumn("build", F.lit(name)).write.parquet(f"{root}/{rollup.folder}/places/{name}")


def cells(spark: SparkSession, root: str, rollup: Rollup, locator: Locator | str = "es://_all") -> DataFrame:
    """Cells of a scope: ``bucket``, the keys by their names, ``docs`` and the figures of each value.

    Filters on keys, and on ``bucket`` with bounds where intervals begin, choose the same documents as on the index.
    """
    have, missing, builds = _known(spark, root, rollup, locator)
    parts = []
    if builds:
        stored = spark.read.parquet(*[f"{root}/{rollup.folder}/cells/{b}" for b in builds])
        parts.append(stored.join(F.broadcast(have), [*PLACE, "gone", "build"], "left_semi").drop("build"))
    if not builds or not missing.isEmpty():
        parts.append(_fresh(spark, root, rollup, locator, missing))
    every = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return every.drop(*PLACE, "gone").withColumnsRenamed({f"_k{i}": k for i, k in enumerate(rollup.keys)})


def statistical(cells: DataFrame, rollup: Rollup, value: str, where: Column | None = None) -> DataFrame:
    """One row: count, total, min, max, mean, sum_of_squares."""
    n, total, low, high, squares = _columns(rollup, value)
    kept = cells if where is None else cells.where(where)
    one = kept.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("count"), F.sum(total).alias("total"), F.min(low).alias("min"), F.max(high).alias("max"),
        F.sum(squares).alias("sum_of_squares"))
    return one.withColumn("mean", F.try_divide(F.col("total").cast("double"), F.col("count")))


def date_histogram(
    cells: DataFrame, rollup: Rollup, interval: str, value: str | None = None, zone: str | None = None, where: Column | None = None
) -> DataFrame:
    """Documents per interval (term, count), with the value's statistics when one is given."""
    if interval not in COARSER[rollup.interval] | CALENDAR:
        raise ValueError(f"{interval!r} is not made of whole cells of one {rollup.interval}")
    if zone is not None and not _whole(zone, BASES[rollup.interval]):
        raise ValueError(f"intervals of {zone} are not made of whole cells of one {rollup.interval}")
    kept = (cells if where is None else cells.where(where)).where(F.col("bucket").isNotNull())
    return kept.groupBy(bucket_start(F.col("bucket"), interval, zone).alias("term")).agg(*_stats(rollup, value))


def terms_stats(
    cells: DataFrame, rollup: Rollup, key: str, value: str | None = None, size: int | None = facets.DEFAULT_SIZE, order: str = "count",
    where: Column | None = None,
) -> DataFrame:
    """Documents per value of a key as text (term, count), with a value's statistics when one is given."""
    kept = (cells if where is None else cells.where(where)).where(F.col(_q(key)).isNotNull())
    return facets._ranked(kept.groupBy(F.col(_q(key)).cast("string").alias("term")).agg(*_stats(rollup, value)), order, size)


def _columns(rollup: Rollup, value: str) -> list[Column]:
    k = [field for field, _ in rollup.values].index(value)
    return [F.col(_figure(k, name)) for name in FIGURES]


def _stats(rollup: Rollup, value: str | None) -> list[Column]:
    docs = F.sum("docs").alias("count")
    if value is None:
        return [docs]
    n, total, low, high, _ = _columns(rollup, value)
    return [
        docs, F.sum(n).alias("total_count"), F.sum(total).alias("total"), F.min(low).alias("min"), F.max(high).alias("max"),
        F.try_divide(F.sum(total).cast("double"), F.sum(n)).alias("mean"),
    ]


def _whole(zone: str, seconds: int) -> bool:
    """Whether a zone's distance from UTC was a whole number of intervals in every week from 1970 to 2037."""
    rules, start = ZoneInfo(zone), datetime(1970, 1, 1, tzinfo=timezone.utc)
    offsets = {(start + timedelta(weeks=w)).astimezone(rules).utcoffset() for w in range(68 * 53)}
    return all(o.total_seconds() % seconds == 0 for o in offsets)
