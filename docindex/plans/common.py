"""Shared pieces of the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docindex.sources.store import write_records
from docindex.workspace import work_dir

Query = Callable[[SparkSession, str], DataFrame]

# Spreads and scores are compared to this many places; means come from exact sums.
PLACES = 6

# Exact numbers with cents.
MONEY = "decimal(18,2)"


@dataclass
class Registry:
    """Queries by name, with the SQL that gives the same rows."""

    queries: dict[str, Query] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(fn: Query) -> Query:
            self.queries[name] = fn
            if sql is not None:
                self.sql[name] = sql
            return fn

        return register

    def update(self, other: Registry) -> None:
        self.queries.update(other.queries)
        self.sql.update(other.sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the value as an exact number, so that sums do not depend on order."""
    return table(spark, sf_dir, "events").withColumn("value", F.col("value").cast(MONEY))


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast(MONEY))


def tidy(df: DataFrame) -> DataFrame:
    """Exact numbers as doubles; spreads rounded."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        if f.name in ("variance", "std_deviation"):
            c = F.round(c.cast("double"), PLACES)
        if f.name == "sum_of_squares":
            c = F.round(c.cast("double"), 4)
        columns.append(c.alias(f.name))
    return df.select(*columns)


def index_of(spark: SparkSession, df: DataFrame, locator: str, **options) -> str:
    """A new root that holds ``df`` as an index; returns the root."""
    root = work_dir(spark, "index")
    write_records(df, root, locator, **options)
    return root
