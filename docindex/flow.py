"""Dataflows between indexes and plain files."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from docindex.locator import Locator, is_locator
from docindex.sources.store import json_documents, read_index, write_documents


def identity(df: DataFrame) -> DataFrame:
    return df


def read_input(spark: SparkSession, source: str, root: str | None = None, **options) -> DataFrame:
    """Lines to process: documents of an index, or lines of files, as column ``value``."""
    if is_locator(source):
        return read_index(spark, root, source, **options).select(F.col("_source").alias("value"))
    return spark.read.text(source)


def write_output(df: DataFrame, target: str, root: str | None = None, **options) -> None:
    """Store lines in an index, where each may name its own target, or in files."""
    if is_locator(target):
        write_documents(json_documents(df, Locator.parse(target)), root, **options)
    else:
        df.select("value").write.mode("errorifexists").text(target)


def run_flow(
    spark: SparkSession,
    source: str,
    target: str,
    mapper: Callable[[DataFrame], DataFrame] = identity,
    reducer: Callable[[DataFrame], DataFrame] = identity,
    root: str | None = None,
    read_options: dict | None = None,
    write_options: dict | None = None,
) -> None:
    """Read, transform and write as one plan.

    Input and output are chosen independently: an ``es://`` locator means an
    index below ``root``, anything else plain files.
    """
    lines = read_input(spark, source, root, **(read_options or {}))
    write_output(lines.transform(mapper).transform(reducer), target, root, **(write_options or {}))


def copy_index(
    spark: SparkSession, root: str, source: str, target: str,
    mapper: Callable[[DataFrame], DataFrame] = identity, query: dict | None = None,
) -> None:
    """Write the documents of one index, as selected and transformed, to another."""
    run_flow(spark, source, target, mapper, root=root, read_options={"query": query})


def printed(df: DataFrame) -> DataFrame:
    """Rows as they are printed: ``(a,b)``, with nothing for null."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    return df.select(F.concat(F.lit("("), F.concat_ws(",", *cells), F.lit(")")).alias("line"))


def dump(df: DataFrame, out=None) -> None:
    """Print all rows, fetching one partition at a time."""
    for row in printed(df).toLocalIterator():
        print(row["line"], file=out or sys.stdout)
