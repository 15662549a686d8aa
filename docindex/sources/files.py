"""Plain-file sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docindex.functions.records import JSON_OPTIONS


def read_tsv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Tab-separated rows with a declared schema."""
    return spark.read.schema(schema).option("sep", "\t").option("quote", "").csv(path)


def read_tsv_fields(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Tab-separated rows by a list of field names.

    Values beyond the list are ignored; a short row leaves the rest null, and so
    do empty values at the end of a row.
    """
    parts = F.split(F.regexp_replace("value", "\t+$", ""), "\t")
    has_values = ~F.col("value").rlike("^\t+$")
    fields = [F.when(has_values, F.get(parts, F.lit(i))).alias(n) for i, n in enumerate(names)]
    return spark.read.text(path).select(*fields)


def read_ndjson(spark: SparkSession, path: str, column: str = "data") -> DataFrame:
    """One JSON text per line, unparsed."""
    return spark.read.text(path).withColumnRenamed("value", column)


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a gzip dump. A gzip file is read by one task, so the rows of a few
    files are spread by size; those of many files are spread as they are."""
    lines = spark.read.text(path)
    few = len(lines.inputFiles()) < spark.sparkContext.defaultParallelism
    return lines.hint("rebalance") if few else lines


def read_slowlog(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a log that speak of slow queries."""
    return spark.read.text(path).where(F.col("value").rlike("(?i)slowlog\\.query"))


def write_report(df: DataFrame, path: str) -> None:
    """A tab-separated report with a header line per file."""
    df.write.mode("errorifexists").option("sep", "\t").option("header", True).csv(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("sep", "\t").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Rows as JSON files."""
    df.write.mode("errorifexists").options(**JSON_OPTIONS).json(path)
