"""Backup, restore and duplication of indexes as gzip JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from docindex.functions.records import drop_keys
from docindex.locator import Locator
from docindex.operators.filters import backup_filter
from docindex.sources import catalog
from docindex.sources.files import read_dump
from docindex.sources.store import WriteResult, json_documents, read_index, write_documents

# Result metadata that a dump leaves out.
RESULT_KEYS = ("type", "_index", "_explanation", "_score", "_version", "highlight", "sort")


def dump_lines(docs: DataFrame) -> DataFrame:
    """One JSON text per document: its members, its id and its type."""
    head = F.to_json(F.struct(F.col("_id").alias("id"), "_type"))
    body = drop_keys(F.col("_source"), *RESULT_KEYS, "id", "_type")
    return docs.select(_merged(head, body).alias("value"))


def _merged(head: Column, body: Column) -> Column:
    """Two JSON object texts as one; the first has members, the second may be ``{}``."""
    opened = F.substring(head, F.lit(1), F.length(head) - 1)
    rest = F.when(body == "{}", F.lit("}")).otherwise(F.concat(F.lit(","), F.substring(body, F.lit(2), F.length(body))))
    return F.concat(opened, rest)


def backup(
    spark: SparkSession,
    root: str,
    locator: Locator | str,
    path: str,
    query: dict | None = None,
    mapping_path: str | None = None,
) -> int:
    """Dump an index, or the part a query selects; returns the number of records."""
    docs = read_index(spark, root, locator)
    if query:
        docs = docs.where(backup_filter(query, docs.schema))
    seen = Observation("backup")
    lines = dump_lines(docs).observe(seen, F.count("*").alias("records"))
    lines.write.mode("errorifexists").option("compression", "gzip").text(path)
    if mapping_path is not None:
        mapping = catalog.get_mapping(spark, root, *Locator.of(locator).target)
        catalog.dump_mapping(spark, mapping or {"properties": {}}, mapping_path)
    return seen.get["records"]


def restore(
    spark: SparkSession,
    path: str,
    root: str,
    locator: Locator | str,
    mapping: dict | None = None,
    mapping_path: str | None = None,
) -> WriteResult:
    """Load a dump; each document keeps its id."""
    if mapping_path is not None:
        mapping = catalog.load_mapping(spark, mapping_path)
    return _insert(spark, json_documents(
        read_dump(spark, path), locator, index_field=None, type_field="_type", id_fields=("_id", "id"),
    ), root, locator, mapping)


def duplicate(
    spark: SparkSession, path: str, root: str, locator: Locator | str, mapping: dict | None = None
) -> WriteResult:
    """Load a dump without its ids, so every document is added under a new one."""
    fresh = read_dump(spark, path).select(F.coalesce(drop_keys(F.col("value"), "_id", "id"), F.col("value")).alias("value"))
    return _insert(spark, json_documents(
        fresh, locator, index_field=None, type_field="_type", id_fields=(),
    ), root, locator, mapping)


def _insert(
    spark: SparkSession, docs: DataFrame, root: str, locator: Locator | str, mapping: dict | None
) -> WriteResult:
    index, doc_type = Locator.of(locator).target
    if mapping is not None:
        catalog.put_mapping(spark, root, index, doc_type, mapping)
    else:
        mapping = catalog.get_mapping(spark, root, index, doc_type)
    return write_documents(docs, root, mapping=mapping)
