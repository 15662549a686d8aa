"""Projections and record shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from docindex.functions import records, times
from docindex.plans.common import Registry, table
from docindex.sources.files import read_ndjson
from docindex.workspace import work_dir

REGISTRY = Registry()
query = REGISTRY.add


@query("tuple_to_document", """
SELECT c_custkey, '{"c_custkey":"' || c_custkey || '","c_name":"' || c_name || '"'
       || CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE ',"c_mktsegment":"' || c_mktsegment || '"' END || '}' AS doc
FROM customer""")
def tuple_to_document(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"))
    return rows.select("c_custkey", records.text_document(rows.columns).alias("doc"))


@query("record_to_json", """
SELECT o_orderkey, '{"key":' || o_orderkey || ',"tags":["' || o_orderstatus || '"],"attr":{"p":"' || o_orderpriority || '"}'
       || CASE WHEN o_custkey % 2 = 0 THEN ',"even":true' ELSE '' END || '}' AS doc
FROM orders""")
def record_to_json(spark, sf):
    """Lists and maps keep their JSON types; nulls inside them go, and empty lists."""
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"),
        F.array("o_orderstatus", F.lit(None).cast("string")).alias("tags"),
        F.create_map(F.lit("p"), F.col("o_orderpriority"), F.lit("q"), F.lit(None).cast("string")).alias("attr"),
        F.when(F.col("o_custkey") % 2 == 0, F.lit(True)).alias("even"),
        F.array(F.lit(None).cast("int")).alias("none"),
    )
    return rows.select(F.col("key").alias("o_orderkey"), records.typed_document(rows.schema).alias("doc"))


@query("computed_ts", """
SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) * 1000 AS ts_ms, date_trunc('second', ts) AS ts FROM events""")
def computed_ts(spark, sf):
    """Epoch seconds to an epoch-millisecond date."""
    ms = records.epoch_seconds_to_ms(F.unix_timestamp(F.col("ts").cast("timestamp")))
    return table(spark, sf, "events").select(
        "event_id", ms.alias("ts_ms"), F.timestamp_millis(ms).cast("timestamp_ntz").alias("ts"))


@query("rename_cols", "SELECT o_orderkey AS page_id, o_orderstatus AS title, o_totalprice AS num_visitors FROM orders")
def rename_cols(spark, sf):
    return records.rename(
        table(spark, sf, "orders"), {"o_orderkey": "page_id", "o_orderstatus": "title", "o_totalprice": "num_visitors"})


@query("drop_keys", """
SELECT event_id, '{"event_type":"' || event_type || '","user_id":' || user_id || '}' AS doc FROM events""")
def drop_keys(spark, sf):
    doc = F.to_json(F.struct(F.col("event_id").alias("_id"), F.col("event_id").alias("id"), "event_type", "user_id"))
    return table(spark, sf, "events").select("event_id", records.drop_keys(doc, "_id", "id").alias("doc"))


@query("extract_field", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def extract_field(spark, sf):
    return table(spark, sf, "events").select("event_id", records.field_of(F.col("props"), "k").cast("long").alias("k"))


@query("script_key", """
SELECT event_id, coalesce(nullif(event_type, 'view'), 'null') || '|' || user_id AS key FROM events""")
def script_key(spark, sf):
    rows = table(spark, sf, "events").withColumn("event_type", F.nullif("event_type", F.lit("view")))
    return rows.select("event_id", records.script_key("event_type", "user_id").alias("key"))


@query("parse_ts", """
SELECT event_id, CASE WHEN event_id % 6 < 4 THEN date_trunc('second', ts) END AS ts FROM events""")
def parse_ts(spark, sf):
    """Several text forms; empty and unreadable text gives null."""
    form = F.col("event_id") % 6
    text = (
        F.when(form == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(form == 1, F.date_format("ts", "yyyy/MM/dd HH:mm:ss"))
        .when(form == 2, F.date_format("ts", "yyyyMMddHHmmss"))
        .when(form == 3, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(form == 4, F.lit(""))
        .otherwise(F.lit("bad"))
    )
    return table(spark, sf, "events").select(
        "event_id", times.parse_timestamp(text).cast("timestamp_ntz").alias("ts"))


@query("format_ts", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS wire FROM events")
def format_ts(spark, sf):
    return table(spark, sf, "events").select("event_id", times.format_timestamp(F.col("ts"), ntz=True).alias("wire"))


@query("fragment", "SELECT doc_id, substr(text, 1, 50) AS fragment FROM documents")
def fragment(spark, sf):
    return table(spark, sf, "documents").select("doc_id", records.fragment(F.col("text")).alias("fragment"))


@query("retyped_document", """
SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || '}' AS doc FROM events""")
def retyped_document(spark, sf):
    """Raw texts from files, given a declared shape."""
    path = work_dir(spark, "ndjson")
    table(spark, sf, "events").select(F.concat_ws("", F.lit('{"id":'), "event_id", F.lit(',"doc":'), "props", F.lit("}"))).write.text(path)
    lines = read_ndjson(spark, path)
    return lines.select(
        records.field_of(F.col("data"), "id").cast("long").alias("event_id"),
        records.retyped(records.field_of(F.col("data"), "doc"), "k long, missing array<string>").alias("doc"))
