"""Scans and file sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from docindex.functions.records import JSON_OPTIONS
from docindex.operators.ordinals import assign_chunks, chunk_plan
from docindex.plans.common import Registry, index_of, table
from docindex.sources import files
from docindex.sources.store import json_documents, load, read_index, write_documents, write_records
from docindex.streaming.sink import index_stream
from docindex.workspace import work_dir

REGISTRY = Registry()
query = REGISTRY.add

EVENT_FIELDS = "event_id long, ts string, user_id long, event_type string, value double, props string"
EVENT_ROWS = """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, user_id, event_type, value, props FROM events"""


@query("scan_index", """
SELECT CAST(event_id AS VARCHAR) AS doc_id, event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts,
       user_id, event_type, value, props FROM events""")
def scan_index(spark, sf):
    """(id, source) of one index and type; every row comes back."""
    root = index_of(spark, table(spark, sf, "events"), "es://events/event", id_field="event_id")
    docs = load(spark, root, "es://events/event")
    return docs.select("doc_id", F.from_json("contents", EVENT_FIELDS).alias("d")).select("doc_id", "d.*")


@query("scan_query", """
SELECT event_id, user_id, event_type, value FROM events
WHERE event_type IN ('click', 'view') AND ts >= TIMESTAMP '2024-01-05 08:00:00' AND ts < TIMESTAMP '2024-01-20 08:00:00'
  AND event_type <> 'view'""")
def scan_query(spark, sf):
    """A structured query; blank type part means all types."""
    root = index_of(spark, table(spark, sf, "events"), "es://events/event")
    body = {"and": {"filters": [
        {"terms": {"event_type": ["click", "view"]}},
        {"range": {"ts": {"gte": "2024-01-05T00:00:00-08:00", "lt": "2024-01-20T00:00:00-08:00"}}},
        {"not": {"term": {"event_type": "view"}}},
    ], "_cache": True}}
    return read_index(spark, root, "es://events", query=body).select("event_id", "user_id", "event_type", "value")


WORD_LIST = "regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}]+')"
DOC_WORDS = WORD_LIST.format("concat_ws(' ', text, lang, source)")


@query("scan_free_text", f"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, n_chars FROM documents WHERE list_contains({DOC_WORDS}, 'the')""")
def scan_free_text(spark, sf):
    """A locator with a free-text query and a number of tasks."""
    root = index_of(spark, table(spark, sf, "documents"), "es://docs/doc", id_field="doc_id")
    docs = load(spark, root, "es://docs/doc?q=the&tasks=100")
    return docs.select("doc_id", F.get_json_object("contents", "$.n_chars").cast("long").alias("n_chars"))


def daily_events(spark, sf):
    """Events as JSON lines that name their own daily index and id."""
    e = table(spark, sf, "events")
    target = F.concat(F.lit("ev-"), F.date_format("ts", "yyyyMMdd"))
    return e.select(F.to_json(F.struct(
        target.alias("_index"), F.lit("event").alias("_mapping"), F.col("event_id").alias("_id"),
        "user_id", "event_type",
    )).alias("value"))


@query("scan_multi_index", """
SELECT 'ev-' || strftime(ts, '%Y%m%d') AS index_name, 'event' AS type_name, CAST(event_id AS VARCHAR) AS doc_id FROM events
UNION ALL SELECT 'ord', 'order', CAST(o_orderkey AS VARCHAR) FROM orders""")
def scan_multi_index(spark, sf):
    """Several indices and types at once, by list and by name prefix."""
    root = work_dir(spark, "index")
    write_documents(json_documents(daily_events(spark, sf)), root, rebalance=True)
    write_records(table(spark, sf, "orders"), root, "es://ord/order", id_field="o_orderkey")
    return read_index(spark, root, "es://ev-*,ord/event,order").select(
        F.col("_index").alias("index_name"), F.col("_type").alias("type_name"), F.col("_id").alias("doc_id"))


@query("scan_index_family", """
SELECT 'ev-' || strftime(ts, '%Y%m%d') AS index_name, count(*) AS docs FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' GROUP BY 1""")
def scan_index_family(spark, sf):
    """The daily indices of one date prefix; only their directories are read."""
    root = work_dir(spark, "index")
    write_documents(json_documents(daily_events(spark, sf)), root, rebalance=True)
    docs = read_index(spark, root, "es://ev-2024011*")
    return docs.groupBy(F.col("_index").alias("index_name")).agg(F.count("*").alias("docs"))


@query("locator_read", """
SELECT event_type, count(*) AS docs, CAST(sum(user_id) AS BIGINT) AS users FROM events GROUP BY event_type""")
def locator_read(spark, sf):
    """An index opened by locator and used from SQL."""
    root = index_of(spark, table(spark, sf, "events"), "es://events/event")
    read_index(spark, root, "es:///events/event/").createOrReplaceTempView("docindex_events")
    return spark.sql(
        "SELECT event_type, count(*) AS docs, sum(user_id) AS users FROM docindex_events GROUP BY event_type")


@query("tsv_declared", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def tsv_declared(spark, sf):
    path = work_dir(spark, "tsv")
    customer = table(spark, sf, "customer")
    customer.write.option("sep", "\t").csv(path)
    return files.read_tsv(spark, path, customer.schema)


@query("tsv_by_names", """
SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name,
       CASE WHEN c_nationkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS segment,
       CAST(NULL AS VARCHAR) AS note FROM customer""")
def tsv_by_names(spark, sf):
    """Rows with a missing last value, or with more values than names."""
    path = work_dir(spark, "tsv")
    short = F.col("c_nationkey") % 3 == 0
    customer = table(spark, sf, "customer")
    customer.select(F.concat_ws(
        "\t", F.col("c_custkey").cast("string"), "c_name", F.when(short, "").otherwise(F.col("c_mktsegment")),
        F.lit(""), F.when(~short & (F.col("c_nationkey") % 3 == 1), F.lit("extra")).otherwise(""),
    ).alias("value")).write.text(path)
    rows = files.read_tsv_fields(spark, path, ["key", "name", "segment", "note"])
    return rows.withColumn("note", F.nullif("note", F.lit("")))


def event_lines(spark, sf):
    return table(spark, sf, "events").select(F.to_json(F.struct("*"), JSON_OPTIONS).alias("value"))


@query("ndjson_source", EVENT_ROWS)
def ndjson_source(spark, sf):
    path = work_dir(spark, "ndjson")
    event_lines(spark, sf).write.text(path)
    return files.read_ndjson(spark, path).select(F.from_json("data", EVENT_FIELDS).alias("d")).select("d.*")


@query("dump_source", EVENT_ROWS)
def dump_source(spark, sf):
    path = work_dir(spark, "dump")
    event_lines(spark, sf).write.option("compression", "gzip").text(path)
    return files.read_dump(spark, path).select(F.from_json("value", EVENT_FIELDS).alias("d")).select("d.*")


@query("chunk_plan", """
WITH n AS (SELECT count(*) AS hits, count(*) // 7 AS size FROM orders),
     c AS (SELECT unnest(range(0, (hits - 1) // size + 1)) AS chunk, hits, size FROM n)
SELECT chunk, chunk * size AS "from", least(size, hits - chunk * size) AS size FROM c""")
def chunks(spark, sf):
    return chunk_plan(table(spark, sf, "orders"), 7)


@query("chunk_assign", """
SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // ((SELECT count(*) FROM orders) // 7) AS chunk
FROM orders""")
def chunk_assign(spark, sf):
    return assign_chunks(table(spark, sf, "orders").select("o_orderkey"), 7, ["o_orderkey"])


@query("stream_load", """
SELECT event_type AS index_name, CAST(event_id AS VARCHAR) AS doc_id FROM events""")
def stream_load(spark, sf):
    """A stream of rows added to indices batch by batch."""
    root, checkpoint = work_dir(spark, "index"), work_dir(spark, "stream")
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)

    def documents(rows):
        return json_documents(rows.select(F.to_json(F.struct(
            F.col("event_type").alias("_index"), F.col("event_id").alias("_id"), "user_id", "props",
        )).alias("value")))

    index_stream(stream, root, checkpoint, documents).trigger(availableNow=True).start().awaitTermination()
    return read_index(spark, root, "es://_all").select(
        F.col("_index").alias("index_name"), F.col("_id").alias("doc_id"))


MAPPED = ["event_id", "user_id", "event_type"]


@query("stream_into_mapped", """
SELECT event_id, 'stored' AS part FROM events WHERE event_type = 'click' UNION ALL SELECT event_id, 'text' FROM events WHERE event_type = 'click'""")
def stream_into_mapped(spark, sf):
    """A stream into an index with a mapping is found by typed fields and by words."""
    root, checkpoint = work_dir(spark, "index"), work_dir(spark, "stream")
    e = table(spark, sf, "events")
    write_records(e.where("event_id % 2 = 0").select("event_id", "user_id", "event_type"), root, "es://ev/event")
    stream = spark.readStream.schema(e.schema).option("pathGlobFilter", "events.parquet").parquet(sf)

    def documents(rows):
        return json_documents(rows.where("event_id % 2 = 1").select(F.to_json(F.struct(*MAPPED)).alias("value")), "es://ev/event")

    index_stream(stream, root, checkpoint, documents).trigger(availableNow=True).start().awaitTermination()
    stored = read_index(spark, root, "es://ev/event", query={"term": {"event_type": "click"}})
    text = read_index(spark, root, "es://ev/event?q=click")
    return stored.select("event_id", F.lit("stored").alias("part")).unionByName(text.select("event_id", F.lit("text").alias("part")))


@query("stream_beside_loads", "SELECT event_type, 4 * count(*) AS docs FROM events GROUP BY 1")
def stream_beside_loads(spark, sf):
    """Loads and streams in turn, each adding all rows: none replaces another's."""
    root = work_dir(spark, "index")
    e = table(spark, sf, "events")

    def documents(rows):
        return json_documents(rows.select(F.to_json(F.struct(*MAPPED)).alias("value")), "es://ev/event")

    for _ in range(2):
        write_documents(documents(e), root)
        stream = spark.readStream.schema(e.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
        index_stream(stream, root, work_dir(spark, "stream"), documents).trigger(availableNow=True).start().awaitTermination()
    docs = read_index(spark, root, "es://ev/event")
    return docs.groupBy(F.get_json_object("_source", "$.event_type").alias("event_type")).agg(F.count("*").alias("docs"))


@query("scan_mixed_types", """
SELECT 'long' AS index_name, CAST(event_id AS VARCHAR) AS v FROM events WHERE event_id % 100 = 7 AND event_id < 5000
UNION ALL SELECT 'text', CAST(event_id AS VARCHAR) FROM events WHERE event_id % 100 = 7 AND event_id < 5000""")
def scan_mixed_types(spark, sf):
    """One field is a number in one index and text in the other: a query passes to both."""
    root = work_dir(spark, "index")
    rows = table(spark, sf, "events").select(F.col("event_id").alias("v"), (F.col("event_id") % 100).alias("kind"))
    write_records(rows, root, "es://long/row")
    write_records(rows.select(F.col("v").cast("string").alias("v"), "kind"), root, "es://text/row")
    values = [str(k * 100 + 7) for k in range(50)]
    docs = read_index(spark, root, "es://long,text", query={"terms": {"v": values}})
    return docs.select(F.col("_index").alias("index_name"), "v")
