"""Sinks: what was written is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from docindex import flow
from docindex.functions.records import JSON_OPTIONS
from docindex.mapping import struct_to_mapping, typed_view
from docindex.operators.reports import batch_metrics
from docindex.plans.common import MONEY, Registry, index_of, table
from docindex.sources import catalog, dump, files
from docindex.sources.store import (
    compact, export_bulk, json_documents, json_record_documents, read_index, read_rejects, write_documents, write_records,
)
from docindex.workspace import work_dir

REGISTRY = Registry()
query = REGISTRY.add

CUSTOMER_ROWS = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def members_of(column: str):
    return F.size(F.json_object_keys(column)).alias("members")


def customer_with_gaps(spark, sf):
    return table(spark, sf, "customer").withColumn("c_nationkey", F.nullif("c_nationkey", F.lit(3))).withColumn(
        "c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))


GAPS = """nullif(c_nationkey, 3) AS c_nationkey, c_acctbal, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment"""
GAP_MEMBERS = """
5 - CASE WHEN c_nationkey = 3 THEN 1 ELSE 0 END - CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS members"""


@query("sink_typed", f"""
SELECT CAST(c_custkey AS VARCHAR) AS doc_id, c_custkey, c_name, {GAPS}, {GAP_MEMBERS} FROM customer""")
def sink_typed(spark, sf):
    """Typed records with their id; null fields are not in the document."""
    root = index_of(spark, customer_with_gaps(spark, sf), "es://cust/row", id_field="c_custkey")
    docs = read_index(spark, root, "es://cust/row")
    return docs.select(
        F.col("_id").alias("doc_id"), "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
        members_of("_source"))


@query("sink_missing_id", """
SELECT CAST(nullif(c_nationkey, 3) AS VARCHAR) AS doc_id, CASE WHEN c_nationkey = 3 THEN 'no id' END AS reason,
       CASE WHEN c_nationkey = 3 THEN count(*) ELSE 1 END AS documents FROM customer GROUP BY c_nationkey""")
def sink_missing_id(spark, sf):
    """A record lacking its id is rejected; one id keeps one document."""
    root = index_of(spark, customer_with_gaps(spark, sf), "es://cust/row", id_field="c_nationkey")
    kept = read_index(spark, root, "es://cust/row").select(
        F.col("_id").alias("doc_id"), F.lit(None).cast("string").alias("reason"))
    lost = read_rejects(spark, root).select(F.lit(None).cast("string").alias("doc_id"), F.col("_reason").alias("reason"))
    return kept.unionByName(lost).groupBy("doc_id", "reason").agg(F.count("*").alias("documents"))


TEXT_FIELDS = "c_custkey string, c_name string, c_nationkey string, c_acctbal string, c_mktsegment string"
TEXT_ROWS = f"""
SELECT CAST(c_custkey AS VARCHAR) AS doc_id, CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
       CAST(nullif(c_nationkey, 3) AS VARCHAR) AS c_nationkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal,
       nullif(c_mktsegment, 'BUILDING') AS c_mktsegment, {GAP_MEMBERS} FROM customer"""


def text_documents(spark, root):
    docs = read_index(spark, root, "es://cust/row")
    return docs.select(
        F.col("_id").alias("doc_id"), members_of("_source"), F.from_json("_source", TEXT_FIELDS).alias("d"),
    ).select("doc_id", "members", "d.*")


@query("sink_tabular", TEXT_ROWS)
def sink_tabular(spark, sf):
    """Every field as text; the locator names id and documents per file."""
    root = index_of(
        spark, customer_with_gaps(spark, sf), "es://cust/row?json=false&size=500&id=c_custkey", as_text=True)
    return text_documents(spark, root)


@query("sink_position", TEXT_ROWS)
def sink_position(spark, sf):
    """The id by position."""
    root = index_of(spark, customer_with_gaps(spark, sf), "es://cust/row", id_pos=0, as_text=True)
    return text_documents(spark, root)


def nested_lines(spark, sf):
    """Documents with null members, nulls in lists, empty lists and nested objects."""
    e = table(spark, sf, "events")
    return e.select(F.when(F.col("event_type") != "error", F.concat(
        F.lit('{"event_id":'), "event_id", F.lit(',"a":null,"b":['), "user_id", F.lit(',null,2],"c":{"t":"'),
        "event_type", F.lit('","n":null,"ok":true},"f":[]}'),
    )).alias("data"))


NESTED_ROWS = """
SELECT CAST(event_id AS VARCHAR) AS doc_id,
       '{"event_id":' || event_id || ',"b":[' || user_id || ',2],"c":{"t":"' || event_type || '","ok":true}}' AS source
FROM events WHERE event_type <> 'error'"""


@query("sink_json", NESTED_ROWS)
def sink_json(spark, sf):
    """JSON texts of a declared shape, re-typed and without empty members."""
    root = work_dir(spark, "index")
    schema = "event_id long, a string, b array<long>, c struct<t: string, n: string, ok: boolean>, f array<long>"
    write_documents(json_record_documents(
        nested_lines(spark, sf), "es://ev/doc", id_field="event_id", schema=schema), root)
    return read_index(spark, root, "es://ev/doc").select(F.col("_id").alias("doc_id"), F.col("_source").alias("source"))


@query("sink_json_untyped", NESTED_ROWS)
def sink_json_untyped(spark, sf):
    """The same for texts of unknown shape; null lines are skipped."""
    root = work_dir(spark, "index")
    write_records(nested_lines(spark, sf), root, "es://ev/doc?json=true&id=event_id")
    return read_index(spark, root, "es://ev/doc").select(F.col("_id").alias("doc_id"), F.col("_source").alias("source"))


@query("sink_override", """
SELECT CASE WHEN event_id % 2 = 0 THEN event_type ELSE 'hadoop' END AS index_name,
       CASE WHEN event_id % 3 = 0 THEN 'null' ELSE 'streaming_record' END AS type_name,
       CAST(event_id AS VARCHAR) AS doc_id,
       CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR) END AS routing FROM events""")
def sink_override(spark, sf):
    """Each document may name its index, type, id and routing value."""
    root = work_dir(spark, "index")
    even, third = F.col("event_id") % 2 == 0, F.col("event_id") % 3 == 0
    lines = table(spark, sf, "events").select(F.concat(
        F.lit('{"_id":'), "event_id",
        F.when(even, F.concat(F.lit(',"_index":"'), "event_type", F.lit('","_routing":'), "user_id")).otherwise(""),
        F.when(third, F.lit(',"_mapping":null')).otherwise(""),
        F.lit("}"),
    ).alias("value"))
    write_documents(json_documents(lines), root)
    return read_index(spark, root, "es://_all").select(
        F.col("_index").alias("index_name"), F.col("_type").alias("type_name"), F.col("_id").alias("doc_id"),
        F.col("_routing").alias("routing"))


@query("upsert_latest", """
SELECT CAST(user_id AS VARCHAR) AS doc_id, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def upsert_latest(spark, sf):
    """The same id in two batches, many times in each: the last document stays."""
    root = work_dir(spark, "index")
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    half = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (e.where(half), e.where(~half)):
        write_records(part.orderBy("event_id"), root, "es://users/last", id_field="user_id")
    return read_index(spark, root, "es://users/last").select(F.col("_id").alias("doc_id"), "event_id", "value")


@query("upsert_filtered", """
WITH v AS (SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS age FROM events)
SELECT CAST(user_id AS VARCHAR) AS doc_id, event_id FROM v WHERE age = 1 AND event_type = 'click'""")
def upsert_filtered(spark, sf):
    """A filter that only older versions of a document pass does not find it."""
    root = work_dir(spark, "index")
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    half = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (e.where(half), e.where(~half)):
        write_records(part.orderBy("event_id"), root, "es://users/last", id_field="user_id")
    found = read_index(spark, root, "es://users/last", query={"term": {"event_type": "click"}})
    return found.select(F.col("_id").alias("doc_id"), "event_id")


MAPPED_ROWS = """
SELECT event_id, 'stored' AS part FROM events WHERE event_type = 'click' UNION ALL SELECT event_id, 'text' FROM events WHERE event_type = 'click'"""


def found_in_mapped(spark, root):
    stored = read_index(spark, root, "es://ev/event", query={"term": {"event_type": "click"}})
    text = read_index(spark, root, "es://ev/event?q=click")
    return stored.select("event_id", F.lit("stored").alias("part")).unionByName(text.select("event_id", F.lit("text").alias("part")))


def mapped_half(spark, sf):
    """An index that holds half of the events as records, and the other half as JSON lines."""
    root = work_dir(spark, "index")
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    write_records(e.where("event_id % 2 = 0"), root, "es://ev/event")
    return root, e.where("event_id % 2 = 1").select(F.to_json(F.struct("*")).alias("value"))


@query("flow_into_mapped", MAPPED_ROWS)
def flow_into_mapped(spark, sf):
    """Lines that a flow adds to a mapped index are found by its typed fields."""
    root, lines = mapped_half(spark, sf)
    path = work_dir(spark, "lines")
    lines.write.text(path)
    flow.run_flow(spark, path, "es://ev/event", root=root)
    return found_in_mapped(spark, root)


@query("json_into_mapped", MAPPED_ROWS)
def json_into_mapped(spark, sf):
    root, lines = mapped_half(spark, sf)
    write_records(lines, root, "es://ev/event?json=true")
    return found_in_mapped(spark, root)


@query("compacted_index", """
SELECT CAST(user_id AS VARCHAR) AS doc_id, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def compacted_index(spark, sf):
    """Current documents rewritten, so that a read needs no shuffle."""
    root, target = work_dir(spark, "index"), work_dir(spark, "compacted")
    e = table(spark, sf, "events").select("event_id", "user_id", "value")
    write_records(e.orderBy("event_id"), root, "es://users/last", id_field="user_id")
    compact(spark, root, target)
    return read_index(spark, target, "es://users/last").select(F.col("_id").alias("doc_id"), "event_id", "value")


@query("assigned_ids", "SELECT count(*) AS docs, count(*) AS ids, count(*) AS given FROM documents")
def assigned_ids(spark, sf):
    """Documents without an id each get their own."""
    root = index_of(spark, table(spark, sf, "documents"), "es://docs/doc")
    docs = read_index(spark, root, "es://docs/doc")
    return docs.agg(
        F.count("*").alias("docs"), F.count_distinct("_id").alias("ids"), F.count("_id").alias("given"))


@query("routing_shards", """
SELECT CAST(o_custkey AS VARCHAR) AS routing, 1::BIGINT AS shards, count(*) AS docs FROM orders GROUP BY 1""")
def routing_shards(spark, sf):
    """All documents of a routing value share a shard, though tasks are salted."""
    root = work_dir(spark, "index")
    write_records(
        table(spark, sf, "orders"), root, "es://ord/order", id_field="o_orderkey", routing_field="o_custkey",
        shards=16, salt=4)
    docs = read_index(spark, root, "es://ord/order")
    return docs.groupBy(F.col("_routing").alias("routing")).agg(
        F.count_distinct("_shard").alias("shards"), F.count("*").alias("docs"))


ROUTED = 40


@query("routed_read", f"""
SELECT CAST(o_custkey AS VARCHAR) AS routing, CAST(o_orderkey AS VARCHAR) AS doc_id, CAST(o_totalprice AS DOUBLE) AS price
FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 ORDER BY count(*) DESC, o_custkey LIMIT {ROUTED})""")
def routed_read(spark, sf):
    """All orders of the customers with most of them, by routing value from a clustered index."""
    root, target = work_dir(spark, "index"), work_dir(spark, "clustered")
    orders = table(spark, sf, "orders")
    write_records(orders, root, "es://ord/order", id_field="o_orderkey", routing_field="o_custkey")
    compact(spark, root, target, cluster="routing")
    busy = orders.groupBy("o_custkey").count().orderBy(F.desc("count"), "o_custkey").limit(ROUTED)
    docs = read_index(spark, target, "es://ord/order", routing=[str(r["o_custkey"]) for r in busy.collect()])
    return docs.select(F.col("_routing").alias("routing"), F.col("_id").alias("doc_id"), F.col("o_totalprice").cast("double").alias("price"))


@query("ids_read", """
SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, CAST(o_custkey AS VARCHAR) AS routing, o_orderstatus AS status
FROM orders WHERE o_orderkey IN (SELECT max(o_orderkey) FROM orders GROUP BY o_orderstatus)""")
def ids_read(spark, sf):
    """The last order of each status by id, from an index that is clustered by routing."""
    root, target = work_dir(spark, "index"), work_dir(spark, "clustered")
    orders = table(spark, sf, "orders")
    write_records(orders, root, "es://ord/order", id_field="o_orderkey", routing_field="o_custkey")
    compact(spark, root, target, cluster="routing")
    last = orders.groupBy("o_orderstatus").agg(F.max("o_orderkey").cast("string").alias("id")).collect()
    docs = read_index(spark, target, "es://ord/order", query={"ids": {"values": [r["id"] for r in last]}})
    return docs.select(F.col("_id").alias("doc_id"), F.col("_routing").alias("routing"), F.col("o_orderstatus").alias("status"))


@query("bulk_batches", """
SELECT count(*) AS items, 0::BIGINT AS over_size, 0::BIGINT AS tasks_with_several_remainders FROM lineitem""")
def bulk_batches(spark, sf):
    """Files hold exactly 1000 documents, but for the last of each task; measured from the files that were written."""
    root = work_dir(spark, "index")
    write_records(table(spark, sf, "lineitem"), root, "es://lineitem/row", bulk_size=1000)
    per_file = batch_metrics(read_index(spark, root, "es://lineitem/row").select("_source", F.input_file_name().alias("file")))
    per_task = per_file.groupBy(F.regexp_extract("file", r"part-(\d+)-[^/]*$", 1).alias("task")).agg(
        F.sum("items").alias("items"), F.count_if(F.col("items") > 1000).alias("over"),
        F.count_if(F.col("items") < 1000).alias("partial"))
    return per_task.agg(
        F.sum("items").alias("items"), F.sum("over").alias("over_size"),
        F.count_if(F.col("partial") > 1).alias("tasks_with_several_remainders"))


@query("bulk_export", """
SELECT 'action' AS line, event_type AS index_name, count(*) AS lines FROM events GROUP BY 2
UNION ALL SELECT 'source', event_type, count(*) FROM events GROUP BY 2""")
def bulk_export(spark, sf):
    """Request bodies: an action line and a source line per document."""
    root, path = work_dir(spark, "index"), work_dir(spark, "bulk")
    lines = table(spark, sf, "events").select(F.to_json(F.struct(
        F.col("event_type").alias("_index"), F.col("event_id").alias("_id"), "user_id")).alias("value"))
    write_documents(json_documents(lines), root)
    export_bulk(read_index(spark, root, "es://_all"), path, 1000)
    action = F.get_json_object("value", "$.index._index")
    return spark.read.text(path).select(
        F.when(action.isNotNull(), "action").otherwise("source").alias("line"),
        F.coalesce(action, F.get_json_object("value", "$._index")).alias("index_name"),
    ).groupBy("line", "index_name").agg(F.count("*").alias("lines"))


def clicks_dump(spark, sf):
    """Clicks of an event index as a dump; returns root, dump and mapping paths."""
    root = index_of(spark, table(spark, sf, "events"), "es://events/event", id_field="event_id")
    path, mapping = work_dir(spark, "dump"), work_dir(spark, "mapping")
    dump.backup(spark, root, "es://events/event", path, {"term": {"event_type": "click"}}, mapping)
    return root, path, mapping


@query("backup_query", """
SELECT CAST(event_id AS VARCHAR) AS id, 'event' AS type_name, user_id, value, props, 8 AS members
FROM events WHERE event_type = 'click'""")
def backup_query(spark, sf):
    """The dump of what a query selects."""
    _, path, _ = clicks_dump(spark, sf)
    fields = "id string, _type string, user_id long, value double, props string"
    return files.read_dump(spark, path).select(
        F.from_json("value", fields).alias("d"), members_of("value"),
    ).select("d.id", F.col("d._type").alias("type_name"), "d.user_id", "d.value", "d.props", "members")


@query("restore_docs", """
SELECT CAST(event_id AS VARCHAR) AS doc_id, user_id, value, ts FROM events WHERE event_type = 'click'""")
def restore_docs(spark, sf):
    """A dump loaded with its mapping; ids are kept."""
    root, path, mapping = clicks_dump(spark, sf)
    dump.restore(spark, path, root, "es://back/event", mapping_path=mapping)
    docs = read_index(spark, root, "es://back/event")
    return docs.select(F.col("_id").alias("doc_id"), "user_id", "value", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("duplicate_docs", """
SELECT event_id, CAST(CASE WHEN event_type = 'click' THEN 2 ELSE 1 END AS BIGINT) AS docs FROM events""")
def duplicate_docs(spark, sf):
    """A dump loaded again under fresh ids, next to the old documents."""
    root, path, _ = clicks_dump(spark, sf)
    dump.duplicate(spark, path, root, "es://events/event")
    return read_index(spark, root, "es://events/event").groupBy("event_id").agg(F.count("*").alias("docs"))


@query("rejects", """
SELECT CASE WHEN event_id % 10 = 0 THEN substr(props, 1, length(props) - 1) ELSE props END AS line,
       CASE WHEN event_id % 10 = 0 THEN 'not a JSON object' END AS reason, count(*) AS lines
FROM events GROUP BY 1, 2""")
def rejects(spark, sf):
    """Broken lines go to their own output with a reason."""
    root, path = work_dir(spark, "index"), work_dir(spark, "rejects")
    broken = F.substring("props", F.lit(1), F.length("props") - 1)
    lines = table(spark, sf, "events").select(
        F.when(F.col("event_id") % 10 == 0, broken).otherwise(F.col("props")).alias("value"))
    write_documents(json_documents(lines), root, rejects=path)
    lost = spark.read.schema("_source string, _reason string").json(path)
    kept = read_index(spark, root, "es://_all").select("_source", F.lit(None).cast("string").alias("_reason"))
    return kept.unionByName(lost).groupBy(
        F.col("_source").alias("line"), F.col("_reason").alias("reason")).agg(F.count("*").alias("lines"))


@query("mapping_roundtrip", """
SELECT CAST(event_id AS VARCHAR) AS doc_id, ts, CAST(user_id AS INTEGER) AS user_id, event_type FROM events""")
def mapping_roundtrip(spark, sf):
    """A mapping stored, loaded and used as the typed view of raw documents; other members stay raw."""
    root, path = work_dir(spark, "index"), work_dir(spark, "mapping")
    mapping = {"dynamic": False, "properties": {
        "ts": {"type": "date"}, "user_id": {"type": "integer"},
        "event_type": {"type": "string", "index": "not_analyzed"}}}
    catalog.dump_mapping(spark, mapping, path)
    lines = table(spark, sf, "events").withColumnRenamed("event_id", "_id").select(
        F.to_json(F.struct("*"), JSON_OPTIONS).alias("value"))
    write_documents(json_documents(lines), root)
    docs = typed_view(read_index(spark, root, "es://_all"), catalog.load_mapping(spark, path))
    return docs.select(
        F.col("_id").alias("doc_id"), F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type")


@query("mapping_declared", """
SELECT 'o_custkey' AS field, 'long' AS type, count(o_custkey) AS docs FROM orders
UNION ALL SELECT 'o_orderdate', 'date', count(o_orderdate) FROM orders
UNION ALL SELECT 'o_orderkey', 'long', count(o_orderkey) FROM orders
UNION ALL SELECT 'o_orderpriority', 'string', count(o_orderpriority) FROM orders
UNION ALL SELECT 'o_orderstatus', 'string', count(o_orderstatus) FROM orders
UNION ALL SELECT 'o_totalprice', 'double', count(o_totalprice) FROM orders""")
def mapping_declared(spark, sf):
    """The mapping an index got from its rows, with the documents that hold each field."""
    orders = table(spark, sf, "orders")
    root = index_of(spark, orders, "es://ord/order")
    mapping = catalog.get_mapping(spark, root, "ord", "order")
    assert mapping == struct_to_mapping(orders.schema)
    props = mapping["properties"]
    docs = read_index(spark, root, "es://ord/order")
    held = docs.agg(*[F.count(n).alias(n) for n in props]).unpivot([], list(props), "field", "docs")
    kinds = F.create_map(*[F.lit(x) for n, s in props.items() for x in (n, s["type"])])
    return held.select("field", kinds[F.col("field")].alias("type"), "docs")


@query("json_files", CUSTOMER_ROWS)
def json_files(spark, sf):
    path = work_dir(spark, "json")
    customer = table(spark, sf, "customer")
    files.write_json(customer, path)
    return spark.read.schema(customer.schema).json(path)


@query("report_tsv", CUSTOMER_ROWS)
def report_tsv(spark, sf):
    path = work_dir(spark, "report")
    customer = table(spark, sf, "customer")
    files.write_report(customer, path)
    return files.read_report(spark, path, customer.schema)


@query("save_modes", CUSTOMER_ROWS)
def save_modes(spark, sf):
    """Create, replace, and leave alone: the rows are there once."""
    root = work_dir(spark, "index")
    customer = table(spark, sf, "customer")
    for mode in ("errorifexists", "append", "overwrite", "ignore"):
        write_records(customer, root, "es://cust/row", mode=mode)
    return read_index(spark, root, "es://cust/row").select(*customer.columns)


@query("copy_index", """
SELECT CAST(event_id AS VARCHAR) AS doc_id, user_id, 'copied' AS note FROM events
WHERE event_type IN ('click', 'view')""")
def copy_index(spark, sf):
    """Read with a query, transform, write to another index."""
    root = index_of(spark, table(spark, sf, "events"), "es://events/event", id_field="event_id")

    def mapper(lines):
        d = F.from_json("value", "event_id long, user_id long")
        return lines.select(d.alias("d")).select(F.to_json(F.struct(
            F.col("d.event_id").alias("_id"), "d.user_id", F.lit("copied").alias("note"))).alias("value"))

    flow.copy_index(
        spark, root, "es://events/event", "es://copies/event", mapper,
        query={"terms": {"event_type": ["click", "view"]}})
    docs = read_index(spark, root, "es://copies/event")
    return docs.select(
        F.col("_id").alias("doc_id"), F.get_json_object("_source", "$.user_id").cast("long").alias("user_id"),
        F.get_json_object("_source", "$.note").alias("note"))


@query("flow_identity", "SELECT props AS value, count(*) AS lines FROM events GROUP BY props")
def flow_identity(spark, sf):
    """Files into an index, and the index out to files, unchanged."""
    root, source, target = work_dir(spark, "index"), work_dir(spark, "lines"), work_dir(spark, "lines")
    table(spark, sf, "events").select(F.col("props").alias("value")).write.text(source)
    flow.run_flow(spark, source, "es://props/line", root=root)
    flow.run_flow(spark, "es://props/line", target, root=root)
    return spark.read.text(target).groupBy("value").agg(F.count("*").alias("lines"))


@query("flow_files", "SELECT event_type AS value, count(*) AS lines FROM events GROUP BY event_type")
def flow_files(spark, sf):
    """A map step and a reduce step between plain files."""
    source, target = work_dir(spark, "lines"), work_dir(spark, "lines")
    table(spark, sf, "events").select(F.to_json(F.struct("event_type", "user_id")).alias("value")).write.text(source)
    flow.run_flow(
        spark, source, target,
        mapper=lambda lines: lines.select(F.get_json_object("value", "$.event_type").alias("value")),
        reducer=lambda words: words.groupBy("value").agg(F.count("*").alias("n")).select(
            F.concat_ws("\t", "value", "n").alias("value")))
    return files.read_tsv(spark, target, "value string, lines long")


@query("dump_console", """
SELECT '(' || c_custkey || ',' || c_name || ',' || c_nationkey || ',' || c_mktsegment || ',' || CAST(c_acctbal AS DECIMAL(18, 2)) || ')' AS line
FROM customer""")
def dump_console(spark, sf):
    """The lines that a dump to the console prints."""
    return flow.printed(table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment", F.col("c_acctbal").cast(MONEY).alias("c_acctbal")))


@query("write_metrics", """
SELECT count(*) AS records, CAST(sum(octet_length(encode(
  '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '","o_totalprice":'
  || CAST(o_totalprice AS DECIMAL(18, 2)) || ',"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f')
  || '","o_orderpriority":"' || o_orderpriority || '"}'
))) AS BIGINT) AS bytes, 0::BIGINT AS rejected FROM orders""")
def write_metrics(spark, sf):
    """What a load reports: items, bytes and rejected rows."""
    root = work_dir(spark, "index")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast(MONEY).alias("o_totalprice"), "o_orderdate", "o_orderpriority")
    done = write_records(orders, root, "es://ord/order")
    return spark.createDataFrame(
        [(done.records, done.bytes, done.rejected)], "records long, bytes long, rejected long")
