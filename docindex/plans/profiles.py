"""Counts, cardinalities, catalog listings, order and ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from docindex.functions.records import JSON_OPTIONS
from docindex.functions.text import tokens
from docindex.operators import profile, reports
from docindex.operators.ordinals import running_mean
from docindex.operators.ranking import ranked_hits
from docindex.operators.search import hits_count, matching, search, sorted_documents
from docindex.plans.common import PLACES, Registry, events, index_of, table
from docindex.plans.scans import daily_events
from docindex.sources import catalog, postings, sketches
from docindex.sources.store import json_documents, read_index, write_documents, write_records
from docindex.workspace import work_dir

REGISTRY = Registry()
query = REGISTRY.add


def event_documents(spark, sf, *columns):
    """Events as raw documents, without an index."""
    return table(spark, sf, "events").select(F.to_json(F.struct(*columns), JSON_OPTIONS).alias("_source"))


@query("hits_count", "SELECT count(*) AS hits FROM events WHERE event_type = 'click' AND value > 20")
def count_hits(spark, sf):
    body = {"query": {"and": [{"term": {"event_type": "click"}}, {"range": {"value": {"gt": 20}}}]}}
    return hits_count(matching(table(spark, sf, "events"), body))


@query("docs_per_index", """
SELECT 'ev-' || strftime(ts, '%Y%m%d') AS index_name, count(*) AS docs FROM events GROUP BY 1
UNION ALL SELECT 'ord', count(*) FROM orders""")
def docs_per_index(spark, sf):
    root = work_dir(spark, "index")
    write_documents(json_documents(daily_events(spark, sf)), root, rebalance=True)
    write_records(table(spark, sf, "orders"), root, "es://ord/order")
    return catalog.document_counts(spark, root).withColumnRenamed("_index", "index_name")


CARDINALITY = """
SELECT 'event_type' AS field, count(DISTINCT coalesce(nullif(event_type, 'view'), '')) AS "values" FROM events
UNION ALL SELECT 'user_id', count(DISTINCT coalesce(CAST(nullif(user_id, 7) AS VARCHAR), '')) FROM events
UNION ALL SELECT 'value', count(DISTINCT CAST(value AS DECIMAL(18, 2))) FROM events
UNION ALL SELECT 'props', count(DISTINCT props) FROM events"""


@query("cardinality", CARDINALITY)
def cardinality(spark, sf):
    """Distinct printed values; a missing one counts."""
    df = events(spark, sf).withColumn("event_type", F.nullif("event_type", F.lit("view"))).withColumn(
        "user_id", F.nullif("user_id", F.lit(7)))
    return profile.cardinality(df, ["event_type", "user_id", "value", "props"])


@query("cardinality_approx", """
SELECT unnest(['event_type', 'user_id', 'value', 'props']) AS field, true AS near""")
def cardinality_approx(spark, sf):
    """Stored sketches of a family of indices, merged: each figure is within 3 % of the exact one."""
    root, fields = work_dir(spark, "index"), ["event_type", "user_id", "value", "props"]
    rows = table(spark, sf, "events")
    write_records(rows.where("user_id % 2 = 0"), root, "es://ev-even/event", id_field="event_id")
    write_records(rows.where("user_id % 2 = 1"), root, "es://ev-odd/event", id_field="event_id")
    sketches.build(spark, root, fields)
    # Two of the documents change afterwards: their write is sketched anew.
    write_records(rows.where("event_id < 2").withColumn("event_type", F.lit("click")), root, "es://ev-even/event", id_field="event_id")
    exact = profile.cardinality(read_index(spark, root, "es://ev-*"), fields).withColumnRenamed("values", "exact")
    near = F.abs(F.col("values") - F.col("exact")) <= 0.03 * F.col("exact")
    return sketches.cardinality(spark, root, fields, "es://ev-*").join(exact, "field").select("field", near.alias("near"))


# Every member of an event's document, as its text.
MEMBERS = {
    "event_id": "CAST(event_id AS VARCHAR)", "ts": "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')", "user_id": "CAST(user_id AS VARCHAR)",
    "event_type": "event_type", "value": "CAST(CAST(CAST(value AS DECIMAL(18, 2)) AS DOUBLE) AS VARCHAR)", "props": "props",
}


def exact_documents(spark, sf):
    """Whole events as raw documents, with the value as an exact number."""
    return events(spark, sf).select(F.to_json(F.struct("*"), JSON_OPTIONS).alias("_source"))


@query("value_counts", " UNION ALL ".join(
    f"SELECT '{name}' AS field, {text} AS value, count(*) AS count FROM events GROUP BY 2" for name, text in MEMBERS.items()))
def value_counts(spark, sf):
    return profile.value_counts(exact_documents(spark, sf))


@query("field_cardinality", " UNION ALL ".join(
    f"""SELECT '{name}' AS field, count(DISTINCT {text}) AS "values" FROM events""" for name, text in MEMBERS.items()))
def field_cardinality(spark, sf):
    return profile.field_cardinality(exact_documents(spark, sf))


WORDS = "regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}]+')"
LISTED = f"SELECT DISTINCT unnest({WORDS.format('text')}) AS word FROM benchmark"
DOCUMENT_WORDS = f"unnest(list_distinct({WORDS.format('text')})) AS word FROM documents"


def word_list(spark, sf):
    parts = F.split(F.lower("text"), "[^\\p{L}\\p{N}]+")
    return table(spark, sf, "benchmark").select(F.explode(parts).alias("word")).where("word <> ''").distinct()


@query("term_hits", f"""
WITH w AS ({LISTED}), d AS (SELECT {DOCUMENT_WORDS}), c AS (SELECT word, count(*) AS hits FROM d GROUP BY word)
SELECT w.word, coalesce(c.hits, 0) AS hits FROM w LEFT JOIN c USING (word) WHERE w.word <> ''""")
def term_hits(spark, sf):
    """Documents per word of a list."""
    return profile.term_hits(table(spark, sf, "documents"), "text", word_list(spark, sf))


@query("term_hits_per_index", f"""
WITH w AS ({LISTED}), d AS (SELECT lang, {DOCUMENT_WORDS})
SELECT lang, d.word, count(*) AS hits FROM d SEMI JOIN w USING (word) WHERE d.word <> '' GROUP BY 1, 2""")
def term_hits_per_index(spark, sf):
    return profile.term_hits(table(spark, sf, "documents"), "text", word_list(spark, sf), per="lang")


@query("running_mean", """
SELECT user_id, event_id, CAST(value AS DOUBLE) AS value,
       CAST(sum(CAST(value AS DECIMAL(18, 2))) OVER w AS DOUBLE) / count(value) OVER w AS running_mean
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""")
def mean_so_far(spark, sf):
    means = running_mean(events(spark, sf), "user_id", "event_id", "value")
    return means.select(
        "user_id", "event_id", F.col("value").cast("double").alias("value"), "running_mean")


@query("running_mean_one_run", """
SELECT 1 AS run, event_id,
       CAST(sum(CAST(value AS DECIMAL(18, 2))) OVER w AS DOUBLE) / count(value) OVER w AS running_mean
FROM events WINDOW w AS (ORDER BY event_id)""")
def mean_of_one_run(spark, sf):
    """One run that holds the whole table."""
    means = running_mean(events(spark, sf).withColumn("run", F.lit(1)), "run", "event_id", "value")
    return means.select("run", "event_id", "running_mean")


# -- catalog -------------------------------------------------------------------

def two_indices(spark, sf):
    root = work_dir(spark, "index")
    write_documents(json_documents(daily_events(spark, sf)), root, rebalance=True)
    write_records(table(spark, sf, "orders"), root, "es://ord/order")
    write_records(table(spark, sf, "customer"), root, "es://ord/customer")
    return root


INDEX_NAMES = "SELECT DISTINCT 'ev-' || strftime(ts, '%Y%m%d') AS name FROM events UNION ALL SELECT 'ord'"


@query("list_indices", INDEX_NAMES)
def list_indices(spark, sf):
    """Names from the directories alone."""
    return catalog.names_frame(spark, catalog.list_indices(spark, two_indices(spark, sf)), "name")


@query("names", f"SELECT name FROM ({INDEX_NAMES}) ORDER BY name")
def names(spark, sf):
    """Sorted names; those of the directories, for an index is there if a document is."""
    return catalog.names_frame(spark, catalog.list_indices(spark, two_indices(spark, sf)), "name").orderBy("name")


@query("doc_types", "SELECT DISTINCT event_type AS type_name FROM events")
def doc_types(spark, sf):
    """The types that an index's documents named."""
    root = work_dir(spark, "index")
    lines = table(spark, sf, "events").select(F.to_json(F.struct(F.col("event_type").alias("_mapping"), "*")).alias("value"))
    write_documents(json_documents(lines, "es://ev/event"), root)
    write_records(table(spark, sf, "orders"), root, "es://ord/order")
    return catalog.names_frame(spark, catalog.list_types(spark, root, "ev"), "type_name")


@query("observed_mapping", """
SELECT f AS field, 'STRING' AS type FROM events, (SELECT unnest(['event_type', 'ts', 'props']) AS f) GROUP BY 1
UNION ALL SELECT f, 'BIGINT' FROM events, (SELECT unnest(['event_id', 'user_id', 'cents']) AS f) GROUP BY 1
UNION ALL SELECT 'tags', 'ARRAY<BIGINT>' FROM events GROUP BY 1""")
def observed_mapping(spark, sf):
    """Field types as the documents show them."""
    cents = F.round(F.col("value") * 100).cast("long").alias("cents")
    return catalog.observed_mapping(
        event_documents(spark, sf, "event_id", "ts", "user_id", "event_type", "props", cents, F.array("user_id").alias("tags")))


@query("catalog_fields", """
SELECT column_name AS field FROM (DESCRIBE SELECT * FROM events) UNION ALL SELECT 'click_only' FROM events
WHERE event_type = 'click' GROUP BY 1""")
def catalog_fields(spark, sf):
    only = F.when(F.col("event_type") == "click", F.col("user_id")).alias("click_only")
    return catalog.document_fields(event_documents(spark, sf, "*", only))


@query("catalog_fields_given", """
SELECT column_name AS field FROM (DESCRIBE SELECT * FROM events) WHERE column_name IN ('user_id', 'value')""")
def catalog_fields_given(spark, sf):
    return catalog.document_fields(event_documents(spark, sf, "*"), only=["user_id", "value", "absent"])


# -- reports -------------------------------------------------------------------

@query("throughput", """
WITH runs AS (
  SELECT o_custkey AS run, count(*) * 1000000 AS records, CAST(sum(CAST(round(o_totalprice) AS BIGINT)) * 4096 AS BIGINT) AS bytes,
         CAST(max(o_orderkey) % 7200 AS BIGINT) AS seconds, CAST(max(o_orderkey) % 9 AS BIGINT) AS m FROM orders GROUP BY 1),
t AS (SELECT *, greatest(m, 1) AS machines,
  (seconds // 3600) || 'h' || lpad(CAST(seconds // 60 % 60 AS VARCHAR), 2, '0') || 'm' || lpad(CAST(seconds % 60 AS VARCHAR), 2, '0') AS duration FROM runs)
SELECT run, bytes, records, duration, machines, seconds, records // nullif(seconds, 0) // machines AS rec_s_machine,
       bytes // nullif(seconds, 0) // 1024 // machines AS kib_s_machine, records // nullif(seconds, 0) AS rec_s,
       bytes // nullif(seconds, 0) // 1024 AS kib_s FROM t""")
def throughput(spark, sf):
    """Rates of load runs; each customer's orders stand for a run."""
    runs = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("run")).agg(
        (F.count("*") * 1000000).alias("records"),
        (F.sum(F.round("o_totalprice").cast("long")) * 4096).alias("bytes"),
        (F.max("o_orderkey") % 7200).alias("s"), (F.max("o_orderkey") % 9).alias("machines"))
    duration = F.format_string("%dh%02dm%02d", F.expr("s div 3600"), F.expr("s div 60 % 60"), F.expr("s % 60"))
    return reports.throughput(runs.select("run", "bytes", "records", duration.alias("duration"), "machines"))


@query("alias_inversion", """
SELECT DISTINCT alias, 'ev-' || strftime(ts, '%Y%m%d') AS "index"
FROM (SELECT ts, unnest(['all', event_type]) AS alias FROM events)""")
def alias_inversion(spark, sf):
    """Daily indices carry aliases; each alias is listed with its indices."""
    aliases = table(spark, sf, "events").select(
        F.concat(F.lit("ev-"), F.date_format("ts", "yyyyMMdd")).alias("index"), "event_type",
    ).distinct().select("index", F.array(F.lit("all"), "event_type").alias("aliases"))
    return reports.invert_aliases(aliases)


# -- order and rank ------------------------------------------------------------

@query("sorted_docs", """
SELECT * FROM orders ORDER BY o_orderpriority, o_orderdate, o_orderkey""")
def sorted_docs(spark, sf):
    return sorted_documents(table(spark, sf, "orders"), ["o_orderpriority", "o_orderdate", "o_orderkey"])


@query("page", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 1000""")
def page_of_hits(spark, sf):
    """A page of a sorted request."""
    body = {"query": {"match_all": {}}, "from": 1000, "size": 50, "sort": [{"o_totalprice": "desc"}, "o_orderkey"]}
    return search(table(spark, sf, "orders"), body).hits.select("o_orderkey", "o_totalprice")


@query("page_by_id", """
SELECT CAST(event_id AS VARCHAR) AS doc_id FROM events WHERE event_type = 'click'
ORDER BY CAST(event_id AS VARCHAR) LIMIT 20 OFFSET 40""")
def page_by_id(spark, sf):
    """Hits without a sort come in id order."""
    root = index_of(spark, table(spark, sf, "events"), "es://events/event", id_field="event_id")
    body = {"query": {"term": {"event_type": "click"}}, "from": 40, "size": 20}
    return search(read_index(spark, root, "es://events"), body).hits.select(F.col("_id").alias("doc_id"))


@query("ranked_hits", f"""
WITH t AS (SELECT doc_id, [w for w in {WORDS.format('text')} if w <> ''] AS w FROM documents),
c AS (SELECT doc_id, len(w) AS len, len([x for x in w if x = 'the']) AS tf1, len([x for x in w if x = 'und']) AS tf2 FROM t),
s AS (SELECT count(*) AS n, avg(len) AS mean, count(*) FILTER (WHERE tf1 > 0) AS d1, count(*) FILTER (WHERE tf2 > 0) AS d2 FROM c)
SELECT doc_id, round(
  CASE WHEN tf1 > 0 THEN ln(1 + (n - d1 + 0.5) / (d1 + 0.5)) * tf1 * 2.2 / (tf1 + 1.2 * (0.25 + 0.75 * len / mean)) ELSE 0 END
+ CASE WHEN tf2 > 0 THEN ln(1 + (n - d2 + 0.5) / (d2 + 0.5)) * tf2 * 2.2 / (tf2 + 1.2 * (0.25 + 0.75 * len / mean)) ELSE 0 END,
{PLACES}) AS score FROM c, s WHERE tf1 > 0 OR tf2 > 0 ORDER BY score DESC, doc_id LIMIT 10""")
def ranked(spark, sf):
    """Best documents for two words."""
    hits = ranked_hits(table(spark, sf, "documents"), "doc_id", "text", "the und", 10)
    return hits.select("doc_id", F.round("_score", PLACES).alias("score"))


def text_index(spark, sf):
    """Documents in two writes, some of the first replaced by the second, with postings of their text."""
    root = work_dir(spark, "index")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    write_records(docs, root, "es://docs/row", id_field="doc_id")
    write_records(docs.where("doc_id % 10 = 0").withColumn("text", F.concat("text", F.lit(" the und appended"))), root, "es://docs/row", id_field="doc_id")
    postings.build(spark, root, "text")
    return root


#: The same documents' words.
INDEXED = f"""t AS (SELECT doc_id, [w for w in {WORDS.format("CASE WHEN doc_id % 10 = 0 THEN text || ' the und appended' ELSE text END")} if w <> ''] AS w FROM documents)"""


@query("postings_built", f"""
WITH {INDEXED}, e AS (SELECT doc_id, unnest(w) AS word FROM t)
SELECT word, count(DISTINCT doc_id) AS docs, count(*) AS times FROM e GROUP BY word""")
def postings_built(spark, sf):
    """Every word's documents and occurrences, from the postings alone."""
    found = postings.entries(spark, text_index(spark, sf), "text", lengths=False)
    return found.groupBy("word").agg(F.count("*").alias("docs"), F.sum("times").alias("times"))


@query("term_hits_by_postings", f"""
WITH {INDEXED}, l AS (SELECT lang AS word FROM documents WHERE lang IS NOT NULL UNION SELECT 'the' UNION SELECT 'appended' UNION SELECT 'not-there')
SELECT word, (SELECT count(*) FROM t WHERE list_contains(w, word)) AS hits FROM l""")
def term_hits_by_postings(spark, sf):
    """Documents of each listed word, from the postings alone."""
    words = table(spark, sf, "documents").where("lang IS NOT NULL").select(F.col("lang").alias("word"))
    words = words.unionByName(spark.createDataFrame([("the",), ("appended",), ("not-there",)], "word string"))
    return postings.term_hits(spark, text_index(spark, sf), "text", words)


@query("q_by_postings", f"""
WITH {INDEXED}
SELECT CAST(doc_id AS VARCHAR) AS doc_id, len(w) AS words FROM t WHERE list_contains(w, 'the') AND list_contains(w, 'of')""")
def q_by_postings(spark, sf):
    """Documents with every word, found by postings instead of a search through all texts."""
    docs = postings.matching(spark, text_index(spark, sf), "text", "the of", every=True)
    return docs.select(F.col("_id").alias("doc_id"), F.size(tokens(F.col("text"))).cast("long").alias("words"))


@query("ranked_by_blocks", f"""
WITH {INDEXED},
c AS (SELECT doc_id, len(w) AS len, len([x for x in w if x = 'appended']) AS tf1, len([x for x in w if x = 'und']) AS tf2 FROM t),
s AS (SELECT count(*) AS n, avg(len) AS mean, count(*) FILTER (WHERE tf1 > 0) AS d1, count(*) FILTER (WHERE tf2 > 0) AS d2 FROM c)
SELECT CAST(doc_id AS VARCHAR) AS doc_id, round(
  CASE WHEN tf1 > 0 THEN ln(1 + (n - d1 + 0.5) / (d1 + 0.5)) * tf1 * 2.2 / (tf1 + 1.2 * (0.25 + 0.75 * len / mean)) ELSE 0 END
+ CASE WHEN tf2 > 0 THEN ln(1 + (n - d2 + 0.5) / (d2 + 0.5)) * tf2 * 2.2 / (tf2 + 1.2 * (0.25 + 0.75 * len / mean)) ELSE 0 END,
{PLACES}) AS score FROM c, s WHERE tf1 > 0 OR tf2 > 0 ORDER BY score DESC, CAST(doc_id AS VARCHAR) LIMIT 10""")
def ranked_by_blocks(spark, sf):
    """The best documents for two words, reading only blocks that can hold one."""
    hits = postings.ranked(spark, text_index(spark, sf), "text", "appended und", 10)
    return hits.select(F.col("_id").alias("doc_id"), F.round("_score", PLACES).alias("score"))
