"""Slow-log workload analysis on a log rendered from the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from docindex.operators import slowlog
from docindex.plans.common import Registry, events, table
from docindex.sources.files import read_report, read_slowlog, write_report
from docindex.workspace import work_dir

REGISTRY = Registry()
query = REGISTRY.add

# The log of the rendered events, as SQL columns.
BODY = """'{"query":{"constant_score":{"filter":{"and":{"filters":[{"term":{"event_type":"' || event_type || '"}},{"range":{"ts":{"gte":"'
|| strftime(ts, '%Y-%m-%d') || '"}}}]}}}},"facets":{"c":{"statistical":{"field":"value"}}}}'"""
FIELDS = f"""event_id, date_trunc('milliseconds', ts)::TIMESTAMP AS ts, 'node-' || user_id % 4 AS node, event_type || '_count' AS "index",
CAST(user_id % 12 AS INTEGER) AS shard, (user_id * 37 + event_id % 1000) AS took_millis,
CASE WHEN event_id % 5 = 0 THEN 'COUNT' ELSE 'QUERY_THEN_FETCH' END AS search_type, {BODY} AS query"""
LOG = f"(SELECT {FIELDS} FROM events WHERE event_id % 11 <> 10)"


def log_lines(spark, sf, faults=False):
    """A log file: mostly queries, with other lines and unreadable ones among them.

    With ``faults`` some requests are cut off, and some name a field that the index lacks.
    """
    body = F.concat(
        F.lit('{"query":{"constant_score":{"filter":{"and":{"filters":[{"term":{"event_type":"'), "event_type",
        F.lit('"}},{"range":{"ts":{"gte":"'), F.date_format("ts", "yyyy-MM-dd"),
        F.lit('"}}}]}}}},"facets":{"c":{"statistical":{"field":"value"}}}}'))
    if faults:
        part = F.col("event_id") % 11
        body = F.when(part == 3, F.left(body, F.length(body) - 1)).when(part == 5, F.regexp_replace(body, '"event_type"', '"no_such"')).otherwise(body)
    millis = F.col("user_id") * 37 + F.col("event_id") % 1000
    line = F.concat(
        F.lit("["), F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS"), F.lit("][WARN ][index.search.slowlog.query] [node-"),
        F.col("user_id") % 4, F.lit("] ["), "event_type", F.lit("_count]["), F.col("user_id") % 12, F.lit("] took["),
        millis, F.lit("ms], took_millis["), millis, F.lit("], search_type["),
        F.when(F.col("event_id") % 5 == 0, "COUNT").otherwise("QUERY_THEN_FETCH"), F.lit("], total_shards[60], "),
        F.when(F.col("event_id") % 11 == 10, F.lit("no query here")).otherwise(
            F.concat(F.lit("source["), body, F.lit('], extra_source[{"size":0}], '))),
    )
    other = F.concat(F.lit("curl -XGET 'localhost/"), "event_type", F.lit("/_search' -d '{}'"))
    return table(spark, sf, "events").select(F.explode(F.array(line, other, F.lit(""))).alias("value"))


def parsed_log(spark, sf, faults=False):
    path = work_dir(spark, "slowlog")
    log_lines(spark, sf, faults).write.text(path)
    return slowlog.parse(read_slowlog(spark, path))


@query("slowlog_parse", f"""
SELECT ts, 'WARN' AS level, node, "index", shard, took_millis || 'ms' AS took, took_millis, CAST(NULL AS VARCHAR) AS types,
       search_type, 60 AS total_shards, query, '{{"size":0}}' AS extra_source, count(*) AS lines
FROM {LOG} GROUP BY ALL""")
def slowlog_parse(spark, sf):
    log = slowlog.usable(parsed_log(spark, sf))
    return log.groupBy(*log.columns).agg(F.count("*").alias("lines"))


@query("slowlog_rejects", """
SELECT 'no query in line' AS reason, count(*) AS lines FROM events WHERE event_id % 11 = 10 GROUP BY 1""")
def slowlog_rejects(spark, sf):
    return slowlog.rejected(parsed_log(spark, sf)).groupBy("reason").agg(F.count("*").alias("lines"))


@query("slowlog_classes", f"""
SELECT CASE WHEN search_type = 'QUERY_THEN_FETCH' THEN 'ok' ELSE 'other search type' END AS status, count(*) AS lines
FROM {LOG} GROUP BY 1""")
def slowlog_classes(spark, sf):
    log = slowlog.classify(slowlog.usable(parsed_log(spark, sf)))
    return log.groupBy("status").agg(F.count("*").alias("lines"))


@query("slowlog_report", f"""
SELECT ts AS original_timestamp, took_millis || 'ms' AS es_duration, node, "index", substr(query, 1, 50) AS query_fragment,
       count(*) AS lines FROM {LOG} GROUP BY ALL""")
def slowlog_report(spark, sf):
    """The report as tab-separated text, read back."""
    path = work_dir(spark, "report")
    report = slowlog.report(slowlog.usable(parsed_log(spark, sf)))
    write_report(report, path)
    rows = read_report(spark, path, report.schema)
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("lines"))


@query("slow_minutes", f"SELECT sum(took_millis) / 60000 AS minutes FROM {LOG}")
def slow_minutes(spark, sf):
    return slowlog.total_minutes(slowlog.usable(parsed_log(spark, sf)))


@query("slowlog_profile", f"""
SELECT "index", regexp_replace(query, '[0-9]+', '#', 'g') AS shape, count(*) AS queries,
       CAST(sum(took_millis) AS BIGINT) AS total_millis, max(took_millis) AS max_millis FROM {LOG} GROUP BY 1, 2""")
def slowlog_profile(spark, sf):
    return slowlog.profile(slowlog.usable(parsed_log(spark, sf)))


@query("slowlog_replay", f"""
WITH q AS (SELECT "index", query, count(*) AS logged, CAST(sum(took_millis) AS BIGINT) AS logged_millis,
  any_value(split_part("index", '_count', 1)) AS t, min(date_trunc('day', ts)) AS d FROM {LOG}
  WHERE search_type = 'QUERY_THEN_FETCH' GROUP BY 1, 2)
SELECT "index", query, logged, logged_millis,
       (SELECT count(*) FROM events e WHERE e.event_type = q.t AND e.ts >= q.d) AS hits FROM q""")
def slowlog_replay(spark, sf):
    """Every distinct comparable request run again on the event table."""
    log = slowlog.usable(parsed_log(spark, sf))
    docs = table(spark, sf, "events")
    return slowlog.replay(log, lambda index: docs).drop("reason")


REQUESTS = f"""
q AS (SELECT "index", query, count(*) AS logged, CAST(sum(took_millis) AS BIGINT) AS logged_millis,
  any_value(split_part("index", '_count', 1)) AS t, min(date_trunc('day', ts)) AS d FROM {LOG}
  WHERE search_type = 'QUERY_THEN_FETCH' GROUP BY 1, 2)"""
FAULTY = f"""(SELECT * REPLACE (CASE event_id % 11 WHEN 3 THEN left(query, length(query) - 1)
  WHEN 5 THEN replace(query, '"event_type"', '"no_such"') ELSE query END AS query) FROM {LOG})"""


@query("slowlog_replay_facets", f"""
WITH {REQUESTS}
SELECT "index", query, logged, logged_millis, 'c' AS facet,
  (SELECT count(*) FROM events e WHERE e.event_type = q.t AND e.ts >= q.d) AS count,
  (SELECT CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) FROM events e WHERE e.event_type = q.t AND e.ts >= q.d) AS total FROM q""")
def slowlog_replay_facets(spark, sf):
    """The facets of every distinct comparable request."""
    log = slowlog.usable(parsed_log(spark, sf))
    docs = events(spark, sf)
    return slowlog.replay_facets(log, lambda index: docs).select(
        "index", "query", "logged", "logged_millis", "facet", "count", "total")


@query("slowlog_replay_faults", f"""
WITH q AS (SELECT "index", query, count(*) AS logged, any_value(split_part("index", '_count', 1)) AS t, min(date_trunc('day', ts)) AS d
  FROM {FAULTY} WHERE search_type = 'QUERY_THEN_FETCH' AND event_id % 11 <> 3 GROUP BY 1, 2)
SELECT "index", query, logged, contains(query, 'no_such') AS refused,
  CASE WHEN NOT contains(query, 'no_such') THEN (SELECT count(*) FROM events e WHERE e.event_type = q.t AND e.ts >= q.d) END AS hits FROM q""")
def slowlog_replay_faults(spark, sf):
    """Requests that cannot be run are reported, and the others are run."""
    log = slowlog.usable(parsed_log(spark, sf, faults=True))
    docs = table(spark, sf, "events")
    return slowlog.replay(log, lambda index: docs).select("index", "query", "logged", F.col("reason").isNotNull().alias("refused"), "hits")


@query("slowlog_class_faults", f"""
SELECT CASE WHEN event_id % 11 = 3 THEN 'malformed' WHEN search_type = 'QUERY_THEN_FETCH' THEN 'ok' ELSE 'other search type' END AS status,
  count(*) AS lines FROM {FAULTY} GROUP BY 1""")
def slowlog_class_faults(spark, sf):
    log = slowlog.classify(slowlog.usable(parsed_log(spark, sf, faults=True)))
    return log.groupBy("status").agg(F.count("*").alias("lines"))
