"""Facets and whole request bodies."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from docindex.functions.text import tokens
from docindex.operators import facets
from docindex.operators.search import search
from docindex.plans.common import PLACES, Registry, events, lineitem, table, tidy
from docindex.sources import rollups
from docindex.sources.store import write_records
from docindex.workspace import work_dir

REGISTRY = Registry()
query = REGISTRY.add

V = "CAST(value AS DECIMAL(18, 2))"
STATISTICAL = f"""count({V}) {{f}} AS count, CAST(sum({V}) {{f}} AS DOUBLE) AS total, CAST(min({V}) {{f}} AS DOUBLE) AS min,
CAST(max({V}) {{f}} AS DOUBLE) AS max, CAST(sum({V}) {{f}} AS DOUBLE) / nullif(count({V}) {{f}}, 0) AS mean,
round(CAST(sum({V} * {V}) {{f}} AS DOUBLE), 4) AS sum_of_squares, round(var_pop(value) {{f}}, {PLACES}) AS variance,
round(stddev_pop(value) {{f}}, {PLACES}) AS std_deviation"""


def stats_sql(value: str = V) -> str:
    return f"""count(*) AS count, count({value}) AS total_count, CAST(sum({value}) AS DOUBLE) AS total,
CAST(min({value}) AS DOUBLE) AS min, CAST(max({value}) AS DOUBLE) AS max, CAST(sum({value}) AS DOUBLE) / nullif(count({value}), 0) AS mean"""


def with_gaps(df):
    """Events without a type for views and without a value for errors."""
    return df.withColumn("value", F.when(F.col("event_type") != "error", F.col("value"))).withColumn(
        "event_type", F.nullif("event_type", F.lit("view")))


GAPS = """(SELECT event_id, ts, user_id, nullif(event_type, 'view') AS event_type,
CASE WHEN event_type <> 'error' THEN CAST(value AS DECIMAL(18, 2)) END AS value FROM events)"""


@query("facet_statistical", f"SELECT {STATISTICAL.format(f='')} FROM events")
def facet_statistical(spark, sf):
    return tidy(facets.statistical(events(spark, sf), "value"))


@query("facet_statistical_filtered", f"""
SELECT {STATISTICAL.format(f="FILTER (WHERE event_type = 'click')")} FROM events WHERE user_id < 100""")
def facet_statistical_filtered(spark, sf):
    """The facet's own filter beside the request's."""
    hits = events(spark, sf).where("user_id < 100")
    return tidy(facets.statistical(hits, "value", F.col("event_type") == "click"))


@query("facet_terms", "SELECT user_id AS term, count(*) AS count FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def facet_terms(spark, sf):
    return facets.terms(table(spark, sf, "events"), "user_id")


@query("facet_terms_totals", f"""
WITH c AS (SELECT event_type AS term, count(*) AS n FROM {GAPS} GROUP BY 1)
SELECT CAST((SELECT sum(n) FROM c WHERE term IS NULL) AS BIGINT) AS missing,
       CAST((SELECT sum(n) FROM c WHERE term IS NOT NULL) AS BIGINT) AS total,
       CAST((SELECT sum(n) FROM (SELECT n FROM c WHERE term IS NOT NULL ORDER BY n DESC, term OFFSET 2)) AS BIGINT) AS other""")
def facet_terms_totals(spark, sf):
    return facets.terms_totals(with_gaps(events(spark, sf)), "event_type", 2)


@query("facet_terms_multi", """
SELECT term, count(*) AS count FROM (
  SELECT unnest(list_distinct([CAST(l_linenumber AS VARCHAR), l_returnflag, l_linestatus])) AS term FROM lineitem)
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def facet_terms_multi(spark, sf):
    return facets.terms_multi(table(spark, sf, "lineitem"), ["l_linenumber", "l_returnflag", "l_linestatus"])


@query("facet_terms_list", """
SELECT term, count(*) AS count FROM (
  SELECT unnest(list_distinct(regexp_split_to_array(lower(o_orderpriority), '[^\\p{L}\\p{N}]+'))) AS term FROM orders)
WHERE term <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def facet_terms_list(spark, sf):
    """A field with several values: one count per distinct value of a document."""
    return facets.terms(table(spark, sf, "orders"), tokens(F.col("o_orderpriority")))


@query("facet_script", f"""
SELECT 'f1' AS facet, coalesce(event_type, 'null') || '|' || user_id AS term, count(*) AS count FROM {GAPS} GROUP BY 2""")
def facet_script(spark, sf):
    """Terms of a script value, all of them."""
    body = {"f1": {"terms": {"script_field": "_source.event_type + '|' + _source.user_id", "size": 5, "all_terms": True}}}
    return facets.facet_request(with_gaps(events(spark, sf)), body).select("facet", "term", "count")


@query("facet_all_terms", f"""
SELECT event_type AS term, count(*) FILTER (WHERE user_id = 3 AND value > 100) AS count FROM {GAPS}
WHERE event_type IS NOT NULL GROUP BY 1""")
def facet_all_terms(spark, sf):
    """Terms without matches are listed with 0."""
    matched = (F.col("user_id") == 3) & (F.col("value") > 100)
    return facets.terms(with_gaps(events(spark, sf)), "event_type", where=matched, all_terms=True)


@query("facet_terms_stats", f"""
SELECT event_type AS term, {stats_sql('value')} FROM {GAPS} WHERE event_type IS NOT NULL GROUP BY 1""")
def facet_terms_stats(spark, sf):
    return tidy(facets.terms_stats(with_gaps(events(spark, sf)), "event_type", "value", all_terms=True))


@query("facet_stats_order", f"""
SELECT user_id AS term, {stats_sql()} FROM events WHERE event_type <> 'error' GROUP BY 1
ORDER BY sum({V}) DESC, 1 LIMIT 20""")
def facet_stats_order(spark, sf):
    """By total, the first 20."""
    df = events(spark, sf)
    return tidy(facets.terms_stats(
        df, "user_id", "value", size=20, order="total", where=~F.col("event_type").eqNullSafe("error")))


@query("facet_day", "SELECT date_trunc('day', ts)::TIMESTAMP AS term, count(*) AS count FROM events GROUP BY 1")
def facet_day(spark, sf):
    return facets.date_histogram(table(spark, sf, "events"), "ts", "day")


@query("facet_day_value", f"SELECT date_trunc('day', ts)::TIMESTAMP AS term, {stats_sql()} FROM events GROUP BY 1")
def facet_day_value(spark, sf):
    return tidy(facets.date_histogram(events(spark, sf), "ts", "day", "value"))


@query("facet_day_tz", f"""
SELECT date_trunc('day', ts - INTERVAL 8 HOUR)::TIMESTAMP + INTERVAL 8 HOUR AS term, {stats_sql()} FROM events
WHERE event_type = 'click' GROUP BY 1""")
def facet_day_tz(spark, sf):
    """Local days of a zone, reported as instants (January has no clock change)."""
    return tidy(facets.date_histogram(
        events(spark, sf), "ts", "day", "value", zone="US/Pacific", where=F.col("event_type") == "click"))


@query("facet_month", """
SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS term, count(*) AS count FROM orders GROUP BY 1""")
def facet_month(spark, sf):
    return facets.date_histogram(table(spark, sf, "orders"), "o_orderdate", "month")


Q = "CAST(l_quantity AS DECIMAL(18, 2))"


def keyed_sql(facet: str, key: str) -> str:
    return f"""SELECT '{facet}' AS facet, CAST({key} AS VARCHAR) AS term, count(*) AS count, count({Q}) AS total_count,
CAST(sum({Q}) AS DOUBLE) AS total, CAST(min({Q}) AS DOUBLE) AS min, CAST(max({Q}) AS DOUBLE) AS max,
CAST(sum({Q}) AS DOUBLE) / count({Q}) AS mean, NULL::DOUBLE AS sum_of_squares, NULL::DOUBLE AS variance,
NULL::DOUBLE AS std_deviation FROM lineitem GROUP BY {key}"""


NO_STATS = """NULL::BIGINT AS total_count, NULL::DOUBLE AS total, NULL::DOUBLE AS min, NULL::DOUBLE AS max,
NULL::DOUBLE AS mean, NULL::DOUBLE AS sum_of_squares, NULL::DOUBLE AS variance, NULL::DOUBLE AS std_deviation"""


@query("facet_request", f"""
{keyed_sql('by_flag', 'l_returnflag')} UNION ALL {keyed_sql('by_status', 'l_linestatus')}
UNION ALL {keyed_sql('by_line', 'l_linenumber')}
UNION ALL SELECT 'by_month', strftime(date_trunc('month', l_shipdate), '%Y-%m-%d %H:%M:%S'), count(*), {NO_STATS}
FROM lineitem GROUP BY date_trunc('month', l_shipdate)
UNION ALL SELECT 'number', 'all', count(*), count({Q}), CAST(sum({Q}) AS DOUBLE), CAST(min({Q}) AS DOUBLE),
CAST(max({Q}) AS DOUBLE), CAST(sum({Q}) AS DOUBLE) / count({Q}), round(CAST(sum({Q} * {Q}) AS DOUBLE), 4),
round(var_pop(l_quantity), {PLACES}), round(stddev_pop(l_quantity), {PLACES}) FROM lineitem WHERE l_returnflag = 'R'""")
def facet_request(spark, sf):
    """Five facets of one request in one pass; no hits are asked for."""
    def stats(key):
        return {"terms_stats": {"key_field": key, "value_field": "l_quantity"}}

    body = {"query": {"match_all": {}}, "size": 0, "facets": {
        "by_flag": stats("l_returnflag"), "by_status": stats("l_linestatus"), "by_line": stats("l_linenumber"),
        "by_month": {"date_histogram": {"field": "l_shipdate", "interval": "month"}},
        "number": {"statistical": {"field": "l_quantity"}, "facet_filter": {"term": {"l_returnflag": "R"}}},
    }}
    return tidy(search(lineitem(spark, sf), body).facets)


@query("top_per_key", """
SELECT l_suppkey, l_returnflag, term, count FROM (
  SELECT l_suppkey, l_returnflag, l_partkey AS term, count(*) AS count FROM lineitem GROUP BY 1, 2, 3)
QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY count DESC, term) = 1""")
def top_per_key(spark, sf):
    """The most frequent part for every supplier and flag."""
    return facets.top_per_key(table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"], "l_partkey")


@query("top_per_wanted_key", """
SELECT l_suppkey, term, count FROM (
  SELECT l_suppkey, l_linenumber AS term, count(*) AS count FROM lineitem
  WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY count DESC, term) <= 3""")
def top_per_wanted_key(spark, sf):
    """Three values for each key of a table."""
    wanted = table(spark, sf, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return facets.top_per_key(table(spark, sf, "lineitem"), ["l_suppkey"], "l_linenumber", 3, wanted)


@query("top_per_key_many", """
SELECT l_returnflag, term, count FROM (
  SELECT l_returnflag, l_partkey AS term, count(*) AS count FROM lineitem GROUP BY 1, 2)
QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY count DESC, term) <= 1500""")
def top_per_key_many(spark, sf):
    """More values per key than a short list."""
    return facets.top_per_key(table(spark, sf, "lineitem"), ["l_returnflag"], "l_partkey", 1500)


@query("facet_request_all_terms", f"""
SELECT 'types' AS facet, event_type AS term, count(*) FILTER (WHERE user_id = 3 AND value > 100) AS count FROM {GAPS}
WHERE event_type IS NOT NULL GROUP BY 2
UNION ALL SELECT 'values', u.v, count(*) FILTER (WHERE value > 100) FROM (
  SELECT value, unnest(list_distinct([event_type, CAST(user_id AS VARCHAR)])) AS v FROM {GAPS}) u WHERE u.v IS NOT NULL GROUP BY 2""")
def facet_request_all_terms(spark, sf):
    """All terms beside a filter, also those that no document passing it has."""
    over = {"range": {"value": {"gt": 100}}}
    body = {
        "types": {"terms": {"field": "event_type", "all_terms": True}, "facet_filter": {"and": [{"term": {"user_id": 3}}, over]}},
        "values": {"terms": {"fields": ["event_type", "user_id"], "all_terms": True}, "facet_filter": over}}
    return facets.facet_request(with_gaps(events(spark, sf)), body).select("facet", "term", "count")


@query("facet_request_totals", f"""
WITH g AS (SELECT * FROM {GAPS}), t AS (SELECT event_type AS term, count(*) AS n FROM g WHERE user_id < 60 AND event_type IS NOT NULL GROUP BY 1),
p AS (SELECT v, count(*) AS n FROM (SELECT unnest(list_distinct([event_type, CAST(user_id AS VARCHAR)])) AS v FROM g) WHERE v IS NOT NULL GROUP BY 1)
SELECT 'types' AS facet, (SELECT count(*) FROM g WHERE user_id < 60 AND event_type IS NULL) AS missing,
  CAST((SELECT sum(n) FROM t) AS BIGINT) AS total,
  CAST((SELECT sum(n) FROM t) - (SELECT sum(n) FROM (SELECT n FROM t ORDER BY n DESC, term LIMIT 2)) AS BIGINT) AS other
UNION ALL SELECT 'values', 0::BIGINT, CAST((SELECT sum(n) FROM p) AS BIGINT),
  CAST((SELECT sum(n) FROM p) - (SELECT sum(n) FROM (SELECT n FROM p ORDER BY n DESC, v LIMIT 10)) AS BIGINT)""")
def facet_request_totals(spark, sf):
    """Missing, counted and cut-off values of a request's terms facets."""
    body = {"query": {"match_all": {}}, "size": 0, "facets": {
        "types": {"terms": {"field": "event_type", "size": 2}, "facet_filter": {"range": {"user_id": {"lt": 60}}}},
        "values": {"terms": {"fields": ["event_type", "user_id"]}}}}
    return search(with_gaps(events(spark, sf)), body).facet_totals()


@query("facet_script_plus", """
SELECT 'sums' AS facet, event_type || ' + ' || user_id AS term, count(*) AS count FROM events GROUP BY 2""")
def facet_script_plus(spark, sf):
    """A script whose quoted text holds the operator."""
    body = {"sums": {"terms": {"script_field": "_source.event_type + ' + ' + doc['user_id'].value", "all_terms": True}}}
    return facets.facet_request(events(spark, sf), body).select("facet", "term", "count")


@query("facet_orders", """
SELECT 'rare' AS facet, term, count FROM (SELECT CAST(user_id AS VARCHAR) AS term, count(*) AS count FROM events GROUP BY 1 ORDER BY 2, 1 LIMIT 7)
UNION ALL SELECT 'last', term, count FROM (SELECT event_type AS term, count(*) AS count FROM events GROUP BY 1 ORDER BY 1 DESC LIMIT 2)""")
def facet_orders(spark, sf):
    body = {"rare": {"terms": {"field": "user_id", "order": "reverse_count", "size": 7}},
            "last": {"terms": {"field": "event_type", "order": "reverse_term", "size": 2}}}
    return facets.facet_request(events(spark, sf), body).select("facet", "term", "count")


@query("facet_two_hours", "SELECT time_bucket(INTERVAL 2 HOUR, ts, TIMESTAMP '1970-01-01') AS term, count(*) AS count FROM events GROUP BY 1")
def facet_two_hours(spark, sf):
    return facets.date_histogram(events(spark, sf), "ts", "2h")


@query("term_total", "SELECT count(DISTINCT user_id) AS terms FROM events")
def term_total(spark, sf):
    return facets.term_total(facets.terms(table(spark, sf, "events"), "user_id", size=None))


# -- recorded request shapes ---------------------------------------------------

def answer(df, body):
    return search(df, body).facets


@query("shape_day_sums_in_zone", f"""
SELECT 'amount' AS facet, strftime(date_trunc('day', ts - INTERVAL 8 HOUR)::TIMESTAMP + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS term,
{stats_sql()} FROM events WHERE user_id IN (12, 26, 70) AND ts >= TIMESTAMP '2024-01-05 08:00:00'
AND ts < TIMESTAMP '2024-01-21 07:00:00' AND event_type = 'click' GROUP BY 2""")
def shape_day_sums_in_zone(spark, sf):
    body = {"query": {"constant_score": {"filter": {"and": {"filters": [
        {"terms": {"user_id": [12, 26, 70]}},
        {"range": {"ts": {"gte": "2024-01-05T00:00:00-08:00", "lt": "2024-01-21T00:00:00-07:00"}}},
    ], "_cache": True}}}}, "size": 0, "facets": {"amount": {
        "date_histogram": {"key_field": "ts", "interval": "day", "pre_zone_adjust_large_interval": True,
                           "time_zone": "US/Pacific", "value_field": "value"},
        "facet_filter": {"term": {"event_type": "click"}}}}}
    return tidy(answer(events(spark, sf), body).select("facet", "term", "count", *facets.STATS[1:]))


@query("shape_repeated_facet", """
SELECT 'f' || i AS facet, CAST(user_id AS VARCHAR) AS term, count FROM (
  SELECT user_id, count(*) AS count FROM events WHERE event_type = 'click' GROUP BY 1 ORDER BY 2 DESC, CAST(user_id AS VARCHAR) LIMIT 10),
  range(21) AS r(i)""")
def shape_repeated_facet(spark, sf):
    """21 times the same facet in one request. Equal counts are cut by term text."""
    body = {"query": {"constant_score": {"filter": {"term": {"event_type": "click"}}}}, "size": 0,
            "facets": {f"f{i}": {"terms": {"field": "user_id"}} for i in range(21)}}
    return answer(events(spark, sf), body).select("facet", "term", "count")


@query("shape_filtered_statistics", f"""
SELECT 'amount' AS facet, {STATISTICAL.format(f='')} FROM events
WHERE user_id = 17 AND ts >= TIMESTAMP '2024-01-03 08:00:00' AND ts < TIMESTAMP '2024-01-28 08:00:00'
AND event_type = 'click'""")
def shape_filtered_statistics(spark, sf):
    body = {"query": {"constant_score": {"filter": {"and": {"filters": [
        {"term": {"user_id": 17}},
        {"range": {"ts": {"gte": "2024-01-03T00:00:00-08:00", "lt": "2024-01-28T00:00:00-08:00"}}},
    ], "_cache": True}}}}, "size": 0, "facets": {"amount": {
        "statistical": {"field": "value"}, "facet_filter": {"term": {"event_type": "click"}}}}}
    columns = ("count", "total", "min", "max", "mean", "sum_of_squares", "variance", "std_deviation")
    return tidy(answer(events(spark, sf), body).select("facet", *columns))


@query("shape_excluding_statistics", f"""
SELECT 'amount' AS facet, {STATISTICAL.format(f='')} FROM events
WHERE user_id IN (10, 88) AND value >= 20 AND event_type <> 'error'""")
def shape_excluding_statistics(spark, sf):
    body = {"query": {"constant_score": {"filter": {"terms": {"user_id": [10, 88]}}}}, "size": 0, "facets": {"amount": {
        "statistical": {"field": "value"},
        "facet_filter": {"and": {"filters": [
            {"range": {"value": {"gte": 20}}}, {"not": {"term": {"event_type": "error"}}}], "_cache": False}}}}}
    columns = ("count", "total", "min", "max", "mean", "sum_of_squares", "variance", "std_deviation")
    return tidy(answer(events(spark, sf), body).select("facet", *columns))


@query("shape_ordered_totals", f"""
SELECT 'by_type' AS facet, event_type AS term, {stats_sql()} FROM events
WHERE user_id IN (12, 26, 70) AND ts >= TIMESTAMP '2024-01-05 08:00:00' AND ts < TIMESTAMP '2024-01-21 07:00:00'
AND event_type <> 'error' GROUP BY 2""")
def shape_ordered_totals(spark, sf):
    """Statistics per key by total, with a cut far above the number of keys."""
    body = {"query": {"constant_score": {"filter": {"and": {"filters": [
        {"terms": {"user_id": [12, 26, 70]}},
        {"range": {"ts": {"gte": "2024-01-05T00:00:00-08:00", "lt": "2024-01-21T00:00:00-07:00"}}},
    ]}}}}, "size": 0, "facets": {"by_type": {
        "terms_stats": {"key_field": "event_type", "value_field": "value", "order": "total", "size": 1000000},
        "facet_filter": {"not": {"term": {"event_type": "error"}}}}}}
    return tidy(answer(events(spark, sf), body).select("facet", "term", "count", *facets.STATS[1:]))


@query("shape_key_statistics", f"""
SELECT 'by_user' AS facet, CAST(user_id AS VARCHAR) AS term, {stats_sql()} FROM events
WHERE event_type = 'click' AND ts BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-25' GROUP BY 2""")
def shape_key_statistics(spark, sf):
    """Statistics of every key over a date range."""
    body = {"query": {"constant_score": {"filter": {"and": {"filters": [
        {"term": {"event_type": "click"}}, {"range": {"ts": {"from": "2024-01-02", "to": "2024-01-25"}}}]}}}},
        "size": 0, "facets": {"by_user": {
            "terms_stats": {"key_field": "user_id", "value_field": "value", "all_terms": True}}}}
    return tidy(answer(events(spark, sf), body).select("facet", "term", "count", *facets.STATS[1:]))


@query("shape_pooled_terms", """
SELECT 'values' AS facet, term, count(*) AS count FROM (
  SELECT unnest(list_distinct([CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), l_returnflag])) AS term
  FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1995-02-03' AND TIMESTAMP '1999-02-10')
GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10""")
def shape_pooled_terms(spark, sf):
    body = {"query": {"constant_score": {"filter": {"range": {
        "l_shipdate": {"from": "1995-02-03", "to": "1999-02-10"}}}}}, "size": 0,
        "facets": {"values": {"terms": {"fields": ["l_suppkey", "l_linenumber", "l_returnflag"]}}}}
    return answer(lineitem(spark, sf), body).select("facet", "term", "count")


@query("shape_top_per_combination", """
SELECT l_returnflag || '|' || l_linestatus || '|' || l_linenumber AS facet, CAST(l_suppkey AS VARCHAR) AS term, count
FROM (SELECT l_returnflag, l_linestatus, l_linenumber, l_suppkey, count(*) AS count FROM lineitem
      WHERE l_quantity >= 10 GROUP BY 1, 2, 3, 4)
QUALIFY row_number() OVER (PARTITION BY facet ORDER BY count DESC, term) = 1""")
def shape_top_per_combination(spark, sf):
    """One facet per key combination, each with its own filter and a cut of one."""
    combinations = {
        f"{flag}|{status}|{line}": {"terms": {"field": "l_suppkey", "size": 1}, "facet_filter": {"and": {"filters": [
            {"term": {"l_returnflag": flag}}, {"term": {"l_linestatus": status}}, {"term": {"l_linenumber": line}},
        ], "_cache": False}}}
        for flag, status, line in product("ANR", "FO", range(1, 8))
    }
    body = {"query": {"constant_score": {"filter": {"range": {"l_quantity": {"gte": 10}}}}}, "size": 0,
            "facets": combinations}
    return answer(table(spark, sf, "lineitem"), body).select("facet", "term", "count")


@query("shape_whole_index", f"""
SELECT 'clicks' AS facet, 'all' AS term, count(*) AS count, CAST(sum({V}) AS DOUBLE) AS total FROM events WHERE event_type = 'click'
UNION ALL SELECT 'per_day', strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S'), count(*), NULL FROM events GROUP BY 2
UNION ALL (SELECT 'busiest', CAST(user_id AS VARCHAR), count(*), CAST(sum({V}) AS DOUBLE) FROM events GROUP BY user_id
ORDER BY count(*) DESC, CAST(user_id AS VARCHAR) LIMIT 10)""")
def shape_whole_index(spark, sf):
    """Statistics, a histogram and statistics per key over everything."""
    body = {"query": {"match_all": {}}, "size": 0, "facets": {
        "clicks": {"statistical": {"field": "value"}, "facet_filter": {"term": {"event_type": "click"}}},
        "per_day": {"date_histogram": {"field": "ts", "interval": "day"}},
        "busiest": {"terms_stats": {"key_field": "user_id", "value_field": "value"}}}}
    return tidy(answer(events(spark, sf), body).select("facet", "term", "count", "total"))


# -- the same shapes from stored cells -------------------------------------------

CELLS = rollups.Rollup("ts", "hour", ("event_type", "user_id"), (("value", "decimal(18,2)"),))


def rolled_up(spark, sf):
    """Cells of three writes: one as stored, one from which documents were taken out since, one that came later."""
    root, e = work_dir(spark, "index"), table(spark, sf, "events")
    tenth = F.col("event_id") % 10 == 0
    write_records(e.where("event_id % 2 = 1"), root, "es://ev-odd/event", id_field="event_id")
    write_records(e.where("event_id % 2 = 0").withColumn("value", F.when(tenth, F.lit(0.0)).otherwise(F.col("value"))),
                  root, "es://ev-even/event", id_field="event_id")
    rollups.build(spark, root, CELLS)
    write_records(e.where(tenth), root, "es://ev-even/event", id_field="event_id")
    return rollups.cells(spark, root, CELLS, "es://ev-*")


@query("rollup_whole_index", REGISTRY.sql["shape_whole_index"])
def rollup_whole_index(spark, sf):
    """Statistics, a histogram and statistics per key over everything, without reading documents of the stored cells."""
    cells = rolled_up(spark, sf)
    none = F.lit(None).cast("double").alias("total")
    clicks = rollups.statistical(cells, CELLS, "value", F.col("event_type") == "click")
    per_day = rollups.date_histogram(cells, CELLS, "day")
    busiest = rollups.terms_stats(cells, CELLS, "user_id", "value")
    return (
        tidy(clicks.select(F.lit("clicks").alias("facet"), F.lit("all").alias("term"), "count", "total"))
        .unionByName(per_day.select(F.lit("per_day").alias("facet"), F.date_format("term", "yyyy-MM-dd HH:mm:ss").alias("term"), "count", none))
        .unionByName(tidy(busiest.select(F.lit("busiest").alias("facet"), "term", "count", "total"))))


@query("rollup_day_sums_in_zone", REGISTRY.sql["shape_day_sums_in_zone"])
def rollup_day_sums_in_zone(spark, sf):
    """Local days from cells of one hour; the bounds of the filter lie where hours begin."""
    where = F.col("user_id").isin(12, 26, 70) & (F.col("event_type") == "click") & (
        F.col("bucket") >= F.lit("2024-01-05 08:00:00").cast("timestamp_ntz")) & (F.col("bucket") < F.lit("2024-01-21 07:00:00").cast("timestamp_ntz"))
    days = rollups.date_histogram(rolled_up(spark, sf), CELLS, "day", "value", "US/Pacific", where)
    return tidy(days.select(F.lit("amount").alias("facet"), F.date_format("term", "yyyy-MM-dd HH:mm:ss").alias("term"), "count", *facets.STATS[1:]))
