"""Filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from docindex.operators import filters
from docindex.operators.ordinals import word_filter
from docindex.operators.search import search
from docindex.plans.common import Registry, table

REGISTRY = Registry()
query = REGISTRY.add

COLUMNS = ["event_id", "user_id", "event_type", "value"]
ROWS = "SELECT event_id, user_id, event_type, value FROM events"
WORDS = "regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}]+')"
TEXT_WORDS = WORDS.format("text")
ALL_WORDS = WORDS.format("concat_ws(' ', text, lang, source)")


def kept(spark, sf, condition):
    df = table(spark, sf, "events")
    return df.where(condition(df.schema)).select(*COLUMNS)


def compiled(spark, sf, body):
    return kept(spark, sf, lambda schema: filters.compile_filter(body, schema))


@query("f_match_all", ROWS)
def f_match_all(spark, sf):
    return compiled(spark, sf, {"match_all": {}})


@query("q_free_text", f"SELECT doc_id, n_chars FROM documents WHERE list_contains({ALL_WORDS}, 'the')")
def q_free_text(spark, sf):
    """A bare word over all text fields."""
    df = table(spark, sf, "documents")
    text = [F.col(c) for c in ("text", "lang", "source")]
    return df.where(filters.query_string("The", text)).select("doc_id", "n_chars")


@query("q_field_term", f"SELECT doc_id, n_chars FROM documents WHERE list_contains({TEXT_WORDS}, 'and')")
def q_field_term(spark, sf):
    df = table(spark, sf, "documents")
    return df.where(filters.query_string("text:and", [F.col("text")])).select("doc_id", "n_chars")


@query("q_match", f"""
SELECT doc_id, n_chars FROM documents WHERE list_contains({TEXT_WORDS}, 'the') OR list_contains({TEXT_WORDS}, 'der')""")
def q_match(spark, sf):
    """Any of several words; the request asks for no page, so all matches are taken."""
    df = table(spark, sf, "documents")
    found = search(df, {"query": {"match": {"text": "the, DER!"}}, "size": 0})
    return found.matching.select("doc_id", "n_chars")


@query("f_term", f"{ROWS} WHERE event_type = 'click'")
def f_term(spark, sf):
    return compiled(spark, sf, {"term": {"event_type": "click"}})


@query("f_terms", f"{ROWS} WHERE user_id IN (1, 2, 3, 5, 8, 13)")
def f_terms(spark, sf):
    return compiled(spark, sf, {"terms": {"user_id": [1, 2, 3, 5, 8, "13"]}})


@query("f_terms_table", f"""
{ROWS} WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def f_terms_table(spark, sf):
    """Membership in a table of values."""
    wanted = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    return filters.where_in(table(spark, sf, "events"), "user_id", wanted).select(*COLUMNS)


@query("f_range", f"{ROWS} WHERE ts >= TIMESTAMP '2024-01-05 08:00:00' AND ts < TIMESTAMP '2024-01-12 07:00:00'")
def f_range(spark, sf):
    """Half-open, with zone offsets."""
    return compiled(spark, sf, {"range": {"ts": {"gte": "2024-01-05T00:00:00-08:00", "lt": "2024-01-12T00:00:00-07:00"}}})


@query("f_between", f"{ROWS} WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12'")
def f_between(spark, sf):
    return compiled(spark, sf, {"range": {"ts": {"from": "2024-01-05", "to": "2024-01-12"}}})


@query("f_range_number", f"{ROWS} WHERE value > 10 AND value <= 50.5")
def f_range_number(spark, sf):
    return kept(spark, sf, lambda schema: filters.rng("value", schema, gt=10, lte=50.5))


@query("f_and", f"{ROWS} WHERE event_type = 'click' AND user_id IN (1, 2, 3) AND value >= 20")
def f_and(spark, sf):
    return compiled(spark, sf, {"and": {"filters": [
        {"term": {"event_type": "click"}}, {"terms": {"user_id": [1, 2, 3]}}, {"range": {"value": {"gte": 20}}},
    ], "_cache": True}})


@query("f_not", """
SELECT event_id, user_id, nullif(event_type, 'view') AS event_type FROM events
WHERE NOT coalesce(nullif(event_type, 'view') = 'click', false)""")
def f_not(spark, sf):
    """A document lacking the field is kept."""
    df = table(spark, sf, "events").withColumn("event_type", F.nullif("event_type", F.lit("view")))
    body = {"not": {"term": {"event_type": "click"}}}
    return df.where(filters.compile_filter(body, df.schema)).select("event_id", "user_id", "event_type")


@query("f_const", f"{ROWS} WHERE user_id = 17")
def f_const(spark, sf):
    return compiled(spark, sf, {"constant_score": {"filter": {"term": {"user_id": 17}}}})


@query("backup_dsl", f"{ROWS} WHERE event_type IN ('click', 'error') AND value BETWEEN 5 AND 60")
def backup_dsl(spark, sf):
    """Filters by method name."""
    spec = {"terms": ["event_type", ["click", "error"]], "range": {"value": {"from": 5, "to": 60}}, "all": []}
    return kept(spark, sf, lambda schema: filters.backup_filter(spec, schema))


@query("word_filter", """
WITH lines AS (SELECT DISTINCT unnest(string_split(regexp_replace(text, '\\s+', ' ', 'g'), ' ')) AS word FROM documents),
     numbered AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS line FROM lines WHERE word <> '')
SELECT word FROM numbered WHERE line >= 200 AND NOT regexp_matches(word, '\\W') ORDER BY line LIMIT 500""")
def words(spark, sf):
    """Words of a list after an offset, without those holding other characters."""
    parts = F.split(F.regexp_replace("text", "\\s+", " "), " ")
    listed = table(spark, sf, "documents").select(F.explode(parts).alias("word")).where("word <> ''").distinct()
    return word_filter(listed, "word", ["word"], 200, 500)


def documents_with(spark, sf, text):
    df = table(spark, sf, "documents")
    return df.where(filters.query_string(text, [F.col("text")], lambda name: F.col(name))).select("doc_id", "n_chars")


def has(word):
    return f"list_contains({TEXT_WORDS}, '{word}')"


@query("q_boolean", f"""
SELECT doc_id, n_chars FROM documents
WHERE {has('the')} AND {has('of')} AND NOT {has('from')} AND list_contains(regexp_split_to_array(lower(lang), '[^a-z]+'), 'en')""")
def q_boolean(spark, sf):
    """Required and forbidden words, and a field's clause among them."""
    return documents_with(spark, sf, "the AND of NOT from +lang:en")


@query("q_phrase", r"""
SELECT doc_id, n_chars FROM documents
WHERE regexp_matches(lower(text), '(^|[^\p{L}\p{N}])of[^\p{L}\p{N}]+the([^\p{L}\p{N}]|$)')""")
def q_phrase(spark, sf):
    return documents_with(spark, sf, '"of the"')


@query("q_prefix", r"""
SELECT doc_id, n_chars FROM documents WHERE regexp_matches(lower(text), '(^|[^\p{L}\p{N}])worth')""")
def q_prefix(spark, sf):
    return documents_with(spark, sf, "wort* +worth*")


@query("f_terms_long", f"{ROWS} WHERE event_id % 3 = 0 AND event_id < 60000")
def f_terms_long(spark, sf):
    """A list of many thousand values, compiled like a short one."""
    return compiled(spark, sf, {"terms": {"event_id": list(range(0, 60000, 3))}})


@query("f_or", f"{ROWS} WHERE event_type = 'click' OR value > 100")
def f_or(spark, sf):
    return compiled(spark, sf, {"or": [{"term": {"event_type": {"value": "click"}}}, {"range": {"value": {"gt": 100}}}]})


@query("f_bool", f"""
{ROWS} WHERE value > 5 AND event_type <> 'error' AND (CAST(event_type = 'click' AS INT) + CAST(user_id < 50 AS INT) + CAST(value < 80 AS INT)) >= 2""")
def f_bool(spark, sf):
    return compiled(spark, sf, {"bool": {
        "must": {"range": {"value": {"gt": 5}}}, "must_not": [{"term": {"event_type": "error"}}],
        "should": [{"term": {"event_type": "click"}}, {"range": {"user_id": {"lt": 50}}}, {"range": {"value": {"lt": 80}}}],
        "minimum_should_match": 2}})


@query("f_exists", """
SELECT event_id, user_id, nullif(event_type, 'view') AS event_type, value FROM events
WHERE event_type <> 'view' OR (event_type = 'view' AND user_id = 3)""")
def f_exists(spark, sf):
    """Presence and absence of a field."""
    df = table(spark, sf, "events").withColumn("event_type", F.nullif("event_type", F.lit("view")))
    body = {"or": [{"exists": {"field": "event_type"}}, {"and": [{"missing": {"field": "event_type"}}, {"term": {"user_id": 3}}]}]}
    return df.where(filters.compile_filter(body, df.schema)).select(*COLUMNS)


@query("f_prefix", f"{ROWS} WHERE starts_with(event_type, 'c') AND user_id < 100")
def f_prefix(spark, sf):
    return compiled(spark, sf, {"filtered": {"query": {"prefix": {"event_type": "c"}}, "filter": {"range": {"user_id": {"lt": 100}}}}})


@query("q_match_all_words", f"SELECT doc_id, n_chars FROM documents WHERE {has('the')} AND {has('from')}")
def q_match_all_words(spark, sf):
    df = table(spark, sf, "documents")
    body = {"query": {"match": {"text": {"query": "the, FROM!", "operator": "and"}}}, "size": 0}
    return search(df, body).matching.select("doc_id", "n_chars")
