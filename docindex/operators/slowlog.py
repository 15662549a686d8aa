"""Slow-query logs: parsing, reports, workload profile and replay."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from docindex.functions.records import fragment, is_document, members
from docindex.operators.facets import LONG_NUMBERS, VALUE_NUMBERS, facet_request
from docindex.operators.filters import compile_filter
from docindex.workspace import work_dir

# The parts of a log line.
HEADER = r"^\[([^\]]*)\]\[([^\]]*)\]\[[^\]]*\]\s*\[([^\]]*)\]\s*\[([^\]]*)\]\[([^\]]*)\]"
SOURCE = r", source\[(.*)\], extra_source"
EXTRA = r", extra_source\[(.*)\]"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss,SSS"
COMPARABLE = "QUERY_THEN_FETCH"

# Requests evaluated in one pass over an index when replaying.
REPLAY_PASS = 32


def parse(lines: DataFrame, line: str = "value") -> DataFrame:
    """Fields of slow-log lines; what a line lacks is null.

    A line without a query keeps its text in ``line`` and is for ``rejected``.
    """
    text = F.col(line)

    def part(pattern: str, group: int = 1) -> Column:
        return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))

    def meta(name: str) -> Column:
        return part(rf"[ ,]{name}\[([^\]]*)\]")

    stamp = F.try_to_timestamp(part(HEADER, 1), F.lit(TIME_FORMAT)).cast("timestamp_ntz")
    return lines.select(
        text.alias("line"), stamp.alias("ts"), F.trim(part(HEADER, 2)).alias("level"),
        part(HEADER, 3).alias("node"), part(HEADER, 4).alias("index"),
        part(HEADER, 5).try_cast("int").alias("shard"),
        meta("took").alias("took"), meta("took_millis").try_cast("long").alias("took_millis"),
        meta("types").alias("types"), meta("search_type").alias("search_type"),
        meta("total_shards").try_cast("int").alias("total_shards"),
        part(SOURCE).alias("query"), part(EXTRA).alias("extra_source"),
    )


def usable(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("query").isNotNull()).drop("line")


def rejected(parsed: DataFrame) -> DataFrame:
    """Lines whose query could not be read, with the reason."""
    bad = parsed.where(F.col("query").isNull())
    return bad.select("line", F.lit("no query in line").alias("reason"))


def classify(parsed: DataFrame) -> DataFrame:
    """Add ``status``: ``ok``, ``malformed`` or ``other search type``.

    Only requests of the comparable search type can be run again; a request
    that is no JSON document cannot be run at all.
    """
    readable = is_document(members(F.col("query")))
    comparable = F.coalesce(F.col("search_type") == COMPARABLE, F.lit(False))
    status = F.when(~readable, "malformed").when(comparable, "ok").otherwise("other search type")
    return parsed.withColumn("status", status)


def report(parsed: DataFrame) -> DataFrame:
    """One line per logged query, with the start of its text."""
    return parsed.select(
        F.col("ts").alias("original_timestamp"), F.col("took").alias("es_duration"),
        "node", "index", fragment(F.col("query")).alias("query_fragment"))


def total_minutes(parsed: DataFrame) -> DataFrame:
    """All logged time, in minutes."""
    return parsed.agg((F.sum("took_millis") / 60000).alias("minutes"))


def profile(parsed: DataFrame, percentiles: list[float] | None = None) -> DataFrame:
    """Logged time per index and query shape (numbers in the query become ``#``)."""
    aggs = [
        F.count("*").alias("queries"), F.sum("took_millis").alias("total_millis"),
        F.max("took_millis").alias("max_millis"),
    ]
    if percentiles:
        aggs.append(F.percentile_approx("took_millis", percentiles).alias("percentiles"))
    shape = F.regexp_replace("query", "[0-9]+", "#").alias("shape")
    return parsed.groupBy("index", shape).agg(*aggs)


def replay(parsed: DataFrame, open_index: Callable[[str], DataFrame]) -> DataFrame:
    """Run every distinct logged request again, as a search on an index table.

    Returns (index, query, logged, logged_millis, hits, reason): how often and how long
    the request ran in the log beside the number of documents it finds now. A request
    that cannot be run on the index, as for an unknown field, has a reason instead.
    Requests come to the driver a few at a time; those on one index are counted
    together in one pass over it, and each pass adds to a table.
    """

    def hits(docs: DataFrame, bodies: list[str]) -> DataFrame:
        tests = [compile_filter(_query(json.loads(b)), docs.schema) for b in bodies]
        counts = docs.agg(F.array(*[F.count_if(t) for t in tests]).alias("hits"))
        rows = F.arrays_zip(F.array(*[F.lit(b) for b in bodies]).alias("query"), F.col("hits"))
        return counts.select(F.inline(rows).alias("query", "hits"))

    def check(docs: DataFrame, body: dict) -> None:
        docs.where(compile_filter(_query(body), docs.schema))

    return _replayed(parsed, open_index, check, hits, "query string, hits long")


def replay_facets(parsed: DataFrame, open_index: Callable[[str], DataFrame]) -> DataFrame:
    """The facets of every distinct logged request, beside how long it ran in the log.

    One row per facet term, or one with a reason for a request that cannot be run. The
    requests of a pass become filtered facets of one request, so they too share a scan.
    """

    def facets(docs: DataFrame, bodies: list[str]) -> DataFrame:
        asked, names = {}, []
        for i, body in enumerate(map(json.loads, bodies)):
            for name, spec in body.get("facets", {}).items():
                own = [spec["facet_filter"]] if "facet_filter" in spec else []
                asked[f"{i}|{name}"] = {**spec, "facet_filter": {"and": [_query(body), *own]}}
                names += [F.lit(f"{i}|{name}"), F.struct(F.lit(bodies[i]).alias("query"), F.lit(name).alias("facet"))]
        if not asked:
            return docs.sparkSession.createDataFrame([], schema)
        answer = facet_request(docs, asked).withColumn("_asked", F.element_at(F.create_map(*names), F.col("facet")))
        numbers = [F.col(c).cast("double").alias(c) for c in VALUE_NUMBERS]
        return answer.select("_asked.query", "_asked.facet", "term", *LONG_NUMBERS, *numbers)

    schema = "query string, facet string, term string, " + ", ".join(
        [f"{c} long" for c in LONG_NUMBERS] + [f"{c} double" for c in VALUE_NUMBERS])
    def check(docs: DataFrame, body: dict) -> None:
        found = docs.where(compile_filter(_query(body), docs.schema))
        if body.get("facets"):
            facet_request(found, body["facets"])

    return _replayed(parsed, open_index, check, facets, schema)


def _query(body: dict) -> dict:
    return body.get("query", {"match_all": {}})


def _replayed(
    parsed: DataFrame,
    open_index: Callable[[str], DataFrame],
    check: Callable[[DataFrame, dict], None],
    answer: Callable[[DataFrame, list[str]], DataFrame],
    schema: str,
) -> DataFrame:
    """Answers of all comparable requests, pass by pass, joined to their log figures."""
    spark = parsed.sparkSession
    logged = classify(parsed).where("status = 'ok'").groupBy("index", "query").agg(
        F.count("*").alias("logged"), F.sum("took_millis").alias("logged_millis"))
    path, refused = work_dir(spark, "replay"), work_dir(spark, "replay-refused")
    schema, reasons = "index string, " + schema, "index string, query string, reason string"
    spark.createDataFrame([], schema).write.parquet(path)
    spark.createDataFrame([], reasons).write.parquet(refused)
    for index, bodies in _passes(logged.select("index", "query").orderBy("index", "query")):
        docs, good, bad = open_index(index), [], []
        for body in bodies:
            try:
                check(docs, json.loads(body))
                good.append(body)
            except (ValueError, LookupError, TypeError, AttributeError, AnalysisException) as fault:
                bad.append((index, body, str(fault).splitlines()[0]))
        if bad:
            spark.createDataFrame(bad, reasons).write.mode("append").parquet(refused)
        if good:
            rows = answer(docs, good)
            rows.select(F.lit(index).alias("index"), "*").write.mode("append").parquet(path)
    answers = spark.read.schema(schema).parquet(path).withColumn("reason", F.lit(None).cast("string"))
    answers = answers.unionByName(spark.read.schema(reasons).parquet(refused), allowMissingColumns=True)
    found = [c for c in answers.columns if c not in ("index", "query")]
    return logged.join(answers, ["index", "query"]).select("index", "query", "logged", "logged_millis", *found)


def _passes(requests: DataFrame) -> Iterator[tuple[str, list[str]]]:
    """Requests in groups that share an index, at most REPLAY_PASS each."""
    rows = requests.toLocalIterator()
    index, bodies = None, []
    for row in rows:
        if bodies and (row["index"] != index or len(bodies) == REPLAY_PASS):
            yield index, bodies
            bodies = []
        index = row["index"]
        bodies.append(row["query"])
    if bodies:
        yield index, bodies
