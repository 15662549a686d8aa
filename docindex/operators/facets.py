"""Facets: aggregations over the hits of a query.

Every facet is one grouped aggregation. Spark aggregates in each task before it
shuffles, so one key that holds most of the rows sends one row per task.
A facet's own filter (``where``) restricts only that facet.
"""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from docindex.functions.times import bucket_start
from docindex.operators.filters import compile_filter
from docindex.operators.selection import SHALLOW_GROUP, Order, ranks

DEFAULT_SIZE = 10
# Keys aggregated in one pass: a grouping id has 64 bits.
KEYS_PER_PASS = 32
# More filtered facets than this are matched row by row instead of expanded.
FEW_FILTERED = 4

# Term under which a statistical facet is listed in a request's answer.
WHOLE = "all"

STATS = ("count", "total_count", "total", "min", "max", "mean")


def _column(field: str | Column) -> Column:
    return F.col(field) if isinstance(field, str) else field


def _kept(df: DataFrame, where: Column | None) -> DataFrame:
    return df if where is None else df.where(where)


def _with_key(df: DataFrame, key: str | Column, *others: Column) -> DataFrame:
    """The key as column ``term``; a list counts once per distinct value."""
    keyed = df.select(_column(key).alias("term"), *others)
    if isinstance(keyed.schema["term"].dataType, T.ArrayType):
        rest = keyed.columns[1:]
        keyed = keyed.select(F.explode(F.array_distinct("term")).alias("term"), *rest)
    return keyed


def _stats(value: Column, row: str = "*") -> list[Column]:
    return [
        F.count(row).alias("count"), F.count(value).alias("total_count"), F.sum(value).alias("total"),
        F.min(value).alias("min"), F.max(value).alias("max"), _mean(value).alias("mean"),
    ]


def _mean(value: Column) -> Column:
    """From the sum and the count that a facet keeps anyway."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def _spread(value: Column) -> list[Column]:
    variance = F.var_pop(value)
    squares = F.sum(value.cast("double") * value.cast("double"))
    return [squares.alias("sum_of_squares"), variance.alias("variance"), F.sqrt(variance).alias("std_deviation")]


def _ranked(df: DataFrame, order: str, size: int | None) -> DataFrame:
    """The first ``size`` rows."""
    return df if size is None else ranks(df, _order(order), size)


def _order(order: str) -> Order:
    name = _checked_order(order, STATS).removeprefix("reverse_")
    falls = (name == "term") == order.startswith("reverse_")
    return [(name, falls)] if name == "term" else [(name, falls), ("term", False)]


def _checked_order(order: str, numbers: tuple[str, ...]) -> str:
    if order.removeprefix("reverse_") not in ("term", *numbers):
        raise ValueError(f"order must be 'term' or one of {numbers}, or one of them after 'reverse_', not {order!r}")
    return order


# -- one facet ---------------------------------------------------------------

def statistical(df: DataFrame, field: str | Column, where: Column | None = None) -> DataFrame:
    """One row about a number: count, total, min, max, mean, squares, spread."""
    v = _column(field) if where is None else F.when(where, _column(field))
    return df.agg(
        F.count(v).alias("count"), F.sum(v).alias("total"), F.min(v).alias("min"), F.max(v).alias("max"),
        _mean(v).alias("mean"), *_spread(v),
    )


def terms(
    df: DataFrame,
    field: str | Column,
    size: int | None = DEFAULT_SIZE,
    where: Column | None = None,
    all_terms: bool = False,
) -> DataFrame:
    """Values by number of documents: (term, count).

    With ``all_terms`` every value of ``df`` is returned, also those that no
    document matching ``where`` has (count 0), and there is no cut.
    """
    if all_terms:
        matched = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
        keyed = _with_key(df, field, matched.alias("_matched"))
        return keyed.where(F.col("term").isNotNull()).groupBy("term").agg(F.count_if("_matched").alias("count"))
    keyed = _with_key(_kept(df, where), field).where(F.col("term").isNotNull())
    return _ranked(keyed.groupBy("term").agg(F.count("*").alias("count")), "count", size)


def terms_totals(
    df: DataFrame, field: str, size: int = DEFAULT_SIZE, where: Column | None = None
) -> DataFrame:
    """One row beside a terms facet: documents without a value (missing), with
    one (total), and with a value that the cut left out (other)."""
    counts = _kept(df, where).groupBy(F.col(field).alias("term")).agg(F.count("*").alias("count"))
    present = F.col("term").isNotNull()
    # Nulls rank last instead of being filtered, so both uses share one aggregation.
    first = counts.orderBy(F.desc(present), F.desc("count"), F.asc("term")).limit(size)
    shown = first.agg(F.sum(F.when(present, F.col("count"))).alias("n")).scalar()
    sums = counts.agg(
        F.coalesce(F.sum(F.when(~present, F.col("count"))), F.lit(0)).alias("missing"),
        F.coalesce(F.sum(F.when(present, F.col("count"))), F.lit(0)).alias("total"),
    )
    return sums.select("missing", "total", (F.col("total") - F.coalesce(shown, F.lit(0))).alias("other"))


def pooled(fields: list[str]) -> Column:
    """The values of several fields as one list of texts, null where a value repeats."""
    texts = [F.col(f).cast("string") for f in dict.fromkeys(fields)]
    once = [texts[0]]
    for i, text in enumerate(texts[1:], 1):
        seen = reduce(lambda a, b: a | b, [F.coalesce(text == t, F.lit(False)) for t in texts[:i]])
        once.append(F.when(~seen, text))
    return F.array(*once)


def terms_multi(
    df: DataFrame, fields: list[str], size: int | None = DEFAULT_SIZE, where: Column | None = None
) -> DataFrame:
    """Values of several fields in one histogram; a document counts once per distinct value."""
    pool = _kept(df, where).select(F.explode(pooled(fields)).alias("term"))
    return terms(pool, "term", size)


def term_total(facet: DataFrame) -> DataFrame:
    """Number of distinct terms in a facet's answer."""
    return facet.agg(F.count("*").alias("terms"))


def terms_stats(
    df: DataFrame,
    key: str | Column,
    value: str | Column,
    size: int | None = DEFAULT_SIZE,
    order: str = "count",
    where: Column | None = None,
    all_terms: bool = False,
) -> DataFrame:
    """Statistics of a value per key: (term, count, total_count, total, min, max, mean)."""
    keyed = _with_key(_kept(df, where), key, _column(value).alias("_value")).where(F.col("term").isNotNull())
    return _ranked(keyed.groupBy("term").agg(*_stats(F.col("_value"))), order, None if all_terms else size)


def date_histogram(
    df: DataFrame,
    field: str,
    interval: str,
    value: str | Column | None = None,
    zone: str | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Documents per interval, with the value's statistics when one is given."""
    bucket = bucket_start(F.col(field), interval, zone).alias("term")
    stats = [F.count("*").alias("count")] if value is None else _stats(_column(value))
    kept = _kept(df, where).where(F.col(field).isNotNull())
    return kept.groupBy(bucket).agg(*stats)


def top_per_key(
    df: DataFrame, keys: list[str], field: str, size: int = 1, wanted: DataFrame | None = None
) -> DataFrame:
    """The most frequent values of a field for every key combination.

    Counts come first, so the ranking sees one row per key and value. ``wanted``
    restricts the keys to those of a table.
    """
    counts = df.where(F.col(field).isNotNull()).groupBy(*keys, F.col(field).alias("term")).agg(
        F.count("*").alias("count"))
    if wanted is not None:
        counts = counts.join(wanted.select(*keys).distinct(), keys, "left_semi")
    if size == 1:
        best = F.min(F.struct((-F.col("count")).alias("n"), "term")).alias("_best")
        return counts.groupBy(*keys).agg(best).select(
            *keys, F.col("_best.term").alias("term"), (-F.col("_best.n")).alias("count"))
    return ranks(counts, [("count", True), ("term", False)], size, within=keys)


# -- many facets in one request ----------------------------------------------

def facet_request(df: DataFrame, facets: dict[str, dict]) -> DataFrame:
    """All facets of a request as one long table.

    Columns: facet, term (text), count, total_count, total, min, max, mean,
    sum_of_squares, variance, std_deviation; what a facet does not compute is
    null. Facets on the same value field share one pass over the hits, and
    facets that ask the same thing are computed once.
    """
    asked: dict[str, list[str]] = {}
    for name, spec in facets.items():
        asked.setdefault(json.dumps(spec, sort_keys=True), []).append(name)
    same = {names[0]: names for names in asked.values()}
    answer = _distinct_facets(df, {name: facets[name] for name in same})
    if len(same) == len(facets):
        return answer
    pairs = [x for first, names in same.items() for x in (F.lit(first), F.array(*map(F.lit, names)))]
    return answer.withColumn("facet", F.explode(F.element_at(F.create_map(*pairs), F.col("facet"))))


def _distinct_facets(df: DataFrame, facets: dict[str, dict]) -> DataFrame:
    plans = [_Facet(name, spec, df.schema) for name, spec in facets.items()]
    single = [p for p in plans if not p.pooled and not p.every]
    filtered = [p for p in single if p.where is not None]
    if len(filtered) <= FEW_FILTERED:
        filtered = []
    parts = []
    for value, group in _by_value([p for p in single if p not in filtered]).items():
        for i in range(0, len(group), KEYS_PER_PASS):
            parts.append(_expanded(df, value, group[i:i + KEYS_PER_PASS]))
    for value, group in _by_value(filtered).items():
        parts.append(_matched(df, value, group))
    for p in plans:
        if p.every:
            # Also terms that only rows outside the facet's filter have: they are counted as 0.
            counts = terms(df, pooled(p.fields) if p.fields else p.key, None, p.where, all_terms=True)
            parts.append(_long(counts.select(F.lit(p.name).alias("facet"), F.col("term").cast("string"), "count")))
        elif p.pooled:
            counts = terms_multi(df, p.fields, None, p.where) if p.fields else terms(df, p.key, None, p.where)
            parts.append(_long(counts.select(F.lit(p.name).alias("facet"), F.col("term").cast("string"), "count")))
    answer = reduce(DataFrame.unionByName, [_number_types(p, parts) for p in parts])
    return _cut(answer, plans)


LONG_NUMBERS = ("count", "total_count")
VALUE_NUMBERS = ("total", "min", "max", "mean", "sum_of_squares", "variance", "std_deviation")


class _Facet:
    """One facet of a request: its key, value field, filter and cut."""

    def __init__(self, name: str, spec: dict, schema: T.StructType):
        kinds = set(spec) - {"facet_filter"}
        if len(kinds) != 1:
            raise ValueError(f"facet {name!r} needs exactly one kind")
        self.name, self.kind = name, kinds.pop()
        arg = spec[self.kind]
        self.where = compile_filter(spec["facet_filter"], schema) if "facet_filter" in spec else None
        self.value = arg.get("value_field")
        self.pooled, self.fields, self.key = False, None, None
        self.order = _checked_order(arg.get("order", "count"), STATS if self.kind == "terms_stats" else ("count",))
        self.every = self.kind == "terms" and bool(arg.get("all_terms")) and self.where is not None
        self.size: int | None = None if arg.get("all_terms") else arg.get("size", DEFAULT_SIZE)
        if self.kind == "terms":
            if "fields" in arg:
                self.fields, self.pooled = arg["fields"], True
            else:
                self.key = _script(arg["script_field"]) if "script_field" in arg else F.col(arg["field"])
                self.pooled = "field" in arg and isinstance(schema[arg["field"]].dataType, T.ArrayType)
        elif self.kind == "terms_stats":
            self.key = F.col(arg["key_field"])
        elif self.kind == "date_histogram":
            self.key = bucket_start(
                F.col(arg.get("key_field") or arg["field"]), arg["interval"], arg.get("time_zone"))
            self.size = None
        elif self.kind == "statistical":
            self.key, self.value, self.size = F.lit(WHOLE), arg["field"], None
        else:
            raise ValueError(f"unsupported facet {self.kind!r}")


# A piece of a concatenation: a quoted text or a field, with or without its container.
PIECE = re.compile(r"""\s*(?:'((?:[^'\\]|\\.)*)'|"((?:[^"\\]|\\.)*)"|(?:_source\.)?([^\W\d][\w.]*)|doc\[['"]([^'"]+)['"]\]\.value)\s*(\+|$)""")


def _script(expression: str) -> Column:
    """A concatenation of fields and quoted texts, e.g. ``_source.a + '|' + _source.b``."""
    parts, at, more = [], 0, True
    while more:
        m = PIECE.match(expression, at)
        if m is None:
            raise ValueError(f"unsupported script {expression!r}")
        single, double, *names = m.groups()[:4]
        text = single if single is not None else double
        if text is not None:
            parts.append(F.lit(re.sub(r"\\(.)", r"\1", text)))
        else:
            parts.append(F.coalesce(F.col(names[0] or names[1]).cast("string"), F.lit("null")))
        at, more = m.end(), m[5] == "+"
    return F.concat(*parts)


def facet_totals(df: DataFrame, facets: dict[str, dict]) -> DataFrame:
    """Beside the terms facets of a request: facet, missing, total, other.

    Documents without a value, values counted (a list's distinct ones each), and
    those of terms that the cut left out. All facets share one pass.
    """
    plans = [_Facet(name, spec, df.schema) for name, spec in facets.items() if "terms" in spec]
    if not plans:
        return df.sparkSession.createDataFrame([], "facet string, missing long, total long, other long")
    counts = []
    for p in plans:
        values = pooled(p.fields) if p.fields else p.key
        many = p.fields is not None or p.pooled
        n = F.size(F.array_distinct(F.array_compact(values))) if many else F.lit(1)
        n = F.when(F.coalesce(p.where, F.lit(False)) if p.where is not None else F.lit(True), F.when(values.isNull(), 0).otherwise(n))
        counts.append(F.struct(
            F.lit(p.name).alias("facet"), F.count_if(n == 0).alias("missing"), F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("total")
        ))
    totals = df.agg(F.array(*counts).alias("all")).select(F.inline("all"))
    shown = facet_request(df, {p.name: facets[p.name] for p in plans}).groupBy("facet").agg(F.sum("count").alias("_shown"))
    return totals.join(shown, "facet", "left").select("facet", "missing", "total", (F.col("total") - F.coalesce("_shown", F.lit(0))).alias("other"))


def _by_value(plans: list[_Facet]) -> dict[str | None, list[_Facet]]:
    """Facets that can share a pass; those without a value field join any other."""
    groups: dict[str | None, list[_Facet]] = {}
    for p in plans:
        groups.setdefault(p.value, []).append(p)
    if None in groups and len(groups) > 1:
        shared = next(v for v in groups if v is not None)
        groups[shared] += groups.pop(None)
    return groups


def _value(field: str | None) -> Column:
    return (F.lit(None).cast("double") if field is None else F.col(field)).alias("_value")


def _expanded(df: DataFrame, value: str | None, group: list[_Facet]) -> DataFrame:
    """Facets as grouping sets: one scan, one shuffle of partial aggregates."""
    keys = [f"_k{i}" for i in range(len(group))]
    filtered = [p.key if p.where is None else F.when(p.where, p.key) for p in group]
    rows = df.select(*[k.alias(n) for k, n in zip(filtered, keys)], _value(value), F.lit(1).alias("_row"))
    rows = rows.where(_any([F.col(k).isNotNull() for k in keys]))
    if any(p.kind == "statistical" for p in group):
        always = {k for k, p in zip(keys, group) if p.kind == "statistical"}
        rows = rows.unionByName(_blank(rows, {k: F.lit(WHOLE) for k in always}))
    grouped = rows.groupingSets([[k] for k in keys], *keys).agg(F.grouping_id().alias("_set"), *_numbers(group))
    full = (1 << len(keys)) - 1
    here = [F.col("_set") == F.lit(full - (1 << (len(keys) - 1 - i))).cast("long") for i in range(len(keys))]
    grouped = grouped.where(_any([h & F.col(k).isNotNull() for h, k in zip(here, keys)]))
    facet, term = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, k, p in zip(here, keys, group):
        facet = F.when(h, F.lit(p.name)).otherwise(facet)
        term = F.when(h, F.col(k).cast("string")).otherwise(term)
    return _named(grouped.withColumn("facet", facet).withColumn("term", term), group)


def _matched(df: DataFrame, value: str | None, group: list[_Facet]) -> DataFrame:
    """Many filtered facets: each row joins only those whose filter it passes."""
    pairs = [
        F.when(p.where & p.key.isNotNull(), F.struct(F.lit(p.name).alias("facet"), p.key.cast("string").alias("term")))
        for p in group
    ]
    rows = df.where(_any([p.where for p in group])).select(
        F.explode(F.array_compact(F.array(*pairs))).alias("_pair"), _value(value), F.lit(1).alias("_row"))
    rows = rows.select("_pair.facet", "_pair.term", "_value", "_row")
    always = [F.lit(p.name) for p in group if p.kind == "statistical"]
    if always:
        rows = rows.unionByName(_blank(rows, {"facet": F.explode(F.array(*always)), "term": F.lit(WHOLE)}))
    return _named(rows.groupBy("facet", "term").agg(*_numbers(group)), group)


def _blank(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    """One row that counts for nothing: statistics of no hits are still an answer."""
    return rows.sparkSession.range(0, 1, 1, 1).select(
        *[values.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in rows.schema.fields])


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def _numbers(group: list[_Facet]) -> list[Column]:
    v = F.col("_value")
    return [*_stats(v, "_row"), *(_spread(v) if any(p.kind == "statistical" for p in group) else [])]


def _named(grouped: DataFrame, group: list[_Facet]) -> DataFrame:
    """Only the numbers that each facet asks for."""
    has_value = F.col("facet").isin([p.name for p in group if p.value is not None])
    spread = [c for c in VALUE_NUMBERS[4:] if c in grouped.columns]
    has_spread = F.col("facet").isin([p.name for p in group if p.kind == "statistical"])
    return _long(grouped.select(
        "facet", "term", "count",
        *[F.when(has_value, F.col(c)).alias(c) for c in STATS[1:]],
        *[F.when(has_spread, F.col(c)).alias(c) for c in spread],
    ))


def _long(df: DataFrame) -> DataFrame:
    missing = [c for c in (*LONG_NUMBERS, *VALUE_NUMBERS) if c not in df.columns]
    return df.select(
        "facet", "term", *[
            F.lit(None).cast("long" if c in LONG_NUMBERS else "double").alias(c) if c in missing else F.col(c)
            for c in (*LONG_NUMBERS, *VALUE_NUMBERS)
        ])


def _number_types(part: DataFrame, parts: list[DataFrame]) -> DataFrame:
    """One type per number over all parts; exact when all parts are exact."""
    if len(parts) == 1:
        return part
    return part.select("facet", "term", *LONG_NUMBERS, *[F.col(c).cast("double").alias(c) for c in VALUE_NUMBERS])


def _cut(answer: DataFrame, plans: list[_Facet]) -> DataFrame:
    """Keep each facet's first ``size`` terms in its order.

    Small cuts are one ranking, in which each task first keeps its own best rows per
    facet. Facets with a large cut are selected by buckets, one after the other; those without keep every row.
    """
    name = F.col("facet")
    parts = []
    small = [p for p in plans if p.size is not None and p.size <= SHALLOW_GROUP]
    large = [p for p in plans if p.size is not None and p.size > SHALLOW_GROUP]
    free = [p.name for p in plans if p.size is None]
    if free:
        parts.append(answer if len(free) == len(plans) else answer.where(name.isin(free)))
    if small:
        by = []
        for order in sorted({p.order for p in small} - {"term"}):
            own = F.when(name.isin([p.name for p in small if p.order == order]), F.col(order.removeprefix("reverse_")))
            falls = (order == "reverse_term") or not order.startswith("reverse_")
            by.append(F.desc(own) if falls else F.asc(own))
        rank = F.row_number().over(Window.partitionBy("facet").orderBy(*by, F.asc("term")))
        limit = reduce(lambda rest, p: F.when(name == p.name, F.lit(p.size)).otherwise(rest), small, F.lit(1))
        some = answer if len(small) == len(plans) else answer.where(name.isin([p.name for p in small]))
        ranked = some.withColumn("_rank", rank).where(F.col("_rank") <= max(p.size for p in small))
        parts.append(ranked.where(F.col("_rank") <= limit).drop("_rank"))
    for p in large:
        parts.append(ranks(answer.where(name == p.name), _order(p.order), p.size))
    return reduce(DataFrame.unionByName, parts)
