"""Counts and cardinalities over documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docindex.functions.text import WORD_BREAK


def doc_counts(docs: DataFrame) -> DataFrame:
    """Documents per index."""
    return docs.groupBy("_index").agg(F.count("*").alias("docs"))


def cardinality(df: DataFrame, fields: list[str], approximate: bool = False) -> DataFrame:
    """Distinct printed values per field: (field, values).

    A missing value prints an empty line, so it counts as one value, the same
    one as the empty text. Exact: distinct (field, value) pairs, then a count
    per field, so no task holds all values of a field.
    """
    printed = {f: F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields}
    if approximate:
        row = df.agg(*[F.approx_count_distinct(v).alias(f) for f, v in printed.items()])
        return row.unpivot([], fields, "field", "values")
    pairs = df.select(*[v.alias(f) for f, v in printed.items()]).unpivot([], fields, "field", "value")
    distinct = pairs.distinct()
    return distinct.groupBy("field").agg(F.count("*").alias("values"))


def value_counts(docs: DataFrame, source: str | Column = "_source") -> DataFrame:
    """How often each value of each member occurs: (field, value, count)."""
    pairs = docs.select(F.explode(F.from_json(source, "map<string,string>")).alias("field", "value"))
    return pairs.groupBy("field", "value").agg(F.count("*").alias("count"))


def field_cardinality(docs: DataFrame, source: str | Column = "_source") -> DataFrame:
    """Number of distinct values of each member: (field, values)."""
    return value_counts(docs, source).groupBy("field").agg(F.count("*").alias("values"))


def term_hits(docs: DataFrame, text: str, words: DataFrame, per: str | None = None) -> DataFrame:
    """For each word of a list, the number of documents that hold it: (word, hits).

    ``per`` counts per index as well; words without hits appear with 0 only in
    the plain form. Only listed words are counted; a common one is counted in
    every task first.
    """
    word = words.columns[0]
    listed = words.select(F.lower(F.col(word)).alias("word")).distinct()
    group = [per] if per else []
    words_of = F.array_distinct(F.split(F.lower(F.col(text)), WORD_BREAK))
    found = docs.select(*group, F.explode(words_of).alias("word")).where("word <> ''").join(listed, "word", "left_semi")
    counts = found.groupBy(*group, "word").agg(F.count("*").alias("hits"))
    if per:
        return counts.select(per, "word", "hits")
    return listed.join(counts, "word", "left").select("word", F.coalesce("hits", F.lit(0).cast("long")).alias("hits"))
