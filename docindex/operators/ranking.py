"""Ranked hits of a free-text query (BM25, Robertson and Zaragoza 2009)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docindex.functions.text import query_words, tokens

# The usual BM25 parameters.
K1 = 1.2
B = 0.75


def _occurrences(words: Column, word: str) -> Column:
    return F.size(F.filter(words, lambda w: w == F.lit(word)))


def ranked_hits(df: DataFrame, doc_id: str, text: str, query: str, size: int = 10) -> DataFrame:
    """The best documents for any of the query's words: (doc_id, _score).

    The collection's figures (documents, mean length, documents per word) are one
    aggregated row that the plan reads as a value; nothing is written, and only a
    top-k of the documents with a hit moves between tasks.
    """
    words = query_words(query)
    # Each text is split once: its words are the one element that the lambda sees, and the optimizer cannot copy what is exploded.
    counts = F.transform(F.array(tokens(F.col(text))), lambda w: F.struct(
        F.size(w).alias("_length"), *[_occurrences(w, x).alias(f"_tf{i}") for i, x in enumerate(words)]))
    counted = df.select(F.col(doc_id), F.explode(counts).alias("c")).select(doc_id, "c.*")
    figures = counted.agg(F.struct(
        F.count("*").alias("docs"), F.avg("_length").alias("mean_length"),
        *[F.count_if(F.col(f"_tf{i}") > 0).alias(f"df{i}") for i in range(len(words))],
    ).alias("figures")).scalar()
    total, found = F.lit(0.0), F.lit(False)
    for i in range(len(words)):
        tf, having = F.col(f"_tf{i}"), figures[f"df{i}"]
        idf = F.log(1 + (figures["docs"] - having + 0.5) / (having + 0.5))
        length = (1 - B) + B * F.col("_length") / figures["mean_length"]
        total = total + F.when(tf > 0, idf * tf * (K1 + 1) / (tf + K1 * length)).otherwise(F.lit(0.0))
        found = found | (tf > 0)
    hits = counted.where(found).select(doc_id, total.alias("_score"))
    return hits.orderBy(F.desc("_score"), F.asc(doc_id)).limit(size)
