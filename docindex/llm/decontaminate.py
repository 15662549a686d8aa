"""Benchmark decontamination by winnowing, in DataFrame functions only.

Fingerprints are hashes of six consecutive words; of every eight in a row the least
is kept. A span of thirteen words holds eight such hashes, so every shared window
shares a kept one, wherever it stands: no window is missed. Items of fewer than
thirteen words are one window, compared by hashes of exactly their length.

The kept hashes of test items meet those of the documents in a join whose
small side is broadcast only after its rows were counted. Documents with a hit, few as
a rule, are then extended exactly: their windows are compared as text with the
items' windows.

Defined cases: null has no words and is never contaminated; an item without words
has no window; an item without an id hits words but is not listed; rows of one id
and one text are alike; null ids are kept. Empty tables give no rows, or no hits.
Only ``doc_id, text`` and ``item_id, text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docindex.llm.common import id_and_text, rows_of, text_hash
from docindex.workspace import materialise

WINDOW = 13
#: Least share of hit words, as 1 / SHARE, that makes a document contaminated.
SHARE = 20
#: Most fingerprints (or windows) of the items that are broadcast: 16 bytes and about 100 bytes each.
BROADCAST_PRINTS = 1_000_000
BROADCAST_WINDOWS = 200_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What parts words, before and after lower-casing A-Z.
PARTING_ANY = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PARTING = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The lower-cased words, exactly."""
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), PARTING), "")


def cased_words(text: Column) -> Column:
    """The same words in the text's own case; cheaper for a whole table."""
    return F.array_remove(F.split(text, PARTING_ANY), "")


def _combined(df: DataFrame, to: str, a: str, b: str, skip: int, f) -> DataFrame:
    """Column ``to``: each value of ``a`` with that of ``b`` standing ``skip`` later."""
    later = F.slice(b, F.lit(skip + 1), F.greatest(F.size(b) - skip, F.lit(0)))
    return df.withColumn(to, F.zip_with(a, later, lambda x, y: f(x, y)))


def _grams(df: DataFrame, lengths: set[int]) -> DataFrame:
    """Columns ``g<n>``: hashes of n consecutive words, from ``words``; the last n - 1 are of fewer words.

    A step of its own for each column keeps the steps from being computed twice.
    """
    df = df.withColumn("g1", F.transform("words", lambda w: F.xxhash64(F.lower(w))))
    made = {1}
    for n in sorted(lengths):
        parts = [p for p in (8, 4, 2, 1) if n & p]
        power = 2
        while power <= parts[0]:
            if power not in made:
                df = _combined(df, f"g{power}", f"g{power // 2}", f"g{power // 2}", power // 2, F.xxhash64)
                made.add(power)
            power *= 2
        done = parts[0]
        for p in parts[1:]:
            if done + p not in made:
                df = _combined(df, f"g{done + p}", f"g{done}", f"g{p}", done, F.xxhash64)
                made.add(done + p)
            done += p
    return df


def _winnowed(df: DataFrame) -> DataFrame:
    """Column ``kept``: the least of every eight six-word hashes in a row."""
    df = _combined(df, "m2", "g6", "g6", 1, F.least)
    df = _combined(df, "m4", "m2", "m2", 2, F.least)
    return _combined(df, "m8", "m4", "m4", 4, F.least).withColumn("kept", F.array_distinct("m8"))


def _prints(df: DataFrame, key: list[str], short: list[int], whole_item: bool) -> DataFrame:
    """Rows (key, span, print) of a table with ``words``; for items only windows that are complete."""
    lengths = {6, *short}
    df = _winnowed(_grams(df, lengths))
    n = F.size("words")
    kept = [F.when(n >= WINDOW, F.col("kept")).otherwise(F.expr("array()").cast("array<long>"))]
    if whole_item:
        kept = [F.slice("m8", F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(0)))]
    spans = [WINDOW]
    for s in short:
        own = F.slice(f"g{s}", F.lit(1), F.greatest(n - (s - 1), F.lit(0)))
        kept.append(F.when(n == s, own).otherwise(F.expr("array()").cast("array<long>")) if whole_item else F.array_distinct(own))
        spans.append(s)
    if not short:
        return df.select(*key, F.lit(WINDOW).alias("span"), F.explode(kept[0]).alias("print"))
    groups = F.array(*[F.struct(F.lit(s).alias("span"), k.alias("prints")) for s, k in zip(spans, kept)])
    return df.select(*key, F.inline(groups)).select(*key, "span", F.explode("prints").alias("print"))


def _windows(df: DataFrame, key: list[str], spans: list[int], whole_item: bool) -> DataFrame:
    """Rows (key, span, at, window) with the window's words as text."""
    n = F.size("words")

    def cut(s: int) -> Column:
        fits = (n == s) if whole_item and s < WINDOW else (n >= s)
        windows = F.transform(F.sequence(F.lit(1), n - (s - 1)), lambda i: F.struct(i.alias("at"), F.array_join(F.slice("words", i, F.lit(s)), " ").alias("window")))
        return F.when(fits, windows)

    groups = F.array(*[F.struct(F.lit(s).alias("span"), cut(s).alias("windows")) for s in spans])
    return df.select(*key, F.inline(groups)).select(*key, "span", F.inline("windows"))


def _small(df: DataFrame, most: int) -> DataFrame:
    """``df`` for a broadcast if it was counted to be small, else as it is."""
    return F.broadcast(df) if df.count() <= most else df


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Hit windows: doc_id, print_of_text, span, at (from 1), window, item_id."""
    items = benchmark.select("item_id", words(F.coalesce("text", F.lit(""))).alias("words")).where(F.size("words") > 0)
    short = sorted(r[0] for r in items.select(F.size("words")).distinct().where(f"size(words) < {WINDOW}").collect())
    spans = [WINDOW, *short]
    texts = id_and_text(docs).withColumn("text_print", text_hash())
    own = materialise(_prints(items, [], short, True).distinct(), "item-prints")
    cased = texts.select("doc_id", "text_print", cased_words(F.col("text")).alias("words"))
    found = _prints(cased, ["doc_id", "text_print"], short, False).join(_small(own, BROADCAST_PRINTS), ["span", "print"], "left_semi")
    found = materialise(found.select("doc_id", "text_print").distinct(), "suspect-documents")
    # Extend: only suspects are read again, and decided by their exact words.
    item_windows = materialise(_windows(items, ["item_id"], spans, True).select("span", "window", "item_id").distinct(), "item-windows")
    same = texts["doc_id"].eqNullSafe(found["doc_id"]) & (texts["text_print"] == found["text_print"])
    suspects = texts.join(found, same, "left_semi").withColumn("words", words(F.col("text")))
    return _windows(suspects, ["doc_id", "text_print"], spans, False).join(_small(item_windows, BROADCAST_WINDOWS), ["span", "window"])


def _judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    hit = materialise(hits(docs, benchmark).select("doc_id", "text_print", "span", "at", "item_id"), "hit-windows")
    key = ["doc_id", "text_print"]
    covered = (
        hit.select(*key, "at", "span").distinct().select(*key, F.explode(F.sequence(F.col("at"), F.col("at") + F.col("span") - 1)).alias("word"))
        .distinct().groupBy(*key).agg(F.count("*").alias("n_hit"))
    )
    listed = hit.select(*key, F.col("item_id").cast("string").alias("item")).distinct().groupBy(*key).agg(
        F.count("item").alias("n_items"), F.sha2(F.array_join(F.array_sort(F.collect_list("item")), ","), 256).alias("items_sha256"),
    )
    per_text = covered.join(listed, covered["doc_id"].eqNullSafe(listed["doc_id"]) & (covered["text_print"] == listed["text_print"])).select(
        covered["doc_id"].alias("hit_id"), covered["text_print"].alias("hit_print"), "n_hit", "n_items", "items_sha256"
    )
    texts = id_and_text(docs).select("doc_id", text_hash().alias("text_print"), F.size(cased_words(F.col("text"))).cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return texts.join(per_text, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_print") == F.col("hit_print")), "left").select(
        "doc_id", "text_print", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * SHARE >= F.col("n_words"))).alias("contaminated"),
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return _judged(docs, benchmark).drop("text_print")


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    bad = materialise(_judged(docs, benchmark).where("contaminated").select("doc_id", "text_print").distinct(), "contaminated")
    return rows_of(docs, bad, "left_anti")
