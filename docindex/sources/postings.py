"""An inverted index beside the documents: which rows hold a word, how often, and how long they are.

``_postings/<field>/<attempt>`` holds the tables of one write, so new batches are added
without touching old ones, and a read takes the tables of the writes that its scope holds.
A row of ``blocks`` is a word in a block of ``BLOCK`` consecutive sequence numbers: the places
of its documents as short distances from the block's start and their counts of the word, and
the block's largest count and least length. So a word of nearly all documents is many rows of
bounded size. Each file is in order of the word and has a Bloom filter over words: a query
reads the pages of its words in the files that hold them. ``documents`` has each document's
length once, ``lengths`` their sums.

The words of a document are counted in its own row, and what moves between tasks is a list for
each word and block that a task met, not a row for each word of a document.

Rows that later writes took out are left out by the same bitmaps as the documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from docindex.functions.records import _q
from docindex.functions.text import query_words, tokens
from docindex.locator import Locator
from docindex.operators.ranking import B, K1
from docindex.operators.selection import SHALLOW
from docindex.sources import catalog, log
from docindex.sources.log import Part, Segment
from docindex.sources.store import marked, not_deleted, read_index, scan_parts

#: Sequence numbers of one block.
BLOCK = 4096
#: Blocks of the highest bounds that are read first, one for each wanted document at least, for a score that the others have to reach.
FIRST_BLOCKS = 64
#: Tables of earlier forms have folders of other names and are built anew.
FOLDER = "v2-"
STORAGE = {"compression": "zstd", "parquet.bloom.filter.enabled#word": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
#: Bytes of a list of words that goes to every task.
SENT_WORDS = 8 << 20
#: Scores are sums in any order; a bound this much below the least score is still looked at.
SLACK = 1e-9

PLACE = ["_index", "_type", "_try"]
ROW = [*PLACE, "_seq"]
POSTINGS = T.StructType([
    T.StructField("word", T.StringType()), *[T.StructField(c, T.StringType()) for c in PLACE], T.StructField("block", T.LongType()),
    T.StructField("docs", T.LongType()), T.StructField("most", T.LongType()), T.StructField("shortest", T.LongType()),
    T.StructField("at", T.ArrayType(T.ShortType())), T.StructField("times", T.ArrayType(T.IntegerType())),
])
DOCUMENTS = T.StructType([T.StructField(c, T.StringType()) for c in PLACE] + [T.StructField("_seq", T.LongType()), T.StructField("length", T.IntegerType())])
LENGTHS = T.StructType([T.StructField(c, T.StringType()) for c in PLACE] + [T.StructField(c, T.LongType()) for c in ("docs", "words", "buckets")])


def _parts(spark: SparkSession, root: str, locator: Locator | str) -> dict[Segment, Part]:
    return {s: p for s, p in catalog.segments(spark, root, locator).items() if s.kind != catalog.REJECTED}


def build(spark: SparkSession, root: str, field: str, locator: Locator | str = "es://_all") -> int:
    """Index a text field of all writes in scope that have no postings yet; returns how many were added."""
    folder = log.Folder(spark, root)
    done = {n.removeprefix(FOLDER) for n in folder.names(f"_postings/{field}") if n.startswith(FOLDER) and folder.exists(f"_postings/{field}/{n}/lengths/_SUCCESS")}
    missing: dict[str, dict[Segment, Part]] = {}
    everywhere = _parts(spark, root, "es://_all")
    wanted = {p.place[2] for p in _parts(spark, root, locator).values()} - done
    for s, p in everywhere.items():
        if p.place[2] in wanted:
            missing.setdefault(p.place[2], {})[s] = p
    for attempt, parts in missing.items():
        _build_one(spark, root, field, f"{root}/_postings/{field}/{FOLDER}{attempt}", parts)
    return len(missing)


def _build_one(spark: SparkSession, root: str, field: str, path: str, parts: dict[Segment, Part]) -> None:
    typed = T.StructType([T.StructField(field, T.StringType())])
    words = tokens(F.col(_q(field)))
    block = F.expr(f"_seq div {BLOCK}")
    # A write's own folder and mostly its target are the same in all rows: they do not move with them.
    varying = [c for k, c in enumerate(PLACE) if len({p.place[k] for p in parts.values()}) > 1]
    place = [F.col(c) if c in varying else F.lit(v).alias(c) for c, v in zip(PLACE, next(iter(parts.values())).place)]
    keys = [*varying, "block"]
    rows = scan_parts(spark, root, typed, parts).select(*varying, block.alias("block"), (F.col("_seq") - block * BLOCK).alias("at"), F.sort_array(words).alias("w"))
    # A word's occurrences stand together in its document's row; each begins where the one before differs.
    starts = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: ~F.get("w", i).eqNullSafe(F.get("w", i - 1)))
    rows = rows.where(F.size("w") > 0).select(*keys, "at", "w", F.size("w").alias("length"), starts.alias("starts"))
    # As an outer one, for an inner one would have its input filtered, which splits and sorts each text once more.
    each = rows.select(*keys, "at", "w", "length", "starts", F.posexplode_outer("starts").alias("n", "start")).select(
        *keys, "length", F.get("w", F.col("start")).alias("word"),
        (F.shiftleft("at", 32) + F.coalesce(F.get("starts", F.col("n") + 1), F.col("length")) - F.col("start")).alias("entry"),
    )
    # At most ``BLOCK`` entries come together, each as one number: place, then count.
    lists = each.groupBy("word", *keys).agg(F.min("length").cast("long").alias("shortest"), F.sort_array(F.collect_list("entry")).alias("e"))
    times = F.transform("e", lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int"))
    blocks = lists.select(
        "word", *place, "block", F.size("e").cast("long").alias("docs"), F.array_max(times).cast("long").alias("most"), "shortest",
        F.transform("e", lambda x: F.shiftright(x, 32).cast("short")).alias("at"), times.alias("times"),
    )
    blocks.sortWithinPartitions("word", *PLACE, "block").write.mode("overwrite").options(**STORAGE).parquet(f"{path}/blocks")
    docs = scan_parts(spark, root, typed, parts).select(*ROW, F.size(words).alias("length"))
    docs.write.mode("overwrite").options(**STORAGE).parquet(f"{path}/documents")
    stored = spark.read.schema(DOCUMENTS).parquet(f"{path}/documents")
    buckets = stored.groupBy(*PLACE, F.bitmap_bucket_number("_seq").alias("bucket")).agg(F.count("*").alias("docs"), F.sum("length").alias("words"))
    sums = buckets.groupBy(*PLACE).agg(F.sum("docs").alias("docs"), F.sum("words").alias("words"), F.count("*").alias("buckets"))
    sums.write.mode("overwrite").parquet(f"{path}/lengths")


def _stored(spark: SparkSession, root: str, field: str, parts: dict[Segment, Part], name: str, schema: T.StructType) -> DataFrame:
    """Tables of the writes in scope, restricted to its targets."""
    attempts = sorted({p.place[2] for p in parts.values()})
    if not attempts:
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(schema).parquet(*[f"{root}/_postings/{field}/{FOLDER}{a}/{name}" for a in attempts])
    targets = sorted({p.place[:2] for p in parts.values()})
    return stored.where(reduce(lambda a, b: a | b, [(F.col("_index") == i) & (F.col("_type") == t) for i, t in targets]))


def blocks(spark: SparkSession, root: str, field: str, words: list[str] | None = None, locator: Locator | str = "es://_all") -> DataFrame:
    """Posting rows of some words, or of all."""
    stored = _stored(spark, root, field, _parts(spark, root, locator), "blocks", POSTINGS)
    return stored if words is None else stored.where(F.col("word").isin(words))


def _entries(spark: SparkSession, root: str, some: DataFrame, parts: dict[Segment, Part]) -> DataFrame:
    """One row for each living document of posting rows: word, place, _seq, times."""
    each = some.select("word", *PLACE, "block", F.explode(F.arrays_zip("at", "times")).alias("e"))
    rows = each.select("word", *PLACE, (F.col("block") * BLOCK + F.col("e.at")).alias("_seq"), F.col("e.times").alias("times"))
    return not_deleted(spark, root, rows, parts)


def entries(spark: SparkSession, root: str, field: str, words: list[str] | None = None, locator: Locator | str = "es://_all", lengths: bool = True) -> DataFrame:
    """Living documents of some words, or of all: word, place, _seq, times, and if wanted length."""
    parts = _parts(spark, root, locator)
    rows = _entries(spark, root, blocks(spark, root, field, words, locator), parts)
    return _measured(spark, root, field, rows, parts) if lengths else rows


def _measured(spark: SparkSession, root: str, field: str, rows: DataFrame, parts: dict[Segment, Part]) -> DataFrame:
    """Rows with their documents' lengths."""
    return rows.join(_stored(spark, root, field, parts, "documents", DOCUMENTS), ROW).select(*rows.columns, "length")


def term_hits(spark: SparkSession, root: str, field: str, words: DataFrame, locator: Locator | str = "es://_all") -> DataFrame:
    """For each word of a list, the number of documents that hold it: (word, hits). The documents are not read."""
    listed = words.select(F.lower(F.col(words.columns[0])).alias("word")).distinct()
    n, size = listed.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("word")), F.lit(0))).first()
    some = blocks(spark, root, field, None, locator)
    if size + 32 * n <= SENT_WORDS:  # the postings stay where they are; of a longer list, all words are counted before they meet it
        some = some.join(F.broadcast(listed), "word", "left_semi")
    parts = _parts(spark, root, locator)
    state = log.state(spark, root)
    if catalog.deleted_rows(spark, root, state, {p.place for p in parts.values()}) is None:
        counts = some.groupBy("word").agg(F.sum("docs").alias("hits"))
    else:
        counts = _entries(spark, root, some, parts).groupBy("word").agg(F.count("*").alias("hits"))
    return listed.join(counts, "word", "left").select("word", F.coalesce("hits", F.lit(0).cast("long")).alias("hits"))


def matching(spark: SparkSession, root: str, field: str, query: str, every: bool = False, locator: Locator | str = "es://_all") -> DataFrame:
    """Documents that hold any, or every, word of a query, found by their postings."""
    words = query_words(query)
    found = entries(spark, root, field, words, locator, lengths=False)
    rows = found.groupBy(*ROW).agg(F.count("*").alias("n")).where(F.col("n") >= (len(words) if every else 1))
    # One row for each write in scope.
    buckets = _stored(spark, root, field, _parts(spark, root, locator), "lengths", LENGTHS).agg(F.sum("buckets")).first()[0] or 0
    return marked(read_index(spark, root, locator, q="*", with_place=True), rows, buckets).drop("_try")


def _score(times: Column, length: Column, mean: Column, total: Column, having: Column) -> Column:
    idf = F.log(1 + (total - having + 0.5) / (having + 0.5))
    return idf * times * (K1 + 1) / (times + K1 * ((1 - B) + B * length / mean))


def ranked(spark: SparkSession, root: str, field: str, query: str, size: int = 10, locator: Locator | str = "es://_all") -> DataFrame:
    """The best documents for any of the query's words, by BM25: (_id, _score).

    A block's largest count and least length bound the scores of its documents. The blocks with
    the highest bounds are scored first; their ``size``-th score is what a block's bound has to
    reach for the block to be read at all. Ties in the score go to the smaller id.
    """
    words = query_words(query)
    parts = _parts(spark, root, locator)
    found = blocks(spark, root, field, words, locator)
    figures, having = _figures(spark, root, field, parts, found)
    kept = _needed(spark, root, field, found, parts, figures, having, size)
    hits = _scores(spark, root, field, found.join(kept.select(*PLACE, "block"), [*PLACE, "block"], "left_semi"), parts, figures, having)
    least = kept.agg(F.max("reach")).scalar()
    best = hits.where(F.col("_score") >= F.coalesce(least, F.lit(float("-inf"))) - SLACK)
    docs = read_index(spark, root, locator, q="*", with_place=True).select(*ROW, "_id")
    return docs.join(best, ROW).select("_id", "_score").orderBy(F.desc("_score"), F.asc("_id")).limit(size)


def blocks_needed(spark: SparkSession, root: str, field: str, query: str, size: int = 10, locator: Locator | str = "es://_all") -> DataFrame:
    """The blocks that ``ranked`` reads: place, block, bound, reach (the score that they had to reach)."""
    parts = _parts(spark, root, locator)
    found = blocks(spark, root, field, query_words(query), locator)
    return _needed(spark, root, field, found, parts, *_figures(spark, root, field, parts, found), size)


def _figures(spark: SparkSession, root: str, field: str, parts: dict[Segment, Part], found: DataFrame) -> tuple[Column, DataFrame]:
    """Documents and mean length of the scope as one value, and documents per word.

    Without deletions both come from figures that are stored; with them from the living documents.
    """
    state = log.state(spark, root)
    if catalog.deleted_rows(spark, root, state, {p.place for p in parts.values()}) is None:
        lengths = _stored(spark, root, field, parts, "lengths", LENGTHS).agg(F.sum("docs").alias("docs"), F.sum("words").alias("words"))
        having = found.groupBy("word").agg(F.sum("docs").alias("having"))
    else:
        living = not_deleted(spark, root, _stored(spark, root, field, parts, "documents", DOCUMENTS), parts)
        lengths = living.agg(F.count("*").alias("docs"), F.sum("length").alias("words"))
        having = _entries(spark, root, found, parts).groupBy("word").agg(F.count("*").alias("having"))
    return lengths.select(F.struct("docs", F.try_divide(F.col("words").cast("double"), F.col("docs")).alias("mean")).alias("f")).scalar(), having


def _scores(spark: SparkSession, root: str, field: str, some: DataFrame, parts: dict[Segment, Part], figures: Column, having: DataFrame) -> DataFrame:
    each = _measured(spark, root, field, _entries(spark, root, some, parts), parts).join(F.broadcast(having), "word")  # one row for each word of the query
    score = _score(F.col("times"), F.col("length"), figures["mean"], figures["docs"], F.col("having"))
    return each.groupBy(*ROW).agg(F.sum(score).alias("_score"))


def _needed(spark: SparkSession, root: str, field: str, found: DataFrame, parts: dict[Segment, Part], figures: Column, having: DataFrame, size: int) -> DataFrame:
    bound = _score(F.col("most"), F.col("shortest"), figures["mean"], figures["docs"], F.col("having"))
    bounds = found.join(F.broadcast(having), "word").groupBy(*PLACE, "block").agg(F.sum(bound).alias("bound"))
    first = bounds.orderBy(F.desc("bound"), *PLACE, "block").limit(max(FIRST_BLOCKS, min(size, SHALLOW))).select(*PLACE, "block")
    best = _scores(spark, root, field, found.join(F.broadcast(first), [*PLACE, "block"], "left_semi"), parts, figures, having)
    top = best.orderBy(F.desc("_score")).limit(size).agg(F.when(F.count("*") >= size, F.min("_score")).alias("reach")).scalar()
    return bounds.withColumn("reach", top).where(F.col("bound") >= F.coalesce(F.col("reach"), F.lit(float("-inf"))) - SLACK)
