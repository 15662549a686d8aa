"""Posting lists and block-max ranking against a search through all texts."""

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from docindex.operators.ranking import ranked_hits
from docindex.sources import postings
from docindex.sources.store import read_index, write_records


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(postings, "BLOCK", 16)
    monkeypatch.setattr(postings, "FIRST_BLOCKS", 2)


def texts(spark, low, high, extra=""):
    """A frequent word everywhere, a rarer one, one word of their own; lengths differ."""
    k = F.col("id")
    filler = F.repeat(F.lit("filler "), (k * 7 % 23).cast("int"))
    rare = F.when(k % 97 == 0, F.repeat(F.lit("Rare, "), (1 + k % 5).cast("int"))).otherwise(F.lit(""))
    return spark.range(low, high, 1, 2).select("id", F.concat(F.lit("the own"), k, F.lit(" "), filler, rare, F.lit(extra)).alias("text"))


def stored(spark, root):
    write_records(texts(spark, 0, 1500), root, "es://d/t?id=id")
    write_records(texts(spark, 1490, 1600, " again the"), root, "es://d/t?id=id")
    write_records(spark.createDataFrame([("9000", None), ("9001", ""), ("9002", "RARE the")], "id string, text string").select(F.col("id").cast("long").alias("id"), "text"),
                  root, "es://e/t?id=id")
    return root


def ranking_by_force(docs, query, size):
    return [(r["_id"], round(r["_score"], 9)) for r in ranked_hits(docs, "_id", "text", query, size).collect()]


@pytest.mark.parametrize("locator", ["es://_all", "es://d", "es://e"])
def test_ranking_is_that_of_all_texts(spark, root, small_blocks, locator):
    postings.build(spark, stored(spark, root), "text")
    docs = read_index(spark, root, locator)
    for query, size in (("rare", 5), ("the rare", 10), ("again rare own7", 3), ("nowhere", 4), ("the", 7), ("rare", 10_000)):
        got = [(r["_id"], round(r["_score"], 9)) for r in postings.ranked(spark, root, "text", query, size, locator).collect()]
        assert got == ranking_by_force(docs, query, size), query


def test_blocks_without_a_chance_are_not_read(spark, root, small_blocks):
    postings.build(spark, stored(spark, root), "text")
    every = postings.blocks(spark, root, "text", ["rare"]).count()
    needed = postings.blocks_needed(spark, root, "text", "rare", 3)
    assert every >= 15 and 0 < needed.count() <= every // 2
    assert postings.blocks_needed(spark, root, "text", "rare", 10_000).count() == every


def test_matching_and_counts(spark, root, small_blocks):
    postings.build(spark, stored(spark, root), "text")
    docs = read_index(spark, root, "es://_all")
    for query, every in (("again rare", False), ("again rare", True), ("the", True), ("nowhere the", True), ("own1495", False)):
        words = query.split()
        held = F.array(*[F.array_contains(F.split(F.lower("text"), "[^\\p{L}\\p{N}]+"), w) for w in words])
        want = docs.where(F.size(F.filter(held, lambda x: x)) >= (len(words) if every else 1))
        got = postings.matching(spark, root, "text", query, every)
        assert sorted(map(tuple, got.select("_index", "_id", "text").collect())) == sorted(map(tuple, want.select("_index", "_id", "text").collect()))
    words = spark.createDataFrame([("THE",), ("rare",), ("own3",), ("again",), ("none",)], "word string")
    from docindex.operators.profile import term_hits

    want = sorted(map(tuple, term_hits(docs, "text", words).collect()))
    assert sorted(map(tuple, postings.term_hits(spark, root, "text", words).collect())) == want


def test_postings_are_added_write_by_write(spark, root, small_blocks):
    stored(spark, root)
    assert postings.build(spark, root, "text", "es://d") == 2
    assert postings.build(spark, root, "text") == 1 and postings.build(spark, root, "text") == 0
    write_records(texts(spark, 5, 6, " late"), root, "es://d/t?id=id")
    assert postings.build(spark, root, "text") == 1
    words = spark.createDataFrame([("own5",), ("late",)], "word string")
    assert sorted(map(tuple, postings.term_hits(spark, root, "text", words).collect())) == [("late", 1), ("own5", 1)]


def test_a_word_of_all_documents_is_rows_of_bounded_size(spark, root, small_blocks):
    postings.build(spark, stored(spark, root), "text")
    sizes = postings.blocks(spark, root, "text", ["the"]).select(F.size("at").alias("n"), "docs").collect()
    assert len(sizes) > 90 and all(r["n"] == r["docs"] <= 16 for r in sizes)


def test_a_word_is_sought_in_the_files_and_nothing_else_is_read(spark, root):
    postings.build(spark, stored(spark, root), "text")
    shown = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = postings.blocks(spark, root, "text", ["rare"])._jdf.queryExecution().executedPlan().toString()
        listed = spark.createDataFrame([("rare",)], "word string")
        counting = postings.term_hits(spark, root, "text", listed, "es://e")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", shown)
    assert "EqualTo(word,rare)" in plan
    assert "_source" not in counting and "times:" not in counting


@pytest.fixture
def nothing_is_small(spark):
    """The planner takes no table for small enough to be sent to every task."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    shown = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, shown)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_building_moves_a_list_per_word_and_block_once(spark, root, small_blocks, monkeypatch):
    stored(spark, root)
    plans, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **b: (plans.append((path, plan_of(self._df))), write(self, path, *a, **b))[1])
    postings.build(spark, root, "text")
    moved = [plan for path, plan in plans if path.endswith("/blocks")]
    assert len(moved) == 3
    for plan in moved:
        assert plan.count("Exchange ") == 1 and "rangepartitioning" not in plan and "partial_collect_list" in plan


def test_counts_and_lengths_of_odd_texts(spark, root, small_blocks):
    texts = [None, "", " ,;", "a", "b a B a", "Ärger ärger x1 x1 x1", "z " * 40 + "a"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    write_records(rows, root, "es://d/t?id=id")
    postings.build(spark, root, "text")
    docs = {r["_seq"]: r["_id"] for r in read_index(spark, root, "es://d").select("_seq", "_id").collect()}
    got = sorted((docs[r["_seq"]], r["word"], r["times"], r["length"]) for r in postings.entries(spark, root, "text").collect())
    assert got == sorted([("3", "a", 1, 1), ("4", "a", 2, 4), ("4", "b", 2, 4), ("5", "ärger", 2, 5), ("5", "x1", 3, 5), ("6", "a", 1, 41), ("6", "z", 40, 41)])


def test_documents_stay_where_they_are(spark, root, small_blocks, nothing_is_small):
    stored(spark, root)
    assert "SortMergeJoin" not in plan_of(read_index(spark, root, "es://_all"))


def test_documents_found_by_postings_stay_where_they_are(spark, root, small_blocks, nothing_is_small):
    postings.build(spark, stored(spark, root), "text")
    assert "SortMergeJoin" not in plan_of(postings.matching(spark, root, "text", "again rare"))


def test_postings_stay_where_they_are(spark, root, small_blocks, nothing_is_small, monkeypatch):
    postings.build(spark, stored(spark, root), "text")
    words = spark.createDataFrame([("again",), ("rare",)], "word string")
    assert "LeftSemi, BuildRight" in plan_of(postings.term_hits(spark, root, "text", words))
    short = sorted(map(tuple, postings.term_hits(spark, root, "text", words).collect()))
    monkeypatch.setattr(postings, "SENT_WORDS", 0)
    assert sorted(map(tuple, postings.term_hits(spark, root, "text", words).collect())) == short == [("again", 110), ("rare", 18)]


def test_counting_words_moves_no_entries(spark, root, small_blocks, nothing_is_small):
    postings.build(spark, stored(spark, root), "text")
    found = postings.entries(spark, root, "text", lengths=False)
    assert "SortMergeJoin" not in plan_of(found) and "length" not in found.columns
    counted = {r["word"]: (r["docs"], r["times"]) for r in found.groupBy("word").agg(F.count("*").alias("docs"), F.sum("times").alias("times")).collect()}
    assert counted["again"] == (110, 110) and counted["the"] == (1601, 1711) and counted["own1495"] == (1, 1)
