"""Ranks of an order through buckets, against sorting."""

import random

import pytest
from pyspark.sql import functions as F

import oracle
from docindex.operators import selection
from docindex.operators.selection import ranks

ROWS = [(k % 7 if k % 11 else None, ("x" * (k % 3) + str(k % 50)) if k % 13 else None, float(k % 5), k // 4) for k in range(3000)]


def table(spark):
    rows = ROWS[:]
    random.Random(5).shuffle(rows)
    return spark.createDataFrame(rows, "a int, s string, d double, n int").repartition(4)


def by_force(rows, order, start, stop):
    """Sorted by the order, nulls first where it rises and last where it falls."""
    rows = sorted(rows, key=repr)
    for column, falls in reversed(order):
        at = "asdn".index(column)
        rows.sort(key=lambda r: (r[at] is not None, r[at] if r[at] is not None else 0), reverse=falls)
    return rows[start:stop]


def keys_of(rows, order):
    """The sort keys, which decide; rows with equal keys may stand for each other."""
    at = ["asdn".index(c) for c, _ in order]
    return sorted((tuple(r[i] for i in at) for r in rows), key=repr)


ORDERS = [
    [("n", False), ("s", False)], [("a", True), ("s", False)], [("s", True), ("n", True)], [("d", True)], [("a", False)],
]


@pytest.mark.parametrize("order", ORDERS, ids=str)
@pytest.mark.parametrize("start,size", [(0, 1), (0, 1500), (700, 900), (2900, 500), (5000, 3), (0, 9999)])
def test_ranks_are_those_of_sorting(spark, monkeypatch, order, start, size):
    monkeypatch.setattr(selection, "SHALLOW", 0)
    monkeypatch.setattr(selection, "BLOCK", 3)
    monkeypatch.setattr(selection, "SAMPLE", 12)
    got = ranks(table(spark), order, size, start).collect()
    assert keys_of(got, order) == keys_of(by_force(ROWS, order, start, start + size), order)
    # No row comes twice.
    left = sorted(map(repr, map(tuple, got)))
    every = sorted(map(repr, ROWS))
    for r in left:
        every.remove(r)


@pytest.mark.parametrize("size", [1, 5, 40])
def test_ranks_within_groups(spark, monkeypatch, size):
    order = [("n", True), ("s", False)]
    want = []
    for group in {r[0] for r in ROWS}:
        want += by_force([r for r in ROWS if r[0] == group], order, 0, size)
    for limit in (0, 1000):
        monkeypatch.setattr(selection, "SHALLOW_GROUP", limit)
        got = ranks(table(spark), order, size, within=["a"]).collect()
        assert sorted((r.a, r.n) for r in got if r.a is not None) == sorted((r[0], r[3]) for r in want if r[0] is not None)
        assert len(got) == len(want)


def test_rows_that_are_all_alike(spark, monkeypatch):
    """They are counted before they are ranked."""
    monkeypatch.setattr(selection, "SHALLOW", 0)
    df = spark.range(0, 50_000, 1, 8).select((F.col("id") % 2).alias("k"), F.lit("same").alias("v"))
    got = ranks(df, [("k", False)], 30_000, 10)
    assert {r.k: r["count"] for r in got.groupBy("k").count().collect()} == {0: 24_990, 1: 5_010}
    # A map column cannot be grouped by; ranks are right all the same.
    mapped = df.withColumn("m", F.create_map(F.lit("a"), "k"))
    assert ranks(mapped, [("k", False)], 30_000, 10).count() == 30_000


def test_nothing_runs_and_nothing_is_set_while_a_plan_is_built(spark):
    tracker = spark.sparkContext.statusTracker()
    df = spark.range(0, 200_000, 1, 4).select((F.col("id") * 7 % 200_000).alias("k"))
    before = dict(spark.conf.getAll), spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    top = ranks(df, [("k", True)], 150_000)
    assert (dict(spark.conf.getAll), spark.sparkContext._jsc.sc().dagScheduler().nextJobId()) == before
    assert tracker.getActiveJobsIds() == []
    assert top.agg(F.count("*"), F.min("k")).first()[:] == (150_000, 50_000)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert not oracle.large_top(plan) and not oracle.ONE_TASK.search(plan)


def test_shallow_ranks_are_in_order(spark):
    got = [r.n for r in ranks(table(spark), [("n", True)], 50, 3).collect()]
    assert got == sorted(got, reverse=True) and len(got) == 50
