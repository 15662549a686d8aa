"""The commit log and deletion bitmaps."""

import json
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from docindex.sources import catalog, log, store
from docindex.sources.store import json_documents, read_index, write_documents, write_records


def rows(spark, low, high, value="v"):
    return spark.range(low, high, 1, 2).select("id", F.lit(value).alias("v"))


def put(spark, root, low, high, value="v", **options):
    return write_records(rows(spark, low, high, value), root, "es://i/t?id=id", **options)


def held(spark, root):
    return {int(r["_id"]): r["v"] for r in read_index(spark, root, "es://i/t").collect()}


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_disjoint_appends_read_as_one_plain_scan(spark, root):
    for k in range(4):
        put(spark, root, 10 * k, 10 * k + 10)
    docs = read_index(spark, root, "es://i/t")
    assert "Join" not in plan_of(docs) and "Aggregate" not in plan_of(docs) and plan_of(docs).count("Relation") == 1
    assert docs.count() == 40
    assert not os.path.exists(f"{root}/_deletes") or not os.listdir(f"{root}/_deletes")
    # Only what was replaced meets a bitmap; the other parts stay plain.
    put(spark, root, 5, 7, "new")
    docs = read_index(spark, root, "es://i/t")
    assert plan_of(docs).count("Join") == 1
    assert held(spark, root) == {k: "new" if k in (5, 6) else "v" for k in range(40)}
    # A replaced part outside the scope does not matter.
    write_records(rows(spark, 0, 3), root, "es://j/t?id=id")
    assert "Join" not in plan_of(read_index(spark, root, "es://j/t"))


def test_ids_of_overlapping_ranges_without_repeats(spark, root):
    """Ranges meet, ids do not: the ids are looked at, and nothing is noted."""
    for k in range(3):
        write_records(spark.range(k, 3000, 3).select("id"), root, "es://i/t?id=id")
    docs = read_index(spark, root, "es://i/t")
    assert "Join" not in plan_of(docs) and docs.count() == 3000


def test_bitmaps_over_many_buckets_and_tasks(spark, root):
    n = 100_000
    write_records(spark.range(0, n, 1, 2), root, "es://i/t?id=id")
    write_records(spark.range(0, n, 7, 3), root, "es://i/t?id=id")
    write_records(spark.range(0, n, 14, 1), root, "es://i/t?id=id")
    docs = read_index(spark, root, "es://i/t")
    by_batch = {r["_batch"]: r["count"] for r in docs.groupBy("_batch").count().collect()}
    every, second, third = n, len(range(0, n, 7)), len(range(0, n, 14))
    assert by_batch == {1: every - second, 2: second - third, 3: third}
    assert docs.select("_id").distinct().count() == n
    assert {r["_index"]: r["docs"] for r in catalog.document_counts(spark, root).collect()} == {"i": n}


def test_counts_come_from_the_log(spark, root):
    lines = spark.range(30).select(F.format_string('{"_index":"x%d","_id":"%d"}', F.col("id") % 3, F.col("id") % 10).alias("value"))
    write_documents(json_documents(lines), root)
    write_documents(json_documents(spark.createDataFrame([("broken",), ('{"_index":"x0"}',)], "value string")), root)
    want = {r["_index"]: r["count"] for r in read_index(spark, root, "es://_all").groupBy("_index").count().collect()}
    assert {r["_index"]: r["docs"] for r in catalog.document_counts(spark, root).collect()} == want
    assert {r["_index"]: r["docs"] for r in catalog.document_counts(spark, root, "es://x1,x2").collect()} == {k: want[k] for k in ("x1", "x2")}
    assert catalog.document_counts(spark, root + "-none").count() == 0


def test_a_write_that_broke_off_does_not_exist(spark, root, monkeypatch):
    put(spark, root, 0, 5)
    with monkeypatch.context() as m:
        m.setattr(store, "_commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            put(spark, root, 0, 5, "lost")
    assert set(held(spark, root).values()) == {"v"}
    assert put(spark, root, 3, 4, "next").batch == 3
    assert held(spark, root)[3] == "next"
    # Its data goes when somebody asks for it; what is committed stays.
    assert len(log.vacuum(spark, root)) == 1 and log.vacuum(spark, root) == []
    assert len(held(spark, root)) == 5


def test_a_named_write_replaces_its_own_attempts(spark, root, monkeypatch):
    put(spark, root, 0, 5)
    with monkeypatch.context() as m:
        m.setattr(store, "_commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            put(spark, root, 2, 4, "a", writer="w")
    put(spark, root, 3, 4, "between")
    assert put(spark, root, 2, 4, "b", writer="w").batch == 2
    assert held(spark, root) == {0: "v", 1: "v", 2: "b", 3: "between", 4: "v"}
    assert put(spark, root, 1, 4, "c", writer="w").batch == 2
    assert held(spark, root) == {0: "v", 1: "c", 2: "c", 3: "between", 4: "v"}


def test_racing_claims_get_their_own_numbers(spark, root):
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda _: log.claim(spark, root), range(24)))
    assert sorted(numbers) == list(range(1, 25))
    with ThreadPoolExecutor(4) as pool:
        assert len(set(pool.map(lambda _: log.claim(spark, root, "same"), range(8)))) == 1


def test_racing_writes_of_the_same_ids(spark, root):
    """Whichever commits last, each id keeps the document of the highest batch, once."""
    put(spark, root, 0, 20, "old")
    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(lambda k: put(spark, root, k, 10 + k, f"w{k}").batch, range(4)))
    assert sorted(done) == [2, 3, 4, 5]
    order = [k for _, k in sorted(zip(done, range(4)))]
    want = {k: "old" for k in range(20)}
    for k in order:
        want |= {i: f"w{k}" for i in range(k, 10 + k)}
    docs = read_index(spark, root, "es://i/t").collect()
    assert len(docs) == 20 and held(spark, root) == want
    assert {r["_index"]: r["docs"] for r in catalog.document_counts(spark, root).collect()} == {"i": 20}


def test_commits_that_race_look_at_each_other(spark, root):
    asked = {"a": [], "b": []}

    def entry(name, batch):
        segment = log.Segment("i", "t", "given", batch, name)
        return log.Entry(batch, name, (log.Part(segment, (f"{name}.parquet",), 1, "1", "2"),))

    def b_first(others):
        asked["a"].append({s.writer for s in others})
        if len(asked["a"]) == 1:  # meanwhile another write commits
            log.commit(spark, root, entry("b", 2), lambda others: asked["b"].append({s.writer for s in others}))

    log.commit(spark, root, entry("a", 1), b_first)
    assert asked == {"a": [set(), {"b"}], "b": [set()]}
    assert [e.writer for e in log.entries(spark, root)] == ["b", "a"]


def test_checkpoints_sum_up_entries(spark, root, monkeypatch):
    monkeypatch.setattr(log, "CHECKPOINT", 4)
    for k in range(1, 11):
        segment = log.Segment("i", "t", "unique", k, f"w{k}")
        replaces = (("i", "t"),) if k == 3 else ()
        log.commit(spark, root, log.Entry(k, f"w{k}", (log.Part(segment, (f"f{k}",), k),), replaces=replaces), lambda others: None)
    state = log.state(spark, root)
    assert (state.version, state.newest_batch) == (10, 10)
    assert sorted(s.batch for s in state.parts) == list(range(3, 11))
    # Readers need the newest checkpoint and what follows it.
    for n in range(1, 9):
        os.remove(f"{root}/_log/commits/{n:012d}.json")
    assert log.state(spark, root) == state


def test_entries_are_plain_json(spark, root):
    put(spark, root, 0, 3)
    put(spark, root, 1, 2)
    names = sorted(n for n in os.listdir(f"{root}/_log/commits") if n.endswith(".json"))
    last = json.load(open(f"{root}/_log/commits/{names[-1]}"))
    assert last["batch"] == 2 and last["parts"][0]["records"] == 1 and last["parts"][0]["low"] == last["parts"][0]["high"] == "1"
    first = log.state(spark, root).parts[log.Segment("i", "t", "given", 1, next(log.entries(spark, root)).writer)]
    assert [(tuple(place), n) for place, n in last["deletions"][0]["rows"]] == [(first.place, 1)]


def test_overwriting_a_target_while_reading_it(spark, root):
    put(spark, root, 0, 10)
    kept = read_index(spark, root, "es://i/t").where("id < 3").select("id", "v")
    write_records(kept, root, "es://i/t?id=id", mode="overwrite")
    assert sorted(held(spark, root)) == [0, 1, 2]


def test_an_input_of_several_mappings_runs_once(spark, root):
    write_records(spark.range(1), root, "es://a/t")
    write_records(spark.range(1).select(F.col("id").cast("string").alias("id")), root, "es://b/t")
    lines = spark.range(0, 400, 1, 4).select(F.to_json(F.struct(
        F.when(F.rand() < 0.5, "a").otherwise("b").alias("_index"), F.lit("t").alias("_mapping"), F.col("id").alias("_id"), "id")).alias("value"))
    done = write_documents(json_documents(lines), root)
    docs = read_index(spark, root, "es://a,b/t", q="*").where("_batch = 3")
    assert done.records == 400 and docs.count() == docs.select("_id").distinct().count() == 400


def test_very_many_files_are_listed_and_read_by_their_folder(spark, root):
    rows = spark.createDataFrame([('{"_index":"a,b \\\\c","_id":"%d"}' % k,) for k in range(90)], "value string").coalesce(1)
    write_documents(json_documents(rows), root, bulk_size=2)
    write_documents(json_documents(spark.createDataFrame([('{"_index":"few","_id":"x"}',)], "value string")), root)
    names = log.Folder(spark, root).data_files("")
    walked = [os.path.relpath(os.path.join(d, f), root) for d, _, some in os.walk(root) for f in some if f.startswith("part-")]
    assert names == [] and len(walked) == 46
    attempts = {f.split("/")[0] for f in walked}
    found = [n for a in attempts for n in log.Folder(spark, root).data_files(a)]
    assert sorted(found) == sorted(walked) == sorted(f for p in log.state(spark, root).parts.values() for f in p.files)
    docs = read_index(spark, root, "es://_all")
    assert "InMemoryFileIndex(2 paths)" in docs._jdf.queryExecution().executedPlan().toString()
    assert docs.count() == 91 and docs.where(F.col("_index") == "a,b \\c").count() == 90
