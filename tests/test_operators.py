import json
import math
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from docindex.operators import facets, filters, ordinals, profile, ranking, reports, selection, slowlog
from docindex.operators import search as search_module
from docindex.operators.search import search


def numbers(spark, n):
    return spark.range(n).select(F.col("id").alias("k"))


# -- positions -----------------------------------------------------------------

@pytest.mark.parametrize("hits, chunks, sizes", [
    (7, 2, [3, 3, 1]), (6, 2, [3, 3]), (3, 5, [1, 1, 1]), (1, 1, [1]), (0, 4, []), (10, 1, [10]),
])
def test_chunk_plan(spark, hits, chunks, sizes):
    rows = ordinals.chunk_plan(numbers(spark, hits), chunks).orderBy("chunk").collect()
    assert [r["size"] for r in rows] == sizes
    assert [r["from"] for r in rows] == [sum(sizes[:i]) for i in range(len(sizes))]
    assigned = ordinals.assign_chunks(numbers(spark, hits), chunks, ["k"]).orderBy("k").collect()
    assert [r["chunk"] for r in assigned] == [i for i, s in enumerate(sizes) for _ in range(s)]


def test_ordinals_and_deep_pages(spark, monkeypatch):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"))
    assert ordinals.with_ordinal(df, ["k"]).where("k <> ordinal").count() == 0
    monkeypatch.setattr(selection, "SHALLOW", 10)
    assert [r["k"] for r in ordinals.page(df, ["k"], 4321, 3).orderBy("k").collect()] == [4321, 4322, 4323]


def test_a_shared_sort_value_is_spread_over_tasks(spark):
    df = spark.range(0, 40000, 1, 4).select(F.lit("same").alias("k"), F.col("id").alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = search_module.sorted_documents(df, ["k"]).select("n", F.spark_partition_id().alias("part"))
        sizes = [r["count"] for r in placed.groupBy("part").count().collect()]
        first = [r["n"] for r in placed.where("part = 0").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 20000
    assert first == sorted(first)


def test_running_mean_of_a_run_with_most_rows(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("r"), F.col("id") % 50)).alias("run"),
        F.col("id").alias("seq"), F.when(F.col("id") % 11 > 0, F.col("id") % 17).alias("v"))
    got = {(r["run"], r["seq"]): r["running_mean"] for r in ordinals.running_mean(df, "run", "seq", "v").collect()}
    sums, seen, want = Counter(), Counter(), {}
    for r in df.orderBy("seq").collect():
        if r["v"] is not None:
            sums[r["run"]] += r["v"]
            seen[r["run"]] += 1
        want[r["run"], r["seq"]] = sums[r["run"]] / seen[r["run"]] if seen[r["run"]] else None
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_word_filter(spark):
    words = spark.createDataFrame([(i, w) for i, w in enumerate(["a", "b-c", "d", "e'", "f", "g"])], "n int, w string")
    got = ordinals.word_filter(words, "w", ["n"], 1, 2).collect()
    assert sorted(r["w"] for r in got) == ["d", "f"]


# -- filters -------------------------------------------------------------------

@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, "a", "The quick fox", ["x", "y"], 5), (2, None, "other", ["x", "x"], 7), (3, "b", None, None, None),
        (4, "a", "foxes", [], 5),
    ]
    df = spark.createDataFrame(rows, "id int, kind string, text string, tags array<string>, n int")
    return df.withColumn("ts", F.make_timestamp_ntz(
        F.lit(2013), F.lit(2), F.col("id") + 4, F.lit(8), F.lit(0), F.lit(0)))


@pytest.mark.parametrize("body, ids", [
    ({"match_all": {}}, [1, 2, 3, 4]),
    ({"term": {"kind": "a"}}, [1, 4]),
    ({"term": {"n": "5"}}, [1, 4]),
    ({"term": {"n": "no number"}}, []),
    ({"term": {"tags": "x"}}, [1, 2]),
    ({"terms": {"kind": ["a", "b"]}}, [1, 3, 4]),
    ({"terms": {"tags": ["y", "z"]}}, [1]),
    ({"not": {"term": {"kind": "a"}}}, [2, 3]),
    ({"not": {"filter": {"range": {"n": {"gt": 5}}}}}, [1, 3, 4]),
    ({"not": {"and": [{"term": {"kind": "a"}}, {"term": {"id": 1}}]}}, [2, 3, 4]),
    ({"and": {"filters": [{"term": {"kind": "a"}}, {"range": {"id": {"lt": 4}}}], "_cache": True}}, [1]),
    ({"constant_score": {"filter": {"terms": {"id": [2, 9]}}}}, [2]),
    ({"match": {"text": "Fox other"}}, [1, 2]),
    ({"query": {"match": {"text": "foxes"}}}, [4]),
    ({"query_string": {"query": "fox"}}, [1]),
    ({"query_string": {"query": "text:FOX"}}, [1]),
    ({"query_string": {"query": "*"}}, [1, 2, 3, 4]),
    ({"range": {"ts": {"gte": "2013-02-05T00:00:00-08:00", "lt": "2013-02-07T00:00:00-08:00"}}}, [1, 2]),
    ({"range": {"ts": {"from": "2013-02-06T08:00:00", "to": "2013-02-07T08:00:00Z"}}}, [2, 3]),
    ({"range": {"ts": {"from": "2013-02-06", "to": "2013-02-08"}}}, [2, 3]),
])
def test_filters(docs, body, ids):
    kept = docs.where(filters.compile_filter(body, docs.schema, ["text"]))
    assert sorted(r["id"] for r in kept.collect()) == ids


@pytest.mark.parametrize("dtype", ["int", "bigint", "decimal(8,2)", "double", "float", "smallint"])
@pytest.mark.parametrize("bounds", [
    {"gte": 4.5}, {"lt": 5.5}, {"lte": 4.999}, {"gt": 5}, {"lt": 10**12}, {"gt": -(10**12)}, {"gte": "5"}, {"lt": "5.5"},
    {"lt": 1e30}, {"gte": 5.001},
])
def test_bounds_are_not_rounded(spark, dtype, bounds):
    df = spark.createDataFrame([(3,), (4,), (5,), (6,), (None,)], "n int").select(F.col("n").cast(dtype).alias("n"))
    (how, bound), = bounds.items()
    holds = {"gte": lambda x: x >= float(bound), "gt": lambda x: x > float(bound),
             "lte": lambda x: x <= float(bound), "lt": lambda x: x < float(bound)}[how]
    kept = df.where(filters.compile_filter({"range": {"n": bounds}}, df.schema))
    assert sorted(int(r["n"]) for r in kept.collect()) == [x for x in (3, 4, 5, 6) if holds(x)]


def test_a_fraction_equals_no_whole_number(docs):
    for value, ids in ((5.5, []), (5.0, [1, 4]), ("5.0", [1, 4]), (10**30, []), (float("nan"), [])):
        kept = docs.where(filters.compile_filter({"term": {"n": value}}, docs.schema))
        assert sorted(r["id"] for r in kept.collect()) == ids


@pytest.mark.parametrize("body", [{}, {"a": 1, "b": 2}, {"fuzzy": {"x": 1}}, {"term": {"absent": 1}}])
def test_unknown_filters_are_reported(docs, body):
    with pytest.raises(ValueError):
        filters.compile_filter(body, docs.schema)


def test_backup_methods(docs):
    def ids(spec):
        return sorted(r["id"] for r in docs.where(filters.backup_filter(spec, docs.schema)).collect())

    assert ids({"term": ["kind", "a"]}) == ids({"term": {"kind": "a"}}) == [1, 4]
    assert ids({"all": []}) == [1, 2, 3, 4]
    assert ids({"string": ["text:other"]}) == [2]
    assert ids({"term": {"kind": "a"}, "range": {"id": {"from": 2, "to": 4}}}) == [4]


def test_long_lists_join(spark, docs):
    wanted = spark.createDataFrame([(1,), (3,), (3,), (None,)], "v int")
    assert sorted(r["id"] for r in filters.where_in(docs, "id", wanted).collect()) == [1, 3]
    assert sorted(r["id"] for r in docs.where(filters.terms("id", list(range(2, 20_000)))).collect()) == sorted(
        r["id"] for r in docs.where("id >= 2").collect())


def test_filters_reach_the_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    body = {"and": [{"term": {"event_type": "click"}}, {"range": {"ts": {"gte": "2024-01-05T00:00:00-08:00"}}}]}
    kept = df.where(filters.compile_filter(body, df.schema)).select("event_id")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,click)" in plan and "GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in plan


# -- facets --------------------------------------------------------------------

def test_terms_of_lists_count_documents(docs):
    got = {r["term"]: r["count"] for r in facets.terms(docs, "tags").collect()}
    assert got == {"x": 2, "y": 1}


def test_pooled_terms_count_a_value_once_per_document(spark):
    df = spark.createDataFrame([("a", "a", "b"), ("b", None, "a"), (None, None, None)], "x string, y string, z string")
    got = {r["term"]: r["count"] for r in facets.terms_multi(df, ["x", "y", "z"]).collect()}
    assert got == {"a": 2, "b": 2}


def test_totals(docs):
    row = facets.terms_totals(docs, "kind", 1).first()
    assert (row["missing"], row["total"], row["other"]) == (1, 3, 1)
    row = facets.terms_totals(docs, "kind", 10).first()
    assert (row["missing"], row["total"], row["other"]) == (1, 3, 0)


def test_statistics_of_nothing(docs):
    row = facets.statistical(docs.where("id > 9"), "n").first()
    assert row["count"] == 0 and row["mean"] is None


def test_large_cut(docs, monkeypatch):
    monkeypatch.setattr(selection, "SHALLOW", 0)
    got = facets.terms_stats(docs, "kind", "n", size=1, order="total").collect()
    assert [(r["term"], r["total"]) for r in got] == [("a", 10)]


def request_by_hand(rows, spec):
    """Counts of one facet, by brute force."""
    arg = spec["terms"]
    kept = [r for r in rows if "facet_filter" not in spec or all(
        r[f] == v for f, v in spec["facet_filter"]["term"].items())]
    counts = Counter(str(r[arg["field"]]) for r in kept if r[arg["field"]] is not None)
    ordered = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))
    return ordered[:arg.get("size", 10)]


@pytest.mark.parametrize("filtered", [2, 6])
def test_requests_match_brute_force(spark, filtered):
    df = spark.range(4000).select(
        (F.col("id") * 31 % 97).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 13).alias("b"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5).alias("c"))
    body = {"plain": {"terms": {"field": "a", "size": 4}}, "all": {"terms": {"field": "b", "size": 50}}}
    for i in range(filtered):
        body[f"f{i}"] = {"terms": {"field": "b", "size": 3}, "facet_filter": {"term": {"c": i % 5}}}
    rows = df.collect()
    got = {}
    for r in facets.facet_request(df, body).collect():
        got.setdefault(r["facet"], []).append((r["term"], r["count"]))
    for name, spec in body.items():
        assert sorted(got.get(name, []), key=lambda kv: (-kv[1], kv[0])) == request_by_hand(rows, spec), name


@pytest.mark.parametrize("facets_asked", [1, 6])
def test_statistics_of_no_hits_are_an_answer(docs, facets_asked):
    one = {"statistical": {"field": "n"}, "facet_filter": {"term": {"kind": "none"}}}
    body = {f"f{i}": {**one, "facet_filter": {"term": {"id": 90 + i}}} for i in range(facets_asked)}
    for hits in (docs, docs.where("id > 9")):
        rows = facets.facet_request(hits, body).collect()
        assert sorted((r["facet"], r["count"], r["total"]) for r in rows) == [
            (f"f{i}", 0, None) for i in range(facets_asked)]


def test_more_keys_than_one_pass_holds(spark):
    df = spark.range(50).select(*[(F.col("id") % (i + 2)).alias(f"k{i}") for i in range(40)])
    body = {f"f{i}": {"terms_stats": {"key_field": f"k{i}", "value_field": "k0", "all_terms": True}} for i in range(40)}
    counts = Counter(r["facet"] for r in facets.facet_request(df, body).collect())
    assert counts == {f"f{i}": i + 2 for i in range(40)}


def test_top_per_key_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("l", "z"), ("l", "z"), ("l", "a"), ("m", None)], "k string, v string")
    got = {r["k"]: (r["term"], r["count"]) for r in facets.top_per_key(df, ["k"], "v").collect()}
    assert got == {"k": ("a", 1), "l": ("z", 2)}
    two = facets.top_per_key(df, ["k"], "v", 2, df.where("k = 'l'").select("k")).collect()
    assert sorted((r["term"], r["count"]) for r in two) == [("a", 1), ("z", 2)]


def test_search_without_hits(docs):
    found = search(docs, {"query": {"term": {"kind": "a"}}, "size": 0, "facets": {"f": {"statistical": {"field": "n"}}}})
    assert found.hits is None and found.total().first()["hits"] == 2
    assert found.facets.first()["total"] == 10
    page = search(docs, {"query": {"match_all": {}}, "from": 1, "size": 2, "sort": [{"id": "desc"}]})
    assert [r["id"] for r in page.hits.collect()] == [3, 2] and page.facets is None


# -- profiles and reports --------------------------------------------------------

def test_a_missing_value_prints_like_the_empty_text(spark):
    df = spark.createDataFrame([("a", 1), ("", None), (None, 1)], "x string, y int")
    assert {r["field"]: r["values"] for r in profile.cardinality(df, ["x", "y"]).collect()} == {"x": 2, "y": 2}


def test_value_counts(spark):
    df = spark.createDataFrame([('{"a":1,"b":"x"}',), ('{"a":1}',), ('{"a":2,"b":null}',)], "_source string")
    got = {(r["field"], r["value"]): r["count"] for r in profile.value_counts(df).collect()}
    assert got == {("a", "1"): 2, ("a", "2"): 1, ("b", "x"): 1, ("b", None): 1}


def test_term_hits(spark):
    docs = spark.createDataFrame([("The the cat",), ("a dog, the",), (None,)], "t string")
    words = spark.createDataFrame([("the",), ("Cat",), ("bird",)], "w string")
    got = {r["word"]: r["hits"] for r in profile.term_hits(docs, "t", words).collect()}
    assert got == {"the": 2, "cat": 1, "bird": 0}


def test_ranking_matches_the_formula(spark):
    texts = {1: "the the the", 2: "rare the word here", 3: "rare", 4: "nothing at all", 5: "the end"}
    words = {i: t.split() for i, t in texts.items()}
    mean = sum(map(len, words.values())) / len(words)

    def score(doc):
        total = 0.0
        for q in ("rare", "the"):
            having = sum(q in w for w in words.values())
            tf = words[doc].count(q)
            idf = math.log(1 + (len(words) - having + 0.5) / (having + 0.5))
            total += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words[doc]) / mean))
        return total

    docs = spark.createDataFrame(list(texts.items()), "id int, t string")
    got = ranking.ranked_hits(docs, "id", "t", "rare the").collect()
    want = sorted(((score(i), i) for i in texts if score(i) > 0), key=lambda x: (-x[0], x[1]))
    assert [r["id"] for r in got] == [i for _, i in want]
    assert [r["_score"] for r in got] == pytest.approx([s for s, _ in want])


def test_throughput(spark):
    runs = spark.createDataFrame([
        (707152365, 3709734, "0h02m53", None), (23598696768, 123812641, "0h24m04", 8), (1, 1, "0h00m00", 1),
        (100, 60, "30", 0),
    ], "bytes long, records long, duration string, machines int")
    got = [(r["seconds"], r["rec_s_machine"], r["rec_s"]) for r in reports.throughput(runs).collect()]
    assert got == [(173, 21443, 21443), (1444, 10717, 85742), (0, None, None), (30, 2, 2)]


def test_alias_inversion(spark):
    df = spark.createDataFrame([("i1", ["a", "b"]), ("i2", ["a"]), ("i3", [])], "index string, aliases array<string>")
    assert {(r["alias"], r["index"]) for r in reports.invert_aliases(df).collect()} == {
        ("a", "i1"), ("b", "i1"), ("a", "i2")}


# -- slow logs -------------------------------------------------------------------

LINE = (
    "[2013-03-29 02:16:05,408][WARN ][index.search.slowlog.query] [node-0] [site_count][11] took[12s], "
    'took_millis[12031], search_type[QUERY_THEN_FETCH], total_shards[60], source[{"query":{"term":{"a":[1]}}}], '
    'extra_source[{"size":0}], '
)


def test_slowlog_fields(spark):
    lines = [LINE, LINE.replace('extra_source[{"size":0}]', "extra_source[]"), LINE.split("source[")[0],
             LINE.replace("took_millis[12031], ", "types[t1], "), LINE.replace("QUERY_THEN_FETCH", "COUNT")]
    df = spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
    parsed = slowlog.parse(df)
    full, bare, broken, other, counted = parsed.collect()
    assert [full[c] for c in parsed.columns[2:]] == [
        "WARN", "node-0", "site_count", 11, "12s", 12031, None, "QUERY_THEN_FETCH", 60,
        '{"query":{"term":{"a":[1]}}}', '{"size":0}']
    assert str(full["ts"]) == "2013-03-29 02:16:05.408000"
    assert bare["extra_source"] is None and broken["query"] is None
    assert other["took_millis"] is None and other["types"] == "t1"
    assert slowlog.usable(parsed).count() == 4 and slowlog.rejected(parsed).count() == 1
    status = [r["status"] for r in slowlog.classify(slowlog.usable(parsed)).collect()]
    assert status == ["ok", "ok", "ok", "other search type"]


def test_slowlog_report_and_profile(spark):
    df = spark.createDataFrame([(LINE,), (LINE.replace("[1]", "[22]").replace("12031", "47969"),)], "value string")
    parsed = slowlog.parse(df)
    assert slowlog.total_minutes(parsed).first()["minutes"] == 1.0
    row = slowlog.profile(parsed, [0.5]).first()
    assert (row["queries"], row["total_millis"], row["max_millis"], row["shape"]) == (
        2, 60000, 47969, '{"query":{"term":{"a":[#]}}}')
    assert slowlog.report(parsed).first()["query_fragment"] == '{"query":{"term":{"a":[1]}}}'


def test_replay_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(slowlog, "REPLAY_PASS", 2)
    body = json.dumps({"query": {"term": {"k": 0}}})
    lines = [
        LINE.replace('{"query":{"term":{"a":[1]}}}', body.replace("0", str(k))).replace("[site_count]", f"[{index}]")
        for k in range(5) for index in ("i1", "i2") for _ in range(k + 1)
    ]
    parsed = slowlog.parse(spark.createDataFrame([(x,) for x in lines], "value string"))
    tables = {"i1": spark.range(100).select((F.col("id") % 5).alias("k")), "i2": spark.range(3).select(F.col("id").alias("k"))}
    got = slowlog.replay(parsed, tables.__getitem__).collect()
    assert len(got) == 10
    hits = {(r["index"], json.loads(r["query"])["query"]["term"]["k"]): (r["hits"], r["logged"]) for r in got}
    assert hits == {(i, k): ((20 if i == "i1" else int(k < 3)), k + 1) for i in ("i1", "i2") for k in range(5)}


def test_replayed_facets_match_single_searches(spark, monkeypatch):
    monkeypatch.setattr(slowlog, "REPLAY_PASS", 3)
    docs = spark.range(300).select((F.col("id") % 5).alias("k"), (F.col("id") % 7).alias("g"), F.col("id").alias("v"))
    bodies = [{"query": {"term": {"k": k}}, "facets": {
        "t": {"terms": {"field": "g", "size": 3}, "facet_filter": {"range": {"v": {"gte": 50}}}},
        "s": {"statistical": {"field": "v"}},
    }} for k in (0, 1, 2, 9)] + [{"query": {"match_all": {}}}]
    lines = [LINE.replace('{"query":{"term":{"a":[1]}}}', json.dumps(b)) for b in bodies]
    parsed = slowlog.parse(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = {}
    for r in slowlog.replay_facets(parsed, lambda index: docs).collect():
        got.setdefault(r["query"], set()).add((r["facet"], r["term"], r["count"], r["total"]))
    for body in bodies[:4]:
        alone = search(docs, {**body, "size": 0}).facets.collect()
        assert got.pop(json.dumps(body)) == {(r["facet"], r["term"], r["count"], r["total"]) for r in alone}
    assert not got


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), max_size=30))
def test_statistics_match_plain_arithmetic(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    row = facets.statistical(df, "v").first()
    kept = [v for v in values if v is not None]
    assert row["count"] == len(kept)
    if kept:
        mean = sum(kept) / len(kept)
        assert (row["total"], row["min"], row["max"]) == (sum(kept), min(kept), max(kept))
        assert row["mean"] == pytest.approx(mean)
        assert row["sum_of_squares"] == sum(v * v for v in kept)
        assert row["variance"] == pytest.approx(sum((v - mean) ** 2 for v in kept) / len(kept))
