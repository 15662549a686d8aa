import json
import uuid

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from docindex import flow
from docindex.operators.reports import batch_metrics
from docindex.sources import catalog, dump, files
from docindex.sources.store import (
    compact, export_bulk, json_documents, load, read_index, read_rejects, write_documents, write_records,
)
from docindex.streaming.sink import index_stream


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string").coalesce(1)


def people(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "key int, name string")


def test_round_trip(spark, root):
    done = write_records(people(spark), root, "es://p/row", id_field="key")
    assert (done.records, done.rejected, done.batch) == (3, 0, 1)
    rows = load(spark, root, "es://p/row").orderBy("doc_id").collect()
    assert [tuple(r) for r in rows] == [("1", '{"key":1,"name":"a"}'), ("2", '{"key":2,"name":"b"}'), ("3", '{"key":3}')]


def test_empty_write_and_empty_read(spark, root):
    done = write_records(people(spark).limit(0), root, "es://p/row", id_field="key")
    assert (done.records, done.bytes) == (0, 0)
    assert read_index(spark, root, "es://p/row").count() == 0
    assert read_index(spark, root + "-none", "es://_all").count() == 0


def test_the_last_document_of_an_id_remains(spark, root):
    lines = ['{"_id":1,"v":"old"}', '{"_id":1,"v":"new"}', '{"_id":2,"v":"only"}', '{"v":"x"}', '{"v":"x"}']
    write_documents(json_documents(texts(spark, lines), "es://i/t"), root)
    docs = read_index(spark, root, "es://i/t")
    assert sorted(r["_source"] for r in docs.collect()) == sorted(lines[1:])
    write_documents(json_documents(texts(spark, ['{"_id":1,"w":"newest"}']), "es://i/t"), root)
    again = {r["_id"]: r["_source"] for r in read_index(spark, root, "es://i/t").collect()}
    assert again["1"] == '{"_id":1,"w":"newest"}'
    assert read_index(spark, root, "es://i/t", versions=True).count() == 6


def test_an_assigned_id_can_be_replaced(spark, root):
    write_records(people(spark), root, "es://p/row")
    one = read_index(spark, root, "es://p/row").where("key = 1").first()["_id"]
    write_documents(json_documents(texts(spark, ['{"_id":"%s","key":9}' % one]), "es://p/row"), root)
    docs = read_index(spark, root, "es://p/row")
    assert docs.count() == 3
    assert docs.where(F.col("_id") == one).first()["_source"] == '{"_id":"%s","key":9}' % one


def test_an_id_with_most_of_the_rows(spark, root):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("key"), F.col("id").alias("n")).coalesce(1)
    write_records(rows, root, "es://h/row", id_field="key")
    docs = read_index(spark, root, "es://h/row")
    assert docs.count() == rows.select("key").distinct().count()
    assert docs.where("key = 0").first()["n"] == 19998
    plan = docs._jdf.queryExecution().executedPlan().toString()
    # Only ids are sorted out; the documents themselves stay where they were read.
    assert not any("Exchange" in line and "_source" in line for line in plan.splitlines())


def test_assigned_ids_need_no_shuffle_to_read(spark, root):
    write_records(people(spark), root, "es://p/row")
    write_records(people(spark), root, "es://p/row")
    docs = read_index(spark, root, "es://p/row", query={"term": {"name": "a"}})
    assert docs.count() == 2
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "EqualTo(name,a)" in plan


def test_compaction(spark, root):
    for _ in range(3):
        write_records(people(spark), root, "es://p/row", id_field="key")
    compact(spark, root, root + "-c")
    docs = read_index(spark, root + "-c", "es://p/row")
    assert "Exchange" not in docs._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["key"] for r in docs.collect()) == [1, 2, 3]
    write_records(people(spark).withColumn("name", F.lit("z")), root + "-c", "es://p/row", id_field="key")
    assert [r["name"] for r in read_index(spark, root + "-c", "es://p/row").collect()] == ["z"] * 3


def test_a_small_update_of_a_compacted_index_does_not_shuffle_it(spark, root):
    write_records(spark.range(1000), root, "es://n/row", id_field="id")
    write_records(spark.range(500), root, "es://n/row", id_field="id")
    compact(spark, root, root + "-c")
    update = spark.range(990, 1010).select("id")
    for _ in range(2):
        write_records(update, root + "-c", "es://n/row", id_field="id")
    write_records(update, root + "-c", "es://n/row")
    docs = read_index(spark, root + "-c", "es://n/row")
    assert docs.count() == 1010 + 20 and docs.select("_id").distinct().count() == 1030
    assert docs.where("_batch <= 2").count() == 990
    assert "BroadcastHashJoin" in docs._jdf.queryExecution().executedPlan().toString()


def test_a_lower_batch_number_does_not_win(spark, root):
    write_records(people(spark), root, "es://p/row", id_field="key", batch=9)
    write_records(people(spark).withColumn("name", F.lit("z")), root, "es://p/row", id_field="key", batch=3)
    assert {r["name"] for r in read_index(spark, root, "es://p/row").collect()} == {"a", "b", None}


WRITE = st.tuples(st.booleans(), st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 9)), max_size=4))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(WRITE, min_size=1, max_size=4))
def test_any_history_of_writes_reads_as_the_plain_model(spark, tmp_path, history):
    root = str(tmp_path / uuid.uuid4().hex)
    by_id, without = {}, []
    for compact_first, docs in history:
        if compact_first and catalog.segments(spark, root):
            compact(spark, root, root + "c")
            root += "c"
        lines = [json.dumps({"_id": i, "v": v} if i is not None else {"v": v}) for i, v in docs]
        write_documents(json_documents(texts(spark, lines), "es://i/t"), root)
        for (i, _), line in zip(docs, lines):
            if i is None:
                without.append(line)
            else:
                by_id[i] = line
    got = [r["_source"] for r in read_index(spark, root, "es://i/t").collect()]
    assert sorted(got) == sorted([*by_id.values(), *without])


def test_modes(spark, root):
    write_records(people(spark), root, "es://p/row", mode="errorifexists")
    with pytest.raises(FileExistsError):
        write_records(people(spark), root, "es://p/row", mode="errorifexists")
    assert write_records(people(spark), root, "es://p/row", mode="ignore") is None
    write_records(people(spark), root, "es://p/other")
    write_records(people(spark).where("key = 1"), root, "es://p/row", mode="overwrite")
    counts = {t: read_index(spark, root, f"es://p/{t}").count() for t in ("row", "other")}
    assert counts == {"row": 1, "other": 3}


def test_rejects_keep_the_line(spark, root, tmp_path):
    path = str(tmp_path / "bad")
    lines = ["nope", "[1]", '{"a":1}', None, ""]
    done = write_documents(json_documents(texts(spark, lines), "es://i/t"), root, rejects=path)
    assert (done.records, done.rejected) == (1, 4)
    bad = read_rejects(spark, root).collect()
    assert {r["_source"] for r in bad} == {"nope", "[1]", None, ""}
    assert spark.read.json(path).count() == 4
    assert catalog.list_indices(spark, root) == ["i"]


def test_missing_id_is_rejected(spark, root):
    done = write_records(people(spark), root, "es://p/row", id_field="name")
    assert (done.records, done.rejected) == (2, 1)
    assert read_rejects(spark, root).first()["_reason"] == "no id"


def test_scope_and_types(spark, root):
    write_records(people(spark), root, "es://i1/t1")
    write_records(people(spark), root, "es://i1/t2")
    write_records(people(spark).withColumn("extra", F.lit(1)), root, "es://i2/t1")
    assert read_index(spark, root, "es://i1").count() == 6
    assert read_index(spark, root, "es://i1,i2/t1").count() == 6
    both = read_index(spark, root, "es://_all")
    assert both.count() == 9 and "extra" in both.columns
    assert catalog.list_indices(spark, root) == ["i1", "i2"]
    assert catalog.list_types(spark, root, "i1") == ["t1", "t2"]


def test_numeric_looking_names_stay_text(spark, root):
    write_records(people(spark), root, "es://0012/007")
    row = read_index(spark, root, "es://0012/007").first()
    assert (row["_index"], row["_type"]) == ("0012", "007")


@pytest.mark.parametrize("name", ["a b", "x=y", "p/q", "é", "{z}", "[w]", "50%", "a:b", "UP", "#h", "2013"])
def test_any_target_name_comes_back(spark, root, name):
    write_documents(json_documents(texts(spark, ['{"_index":"%s","_mapping":"%s","_id":1}' % (name, name)])), root)
    row = read_index(spark, root, "es://_all").first()
    assert (row["_index"], row["_type"]) == (name, name)
    assert catalog.list_indices(spark, root) == [name]


def test_fields_of_several_types_have_the_least_common_one(spark, root):
    write_records(people(spark), root, "es://a/t")
    write_records(people(spark).withColumn("key", F.col("key").cast("string")), root, "es://b/t")
    write_records(people(spark).withColumn("key", F.col("key") + 0.5), root, "es://c/t")
    write_records(people(spark).drop("key"), root, "es://d/t")
    both = read_index(spark, root, "es://a,b")
    assert both.schema["key"].dataType.simpleString() == "string" and sorted(r["key"] for r in both.collect()) == ["1", "1", "2", "2", "3", "3"]
    for options in ({"query": {"term": {"key": 1}}}, {"q": "key:1"}):
        assert [r["_index"] for r in read_index(spark, root, "es://a,b", **options).orderBy("_index").collect()] == ["a", "b"]
    numbers = read_index(spark, root, "es://a,c", query={"range": {"key": {"gte": 2, "lt": 3}}})
    assert sorted((r["_index"], r["key"]) for r in numbers.collect()) == [("a", 2.0), ("c", 2.5)]
    assert read_index(spark, root, "es://_all", query={"exists": {"field": "key"}}).count() == 9
    assert read_index(spark, root, "es://b").count() == 3
    # Replaced documents go in every branch.
    write_records(people(spark).withColumn("name", F.lit("z")), root, "es://a/t?id=key")
    write_records(people(spark).withColumn("name", F.lit("y")), root, "es://a/t?id=key")
    assert read_index(spark, root, "es://a,b", query={"term": {"name": "z"}}).count() == 0
    assert read_index(spark, root, "es://a,b", query={"term": {"name": "y"}}).count() == 3


def test_a_later_write_adds_fields(spark, root):
    write_records(people(spark), root, "es://p/row", id_field="key")
    more = spark.createDataFrame([(4, "text")], "key int, extra string")
    write_records(more, root, "es://p/row", id_field="key")
    rows = {r["key"]: (r["name"], r["extra"]) for r in read_index(spark, root, "es://p/row").collect()}
    assert rows == {1: ("a", None), 2: ("b", None), 3: (None, None), 4: (None, "text")}
    with pytest.raises(ValueError):
        write_records(more.withColumn("extra", F.lit(1)), root, "es://p/row")


def test_one_field_of_raw_documents(spark, root):
    lines = ['{"t":"An Alien ship","u":"x"}', '{"t":"ship","u":"alien"}']
    write_documents(json_documents(texts(spark, lines)), root)
    assert [r["_source"] for r in read_index(spark, root, q="t:alien").collect()] == lines[:1]
    assert read_index(spark, root, q="t:*").count() == 2


def test_routing_path_of_a_mapping(spark, root):
    mapping = {"_routing": {"path": "flight"}, "properties": {"n": {"type": "long"}}}
    lines = ['{"flight":7,"n":1}', '{"flight":7,"n":2,"_routing":"own"}', '{"n":3}']
    write_documents(json_documents(texts(spark, lines)), root, mapping=mapping, shards=8)
    catalog.put_mapping(spark, root, "hadoop", "streaming_record", mapping)
    got = {r["n"]: r["_routing"] for r in read_index(spark, root).collect()}
    assert got == {1: "7", 2: "own", 3: None}


def test_free_text_over_mapped_and_raw_documents(spark, root):
    write_records(spark.createDataFrame([("an alien",), ("no",)], "note string"), root, "es://m/row")
    write_documents(json_documents(texts(spark, ['{"t":"alien ship"}', '{"t":"x"}']), "es://r/row"), root)
    assert load(spark, root, "es://m,r?q=alien").count() == 2
    assert load(spark, root, "es://m?q=alien").count() == 1


def test_free_text_over_raw_documents(spark, root):
    lines = ['{"t":"An Alien ship"}', '{"t":"aliens","alien":1}', '{"n":{"d":"alien"}}']
    write_documents(json_documents(texts(spark, lines), "es://ufo/s"), root)
    found = sorted(r["contents"] for r in load(spark, root, "es://ufo/s?q=alien").collect())
    assert found == sorted([lines[0], lines[2]])


def test_routing_keeps_its_shard(spark, root):
    rows = spark.range(1000).select("id", (F.col("id") % 3 * 0 + F.col("id") % 7).alias("flight"))
    write_records(rows, root, "es://f/row", id_field="id", routing_field="flight", shards=4, salt=3)
    docs = read_index(spark, root, "es://f/row")
    per = docs.groupBy("_routing").agg(F.count_distinct("_shard").alias("n"), F.min("_shard").alias("s")).collect()
    assert {r["n"] for r in per} == {1} and all(0 <= r["s"] < 4 for r in per) and docs.count() == 1000


def test_bulk_requests(spark, root, tmp_path):
    rows = spark.range(0, 2500, 1, 2).select(F.to_json(F.struct("id")).alias("_source"))
    write_documents(json_documents(rows.withColumnRenamed("_source", "v"), "es://i/t"), root, bulk_size=1000)
    files = batch_metrics(read_index(spark, root, "es://i/t").withColumn("file", F.input_file_name())).collect()
    assert sorted(r["items"] for r in files) == [250, 250, 1000, 1000]
    path = str(tmp_path / "bulk")
    export_bulk(read_index(spark, root, "es://i/t"), path, 500)
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert len(lines) == 5000 and sum('"index":{"_index":"i"' in x for x in lines) == 2500


def test_replaced_batch(spark, root):
    docs = json_documents(texts(spark, ['{"_id":1}', '{"_id":2}', '{"a":1}']), "es://i/t")
    for _ in range(2):
        write_documents(docs, root, batch=4, writer="again")
    assert read_index(spark, root, "es://i/t", versions=True).count() == 3


def test_stream_resumes_without_doubles(spark, root, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")

    def run():
        stream = spark.readStream.schema("value string").format("text").load(source)
        index_stream(stream, root, checkpoint, lambda df: json_documents(df, "es://s/t")).trigger(
            availableNow=True).start().awaitTermination()

    texts(spark, ['{"_id":1}', '{"a":1}']).write.text(source)
    run()
    run()
    texts(spark, ['{"_id":1,"v":2}', '{"a":1}']).write.mode("append").text(source)
    run()
    docs = read_index(spark, root, "es://s/t")
    assert docs.count() == 3
    assert docs.where("_id = '1'").first()["_source"] == '{"_id":1,"v":2}'


def test_backup_restore_duplicate(spark, root, tmp_path):
    lines = ['{"_id":"x","id":5,"type":"t","n":1}', '{"id":"y","n":2}', '{"n":3,"sort":[1]}']
    write_documents(json_documents(texts(spark, lines), "es://a/t"), root)
    path = str(tmp_path / "d")
    assert dump.backup(spark, root, "es://a/t", path) == 3
    dumped = files.read_dump(spark, path)
    keys = {k for r in dumped.select(F.json_object_keys("value").alias("k")).collect() for k in r["k"]}
    assert keys == {"id", "_type", "_id", "n"}
    dump.restore(spark, path, root, "es://b/t")
    ids = {r["_id"] for r in read_index(spark, root, "es://a").collect()}
    assert {r["_id"] for r in read_index(spark, root, "es://b").collect()} == ids
    done = dump.duplicate(spark, path, root, "es://b/t")
    docs = read_index(spark, root, "es://b")
    assert done.records == 3 and docs.count() == 6 and docs.select("_id").distinct().count() == 6


def test_backup_of_an_empty_document(spark, root, tmp_path):
    write_documents(json_documents(texts(spark, ["{}"]), "es://a/t"), root)
    path = str(tmp_path / "d")
    dump.backup(spark, root, "es://a/t", path)
    value = files.read_dump(spark, path).first()["value"]
    assert value.startswith('{"id":"') and value.endswith('","_type":"t"}')


def test_tsv_by_names(spark, tmp_path):
    path = str(tmp_path / "t")
    texts(spark, ["a\tb\tc", "a", "\tb", "a\t\tc", "a\t\t", "\t\t", ""]).write.text(path)
    rows = [tuple(r) for r in files.read_tsv_fields(spark, path, ["x", "y"]).collect()]
    assert rows == [("a", "b"), ("a", None), ("", "b"), ("a", ""), ("a", None), (None, None), ("", None)]


def test_slowlog_source(spark, tmp_path):
    path = str(tmp_path / "log")
    texts(spark, ["x [index.search.SlowLog.Query] y", "curl", ""]).write.text(path)
    assert files.read_slowlog(spark, path).count() == 1


def test_flow_between_all_kinds(spark, root, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    texts(spark, ['{"_id":1}', '{"_id":2}']).write.text(a)
    flow.run_flow(spark, a, "es://i/t", root=root)
    flow.run_flow(spark, "es://i/t", "es://j/t", root=root, read_options={"query": None})
    flow.run_flow(spark, "es://j/t", b, mapper=lambda df: df.where("value like '%2%'"), root=root)
    assert [r["value"] for r in spark.read.text(b).collect()] == ['{"_id":2}']


def test_console_dump(spark, capsys):
    flow.dump(people(spark))
    assert sorted(capsys.readouterr().out.split()) == ["(1,a)", "(2,b)", "(3,)"]


def test_work_folder_is_shared_or_refused():
    from types import SimpleNamespace

    from docindex.workspace import work_dir

    def session(master, folder):
        conf = SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert work_dir(session("yarn", "hdfs://nn/cp/"), "x").startswith("hdfs://nn/cp/docindex/x-")
    assert work_dir(session("local[2]", None), "x")
    with pytest.raises(ValueError):
        work_dir(session("yarn", None), "x")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_files_of_given_ids(spark, root):
    rows = spark.range(2000).select(F.col("id").alias("key"), (F.col("id") % 7).cast("string").alias("kind"), F.lit("x" * 50).alias("pad"))
    write_records(rows, root, "es://u/row?id=key")
    write_records(rows.where("key < 30").withColumn("kind", F.lit("new")), root, "es://u/row?id=key")
    found = read_index(spark, root, "es://u/row", query={"term": {"kind": "3"}})
    assert sorted(int(r["_id"]) for r in found.select("_id").collect()) == [k for k in range(30, 2000) if k % 7 == 3]
    assert read_index(spark, root, "es://u/row", query={"term": {"kind": "new"}}).count() == 30
    plan = plan_of(found)
    assert "EqualTo(kind,3)" in plan
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert read_index(spark, root, "es://u/row").count() == 2000


def test_every_path_fills_the_typed_columns(spark, root, tmp_path):
    rows = spark.range(4).select(F.col("id").alias("n"), F.lit("click").alias("kind"))
    write_records(rows, root, "es://m/row")
    other = spark.range(2).select(F.col("id").cast("string").alias("n"))
    write_records(other, root, "es://o/row")
    flow.write_output(texts(spark, ['{"n":10,"kind":"click"}', '{"n":"11","kind":"view","_index":"o","_mapping":"row"}', '{"z":1,"_index":"free"}']), "es://m/row", root)
    write_records(texts(spark, ['{"n":"12","kind":"click"}']), root, "es://m/row?json=true")
    write_records(spark.createDataFrame([(13, "click")], "n long, kind string"), root, "es://m/row", as_text=True)
    found = read_index(spark, root, "es://m/row", query={"term": {"kind": "click"}})
    assert sorted(r["n"] for r in found.collect()) == [0, 1, 2, 3, 10, 12, 13]
    assert read_index(spark, root, "es://m/row", q="click").count() == 7
    assert sorted(r["n"] for r in read_index(spark, root, "es://o/row").collect()) == ["0", "1", "11"]
    # Both targets' types of n differ: text holds both.
    assert load(spark, root, "es://_all").count() == 11
    assert read_index(spark, root, "es://_all", query={"term": {"kind": "click"}}).count() == 7
    assert sorted(r["_index"] for r in read_index(spark, root, "es://_all", query={"term": {"n": 1}}).collect()) == ["m", "o"]


def test_streams_and_loads_side_by_side(spark, root, tmp_path):
    def load_some(k):
        write_documents(json_documents(texts(spark, [f'{{"load":{k},"n":{n}}}' for n in range(5)]), "es://s/t"), root)

    def stream(name):
        texts(spark, [f'{{"stream":"{name}","n":{n}}}' for n in range(5)]).write.text(str(tmp_path / name))
        lines = spark.readStream.schema("value string").format("text").load(str(tmp_path / name))
        index_stream(lines, root, str(tmp_path / f"cp-{name}"), lambda df: json_documents(df, "es://s/t")).trigger(
            availableNow=True).start().awaitTermination()

    load_some(1)
    stream("a")
    load_some(2)
    stream("b")
    assert read_index(spark, root, "es://s/t").count() == 20


def test_tasks_and_size_move_no_documents(spark, root):
    write_records(spark.range(1000).repartition(4), root, "es://i/t?size=10")
    files = [f for f in spark.read.parquet(root).inputFiles()]
    assert len(files) == 4
    docs = read_index(spark, root, "es://i/t?tasks=2")
    assert docs.rdd.getNumPartitions() == 2 and "Exchange" not in plan_of(docs)
