import json

import pytest
from pyspark.sql import functions as F

from docindex.functions import records, times
from docindex.functions.text import has_any_word, has_word, query_words, tokens
from docindex.mapping import mapping_to_struct, merged, routing_path, struct_to_mapping, typed_view
from docindex.sources.store import json_documents, json_record_documents, record_documents


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def evaluate(spark, values, expression):
    return [r[0] for r in texts(spark, values).select(expression(F.col("v"))).collect()]


CASES = [
    ('{"a":null,"b":1}', {"b": 1}),
    ('{"b":[1,null,2]}', {"b": [1, 2]}),
    ('{"f":[],"b":1}', {"b": 1}),
    ('{"c":{"e":true,"n":null}}', {"c": {"e": True}}),
    ('{"c":{"l":[[],[null],[1]]}}', {"c": {"l": [[1]]}}),
    ('{"big":123456789012345678901234567890,"b":2}', {"big": 123456789012345678901234567890, "b": 2}),
    (' { "s" : "a , null , [] :null} \\\\" , "n" : null , "t" : "\\"x\\": []" } ', {"s": "a , null , [] :null} \\", "t": '"x": []'}),
    ('{"a":[[[]],[[],[null]]],"b":[[1,[]],null],"c":{},"d":[{"e":[]}]}', {"b": [[1]], "c": {}, "d": [{}]}),
    ('{"a":null,"b":null}', {}),
    ("{'a':1}", None),
    ('{"a":1}}', None),
    ('{"a":1}{"b":2}', None),
    ('{"k\uf8f0":"\uf8f1","n":1.50}', {"k\uf8f0": "\uf8f1", "n": 1.5}),
    ('{"s":"é\\"x","d":1.5}', {"s": 'é"x', "d": 1.5}),
    ("{}", {}),
    ("nope", None),
    ("[1]", None),
    ("", None),
    (None, None),
    ('{"a":1,"a":2}', None),
    ('{"c":{"k":1,"k":2}}', None),
    ('{"a":NaN}', None),
    ('{"a":1} trailing', None),
]


def test_untyped_compaction(spark):
    got = evaluate(spark, [c for c, _ in CASES], records.compacted)
    assert [json.loads(g) if g is not None else None for g in got] == [w for _, w in CASES]


def test_numbers_and_long_texts_are_kept_as_written(spark):
    long = '{"t":"' + '\\\\ \\" [] ,null, ' * 30_000 + '","n":[1.50,-0.0,1e5,null]}'
    assert evaluate(spark, [long], records.compacted) == [long.replace(",null]}", "]}")]


def test_declared_compaction(spark):
    schema = "a string, b array<long>, c struct<e: boolean, n: string, l: array<array<long>>>, f array<long>, m map<string, array<long>>"
    values = [
        '{"a":null,"b":[1,null,2],"f":[]}',
        '{"c":{"e":true,"n":null,"l":[[],[null],[1]]}}',
        '{"m":{"x":null,"y":[],"z":[1,null]}}',
        "nope", "[1]", '{"a":1,"a":2}',
    ]
    got = evaluate(spark, values, lambda v: records.retyped(v, schema))
    assert [json.loads(g) if g else None for g in got] == [
        {"b": [1, 2]}, {"c": {"e": True, "l": [[1]]}}, {"m": {"z": [1]}}, None, None, None]


def test_document_validity(spark):
    values = ['{"a":1}', "{}", '{"a":1} x', "nope", "[1]", '"s"', "1", "", None, '{"a":1,"a":2}', '{"c":{"k":1,"k":2}}', '{"a":1']
    got = evaluate(spark, values, lambda v: records.is_document(records.members(v)))
    assert got == [True, True, True] + [False] * 9


def test_metadata(spark):
    lines = [
        '{"_id":7}', '{"_id":null}', '{"_index":"x","_mapping":"y","_routing":5}', '{"a":1}', "nope", "[1]", '{"_index":" "}',
    ]
    rows = json_documents(texts(spark, lines)).collect()
    got = {r["_source"]: (r["_index"], r["_type"], r["_id"], r["_routing"], r["_reason"]) for r in rows}
    default = ("hadoop", "streaming_record")
    assert got == {
        lines[0]: (*default, "7", None, None),
        lines[1]: (*default, "null", None, None),
        lines[2]: ("x", "y", None, "5", None),
        lines[3]: (*default, None, None, None),
        lines[4]: (*default, None, None, "not a JSON object"),
        lines[5]: (*default, None, None, "not a JSON object"),
        lines[6]: (*default, None, None, "blank target"),
    }


def test_metadata_keys_can_be_named(spark):
    row = json_documents(
        texts(spark, ['{"i":"x","t":"y","k":1,"r":"z"}']), "es://d/e", index_field="i", type_field="t",
        id_fields=("nope", "k"), routing_field="r").first()
    assert (row["_index"], row["_type"], row["_id"], row["_routing"]) == ("x", "y", "1", "z")


def test_tabular_and_json_forms_give_the_same_document(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "character string, value int")
    tabular = record_documents(rows, "es://foo/bar", as_text=True)
    lines = texts(spark, ['{"character":"a","value":"1"}', '{"character":"b","value":"2"}', '{"character":"c","value":null}'])
    as_json = json_record_documents(lines, "es://foo/bar")
    assert sorted(r["_source"] for r in tabular.collect()) == sorted(r["_source"] for r in as_json.collect())


def test_reserved_names_are_refused(spark):
    with pytest.raises(ValueError):
        record_documents(spark.createDataFrame([(1,)], "_seq int"), "es://a/b")


def test_drop_keys(spark):
    values = ['{"_id":1,"id":"x","a":[1,null],"n":null}', "{}", "nope"]
    got = evaluate(spark, values, lambda v: records.drop_keys(v, "_id", "id"))
    assert got == ['{"a":[1,null],"n":null}', "{}", None]


def test_timestamps(spark):
    values = [
        "2012-11-30T01:15:23", "2012-11-30T01:15:23.9", "2012-11-30T01:15:23+02:00", "2012-11-30", "20121130",
        "2012/11/30 01:15:23", "30 Nov 2012 01:15:23", "", None, "bad",
    ]
    wire = evaluate(spark, values, lambda v: times.format_timestamp(times.parse_timestamp(v)))
    assert wire == [
        "2012-11-30T01:15:23Z", "2012-11-30T01:15:23Z", "2012-11-29T23:15:23Z", "2012-11-30T00:00:00Z",
        "2012-11-30T00:00:00Z", "2012-11-30T01:15:23Z", "2012-11-30T01:15:23Z", None, None, None]


def test_wire_form_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = evaluate(
            spark, ["2012-11-30T01:15:23Z"], lambda v: times.format_timestamp(times.parse_timestamp(v)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["2012-11-30T01:15:23Z"]


def test_local_days_follow_the_clock_change(spark):
    stamps = ["2013-03-10 08:30:00", "2013-03-11 06:30:00", "2013-03-11 07:30:00"]
    got = evaluate(spark, stamps, lambda v: times.bucket_start(v.cast("timestamp_ntz"), "day", "US/Pacific").cast("string"))
    assert got == ["2013-03-10 08:00:00", "2013-03-10 08:00:00", "2013-03-11 07:00:00"]


def test_words(spark):
    values = ["The cat, the_dog; Été-2 x", "theme other bathe", "", None, "THE", "the2 éthe", "a the"]
    assert evaluate(spark, values, tokens)[0] == ["the", "cat", "the", "dog", "été", "2", "x"]
    assert evaluate(spark, values, lambda v: has_word(v, "the")) == [True, False, False, False, True, False, True]
    by_list = evaluate(spark, values, lambda v: F.array_contains(tokens(v), "the"))
    assert by_list == [True, False, False, False, True, False, True]
    assert query_words("The, the ÉTÉ! a_b") == ["the", "été", "a", "b"]
    assert evaluate(spark, values[:3], lambda v: has_any_word(v, ["bathe", "cat"])) == [True, True, False]


MAPPING = {
    "_routing": {"path": "flight_id"},
    "dynamic": False,
    "properties": {
        "_state": {"type": "string", "index": "no", "store": "yes"},
        "cnt": {"type": "integer"},
        "flight_id": {"type": "integer"},
        "metric": {"type": "string", "index": "not_analyzed"},
        "tb_h": {"type": "date"},
        "at": {"properties": {"lat": {"type": "double"}}},
    },
}


def test_mapping_view(spark):
    lines = texts(spark, [
        '{"cnt":5,"metric":"m","tb_h":"2013-02-05T00:00:00-08:00","at":{"lat":1.5},"unmapped":1}',
        '{"cnt":"7","tb_h":1360051200000}',
        '{"cnt":"x","tb_h":"never"}',
    ]).withColumnRenamed("v", "_source")
    rows = typed_view(lines, MAPPING).select("cnt", "metric", times.format_timestamp(F.col("tb_h")), "at.lat").collect()
    assert [tuple(r) for r in rows] == [
        (5, "m", "2013-02-05T08:00:00Z", 1.5), (7, None, "2013-02-05T08:00:00Z", None), (None, None, None, None)]


def test_mappings_grow_but_keep_their_types():
    old = {"dynamic": False, "properties": {"a": {"type": "long"}}}
    new = {"properties": {"a": {"type": "long"}, "b": {"type": "string"}}}
    assert merged(old, new) == {"dynamic": False, "properties": new["properties"]}
    assert merged(None, new) is new
    with pytest.raises(ValueError):
        merged(old, {"properties": {"a": {"type": "string"}}})


def test_mapping_round_trip():
    struct = mapping_to_struct(MAPPING)
    assert struct["metric"].metadata == {"analyzed": False, "indexed": True, "stored": False}
    assert struct["_state"].metadata == {"analyzed": False, "indexed": False, "stored": True}
    assert mapping_to_struct(struct_to_mapping(struct)) == struct
    assert routing_path(MAPPING) == "flight_id"
