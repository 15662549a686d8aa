"""Archives: round trips, odd pages, hostile bytes."""

import base64
import hashlib
import random
import struct

import pytest
import zstandard
from pyspark.sql import types as T

from docindex.llm import warc
from docindex.workspace import work_dir

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
    # Names that the operator uses itself.
    T.StructField("key", T.StringType()), T.StructField("n", T.LongType()), T.StructField("head", T.LongType()), T.StructField("sha1", T.StringType()),
])
ODD = [
    (1, "http://a/1", "<p>x"), (2, "http://a/2", "<p>x"), (3, None, None), (4, "", ""), (5, "http://a b\r\nX: y", "é\r\n\r\nWARC/1.1\r\n" * 3),
    (7, "u", "same row"), (7, "u", "same row"), (7, "u", "same row"), (7, "t", "same row"), (6, "u", "same row"), (None, "n", "no id"), (None, "n", "no id"),
    (None, "n", "<p>x"), (-8, "m", "x" * 3_000_000), (9, "日本", "日本" * 1000),
]


def force(pages):
    """(page_id, payload_bytes, digest, type, refers_to) one page at a time."""
    out, groups = [], {}
    for page_id, url, html, *_ in pages:
        groups.setdefault((html or "").encode(), []).append((page_id is not None, page_id or 0, url or "", page_id))
    for payload, members in groups.items():
        members.sort()
        head = members[-1][3]
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out += [(m[3], len(payload), digest, "revisit", head) for m in members[:-1]] + [(head, len(payload), digest, "response", None)]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("parts", [1, 5])
def test_pages_come_back_as_records(spark, parts):
    pages = [(*p, "k", 1, 2, "s") for p in ODD]
    df = spark.createDataFrame(pages, PAGES).repartition(parts)
    assert rows_of(warc.archived(df)) == force(pages)


def test_no_pages_give_no_records(spark):
    assert warc.archived(spark.createDataFrame([], PAGES)).count() == 0


def test_payloads_and_files(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    random.seed(3)
    pages = [(k, f"http://h/{k}", f"<html><p>{random.random()}" + "<div class='a'>word</div>" * random.randrange(300), "", 0, 0, "") for k in range(400)]
    folder = work_dir(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(pages, PAGES).repartition(2), folder, "2020-01-01T00:00:00Z")
    got = warc.read_archives(spark, folder, with_payload=True)
    assert {(r.page_id, r.payload.decode(), r.target_uri, r.warc_date) for r in got.collect()} == {(p[0], p[2], p[1], "2020-01-01T00:00:00Z") for p in pages}
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    assert files.count() > 2
    content = bytes(files.first()["content"])
    # A dictionary leads, and any reader of concatenated frames that has it reads on.
    dictionary, start = warc.dictionary_of(memoryview(content))
    assert dictionary is not None and struct.unpack_from("<I", content)[0] == 0x184D2A5D
    text = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(content[start:], read_across_frames=True).read()
    assert text.count(b"WARC/1.1\r\n") == sum(1 for _ in warc.records_of(content))


def archive(records, dictionary=b"", front=None):
    kind = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    press = zstandard.ZstdCompressor(dict_data=kind)
    front = warc.leading_frame(dictionary) if front is None and dictionary else front or b""
    return front + b"".join(press.compress(r) for r in records)


def response(payload, **changed):
    digest = warc.digest_of(payload)
    fields = {
        "WARC-Type": "response", "WARC-Record-ID": warc.record_id(1, digest), "WARC-Date": "2020-01-01T00:00:00Z",
        "WARC-Payload-Digest": f"sha1:{digest}",
    }
    fields.update(changed)
    return warc.record_bytes([(k, v) for k, v in fields.items() if v is not None], warc.http_head(len(payload)) + payload)


GOOD = response(b"good")


@pytest.mark.parametrize("record,problem", [
    (GOOD.replace(b"WARC/1.1", b"WARC/9.9"), "version"),
    (GOOD[:-4], "block of"),
    (GOOD + b"more", "block of"),
    (GOOD.replace(b"good\r\n\r\n", b"goop\r\n\r\n"), "differs from its digest"),
    (GOOD.replace(b"Content-Length: 4", b"Content-Length: 5"), "payload of 4"),
    (GOOD.replace(b"Content-Length: 4", b"Content-Length: x"), "content length"),
    (response(b"good", **{"WARC-Date": None}), "no warc-date"),
    (response(b"good", **{"WARC-Payload-Digest": "md5:1"}), "payload digest"),
    (response(b"good", **{"WARC-Type": "revisit"}), "a revisit with a payload"),
    (b"WARC/1.1\r\nno colon\r\n\r\n\r\n\r\n", "header line"),
    (b"\xff\xfe", "headers without end"),
])
def test_damaged_records_are_named_and_the_next_is_read(record, problem):
    found = list(warc.records_of(archive([GOOD, record, GOOD])))
    assert [r is not None for _, r, _ in found] == [True, False, True]
    assert problem in found[1][2]


def test_damaged_frames_end_an_archive():
    content = archive([GOOD, GOOD])
    for broken in (content[:-3], content + b"\x28\xb5", content + b"garbage!"):
        found = list(warc.records_of(broken))
        assert found[0][1] is not None and found[-1][1] is None and found[-1][2]
    assert list(warc.records_of(b"")) == []
    flipped = bytearray(archive([GOOD]))
    flipped[-6] ^= 1
    assert next(warc.records_of(bytes(flipped)))[1] is None


def test_dictionaries_plain_pressed_and_missing():
    samples = [f"<html><head><title>{k}</title></head><body>page number {k % 7}</body></html>".encode() for k in range(500)]
    raw = zstandard.train_dictionary(4000, samples).as_bytes()
    record = response(samples[3])
    plain = struct.pack("<II", 0x184D2A5D, len(raw)) + raw
    for content in (archive([record], raw), archive([record], raw, plain), archive([record])):
        ((_, got, _),) = warc.records_of(content)
        assert got.payload == samples[3]
    # Made with a dictionary that is not there.
    lost = archive([record], raw)[len(warc.leading_frame(raw)):]
    assert next(warc.records_of(lost))[1] is None


def test_folded_headers_and_other_types():
    info = warc.record_bytes([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:uuid:1>"), ("WARC-Date", "2020-01-01T00:00:00Z"), ("X", "a\r\n  b")], b"software: x")
    ((_, got, problem),) = warc.records_of(archive([info]))
    assert problem is None and got.payload == b"software: x" and got.fields["x"] == "a b"


def test_strict_reading_fails_and_lenient_reading_says_why(spark, tmp_path):
    (tmp_path / "part-0.warc.zst").write_bytes(archive([GOOD, GOOD[:-1], GOOD]))
    with pytest.raises(Exception, match="block of"):
        warc.read_archives(spark, str(tmp_path)).collect()
    rows = warc.read_archives(spark, str(tmp_path), strict=False).orderBy("offset").collect()
    assert [r.problem is None for r in rows] == [True, False, True] and rows[2].page_id == 1
