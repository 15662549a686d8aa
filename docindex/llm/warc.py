"""WARC archives in zstandard: one frame per record, a shared dictionary in front.

An archive starts with a skippable frame that holds the dictionary, itself compressed.
Every record after it is one zstandard frame made with that dictionary, so a reader can
skip to any record. The reader loads the dictionary, walks the frames by their block
headers, decompresses one record at a time and checks it: version line, header fields,
lengths of block and payload, digest. Frames that hold no record are skipped.

Of pages with equal payloads the one with the largest id (then the largest url) becomes a
response with the payload; the others become revisits that name it and carry headers
only. Which one it is comes from two aggregations of digests, combined in every task
before their shuffles, so a payload that a third of all pages share sends one row a task,
and rows equal in everything are counted and written again instead of being numbered.

Archives are committed by Spark's own writer, one file for every ``FILE_BYTES`` of frames,
so a lost executor leaves no half-written file. The dictionary is learned from at most
``SAMPLE_ROWS`` pages of at most ``SAMPLE_BYTES``; too few of them give archives without one.

Defined cases: a null html is empty, and all empty payloads are equal; a null page id is
smaller than every other; a null url is written as ``about:blank``; repeated rows are one
response and revisits of it. An empty table gives no records. Only ``page_id, url, html``
are read. A damaged record is an error, or a row with its ``problem`` where asked for.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docindex.llm.common import ship, slices
from docindex.workspace import materialise, work_dir

FILE_BYTES = 16 << 20
BATCH_TEXT = 8 << 20
LEVEL = 3
#: Pages that the dictionary is learned from, the longest of them, and its size.
SAMPLE_ROWS, SAMPLE_BYTES, DICTIONARY = 256, 32 << 10, 64 << 10

# Numbers of frames, and an empty skippable frame that ends every file.
DICTIONARY_FRAME, FRAME = 0x184D2A5D, 0xFD2FB528
SKIPPABLE, SKIPPABLE_LAST = 0x184D2A50, 0x184D2A5F
ENDING = "\x5e*M\x18\0\0\0\0"

VERSIONS = (b"WARC/1.0", b"WARC/1.1")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
UNSAFE = re.compile(r"[^\x21-\x7e]")

RECORDS = (
    "path string, offset long, record_type string, record_id string, target_uri string, warc_date string, page_id long, "
    "payload_bytes long, payload_digest string, refers_to long, problem string"
)


class Damaged(ValueError):
    """A record that is not what its headers say."""


def digest_of(payload: bytes) -> str:
    """Base32 of the payload's SHA-1.

    >>> digest_of(b"")
    '3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ'
    """
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# -- one record ----------------------------------------------------------------

def record_bytes(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def http_head(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def record_id(page_id: int | None, digest: str, more: str = "") -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}:{digest}{more}>"


def page_of(identifier: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+|null):[A-Z2-7]{32}[^<>]*>", identifier)
    if not found:
        raise Damaged(f"record id {identifier!r}")
    return None if found[1] == "null" else int(found[1])


def uri(url: str | None) -> str:
    """A url that fits one header line.

    >>> uri("http://a/b c\\nd"), uri(None)
    ('http://a/b%20c%0Ad', 'about:blank')
    """
    if not url:
        return "about:blank"
    return UNSAFE.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode(errors="replace")), url)


def _headers(text: bytes, start: int) -> tuple[bytes, dict[str, str], int]:
    """First line, fields by lower-case name, and where the body begins."""
    stop = text.find(b"\r\n\r\n", start)
    if stop < 0:
        raise Damaged("headers without end")
    first, *lines = text[start:stop].split(b"\r\n")
    fields: dict[str, str] = {}
    name = None
    for line in lines:
        if line[:1] in (b" ", b"\t") and name:  # a folded line continues the field
            fields[name] += " " + line.strip().decode()
            continue
        key, colon, value = line.partition(b":")
        if not colon or not key.strip():
            raise Damaged(f"header line {line[:40]!r}")
        name = key.strip().lower().decode()
        fields[name] = value.strip().decode()
    return first, fields, stop + 4


def _length(fields: dict[str, str]) -> int:
    value = fields.get("content-length", "")
    if not value.isdigit():
        raise Damaged(f"content length {value!r}")
    return int(value)


@dataclass
class Record:
    fields: dict[str, str]
    payload: bytes | None
    payload_bytes: int
    digest: str


def read_record(data: bytes) -> Record:
    """A record's checked fields and payload; a revisit has only its payload's length and digest."""
    try:
        version, fields, body = _headers(data, 0)
    except UnicodeDecodeError as e:
        raise Damaged(f"header is no UTF-8: {e}") from e
    if version not in VERSIONS:
        raise Damaged(f"version {version[:20]!r}")
    for name in REQUIRED:
        if not fields.get(name):
            raise Damaged(f"no {name}")
    length = _length(fields)
    if len(data) - body != length + 4 or data[body + length :] != b"\r\n\r\n":
        raise Damaged(f"block of {len(data) - body - 4} bytes, header says {length}")
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return Record(fields, data[body : body + length], length, digest_of(data[body : body + length]))
    status, http, start = _headers(data[: body + length], body)
    if not status.startswith(b"HTTP/"):
        raise Damaged(f"status line {status[:20]!r}")
    stated = _length(http)
    named = fields.get("warc-payload-digest", "")
    if not re.fullmatch(r"sha1:[A-Z2-7]{32}", named):
        raise Damaged(f"payload digest {named!r}")
    if kind == "revisit":
        if start != body + length:
            raise Damaged("a revisit with a payload")
        if not fields.get("warc-refers-to"):
            raise Damaged("a revisit of nothing")
        return Record(fields, None, stated, named[5:])
    payload = data[start : body + length]
    if len(payload) != stated:
        raise Damaged(f"payload of {len(payload)} bytes, header says {stated}")
    if digest_of(payload) != named[5:]:
        raise Damaged("payload differs from its digest")
    return Record(fields, payload, stated, named[5:])


# -- archives ------------------------------------------------------------------

def leading_frame(dictionary: bytes) -> bytes:
    """The skippable frame that holds a dictionary."""
    pressed = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", DICTIONARY_FRAME, len(pressed)) + pressed


def _number(data: memoryview, at: int) -> int:
    if at + 4 > len(data):
        raise Damaged("cut off in a frame's number")
    return struct.unpack_from("<I", data, at)[0]


def frame_stop(data: memoryview, at: int) -> int:
    """Where the frame that begins at ``at`` ends, by its block headers."""
    kept = data[at : at + 18].tobytes()
    try:
        parameters, place = zstandard.get_frame_parameters(kept), at + zstandard.frame_header_size(kept)
    except zstandard.ZstdError as e:
        raise Damaged(f"frame header: {e}") from e
    last = False
    while not last:
        if place + 3 > len(data):
            raise Damaged("cut off in a block")
        head = int.from_bytes(data[place : place + 3], "little")
        last, kind, size = bool(head & 1), (head >> 1) & 3, head >> 3
        place += 3 + (1 if kind == 1 else size)
    place += 4 if parameters.has_checksum else 0
    if place > len(data):
        raise Damaged("cut off in a frame")
    return place


def dictionary_of(data: memoryview) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """The dictionary of an archive's leading frame, if it has one, and where the records begin."""
    if len(data) < 8 or _number(data, 0) != DICTIONARY_FRAME:
        return None, 0
    stop = 8 + _number(data, 4)
    if stop > len(data):
        raise Damaged("cut off in the dictionary")
    raw = data[8:stop].tobytes()
    if struct.unpack_from("<I", raw.ljust(4, b"\0"))[0] == FRAME:
        raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
    return zstandard.ZstdCompressionDict(raw), stop


def records_of(content: bytes) -> Iterator[tuple[int, Record | None, str | None]]:
    """(offset, record, None) or (offset, None, problem) of every record of an archive.

    After a damaged record the next frame is read; after damage to the frames themselves nothing is.
    """
    data = memoryview(content)
    at = 0
    try:
        dictionary, at = dictionary_of(data)
        press = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
        while at < len(data):
            number = _number(data, at)
            if SKIPPABLE <= number <= SKIPPABLE_LAST:
                at += 8 + _number(data, at + 4)
                continue
            stop = frame_stop(data, at)
            try:
                one = press.decompressobj()
                text = one.decompress(data[at:stop])
                if not one.eof:
                    raise Damaged("frame without end")
                found = read_record(text), None
            except (zstandard.ZstdError, Damaged, UnicodeDecodeError) as e:
                found = None, str(e)
            yield at, *found
            at = stop
    except (zstandard.ZstdError, Damaged) as e:
        yield at, None, str(e)


# -- writing -------------------------------------------------------------------

def learned(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample in an order given by a hash; empty where zstandard can learn none."""
    html = F.col("html").cast("binary")
    rows = pages.where(F.octet_length(html).between(1, SAMPLE_BYTES)).select(html.alias("html"))
    rows = rows.orderBy(F.xxhash64("html"), "html").limit(SAMPLE_ROWS).toArrow()
    samples = [http_head(len(x)) + x for x in rows.column("html").to_pylist()]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def _record(row: dict, date: str, more: str) -> bytes:
    payload, url = row["html"] or b"", uri(row["url"])
    fields = [
        ("WARC-Type", "response" if row["response"] else "revisit"),
        ("WARC-Record-ID", record_id(row["page_id"], row["digest"], more)),
        ("WARC-Date", date), ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if row["response"]:
        return record_bytes(fields, http_head(len(payload)) + payload)
    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(row["head"], row["digest"])), ("WARC-Refers-To-Target-URI", uri(row["head_url"]))]
    return record_bytes(fields, http_head(row["n_bytes"]))


def _archives(sent, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        raw = sent.value
        kind = zstandard.ZstdCompressionDict(raw) if raw else None
        if kind:
            kind.precompute_compress(level=LEVEL)
        press = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, dict_data=kind)
        task, n = TaskContext.get().partitionId(), 0
        front = leading_frame(raw) if raw else b""
        frames, held = [front], 0

        def file() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join(frames)], pa.binary())], names=["value"])

        for batch in slices(batches, "html", BATCH_TEXT):
            for row in batch.to_pylist():
                row["digest"] = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                n += 1
                frames.append(press.compress(_record(row, date, "" if row["response"] else f":{task}-{n}")))
                held += len(frames[-1])
                if held >= FILE_BYTES:
                    yield file()
                    frames, held = [front], 0
        if held:
            yield file()

    return run


def _digests(pages: DataFrame) -> DataFrame:
    """Pages with ``key`` (equal for equal payloads), ``sha1`` and ``n_bytes``."""
    html = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    return rows.select("*", F.sha2("html", 256).alias("key"), F.sha1("html").alias("sha1"), F.octet_length("html").cast("long").alias("n_bytes"))


def with_roles(pages: DataFrame) -> DataFrame:
    """Every page as a record to write: page_id, url, html (of responses), sha1, n_bytes, response, head, head_url."""
    rows = _digests(pages)
    each = rows.groupBy("key", "page_id", "url").agg(F.count("*").alias("n"))
    heads = materialise(
        each.groupBy("key").agg(F.max(F.struct("page_id", "url", "n")).alias("top"), F.sum("n").alias("copies")).where("copies > 1")
        .select("key", F.col("top.page_id").alias("head"), F.col("top.url").alias("head_url"), F.col("top.n").alias("n")),
        "warc-heads",
    )
    joined = rows.join(heads, "key", "left")
    is_top = F.col("page_id").eqNullSafe(F.col("head")) & F.col("url").eqNullSafe(F.col("head_url"))
    single = F.col("n").isNull() | (is_top & (F.col("n") == 1))
    columns = ["page_id", "url", "html", "sha1", "n_bytes", "response", "head", "head_url"]

    def record(response: Column) -> list[Column | str]:
        return ["page_id", "url", F.when(response, F.col("html")).otherwise(F.lit(b"")).alias("html"), "sha1", "n_bytes", response.alias("response"), "head", "head_url"]

    plain = joined.where(single | ~is_top).select(*record(single))
    # Rows that are all alike and all on top: one keeps the payload, the others are only counted.
    alike = joined.where(~single & is_top).groupBy("key", "page_id", "url", "sha1", "n_bytes", "head", "head_url", "n").agg(F.min("html").alias("html"))
    alike = alike.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    return plain.unionByName(alike.select(*record(F.col("copy") == 1))).select(*columns)


def write_archives(pages: DataFrame, folder: str, date: str | None = None) -> None:
    """Write a record per page into archives below ``folder``."""
    spark = ship(pages.sparkSession)
    sent = spark.sparkContext.broadcast(learned(pages))  # DICTIONARY bytes
    date = date or time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
    (
        with_roles(pages).mapInArrow(_archives(sent, date), "value binary").select(F.col("value").cast("string").alias("value"))
        .write.option("lineSep", ENDING).option("compression", "none").option("maxRecordsPerFile", 1).text(folder)
    )


# -- reading -------------------------------------------------------------------

def _row(path: str, offset: int, record: Record | None, problem: str | None) -> dict:
    row = {c.split()[0]: None for c in RECORDS.split(", ")} | {"path": path, "offset": offset, "problem": problem}
    if record is None:
        return row
    fields = record.fields
    try:
        refers = fields.get("warc-refers-to")
        row |= {"page_id": page_of(fields["warc-record-id"]), "refers_to": page_of(refers) if refers else None}
    except Damaged as e:
        row["problem"] = str(e)
    return row | {
        "record_type": fields["warc-type"], "record_id": fields["warc-record-id"], "target_uri": fields.get("warc-target-uri"),
        "warc_date": fields["warc-date"], "payload_bytes": record.payload_bytes, "payload_digest": record.digest,
        "payload": record.payload,
    }


def _records(strict: bool, with_payload: bool):
    kinds = [pa.field(n, {"string": pa.string(), "long": pa.int64()}[t]) for n, t in (c.split() for c in RECORDS.split(", "))]
    schema = pa.schema(kinds + ([pa.field("payload", pa.binary())] if with_payload else []))

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{n: r.get(n) for n in schema.names} for r in rows], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows, held = [], 0
                for offset, record, problem in records_of(content.as_py() or b""):
                    rows.append(_row(path, offset, record, problem))
                    if strict and rows[-1]["problem"]:
                        raise Damaged(f"{path} at {offset}: {rows[-1]['problem']}")
                    held += len(record.payload or b"") + 500 if record and with_payload else 500
                    if held > BATCH_TEXT:
                        yield batch_of(rows)
                        rows, held = [], 0
                yield batch_of(rows)

    return run


def read_archives(spark: SparkSession, folder: str, strict: bool = True, with_payload: bool = False) -> DataFrame:
    """Checked records of all archives below a folder; see ``RECORDS``. ``strict`` fails on the first damaged one."""
    files = ship(spark).read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content")
    return files.mapInArrow(_records(strict, with_payload), RECORDS + (", payload binary" if with_payload else ""))


def archived(pages: DataFrame) -> DataFrame:
    """Write the pages below the shared folder and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    folder = work_dir(spark, "warc")
    write_archives(pages, folder)
    return read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
