"""Index tables: documents written to and read from partitioned Parquet.

Layout below a root: ``_try=/_index=/_type=/_kind=/_batch=/_writer=``. A write only appends files
below a folder of its own and needs no shuffle unless a layout option asks for one; it exists
from its entry in the commit log (``log``) on. ``_batch`` gives the order of writes, ``_writer``
names the write itself. ``_kind`` says what a segment holds:

* ``unique``   ids were assigned here (or the index was compacted): no id repeats
* ``given``    the caller chose the ids, so a later document may replace one
* ``rejected`` rows that could not become documents, with their reason

What a document replaces is found once, when its write commits: a join of ids alone, with
those committed parts whose range of ids meets the write's. The replaced rows are stored as
bitmaps over sequence numbers. A read of segments from which nothing was taken out is a plain
scan, however many there are; of the others, a row is kept or not by its bit.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from docindex.functions import records
from docindex.locator import Locator
from docindex.mapping import mapping_to_struct, merged, routing_path, struct_to_mapping, typed_columns
from docindex.operators.filters import compile_filter, query_string
from docindex.sources import catalog, log
from docindex.sources.log import Part, Segment
from docindex.workspace import materialise

# Target used where a JSON record names none.
DEFAULT_INDEX = "hadoop"
DEFAULT_TYPE = "streaming_record"

PARTITIONING = ("_index", "_type", "_kind", "_batch", "_writer")
STORED = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("_routing", T.StringType()),
    T.StructField("_shard", T.IntegerType()),
    T.StructField("_seq", T.LongType()),
    T.StructField("_source", T.StringType()),
    T.StructField("_reason", T.StringType()),
])
PARTITION_COLUMNS = T.StructType([
    T.StructField("_try", T.StringType()),
    T.StructField("_index", T.StringType()),
    T.StructField("_type", T.StringType()),
    T.StructField("_kind", T.StringType()),
    T.StructField("_batch", T.LongType()),
    T.StructField("_writer", T.StringType()),
])
# Bytes of a bitmap, of 32,768 rows; bytes of bitmaps that a join sends to every task.
BITMAP, SENT_BITS = 4096, 32 << 20
# Files of one folder that are sought one by one; Spark looks for as many paths before it starts a job for them.
NAMED_FILES = 32
# Where a document stands in the order of all writes.
AGE = ("_batch", "_writer", "_seq")
RESERVED = set(STORED.names) | set(PARTITION_COLUMNS.names)
DOCUMENT = ["_index", "_type", "_id", "_routing", "_shard", "_batch", "_writer", "_seq", "_source"]


@dataclass(frozen=True)
class WriteResult:
    """What a finished write did (the load's metrics)."""

    batch: int
    records: int
    bytes: int
    rejected: int
    seconds: float

    @property
    def records_per_second(self) -> float:
        return self.records / self.seconds if self.seconds else 0.0


# -- documents from records --------------------------------------------------

def record_documents(
    df: DataFrame,
    locator: Locator | str,
    id_field: str | None = None,
    id_pos: int | None = None,
    as_text: bool = False,
    routing_field: str | None = None,
) -> DataFrame:
    """Rows as documents of one fixed target; a row without its id is rejected."""
    index, doc_type = Locator.of(locator).target
    if id_pos is not None:
        id_field = df.columns[id_pos]
    source = records.text_document(df.columns) if as_text else records.typed_document(df.schema)
    doc_id, reason = _declared_id(None if id_field is None else F.col(records._q(id_field)).cast("string"))
    routing = F.col(records._q(routing_field)).cast("string") if routing_field else _null()
    typed = [F.col(records._q(f.name)) for f in df.schema.fields if not as_text and _storable(f.dataType)]
    clash = RESERVED & {f.name for f in df.schema.fields}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are reserved")
    return df.select(
        F.lit(index).alias("_index"), F.lit(doc_type).alias("_type"), doc_id.alias("_id"),
        routing.alias("_routing"), source.alias("_source"), reason.alias("_reason"), *typed,
    )


def json_record_documents(
    df: DataFrame,
    locator: Locator | str,
    column: str | None = None,
    id_field: str | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """A column of JSON texts as documents of one fixed target, re-typed and compacted."""
    index, doc_type = Locator.of(locator).target
    text = F.col(records._q(column or df.columns[0]))
    shaped = df.where(text.isNotNull()).select(
        text.alias("_line"),
        (records.retyped(text, schema) if schema is not None else records.compacted(text)).alias("_json"),
    )
    doc_id, reason = _declared_id(None if id_field is None else records.field_of(F.col("_json"), id_field))
    reason = F.when(F.col("_json").isNull(), F.lit("not a JSON object")).otherwise(reason)
    return shaped.select(
        F.lit(index).alias("_index"), F.lit(doc_type).alias("_type"), doc_id.alias("_id"),
        _null().alias("_routing"),
        F.when(reason.isNull(), F.col("_json")).otherwise(F.col("_line")).alias("_source"),
        reason.alias("_reason"),
    )


def json_documents(
    df: DataFrame,
    locator: Locator | str | None = None,
    column: str | None = None,
    index_field: str | None = "_index",
    type_field: str | None = "_mapping",
    id_fields: tuple[str, ...] = ("_id",),
    routing_field: str | None = "_routing",
) -> DataFrame:
    """A column of JSON texts as documents; each may name its own target, id and routing.

    A field given as None is not looked for. The text is stored unchanged. What
    is no JSON object is rejected.
    """
    index, doc_type = (DEFAULT_INDEX, DEFAULT_TYPE) if locator is None else Locator.of(locator).target
    text = F.col(records._q(column or df.columns[0]))
    m = F.col("_m")
    parsed = df.select(text.alias("_source"), records.members(text).alias("_m")).select(
        "_source", "_m", records.is_document(m).alias("_valid"))

    def member(name: str | None, default: Column) -> Column:
        return default if name is None else records.member_or(m, name, default)

    target = F.when(F.col("_valid"), member(index_field, F.lit(index))).otherwise(F.lit(index))
    kind = F.when(F.col("_valid"), member(type_field, F.lit(doc_type))).otherwise(F.lit(doc_type))
    doc_id = reduce(lambda rest, name: member(name, rest), reversed(id_fields), _null())
    blank = (F.trim(target) == "") | (F.trim(kind) == "")
    reason = F.when(~F.col("_valid"), F.lit("not a JSON object")).when(blank, F.lit("blank target"))
    return parsed.select(
        F.when(blank, F.lit(index)).otherwise(target).alias("_index"),
        F.when(blank, F.lit(doc_type)).otherwise(kind).alias("_type"),
        doc_id.alias("_id"),
        member(routing_field, _null()).alias("_routing"),
        F.col("_source"),
        reason.alias("_reason"),
    )


def _null() -> Column:
    return F.lit(None).cast("string")


def _declared_id(value: Column | None) -> tuple[Column, Column]:
    if value is None:
        return _null(), _null()
    return value, F.when(value.isNull(), F.lit("no id"))


def _storable(dtype: T.DataType) -> bool:
    return not isinstance(dtype, T.VariantType | T.NullType)


# -- writing -----------------------------------------------------------------

def write_documents(
    docs: DataFrame,
    root: str,
    mapping: dict | None = None,
    batch: int | None = None,
    writer: str | None = None,
    replace_target: tuple[str, str] | None = None,
    shards: int | None = None,
    salt: int = 1,
    rebalance: bool = False,
    bulk_size: int | None = None,
    rejects: str | None = None,
    targets: list[tuple[str, str]] | None = None,
) -> WriteResult:
    """Add documents to their indices as one batch.

    ``mapping``    of all documents; without it each target's stored mapping is used
    ``writer``     a name for this write: repeating it replaces its earlier attempt,
                   in the same place of the order, and nothing else
    ``shards``     place rows by routing value; ``salt`` spreads one busy routing
                   value over several tasks without changing its shard number
    ``rebalance``  one shuffle by target, split and merged by size, for few large
                   files; without it each task writes a file per target it meets
    ``bulk_size``  at most this many documents per file
    ``replace_target`` the one (index, type) of all documents, whose earlier ones go
    ``rejects``    also write the rejected lines as JSON to this path
    ``targets``    the only targets that documents name, if known
    """
    spark = docs.sparkSession
    if batch is None:
        batch = log.claim(spark, root, writer)
    name, attempt = writer or uuid.uuid4().hex, f"_try={uuid.uuid4().hex}"
    parts = [[(None, mapping)]] if mapping is not None else _mapped_parts(spark, root, targets)
    started = time.monotonic()
    numbers = []
    if len(parts) > 1:
        # Documents of targets with differing types of one field go to files of their own; the input runs once.
        docs = materialise(docs, "mapped-input")
    for k, part in enumerate(parts):
        some = docs if len(parts) == 1 else docs.where(_in_part(parts, k))
        rows = _numbered(some, batch, name, part)
        if shards:
            rows = _placed(rows, shards, salt)
        elif rebalance:
            rows = rows.hint("rebalance", "_index", "_type")
        numbers.append(_written(rows, f"{root}/{attempt}", bulk_size))
    total = {c: sum(n[c] for n in numbers) for c in ("records", "bytes", "rejected")}
    written = _parts_of(spark, root, attempt, numbers)
    _commit(spark, root, log.Entry(batch, name, tuple(written), replaces=(replace_target,) if replace_target else ()))
    done = WriteResult(batch=batch, seconds=time.monotonic() - started, **total)
    if rejects is not None and done.rejected:
        read_rejects(spark, root, batch=batch).write.mode("append").json(rejects)
    return done


def _written(rows: DataFrame, path: str, bulk_size: int | None = None, options: dict | None = None) -> dict:
    seen = Observation("write")
    ok, given = F.col("_kind") != catalog.REJECTED, F.when(F.col("_kind") == "given", F.col("_id"))
    rows = rows.observe(
        seen,
        F.count(F.when(ok, 1)).alias("records"),
        F.coalesce(F.sum(F.when(ok, F.octet_length("_source"))), F.lit(0)).alias("bytes"),
        F.count(F.when(~ok, 1)).alias("rejected"),
        F.min(given).alias("low"), F.max(given).alias("high"),
    )
    # For files of a few documents, starting a compressor costs more than it saves.
    out = rows.write.mode("append").options(**(({} if bulk_size else {"compression": "zstd"}) | (options or {})))
    if bulk_size:
        out = out.option("maxRecordsPerFile", bulk_size)
    out.partitionBy(*PARTITIONING).parquet(path)
    return seen.get


def _parts_of(spark: SparkSession, root: str, attempt: str, numbers: list[dict]) -> list[Part]:
    """What a write put into its folder. With one segment the write has counted it; else its files are counted."""
    files: dict[Segment, list[str]] = {}
    for name in log.Folder(spark, root).data_files(attempt):
        index, doc_type, kind, batch, writer = (unquote(p.partition("=")[2]) for p in name.split("/")[-6:-1])
        files.setdefault(Segment(index, doc_type, kind, int(batch), writer), []).append(name)
    if len(files) == 1 and len(numbers) == 1:
        ((segment, names),) = files.items()
        (n,) = numbers
        return [Part(segment, tuple(names), n["records"] + n["rejected"], n["low"], n["high"])]
    if not files:
        return []
    given = F.when(F.col("_kind") == "given", F.col("_id"))
    rows = _scan(spark, root, T.StructType([]), [f for names in files.values() for f in names])
    counts = {
        (r["_index"], r["_type"], r["_kind"]): r
        for r in rows.groupBy("_index", "_type", "_kind").agg(F.count("*").alias("n"), F.min(given).alias("low"), F.max(given).alias("high")).collect()
    }
    found = []
    for s, names in files.items():
        r = counts[s.index, s.type, s.kind]
        found.append(Part(s, tuple(names), r["n"], r["low"], r["high"]))
    return found


def _commit(spark: SparkSession, root: str, entry: log.Entry) -> None:
    own = {p.segment: p for p in entry.parts}
    asked = []

    def against(others: dict[Segment, Part]) -> log.Deletion | None:
        found = _replaced(spark, root, own, others, first=not asked)
        asked.append(True)
        return None if found is None else _bitmaps(spark, root, found)

    log.commit(spark, root, entry, against)


def _replaced(spark: SparkSession, root: str, own: dict[Segment, Part], others: dict[Segment, Part], first: bool) -> DataFrame | None:
    """Rows that a write takes out of other parts, or they out of it, or that it repeats itself: target, attempt, sequence number.

    Only ids are read, and of the others those within the write's range; a busy id is one row per task.
    """
    given = {s: p for s, p in own.items() if s.kind == "given"}
    if not given:
        return None
    empty = T.StructType([])
    row = ["_index", "_type", "_try", "_seq"]
    target = ["_index", "_type", "_id"]
    mine = _scan(spark, root, empty, _files(given)).select(*row, "_id")
    meets = {
        s: p for s, p in others.items() if s.kind != catalog.REJECTED and any(
            (s.index, s.type) == (g.index, g.type) and (p.low is None or p.low <= q.high and q.low <= p.high) for g, q in given.items())
    }
    age = max((g.batch, g.writer) for g in given)
    older = {s: p for s, p in meets.items() if (s.batch, s.writer) < age}
    newer = {s: p for s, p in meets.items() if (s.batch, s.writer) > age and s.kind == "given"}
    found = []
    if first:
        repeats = mine.groupBy(*target).agg(F.max("_seq").alias("_last"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
        found.append(mine.join(repeats, target).where("_seq < _last").select(row))
    if older:
        low, high = min(p.low for p in given.values()), max(p.high for p in given.values())
        ids = _standing(spark, root, empty, older).where(F.col("_id").between(low, high))
        found.append(ids.join(mine.select(target).distinct(), target, "left_semi").select(row))
    if newer:
        ids = _scan(spark, root, empty, _files(newer)).select(target).distinct()
        found.append(mine.join(ids, target, "left_semi").select(row))
    return reduce(DataFrame.unionByName, found) if found else None


def _bitmaps(spark: SparkSession, root: str, rows: DataFrame) -> log.Deletion | None:
    """Store rows as bitmaps over their sequence numbers; None if there are none."""
    path = f"_deletes/{uuid.uuid4().hex}"
    bucket = F.bitmap_bucket_number("_seq").alias("_bucket")
    bits = rows.groupBy("_index", "_type", "_try", bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_seq")).alias("_bits"))
    bits.write.parquet(f"{root}/{path}")
    stored = spark.read.schema(catalog.BITMAPS).parquet(f"{root}/{path}")
    # One row for each place that loses documents.
    counts = stored.groupBy("_index", "_type", "_try").agg(F.sum(F.bitmap_count("_bits")).alias("n"), F.count("*").alias("buckets")).collect()
    if not counts:
        log.Folder(spark, root).delete(path)
        return None
    return log.Deletion(path, tuple(((r["_index"], r["_type"], r["_try"]), r["n"]) for r in counts), sum(r["buckets"] for r in counts))


def _mapped_parts(spark: SparkSession, root: str, targets: list[tuple[str, str]] | None) -> list[list[tuple]]:
    """Stored mappings as lists of (targets, mapping), split so that a field has one type in each list."""
    known = {t: m for t, m in catalog.get_mappings(spark, root).items() if targets is None or t in targets}
    alike: dict[str, tuple[list, dict]] = {}
    for target, mapping in sorted(known.items()):
        alike.setdefault(json.dumps(mapping, sort_keys=True), ([], mapping))[0].append(target)
    parts: list[tuple[dict, list]] = []
    for entry in alike.values():
        fields = {f.name: f.dataType for f in mapping_to_struct(entry[1]).fields}
        for types, entries in parts:
            if all(types.get(n, t) == t for n, t in fields.items()):
                types.update(fields)
                entries.append(entry)
                break
        else:
            parts.append((fields, [entry]))
    return [entries for _, entries in parts] or [[]]


def _is_target(targets: list[tuple[str, str]]) -> Column:
    by_type: dict[str, list[str]] = {}
    for index, doc_type in targets:
        by_type.setdefault(doc_type, []).append(index)
    return reduce(lambda a, b: a | b, [(F.col("_type") == t) & F.col("_index").isin(i) for t, i in by_type.items()])


def _in_part(parts: list[list[tuple]], k: int) -> Column:
    """Documents of a part's targets; those without any mapping belong to the first."""
    own = [_is_target([t for targets, _ in part for t in targets]) for part in parts]
    return own[k] if k else ~reduce(lambda a, b: a | b, own[1:])


def write_records(
    df: DataFrame,
    root: str,
    locator: Locator | str,
    id_field: str | None = None,
    id_pos: int | None = None,
    as_text: bool = False,
    mapping: dict | None = None,
    routing_field: str | None = None,
    mode: str = "append",
    **layout,
) -> WriteResult | None:
    """Store rows in one index and type, creating it when absent.

    The locator's ``id`` option names the id column, ``json=true`` says that the
    first column holds documents. ``size`` is accepted; bytes decide the files.
    """
    loc = Locator.of(locator)
    spark = df.sparkSession
    if not _prepare(spark, root, loc, mode):
        return None
    id_field = id_field or loc.id_field
    if loc.option("json") == "true":
        docs = json_record_documents(df, loc, id_field=id_field)
    else:
        docs = record_documents(df, loc, id_field, id_pos, as_text, routing_field)
        if mapping is None and not as_text:
            mapping = struct_to_mapping(df.schema)
    if mapping is not None:
        if mode != "overwrite":
            mapping = merged(catalog.get_mapping(spark, root, *loc.target), mapping)
        catalog.put_mapping(spark, root, *loc.target, mapping)
    target = loc.target if mode == "overwrite" else None
    return write_documents(docs, root, mapping=mapping, replace_target=target, targets=[loc.target], **layout)


def _prepare(spark: SparkSession, root: str, loc: Locator, mode: str) -> bool:
    """Apply a save mode to one target; False when there is nothing to write."""
    if mode not in ("append", "overwrite", "errorifexists", "ignore"):
        raise ValueError(f"unknown mode {mode!r}")
    index, doc_type = loc.target
    if not re.fullmatch(r"[\w.\-]+", index) or not re.fullmatch(r"[\w.\-]+", doc_type):
        raise ValueError("index and type names may hold letters, digits, '_', '-' and '.'")
    if mode in ("append", "overwrite") or not catalog.segments(spark, root, loc):
        return True
    if mode == "errorifexists":
        raise FileExistsError(f"{index}/{doc_type} already holds documents")
    return False


def _numbered(docs: DataFrame, batch: int, writer: str, mappings: list[tuple]) -> DataFrame:
    """Sequence numbers, assigned ids and the typed columns of each target's mapping.

    The sequence number is task number and row number in the task. An assigned
    id is a digest of it and of the write's own name, which is fixed before the
    job starts, so a repeated task gives the same ids again.
    """
    rows = docs.withColumn("_seq", F.monotonically_increasing_id())
    digest = F.sha2(F.concat_ws("|", F.lit(writer), F.col("_seq"), F.col("_source")), 256)
    kind = (
        F.when(F.col("_reason").isNotNull(), F.lit(catalog.REJECTED))
        .when(F.col("_id").isNull(), F.lit("unique"))
        .otherwise(F.lit("given"))
    )
    routing = F.col("_routing")
    typed: dict[str, list[tuple[Column | None, Column]]] = {}
    for targets, mapping in mappings:
        struct = mapping_to_struct(mapping)
        have = set(docs.columns)
        parsed = {} if have.issuperset(struct.names) else dict(
            zip(struct.names, typed_columns(F.col("_source"), mapping)))
        here = None if targets is None else _is_target(targets)
        for f in struct.fields:
            value = F.col(records._q(f.name)).cast(f.dataType) if f.name in have else parsed[f.name]
            typed.setdefault(f.name, []).append((here, value))
        path = routing_path(mapping)
        if path is not None:
            named = records.field_of(F.col("_source"), path)
            routing = F.coalesce(routing, named if here is None else F.when(here, named))
    columns = [_chosen(choices).alias(name) for name, choices in typed.items()]
    return rows.select(
        F.coalesce("_id", digest).alias("_id"), routing.alias("_routing"), F.lit(None).cast("int").alias("_shard"), "_seq",
        "_source", "_reason", *columns,
        "_index", "_type", kind.alias("_kind"), F.lit(batch).cast("long").alias("_batch"), F.lit(writer).alias("_writer"),
    )


def _chosen(choices: list[tuple[Column | None, Column]]) -> Column:
    """The value of the one mapping that a document's target has."""
    if choices[0][0] is None:
        return choices[0][1]
    first, *rest = choices
    return reduce(lambda column, c: column.when(*c), rest, F.when(*first))


def shard_of(routing: Column, doc_id: Column, shards: int) -> Column:
    """Shard number of a document; the id routes it where it names no routing value."""
    return F.pmod(F.xxhash64(F.coalesce(routing, doc_id)), F.lit(shards)).cast("int")


def _placed(rows: DataFrame, shards: int, salt: int) -> DataFrame:
    rows = rows.withColumn("_shard", shard_of(F.col("_routing"), F.col("_id"), shards))
    if salt <= 1:
        return rows.hint("rebalance", "_shard")
    # Bytes decide the number of tasks, however many shards there are.
    rows = rows.withColumn("_spread", F.pmod(F.xxhash64("_id"), F.lit(salt)))
    return rows.hint("rebalance", "_shard", "_spread").drop("_spread")


def bulk_lines(docs: DataFrame) -> DataFrame:
    """Two lines per document, action then source, ready for a bulk request body."""
    action = F.to_json(F.struct(F.struct("_index", "_type", "_id", F.col("_routing").alias("routing")).alias("index")))
    return docs.select(F.concat(action, F.lit("\n"), F.col("_source")).alias("value"))


def export_bulk(docs: DataFrame, path: str, bulk_size: int = 1000) -> None:
    """One text file per bulk request."""
    bulk_lines(docs).write.mode("errorifexists").option("maxRecordsPerFile", bulk_size).text(path)


# -- reading -----------------------------------------------------------------

def read_index(
    spark: SparkSession,
    root: str,
    locator: Locator | str = f"es://{DEFAULT_INDEX}/{DEFAULT_TYPE}",
    query: dict | None = None,
    q: str | None = None,
    tasks: int | None = None,
    versions: bool = False,
    with_place: bool = False,
    routing: str | list[str] | None = None,
) -> DataFrame:
    """Current documents in a locator's scope, with their typed columns.

    ``query`` is a structured filter, ``q`` a free-text one (default: the
    locator's). ``versions=True`` also returns replaced documents, ``with_place``
    the attempt that wrote each, which with its ``_seq`` names a row. ``routing``
    keeps the documents routed by one of some values, by the id where a document
    names none; ``compact(cluster="routing")`` lays them out so that this skips row groups.
    """
    loc = Locator.of(locator)
    state = log.state(spark, root)
    found = {s: p for s, p in catalog.segments(spark, root, loc, state).items() if s.kind != catalog.REJECTED}
    mappings = catalog.get_mappings(spark, root, loc)
    targets = {(s.index, s.type) for s in found}
    structs = {t: mapping_to_struct(mappings[t]) for t in sorted(targets & mappings.keys())}
    typed, differing = _typed_schema(list(structs.values()))
    branches = _branches(found, structs, typed, differing)
    docs = reduce(DataFrame.unionByName, [
        (_scan(spark, root, own, _files(some)) if versions else _standing(spark, root, own, some, state))
        .withColumns({f.name: F.col(records._q(f.name)).cast(f.dataType) for f in typed.fields if f.name in differing})
        for own, some in branches
    ])
    docs = docs.select(*DOCUMENT, *(["_try"] if with_place else []), *map(records._q, typed.names))
    if routing is not None:
        values = [routing] if isinstance(routing, str) else list(routing)
        docs = docs.where(F.col("_routing").isin(values) | F.col("_routing").isNull() & F.col("_id").isin(values))
    q = q if q is not None else loc.option("q")

    def named(name: str) -> Column:
        return _field(typed, name)

    if q not in ("", "*"):
        texts = _text_columns(typed, targets <= mappings.keys() and not differing)
        docs = docs.where(query_string(q, texts, named))
    if query is not None:
        docs = docs.where(compile_filter(query, docs.schema))
    if tasks is None and "tasks" in loc.options:
        tasks = int(loc.option("tasks"))
    # At most so many tasks, made of whole input splits; no document is moved for it.
    return docs if tasks is None else docs.coalesce(tasks)


def _files(parts: dict[Segment, Part]) -> list[str]:
    return [f for p in parts.values() for f in p.files]


def _standing(spark: SparkSession, root: str, typed: T.StructType, found: dict[Segment, Part], state: log.State | None = None) -> DataFrame:
    """Documents of some parts that nothing has taken out.

    Parts without a deletion are scanned as they are. Rows of the others meet the bitmap of their
    bucket of sequence numbers: one short row for up to 32,768 documents, which goes to every
    task unless very many were replaced.
    """
    state = state or log.state(spark, root)
    hit = {place for d in state.deletions for place, _ in d.rows}
    dirty = {s: p for s, p in found.items() if p.place in hit}
    clean = _scan(spark, root, typed, _files({s: p for s, p in found.items() if s not in dirty}))
    if not dirty:
        return clean
    kept = not_deleted(spark, root, _scan(spark, root, typed, _files(dirty)), dirty, state)
    return kept if len(dirty) == len(found) else clean.unionByName(kept)


def scan_parts(spark: SparkSession, root: str, typed: T.StructType, parts: dict[Segment, Part]) -> DataFrame:
    """All rows of some parts, deleted ones too."""
    return _scan(spark, root, typed, _files(parts))


def not_deleted(spark: SparkSession, root: str, rows: DataFrame, parts: dict[Segment, Part], state: log.State | None = None) -> DataFrame:
    """Rows with a place and ``_seq`` whose bit is not set in the bitmaps of some parts."""
    state = state or log.state(spark, root)
    places = {p.place for p in parts.values()}
    bits = catalog.deleted_rows(spark, root, state, places)
    if bits is None:
        return rows
    return _beside_bits(rows, bits, _buckets(state, places), "left").where(F.col("_x_bits").isNull() | ~F.col("_x_set")).select(*rows.columns)


def marked(rows: DataFrame, wanted: DataFrame, buckets: int) -> DataFrame:
    """Rows with a place and ``_seq`` that are among some others, which lie in at most so many buckets; only bitmaps of these move."""
    bucket = F.bitmap_bucket_number("_seq").alias("_bucket")
    bits = wanted.groupBy("_index", "_type", "_try", bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_seq")).alias("_bits"))
    return _beside_bits(rows, bits, buckets, "inner").where("_x_set").select(*rows.columns)


def _buckets(state: log.State, places: set[tuple]) -> int | None:
    """At most so many bitmaps take rows out of some places; None where an entry does not say."""
    known = [d.buckets for d in state.deletions if any(p in places for p, _ in d.rows)]
    return None if None in known else sum(known)


def _beside_bits(rows: DataFrame, bits: DataFrame, buckets: int | None, how: str) -> DataFrame:
    """Rows beside the bitmap of their bucket, with ``_x_set`` for their own bit.

    Bitmaps of up to ``SENT_BITS`` bytes go to every task, so that the rows stay where they are; of others the planner decides.
    """
    names = {c: f"_x{c}" for c in catalog.BITMAPS.names}
    side = bits.withColumnsRenamed(names)
    if buckets is not None and buckets * BITMAP <= SENT_BITS:
        side = F.broadcast(side)
    same = [F.col(c) == F.col(names[c]) for c in ("_index", "_type", "_try")] + [F.bitmap_bucket_number("_seq") == F.col("_x_bucket")]
    place = F.bitmap_bit_position("_seq")
    byte = F.conv(F.hex(F.substring(F.col("_x_bits"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return rows.join(side, reduce(lambda a, b: a & b, same), how).withColumn("_x_set", F.getbit(byte, (place % 8).cast("int")) == 1)


def load(spark: SparkSession, root: str, locator: Locator | str, **options) -> DataFrame:
    """Documents as two text columns, ``doc_id`` and ``contents``."""
    return read_index(spark, root, locator, **options).select(
        F.col("_id").alias("doc_id"), F.col("_source").alias("contents"))


def latest(docs: DataFrame) -> DataFrame:
    """The newest document of every id among several versions: highest batch, then highest sequence number.

    Each task keeps one row per id before the shuffle, so an id that was
    written millions of times sends one row per task.
    """
    newest = Window.partitionBy("_index", "_type", "_id").orderBy(*map(F.desc, AGE))
    return docs.withColumn("_age", F.row_number().over(newest)).where("_age = 1").drop("_age")


def read_rejects(
    spark: SparkSession, root: str, locator: Locator | str = "es://_all", batch: int | None = None
) -> DataFrame:
    """Rows that did not become documents: target, batch, the line and the reason."""
    found = {
        s: p for s, p in catalog.segments(spark, root, locator).items() if s.kind == catalog.REJECTED and batch in (None, s.batch)
    }
    return _scan(spark, root, T.StructType([]), _files(found)).select("_index", "_type", "_batch", "_source", "_reason")


#: Orders that documents can be laid out in, within their target.
CLUSTERS = {None: (), "id": ("_id",), "routing": ("_routing", "_id")}
#: Filters over ids and routing values, sized by what a row group holds.
BLOOM = {"parquet.bloom.filter.enabled#_id": "true", "parquet.bloom.filter.enabled#_routing": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def compact(
    spark: SparkSession,
    source_root: str,
    target_root: str,
    locator: Locator | str = "es://_all",
    cluster: str | None = None,
    row_group_bytes: int | None = None,
) -> None:
    """Rewrite current documents into a new root, where reads need no shuffle.

    ``cluster`` ("routing" or "id") orders them: files and row groups hold narrow ranges, which a
    routed read or one by ids skips by their bounds. A value that most documents share, null too,
    is cut by ids. Ids outside the order are found by Bloom filters. ``row_group_bytes``
    bounds row groups (default: Parquet's).
    """
    if cluster not in CLUSTERS:
        raise ValueError(f"unknown order {cluster!r}")
    found = catalog.segments(spark, source_root, locator)
    if log.state(spark, target_root).version:
        raise FileExistsError(f"{target_root} already holds documents")
    docs = read_index(spark, source_root, locator, q="*")
    typed = [c for c in docs.columns if c not in RESERVED]
    newest = max((s.batch for s in found), default=0)
    rows = docs.select(
        "_id", "_routing", "_shard", "_seq", "_source", _null().alias("_reason"), *typed,
        "_index", "_type", F.lit("unique").alias("_kind"), F.lit(newest).cast("long").alias("_batch"), F.lit("compact").alias("_writer"),
    )
    options = {} if row_group_bytes is None else {"parquet.block.size": str(row_group_bytes)}
    if cluster is None:
        rows = rows.hint("rebalance", "_index", "_type")
    else:
        order = ["_index", "_type", *CLUSTERS[cluster]]
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*PARTITIONING, *CLUSTERS[cluster])
        options |= BLOOM
    # Sequence numbers of several batches may meet in one segment; a new one is their place here.
    rows = rows.withColumn("_seq", F.monotonically_increasing_id())
    attempt = f"_try={uuid.uuid4().hex}"
    numbers = [_written(rows, f"{target_root}/{attempt}", options=options)]
    _commit(spark, target_root, log.Entry(newest, "compact", tuple(_parts_of(spark, target_root, attempt, numbers))))
    kept = {(s.index, s.type) for s in found}
    for (index, doc_type), mapping in catalog.get_mappings(spark, source_root).items():
        if (index, doc_type) in kept:
            catalog.put_mapping(spark, target_root, index, doc_type, mapping)


def _scan(spark: SparkSession, root: str, typed: T.StructType, files: list[str]) -> DataFrame:
    """The named files, which are all that their parts have. No folder is listed, but that of a part with very many files."""
    schema = T.StructType(STORED.fields + typed.fields + PARTITION_COLUMNS.fields)
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{p}" for p in _paths(files)])


def _paths(files: list[str]) -> list[str]:
    """Files by name; more than ``NAMED_FILES`` of a folder by the folder, which a finished write never adds to."""
    folders: dict[str, list[str]] = {}
    for f in sorted(files):
        folders.setdefault(f.rpartition("/")[0], []).append(f)
    return [p for folder, names in folders.items() for p in (names if len(names) <= NAMED_FILES else [folder])]


def _typed_schema(structs: list[T.StructType]) -> tuple[T.StructType, set[str]]:
    """Columns of all mappings in scope, each of the least type that holds all of its types, and the names that have several."""
    fields: dict[str, T.StructField] = {}
    differing = set()
    for struct in structs:
        for f in struct.fields:
            known = fields.setdefault(f.name, f)
            if known.dataType != f.dataType:
                differing.add(f.name)
                fields[f.name] = T.StructField(f.name, common_type(known.dataType, f.dataType))
    return T.StructType(list(fields.values())), differing


#: Numbers from the narrowest to the widest.
NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that two types of one field can be cast to without losing a value: text holds everything.

    >>> common_type(T.LongType(), T.DoubleType()), common_type(T.LongType(), T.StringType())
    (DoubleType(), StringType())
    """
    if a == b:
        return a
    if isinstance(a, NUMBERS) and isinstance(b, NUMBERS):
        wide = max(a, b, key=lambda t: NUMBERS.index(type(t)))
        return T.DoubleType() if isinstance(wide, T.FloatType) else wide
    dates = (T.DateType, T.TimestampNTZType, T.TimestampType)
    if isinstance(a, dates) and isinstance(b, dates):
        return max(a, b, key=lambda t: dates.index(type(t)))
    if isinstance(a, T.ArrayType) or isinstance(b, T.ArrayType):
        inner = common_type(*(t.elementType if isinstance(t, T.ArrayType) else t for t in (a, b)))
        return T.ArrayType(inner) if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType) else T.StringType()
    return T.StringType()


def _branches(
    found: dict[Segment, Part], structs: dict[tuple[str, str], T.StructType], typed: T.StructType, differing: set[str]
) -> list[tuple[T.StructType, dict[Segment, Part]]]:
    """Parts by the types that their files hold: one scan, unless a field differs."""
    branches: dict[str, tuple[T.StructType, dict[Segment, Part]]] = {}
    for segment, part in found.items():
        own = {f.name: f for f in structs.get((segment.index, segment.type), T.StructType([])).fields}
        struct = T.StructType([own.get(f.name, f) if f.name in differing else f for f in typed.fields])
        branches.setdefault(struct.json() if differing else "", (struct, {}))[1][segment] = part
    return list(branches.values()) or [(typed, {})]


def _text_columns(typed: T.StructType, all_mapped: bool) -> list[Column]:
    """The mapped text fields; where documents without a mapping are in scope, all values."""
    names = [f.name for f in typed.fields if isinstance(f.dataType, T.StringType)]
    if names and all_mapped:
        return [F.col(records._q(n)) for n in names]
    values = F.map_values(F.from_json("_source", "map<string,string>"))
    return [F.concat_ws(" ", values)]


def _field(typed: T.StructType, name: str) -> Column:
    """A mapped field's column, or the member of the raw document; dots lead into objects."""
    if name in typed.names:
        return F.col(records._q(name))
    first, *rest = name.split(".")
    if rest and first in typed.names:
        return reduce(lambda column, part: column[part], rest, F.col(records._q(first)))
    path = "$" + "".join(f"['{part}']" for part in (first, *rest))
    return F.coalesce(records.field_of(F.col("_source"), name), F.get_json_object("_source", path)) if rest else records.field_of(F.col("_source"), name)
