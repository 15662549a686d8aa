"""Removal of repeated strings by suffix arrays of shards.

Every string of ``LENGTH`` bytes belongs to the least hash of the ``GRAM``-byte strings in
it, so equal strings belong to the same hash wherever they stand. Neighbouring strings of one hash form
a passage. Passages whose hash occurs once, also inside them, are unique and go no further. Equal
passages are counted, and every string in a passage that occurs twice is repeated. The
distinct passages of a hash then meet in a shard, whose suffix array (``induced``) with
its permuted common prefixes shows which strings stand in two of them.

A hash with more than ``HOT`` distinct passages, as that of a line which a third of all
documents hold, or with more than ``SHARD_BYTES`` of them, is not gathered: the digests of its strings are counted one by one
instead, aggregated in every task before their shuffle.

Strings never cross documents, are judged on the input, and every byte that a repeated
string covers goes.

Defined cases: a null or empty text keeps nothing and loses nothing; texts shorter than
``LENGTH`` stay. Rows with equal id and text are two documents that repeat each other.
Null ids are kept. An empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docindex.llm.common import id_and_text, mixed, ship, slices, text_bytes, text_hash
from docindex.llm.induced import common_prefixes, suffix_array
from docindex.workspace import materialise

LENGTH = 400
GRAM = 48
#: Strings of one passage; longer stretches of one hash, as in endless repetitions, are cut.
PASSAGE = 1 << 14
HOT = 3_000
#: Bytes of a shard: some 60 times as much memory.
SHARD_BYTES = 3 << 20
BATCH_TEXT = 2 << 20

PASSAGES = "doc_id long, text_print long, key long, low long, high long, start int, strings int, tied boolean"
TEXTS = "key long, hot boolean, copies long, doc_id long, text_print long, start int, body binary"
SPANS = "doc_id long, text_print long, start int, stop int"
STRINGS = "low long, high long, doc_id long, text_print long, at int"
CLEANED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string"

BASE = 0x9E3779B97F4A7C15
# The value of BASE times which is 1, modulo 2 ** 64.
INVERSE = pow(BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out)


class _Powers:
    up = np.empty(0, np.uint64)
    down = np.empty(0, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(BASE, n), _powers(INVERSE, n)
        return cls.up[:n], cls.down[:n]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all strings of GRAM bytes."""
    n = len(data)
    up, down = _Powers.upto(n + 1)
    letters = mixed(np.arange(1, 257, dtype=np.uint64))
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters[data] * up[:n], dtype=np.uint64)])
        return mixed((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])


def _sliding(values: np.ndarray, need: int, pick) -> np.ndarray:
    """``pick`` over every ``need`` values in a row, by doubling."""
    width = 1
    while width < need:
        step = min(width, need - width)
        values = pick(values[:-step], values[step:])
        width += step
    return values


def passages(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts one after the other: row, start in the row, number of strings, hash of every passage, and
    whether its least gram may stand in it twice, so that its own strings may repeat each other.
    """
    if len(data) < LENGTH:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64), np.empty(0, bool))
    grams, need = gram_hashes(data), LENGTH - GRAM + 1
    keys = _sliding(grams, need, np.minimum)
    lengths = np.diff(borders)
    row = np.repeat(np.arange(len(lengths)), lengths)[: len(keys)]
    place = np.arange(len(keys)) - borders[row]
    inside = place + LENGTH <= lengths[row]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (row[1:] != row[:-1]) | ~inside[:-1]
    new &= inside
    at = np.arange(len(keys))
    new |= inside & ((at - np.maximum.accumulate(np.where(new, at, 0))) % PASSAGE == 0)
    starts = np.flatnonzero(new)
    ends = np.flatnonzero(inside & np.append(new[1:] | ~inside[1:], True))
    # Grams that are the least of some string; two equal ones of one passage that follow each other are at most
    # ``need`` apart: further apart, a string between them would have neither. At ``need`` they share no string.
    padded = np.concatenate([np.zeros(need - 1, np.uint64), keys, np.zeros(need - 1, np.uint64)])
    spots = np.flatnonzero(grams == _sliding(padded, need, np.maximum))
    pair = (grams[spots[1:]] == grams[spots[:-1]]) & (np.diff(spots) <= need)
    first, second = spots[:-1][pair], np.append(spots[1:][pair], len(data) * 2)
    tied = second[np.searchsorted(first, starts)] <= ends + need - 1
    return row[starts], place[starts], ends - starts + 1, keys[starts], tied


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    digest = xxhash.xxh3_128_digest
    for batch in slices(batches, "text", BATCH_TEXT):
        data, borders = text_bytes(batch.column("text"))
        rows, starts, strings, keys, tied = passages(data, borders)
        raw, begin = data.tobytes(), (borders[rows] + starts)
        bodies = b"".join([digest(raw[a:b]) for a, b in zip(begin.tolist(), (begin + strings + LENGTH - 1).tolist())])
        pairs = np.frombuffer(bodies, np.int64).reshape(-1, 2)
        take = pa.array(rows)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(take), batch.column("text_print").take(take), pa.array(keys.view(np.int64)),
                pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1])),
                pa.array(starts.astype(np.int32)), pa.array(strings.astype(np.int32)), pa.array(tied),
            ],
            names=["doc_id", "text_print", "key", "low", "high", "start", "strings", "tied"],
        )


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of the passages that are listed beside each document."""
    for batch in batches:
        out: dict[str, list] = {c.split()[0]: [] for c in TEXTS.split(", ")}
        for doc_id, text_print, text, wanted in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_print", "text", "wanted"))):
            raw = text.encode()
            for w in wanted:
                values = (w["key"], w["hot"], w["copies"], doc_id, text_print, w["start"], raw[w["start"] : w["start"] + w["strings"] + LENGTH - 1])
                for column, value in zip(out.values(), values):
                    column.append(value)
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))


def repeated(bodies: list[bytes]) -> list[np.ndarray]:
    """For each passage the starts of strings that also start elsewhere in the shard.

    >>> a, b = bytes(range(250)) * 2, b"x" + bytes(range(250)) * 2
    >>> [len(x) for x in repeated([a, b])]
    [101, 101]
    """
    parts = [np.frombuffer(b, np.uint8) for b in bodies]
    lengths = np.array([len(p) for p in parts])
    data = np.full(int((lengths + 1).sum()), 0xFF, np.uint8)
    begins = np.cumsum(lengths + 1) - lengths - 1
    for part, begin in zip(parts, begins.tolist()):
        data[begin : begin + len(part)] = part
    ends = np.repeat(begins + lengths, lengths + 1)
    array = suffix_array(data, LENGTH)
    before, common = common_prefixes(data, array, LENGTH)
    # A common prefix counts as far as both passages reach.
    at = np.flatnonzero(common >= LENGTH)
    at = at[(ends[at] - at >= LENGTH) & (ends[before[at]] - before[at] >= LENGTH)]
    twice = np.zeros(len(data), bool)
    twice[at] = twice[before[at]] = True
    return [np.flatnonzero(twice[b : b + n]) for b, n in zip(begins.tolist(), lengths.tolist())]


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """Bytes that strings at these sorted starts cover, joined where they touch."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > LENGTH)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), (starts[np.append(cut, len(starts) - 1)] + LENGTH).tolist()))


def _shard(table: pa.Table) -> pa.Table:
    rows: list[tuple] = []
    columns = [table.column(c).to_pylist() for c in ("doc_id", "text_print", "start", "copies", "body")]
    for doc_id, text_print, start, copies, strings in zip(*columns[:4], repeated(columns[4])):
        if copies == 1:  # passages with copies are repeated as a whole
            rows += [(doc_id, text_print, start + a, start + b) for a, b in _runs(strings)]
    kinds = {"doc_id": pa.int64(), "text_print": pa.int64(), "start": pa.int32(), "stop": pa.int32()}
    return pa.table([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 4, kinds.values())], names=list(kinds))


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of all strings of passages."""
    import xxhash

    digest = xxhash.xxh3_128_digest
    for batch in batches:
        for doc_id, text_print, start, body in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_print", "start", "body"))):
            n = len(body) - LENGTH + 1
            pairs = np.frombuffer(b"".join([digest(body[i : i + LENGTH]) for i in range(n)]), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1])),
                    pa.array([doc_id] * n, pa.int64()), pa.array([text_print] * n, pa.int64()), pa.array(np.arange(start, start + n, dtype=np.int32)),
                ],
                names=["low", "high", "doc_id", "text_print", "at"],
            )


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans"))):
            raw, kept, at = text.encode(), [], 0
            runs = _joined([(s["start"], s["stop"]) for s in spans or []])
            for start, stop in runs:
                kept.append(raw[at:start])
                at = stop
            kept.append(raw[at:])
            rest = b"".join(kept)
            rows.append((doc_id, len(raw), len(raw) - len(rest), len(runs), hashlib.sha256(rest).hexdigest(), rest.decode(errors="ignore"), rest))
        columns = list(zip(*rows)) or [()] * 7
        kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text", "kept"])


def _beside(texts: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Join lists by document to the texts."""
    side = lists.withColumnsRenamed({"doc_id": "_id", "text_print": "_print"})
    return texts.join(side, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_print") == F.col("_print")), how)


def _hot(distinct: DataFrame) -> DataFrame:
    """Whether a hash has too many or too long distinct passages for one shard: key, hot."""
    n_bytes = F.sum(F.col("of.strings").cast("long") + (LENGTH - 1))
    return distinct.groupBy("key").agg(((F.count("*") > HOT) | (n_bytes > SHARD_BYTES)).alias("hot"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Byte spans covered by repeated strings: doc_id, text_print, start, stop; they may overlap."""
    spark = ship(docs.sparkSession)
    texts = id_and_text(docs).withColumn("text_print", text_hash())
    found = materialise(texts.where(F.octet_length("text") >= LENGTH).mapInArrow(_found, PASSAGES), "passages")
    body = F.struct("low", "high")
    keys = (
        found.groupBy("key").agg(F.count("*").alias("n"), (F.min(body) != F.max(body)).alias("differ"), F.max("tied").alias("tied"))
        .where("n > 1 or tied").select("key", (F.col("differ") | (F.col("n") == 1)).alias("differ"))
    )
    shared = found.join(keys, "key")
    stop = F.col("start") + F.col("strings") + (LENGTH - 1)
    where = F.struct("doc_id", "text_print", "start", "strings")
    distinct = materialise(
        shared.where("differ").groupBy("key", "low", "high").agg(F.count("*").alias("copies"), F.min(where).alias("of")), "distinct-passages"
    )
    whole = shared.where("not differ").select("doc_id", "text_print", "start", stop.cast("int").alias("stop"))
    copied = distinct.where("copies > 1").select("key", "low", "high")
    copies = shared.where("differ").join(copied, ["key", "low", "high"], "left_semi").select("doc_id", "text_print", "start", stop.cast("int").alias("stop"))
    # The texts of distinct passages, one of each.
    of = distinct.join(_hot(distinct), "key").select("key", "hot", "copies", "of.*")
    listed = of.groupBy("doc_id", "text_print").agg(F.collect_list(F.struct("key", "hot", "copies", "start", "strings")).alias("wanted"))
    listed = materialise(listed, "wanted-passages")
    bodies = materialise(
        _beside(texts, listed, "inner").select("doc_id", "text_print", "text", "wanted").mapInArrow(_bodies, TEXTS),
        "passage-texts",
    )
    size = bodies.where("not hot").agg(F.sum(F.octet_length("body"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // SHARD_BYTES + 1)
    sharded = (
        bodies.where("not hot").withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
        .select("shard", "doc_id", "text_print", "start", "copies", "body").groupBy("shard").applyInArrow(_shard, SPANS)
    )
    strings = bodies.where("hot").mapInArrow(_strings, STRINGS)
    again = strings.groupBy("low", "high").agg(F.count("*").alias("n")).where("n > 1").select("low", "high")
    single = strings.join(again, ["low", "high"], "left_semi").select("doc_id", "text_print", F.col("at").alias("start"), (F.col("at") + LENGTH).alias("stop"))
    return whole.unionByName(copies).unionByName(sharded).unionByName(single)


def cleaned(docs: DataFrame, with_bytes: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, text (what is left), and its exact bytes if asked for.

    A removed run may begin or end inside a character; ``text`` goes without the rest of such a character.
    """
    ship(docs.sparkSession)
    texts = id_and_text(docs).withColumn("text_print", text_hash())
    spans = repeated_spans(docs).groupBy("doc_id", "text_print").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    beside = _beside(texts, materialise(spans, "repeated-spans"), "left").select("doc_id", "text", "spans")
    out = beside.mapInArrow(_cleaned, CLEANED + ", kept binary")
    return out if with_bytes else out.drop("kept")
