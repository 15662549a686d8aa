"""Exact dedup by an exchange of Golomb-coded fingerprints.

Every partition fingerprints its normalised texts, sends each owner (a range of
fingerprints) its sorted distinct values as Rice codes of their gaps, and gets a
bitmap back that marks the values which another block has as well. Only rows
marked there, or repeated within their block, are suspects; their texts are
grouped byte for byte. Copies in a block cost one code, and texts are
pre-aggregated before their shuffle, so a group of any size stays spread.

Defined cases: a null text is empty, and all empty or blank texts are equal. Null
and repeated ids are rows like any other; among rows that also share the id, one
stays. An empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from docindex.llm.common import id_and_text, ship, unused
from docindex.workspace import materialise

#: Characters that a comparison ignores.
BLANK = b" \t\n\v\f\r"
BLANK_PATTERN = r"[\x20\x09-\x0D]+"
#: Rows of a block and fingerprints of an owner; both bound a task's memory.
BLOCK_ROWS = 200_000
OWNER_ROWS = 1 << 21

BLOCK = (
    "block long, owner int, shift int, n int, code binary, doc_ids array<long>, rows array<long>, "
    "place array<int>, points array<long>, digests array<string>"
)
REPLY = "block long, owner int, marked binary"
MEMBER = "doc_id long, row long, points long, text_sha256 string, suspect boolean"


def rice_encode(values: np.ndarray) -> tuple[int, bytes]:
    """Sorted 64-bit values as a first value and Rice codes of the gaps; returns (shift, code).

    A gap is a unary quotient (ones ended by a zero) after a fixed-width remainder;
    remainders and quotients are kept in two runs of bits.

    >>> v = np.array([3, 10, 500, 2**63], np.uint64)
    >>> rice_decode(*rice_encode(v), 4).tolist() == v.tolist()
    True
    """
    gaps = np.diff(values, prepend=np.uint64(0))
    mean = float(values[-1]) / len(values) if len(values) else 1.0
    shift = int(min(63, max(0, np.floor(np.log2(max(mean * 0.69, 1.0))))))
    quotients = (gaps >> np.uint64(shift)).astype(np.int64)
    ends = np.cumsum(quotients + 1) - 1
    unary = np.ones(int(ends[-1]) + 1 if len(ends) else 0, np.uint8)
    unary[ends] = 0
    rest = (gaps & np.uint64((1 << shift) - 1)).astype(">u8").view(np.uint8).reshape(-1, 8)
    bits = np.unpackbits(rest, axis=1)[:, 64 - shift :]
    return shift, np.packbits(np.concatenate([bits.ravel(), unary])).tobytes()


def rice_decode(shift: int, code: bytes, n: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(code, np.uint8))
    wide = np.zeros((n, 64), np.uint8)
    wide[:, 64 - shift :] = bits[: n * shift].reshape(n, shift)
    rest = np.packbits(wide, axis=1).view(">u8").ravel().astype(np.uint64)
    ends = np.flatnonzero(bits[n * shift :] == 0)[:n]
    quotients = np.diff(ends, prepend=-1) - 1
    return np.cumsum((quotients.astype(np.uint64) << np.uint64(shift)) + rest, dtype=np.uint64)


def _blocks(owners: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        ids: list = []
        digests: list[bytes] = []
        points: list[int] = []
        for batch in batches:
            ids += batch.column("doc_id").to_pylist()
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                digests.append(hashlib.sha256(text.translate(None, BLANK)).digest())
                points.append(len(text.decode()))
            if len(ids) >= BLOCK_ROWS:
                yield _block(first, owners, ids, digests, points)
                first += len(ids)
                ids, digests, points = [], [], []
        if ids:
            yield _block(first, owners, ids, digests, points)

    return run


def _block(first_row: int, owners: int, ids: list, digests: list[bytes], points: list[int]) -> pa.RecordBatch:
    """One row per owner. A block is named by the number of its first row."""
    prints = np.frombuffer(b"".join(digests), ">u8").reshape(-1, 4)[:, 0].astype(np.uint64)
    distinct, place = np.unique(prints, return_inverse=True)
    owner = _owner(distinct, owners)
    order = np.argsort(place, kind="stable")
    starts = np.searchsorted(place[order], np.arange(len(distinct) + 1))
    rows = []
    for own, first, last in _runs(owner):
        shift, code = rice_encode(distinct[first:last])
        members = order[starts[first] : starts[last]]
        rows.append((
            first_row, own, shift, last - first, code, [ids[i] for i in members], (members + first_row).tolist(),
            (place[members] - first).tolist(), [points[i] for i in members], [digests[i].hex() for i in members],
        ))
    names = [c.split()[0] for c in BLOCK.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.string())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _owner(prints: np.ndarray, owners: int) -> np.ndarray:
    """Ranges of equal width, in order of the fingerprints."""
    return ((prints >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64)


def _runs(values: np.ndarray) -> list[tuple[int, int, int]]:
    borders = np.flatnonzero(np.diff(values, prepend=-1, append=-1))
    return [(int(values[a]), int(a), int(b)) for a, b in zip(borders[:-1], borders[1:])]


def _replies(frame: pd.DataFrame) -> pd.DataFrame:
    """One owner: which of each block's values another block has as well."""
    parts = [rice_decode(s, c, n) for s, c, n in zip(frame["shift"], frame["code"], frame["n"])]
    values = np.concatenate(parts)
    _, place, times = np.unique(values, return_inverse=True, return_counts=True)
    shared = times[place] > 1
    cuts = np.cumsum([len(p) for p in parts])[:-1]
    return pd.DataFrame({
        "block": frame["block"], "owner": frame["owner"],
        "marked": [np.packbits(s).tobytes() for s in np.split(shared, cuts)],
    })


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            place = np.array(row["place"], np.int64)
            shared = np.unpackbits(np.frombuffer(row["marked"], np.uint8))[: row["n"]].astype(bool)
            shared |= np.bincount(place, minlength=row["n"]) > 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()), pa.array(row["rows"], pa.int64()),
                    pa.array(row["points"], pa.int64()), pa.array(row["digests"], pa.string()), pa.array(shared[place]),
                ],
                names=[c.split()[0] for c in MEMBER.split(", ")],
            )


def exact_groups(docs: DataFrame) -> DataFrame:
    """Each row's group: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the one with the most code points, then the smallest id
    (null last) stays.
    """
    spark = ship(docs.sparkSession)
    texts = id_and_text(docs)
    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), texts.count() // OWNER_ROWS + 1)
    blocks = materialise(texts.mapInArrow(_blocks(owners), BLOCK), "exact-blocks")
    sent = blocks.select("block", "owner", "shift", "n", "code")
    replies = sent.groupBy("owner").applyInPandas(_replies, REPLY)
    members = materialise(
        blocks.drop("code", "shift").join(replies, ["block", "owner"])
        .select("n", "doc_ids", "rows", "place", "points", "digests", "marked").mapInArrow(_members, MEMBER),
        "exact-members",
    )
    suspects = members.where("suspect")
    bodies = (
        texts.join(suspects.select(F.col("doc_id").alias("id")).distinct(), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
        .groupBy(F.regexp_replace("text", BLANK_PATTERN, "").alias("body")).agg(F.count("*").alias("rows"))
        .where("rows > 1").select(F.sha2(F.col("body"), 256).alias("text_sha256"))
    )
    # The order of preference within a group, as one comparable value.
    best = F.struct("points", F.coalesce(-F.col("doc_id"), F.lit(-(1 << 63))).alias("low"), (-F.col("row")).alias("first"))
    groups = (
        suspects.join(bodies, "text_sha256", "left_semi").groupBy("text_sha256")
        .agg(F.count("*").alias("group_size"), F.max(F.struct(best.alias("best"), "doc_id", "row")).alias("top"))
        .select("text_sha256", "group_size", F.col("top.doc_id").alias("top_id"), F.col("top.row").alias("top_row"))
    )
    grouped = F.col("group_size").isNotNull()
    return members.join(groups, "text_sha256", "left").select(
        "doc_id", F.when(grouped, F.col("top_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(grouped, F.col("row") == F.col("top_row")).otherwise(F.lit(True)).alias("kept"), "text_sha256",
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    groups = materialise(exact_groups(docs), "exact-groups")
    a, b, c = unused(docs, 3)
    # Ids that name one row each decide by id alone; the others, seldom any, by id and text.
    unclear = materialise(
        groups.groupBy("doc_id").count().where("count > 1 or doc_id is null").select(F.col("doc_id").alias(a)), "exact-repeated"
    )
    kept = groups.where("kept").select(F.col("doc_id").alias(a), F.col("text_sha256").alias(b))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(a))
    once = docs.join(kept.join(unclear, a, "left_anti").where(F.col(a).isNotNull()).select(a), same, "left_semi")
    if unclear.isEmpty():
        return once
    digest = F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), BLANK_PATTERN, ""), 256)
    row = F.struct(*[F.col(f"`{x}`") for x in docs.columns])
    several = (
        docs.join(unclear, same, "left_semi").withColumn(c, digest).join(kept, same & (F.col(c) == F.col(b)), "left_semi")
        .groupBy("doc_id", c).agg(F.max_by(row, F.char_length(F.coalesce("text", F.lit("")))).alias("row"))
    )
    return once.unionByName(several.select("row.*"))
