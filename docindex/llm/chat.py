"""Chat formatting with collapse of cumulative snapshots.

Logs often hold a conversation many times, each time a few turns longer. A rolling hash
over a conversation's turns names every prefix of it. One row per prefix hash keeps how long
the longest conversation with that prefix is; conversations that a longer one
continues, or an equal one with a smaller id repeats, leave by an anti-join. The rest
is rendered.

The hash has 128 bits, so equal hashes are taken for equal turns. Prefix hashes are
aggregated in every task before their shuffle: a first turn or a conversation that a third of all rows
share is one row per task. A single conversation's turns meet in one row,
as the rendered text does anyway.

Defined cases: rows of one conversation that repeat turn, role and text count once; turns
are ordered by number, role, text, nulls first; a null role is ``unknown``, a null text
empty; rows with a null id are one conversation, which leaves last among equals. ``<|`` in a text is written ``< |``, so no
text can open or close a turn. An empty table gives no rows. Only ``conv_id, turn,
role, text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docindex.llm.common import ship
from docindex.workspace import materialise

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
UNKNOWN = "unknown"

HASHED = "conv_id long, n_turns long, prefixes array<binary>"


def _turns(conversations: DataFrame) -> DataFrame:
    """Per conversation its distinct turns in order."""
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(UNKNOWN)).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return (
        conversations.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
        .groupBy("conv_id").agg(F.sort_array(F.collect_set("turn")).alias("turns"))
    )


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in batches:
        found = []
        for turns in batch.column("turns").to_pylist():
            rolling, hashes = xxhash.xxh3_128(), []
            for turn in turns:
                for part in (turn["role"].encode(), turn["text"].encode()):
                    rolling.update(len(part).to_bytes(8, "little"))
                    rolling.update(part)
                hashes.append(rolling.digest())
            found.append(hashes)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array([len(h) for h in found], pa.int64()), pa.array(found, pa.list_(pa.binary()))],
            names=["conv_id", "n_turns", "prefixes"],
        )


def rendered(turns: Column) -> Column:
    """The turns as one training text."""
    return F.array_join(
        F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit("\n"), F.replace(t["text"], F.lit("<|"), F.lit("< |")), F.lit(CLOSE + "\n"))), ""
    )


def maximal(turns: DataFrame) -> DataFrame:
    """The ids of conversations that no longer or earlier equal one covers: conv_id, n_turns."""
    hashed = materialise(turns.mapInArrow(_prefixes, HASHED), "chat-prefixes")
    last = F.element_at("prefixes", -1)
    own = F.coalesce("conv_id", F.lit((1 << 63) - 1))
    # The only longer conversations that matter are known by their length; of equal ones the first is.
    covers = (
        hashed.select(own.alias("own"), "n_turns", F.posexplode("prefixes").alias("at", "prefix"))
        .groupBy("prefix").agg(F.max("n_turns").alias("longest"), F.min(F.when(F.col("at") + 1 == F.col("n_turns"), F.col("own"))).alias("first"))
    )
    ends = hashed.select("conv_id", "n_turns", own.alias("own"), last.alias("end"))
    covered = (F.col("end") == F.col("prefix")) & ((F.col("longest") > F.col("n_turns")) | (F.col("first") < F.col("own")))
    return ends.join(covers, covered, "left_anti").select("conv_id", "n_turns")


def chats(conversations: DataFrame) -> DataFrame:
    """Per maximal conversation: conv_id, n_turns, text."""
    ship(conversations.sparkSession)
    turns = materialise(_turns(conversations), "chat-turns")
    kept = maximal(turns).withColumnRenamed("conv_id", "kept_id")
    return turns.join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id"))).select("conv_id", "n_turns", rendered(F.col("turns")).alias("text"))
