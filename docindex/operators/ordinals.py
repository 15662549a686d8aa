"""Positions in a total order, without a window over the whole table."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from docindex.operators.selection import ranks
from docindex.workspace import materialise


def spread_sort(df: DataFrame, order_by: list[str | Column]) -> DataFrame:
    """A total order in which a value that many rows share is cut into many
    ranges: ties are broken by read position."""
    return df.withColumn("_tie", F.monotonically_increasing_id()).orderBy(*order_by, "_tie").drop("_tie")


def _sorted_parts(df: DataFrame, order_by: list[str | Column], name: str) -> DataFrame:
    """Rows range-partitioned in order, with their part and position in it, written once."""
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = spread_sort(df, order_by) if order_by else df
    return materialise(placed.select("*", F.spark_partition_id().alias("_part"), row.alias("_row")), name)


def with_ordinal(df: DataFrame, order_by: list[str | Column], name: str = "ordinal") -> DataFrame:
    """Add the 0-based position of each row in the given order."""
    return _numbered(df, order_by, name)[0]


def _numbered(df: DataFrame, order_by: list[str | Column], name: str) -> tuple[DataFrame, int]:
    """Rows with their position, and how many there are.

    A range sort, then one count per part. The counts (one row per part, never
    more than there are tasks) give each part its first position.
    """
    placed = _sorted_parts(df, order_by, "ordinal")
    counts = sorted((r["_part"], r["count"]) for r in placed.groupBy("_part").count().collect())
    starts = [0, *accumulate(n for _, n in counts)]
    offsets = df.sparkSession.createDataFrame(
        [(part, start) for (part, _), start in zip(counts, starts)], "_part int, _start long")
    joined = placed.join(F.broadcast(offsets), "_part")
    return joined.select(*df.columns, (F.col("_start") + F.col("_row")).alias(name)), starts[-1]


def chunk_plan(df: DataFrame, chunks: int) -> DataFrame:
    """How the rows fall into equal chunks: (chunk, from, size).

    At most one chunk per row; a remainder forms one chunk more (7 rows in 2
    chunks: 3, 3, 1). No rows give an empty plan.
    """
    hits = df.agg(F.count("*").alias("hits")).where("hits > 0")
    sized = hits.select("hits", F.expr(f"hits div least({int(chunks)}L, hits)").alias("size"))
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(hits - 1) div size"))).alias("chunk")
    start = F.col("chunk") * F.col("size")
    return sized.select("hits", "size", chunk).select(
        "chunk", start.alias("from"), F.least(F.col("size"), F.col("hits") - start).alias("size"))


def assign_chunks(df: DataFrame, chunks: int, order_by: list[str | Column] | None = None) -> DataFrame:
    """Add each row's chunk number under ``chunk_plan``, in the given (or read) order."""
    placed, hits = _numbered(df, order_by or [], "_ordinal")
    size = hits // min(chunks, hits) if hits else 1
    return placed.select(*df.columns, F.expr(f"_ordinal div {size}").alias("chunk"))


def page(df: DataFrame, order_by: list[str | tuple[str, bool]], start: int = 0, size: int = 10) -> DataFrame:
    """Rows ``start`` to ``start + size`` of an order of columns, or of (column, whether it falls).

    A shallow page is a bounded top-k, in order; a deep one is selected by buckets.
    """
    return ranks(df, [(c, False) if isinstance(c, str) else c for c in order_by], size, start)


def word_filter(words: DataFrame, word: str, order_by: list[str | Column], offset: int, n: int) -> DataFrame:
    """The first ``n`` plain words after skipping ``offset`` lines of a word list.

    Skipped lines are counted before words holding a non-word character go.
    """
    placed = with_ordinal(words, order_by, "_line").where(F.col("_line") >= offset)
    plain = placed.where(~F.col(word).rlike("\\W"))
    return plain.orderBy("_line").limit(n).drop("_line")


def running_mean(df: DataFrame, run: str, seq: str, value: str, name: str = "running_mean") -> DataFrame:
    """Mean of a value over a run's rows so far, in order of ``seq``.

    A run may hold most of the table, so it is not put into one window: rows are
    range-partitioned, summed per part, and each part starts from the sum of the
    parts before it.
    """
    rows = df.select(run, seq, value)
    placed = _sorted_parts(rows, [run, seq], "running-mean")
    sums = placed.groupBy(run, "_part").agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    earlier = Window.partitionBy(run).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(
        F.col(run).alias("_run"), F.col("_part").alias("_base_part"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base_sum"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base_n"),
    )
    so_far = Window.partitionBy(run, "_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    local = placed.select(
        run, seq, value, "_part",
        F.coalesce(F.sum(value).over(so_far), F.lit(0)).alias("_local_sum"),
        F.count(value).over(so_far).alias("_local_n"),
    )
    joined = local.join(base, F.col(run).eqNullSafe(F.col("_run")) & (F.col("_part") == F.col("_base_part")))
    total = F.col("_base_sum") + F.col("_local_sum")
    seen = F.col("_base_n") + F.col("_local_n")
    return joined.select(run, seq, value, F.try_divide(total.cast("double"), seen).alias(name))
