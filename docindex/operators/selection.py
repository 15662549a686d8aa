"""The rows of some ranks in an order, of a whole table or of every group, without gathering them.

A bounded sample, taken by a hash and so the same whenever it is taken, splits the order
into buckets. Rows are counted by bucket, and the counts say which buckets lie inside the wanted
ranks and which at a border. Rows inside are filtered where they are; only the rows of a
border's bucket, one in a thousand, are ranked. It is one lazy plan: nothing runs while it is
built, and no setting of the session is touched.

Rows that are equal in the whole order are told apart by a hash of their columns; rows
equal in everything are counted before they are ranked, so no number of them meets in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

#: Ranks up to which every task just keeps its own first rows, and those of one group.
SHALLOW, SHALLOW_GROUP = 10_000, 1_000
#: Splitters of an order: blocks of so many are searched one after the other.
BLOCK = 31
SAMPLE = BLOCK * (BLOCK + 1)

Order = list[tuple[str, bool]]


def sort_columns(order: Order) -> list[Column]:
    """An order of (column, whether it falls) as Spark sorts: nulls first where it rises, last where it falls."""
    return [F.desc(c) if falls else F.asc(c) for c, falls in order]


def _precedes(a: list[Column], b: list[Column], falls: list[bool]) -> Column:
    """Whether ``a`` stands before ``b``."""
    out, same = F.lit(False), F.lit(True)
    for x, y, down in zip(a, b, falls):
        high, low = (x, y) if down else (y, x)
        before = F.coalesce(low < high, low.isNull() & high.isNotNull())
        out, same = out | (same & before), same & x.eqNullSafe(y)
    return out


def _ordered(rows: Column, names: list[str], falls: list[bool]) -> Column:
    def compare(a: Column, b: Column) -> Column:
        left, right = [a[n] for n in names], [b[n] for n in names]
        return F.when(_precedes(left, right, falls), F.lit(-1)).when(_precedes(right, left, falls), F.lit(1)).otherwise(F.lit(0))

    return F.array_sort(rows, compare)


def _plain(dtype: T.DataType) -> bool:
    """Whether rows can be grouped by a column."""
    if isinstance(dtype, T.StructType):
        return all(_plain(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _plain(dtype.elementType)
    return not isinstance(dtype, T.MapType | T.VariantType)


def ranks(df: DataFrame, order: Order, size: int, start: int = 0, within: list[str] | None = None) -> DataFrame:
    """Rows with ``start`` <= rank < ``start + size`` (from 0), of every group of ``within`` if given.

    Few are kept by every task and then put in order; more come through buckets, in no order.
    """
    within = within or []
    if not within and start + size <= SHALLOW:
        return df.orderBy(*sort_columns(order)).offset(start).limit(size)
    if within and start + size <= SHALLOW_GROUP:
        rank = F.row_number().over(Window.partitionBy(*within).orderBy(*sort_columns(order)))
        cut = df.withColumn("_rank", rank).where(F.col("_rank") <= start + size)
        return (cut.where(F.col("_rank") > start) if start else cut).drop("_rank")
    return _by_buckets(df, order, size, start, within)


def _by_buckets(df: DataFrame, order: Order, size: int, start: int, within: list[str]) -> DataFrame:
    keys = [f"_k{i}" for i in range(len(order) + 1)]
    falls = [down for _, down in order] + [False]
    groups = [f"_g{i}" for i in range(len(within))]
    hashed = [c for c in df.columns if _plain(df.schema[c].dataType)]
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in hashed])
    rows = df.select("*", *[F.col(c).alias(k) for (c, _), k in zip(order, keys)], tie.alias(keys[-1]))
    rows = rows.select("*", *[F.col(c).alias(g) for c, g in zip(within, groups)])

    # The sample of a group is the rows with its least hashes.
    key = F.struct(*keys)
    chance = F.xxhash64(*keys)
    if within:
        place = F.row_number().over(Window.partitionBy(*groups).orderBy(chance))
        sample = rows.select(*groups, *keys).withColumn("_place", place).where(F.col("_place") <= SAMPLE)
        splitters = sample.groupBy(*groups).agg(F.collect_list(key).alias("_all"))
    else:
        splitters = rows.select(*keys).orderBy(chance).limit(SAMPLE).agg(F.collect_list(key).alias("_all"))
    sort = _ordered(F.col("_all"), keys, falls)
    splitters = splitters.select(*groups, sort.alias("_all"))
    coarse = F.filter("_all", lambda s, i: (i + 1) % (BLOCK + 1) == 0)
    splitters = splitters.select(*groups, "_all", coarse.alias("_coarse"))
    joined = _beside(rows, splitters, groups, tie=keys[-1])
    own = [F.col(k) for k in keys]

    def before(some: Column) -> Column:
        return F.size(F.filter(some, lambda s: _precedes([s[k] for k in keys], own, falls)))

    block = before(F.col("_coarse"))
    joined = joined.withColumn("_block", block)
    bucket = F.col("_block") * (BLOCK + 1) + before(F.slice("_all", F.col("_block") * (BLOCK + 1) + 1, BLOCK + 1))
    placed = joined.withColumn("_bucket", bucket).drop("_all", "_coarse", "_block")

    # One row for each bucket of a group.
    counts = placed.groupBy(*groups, "_bucket").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_low", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    low, high, stop = F.col("_low"), F.col("_low") + F.col("_n"), start + size
    counts = counts.where((low < stop) & (high > start))
    inside = (low >= start) & (high <= stop)
    whole = _beside(placed, counts.where(inside), [*groups, "_bucket"], "left_semi")
    part = _beside(placed, counts.where(~inside), [*groups, "_bucket"])
    return whole.select(*df.columns).unionByName(_ranked(part, df, keys, falls, groups, start, stop))


def _ranked(part: DataFrame, df: DataFrame, keys: list[str], falls: list[bool], groups: list[str], start: int, stop: int) -> DataFrame:
    """The wanted rows of buckets at a border."""
    by = [F.desc(k) if down else F.asc(k) for k, down in zip(keys, falls)]
    if not all(_plain(f.dataType) for f in df.schema.fields):
        rank = F.col("_low") + F.row_number().over(Window.partitionBy(*groups, "_bucket").orderBy(*by)) - 1
        return part.withColumn("_rank", rank).where((F.col("_rank") >= start) & (F.col("_rank") < stop)).select(*df.columns)
    columns = [F.col(f"`{c}`") for c in df.columns]
    alike = part.groupBy(*columns, *keys, *groups, "_bucket", "_low").agg(F.count("*").alias("_times"))
    so_far = Window.partitionBy(*groups, "_bucket").orderBy(*by, *columns).rowsBetween(Window.unboundedPreceding, 0)
    high = F.col("_low") + F.sum("_times").over(so_far)
    first = F.greatest(high - F.col("_times"), F.lit(start))
    taken = alike.withColumn("_taken", F.least(high, F.lit(stop)) - first).where("_taken > 0")
    return taken.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), "_taken")).alias("_copy")).drop("_copy")


def _beside(rows: DataFrame, side: DataFrame, on: list[str], how: str = "inner", tie: str = "") -> DataFrame:
    """Join a side that has at most a few rows a group; without groups it is one row or a row a bucket, and broadcast."""
    grouped = any(name.startswith("_g") for name in on)
    if not on:
        # The one row is looked up by a hash modulo one, so that it is an ordinary join by a key.
        one = side.withColumn("_one", F.pmod(F.xxhash64(F.size("_all")), F.lit(1).cast("long")))
        return rows.join(F.broadcast(one), F.pmod(rows[tie], F.lit(1).cast("long")) == F.col("_one")).drop("_one")
    same = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(side[c]) for c in on])
    out = rows.join(side if grouped else F.broadcast(side), same, how)
    return out if how == "left_semi" else out.drop(*[side[c] for c in on])
