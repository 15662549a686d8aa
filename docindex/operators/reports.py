"""Load reports and catalog reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def throughput(runs: DataFrame) -> DataFrame:
    """Rates of load runs given as (bytes, records, duration, machines).

    A duration reads like ``0h14m25``; missing leading parts are zero. Rates are
    whole numbers; a run of zero seconds has none.
    """
    parts = F.reverse(F.split("duration", "[^0-9]+"))

    def part(i: int):
        return F.coalesce(F.get(parts, F.lit(i)).try_cast("long"), F.lit(0))

    machines = F.greatest(F.coalesce(F.col("machines"), F.lit(1)), F.lit(1)).cast("long")
    timed = runs.withColumn("seconds", part(0) + 60 * part(1) + 3600 * part(2)).withColumn("machines", machines)
    per = "nullif(seconds, 0)"
    return timed.select(
        *[c for c in runs.columns if c != "machines"], "machines", "seconds",
        F.expr(f"records div {per} div machines").alias("rec_s_machine"),
        F.expr(f"bytes div {per} div 1024 div machines").alias("kib_s_machine"),
        F.expr(f"records div {per}").alias("rec_s"),
        F.expr(f"bytes div {per} div 1024").alias("kib_s"),
    )


def invert_aliases(aliases: DataFrame) -> DataFrame:
    """From (index, aliases) to one row per alias and index, (alias, index)."""
    return aliases.select(F.explode("aliases").alias("alias"), "index").distinct()


def batch_metrics(docs: DataFrame) -> DataFrame:
    """Items and bytes of each file that documents were read from (column ``file``)."""
    return docs.groupBy("file").agg(F.count("*").alias("items"), F.sum(F.octet_length("_source")).alias("bytes"))
