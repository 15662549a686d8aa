"""Shared scratch space for tables that cut a plan in two.

Executors can be lost at any time, so an intermediate result that two later
jobs must see identically is written as a table in the folder the cluster names
in ``spark.checkpoint.dir`` and read back. Nothing is kept on a local disk of a
cluster node.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="docindex-")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared checkpoint folder.

    Only a single-machine session may leave the folder unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        base = _own_folder()
    return f"{base.rstrip('/')}/docindex/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a reader of exactly those rows."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
