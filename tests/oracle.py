"""Side-by-side comparison of registered queries with their SQL."""

from __future__ import annotations

import math
import os
import re
from datetime import date, datetime
from decimal import Decimal

import duckdb

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


# Operators that pair rows without a key, or run Python once per row.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
# Python in any form, which only the training-data operations (op...) use.
PYTHON = ("ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups", "FlatMapCoGroups")
# A shuffle of whole rows into one task.
ONE_TASK = re.compile(r"Exchange SinglePartition, ENSURE_REQUIREMENTS.*\n[^A-Za-z]*(?:\*\(\d+\) )?(?:Project|Filter|Scan|FileScan|ColumnarToRow)\b")

# Rows that a top-k may bring into one task.
TOP_ROWS = 10_000


def large_top(plan: str) -> bool:
    return any(int(n) > TOP_ROWS for n in re.findall(r"TakeOrderedAndProject\(limit=(\d+)|GlobalLimit (\d+)", plan) for n in n if n)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, date | datetime):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, fn, sql: str, sf_dir: str) -> str | None:
    """None when both sides give the same rows, else what differs."""
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in UNWANTED:
        if operator in plan:
            return f"plan holds {operator}"
    if not re.match(r"op\d+_|pipeline$", getattr(fn, "__name__", "")):
        for operator in PYTHON:
            if operator in plan:
                return f"plan holds {operator}"
    if ONE_TASK.search(plan) or large_top(plan):
        return "plan gathers whole rows in one task"
    answer = con.execute(sql)
    columns = [d[0] for d in answer.description]
    want = rows_of(columns, answer.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    types = {d[0]: str(d[1]) for d in answer.description}
    differ = [
        f"{f.name}: {f.dataType.simpleString()} != {types[f.name]}"
        for f in df.schema.fields if SQL_TYPES.get(f.dataType.simpleString()) != types[f.name]
    ]
    if differ:
        return ", ".join(differ)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}; {got[:2]} {want[:2]}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} != {b}"
    return None
