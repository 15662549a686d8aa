"""Structured Streaming into index tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from docindex.sources.store import write_documents


def index_stream(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    to_documents: Callable[[DataFrame], DataFrame],
    mapping: dict | None = None,
) -> DataStreamWriter:
    """A stream writer that adds each micro-batch to its indices as one batch.

    A micro-batch is a write named by the stream's checkpoint and its own number.
    Run again after a failure, it replaces its first attempt and nothing else, so
    documents arrive exactly once beside any other loads and streams. Call
    ``.start()`` on the result.
    """
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def write(rows: DataFrame, epoch: int) -> None:
        write_documents(to_documents(rows), root, mapping=mapping, writer=f"{name}-{epoch}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
