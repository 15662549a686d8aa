"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution merges small shuffle parts and splits hot ones; the zone
# fixes how wall-clock columns are read; several open writers per task spare a
# sort when a load has few targets.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def builder(app: str = "docindex") -> SparkSession.Builder:
    b = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b
