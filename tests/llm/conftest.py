import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from edge_cases import EDGES, SCHEMA, rows  # noqa: E402


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(rows(EDGES), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
