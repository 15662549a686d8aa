"""Every registered query against its SQL."""

import oracle
import pytest
from oracle import SF_DIR

import __spark_entry__
from docindex.operators import profile


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_query_gives_the_rows_of_its_sql(spark, con, sf_dir, name):
    fn = __spark_entry__.queries()[name]
    assert oracle.compare(spark, con, fn, __spark_entry__.oracle_sql()[name], sf_dir) is None


def test_every_sql_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_approximate_cardinality_is_near_the_exact_one(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    near, exact = ({r["field"]: r["values"] for r in profile.cardinality(df, ["event_type", "value"], approximate=a).collect()} for a in (True, False))
    assert near["event_type"] == exact["event_type"] and abs(near["value"] - exact["value"]) <= 0.15 * exact["value"]
