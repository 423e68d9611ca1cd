"""Every catalogue query with an oracle matches DuckDB on the sf0.001 tables (the driver
runs the same comparison at sf0.01: ``python tests/oracle_harness.py``)."""

import pytest

import __spark_entry__ as E
from hamper.plans.oracle import ORACLE
from tests.conftest import SF001
from tests.oracle_harness import compare, duck

ORACLES = ORACLE  # the reference's own operators; tests/llm covers the others


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF001, name, E.queries()[name], ORACLES[name], con)
    assert r["status"] == "match", r


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(E.queries())


def test_entry_flagship(spark):
    df = E.entry(spark)
    rows = df.groupBy("basket").count().collect()
    assert len(rows) == 150 and {r["count"] for r in rows} == {100}


def test_every_reference_query_has_an_oracle():
    from hamper.plans.catalog import QUERIES
    assert set(QUERIES) <= set(ORACLES)


@pytest.mark.parametrize("name", ["interactions", "split_train", "split_order", "recs_unseen", "hits"])
def test_query_matches_oracle_with_many_range_partitions(spark, con, name):
    """The same queries with their groups spread over more partitions than usual."""
    from hamper.plans import catalog
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    catalog.clear_memo()
    try:
        r = compare(spark, SF001, name, E.queries()[name], ORACLES[name], con)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        catalog.clear_memo()
    assert r["status"] == "match", r
