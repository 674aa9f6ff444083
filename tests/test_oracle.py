"""Every registered query against its SQL, on the small tables."""

from __future__ import annotations

import pytest

import oracle
from __spark_entry__ import entry
from oracle_queries import ORACLE as SQL
from tripweave.plans.catalog import QUERIES
from tripweave.plans.further import WITHOUT_SQL


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) - WITHOUT_SQL == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(name, spark, sf_dir, con):
    assert oracle.differences(QUERIES[name](spark, sf_dir), con, SQL[name]) == []


def test_entry_is_the_share_groups(spark):
    df = entry(spark)
    assert df.count() == 16
    assert "spread_minutes" in df.columns


def test_comparison_notices_differences(spark, con):
    df = spark.sql("SELECT 1L AS n")
    assert oracle.differences(df, con, "SELECT CAST(1 AS BIGINT) AS n") == []
    assert oracle.differences(df, con, "SELECT CAST(2 AS BIGINT) AS n")
    assert oracle.differences(df, con, "SELECT CAST(1 AS INTEGER) AS n")
    assert oracle.differences(df, con, "SELECT CAST(1 AS BIGINT) AS m")
    assert oracle.differences(df, con, "SELECT CAST(1 AS BIGINT) AS n FROM range(2)")
