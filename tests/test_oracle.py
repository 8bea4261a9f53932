"""Every query with a SQL twin gives the same rows, names and types as DuckDB."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import difference, duck, type_difference
from stationflow.plans.catalog import CATALOG
from stationflow.plans.oracle import oracles

SQL = oracles()
# Whole models sample rows and features by the round; F11_boosted_stumps has a twin, tests/test_model.py the rest.
FULL_BOOSTING = {f"F11_boosted_{k}" for k in ("hours", "minutes", "peak", "workday", "weekend")}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_a_twin():
    assert set(CATALOG) - FULL_BOOSTING == set(SQL)
    assert set(CATALOG) <= set(queries())
    assert set(SQL) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_duckdb(spark, sf_dir, con, name):
    df = queries()[name](spark, sf_dir)
    assert type_difference(df, con, SQL[name]) is None
    assert difference(df, con, SQL[name]) is None


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["stationID", "startTime", "endTime", "inNums", "outNums"]
    assert df.count() > 0
