"""Registered queries against their DuckDB twins on the smallest tables.

Set BARFRAME_FULL_ORACLE=1 to run every registered SQL twin (slow)."""
import os

import pytest

from barframe.plans.catalog import QUERIES, SQL
from barframe.plans.compare import compare, duckdb_connection

from conftest import SF_SMALL

FAST = ["bars_daily", "bars_brand", "bars_hourly", "equal_weight_index", "feature_matrix",
        "validation_report", "price_summary", "monthly_returns", "roc_auc", "signal_study",
        "ema", "bollinger"]
NAMES = sorted(SQL) if os.environ.get("BARFRAME_FULL_ORACLE") else FAST


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, con, name):
    r = compare(QUERIES[name](spark, SF_SMALL), con, SQL[name])
    assert r["cols_match"], (r["spark_cols"], r["sql_cols"])
    assert r["rows"][0] == r["rows"][1]
    assert r["hash_match"], r.get("diff")


def test_every_sql_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
