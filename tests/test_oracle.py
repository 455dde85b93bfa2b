"""Every registered query against its independent DuckDB oracle (row count,
column names, order-insensitive value hash) on the smallest driver tables;
rows-only keys must run and return rows."""

from __future__ import annotations

import pytest
from harness import compare, duck

from tradecast.registry import oracle_sql, queries

QUERIES = queries()
ORACLE = oracle_sql()
# MLlib fits are exercised in test_models.py (they are slow).
SLOW = {"m7_gbt_mean", "m8_quantile", "m9_metrics_all", "m10_metrics_h12_all", "m12_capacity_gbt"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, sf_dir, con, key):
    r = compare(spark, sf_dir, QUERIES[key], ORACLE[key], con)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["hash_match"], r


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE) - SLOW))
def test_rows_only_runs(spark, sf_dir, key):
    assert QUERIES[key](spark, sf_dir).count() > 0


def test_every_oracle_key_is_registered():
    assert set(ORACLE) <= set(QUERIES)
