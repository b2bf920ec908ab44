"""Every registered query equals its SQL oracle at sf0.01; entry() runs."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_mod
from eventide.plans import catalog
from eventide.plans.verify import compare, duck
from tests.conftest import SF001

QUERIES, ORACLE = catalog.QUERIES, catalog.ORACLE_SQL


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE) <= set(entry_mod.oracle_sql())


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["window_start", "window_end", "n_match"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF001), con, ORACLE[name])
    assert r["cols_match"], r
    assert r["rows_match"], r
    assert r["values_match"], r
