"""Every core query with SQL against that SQL, over the smallest tables; the others run and keep their columns."""

from __future__ import annotations

import importlib

import pytest
from oracle import compare, connect

MODULES = [importlib.import_module(m) for m in ("loomspan.plans.general", "loomspan.plans.reference", "loomspan.plans.knowledge", "loomspan.plans.extras", "loomspan.plans.corpora")]
QUERIES = {n: f for m in MODULES for n, f in m.queries().items()}
SQL = {n: s for m in MODULES for n, s in m.oracle_sql().items()}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    if name in SQL:
        assert compare(df, con, SQL[name]) == ""
    else:
        df.count()


def test_entry(spark):
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
