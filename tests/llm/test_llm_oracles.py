"""The training-data queries that have SQL against it, over the smallest tables; the others run."""

from __future__ import annotations

import pytest

queries = pytest.importorskip("loomspan.llm.queries")

from oracle import compare, connect  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, sf_dir, name):
    df = queries.queries()[name](spark, sf_dir)
    if name in queries.oracle_sql():
        assert compare(df, connect(sf_dir), queries.oracle_sql()[name]) == ""
    else:
        assert df.count() >= 0
