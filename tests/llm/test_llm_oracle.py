"""Queries of the training-data operators against their SQL."""

import duckdb
import pytest

from closebook.llm.oracle import ORACLE_SQL
from closebook.llm.queries import QUERIES
from compare import compare


@pytest.fixture(scope="module")
def con(small_sf):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, con, small_sf, name):
    ok, message = compare(QUERIES[name](spark, small_sf), con, ORACLE_SQL[name])
    assert ok, f"{name}: {message}"
