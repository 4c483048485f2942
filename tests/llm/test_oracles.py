"""Queries against their DuckDB statements on the given tables."""

import duckdb
import pytest

from costlens.llm import queries as q
from tests.compare import compare

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    ok, message = compare(q.queries()[name](spark, SF).toPandas(), con.execute(q.oracle_sql()[name]).df())
    assert ok, message


def test_every_operator_has_one_query():
    names = list(q.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
