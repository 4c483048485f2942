"""Every registered query equals its DuckDB oracle on the smallest TESTDATA."""

import pytest

import __spark_entry__ as E
from compare import compare, duck

SF = "/root/testdata/sf0.001"
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


# the training-data queries are tested in tests/llm
@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E._llm()[0])))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    assert name in ORACLES, f"{name} has no oracle"
    want = con.sql(ORACLES[name]).df()
    ok, msg = compare(got, want)
    assert ok, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:7] == ["company_id", "company_name", "project_no", "period_date",
                              "grupo", "capitulo", "nivel"]
    assert df.count() > 0
