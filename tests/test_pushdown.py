"""On canonical parquet tables, period filters reach the scan and results
equal the fixture path."""

from costlens.operators import datasets as DS
from costlens.plans import requests as R
from costlens.plans.period import Period
from costlens.plans.resumen import resumen
from costlens.sources import load_parquet_sources
from costlens.sources.fixtures import load_fixture_sources

SF = "/root/testdata/sf0.001"
JAN = Period(1997, 1)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_parquet_sources_push_period_filters(spark, tmp_table_root):
    fx = load_fixture_sources(spark, SF)
    for name, df in fx.items():
        df.write.mode("overwrite").parquet(f"{tmp_table_root}/{name}")
    pq = load_parquet_sources(spark, tmp_table_root, tables=list(fx))

    led = DS.ledger_entries(pq, None, None, JAN.cut)
    plan = _plan(led)
    scan = [ln for ln in plan.split("\n") if "FileScan parquet [Posting_Date#" in ln]
    assert scan and "LessThan(Posting_Date" in scan[0].split("PushedFilters")[1], plan

    docs = DS.pending_docs(pq, None, None, JAN.month_start, JAN.month_end)
    scan = [ln for ln in _plan(docs).split("\n") if "FileScan parquet" in ln and "fecha_seguimiento#" in ln]
    assert scan and "GreaterThanOrEqual(fecha_seguimiento" in scan[0].split("PushedFilters")[1]

    a = resumen(pq, R.all_projects(pq), JAN)
    b = resumen(fx, R.all_projects(fx), JAN)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def _key_shuffles(df) -> int:
    plan = _plan(df)
    return sum(1 for ln in plan.split("\n")
               if "Exchange hashpartitioning" in ln or "Exchange rangepartitioning" in ln)


def test_plan_shape_of_the_summary(spark, tmp_table_root):
    """Guards the plan before adaptive execution: shuffles of the sources carry
    aggregated rows, and the whole tail adds the union's one shuffle to them and to
    those of the overhead percentages."""
    from costlens.operators.chapters import all_parts
    from costlens.plans import resumen as S
    fx = load_fixture_sources(spark, SF)
    for name, df in fx.items():
        df.write.mode("overwrite").parquet(f"{tmp_table_root}/{name}")
    pq = load_parquet_sources(spark, tmp_table_root, tables=list(fx))
    req = S.prepare_requests(R.all_projects(pq))
    parts = _key_shuffles(all_parts(pq, req, JAN))
    assert parts <= 12
    whole = resumen(pq, R.all_projects(pq), JAN)
    assert _key_shuffles(whole) - parts <= 4
    assert sum("REPARTITION_BY_COL" in ln for ln in _plan(whole).split("\n")) == 1


def test_invoices_cut_the_big_tables_first(spark, tmp_table_root):
    """The month's headers semi-join lines and ledger below their aggregations, at any size."""
    fx = load_fixture_sources(spark, SF)
    for name, df in fx.items():
        df.write.mode("overwrite").parquet(f"{tmp_table_root}/{name}")
    pq = load_parquet_sources(spark, tmp_table_root, tables=list(fx))
    plan = DS.invoices_by_chapter(pq, None, None, JAN.month_start, JAN.month_end, sort=False) \
        ._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = lambda ln: len(ln) - len(ln.lstrip(" :+-"))
    for table, agg in (("InvoiceId", "count(1)"), ("Total_Cost_LCY", "sum(Total_Cost_LCY")):
        scan = next(i for i, ln in enumerate(plan) if "Relation" in ln and table in ln)
        above, d = [], depth(plan[scan])
        for ln in reversed(plan[:scan]):
            if depth(ln) < d:
                above.append(ln)
                d = depth(ln)
        joins = next(i for i, ln in enumerate(above) if "LeftSemi" in ln)
        aggs = next(i for i, ln in enumerate(above) if "Aggregate" in ln and agg in ln)
        assert joins < aggs, above
    assert any("GreaterThanOrEqual(invoiceDate" in ln or "invoiceDate" in ln and ">=" in ln for ln in plan)
