"""Balances: the same to-date metrics as a full scan, from one month's scan."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from costlens.operators import chapters as C
from costlens.plans import requests as R
from costlens.plans import rollup as B
from costlens.plans.period import Period
from costlens.plans.resumen import resumen
from costlens.sources import load_parquet_sources
from costlens.sources.fixtures import load_fixture_sources
from helpers import company, job, ledger, make_sources

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def src(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("erp"))
    fx = load_fixture_sources(spark, SF)
    for name, df in fx.items():
        df.write.parquet(f"{root}/{name}")
    return load_parquet_sources(spark, root, tables=list(fx))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def posted_late(src, of):
    """Change marks by the day of posting, which for most entries is weeks after their date."""
    day = F.datediff(F.col(of.date), F.lit(dt.date(1995, 12, 1)))
    late = F.pmod(F.col(of.mark), F.lit(7)) * 20  # days between the date of an entry and its posting
    posted = day + late
    return src | {of.source: src[of.source].withColumn(of.mark, posted.cast("long") * 10_000_000 + F.col(of.mark))}


def test_twelve_months_equal_the_full_scan(spark, src, tmp_path):
    """Every month of 1996 is closed with the entries posted until then; late ones are found."""
    rollup = B.Rollup(str(tmp_path / "balances"))
    req = R.all_projects(src)
    late = 0
    for of in (B.COST, B.CERTIFIED):
        marked = posted_late(src, of)
        amount = {"cost": "cbo", "certified": "sum_o"}[of.name]
        period = Period(1995, 12)
        while period.year < 1997:
            now = (period.cut - dt.date(1995, 12, 1)).days
            B.close_month(spark, marked, of, period, rollup, upto_mark=(now + 1) * 10_000_000 - 1)
            following = Period(period.year + period.month // 12, period.month % 12 + 1)
            got = B.to_date(spark, marked, of, following, rollup)
            want = B.to_date(spark, marked, of, following)
            assert rows(got) == rows(want), (of.name, following)
            stored = spark.read.parquet(f"{rollup.path(of)}/month={B._label(period)}").agg(F.sum(amount)).first()[0]
            late += stored != B.to_date(spark, marked, of, period).agg(F.sum(amount)).first()[0]
            period = following
        fn = {"cost": C.cost_by_chapter, "certified": C.cert_by_chapter}[of.name]
        jan = Period(1997, 1)
        assert rows(fn(marked, req, jan, False, agg=B.to_date(spark, marked, of, jan, rollup))) == rows(fn(src, req, jan, False))
    assert late > 0  # balances did miss entries that came later


def test_plan_scans_one_month(spark, src, tmp_path):
    """The source's scan is filtered by month and mark, on plain columns; history comes from the balance."""
    rollup = B.Rollup(str(tmp_path / "balances"))
    jan = Period(1997, 1)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    for of in B.BALANCES:
        B.close_month(spark, src, of, jan.previous(), rollup)
        plan = B.to_date(spark, src, of, jan, rollup)._jdf.queryExecution().executedPlan().toString()
        scans = [x for x in plan.split("\n") if "FileScan parquet" in x and f"{of.date}#" in x]
        pushed = scans[0].split("PushedFilters")[1]
        assert f"GreaterThan({of.mark}," in pushed and f"({of.date}," in pushed and "Or(" in pushed, pushed
        assert any(f"{of.name}/month=1996-12" in x for x in plan.split("\n")), plan
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_summary_from_balances(spark, src, tmp_path):
    rollup = B.Rollup(str(tmp_path / "balances"))
    jan = Period(1997, 1)
    assert set(B.close_all(spark, src, jan.previous(), rollup)) == {"cost", "certified", "unposted"}
    req = R.all_projects(src)
    assert rows(resumen(src, req, jan, rollup=rollup)) == rows(resumen(src, req, jan))
    few = R.all_projects(src, company="NATION_2")
    assert rows(resumen(src, few, jan, rollup=rollup, restrict=True)) == rows(resumen(src, few, jan))


def _bill(no, amount, mark, posted=None, day=5, job_no="J1"):
    return {"documentDate": dt.datetime(1996, 11, day), "documentNo": no, "bc_documentNo": posted, "baseAmount": amount, "posting_jobNo": job_no,
            "posting_jobTaskNo": "01", "company": "1", "bunisnessUnit": "9", "Change_No": mark}


def test_changed_invoices_replace_their_old_amounts(spark, tmp_path):
    """Registered, corrected, moved, split, unnamed, unmarked and new documents."""
    from decimal import Decimal as X
    rollup = B.Rollup(str(tmp_path / "balances"))
    first = [_bill("a", X(10), 1), _bill("b", X(20), 2), _bill("c", X(30), 3), _bill("d", X(40), 4), _bill("d", X(41), 4), _bill(None, X(50), 5), _bill("e", X(60), None), _bill("f", X(70), 6)]
    B.close_month(spark, make_sources(spark, facturas_qwark=first), B.UNPOSTED, Period(1996, 11), rollup)
    now = [_bill("a", X(10), 1), _bill("b", X(20), 11, posted="CFR1"), _bill("c", X(33), 12), _bill("d", X(44), 13), _bill(None, X(50), 5), _bill(None, X(51), 14),
           _bill("e", X(60), None), _bill("f", X(70), 15, job_no="J2"), _bill("g", X(80), 16, day=1), _bill("h", X(-5), 17)]
    src = make_sources(spark, facturas_qwark=now)
    for period in (Period(1996, 12), Period(1997, 3)):
        assert rows(B.to_date(spark, src, B.UNPOSTED, period, rollup)) == rows(B.to_date(spark, src, B.UNPOSTED, period))
    B.close_month(spark, src, B.UNPOSTED, Period(1996, 12), rollup)
    assert rows(B.to_date(spark, src, B.UNPOSTED, Period(1997, 1), rollup)) == rows(B.to_date(spark, src, B.UNPOSTED, Period(1997, 1)))
    B.close_month(spark, src, B.UNPOSTED, Period(1996, 11), rollup)  # again
    assert rows(B.to_date(spark, src, B.UNPOSTED, Period(1996, 12), rollup)) == rows(B.to_date(spark, src, B.UNPOSTED, Period(1996, 12)))


def test_sources_without_marks(spark, tmp_path):
    src = make_sources(spark, companies_bc=[company("1", "ACME")], job_list_bc=[job("J1", "1")], job_ledger_entries_bc=[ledger(dt.date(1996, 5, 1), "J1", "01", 10)])
    rollup = B.Rollup(str(tmp_path / "balances"))
    with pytest.raises(B.NoChangeMark):
        B.close_month(spark, src, B.COST, Period(1996, 12), rollup)
    assert all("error" in x for x in B.close_all(spark, src, Period(1996, 12), rollup).values())
    assert B.to_date(spark, src, B.COST, Period(1997, 1), rollup).count() == 1


def _shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for _, _, files in os.walk(d.getPath()) for f in files if f.startswith("shuffle_")}


def test_closing_a_month_leaves_no_shuffle_files(spark, src, tmp_path):
    """The files of a finished step else stay on disk while the next ones write theirs."""
    rollup = B.Rollup(str(tmp_path / "balances"))
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(key), _shuffle_files(spark)
    for of in B.BALANCES:
        for period in (Period(1996, 11), Period(1996, 12)):
            B.close_month(spark, src, of, period, rollup)
    until = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < until:  # they are removed in the background
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(key) == setting


def test_changed_documents_are_read_and_dealt_out_once(spark, src, tmp_path):
    rollup = B.Rollup(str(tmp_path / "balances"))
    jan = Period(1997, 1)
    B.close_month(spark, src, B.UNPOSTED, jan.previous(), rollup)
    plan = B.to_date(spark, src, B.UNPOSTED, jan, rollup)._jdf.queryExecution().executedPlan().toString().split("\n")
    assert sum("FileScan parquet" in x and "facturas_qwark" in x for x in plan) == 1
    assert sum("Exchange hashpartitioning" in x for x in plan) == 2  # by document, then by the keys alone


def test_unnamed_documents_are_dealt_out_by_their_keys(spark, tmp_path):
    """Rows without a document never meet in one place, and none replaces another."""
    from decimal import Decimal as X
    rollup = B.Rollup(str(tmp_path / "balances"))
    bills = [_bill(None, X(k + 1), k, job_no=f"J{k % 5}") for k in range(40)] + [_bill("a", X(100), 41), _bill("a", X(7), 42, job_no="J9")]
    B.close_month(spark, make_sources(spark, facturas_qwark=bills[:30] + bills[40:]), B.UNPOSTED, Period(1996, 11), rollup)
    src = make_sources(spark, facturas_qwark=bills[:-2] + [_bill("a", X(9), 50, job_no="J9")])
    want = rows(B.to_date(spark, src, B.UNPOSTED, Period(1996, 12)))
    assert rows(B.to_date(spark, src, B.UNPOSTED, Period(1996, 12), rollup)) == want and len(want) == 6
