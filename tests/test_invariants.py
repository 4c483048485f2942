"""Plan-level invariants on TESTDATA sf0.001."""

from pyspark.sql import functions as F

from costlens.plans import gapfill as G
from costlens.plans import requests as R
from costlens.plans import runs as RUN
from costlens.plans.period import Period
from costlens.plans.resumen import resumen
from costlens.sources.fixtures import load_fixture_sources

SF = "/root/testdata/sf0.001"
JAN = Period(1997, 1)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_batch_equals_loop(spark):
    src = load_fixture_sources(spark, SF)
    reqs = R.all_projects(src).orderBy("company_name", "project_no").limit(3).collect()
    pairs = [(r["company_name"], r["project_no"]) for r in reqs]
    batch = resumen(src, R.explicit(spark, src, pairs), JAN)
    loop = None
    for p in pairs:
        one = resumen(src, R.explicit(spark, src, [p]), JAN)
        loop = one if loop is None else loop.unionByName(one)
    assert rows(batch) == rows(loop)


def test_to_date_is_month_plus_previous(spark):
    src = load_fixture_sources(spark, SF)
    df = resumen(src, R.all_projects(src), JAN)
    # direct chapters only: overhead rows take their three costs from different bases
    bad = df.where(F.col("grupo") == "Directos").where(F.abs(F.col("coste_bc_a_origen") - F.col("coste_bc_mes_actual")
                         - F.col("coste_bc_mes_anterior")) > 0.011)
    assert bad.count() == 0


def test_run_then_backfill_leaves_nothing_missing(spark, tmp_table_root):
    src = load_fixture_sources(spark, SF)
    target = RUN.Target(tmp_table_root)
    out = RUN.backfill_missing(spark, src, JAN, target, snapshot=src["resumen_seguimiento"], details=True)
    assert out["run"] == out["missing"] > 0
    snap = RUN.snapshot_table(spark, target).unionByName(
        src["resumen_seguimiento"], allowMissingColumns=True)
    assert G.missing_projects(src, snap, JAN).count() == 0
    # a second identical run leaves the summary unchanged (upsert, not append)
    before = rows(RUN.snapshot_table(spark, target).drop("snapshot_run_id", "snapshot_run_ts"))
    RUN.backfill_missing(spark, src, JAN, target, snapshot=src["resumen_seguimiento"], details=False)
    after = rows(RUN.snapshot_table(spark, target).drop("snapshot_run_id", "snapshot_run_ts"))
    assert before == after


def test_run_from_params_single_project(spark, tmp_table_root):
    src = load_fixture_sources(spark, SF)
    one = R.all_projects(src).orderBy("company_name", "project_no").first()
    out = RUN.run_from_params(spark, src, {"company_name": one["company_name"], "project_no": one["project_no"],
                                           "year": 1997, "month": 1, "details": False},
                              RUN.Target(tmp_table_root))
    assert out["ok"], out["message"]
    snap = RUN.snapshot_table(spark, RUN.Target(tmp_table_root))
    keys = {(r["company_name"], r["project_no"]) for r in snap.select("company_name", "project_no").collect()}
    assert keys == {(one["company_name"], one["project_no"])}
    bad = RUN.run_from_params(spark, src, {"year": 1997}, RUN.Target(tmp_table_root))
    assert not bad["ok"]


def test_restricted_sources_give_the_same_rows(spark):
    from costlens.plans import resumen as S
    src = load_fixture_sources(spark, SF)
    reqs = R.all_projects(src).orderBy("project_no").limit(5)
    restricted, full = (rows(S.resumen(src, reqs, JAN, restrict=r)) for r in (True, False))
    assert restricted == full and len(full) > 0


def test_unification_keeps_metric_totals(spark):
    """Σ of every metric per project is the same before and after the load's
    chapter unification and re-aggregation (produccion_a_origen excepted: the
    load recomputes it from its three components)."""
    from costlens.plans import resumen as S
    src = load_fixture_sources(spark, SF)
    reqs = R.all_projects(src)
    cols = [c for c in S.NUM_COLS if c != "produccion_a_origen"]
    before = S.transform_rows(src, reqs, JAN).groupBy("company_name", "project_no") \
        .agg(*[F.round(F.sum(c), 2).alias(c) for c in cols])
    after = S.resumen(src, reqs, JAN).groupBy("company_name", "project_no") \
        .agg(*[F.round(F.sum(c), 2).alias(c) for c in cols])
    assert rows(before) == rows(after)
    assert before.count() == reqs.count()


def test_backfill_goes_on_after_refused_pairs(spark, tmp_table_root, tmp_path):
    """A pair whose rows break the summary's key, and pairs without a name, fail alone, with their
    details; the run with balances gives the same rows."""
    from pyspark.sql import functions as F

    from costlens.plans import rollup as B

    src = load_fixture_sources(spark, SF)
    # 'NATION_2 ' is cleaned to the same name under another id, so a project of both has each key twice
    one = R.all_projects(src, company="NATION_2").orderBy("project_no").first()["project_no"]
    bad = dict(src)
    bad["companies_bc"] = src["companies_bc"].unionByName(spark.createDataFrame([("zz", "NATION_2 ")], "id string, name string"))
    bad["job_list_bc"] = src["job_list_bc"].unionByName(spark.createDataFrame(
        [(one, "zz", "again"), ("PY_NONAME", "unknown", "no company")], "No string, CompanyId string, Description string"))
    empty = src["resumen_seguimiento"].limit(0)
    target = RUN.Target(tmp_table_root + "/refused")
    out = RUN.backfill_missing(spark, bad, JAN, target, snapshot=empty, company=None, details=True)
    failed = {(r["company_name"], r["project_no"], r["refused_because"]) for r in out["failed"].collect()}
    assert failed == {("NATION_2", one, "duplicate key"), (None, "PY_NONAME", "null key")}
    assert out["missing"] == out["run"] + 3  # both requests of the pair, and the nameless one
    snap = RUN.snapshot_table(spark, target)
    assert snap.where(F.col("project_no") == one).count() == 0
    pending = spark.read.parquet(target.path(RUN.PENDING_DOCS))
    assert pending.where(F.col("project_no") == one).count() == 0 and pending.count() > 0

    rollup = B.Rollup(str(tmp_path / "balances"))
    B.close_all(spark, src, JAN.previous(), rollup)
    plain, balanced = RUN.Target(tmp_table_root + "/plain"), RUN.Target(tmp_table_root + "/balanced")
    RUN.run_snapshot(spark, src, R.all_projects(src), JAN, plain, details=False, all_projects=True)
    RUN.run_snapshot(spark, src, R.all_projects(src), JAN, balanced, details=False, all_projects=True, rollup=rollup)
    meta = ("snapshot_run_id", "snapshot_run_ts")
    assert rows(RUN.snapshot_table(spark, plain).drop(*meta)) == rows(RUN.snapshot_table(spark, balanced).drop(*meta))
