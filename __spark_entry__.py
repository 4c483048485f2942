"""

Every query reads the TESTDATA tables of ``sf_dir`` through the fixture
adapters (``costlens.sources.fixtures``) and runs over the whole tables.
Fixed parameters: month 1997-01 (d1 = 1997-01-01, cut = 1997-01-31), all
companies and projects, except the ``*_one_project`` variants, which filter
on company NATION_2 and its smallest project number, and the
``*_one_company`` variants, which filter on company NATION_2 only.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_sql as O  # noqa: E402
from costlens.output import decimals_to_double  # noqa: E402
from costlens.operators import chapters as C  # noqa: E402
from costlens.operators import datasets as D  # noqa: E402
from costlens.plans import gapfill as G  # noqa: E402
from costlens.plans import requests as R  # noqa: E402
from costlens.plans import resumen as S  # noqa: E402
from costlens.plans import rollup as B  # noqa: E402
from costlens.plans import runs as RUN  # noqa: E402
from costlens.plans.period import DEFAULT_PERIOD as P  # noqa: E402
from costlens.session import scratch_path  # noqa: E402
from costlens.sinks import tables as T  # noqa: E402
from costlens.sources.fixtures import load_fixture_sources  # noqa: E402
from costlens.sources.schema import Col, Table, resolve_columns  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"
ONE_COMPANY = "NATION_2"


_SOURCES: dict = {}


def _src(spark: SparkSession, sf_dir: str):
    """Canonical sources of a TESTDATA folder (lazy DataFrames, built once per
    session and folder; nothing is cached in memory)."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # sessions without a local SparkContext handle
        app = None
    key = (app, id(spark), sf_dir)
    if key not in _SOURCES:
        _SOURCES[key] = load_fixture_sources(spark, sf_dir)
    return _SOURCES[key]


def _one_project(src) -> str | None:
    """Smallest project number of the filter company (read from the data)."""
    r = R.all_projects(src, company=ONE_COMPANY).agg(F.min("project_no")).first()
    return r[0] if r else None


def _resumen(spark, sf_dir):
    src = _src(spark, sf_dir)
    return S.resumen(src, R.all_projects(src), P)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the monthly summary of every project at sf0.001."""
    return _resumen(spark, SF_SMOKE)


def _ds(fn, *args):
    def run(spark, sf_dir):
        return decimals_to_double(fn(_src(spark, sf_dir), *args))
    return run


def _ledger_one(spark, sf_dir):
    src = _src(spark, sf_dir)
    return decimals_to_double(D.ledger_entries(src, ONE_COMPANY, _one_project(src), P.cut))


def _pending_one(spark, sf_dir):
    src = _src(spark, sf_dir)
    return decimals_to_double(D.pending_month(src, ONE_COMPANY, _one_project(src), P.month_start, P.month_end))


def _production_one(spark, sf_dir):
    src = _src(spark, sf_dir)
    return decimals_to_double(D.production_month(src, ONE_COMPANY, _one_project(src), P.month_start, P.month_end))


def _one(fn, *tail):
    """A dataset filtered on the fixed company and its smallest project."""
    def run(spark, sf_dir):
        src = _src(spark, sf_dir)
        return decimals_to_double(fn(src, ONE_COMPANY, _one_project(src), *tail))
    return run


def _overhead_pct(spark, sf_dir):
    src = _src(spark, sf_dir)
    return decimals_to_double(D.overhead_pct(src, R.all_projects(src)))


def _per_request(fn, *args):
    """A chapter-level operator over every project's request."""
    def run(spark, sf_dir):
        src = _src(spark, sf_dir)
        return decimals_to_double(fn(src, R.all_projects(src), P, *args))
    return run


def _snapshot(src):
    return src["resumen_seguimiento"]


def _expected(spark, sf_dir):
    return G.expected_projects(_src(spark, sf_dir), sort=True)


def _resumen_prev(spark, sf_dir):
    src = _src(spark, sf_dir)
    return S.resumen(src, R.all_projects(src), P, with_prev_month=True)


def _existing(spark, sf_dir):
    return G.existing_projects(_snapshot(_src(spark, sf_dir)), P)


def _missing(spark, sf_dir):
    src = _src(spark, sf_dir)
    return G.missing_projects(src, _snapshot(src), P)


def _backfill(spark, sf_dir):
    src = _src(spark, sf_dir)
    return S.resumen(src, G.backfill_requests(src, _snapshot(src), P), P, restrict=True)


def _expected_company(spark, sf_dir):
    return G.expected_projects(_src(spark, sf_dir), company=ONE_COMPANY.lower())


def _existing_company(spark, sf_dir):
    # the snapshot holds company names in lower case between spaces
    return G.existing_projects(_snapshot(_src(spark, sf_dir)), P, company=f" {ONE_COMPANY} ")


def _backfill_dry_run(spark, sf_dir):
    """The pairs that a dry run of the backfill lists for one company."""
    src = _src(spark, sf_dir)
    out = RUN.backfill_missing(spark, src, P, RUN.Target(scratch_path(spark, "dry-run")),
                               snapshot=_snapshot(src), dry_run=True, company=ONE_COMPANY.lower())
    assert out["run"] == 0
    return out["requests"]


def _read_back(spark, path, drop=(), schema=None):
    df = T.read_table(spark, path, schema)
    return df.drop(*T.META_COLS, *drop)


def _written_summary(spark, src, name):
    """The month's summary, evaluated once and written to the shared folder."""
    path = scratch_path(spark, name)
    S.resumen(src, R.all_projects(src), P).write.parquet(path)
    return spark.read.schema(_summary_types()).parquet(path)


def _summary_types():
    meta = set(T.META_COLS)
    return StructType([f for f in RUN.summary_schema().fields if f.name not in meta])


def _upsert_resumen(spark, sf_dir):
    """Two batches. The first has other values for every key and, for one company,
    projects ('ZZ...') that the second lacks; the second lacks company NATION_3. The table
    must hold the second batch's values, the ZZ projects, and NATION_3 as first written."""
    src = _src(spark, sf_dir)
    target = RUN.Target(scratch_path(spark, "upsert-resumen"))
    rows = _written_summary(spark, src, "upsert-source")
    first = rows.withColumn("coste_qwark", F.col("coste_qwark") + 1)
    vanished = first.where(F.col("company_name") == ONE_COMPANY) \
        .withColumn("project_no", F.concat(F.lit("ZZ"), "project_no"))
    for batch in (first.unionByName(vanished), rows.where("company_name <> 'NATION_3'")):
        T.upsert(spark, RUN._prep(batch, T.RunStamp.new()), target.path(RUN.SUMMARY), S.KEY_COLS,
                 partition_by=RUN.SUMMARY_PARTITIONS, schema=RUN.summary_schema())
    return _read_back(spark, target.path(RUN.SUMMARY), schema=RUN.summary_schema()).select(*S.OUT_COLS)


def _upsert_facturas(spark, sf_dir):
    """The month's invoices, summed to the sink key; first with every cost one higher."""
    src = _src(spark, sf_dir)
    path = RUN.Target(scratch_path(spark, "upsert-facturas")).path(RUN.INVOICES)
    rows = RUN.invoice_rows(src, P)
    RUN.upsert_invoices(spark, rows.withColumn("coste_registrado_a_origen", F.col("coste_registrado_a_origen") + 1),
                        T.RunStamp.new(), path)
    RUN.upsert_invoices(spark, rows, T.RunStamp.new(), path)
    return _read_back(spark, path, schema=RUN.invoice_schema()).select(*RUN.INVOICE_COLS)


def _append_detail(name):
    def run(spark, sf_dir):
        src = _src(spark, sf_dir)
        target = RUN.Target(scratch_path(spark, f"append-{name}"))
        df = RUN.detail_rows(src, P)[name]
        cols = df.columns
        df = RUN._prep(df, T.RunStamp.new()).withColumn("period_date", F.lit(P.cut).cast("date"))
        T.append(df, target.path(name), partition_by="period_date")
        return _read_back(spark, target.path(name)).select(*cols)
    return run


def _latest_snapshot(spark, sf_dir):
    """Run log of two runs (every project, then, later and with other amounts, the
    projects that the gap fill names); the latest-row view keeps one row per key."""
    src = _src(spark, sf_dir)
    path = scratch_path(spark, "latest")
    rows = _written_summary(spark, src, "latest-source")
    first = T.RunStamp.new()
    later = T.RunStamp(first.run_id, first.run_ts + dt.timedelta(hours=1))
    # the older run is written last: the order of writing must not matter
    keys = G.backfill_requests(src, _snapshot(src), P).select("company_name", "project_no")
    again = rows.join(keys, ["company_name", "project_no"], "left_semi").withColumn("contratos", F.col("contratos") + 1000)
    T.append(RUN._prep(again, later), path, partition_by="period_date")
    T.append(RUN._prep(rows, first), path, partition_by="period_date")
    latest = T.latest_rows(T.read_table(spark, path, RUN.summary_schema()), S.KEY_COLS)
    return latest.drop(*T.META_COLS).select(*S.OUT_COLS)


def _backfill_isolated(spark, sf_dir):
    """The missing projects, the smallest of each company asked for under a second company id too, so
    that its rows have each key twice: those fail, all others are written."""
    src = _src(spark, sf_dir)
    path = scratch_path(spark, "isolated-requests")
    G.backfill_requests(src, _snapshot(src), P).write.parquet(path)
    reqs = spark.read.parquet(path)
    bad = reqs.groupBy("company_name").agg(F.min("project_no").alias("project_no"))
    bad = bad.select("company_name", "project_no", F.lit("another").alias("company_id"))
    target = RUN.Target(scratch_path(spark, "isolated"))
    out = RUN.run_snapshot(spark, src, reqs.unionByName(bad), P, target, details=False)
    written = T.read_table(spark, target.path(RUN.SUMMARY), RUN.summary_schema()).groupBy("company_name", "project_no") \
        .agg(F.lit("written").alias("outcome"), F.count(F.lit(1)).alias("n_rows"), F.sum("contratos").alias("contratos"))
    failed = out["failed"].select("company_name", "project_no", F.col("refused_because").alias("outcome"))
    return written.unionByName(failed, allowMissingColumns=True)


def _evolve_schema(spark, sf_dir):
    """A first batch brings two columns that the summary doesn't declare; a second one, without
    them, replaces the rows of every other project. The others keep theirs."""
    src = _src(spark, sf_dir)
    path = RUN.Target(scratch_path(spark, "evolve")).path(RUN.SUMMARY)
    rows = _written_summary(spark, src, "evolve-source")
    wider = rows.withColumns({"nota": F.concat(F.lit("nota "), "project_no"), "margen": F.col("contratos") * 2})
    again = rows.where(F.substring("project_no", 4, 99).cast("int") % 2 == 0)
    for batch in (wider, again):
        T.upsert(spark, RUN._prep(batch, T.RunStamp.new()), path, S.KEY_COLS, partition_by=RUN.SUMMARY_PARTITIONS,
                 schema=RUN.summary_schema())
    return _read_back(spark, path, schema=RUN.summary_schema()).select(*S.OUT_COLS, "nota", "margen")


def _keep_first(spark, sf_dir):
    """The earliest unposted document of each (company, project, chapter)."""
    docs = D.unposted_docs(_src(spark, sf_dir), None, None, P.month_start, P.month_end, sort=False)
    return T.keep_first(decimals_to_double(docs), ["company_id", "project_no", "job_task_no"], ["fecha_factura", "base_amount"])


def _run_log(spark, sf_dir):
    """The log of a run for each company, read back by its parameters."""
    src = _src(spark, sf_dir)
    path = scratch_path(spark, "run-log")
    for r in R.all_projects(src).groupBy("company_name").count().collect():  # a row a company
        T.append_run_log(spark, path, T.RunStamp.new(), {"company": r[0], "projects": r[1], "project": None, "year": P.year, "month": P.month})
    log = spark.read.parquet(path).select(F.from_json("params_json", "company string, projects long, project string, year int, month int").alias("p"),
                                          F.col("params_json").contains('"project":null').alias("no_project"))
    return log.select("p.company", "p.projects", "no_project", "p.year", "p.month")


def _coerced_cells(spark, sf_dir):
    """Spreadsheet cells coerced on load: bad dates and numbers become null."""
    cells = spark.sql(O.COERCED_CELLS.format(lineitem=f"parquet.`{sf_dir}/lineitem.parquet`"))
    spec = Table("cells", (Col("id", "bigint", ("l_orderkey",)), Col("fecha", "date"), Col("importe", "decimal(18,6)")))
    return decimals_to_double(resolve_columns(cells, spec, cast=True))


def _as_of(src, share: float):
    """The sources as they were when that share of the entries had been made: later ones are missing, and
    invoices that have changed since have their old amount and aren't registered yet."""
    out = dict(src)
    for of in (B.COST, B.CERTIFIED):
        out[of.source] = src[of.source].where(F.pmod(F.xxhash64(of.mark), F.lit(1000)) < int(1000 * share))
    fq = src[B.UNPOSTED.source]
    old = F.pmod(F.xxhash64("Change_No"), F.lit(1000)) < int(1000 * share)
    changes = F.pmod(F.col("Change_No"), F.lit(5)) == 0
    out[B.UNPOSTED.source] = fq.where(old).withColumns({
        "baseAmount": F.when(changes, F.abs("baseAmount") + 1).otherwise(F.col("baseAmount")).cast("decimal(18,6)"),
        "bc_documentNo": F.when(~changes, F.col("bc_documentNo"))})
    return out


def _marked(src, share: float):
    """Change marks in the order in which ``_as_of`` lets entries appear, changed invoices last."""
    out = dict(src)
    for of in B.BALANCES:
        late = (F.pmod(F.xxhash64(of.mark), F.lit(1000)) >= int(1000 * share))
        if of.document:
            late = late | (F.pmod(F.col(of.mark), F.lit(5)) == 0)
        out[of.source] = src[of.source].withColumn(of.mark, F.when(late, F.col(of.mark) + (1 << 40)).otherwise(F.col(of.mark)))
    return out


def _rollup(spark, src, balances=B.BALANCES) -> tuple:
    """Balances of November, from 60 % of the entries, and of December, from 80 %; and the sources with all."""
    rollup = B.Rollup(scratch_path(spark, "balances"))
    for period, share in ((P.previous().previous(), 0.6), (P.previous(), 0.8)):
        for of in balances:
            B.close_month(spark, _as_of(src, share), of, period, rollup)
        src = _marked(src, share)
    return rollup, src


def _to_date(of, fn, *args):
    """A to-date aggregate from the balance of December and the entries since."""
    def run(spark, sf_dir):
        rollup, src = _rollup(spark, _src(spark, sf_dir), [of])
        sums = B.to_date(spark, src, of, P, rollup)
        return decimals_to_double(fn(src, R.all_projects(src), P, *args, agg=sums))
    return run


def _resumen_rollup(spark, sf_dir):
    rollup, src = _rollup(spark, _src(spark, sf_dir))
    return S.resumen(src, R.all_projects(src), P, rollup=rollup)


def _cert_by_name(spark, sf_dir):
    """Certified revenue of requests without a company id: planning lines match by company name."""
    src = _src(spark, sf_dir)
    named = R.all_projects(src).withColumn("company_id", F.lit(None).cast("string"))
    return decimals_to_double(C.cert_by_chapter(src, named, P, False))


def _llm():
    """Query and SQL tables of the training-data operators and their pipeline;
    empty without the subpackage."""
    try:
        import corpus_pipeline
        from costlens.llm import queries as llm
    except ModuleNotFoundError as e:
        if e.name not in ("corpus_pipeline", "costlens.llm"):
            raise
        return {}, {}
    sql = dict(llm.oracle_sql())
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return dict(llm.queries(), pipeline=corpus_pipeline.run), sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    prev = P.previous()
    return _llm()[0] | {
        # §2.6 composite datasets
        "ledger_entries": _ds(D.ledger_entries, None, None, P.cut),
        "ledger_entries_one_project": _ledger_one,
        "task_lines": _ds(D.task_lines, None, None),
        "task_lines_one_project": _one(D.task_lines),
        "unposted_pending_one_project": _one(D.unposted_pending, P.cut),
        "invoices_by_chapter_one_company": _ds(D.invoices_by_chapter, ONE_COMPANY, None, P.month_start, P.month_end),
        "unposted_docs_one_company": _ds(D.unposted_docs, ONE_COMPANY, None, P.month_start, P.month_end),
        "pending_docs_one_project": _one(D.pending_docs, P.month_start, P.month_end),
        "tracking_docs_one_project": _one(D.tracking_docs, P.month_start, P.month_end),
        "resource_entries_one_company": _ds(D.resource_entries, ONE_COMPANY, None, P.month_start, P.month_end),
        "unposted_pending": _ds(D.unposted_pending, None, None, P.cut),
        "overhead_pct": _overhead_pct,
        "pending_month": _ds(D.pending_month, None, None, P.month_start, P.month_end),
        "pending_month_one_project": _pending_one,
        "pending_prev_month": _ds(D.pending_month, None, None, prev.month_start, prev.month_end),
        "production_month": _ds(D.production_month, None, None, P.month_start, P.month_end),
        "production_month_one_project": _production_one,
        "production_prev_month": _ds(D.production_month, None, None, prev.month_start, prev.month_end),
        "invoices_by_chapter": _ds(D.invoices_by_chapter, None, None, P.month_start, P.month_end),
        "unposted_docs": _ds(D.unposted_docs, None, None, P.month_start, P.month_end),
        "pending_docs": _ds(D.pending_docs, None, None, P.month_start, P.month_end),
        "tracking_docs": _ds(D.tracking_docs, None, None, P.month_start, P.month_end),
        "resource_entries": _ds(D.resource_entries, None, None, P.month_start, P.month_end),
        # §2.5 chapter aggregates (per project of every request)
        "cost_to_date_by_chapter": _per_request(C.cost_by_chapter, False),
        "cost_month_by_chapter": _per_request(C.cost_by_chapter, True),
        "cert_to_date_by_chapter": _per_request(C.cert_by_chapter, False),
        "cert_month_by_chapter": _per_request(C.cert_by_chapter, True),
        "pending_cert_by_chapter": _per_request(C.production_by_chapter, "cpend"),
        "remaining_prod_by_chapter": _per_request(C.production_by_chapter, "resto"),
        "prev_pending_cert_by_chapter": _per_request(C.production_by_chapter, "cpend", True),
        "prev_remaining_prod_by_chapter": _per_request(C.production_by_chapter, "resto", True),
        "pending_cost_by_chapter": _per_request(C.pending_cost_by_chapter),
        "unposted_cost_by_chapter": _per_request(C.unposted_cost_by_chapter),
        "contract_by_chapter": _per_request(C.task_by_chapter, "contr"),
        "planned_by_chapter": _per_request(C.task_by_chapter, "plan"),
        # spine, transform rows, totals
        "chapter_spine": _per_request(S.chapter_spine),
        "direct_rows": _per_request(S.transform_rows, "direct"),
        "overhead_rows": _per_request(S.transform_rows, "overhead"),
        "direct_totals": _per_request(S.direct_totals),
        # the summary
        "resumen": _resumen,
        "resumen_with_prev_month": _resumen_prev,
        # gap fill
        "expected_projects": _expected,
        "existing_projects": _existing,
        "missing_projects": _missing,
        "expected_projects_company": _expected_company,
        "existing_projects_company": _existing_company,
        "backfill_dry_run": _backfill_dry_run,
        "backfill_missing": _backfill,
        # sinks (written to a fresh folder under the checkpoint dir, read back)
        "upsert_resumen": _upsert_resumen,
        "upsert_facturas": _upsert_facturas,
        "append_unposted_docs": _append_detail(RUN.UNPOSTED_DOCS),
        "append_pending_docs": _append_detail(RUN.PENDING_DOCS),
        "append_tracking_docs": _append_detail(RUN.TRACKING_DOCS),
        "append_resource_entries": _append_detail(RUN.RESOURCES),
        "latest_snapshot": _latest_snapshot,
        # isolation of failures, schema evolution, keep-first, run log, coerced cells
        "backfill_isolated": _backfill_isolated,
        "evolve_schema": _evolve_schema,
        "keep_first_documents": _keep_first,
        "run_log": _run_log,
        "coerced_cells": _coerced_cells,
        # to-date metrics from balances, and planning lines matched by name
        "cost_to_date_rollup": _to_date(B.COST, C.cost_by_chapter, False),
        "cert_to_date_rollup": _to_date(B.CERTIFIED, C.cert_by_chapter, False),
        "unposted_cost_rollup": _to_date(B.UNPOSTED, C.unposted_cost_by_chapter),
        "resumen_rollup": _resumen_rollup,
        "cert_to_date_by_name": _cert_by_name,
    }


def oracle_sql() -> dict[str, str]:
    return _llm()[1] | {
        "ledger_entries": O.ledger_entries(),
        "ledger_entries_one_project": O.ledger_entries(filtered=True),
        "task_lines": O.task_lines(),
        "task_lines_one_project": O.task_lines(filtered=True),
        "unposted_pending_one_project": O.unposted_pending(filtered=True),
        "invoices_by_chapter_one_company": O.invoices_by_chapter(company=True),
        "unposted_docs_one_company": O.unposted_docs(company=True),
        "pending_docs_one_project": O.pending_docs(filtered=True),
        "tracking_docs_one_project": O.tracking_docs(filtered=True),
        "resource_entries_one_company": O.resource_entries(company=True),
        "unposted_pending": O.unposted_pending(),
        "overhead_pct": O.overhead_pct(),
        "pending_month": O.pending_month(),
        "pending_month_one_project": O.pending_month(filtered=True),
        "pending_prev_month": O.pending_month(prev=True),
        "production_month": O.production_month(),
        "production_month_one_project": O.production_month(filtered=True),
        "production_prev_month": O.production_month(prev=True),
        "invoices_by_chapter": O.invoices_by_chapter(),
        "unposted_docs": O.unposted_docs(),
        "pending_docs": O.pending_docs(),
        "tracking_docs": O.tracking_docs(),
        "resource_entries": O.resource_entries(),
        "cost_to_date_by_chapter": O.cost_to_date_by_chapter(),
        "cost_month_by_chapter": O.cost_month_by_chapter(),
        "cert_to_date_by_chapter": O.cert_to_date_by_chapter(),
        "cert_month_by_chapter": O.cert_month_by_chapter(),
        "pending_cert_by_chapter": O.pending_cert_by_chapter(),
        "remaining_prod_by_chapter": O.remaining_prod_by_chapter(),
        "prev_pending_cert_by_chapter": O.prev_pending_cert_by_chapter(),
        "prev_remaining_prod_by_chapter": O.prev_remaining_prod_by_chapter(),
        "pending_cost_by_chapter": O.pending_cost_by_chapter(),
        "unposted_cost_by_chapter": O.unposted_cost_by_chapter(),
        "contract_by_chapter": O.contract_by_chapter(),
        "planned_by_chapter": O.planned_by_chapter(),
        "chapter_spine": O.chapter_spine(),
        "direct_rows": O.direct_rows(),
        "overhead_rows": O.overhead_rows(),
        "direct_totals": O.direct_totals(),
        "resumen": O.resumen(),
        "resumen_with_prev_month": O.resumen_with_prev_month(),
        "expected_projects": O.expected_projects(),
        "existing_projects": O.existing_projects(),
        "missing_projects": O.missing_projects(),
        "expected_projects_company": O.expected_projects_company(),
        "existing_projects_company": O.existing_projects_company(),
        "backfill_dry_run": O.backfill_dry_run(),
        "backfill_missing": O.backfill_missing(),
        "upsert_resumen": O.upsert_resumen(),
        "upsert_facturas": O.upsert_facturas(),
        "append_unposted_docs": O.cleaned(O.unposted_docs(), O.TEXT_COLUMNS["unposted_docs"]),
        "append_pending_docs": O.cleaned(O.pending_docs(), O.TEXT_COLUMNS["pending_docs"]),
        "append_tracking_docs": O.cleaned(O.tracking_docs(), O.TEXT_COLUMNS["tracking_docs"]),
        "append_resource_entries": O.cleaned(O.resource_entries(), O.TEXT_COLUMNS["resource_entries"]),
        "latest_snapshot": O.latest_snapshot(),
        "backfill_isolated": O.backfill_isolated(),
        "evolve_schema": O.evolve_schema(),
        "keep_first_documents": O.keep_first_documents(),
        "run_log": O.run_log(),
        "coerced_cells": O.coerced_cells(),
        "cost_to_date_rollup": O.cost_to_date_by_chapter(),
        "cert_to_date_rollup": O.cert_to_date_by_chapter(),
        "unposted_cost_rollup": O.unposted_cost_by_chapter(),
        "resumen_rollup": O.resumen(),
        "cert_to_date_by_name": O.cert_to_date_by_chapter(),
    }
