"""A snapshot run: the summary and the five detail tables for many requests.

A request whose rows the summary can't hold (a null key, two rows of one key) fails alone:
its rows go to the summary's quarantine with the reason, its details aren't written, and all
other requests are, as if each had a run of its own.

One run id / timestamp stamps every sink of the run (the reference mints one
per sink) and one run-log row records the parameters. Each sink is written by
its own Spark job; the summary upsert replaces only the run's period
partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StringType, StructField, StructType, TimestampType

from costlens.functions.text import clean_value, trim_ws
from costlens.operators import datasets as D
from costlens.output import decimals_to_double
from costlens.plans import gapfill as G
from costlens.plans.period import Period
from costlens.plans.resumen import KEY_COLS, NUM_COLS, OUT_COLS, resumen
from costlens.plans.rollup import Rollup
from costlens.sinks.tables import (
    NULL_KEY, RunStamp, append, append_run_log, clean_text_columns, quarantined, read_table, recover, stamp_run, table_exists,
    upsert,
)
from costlens.sources.loaders import Sources
from costlens.session import scratch_path

SUMMARY = "resumen_seguimiento"
INVOICES = "facturas"
UNPOSTED_DOCS = "qwark_coste_docs"
PENDING_DOCS = "pendientes_jo"
TRACKING_DOCS = "seguimiento_produccion"
RESOURCES = "resource_ledger_entries"
RUN_LOG = "snapshot_run"

# The summary is partitioned by month and company: a run or a backfill
# rewrites only the (month, company) partitions it touches.
SUMMARY_PARTITIONS = ["period_date", "company_name"]

# What fails alone in a run.
REQUEST = ["company_name", "project_no"]

INVOICE_KEYS = ["company_id", "invoice_id", "capitulo"]
# Invoices are partitioned by the month of their date: a month's run leaves the
# others alone, unless an invoice's date has moved.
INVOICE_PARTITION = "mes_factura"
INVOICE_COLS = ["company_id", "invoice_id", "job_no", "capitulo", "numero_factura", "proveedor",
                "fecha_factura", "coste_registrado_a_origen"]


def summary_schema() -> StructType:
    """Column types of the summary table (fixed on read, see ``read_table``)."""
    fields = [StructField("snapshot_run_id", StringType()), StructField("snapshot_run_ts", TimestampType())]
    for c in OUT_COLS:
        t = DoubleType() if c in NUM_COLS else DateType() if c == "period_date" else StringType()
        fields.append(StructField(c, t))
    return StructType(fields)


def invoice_schema() -> StructType:
    """Column types of the invoice table."""
    fields = [StructField("snapshot_run_id", StringType()), StructField("snapshot_run_ts", TimestampType())]
    for c in [*INVOICE_COLS, INVOICE_PARTITION]:
        t = DateType() if c == "fecha_factura" else DoubleType() if c.startswith("coste") else StringType()
        fields.append(StructField(c, t))
    return StructType(fields)


@dataclass(frozen=True)
class Target:
    """Root folder of the snapshot tables (shared storage on a cluster)."""
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"


def _prep(df: DataFrame, stamp: RunStamp) -> DataFrame:
    return stamp_run(clean_text_columns(decimals_to_double(df)), stamp)


def summary_rows(src: Sources, requests: DataFrame, period: Period, restrict: bool = False,
                 rollup: Rollup | None = None) -> DataFrame:
    return resumen(src, requests, period, restrict=restrict, rollup=rollup)


def invoice_rows(src: Sources, period: Period, requests: DataFrame | None = None) -> DataFrame:
    inv = D.invoices_by_chapter(src, None, None, period.month_start, period.month_end, sort=False)
    if requests is not None:
        ids = requests.join(
            src["companies_bc"].select(F.col("id").alias("_cid"), F.col("name").alias("_cn")),
            F.col("company_name") == F.col("_cn"), "inner").select("_cid", F.col("project_no").alias("_p"))
        inv = inv.join(ids, (inv["CompanyId"] == ids["_cid"]) & (inv["Job_No"] == ids["_p"]), "left_semi")
    return inv.select(F.col("CompanyId").cast("string").alias("company_id"),
                      F.col("id").cast("string").alias("invoice_id"),
                      F.col("Job_No").alias("job_no"), "capitulo", "numero_factura", "proveedor",
                      "fecha_factura", "coste_registrado_a_origen")


def invoice_sink_rows(rows: DataFrame) -> DataFrame:
    """Invoice rows at the sink's key (company, invoice, cleaned chapter): costs are
    summed, since cleaning or several jobs may bring rows of one key together; the
    other columns keep their smallest value. ``rows`` are prepared (``_prep``)."""
    others = [c for c in INVOICE_COLS if c not in (*INVOICE_KEYS, "coste_registrado_a_origen")]
    stamps = [c for c in rows.columns if c not in INVOICE_COLS]
    out = rows.groupBy(*stamps, *INVOICE_KEYS).agg(
        F.sum("coste_registrado_a_origen").alias("coste_registrado_a_origen"), *[F.min(c).alias(c) for c in others])
    return out.select(*rows.columns, F.date_format("fecha_factura", "yyyy-MM").alias(INVOICE_PARTITION))


def upsert_invoices(spark: SparkSession, rows: DataFrame, stamp: RunStamp, path: str) -> dict:
    """Sum to the sink key in DECIMAL, then upsert."""
    exact = stamp_run(clean_text_columns(rows), stamp)
    return upsert(spark, decimals_to_double(invoice_sink_rows(exact)), path, INVOICE_KEYS,
                  partition_by=INVOICE_PARTITION, schema=invoice_schema())


def _semi(df: DataFrame, requests: DataFrame | None, company_col: str, project_col: str,
          strip: bool = False) -> DataFrame:
    if requests is None:
        return df
    r = requests.select(F.col("company_name").alias("_c"), F.col("project_no").alias("_p"))
    c, p = F.col(company_col), F.col(project_col)
    if strip:
        c, p = trim_ws(c), trim_ws(p)
    return df.join(r, (c == F.col("_c")) & (p == F.col("_p")), "left_semi")


def detail_rows(src: Sources, period: Period, requests: DataFrame | None = None) -> dict[str, DataFrame]:
    a, b = period.month_start, period.month_end
    unposted = _semi(D.unposted_docs(src, None, None, a, b, sort=False), requests, "company_name", "project_no")
    pending = _semi(D.pending_docs(src, None, None, a, b), requests, "company_name", "project_no", strip=True)
    tracking = _semi(D.tracking_docs(src, None, None, a, b), requests, "company_name", "project_no", strip=True)
    res = D.resource_entries(src, None, None, a, b)
    if requests is not None:
        names = src["companies_bc"].select(F.col("id").cast("string").alias("_cid"), F.col("name").alias("_cn"))
        res = res.join(names, res["company_id"] == F.col("_cid"), "left")
        res = _semi(res, requests, "_cn", "job_no").drop("_cid", "_cn")
    return {UNPOSTED_DOCS: unposted, PENDING_DOCS: pending, TRACKING_DOCS: tracking, RESOURCES: res}


def without(requests: DataFrame, failed: DataFrame) -> DataFrame:
    """The requests whose cleaned names aren't among ``failed``."""
    bad = failed.select(*[F.col(c).alias(f"_bad_{c}") for c in REQUEST])
    same = [clean_value(c).eqNullSafe(F.col(f"_bad_{c}")) for c in REQUEST]
    return requests.join(bad, same[0] & same[1], "left_anti")


def run_snapshot(spark: SparkSession, src: Sources, requests: DataFrame, period: Period,
                 target: Target, details: bool = True, all_projects: bool = False,
                 stamp: RunStamp | None = None, rollup: Rollup | None = None) -> dict:
    """Write the summary (upsert by its 6 keys, partition = period) and, with
    ``details``, the invoice table (upsert) and the four detail photos
    (append). ``all_projects`` marks a run over every project, which lets the
    detail queries skip the request semi-joins. ``rollup`` takes the to-date metrics from
    the last balances (``rollup.close_all`` closes a month).

    The summary must succeed but for the requests that it refuses, which ``failed``
    lists (company_name, project_no, refused_because; None if there are none); a detail
    table that fails is reported under its name as ``{"error": ...}`` and doesn't stop the
    others, and the run is logged in any case, as in the reference."""
    stamp = stamp or RunStamp.new()
    out = {"snapshot_run_id": stamp.run_id, "failed": None}

    def attempt(name: str, load) -> None:
        try:
            out[name] = load()
        except Exception as exc:  # a detail table is best effort
            out[name] = {"error": f"{type(exc).__name__}: {exc}"}

    def photo(name: str):
        rows = _prep(detail_rows(src, period, req)[name], stamp)
        return append(rows.withColumn("period_date", F.lit(period.cut).cast("date")),
                      target.path(name), partition_by="period_date")

    try:
        out[SUMMARY] = upsert(spark, _prep(summary_rows(src, requests, period, not all_projects, rollup), stamp),
                              target.path(SUMMARY), KEY_COLS, partition_by=SUMMARY_PARTITIONS,
                              schema=summary_schema(), isolate=REQUEST)
        req = None if all_projects else requests
        if out[SUMMARY]["rejected"]:
            refused = quarantined(spark, target.path(SUMMARY), stamp.run_id)
            out["failed"] = refused.select(*REQUEST, "refused_because").distinct()
            req = without(requests, out["failed"])
        if details:
            attempt(INVOICES, lambda: upsert_invoices(spark, invoice_rows(src, period, req), stamp, target.path(INVOICES)))
            for name in (UNPOSTED_DOCS, PENDING_DOCS, TRACKING_DOCS, RESOURCES):
                attempt(name, lambda name=name: photo(name))
    finally:
        append_run_log(spark, target.path(RUN_LOG), stamp,
                       {"year": period.year, "month": period.month, "details": details})
    return out


def snapshot_table(spark: SparkSession, target: Target, empty_like: DataFrame | None = None) -> DataFrame:
    """The summary table, or an empty frame of the given shape before the first run."""
    path = target.path(SUMMARY)
    recover(spark, path)  # a run opens the table: an interrupted write is finished first
    if table_exists(spark, path):
        return read_table(spark, path, summary_schema())
    if empty_like is None:
        raise FileNotFoundError(path)
    return empty_like.limit(0)


def backfill_missing(spark: SparkSession, src: Sources, period: Period, target: Target,
                     snapshot: DataFrame | None = None, dry_run: bool = False,
                     company: str | None = None, details: bool = True, rollup: Rollup | None = None) -> dict:
    """Find the projects without a summary row in the month and run them all
    in one batched snapshot (the reference runs one pipeline per project).

    ``missing`` counts them, ``requests`` lists those that can be run; with ``dry_run``
    nothing else is done. ``failed`` lists the pairs that couldn't be written, with the
    reason (pairs without a company or project among them), and ``run`` counts the
    requests that were."""
    snap = snapshot if snapshot is not None else snapshot_table(spark, target)
    reqs = G.backfill_requests(src, snap, period, company)
    # the request set is written once: every sink of the run reads it, and the
    # summary it depends on changes meanwhile
    path = scratch_path(spark, "backfill-requests")
    reqs.write.parquet(path)
    reqs = spark.read.schema(reqs.schema).parquet(path)
    nameless = scratch_path(spark, "backfill-nameless")
    G.unnamed_missing(src, snap, period, company).select(*REQUEST, F.lit(NULL_KEY).alias("refused_because")).write.parquet(nameless)
    failed = spark.read.schema(", ".join(f"{c} string" for c in (*REQUEST, "refused_because"))).parquet(nameless)
    n, unnamed = reqs.count(), failed.count()
    out = {"missing": n + unnamed, "run": 0, "requests": reqs, "failed": failed}
    if dry_run or n == 0:
        return out
    res = run_snapshot(spark, src, reqs, period, target, details=details, rollup=rollup)
    if res["failed"] is not None:
        out["failed"] = failed.unionByName(res["failed"])
        n = without(reqs, res["failed"]).count()
    return out | {"run": n, "result": res}


def run_from_params(spark: SparkSession, src: Sources, params: dict, target: Target) -> dict:
    """Parameter-dict entry point (the reference's JSON / CLI entry, as a
    function): ``{"company_name"?, "project_no"?, "year", "month", "details"?}``.
    Missing company / project mean every matching project. Returns
    ``{"ok", "message", "params", "result"}``; errors are reported, not raised."""
    from costlens.plans import requests as R
    try:
        period = Period(int(params["year"]), int(params["month"]))
        company, project = params.get("company_name") or None, params.get("project_no") or None
        reqs = R.all_projects(src, company=company, project=project)
        if company is not None and project is not None:
            reqs = R.explicit(spark, src, [(company, project)])
        result = run_snapshot(spark, src, reqs, period, target, details=bool(params.get("details", True)),
                              all_projects=company is None and project is None)
        if result["failed"] is not None and not result[SUMMARY]["inserted"]:
            raise ValueError(f"refused: {result['failed'].first()['refused_because']}")
        return {"ok": True, "message": "snapshot written", "params": params, "result": result}
    except Exception as exc:  # reported to the caller like the reference's entry
        return {"ok": False, "message": f"{type(exc).__name__}: {exc}", "params": params, "result": None}
