"""Per-chapter aggregates of the monthly summary.

Every source is first aggregated on its *own* keys (job, company id, raw
chapter, ...), so a hot project or a hot 'None' chapter collapses map-side
before any shuffle; only then is it mapped onto the request keys
(company_name, project_no) through small joins. Each ``*_part`` returns the
columns

    company_name, project_no, raw_cap, cap, in_spine, <metrics...>

where ``cap`` is the normalised chapter that feeds the chapter spine and
``raw_cap`` the chapter as stored. Ledger, planning and production amounts
are looked up by the *raw* chapter in the reference, so they only land on a
spine chapter when the raw text already is normalised (see ``raw_exact``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.functions.dates import as_date, as_ts, lit_date, lit_ts, on_or_before, within
from costlens.functions.text import (
    contains_ci, derive_project, is_blank, normalize_chapter, normalize_text, trim_ws,
)
from costlens.operators.datasets import CERT, not_certification
from costlens.operators.spelling import semi_spelled
from costlens.plans.period import Period
from costlens.sources.loaders import Sources

# metric columns carried by the tall union (all DECIMAL or counts)
PART_METRICS = [
    "cbo", "cbm",                     # posted cost: to date, current month
    "pend",                           # pending cost (month)
    "qwk",                            # unposted invoices, to date
    "cpend", "resto",                 # pending certification, remaining production (month)
    "contr", "plan",                  # contract price, planned cost
    "rows_o", "sum_o", "n_o",         # certification to date: rows, sum, non-null count
    "rows_m", "sum_m", "n_m",         # certification in the month
    "cpend_prev", "resto_prev",       # production of the previous month (option)
]


def _jobs(src: Sources) -> DataFrame:
    return src["job_list_bc"].select(F.col("No"), F.col("CompanyId").alias("_jcid"))


def _companies(src: Sources) -> DataFrame:
    return src["companies_bc"].select(F.col("id").alias("_cid"), F.col("name").alias("company_name"))


def _companies_qwark(src: Sources) -> DataFrame:
    return src["companies_qwark"].select(F.col("id").alias("_cq_id"), F.col("name").alias("company_name"))


def _business_units(src: Sources) -> DataFrame:
    return src["businessUnit_qwark"].select(
        F.col("id").cast("string").alias("_bu_id"), F.col("Unidad de negocio").alias("_unit"))


def _to_requests(df: DataFrame, req: DataFrame, left_keys, right_keys) -> DataFrame:
    """Inner-join a source aggregate to the requests and take the request's
    (company_name, project_no). Request columns are renamed first so the join
    never depends on resolving same-named columns of a shared lineage."""
    r = req.select(*[F.col(c).alias(f"_r_{c}") for c in req.columns])
    cond = None
    for lk, rk in zip(left_keys, right_keys):
        c = F.col(lk) == F.col(f"_r_{rk}")
        cond = c if cond is None else cond & c
    keep = [c for c in df.columns if c not in ("company_name", "project_no", "company_id")]
    return df.join(r, cond, "inner").select(
        F.col("_r_company_name").alias("company_name"), F.col("_r_project_no").alias("project_no"),
        F.col("_r_company_id").alias("company_id"), *keep)


def _with_project(src: Sources, agg: DataFrame) -> DataFrame:
    """Ledger aggregates with their project and company name. Jobs and companies are
    joined one after the other, as plain scans that Spark can broadcast by size."""
    jobs, comps = _jobs(src), _companies(src)
    j = agg.join(jobs, (agg["Job_No"] == jobs["No"]) & (agg["CompanyId"] == jobs["_jcid"]), "inner")
    return j.join(comps, F.col("_jcid") == F.col("_cid"), "inner").withColumn("project_no", F.col("No"))


def _task_key(job, company) -> "F.Column":
    """The reference's text key of a job, under which task lines match."""
    return F.concat(job, F.lit("_"), company)


def ledger_part(src: Sources, req: DataFrame, period: Period, agg: DataFrame | None = None) -> DataFrame:
    """Posted cost (non-certification) to date and in the month, per raw chapter.
    Every ledger row up to the cut adds its chapter to the spine. ``agg``: the sums per
    job, company id and raw chapter, where a balance has them (``plans.rollup``)."""
    fle = src["job_ledger_entries_bc"]
    d = as_date("Posting_Date")
    nc = not_certification("Gen_Prod_Posting_Group")
    if agg is None:
        agg = fle.where(on_or_before(fle, "Posting_Date", period.cut)).groupBy("Job_No", "CompanyId", "Job_Task_No").agg(
            F.sum(F.when(nc, F.col("Total_Cost_LCY"))).alias("cbo"),
            F.sum(F.when(nc & (d >= lit_date(period.month_start)), F.col("Total_Cost_LCY"))).alias("cbm"),
        )
    j = _with_project(src, agg).select("company_name", "project_no", F.col("Job_Task_No").alias("raw_cap"), "cbo", "cbm")
    j = _to_requests(j, req, ["company_name", "project_no"], ["company_name", "project_no"])
    return j.withColumns({"cap": normalize_chapter("raw_cap"), "in_spine": F.lit(True)})


def production_part(src: Sources, req: DataFrame, period: Period, prev: bool = False) -> DataFrame:
    """Pending certification and remaining production of the month (raw chapter),
    matched to requests on normalised company / project text. Rows are summed by raw
    spelling first; only the sums' names are normalised."""
    p = period.previous() if prev else period
    d = src["DimSeguimientoProduccion"]
    d = d.where(within(d, "fecha_produccion", p.month_start, p.month_end))
    raw = F.coalesce(F.col("capitulo_codigo").cast("string"), F.col("capitulo").cast("string"))
    agg = d.groupBy("empresa", "proyecto", raw.alias("raw_cap")).agg(
        F.sum("certificacion_pendiente").alias("cpend"),
        F.sum("resto_produccion").alias("resto"))
    agg = agg.select(normalize_text("empresa").alias("_ck"), normalize_text("proyecto").alias("_pk"), "raw_cap", "cpend", "resto")
    j = _to_requests(agg, req, ["_ck", "_pk"], ["company_key", "project_key"]).drop("_ck", "_pk")
    return j.withColumns({"cap": normalize_chapter("raw_cap"), "in_spine": F.lit(True)})


def pending_part(src: Sources, req: DataFrame, period: Period) -> DataFrame:
    """Pending cost of the month, per normalised chapter (summed by raw spelling first)."""
    d = src["DimPendientesProduccion"]
    d = d.where(within(d, "fecha_produccion", period.month_start, period.month_end))
    raw = F.coalesce(F.col("capitulo_codigo").cast("string"), F.col("capitulo").cast("string"))
    agg = d.groupBy("empresa", "proyecto", raw.alias("_raw")).agg(F.sum("coste_pendiente").alias("pend"))
    agg = agg.select(normalize_text("empresa").alias("_ck"), normalize_text("proyecto").alias("_pk"),
                     normalize_chapter("_raw").alias("cap"), "pend")
    j = _to_requests(agg, req, ["_ck", "_pk"], ["company_key", "project_key"]).drop("_ck", "_pk")
    return j.withColumns({"raw_cap": F.col("cap"), "in_spine": F.lit(True)})


def unposted_part(src: Sources, req: DataFrame, period: Period, agg: DataFrame | None = None) -> DataFrame:
    """Unposted positive invoices up to the cut, per normalised chapter
    (blank chapter -> 'None'). Pre-aggregated on the invoice's own keys before
    the company / business-unit lookups, or taken from a balance (``agg``)."""
    if agg is None:
        fq = src["facturas_qwark"]
        fq = fq.where(on_or_before(fq, "documentDate", period.cut) & (F.col("baseAmount") > 0)
                      & ~contains_ci("bc_documentNo", "CFR"))
        agg = fq.groupBy("company", "bunisnessUnit", "posting_jobNo",
                         normalize_chapter("posting_jobTaskNo").alias("cap")) \
            .agg(F.sum("baseAmount").alias("qwk"))
    cq = _companies_qwark(src)
    bu = _business_units(src)
    j = agg.join(cq, agg["company"] == cq["_cq_id"], "left") \
           .join(bu, agg["bunisnessUnit"].cast("string") == bu["_bu_id"], "left")
    j = j.select("company_name", derive_project("posting_jobNo", "_unit").alias("project_no"), "cap", "qwk")
    j = _to_requests(j, req, ["company_name", "project_no"], ["company_name", "project_no"])
    return j.withColumns({"raw_cap": F.col("cap"), "in_spine": F.lit(True)})


def tasks_part(src: Sources, req: DataFrame, period: Period, with_end_date: bool = False) -> DataFrame:
    """Contract price and planned cost per normalised chapter. By default no
    date limit: the reference's query never selects the task end date, so its
    end-date filter is inactive; ``with_end_date`` applies it (end date
    present and on or before the cut)."""
    t = src["job_task_lines_subform_bc"]
    # every task line adds its chapter to the spine; the end date only limits the amounts
    ended = (F.col("End_Date").isNotNull() & (as_ts("End_Date") <= lit_ts(period.cut))) if with_end_date \
        else F.lit(True)
    agg = t.groupBy("Job_No", "CompanyId", normalize_chapter("Job_Task_No").alias("cap")).agg(
        F.sum(F.when(ended, F.col("Schedule_Total_Price"))).alias("contr"),
        F.sum(F.when(ended, F.col("Schedule_Total_Cost"))).alias("plan"))
    jobs, comps = _jobs(src), _companies(src)
    j = agg.join(jobs, _task_key(agg["Job_No"], agg["CompanyId"]) == _task_key(jobs["No"], jobs["_jcid"]), "inner") \
        .join(comps, F.col("_jcid") == F.col("_cid"), "inner") \
        .select("company_name", F.col("No").alias("project_no"), "cap", "contr", "plan")
    j = _to_requests(j, req, ["company_name", "project_no"], ["company_name", "project_no"])
    return j.withColumns({"raw_cap": F.col("cap"), "in_spine": F.lit(True)})


def planning_part(src: Sources, req: DataFrame, period: Period, agg: DataFrame | None = None) -> DataFrame:
    """Certified revenue from planning lines (posting group CERTIFICACIONES):
    to date and in the month, per raw chapter, with row and non-null counts so
    'all amounts NULL' can be told apart from 'no rows'. Matched on company id
    (or on company name when the request has no id). Not part of the spine. ``agg``: the
    same sums from a balance."""
    pl = src["job_planning_lines_bc"]
    ts = as_ts("Planning_Date")
    amt = F.col("Line_Amount")
    in_m = ts >= lit_ts(period.month_start)
    p = pl.where((F.col("Gen_Prod_Posting_Group") == F.lit(CERT)) & (ts <= lit_ts(period.cut)))
    # (planning dates are compared as timestamps: a 10:00 entry on the last
    # day is after the midnight cut, as in the reference)
    cid = trim_ws(F.coalesce(F.col("CompanyId").cast("string"), F.lit("None")))
    if agg is None:
        agg = p.groupBy(cid.alias("_cid"), F.col("Company_Name").alias("_cname"),
                        F.col("Job_No").alias("_pno"), F.col("Job_Task_No").alias("raw_cap")).agg(
            F.count(F.lit(1)).alias("rows_o"), F.sum(amt).alias("sum_o"), F.count(amt).alias("n_o"),
            F.count(F.when(in_m, F.lit(1))).alias("rows_m"), F.sum(F.when(in_m, amt)).alias("sum_m"),
            F.count(F.when(in_m, amt)).alias("n_m"))
    # One equi-join for both matching rules: a request with a company id is
    # keyed 'i:<id>', one without 'n:<name>'; each aggregated planning row
    # offers both of its keys (after the aggregation, so the explode is cheap)
    # and a request has exactly one, so no row is counted twice.
    agg = agg.withColumn("_mk", F.explode(F.array(F.concat(F.lit("i:"), F.col("_cid")),
                                                  F.concat(F.lit("n:"), F.col("_cname")))))
    r = req.withColumn("_mk", F.when(F.col("company_id").isNotNull(), F.concat(F.lit("i:"), F.col("company_id")))
                       .otherwise(F.concat(F.lit("n:"), F.col("company_name"))))
    j = _to_requests(agg, r, ["_mk", "_pno"], ["_mk", "project_no"]).drop("_mk", "_cid", "_cname", "_pno")
    return j.withColumns({"cap": F.col("raw_cap"), "in_spine": F.lit(False)})


RAW_KEYED = {"ledger": ("cbo", "cbm"), "production": ("cpend", "resto")}


def raw_exact(df: DataFrame, metrics) -> DataFrame:
    """Keep an amount only where the raw chapter equals its normalised form."""
    exact = F.col("raw_cap").isNotNull() & (F.col("raw_cap") == F.col("cap"))
    return df.select(*[F.when(exact, F.col(c)).alias(c) if c in metrics else F.col(c) for c in df.columns])


def restrict_to_requests(src: Sources, req: DataFrame) -> dict:
    """Cut every raw source down to rows that can belong to a request, before any
    aggregation, so a single-project or backfill run aggregates only its own
    projects. Each semi-join uses the key under which the source matches jobs (task
    lines: the concatenated key), so no row of a request is lost; the exact request
    match follows after the aggregation. Blank invoice jobs are kept: their project
    is derived later."""
    projects = req.select(F.col("project_no").alias("_fp"))
    keys = req.select(F.col("project_key").alias("_fk"))
    out = dict(src)
    for name in ("job_ledger_entries_bc", "job_planning_lines_bc"):
        out[name] = src[name].join(projects, src[name]["Job_No"] == projects["_fp"], "left_semi")
    tasks = src["job_task_lines_subform_bc"]
    jobs = _jobs(src).join(projects, F.col("No") == F.col("_fp"), "left_semi").select(
        _task_key(F.col("No"), F.col("_jcid")).alias("_ft"))
    out["job_task_lines_subform_bc"] = tasks.join(
        jobs, _task_key(tasks["Job_No"], tasks["CompanyId"]) == jobs["_ft"], "left_semi")
    for name in ("DimSeguimientoProduccion", "DimPendientesProduccion"):
        out[name] = semi_spelled(src[name], "proyecto", keys, "_fk")
    fq = src["facturas_qwark"]
    blank = fq.where(is_blank("posting_jobNo"))
    given = fq.where(~is_blank("posting_jobNo"))
    given = given.join(projects, given["posting_jobNo"] == projects["_fp"], "left_semi")
    out["facturas_qwark"] = given.unionByName(blank)
    return out


#: What each part adds to the tall union, by the name under which a row holds it.
PARTS = {
    "ledger": ("cbo", "cbm"),
    "production": ("cpend", "resto"),
    "pending": ("pend",),
    "unposted": ("qwk",),
    "tasks": ("contr", "plan"),
    "planning": ("rows_o", "sum_o", "n_o", "rows_m", "sum_m", "n_m"),
    "production_prev": ("cpend_prev", "resto_prev"),
}


def parts_by_name(src: Sources, req: DataFrame, period: Period, with_prev_month: bool = False,
                  with_end_date: bool = False, normalize_all_chapters: bool = False,
                  restrict: bool = False, balances: dict | None = None) -> dict[str, DataFrame]:
    """Every source's contribution (one row per source group), by its name in ``PARTS``.

    ``normalize_all_chapters`` corrects the raw-chapter lookups: ledger,
    production and planning amounts then land on their normalised chapter
    instead of being lost for NULL / untrimmed chapters. ``restrict`` cuts
    the raw sources to the requested projects first; the result is the same. ``balances``
    has the sums to date of sources by name (``plans.rollup``)."""
    balances = balances or {}
    if restrict:
        src = restrict_to_requests(src, req)
    exact = (lambda df, m: df) if normalize_all_chapters else raw_exact
    planning = planning_part(src, req, period, balances.get("certified"))
    if normalize_all_chapters:
        planning = planning.withColumn("cap", normalize_chapter("raw_cap"))
    parts = {
        "ledger": exact(ledger_part(src, req, period, balances.get("cost")), RAW_KEYED["ledger"]),
        "production": exact(production_part(src, req, period), RAW_KEYED["production"]),
        "pending": pending_part(src, req, period),
        "unposted": unposted_part(src, req, period, balances.get("unposted")),
        "tasks": tasks_part(src, req, period, with_end_date),
        "planning": planning,
    }
    if with_prev_month:
        prev = production_part(src, req, period, prev=True) \
            .withColumnRenamed("cpend", "cpend_prev").withColumnRenamed("resto", "resto_prev")
        parts["production_prev"] = exact(prev, ("cpend_prev", "resto_prev"))
    return parts


def all_parts(src: Sources, req: DataFrame, period: Period, **options) -> DataFrame:
    """Tall union of every source's contribution, a column for each metric (options:
    ``parts_by_name``)."""
    cols = ["company_name", "project_no", "company_id", "cap", "in_spine"] + PART_METRICS
    out = None
    for p in parts_by_name(src, req, period, **options).values():
        p = p.drop("raw_cap")
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out.select(*[c for c in cols if c in set(out.columns)])


def packed_parts(src: Sources, req: DataFrame, period: Period, **options) -> DataFrame:
    """The tall union with one struct a source instead of a column a metric: a row holds the
    metrics of its own source, and the others' take eight bytes each, not 24 a decimal.
    Rows without a chapter (planning lines alone) reach no spine and are left out."""
    out = None
    for name, p in parts_by_name(src, req, period, **options).items():
        p = p.where(F.col("cap").isNotNull()).select(
            "company_name", "project_no", "company_id", "cap", "in_spine", F.struct(*PARTS[name]).alias(name))
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out


# ─────────────── individual chapter aggregates (§2.5 queries) ───────────────

def chapter_aggregate(part: DataFrame, metric: str, alias: str, key: str = "cap",
                      null_if_all_null: bool = False) -> DataFrame:
    """Σ metric per (company, project, chapter key). Sums of no non-NULL value are
    0 (pandas ``sum``) unless ``null_if_all_null`` (``sum(min_count=1)``)."""
    s = F.sum(metric)
    val = s if null_if_all_null else F.coalesce(s, F.lit(0))
    return part.groupBy("company_name", "project_no", F.col(key).alias("job_task_no")).agg(val.alias(alias))


def _norm_req(req: DataFrame) -> DataFrame:
    cols = set(req.columns)
    if "company_key" not in cols:
        req = req.withColumn("company_key", normalize_text("company_name"))
    if "project_key" not in cols:
        req = req.withColumn("project_key", normalize_text("project_no"))
    return req


def cost_by_chapter(src: Sources, req: DataFrame, period: Period, month: bool, agg: DataFrame | None = None) -> DataFrame:
    """Σ posted cost excluding certifications (NULL group kept), to date or in
    the month, by (company, project, raw chapter). ``agg``: the sums to date from a
    balance, with ``rows_nc``, the number of such entries."""
    fle = src["job_ledger_entries_bc"]
    window = within(fle, "Posting_Date", period.month_start, period.cut) if month \
        else on_or_before(fle, "Posting_Date", period.cut)
    cond = not_certification("Gen_Prod_Posting_Group") & window
    if agg is None:
        agg = fle.where(cond).groupBy("Job_No", "CompanyId", "Job_Task_No") \
            .agg(F.sum("Total_Cost_LCY").alias("_v"))
    else:
        agg = agg.where("rows_nc > 0").select("Job_No", "CompanyId", "Job_Task_No", F.col("cbo").alias("_v"))
    j = _with_project(src, agg).select("company_name", "project_no", "Job_Task_No", "_v")
    j = _to_requests(j, req, ["company_name", "project_no"], ["company_name", "project_no"])
    name = "coste_bc_mes_actual" if month else "coste_bc_a_origen"
    return j.groupBy("company_name", "project_no", F.col("Job_Task_No").alias("job_task_no")) \
        .agg(F.coalesce(F.sum("_v"), F.lit(0)).alias(name))


def cert_by_chapter(src: Sources, req: DataFrame, period: Period, month: bool, agg: DataFrame | None = None) -> DataFrame:
    """Σ certified planning amounts by raw chapter; NULL when every amount is NULL."""
    p = planning_part(src, req, period, agg)
    if month:
        p = p.where(F.col("rows_m") > 0)
        v = F.sum("sum_m")
        name = "certificacion_mes_actual"
    else:
        v = F.sum("sum_o")
        name = "certificacion_a_origen"
    return p.groupBy("company_name", "project_no", F.col("raw_cap").alias("job_task_no")).agg(v.alias(name))


def production_by_chapter(src: Sources, req: DataFrame, period: Period, metric: str,
                          prev: bool = False) -> DataFrame:
    """Σ pending certification ('cpend') or remaining production ('resto') of the
    month (or of the previous month) by raw chapter (NULL chapter is a group)."""
    name = {"cpend": "certificacion_pendiente", "resto": "resto_produccion"}[metric]
    if prev:
        name += "_mes_anterior"
    return chapter_aggregate(production_part(src, _norm_req(req), period, prev=prev), metric, name,
                             key="raw_cap")


def pending_cost_by_chapter(src: Sources, req: DataFrame, period: Period) -> DataFrame:
    return chapter_aggregate(pending_part(src, _norm_req(req), period), "pend", "coste_pendiente")


def unposted_cost_by_chapter(src: Sources, req: DataFrame, period: Period, agg: DataFrame | None = None) -> DataFrame:
    return chapter_aggregate(unposted_part(src, req, period, agg), "qwk", "coste_qwark")


def task_by_chapter(src: Sources, req: DataFrame, period: Period, metric: str) -> DataFrame:
    """Σ contract price ('contr') or planned cost ('plan') by normalised chapter;
    NULL when every value is NULL."""
    name = {"contr": "contratos", "plan": "planificado"}[metric]
    return chapter_aggregate(tasks_part(src, req, period), metric, name, null_if_all_null=True)
