"""Dataset queries: the inputs of the summary and the detail "photos".

Each function takes the canonical ``Sources`` mapping plus optional company
/ project filters and returns a lazy DataFrame. Filters are only added when
a parameter is given, and are written on source columns so Catalyst pushes
them into the scans. Dimensions (jobs, companies, business units) are joined one by
one as plain scans, so Spark broadcasts each by its size in bytes.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.functions.dates import as_date, lit_date, on_or_before, within
from costlens.functions.money import money
from costlens.functions.text import contains_ci, derive_project, normalize_chapter, trim_ws
from costlens.operators.joins import where_eq, where_given
from costlens.operators.spelling import where_spelled
from costlens.sources.loaders import Sources

CERT = "CERTIFICACIONES"   # posting group of certified revenue (fixed value)


def not_certification(gppg) -> "F.Column":
    """Keeps NULL groups: ``NULL != 'CERTIFICACIONES'`` counts as true here."""
    return ~F.col(gppg).eqNullSafe(F.lit(CERT)) if isinstance(gppg, str) else ~gppg.eqNullSafe(F.lit(CERT))


def _jobs(src: Sources, project: str | None) -> DataFrame:
    jobs = src["job_list_bc"].select("No", F.col("CompanyId").alias("_jcid"), "Description")
    return where_eq(jobs, "No", project)


def _companies(src: Sources, company: str | None) -> DataFrame:
    comps = src["companies_bc"].select(F.col("id").alias("_cid"), F.col("name").alias("company_name"))
    return where_eq(comps, "company_name", company)


# ─────────────────────────── ledger / tasks ───────────────────────────

def ledger_entries(src: Sources, company: str | None, project: str | None,
                   date_to: dt.date) -> DataFrame:
    """Job ledger entries up to ``date_to`` with company and project attributes."""
    led = src["job_ledger_entries_bc"]
    fle = led.where(on_or_before(led, "Posting_Date", date_to))
    jobs, comps = _jobs(src, project), _companies(src, company)
    j = fle.join(jobs, (fle["Job_No"] == jobs["No"]) & (fle["CompanyId"] == jobs["_jcid"]), "inner")
    j = j.join(comps, jobs["_jcid"] == comps["_cid"], "inner")
    return j.select(
        as_date(fle["Posting_Date"]).alias("posting_date"),
        fle["Gen_Prod_Posting_Group"].alias("gppg"),
        fle["Job_No"].alias("job_no"),
        fle["Job_Task_No"].alias("job_task_no"),
        fle["Total_Cost_LCY"].alias("total_cost_lcy"),
        fle["Line_Amount_LCY"].alias("line_amount_lcy"),
        comps["company_name"],
        jobs["_jcid"].alias("company_id"),
        jobs["No"].alias("project_no"),
        jobs["Description"].alias("project_description"),
        F.concat(jobs["No"], F.lit("_"), jobs["_jcid"]).alias("project_id"),
    )


def task_lines(src: Sources, company: str | None, project: str | None) -> DataFrame:
    """Chapter budget lines (contract price, planned cost) per project.

    The reference joins on the concatenated text key ``No || '_' || CompanyId``;
    the same expression is used as the equi-join key, so a separator inside
    the data behaves identically (and NULL ids never match).
    """
    t = src["job_task_lines_subform_bc"]
    jobs, comps = _jobs(src, project), _companies(src, company)
    tkey = F.concat(t["Job_No"], F.lit("_"), t["CompanyId"])
    jkey = F.concat(jobs["No"], F.lit("_"), jobs["_jcid"])
    j = t.join(jobs, tkey == jkey, "inner").join(comps, jobs["_jcid"] == comps["_cid"], "inner")
    return j.select(
        t["Job_Task_No"].alias("job_task_no"),
        t["Schedule_Total_Price"].alias("schedule_total_price"),
        t["Schedule_Total_Cost"].alias("schedule_total_cost"),
        jobs["No"].alias("project_no"),
        comps["company_name"],
    )


# ─────────────────────────── unposted invoices ───────────────────────────

def _unposted_base(src: Sources) -> DataFrame:
    """facturas_qwark LEFT companies LEFT business units, with lookup names."""
    fq = src["facturas_qwark"]
    cq = src["companies_qwark"].select(F.col("id").alias("_cq_id"), F.col("name").alias("company_name_bc"))
    bu = src["businessUnit_qwark"].select(
        F.col("id").cast("string").alias("_bu_id"),
        F.col("Unidad de negocio").alias("unidad_negocio"))
    j = fq.join(cq, fq["company"] == cq["_cq_id"], "left")
    j = j.join(bu, fq["bunisnessUnit"].cast("string") == bu["_bu_id"], "left")
    return j.drop("_cq_id", "_bu_id")


def unposted_pending(src: Sources, company: str | None, project: str | None,
                     date_to: dt.date) -> DataFrame:
    """Received, not yet posted ('registered') positive invoices up to ``date_to``.

    Registered = the ERP document number contains 'CFR' (case-insensitive).
    A blank job number is derived from the business-unit name's first four
    digits ('PY_00' + digits).
    """
    fq = _unposted_base(src)
    fq = fq.where(on_or_before(fq, "documentDate", date_to))
    registrada = contains_ci("bc_documentNo", "CFR")
    out = fq.select(
        as_date("documentDate").alias("fecha_factura"),
        F.col("documentNo").alias("documentNo_orig"),
        registrada.alias("registrada"),
        F.col("baseAmount").alias("base_amount"),
        F.col("posting_jobTaskNo").alias("job_task_no"),
        F.col("posting_jobNo").alias("project_no"),
        derive_project("posting_jobNo", "unidad_negocio").alias("proyecto"),
        F.col("company_name_bc"),
        F.col("bunisnessUnit").cast("string").alias("business_unit_id"),
        F.col("company_name_bc").alias("company_name"),
    ).where((F.col("base_amount") > 0) & ~F.col("registrada"))
    out = where_given(out, "company_name_bc", company)
    return where_given(out, "proyecto", project)


def unposted_docs(src: Sources, company: str | None, project: str | None,
                  d1: dt.date, d2: dt.date, sort: bool = True) -> DataFrame:
    """Document-level detail of the unposted cost within [d1, d2], without 'RET'
    (retention) documents; sorted by date and document (``sort=False`` skips
    the global sort, e.g. when the rows only go into a table)."""
    fq = _unposted_base(src)
    fq = fq.where(within(fq, "documentDate", d1, d2))
    orig = F.col("bc_documentNo")
    registrada = contains_ci(F.coalesce(orig, F.col("documentNo")), "CFR")
    has_ret = (contains_ci("documentNo", "RET") | contains_ci(orig, "RET")
               | contains_ci("bc_draftDocumentNo", "RET"))
    out = fq.where((F.col("baseAmount") > 0) & ~registrada & ~has_ret).select(
        F.col("company").cast("string").alias("company_id"),
        F.col("company_name_bc").alias("company_name"),
        derive_project("posting_jobNo", "bunisnessUnit").alias("project_no"),
        as_date("documentDate").alias("fecha_factura"),
        F.col("documentNo").alias("document_no"),
        F.col("vendorName").alias("vendor_name"),
        F.col("posting_description"),
        F.col("bc_draftDocumentNo").alias("bc_draft_document_no"),
        F.col("detail_jobTaskNo").alias("job_task_no"),
        F.col("baseAmount").alias("base_amount"),
    )
    out = where_given(out, "company_name", company)
    out = where_given(out, "project_no", project)
    if not sort:
        return out
    return out.orderBy(F.col("fecha_factura").asc_nulls_last(), F.col("document_no").asc_nulls_last())


# ─────────────────────────── overhead percentages ───────────────────────────

def overhead_pct(src: Sources, requests: DataFrame, with_id: bool = False) -> DataFrame:
    """Overhead percentages ('gastos generales', 'postventa') of each request,
    matched on (project number, company id as text); ``with_id`` adds the company id."""
    dp = src["DimProporcionales"]
    r = requests.select("company_name", "project_no", "company_id").where(F.col("company_id").isNotNull())
    j = r.join(dp, (dp["number"] == r["project_no"]) & (dp["CompanyId"].cast("string") == r["company_id"]),
               "inner")
    return j.select(
        r["company_name"], r["project_no"], *([r["company_id"]] if with_id else []),
        money(dp["gastos generales"]).alias("gastos_generales"),
        money(dp["postventa"]).alias("postventa"),
    )


# ─────────────────────────── spreadsheets: pending / tracking ───────────────────────────

def _norm_filter(df: DataFrame, company: str | None, project: str | None,
                 company_col: str, project_col: str) -> DataFrame:
    """Equality on normalised text (NBSP, Unicode strip, case fold), by the spellings of the
    column: the scan gets the raw values."""
    if company is not None and company != "":
        df = where_spelled(df, company_col, company)
    if project is not None and project != "":
        df = where_spelled(df, project_col, project)
    return df


def _chapter_text(df: DataFrame) -> "F.Column":
    return F.coalesce(F.col("capitulo_codigo").cast("string"), F.col("capitulo").cast("string"))


def pending_month(src: Sources, company: str | None, project: str | None,
                  d1: dt.date, d2: dt.date) -> DataFrame:
    """Pending cost rows whose production date lies in [d1, d2]."""
    d = src["DimPendientesProduccion"]
    d = d.where(within(d, "fecha_produccion", d1, d2))
    d = _norm_filter(d, company, project, "empresa", "proyecto")
    return d.select(
        as_date("fecha_produccion").alias("fecha_produccion"),
        F.col("coste_pendiente"),
        _chapter_text(d).alias("job_task_no"),
        F.col("proyecto").alias("project_no"),
        F.col("empresa").alias("company_name"),
    )


def production_month(src: Sources, company: str | None, project: str | None,
                     d1: dt.date, d2: dt.date) -> DataFrame:
    """Production-tracking rows (pending certification, remaining production) in [d1, d2]."""
    d = src["DimSeguimientoProduccion"]
    d = d.where(within(d, "fecha_produccion", d1, d2))
    d = _norm_filter(d, company, project, "empresa", "proyecto")
    return d.select(
        as_date("fecha_produccion").alias("fecha_produccion"),
        F.col("certificacion_pendiente"),
        F.col("resto_produccion"),
        _chapter_text(d).alias("job_task_no"),
        F.col("proyecto").alias("project_no"),
        F.col("empresa").alias("company_name"),
    )


def _photo_chapter(fallback: bool = False) -> "F.Column":
    """Detail photos render a NULL code as the text 'None' before the fallback,
    so the text chapter is never used while the code column exists;
    ``fallback=True`` applies the intended COALESCE(code, text)."""
    if fallback:
        return normalize_chapter(F.coalesce(F.col("capitulo_codigo").cast("string"),
                                            F.col("capitulo").cast("string")))
    code = F.coalesce(F.col("capitulo_codigo").cast("string"), F.lit("None"))
    return normalize_chapter(code)


def _strip_filter(df: DataFrame, company, project, company_col, project_col) -> DataFrame:
    """Strip-only, case-sensitive equality used by the detail photos."""
    if company is not None and company != "":
        df = df.where(trim_ws(F.coalesce(F.col(company_col).cast("string"), F.lit("None"))) == company)
    if project is not None and project != "":
        df = df.where(trim_ws(F.coalesce(F.col(project_col).cast("string"), F.lit("None"))) == project)
    return df


def _company_by_name(src: Sources, df: DataFrame) -> DataFrame:
    """LEFT join companies_bc on the (unstripped) name; NULL matches NULL."""
    comps = src["companies_bc"].select(F.col("id").cast("string").alias("company_id"), F.col("name").alias("_cname"))
    return df.join(comps, df["company_name"].eqNullSafe(comps["_cname"]), "left").drop("_cname")


def pending_docs(src: Sources, company: str | None, project: str | None,
                 d1: dt.date, d2: dt.date, chapter_fallback: bool = False) -> DataFrame:
    """Photo of pending cost, windowed on the follow-up date (fecha_seguimiento)."""
    d = src["DimPendientesProduccion"]
    d = d.where(within(d, "fecha_seguimiento", d1, d2))
    d = _strip_filter(d, company, project, "empresa", "proyecto")
    d = d.select(
        as_date("fecha_seguimiento").alias("fecha_seguimiento"),
        F.col("proyecto").alias("project_no"),
        F.col("empresa").alias("company_name"),
        _photo_chapter(chapter_fallback).alias("capitulo"),
        F.col("coste_pendiente"),
        F.col("observaciones"),
        F.col("proveedor"),
    )
    return _company_by_name(src, d).select(
        "company_id", "company_name", "project_no", "fecha_seguimiento",
        "capitulo", "coste_pendiente", "observaciones", "proveedor")


def tracking_docs(src: Sources, company: str | None, project: str | None,
                  d1: dt.date, d2: dt.date, chapter_fallback: bool = False) -> DataFrame:
    """Photo of production tracking, windowed on fecha_produccion."""
    d = src["DimSeguimientoProduccion"]
    d = d.where(within(d, "fecha_produccion", d1, d2))
    d = _strip_filter(d, company, project, "empresa", "proyecto")
    d = d.select(
        as_date("fecha_produccion").alias("fecha_produccion"),
        F.col("proyecto").alias("project_no"),
        F.col("empresa").alias("company_name"),
        _photo_chapter(chapter_fallback).alias("capitulo"),
        F.col("certificacion_pendiente"),
        F.col("resto_produccion"),
        F.col("observaciones"),
    )
    return _company_by_name(src, d).select(
        "company_id", "company_name", "project_no", "fecha_produccion",
        "capitulo", "certificacion_pendiente", "resto_produccion", "observaciones")


# ─────────────────────────── resources ───────────────────────────

def resource_entries(src: Sources, company: str | None, project: str | None,
                     d1: dt.date, d2: dt.date) -> DataFrame:
    """Resource ledger entries posted in [d1, d2]."""
    r = src["resource_ledger_entries_bc"]
    r = r.where(within(r, "Posting_Date", d1, d2))
    r = where_eq(r, "Job_No", project)
    comps = src["companies_bc"].select(F.col("id").cast("string").alias("_cid"), F.col("name").alias("_cname"))
    r = r.join(comps, r["CompanyId"].cast("string") == comps["_cid"], "left")
    r = where_eq(r, "_cname", company)
    return r.select(
        as_date("Posting_Date").alias("posting_date"),
        F.col("Document_No").alias("document_no"),
        F.col("Description").alias("description"),
        F.col("Job_No").alias("job_no"),
        F.col("Global_Dimension_1_Code").alias("global_dimension_1_code"),
        F.col("Global_Dimension_2_Code").alias("global_dimension_2_code"),
        F.col("Resource_No").alias("resource_no"),
        F.col("Total_Cost").alias("total_cost"),
        F.col("CompanyId").cast("string").alias("company_id"),
    )


# ─────────────────────────── invoices by chapter ───────────────────────────

def _document_key(company: str, number: str) -> "F.Column":
    """The reference's text key of an invoice document."""
    return F.concat(F.col(company).cast("string"), F.lit("|"), F.coalesce(F.col(number).cast("string"), F.lit("")))


def invoices_by_chapter(src: Sources, company: str | None, project: str | None,
                        d1: dt.date, d2: dt.date, dedupe_lines: bool = False,
                        sort: bool = True) -> DataFrame:
    """Posted cost per (chapter, invoice) for invoices dated in [d1, d2].

    The reference joins every invoice *line* to every ledger entry of the
    invoice's document and sums, so the cost is multiplied by the number of
    lines. Instead of materialising those pairs, both sides are aggregated
    first — lines counted per invoice, ledger cost summed per (document,
    chapter, job) — and the product ``cost × line count`` is taken after a
    join of the two aggregates: the same totals, with no quadratic fan-out on
    a hot document. ``dedupe_lines=True`` counts each invoice once instead.
    """
    # the month's headers of the wanted companies come first: lines and ledger
    # entries, the big tables, are cut to them before anything is aggregated
    headers = src["purchase_invoices_bc"]
    headers = headers.where(within(headers, "invoiceDate", d1, d2))
    wanted = where_eq(src["companies_bc"].select("name", F.col("id").alias("_cid")), "name", company)
    headers = headers.join(wanted, headers["CompanyId"] == wanted["_cid"], "inner").select(
        F.col("CompanyId").alias("company_id"), F.col("id").alias("invoice_id"),
        F.col("number").alias("numero_factura"), F.col("vendorName").alias("proveedor"),
        as_date("invoiceDate").alias("fecha_factura"))
    lines = src["purchase_invoice_lines_bc"].select(F.col("CompanyId").alias("_lc"), F.col("InvoiceId").alias("_li"))
    same = (F.col("_lc") == F.col("company_id")) & (F.col("_li") == F.col("invoice_id"))
    counted = lines.join(headers.select("company_id", "invoice_id"), same, "left_semi") \
        .groupBy("_lc", "_li").agg(F.count(F.lit(1)).alias("n_lines"))
    n_lines = F.lit(1).cast("long") if dedupe_lines else F.sum("n_lines")
    invoices = headers.join(counted, same, "inner") \
        .groupBy("company_id", "invoice_id", "numero_factura", "proveedor", "fecha_factura") \
        .agg(n_lines.alias("n_lines"))
    invoices = invoices.withColumn("_k", _document_key("company_id", "numero_factura"))

    entries = src["job_ledger_entries_bc"]
    entries = entries.where(not_certification("Gen_Prod_Posting_Group") & F.col("Job_Task_No").isNotNull())
    entries = where_eq(entries, "Job_No", project).withColumn("_k", _document_key("CompanyId", "Document_No"))
    asked = headers.select(_document_key("company_id", "numero_factura").alias("_k"))
    cost = entries.join(asked, "_k", "left_semi").groupBy("_k", "Job_Task_No", "Job_No") \
        .agg(F.sum("Total_Cost_LCY").alias("_cost"))

    out = invoices.join(cost, "_k", "inner").groupBy(
        "Job_Task_No", "numero_factura", "proveedor", "fecha_factura", "company_id", "invoice_id", "Job_No",
    ).agg(F.sum(F.col("_cost") * F.col("n_lines")).alias("coste_registrado_a_origen"))
    out = out.select(
        F.col("Job_Task_No").cast("string").alias("capitulo"),
        "coste_registrado_a_origen", "numero_factura", "proveedor", "fecha_factura",
        F.col("company_id").alias("CompanyId"), F.col("invoice_id").alias("id"), "Job_No",
    )
    if not sort:          # e.g. rows that only go into a table
        return out
    return out.orderBy(F.col("fecha_factura").asc_nulls_last(), F.col("numero_factura").asc_nulls_last(),
              F.col("capitulo").asc_nulls_last())
