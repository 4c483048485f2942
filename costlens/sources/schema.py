"""Canonical source schemas and the column resolver.

Source tables come from ERP exports and spreadsheets whose column spellings
vary; every loader resolves the real columns against ordered,
case-insensitive alias lists into one fixed canonical projection. Missing
optional columns become typed NULL literals; missing mandatory ones fail at
plan-build time (before any job runs).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Col:
    name: str
    dtype: str = "string"
    aliases: tuple[str, ...] = ()
    required: bool = True
    default: object = None  # literal used when an optional column is absent

    @property
    def candidates(self) -> tuple[str, ...]:
        return (self.name,) + self.aliases


@dataclass(frozen=True)
class Table:
    name: str
    cols: tuple[Col, ...] = field(default_factory=tuple)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.cols]


def _c(name, dtype="string", *aliases, required=True, default=None) -> Col:
    return Col(name, dtype, tuple(aliases), required, default)


# Accepted spellings of each source column, in priority order.
TABLES: dict[str, Table] = {t.name: t for t in [
    Table("companies_bc", (
        _c("id", "string", "companyid", "company_id"),
        _c("name", "string", "display_name", "companyname", "company_name"))),
    Table("companies_qwark", (_c("id"), _c("name"))),
    Table("job_list_bc", (
        _c("No", "string", "job_no", "project_no", "code"),
        _c("CompanyId", "string", "company_id"),
        _c("Description", "string", required=False))),
    Table("job_ledger_entries_bc", (
        _c("Posting_Date", "timestamp_ntz"),
        _c("Gen_Prod_Posting_Group", required=False),
        _c("Job_No"),
        _c("Job_Task_No", required=False),
        _c("Total_Cost_LCY", "decimal(18,6)"),
        _c("Line_Amount_LCY", "decimal(18,6)"),
        _c("CompanyId"),
        _c("Document_No", required=False),
        # change mark of the balances (plans.rollup): grows with every entry added
        _c("Entry_No", "bigint", "entry_no", required=False))),
    Table("job_task_lines_subform_bc", (
        _c("Job_No", "string", "project_no", "job_no"),
        _c("CompanyId", "string", "company_id"),
        _c("Job_Task_No", "string", "job_task_no"),
        _c("Schedule_Total_Price", "decimal(18,6)", "schedule_total_price"),
        _c("Schedule_Total_Cost", "decimal(18,6)", "schedule_total_cost"),
        _c("End_Date", "timestamp_ntz", "end_date", required=False))),
    Table("job_planning_lines_bc", (
        _c("Planning_Date", "timestamp_ntz", "planning_date", "PlanningDate", "planningdate",
           "Date", "date", required=False),
        _c("Gen_Prod_Posting_Group", "string", "gen_prod_posting_group", "GPPG", "gppg",
           "GenProdPostingGroup", required=False),
        _c("Line_Amount", "decimal(18,6)", "line_amount", "Amount", "amount", "LineAmount",
           required=False, default=0),
        _c("Job_No", "string", "job_no", "Project_No", "project_no", required=False),
        _c("Job_Task_No", "string", "job_task_no", "Task_No", "task_no", required=False),
        _c("CompanyId", "string", "company_id", "Company_Id", "company", "Company",
           required=False),
        _c("Company_Name", "string", "company_name", "Name", "name", required=False),
        _c("Entry_No", "bigint", "entry_no", required=False))),
    Table("purchase_invoices_bc", (
        _c("id", "string", "Id", "ID"),
        _c("CompanyId", "string", "company_id", "companyid", "company"),
        _c("number", "string", "Number", "invoice_number", "Invoice_Number"),
        _c("vendorName", "string", "vendor_name", "VendorName"),
        _c("invoiceDate", "timestamp_ntz", "invoice_date", "InvoiceDate"))),
    Table("purchase_invoice_lines_bc", (
        _c("CompanyId", "string", "company_id", "companyid", "company"),
        _c("InvoiceId", "string", "invoiceId", "invoice_id", "invoiceid", "id_invoice"))),
    Table("resource_ledger_entries_bc", (
        _c("Posting_Date", "timestamp_ntz", "posting_date", "Date", "date"),
        _c("Document_No", "string", "document_no"),
        _c("Description", "string", "description"),
        _c("Job_No", "string", "job_no", "Job", "job"),
        _c("Global_Dimension_1_Code", "string", "global_dimension_1_code"),
        _c("Global_Dimension_2_Code", "string", "global_dimension_2_code"),
        _c("Resource_No", "string", "resource_no"),
        _c("Total_Cost", "decimal(18,6)", "total_cost", "Total_Cost_LCY", "total_cost_lcy"),
        _c("CompanyId", "string", "company_id"))),
    Table("facturas_qwark", (
        _c("documentDate", "timestamp_ntz", "document_date"),
        _c("documentNo", "string", "document_no"),
        _c("bc_documentNo", "string", "bc_documentno", required=False),
        _c("bc_draftDocumentNo", "string", "draftDocumentNo", "bc_draft_document_no",
           required=False),
        _c("vendorName", "string", "vendor_name"),
        _c("posting_description", "string", "postingDescription", required=False),
        _c("baseAmount", "decimal(18,6)", "base_amount"),
        _c("posting_jobNo", "string", "posting_job_no", "posting_jobno", "project_no",
           required=False),
        _c("posting_jobTaskNo", "string", "posting_job_task_no", "job_task_no",
           "capitulo_codigo", "capitulo", required=False),
        # the document photo accepts fewer spellings of the chapter than the summary
        _c("detail_jobTaskNo", "string", "posting_jobTaskNo", "posting_job_task_no", "job_task_no",
           required=False),
        _c("company", "string", "companyid", "company_id"),
        _c("bunisnessUnit", "string", "businessUnit", "business_unit", "businessunit",
           required=False),
        # grows with every invoice added or changed
        _c("Change_No", "bigint", "change_no", required=False))),
    Table("businessUnit_qwark", (
        _c("id"),
        _c("Unidad de negocio", "string", "unidad_negocio"))),
    Table("DimProporcionales", (
        _c("number"),
        _c("CompanyId"),
        _c("gastos generales", "decimal(18,6)", "gastos_generales", required=False),
        _c("postventa", "decimal(18,6)", required=False))),
    Table("DimPendientesProduccion", (
        _c("fecha_produccion", "date", required=False),
        _c("fecha_seguimiento", "date", "fecha_seguimiento_jo", "fecha_seguim", "fecha",
           required=False),
        _c("coste_pendiente", "decimal(18,6)", "costePendiente", "pendiente_coste",
           required=False, default=0),
        _c("capitulo_codigo", "string", "capitulo_cod", "codigo_capitulo", required=False),
        _c("capitulo", "string", "cap", required=False),
        _c("proyecto", "string", "project_no", "job_no"),
        _c("empresa", "string", "company_name", "company"),
        _c("observaciones", "string", "observacion", "obs", required=False),
        _c("proveedor", "string", "vendor", "supplier", required=False))),
    Table("DimSeguimientoProduccion", (
        _c("fecha_produccion", "date", "fecha", "date", required=False),
        _c("certificacion_pendiente", "decimal(18,6)", "certificacion_pendinte",
           required=False, default=0),
        _c("resto_produccion", "decimal(18,6)", "resto", required=False, default=0),
        _c("capitulo_codigo", "string", "capitulo_cod", "codigo_capitulo", required=False),
        _c("capitulo", "string", "cap", required=False),
        _c("proyecto", "string", "project_no", "job_no"),
        _c("empresa", "string", "company_name", "company"),
        _c("observaciones", "string", "observacion", "obs", required=False))),
    Table("resumen_seguimiento", (
        _c("company_name"), _c("project_no"), _c("period_date", "date"))),
]}

CANONICAL: dict[str, list[str]] = {n: t.names for n, t in TABLES.items()}


class MissingColumnError(ValueError):
    pass


def resolve_columns(df: DataFrame, table: str | Table, cast: bool = False) -> DataFrame:
    """Project ``df`` onto the canonical columns of ``table``.

    For every canonical column the first candidate present in ``df``
    (case-insensitively) is selected and renamed; an absent optional column
    becomes a typed literal. With ``cast`` the values are coerced with
    ``try_cast`` so malformed cells turn into NULL instead of failing.
    """
    spec = TABLES[table] if isinstance(table, str) else table
    lower = {c.lower(): c for c in df.columns}
    exprs = []
    for col in spec.cols:
        real = next((lower[c.lower()] for c in col.candidates if c.lower() in lower), None)
        if real is None:
            if col.required:
                raise MissingColumnError(
                    f"{spec.name}: none of {list(col.candidates)} in {df.columns}")
            exprs.append(F.lit(col.default).cast(col.dtype).alias(col.name))
            continue
        e = F.col(f"`{real}`")
        if cast:
            e = e.try_cast(col.dtype)
        exprs.append(e.alias(col.name))
    return df.select(*exprs)
