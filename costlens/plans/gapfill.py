"""Gap fill: projects with no summary row in a month, and their backfill.

The reference loops over the missing pairs and runs one pipeline per pair;
here the anti-join result *is* the request DataFrame of one batched run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.functions.text import trim_ws
from costlens.plans.period import Period
from costlens.plans.requests import resolve_company_ids
from costlens.sources.loaders import Sources


def expected_projects(src: Sources, company: str | None = None, sort: bool = False) -> DataFrame:
    """Every project of the job list, with its company name (NULL when the
    company is unknown: LEFT join); ``sort`` orders the report by company and
    project (the anti-join below does not need the order)."""
    jobs = src["job_list_bc"].select(F.col("No"), F.col("CompanyId"))
    comps = src["companies_bc"].select(F.col("id").alias("_cid"), F.col("name").alias("_cname"))
    j = jobs.join(comps, jobs["CompanyId"] == comps["_cid"], "left")
    if company:  # '' means every company, as in the reference
        j = j.where(F.lower(F.col("_cname").cast("string")) == F.lower(F.lit(company)))
    out = j.select(F.col("_cname").cast("string").alias("company_name"),
                   F.col("No").cast("string").alias("project_no")).distinct()
    return out.orderBy("company_name", "project_no") if sort else out


def existing_projects(snapshot: DataFrame, period: Period, company: str | None = None) -> DataFrame:
    """Keys already present in the summary anywhere in the month (SQL TRIM:
    spaces only, then lower-case)."""
    s = snapshot.where(F.col("period_date").between(F.lit(period.month_start).cast("date"),
                                                    F.lit(period.month_end).cast("date")))
    if company:
        s = s.where(F.lower(F.col("company_name").cast("string")) == F.lower(F.lit(company)))
    return s.select(F.trim(F.lower(F.col("company_name").cast("string"))).alias("company_key"),
                    F.trim(F.lower(F.col("project_no").cast("string"))).alias("project_key")).distinct()


def missing_projects(src: Sources, snapshot: DataFrame, period: Period,
                     company: str | None = None) -> DataFrame:
    """Expected projects without any summary row in the month (left anti join
    on stripped, lower-cased keys)."""
    exp = expected_projects(src, company)
    exp = exp.withColumn("company_key", F.lower(trim_ws("company_name"))) \
             .withColumn("project_key", F.lower(trim_ws("project_no")))
    exist = existing_projects(snapshot, period, company)
    return exp.join(exist, ["company_key", "project_key"], "left_anti") \
              .select("company_name", "project_no").distinct()


def backfill_requests(src: Sources, snapshot: DataFrame, period: Period,
                      company: str | None = None) -> DataFrame:
    """Requests for the backfill run. Pairs without company or project are left
    out: the reference's run for them fails on the summary's NOT NULL keys."""
    miss = missing_projects(src, snapshot, period, company) \
        .where(F.col("company_name").isNotNull() & F.col("project_no").isNotNull())
    return resolve_company_ids(src, miss)


def unnamed_missing(src: Sources, snapshot: DataFrame, period: Period, company: str | None = None) -> DataFrame:
    """Missing pairs without company or project: the summary's keys can't hold them."""
    return missing_projects(src, snapshot, period, company) \
        .where(F.col("company_name").isNull() | F.col("project_no").isNull())
