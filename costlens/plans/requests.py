"""Request DataFrames: which (company, project) pairs a run computes.

The reference runs one pipeline per (company, project); here a request is a
row, so a month-end run for every project, a single project, or the output of
the gap fill are all the same plan over a different request DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens.functions.text import normalize_text
from costlens.sources.loaders import Sources


def resolve_company_ids(src: Sources, pairs: DataFrame) -> DataFrame:
    """Attach ``company_id`` to (company_name, project_no) pairs.

    The company id is the job's CompanyId among jobs ⨝ companies with that
    company name and project number; the reference takes an unordered first
    one, here the smallest (deterministic). Unresolvable pairs keep NULL.
    """
    jobs = src["job_list_bc"].select(F.col("No"), F.col("CompanyId"))
    comps = src["companies_bc"].select(F.col("id"), F.col("name"))
    ids = jobs.join(comps, jobs["CompanyId"] == comps["id"], "inner") \
        .groupBy(F.col("name").alias("_n"), F.col("No").alias("_p")) \
        .agg(F.min("CompanyId").alias("company_id"))
    j = pairs.join(ids, (pairs["company_name"] == ids["_n"]) & (pairs["project_no"] == ids["_p"]), "left")
    return j.drop("_n", "_p")


def with_norm_keys(requests: DataFrame) -> DataFrame:
    return requests.select("*", normalize_text("company_name").alias("company_key"),
                           normalize_text("project_no").alias("project_key"))


def all_projects(src: Sources, company: str | None = None,
                 project: str | None = None) -> DataFrame:
    """Every project of jobs ⨝ companies (optionally one company / project)."""
    jobs = src["job_list_bc"].select(F.col("No"), F.col("CompanyId"))
    comps = src["companies_bc"].select(F.col("id"), F.col("name"))
    j = jobs.join(comps, jobs["CompanyId"] == comps["id"], "inner")
    if company is not None:
        j = j.where(F.col("name") == F.lit(company))
    if project is not None:
        j = j.where(F.col("No") == F.lit(project))
    return j.groupBy(F.col("name").alias("company_name"), F.col("No").alias("project_no")) \
        .agg(F.min("CompanyId").alias("company_id"))


def explicit(spark: SparkSession, src: Sources, pairs: list[tuple[str, str]]) -> DataFrame:
    """Requests for an explicit, small list of (company, project) pairs."""
    df = spark.createDataFrame(pairs, "company_name string, project_no string").distinct()
    return resolve_company_ids(src, df)
