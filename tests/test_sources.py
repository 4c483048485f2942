"""Column resolution and the parquet loader."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from costlens.sources import MissingColumnError, load_parquet_sources, resolve_columns
from costlens.sources.fixtures import spark_sql


def test_resolve_aliases_case_and_optional_defaults(spark):
    df = spark.createDataFrame([("2024-01-05", "12.5", "PY_1", "x", "1")],
                               "planningdate string, AMOUNT string, project_no string, gppg string, company string")
    out = resolve_columns(df, "job_planning_lines_bc", cast=True)
    assert out.columns == ["Planning_Date", "Gen_Prod_Posting_Group", "Line_Amount", "Job_No",
                           "Job_Task_No", "CompanyId", "Company_Name", "Entry_No"]
    r = out.first()
    assert r["Planning_Date"] == dt.datetime(2024, 1, 5)
    assert float(r["Line_Amount"]) == 12.5
    assert r["Job_Task_No"] is None and r["Company_Name"] is None


def test_bad_values_become_null(spark):
    df = spark.createDataFrame([("not a date", "abc")], "fecha_produccion string, coste_pendiente string")
    df = df.withColumn("proyecto", F.lit("P")).withColumn("empresa", F.lit("E"))
    r = resolve_columns(df, "DimPendientesProduccion", cast=True).first()
    assert r["fecha_produccion"] is None and r["coste_pendiente"] is None


def test_missing_required_column_fails_at_plan_time(spark):
    df = spark.createDataFrame([("x",)], "foo string")
    with pytest.raises(MissingColumnError):
        resolve_columns(df, "companies_bc")


def test_load_parquet_sources(spark, tmp_table_root):
    spark.createDataFrame([("1", "ACME")], "CompanyId string, display_name string") \
        .write.parquet(f"{tmp_table_root}/companies_bc")
    src = load_parquet_sources(spark, tmp_table_root, tables=["companies_bc"])
    assert [tuple(r) for r in src["companies_bc"].collect()] == [("1", "ACME")]


def test_document_photo_takes_fewer_spellings_of_the_chapter(spark):
    row = "1997-01-03", "1", "S", 5, "PY_1", "07.01", "1"
    df = spark.createDataFrame([row], "documentDate string, documentNo string, vendorName string, baseAmount int, "
                                      "posting_jobNo string, capitulo string, company string")
    got = resolve_columns(df, "facturas_qwark", cast=True).first()
    assert got["posting_jobTaskNo"] == "07.01" and got["detail_jobTaskNo"] is None
    got = resolve_columns(df.withColumnRenamed("capitulo", "job_task_no"), "facturas_qwark", cast=True).first()
    assert got["posting_jobTaskNo"] == got["detail_jobTaskNo"] == "07.01"


def test_spreading_a_table_sorts_no_scan_and_changes_no_row(spark, tmp_table_root):
    """Dealt round-robin, the task that reads a file would sort all of it first."""
    orders = [(k % 40 if k % 7 else None, k % 3 if k % 5 else None, dt.date(1997, 1, 1 + k % 28)) for k in range(200)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate date").coalesce(1) \
        .write.parquet(f"{tmp_table_root}/orders.parquet")
    spark.createDataFrame([(0, 1), (1, 2), (None, 3)], "c_custkey long, c_nationkey long") \
        .write.parquet(f"{tmp_table_root}/customer.parquet")
    spread = spark.sql(spark_sql("purchase_invoices_bc", tmp_table_root, 4))
    plain = spark.sql(spark_sql("purchase_invoices_bc", tmp_table_root))
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "RoundRobin" not in plan


def test_tables_larger_than_a_split_are_not_spread(spark):
    """Each row of a large table crosses one shuffle to its join, and the rows are the same."""
    from costlens.sources.fixtures import load_fixture_sources
    sf, key = "/root/testdata/sf0.001", "spark.sql.files.maxPartitionBytes"
    names = ("job_ledger_entries_bc", "job_task_lines_subform_bc", "facturas_qwark", "resource_ledger_entries_bc", "job_planning_lines_bc", "DimSeguimientoProduccion")
    small = load_fixture_sources(spark, sf)
    before = spark.conf.get(key)
    spark.conf.set(key, "1k")
    try:
        large = load_fixture_sources(spark, sf)
    finally:
        spark.conf.set(key, before)
    for name in names:
        assert "REPARTITION_BY_NUM" not in large[name]._jdf.queryExecution().executedPlan().toString(), name
        assert large[name].schema == small[name].schema
        assert sorted(map(str, large[name].collect())) == sorted(map(str, small[name].collect())), name
    assert "REPARTITION_BY_NUM" in small[names[0]]._jdf.queryExecution().executedPlan().toString()
