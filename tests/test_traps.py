"""Golden summary tests on hand-written rows, one per semantic trap."""


import pytest
from pyspark.sql import functions as F

from costlens.operators import datasets as DS
from costlens.plans import requests as R
from costlens.plans.period import Period
from costlens.plans.resumen import resumen
from helpers import D, TS, company, dec, job, ledger, make_sources

JAN = Period(1997, 1)


def summary(spark, **tables):
    src = make_sources(spark, **tables)
    rows = resumen(src, R.all_projects(src), JAN).collect()
    return {(r["project_no"], r["grupo"], r["capitulo"]): r for r in rows}


@pytest.fixture()
def base():
    return dict(companies_bc=[company("1", "ACME")], job_list_bc=[job("PY_1", "1")])


def test_t1_null_posting_group_counts_as_cost(spark, base):
    s = summary(spark, **base, job_ledger_entries_bc=[
        ledger(D(1997, 1, 5), "PY_1", "01.01", 10, gppg=None),
        ledger(D(1997, 1, 5), "PY_1", "01.01", 100, gppg="CERTIFICACIONES"),
        ledger(D(1996, 12, 5), "PY_1", "01.01", 5),
        ledger(D(1997, 2, 1), "PY_1", "01.01", 1000),          # after the cut
    ])
    r = s[("PY_1", "Directos", "01.01")]
    assert r["coste_bc_a_origen"] == 15.0
    assert r["coste_bc_mes_actual"] == 10.0
    assert r["coste_bc_mes_anterior"] == 5.0


def test_t2_untrimmed_and_null_chapters_lose_their_cost(spark, base):
    s = summary(spark, **base, job_ledger_entries_bc=[
        ledger(D(1997, 1, 5), "PY_1", " 02.01 ", 7),
        ledger(D(1997, 1, 5), "PY_1", None, 3),
    ])
    assert s[("PY_1", "Directos", "02.01")]["coste_bc_a_origen"] == 0.0
    assert s[("PY_1", "Directos", "None")]["coste_bc_a_origen"] == 0.0


def test_t3_all_null_certification_and_overhead_base(spark, base):
    plan = lambda task, amt: {"Planning_Date": TS(1997, 1, 10), "Gen_Prod_Posting_Group": "CERTIFICACIONES",
                              "Line_Amount": dec(amt), "Job_No": "PY_1", "Job_Task_No": task,
                              "CompanyId": " 1 ", "Company_Name": None}
    track = lambda task, cp, resto: {"fecha_produccion": D(1997, 1, 20), "certificacion_pendiente": dec(cp),
                                     "resto_produccion": dec(resto), "capitulo_codigo": task, "capitulo": None,
                                     "proyecto": "py_1 ", "empresa": " acme", "observaciones": None}
    s = summary(spark, **base,
                job_ledger_entries_bc=[ledger(D(1997, 1, 5), "PY_1", "01.01", 1),
                                       ledger(D(1997, 1, 5), "PY_1", "02.01", 1)],
                job_planning_lines_bc=[plan("01.01", None), plan("02.01", 100)],
                DimSeguimientoProduccion=[track("01.01", 4, 2), track("02.01", 1, 1)],
                DimProporcionales=[{"number": "PY_1", "CompanyId": "1", "gastos generales": dec(10),
                                    "postventa": dec(20)},
                                   {"number": "PY_1", "CompanyId": "1", "gastos generales": dec(50),
                                    "postventa": None}])
    a = s[("PY_1", "Directos", "01.01")]
    b = s[("PY_1", "Directos", "02.01")]
    assert a["certificacion_a_origen"] == 0.0
    assert a["produccion_a_origen"] == 6.0          # repaired on load: 0 + 4 + 2
    assert b["certificacion_a_origen"] == 100.0
    assert b["produccion_a_origen"] == 102.0
    gg = s[("PY_1", "Proporcionales", "Gastos generales")]
    pv = s[("PY_1", "Proporcionales", "Postventa")]
    # base excludes chapter 01.01 (its production was NULL before the load)
    assert gg["coste_total_a_origen"] == 10.2        # min(10, 50) % of 102
    assert gg["coste_bc_a_origen"] == 10.2
    assert gg["coste_bc_mes_actual"] == 10.0         # 10 % of certification of the month (100)
    assert pv["coste_total_a_origen"] == 20.4


def test_overheads_without_chapters(spark, base):
    s = summary(spark, **base)
    assert set(s) == {("PY_1", "Proporcionales", "Gastos generales"), ("PY_1", "Proporcionales", "Postventa")}
    assert s[("PY_1", "Proporcionales", "Postventa")]["company_id"] == "1"


def test_unify_bare_code_to_first_description(spark, base):
    task = lambda t, price: {"Job_No": "PY_1", "CompanyId": "1", "Job_Task_No": t,
                             "Schedule_Total_Price": dec(price), "Schedule_Total_Cost": dec(price)}
    s = summary(spark, **base,
                job_ledger_entries_bc=[ledger(D(1997, 1, 5), "PY_1", "03.01.B", 1),
                                       ledger(D(1997, 1, 5), "PY_1", "03.01.A", 2)],
                job_task_lines_subform_bc=[task("03.01", 50)])
    assert ("PY_1", "Directos", "03.01") not in s
    a = s[("PY_1", "Directos", "03.01.A")]
    assert a["contratos"] == 50.0 and a["coste_bc_a_origen"] == 2.0
    assert s[("PY_1", "Directos", "03.01.B")]["contratos"] == 0.0


def test_t5_t6_photos_strip_only_and_code_fallback(spark):
    pend = lambda emp, code, cap: {"fecha_seguimiento": D(1997, 1, 3), "coste_pendiente": dec(1),
                                   "capitulo_codigo": code, "capitulo": cap, "proyecto": "PY_1",
                                   "empresa": emp}
    src = make_sources(spark, companies_bc=[company("1", "ACME")], DimPendientesProduccion=[
        pend(" ACME ", None, "CAP X"), pend("acme", "01.01", None), pend(None, "02.01", None)])
    rows = DS.pending_docs(src, "ACME", None, D(1997, 1, 1), D(1997, 1, 31)).collect()
    assert len(rows) == 1                               # strip-only, case-sensitive
    assert rows[0]["capitulo"] == "None"                # NULL code renders 'None', text ignored
    assert rows[0]["company_id"] is None                # the name join uses the unstripped name
    allrows = DS.pending_docs(src, None, None, D(1997, 1, 1), D(1997, 1, 31)).collect()
    assert len(allrows) == 3


def test_t8_invoice_lines_multiply_cost(spark):
    src = make_sources(
        spark, companies_bc=[company("1", "ACME")],
        purchase_invoices_bc=[{"id": "9", "CompanyId": "1", "number": "F9", "vendorName": "V",
                               "invoiceDate": TS(1997, 1, 10)}],
        purchase_invoice_lines_bc=[{"CompanyId": "1", "InvoiceId": "9"}] * 3,
        job_ledger_entries_bc=[ledger(D(1997, 1, 5), "PY_1", "01.01", 10, doc="F9"),
                               ledger(D(1997, 1, 6), "PY_1", "01.01", 5, doc="F9"),
                               ledger(D(1997, 1, 6), "PY_1", None, 5, doc="F9"),
                               ledger(D(1997, 1, 6), "PY_1", "01.01", 99, doc="F9", gppg="CERTIFICACIONES")])
    rows = DS.invoices_by_chapter(src, None, None, D(1997, 1, 1), D(1997, 1, 31)).collect()
    assert [(r["capitulo"], float(r["coste_registrado_a_origen"])) for r in rows] == [("01.01", 45.0)]
    rows = DS.invoices_by_chapter(src, None, None, D(1997, 1, 1), D(1997, 1, 31), dedupe_lines=True).collect()
    assert float(rows[0]["coste_registrado_a_origen"]) == 15.0


def test_t12_concatenated_task_key(spark):
    src = make_sources(
        spark, companies_bc=[company("B_C", "X"), company("C", "Y")],
        job_list_bc=[job("A", "B_C"), job("A_B", "C")],
        job_task_lines_subform_bc=[{"Job_No": "A", "CompanyId": "B_C", "Job_Task_No": "01",
                                    "Schedule_Total_Price": dec(1), "Schedule_Total_Cost": dec(1)}])
    rows = DS.task_lines(src, None, None).collect()
    # 'A' + '_' + 'B_C' == 'A_B' + '_' + 'C': the text key matches both jobs
    assert sorted(r["company_name"] for r in rows) == ["X", "Y"]


def test_unposted_registered_and_derived_project(spark):
    f = lambda doc, bc, amt, job, unit, task: {"documentDate": TS(1997, 1, 2), "documentNo": doc,
                                               "bc_documentNo": bc, "bc_draftDocumentNo": None,
                                               "vendorName": "S", "posting_description": None,
                                               "baseAmount": dec(amt), "posting_jobNo": job,
                                               "posting_jobTaskNo": task, "company": "1", "bunisnessUnit": unit}
    src = make_sources(
        spark, companies_qwark=[company("1", "ACME")],
        businessUnit_qwark=[{"id": "7", "Unidad de negocio": "UN 0042 OBRA"}],
        facturas_qwark=[f("a", "xCFRx", 10, "PY_1", "7", "01"), f("b", None, -5, "PY_1", "7", "01"),
                        f("c", None, 3, " ", "7", "  "), f("d", "RET1", 4, "PY_1", "7", None)])
    rows = {r["documentNo_orig"]: r for r in DS.unposted_pending(src, None, None, D(1997, 1, 31)).collect()}
    assert set(rows) == {"c", "d"}                       # registered and negative dropped; RET kept
    assert rows["c"]["proyecto"] == "PY_000042"


def test_t7_task_end_date_option(spark, base):
    task = lambda t, price, end: {"Job_No": "PY_1", "CompanyId": "1", "Job_Task_No": t,
                                  "Schedule_Total_Price": dec(price), "Schedule_Total_Cost": dec(price),
                                  "End_Date": end}
    tables = dict(base, job_task_lines_subform_bc=[task("01.01", 10, TS(1997, 1, 10)),
                                                    task("01.01", 5, None),
                                                    task("01.01", 7, TS(1997, 3, 1)),
                                                    task("09.01", 4, TS(1997, 3, 1))])
    src = make_sources(spark, **tables)
    default = {r["capitulo"]: r for r in resumen(src, R.all_projects(src), JAN).collect()}
    limited = {r["capitulo"]: r for r in resumen(src, R.all_projects(src), JAN, with_end_date=True).collect()}
    assert default["01.01"]["contratos"] == 22.0      # end date ignored, as in the reference
    assert limited["01.01"]["contratos"] == 10.0
    assert limited["09.01"]["contratos"] == 0.0        # chapter kept in the spine


def test_t2_option_normalize_all_chapters(spark, base):
    tables = dict(base, job_ledger_entries_bc=[ledger(D(1997, 1, 5), "PY_1", " 02.01 ", 7),
                                                ledger(D(1997, 1, 5), "PY_1", None, 3)])
    src = make_sources(spark, **tables)
    rows = {r["capitulo"]: r for r in
            resumen(src, R.all_projects(src), JAN, normalize_all_chapters=True).collect()}
    assert rows["02.01"]["coste_bc_a_origen"] == 7.0
    assert rows["None"]["coste_bc_a_origen"] == 3.0


def test_t6_option_chapter_fallback(spark):
    src = make_sources(spark, companies_bc=[company("1", "ACME")], DimPendientesProduccion=[
        {"fecha_seguimiento": D(1997, 1, 3), "coste_pendiente": dec(1), "capitulo_codigo": None,
         "capitulo": " CAP X ", "proyecto": "PY_1", "empresa": "ACME"}])
    rows = DS.pending_docs(src, None, None, D(1997, 1, 1), D(1997, 1, 31), chapter_fallback=True).collect()
    assert rows[0]["capitulo"] == "CAP X"


def test_planning_timestamp_after_midnight_of_the_cut_is_excluded(spark, base):
    plan = lambda ts, amt: {"Planning_Date": ts, "Gen_Prod_Posting_Group": "CERTIFICACIONES",
                            "Line_Amount": dec(amt), "Job_No": "PY_1", "Job_Task_No": "01.01",
                            "CompanyId": "1", "Company_Name": None}
    s = summary(spark, **base,
                job_ledger_entries_bc=[ledger(D(1997, 1, 5), "PY_1", "01.01", 1)],
                job_planning_lines_bc=[plan(TS(1997, 1, 31, 0, 0), 100), plan(TS(1997, 1, 31, 10, 0), 7),
                                       plan(TS(1996, 12, 31), 5)])
    r = s[("PY_1", "Directos", "01.01")]
    assert r["certificacion_a_origen"] == 105.0      # the 10:00 line on the last day is after the cut
    assert r["certificacion_mes_actual"] == 100.0
    assert r["certificacion_mes_anterior"] == 5.0


def test_ordered_report(spark, base):
    src = make_sources(spark, **base, job_ledger_entries_bc=[
        ledger(D(1997, 1, 5), "PY_1", "02.01", 1), ledger(D(1997, 1, 5), "PY_1", "01.01", 1)])
    got = [(r["grupo"], r["capitulo"]) for r in resumen(src, R.all_projects(src), JAN, ordered=True).collect()]
    assert got == [("Directos", "01.01"), ("Directos", "02.01"),
                   ("Proporcionales", "Gastos generales"), ("Proporcionales", "Postventa")]


def test_planning_matched_by_name_when_the_request_has_no_company_id(spark):
    plan = lambda cid, cname, amt: {"Planning_Date": TS(1997, 1, 10), "Gen_Prod_Posting_Group": "CERTIFICACIONES",
                                    "Line_Amount": dec(amt), "Job_No": "PY_9", "Job_Task_No": "01.01",
                                    "CompanyId": cid, "Company_Name": cname}
    src = make_sources(spark, companies_bc=[company("1", "ACME")],   # PY_9 is not in the job list
                       DimSeguimientoProduccion=[{"fecha_produccion": D(1997, 1, 20), "certificacion_pendiente": dec(1),
                                                  "resto_produccion": dec(0), "capitulo_codigo": "01.01",
                                                  "capitulo": None, "proyecto": "PY_9", "empresa": "ACME",
                                                  "observaciones": None}],
                       job_planning_lines_bc=[plan("7", "ACME", 40), plan("8", "OTHER", 1000)])
    rows = {r["capitulo"]: r for r in resumen(src, R.explicit(spark, src, [("ACME", "PY_9")]), JAN).collect()}
    assert rows["01.01"]["company_id"] is None
    assert rows["01.01"]["certificacion_a_origen"] == 40.0


def test_t12_restricted_run_keeps_rows_of_the_concatenated_key(spark):
    """Task line (A, B_C) belongs to project (A_B, C): cutting the sources to the requests
    must not lose it."""
    src = make_sources(
        spark, companies_bc=[company("C", "Y")], job_list_bc=[job("A_B", "C"), job("Z", "C")],
        job_task_lines_subform_bc=[
            {"Job_No": "A", "CompanyId": "B_C", "Job_Task_No": "01", "Schedule_Total_Price": dec(10)},
            {"Job_No": "Z", "CompanyId": "C", "Job_Task_No": "01", "Schedule_Total_Price": dec(99)}],
        facturas_qwark=[{"documentDate": TS(1997, 1, 3), "documentNo": "1", "baseAmount": dec(5), "posting_jobNo": "A_B",
                         "posting_jobTaskNo": "01", "company": "C"}])
    req = R.explicit(spark, src, [("Y", "A_B")])
    free, cut = (sorted(map(tuple, resumen(src, req, JAN, restrict=r).collect())) for r in (False, True))
    assert free == cut and len(free) == 3
    assert [r["contratos"] for r in resumen(src, req, JAN, restrict=True).where("capitulo = '01'").collect()] == [10.0]


def test_building_a_query_starts_no_job(spark):
    """Datasets and the summary are lazy."""
    src = make_sources(spark, companies_bc=[company("1", "ACME")], job_list_bc=[job("PY_1", "1")])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "no jobs expected")
    try:
        req = R.all_projects(src)
        for restrict in (False, True):
            resumen(src, req, JAN, restrict=restrict)
        DS.invoices_by_chapter(src, "ACME", None, D(1997, 1, 1), D(1997, 1, 31))
        DS.ledger_entries(src, None, None, D(1997, 1, 31))
        DS.unposted_docs(src, "", "", D(1997, 1, 1), D(1997, 1, 31))
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_empty_parameters_mean_no_filter(spark, base):
    src = make_sources(spark, **base, companies_qwark=[company("1", "ACME")], facturas_qwark=[
        {"documentDate": TS(1997, 1, 3), "documentNo": "1", "baseAmount": dec(5), "posting_jobNo": "PY_1", "company": "1"}])
    assert DS.unposted_docs(src, "", "", D(1997, 1, 1), D(1997, 1, 31)).count() == 1
    assert DS.unposted_pending(src, "", "", D(1997, 1, 31)).count() == 1
    assert DS.task_lines(src, "", None).count() == 0  # the SQL datasets do compare with ''


def test_summary_tail_is_hash_aggregated(spark, base):
    src = make_sources(spark, **base)
    plan = resumen(src, R.all_projects(src), JAN)._jdf.queryExecution().executedPlan().toString()
    # only the requests' company id, one row per project, is a text that is aggregated
    sorts = [ln for ln in plan.split("\n") if "SortAggregate" in ln]
    assert all("min(CompanyId" in ln for ln in sorts) and "HashAggregate" in plan


@pytest.mark.parametrize("prev", [False, True])
def test_summary_tail_holds_one_sort(spark, base, prev):
    """Above the one shuffle of the tall union a task sorts its narrow rows once; sums and totals are
    windows in that order, and no aggregation keeps a row of sums for every chapter of the task."""
    src = make_sources(spark, **base)
    plan = resumen(src, R.all_projects(src), JAN, with_prev_month=prev)._jdf.queryExecution().executedPlan().toString()
    tail = plan[:plan.index("REPARTITION_BY_COL")].split("\n")
    assert sum("- Sort [" in ln for ln in tail) == 1 and any("Window [" in ln for ln in tail)
    assert not any("Aggregate" in ln or "Generate" in ln for ln in tail)


def test_chapters_joined_within_a_code(spark, base):
    """The bare code joins the first description, whatever lies between them; spellings that differ in a
    no-break space are one chapter; other chapters of the code stay alone; rows of the same code of a
    project asked for under two company ids stay apart."""
    nbsp = chr(160)
    tables = dict(base, job_ledger_entries_bc=[
        ledger(D(1997, 1, 5), "PY_1", cap, cost) for cap, cost in
        [("03.01", 1), (f"03.01.A{nbsp}X", 2), ("03.01.A X", 4), ("03.01.B", 8), ("03.01-A", 16), ("04.01", 32), ("04.01.Z", 64), ("CAP A", 128), ("CAP A1", 256)]])
    src = make_sources(spark, **tables)
    both = R.all_projects(src).unionByName(R.all_projects(src).withColumn("company_id", F.lit("another")))
    rows = [r for r in resumen(src, both, JAN).collect() if r["grupo"] == "Directos"]
    for cid in ("1", "another"):
        assert {r["capitulo"]: r["coste_bc_a_origen"] for r in rows if r["company_id"] == cid} == {
            "03.01.A X": 7.0, "03.01.B": 8.0, "03.01-A": 16.0, "04.01.Z": 96.0, "CAP A": 128.0, "CAP A1": 256.0}
    assert len(rows) == 12


def test_detail_tables_fail_on_their_own(spark, base, tmp_table_root):
    """A broken detail source is reported; the others and the run log are still written."""
    from costlens.plans import runs as RUN
    src = make_sources(spark, **base, job_ledger_entries_bc=[ledger(D(1997, 1, 5), "PY_1", "01.01", 10)])
    src = dict(src, purchase_invoices_bc=src["purchase_invoices_bc"].drop("number"))
    target = RUN.Target(tmp_table_root)
    out = RUN.run_snapshot(spark, src, R.all_projects(src), JAN, target, all_projects=True)
    assert out[RUN.SUMMARY]["inserted"] == 3 and "error" in out[RUN.INVOICES]
    assert out[RUN.RESOURCES] == {"inserted": 0, "skipped": 0}
    assert spark.read.parquet(target.path(RUN.RUN_LOG)).count() == 1


def test_checkpoint_folder_is_required_off_local_masters(monkeypatch):
    from types import SimpleNamespace

    from costlens import session
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    far = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d: d))
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(far)
    assert session.cluster_conf("s3a://bucket/ckpt")["spark.checkpoint.dir"] == "s3a://bucket/ckpt"
