"""Full case folding, and matching by spelling dictionaries."""

import datetime as dt
import sys

import pytest
from pyspark.sql import functions as F

from costlens.functions.text import casefold, normalize_text
from costlens.operators import datasets as DS
from costlens.operators import spelling as SP
from helpers import make_sources

NBSP = "\u00a0"


def test_casefold_of_every_code_point(spark):
    points = [p for p in range(sys.maxunicode + 1) if not 0xD800 <= p <= 0xDFFF]
    # hundreds of code points a row, each between two others
    rows = [("|".join(map(chr, points[i : i + 500])),) for i in range(0, len(points), 500)]
    got = spark.createDataFrame(rows, "s string").select("s", casefold("s").alias("f")).collect()
    assert [r["f"] for r in got] == [r["s"].casefold() for r in got]


def test_casefold_in_words(spark):
    words = ["Straße", "STRASSE", "ﬁn ﬀ", "ΌΣΟΣ", "İstanbul", "ŉ", "ᾳ ᾼ", "𐐀𐐨", "ACME 1", "", None, "ß" * 50, "ẞ"]
    got = spark.createDataFrame([(w,) for w in words], "s string").select(casefold("s"), normalize_text("s")).collect()
    assert [r[0] for r in got] == [w if w is None else w.casefold() for w in words]
    assert [r[1] for r in got] == [str(w).replace(NBSP, " ").strip().casefold() for w in words]


def _tracking(spark, names):
    day = dt.date(1997, 1, 5)
    return make_sources(spark, DimSeguimientoProduccion=[
        {"fecha_produccion": day, "empresa": e, "proyecto": p, "capitulo_codigo": "01", "resto_produccion": None} for e, p in names])


SPELLED = [("ACME", "P1"), (" acme", "P1"), (f"{NBSP}Acme{NBSP}", "p1"), ("ACME SA", "P1"), (None, "P1"), ("none", "P1"), ("Straße", "P2"), ("STRASSE", "P2"), ("ACME", None)]


def _norm(x):
    return str(x).replace(NBSP, " ").strip().casefold()


@pytest.mark.parametrize("literals", [200, 0])
def test_datasets_match_all_spellings(spark, monkeypatch, literals):
    monkeypatch.setattr(SP, "LITERALS", literals)
    src = _tracking(spark, SPELLED)
    a, b = dt.date(1997, 1, 1), dt.date(1997, 1, 31)
    for company, project in (("acme", None), ("acme", "P1"), ("None", None), ("strasse", None), (None, "p1"), ("nobody", None), (None, "NONE")):
        got = DS.production_month(src, company, project, a, b).collect()
        want = [(e, p) for e, p in SPELLED if (company is None or _norm(e) == _norm(company)) and (project is None or _norm(p) == _norm(project))]
        assert sorted(((r["company_name"], r["project_no"]) for r in got), key=str) == sorted(want, key=str), (company, project)


def test_spellings_reach_the_scan(spark, tmp_path):
    src = _tracking(spark, SPELLED)
    src["DimSeguimientoProduccion"].write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = SP.where_spelled(df, "empresa", "Acme")._jdf.queryExecution().executedPlan().toString()
    assert "In(empresa, [" in plan.split("PushedFilters")[1] and "regexp" not in plan, plan


def test_semi_join_on_spellings(spark):
    df = spark.createDataFrame([(e, i) for i, (e, _) in enumerate(SPELLED)], "empresa string, i int")
    keys = spark.createDataFrame([("acme",), ("none",), ("acme",)], "k string")
    got = sorted(r["i"] for r in SP.semi_spelled(df, "empresa", keys, "k").collect())
    assert got == [i for i, (e, _) in enumerate(SPELLED) if _norm(e) in ("acme", "none")]
