"""Golden tests of the column helpers (traps T4, T9, T11)."""

import decimal

from pyspark.sql import functions as F

import costlens.functions.money as money
import costlens.functions.text as text


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(expr(F.col("v")).alias("r")).first()["r"]


def test_trim_ws_strips_unicode_whitespace(spark):
    assert one(spark, text.trim_ws, "  x y \t") == "x y"
    assert one(spark, text.trim_ws, "\x1c a \x1f") == "a"   # Python treats these as spaces


def test_normalize_text(spark):
    assert one(spark, text.normalize_text, "  ACME Obras ") == "acme obras"
    assert one(spark, text.normalize_text, None) == "none"    # str(None).casefold()


def test_normalize_chapter(spark):
    assert one(spark, text.normalize_chapter, None) == "None"
    assert one(spark, text.normalize_chapter, "   ") == "None"
    assert one(spark, text.normalize_chapter, " 01.01 ") == "01.01"


def test_clean_chapter_nbsp_inside(spark):
    assert one(spark, text.clean_chapter, "01.01.A B ") == "01.01.A B"


def test_clean_value(spark):
    assert one(spark, text.clean_value, "  ") is None
    assert one(spark, text.clean_value, " a ") == "a"


def test_derive_project(spark):
    df = spark.createDataFrame(
        [("", "UN 12345 OBRA"), (None, "SIN CODIGO"), ("  ", None), ("PY_9", "UN 0001"), (None, "x0042y")],
        "p string, u string")
    got = [r["r"] for r in df.select(text.derive_project("p", "u").alias("r")).collect()]
    assert got == ["PY_001234", None, None, "PY_9", "PY_000042"]


def test_contains_ci(spark):
    df = spark.createDataFrame([("xcfr1",), (None,), ("ret",)], "v string")
    got = [r["r"] for r in df.select(text.contains_ci("v", "CFR").alias("r")).collect()]
    assert got == [True, False, False]


def test_round_half_up_on_decimals(spark):
    df = spark.createDataFrame([(decimal.Decimal("2.675"),), (decimal.Decimal("0.125"),),
                                (decimal.Decimal("-2.675"),)], "v decimal(18,6)")
    got = [r["r"] for r in df.select(money.round_money("v").alias("r")).collect()]
    assert got == [decimal.Decimal("2.68"), decimal.Decimal("0.13"), decimal.Decimal("-2.68")]


def test_clamp_pct(spark):
    df = spark.createDataFrame([(8.0,), (0.5,), (-3.0,), (150.0,), (None,)], "v double")
    got = [float(r["r"]) for r in df.select(money.clamp_pct("v").alias("r")).collect()]
    assert got == [0.08, 0.005, 0.0, 1.0, 0.0]
