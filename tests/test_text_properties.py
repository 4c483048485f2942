"""Bulk comparison of the text helpers with Python's own string semantics."""

import random
import re
import sys

import costlens.functions.text as text

# every character Python's str.isspace() accepts, plus ordinary text
WHITESPACE = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]
ALPHABET = WHITESPACE + list("aZ09._-ñ ")


def _strings(n=2000, seed=7):
    rnd = random.Random(seed)
    return [("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 8))),) for _ in range(n)]


def test_trim_ws_equals_python_strip(spark):
    data = _strings()
    df = spark.createDataFrame(data, "s string")
    got = [r["t"] for r in df.select(text.trim_ws("s").alias("t")).collect()]
    assert got == [s.strip() for (s,) in data]


def test_normalize_chapter_equals_python(spark):
    data = _strings(seed=11) + [(None,)]
    df = spark.createDataFrame(data, "s string")
    got = [r["t"] for r in df.select(text.normalize_chapter("s").alias("t")).collect()]
    want = [("" if s is None else s).strip() or "None" for (s,) in data]
    assert got == want


def test_derive_project_equals_python_regex(spark):
    rnd = random.Random(3)
    units = ["".join(rnd.choice("0123456789 UNx") for _ in range(rnd.randint(0, 9))) for _ in range(500)]
    df = spark.createDataFrame([("", u) for u in units], "p string, u string")
    got = [r["t"] for r in df.select(text.derive_project("p", "u").alias("t")).collect()]

    def py(u):
        m = re.search(r"(\d{4})", u) if u else None
        return f"PY_00{m.group(1)}" if m else None
    assert got == [py(u) for u in units]
