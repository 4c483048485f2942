"""Matching on normalised text without normalising every row.

Company and project names of spreadsheets come in many spellings (spaces, no-break
spaces, case), but there are far fewer spellings than rows. A *spelling dictionary* is
the distinct raw spellings of a column; each is normalised once, and the rows are matched on
the raw column, which a scan can be filtered by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.functions.text import normalize_text

#: Spellings that are passed to the scan as literals.
LITERALS = 200


def spellings(df: DataFrame, column: str) -> DataFrame:
    """(raw, key): each distinct value of the column, null too, and its normal form."""
    raw = df.select(F.col(column).cast("string").alias("raw")).distinct()
    return raw.withColumn("key", normalize_text("raw"))


def where_spelled(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose column, normalised, equals the normalised ``value``. The dictionary is read
    first (a scan of this one column): up to ``LITERALS`` spellings become an IN filter that
    reaches the scan, more are semi-joined on the raw column."""
    found = spellings(df, column).where(F.col("key") == normalize_text(F.lit(value))).select("raw")
    known = [r[0] for r in found.limit(LITERALS + 1).collect()]
    if len(known) > LITERALS:
        return df.join(found, F.col(column).cast("string").eqNullSafe(F.col("raw")), "left_semi")
    exact = F.col(column).isin([x for x in known if x is not None])
    return df.where(exact | F.col(column).isNull() if None in known else exact)


def semi_spelled(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose column, normalised, is among ``keys``: the dictionary is joined to the keys,
    and the rows to what is left of it, on the raw column."""
    wanted = keys.select(F.col(key).alias("_wanted")).distinct()
    found = spellings(df, column).join(wanted, F.col("key") == F.col("_wanted"), "left_semi").select("raw")
    return df.join(found, F.col(column).cast("string").eqNullSafe(F.col("raw")), "left_semi")
