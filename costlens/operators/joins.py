"""Join helpers: optional-parameter filters.

No join in this package carries a broadcast hint: lookups are joined as plain
scans, so Spark broadcasts them by their measured bytes and its own threshold, and
adaptive execution re-plans the rest at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def where_eq(df: DataFrame, col: Column | str, value) -> DataFrame:
    """``(value IS NULL OR col = value)`` built only when the value is given,
    so no always-true disjunction reaches the plan."""
    if value is None:
        return df
    c = F.col(col) if isinstance(col, str) else col
    return df.where(c == F.lit(value))


def where_given(df: DataFrame, col: Column | str, value) -> DataFrame:
    """``where_eq`` for the datasets whose reference filter treats '' as no filter."""
    return where_eq(df, col, value or None)
