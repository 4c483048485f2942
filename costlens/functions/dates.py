"""Date helpers (coercing casts; bad values become NULL, never errors)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(c) -> Column:
    return _col(c).try_cast("date")


def as_ts(c) -> Column:
    """Naive timestamp; a date becomes midnight."""
    return _col(c).try_cast("timestamp_ntz")


def lit_date(d: dt.date) -> Column:
    return F.lit(d).cast("date")


def lit_ts(d: dt.date) -> Column:
    return F.lit(d).cast("timestamp_ntz")


def in_window(c, d1: dt.date, d2: dt.date) -> Column:
    """d1 <= date(c) <= d2; NULL dates are dropped."""
    d = as_date(c)
    return d.isNotNull() & (d >= lit_date(d1)) & (d <= lit_date(d2))


# ─────────── sargable date predicates (pushed into parquet / JDBC scans) ───────────
#
# ``CAST(ts AS DATE) <= d`` cannot be pushed into a parquet scan; for a
# timestamp column the equivalent ``ts < d + 1 day`` can, so row groups
# outside the period are skipped. The helpers pick the form from the
# column's type; NULL dates fail every comparison, as before.

def _kind(df, name: str) -> str:
    from pyspark.sql.types import DateType, TimestampNTZType, TimestampType
    t = df.schema[name].dataType
    if isinstance(t, TimestampNTZType):
        return "ntz"
    if isinstance(t, TimestampType):
        return "ltz"
    if isinstance(t, DateType):
        return "date"
    return "other"


def _bound(kind: str, d: dt.date) -> Column:
    if kind == "ntz":
        return lit_ts(d)
    return F.lit(d).cast("timestamp")


def on_or_before(df, name: str, d: dt.date) -> Column:
    """date(col) <= d, written so the scan can use it."""
    k = _kind(df, name)
    c = F.col(name)
    if k in ("ntz", "ltz"):
        return c < _bound(k, d + dt.timedelta(days=1))
    if k == "date":
        return c <= lit_date(d)
    return as_date(c) <= lit_date(d)


def within(df, name: str, d1: dt.date, d2: dt.date) -> Column:
    """d1 <= date(col) <= d2, written so the scan can use it."""
    k = _kind(df, name)
    c = F.col(name)
    if k in ("ntz", "ltz"):
        return (c >= _bound(k, d1)) & (c < _bound(k, d2 + dt.timedelta(days=1)))
    if k == "date":
        return (c >= lit_date(d1)) & (c <= lit_date(d2))
    return in_window(c, d1, d2)
