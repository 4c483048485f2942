"""Balances: to-date metrics without rereading all history.

Posted cost, certified revenue and unposted invoices count from the first entry on, so a
month's run would read every entry ever posted. A *balance* holds, per month that was closed, what the
entries up to its end add up to, on the source's own keys (job, company, chapter); a
month's to-date metrics are the last balance before it plus the entries after that balance.

Late entries. Each balance remembers the greatest *change mark* (an entry number or a time
of change, which grows with every insert and update) that it has seen. A run also reads
the entries dated inside the balance with a greater mark, or without one. The two
conditions are one scan filter on plain columns:

    date in the open window  or  (date before it and (mark > seen or mark is null))

so files and row groups of old entries, with old marks, are skipped by their statistics.

Ledger and planning entries are only ever added. Unposted invoices change (they get
registered, or corrected): their balance keeps the documents that were pending, a
small part of the table, and the documents among the entries just read replace theirs:
both are dealt out by document once, and the entries are read once.

Balances are tables partitioned by month, replaced month by month in a journaled commit
(``sinks.commit``). They're an option: without them, or for the first balance, everything is read
once, and results are the same, row by row.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from costlens.functions.dates import as_date, as_ts, lit_date, lit_ts, on_or_before
from costlens.functions.text import contains_ci, normalize_chapter, trim_ws
from costlens.operators.datasets import CERT, not_certification
from costlens.plans.period import Period
from costlens.session import shuffles_released
from costlens.sinks import commit as J
from costlens.sources.loaders import Sources

MONEY = "decimal(28,6)"


class NoChangeMark(ValueError):
    """The source has no change marks, so late entries couldn't be found."""


@dataclass(frozen=True)
class Balance:
    """How a source adds up. ``keys`` and ``measures`` are expressions over the source's rows;
    ``month`` are measures of the rows for which ``in_month`` holds, which no balance keeps. ``document``
    names the columns that tell documents apart where rows may change; ``each`` has what one row then adds
    to each measure."""

    name: str
    source: str
    date: str
    mark: str
    upto: Callable[[DataFrame, dt.date], Column]
    keys: Callable[[], dict[str, Column]]
    measures: Callable[[], dict[str, Column]]
    month: Callable[[Period], dict[str, Column]] = field(default=lambda period: {})
    wanted: Callable[[], Column] | None = None
    document: tuple[str, ...] = ()
    each: Callable[[], dict[str, Column]] = dict
    counts: tuple[str, ...] = ()


def _planned_upto(df: DataFrame, day: dt.date) -> Column:
    """Planning dates are compared as timestamps: 10:00 on the last day is after the cut."""
    return F.col("Planning_Date") <= lit_ts(day)


def _cost_measures(nc: Column) -> dict[str, Column]:
    return {"cbo": F.sum(F.when(nc, F.col("Total_Cost_LCY"))), "rows_nc": F.count(F.when(nc, F.lit(1)))}


def _cost_month(period: Period) -> dict[str, Column]:
    nc = not_certification("Gen_Prod_Posting_Group") & (as_date("Posting_Date") >= lit_date(period.month_start))
    return {"cbm": F.sum(F.when(nc, F.col("Total_Cost_LCY")))}


def _cert_month(period: Period) -> dict[str, Column]:
    amount, inside = F.col("Line_Amount"), as_ts("Planning_Date") >= lit_ts(period.month_start)
    return {"rows_m": F.count(F.when(inside, F.lit(1))), "sum_m": F.sum(F.when(inside, amount)),
            "n_m": F.count(F.when(inside, amount))}


COST = Balance(
    "cost", "job_ledger_entries_bc", "Posting_Date", "Entry_No",
    lambda df, day: on_or_before(df, "Posting_Date", day),
    lambda: {c: F.col(c) for c in ("Job_No", "CompanyId", "Job_Task_No")},
    lambda: _cost_measures(not_certification("Gen_Prod_Posting_Group")),
    _cost_month, counts=("rows_nc",))

CERTIFIED = Balance(
    "certified", "job_planning_lines_bc", "Planning_Date", "Entry_No", _planned_upto,
    lambda: {"_cid": trim_ws(F.coalesce(F.col("CompanyId").cast("string"), F.lit("None"))), "_cname": F.col("Company_Name"),
             "_pno": F.col("Job_No"), "raw_cap": F.col("Job_Task_No")},
    lambda: {"rows_o": F.count(F.lit(1)), "sum_o": F.sum("Line_Amount"), "n_o": F.count("Line_Amount")},
    _cert_month, wanted=lambda: F.col("Gen_Prod_Posting_Group") == F.lit(CERT),
    counts=("rows_o", "n_o", "rows_m", "n_m"))

UNPOSTED = Balance(
    "unposted", "facturas_qwark", "documentDate", "Change_No",
    lambda df, day: on_or_before(df, "documentDate", day),
    lambda: {"company": F.col("company"), "bunisnessUnit": F.col("bunisnessUnit"), "posting_jobNo": F.col("posting_jobNo"),
             "cap": normalize_chapter("posting_jobTaskNo")},
    lambda: {"qwk": F.sum("baseAmount")},
    wanted=lambda: (F.col("baseAmount") > 0) & ~contains_ci("bc_documentNo", "CFR"),
    document=("company", "documentNo"), each=lambda: {"qwk": F.col("baseAmount")})

BALANCES = (COST, CERTIFIED, UNPOSTED)


@dataclass(frozen=True)
class Rollup:
    """The balances under ``root``, a folder on shared storage."""

    root: str

    def path(self, of: Balance) -> str:
        return f"{self.root.rstrip('/')}/{of.name}"

    def marks(self, spark: SparkSession, of: Balance) -> dict[str, str]:
        """The mark that each month's balance has seen."""
        J.recover(spark, self.path(of))
        return json.loads(J.read_text(spark, f"{self.path(of)}.marks.json") or "{}")


def _label(period: Period) -> str:
    return f"{period.year:04d}-{period.month:02d}"


def _period(label: str) -> Period:
    return Period(*map(int, label.split("-")))


def _base(marks: dict[str, str], period: Period) -> str | None:
    """The last balance that ends before the month begins."""
    return max((m for m in marks if m < _label(period)), default=None)


def _newer(of: Balance, df: DataFrame, seen: str) -> Column:
    mark = F.col(of.mark)
    return (mark > F.lit(seen).cast(df.schema[of.mark].dataType)) | mark.isNull()


def _unnamed(of: Balance) -> Column:
    """Rows that no document key tells apart are never kept in a balance."""
    out = F.lit(False)
    for c in of.document:
        out = out | F.col(c).isNull()
    return out


def _open(of: Balance, df: DataFrame, period: Period, base: str | None, seen: str | None) -> Column:
    """Holds for the rows that the base balance hasn't counted, up to the cut."""
    upto = of.upto(df, period.cut)
    if base is None:
        return upto
    before = of.upto(df, _period(base).cut)
    uncounted = _newer(of, df, seen)
    if of.document:
        uncounted = uncounted | _unnamed(of)
    return upto & (~before | (before & uncounted))


def _sums(rows: DataFrame, of: Balance, by: list[str], period: Period | None) -> DataFrame:
    measures = of.measures() | (of.month(period) if period else {})
    if of.wanted is not None:
        rows = rows.where(of.wanted())
    document = [F.col(c).alias(f"doc_{c}") for c in of.document if f"doc_{c}" in by]
    return rows.groupBy(*[e.alias(k) for k, e in of.keys().items()], *document).agg(*[m.alias(k) for k, m in measures.items()])


def _added(of: Balance, parts: DataFrame, by: list[str]) -> DataFrame:
    """Sums of sums, in the types of a full scan."""
    values = [c for c in parts.columns if c not in by]
    return parts.groupBy(*by).agg(*[
        F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) if c in of.counts else F.sum(c).cast(MONEY).alias(c) for c in values])


def _balance(spark: SparkSession, rollup: Rollup, of: Balance, base: str, schema) -> DataFrame:
    rows = spark.read.schema(schema).option("basePath", rollup.path(of)).parquet(f"{rollup.path(of)}/month={base}")
    return rows.drop("month")


def _replaced(of: Balance, df: DataFrame, old: DataFrame, is_open: Column, newer: Column, by: list[str]) -> DataFrame:
    """The balance without the documents that were read again, and the open rows. One scan gives both, and
    balance and rows cross the network once, by document; rows without a document by their keys."""
    named, counted = ~_unnamed(of), F.coalesce(is_open & of.wanted(), F.lit(False))
    doc = [c for c in by if c not in of.keys()]
    rows = df.select(*[F.when(counted, e).alias(k) for k, e in of.keys().items()], *[F.col(c).alias(f"doc_{c}") for c in of.document],
                     *[F.when(counted, e).cast(MONEY).alias(k) for k, e in of.each().items()],
                     counted.alias("_counted"), (newer & named).alias("_again"), F.lit(False).alias("_old"),
                     F.when(~named, F.xxhash64(*of.keys().values())).alias("_unnamed")).where("_counted or _again")
    kept = old.withColumns({"_counted": F.lit(True), "_again": F.lit(False), "_old": F.lit(True), "_unnamed": F.lit(None).cast("bigint")})
    place = [*doc, "_unnamed"]
    dealt = kept.unionByName(rows).repartition(*place)
    again = F.max("_again").over(Window.partitionBy(*place))
    dealt = dealt.withColumn("_again", again).where(F.col("_counted") & ~(F.col("_old") & F.col("_again")))
    return _added(of, dealt.drop("_counted", "_again", "_old"), [*by, "_unnamed"]).drop("_unnamed")


def _state(spark: SparkSession, src: Sources, of: Balance, period: Period, rollup: Rollup | None, upto_mark=None,
           with_month: bool = True) -> DataFrame:
    """Sums up to the cut, per key (and document): the base balance and the open rows."""
    by = [*of.keys(), *[f"doc_{c}" for c in of.document]]
    marks = rollup.marks(spark, of) if rollup else {}
    base = _base(marks, period)
    df = src[of.source]
    is_open = _open(of, df, period, base, marks.get(base))
    seen = df if upto_mark is None else df.where(F.col(of.mark) <= upto_mark)
    if base is None:
        return _sums(seen.where(is_open), of, by, period if with_month else None)
    old = _balance(spark, rollup, of, base, _sums(df, of, by, None).schema)
    if of.document:  # what was read again replaces what the balance knew of the document
        newer = _newer(of, df, marks[base])
        return _replaced(of, seen.where(is_open | newer), old, is_open, newer, by)
    new = _sums(seen.where(is_open), of, by, period if with_month else None)
    return _added(of, old.unionByName(new, allowMissingColumns=True), by)


def to_date(spark: SparkSession, src: Sources, of: Balance, period: Period, rollup: Rollup | None = None) -> DataFrame:
    """The to-date (and month) measures of a source per key, at the period's cut. The last balance
    before the month, if there is one, stands for the entries that it has counted."""
    state = _state(spark, src, of, period, rollup)
    return _added(of, state.drop(*[f"doc_{c}" for c in of.document]), list(of.keys())) if of.document else state


def close_month(spark: SparkSession, src: Sources, of: Balance, period: Period, rollup: Rollup, upto_mark=None) -> dict:
    """Write the balance of ``period`` from the one before it and the entries since. It has seen
    all entries with a mark up to ``upto_mark`` (the greatest there is, by default); closing a
    month again replaces its balance. The driver gets the mark alone."""
    df = src[of.source]
    if upto_mark is None:
        with shuffles_released(spark):
            upto_mark = df.agg(F.max(of.mark)).first()[0]
    if upto_mark is None:
        raise NoChangeMark(f"{of.source}: no value in {of.mark}")
    seen = spark.range(1).select(F.lit(upto_mark).cast(df.schema[of.mark].dataType).cast("string")).first()[0]
    marks = rollup.marks(spark, of)
    path, label = rollup.path(of), _label(period)
    staging = J.staging_for(path)
    with shuffles_released(spark):
        state = _state(spark, src, of, period, rollup, F.lit(upto_mark), with_month=False)
        for c in of.document:
            state = state.where(F.col(f"doc_{c}").isNotNull())
        state.write.parquet(f"{staging}/new/month={label}")
    # the mark is stored first, with the month it replaces left out: a crash in between loses
    # a balance, not an entry
    J.write_text(spark, f"{path}.marks.json", json.dumps({m: x for m, x in marks.items() if m != label}))
    J.commit(spark, staging, path, 1)
    J.write_text(spark, f"{path}.marks.json", json.dumps({**marks, label: seen}))
    return {"month": label, "mark": seen}


def close_all(spark: SparkSession, src: Sources, period: Period, rollup: Rollup) -> dict:
    """The balances of all sources that have change marks."""
    out = {}
    for of in BALANCES:
        try:
            out[of.name] = close_month(spark, src, of, period, rollup)
        except NoChangeMark as e:
            out[of.name] = {"error": str(e)}
    return out
