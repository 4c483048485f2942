"""The monthly project summary (`resumen`) for many requests in one plan.

Shape of the plan (one request = one (company, project) pair):

1. every source is aggregated on its own keys and mapped to request keys
   (``operators.chapters.all_parts``); every request adds one *seed* row that
   carries its overhead percentages;
2. that tall union is hash-partitioned by (company_name, project_no) and sorted
   by request, chapter code and chapter, **once**. The chapter sums, the
   per-project totals, the chapter unification and the final sums are windows
   over prefixes of that order, so the whole tail runs inside that one
   partitioning and order, with no further shuffle or sort and no second
   evaluation of the direct rows. The sort's narrow rows are all that a task
   holds: windows see a chapter, a code or a request at a time.

Building the DataFrame starts no Spark job: whoever writes it materialises it,
once, at the sink. Text keys are cleaned when the union is made, as the sink
would clean them, so the result has unique keys; the company id is constant per
request and grouped by, not aggregated, which keeps every aggregation of the
tail a hash aggregation. Columns that are constant 0 are added at the end.

Money stays DECIMAL throughout (order-independent sums, half-up rounding to
cents) and becomes DOUBLE only in the output. Row volume after step 1 is
bounded by projects x chapters, so a hot project costs no more than its
chapter count in the tail.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from costlens.functions.money import CENTS, PCT, clamp_pct, round_money
from costlens.functions.text import clean_chapter, clean_value
from costlens.operators.chapters import PARTS, all_parts, packed_parts  # noqa: F401  (tools/plan_summary.py reads all_parts here)
from costlens.operators.datasets import overhead_pct
from costlens.plans.period import Period
from costlens.plans.requests import with_norm_keys
from costlens.sources.loaders import Sources

KEY_COLS = ["company_name", "project_no", "period_date", "grupo", "capitulo", "nivel"]

# Output numeric columns, in the sink's order.
NUM_COLS = [
    "coste_bc_a_origen", "coste_bc_mes_actual", "coste_bc_mes_anterior", "coste_qwark",
    "coste_pendiente", "coste_total_a_origen", "certificacion_a_origen",
    "certificacion_mes_actual", "certificacion_mes_anterior", "certificacion_pendiente",
    "resto_produccion", "produccion_a_origen", "certificacion_pendiente_mes_anterior",
    "resto_produccion_mes_anterior", "produccion_mes_anterior", "resultado", "pct_resultado",
    "contratos", "planificado", "pct_avance_venta_contrato", "pct_avance_coste_planificado",
]
# Always 0 in the reference, and 0 unless the previous month is asked for.
CONSTANT = ["resultado", "pct_resultado", "pct_avance_venta_contrato", "pct_avance_coste_planificado"]
PREVIOUS = ["certificacion_pendiente_mes_anterior", "resto_produccion_mes_anterior"]
OUT_COLS = ["company_id", "company_name", "project_no", "period_date", "grupo", "capitulo", "nivel"] + NUM_COLS

# Group / level labels and the overhead lines.
DIRECT = "Directos"
OVERHEAD = "Proporcionales"
DETAIL = "Detalle"
OVERHEAD_LINES = (("Gastos generales", "gastos_generales"), ("Postventa", "postventa"))
DESCRIPTIVE_CHAPTER = r"^[0-9]{2}\.[0-9]{2}\..+"   # 'NN.NN.<description>'

_REQ_KEYS = ["company_name", "project_no"]
_TEXT_KEYS = [*_REQ_KEYS, "company_id"]
_SEED = "R"      # row kinds in the tall union: request seed / source data
_DATA = "D"
# The one order of the tail. ``capitulo`` is the cleaned chapter, ``code`` its first five
# characters; ``raw`` is the chapter before cleaning where that differs, else NULL.
_ORDER = ["company_name", "project_no", "code", "company_id", "kind", "capitulo", "raw", "in_spine"]


def _zero() -> Column:
    return F.lit(0).cast(CENTS)


def prepare_requests(requests: DataFrame) -> DataFrame:
    """Request set with normalised join keys (lazy; one small row per project)."""
    return with_norm_keys(requests.select("company_name", "project_no", "company_id"))


def _until(*keys: str) -> list[str]:
    """The columns of the tail's order up to the last of ``keys``."""
    return _ORDER[:max(map(_ORDER.index, keys)) + 1]


def _whole(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _seeds(src: Sources, req: DataFrame) -> DataFrame:
    """Seed rows of kind R, one per overhead line: for each request, and for each
    matching overhead-percentage row, which alone has a percentage. They are summed
    together with the chapters, inside the same partitioning, so the percentages need
    no shuffle of their own."""
    ids = req.select(*_TEXT_KEYS)
    pcts = overhead_pct(src, req, with_id=True).select(*_TEXT_KEYS, *[c for _, c in OVERHEAD_LINES])
    s = ids.unionByName(pcts, allowMissingColumns=True)
    lines = F.array(*[F.struct(F.lit(label).alias("cap"), F.col(c).alias("pct")) for label, c in OVERHEAD_LINES])
    return s.select(*_TEXT_KEYS, F.lit(_SEED).alias("kind"), F.lit(False).alias("in_spine"), F.inline(lines))


def _tall(src: Sources, req: DataFrame, period: Period, with_seeds: bool = True, **options) -> DataFrame:
    """Source contributions (+ request seeds) with cleaned text keys,
    hash-partitioned by request and sorted: every later operator of the tail reuses that
    one partitioning and order. A lost executor re-runs its own map tasks only; nothing is
    materialised here."""
    data = packed_parts(src, req, period, **options).withColumn("kind", F.lit(_DATA))
    tall = data.unionByName(_seeds(src, req), allowMissingColumns=True) if with_seeds else data
    tall = tall.withColumns({k: clean_value(k) for k in _TEXT_KEYS} | {"capitulo": clean_chapter("cap")})
    tall = tall.withColumns({"code": F.substring("capitulo", 1, 5), "raw": F.when(F.col("cap") != F.col("capitulo"), F.col("cap"))})
    return tall.drop("cap").repartition(*_REQ_KEYS).sortWithinPartitions(*_ORDER)


def _grouped(tall: DataFrame) -> DataFrame:
    """Spine chapters (kind D, in_spine) with summed metrics, and two seed rows
    per request with its overhead fractions. The reference takes the first
    numeric percentage without an order; here the smallest (deterministic)."""
    keys = _until("raw")
    chapter = Window.partitionBy(*keys).orderBy("in_spine")
    whole = _whole(chapter)
    pct = [clamp_pct(F.min("pct").over(whole)).alias("pct")] if "pct" in tall.columns else []
    agg = tall.select(*keys, F.max("in_spine").over(whole).alias("in_spine"), *pct,
                      *[F.sum(f"{part}.{m}").over(whole).alias(m) for part, ms in PARTS.items() if part in tall.columns for m in ms],
                      F.row_number().over(chapter).alias("place"))
    return agg.where((F.col("place") == 1) & ((F.col("kind") == _SEED) | F.col("in_spine"))) \
        .withColumn("linea", F.coalesce("raw", "capitulo")).drop("place")


def _direct_metrics(with_prev: bool) -> dict[str, Column]:
    """The metrics of a spine chapter that aren't constant, rounded to cents. Certification
    metrics are NULL when the chapter's planning amounts are all NULL (they
    then drop out of the overhead base and become 0 in the output)."""
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    rows_o = F.coalesce(F.col("rows_o"), F.lit(0))
    rows_m = F.coalesce(F.col("rows_m"), F.lit(0))
    cert_o = F.when(rows_o == 0, F.lit(0)).when(F.col("n_o") == 0, F.lit(None)).otherwise(F.col("sum_o"))
    cert_m = F.when(rows_m == 0, F.lit(0)).when(F.col("n_m") == 0, F.lit(None)).otherwise(F.col("sum_m"))
    cert_prev = F.when(rows_o == 0, F.lit(0)).when(F.col("n_o") == 0, F.lit(None)) \
        .otherwise(F.col("sum_o") - z("sum_m"))
    m = {
        "coste_bc_a_origen": round_money(z("cbo")),
        "coste_bc_mes_actual": round_money(z("cbm")),
        "coste_bc_mes_anterior": round_money(z("cbo") - z("cbm")),
        "coste_qwark": round_money(z("qwk")),
        "coste_pendiente": round_money(z("pend")),
        "coste_total_a_origen": round_money(z("cbo") + z("pend")),
        "certificacion_a_origen": round_money(cert_o),
        "certificacion_mes_actual": round_money(cert_m),
        "certificacion_mes_anterior": round_money(cert_prev),
        "certificacion_pendiente": round_money(z("cpend")),
        "resto_produccion": round_money(z("resto")),
        "produccion_a_origen": round_money(cert_o + z("cpend") + z("resto")),
        "produccion_mes_anterior": round_money(cert_prev),
        "contratos": round_money(z("contr")),
        "planificado": round_money(z("plan")),
    }
    if with_prev:
        m.update(zip(PREVIOUS, (round_money(z("cpend_prev")), round_money(z("resto_prev")))))
    return {c: m[c].cast(CENTS) for c in NUM_COLS if c in m}


def _with_directs(grouped: DataFrame) -> DataFrame:
    is_d = F.col("kind") == _DATA
    return grouped.select(*_ORDER, "linea", "pct",
                          *[F.when(is_d, m).alias(c) for c, m in _direct_metrics("cpend_prev" in grouped.columns).items()])


def _metrics_of(rows: DataFrame) -> list[str]:
    return [c for c in NUM_COLS if c in rows.columns]


def _expand(rows: DataFrame) -> DataFrame:
    """Totals of the direct rows per request (window over the request
    partition), from which each seed becomes an overhead row. The overhead
    bases are sums of the rounded direct values with NULLs skipped."""
    metrics = _metrics_of(rows)
    w = Window.partitionBy(*_REQ_KEYS)
    is_d = F.col("kind") == _DATA
    tot = lambda c: F.coalesce(F.sum(F.when(is_d, F.col(c))).over(w), F.lit(0)).cast(CENTS)
    rows = rows.select(*rows.columns,
                       tot("produccion_a_origen").alias("t_po"),
                       tot("certificacion_mes_actual").alias("t_cm"),
                       tot("produccion_mes_anterior").alias("t_pp"))
    pct = F.coalesce(F.col("pct"), F.lit(0)).cast(PCT)
    ctao = round_money(pct * F.col("t_po")).cast(CENTS)
    over = {c: _zero() for c in metrics}
    over.update({
        "coste_bc_a_origen": ctao, "coste_total_a_origen": ctao,
        "coste_bc_mes_actual": round_money(pct * F.col("t_cm")).cast(CENTS),
        "coste_bc_mes_anterior": round_money(pct * F.col("t_pp")).cast(CENTS),
    })
    return rows.select(
        *_ORDER, F.when(is_d, F.lit(DIRECT)).otherwise(F.lit(OVERHEAD)).alias("grupo"),
        "linea", F.lit(DETAIL).alias("nivel"),
        *[F.when(is_d, F.col(c)).otherwise(over[c]).alias(c) for c in metrics],
        "t_po", "t_cm", "t_pp")


def unify_chapters(rows: DataFrame, metrics: list[str]) -> DataFrame:
    """Map a bare 'NN.NN' code onto the first 'NN.NN.<description>' chapter of the same
    request (first in the summary's chapter order, i.e. the smallest raw chapter) and sum the
    metrics by the cleaned chapter. Within a request and code at most one group of rows joins
    several chapters: the bare code and that first description. Its sums, and those of each
    other chapter, are windows in the order of the tail, whose first rows are kept."""
    descr = F.col("capitulo").rlike(DESCRIPTIVE_CHAPTER)
    first = F.min_by(F.when(descr, F.col("capitulo")), F.when(descr, F.col("linea"))).over(Window.partitionBy(*_until("code")))
    rows = rows.withColumn("first", first)
    joined = F.col("first").isNotNull() & ((F.length("capitulo") == 5) | (F.col("capitulo") == F.col("first")))
    rows = rows.withColumn("joined", joined)
    code = Window.partitionBy(*_until("kind")).orderBy("capitulo", "raw")
    chapter = Window.partitionBy(*_until("capitulo")).orderBy("raw")
    so_far = F.count(F.when(F.col("joined"), F.lit(1))).over(code.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.select(
        *_TEXT_KEYS, "grupo", clean_value(F.when(F.col("joined"), F.col("first")).otherwise(F.col("capitulo"))).alias("capitulo"), "nivel",
        *[F.when(F.col("joined"), F.sum(F.when(F.col("joined"), F.col(c))).over(_whole(code)))
          .otherwise(F.sum(c).over(_whole(chapter))).alias(c) for c in metrics],
        F.when(F.col("joined"), so_far).otherwise(F.row_number().over(chapter)).alias("place"),
    ).where("place = 1").drop("place")


def transform_frame(src: Sources, requests: DataFrame, period: Period, **options) -> DataFrame:
    """Rows before the load step: directs and overheads with ``linea``, NULL
    metrics kept, plus the per-request totals (``t_*``)."""
    req = prepare_requests(requests)
    return _expand(_with_directs(_grouped(_tall(src, req, period, **options))))


def resumen(src: Sources, requests: DataFrame, period: Period, as_double: bool = True,
            with_prev_month: bool = False, with_end_date: bool = False,
            normalize_all_chapters: bool = False, ordered: bool = False, restrict: bool = False,
            rollup=None) -> DataFrame:
    """Summary rows (28 columns) for every request and the given month.

    Options (off by default, as in the reference): ``with_prev_month``
    feeds the previous month's production into the '*_mes_anterior' columns
    and the spine; ``with_end_date`` limits contract / planned amounts to
    tasks ended by the cut; ``ordered`` sorts the rows as a report;
    ``normalize_all_chapters`` keeps the ledger, production and planning
    amounts of NULL / untrimmed chapters (the reference loses them).
    ``restrict`` cuts the sources to the requests before aggregating, which
    pays for few requests and changes no row. ``rollup`` (a ``plans.rollup.Rollup``)
    takes the sums to date from the last balances and reads only the entries since; it
    changes no row either."""
    balances = None
    if rollup is not None:
        from costlens.plans.rollup import BALANCES, to_date
        balances = {of.name: to_date(requests.sparkSession, src, of, period, rollup) for of in BALANCES}
    rows = transform_frame(src, requests, period, with_prev_month=with_prev_month, with_end_date=with_end_date,
                           normalize_all_chapters=normalize_all_chapters, restrict=restrict, balances=balances)
    metrics = [c for c in _metrics_of(rows) if c != "produccion_a_origen"]
    rows = rows.select(*_ORDER, "grupo", "linea", "nivel",
                       *[F.coalesce(F.col(c), _zero()).alias(c) for c in metrics])
    out = unify_chapters(rows, metrics)
    # produccion_a_origen is recomputed from its three components after the
    # unification
    made = {c: _zero() for c in NUM_COLS if c not in metrics}
    made["produccion_a_origen"] = F.col("certificacion_a_origen") + F.col("certificacion_pendiente") \
        + F.col("resto_produccion")
    made["period_date"] = F.lit(period.cut).cast("date")
    out = out.withColumns(made)
    if as_double:
        out = out.select(*[F.col(c).cast("double").alias(c) if c in NUM_COLS else F.col(c) for c in OUT_COLS])
    else:
        out = out.select(*OUT_COLS)
    if ordered:
        # report order of the reference's load: by its grouping keys
        # (directs before overheads, chapters in code-point order)
        out = out.orderBy(*[F.col(c).asc_nulls_last() for c in
                            ("company_id", "company_name", "project_no", "grupo", "capitulo", "nivel")])
    return out


def chapter_spine(src: Sources, requests: DataFrame, period: Period) -> DataFrame:
    """Distinct normalised chapters of each request (planning lines excluded)."""
    req = prepare_requests(requests)
    g = _grouped(_tall(src, req, period, with_seeds=False))
    return g.select("company_name", "project_no", F.col("linea").alias("capitulo"))


def transform_rows(src: Sources, requests: DataFrame, period: Period, which: str = "all") -> DataFrame:
    """Rows before the load step (chapter in ``linea``, NULL metrics -> 0):
    ``which`` = 'direct', 'overhead' or 'all'."""
    rows = transform_frame(src, requests, period)
    if which == "direct":
        rows = rows.where(F.col("kind") == _DATA)
    elif which == "overhead":
        rows = rows.where(F.col("kind") == _SEED)
    have = _metrics_of(rows)
    value = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double") if c in have else F.lit(0.0)
    return rows.select(*_REQ_KEYS, "grupo", "linea", "nivel", *[value(c).alias(c) for c in NUM_COLS])


def direct_totals(src: Sources, requests: DataFrame, period: Period) -> DataFrame:
    """Per request: the three overhead bases (sums of rounded direct values)."""
    rows = transform_frame(src, requests, period).where(F.col("kind") == _SEED) \
        .where(F.col("linea") == OVERHEAD_LINES[0][0])
    return rows.select(*_REQ_KEYS, F.col("t_po").cast("double").alias("total_produccion_a_origen"),
                       F.col("t_cm").cast("double").alias("total_certificacion_mes_actual"),
                       F.col("t_pp").cast("double").alias("total_produccion_mes_anterior"))
