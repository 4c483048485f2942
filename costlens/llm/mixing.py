"""Mixing sources to target weights by a time-varying curriculum (operator 8).

Method. Every source has a weight schedule over training time 0 to 1. Its integral
is the source's weight, which sets its target number of words; the source's
documents, in hash order and passed through as often as the target asks, make up
its cumulative token demand. Inverting the integrated schedule at a document's
place in that demand gives its training position, and the copies of all sources,
range-sorted by position, are the training order.

The share of the whole that is mixed is ``volume``; a target stops at ``most``
times its source's size, and the excess is shared out again by weight until no
target is above. A document is taken whole: the last pass takes those whose
middle lies before the target's end, so a source misses its target by at most
half a document. Texts are shuffled twice: once by row number, to meet their places, and
once, copies and all, in the final range-sort.

Defined results: a null source is a source of its own, after all others; a null
or empty text, or one without words, has size 0 and is taken 0 words, in as many
copies as its place asks; a source without words has target 0; rows that repeat a
doc_id are separate rows with a place each; with no words at all every target is
0. Rows with a null doc_id are placed like others. Columns of the input are kept
by ``training_order``, but for those named like its two own.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlens.llm.prefix import hash_of, with_running_total
from costlens.llm.staging import numbered, staged

#: Words.
WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Schedules that go with them: (time, relative weight) knots, linear between them.
#: The heaviest sources fade out, the lightest come in late, the middle holds on.
SCHEDULES = (
    ((0.0, 1.5), (0.5, 1.2), (1.0, 0.1)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.2), (0.6, 0.8), (1.0, 2.0)),
)


def integrated(knots: tuple) -> list[tuple[float, float, float, float, float, float]]:
    """Segments (t0, t1, w0, w1, from, to) of a schedule; from and to are the shares of
    its integral before and after the segment."""
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:], strict=False)]
    if min(areas, default=0) < 0 or sum(areas) <= 0 or any(w < 0 for _, w in knots):
        raise ValueError("a schedule needs rising times and weights that aren't negative, some positive")
    total, done, out = sum(areas), 0.0, []
    for (t0, w0), (t1, w1), area in zip(knots, knots[1:], areas, strict=False):
        out.append((t0, t1, w0 / total, w1 / total, done / total, (done + area) / total))
        done += area
    return out


def invert(knots: tuple, share: Column) -> Column:
    """The time at which the integral of the schedule reaches ``share`` (0 to 1) of its total."""
    time = None
    for t0, t1, w0, w1, lo, hi in reversed(integrated(knots)):
        slope, rest = (w1 - w0) / (t1 - t0), share - F.lit(lo)
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * rest, F.lit(0.0)))
        here = F.lit(t0) + F.when(rest <= 0, 0.0).otherwise(2 * rest / (F.lit(w0) + root))  # stable for any slope
        here = F.least(here, F.lit(t1))
        time = here if time is None else F.when(share < hi, here).otherwise(time)
    return time


def _times(knots: tuple) -> Column:
    """The training positions at the demands ``__starts``."""
    return F.transform("__starts", lambda q: invert(knots, F.least(q / F.col("target"), F.lit(1.0))))


def targets(sources: DataFrame, volume: float, most: float) -> DataFrame:
    """``sources`` (source_size, weight) with ``target``. Every round is one small
    aggregation; the driver holds four numbers."""
    sizes = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    total, level = volume * float(sizes[0] or 0), 0.0
    capped = (0, 0.0, float(sizes[1] or 0))
    while capped[2] > 0:
        level = (total - most * capped[1]) / capped[2]
        over = F.col("weight") * F.lit(level) >= F.lit(most) * F.col("source_size")
        row = sources.agg(F.count(F.when(over, 1)), F.sum(F.when(over, F.col("source_size"))), F.sum(F.when(~over, F.col("weight")))).first()
        now = (row[0], float(row[1] or 0), float(row[2] or 0))
        if now[0] == capped[0]:
            break
        capped = now
    return sources.withColumn("target", F.least(F.lit(most) * F.col("source_size"), F.col("weight") * F.lit(level)))


def _identity() -> list[Column]:
    """Null-free columns by which documents of equal hashes are ordered."""
    text, source = F.col("text").cast("string"), F.col("source").cast("string")
    doc_id = F.col("doc_id").cast("long")
    body = F.xxhash64(doc_id.isNull(), source.isNull(), F.coalesce(source, F.lit("")), text.isNull(), F.coalesce(text, F.lit("")))
    return [F.coalesce(doc_id, F.lit(-1).cast("long")).alias("__id"), body.alias("__body")]


def plan(docs: DataFrame, weights: tuple = WEIGHTS, schedules: tuple = SCHEDULES, volume: float = 1.5, most: float = 2.0, keep: tuple = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, positions) of every row of
    ``docs`` (doc_id, text, source): ``taken`` words in ``size(positions)`` copies; then the
    columns ``keep`` of ``docs``."""
    if len(weights) != len(schedules):
        raise ValueError("every weight needs a schedule")
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        # ids that repeat, or are null, are told apart by their texts: no id fills a bucket
        hash_of(F.concat_ws(":", F.col("doc_id").cast("long"), F.md5(text.cast("binary")))).alias("__hash"),
        *_identity(),
        *keep,
    )
    rows = rows.withColumn("__key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    rows = staged(rows, "mix-rows")
    sources = rows.groupBy("__key").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("__rows"), F.first("source").alias("__name"))
    place = F.row_number().over(Window.orderBy(F.col("__name").asc_nulls_last())) - 1  # one row per source
    sources = sources.withColumn("__class", F.pmod(place, F.lit(len(weights))))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("__class") + 1)
    sources = staged(sources.withColumn("weight", weight).drop("__name"), "mix-sources")
    sources = targets(sources, volume, most).drop("weight")
    rows = with_running_total(rows, sources, "__key", "size", ["doc_id", "size", "__body", *keep])
    # pass p holds the demand from p * source_size on; a copy counts while its middle is within the target
    pass_starts = F.transform(F.sequence(F.lit(0), F.lit(ceil(most))), lambda p: p * F.col("source_size") + F.col("__before"))
    starts = F.filter(pass_starts, lambda q: (q + F.col("size") / 2 < F.col("target")) & (q < F.col("target")))
    starts = F.slice(starts, 1, ceil(most))
    positions = None
    for i, knots in enumerate(schedules):
        mine = _times(knots)
        positions = mine if positions is None else F.when(F.col("__class") == i, mine).otherwise(positions)
    rows = rows.withColumn("__starts", starts)
    return rows.select("doc_id", "source", "size", "source_size", "target", (F.size("__starts") * F.col("size")).alias("taken"), positions.alias("positions"), *keep)


def training_order(docs: DataFrame, copy: str = "copy", position: str = "position", **options) -> DataFrame:
    """The copies that the mix takes, with all columns of ``docs`` and, named as asked, the
    copy's number (from 0) and position (0 to 1), range-sorted by position. Every row has
    places of its own."""
    keep = [F.col(c) for c in docs.columns if c not in (copy, position)]
    rows = numbered(docs)
    places = plan(rows, keep=("__row",), **options).where(F.size("positions") > 0).select("__row", F.col("positions").alias("__places"))
    rows = rows.join(places, "__row").select(*keep, F.posexplode("__places").alias(copy, position))
    return rows.orderBy(position)
