"""Sharding along a Hilbert curve (operator 4). DataFrame functions only.

Method. Several metadata dimensions are quantised to ``2 ** bits`` steps each, at
quantiles over all rows; the cells they make up are numbered along a Hilbert
curve; rows are sorted by cell number and the sorted run is cut into shards. A
shard's rows lie close together in every dimension, so a filter on any of them
skips most files.

The law is ``rows``: row counts of shards differ by one at most. The global rank
that this takes is made without a global sort: the cells, at most ``2 ** (bits *
dimensions)`` of them, are counted and summed up along the curve; a cell's rows are
ordered by a hash of doc_id in buckets of bounded size, so a cell that holds a
third of all rows is dealt over many tasks.

Defined results: nulls of a dimension are their own lowest step; rows equal in
all dimensions are ordered by a hash of doc_id, then doc_id, size and checksum,
so runs agree, and rows that repeat all of these are interchangeable; an empty
table gives no rows. Input columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlens.llm.prefix import hash_of, with_running_total
from costlens.llm.staging import staged

#: Steps of a dimension, as a power of two. With three dimensions 32768 cells.
BITS = 5
#: Cells at most; their table is broadcast.
MOST_CELLS = 1 << 16


def _numbers(docs: DataFrame, dims: dict[str, Column]) -> dict[str, Column]:
    """Each dimension as an order-keeping number: texts by six bytes after the longest
    prefix that all of them share."""
    texts = [n for n, c in dims.items() if isinstance(docs.select(c.alias(n)).schema[0].dataType, T.StringType)]
    ends = docs.agg(*[f(dims[n]).alias(f"{n}_{f.__name__}") for n in texts for f in (F.min, F.max)]).first() if texts else None
    out = {}
    for n, c in dims.items():
        if n in texts:
            lo, hi = ((ends[f"{n}_{x}"] or "").encode() for x in ("min", "max"))
            common = next((i for i, (x, y) in enumerate(zip(lo, hi, strict=False)) if x != y), min(len(lo), len(hi)))
            tail = F.rpad(F.hex(F.substring(c.cast("binary"), common + 1, 6)), 12, "0")
            out[n] = F.conv(tail, 16, 10).cast("double")
        else:
            out[n] = c.cast("double")
    return out


def _cuts_below(cuts: list[float], number: Column, lo: int = 0) -> Column:
    """How many of the sorted cuts lie below the number: a binary search of nested cases."""
    if not cuts:
        return F.lit(lo)
    mid = len(cuts) // 2
    return F.when(number > cuts[mid], _cuts_below(cuts[mid + 1 :], number, lo + mid + 1)).otherwise(_cuts_below(cuts[:mid], number, lo))


def _steps(rows: DataFrame, numbers: list[str], bits: int) -> dict[str, Column]:
    """Each number column as a step from 0 to 2 ** bits - 1, cut at approximate quantiles over all rows."""
    n = 1 << bits
    shares = [i / (n - 1) for i in range(1, n - 1)]
    row = rows.agg(*[F.percentile_approx(k, shares, 10_000).alias(k) for k in numbers]).first()
    out = {}
    for k in numbers:
        cuts = sorted({float(x) for x in row[k] or [] if x == x})
        below = _cuts_below(cuts, F.col(k))
        # few distinct values are spread over the whole axis, as many are
        spread = F.floor((below + 1) * F.lit(n / (len(cuts) + 2)))
        out[k] = F.when(F.col(k).isNull(), 0).otherwise(spread).cast("int")
    return out


def _along_curve(cells: DataFrame, names: list[str], bits: int) -> DataFrame:
    """``cells`` with ``__curve``, the index on the Hilbert curve: the coordinates are
    turned and mirrored level by level from the highest bit, Gray-coded, and interleaved."""
    x = [f"__x{i}" for i in range(len(names))]
    cells = cells.select("*", *[F.col(n).cast("long").alias(c) for n, c in zip(names, x, strict=True)])
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for c in x:
            on = F.col(c).bitwiseAND(F.lit(bit)) != 0
            if c == x[0]:
                cells = cells.withColumn(c, F.when(on, F.col(c).bitwiseXOR(F.lit(low))).otherwise(F.col(c)))
                continue
            swap = F.col(x[0]).bitwiseXOR(F.col(c)).bitwiseAND(F.lit(low))
            first = F.when(on, F.col(x[0]).bitwiseXOR(F.lit(low))).otherwise(F.col(x[0]).bitwiseXOR(swap))
            mine = F.when(on, F.col(c)).otherwise(F.col(c).bitwiseXOR(swap))
            cells = cells.withColumns({x[0]: first, c: mine})
    for a, b in zip(x, x[1:], strict=False):
        cells = cells.withColumn(b, F.col(b).bitwiseXOR(F.col(a)))
    turn = F.lit(0).cast("long")
    for level in range(bits - 1, 0, -1):
        on = F.col(x[-1]).bitwiseAND(F.lit(1 << level)) != 0
        turn = turn.bitwiseXOR(F.when(on, F.lit((1 << level) - 1)).otherwise(F.lit(0)).cast("long"))
    cells = cells.withColumn("__turn", turn)
    cells = cells.withColumns({c: F.col(c).bitwiseXOR(F.col("__turn")) for c in x})
    index = F.lit(0).cast("long")
    for level in range(bits - 1, -1, -1):
        for c in x:
            index = F.shiftleft(index, 1).bitwiseOR(F.shiftright(F.col(c), level).bitwiseAND(F.lit(1)))
    return cells.withColumn("__curve", index).drop(*x, "__turn")


def hilbert_shards(docs: DataFrame, dims: dict[str, Column], shards: int = 8, bits: int = BITS, drop: tuple = ()) -> DataFrame:
    """``docs`` with ``size`` (UTF-8 bytes of text plus 1), ``text_crc32``, ``law``, ``shard``
    (from 0), ``slot`` (from 0 in the shard, along the curve) and ``curve``.

    ``dims``: name to column, a number or a text, two at least. Columns in ``drop`` are
    left out before rows are shuffled."""
    if len(dims) < 2 or (1 << bits * len(dims)) > MOST_CELLS or shards < 1:
        raise ValueError("from two dimensions on, with 65536 cells at most, and one shard at least")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    made = {"size": F.octet_length(text).cast("long") + 1, "text_crc32": F.crc32(text.cast("binary")), "law": F.lit("rows")}
    names = [f"__s{i}" for i in range(len(dims))]
    numbers = dict(zip(names, _numbers(docs, dims).values(), strict=True))
    metadata = docs.select(*[c.alias(k) for k, c in numbers.items()])
    steps = _steps(metadata, names, bits)
    keep = [c for c in docs.columns if c not in (*made, "shard", "slot", "curve", *drop)]
    code = F.lit(0).cast("long")
    for c in steps.values():
        code = F.shiftleft(code, bits).bitwiseOR(c.cast("long"))
    rows = docs.select("*", *[c.alias(k) for k, c in numbers.items()]).select(*keep, *[c.alias(k) for k, c in made.items()], code.alias("__cell"))
    rows = rows.withColumn("__hash", hash_of(F.concat_ws(":", F.col("doc_id").cast("string"), "size", "text_crc32")))  # no id fills a bucket

    counts = metadata.groupBy(code.alias("__cell")).agg(F.count(F.lit(1)).alias("__rows"))
    low = F.lit((1 << bits) - 1)
    split = [F.shiftright(F.col("__cell"), bits * (len(dims) - 1 - i)).bitwiseAND(low).alias(n) for i, n in enumerate(names)]
    cells = _along_curve(counts.select("*", *split), names, bits).drop(*names)
    ahead = Window.orderBy("__curve").rowsBetween(Window.unboundedPreceding, -1)  # MOST_CELLS rows at most
    cells = cells.withColumn("__start", F.coalesce(F.sum("__rows").over(ahead), F.lit(0)))
    cells = staged(cells, "hilbert-cells")
    total = cells.agg(F.sum("__rows")).first()[0] or 0

    ranked = with_running_total(rows, F.broadcast(cells), "__cell", "size", ["doc_id", "size", "text_crc32"])
    rank = F.col("__start") + F.col("__rank")
    shard = F.expr(f"cast((__at * {shards}) div {max(total, 1)} as int)")
    first = F.expr(f"(shard * {max(total, 1)}L + {shards - 1}) div {shards}")
    out = ranked.withColumn("__at", rank).withColumn("shard", shard).withColumn("slot", F.col("__at") - first)
    return out.select(*keep, *made, "shard", "slot", F.col("__curve").alias("curve"))


def document_dims() -> dict[str, Column]:
    """The dimensions of ``documents``: language, source, and length on a log scale."""
    length = F.length(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return {"lang": F.col("lang"), "source": F.col("source"), "length": F.round(F.log2(length + 1), 2)}


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard, its rows in curve order."""
    sharded.repartitionByRange(F.col("shard"), F.col("slot")).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
