"""Near-duplicate documents by bottom-k sketches (operator 2).

Method. One hash function orders all word shingles; a document's sketch is the
``k`` smallest hashes of its shingle set. Inverted lists of the retained values
generate the overlaps, an estimate over the sketch of the union filters them,
and the exact Jaccard similarity of the full sets confirms each link.

Rows are told apart by numbers, not by doc_id, so a repeated id multiplies nothing.
Documents with equal sets form a class first, so copies cost one row each.
Between classes:

* a value retained by at most ``rare_df`` classes is *rare*: all pairs of its
  list are candidates, at most ``rare_df / 2`` a row, whatever the data;
* a longer list is never expanded. A linked pair without a rare value in common
  has few rare values at all (each is a value the other lacks, and the binomial
  tail bounds those at ``FAIL``). Such *dense* classes meet in the lists of their
  smallest retained values, again enough of them for ``FAIL``: every member is
  first compared with its list's leader, which joins a group of near copies in
  linear work; only lists that still hold several components are compared
  further, in blocks of bounded size that give back the links between components.

So no list is cut and no candidate is dropped by a cap; the one source of error
is the sketch itself, below ``FAIL`` for a pair at the threshold.

Defined results: null or empty texts and texts without words have no shingles,
``n_shingles`` 0, and link with nothing; texts with fewer than ``width`` words
have one shingle, the whole sequence; rows that repeat a doc_id are one node and
each get a row; a null doc_id gets a null component and is kept. Columns other
than doc_id and text aren't read. Similarity is compared in integers:
``100 * intersection >= percent * union``. Shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil, comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm import textbytes as tb
from costlens.llm.components import components
from costlens.llm.staging import numbered, staged

#: Bound on the probability that a pair at the threshold is missed by one step.
FAIL = 1e-8
#: Shingles of one side of a block comparison (8 bytes each).
BLOCK_SHINGLES = 200_000

_SKETCH = "doc_id long, n_shingles long, h1 long, h2 long, sketch array<long>"


def misses(k: int, percent: int) -> int:
    """The most of ``k`` retained values that a linked pair fails to share, but for ``FAIL``."""
    p = 1 - percent / 100
    tail, m = 1.0, -1
    while tail > FAIL and m < k:
        m += 1
        tail -= comb(k, m) * p**m * (1 - p) ** (k - m)
    return m


def lists_needed(percent: int) -> int:
    """Smallest retained values of the union of which at least one is shared, but for ``FAIL``."""
    return ceil(log(FAIL) / log(1 - percent / 100)) if percent < 100 else 1


def _digest(values: np.ndarray) -> tuple[int, int]:
    """128 bits of a sorted set, as two signed longs."""
    if not len(values):
        return 0, 0
    at = np.arange(1, len(values) + 1, dtype=np.uint64)
    one = np.bitwise_xor.reduce(tb.mix64(values + at * np.uint64(0x9E3779B97F4A7C15)))
    two = np.add.reduce(tb.mix64(values ^ tb.mix64(at + np.uint64(len(values)))))
    return tuple(int(x) for x in np.array([one, two], np.uint64).view(np.int64))


def _sketches(width: int, k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, n, bounds, values in tb.shingle_sets(batch.column(1), width):
                size = np.diff(bounds)
                digest = np.array([_digest(values[bounds[i] : bounds[i + 1]]) for i in range(n)], np.int64).reshape(n, 2)
                kept = np.minimum(size, k)
                off = np.concatenate(([0], np.cumsum(kept)))
                at = np.arange(off[-1]) - np.repeat(off[:-1], kept) + np.repeat(bounds[:-1], kept)
                sketch = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(values[at].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, n), pa.array(size, pa.int64()), pa.array(digest[:, 0]), pa.array(digest[:, 1]), sketch],
                    ["doc_id", "n_shingles", "h1", "h2", "sketch"],
                )

    return run


def sketches(docs: DataFrame, width: int = 5, k: int = 64) -> DataFrame:
    """(doc_id, n_shingles, h1, h2, sketch) of each row: the size and a 128-bit digest of
    its shingle set and the set's ``k`` smallest hashes."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_sketches(width, k), _SKETCH)


def _compare(width: int, percent: int) -> Callable:
    """Rows (a, a_h, b, b_h, a_text, b_text) to the links (a, b) among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[int, tuple] = {}  # a leader's rows follow each other: its set is made once
        for batch in batches:
            side_b = {}
            for first, n, bounds, values in tb.shingle_sets(batch.column(5), width):
                for i in range(n):
                    side_b[first + i] = values[bounds[i] : bounds[i + 1]]
            links = []
            for i, (a, a_h, b, b_h, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True)):
                if a not in last or last[a][0] != text:
                    _, _, bounds, values = next(tb.shingle_sets(pa.array([text], pa.string()), width))
                    last = {a: (text, values, _digest(values)[0])}
                _, left, digest = last[a]
                right = side_b[i]
                if digest != a_h or _digest(right)[0] != b_h:
                    continue  # another row with this doc_id
                both = len(np.intersect1d(left, right, assume_unique=True))
                if 100 * both >= percent * (len(left) + len(right) - both):
                    links.append((a, b))
            cols = list(zip(*links, strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b"])

    return run


def _block_links(width: int, percent: int) -> Callable:
    """Links between different components of a block's documents; a spanning set of them."""

    def run(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        ids, comp = block["id"].to_numpy(), block["comp"].to_numpy()
        texts = block["text"].combine_chunks()
        sets = []
        for _, n, bounds, values in tb.shingle_sets(texts, width):
            sets += [values[bounds[i] : bounds[i + 1]] for i in range(n)]
        good = [i for i, h in enumerate(block["h1"].to_pylist()) if _digest(sets[i])[0] == h]
        size = np.array([len(s) for s in sets], np.int64)
        value = np.concatenate([sets[i] for i in good]) if good else np.zeros(0, np.uint64)
        owner = np.repeat(np.array(good, np.int64), size[good]) if good else np.zeros(0, np.int64)
        order = np.argsort(value, kind="stable")
        value, owner = value[order], owner[order]
        group = {int(c): int(c) for c in set(comp.tolist())}

        def root(c: int) -> int:
            while group[c] != c:
                group[c] = group[group[c]]
                c = group[c]
            return c

        kinds, counts = np.unique(comp[good], return_counts=True) if good else (np.zeros(0), np.zeros(0))
        most = kinds[np.argmax(counts)] if len(kinds) else None
        links = []
        for i in (i for i in good if comp[i] != most):  # each pair of components has a side outside the largest
            lo, hi = np.searchsorted(value, sets[i], "left"), np.searchsorted(value, sets[i], "right")
            n = hi - lo
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            both = np.bincount(owner[at], minlength=len(sets))
            for j in np.flatnonzero((both > 0) & (100 * both >= percent * (size[i] + size - both))):
                x, y = root(int(comp[i])), root(int(comp[j]))
                if x != y:
                    group[max(x, y)] = min(x, y)
                    links.append((int(ids[i]), int(ids[j])))
        cols = list(zip(*links, strict=True)) or [(), ()]
        return pa.table({"a": pa.array(cols[0], pa.int64()), "b": pa.array(cols[1], pa.int64())})

    return run


def _estimate(x, y, n_x, n_y, k: int, percent: int):
    """True unless the sketch of the union rules the pair out."""
    union = F.slice(F.array_sort(F.transform(F.array_union(x, y), _flip)), 1, k)
    shared = F.size(F.array_intersect(union, F.transform(F.array_intersect(x, y), _flip)))
    whole = (n_x <= k) & (n_y <= k)
    exact = F.size(F.array_intersect(x, y))
    return F.when(whole, 100 * exact >= percent * (n_x + n_y - exact)).otherwise(shared >= F.size(union) - misses(k, percent))


def _flip(v):
    """Signed order of the result = unsigned order of the hash."""
    return v.bitwiseXOR(F.lit(-(1 << 63)))


def _confirm(pairs: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int, k: int) -> DataFrame:
    """The links (a, b) among candidate pairs: union-sketch estimate, then full sets."""
    one = classes.select(F.col("id").alias("a"), F.col("h1").alias("a_h"), F.col("n").alias("a_n"), F.col("sketch").alias("a_s"))
    two = classes.select(F.col("id").alias("b"), F.col("h1").alias("b_h"), F.col("n").alias("b_n"), F.col("sketch").alias("b_s"))
    likely = (
        pairs.join(two, "b")
        .join(one, "a")
        .where((100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")) & _estimate(F.col("a_s"), F.col("b_s"), F.col("a_n"), F.col("b_n"), k, percent))
        .select("a", "a_h", "b", "b_h")
    )
    likely = staged(likely, "likely")
    rows = (
        likely.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("b_text")), "b")
        .join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("a_text")), "a")
        .select("a", "a_h", "b", "b_h", "a_text", "b_text")
    )
    return rows.mapInArrow(_compare(width, percent), "a long, b long").distinct()


def near_rows(rows: DataFrame, width: int = 5, percent: int = 85, k: int = 64, rare_df: int = 32) -> DataFrame:
    """(row, n_shingles, component): for each of ``rows`` (row, text), whose numbers are distinct, the
    smallest row reachable over links. Rows link whose sets of ``width``-word shingles have
    ``100 * intersection >= percent * union``; ``percent`` from 50 to 100."""
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    texts = rows.select(F.col("row").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = staged(sketches(texts, width, k), "sketches")
    slim = rows.select("doc_id", "n_shingles", "h1", "h2")
    sets = slim.where("n_shingles > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("id"))
    own = rows.where("n_shingles > 0").withColumnRenamed("doc_id", "id")
    classes = own.join(sets, ["h1", "h2", "id"], "left_semi").select("id", "h1", F.col("n_shingles").alias("n"), "sketch")
    classes = staged(classes.dropDuplicates(["id", "h1"]), "classes")

    # inverted lists of the retained values
    postings = classes.select("id", "n", F.explode("sketch").alias("v"))
    lists = staged(postings.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "lists")
    shared = staged(postings.join(lists, "v"), "postings")
    common = shared.where(F.col("df") > rare_df).groupBy("id").agg(F.count(F.lit(1)).alias("common"))

    # rare values: every pair of the list; the overlap so far bounds the estimate
    rare = shared.where(F.col("df") <= rare_df)
    pairs = (
        rare.select("v", F.col("id").alias("a"), F.col("n").alias("a_n"))
        .join(rare.select("v", F.col("id").alias("b"), F.col("n").alias("b_n")), "v")
        .where((F.col("a") < F.col("b")) & (100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")))
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("overlap"), F.first("a_n").alias("a_n"), F.first("b_n").alias("b_n"))
        .join(common.select(F.col("id").alias("a"), F.col("common").alias("a_c")), "a", "left")
        .join(common.select(F.col("id").alias("b"), F.col("common").alias("b_c")), "b", "left")
    )
    most = F.col("overlap") + F.coalesce(F.least(F.coalesce("a_c", F.lit(0)), F.coalesce("b_c", F.lit(0))), F.lit(0))
    least = F.greatest(
        F.lit(1), F.when(F.greatest("a_n", "b_n") > k, F.least(F.lit(k), F.least("a_n", "b_n")) - misses(k, percent)).otherwise(F.ceil((F.col("a_n") + F.col("b_n")) * percent / (100.0 + percent) - 1e-9))
    )
    links = staged(_confirm(pairs.where(most >= least).select("a", "b"), classes, texts, width, percent, k), "rare-links")

    # dense classes: nearly all they retain is common
    held = F.size("sketch")
    # (a partner of a set just below k may be above it, and then not retain all that both have)
    spare = F.when(100 * F.col("n") > percent * k, F.lit(misses(k, percent))).otherwise(F.floor((100 - percent) * F.col("n") / F.lit(float(percent)) + 1e-9))
    dense = classes.join(common, "id").where(held - F.col("common") <= spare)
    smallest = F.slice("sketch", 1, lists_needed(percent))  # ascending
    entries = staged(dense.select("id", "n", "h1", F.explode(smallest).alias("v")), "dense")
    leaders = entries.groupBy("v").agg(F.min("id").alias("a"))
    led = entries.join(leaders, "v").where("id > a").groupBy(F.col("id").alias("b")).agg(F.min("a").alias("a"))
    links = links.unionByName(staged(_confirm(led.select("a", "b"), classes, texts, width, percent, k), "leader-links"))
    comps = staged(components(links), "components")

    # lists that still hold several components: blocks against blocks
    named = entries.join(comps, "id", "left").select("id", "n", "h1", "v", F.coalesce("component_id", "id").alias("comp"))
    named = staged(named, "dense-named")
    open_lists = named.groupBy("v").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.sum("n").alias("total")).where("lo <> hi")
    open_lists = open_lists.select("v", F.ceil(F.col("total") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    cells = named.join(open_lists, "v").select("id", "h1", "comp", "v", mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = cells.select("id", "h1", "comp", "v", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    blocks = cells.join(texts.select(F.col("doc_id").alias("id"), "text"), "id")
    found = blocks.groupBy("v", "i", "j").applyInArrow(_block_links(width, percent), "a long, b long").distinct()
    links = staged(found.unionByName(comps.select(F.col("id").alias("a"), F.col("component_id").alias("b"))), "all-links")
    comps = components(links)

    members = slim.join(sets, ["h1", "h2"], "left").select("doc_id", "n_shingles", F.coalesce("id", "doc_id").alias("id"))
    out = members.join(comps.withColumnRenamed("component_id", "c"), "id", "left")
    return out.select(F.col("doc_id").alias("row"), "n_shingles", F.coalesce("c", "id").alias("component"))


def near_dedup(docs: DataFrame, width: int = 5, percent: int = 85, k: int = 64, rare_df: int = 32) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of ``docs`` (doc_id, text).

    Rows link as in ``near_rows``; ``component_id`` is the smallest doc_id reachable over links,
    ``kept`` is true where it is the row's own.
    """
    rows = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), "row")
    # rows without an id are counted, but link nothing
    named = near_rows(rows.where("doc_id is not null"), width, percent, k, rare_df).join(rows.select("row", "doc_id"), "row")
    named = staged(named, "near-rows")
    # rows that repeat a doc_id are one node: their components are one
    twice = named.groupBy("doc_id").agg(F.min("component").alias("a"), F.max("component").alias("hi")).where("a <> hi")
    joined = named.join(twice.select("doc_id", "a"), "doc_id").select("a", F.col("component").alias("b"))
    same = components(joined).select(F.col("id").alias("component"), F.col("component_id").alias("whole"))
    named = named.join(same, "component", "left").withColumn("whole", F.coalesce("whole", "component"))
    least = named.groupBy("whole").agg(F.min("doc_id").alias("component_id"))
    out = named.join(least, "whole").select("doc_id", "n_shingles", "component_id")
    nameless = sketches(rows.where("doc_id is null").select("doc_id", "text"), width, 1)
    out = out.unionByName(nameless.select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
