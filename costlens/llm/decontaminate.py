"""Benchmark decontamination by pigeonhole edit matching (operator 3).

Method. Texts are compared as letter streams (lower-cased letters, anything else
as one space). A test item of n characters may differ from a passage by
k = floor(error_rate * n) edits; it is split into k + 1 pieces, of which at least
one occurs unchanged in any such passage. Exact piece hits are found in one pass
over each document, and each hit's surroundings are verified with Myers'
bit-parallel edit distance, many candidates at a time.

Short items, of fewer than ``least_chars`` letters, say little once digits and signs are gone:
they have no error budget and are sought as whole words in streams of letters and
digits, as one piece.

Items are a query set: they are handled in blocks of bounded size (``BLOCK_CHARS``). A
block is a job of its own that sends the block to all tasks, reads the documents once
and adds its hits to a written table; no task or driver holds two blocks. Documents are
told apart by row numbers and never shuffled for the search.

Defined results: null and empty texts, of items or documents, match nothing, nor do
items without a letter or digit; items that repeat an item_id or a text are separate
items, and a document lists each item_id once; an item with a null item_id is sought too: it
contaminates, and isn't listed; a document shorter than the item can't hold it beyond
its k edits. Rows that repeat a doc_id get a row each. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm import textbytes as tb
from costlens.llm.staging import numbered
from costlens.session import scratch_path

#: Characters of the items that are sent with a job at once.
BLOCK_CHARS = 4 << 20
#: Candidates verified together, and characters of their surroundings (both bound memory).
TOGETHER, CELLS = 4096, 1 << 21
#: Letters of an item that may have errors, at least.
LEAST_CHARS = 40


@dataclass
class Items:
    """A block of items: their streams, one after the other, and their pieces."""

    item_id: list
    points: np.ndarray
    bounds: np.ndarray  # of the streams; without the outer spaces, but for exact items
    errors: np.ndarray  # k of each item
    piece_item: np.ndarray
    piece_start: np.ndarray  # in the item
    piece_end: np.ndarray
    digits: bool


def _split(found: list[tuple], error_rate: float, digits: bool) -> Items | None:
    """The pieces of (item_id, stream)."""
    if not found:
        return None
    errors = [int(error_rate * len(points)) for _, points in found]
    pieces = []
    for i, ((_, points), k) in enumerate(zip(found, errors, strict=True)):
        cut = np.linspace(0, len(points), k + 2).astype(np.int64)
        pieces += [(i, a, b) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    piece = np.array(pieces, np.int64)
    bounds = np.cumsum([0, *(len(points) for _, points in found)])
    return Items([x for x, _ in found], np.concatenate([p for _, p in found]), bounds, np.array(errors, np.int64), piece[:, 0], piece[:, 1], piece[:, 2], digits)


def prepare(rows: list[tuple], error_rate: float, least_chars: int = LEAST_CHARS) -> list[Items]:
    """Items (item_id, text) split into pieces: those with an error budget, and the short ones,
    whole words with the spaces around them."""
    edited, exact = [], []
    for item_id, text in rows:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        points, _ = tb.letter_stream(raw, np.array([0, len(raw)]))
        if len(points) - 2 >= max(least_chars, 1) and (points != 32).any():
            edited.append((item_id, points[1:-1]))
            continue
        points, _ = tb.letter_stream(raw, np.array([0, len(raw)]), digits=True)
        if (points != 32).any():
            exact.append((item_id, points))
    return [x for x in (_split(edited, error_rate, False), _split(exact, 0.0, True)) if x is not None]


def myers(pattern: np.ndarray, lengths: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each row: the least edit distance of pattern[row, :lengths[row]] to a substring of
    windows[row]. Both padded with codes that match nothing (pattern 0, windows 1). All rows
    advance together; a pattern takes ceil(longest / 64) machine words."""
    rows, longest = pattern.shape
    blocks = -(-longest // 64)
    one, full = np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF)
    plus = np.full((blocks, rows), full)
    minus = np.zeros((blocks, rows), np.uint64)
    last_block, last_bit = (lengths - 1) // 64, ((lengths - 1) % 64).astype(np.uint64)
    # match masks: for each row, the sorted distinct codes of the pattern get a mask per block
    order = np.argsort(pattern, axis=1, kind="stable")
    ranked = np.take_along_axis(pattern, order, 1)
    fresh = np.ones_like(ranked, bool)
    fresh[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
    code_at = np.cumsum(fresh, axis=1) - 1
    width = int(code_at.max()) + 1
    masks = np.zeros((rows, width, blocks), np.uint64)
    r = np.repeat(np.arange(rows), longest)
    np.bitwise_or.at(masks, (r, code_at.ravel(), order.ravel() // 64), one << (order.ravel() % 64).astype(np.uint64))
    masks[np.arange(rows), code_at[:, 0], :] *= (ranked[:, 0] != 0)[:, None].astype(np.uint64)  # the padding
    codes = np.full((rows, width), np.uint32(0xFFFFFFFF))
    codes[np.repeat(np.arange(rows), longest)[fresh.ravel()], code_at.ravel()[fresh.ravel()]] = ranked.ravel()[fresh.ravel()]
    # look all window characters up at once: row-wise keys in one sorted array
    base = (np.arange(rows, dtype=np.uint64) << np.uint64(32))[:, None]
    keys = (base | codes.astype(np.uint64)).ravel()
    sought = (base | windows.astype(np.uint64)).ravel()
    found = np.searchsorted(keys, sought)
    found = np.minimum(found, len(keys) - 1)
    found = np.where(keys[found] == sought, found, -1).reshape(windows.shape)
    flat = np.concatenate((masks.reshape(rows * width, blocks), np.zeros((1, blocks), np.uint64)))
    score = lengths.astype(np.int64).copy()
    best = score.copy()
    for j in range(windows.shape[1]):
        eq_all = flat[found[:, j]]
        carry_p = np.zeros(rows, np.uint64)  # horizontal delta into the block: +1
        carry_m = np.zeros(rows, np.uint64)  # -1
        for b in range(blocks):
            p, m, eq = plus[b], minus[b], eq_all[:, b]
            xv = eq | m
            eq = eq | carry_m
            xh = (((eq & p) + p) ^ p) | eq
            hp = m | ~(xh | p)
            hm = p & xh
            here = last_block == b
            if here.any():
                score = score + np.where(here, ((hp >> last_bit) & one).astype(np.int64) - ((hm >> last_bit) & one).astype(np.int64), 0)
            out_p, out_m = hp >> np.uint64(63), hm >> np.uint64(63)
            hp = (hp << one) | carry_p
            hm = (hm << one) | carry_m
            plus[b] = hm | ~(xv | hp)
            minus[b] = hp & xv
            carry_p, carry_m = out_p, out_m
        best = np.minimum(best, score)
    return best


def _padded(points: np.ndarray, start: np.ndarray, end: np.ndarray, code: int) -> np.ndarray:
    size = end - start
    out = np.full((len(start), int(size.max(initial=1))), np.uint32(code))
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(np.arange(len(start)), size), at] = points[np.repeat(start, size) + at]
    return out


class Matcher:
    """Finds the items of a block in letter streams."""

    def __init__(self, items: Items):
        self.items = items
        length = items.piece_end - items.piece_start
        absolute = items.bounds[items.piece_item] + items.piece_start
        self.probes = []  # by the length of the pieces' first characters that are looked up
        for width in sorted({int(min(w, 16)) for w in length}):
            mine = np.flatnonzero(np.minimum(length, 16) == width)
            hashes = tb.gram_hashes(items.points, width)[absolute[mine]]
            order = np.argsort(hashes, kind="stable")
            mine, hashes = mine[order], hashes[order]
            self.probes.append((width, tb.Lookup(np.unique(hashes)), hashes, mine))

    def pieces(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, piece) of all exact piece occurrences."""
        items, ats, found = self.items, [], []
        for width, lookup, hashes, mine in self.probes:
            at, index = lookup.find(tb.gram_hashes(points, width))
            lo = np.searchsorted(hashes, lookup.hashes[index], "left")
            n = np.searchsorted(hashes, lookup.hashes[index], "right") - lo
            at = np.repeat(at, n)
            piece = mine[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
            size = items.piece_end[piece] - items.piece_start[piece]
            fits = at + size <= len(points)
            at, piece, size = at[fits], piece[fits], size[fits]
            source = items.bounds[items.piece_item[piece]] + items.piece_start[piece]
            same = np.ones(len(at), bool)
            for i in range(int(size.max(initial=0))):
                live = same & (i < size)
                same[live] = points[at[live] + i] == items.points[source[live] + i]
            ats.append(at[same])
            found.append(piece[same])
        return np.concatenate(ats), np.concatenate(found)

    def find(self, points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, distance) of the items found within their error budget."""
        items = self.items
        at, piece = self.pieces(points)
        text = np.searchsorted(bounds, at, side="right") - 1
        inside = at + items.piece_end[piece] - items.piece_start[piece] <= bounds[text + 1]
        at, piece, text = at[inside], piece[inside], text[inside]
        item = items.piece_item[piece]
        # hits of one passage lie within the budget of one diagonal: verify once per strip
        k = items.errors[item]
        start = at - items.piece_start[piece]
        strip = np.floor_divide(start - bounds[text], 2 * k + 1)
        order = np.lexsort((strip, item, text))
        text, item, strip = text[order], item[order], strip[order]
        keep = np.ones(len(text), bool)
        keep[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (strip[1:] != strip[:-1])
        text, item, strip = text[keep], item[keep], strip[keep]
        k, n = items.errors[item], np.diff(items.bounds)[item]
        first = bounds[text] + strip * (2 * k + 1) - k
        end = np.minimum(bounds[text] + (strip + 1) * (2 * k + 1) + n + k, bounds[text + 1])
        first = np.maximum(first, bounds[text])
        distance = np.empty(len(text), np.int64)
        order = np.argsort(n, kind="stable")
        longest = np.maximum.accumulate((end - first)[order])  # a group's arrays are as wide as its longest
        i = 0
        while i < len(order):
            j = min(i + TOGETHER, len(order))
            j = i + max(1, int(np.searchsorted(np.arange(1, j - i + 1) * longest[i:j], CELLS, side="right")))
            some = order[i:j]
            i = j
            b = items.bounds[item[some]]
            distance[some] = myers(_padded(items.points, b, b + n[some], 0), n[some], _padded(points, first[some], end[some], 1))
        hit = distance <= k
        text, item, distance = text[hit], item[hit], distance[hit]
        order = np.lexsort((distance, item, text))
        text, item, distance = text[order], item[order], distance[order]
        keep = np.ones(len(text), bool)
        keep[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1])
        return text[keep], item[keep], distance[keep]


def _hits(blocks: list[Items]) -> Callable:
    """(row, text) to (row, item_id, distance) of the items found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matchers = [Matcher(x) for x in blocks]
        for batch in batches:
            rows = batch.column(0).to_numpy()
            offsets, data = tb.buffers(batch.column(1))
            for i, j in tb.slices(offsets):
                for matcher in matchers:
                    points, bounds = tb.letter_stream(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], matcher.items.digits)
                    text, item, distance = matcher.find(points, bounds)
                    ids = pa.array([matcher.items.item_id[x] for x in item.tolist()], pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(rows[i + text]), ids, pa.array(distance)], ["row", "item_id", "distance"])

    return run


_HIT = "row long, item_id long, distance long"


def hits(rows: DataFrame, benchmark: DataFrame, error_rate: float = 0.06, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(row, item_id, distance) of each item of ``benchmark`` (item_id, text) that occurs in the text of
    ``rows`` (row, text), in a written table."""
    spark = rows.sparkSession
    asked = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    blocks = 1 + (asked.agg(F.sum(F.length("text"))).first()[0] or 0) // BLOCK_CHARS
    path = scratch_path(spark, "llm-hits")
    spark.createDataFrame([], _HIT).write.parquet(path)
    for i in range(blocks):
        some = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i).orderBy("item_id", "text").collect()
        items = prepare([tuple(r) for r in some], error_rate, least_chars)
        if items:
            rows.select("row", "text").mapInArrow(_hits(items), _HIT).write.mode("append").parquet(path)
    return spark.read.schema(_HIT).parquet(path)


def without_items(docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.06, least_chars: int = LEAST_CHARS) -> DataFrame:
    """The rows of ``docs`` that ``decontaminate`` doesn't find contaminated, whole. Each row
    is judged by its own text, so null and repeated doc_ids are told apart."""
    rows = numbered(docs.withColumn("text", F.col("text").cast("string")))
    found = hits(rows.select(F.col("__row").alias("row"), "text"), benchmark, error_rate, least_chars)
    bad = found.select(F.col("row").alias("__row")).distinct()
    return rows.join(bad, "__row", "left_anti").select(*docs.columns)


def decontaminate(docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.06, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc_id, contaminated, item_ids, least_distance) of every row of ``docs``: the
    items of ``benchmark`` (item_id, text) that occur in the text within ``error_rate``
    edits a character, ascending, and the least edit distance (null without any)."""
    rows = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), "row")
    found = hits(rows, benchmark, error_rate, least_chars)
    found = found.groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.min("distance").alias("least_distance"))
    none = F.array().cast("array<long>")
    return rows.select("row", "doc_id").join(found, "row", "left").select(
        "doc_id",
        F.col("least_distance").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", none).alias("item_ids"),
        "least_distance",
    )
