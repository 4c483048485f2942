"""Ranked lexical search over a length-stratified index (operator 11).

Scores. With N documents that hold a term, L terms in all and n in a document, the
document's normaliser is m = 75 + (25 n N) div L, and a term of weight w that occurs tf
times in it adds w ((10^9 tf) div (1000 tf + 12 m)); w is floor(1000 ln((2N + 2) / (2df + 1))).

Index. Documents of equal m form a stratum. A row of the index is a block: some strata,
or a slice of one, with about ``BLOCK_BYTES`` of text, whatever the strata's sizes. It holds
the strata, for each of them the tf that occur (levels, falling) with the impact of each,
computed once, and for each term its postings by stratum, then level, then document. Texts
cross the network once, to their block; blocks are dealt by length and hash, so a stratum
with a third of all documents is many blocks.

Search. Queries come in blocks of bounded size, each a job over the index. In a block
of the index the first posting of a term in a stratum has its greatest impact, which gives
every stratum a bound; strata are visited by falling bound until none can reach the
query's k-th best score of this task. A task returns at most k rows a query; they are
ranked in two steps. All numbers of the score are 64-bit integers.

Defined results: a null text, or one without a term, isn't indexed and never found; a null
doc_id comes after all others among equal scores; rows that repeat a doc_id are documents
of their own and may fill several ranks; queries without a term in the corpus get no
rows; rows that repeat an item_id are queries of their own. An empty table gives no
rows. Terms are told apart by a 64-bit hash. Other columns aren't read. Rows equal in doc_id
and text land in the same task, in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlens.llm import textbytes as tb
from costlens.session import scratch_path

# The bytes of a term: ASCII letters and digits and all characters beyond ASCII.
_NO_TERM = np.ones(256, bool)
_NO_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

#: Bytes of text in a block of the index, about; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20
#: Terms in a part: documents of like length that are sent to one task together.
PART_TERMS = 1 << 19
#: Cells of an octave of document lengths, by which parts are laid out.
CELLS = 16
#: Bytes and rows of a block of queries.
QUERY_BYTES, QUERY_ROWS = 4 << 20, 4096
#: Partial results a query is ranked in, at most.
SALTS = 256

_BLOCK = "ids array<long>, level_stratum array<int>, level_impact array<long>, terms array<long>, start array<int>, doc array<int>, level array<int>"


@dataclass
class Index:
    """The written blocks and the counts of the corpus."""

    blocks: DataFrame
    documents: int
    terms: int


def _layout(cells: dict[int, int]) -> tuple[list[int], list[int]]:
    """First part and number of parts of each cell of lengths, from the cells' terms."""
    first, count, part, held = [], [], 0, 0
    for cell in range(max(cells, default=-1) + 1):
        terms = cells.get(cell, 0)
        own = -(-terms // PART_TERMS)
        if held and held + terms > PART_TERMS:
            part, held = part + 1, 0
        first.append(part)
        count.append(max(1, own))
        if own > 1:
            part, held = part + own, 0
        else:
            held += terms
    return first, count


def term_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each term of a text column, in order."""
    rows, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    offsets, data = tb.buffers(texts)
    for i, j in tb.slices(offsets):
        part = data[offsets[i] : offsets[j]]
        row, start, end = tb.words(part, offsets[i : j + 1] - offsets[i], _NO_TERM)
        rows.append(row + i)
        hashes.append(tb.word_hashes(part, start, end).view(np.int64))
    return np.concatenate(rows), np.concatenate(hashes)


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [lo, hi), one after the other."""
    n = hi - lo
    total = int(n.sum())
    if not total:
        return np.zeros(0, np.int64)
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(total)


def _block(rows: pa.Table) -> pa.RecordBatch:
    """One block of the index of rows (m, doc_id, text)."""
    column = lambda i: rows.column(i).combine_chunks()
    ids, m = column(1), column(0).to_numpy(zero_copy_only=False).astype(np.int64)
    null, number = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False)
    order = np.lexsort((number, null, m))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    m = m[order]
    strata = _starts(m)
    stratum = np.repeat(np.arange(len(strata)), np.diff(np.append(strata, len(m))))
    row, term = term_hashes(column(2))
    doc = place[row]
    by = np.lexsort((doc, term))
    doc, term = doc[by], term[by]
    first = _starts(term, doc)
    tf = np.diff(np.append(first, len(doc)))
    doc, term = doc[first], term[first]
    # the tf of each stratum, falling, and what each adds to a score, once
    most = int(tf.max(initial=0)) + 1
    code = stratum[doc] * most + (most - 1 - tf)
    levels, level = np.unique(code, return_inverse=True)
    level_stratum, level_tf = levels // most, most - 1 - levels % most
    impact = (1_000_000_000 * level_tf) // (1000 * level_tf + 12 * m[strata][level_stratum])
    run = np.zeros(len(doc), np.int64)
    run[_starts(term, stratum[doc])] = 1
    by = np.lexsort((level, np.cumsum(run)))
    start = np.append(_starts(term), len(term))
    lists = [
        (ids.take(pa.array(order)), pa.int64()), (pa.array(level_stratum), pa.int32()), (pa.array(impact), pa.int64()),
        (pa.array(term[start[:-1]]), pa.int64()), (pa.array(start), pa.int32()), (pa.array(doc[by]), pa.int32()), (pa.array(level[by]), pa.int32()),
    ]
    names = [x.split()[0] for x in _BLOCK.split(", ")]
    return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a.cast(t)) for a, t in lists], names)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, m, doc_id, text), by part and m, to blocks."""
    held, size, part = [], 0, None
    for batch in batches:
        parts, at = batch.column(0).to_numpy(zero_copy_only=False), 0
        offsets, _ = tb.buffers(batch.column(3))
        while at < batch.num_rows:
            if held and (size >= BLOCK_BYTES or parts[at] != part):
                yield _block(pa.Table.from_batches(held))
                held, size = [], 0
            part = parts[at]
            same = int(np.searchsorted(parts, part, side="right"))
            full = int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES - size, side="left"))
            to = max(at + 1, min(same, full))
            held.append(batch.slice(at, to - at).select([1, 2, 3]))
            size += int(offsets[to] - offsets[at])
            at = to
    if held:
        yield _block(pa.Table.from_batches(held))


def _term_counts(texts: pa.Array) -> np.ndarray:
    """Terms of each text of a column."""
    offsets, data = tb.buffers(texts)
    out = np.zeros(len(texts), np.int64)
    for i, j in tb.slices(offsets):
        row, _, _ = tb.words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], _NO_TERM)
        out[i:j] = np.bincount(row, minlength=j - i)
    return out


def _cells(n: np.ndarray) -> np.ndarray:
    """The cell of lengths of each count of terms, all above 0."""
    return np.floor(np.log2(n) * CELLS).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) to (cell, documents, terms) of the task."""
    documents, terms = np.zeros(64 * CELLS, np.int64), np.zeros(64 * CELLS, np.int64)
    for batch in batches:
        n = _term_counts(batch.column(0))
        cell = _cells(n[n > 0])
        documents += np.bincount(cell, minlength=len(documents))
        np.add.at(terms, cell, n[n > 0])
    some = np.flatnonzero(documents)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(documents[some]), pa.array(terms[some])], ["cell", "documents", "terms"])


def _assign(documents: int, terms: int, first: list[int], count: list[int]) -> Callable:
    """(hash, doc_id, text) to (part, m, doc_id, text) of the rows that hold a term."""
    first, count = np.array(first, np.int64), np.array(count, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = _term_counts(batch.column(2))
            some = np.flatnonzero(n)
            n, cell = n[some], _cells(n[some])
            part = first[cell] + batch.column(0).to_numpy()[some] % count[cell]
            exact = int(n.max(initial=0)) * 25 * documents >= 1 << 63  # the product of three counts may pass 64 bits
            m = 75 + ((25 * documents * n.astype(object) // terms).astype(np.int64) if exact else 25 * documents * n // max(1, terms))
            rows = batch.take(pa.array(some))
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(m), rows.column(1), rows.column(2)], ["part", "m", "doc_id", "text"])

    return run


def build_index(docs: DataFrame) -> Index:
    """The index of all ``docs`` (doc_id, text), written to the shared checkpoint folder. The
    driver gets a row of counts for each cell of lengths, of which there are ``CELLS`` an octave."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = rows.select("text").mapInArrow(_count, "cell long, documents long, terms long")
    found = {r[0]: (r[1], r[2]) for r in counts.groupBy("cell").agg(F.sum("documents"), F.sum("terms")).collect()}
    documents, terms = (sum(x[i] for x in found.values()) for i in (0, 1))
    assign = _assign(documents, terms, *_layout({c: x[1] for c, x in found.items()}))
    rows = rows.select(F.xxhash64("doc_id", "text").alias("hash"), "doc_id", "text").mapInArrow(assign, "part long, m long, doc_id long, text string")
    rows = rows.repartition("part").sortWithinPartitions("part", "m")
    path = scratch_path(docs.sparkSession, "llm-index")
    # a row is a block of megabytes: small row groups keep a reading task's memory small
    rows.mapInArrow(_index, _BLOCK).write.option("parquet.block.size", 8 << 20).parquet(path)
    return Index(docs.sparkSession.read.schema(_BLOCK).parquet(path), documents, terms)


@dataclass
class Queries:
    """A block of queries: the distinct hashes of their terms, ascending, and for query i,
    named ``names[i]``, the terms ``term[start[i]:start[i + 1]]`` (indices, with repeats as ``times``)."""

    names: list
    first: int
    vocabulary: np.ndarray
    start: np.ndarray
    term: np.ndarray
    times: np.ndarray


def _queries(names: list, texts: list[str | None], first: int) -> Queries:
    row, term = term_hashes(pa.array(texts, pa.large_string()))
    vocabulary, index = np.unique(term, return_inverse=True)
    by = np.lexsort((index, row))
    row, index = row[by], index[by]
    run = _starts(row, index)
    times = np.diff(np.append(run, len(row)))
    return Queries(names, first, vocabulary, np.searchsorted(row[run], np.arange(len(names) + 1)), index[run], times)


def query_blocks(queries: DataFrame, name: str, text: str) -> Iterator[Queries]:
    """``queries`` in blocks of at most ``QUERY_ROWS`` rows and about ``QUERY_BYTES`` bytes; the
    driver holds one block, and the partition that it comes from."""
    names, texts, size, first = [], [], 0, 0
    for row in queries.select(F.col(name).cast("long"), F.col(text).cast("string")).toLocalIterator():
        names.append(row[0])
        texts.append(row[1])
        size += 4 * len(row[1] or "")
        if size >= QUERY_BYTES or len(names) >= QUERY_ROWS:
            yield _queries(names, texts, first)
            names, texts, size, first = [], [], 0, first + len(names)
    if names:
        yield _queries(names, texts, first)


def _lists(batch: pa.RecordBatch, name: str) -> Iterator[np.ndarray]:
    """The values of each row of a list column without null entries."""
    column = batch.column(batch.schema.get_field_index(name))
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return (values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True))


def _found(terms: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index in ``vocabulary``, place in ``terms``) of the terms in both; both ascend."""
    at = np.searchsorted(terms, vocabulary)
    hit = np.flatnonzero(at < len(terms))
    hit = hit[terms[at[hit]] == vocabulary[hit]]
    return hit, at[hit]


def _frequency(vocabulary: np.ndarray) -> Callable:
    """(terms, start) of blocks to (term, df): documents of the task that hold the term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for terms, start in zip(_lists(batch, "terms"), _lists(batch, "start"), strict=True):
                hit, at = _found(terms, vocabulary)
                df[hit] += start[at + 1] - start[at]
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["term", "df"])

    return run


class _Best:
    """The k best documents of a query so far: scores falling, equal ones by id, nulls last."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.score, self.null, self.id = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        score, null, ids = np.concatenate((self.score, score)), np.concatenate((self.null, null)), np.concatenate((self.id, ids))
        by = np.lexsort((ids, null, -score))[: self.k]
        self.score, self.null, self.id = score[by], null[by], ids[by]
        if len(by) == self.k:
            self.least = int(self.score[-1])


def _visit(best: _Best, bound: np.ndarray, runs: tuple, null: np.ndarray, ids: np.ndarray) -> None:
    """Score the strata of a block for one query, by falling bound, until none can reach
    the best. ``runs``: for each run of postings of a term in a stratum its stratum, first and
    last posting, the term's weight; then the document and the impact of each posting."""
    stratum, lo, hi, weight, doc, impact = runs
    order = np.flatnonzero(bound >= best.least)
    order = order[np.argsort(-bound[order], kind="stable")]
    at, step = 0, 16
    score, chosen = np.zeros(len(ids), np.int64), np.zeros(len(bound), bool)
    while at < len(order) and bound[order[at]] >= best.least:
        chosen[:] = False
        chosen[order[at : at + step]] = True
        some = np.flatnonzero(chosen[stratum])
        posting = _ranges(lo[some], hi[some])
        np.add.at(score, doc[posting], np.repeat(weight[some], hi[some] - lo[some]) * impact[posting])
        good = np.flatnonzero(score >= best.least)
        best.add(score[good], null[good], ids[good])
        score[doc[posting]] = 0
        at, step = at + step, 2 * step


def _search(queries: Queries, weights: np.ndarray, k: int) -> Callable:
    """Blocks to (query, item_id, doc_id, score): at most k rows a query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(k) for _ in queries.names]
        weight = weights[queries.term] * queries.times
        for batch in batches:
            columns = [_lists(batch, x) for x in ("level_stratum", "level_impact", "terms", "start", "doc", "level")]
            for i, (level_stratum, level_impact, terms, start, doc, level) in enumerate(zip(*columns, strict=True)):
                ids = batch.column(batch.schema.get_field_index("ids"))[i].values
                null, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False)
                hit, at = _found(terms, queries.vocabulary)
                posting = _ranges(start[at].astype(np.int64), start[at + 1].astype(np.int64))
                term = np.repeat(hit, start[at + 1] - start[at])
                doc, level = doc[posting], level[posting]
                impact, stratum = level_impact[level], level_stratum[level]
                lo = _starts(term, stratum)
                hi = np.append(lo[1:], len(term)).astype(np.int64)
                stratum, top = stratum[lo], impact[lo]  # the first posting of a run has the greatest impact
                runs_of = np.searchsorted(term[lo], np.arange(len(queries.vocabulary) + 1))
                n_strata = int(level_stratum[-1]) + 1 if len(level_stratum) else 0
                for q, mine in enumerate(best):
                    of = slice(queries.start[q], queries.start[q + 1])
                    t = queries.term[of]
                    runs = _ranges(runs_of[t], runs_of[t + 1])
                    w = np.repeat(weight[of], runs_of[t + 1] - runs_of[t])
                    bound = np.zeros(n_strata, np.int64)
                    np.add.at(bound, stratum[runs], w * top[runs])
                    if bound.max(initial=0) >= mine.least:
                        _visit(mine, bound, (stratum[runs], lo[runs], hi[runs], w, doc, impact), null, ids)
        q = np.repeat(np.arange(len(best)), [len(x.score) for x in best])
        names = pa.array(queries.names, pa.int64()).take(pa.array(q))
        ids = pa.array(np.concatenate([x.id for x in best]), mask=np.concatenate([x.null for x in best]))
        scores = np.concatenate([x.score for x in best])
        yield pa.RecordBatch.from_arrays([pa.array(q + queries.first), names, ids, pa.array(scores)], ["query", "item_id", "doc_id", "score"])

    return run


def search(index: Index, queries: DataFrame, k: int = 20, name: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each row of ``queries``."""
    spark = index.blocks.sparkSession
    kind = "query long, item_id long, doc_id long, score long"
    path, found = scratch_path(spark, "llm-found"), None
    for block in query_blocks(queries, name, text):
        df = np.zeros(len(block.vocabulary), np.int64)
        counts = index.blocks.select("terms", "start").mapInArrow(_frequency(block.vocabulary), "term long, df long")
        for r in counts.groupBy("term").agg(F.sum("df")).collect():  # at most a row for each term of the block of queries
            df[r[0]] = r[1]
        weights = np.array([floor(1000 * log((2 * index.documents + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        rows = index.blocks.mapInArrow(_search(block, weights, k), kind).withColumn("salt", F.spark_partition_id() % SALTS)
        rows.write.mode("append").parquet(path)
        found = spark.read.schema(f"{kind}, salt int").parquet(path)
    if found is None:
        found = spark.createDataFrame([], f"{kind}, salt int")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for keys in (["query", "salt"], ["query"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return found.select(F.col("item_id").alias(name), F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def lexical_search(docs: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """Index all ``docs`` and search them with every row of ``queries`` (item_id, text)."""
    return search(build_index(docs), queries, k)
