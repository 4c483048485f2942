"""Toxicity by a character n-gram linear classifier (operator 10).

Method. A feature is the presence of a character n-gram of the text's letter
stream (lower-cased letters, anything else as one space). Each feature is scaled
by its naive Bayes log-count ratio between the two labels, and a logistic
regression is fitted on the scaled features.

Training reads a bounded, documented sample of the labelled rows, ``per_label`` rows
of each label at most, by a hash of doc_id and, where ids repeat, of the row; counting n-grams and turning the
sample into rows of features run as Spark jobs, and the driver gets every n-gram
whose statistic is ``LEAST_G2`` at least (their number is bounded by the sample,
not by a cap) and the sample's feature indices. Scoring reads every whole text
once, without a shuffle.

The score is the probability at the sample's share of label 1, so that a rare label
is found by a single clear sign; it isn't shifted to the label's share in the data.

Defined results: a null or empty text has no feature and gets the score of the
intercept; without labelled rows of both labels every score is the share of
label 1 among them (0 without any). Labels of repeated doc_ids count as 1 if any
is 1; labels other than 0 and 1 and null labels are unlabelled. Rows are scored
one by one, so repeated rows get equal rows. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm import textbytes as tb
from costlens.llm.staging import bounded_rows, staged

#: Lengths of the n-grams.
WIDTHS = (4, 5, 6, 7)
#: Sampled rows of each label; each is read whole.
PER_LABEL = 2500
#: The least likelihood-ratio statistic of a selected n-gram.
LEAST_G2 = 12.0


@dataclass
class Model:
    """n-gram hashes (sorted), a weight for each and the intercept."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float


def held_out(fold: int, parts: int):
    """True where crc32 of doc_id as text leaves remainder ``fold`` (a null doc_id: false)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == fold, F.lit(False))


def _present(column: pa.Array, keep: Callable) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For slices of a text column: (first row, rows, row, value) with the distinct values
    that ``keep`` makes of n-gram hashes ((position, value) of those to keep)."""
    offsets, data = tb.buffers(column)
    for i, j in tb.slices(offsets):
        points, bounds = tb.letter_stream(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        rows, values = [], []
        for width in WIDTHS:
            at, value = keep(tb.gram_hashes(points, width))
            row = np.searchsorted(bounds, at, side="right") - 1
            whole = at + width <= bounds[row + 1]
            rows.append(row[whole])
            values.append(value[whole])
        yield i, j - i, *tb.distinct_sorted(np.concatenate(rows), np.concatenate(values))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, label) to (gram, n0, n1): documents of each label that have the n-gram."""
    for batch in batches:
        label = batch.column(1).to_numpy(zero_copy_only=False)
        for first, _, row, value in _present(batch.column(0), lambda h: (np.arange(len(h)), h)):
            order = np.argsort(value, kind="stable")
            value, one = value[order], label[first + row[order]] == 1
            start = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1]))) if len(value) else np.zeros(0, np.int64)
            n = np.diff(np.append(start, len(value)))
            n1 = np.add.reduceat(one.astype(np.int64), start) if len(start) else n
            yield pa.RecordBatch.from_arrays([pa.array(value[start].view(np.int64)), pa.array(n - n1), pa.array(n1)], ["gram", "n0", "n1"])


def _indices(lookup: tb.Lookup) -> Callable:
    """(text, label) to (label, features)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, row, value in _present(batch.column(0), lookup.find):
                off = np.searchsorted(row, np.arange(n + 1))
                lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(value.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(first, n), lists], ["label", "features"])

    return run


def _fit(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, l2: float = 0.01, rounds: int = 600) -> tuple[np.ndarray, float]:
    """Logistic regression on the scaled presence features (accelerated gradient)."""
    n, m = len(rows), len(ratio)
    at = np.repeat(np.arange(n), [len(r) for r in rows])
    feature = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    rows.clear()
    value = ratio[feature]
    norm = np.bincount(at, value**2, minlength=n).max(initial=0.0) + 1.0
    step = 1.0 / (0.25 * norm + l2 / n)
    w = v = np.zeros(m + 1)
    t = 1.0
    for _ in range(rounds):
        z = np.bincount(at, value * v[feature], minlength=n) + v[m]
        error = 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))) - y
        grad = np.append(np.bincount(feature, value * error[at], minlength=m) / n + l2 / n * v[:m], error.mean())
        new = v - step * grad
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w[:m] * ratio, float(w[m])


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Model:
    """Fit on the labelled rows of ``docs`` (doc_id, text) and ``labels`` (doc_id, label)."""
    marks = labels.where("label in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    drawn = [
        marks.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
        for k in (0, 1)
    ]
    totals = {r["label"]: r["count"] for r in marks.groupBy("label").count().collect()}
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sample = bounded_rows(texts, drawn[0].unionByName(drawn[1]), per_label, "label", (0, 1)).select("text", "label")
    sample = staged(sample, "toxic-sample")
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    n0, n1 = (float(sizes[k]) for k in (0, 1))
    counts = sample.repartition(16).mapInArrow(_count, "gram long, n0 long, n1 long").groupBy("gram").agg(F.sum("n0").alias("a"), F.sum("n1").alias("b"))

    def term(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))

    a, b = F.col("a"), F.col("b")
    both = (a + b) / (n0 + n1)
    g2 = 2 * (term(a, both * n0) + term(b, both * n1) + term(F.lit(n0) - a, (1 - both) * n0) + term(F.lit(n1) - b, (1 - both) * n1))
    ratio = F.log(((b + 1) / (n1 + 2)) / ((a + 1) / (n0 + 2)))
    chosen = counts.where((a + b < n0 + n1) & (a + b >= 3)).select("gram", g2.alias("g2"), ratio.alias("r")).where(F.col("g2") >= LEAST_G2)
    chosen = chosen.toPandas()
    hashes = chosen["gram"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    lookup = tb.Lookup(hashes)
    rows = sample.repartition(16).mapInArrow(_indices(lookup), "label int, features array<int>").toPandas()
    y = rows["label"].to_numpy(np.float64)
    weights, bias = _fit([np.asarray(x, np.int64) for x in rows["features"]], y, chosen["r"].to_numpy()[order])
    return Model(lookup.hashes, weights, bias)


def _score(model: Model) -> Callable:
    lookup = tb.Lookup(model.hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, row, value in _present(batch.column(1), lookup.find):
                z = np.bincount(row, model.weights[value], minlength=n) + model.bias if len(row) else np.full(n, model.bias)
                score = 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), pa.array(score)], ["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row: the probability of label 1."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_score(model), "doc_id long, score double")


def _below(model: Model, threshold: float, text: int) -> Callable:
    """The rows whose text, in column ``text``, scores less than ``threshold``."""
    scored = _score(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for part in scored(iter([pa.RecordBatch.from_arrays([batch.column(text)] * 2, ["doc_id", "text"])])):
                stays = pa.array(part.column(1).to_numpy() < threshold)
                yield batch.slice(first, part.num_rows).filter(stays)
                first += part.num_rows

    return run


def _learned(docs: DataFrame, labels: DataFrame, fold: int, parts: int) -> Model:
    """The classifier of ``toxic`` of ``labels``, from the rows that aren't held out."""
    learn = labels.where(~held_out(fold, parts)).select("doc_id", F.col("toxic").alias("label"))
    return train(docs, learn)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, fold: int = 0, parts: int = 5) -> DataFrame:
    """The rows of ``docs`` that ``toxicity`` doesn't predict to be toxic, whole. Each row is
    judged by its own text, so null and repeated doc_ids are told apart."""
    docs = docs.withColumn("text", F.col("text").cast("string"))
    return docs.mapInArrow(_below(_learned(docs, labels, fold, parts), threshold, docs.columns.index("text")), docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, fold: int = 0, parts: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``; the classifier
    learns ``toxic`` of ``labels`` from the rows that aren't held out."""
    out = score(docs, _learned(docs, labels, fold, parts))
    return out.select("doc_id", held_out(fold, parts).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
