"""Language identification by clustered TF-IDF centroids (operator 1).

Method. A text is the normalised TF-IDF vector of its letter stream's character
n-grams (lengths 1 to 3, hashed to ``BUCKETS``; term frequencies damped by a
logarithm). Each language has several centroids, found by spherical k-means on its
sampled texts. A text gets the language of the centroid with the largest cosine;
it is marked as rejected where its cosine distance to that centroid exceeds the
distance that all but a share ``REJECT`` of the centroid's own texts keep.

Document frequencies are counted over all training texts by a Spark job. Clustering
reads at most ``per_lang`` texts of each language, rows drawn by a hash of their number, so
that repeated ids don't matter, and each language is clustered in a task of its own. Scoring reads every whole text once,
without a shuffle.

Defined results: a null text, or one without a letter, gets ``und`` and score 0; so
does every text if no language was learned. A text that has letters but no n-gram
in common with any centroid gets the first language by name and score 0; equal
cosines go to the first language by name. Null languages and rows with a null doc_id aren't learned from. Rows are
scored one by one, so repeated rows get equal rows. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlens.llm import textbytes as tb
from costlens.llm.staging import numbered, staged

WIDTHS = (1, 2, 3)
BUCKETS = 1 << 13
#: Centroids of a language, and texts of it that are read in training.
CENTROIDS = 4
PER_LANG = 400
REJECT = 0.005


@dataclass
class Model:
    """A row of ``centroids`` (unit vectors) per cluster, its language, and the least cosine it accepts."""

    langs: list[str]
    centroids: np.ndarray
    least: np.ndarray
    idf: np.ndarray


def counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, damped count) of the n-grams of each text, by row."""
    points, bounds = tb.letter_stream(data, offsets)
    keys = []
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    for width in WIDTHS:
        h = tb.gram_hashes(points, width)
        m = len(h)
        whole = row[:m] == row[width - 1 : width - 1 + m]
        if width == 1:
            whole &= points != 32
        keys.append(row[:m][whole].astype(np.uint64) * np.uint64(BUCKETS) + (h[whole] >> np.uint64(51)))
    keys = np.sort(np.concatenate(keys))
    start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    n = np.diff(np.append(start, len(keys)))
    return (keys[start] // np.uint64(BUCKETS)).astype(np.int64), (keys[start] % np.uint64(BUCKETS)).astype(np.int64), np.log1p(n)


def vectors(data: np.ndarray, offsets: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, weight): the texts' unit vectors."""
    row, bucket, value = counts(data, offsets)
    value = value * idf[bucket]
    norm = np.sqrt(np.bincount(row, value**2, minlength=len(offsets) - 1))
    return row, bucket, value / np.maximum(norm, 1e-300)[row]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) to (bucket, n): texts of the task that have the bucket, and all of them as bucket -1."""
    total, texts = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        texts += batch.num_rows
        offsets, data = tb.buffers(batch.column(0))
        for i, j in tb.slices(offsets):
            total += np.bincount(counts(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])[1], minlength=BUCKETS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array([-1, *some.tolist()]), pa.array([texts, *total[some].tolist()])], ["bucket", "n"])


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means of unit rows: (unit centroids, label of each row). Starts from the
    rows that lie farthest from those chosen before."""
    mean = x.mean(0)
    best = x @ mean
    seeds = [int(np.argmax(best))]
    near = x @ x[seeds[0]]
    while len(seeds) < min(k, len(x)):
        seeds.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[seeds[-1]])
    centre = x[seeds].copy()
    label = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        label = np.argmax(x @ centre.T, axis=1)
        for c in range(len(centre)):
            if (label == c).any():
                total = x[label == c].sum(0)
                centre[c] = total / max(np.linalg.norm(total), 1e-300)
    used = np.unique(label)
    return centre[used], np.searchsorted(used, label)


def _centroids(idf: np.ndarray, k: int) -> Callable:
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("doc_id").combine_chunks()
        text = rows["text"].combine_chunks() if isinstance(rows["text"], pa.ChunkedArray) else rows["text"]
        offsets, data = tb.buffers(text)
        dense = np.zeros((len(rows), BUCKETS), np.float32)
        for i, j in tb.slices(offsets):
            row, bucket, value = vectors(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], idf)
            dense[row + i, bucket] = value
        dense = dense[(dense != 0).any(1)]
        if not len(dense):
            return pa.table({"lang": pa.array([], pa.string()), "centroid": pa.array([], pa.list_(pa.float32())), "least": pa.array([], pa.float64())})
        centre, label = cluster(dense, k)
        cosine = np.einsum("ij,ij->i", dense, centre[label])
        least = [float(np.quantile(cosine[label == c], REJECT)) for c in range(len(centre))]
        return pa.table({
            "lang": pa.array([rows["lang"][0].as_py()] * len(centre)),
            "centroid": pa.array(list(centre.astype(np.float32)), pa.list_(pa.float32())),
            "least": pa.array(least),
        })

    return run


def train(docs: DataFrame, per_lang: int = PER_LANG, centroids: int = CENTROIDS) -> Model:
    """Learn from ``docs`` (doc_id, text, lang)."""
    rows = numbered(docs.where("lang is not null and text is not null and doc_id is not null").select("lang", "doc_id", "text"))
    ids = rows.select("lang", "__row", F.xxhash64("__row").alias("__hash"))
    sizes = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("__n"))
    # rows are drawn without their texts: a share of each language by hash, then the first of them
    share = F.col("__hash") / F.lit(float(1 << 64)) + 0.5
    # (a row a language, fewer than the model's own rows: sent to all tasks, so no row is shuffled)
    few = ids.join(F.broadcast(sizes), "lang").where(share * F.col("__n") < 4.0 * per_lang)
    order = Window.partitionBy("lang").orderBy("__hash", "__row")
    drawn = few.withColumn("__i", F.row_number().over(order)).where(F.col("__i") <= per_lang).select("__row")
    drawn = staged(drawn, "lang-drawn")  # per_lang rows a language at most
    sample = staged(rows.join(F.broadcast(drawn), "__row").select("lang", "doc_id", "text"), "lang-sample")
    # document frequencies are counted over all training texts
    seen = rows.select("text").mapInArrow(_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    df, n = np.zeros(BUCKETS), 0
    for r in seen:
        if r["bucket"] < 0:
            n = r["n"]
        else:
            df[r["bucket"]] = r["n"]
    idf = np.log((1 + n) / (1 + df)) + 1.0
    found = sample.groupBy("lang").applyInArrow(_centroids(idf, centroids), "lang string, centroid array<float>, least double").collect()
    found = sorted(found, key=lambda r: r["lang"].encode())
    centre = np.array([r["centroid"] for r in found], np.float64).reshape(len(found), BUCKETS)
    return Model([r["lang"] for r in found], centre, np.array([r["least"] for r in found]), idf)


def _classify(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.ascontiguousarray(model.centroids.T)
        for batch in batches:
            offsets, data = tb.buffers(batch.column(1))
            for i, j in tb.slices(offsets):
                n = j - i
                row, bucket, value = vectors(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], model.idf)
                cosine = np.zeros((n, table.shape[1]))
                step = max(1, (1 << 22) // table.shape[1])
                for s in range(0, len(row), step):  # rows ascend: sums over runs of them
                    r, w = row[s : s + step], table[bucket[s : s + step]] * value[s : s + step, None]
                    first = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
                    cosine[r[first]] += np.add.reduceat(w, first, axis=0)
                best = np.argmax(cosine, axis=1)
                score = np.clip(cosine[np.arange(n), best], 0.0, 1.0)
                names = pa.array([model.langs[b] for b in best], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, n), batch.column(2).slice(i, n), names, pa.array(score), pa.array(score < model.least[best])],
                    ["doc_id", "letters", "nearest", "cosine", "far"],
                )

    return run


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row of ``docs`` (doc_id, text)."""
    text = F.col("text").cast("string")
    letters = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), letters.alias("letters"))
    if not model.langs:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    out = rows.mapInArrow(_classify(model), "doc_id long, letters boolean, nearest string, cosine double, far boolean")
    return out.select(
        "doc_id",
        F.when(F.col("letters"), F.col("nearest")).otherwise("und").alias("lang_pred"),
        F.when(F.col("letters"), F.col("cosine")).otherwise(0.0).alias("score"),
        (F.col("far") | ~F.col("letters")).alias("rejected"),
    )
