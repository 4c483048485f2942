"""Quality by a sparse rule ensemble (operator 5).

Method. Boosted shallow trees are grown over statistics of labelled texts; every
path from a root to a node is a rule, a conjunction of threshold tests. A logistic
regression with an L1 penalty gives most rules the weight 0, and the others are
compiled into one Spark column expression over the statistics.

Training reads the statistics, not the texts, of at most ``most`` labelled rows, drawn
by a hash of doc_id and, where ids repeat, of the row; trees and weights are fitted on the driver. Statistics are
made of every whole text in one pass without a shuffle.

Defined results: a null text is empty; an empty text has statistics 0 and gets the
score of the rules that hold there; without labelled rows of both labels every
score is the share of label 1 (0 without any). Labels of repeated doc_ids count as
1 if any is 1; labels other than 0 and 1 and nulls are unlabelled. Rows are scored
one by one, so repeated rows get equal rows. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.llm import textbytes as tb
from costlens.llm.staging import bounded_rows, staged
from costlens.llm.toxicity import held_out

#: Labelled rows that training reads.
MOST = 12_000
TREES, DEPTH, BINS = 60, 3, 32

#: Classes of bytes whose shares are statistics.
_CLASSES = {
    "lower": range(0x61, 0x7B),
    "upper": range(0x41, 0x5B),
    "digit": range(0x30, 0x3A),
    "space": (0x20, 0x09),
    "newline": (0x0A, 0x0D),
    "stop": b".?",
    "comma": b",;:",
    "bang": b"!",
    "bar": b"|",
    "star": b"*",
    "hash": b"#$%&@^~",
    "bracket": b"()[]{}<>",
    "slash": b"/\\_=+-",
    "quote": b"'\"`",
    "high": range(0x80, 0x100),
}
_CLASS = np.full(256, len(_CLASSES), np.int64)
for _i, _codes in enumerate(_CLASSES.values()):
    _CLASS[list(_codes)] = _i

STATISTICS = [
    *[f"share_{c}" for c in _CLASSES],
    "log_bytes", "log_words", "word_bytes", "long_words", "distinct_words", "top_word", "repeated_next",
    "log_lines", "line_bytes", "distinct_lines", "distinct_triples", "upper_per_letter", "odd_word_ends", "ends_in_stop",
]


def _per(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def _distinct(row: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, and how often its most frequent one occurs."""
    order = np.lexsort((value, row))
    r, v = row[order], value[order]
    start = np.flatnonzero(np.concatenate(([True], (r[1:] != r[:-1]) | (v[1:] != v[:-1])))) if len(r) else np.zeros(0, np.int64)
    times = np.diff(np.append(start, len(r)))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, r[start], times)
    return np.bincount(r[start], minlength=n), top


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, statistics) of UTF-8 texts ``data[offsets[i]:offsets[i + 1]]``."""
    n, size = len(offsets) - 1, np.diff(offsets)
    k = len(_CLASSES) + 1
    kinds = np.bincount(np.repeat(np.arange(n) * k, size) + _CLASS[data], minlength=n * k).reshape(n, k)[:, :-1]
    row, start, end = tb.words(data, offsets)
    words = np.bincount(row, minlength=n)
    length = end - start
    hashes = tb.word_hashes(data, start, end)
    distinct, top = _distinct(row, hashes, n)
    again = (row[1:] == row[:-1]) & (hashes[1:] == hashes[:-1])
    triple_row, triple = tb.shingle_hashes(row, hashes, n, 3)
    triples, _ = _distinct(triple_row, triple, n)
    cut = np.flatnonzero(data == 0x0A)
    lines_from = np.unique(np.concatenate((offsets[:-1][size > 0], cut + 1)))
    lines_from = lines_from[lines_from < len(data)]
    line_row = np.searchsorted(offsets, lines_from, side="right") - 1
    lines_to = np.minimum(np.append(lines_from[1:], len(data)), offsets[line_row + 1])
    lines = np.bincount(line_row, minlength=n)
    line_kinds, _ = _distinct(line_row, tb.word_hashes(data, lines_from, lines_to), n)
    last = data[np.maximum(end - 1, 0)] if len(end) else np.zeros(0, np.uint8)
    odd = np.isin(last, np.frombuffer(b"*#$%&@^~!|", np.uint8)) & (length > 1)
    final = np.zeros(n, np.int64)
    final[row] = last  # the last word's last byte stays
    letters = kinds[:, 0] + kinds[:, 1]
    columns = [
        *(kinds / np.maximum(size, 1)[:, None]).T,
        np.log1p(size), np.log1p(words), _per(np.bincount(row, length, minlength=n), words), _per(np.bincount(row, length > 20, minlength=n), words),
        _per(distinct, words), _per(top, words), _per(np.bincount(row[1:][again], minlength=n), words),
        np.log1p(lines), _per(size, lines), _per(line_kinds, lines), _per(triples, np.maximum(words - 2, 1)), _per(kinds[:, 1], letters), _per(np.bincount(row, odd, minlength=n), words), np.isin(final, [0x2E, 0x3F, 0x21]),
    ]
    # few digits: a threshold between two values holds on any machine
    return np.round(np.stack([np.asarray(c, np.float64) for c in columns], axis=1), 9)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, data = tb.buffers(batch.column(1))
        for i, j in tb.slices(offsets):
            x = statistics(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *[pa.array(c) for c in np.ascontiguousarray(x.T)]], ["doc_id", *STATISTICS])


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, statistics...) of every row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_measure, "doc_id long, " + ", ".join(f"{s} double" for s in STATISTICS))


#: A rule: (statistic, above, threshold) tests that hold together.
Rule = tuple[tuple[str, bool, float], ...]


@dataclass
class Model:
    bias: float
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def column(self) -> Column:
        """The score as an expression over the statistics."""
        z = F.lit(self.bias)
        for rule, weight in self.rules:
            holds = None
            for name, above, threshold in rule:
                test = F.col(name) > threshold if above else F.col(name) <= threshold
                holds = test if holds is None else holds & test
            z = z + F.when(holds, weight).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, names: list[str]) -> list[Rule]:
    """Rules of boosted trees: each tree fits the logistic loss's gradient on half of the rows."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    flat = binned + np.arange(x.shape[1]) * BINS
    z = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    rules: dict[Rule, None] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        grad, hess = y - p, p * (1 - p)
        drawn = rng.random(len(y)) < 0.5
        leaves: list[tuple[np.ndarray, Rule]] = [(np.arange(len(y)), ())]
        for _ in range(DEPTH):
            nodes = []
            for rows, path in leaves:
                split = _split(flat, rows[drawn[rows]], grad, hess, x.shape[1])
                if split is None:
                    nodes.append((rows, path))
                    continue
                f, b = split
                if b >= len(edges[f]):
                    nodes.append((rows, path))
                    continue
                above = binned[rows, f] > b
                for side in (False, True):
                    rule = _tidy((*path, (names[f], side, float(edges[f][b]))))
                    rules[rule] = None
                    nodes.append((rows[above == side], rule))
            leaves = nodes
        for rows, _ in leaves:
            z[rows] += 0.3 * grad[rows].sum() / (hess[rows].sum() + 1.0)
    return list(rules)


def _split(flat: np.ndarray, rows: np.ndarray, grad: np.ndarray, hess: np.ndarray, features: int) -> tuple[int, int] | None:
    """(feature, bin) after which to cut, by the gain of a Newton step; none without a gain."""
    if len(rows) < 20:
        return None
    at = flat[rows].ravel()
    g = np.bincount(at, np.repeat(grad[rows], features), minlength=features * BINS).reshape(features, BINS).cumsum(1)
    h = np.bincount(at, np.repeat(hess[rows], features), minlength=features * BINS).reshape(features, BINS).cumsum(1)
    n = np.bincount(at, minlength=features * BINS).reshape(features, BINS).cumsum(1)
    total_g, total_h = g[0, -1], h[0, -1]
    gain = g**2 / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g**2 / (total_h + 1)
    gain[(n < 10) | (len(rows) - n < 10)] = -1
    best = int(np.argmax(gain))
    return divmod(best, BINS) if gain.flat[best] > 1e-3 else None


def _tidy(path: Rule) -> Rule:
    """The path with only its sharpest test of each statistic and direction, sorted."""
    tests: dict[tuple[str, bool], float] = {}
    for name, above, t in path:
        key = (name, above)
        tests[key] = t if key not in tests else max(tests[key], t) if above else min(tests[key], t)
    return tuple(sorted((n, a, t) for (n, a), t in tests.items()))


def holds(rules: list[Rule], x: np.ndarray, names: list[str]) -> np.ndarray:
    """(rows, rules) 0/1."""
    at = {n: i for i, n in enumerate(names)}
    out = np.ones((len(x), len(rules)), np.float32)
    for r, rule in enumerate(rules):
        for name, above, t in rule:
            out[:, r] *= (x[:, at[name]] > t) if above else (x[:, at[name]] <= t)
    return out


def lasso(x: np.ndarray, y: np.ndarray, penalty: float, start: np.ndarray | None = None, rounds: int = 250) -> np.ndarray:
    """Logistic weights (the intercept last) under an L1 penalty, by accelerated proximal gradient."""
    n, m = x.shape
    v = np.random.default_rng(0).random(m).astype(np.float32)
    for _ in range(15):  # the largest eigenvalue of x'x / n
        v = x.T @ (x @ v)
        v /= max(float(np.linalg.norm(v)), 1e-30)
    step = 1.0 / (0.25 * (float(np.linalg.norm(x @ v)) ** 2 / n + 1.0) * 1.05)
    w = prev = np.zeros(m + 1) if start is None else start
    t = 1.0
    for _ in range(rounds):
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        u = w + (t - 1) / t_next * (w - prev)
        error = 1 / (1 + np.exp(-np.clip(x @ u[:m].astype(np.float32) + u[m], -60, 60))) - y
        new = u - step * np.append(x.T @ error.astype(np.float32) / n, error.mean())
        new[:m] = np.sign(new[:m]) * np.maximum(np.abs(new[:m]) - step * penalty, 0)
        prev, w, t = w, new, t_next
    return w


def fit(x: np.ndarray, y: np.ndarray, names: list[str]) -> Model:
    """The rule ensemble; the penalty is the one with the least loss on a fifth set aside."""
    rng = np.random.default_rng(11)
    rules = grow(x, y, rng, names)
    if not rules:
        return Model(float(np.log(y.mean() / (1 - y.mean()))))
    on = holds(rules, x, names)
    rest = np.arange(len(y)) % 5 != 0
    best, w = (np.inf, 0.0), None
    for penalty in (0.01, 0.004, 0.0015, 0.0006):
        w = lasso(on[rest], y[rest], penalty, w)
        z = on[~rest] @ w[:-1] + w[-1]
        loss = float(np.mean(np.logaddexp(0, z) - y[~rest] * z))
        best = min(best, (loss, penalty))
    w = lasso(on, y, best[1])
    kept = np.flatnonzero(np.abs(w[:-1]) > 1e-6)
    return Model(float(w[-1]), [(rules[i], float(w[i])) for i in kept])


def train(docs: DataFrame, labels: DataFrame, most: int = MOST) -> Model:
    """Fit on the labelled rows of ``docs`` (doc_id, text) and ``labels`` (doc_id, label)."""
    marks = labels.where("label in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    drawn = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    sample = bounded_rows(docs.select("doc_id", "text"), drawn, most).select("doc_id", "text")
    rows = staged(measured(sample), "quality-sample").join(F.broadcast(drawn), "doc_id").orderBy(F.xxhash64("doc_id"), *STATISTICS).toPandas()
    y = rows["label"].to_numpy(np.float64)
    if len(np.unique(y)) < 2:
        share = float(y.mean()) if len(y) else 0.0
        return Model(60.0 if share == 1 else -60.0)
    return fit(rows[STATISTICS].to_numpy(np.float64), y, STATISTICS)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fold: int = 0, parts: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``; the ensemble learns
    ``quality`` of ``labels`` from the rows that aren't held out."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    learn = labels.where(~held_out(fold, parts)).select("doc_id", F.col("quality").alias("label"))
    out = measured(docs).select("doc_id", train(docs, learn).column().alias("score"))
    return out.select("doc_id", held_out(fold, parts).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
