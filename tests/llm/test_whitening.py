import numpy as np
import pytest

from costlens.llm import whitening as W
from tests.llm.helpers import clashing

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def brute(rows, k=16):
    """(vec_id, component) -> (n, deviation, |whitened|, explained)"""
    good = [(i, np.array(v, np.float32).astype(np.float64)) for i, v, *_ in rows if usable(v)]
    x = np.array([np.floor(64 * v).astype(np.int64) + 1_000_000 for _, v in good])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    keep = e > 1e-9 * e[0]
    white = np.abs((x - s / n) @ q[:, keep] / np.sqrt(e[keep]))
    deviation = [int(((n * row.astype(object) - s) ** 2).sum()) for row in x]
    share = e[keep] / np.trace(c.T @ c / n)
    return sorted((good[r][0] or -1, j + 1, n, deviation[r], round(white[r, j], 7), round(share[j], 10)) for r in range(len(x)) for j in range(keep.sum()))


def run(spark, rows, prepare=lambda df: df, k=16):
    out = W.whiten(prepare(spark.createDataFrame(rows, SCHEMA).repartition(3)), k).collect()
    assert all(r.identity_error <= 1e-9 for r in out)
    return sorted((r.vec_id or -1, r.component, r.n, r.deviation, round(abs(r.whitened), 7), round(r.explained, 10)) for r in out)


def close(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert x[:4] == y[:4] and x[4:] == pytest.approx(y[4:], abs=1e-6)


def vectors(seed, n, dim, scale=2.0):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, dim)) * scale * np.linspace(1, 0.2, dim) + 3).tolist()


def test_filtered_iteration_equals_the_eigenvectors(spark):
    rows = [(i, v, 0) for i, v in enumerate(vectors(1, 600, 64))]
    close(run(spark, rows), brute(rows))


def test_copies_count_once_and_unusable_rows_go(spark):
    base = vectors(2, 80, 12)
    rows = [(i, v, 0) for i, v in enumerate(base)] + [(500 + i, base[3], 0) for i in range(40)]
    rows += [(1000, None, 1), (1001, [None] * 12, 1), (1002, [float("nan")] + [0.0] * 11, 1), (1003, [float("inf")] * 12, 1), (None, base[5], 0), (7, base[6], 0)]
    close(run(spark, rows), brute(rows))
    close(run(spark, rows, clashing, k=3), brute(rows, 3))


def test_directions_without_variance_end_the_components(spark):
    flat = [(i, [*v, 1.5, -2.0], 0) for i, v in enumerate(vectors(3, 50, 4))]
    out = run(spark, flat)
    assert {r[1] for r in out} == {1, 2, 3, 4}
    close(out, brute(flat))


def test_other_lengths_stay_unprojected(spark):
    rows = [(i, v, 0) for i, v in enumerate(vectors(4, 40, 6))] + [(100, [1.0, 2.0], 0), (101, [], 0)]
    out = W.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == 42 * 6
    odd = [r for r in out if r.vec_id >= 100]
    assert len(odd) == 12 and all(r.whitened is None and r.deviation is None and r.n == 40 for r in odd)


def test_empty_and_single(spark):
    assert W.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0)] * 5, SCHEMA)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, None, 0), (2, [], 0)], SCHEMA)).count() == 0


def test_filter_is_the_chebyshev_polynomial():
    rng = np.random.default_rng(5)
    v = rng.normal(size=(9, 9))
    v = v @ v.T
    values, q = np.linalg.eigh(v)
    block, below, top = rng.normal(size=(9, 3)), values[4], values[-1]
    t = lambda x: np.polynomial.chebyshev.chebval((x - below / 2) / (below / 2), [0] * 6 + [1])
    expected = q @ np.diag(t(values) / t(top)) @ q.T @ block
    found = W._filtered(lambda x: v @ x, block, v @ block, below, top, 6)
    assert np.allclose(found, expected)


def test_deviation_is_exact_or_null(spark):
    rows = [(i, [float(x), float(-x)], 0) for i, x in enumerate([0.0, 1e3, 1e6, 2e7, 3e9, 1e30])]
    out = {r.vec_id: r.deviation for r in W.whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    x = [[int(np.floor(64 * min(max(float(np.float32(c)), -W.BOUND), W.BOUND))) + 1_000_000 for c in r[1]] for r in rows]
    n, s = 6, [sum(c) for c in zip(*x, strict=True)]
    exact = {i: sum((n * c - t) ** 2 for c, t in zip(v, s, strict=True)) for i, v in enumerate(x)}
    assert out == {i: d if d < 1 << 63 else None for i, d in exact.items()}
    assert None in out.values() or max(exact.values()) < 1 << 63
