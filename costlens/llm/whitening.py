"""Whitening of embeddings by Chebyshev-filtered subspace iteration (operator 12).

Fit. An entry c becomes x = floor(64 c) + 1000000; the fit list is each distinct x-vector
once, n vectors with the sums S per dimension. The covariance V has divisor n and is
centred by S / n before anything is multiplied. V is never formed: V Q, for a thin block Q,
is a distributed pass that sums Xᵀ(X Q) over the written fit list; a task sends one row a
dimension, added up by Spark, and the driver holds blocks of d x (k + guard) numbers.

Method. A round filters the block by a Chebyshev polynomial of V, by its three-term
recurrence, a pass a degree: the part of the spectrum below the block's smallest Ritz
value is damped, the part above grows. QR makes the block orthonormal, Rayleigh-Ritz turns
it to the eigenvectors. Rounds go on until every wanted pair is certified: its residual
||V q - e q|| is ``TOLERANCE`` of the largest eigenvalue at most, or no longer falls and is
within ``ROUNDING`` of it, what the sums' rounding leaves. The covariance of the whitened
fit list is then measured by a pass of its own.

Defined results: rows whose vector is null or holds null or non-finite entries go; the
model is fitted on the vectors of the commonest length (the longest of equally
common ones), vectors of other lengths, empty ones too, stay with null ``deviation`` and
``whitened``; entries beyond ±2^34 count as ±2^34; a deviation beyond 64 bits is null.
Repeated rows, null and repeated vec_ids are rows of their own. Directions without
variance can't be whitened: components end before them, so a fit list of one vector, or an
empty table, gives no rows. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm.staging import staged

#: Scale and offset of the whole numbers (fixed values).
SCALE, OFFSET = 64.0, 1_000_000
BOUND = float(1 << 34)
#: Columns of the block beside the wanted ones: they speed up the filter.
GUARD = 16
#: Degree of a round's polynomial, and rounds at most.
DEGREE, ROUNDS = 10, 60
#: Certified residuals, as a part of the largest eigenvalue.
TOLERANCE, ROUNDING = 1e-13, 1e-10
#: Eigenvalues below this part of the largest one are no variance.
NOTHING = 1e-12


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, embedding) to (vec_id, x): the usable rows."""
    for batch in batches:
        column = batch.column(1)
        offsets = column.offsets.to_numpy().astype(np.int64)
        flat = column.values.cast(pa.float64())
        bad = ~np.isfinite(flat.fill_null(np.nan).to_numpy(zero_copy_only=False))
        before = np.concatenate(([0], np.cumsum(bad)))
        good = (before[offsets[1:]] == before[offsets[:-1]]) & column.is_valid().to_numpy(zero_copy_only=False)
        some = np.flatnonzero(good)
        value = flat.fill_null(0.0).to_numpy(zero_copy_only=False)
        with np.errstate(over="ignore", invalid="ignore"):
            x = np.floor(np.clip(np.where(bad, 0.0, value), -BOUND, BOUND) * SCALE).astype(np.int64) + OFFSET
        length = offsets[some + 1] - offsets[some]
        start = np.concatenate(([0], np.cumsum(length)))
        at = np.repeat(offsets[some] - start[:-1], length) + np.arange(start[-1])
        lists = pa.ListArray.from_arrays(pa.array(start, pa.int32()), pa.array(x[at]))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some)), lists], ["vec_id", "x"])


def entries(vectors: DataFrame) -> DataFrame:
    """(vec_id, x) of the usable rows of ``vectors`` (vec_id, embedding)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(_entries, "vec_id long, x array<long>")


def _matrices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    """The x-vectors of a first column without nulls, all of length ``dim``, in matrices."""
    for batch in batches:
        column = batch.column(0)
        lo, hi = (int(column.offsets[i].as_py()) for i in (0, len(column))) if len(column) else (0, 0)
        flat = column.values.to_numpy(zero_copy_only=False)[lo:hi].reshape(-1, dim)
        for i in range(0, len(flat), 4096):
            yield flat[i : i + 4096]


@dataclass(frozen=True)
class Centre:
    """The mean S / n of each dimension as a whole number and the rest, below 1."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest


def _sums(dim: int) -> Callable:
    """x to (dimension, sum) of each matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _matrices(batches, dim):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), pa.array(x.sum(axis=0))], ["i", "s"])

    return run


def centre(fit: DataFrame, dim: int) -> tuple[Centre, list[int]]:
    """The centre of the written fit list (x), and S."""
    n = fit.count()
    rows = fit.mapInArrow(_sums(dim), "i long, s long").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38, 0)"))).collect()
    s = [0] * dim
    for i, total in rows:  # a row a dimension
        s[i] = int(total)
    whole = [x // n for x in s]
    rest = [(x - n * y) / n for x, y in zip(s, whole, strict=True)]
    return Centre(n, np.array(whole, np.int64), np.array(rest)), s


def _pass(centre: Centre, block: np.ndarray, gram: bool) -> Callable:
    """x to the rows (i, z0, z1, ...) of the task's Xᵀ(X Q), or, with ``gram``, of (X Q)ᵀ(X Q);
    the last column is the task's sum of squares of dimension i."""
    dim, width = block.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width if gram else dim, width + 1))
        for x in _matrices(batches, dim):
            c = centre(x)
            y = c @ block
            total[:, :width] += (y if gram else c).T @ y
            if not gram:
                total[:, width] += np.einsum("ij,ij->j", c, c)
        columns = [pa.array(np.arange(len(total))), *[pa.array(np.ascontiguousarray(z)) for z in total.T]]
        yield pa.RecordBatch.from_arrays(columns, ["i", *[f"z{j}" for j in range(width + 1)]])

    return run


def apply(fit: DataFrame, centre: Centre, block: np.ndarray, gram: bool = False) -> tuple[np.ndarray, float]:
    """V Q for the block Q, and the trace of V, by one pass over the fit list."""
    width = block.shape[1]
    kinds = ", ".join(["i long", *[f"z{j} double" for j in range(width + 1)]])
    parts = fit.mapInArrow(_pass(centre, block, gram), kinds)
    total = parts.groupBy("i").agg(*[F.sum(f"z{j}") for j in range(width + 1)]).collect()  # a row a dimension
    out = np.zeros((width if gram else len(block), width + 1))
    for row in total:
        out[row[0]] = row[1:]
    return out[:, :width] / centre.n, float(out[:, width].sum()) / centre.n


@dataclass
class Model:
    """Components as columns, their eigenvalues falling, and what certifies them."""

    centre: Centre
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residuals: np.ndarray
    rounds: int
    identity_error: float


def _ritz(block: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values (falling) and vectors of an orthonormal block, and their images."""
    small = block.T @ image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], block @ turn, image @ turn


def _filtered(product: Callable, block: np.ndarray, image: np.ndarray, below: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of V, scaled to 1 at ``top``, that is small on [0, below], times
    the block; ``image`` is V times the block."""
    half = below / 2
    sigma = first = half / (top - half)
    last, now = block, (image - half * block) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        last, now = now, (product(now) - half * now) * (2 * following / half) - sigma * following * last
        sigma = following
    return now


def fit_components(fit: DataFrame, dim: int, k: int = 16, seed: int = 12) -> Model:
    """The ``k`` largest eigenpairs of the covariance of the written fit list (x)."""
    middle, sums = centre(fit, dim)
    width = min(dim, k + GUARD)
    k = min(k, dim)
    block, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, width)))
    product = lambda q: apply(fit, middle, q)[0]
    image, trace = apply(fit, middle, block)
    best, rounds = np.inf, 0
    while True:
        values, block, image = _ritz(block, image)
        top = values[0]
        residuals = np.linalg.norm(image - block * values, axis=0)[:k]
        wanted = values[:k] > NOTHING * top
        worst = residuals[wanted].max(initial=0.0)
        if top <= 0 or worst <= TOLERANCE * top or (worst <= ROUNDING * top and worst > 0.5 * best):
            break
        if rounds == ROUNDS:
            raise ArithmeticError(f"no certified components: residual {worst:.3g} of {top:.3g} after {rounds} rounds")
        best, rounds = min(best, worst), rounds + 1
        below = max(values[-1], NOTHING * top)
        block, _ = np.linalg.qr(_filtered(product, block, image, below, top, DEGREE))
        image = product(block)
    vectors, values = block[:, :k][:, wanted & (top > 0)], values[:k][wanted & (top > 0)]
    error = 0.0
    if len(values):
        covariance, _ = apply(fit, middle, vectors / np.sqrt(values), gram=True)
        error = float(np.abs(covariance - np.eye(len(values))).max())
    return Model(middle, sums, vectors, values, trace, residuals, rounds, error)


def _project(model: Model) -> Callable:
    """(vec_id, x) to a row for each component."""
    dim, k = model.vectors.shape
    scaled = model.vectors / np.sqrt(model.values)
    n, share = model.centre.n, model.values / model.trace
    # n x - S in 64 bits: sums that fit come out right even where their parts wrap around
    s = np.array([(x + (1 << 63)) % (1 << 64) - (1 << 63) for x in model.sums], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            offsets = column.offsets.to_numpy().astype(np.int64)
            flat = column.values.to_numpy(zero_copy_only=False)
            for i in range(0, batch.num_rows, 4096):
                j = min(i + 4096, batch.num_rows)
                fits = np.diff(offsets[i : j + 1]) == dim
                some = np.flatnonzero(fits)
                x = flat[offsets[i + some][:, None] + np.arange(dim)]
                c = model.centre(x)
                with np.errstate(over="ignore"):
                    away = x * np.int64(n) - s
                    exact = (away * away).sum(axis=1)
                white, deviation, known = np.zeros((j - i, k)), np.zeros(j - i, np.int64), fits.copy()
                white[some], deviation[some] = c @ scaled, exact
                known[some] = ((c * float(n)) ** 2).sum(axis=1) < 2.0**63 * (1 - 1e-9)
                m = j - i
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, m).take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n, np.int64)),
                        pa.array(np.repeat(deviation, k), mask=np.repeat(~known, k)),
                        pa.array(white.ravel(), mask=np.repeat(~fits, k)),
                        pa.array(np.tile(share, m)),
                        pa.array(np.full(m * k, model.identity_error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def whiten(vectors: DataFrame, k: int = 16) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each usable row
    of ``vectors`` (vec_id, embedding) and each of the first ``k`` components."""
    kinds = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = staged(entries(vectors), "white-rows")
    length = rows.groupBy(F.size("x").alias("d")).count().where("d > 0").orderBy(F.desc("count"), F.desc("d")).first()
    if length is None:
        return vectors.sparkSession.createDataFrame([], kinds)
    fit = staged(rows.where(F.size("x") == length["d"]).select("x").distinct(), "white-fit")
    model = fit_components(fit, length["d"], k)
    if not len(model.values):
        return vectors.sparkSession.createDataFrame([], kinds)
    return rows.mapInArrow(_project(model), kinds)
