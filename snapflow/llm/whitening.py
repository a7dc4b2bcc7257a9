"""Whitening of embeddings: exact integer sums, a distributed covariance, eigenvectors refined beyond their first precision.

The covariance of the distinct vectors is added up in tasks, a matrix per input split.  Its eigenvectors are first
found in float32 and then corrected, Ogita and Aishima's way, by matrix products in extended precision: from the residuals
I - X'X and X'AX every eigenvector gets a correction, and errors are squared in every round.  Eigenvalues that lie closer
than the residuals can tell apart form a cluster; its vectors are only made orthogonal by that correction, and a small
eigenproblem in the cluster's own subspace, shifted by the cluster's mean so that no digits are lost, turns them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written
from .vectors import matrix, pack_integers, unpack_integers, usable

HIGHER = np.longdouble
ROUNDS = 40
TIED = 1e-10  # eigenvalues that differ by less, relative to the largest, are always solved together
EDGE = 1 << 62


def first_eigenvectors(a: np.ndarray) -> np.ndarray:
    """In float32, whatever the size of the numbers."""
    return np.linalg.eigh(a.astype(np.float32))[1].astype(HIGHER)


def _clusters(values: np.ndarray, close) -> list[np.ndarray]:
    """Places of eigenvalues that follow each other within ``close``, two or more together."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > close) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def _turned(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The basis x of a cluster turned to eigenvectors of a within it."""
    t = x.T @ (a @ x)
    t = (t + t.T) / 2
    t = t - np.eye(len(t), dtype=HIGHER) * (np.trace(t) / len(t))
    size = np.abs(t).max()
    if size == 0 or np.abs(t - np.diag(np.diag(t))).max() <= 1e-19 * np.abs(a).max():
        return x
    return x @ np.linalg.eigh((t / size).astype(np.float64))[1].astype(HIGHER)


def eigenpairs(a: np.ndarray, start=first_eigenvectors) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, to double precision.

    Of either sign, the one whose largest entry is positive.  Vectors of equal eigenvalues are some orthonormal basis.
    """
    dim = len(a)
    size = np.abs(a).max(initial=0.0)
    if not size:
        return np.zeros(dim), np.eye(dim)
    a = np.asarray(a, HIGHER) / HIGHER(size)
    a = (a + a.T) / 2
    x, one = start(a), np.eye(dim, dtype=HIGHER)
    norm = np.sqrt((a * a).sum())
    best = np.inf
    for _ in range(ROUNDS):
        r, s = one - x.T @ x, x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        close = 2 * (np.sqrt(((s - np.diag(values)) ** 2).sum()) + norm * np.sqrt((r * r).sum()))
        close = max(close, TIED * norm)
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > close  # never of the diagonal
        # half of the residual, and a turn that is exactly antisymmetric, so that rounding does not undo orthogonality
        turn = (s + (values[None, :] + values[:, None]) / 2 * r) / np.where(apart, gap, 1)
        step = r / 2 + np.where(apart, turn, 0)
        x = x + x @ step
        for c in _clusters(values, close):
            x[:, c] = _turned(a, x[:, c])
        change = np.abs(step).max()
        if change < 1e-18 or (change < 1e-15 and change >= best):
            break
        best = change
    x = x / np.sqrt((x * x).sum(0))
    values = (x * (a @ x)).sum(0)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    x = x * np.sign(x[np.abs(x).argmax(0), np.arange(dim)])
    return (values[order] * size).astype(np.float64), x.astype(np.float64)


@dataclass
class Whitening:
    """What every task needs to know; its size is that of a few vectors."""

    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray  # of the components that are returned, falling
    vectors: np.ndarray
    explained: list[float | None]
    known: np.ndarray  # components whose eigenvalue is not zero

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates; a component without variance has 0 here."""
        centred = x.astype(np.float64) - self.mean
        return (centred @ self.vectors) * np.where(self.known, 1 / np.sqrt(np.where(self.known, self.values, 1)), 0)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)**2 of each row, exactly; None beyond 64 bits."""
        n, s = self.n, np.array(self.sums, object)
        large = int(max(x.max(initial=0), -int(x.min(initial=0))))
        largest_sum = max(map(abs, self.sums), default=0)
        if x.shape[1] * large * large < EDGE and x.shape[1] * large * largest_sum < EDGE and largest_sum < EDGE:
            squares, mixed = (x * x).sum(1), x @ np.array(self.sums, np.int64)
            exact = n * n * squares.astype(object) - 2 * n * mixed.astype(object) + int((s * s).sum())
        else:
            exact = ((n * x.astype(object) - s) ** 2).sum(1)
        return [int(d) if d < 1 << 63 else None for d in exact]


def integers(vector: np.ndarray, factor: int) -> np.ndarray:
    """floor(factor * c); numbers beyond 64 bits take the nearest that is within."""
    return np.clip(np.floor(vector * factor), -(2.0**63), 2.0**63 - 1024).astype(np.int64)


def _totals(fit: DataFrame, dim: int, cells: int, of) -> np.ndarray:
    """The sum over the table of ``of(x)``, an array of so many doubles for a matrix of vectors; a partial sum per split."""

    def add(batches):
        total = np.zeros(cells)
        for batch in batches:
            total += of(unpack_integers(batch.column("x"), dim))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells), pa.int32()), pa.array(total)], ["cell", "value"])

    found = fit.mapInArrow(add, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(cells)
    out[found.column("cell").to_numpy()] = found.column("value").to_numpy()
    return out


def _exact_sums(fit: DataFrame, dim: int) -> list[int]:
    """Per dimension; high and low halves apart, so that nothing overflows."""

    def add(batches):
        high, low = np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for batch in batches:
            x = unpack_integers(batch.column("x"), dim)
            high += (x >> 32).sum(0)
            low += (x & 0xFFFFFFFF).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim), pa.int32()), pa.array(high), pa.array(low)], ["j", "high", "low"])

    whole = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    rows = fit.mapInArrow(add, "j int, high bigint, low bigint").groupBy("j").agg(*whole).collect()
    out = [0] * dim
    for r in rows:
        out[r.j] = (int(r.high) << 32) + int(r.low)
    return out


def fit_whitening(fit: DataFrame, n: int, dim: int, components: int) -> Whitening:
    """The transform of a table of distinct packed vectors ``x``."""
    sums = _exact_sums(fit, dim)
    mean = np.array([float(s / n) for s in sums])
    upper = np.triu_indices(dim)

    def products(x):
        centred = x.astype(np.float64) - mean
        return (centred.T @ centred)[upper]

    v = np.zeros((dim, dim))
    v[upper] = _totals(fit, dim, len(upper[0]), products) / n
    v = np.triu(v) + np.triu(v, 1).T
    values, vectors = eigenpairs(v)
    trace = float(np.trace(v))
    k = min(components, dim)
    known = values[:k] > 16 * dim * np.finfo(float).eps * max(values[0], 0.0)
    explained = [float(e) / trace if trace > 0 else None for e in np.where(known, values[:k], 0.0)]
    return Whitening(n, sums, mean, values[:k], vectors[:, :k], explained, known)


def identity_error(fit: DataFrame, model: Whitening, dim: int) -> float | None:
    """The largest entry, in absolute value, of the whitened coordinates' covariance minus the identity."""
    k = int(model.known.sum())
    if not k:
        return None

    def moments(x):
        z = model.project(x)[:, model.known]
        return np.concatenate([z.sum(0), (z.T @ z).ravel()])

    total = _totals(fit, dim, k + k * k, moments) / model.n
    covariance = total[k:].reshape(k, k) - np.outer(total[:k], total[:k])
    return float(np.abs(covariance - np.eye(k)).max())


RESULT = "id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", factor: int = 256, components: int = 4
) -> DataFrame:
    """id, component (from 1), n, deviation, whitened, explained and identity_error of every row and leading component.

    x = floor(factor * c) of every entry c, as double.  The transform is fitted on each distinct x vector once: n vectors
    with sums S.  deviation is the exact sum of (n x - S)**2, null where it passes 64 bits.  whitened is (x - S / n)
    projected on the component, divided by the root of its eigenvalue; a component without variance (one vector, fewer
    dimensions or vectors than components) has null there and 0 explained (null if nothing varies at all).
    identity_error is one value for all rows, over the components with variance; null if there are none.

    Rows with a null vector or an entry that is null or not finite are left out; repeated and null ids are kept row by
    row.  A vector that is shorter than others counts as filled up with zeros; with fewer dimensions than components
    there is a row per dimension.  An empty table gives an empty result; other columns are left behind.  The driver holds one
    matrix of dimension x dimension.
    """
    given = vectors.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v")
    )

    def pack(batches):
        for batch in batches:
            batch = batch.filter(pa.array(usable(batch.column("v"))))
            v = batch.column("v")
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), v.value_lengths().cast(pa.int32()), pack_integers(integers(matrix(v), factor))], ["id", "size", "x"]
            )

    rows = written(given.mapInArrow(pack, "id bigint, size int, x binary"), "integer_vectors")
    fit = written(rows.select("x").distinct(), "distinct_vectors")
    n, dim = fit.count(), rows.agg(F.max("size")).first()[0] or 0
    if not n or not dim:
        return rows.where("false").selectExpr(*[f"CAST(NULL AS {kind}) AS {name}" for name, kind in map(str.split, RESULT.split(", "))]).withColumnRenamed("id", id_col)
    model = fit_whitening(fit, n, dim, components)
    error = identity_error(fit, model, dim)

    def transform(batches):
        k = len(model.values)
        for batch in batches:
            x = unpack_integers(batch.column("x"), dim)
            size = len(x)
            z = pa.array(model.project(x).ravel(), mask=np.tile(~model.known, size))
            rows = np.repeat(np.arange(size), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1), size), pa.int32()),
                    pa.array(np.full(size * k, n)), pa.array(model.deviations(x), pa.int64()).take(pa.array(rows)), z,
                    pa.array(model.explained * size, pa.float64()), pa.array([error] * (size * k), pa.float64()),
                ],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.select("id", "x").mapInArrow(transform, RESULT).withColumnRenamed("id", id_col)
