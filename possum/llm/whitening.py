"""Embedding whitening by spectrum slicing (operator 11).

A vector's entries become integers ``x = floor(1024 * c) + 100000``.  Spark
adds up, in three passes over the vectors, their number and sums (exact), the
covariance of the centred entries (one d x d partial per task, added row by
row in Spark), and at last the covariance of the whitened values, which
measures the result.

The driver gets the d x d covariance only, and finds its leading eigenpairs:

* the inertia of ``V - s I = P' L D L' P`` (Bunch-Kaufman pivots) counts the
  eigenvalues above a shift ``s``; bisection with these counts isolates each
  of the leading ones;
* inverse iteration and Rayleigh quotient iteration converge to the pair in
  the interval; a value outside it halves the interval and tries again;
* counts just below and just above each value found certify its number.

An interval that cannot be split further holds equal eigenvalues; their
vectors are an orthonormal basis of their space.

Defined results: a row whose vector is null or holds a null, a non-finite
entry, or one whose x does not fit 64 bits is dropped; so are vectors of
another length than the most frequent one (ties: the longer).  Directions
without variance (an eigenvalue within rounding of 0) are no components: a
table of equal vectors, or an empty one, gives no rows, and n vectors at most
n - 1 components.  A deviation beyond 64 bits is null.  Null and repeated ids
are kept.  Only the id and the vector are read, so other columns change
nothing.  An eigenvector's sign is the one that makes its largest entry positive.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

COMPONENTS = 8
SCALE = 1024
OFFSET = 100_000
_EPS = float(np.finfo(np.float64).eps)
_PIVOT = (1 + math.sqrt(17)) / 8
_LONG = 2**63 - 1


# --- eigenpairs of a symmetric matrix ---

def inertia(matrix: np.ndarray) -> tuple[int, int, int]:
    """Numbers of positive, negative and zero eigenvalues, from an LDL' factorisation."""
    a = np.array(matrix, dtype=np.float64)
    n = len(a)
    up = down = none = 0
    k = 0

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j], k:] = a[[j, i], k:]
            a[k:, [i, j]] = a[k:, [j, i]]

    while k < n:
        here = abs(a[k, k])
        below = np.abs(a[k + 1:, k])
        largest = float(below.max()) if len(below) else 0.0
        if here == 0 and largest == 0:
            none += 1
            k += 1
            continue
        size = 1
        if here < _PIVOT * largest:
            r = k + 1 + int(below.argmax())
            row = np.abs(a[r, k:])
            row[r - k] = 0
            beside = float(row.max())
            if here * beside < _PIVOT * largest * largest:
                if abs(a[r, r]) >= _PIVOT * beside:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    size = 2
        rest = k + size
        if size == 1:
            pivot = a[k, k]
            up, down = up + (pivot > 0), down + (pivot < 0)
            a[rest:, rest:] -= np.outer(a[rest:, k] / pivot, a[rest:, k])
        else:  # such a block has one eigenvalue of each sign
            up, down = up + 1, down + 1
            block = a[rest:, k:rest]
            a[rest:, rest:] -= block @ np.linalg.solve(a[k:rest, k:rest], block.T)
        k = rest
    return up, down, none


class Slicer:
    """Leading eigenpairs of a symmetric positive semidefinite matrix of trace 1."""

    def __init__(self, matrix: np.ndarray):
        self.a = matrix
        self.d = len(matrix)
        self.one = np.eye(self.d)
        self.tolerance = 16 * self.d * _EPS
        self.counts: dict[float, int] = {}

    def above(self, shift: float) -> int:
        """How many eigenvalues exceed ``shift``."""
        if shift not in self.counts:
            self.counts[shift] = inertia(self.a - shift * self.one)[0]
        return self.counts[shift]

    def bracket(self, k: int) -> tuple[float, float]:
        """The narrowest shifts known around the k-th largest eigenvalue."""
        low, high = -self.tolerance, 1 + self.tolerance
        for shift, count in self.counts.items():
            if count >= k:
                low = max(low, shift)
            else:
                high = min(high, shift)
        return low, high

    def _solve(self, shift: float, right: np.ndarray) -> np.ndarray | None:
        try:
            got = np.linalg.solve(self.a - shift * self.one, right)
        except np.linalg.LinAlgError:
            return None
        return got if np.isfinite(got).all() else None

    def _inverse(self, shift: float, block: np.ndarray, steps: int = 3) -> np.ndarray:
        """Orthonormal columns after some steps of inverse iteration."""
        for _ in range(steps):
            got = self._solve(shift, block)
            while got is None:  # exactly an eigenvalue
                shift += self.tolerance / 4
                got = self._solve(shift, block)
            block = np.linalg.qr(got)[0]
        return block

    def _refine(self, vector: np.ndarray) -> tuple[float, np.ndarray]:
        """Rayleigh quotient iteration, until the residual stops falling."""
        value = float(vector @ self.a @ vector)
        left = float(np.linalg.norm(self.a @ vector - value * vector))
        for _ in range(30):
            got = self._solve(value, vector)
            if got is None:  # exactly an eigenvalue: a step beside it still turns the vector
                got = self._solve(value + self.tolerance / 4, vector)
            if got is None:
                break
            new = got / np.linalg.norm(got)
            new_value = float(new @ self.a @ new)
            new_left = float(np.linalg.norm(self.a @ new - new_value * new))
            if new_left >= left and left <= self.tolerance:
                break
            vector, value, left = new, new_value, new_left
        return value, vector

    def leading(self, many: int) -> tuple[np.ndarray, np.ndarray]:
        """The largest eigenvalues, falling, and their unit vectors as columns."""
        rng = np.random.default_rng(20240103)
        values: list[float] = []
        vectors = np.zeros((self.d, 0))
        many = min(many, self.d)
        while len(values) < many:
            k = len(values) + 1
            low, high = self.bracket(k)
            if self.above(low) < k:  # rounding around 0
                low = -1.0
            found = None
            while found is None:
                if high - low <= self.tolerance:
                    # Equal eigenvalues: all of them at once.
                    size = max(1, self.above(low) - len(values))
                    block = rng.standard_normal((self.d, size))
                    block -= vectors @ (vectors.T @ block)
                    found = self._inverse((low + high) / 2, block)
                    break
                if self.above(low) == k and self.above(high) == k - 1:
                    start = self._inverse((low + high) / 2, rng.standard_normal((self.d, 1)))
                    value, vector = self._refine(start[:, 0])
                    if low < value <= high:
                        found = vector[:, None]
                        break
                middle = (low + high) / 2
                low, high = (middle, high) if self.above(middle) >= k else (low, middle)
            for column in found.T:
                for _ in range(2):
                    column = column - vectors @ (vectors.T @ column)
                    column = column / np.linalg.norm(column)
                values.append(float(column @ self.a @ column))
                vectors = np.column_stack([vectors, column])
        order = np.argsort(-np.array(values), kind="stable")
        return np.array(values)[order][:many], vectors[:, order][:, :many]

    def certify(self, values: np.ndarray) -> None:
        """Counts beside each value must agree with its number."""
        for k, value in enumerate(values, 1):
            if not (self.above(value + 2 * self.tolerance) < k
                    <= self.above(value - 2 * self.tolerance)):
                raise ArithmeticError(f"eigenvalue {k} is not the {k}-th largest")


def leading_pairs(covariance: np.ndarray, many: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues that differ from 0 and their vectors as columns, largest first."""
    trace = float(np.trace(covariance))
    if not trace > 0:
        return np.zeros(0), np.zeros((len(covariance), 0))
    slicer = Slicer((covariance + covariance.T) / (2 * trace))
    values, vectors = slicer.leading(many)
    slicer.certify(values)
    real = values > 4 * slicer.tolerance
    values, vectors = values[real], vectors[:, real]
    turn = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values * trace, vectors * turn


# --- passes over the vectors ---

@dataclass(frozen=True)
class Fit:
    """Number of vectors and exact sums of their x."""

    n: int
    sums: tuple[int, ...]

    def moved(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S`` per entry, exact (Python integers where 64 bits may not do)."""
        most = max([abs(s) for s in self.sums] + [0])
        if len(x) and self.n * max(abs(int(x.max())), abs(int(x.min()))) + most <= _LONG:
            return x * self.n - np.array(self.sums, dtype=np.int64)
        return x.astype(object) * self.n - np.array(self.sums, dtype=object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n`` as doubles."""
        return (self.moved(x) / self.n).astype(np.float64)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        moved = self.moved(x)
        if moved.dtype != object and moved.size:
            if moved.shape[1] * int(np.abs(moved).max()) ** 2 <= _LONG:
                return (moved * moved).sum(axis=1).tolist()
            moved = moved.astype(object)
        return [s if s <= _LONG else None for s in (moved * moved).sum(axis=1).tolist()]


def _matrices(batches: Iterator[pa.RecordBatch], d: int,
              rows: int = 4096) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, x) of a few thousand vectors at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            c = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            yield part.column(0), np.floor(c * SCALE).astype(np.int64).reshape(-1, d) + OFFSET


def _sums(d: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * d
        for _, x in _matrices(batches, d):
            n += len(x)
            wide = len(x) * max(abs(int(x.max())), abs(int(x.min()))) > _LONG
            new = (x.astype(object) if wide else x).sum(axis=0).tolist()
            sums = [a + int(b) for a, b in zip(sums, new)]
        if n:
            with decimal.localcontext() as exact:
                exact.prec = 40
                yield pa.record_batch([pa.array([n], pa.int64()), pa.array(
                    [[decimal.Decimal(s) for s in sums]], pa.list_(pa.decimal128(38, 0)))],
                    ["n", "sums"])
    return run


def _products(fit: Fit) -> Callable:
    """Row by row, the task's part of the sum of products of centred entries."""
    d = len(fit.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for _, x in _matrices(batches, d):
            y = fit.centred(x)
            total += y.T @ y
        if total.any():
            yield pa.record_batch([pa.array(np.arange(d, dtype=np.int32)),
                                   pa.array([row.tobytes() for row in total], pa.binary())],
                                  ["i", "row"])
    return run


def _add_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, row in zip(batch.column(0).to_pylist(), batch.column(1)):
            got = np.frombuffer(row.as_py(), dtype=np.float64)
            total[i] = total[i] + got if i in total else got
    if total:
        yield pa.record_batch([pa.array(list(total), pa.int32()),
                               pa.array([r.tobytes() for r in total.values()], pa.binary())],
                              ["i", "row"])


def _moments(fit: Fit, whiten: np.ndarray) -> Callable:
    """The task's part of the sums and products of the whitened values."""
    d, m = whiten.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((m + 1, m))
        for _, x in _matrices(batches, d):
            w = fit.centred(x) @ whiten
            total[:m] += w.T @ w
            total[m] += w.sum(axis=0)
        i, j = np.divmod(np.arange(total.size, dtype=np.int32), np.int32(m))
        yield pa.record_batch([pa.array(i), pa.array(j), pa.array(total.ravel())], ["i", "j", "v"])
    return run


def _rows(fit: Fit, whiten: np.ndarray, explained: np.ndarray, error: float, id_type: pa.DataType,
          names: list[str]) -> Callable:
    d, m = whiten.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _matrices(batches, d):
            n = len(x)
            yield pa.record_batch([
                ids.take(pa.array(np.repeat(np.arange(n), m))).cast(id_type),
                pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), n)),
                pa.array(np.full(n * m, fit.n, dtype=np.int64)),
                pa.array(fit.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(n), m))),
                pa.array((fit.centred(x) @ whiten).ravel()),
                pa.array(np.tile(explained, n)),
                pa.array(np.full(n * m, error)),
            ], names)
    return run


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """id, component, n, deviation, whitened, explained, identity_error: one row per
    usable vector and component."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = vectors.sparkSession
    ship(spark)
    limit = float(2**63 // SCALE - OFFSET)
    usable = vectors.select(F.col(id_col).alias(id_col), F.col(vector_col).alias("_c")).where(
        F.col("_c").isNotNull() & F.forall("_c", lambda c: F.coalesce(
            F.abs(c.cast("double")) < limit, F.lit(False))))
    id_type = usable.schema[id_col].dataType
    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    schema = (f"`{id_col}` {id_type.simpleString()}, component int, n bigint, deviation bigint,"
              " whitened double, explained double, identity_error double")
    length = (usable.groupBy(F.size("_c").alias("d")).count()
              .orderBy(F.desc("count"), F.desc("d")).first())
    d = length["d"] if length else 0
    if not d:
        return spark.createDataFrame([], schema)
    usable = usable.where(F.size("_c") == d)

    sums = usable.mapInArrow(_sums(d), "n bigint, sums array<decimal(38,0)>")
    found = (sums.select("n", F.posexplode("sums").alias("i", "s")).groupBy("i")
             .agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect())
    fit = Fit(found[0]["n"], tuple(int(r["s"]) for r in found))

    partial = usable.mapInArrow(_products(fit), "i int, row binary")
    added = partial.repartitionById(min(d, 64), F.col("i") % min(d, 64)).mapInArrow(
        _add_rows, "i int, row binary")
    covariance = np.zeros((d, d))
    for r in added.collect():  # d rows of d numbers
        covariance[r["i"]] = np.frombuffer(r["row"]) / fit.n
    values, axes = leading_pairs(covariance, components)
    if not len(values):
        return spark.createDataFrame([], schema)
    to_white = axes / np.sqrt(values)

    m = len(values)
    moments = np.zeros((m + 1, m))
    for r in (usable.mapInArrow(_moments(fit, to_white), "i int, j int, v double")
              .groupBy("i", "j").agg(F.sum("v").alias("v")).collect()):
        moments[r["i"], r["j"]] = r["v"] / fit.n
    white = moments[:m] - np.outer(moments[m], moments[m])
    error = float(np.abs(white - np.eye(m)).max())
    explained = values / np.trace(covariance)
    return usable.mapInArrow(
        _rows(fit, to_white, explained, error, to_arrow_type(id_type), names), schema)
