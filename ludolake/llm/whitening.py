"""Operator 11: whitening by Chebyshev-filtered subspace iteration.

Vectors are scaled to whole numbers (``floor(scale * entry)``). The *fit list* holds each distinct whole-number vector once, so
copies don't weigh more than their text. One pass gives its size, exact sums and exact squares. Then the leading
eigenvectors of its covariance come from passes over the stored list, each of which multiplies the centred
covariance with a block of ``block`` columns: every task centres its rows, adds up X^T (X Q), and the tasks'
products meet in about the square root of as many groups before the driver adds those.

One round of the iteration runs a scaled Chebyshev polynomial of the covariance over the block by the three-term
recurrence, which damps all of the spectrum below the block's smallest Ritz value, orthonormalises the result
(QR) and rotates it to Ritz vectors (Rayleigh-Ritz). It ends when the residual of each wanted pair certifies it:
an eigenvalue lies within ``||Vq - eq||`` of e, and q is as exact as that over the gap to the next Ritz value.
The driver holds matrices of dimension x block only.

Defined results: rows whose vector is null, empty or holds null, NaN or infinite entries are left out; a null key stays null;
repeated rows stay repeated and count once in the fit list. Directions without variance (below 1e-10 of the
largest) can't be whitened, so there may be fewer components than asked, and none for a single distinct vector;
with equal eigenvalues any orthonormal choice is right, and it's the same for all rows. An empty table gives no
rows. Only the key and the vector are read, so other columns may have any name. Vectors of different lengths are
an error, as are entries beyond 2^53 after scaling.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludolake.llm.common import stored
from ludolake.llm.vectors import floors, matrix, numeric, usable

BLOCK = 32           # columns that are iterated together: the wanted ones and guards
FIRST_DEGREE = 4     # of the polynomial, while the Ritz values are rough
MOST_DEGREE = 10
RESIDUAL = 2e-14     # of the largest eigenvalue, at which a pair is certified
STALLED = 1e-11      # residual that will do when rounding allows no better
ROUNDS = 200
FLAT = 1e-10         # of the largest eigenvalue, below which a direction has no variance


class Whitening(NamedTuple):
    n: int                      # distinct vectors
    sums: list[int]             # exact, by dimension
    trace: float
    axes: np.ndarray            # dimension x components, unit columns
    values: np.ndarray          # eigenvalues, falling
    residual: float             # the largest, in units of the largest eigenvalue
    passes: int
    identity_error: float


def _pack(whole: np.ndarray) -> pa.Array:
    """Each row as little-endian bytes of the narrowest width that holds it, so equal rows have equal bytes."""
    top = np.abs(whole).max(axis=1)
    kind = (top >= 2 ** 15).astype(int) + (top >= 2 ** 31)
    out: list[bytes | None] = [None] * len(whole)
    for k, width in enumerate(("<i2", "<i4", "<i8")):
        rows = np.flatnonzero(kind == k)
        raw, size = whole[rows].astype(width).tobytes(), whole.shape[1] * int(width[-1])
        for at, row in enumerate(rows.tolist()):
            out[row] = raw[at * size:(at + 1) * size]
    return pa.array(out, pa.binary())


def _unpack(column: pa.Array, dimension: int) -> np.ndarray:
    values = column.to_pylist()
    out = np.empty((len(values), dimension))
    sizes = np.array([len(v) // dimension for v in values])
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        out[rows] = np.frombuffer(b"".join([values[r] for r in rows.tolist()]), f"<i{size}").reshape(-1, dimension)
    return out


def _fit_list(df: DataFrame, vector: str, scale: float) -> DataFrame:
    def read(batches):
        for batch in batches:
            if batch.num_rows:
                values = floors(matrix(batch.column(0)), scale)
                yield pa.RecordBatch.from_arrays([_pack(values), pa.array([values.shape[1]] * len(values), pa.int32())],
                                                 names=["packed", "size"])

    rows = df.select(numeric(df, vector).alias("v")).filter(usable(F.col("v")))
    return stored(rows.mapInArrow(read, "packed binary, size int").distinct(), "fit_list")


class _Passes:
    """Passes over the stored fit list."""

    def __init__(self, fit: DataFrame, dimension: int):
        self.fit, self.dimension, self.groups, self.done = fit, dimension, 1, 0
        self.mean = np.zeros(dimension)

    def totals(self) -> tuple[int, list[int], int]:
        """Rows, exact sums by dimension, and the exact sum of all squares."""
        dimension = self.dimension

        def read(batches):
            n, sums, squares = 0, [0] * dimension, [0] * dimension
            for batch in batches:
                x = _unpack(batch.column(0), dimension)
                n += len(x)
                if len(x) and np.abs(x).max() < 2 ** 21:  # else sums of squares might round
                    whole = x.astype(np.int64)
                else:
                    whole = x.astype(np.int64).astype(object)
                sums = [a + int(b) for a, b in zip(sums, whole.sum(axis=0))]
                squares = [a + int(b) for a, b in zip(squares, (whole * whole).sum(axis=0))]
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(dimension), pa.int32()), pa.array([n] * dimension, pa.int64()),
                     *[pa.array([str(x) for x in column]) for column in (sums, squares)]], names=["i", "n", "s", "q"])

        whole = T.DecimalType(38, 0)
        rows = (self.fit.select("packed").mapInArrow(read, "i int, n long, s string, q string").groupBy("i")
                .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast(whole)).alias("s"),
                     F.sum(F.col("q").cast(whole)).alias("q"), F.count(F.lit(1)).alias("tasks")).orderBy("i").collect())
        n, sums = rows[0]["n"], [int(r["s"]) for r in rows]
        self.groups = 1 << max(1, int(np.ceil(np.log2(rows[0]["tasks"]) / 2)))
        self.mean = np.array([s / n for s in sums])
        return n, sums, sum(int(r["q"]) for r in rows)

    def added(self, of_batch, rows: int, columns: int) -> np.ndarray:
        """Sum of ``of_batch(centred rows)`` over all batches; matrices of rows x columns."""
        dimension, mean, groups = self.dimension, self.mean, self.groups

        def read(batches):
            total = np.zeros((rows, columns))
            for batch in batches:
                if batch.num_rows:
                    total += of_batch(_unpack(batch.column(0), dimension) - mean)
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([part % groups], pa.int32()), pa.array([part], pa.int32()),
                                              pa.array([total.tobytes()], pa.binary())], names=["cell", "part", "total"])

        def add(t: pa.Table) -> pa.Table:
            order = np.argsort(t["part"].to_numpy())
            raw = t["total"].to_pylist()
            total = sum((np.frombuffer(raw[i]) for i in order), np.zeros(rows * columns))
            return pa.table({"cell": t["cell"].slice(0, 1), "total": pa.array([total.tobytes()], pa.binary())})

        self.done += 1
        found = (self.fit.select("packed").mapInArrow(read, "cell int, part int, total binary")
                 .groupBy("cell").applyInArrow(add, "cell int, total binary").collect())
        return sum((np.frombuffer(r["total"]) for r in sorted(found, key=lambda r: r["cell"])),
                   np.zeros(rows * columns)).reshape(rows, columns)


def _ritz(basis: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values (falling), vectors and their images."""
    inner = basis.T @ image
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    return values, basis @ turn, image @ turn


def filtered(basis: np.ndarray, image: np.ndarray, times, degree: int, end: float, top: float) -> np.ndarray:
    """The scaled Chebyshev polynomial for [0, ``end``] applied to the basis, whose image is known already."""
    half = centre = end / 2
    first = scale = half / (centre - top)
    before, now = basis, (image - centre * basis) * (scale / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - scale)
        before, now = now, (times(now) - centre * now) * (2 * after / half) - (scale * after) * before
        scale = after
    return now


def subspace(times, dimension: int, components: int, block: int = BLOCK, seed: int = 11):
    """Leading eigenpairs of the symmetric non-negative matrix that ``times`` multiplies: values, vectors, residual."""
    block = min(dimension, max(block, 2 * components))
    basis, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(dimension, block)))
    values, basis, image = _ritz(basis, times(basis))
    best, waited, degree = np.inf, 0, FIRST_DEGREE
    for _ in range(ROUNDS):
        wanted = min(components, block)
        if values[0] <= 0:
            return values[:wanted], basis[:, :wanted], 0.0
        apart = np.linalg.norm(image - basis * values, axis=0)[:wanted] / values[0]
        worst = float(apart[values[:wanted] > FLAT * values[0]].max())
        waited = 0 if worst < best / 2 else waited + 1
        best = min(best, worst)
        if worst <= RESIDUAL or worst <= STALLED and waited >= 2 or block == dimension:
            return values[:wanted], basis[:, :wanted], worst
        end = max(values[-1], 1e-8 * values[0])
        grow = np.arccosh(max(1.0, 2 * max(values[wanted - 1], end) / end - 1))
        basis, _ = np.linalg.qr(filtered(basis, image, times, degree, end, values[0]))
        values, basis, image = _ritz(basis, times(basis))
        left = np.log(max(worst / RESIDUAL, 2.0))
        degree = int(np.clip(np.ceil(left / max(grow, 1e-3)), 2, MOST_DEGREE))
    raise RuntimeError(f"no certificate after {ROUNDS} rounds: residual {worst:.2g}")


def fit_whitening(df: DataFrame, vector: str = "embedding", components: int = 4, scale: float = 256,
                  block: int = BLOCK) -> Whitening | None:
    """The whitening of a table's vectors; None if it has none."""
    fit = _fit_list(df, vector, scale)
    sizes = fit.agg(F.min("size"), F.max("size")).first()
    if sizes[0] is None:
        return None
    if sizes[0] != sizes[1]:
        raise ValueError(f"vectors of different lengths: {sizes[0]} and {sizes[1]}")
    dimension = sizes[0]
    passes = _Passes(fit, dimension)
    n, sums, squares = passes.totals()
    trace = float((n * squares - sum(s * s for s in sums)) / (n * n)) if n else 0.0

    def times(q: np.ndarray) -> np.ndarray:
        return passes.added(lambda x: x.T @ (x @ q), dimension, q.shape[1]) / n

    if trace <= 0:
        return Whitening(n, sums, 0.0, np.zeros((dimension, 0)), np.zeros(0), 0.0, 0, 0.0)
    values, axes, residual = subspace(times, dimension, components, block)
    some = values > FLAT * values[0]
    values, axes = values[some], axes[:, some]
    projection = axes / np.sqrt(values)
    k = len(values)
    spread = passes.added(lambda x: (x @ projection).T @ (x @ projection), k, k) / n
    return Whitening(n, sums, trace, axes, values, residual, passes.done,
                     float(np.abs(spread - np.eye(k)).max()))


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of (n * x - S)^2 by row; None beyond the range of a long."""
    most = n * int(np.abs(x).max()) + max(abs(s) for s in sums)
    whole = x.astype(np.int64)
    if most * most * x.shape[1] >= 2 ** 63:
        whole = whole.astype(object)
    apart = n * whole - np.array(sums, dtype=whole.dtype)
    return [v if v < 2 ** 63 else None for v in map(int, (apart * apart).sum(axis=1))]


def whiten(df: DataFrame, model: Whitening | None, key: str = "vec_id", vector: str = "embedding",
           scale: float = 256) -> DataFrame:
    """Per usable row and component: key, component, whitened, explained, and the row's deviation from the mean.

    ``deviation`` is the exact sum of (n * x - S)^2 over the dimensions, null where it exceeds a long.
    """
    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("component", T.IntegerType()),
                           T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
                           T.StructField("explained", T.DoubleType())])
    rows = df.select(F.col(f"`{key}`"), numeric(df, vector).alias("v")).filter(usable(F.col("v")))
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], schema)
    k, mean = len(model.values), np.array([s / model.n for s in model.sums])
    projection, explained = model.axes / np.sqrt(model.values), model.values / model.trace

    def read(batches):
        for batch in batches:
            m = batch.num_rows
            if m:
                x = floors(matrix(batch.column(1)), scale)
                spread = (x - mean) @ projection
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(_deviations(x, model.n, model.sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                     pa.array(spread.ravel()), pa.array(np.tile(explained, m))], names=schema.names)

    return rows.mapInArrow(read, schema)
