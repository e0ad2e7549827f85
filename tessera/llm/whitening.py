"""Whitening of embeddings by a compensated covariance.

Entries become whole numbers, whose count and sums are exact.  A second scan
subtracts the mean, kept as a double-double, from each vector and accumulates
the outer products in double-double by error-free transformations; the high
and low parts of the tasks are merged group by group, so no task and no driver
gets more than GROUP matrices at once.  The covariance (one matrix of the
vectors' length) is solved by LAPACK's tridiagonal divide and conquer, and one
step of refinement in extended precision follows, so small eigenvalues beside
a very large one keep their digits.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import group_arrow, map_arrow
from .vectors import Outer, clean, matrix, two_sum

SCALE, SHIFT = 64, 1_000_000
#: Entries from here on have no whole number in 64 bits.
BEYOND = 2.0**55
#: Matrices that one task, or the driver, merges.
GROUP = 64
_MATRICES = "k long, high binary, low binary"


@dataclass
class Whitening:
    """A fit: whitened = (x - sums / n) @ axes, x the scaled entries."""

    n: int
    sums: list[int]
    mean: tuple[np.ndarray, np.ndarray]
    values: np.ndarray
    axes: np.ndarray
    explained: np.ndarray
    identity_error: float | None

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """x - sums / n as double-doubles."""
        h = x.astype(np.float64)
        rest = (x - h.astype(np.int64)).astype(np.float64)
        h, low = two_sum(h, -self.mean[0])
        return two_sum(h, low + (rest - self.mean[1]))

    def whitened(self, x: np.ndarray) -> np.ndarray:
        h, low = self.centred(x)
        return h @ self.axes + low @ self.axes

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n * x - sums)**2, exact; None beyond 64 bits."""
        h, _ = self.centred(x)
        small = ((h * self.n) ** 2).sum(axis=1) < 2.0**62
        small &= (np.abs(x) < 2.0**62 / max(self.n, 1)).all(axis=1)
        own = np.where(small[:, None], x, 0) * self.n - np.array([s if abs(s) < 1 << 63 else 0 for s in self.sums], np.int64)
        out: list = (np.where(small[:, None], own, 0) ** 2).sum(axis=1).tolist()
        for i in np.flatnonzero(~small).tolist():
            exact = sum((self.n * v - s) ** 2 for v, s in zip(x[i].tolist(), self.sums, strict=True))
            out[i] = exact if exact < 1 << 63 else None
        return out


def whole(vectors: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * vectors).astype(np.int64) + SHIFT


def _sums(rows: DataFrame, vector: str, dims: int) -> tuple[int, list[int]]:
    def run(batches):
        n, total = 0, [0] * dims
        for b in batches:
            x = whole(matrix(b.column(0), dims))
            n += len(x)
            safe = len(x) * float(np.abs(x).max(initial=0)) < 2.0**62
            own = x.sum(axis=0).tolist() if safe else [sum(c) for c in x.T.tolist()]
            total = [s + o for s, o in zip(total, own, strict=True)]
        yield pa.RecordBatch.from_pydict({"pos": list(range(-1, dims)), "s": [str(v) for v in (n, *total)]})

    found = map_arrow(rows.select(vector), run, "pos long, s string").groupBy("pos").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    got = {r.pos: int(r.s) for r in found.collect()}
    return got.get(-1, 0), [got.get(i, 0) for i in range(dims)]


def _outer(rows: DataFrame, vector: str, dims: int, size: int, centred) -> np.ndarray:
    """The sum over rows of the outer products of what centred() gives (high
    and low parts, `size` columns), as extended-precision numbers."""

    def run(batches):
        own = Outer(size)
        for b in batches:
            own.rows(*centred(whole(matrix(b.column(0), dims))))
        yield pa.RecordBatch.from_pydict(own.row(TaskContext.get().partitionId()))

    def merge(key, table):
        out = Outer.merged(size, table.column("high").to_pylist(), table.column("low").to_pylist())
        return pa.Table.from_pydict(out.row(key[0].as_py()))

    rows = rows.select(vector)
    found, tasks = map_arrow(rows, run, _MATRICES), rows.rdd.getNumPartitions()
    while tasks > GROUP:
        found = group_arrow(found.withColumn("k", F.expr(f"k div {GROUP}")), merge, _MATRICES, by="k")
        tasks = -(-tasks // GROUP)
    got = found.collect()
    out = Outer.merged(size, [bytes(r.high) for r in got], [bytes(r.low) for r in got])
    return out.high.astype(np.longdouble) + out.low


def solve(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix of extended precision, falling, and
    unit eigenvectors as columns: LAPACK's divide and conquer on doubles, then
    one step that corrects values and vectors by the residual."""
    _, q = np.linalg.eigh(v.astype(np.float64))
    q = q[:, ::-1].astype(np.longdouble)
    for _ in range(2):
        r, s = np.eye(len(q)) - q.T @ q, q.T @ v @ q
        e = np.diag(s) / (1 - np.diag(r))
        gap = e[None, :] - e[:, None]
        near = np.abs(gap) <= 1e-12 * max(abs(e).max(), np.longdouble(1e-300))  # of one multiple value: any basis
        step = np.where(near, r / 2, (s + r * e[None, :]) / np.where(near, 1, gap))
        q = q + q @ step
    order = np.argsort(-e, kind="stable")
    q = q[:, order] / np.sqrt((q[:, order] ** 2).sum(axis=0))
    return e[order].astype(np.float64), q.astype(np.float64)


def fit(rows: DataFrame, vector: str, dims: int, components: int) -> Whitening | None:
    """The whitening of clean vectors of one length; None without any."""
    n, sums = _sums(rows, vector, dims)
    if not n:
        return None
    means = [Fraction(s, n) for s in sums]
    high = np.array([float(m) for m in means])
    low = np.array([float(m - Fraction(h)) for m, h in zip(means, high.tolist(), strict=True)])
    model = Whitening(n, sums, (high, low), np.zeros(0), np.zeros((dims, 0)), np.zeros(0), None)
    v = _outer(rows, vector, dims, dims, model.centred) / n
    values, q = solve(v)
    k = min(components, dims)
    real = values[:k] > max(values[0], 0.0) * dims * 2.0**-60
    model.values = np.where(real, values[:k], 0.0)
    model.axes = np.where(real, q[:, :k] / np.sqrt(np.where(real, values[:k], 1.0)), 0.0)
    trace = float(np.trace(v))
    model.explained = values[:k] / trace if trace > 0 else np.full(k, np.nan)
    if real.any():
        axes = model.axes[:, real]

        def again(x):
            h, rest = model.centred(x)
            w = h @ axes + rest @ axes
            return np.hstack([w, np.ones((len(w), 1))]), np.zeros((len(w), axes.shape[1] + 1))

        # The column of ones gives the mean, which is taken off; being 1e-13
        # or so, its square does not reach the digits of the covariance.
        o = _outer(rows, vector, dims, axes.shape[1] + 1, again) / n
        off = o[:-1, :-1] - np.outer(o[:-1, -1], o[:-1, -1]) - np.eye(axes.shape[1])
        model.identity_error = float(np.abs(off).max())
    return model


def whiten(rows: DataFrame, components: int = 32, vector: str = "embedding") -> DataFrame:
    """rows with `n`, `deviation`, and arrays `whitened` and `explained` of
    the first components (fewer if vectors are shorter), and `identity_error`.

    Dropped are rows whose vector is null, has a null or non-finite entry or
    one of 2**55 and more (its whole number has over 64 bits), or another
    length than most (ties: the longer one).  Repeated rows count each for
    itself.  A component without variance (fewer rows than dimensions, equal
    vectors) has null in `whitened`; eigenvalues of equal size keep LAPACK's
    order.  A deviation of more than 64 bits is null.  An empty table, or one
    where all rows are dropped, gives no rows.  Columns of rows named like a
    new one are replaced.
    """
    new = "n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    names = [x.split()[0] for x in new.split(", ")]
    rows = rows.drop(*names).filter(clean(vector, BEYOND))
    most = rows.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dims = most.d if most else 0
    rows = rows.filter(F.size(vector) == dims)
    model = fit(rows, vector, dims, components) if dims else None
    packed = rows.select(F.struct("*").alias("row"), F.col(vector).alias("v"))
    schema = StructType([packed.schema["row"], *StructType.fromDDL(new).fields])

    def run(batches):
        for b in batches:
            if not b.num_rows or model is None:
                continue
            x = whole(matrix(b.column(1), dims))
            k = len(model.values)
            live = np.broadcast_to(model.values > 0, (len(x), k)).ravel()
            flat = pa.array(model.whitened(x).ravel(), mask=~live)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * k)
            shares = pa.ListArray.from_arrays(offsets, pa.array(np.tile(model.explained, len(x)), from_pandas=True))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([model.n] * len(x), pa.int64()), pa.array(model.deviations(x), pa.int64()), pa.ListArray.from_arrays(offsets, flat), shares, pa.array([model.identity_error] * len(x), pa.float64())],
                ["row", *names],
            )

    return map_arrow(packed, run, schema).select("row.*", *names)


def op12_whitening(spark: SparkSession, sf_dir: str, components: int = 32) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    each = whiten(rows, components).select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("p", "c"))
    return each.select("vec_id", (F.col("p") + 1).alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")
