"""Columns of vectors as numpy matrices, and sums that lose nothing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def clean(vector: str, below: float) -> Column:
    """True for vectors without null, NaN, infinite or larger entries than
    `below`; false for null vectors too."""
    return F.coalesce(F.col(vector).isNotNull() & F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < below), F.lit(False))), F.lit(False))


def matrix(col: pa.Array, dims: int) -> np.ndarray:
    """A column of clean vectors of one length as doubles."""
    return np.asarray(col.flatten().cast(pa.float64())).reshape(len(col), dims)


def lengths(col: pa.Array) -> np.ndarray:
    return np.asarray(pc.list_value_length(col), np.int64)


def two_sum(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """a + b as its rounded value and the exact rest."""
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def slices(h: np.ndarray, low: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The double-doubles h + low, column by column, as sums of whole numbers
    of at most `bits` bits times a power of two, until nothing is left."""
    top = np.abs(h).max(axis=0)
    step = np.exp2(np.ceil(np.log2(np.where(top > 0, top, 1.0))) - bits)
    out = []
    while len(out) < 6 and (h.any() or low.any()):
        whole = np.rint(h / step)
        out.append((whole, step))
        h, low = two_sum(h - whole * step, low)
        step = step * 2.0**-bits
    return out


class Outer:
    """The sum of outer products of rows, in double-double.

    Rows are split without error into slices so narrow that the products of a
    block of them add up exactly in a double (so BLAS may add them in any
    order); the exact matrices are added by error-free transformations.
    """

    BLOCK = 1024
    BITS = (53 - 10) // 2

    def __init__(self, dims: int) -> None:
        self.high, self.low = np.zeros((dims, dims)), np.zeros((dims, dims))

    def plus(self, high: np.ndarray, low: np.ndarray | float = 0.0) -> None:
        self.high, rest = two_sum(self.high, high)
        self.high, self.low = two_sum(self.high, self.low + rest + low)

    def rows(self, h: np.ndarray, low: np.ndarray) -> None:
        for at in range(0, len(h), self.BLOCK):
            parts = slices(h[at : at + self.BLOCK], low[at : at + self.BLOCK], self.BITS)
            for i, (a, p) in enumerate(parts):
                for j, (b, q) in enumerate(parts[: i + 1]):
                    product = (a.T @ b) * np.outer(p, q)
                    self.plus(product)
                    if i != j:
                        self.plus(product.T)

    def row(self, key: int) -> dict:
        return {"k": [key], "high": [self.high.tobytes()], "low": [self.low.tobytes()]}

    @classmethod
    def merged(cls, dims: int, highs: list[bytes], lows: list[bytes]) -> Outer:
        out = cls(dims)
        for h, x in zip(highs, lows, strict=True):
            out.plus(np.frombuffer(h).reshape(dims, dims), np.frombuffer(x).reshape(dims, dims))
        return out
