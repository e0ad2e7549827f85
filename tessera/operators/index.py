"""Retrieval by an inverted file of centroids, with exact rescoring.

Centroids are fitted on a bounded sample and every row is filed under its
nearest one; a query looks through the rows of its nearest centroids, whose
number is the least that finds the wanted share of the sample's true
neighbours.  Rows meet queries in blocks of bounded size, and of each block
only a query's best rows leave the task, so no table of all scores is made.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of the sample that centroids are fitted on, those of it that ask for
#: the number of cells to look through, and the most centroids.
SAMPLE, ASKED, CELLS = 8192, 512, 4096
#: Rows and queries that meet in a task.
CHUNK, BLOCK = 4096, 1024


@dataclass
class Index:
    """centroids, a row each, and how many of them a query looks through."""

    centroids: np.ndarray
    probes: int

    def cells(self, v: np.ndarray, n: int) -> np.ndarray:
        """The n nearest centroids of each row, nearest first."""
        return np.argsort(-(v @ self.centroids.T), axis=1, kind="stable")[:, :n]


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-300)


def fit(rows: DataFrame, key: str, vector: str, k: int = 10, recall: float = 0.97, sample: int = SAMPLE, rounds: int = 12) -> Index:
    """An index fitted on at most `sample` rows, those with the least hash of
    their key; a square root of all rows' number of centroids, CELLS at most.
    Rows without a vector are left out."""
    rows = rows.filter(F.col(vector).isNotNull())
    n = rows.count()
    got = rows.orderBy(F.xxhash64(key), key).limit(sample).select(vector).collect()
    if not got:
        return Index(np.zeros((1, 1)), 1)
    x = np.array([r[0] for r in got], np.float64)
    c = _unit(x[: max(1, min(CELLS, math.isqrt(n), len(x) // 4))].copy())
    for _ in range(rounds):  # Lloyd's steps on directions
        near = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, _unit(x))
        c = np.where(np.bincount(near, minlength=len(c))[:, None] > 0, _unit(sums), c)
    out = Index(c, len(c))
    asked = x[:ASKED]
    scores = asked @ x.T
    scores[np.arange(len(asked)), np.arange(len(asked))] = -np.inf  # not itself
    k = min(k, max(1, len(x) - 1))
    true = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    place = np.argsort(out.cells(asked, len(c)), axis=1)  # of each cell among a query's
    need = np.sort(np.take_along_axis(place, (x @ c.T).argmax(axis=1)[true], axis=1).ravel()) + 1
    out.probes = int(need[min(len(need) - 1, math.ceil(recall * len(need)) - 1)])
    return out


def placed(rows: DataFrame, index: Index, key: str, vector: str, n: int = 1) -> DataFrame:
    """(key, v, cells): each row's n nearest cells."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                cells = index.cells(_matrix(b.column(1)), n)
                offsets = pa.array(np.arange(len(cells) + 1, dtype=np.int32) * cells.shape[1])
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(offsets, pa.array(cells.astype(np.int64).ravel()))], [key, "v", "cells"])

    x = rows.filter(F.col(vector).isNotNull()).select(key, F.col(vector).cast("array<double>").alias("v"))
    return x.mapInArrow(run, f"{key} {dict(x.dtypes)[key]}, v array<double>, cells array<long>")


def search(queries: DataFrame, rows: DataFrame, index: Index, query: str, key: str, vector: str = "embedding", k: int = 10) -> DataFrame:
    """(query, key, score, rank): of each query the k rows with the highest
    products in its cells, the smallest key first of equal ones; a row with
    the query's own key is none of them.

    A cell with more than CHUNK rows, or more than BLOCK queries, is dealt out
    by hashes, so no task holds more of either than about that.
    """
    deal = lambda c, n, seed: F.pmod(F.xxhash64(F.lit(seed), c), n)
    r = placed(rows, index, key, vector).select(key, "v", F.get("cells", F.lit(0)).alias("cell"))
    q = placed(queries, index, query, vector, index.probes).select(query, "v", F.explode("cells").alias("cell"))
    size = lambda df, most, out: df.groupBy("cell").agg(F.ceil(F.count("*") / most).alias(out))
    sizes = F.broadcast(size(r, CHUNK, "chunks").join(size(q, BLOCK, "blocks"), "cell"))  # CELLS rows at most
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    r = r.join(sizes, "cell").withColumn("chunk", deal(key, F.col("chunks"), 1)).withColumn("block", each("blocks")).drop("chunks", "blocks")
    q = q.join(sizes, "cell").withColumn("block", deal(query, F.col("blocks"), 2)).withColumn("chunk", each("chunks")).drop("chunks", "blocks")
    schema = f"{query} {dict(q.dtypes)[query]}, {key} {dict(r.dtypes)[key]}, score double"

    def meet(asked: pa.Table, there: pa.Table) -> pa.Table:
        if not asked.num_rows or not there.num_rows:
            return pa.table({query: asked[query].slice(0, 0), key: there[key].slice(0, 0), "score": pa.array([], pa.float64())})
        there = there.sort_by(key)
        scores = _matrix(asked["v"]) @ _matrix(there["v"]).T
        same = np.asarray(asked[query])[:, None] == np.asarray(there[key])[None, :]
        scores[same] = -np.inf
        best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
        i = np.repeat(np.arange(len(scores)), best.shape[1])
        j = best.ravel()
        keep = np.isfinite(scores[i, j])
        i, j = i[keep], j[keep]
        return pa.table({query: asked[query].take(pa.array(i)), key: there[key].take(pa.array(j)), "score": scores[i, j]})

    by = ["cell", "chunk", "block"]
    met = q.groupBy(*by).cogroup(r.groupBy(*by)).applyInArrow(meet, schema)
    w = Window.partitionBy(query).orderBy(F.desc("score"), key)
    return met.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def exact(queries: DataFrame, rows: DataFrame, query: str, key: str, vector: str = "embedding", k: int = 10) -> DataFrame:
    """What search() finds if it looks through all rows: one cell, in blocks."""
    first = rows.filter(F.col(vector).isNotNull()).select(F.size(vector).alias("n")).first()
    return search(queries, rows, Index(np.zeros((1, first.n if first else 1)), 1), query, key, vector, k)


def recall(found: DataFrame, true: DataFrame, query: str, key: str) -> DataFrame:
    """One row: queries, true neighbours, those found, and their share."""
    both = true.select(query, key).join(found.select(query, key, F.lit(1).alias("hit")), [query, key], "left")
    n = both.agg(F.count_distinct(query).alias("queries"), F.count("*").alias("wanted"), F.count("hit").alias("found"))
    return n.withColumn("recall", F.try_divide("found", "wanted"))
