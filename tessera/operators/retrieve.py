"""Retrieval on precomputed vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def max_sim(query: Column, page: Column) -> Column:
    """Sum over a query's vectors of the best product with a page's vectors."""
    best = F.transform(query, lambda q: F.array_max(F.transform(page, lambda p: dot(q, p))))
    return F.aggregate(best, F.lit(0.0), lambda s, x: s + x)


#: Vectors of queries in a block, and rows of pages in a chunk.
BLOCK, CHUNK = 1024, 2048


def _vectors(table: pa.Table) -> np.ndarray:
    flat = table["_v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype("float64").reshape(table.num_rows, -1)


def _order(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Rows by value, each value's first place among them, the values."""
    codes = column.combine_chunks().dictionary_encode("encode")
    at = codes.indices.to_numpy(zero_copy_only=False)
    rows = np.argsort(at, kind="stable")
    return rows, np.flatnonzero(np.diff(at[rows], prepend=-1)), codes.dictionary


def _meet(query: str, page: str, schema: pa.Schema):
    def f(p: pa.Table, q: pa.Table) -> pa.Table:
        if not p.num_rows or not q.num_rows:
            return schema.empty_table()
        rows, starts, pages = _order(p[page])
        best = np.maximum.reduceat(_vectors(q) @ _vectors(p)[rows].T, starts, axis=1)
        split = p["_split"].to_numpy()[rows][starts]
        # A split page's best products meet those of its other chunks.
        i, j = (x.ravel() for x in np.meshgrid(np.arange(q.num_rows), np.flatnonzero(split), indexing="ij"))
        one = [q[query].take(pa.array(i)), q["_i"].take(pa.array(i)), pages.take(pa.array(j)), best[i, j]]
        # A page that is whole here needs only the sum over the block's vectors.
        rows, starts, asked = _order(q[query])
        total = np.add.reduceat(best[rows], starts, axis=0)
        i, j = (x.ravel() for x in np.meshgrid(np.arange(len(asked)), np.flatnonzero(~split), indexing="ij"))
        two = [asked.take(pa.array(i)), np.full(len(i), -1 - q["_b"][0].as_py()), pages.take(pa.array(j)), total[i, j]]
        return pa.concat_tables(pa.table(dict(zip(schema.names, x, strict=True))).cast(schema) for x in (one, two))

    return f


def late_interaction(queries: DataFrame, pages: DataFrame, query: str, page: str) -> DataFrame:
    """(query, page, score) by the same measure with one vector a row.

    Blocks of queries meet chunks of pages, all of them, as products of two
    matrices of bounded size, so neither side needs to fit in one place.
    Pages of more than CHUNK rows are dealt over chunks.  Rows without a
    vector count for nothing.
    """
    ident = lambda: F.xxhash64(F.monotonically_increasing_id())
    q = queries.filter("embedding IS NOT NULL").select(F.col(query).alias(query), F.col("embedding").alias("_v"))
    p = pages.filter("embedding IS NOT NULL").select(F.col(page).alias(page), F.col("embedding").alias("_v"))
    n_blocks, n_chunks = (-(-df.count() // n) or 1 for df, n in ((q, BLOCK), (p, CHUNK)))
    large = p.groupBy(page).count().filter(F.col("count") > CHUNK).select(page, F.lit(True).alias("_split"))
    p = p.join(large, page, "left").withColumn("_split", F.coalesce("_split", F.lit(False)))
    p = p.withColumn("_c", F.pmod(F.when(F.col("_split"), ident()).otherwise(F.xxhash64(page)), F.lit(n_chunks)))
    q = q.withColumn("_i", F.monotonically_increasing_id()).withColumn("_b", F.pmod(F.xxhash64("_i"), F.lit(n_blocks)))
    p = p.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<bigint>")))
    q = q.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1)).cast("array<bigint>")))
    out = StructType([q.schema[query], q.schema["_i"], p.schema[page], StructField("_s", DoubleType())])
    met = p.groupBy("_c", "_b").cogroup(q.groupBy("_c", "_b")).applyInArrow(_meet(query, page, to_arrow_schema(out)), out)
    return met.groupBy(query, "_i", page).agg(F.max("_s").alias("_s")).groupBy(query, page).agg(F.sum("_s").alias("score"))


def top_k(scores: DataFrame, query: str, page: str, k: int = 3) -> DataFrame:
    w = Window.partitionBy(query).orderBy(F.desc("score"), page)
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def penalised(scores: DataFrame, against: DataFrame, page: str, low: float = 10.0, penalty: float = 10.0) -> DataFrame:
    """scores (page, score) less a penalty where a page is more like the
    unwanted query (page, against) and its own score is under `low`."""
    x = scores.join(against.select(page, "against"), page, "left")
    worse = (F.col("against") > F.col("score")) & (F.col("score") < low)
    return x.withColumn("score", F.when(worse, F.col("score") - penalty).otherwise(F.col("score"))).drop("against")


def cutoff(scores: DataFrame, page: str, k: int = 10, ratio: float = 0.9, floor: float = 0.6, least: int = 4) -> DataFrame:
    """Of the k best pages those with max(ratio, floor) of the best score, and
    the `least` best in any case."""
    # The k best come first, so the window is over k rows.
    best = scores.orderBy(F.desc("score"), page).limit(k)
    w = Window.orderBy(F.desc("score"), page)
    ranked = best.withColumns({"rank": F.row_number().over(w), "_max": F.max("score").over(Window.partitionBy())})
    return ranked.filter((F.col("rank") <= least) | (F.col("score") >= F.greatest(F.lit(ratio), F.lit(floor)) * F.col("_max"))).drop("_max")
