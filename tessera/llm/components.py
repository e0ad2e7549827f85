"""Connected components by alternating stars, every step a join or a sum.

Large star: each vertex ties its larger neighbours to the smallest vertex it
knows; small star: each ties its smaller neighbours and itself to it.  Both
keep the components and end in stars round the smallest vertices, in about
log(n) rounds.  A vertex with very many edges is a skewed join key, which is
split; minima are combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _large(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    inner = e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return inner.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(u, root) for each vertex of edges (a, b) that is not its own root;
    the root is the smallest vertex of the component.

    Loops, repeated edges and edges with a null end are nothing; no edges give
    no rows.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("a IS NOT NULL AND b IS NOT NULL AND u <> v").distinct()
    e = materialize(e, "edges")
    before = None
    for _ in range(most):
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return e.select("u", F.col("v").alias("root"))
        before = now
        e = materialize(_small(_large(e)), "edges")
    raise RuntimeError("components did not settle")
