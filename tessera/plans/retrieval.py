"""Queries on retrieval by an index: every twentieth vector asks all."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import index
from .common import read


def _sides(spark, d):
    e = read(spark, d, "embeddings").select("vec_id", "embedding")
    return e.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query"), e


def nearest_exact(spark, d):
    """The ten nearest vectors of each query, by all products."""
    return index.exact(*_sides(spark, d), "query", "vec_id").select("query", "vec_id", "rank", F.round("score", 6).alias("score"))


def nearest_indexed(spark, d):
    """The same by the index; nearly all of them."""
    q, e = _sides(spark, d)
    return index.search(q, e, index.fit(e, "vec_id", "embedding"), "query", "vec_id").select("query", "vec_id", "rank", F.round("score", 6).alias("score"))


def index_recall(spark, d):
    """How many of the true neighbours the index finds, against the bar."""
    q, e = _sides(spark, d)
    found = index.search(q, e, index.fit(e, "vec_id", "embedding"), "query", "vec_id")
    got = index.recall(found, index.exact(q, e, "query", "vec_id"), "query", "vec_id")
    return got.select("queries", "wanted", (F.col("recall") >= 0.9).alias("reached"))


QUERIES = {f.__name__: f for f in (nearest_exact, nearest_indexed, index_recall)}

_BEST = """S AS (SELECT q.vec_id AS query, p.vec_id AS vec_id, list_sum(list_transform(list_zip(q.embedding, p.embedding), lambda x: x[1]::DOUBLE * x[2]::DOUBLE)) AS score
  FROM embeddings AS q JOIN embeddings AS p ON q.vec_id % 20 = 0 AND q.vec_id <> p.vec_id),
R AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS rank FROM S)"""
ORACLE_SQL = {
    "nearest_exact": f"WITH {_BEST} SELECT query, vec_id, rank, round(score, 6) AS score FROM R WHERE rank <= 10",
    "index_recall": f"WITH {_BEST} SELECT count(DISTINCT query) AS queries, count(*) AS wanted, true AS reached FROM R WHERE rank <= 10",
}
