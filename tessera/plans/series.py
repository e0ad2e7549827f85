"""Queries on time series and retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import retrieve, series
from .common import read


def _events(spark, d):
    t = (F.unix_timestamp(F.col("ts").cast("timestamp")) / 3600.0).alias("t")
    return read(spark, d, "events").select("event_id", "user_id", t, "value")


def _curve(spark, d):
    e = _events(spark, d).groupBy("user_id", "t").agg(F.avg("value").alias("y"), F.min("event_id").alias("i"))
    return e.filter("i % 2 = 0").drop("i"), e.filter("i % 2 = 1").select("user_id", "t", F.col("y").alias("observed"))


def interp_asof(spark, d):
    curve, asked = _curve(spark, d)
    return series.interpolate(curve, asked, "user_id", "t", "y").select("user_id", F.round("t", 4).alias("t"), F.round("y", 3).alias("y"))


def fit_metrics(spark, d):
    curve, asked = _curve(spark, d)
    got = series.interpolate(curve, asked, "user_id", "t", "y").join(asked, ["user_id", "t"])
    m = series.fit_measures(got, "user_id", "y", "observed")
    return m.select("user_id", "n", F.round("rmse", 3).alias("rmse"), "verdict")


def compartment_sim(spark, d):
    s = read(spark, d, "supplier").select("s_suppkey", F.pmod("s_suppkey", F.lit(7)).alias("m"))
    x = s.select("s_suppkey", F.explode(F.array(*(F.struct(F.lit(n).alias("sym"), (F.lit(v) * (1 + F.col("m"))).alias("val"), F.lit(i).alias("o")) for i, (n, v) in enumerate((("Vc", 10.0), ("Vp", 20.0), ("CL", 2.0), ("Q", 3.0), ("ka", 0.5))))))).select("s_suppkey", F.col("col.sym").alias("sym"), F.col("col.val").alias("val"), F.col("col.o").alias("o"))
    models = series.roles(x, "s_suppkey", "sym", "val", "o").withColumn("dose", F.lit(100.0))
    x = series.simulate(models, "s_suppkey", 24.0, 25)
    return x.select("s_suppkey", F.round("time", 4).alias("time"), *(F.abs(F.round(c, 4)).alias(c) for c in ("central", "peripheral", "depot")))


def maxsim_topk(spark, d):
    e = read(spark, d, "embeddings")
    q = e.filter("vec_id % 20 = 0").select((F.col("vec_id") / 20 % 4).cast("long").alias("query"), "embedding")
    s = retrieve.late_interaction(q, e.select(F.col("label").alias("page"), "embedding"), "query", "page")
    return retrieve.top_k(s, "query", "page", 3).select("query", "page", F.col("rank"), F.round("score", 4).alias("score"))


def cutoff_topk(spark, d):
    e = read(spark, d, "embeddings")
    q = e.filter("vec_id % 20 = 0").select(F.lit(0).alias("query"), "embedding")
    s = retrieve.late_interaction(q, e.select(F.col("vec_id").alias("page"), "embedding"), "query", "page").select("page", "score")
    return retrieve.cutoff(s, "page", 10, 0.9).select("page", F.col("rank"), F.round("score", 4).alias("score"))


_INTERP = """E AS (SELECT user_id, floor(epoch(ts)) / 3600.0::DOUBLE AS t, avg(value) AS y, min(event_id) AS i FROM events GROUP BY ALL),
C AS (SELECT user_id, t, y, row_number() OVER (PARTITION BY user_id ORDER BY t) AS k, count(*) OVER (PARTITION BY user_id) AS n FROM E WHERE i % 2 = 0),
A AS (SELECT user_id, t, y AS observed FROM E WHERE i % 2 = 1),
K AS (SELECT A.user_id, A.t, A.observed, greatest(1, least(n - 1, coalesce(max(k) FILTER (C.t <= A.t), 0))) AS k, n FROM A JOIN C ON A.user_id = C.user_id GROUP BY A.user_id, A.t, A.observed, n),
I AS (SELECT K.user_id, K.t, observed, a.y + CASE WHEN b.t IS NULL THEN 0 ELSE (b.y - a.y) / (b.t - a.t) * (K.t - a.t) END AS y FROM K JOIN C a ON a.user_id = K.user_id AND a.k = K.k LEFT JOIN C b ON b.user_id = K.user_id AND b.k = K.k + 1)"""
_SIM = """S AS (SELECT q.vec_id AS qi, q.query, p.{page} AS page, list_sum(list_transform(list_zip(q.embedding, p.embedding), lambda x: x[1]::DOUBLE * x[2]::DOUBLE)) AS s FROM Q q, embeddings p),
M AS (SELECT query, page, sum(m) AS score FROM (SELECT qi, query, page, max(s) AS m FROM S GROUP BY ALL) GROUP BY ALL)"""

QUERIES = {f.__name__: f for f in (interp_asof, fit_metrics, compartment_sim, maxsim_topk, cutoff_topk)}
ORACLE_SQL = {
    "interp_asof": f"WITH {_INTERP} SELECT user_id, round(t, 4) AS t, round(y, 3) AS y FROM I",
    "fit_metrics": f"""WITH {_INTERP}, J AS (SELECT *, avg(observed) OVER (PARTITION BY user_id) AS m FROM I)
SELECT user_id, count(*) AS n, round(sqrt(avg((observed - y) ** 2)), 3) AS rmse, CASE WHEN 1 - sum((observed - y) ** 2) / (sum((observed - m) ** 2) + 1e-10) > 0.85 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM J GROUP BY user_id""",
    # The exponentials of two compartments and a depot: rates 0.2 out, 0.3 to
    # and 0.15 from the second one, a and b the roots of the two.
    "compartment_sim": """WITH m AS (SELECT s_suppkey, 0.5::DOUBLE * (1 + s_suppkey % 7) AS ka, (0.65::DOUBLE + sqrt(0.65::DOUBLE ** 2 - 4 * 0.03::DOUBLE)) / 2 AS a, (0.65::DOUBLE - sqrt(0.65::DOUBLE ** 2 - 4 * 0.03::DOUBLE)) / 2 AS b FROM supplier),
e AS (SELECT *, t::DOUBLE AS time, exp(-a * t) / ((ka - a) * (b - a)) AS ea, exp(-b * t) / ((ka - b) * (a - b)) AS eb, exp(-ka * t) / ((a - ka) * (b - ka)) AS ek FROM m, unnest(range(0, 25)) AS r(t))
SELECT s_suppkey, time, abs(round(100 * ka * ((0.15::DOUBLE - a) * ea + (0.15::DOUBLE - b) * eb + (0.15::DOUBLE - ka) * ek), 4)) AS central, abs(round(100 * ka * 0.3::DOUBLE * (ea + eb + ek), 4)) AS peripheral, round(100 * exp(-ka * time), 4) AS depot FROM e""",
    "maxsim_topk": f"WITH Q AS (SELECT vec_id, vec_id // 20 % 4 AS query, embedding FROM embeddings WHERE vec_id % 20 = 0), {_SIM.format(page='label')} SELECT query, page, rank, round(score, 4) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, page) AS rank FROM M) WHERE rank <= 3",
    "cutoff_topk": f"""WITH Q AS (SELECT vec_id, 0 AS query, embedding FROM embeddings WHERE vec_id % 20 = 0), {_SIM.format(page='vec_id')},
R AS (SELECT page, score, row_number() OVER (ORDER BY score DESC, page) AS rank, max(score) OVER () AS m FROM M)
SELECT page, rank, round(score, 4) AS score FROM R WHERE rank <= 10 AND (rank <= 4 OR score >= 0.9::DOUBLE * m)""",
}
