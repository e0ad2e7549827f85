"""Queries on agreement of predictions with references."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import number_state, ratio, text_state
from ..functions.text import normal_identifier
from ..operators import match
from .common import LINES, lines, read

JUNK = "[#$%&*]{3}|!!"


def precision_recall_f1(spark, d):
    docs = read(spark, d, "documents").select("doc_id", F.coalesce(~F.col("text").rlike(JUNK), F.lit(False)).alias("p"))
    both = docs.join(read(spark, d, "labels").select("doc_id", (F.col("quality") == 1).alias("g")), "doc_id")
    n = both.agg(*(F.count_if((F.col("p") == p) & (F.col("g") == g)).alias(c) for c, p, g in (("tp", True, True), ("fp", True, False), ("fn", False, True), ("tn", False, False))))
    measures = match.prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return n.select("*", *(F.round(c, 6).alias(k) for k, c in measures.items()))


def _sides(spark, d):
    # Parts are normalised once, not once a line.
    form = lambda c: normal_identifier(F.col(c))
    names = F.array(form("p_brand"), F.concat(F.lit("s"), F.pmod("p_size", F.lit(9)).cast("string")))
    part = read(spark, d, "part").select("p_partkey", names.alias("names"), F.array(form("p_type")).alias("symbols"))
    x = lines(spark, d, "l_partkey", "l_returnflag", "l_linestatus", "l_suppkey").join(part, F.col("l_partkey") == F.col("p_partkey"))
    status = F.when(F.col("ord") % 5 != 0, F.col("l_linestatus"))
    x = x.select("l_orderkey", "ord", "names", "symbols", "l_returnflag", status.alias("status"), F.concat(F.lit("t"), F.pmod("l_suppkey", F.lit(3)).cast("string")).alias("source"))
    return x.filter("ord % 2 = 1"), x.filter("ord % 2 = 0")


def _pairs(spark, d):
    return match.candidates(*_sides(spark, d), "l_orderkey", [("names", 8), ("symbols", 7)], ["l_returnflag", "status"], ["source"])


def candidate_match(spark, d):
    return match.one_to_one(_pairs(spark, d), "l_orderkey")


def ambiguous_matches(spark, d):
    tied = match.best(_pairs(spark, d), "l_orderkey").filter("ties > 1")
    return tied.groupBy("l_orderkey", "pred", "score").agg(F.count("*").alias("n_refs"), F.array_join(F.sort_array(F.collect_list("ref")), ",").alias("refs"))


def unmatched_rows(spark, d):
    ref, got = _sides(spark, d)[0], candidate_match(spark, d)
    left = match.unmatched(ref.select("l_orderkey", F.col("ord").alias("ref")), got.select("l_orderkey", "ref"), ["l_orderkey", "ref"])
    return left.groupBy("l_orderkey").agg(F.count("*").alias("n_unmatched"), F.min("ref").alias("first_unmatched"))


def field_agreement(spark, d):
    part = read(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    x = lines(spark, d, "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag").join(part, F.col("l_partkey") == F.col("p_partkey"))
    x = x.withColumn("pair", ((F.col("ord") + 1) / 2).cast("int"))
    cols = ("p_brand", "p_type", "p_size", "l_quantity", "l_extendedprice", "l_returnflag")
    side = lambda odd, pre: x.filter(f"ord % 2 = {odd}").select("l_orderkey", "pair", *(F.col(c).alias(pre + c) for c in cols))
    pairs = side(1, "r_").join(side(0, "p_"), ["l_orderkey", "pair"])
    fields = {c: text_state(F.col("r_" + c), F.col("p_" + c), normal_identifier) for c in ("p_brand", "p_type", "l_returnflag")}
    size = lambda pre: F.when(F.col(pre + "p_size") > 10, F.col(pre + "p_size").cast("double"))
    fields |= {"p_size": number_state(size("r_"), size("p_"))}
    fields |= {c: number_state(F.col("r_" + c), F.col("p_" + c)) for c in ("l_quantity", "l_extendedprice")}
    return match.agreement(match.states(pairs, fields)).withColumn("agreement", F.round("agreement", 6))


def bag_intersection(spark, d):
    x = lines(spark, d, "l_returnflag", "l_linestatus").withColumn("item", F.concat("l_returnflag", "l_linestatus"))
    return match.bag_overlap(x.filter("ord % 2 = 1"), x.filter("ord % 2 = 0"), "l_orderkey", "item")


def macro_rollup(spark, d):
    part = read(spark, d, "part").select("p_partkey", "p_brand")
    x = lines(spark, d, "l_partkey", "l_returnflag", "l_discount", "l_tax").join(part, F.col("l_partkey") == F.col("p_partkey"))
    per = x.groupBy("p_brand", "l_returnflag").agg(F.count_if(F.expr("ord % 2 = 1")).alias("gold"), F.count_if(F.expr("ord % 2 = 0")).alias("pred"), F.avg("l_discount").alias("a"), F.avg("l_tax").alias("b"))
    per = per.withColumn("recall", F.when(F.col("gold") == 0, 100.0).otherwise(100 * F.least(F.lit(1.0), ratio(F.col("pred"), F.col("gold")))))
    out = per.rollup("p_brand").agg(*(F.avg(c).alias(c) for c in ("recall", "a", "b")))
    score = 0.4 * F.col("recall") + 20 * F.col("a") + 20 * F.col("b") + 0.2 * F.lit(100.0)
    return out.select(F.coalesce("p_brand", F.lit("all")).alias("p_brand"), F.round("recall", 4).alias("recall"), F.round(score, 4).alias("composite"))


_ID = "regexp_replace(lower({}), '[^a-z0-9]', '', 'g')"
_SIDES = f"""{LINES},
S AS (SELECT l_orderkey, ord, [{_ID.format('p_brand')}, 's' || p_size % 9] AS names, {_ID.format('p_type')} AS type, l_returnflag AS f, CASE WHEN ord % 5 <> 0 THEN l_linestatus END AS s, l_suppkey % 3 AS t FROM L JOIN part ON l_partkey = p_partkey),
C AS (SELECT r.l_orderkey, r.ord AS ref, p.ord AS pred, CASE WHEN list_has_any(r.names, p.names) THEN 8 ELSE 0 END + CASE WHEN r.type = p.type THEN 7 ELSE 0 END + 2 + CASE WHEN r.s = p.s THEN 2 ELSE 0 END + CASE WHEN r.t = p.t THEN 2 ELSE 0 END AS score
  FROM S r JOIN S p ON r.l_orderkey = p.l_orderkey AND r.ord % 2 = 1 AND p.ord % 2 = 0
  WHERE (list_has_any(r.names, p.names) OR r.type = p.type) AND r.f = p.f AND (r.s IS NULL OR p.s IS NULL OR r.s = p.s)),
B AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey, pred) AS ties FROM (SELECT *, max(score) OVER (PARTITION BY l_orderkey, pred) AS m FROM C) WHERE score = m),
M AS (SELECT l_orderkey, ref, pred, score FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, ref ORDER BY score DESC, pred) AS k FROM B WHERE ties = 1) WHERE k = 1)"""

_NUM = "CASE WHEN {a} IS NULL AND {b} IS NULL THEN 'not_compared' WHEN {a} IS NULL OR {b} IS NULL THEN 'mismatch' WHEN abs({a} - {b}) <= greatest(0.05::DOUBLE * greatest(abs({a}), abs({b})), 1e-9) THEN 'match' ELSE 'mismatch' END"

QUERIES = {
    "precision_recall_f1": precision_recall_f1,
    "candidate_match": candidate_match,
    "ambiguous_matches": ambiguous_matches,
    "unmatched_rows": unmatched_rows,
    "field_agreement": field_agreement,
    "bag_intersection": bag_intersection,
    "macro_rollup": macro_rollup,
}
ORACLE_SQL = {
    "precision_recall_f1": f"""
WITH x AS (SELECT coalesce(NOT regexp_matches(text, '{JUNK}'), false) AS p, quality = 1 AS g FROM documents JOIN labels USING (doc_id)),
n AS (SELECT count(*) FILTER (p AND g) AS tp, count(*) FILTER (p AND NOT g) AS fp, count(*) FILTER (NOT p AND g) AS fn, count(*) FILTER (NOT p AND NOT g) AS tn FROM x),
m AS (SELECT *, tp / (tp + fp)::DOUBLE AS pr, tp / (tp + fn)::DOUBLE AS re FROM n)
SELECT tp, fp, fn, tn, round(pr, 6) AS precision, round(re, 6) AS recall, round(2 * pr * re / (pr + re), 6) AS f1 FROM m""",
    "candidate_match": f"WITH {_SIDES} SELECT l_orderkey, ref, pred, score FROM M",
    "ambiguous_matches": f"WITH {_SIDES} SELECT l_orderkey, pred, score, count(*) AS n_refs, string_agg(ref::VARCHAR, ',' ORDER BY ref) AS refs FROM B WHERE ties > 1 GROUP BY ALL",
    "unmatched_rows": f"WITH {_SIDES} SELECT l_orderkey, count(*) AS n_unmatched, min(ord) AS first_unmatched FROM S WHERE ord % 2 = 1 AND NOT EXISTS (SELECT 1 FROM M WHERE M.l_orderkey = S.l_orderkey AND M.ref = S.ord) GROUP BY l_orderkey",
    "field_agreement": f"""
WITH {LINES}, X AS (SELECT *, (ord + 1) // 2 AS pair, CASE WHEN p_size > 10 THEN p_size::DOUBLE END AS sz FROM L JOIN part ON l_partkey = p_partkey),
P AS (SELECT r.p_brand rb, p.p_brand pb, r.p_type rt, p.p_type pt, r.sz rs, p.sz ps, r.l_quantity rq, p.l_quantity pq, r.l_extendedprice re, p.l_extendedprice pe, r.l_returnflag rf, p.l_returnflag pf
  FROM X r JOIN X p ON r.l_orderkey = p.l_orderkey AND r.pair = p.pair AND r.ord % 2 = 1 AND p.ord % 2 = 0),
U AS (SELECT 'p_brand' AS field, CASE WHEN rb = pb THEN 'match' ELSE 'mismatch' END AS state FROM P UNION ALL
  SELECT 'p_type', CASE WHEN rt = pt THEN 'match' ELSE 'mismatch' END FROM P UNION ALL
  SELECT 'l_returnflag', CASE WHEN rf = pf THEN 'match' ELSE 'mismatch' END FROM P UNION ALL
  SELECT 'p_size', {_NUM.format(a='rs', b='ps')} FROM P UNION ALL
  SELECT 'l_quantity', {_NUM.format(a='rq', b='pq')} FROM P UNION ALL
  SELECT 'l_extendedprice', {_NUM.format(a='re', b='pe')} FROM P)
SELECT field, count(*) FILTER (state <> 'not_compared') AS compared, count(*) FILTER (state = 'match') AS matched, count(*) FILTER (state = 'mismatch') AS mismatched,
  count(*) FILTER (state = 'not_compared') AS not_compared, round(count(*) FILTER (state = 'match') / nullif(count(*) FILTER (state <> 'not_compared'), 0)::DOUBLE, 6) AS agreement FROM U GROUP BY field""",
    "bag_intersection": f"""
WITH {LINES}, A AS (SELECT l_orderkey, l_returnflag || l_linestatus AS item, count(*) FILTER (ord % 2 = 1) AS x, count(*) FILTER (ord % 2 = 0) AS y FROM L GROUP BY ALL)
SELECT l_orderkey, sum(least(x, y))::BIGINT AS common FROM A WHERE x > 0 AND y > 0 GROUP BY l_orderkey""",
    "macro_rollup": f"""
WITH {LINES}, P AS (SELECT p_brand, l_returnflag, count(*) FILTER (ord % 2 = 1) AS gold, count(*) FILTER (ord % 2 = 0) AS pred, avg(l_discount) AS a, avg(l_tax) AS b FROM L JOIN part ON l_partkey = p_partkey GROUP BY ALL),
R AS (SELECT *, CASE WHEN gold = 0 THEN 100.0::DOUBLE ELSE 100 * least(1.0::DOUBLE, pred / gold::DOUBLE) END AS recall FROM P),
G AS (SELECT p_brand, avg(recall) AS recall, avg(a) AS a, avg(b) AS b FROM R GROUP BY ROLLUP (p_brand))
SELECT coalesce(p_brand, 'all') AS p_brand, round(recall, 4) AS recall, round(0.4::DOUBLE * recall + 20 * a + 20 * b + 20, 4) AS composite FROM G""",
}
