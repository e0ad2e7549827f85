"""Queries on the learned filter: `labels` are what it is fitted on, four
fifths of them; the rest are held out."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import learned
from .common import read

LABEL = {"0": "poor", "1": "good"}


def _rows(spark, d):
    """Documents (doc_id, text, lang), and those with a quality label."""
    docs = read(spark, d, "documents").select("doc_id", "text", "lang")
    labels = read(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor").alias("label"))
    # A fit deals the texts by key anyway, so they are dealt once, for both.
    return docs, docs.join(labels.hint("merge"), "doc_id")


def _model(known, label):
    return learned.fit(known.filter("doc_id % 5 <> 0"), "doc_id", "text", label)


def learned_relevance(spark, d):
    docs, known = _rows(spark, d)
    return learned.relevance(docs, _model(known, "label"), "doc_id", "text", "good").select("doc_id", F.round("score", 6).alias("score"), "keep")


def learned_held_out(spark, d):
    _, known = _rows(spark, d)
    held = known.filter("doc_id % 5 = 0")
    scored = learned.relevance(held, _model(known, "label"), "doc_id", "text", "good").join(held.select("doc_id", (F.col("label") == "good").alias("good")), "doc_id")
    kept = scored.agg(F.count_if("keep").alias("kept"), F.count_if(F.col("keep") & F.col("good")).alias("kept_good"))
    return learned.auc(scored, "score", "good").crossJoin(F.broadcast(kept)).select("positives", "negatives", F.round("auc", 4).alias("auc"), "kept", "kept_good")


def learned_classes(spark, d):
    docs, known = _rows(spark, d)
    model = _model(known, "lang")
    found = learned.chosen(learned.score(docs, model, "doc_id", "text"), model)
    return found.join(docs.select("doc_id", "lang"), "doc_id").groupBy("lang", "choice").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (learned_relevance, learned_held_out, learned_classes)}

_FEATURES = r"""T AS (SELECT doc_id, lang, text, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\r]+'), lambda x: x <> '') AS ws,
  list_filter(regexp_split_to_array(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '[a-z]+', 'a', 'g'), '[A-Z]+', 'A', 'g'), '[0-9]+', '0', 'g'), '[^\x00-\x7F]+', '~', 'g'), '[ \t\n\r]+'), lambda x: x <> '') AS ss FROM documents),
TOLD AS (SELECT doc_id, 'w:' || w AS f FROM (SELECT doc_id, unnest(ws) AS w FROM T) UNION SELECT doc_id, 's:' || s FROM (SELECT doc_id, unnest(ss) AS s FROM T)
  UNION SELECT doc_id, 'd:' || a || ' ' || b FROM (SELECT doc_id, unnest(ss[:-2]) AS a, unnest(ss[2:]) AS b FROM T WHERE len(ss) > 1)
  UNION SELECT doc_id, 'r:' || floor(10 * len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) / greatest(len(ws) - 1, 1))::BIGINT::VARCHAR FROM T),
F AS (SELECT doc_id, f FROM TOLD WHERE length(f) <= 64),
K AS (SELECT doc_id, lang, CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END AS label FROM labels JOIN T USING (doc_id)),
"""


def _scored(label: str) -> str:
    """SC (doc_id, y, p): the probability of each class, of all documents."""
    return _FEATURES + rf"""S AS (SELECT doc_id, {label} AS y FROM K WHERE doc_id % 5 <> 0),
C AS (SELECT y, count(*) AS n, round(1000 * ln(count(*) / (SELECT count(*) FROM S WHERE y IS NOT NULL)))::BIGINT AS prior FROM S WHERE y IS NOT NULL GROUP BY y),
M AS (SELECT b.f, C.y, round(1000 * ln((coalesce(m, 0) + 1) / (n + 2.0::DOUBLE)))::BIGINT AS w FROM (SELECT f, count(*) AS c FROM F JOIN S USING (doc_id) WHERE y IS NOT NULL GROUP BY f ORDER BY c DESC, f LIMIT {learned.FEATURES}) AS b CROSS JOIN C
  LEFT JOIN (SELECT f, y, count(*) AS m FROM F JOIN S USING (doc_id) GROUP BY ALL) AS h ON h.f = b.f AND h.y = C.y),
E AS (SELECT T.doc_id, C.y, (C.prior + {learned.EVIDENCE} * coalesce(sums.s::DOUBLE / sums.n, 0)) / 1000 AS e FROM T CROSS JOIN C LEFT JOIN (SELECT doc_id, y, sum(w) AS s, count(*) AS n FROM F JOIN M USING (f) GROUP BY ALL) AS sums ON sums.doc_id = T.doc_id AND sums.y = C.y),
O AS (SELECT doc_id, y, exp(e - max(e) OVER (PARTITION BY doc_id)) AS o FROM E),
SC AS (SELECT doc_id, y, o / sum(o) OVER (PARTITION BY doc_id) AS p FROM O)"""


_KEPT = "R AS (SELECT doc_id, CASE WHEN length(trim(coalesce(text, ''), ' ')) < 50 THEN 1.0::DOUBLE ELSE p END AS score, score >= 0.25 AS keep FROM SC JOIN T USING (doc_id) WHERE y = 'good')"

ORACLE_SQL = {
    "learned_relevance": f"WITH {_scored('label')}, {_KEPT} SELECT doc_id, round(score, 6) AS score, keep FROM R",
    "learned_held_out": f"""WITH {_scored('label')}, {_KEPT}, H AS (SELECT floor(score * 10000) AS bin, keep, label = 'good' AS good FROM R JOIN K USING (doc_id) WHERE doc_id % 5 = 0),
B AS (SELECT bin, count(*) FILTER (good) AS p, count(*) FILTER (NOT good) AS n FROM H GROUP BY bin), W AS (SELECT *, coalesce(sum(n) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM B)
SELECT sum(p)::BIGINT AS positives, sum(n)::BIGINT AS negatives, round(sum(p * (below + n / 2)) / (sum(p)::DOUBLE * sum(n)), 4) AS auc, (SELECT count(*) FILTER (keep) FROM H) AS kept, (SELECT count(*) FILTER (keep AND good) FROM H) AS kept_good FROM W""",
    "learned_classes": f"WITH {_scored('lang')}, B AS (SELECT doc_id, arg_max(y, p) AS choice FROM (SELECT * FROM SC ORDER BY y) GROUP BY doc_id) SELECT lang, choice, count(*) AS n FROM B JOIN T USING (doc_id) GROUP BY ALL",
}
