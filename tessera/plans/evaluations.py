"""Queries on the evaluation of a whole corpus: odd lines of a document stand
for reference parameters, even ones for predicted ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate, match
from .common import read
from .verification import BASE, PARAMETERS, parameters_and_tables


def _sides(spark, d):
    p, _ = parameters_and_tables(spark, d, tables=False)
    x = p.withColumns({"name_standardized": F.when(F.col("ord") % 4 < 2, F.upper("name")), "symbol_standardized": F.when(F.col("ord") % 5 == 0, F.concat(F.lit(" "), "symbol")), "unit_standardized": F.when(F.col("ord") % 3 == 0, F.replace("unit", F.lit("1/h"), F.lit("h^-1"))),
                       "status": F.when(F.col("ord") % 3 != 0, F.col("confidence")), "source_page": F.when(F.col("ord") % 2 == 0, F.pmod("ord", F.lit(4))).otherwise(F.lit(2))})
    return x.filter("ord % 2 = 1"), x.filter("ord % 2 = 0")


def evaluation_pairs(spark, d):
    ref, pred = _sides(spark, d)
    return evaluate.pairs(ref, pred, "doc")


def evaluation_metrics(spark, d):
    ref, pred = _sides(spark, d)
    out = evaluate.metrics(ref, pred, match.one_to_one(evaluate.pairs(ref, pred, "doc"), "doc"), "doc")
    return out.select("doc", "reference_count", "prediction_count", "matched_count", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")))


def evaluation_fields(spark, d):
    """All fields of all pairs, so that every state of every field occurs."""
    ref, pred = _sides(spark, d)
    both = evaluate.matched(ref, pred, evaluate.pairs(ref, pred, "doc"), "doc")
    return match.agreement(match.states(both, evaluate.field_states())).withColumn("agreement", F.round("agreement", 6))


def evaluation_left_over(spark, d):
    ref, pred = _sides(spark, d)
    a, b = evaluate.left_over(ref, pred, evaluate.pairs(ref, pred, "doc"), "doc")
    return a.select("doc", "ord", F.lit("reference").alias("side")).unionByName(b.select("doc", "ord", F.lit("prediction").alias("side")))


def collection_agreement(spark, d):
    """Events of a user by type, as JSON with its keys in either order."""
    e = read(spark, d, "events").select("user_id", "event_type", "event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), F.pmod("event_id", F.lit(3)).alias("m"))
    one = F.format_string('{"b": %d, "a": {"y": [1, %d], "x": null}}', "k", "m")
    two = F.format_string('{"a":{"x":null,"y":[1,%d]},"b":%d}', "m", "k")
    return evaluate.collections(e.filter("event_id % 2 = 0").withColumn("item", one), e.filter("event_id % 2 = 1").withColumn("item", two), "user_id", "event_type", "item")


QUERIES = {f.__name__: f for f in (evaluation_pairs, evaluation_metrics, evaluation_fields, evaluation_left_over, collection_agreement)}

_ID = "regexp_replace(lower(coalesce({}, '')), '[^a-z0-9]', '', 'g')"
_NT = r"trim(regexp_replace(lower(coalesce({}, '')), '\s+', ' ', 'g'))"
_UNIT = r"replace(regexp_replace(translate(trim(regexp_replace(lower(coalesce({}, '')), '\s+', ' ', 'g')), 'μµ *', 'uu'), '([a-z]+)\^-1', '/\1', 'g'), 'per', '/')"
_X = rf"""B AS ({BASE}), P AS ({PARAMETERS}), Q AS (SELECT *, CASE WHEN ord % 4 < 2 THEN upper(name) END AS name2, CASE WHEN ord % 5 = 0 THEN ' ' || symbol END AS symbol2, CASE WHEN ord % 3 = 0 THEN replace(unit, '1/h', 'h^-1') END AS unit2,
  CASE WHEN ord % 3 <> 0 THEN confidence END AS status, CASE WHEN ord % 2 = 0 THEN ord % 4 ELSE 2 END AS page FROM P),
N AS (SELECT *, list_distinct(list_filter([{_ID.format('name2')}, {_ID.format('name')}], lambda x: x <> '')) AS names, list_distinct(list_filter([{_ID.format('symbol2')}, {_ID.format('symbol')}], lambda x: x <> '')) AS symbols,
  {_ID.format('compound')} AS c1, {_ID.format('species')} AS c2, {_ID.format('population')} AS c4, {_ID.format('organ')} AS c5, 'iv|oral' AS c6, {_ID.format('source_table')} AS tab FROM Q),
S AS (SELECT r.doc, r.ord AS ref, p.ord AS pred, CASE WHEN list_has_any(r.names, p.names) THEN 8 ELSE 0 END + CASE WHEN list_has_any(r.symbols, p.symbols) THEN 7 ELSE 0 END + 2 + """ + " + ".join(f"CASE WHEN r.{c} <> '' AND r.{c} = p.{c} THEN 2 ELSE 0 END" for c in ("c1", "c2", "c4", "c5", "tab")) + """ AS score
  FROM N AS r JOIN N AS p ON r.doc = p.doc AND r.ord % 2 = 1 AND p.ord % 2 = 0 WHERE (list_has_any(r.names, p.names) OR list_has_any(r.symbols, p.symbols))""" + "".join(f" AND (r.{c} = '' OR p.{c} = '' OR r.{c} = p.{c})" for c in ("c1", "c2", "c4", "c5")) + """),
T AS (SELECT *, count(*) OVER (PARTITION BY doc, pred) AS ties FROM (SELECT *, max(score) OVER (PARTITION BY doc, pred) AS m FROM S) WHERE score = m),
M AS (SELECT doc, ref, pred, score FROM (SELECT *, row_number() OVER (PARTITION BY doc, ref ORDER BY score DESC, pred) AS k FROM T WHERE ties = 1) WHERE k = 1)"""


def _state(field: str, a: str, form: str = "{}") -> str:
    r, p = (a.replace("@", f"{s}.") for s in "rp")
    return f"SELECT '{field}' AS field, CASE WHEN {r} IS NULL AND {p} IS NULL THEN 'not_compared' WHEN {form.format(r)} = {form.format(p)} THEN 'match' ELSE 'mismatch' END AS state FROM J"


_NUM = "SELECT 'value' AS field, CASE WHEN r.value IS NULL AND p.value IS NULL THEN 'not_compared' WHEN r.value IS NULL OR p.value IS NULL THEN 'mismatch' WHEN abs(r.value - p.value) <= greatest(0.05::DOUBLE * greatest(abs(r.value), abs(p.value)), 1e-9) THEN 'match' ELSE 'mismatch' END FROM J"
_JOIN = "S JOIN Q AS r ON r.doc = S.doc AND r.ord = S.ref JOIN Q AS p ON p.doc = S.doc AND p.ord = S.pred"
_STATES = " UNION ALL ".join((
    _state("parameter_class", "@class", _NT), _state("parameter_subclass", "@subclass", _NT), _state("parameter_name", "coalesce(nullif(@name2, ''), nullif(@name, ''))", _ID), _state("symbol", "coalesce(nullif(@symbol2, ''), nullif(@symbol, ''))", _ID), _NUM,
    _state("unit", "coalesce(nullif(@unit2, ''), nullif(@unit, ''))", _UNIT), _state("provenance_status", "@status", _NT), _state("source_table", "@source_table", _ID), _state("source_page", "@page", "{}::VARCHAR"), _state("context.compound", "@compound", _ID),
    _state("context.species", "@species", _ID), _state("context.life_stage", "@life_stage", _ID), _state("context.population", "@population", _ID), _state("context.organ", "@organ", _ID), "SELECT 'context.formulation', 'match' FROM J",
)).replace("FROM J", f"FROM {_JOIN}")
ORACLE_SQL = {
    "evaluation_pairs": f"WITH {_X} SELECT doc, ref, pred, score FROM S",
    "evaluation_metrics": f"""WITH {_X}, C AS (SELECT doc, count(*) FILTER (ord % 2 = 1) AS r, count(*) FILTER (ord % 2 = 0) AS p FROM P GROUP BY doc), K AS (SELECT doc, count(*) AS m FROM M GROUP BY doc),
V AS (SELECT doc, r, p, coalesce(m, 0) AS m, coalesce(coalesce(m, 0) / nullif(p, 0)::DOUBLE, 0) AS pr, coalesce(coalesce(m, 0) / nullif(r, 0)::DOUBLE, 0) AS re FROM C LEFT JOIN K USING (doc))
SELECT doc, r AS reference_count, p AS prediction_count, m AS matched_count, round(pr, 6) AS precision, round(re, 6) AS recall, round(coalesce(2 * pr * re / nullif(pr + re, 0), 0), 6) AS f1 FROM V""",
    "evaluation_fields": f"""WITH {_X}, U AS ({_STATES})
SELECT field, count(*) FILTER (state <> 'not_compared') AS compared, count(*) FILTER (state = 'match') AS matched, count(*) FILTER (state = 'mismatch') AS mismatched, count(*) FILTER (state = 'not_compared') AS not_compared,
  round(count(*) FILTER (state = 'match') / nullif(count(*) FILTER (state <> 'not_compared'), 0)::DOUBLE, 6) AS agreement FROM U GROUP BY field""",
    "evaluation_left_over": f"""WITH {_X} SELECT doc, ord, 'reference' AS side FROM P WHERE ord % 2 = 1 AND NOT EXISTS (SELECT 1 FROM M WHERE M.doc = P.doc AND M.ref = P.ord) UNION ALL
SELECT doc, ord, 'prediction' FROM P WHERE ord % 2 = 0 AND NOT EXISTS (SELECT 1 FROM M WHERE M.doc = P.doc AND M.pred = P.ord) AND NOT EXISTS (SELECT 1 FROM T WHERE ties > 1 AND T.doc = P.doc AND T.pred = P.ord)""",
    "collection_agreement": """WITH c AS (SELECT user_id, event_type, (props->>'k')::INT AS k, event_id % 3 AS m, count(*) FILTER (event_id % 2 = 0) AS r, count(*) FILTER (event_id % 2 = 1) AS p FROM events GROUP BY ALL)
SELECT user_id, event_type, sum(r)::BIGINT AS reference_count, sum(p)::BIGINT AS prediction_count, sum(least(r, p))::BIGINT AS matched FROM c GROUP BY ALL""",
}
