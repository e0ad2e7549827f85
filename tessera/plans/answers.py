"""Queries on the questionnaire that is answered from facts, customers
standing for documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import answers
from ..operators.assess import ITEMS, NONE
from .common import read, spread
from .verification import _BOTH, heads, unwritten

#: Facts as expressions over k, the customer's number, for both engines.
K = {
    "n_parameters": "k % 3", "n_referenced": "k % 3 - CASE WHEN k % 6 = 2 THEN 1 ELSE 0 END", "n_uncertain": "CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END", "n_observed": "k % 2", "n_simulated": "CASE WHEN k % 7 < 3 THEN 1 ELSE 0 END",
    "n_dosing": "CASE WHEN k % 11 < 4 THEN 2 ELSE 0 END", "n_assumptions": "CASE WHEN k % 4 = 1 THEN 1 ELSE 0 END", "n_compartments": "CASE WHEN k % 9 = 0 THEN 3 ELSE 0 END", "n_sensitivity": "CASE WHEN k % 13 < 5 THEN 1 ELSE 0 END",
    "purpose": "CASE k % 5 WHEN 0 THEN 'not_reported' WHEN 1 THEN NULL ELSE 'to predict' END", "context_quote": "CASE WHEN k % 3 <> 1 THEN 'we aim' END", "title": "CASE WHEN k % 8 = 0 THEN 'N/A' WHEN k % 8 < 5 THEN 'A title' END",
    "model_origin": "CASE WHEN k % 10 = 0 THEN 'own' END", "equations_provided": "CASE WHEN k % 6 = 0 THEN 'full' WHEN k % 6 = 1 THEN 'none' END",
}


def _facts(spark, d):
    c = spread(read(spark, d, "customer").select(F.col("c_custkey").alias("k")))
    text, page = F.lit(None).cast("string"), F.lit(None).cast("int")
    one = lambda s, p=page, w=text, q=text: F.struct(p.alias("page"), F.lit(s).alias("section"), w.alias("location"), q.alias("quote"))
    if_ = lambda cond, *es: F.when(F.expr(cond), F.array(*es)).otherwise(F.array().cast(answers.EVIDENCE))
    x = c.withColumns({n: F.expr(e) for n, e in K.items()})
    return x.withColumns({
        "has_structure": F.expr("k % 9 < 2"), "structure_location": F.when(F.col("k") % 9 == 0, "Figure 1"), "phases": F.when(F.col("k") % 4 == 0, F.array(F.lit("absorption"), F.lit("metabolism"))), "categories": F.when(F.col("k") % 4 == 1, F.array(F.lit("protein_binding_free_fraction"))),
        "roles": F.when(F.col("k") % 2 == 1, F.array(F.when(F.col("k") % 3 == 0, "Calibration").otherwise("external_validation"))), "metrics": F.when(F.col("k") % 7 == 0, F.array(F.lit("AAFE of AUC"))),
        "software": F.array(*(F.when(F.col("k") % 5 >= i, "x") for i in range(5))),
        "parameter_evidence": if_("n_parameters > 0", one("Methods", w=F.lit("Table 1"))), "observed_evidence": if_("n_observed > 0", one("observed_data", q=F.lit("seen")), one("observed_data", q=F.lit("seen"))),
        "simulated_evidence": if_("n_simulated > 0", one("simulated_data", p=F.lit(3))), "dosing_evidence": if_("n_dosing > 0", one("dosing event", q=F.lit("none"))), "assumption_evidence": if_("n_assumptions > 0", one("model assumption", p=F.lit(2), q=F.lit("we assume"))),
        "phase_evidence": if_("k % 4 = 0", one("ADME absorption", w=F.lit("p. 4"), q=F.lit("is absorbed"))), "sensitivity_evidence": if_("n_sensitivity > 0", one("sensitivity analysis", w=F.lit("Table 4"), q=F.lit("is sensitive"))), "software_evidence": if_("k % 2 = 0", one("software", q=F.lit("in R"))),
    })


def fact_answers(spark, d):
    x = answers.answers(_facts(spark, d), "k")
    return x.select("k", "item_id", "response", "confidence", F.size("evidence").cast("bigint").alias("n_evidence"))


def answer_overview(spark, d):
    x = answers.overview(answers.answers(_facts(spark, d), "k"), "k")
    return x.select("k", "n_open", "fit", F.array_join("gaps", ",").alias("gaps"))


def answer_search(spark, d):
    x = answers.search(answers.answers(_facts(spark, d), "k"), "SENSITIVE", "partially")
    return x.groupBy("k").agg(F.count("*").alias("n"))


def answer_targets(spark, d):
    return answers.targets(heads(spark, unwritten(spark, d)), "doc").select("doc", F.array_join("targets", ",").alias("targets"))


def basis_union(spark, d):
    """Events of a user as findings: types are collections, days pages."""
    e = read(spark, d, "events").select("user_id", F.to_date("ts").alias("page"), F.col("event_id").alias("pos"), F.col("event_type").alias("collection"), F.pmod("event_id", F.lit(5)).alias("key"), F.round("value", 3).alias("value"))
    return answers.merged_basis(e, "user_id").select("user_id", "collection", "key", "pos", "value")


QUERIES = {f.__name__: f for f in (fact_answers, answer_overview, answer_search, answer_targets, basis_union)}

#: Each item: the collections of its evidence and its answer, in SQL.
_CTX, _DATA = ("ctx",), ("obs", "sim")
_GRADE = "CASE WHEN {} THEN 'yes' WHEN {} THEN 'partially' ELSE 'i_cannot_answer' END"


def _item(i: str) -> tuple[tuple[str, ...], str]:
    yes = lambda c: _GRADE.format(c, "false")
    part = lambda c: _GRADE.format("false", c)
    last = i.rsplit(".", 1)[-1]
    if i == "TAN_1.3":
        return (), "'yes'"
    if i in ("TAN_1.1", "TAN_1.2"):
        return ("head", "par"), part("title IS NOT NULL OR n_parameters > 0")
    if i == "TAN_2.1.3":
        return (*_CTX, *_DATA), "'i_cannot_answer'"
    if i in ("TAN_2.1.1", "TAN_2.1.2", "TAN_2.3.1"):
        return (*_CTX, *_DATA), _GRADE.format("purpose <> '' AND context_quote <> ''", "purpose <> '' AND purpose <> 'not_reported' OR n_observed + n_simulated > 0")
    if i == "TAN_2.2.1":
        return ("par", *_CTX), part("n_parameters > 0")
    if i in ("TAN_2.4.1", "TAN_2.4.3.1"):
        return (*_CTX, "struc", "asm"), part("model_origin <> '' OR k % 9 < 2 OR n_assumptions > 0")
    if i == "TAN_2.4.3.2":
        return (*_CTX, "struc", "asm"), yes("n_compartments > 0")
    if i == "TAN_2.4.2A":
        return ("par",), part("n_parameters > 0")
    if i == "TAN_2.4.5A":
        return ("par",), yes("n_parameters > 0")
    if i == "TAN_2.4.5B":
        return ("par",), _GRADE.format("n_parameters > 0 AND n_referenced = n_parameters", "n_referenced > 0")
    if i == "TAN_2.4.5C":
        return ("par",), part("n_uncertain > 0")
    if i == "TAN_2.4.2B":
        return _DATA, yes("k % 2 = 1 AND k % 3 = 0")
    if i == "TAN_2.4.2C":
        return _DATA, yes("k % 2 = 1 AND k % 3 <> 0")
    if i == "TAN_2.5.1A":
        return _DATA, _GRADE.format("n_observed > 0 AND n_simulated > 0", "n_observed + n_simulated > 0")
    if i == "TAN_2.5.1B":
        return _DATA, yes("k % 7 = 0")
    if i.startswith("TAN_2.4.3."):
        if int(last) < 9:
            return ("abs",) if last == "3" else (), yes("k % 4 = 0" if last in ("3", "6") else "false")
        return ("asm",), yes("k % 4 = 1" if last == "10" else "false")
    if i == "TAN_2.4.4":
        return ("struc",), part("equations_provided = 'full'")
    if i == "TAN_2.4.6A":
        return ("dose", *_DATA, *_CTX), yes("n_dosing > 0")
    if i == "TAN_2.4.6B":
        return ("dose", *_DATA, *_CTX), part("n_observed + n_simulated > 0")
    if i == "TAN_2.4.7":
        return ("soft",), _GRADE.format("k % 5 + 1 >= 4", "true")
    return ("sens",), part("n_sensitivity > 0")  # TAN_2.5.2A and B


#: Each collection: when it is there, and whether its piece has a quote, a
#: place, and something to look up.
_SETS = {
    "ctx": ("purpose <> '' AND purpose <> 'not_reported'", "context_quote IS NOT NULL", "false", "context_quote IS NOT NULL"), "head": ("title IS NOT NULL", "true", "false", "title <> 'N/A'"), "par": ("n_parameters > 0", "false", "true", "true"),
    "obs": ("n_observed > 0", "true", "false", "true"), "sim": ("n_simulated > 0", "false", "true", "true"), "dose": ("n_dosing > 0", "true", "false", "false"), "asm": ("n_assumptions > 0", "true", "true", "true"), "struc": ("k % 9 < 2", "false", "k % 9 = 0", "k % 9 = 0"),
    "abs": ("k % 4 = 0", "true", "true", "true"), "sens": ("n_sensitivity > 0", "true", "true", "true"), "soft": ("k % 2 = 0", "true", "false", "true"),
}


def _any(names, f) -> str:
    return "(" + " OR ".join(f"coalesce({f(*_SETS[n])}, false)" for n in names) + ")" if names else "false"


def _rows() -> str:
    out = []
    for k, i in enumerate(ITEMS):
        sets, response = _item(i)
        n = " + ".join(f"coalesce({_SETS[s][0]}, false)::INT" for s in sets) or "0"
        out.append(f"SELECT k, '{i}' AS item_id, {k} AS o, {response} AS asked, ({n})::BIGINT AS n_evidence, {_any(sets, lambda t, q, p, s: f'({t}) AND ({q}) AND ({p})')} AS direct, {_any(sets, lambda t, q, p, s: f'({t}) AND (({q}) OR ({p}))')} AS partial, {_any(sets, lambda t, q, p, s: f'({t}) AND ({s})')} AS sound FROM X")
    return " UNION ALL ".join(out)


_A = f"""X AS (SELECT c_custkey AS k, {', '.join(f'{e.replace("k %", "c_custkey %")} AS {n}' for n, e in K.items())} FROM customer), I AS ({_rows()}),
R AS (SELECT *, CASE WHEN item_id <> 'TAN_1.3' AND NOT sound THEN '{NONE}' ELSE asked END AS response FROM I), A AS (SELECT k, item_id, o, response, CASE WHEN response = '{NONE}' THEN 'low' WHEN direct THEN 'high' WHEN partial THEN 'medium' ELSE 'low' END AS confidence, n_evidence FROM R)"""
ORACLE_SQL = {
    "fact_answers": f"WITH {_A} SELECT k, item_id, response, confidence, n_evidence FROM A",
    "answer_overview": f"""WITH {_A} SELECT k, count(*) FILTER (response = '{NONE}') AS n_open, (36 - count(*) FILTER (response = '{NONE}')) || '/36 items have at least some supported evidence; ' || count(*) FILTER (response = '{NONE}') || '/36 remain {NONE}' AS fit,
  coalesce(string_agg(item_id, ',' ORDER BY o) FILTER (response = '{NONE}'), '') AS gaps FROM A GROUP BY k""",
    "answer_targets": f"WITH {_BOTH} SELECT doc, coalesce(string_agg(DISTINCT s, ',' ORDER BY s), '') AS targets FROM (SELECT doc, unnest(string_split(subjects, '|')) AS s FROM T) WHERE s <> '' GROUP BY doc",
    "basis_union": "SELECT user_id, event_type AS collection, key, event_id AS pos, value FROM (SELECT user_id, event_type, event_id % 5 AS key, event_id, round(value, 3) AS value, row_number() OVER (PARTITION BY user_id, event_type, event_id % 5 ORDER BY ts::DATE, event_id) AS k FROM events) WHERE k = 1",
    "answer_search": f"WITH {_A} SELECT k, count(*) AS n FROM A WHERE item_id IN ('TAN_2.5.2A', 'TAN_2.5.2B') AND response = 'partially' AND n_evidence > 0 GROUP BY k",
}
