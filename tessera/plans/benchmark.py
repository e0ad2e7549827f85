"""Queries on the benchmark's comparison: even lines of a document stand for
what was extracted, odd ones for what was curated."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import benchmark, match
from .verification import BASE, PARAMETERS, _pick, parameters_and_tables

SYNONYMS = _pick(7, "", "rlz", "Riluzole", "PFOA", "pfoa ", "Rilutor ASD", "PFHxS")
SPECIES = _pick(5, "", "Cynomolgus monkey", "Adult", "Wistar rats", "Mice")


def _sides(spark, d):
    p, _ = parameters_and_tables(spark, d, tables=False)
    text, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    x = p.select(
        "doc", "ord", F.expr(SYNONYMS.replace("k %", "ord %")).alias("compound"), F.expr(SPECIES.replace("k %", "ord %")).alias("species"), text.alias("subject_species"), F.lit("infant").alias("life_stage"), text.alias("symbol_standardized"), "symbol",
        text.alias("name_standardized"), "name", "value", number.alias("ci_low"), number.alias("ci_high"), "low", "high", text.alias("unit_standardized"), "unit", F.array_join("formulation", ",").alias("formulation"), "directness", text.alias("parameter_id"), "derivation", "source_table",
    )
    x = benchmark.comparable(x)
    return x.filter("ord % 2 = 0"), x.filter("ord % 2 = 1")


def comparison_form(spark, d):
    pred, gold = _sides(spark, d)
    return pred.unionByName(gold).select("doc", "ord", "compound", "species", "symbol", "name", "unit", "ci_low", "ci_high", "inherited")


def greedy_benchmark(spark, d):
    pred, gold = _sides(spark, d)
    return match.greedy(benchmark.strict(benchmark.near_pairs(pred, gold, "doc")), "doc")


def benchmark_scores(spark, d):
    return benchmark.scores(*_sides(spark, d), "doc")


def benchmark_differences(spark, d):
    missed, extra = benchmark.differences(*_sides(spark, d), "doc")
    per = lambda df, n: df.groupBy("doc").agg(F.count("*").alias("n"), F.min("ord").alias("first")).withColumn("side", F.lit(n))
    return per(missed, "missed").unionByName(per(extra, "extra"))


QUERIES = {f.__name__: f for f in (comparison_form, greedy_benchmark, benchmark_scores, benchmark_differences)}

_N = rf"""B AS ({BASE}), P AS ({PARAMETERS}), Q AS (SELECT doc, ord, regexp_replace(upper({SYNONYMS.replace('k %', 'ord %')}), '[^A-Z0-9]', '', 'g') AS c0, coalesce(nullif({SPECIES.replace('k %', 'ord %')}, ''), 'infant') AS s0,
  regexp_replace(lower(coalesce(symbol, '')), '[^a-z0-9]', '', 'g') AS symbol, lower(trim(name)) AS name, value, low AS ci_low, high AS ci_high, regexp_replace(lower(trim(coalesce(unit, ''))), '\s+', ' ', 'g') AS unit,
  coalesce(directness, '') = 'inherited_cross_species' OR contains(coalesce(derivation, ''), 'held constant') AS inherited FROM P),
N AS (SELECT * EXCLUDE (c0, s0), CASE WHEN c0 IN ('RLZ', 'RLE', 'RILUTOR', 'RILUTORASD') THEN 'RILUZOLE' ELSE c0 END AS compound,
  CASE WHEN regexp_matches(lower(s0), 'primate|monkey') THEN 'nonhuman primate' WHEN regexp_matches(lower(s0), 'mother|fetus|infant|human|adult|gestation|lactation') THEN 'human' WHEN contains(lower(s0), 'rat') THEN 'rat' WHEN regexp_matches(lower(s0), 'mouse|mice') THEN 'mouse' ELSE lower(trim(s0)) END AS species FROM Q),
V AS (SELECT p.doc, p.ord AS pred, g.ord AS ref, p.compound AS pc, g.compound AS gc, p.species AS ps, g.species AS gs, p.symbol AS py, g.symbol AS gy, p.name AS pn, g.name AS gn, p.unit AS pu, g.unit AS gu, p.ci_low AS pl, g.ci_low AS gl, p.ci_high AS ph, g.ci_high AS gh
  FROM N AS p JOIN N AS g ON p.doc = g.doc AND p.ord % 2 = 0 AND g.ord % 2 = 1 AND (p.value IS NULL AND g.value IS NULL OR abs(p.value - g.value) <= greatest(0.02::DOUBLE * greatest(abs(p.value), abs(g.value)), 1e-5))),
NAMED AS (SELECT * FROM V WHERE py <> '' AND gy <> '' AND (contains(py, gy) OR contains(gy, py)) OR pn <> '' AND gn <> '' AND (contains(pn, gn) OR contains(gn, pn)) OR py <> '' AND gn <> '' AND (contains(py, gn) OR contains(gn, py)) OR pn <> '' AND gy <> '' AND (contains(pn, gy) OR contains(gy, pn))),
STRICT AS (SELECT * FROM NAMED WHERE (gs = '' OR ps = '' OR ps = gs) AND (gc = '' OR pc = '' OR pc = gc)),
LISTED AS (SELECT * FROM V WHERE (py <> '' AND py = gy OR pn <> '' AND gn <> '' AND (contains(pn, gn) OR contains(gn, pn))) AND (gs = '' OR ps = gs) AND (gc = '' OR pc = gc))"""


def _taken(pairs: str, name: str) -> str:
    """Each prediction in order takes the first free reference, step by step."""
    return f"""{name}_A AS (SELECT doc, pred, list(ref ORDER BY ref) AS refs, row_number() OVER (PARTITION BY doc ORDER BY pred) AS i FROM {pairs} GROUP BY doc, pred),
{name}_G AS (SELECT doc, 0::BIGINT AS i, []::BIGINT[] AS used, NULL::BIGINT AS pred, NULL::BIGINT AS ref FROM (SELECT DISTINCT doc FROM {name}_A) UNION ALL
  SELECT G.doc, A.i, CASE WHEN len(list_filter(A.refs, lambda x: NOT list_contains(G.used, x))) = 0 THEN G.used ELSE list_append(G.used, list_filter(A.refs, lambda x: NOT list_contains(G.used, x))[1]) END, A.pred, list_filter(A.refs, lambda x: NOT list_contains(G.used, x))[1]
  FROM {name}_G AS G JOIN {name}_A AS A ON A.doc = G.doc AND A.i = G.i + 1),
{name} AS (SELECT doc, pred, ref FROM {name}_G WHERE ref IS NOT NULL)"""


ORACLE_SQL = {
    "comparison_form": f"WITH {_N} SELECT doc, ord, compound, species, symbol, name, unit, ci_low, ci_high, inherited FROM N",
    "greedy_benchmark": f"WITH RECURSIVE {_N}, {_taken('STRICT', 'S')} SELECT doc, pred, ref FROM S",
    "benchmark_scores": f"""WITH RECURSIVE {_N}, {_taken('STRICT', 'S')}, {_taken('NAMED', 'R')},
W AS (SELECT doc, count(*) AS tp, count(*) FILTER (pu = '' OR gu = '' OR contains(translate(pu, '^ *', ''), translate(gu, '^ *', '')) OR contains(translate(gu, '^ *', ''), translate(pu, '^ *', ''))) AS u, count(*) FILTER (ps = gs) AS s, count(*) FILTER (pc = gc) AS c,
  count(*) FILTER (gl IS NOT NULL AND pl IS NOT NULL AND abs(pl - gl) <= 0.02 * greatest(abs(pl), abs(gl)) AND (ph IS NULL AND gh IS NULL OR abs(ph - gh) <= 0.02 * greatest(abs(ph), abs(gh)))) AS ci FROM S JOIN V USING (doc, pred, ref) GROUP BY doc),
T AS (SELECT doc, count(*) AS tp FROM R GROUP BY doc), D AS (SELECT doc, count(*) FILTER (ord % 2 = 1) AS g, count(*) FILTER (ord % 2 = 0) AS p, count(ci_low) FILTER (ord % 2 = 1) AS cis FROM N GROUP BY doc),
X AS (SELECT D.*, coalesce(W.tp, 0) AS st, coalesce(T.tp, 0) AS pt, coalesce(u, 0) AS u, coalesce(s, 0) AS s, coalesce(c, 0) AS c, coalesce(ci, 0) AS ci FROM D LEFT JOIN W USING (doc) LEFT JOIN T USING (doc))
SELECT doc, g AS ground_truth_count, p AS extracted_count, st AS strict_tp, pt AS partial_tp, p - st AS fp, g - st AS fn,""" + ", ".join(
        f"round(coalesce(100.0::DOUBLE * {a} / nullif({b}, 0), {e}), 2) AS {n}" for a, b, e, n in (
            ("st", "p", 0, "strict_precision"), ("st", "g", 0, "strict_recall"), ("(2 * st)", "(g + p)", 0, "strict_f1"), ("pt", "p", 0, "partial_precision"), ("pt", "g", 0, "partial_recall"), ("(2 * pt)", "(g + p)", 0, "partial_f1"),
            ("st", "g", 0, "value_accuracy"), ("u", "g", 0, "unit_accuracy"), ("s", "g", 0, "species_accuracy"), ("c", "g", 0, "compound_accuracy"), ("ci", "cis", 100, "ci_accuracy"))) + " FROM X",
    "benchmark_differences": f"""WITH RECURSIVE {_N}, {_taken('LISTED', 'S')}
SELECT doc, count(*) AS n, min(ord) AS first, 'missed' AS side FROM N WHERE ord % 2 = 1 AND NOT EXISTS (SELECT 1 FROM S WHERE S.doc = N.doc AND S.ref = N.ord) GROUP BY doc UNION ALL
SELECT doc, count(*), min(ord), 'extra' FROM N WHERE ord % 2 = 0 AND NOT EXISTS (SELECT 1 FROM S WHERE S.doc = N.doc AND S.pred = N.ord) GROUP BY doc""",
}
