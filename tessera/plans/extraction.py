"""Queries on steps between answers and records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.python import repair_json, title_ratio
from ..operators import extract, inference, segments
from .common import LINES, lines, read


def flatten_blocks(spark, d):
    x = lines(spark, d, "l_quantity", "l_returnflag", "l_linestatus", "l_tax")
    p = F.struct(F.col("ord").alias("o"), F.concat(F.lit("P"), "l_linestatus").alias("name"), F.col("l_quantity").cast("int").alias("value"), F.when(F.col("l_tax") > 0.04, F.lit("rat")).alias("species"), F.when(F.col("l_tax") > 0.06, F.lit("mg")).alias("unit"), F.lit(None).cast("string").alias("class"))
    b = x.groupBy("l_orderkey", "l_returnflag").agg(F.array_sort(F.collect_list(p)).alias("parameters"))
    b = b.select("l_orderkey", F.col("l_returnflag").alias("block_ord"), F.lit("human").alias("species"), F.lit("L/h").alias("unit"), F.col("l_returnflag").alias("class"), "parameters")
    return extract.flatten_blocks(b, "l_orderkey")


def match_offsets(spark, d):
    return segments.matches(read(spark, d, "documents"), "doc_id", "text", "[0-9]{4,}")


def ratio_sweep(spark, d):
    """Numbers with `for` and a name, near a word that tells what they are."""
    docs = read(spark, d, "documents").select("doc_id", F.concat_ws(" ", "text", F.concat(F.lit("a placental ratio of 0."), F.col("doc_id").cast("string"), F.lit(" for PFOA and 12 for the rest."))).alias("text"))
    x = segments.matches(docs, "doc_id", "text", r"[0-9]*\.?[0-9]+\s+for\s+[A-Z0-9][A-Za-z0-9_-]{1,10}", 200)
    return x.filter(F.lower("context").rlike("placental|cord/mother")).select("doc_id", "found")


def json_repair(spark, d):
    e = read(spark, d, "events").select("event_id", F.concat(F.lit("Answer: "), F.substring("props", F.lit(1), F.length("props") - F.pmod("event_id", F.lit(2)).cast("int"))).alias("t"))
    return e.select("event_id", F.get_json_object(repair_json("t"), "$.k").alias("k"))


def title_match(spark, d):
    p = read(spark, d, "part").select("p_partkey", "p_name", F.concat(F.upper("p_name"), F.when(F.col("p_partkey") % 2 == 0, F.lit("!")).otherwise(" of another kind altogether")).alias("other"))
    return p.select("p_partkey", (title_ratio("p_name", "other") > 0.8).alias("same"))


def title_lines(spark, d):
    x = segments.lines(read(spark, d, "documents"), "doc_id", "text")
    return extract.title_line(x, "doc_id")


def table_boxes(spark, d):
    x = read(spark, d, "lineitem")
    label = F.when(F.col("l_linenumber") % 5 == 0, "figure").when(F.col("l_linenumber") % 2 == 0, "Table").otherwise("borderless table")
    b = x.select("l_orderkey", label.alias("label"), (F.col("l_discount") * 10).alias("score"), (F.col("l_quantity") * 12.5).alias("x0"), (F.col("l_quantity") * 12.5 + F.pmod("l_partkey", F.lit(7)) * 60.0).alias("x1"), (F.col("l_tax") * 1000.0).alias("y0"), (F.col("l_tax") * 1000.0 + 100.0 + F.pmod("l_suppkey", F.lit(5)) * 200.0).alias("y1"), F.lit(1030).alias("width"), F.lit(1000).alias("height"))
    return extract.good_boxes(b, "l_orderkey").select("l_orderkey", "n_boxes", F.round("best", 6).alias("best"), "x0", "y0", "x1", "y1")


def _pick(p, values):
    return F.element_at(F.array(*map(F.lit, values)), F.pmod(p, F.lit(len(values))).cast("int") + 1)


DOSE_UNITS, DOSE_NOTES = ("mg/kg/day", "L/h", "mg", "1/min", "mL/min", "ug/h/kg per day"), ("", "Tmc of the tubule", "vmax", "as ka", "weekly")
UNITS_BEFORE, UNITS_AFTER = ("µg/L", "mg/L", "ng", "L/h", "mL", "pmol/min", "μmol"), ("ug/L", "g/L", "ng", "l/h", "mL/h")


def real_doses(spark, d):
    p = read(spark, d, "part").select("p_partkey", _pick("p_partkey", DOSE_UNITS).alias("unit"), _pick("p_size", DOSE_NOTES).alias("t"))
    return extract.real_doses(p, "unit", "t")


def unit_prefix_guard(spark, d):
    return read(spark, d, "part").select("p_partkey", extract.guard_prefix(_pick("p_partkey", UNITS_BEFORE), _pick("p_size", UNITS_AFTER)).alias("unit"))


def compound_scope(spark, d):
    x = read(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("compound"), F.when(F.col("o_orderstatus") == "F", "physiological").otherwise("x").alias("class"))
    return extract.of_compound(x, "compound", "1-urgent").groupBy("class").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"))


def evidence_union(spark, d):
    o = read(spark, d, "orders").select(F.col("o_custkey").alias("k"), "o_orderkey", F.lit("a").alias("src"))
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.lit(0).cast("long").alias("o_orderkey"), F.lit("b").alias("src"))
    return extract.union_first([o, c], ["k"], "o_orderkey")


def larger_structure(spark, d):
    x = lines(spark, d, "l_returnflag").groupBy("l_orderkey", "l_returnflag").agg(F.array_sort(F.collect_list("ord")).alias("items"))
    x = x.withColumn("v", F.ascii("l_returnflag"))
    return extract.larger_structure(x, "l_orderkey", "items", "v").select("l_orderkey", F.array_join("items", ",").alias("items"))


def model_stub(spark, d):
    p = read(spark, d, "part").select("p_partkey", F.concat(F.lit("V = "), F.col("p_size").cast("string"), F.lit(" L and CL of "), F.format_string("%.1f", F.floor("p_retailprice").cast("double")), F.lit(" L/h")).alias("t"))
    out = inference.run(p, "t")
    kind = "array<struct<symbol: string, value: double, unit: string>>"
    return out.select("p_partkey", F.col("answer.ok").alias("ok"), F.inline(F.from_json("answer.json", kind)))


def batch_summary(spark, d):
    x = read(spark, d, "documents").select((F.col("n_chars") > 100).alias("ok"), "n_chars")
    return extract.batch_summary(x, "ok", "n_chars")


QUERIES = {f.__name__: f for f in (
    flatten_blocks, match_offsets, ratio_sweep, json_repair, title_match, title_lines, table_boxes, real_doses, unit_prefix_guard, compound_scope, evidence_union,
    larger_structure, model_stub, batch_summary,
)}
ORACLE_SQL = {
    "flatten_blocks": f"""WITH {LINES}, B AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY ord) - 1 AS pos FROM L),
P AS (SELECT l_orderkey, l_returnflag AS block_ord, pos::INT AS pos, 'P' || l_linestatus AS name, l_quantity::INT AS value, CASE WHEN l_tax > 0.04::DOUBLE THEN 'rat' ELSE 'human' END AS species, CASE WHEN l_tax > 0.06::DOUBLE THEN 'mg' ELSE 'L/h' END AS unit, l_returnflag AS class FROM B)
SELECT *, 'param_' || substr(sha256(lower(concat_ws('|', name, species, value, unit))), 1, 16) AS parameter_id FROM P""",
    "match_offsets": """WITH x AS (SELECT doc_id, regexp_split_to_array(text, '[0-9]{4,}') AS p, regexp_extract_all(text, '[0-9]{4,}') AS m FROM documents)
SELECT doc_id, (list_sum(list_transform(p[1:k], lambda s: length(s))) + coalesce(list_sum(list_transform(m[1:k - 1], lambda s: length(s))), 0))::INT AS start, m[k] AS found FROM x, unnest(range(1, len(m) + 1)) AS r(k)""",
    "ratio_sweep": "SELECT doc_id, '0.' || doc_id || ' for PFOA' AS found FROM documents",
    "json_repair": "SELECT event_id, props->>'k' AS k FROM events",
    "title_match": "SELECT p_partkey, p_partkey % 2 = 0 AS same FROM part",
    "title_lines": """WITH l AS (SELECT doc_id, i, trim(ls[i], ' ') AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), unnest(range(1, len(ls) + 1)) AS r(i)),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM l WHERE length(t) > 20)
SELECT doc_id, arg_min(t, i) AS title FROM k WHERE k <= 8 AND length(t) < 300 AND length(regexp_replace(t, '[^0-9]', '', 'g')) / length(t)::DOUBLE <= 0.05::DOUBLE AND length(t) - length(replace(t, ',', '')) <= 3 GROUP BY doc_id""",
    "table_boxes": """WITH b AS (SELECT l_orderkey, l_discount * 10 AS score, (l_quantity * 12.5::DOUBLE)::DOUBLE AS fx0, l_quantity * 12.5::DOUBLE + l_partkey % 7 * 60.0::DOUBLE AS fx1, l_tax * 1000.0::DOUBLE AS fy0, l_tax * 1000.0::DOUBLE + 100.0::DOUBLE + l_suppkey % 5 * 200.0::DOUBLE AS fy1 FROM lineitem WHERE l_linenumber % 5 <> 0),
i AS (SELECT l_orderkey, score, trunc(fx0)::BIGINT AS x0, trunc(fx1)::BIGINT AS x1, trunc(fy0)::BIGINT AS y0, trunc(fy1)::BIGINT AS y1 FROM b),
g AS (SELECT * FROM i WHERE score >= 0.3::DOUBLE AND (x1 - x0) * (y1 - y0) >= 10300 AND (x1 - x0) * (y1 - y0) <= 978500 AND x1 <> x0 AND (y1 - y0) / (x1 - x0)::DOUBLE <= 10)
SELECT l_orderkey, count(*) AS n_boxes, round(max(score), 6) AS best, greatest(0, min(x0) - 51) AS x0, greatest(0, min(y0) - 100) AS y0, least(1030, max(x1) + 51) AS x1, least(1000, max(y1) + 150) AS y1 FROM g GROUP BY l_orderkey""",
    "real_doses": f"SELECT p_partkey, unit, t FROM (SELECT p_partkey, {list(DOSE_UNITS)}[p_partkey % {len(DOSE_UNITS)} + 1] AS unit, {list(DOSE_NOTES)}[p_size % {len(DOSE_NOTES)} + 1] AS t FROM part) WHERE unit IN ('mg/kg/day', 'mg', 'ug/h/kg per day') AND t IN ('', 'vmax', 'weekly')",
    "unit_prefix_guard": f"""WITH x AS (SELECT lower(replace(replace({list(UNITS_BEFORE)}[p_partkey % {len(UNITS_BEFORE)} + 1], 'µ', 'u'), 'μ', 'u')) AS o, {list(UNITS_AFTER)}[p_size % {len(UNITS_AFTER)} + 1] AS s, p_partkey FROM part)
SELECT p_partkey, CASE WHEN regexp_matches(o, 'mg') AND NOT contains(lower(s), 'mg') OR contains(o, 'ug') AND NOT contains(lower(s), 'ug') OR contains(o, 'ng') AND NOT contains(lower(s), 'ng') OR contains(o, 'ml') AND NOT contains(lower(s), 'ml')
  OR contains(o, 'pmol') AND NOT contains(lower(s), 'pmol') OR contains(o, 'umol') AND NOT contains(lower(s), 'umol') THEN NULL ELSE s END AS unit FROM x""",
    "compound_scope": """SELECT CASE WHEN o_orderstatus = 'F' THEN 'physiological' ELSE 'x' END AS class, count(*) AS n, min(o_orderkey) AS first_key FROM orders
WHERE o_orderkey % 5 = 0 OR o_orderstatus = 'F' OR o_orderpriority = '1-URGENT' GROUP BY 1""",
    "evidence_union": "SELECT c_custkey AS k, coalesce(m, 0) AS o_orderkey, CASE WHEN m IS NULL THEN 'b' ELSE 'a' END AS src FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS m FROM orders GROUP BY 1) ON o_custkey = c_custkey",
    "larger_structure": f"""WITH {LINES}, G AS (SELECT l_orderkey, l_returnflag, count(*) AS n, string_agg(ord::VARCHAR, ',' ORDER BY ord) AS items FROM L GROUP BY ALL)
SELECT l_orderkey, items FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, l_returnflag) AS k FROM G) WHERE k = 1""",
    "model_stub": """SELECT p_partkey, true AS ok, 'V' AS symbol, p_size::DOUBLE AS value, 'L' AS unit FROM part UNION ALL SELECT p_partkey, true, 'CL', floor(p_retailprice), 'L/h' FROM part""",
    "batch_summary": "SELECT count(*) AS documents, count(*) FILTER (n_chars > 100) AS succeeded, count(*) FILTER (n_chars <= 100) AS failed, sum(n_chars)::BIGINT AS total FROM documents",
}
