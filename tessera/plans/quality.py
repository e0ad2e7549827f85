"""Queries on rules, classes, questionnaires and listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.classify import parameter_class
from ..operators import assess, rules
from .common import read


def plausibility_rules(spark, d):
    p = read(spark, d, "part")
    names = F.element_at(F.array(*map(F.lit, ("volume", "clearance cl", "half life", "rate ka", "fraction", "frequency"))), F.pmod("p_size", F.lit(6)).cast("int") + 1)
    units = F.element_at(F.array(*map(F.lit, ("L/kg", "L/h", "h", "1/h", "%", "L"))), F.pmod("p_partkey", F.lit(6)).cast("int") + 1)
    x = p.select("p_partkey", names.alias("n"), units.alias("u"), F.col("p_retailprice").alias("v"))
    x = x.withColumn("p", rules.plausibility(F.col("n"), F.lit(""), F.col("u")))
    return x.select("p_partkey", F.coalesce("p.rule", F.lit(-1)).alias("rule"), F.coalesce(~F.col("v").between(F.col("p.low"), F.col("p.high")), F.lit(False)).alias("flagged"))


def unit_dictionary(spark, d):
    p = read(spark, d, "part")
    sub = F.element_at(F.array(*map(F.lit, ("renal_clearance", "organ_volume", "rate_constant", "km", "other"))), F.pmod("p_size", F.lit(5)).cast("int") + 1)
    unit = F.element_at(F.array(*map(F.lit, ("L/h", "mL", "1/min", "ug", ""))), F.pmod("p_partkey", F.lit(5)).cast("int") + 1)
    return p.select("p_partkey", sub.alias("subclass"), F.coalesce(rules.unit_allowed(sub, unit).cast("string"), F.lit("no rule")).alias("allowed"))


def class_rules(spark, d):
    p = read(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    got = parameter_class(F.col("p_type"), F.concat_ws(" ", "p_name", "p_type"), ("small", "red", "gear"), ("blue", "gizmo", "hot"))
    return p.groupBy(got.alias("class")).agg(F.count("*").alias("n"), F.min("p_partkey").alias("first_part"))


def questionnaire(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "source", "lang", "n_chars")
    items = F.array(*map(F.lit, assess.ITEMS))
    a = docs.select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(35), F.lit(5))).alias("i"), "n_chars", "lang")
    a = a.select("doc_id", F.element_at(items, F.col("i") + 1).alias("item_id"), F.when(F.pmod(F.col("doc_id") + F.col("i"), F.lit(3)) == 0, "Yes").when(F.pmod(F.col("doc_id") + F.col("i"), F.lit(3)) == 1, "no").alias("response"), F.when(F.col("n_chars") > 1000, F.col("lang")).alias("quote"), F.when(F.col("lang") == "en", "page 1").alias("location"))
    return assess.summary(assess.questionnaire(docs, a, "doc_id"), "doc_id")


def doc_listing(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    li = read(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_discount")
    x = read(spark, d, "customer").select("c_custkey").join(o, F.col("c_custkey") == F.col("o_custkey")).join(li, F.col("o_orderkey") == F.col("l_orderkey"))
    return x.groupBy("c_custkey").agg(F.count_distinct("o_orderkey").alias("n_docs"), F.count("*").alias("n_parameters"), F.count_if(F.col("l_discount") > 0.05).alias("n_supported"), F.array_join(F.sort_array(F.collect_set("l_returnflag")), ",").alias("compounds"), F.array_join(F.sort_array(F.collect_set("o_orderpriority")), ",").alias("species"))


def facet_search(spark, d):
    q = F.lit("ol")
    p = read(spark, d, "part")
    hit = F.contains(F.lower("p_name"), q) | F.contains(F.lower("p_brand"), q) | F.contains(F.lower("p_type"), q)
    return p.filter(hit & (F.col("p_size") > 5)).groupBy("p_type").agg(F.count("*").alias("n"), F.count_distinct("p_brand").alias("n_brands"))


_ITEMS = "[" + ", ".join(f"'{i}'" for i in assess.ITEMS) + "]"

QUERIES = {f.__name__: f for f in (plausibility_rules, unit_dictionary, class_rules, questionnaire, doc_listing, facet_search)}
ORACLE_SQL = {
    "plausibility_rules": """WITH x AS (SELECT p_partkey, ['volume', 'clearance cl', 'half life', 'rate ka', 'fraction', 'frequency'][p_size % 6 + 1] AS n, ['l/kg', 'l/h', 'h', '1/h', '%', 'l'][p_partkey % 6 + 1] AS u, p_retailprice AS v FROM part),
r AS (SELECT *, CASE WHEN n = 'volume' AND contains(u, 'l/kg') THEN 0 WHEN n = 'volume' AND contains(u, 'l') THEN 1 WHEN n = 'clearance cl' AND contains(u, 'l/h') THEN 2
  WHEN n = 'half life' AND contains(u, 'h') THEN 4 WHEN n = 'rate ka' AND contains(u, '1/h') THEN 5 WHEN n = 'fraction' AND contains(u, '%') THEN 6 ELSE -1 END AS rule FROM x)
SELECT p_partkey, rule, CASE rule WHEN -1 THEN false WHEN 0 THEN v NOT BETWEEN 0.0001 AND 500 WHEN 1 THEN v NOT BETWEEN 0.0001 AND 500 WHEN 2 THEN v NOT BETWEEN 0 AND 5000 WHEN 4 THEN v NOT BETWEEN 0.001 AND 50000 ELSE v NOT BETWEEN 0 AND 100 END AS flagged FROM r""",
    "unit_dictionary": """WITH x AS (SELECT p_partkey, ['renal_clearance', 'organ_volume', 'rate_constant', 'km', 'other'][p_size % 5 + 1] AS subclass, ['l/h', 'ml', '1/min', 'ug', ''][p_partkey % 5 + 1] AS u FROM part)
SELECT p_partkey, subclass, CASE subclass WHEN 'other' THEN 'no rule' WHEN 'renal_clearance' THEN CASE WHEN u = 'l/h' THEN 'true' ELSE 'false' END
  WHEN 'organ_volume' THEN CASE WHEN u IN ('l/h', 'ml', '') THEN 'true' ELSE 'false' END WHEN 'rate_constant' THEN CASE WHEN u = '1/min' THEN 'true' ELSE 'false' END ELSE 'false' END AS allowed FROM x""",
    "class_rules": r"""WITH x AS (SELECT p_partkey, lower(p_type) AS s, lower(p_name || ' ' || p_type) AS t FROM part)
SELECT CASE WHEN contains(t, 'small') OR regexp_matches(t, '\b(red|gear)\b') THEN 'physiological' WHEN regexp_matches(t, '\b(blue|hot)\b') OR contains(t, 'gizmo') THEN 'biochemical' ELSE 'physiological' END AS class,
  count(*) AS n, min(p_partkey) AS first_part FROM x GROUP BY 1""",
    "questionnaire": f"""WITH i AS (SELECT u AS i, {_ITEMS}[u + 1] AS item_id FROM unnest(range(0, 36)) AS t(u)),
g AS (SELECT DISTINCT doc_id, i, item_id, n_chars, lang FROM documents, i),
a AS (SELECT *, i % 5 = 0 AND n_chars > 1000 AS q, i % 5 = 0 AND lang = 'en' AS l, CASE WHEN i % 5 <> 0 THEN 'n' WHEN (doc_id + i) % 3 = 0 THEN 'yes' WHEN (doc_id + i) % 3 = 1 THEN 'no' ELSE 'n' END AS r FROM g),
f AS (SELECT doc_id, item_id, CASE WHEN item_id = 'TAN_1.3' THEN 'yes' WHEN r = 'yes' AND NOT q AND NOT l THEN 'n' ELSE r END AS r FROM a)
SELECT doc_id, count(*) AS n_items, count(*) FILTER (r = 'yes') AS n_yes, count(*) FILTER (r = 'no') AS n_no, count(*) FILTER (r = 'n') AS n_open,
  round(100 * (36 - count(*) FILTER (r = 'n')) / 36.0::DOUBLE, 1) AS completeness, array_to_string(list_sort(list(item_id) FILTER (r = 'n'))[1:5], ',') AS gaps FROM f GROUP BY doc_id""",
    "doc_listing": """SELECT c_custkey, count(DISTINCT o_orderkey) AS n_docs, count(*) AS n_parameters, count(*) FILTER (l_discount > 0.05::DOUBLE) AS n_supported,
  string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS compounds, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS species
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey GROUP BY c_custkey""",
    "facet_search": "SELECT p_type, count(*) AS n, count(DISTINCT p_brand) AS n_brands FROM part WHERE p_size > 5 AND (contains(lower(p_name), 'ol') OR contains(lower(p_brand), 'ol') OR contains(lower(p_type), 'ol')) GROUP BY p_type",
}
