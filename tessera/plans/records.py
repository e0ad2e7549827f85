"""Queries on the repair of records."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.text import stable_id
from ..operators import physiology, repair
from .common import LINES, lines, read


def dedup_keep_first(spark, d):
    key = F.sha2(F.lower(F.trim(F.coalesce("text", F.lit("")))), 256)
    docs = read(spark, d, "documents").select("doc_id", "source", "n_chars", key.alias("k"))
    return repair.keep_first(docs, ["k"], ["doc_id"]).select("doc_id", "source", "n_chars")


def stable_ids(spark, d):
    x = lines(spark, d, "l_partkey", "l_returnflag", "l_quantity")
    ident = stable_id(F.col("l_orderkey"), F.col("l_partkey"), F.col("l_returnflag"), F.col("l_quantity").cast("int"))
    return x.select("l_orderkey", "ord", ident.alias("parameter_id"))


def unique_suffix(spark, d):
    """Some names are made to look like another's suffixed repeats."""
    taken = F.when(F.col("p_partkey") % 11 == 0, F.concat(F.col("p_name"), F.lit("_"), (F.col("p_partkey") % 4).cast("string"))).otherwise(F.col("p_name"))
    return repair.unique_ids(read(spark, d, "part").select("p_partkey", taken.alias("p_name")), "p_name", ["p_partkey"])


def forward_fill(spark, d):
    e = read(spark, d, "events").select("event_id", "user_id", "ts", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("known"))
    return e.withColumn("filled", repair.forward_fill(e, "known", ["user_id"], ["ts", "event_id"])).select("event_id", "user_id", "filled")


def running_state(spark, d):
    e = read(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    label = repair.running_label(F.col("event_type") == "click", ["user_id"], ["ts", "event_id"], ("Rat", "Human"))
    return e.withColumn("state", label).groupBy("user_id", F.coalesce("state", F.lit("none")).alias("state")).agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


def first_value_conflict(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return repair.conflicts(o, ["o_custkey", "o_orderpriority"], "o_orderstatus", ["o_orderkey"]).select("o_orderkey", "rule")


def minority_share(spark, d):
    part = read(spark, d, "part").select("p_partkey", "p_brand")
    x = read(spark, d, "lineitem").select("l_orderkey", "l_partkey").join(part, F.col("l_partkey") == F.col("p_partkey"))
    got = repair.share_of_total(x, ["l_orderkey"], "p_brand").filter("n_parts > 1 AND share < 0.15")
    return got.select("l_orderkey", "p_brand", "n", "n_total", F.round("share", 6).alias("share"))


def anti_supplement(spark, d):
    x = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("v")).select(F.col("l_orderkey").alias("k"), F.round("v", 2).alias("v"), F.lit("line").alias("origin"))
    more = read(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.round("o_totalprice", 2).alias("v"), F.lit("order").alias("origin"))
    return repair.supplement(x, more, ["k"])


def donor_inherit(spark, d):
    n = read(spark, d, "nation").join(read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    s = read(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    x = s.select(F.pmod("s_suppkey", F.lit(5)).alias("compound"), F.pmod("s_suppkey", F.lit(97)).cast("string").alias("symbol"), F.col("r_name").alias("species"), F.round("s_acctbal", 2).alias("value"), F.col("s_suppkey").alias("ord"))
    x = x.withColumns({"compound": F.when(F.col("compound") > 0, F.concat(F.lit("c"), F.col("compound").cast("string"))), "symbol": F.concat(F.lit("y"), "symbol"), "species": F.initcap("species")})
    return repair.inherit(x, [], "compound", "symbol", "species", "ord", "europe", ("middle east", "asia", "america"), ("Y13",))


def tiered_lookup(spark, d):
    part = read(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")

    def first_two(keys):
        # The first, and the second for whoever is the first.
        w = Window.partitionBy(*keys).orderBy("p_partkey")
        return part.select("p_partkey", *keys).dropna(subset=keys).withColumn("_k", F.row_number().over(w)).filter("_k <= 2").withColumnRenamed("p_partkey", "found").drop("_k")

    def alike(tier, score, keys):
        c = part.join(first_two(keys), keys).filter("found <> p_partkey")
        return c.select(F.col("p_partkey").alias("want"), F.lit(tier).alias("tier"), F.lit(score).alias("score"), "found")

    best = lambda c: repair.best_tier(c, ["want"], "tier", F.col("score"), ["found"])
    near = best(alike(1, 3, ["p_brand", "p_type", "p_size"]).unionByName(alike(2, 1, ["p_brand", "p_type"])))
    # A price within 3 % lies at most two bands away; one more for rounding.
    band = lambda v: F.coalesce(F.floor(F.ln(v) / F.ln(F.lit(1.03))), F.lit(-(10**6)))
    rest = part.join(near.select(F.col("want").alias("p_partkey")), "p_partkey", "left_anti")
    rest = rest.select(F.col("p_partkey").alias("want"), "p_brand", F.col("p_size").alias("s"), F.col("p_retailprice").alias("v"), F.explode(F.sequence(band(F.col("p_retailprice")) - 3, band(F.col("p_retailprice")) + 3)).alias("band"))
    priced = first_two(["p_brand", "p_retailprice"]).withColumn("p_size", F.lit(None).cast("int")).unionByName(first_two(["p_brand", "p_size", "p_retailprice"]))
    c = rest.join(priced.withColumn("band", band(F.col("p_retailprice"))), ["p_brand", "band"])
    c = c.filter((F.col("want") != F.col("found")) & (F.abs(F.col("v") - F.col("p_retailprice")) <= 0.03 * F.col("v")) & (F.col("p_size").isNull() | (F.col("p_size") == F.col("s"))))
    c = c.select("want", F.lit(3).alias("tier"), F.when(F.col("p_size").isNull(), 0).otherwise(2).alias("score"), "found")
    return near.unionByName(best(c)).select("want", "tier", "score", "found")


def priority_resolve(spark, d):
    docs = read(spark, d, "documents").select(F.sha2("text", 256).alias("k"), "lang", "source")
    src = F.when(F.pmod(F.length("source"), F.lit(2)) == 0, F.concat(F.lit("pmc_"), "lang")).otherwise(F.concat(F.lit("local_"), "lang"))
    a = docs.select("lang", src.alias("source"))
    return repair.resolve(a, "lang", "source", ["local_de", "local_en", "pmc_en", "local_fr", "pmc_fr", "pmc_de", "pmc_es"])


def split_multivalue(spark, d):
    p = read(spark, d, "part").select("p_partkey", F.when(F.col("p_size") % 3 == 0, F.concat_ws(", ", F.col("p_size").cast("string"), (F.col("p_size") * 2).cast("string"), F.lit("nd"))).otherwise(F.col("p_size").cast("string")).alias("value_text"), F.array(F.lit("tablet"), F.lit("capsule")).alias("forms"))
    return repair.split_values(p, "value_text", "forms").select("p_partkey", "value_text", "value", "label")


def view_constraints(spark, d):
    x = lines(spark, d, "l_returnflag", dealt=True).withColumn("class", F.when(F.col("l_returnflag") == "R", "physiological").when(F.col("l_returnflag") == "A", "biochemical"))
    inside, rest = repair.class_views(x, "class", "physiological")
    dup = x.groupBy("l_orderkey", "ord").count().filter("count > 1")
    n = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("check"), "n")
    lost = x.select("l_orderkey", "ord").exceptAll(inside.unionByName(rest).select("l_orderkey", "ord"))
    return n(inside, "system_rows").unionByName(n(rest, "other_rows")).unionByName(n(dup, "duplicate_keys")).unionByName(n(lost, "lost_rows"))


def patch_update(spark, d):
    c = read(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    new = c.filter("c_custkey % 7 = 0").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.lit(0.0)).alias("c_acctbal"), F.lit("REVIEWED").alias("c_mktsegment"), F.lit("x").alias("c_name"))
    return repair.patch(c, new, "c_custkey", ["c_acctbal", "c_mktsegment"])


def corpus_validation(spark, d):
    docs = read(spark, d, "documents").select("source", "doc_id", "lang", "n_chars", F.length("text").alias("len"))
    checks = F.array_compact(F.array(
        F.when(F.col("len") != F.col("n_chars"), "length"), F.when(F.col("len") < 50, "short"), F.when(~F.col("lang").isin("en", "de", "fr", "es"), "language")))
    x = docs.withColumn("errors", checks)
    return x.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum(F.size("errors")).alias("n_errors"), F.bool_and(F.size("errors") == 0).alias("valid"), F.count_if(F.array_contains("errors", "short")).alias("n_short"))


def json_props(spark, d):
    e = read(spark, d, "events").select("event_id", F.from_json("props", "k int").alias("p"), "event_type")
    names = F.create_map(*(F.lit(x) for x in ("click", "yes", "view", "no", "purchase", "yes")))
    return e.select("event_id", F.coalesce("p.k", F.lit(-1)).alias("k"), F.coalesce(F.try_element_at(names, F.col("event_type")), F.lit("i_cannot_answer")).alias("response"))


def merge_first_known(spark, d):
    e = read(spark, d, "events").select("user_id", "event_id", F.when(F.col("event_id") % 4 == 0, F.col("event_type")).alias("a"), F.when(F.col("event_id") % 5 == 1, F.round("value", 3)).alias("b"))
    return repair.first_known(e, "user_id", "event_id", ["a", "b"])


def physio_lookup(spark, d):
    asked = ["Homo sapiens", "wistar", " NHP ", "Mouse", "dog"]
    pick = F.element_at(F.array(*map(F.lit, asked)), F.pmod("c_custkey", F.lit(5)).cast("int") + 1)
    c = read(spark, d, "customer").select("c_custkey", pick.alias("name"), F.when(F.col("c_custkey") % 3 == 0, 60.0).alias("own"))
    return physiology.lookup(c, "name", "own").select("c_custkey", "species", "symbol", "value")


def symbol_descriptions(spark, d):
    """Species and symbols of the table, and what is said of symbols that it lacks."""
    more = read(spark, d, "nation").select(F.col("n_name").alias("symbol"))
    known = physiology.table(spark).select("symbol").distinct()
    out = known.unionByName(more).select("symbol", physiology.describe(F.col("symbol")).alias("description"))
    return out.unionByName(physiology.species(spark).select(F.col("species").alias("symbol"), F.lit("species").alias("description")))


QUERIES = {f.__name__: f for f in (
    dedup_keep_first, stable_ids, unique_suffix, forward_fill, running_state, first_value_conflict, minority_share, anti_supplement, donor_inherit,
    tiered_lookup, priority_resolve, split_multivalue, view_constraints, patch_update, corpus_validation, json_props, merge_first_known, physio_lookup, symbol_descriptions,
)}
_FACTS = ", ".join(f"('{s}', '{n}', {v}::DOUBLE)" for s, vs in physiology.VALUES.items() for (n, _), v in zip(physiology.SYMBOLS, vs, strict=True))
ORACLE_SQL = {
    "dedup_keep_first": "SELECT doc_id, source, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(coalesce(text, ''), ' ')) ORDER BY doc_id) AS k FROM documents) WHERE k = 1",
    "stable_ids": f"WITH {LINES} SELECT l_orderkey, ord, 'param_' || substr(sha256(lower(concat_ws('|', l_orderkey, l_partkey, l_returnflag, l_quantity::INT))), 1, 16) AS parameter_id FROM L",
    "unique_suffix": r"""WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN p_name || '_' || p_partkey % 4 ELSE p_name END AS n FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY p_partkey) AS k, count(*) OVER (PARTITION BY n) AS c FROM p), names AS (SELECT DISTINCT n FROM p),
free AS (SELECT n, i, row_number() OVER (PARTITION BY n ORDER BY i) + 1 AS k FROM (SELECT n, unnest(range(2, max(c) + 6)) AS i FROM r GROUP BY n HAVING max(c) > 1) AS x WHERE NOT EXISTS (SELECT 1 FROM names WHERE names.n = x.n || '_' || x.i))
SELECT p_partkey, CASE WHEN r.k = 1 THEN r.n ELSE r.n || '_' || i END AS p_name FROM r LEFT JOIN free ON free.n = r.n AND free.k = r.k""",
    "forward_fill": "SELECT event_id, user_id, last_value(CASE WHEN event_id % 3 = 0 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS filled FROM events",
    "running_state": """SELECT user_id, CASE WHEN n <= 1 THEN 'none' WHEN n = 2 THEN 'Rat' ELSE 'Human' END AS state, count(*) AS n, min(event_id) AS first_event
FROM (SELECT user_id, event_id, count(*) FILTER (event_type = 'click') OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n FROM events) GROUP BY 1, 2""",
    "first_value_conflict": """SELECT o_orderkey, CASE WHEN o_orderstatus = f THEN 'DUPLICATE_ENTRY' ELSE 'CONFLICTING_ENTRY' END AS rule FROM (
SELECT *, row_number() OVER w AS k, first_value(o_orderstatus) OVER w AS f FROM orders WINDOW w AS (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey)) WHERE k > 1""",
    "minority_share": """WITH p AS (SELECT l_orderkey, p_brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
s AS (SELECT *, sum(n) OVER (PARTITION BY l_orderkey)::BIGINT AS n_total, count(*) OVER (PARTITION BY l_orderkey) AS k FROM p)
SELECT l_orderkey, p_brand, n, n_total, round(n / n_total::DOUBLE, 6) AS share FROM s WHERE k > 1 AND n / n_total::DOUBLE < 0.15""",
    "anti_supplement": """WITH a AS (SELECT l_orderkey AS k, round(sum(l_quantity), 2) AS v FROM lineitem GROUP BY 1)
SELECT k, v, 'line' AS origin FROM a UNION ALL SELECT o_orderkey, round(o_totalprice, 2), 'order' FROM orders WHERE o_orderkey NOT IN (SELECT k FROM a)""",
    "donor_inherit": """WITH x AS (SELECT CASE WHEN s_suppkey % 5 > 0 THEN 'c' || s_suppkey % 5 END AS compound, 'y' || s_suppkey % 97 AS symbol, array_to_string(list_transform(string_split(lower(r_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS species, round(s_acctbal, 2) AS value, s_suppkey AS ord
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
g AS (SELECT *, coalesce(compound, 'none') AS c, list_position(['middle east', 'asia', 'america'], lower(species)) AS r FROM x),
d AS (SELECT c, min(r) AS r FROM g GROUP BY c HAVING bool_or(species = 'Europe')),
l AS (SELECT g.*, row_number() OVER (PARTITION BY c, symbol ORDER BY ord DESC) AS k FROM g JOIN d USING (c, r) WHERE symbol <> 'y13' AND NOT EXISTS (SELECT 1 FROM g AS h WHERE h.species = 'Europe' AND h.c = g.c AND h.symbol = g.symbol))
SELECT compound, symbol, species, value, ord, NULL AS donor FROM x UNION ALL SELECT compound, symbol, 'europe', value, ord, lower(species) FROM l WHERE k = 1""",
    "tiered_lookup": """WITH c AS (SELECT w.p_partkey AS want, p.p_partkey AS found,
  CASE WHEN w.p_type = p.p_type AND w.p_size = p.p_size THEN 1 WHEN w.p_type = p.p_type THEN 2 WHEN abs(w.p_retailprice - p.p_retailprice) <= 0.03::DOUBLE * w.p_retailprice THEN 3 END AS tier,
  CASE WHEN w.p_size = p.p_size THEN 2 ELSE 0 END + CASE WHEN w.p_type = p.p_type THEN 1 ELSE 0 END AS score
  FROM part w JOIN part p ON w.p_brand = p.p_brand AND w.p_partkey <> p.p_partkey)
SELECT want, tier, score, found FROM (SELECT *, row_number() OVER (PARTITION BY want ORDER BY tier, score DESC, found) AS k FROM c WHERE tier IS NOT NULL) WHERE k = 1""",
    "priority_resolve": """WITH a AS (SELECT lang, CASE WHEN length(source) % 2 = 0 THEN 'pmc_' ELSE 'local_' END || lang AS source FROM documents),
r AS (SELECT *, list_position(['local_de', 'local_en', 'pmc_en', 'local_fr', 'pmc_fr', 'pmc_de', 'pmc_es'], source) AS p FROM a)
SELECT lang, arg_min(source, p) AS resolved, min(p)::BIGINT AS priority, count(*) AS n_sources FROM r WHERE p > 0 GROUP BY lang""",
    "split_multivalue": """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_size || ', ' || p_size * 2 || ', nd' ELSE p_size::VARCHAR END AS value_text, v AS value, label FROM (
SELECT p_partkey, p_size, p_size::DOUBLE AS v, 'tablet' AS label FROM part WHERE p_size % 3 = 0 UNION ALL SELECT p_partkey, p_size, p_size * 2, 'capsule' FROM part WHERE p_size % 3 = 0
UNION ALL SELECT p_partkey, p_size, NULL, NULL FROM part WHERE p_size % 3 <> 0)""",
    "view_constraints": f"""WITH {LINES} SELECT 'system_rows' AS "check", count(*) FILTER (l_returnflag = 'R') AS n FROM L UNION ALL SELECT 'other_rows', count(*) FILTER (l_returnflag IS DISTINCT FROM 'R') FROM L
UNION ALL SELECT 'duplicate_keys', count(*) FROM (SELECT l_orderkey, ord FROM L GROUP BY ALL HAVING count(*) > 1) UNION ALL SELECT 'lost_rows', 0""",
    "patch_update": """SELECT c_custkey, c_name, CASE WHEN c_custkey % 14 = 0 THEN 0.0::DOUBLE ELSE c_acctbal END AS c_acctbal, CASE WHEN c_custkey % 7 = 0 THEN 'REVIEWED' ELSE c_mktsegment END AS c_mktsegment FROM customer""",
    "corpus_validation": """WITH e AS (SELECT source, (length(text) <> n_chars)::INT + (length(text) < 50)::INT + (lang NOT IN ('en', 'de', 'fr', 'es'))::INT AS n, length(text) < 50 AS short FROM documents)
SELECT source, count(*) AS n_docs, sum(n)::BIGINT AS n_errors, bool_and(n = 0) AS valid, count(*) FILTER (short) AS n_short FROM e GROUP BY source""",
    "json_props": """SELECT event_id, coalesce((props->>'k')::INT, -1) AS k, CASE event_type WHEN 'click' THEN 'yes' WHEN 'view' THEN 'no' WHEN 'purchase' THEN 'yes' ELSE 'i_cannot_answer' END AS response FROM events""",
    "merge_first_known": """SELECT user_id, arg_min(event_type, event_id) FILTER (event_id % 4 = 0) AS a, arg_min(round(value, 3), event_id) FILTER (event_id % 5 = 1) AS b FROM events GROUP BY user_id""",
    "physio_lookup": f"""WITH c AS (SELECT c_custkey, ['human', 'rat', 'nonhuman primate', 'mouse', 'dog'][c_custkey % 5 + 1] AS species FROM customer),
f(species, symbol, value) AS (VALUES {_FACTS})
SELECT c_custkey, species, symbol, CASE WHEN symbol = 'BW' AND c_custkey % 3 = 0 THEN 60.0::DOUBLE ELSE value END AS value FROM c JOIN f USING (species)""",
    "symbol_descriptions": f"""SELECT n_name AS symbol, 'Physiological parameter: ' || n_name AS description FROM nation UNION ALL SELECT * FROM (VALUES {', '.join(f"('{a}', '{b}')" for a, b in physiology.SYMBOLS)})
UNION ALL SELECT unnest(['human', 'mouse', 'nonhuman primate', 'rat']), 'species'""",
}
