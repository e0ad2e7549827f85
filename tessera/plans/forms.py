"""Queries on small forms: nested records, XML, grids, and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers
from ..functions import text as T
from ..operators import assembly, assess, extract
from ..sources import documents, tables
from .common import LINES, lines, read, spread
from .texts import GRID


def _pick(column, values):
    return F.get(F.array(*(F.lit(v) for v in values)), F.pmod(column, F.lit(len(values))).cast("int"))


TEXTS = ("A – B  c", "5 (2, 3)", "nan", "−7.5 mg", "Brown et al. 2001, 3 L/h/kg^0.75 (1999)", '<think>no</think>```json\n{"a": [1,]}\n```', "  ", "1e999")


def scalar_forms(spark, d):
    p = read(spark, d, "part")
    t = _pick(F.col("p_partkey"), TEXTS)
    several = F.when(F.col("p_size") % 3 == 0, F.array(F.lit("Oral B"), F.lit("iv!"), F.lit("")))
    scores = F.array(F.pmod("p_partkey", F.lit(3)), F.pmod("p_size", F.lit(3)).cast("bigint"))
    return p.select(
        "p_partkey", T.normal_list(several).alias("listed"), T.verification_form(t).alias("verified"), numbers.scraped(t).alias("scraped"), numbers.is_finite(t.try_cast("double")).alias("finite"), T.scrub(t).alias("scrubbed"),
        T.without_fences(t).alias("inner"), T.nonempty(t).alias("some"), T.data_uri(F.encode("p_brand", "UTF-8")).alias("uri"), assess.basis_confidence(scores).alias("basis"), F.substring(F.concat(F.lit("D:20"), F.lpad((F.col("p_size") % 100).cast("string"), 2, "0")), 3, 4).try_cast("int").alias("year"),
    )


def benchmark_agreement(spark, d):
    """Values, units and names by the benchmark's rules."""
    p = read(spark, d, "part")
    v = lambda m, n: F.when(F.col("p_partkey") % m != 0, F.pmod("p_partkey", F.lit(n)) / 100.0)
    units, names = ("L / h", "l/h", "", "kg^0.75", "kg0.75 *x", None), ("cl", "", "clearance", "vd", None)
    at = lambda xs, step: _pick(F.floor(F.col("p_partkey") / step).cast("bigint"), xs)
    return p.select(
        "p_partkey", numbers.benchmark_close(v(5, 7), v(7, 9)).alias("values"), numbers.units_agree(at(units, 1), at(units, 2)).alias("units"),
        numbers.names_agree(at(names, 1), at(names, 2), at(names, 3), at(names, 5)).alias("names"),
    )


def rerouted_values(spark, d):
    """Records with a value, and those that are measurements of a product."""
    p = read(spark, d, "part").select("p_partkey", F.when(F.col("p_size") % 4 == 0, F.concat("p_name", F.lit(" Particle size"))).otherwise(F.col("p_name")).alias("name"), F.when(F.col("p_size") % 5 == 0, "°").otherwise("mg").alias("unit"), F.when(F.col("p_partkey") % 3 != 0, "x").alias("value_text"), F.when(F.col("p_partkey") % 2 == 0, 1.0).alias("value"))
    stay, go = extract.reroute(extract.with_value(p), assembly.is_formulation(F.col("name"), F.col("unit")))
    return stay.select("p_partkey", F.lit("parameter").alias("kind")).unionByName(go.select("p_partkey", F.lit("formulation").alias("kind")))


def nested_parameters(spark, d):
    """Records of JSON documents; what they call compartment is the organ."""
    x = lines(spark, d, "l_quantity", "l_returnflag", "l_linestatus")
    body = F.to_json(F.struct(
        F.concat(F.lit("p"), F.col("ord").cast("string")).alias("parameter_id"),
        F.struct(F.when(F.col("ord") % 2 == 0, F.col("l_returnflag")).alias("species"), F.lit("rat").alias("subject_species"), F.when(F.col("ord") % 3 == 0, F.lit("liver")).alias("organ"), F.col("l_linestatus").alias("compartment")).alias("context"),
        F.struct(F.col("l_quantity").cast("double").alias("value")).alias("quantitative_data")))
    docs = x.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", body.alias("b")))), lambda r: r["b"]), ",").alias("b"))
    docs = docs.select("l_orderkey", F.from_json(F.concat(F.lit("["), "b", F.lit("]")), f"array<{documents.PARAMETER}>").alias("model_parameters"))
    out = documents.parameters(docs, "l_orderkey")
    return out.select("l_orderkey", "ord", "parameter_id", F.col("context.species").alias("species"), F.col("context.organ").alias("organ"), F.col("context.compartment").alias("compartment"), F.col("quantitative_data.value").alias("value"))


def jats_metadata(spark, d):
    p = spread(read(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size"))
    author = "<contrib><name><surname>{}</surname><given-names>{}</given-names></name></contrib>"
    xml = F.concat(F.lit("<article><title-group><article-title>"), "p_name", F.lit("</article-title></title-group><journal-title>"), "p_brand", F.lit("</journal-title>"), F.lit(author.format("B", "A") + author.format("D", "C")),
                   F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("<pub-date><year>20"), F.lpad((F.col("p_size") % 100).cast("string"), 2, "0"), F.lit("</year></pub-date><pub-date><year>1999</year></pub-date>"))).otherwise(""), F.lit("</article>"))
    return documents.xml_metadata(p.select("p_partkey", xml.alias("xml"))).select("p_partkey", "title", F.array_join("authors", "; ").alias("authors"), "year")


def grid_markdown(spark, d):
    x = read(spark, d, "pages").select("page_id", F.lit(GRID).alias("m"))
    notes = x.filter("page_id % 2 = 0").select("page_id", F.lit(0).alias("table_ord"), F.explode(F.array(F.struct(F.lit(2).alias("pos"), F.lit("b: of two").alias("note")), F.struct(F.lit(1).alias("pos"), F.lit("a: of one").alias("note")))).alias("x")).select("page_id", "table_ord", "x.*")
    return tables.markdown(tables.cells(x, "page_id", "m"), ["page_id", "table_ord"], notes).select("page_id", "text")


def table_unroll(spark, d):
    """Records of a grid's cells by its header paths."""
    x = read(spark, d, "pages").select("page_id", F.lit(RECORDS).alias("m"))
    ev = tables.evidence(tables.cells(x, "page_id", "m"), ["page_id", "table_ord"])
    return tables.unroll(ev, ["page_id", "table_ord"], compounds=("PFOS", "PFOA")).select("page_id", "row_id", "name", "symbol", "species", "compound", "value", "ci_low", "ci_high", "unit", "status")


RECORDS = """<table><tr><th>Species</th><th>Variable</th><th>Name</th><th>Mean PFOS</th><th>Mean PFOA</th><th>Source</th></tr>
<tr><td>human</td><td>BW</td><td>Body weight (kg)</td><td>70 (65, 75)</td><td>71</td><td>Optimized</td></tr><tr><td>rat</td><td>V</td><td>Volume (L)</td><td>nd</td><td>0.5</td><td>Brown</td></tr></table>"""

QUERIES = {f.__name__: f for f in (scalar_forms, benchmark_agreement, rerouted_values, nested_parameters, jats_metadata, grid_markdown, table_unroll)}

_V = "CASE WHEN p_partkey % {m} <> 0 THEN p_partkey % {n} / 100.0::DOUBLE END"
_U = "coalesce(['l/h', 'l/h', '', 'kg0.75', 'kg0.75x', ''][p_partkey // {} % 6 + 1], '')"
_N = "coalesce(['cl', '', 'clearance', 'vd', NULL][p_partkey // {} % 5 + 1], '')"
_IN = "({0} <> '' AND {1} <> '' AND (contains({0}, {1}) OR contains({1}, {0})))"
ORACLE_SQL = {
    "scalar_forms": """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '|iv|oralb' ELSE '' END AS listed, ['a-bc', '5(2,3)', 'nan', '-7.5mg', 'brownetal.2001,3l/h/kg^0.75(1999)', '<think>no</think>```json{"a":[1,]}```', '', '1e999'][p_partkey % 8 + 1] AS verified,
  [NULL, 5.0::DOUBLE, NULL, -7.5, NULL, NULL, NULL, 'Infinity'::DOUBLE][p_partkey % 8 + 1] AS scraped, false AS finite, ['A – B  c', '5 (2, 3)', 'nan', '−7.5 mg', 'Brown , 3 L/h/kg', '<think>no</think>```json' || chr(10) || '{"a": [1,]}' || chr(10) || '```', '', '1e999'][p_partkey % 8 + 1] AS scrubbed,
  ['A – B  c', '5 (2, 3)', 'nan', '−7.5 mg', 'Brown et al. 2001, 3 L/h/kg^0.75 (1999)', '{"a": [1]}', '', '1e999'][p_partkey % 8 + 1] AS inner, p_partkey % 8 <> 6 AS some, 'data:image/png;base64,' || base64(p_brand::BLOB) AS uri,
  CASE WHEN p_partkey % 3 = 2 AND p_size % 3 = 2 THEN 'high' WHEN p_partkey % 3 + p_size % 3 > 0 THEN 'medium' ELSE 'low' END AS basis, 2000 + p_size % 100 AS year FROM part""",
    "benchmark_agreement": f"""WITH x AS (SELECT p_partkey, {_V.format(m=5, n=7)} AS a, {_V.format(m=7, n=9)} AS b, {_U.format(1)} AS u, {_U.format(2)} AS w, {_N.format(1)} AS n1, {_N.format(2)} AS s1, {_N.format(3)} AS n2, {_N.format(5)} AS s2 FROM part)
SELECT p_partkey, CASE WHEN a IS NULL AND b IS NULL THEN true WHEN a IS NULL OR b IS NULL THEN false ELSE abs(a - b) <= greatest(0.02::DOUBLE * greatest(abs(a), abs(b)), 1e-5) END AS "values", u = '' OR w = '' OR contains(u, w) OR contains(w, u) AS units,
  {_IN.format('s1', 's2')} OR {_IN.format('n1', 'n2')} OR {_IN.format('s1', 'n2')} OR {_IN.format('n1', 's2')} AS names FROM x""",
    "rerouted_values": "SELECT p_partkey, CASE WHEN p_size % 4 = 0 OR p_size % 5 = 0 THEN 'formulation' ELSE 'parameter' END AS kind FROM part WHERE p_partkey % 3 <> 0 OR p_partkey % 2 = 0",
    "nested_parameters": f"""WITH {LINES} SELECT l_orderkey, (ord - 1)::INT AS ord, 'p' || ord AS parameter_id, CASE WHEN ord % 2 = 0 THEN l_returnflag ELSE 'rat' END AS species, CASE WHEN ord % 3 = 0 THEN 'liver' ELSE l_linestatus END AS organ, l_linestatus AS compartment, l_quantity::DOUBLE AS value FROM L""",
    "jats_metadata": "SELECT p_partkey, p_name AS title, 'A B; C D' AS authors, CASE WHEN p_size % 2 = 0 THEN 2000 + p_size % 100 END AS year FROM part",
    "grid_markdown": "SELECT page_id, '| Species | Mean (95% CI) | Mean (95% CI) |' || chr(10) || '| Species | PFOS | PFOA |' || chr(10) || '| Adults | Adults | Adults |' || chr(10) || '| human | 70 (65, 75) | 71 |' || chr(10) || '| rat | 0.25 |  |' || CASE WHEN page_id % 2 = 0 THEN chr(10) || chr(10) || 'a: of one' || chr(10) || 'b: of two' ELSE '' END AS text FROM pages",
    "table_unroll": """SELECT page_id, r.* FROM pages, (VALUES ('row_0', 'Body weight (kg)', 'BW', 'human', 'PFOS', 70.0::DOUBLE, 65.0::DOUBLE, 75.0::DOUBLE, 'kg', 'fitted'), ('row_0', 'Body weight (kg)', 'BW', 'human', 'PFOA', 71.0, NULL, NULL, 'kg', 'fitted'), ('row_1', 'Volume (L)', 'V', 'rat', 'PFOA', 0.5, NULL, NULL, 'L', NULL))
  AS r(row_id, name, symbol, species, compound, value, ci_low, ci_high, unit, status)""",
}
