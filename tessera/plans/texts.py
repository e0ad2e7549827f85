"""Queries on texts, pages and conversations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import classify, numbers
from ..functions import text as T
from ..operators import segments
from ..sources import tables
from .common import read


def section_islands(spark, d):
    x = segments.lines(read(spark, d, "documents"), "doc_id", "text")
    kind = F.when(F.contains("line", F.lit("|")), "table").otherwise("text")
    return segments.islands(x, "doc_id", "pos", kind).select("doc_id", "run", "kind", "first", "last", "n")


def sentence_context(spark, d):
    x = segments.sentences(read(spark, d, "documents"), "doc_id", "text")
    got = segments.with_context(x, "doc_id", F.col("sentence").rlike("[0-9]"))
    return got.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if("hit").alias("n_hits"), F.min("pos").alias("first_pos"), F.sum(F.length("sentence")).alias("n_chars"))


STRONG, WEAK = (r"\bablation\b", r"\bthe\b", r"\bder\b", r"\bque\b"), (r"\band\b", r"\bof\b", r"\bdie\b", r"\ben\b", r"\bles\b")


def keyword_tiers(spark, d):
    x, t = read(spark, d, "documents").select("doc_id", "text"), F.col("text")
    x = x.select("doc_id", classify.hits(t, STRONG[:1]).alias("first"), classify.hits(t, STRONG[1:]).alias("others"), classify.hits(t, WEAK).alias("tier2"))
    return x.select("doc_id", (F.col("first") + F.col("others")).alias("tier1"), "tier2", classify.by_tiers(F.lit(""), F.col("first"), F.col("tier2")).alias("kept"))


TITLES = ("Normalized  sensitivity of AUC", "Sensitivity of the fit", "Daily\tIntake", "POD HED by species", "Parameters", "Morris screening")


def table_gate_route(spark, d):
    x, t = read(spark, d, "documents"), F.col("text")
    gate = classify.is_input_table(t, t, ("the", "and", "der", "que", "les", "ten"))
    title = F.element_at(F.array(*map(F.lit, TITLES)), F.pmod("doc_id", F.lit(len(TITLES))).cast("int") + 1)
    return x.select("doc_id", gate.alias("is_input"), classify.table_role(title, t).alias("role"))


def bibliography_strip(spark, d):
    x = read(spark, d, "documents").select("doc_id", F.concat_ws("\n", "text", F.when(F.col("doc_id") % 2 == 0, "## References"), F.lit("[1] someone"), F.when(F.col("doc_id") % 4 == 0, "# Appendix A"), F.lit("tail")).alias("md"))
    return x.select("doc_id", T.without_bibliography(F.col("md")).alias("kept"))


def block_budget(spark, d):
    x = segments.lines(read(spark, d, "documents"), "doc_id", "text").filter("line <> ''")
    x = x.withColumnRenamed("line", "block").withColumn("priority", F.when(F.col("block").rlike("[0-9|]"), 0).otherwise(1))
    return segments.within_budget(x, "doc_id", 600).groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.length("block")).alias("used"))


def number_parsing(spark, d):
    p = read(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    size, price = F.col("p_size").cast("string"), F.format_string("%.2f", "p_retailprice")
    kinds = (price, F.concat(size, F.lit(" a")), F.concat(price, F.lit(" ("), size, F.lit(", 99.5)")), F.concat(size, F.lit(" - "), F.lit("70 (gestation)")), F.concat(size, F.lit("d")), F.lit("nd"))
    x = p.withColumn("t", F.element_at(F.array(*kinds), F.pmod("p_partkey", F.lit(6)).cast("int") + 1))
    c, s = numbers.cell(F.col("t"), F.array(F.lit("Mean"))), numbers.span(F.col("t"))
    return x.select("p_partkey", c["value"].alias("value"), c["mark"].alias("mark"), c["spread"].alias("spread"), s["low"].alias("low"), s["high"].alias("high"), s["note"].alias("note"), numbers.gated_double(F.col("t")).alias("plain"))


def normal_forms(spark, d):
    x = read(spark, d, "part").select("p_partkey", F.concat(F.lit("  "), F.upper("p_name"), F.lit("  \t "), "p_brand", F.lit(" ")).alias("t"), F.element_at(F.array(*map(F.lit, ("µg * h^-1", "L per h", "mg/L"))), F.pmod("p_size", F.lit(3)).cast("int") + 1).alias("u"), F.concat(F.lit("Table S"), "p_size", F.lit(": doses")).alias("tab"))
    return x.select("p_partkey", T.normal_text(F.col("t")).alias("text_form"), T.normal_identifier(F.col("t")).alias("id_form"), T.normal_unit(F.col("u")).alias("unit_form"), T.table_form(F.col("tab")).alias("table_form"), T.symbol_form(F.col("t")).alias("symbol_form"))


LOW = "abcdefghijklmnopqrstuvwxyz"


def entity_detect(spark, d):
    x = read(spark, d, "documents").select("doc_id", "lang", F.translate("text", LOW, LOW.upper()).alias("t"))
    species = classify.first_label(F.col("t"), [(r"(?U)\bTHE\b", "rat"), (r"(?U)\bDER\b|\bDIE\b", "mouse"), (r"(?U)\bQUE\b", "human")], "human")
    names = classify.acronyms(F.col("t"), (), ("THE", "AND", "DER", "DIE", "QUE", "LES"))
    return x.select("doc_id", species.alias("species"), F.array_join(F.array_sort(names), ",").alias("names"))


def doi_like_extract(spark, d):
    x = read(spark, d, "pages").select("page_id", F.regexp_extract("url", r"/(\d+)(?:[/.?#]|$)", 1).alias("n"))
    raw = F.concat(F.lit("see https://doi.org/10.1016/J.TOX."), "n", F.lit("., and more"))
    return x.select("page_id", F.when(F.col("n") != "", T.doi(raw)).alias("doi"))


def html_metadata(spark, d):
    h = F.col("html")
    x = read(spark, d, "pages")
    return x.select("page_id", F.regexp_extract(h, r"<title>([^<]*)</title>", 1).alias("title"), F.regexp_extract(h, r"<html lang=\"([a-z]+)\"", 1).alias("lang"), F.size(F.regexp_extract_all(h, F.lit("<h1>"), 0)).alias("n_h1"), F.size(F.regexp_extract_all(h, F.lit("<p>"), 0)).alias("n_p"))


def html_link_filter(spark, d):
    x = read(spark, d, "pages").select("page_id", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit('href="/([a-z]+)"'), 1))).alias("link"))
    return x.filter(F.length("link") > 3).groupBy("link").agg(F.count_distinct("page_id").alias("n_pages"), F.min("page_id").alias("first_page"))


GRID = """<table><thead><tr><th rowspan="2">Species</th><th colspan="2">Mean (95% CI)</th></tr><tr><th>PFOS</th><th>PFOA</th></tr></thead>
<tbody><tr><td colspan="3">Adults</td></tr><tr><td>human</td><td>70 (65, 75)</td><td>71</td></tr><tr><td>rat</td><td>0.25</td><td></td></tr></tbody></table>"""


def html_grid(spark, d):
    x = read(spark, d, "pages").select("page_id", F.concat(F.coalesce("html", F.lit("")), F.lit(GRID)).alias("m"))
    return tables.evidence(tables.cells(x, "page_id", "m"), ["page_id", "table_ord"]).select("page_id", "cell_id", "text", F.array_join("row_path", "/").alias("row_path"), F.array_join("column_path", "/").alias("column_path"))


def chat_roles(spark, d):
    c = read(spark, d, "conversations")
    message = F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), "text", F.lit("<|im_end|>\n"))
    whole = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", message.alias("m")))).alias("ms"))
    prompt = whole.select("conv_id", F.array_join(F.transform("ms", lambda x: x["m"]), "").alias("prompt"))
    return segments.chat(prompt, "prompt").groupBy("conv_id", "role").agg(F.count("*").alias("n"), F.sum(F.length("content")).alias("n_chars"))


def line_scan(spark, d):
    p = read(spark, d, "part")
    x = p.select("p_brand", F.col("p_partkey").alias("k"), F.explode(F.array(F.struct(F.lit(0).alias("o"), F.col("p_name").alias("line")), F.struct(F.lit(1).alias("o"), F.col("p_size").cast("string").alias("line")), F.struct(F.lit(2).alias("o"), F.when(F.col("p_size") % 2 == 0, F.format_string("%.2f", "p_retailprice")).otherwise("nd").alias("line")))).alias("s"))
    x = x.select("p_brand", "k", "s.*").withColumn("pos", F.row_number().over(Window.partitionBy("p_brand").orderBy("k", "o")))
    return segments.scan_values(x.select("p_brand", "pos", "line"), "p_brand", "^[a-z]", r"^[0-9.]+$").select("p_brand", "pos", "line", F.array_join("values", ";").alias("found"))


QUERIES = {f.__name__: f for f in (
    section_islands, sentence_context, keyword_tiers, table_gate_route, bibliography_strip, block_budget, number_parsing, normal_forms, entity_detect,
    doi_like_extract, html_metadata, html_link_filter, html_grid, chat_roles, line_scan,
)}
_IC = "regexp_matches(text, '(?i){}')::INT"


def _sql(pattern: str) -> str:
    """A pattern with word bounds that take all letters, for RE2."""
    return pattern.replace(r"\b", r"(?:^|$|[^\pL\pN_])")


ORACLE_SQL = {
    "section_islands": """WITH l AS (SELECT doc_id, i - 1 AS pos, CASE WHEN contains(ls[i], '|') THEN 'table' ELSE 'text' END AS kind FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), unnest(range(1, len(ls) + 1)) AS r(i)),
n AS (SELECT *, CASE WHEN lag(kind) OVER w = kind THEN 0 ELSE 1 END AS new FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
g AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY pos)::BIGINT AS run FROM n)
SELECT doc_id, run, kind, min(pos) AS first, max(pos) AS last, count(*) AS n FROM g GROUP BY ALL""",
    "sentence_context": """WITH s AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?]) +', '\\1' || chr(1), 'g'), chr(1)) AS ss FROM documents),
x AS (SELECT doc_id, i - 1 AS pos, ss[i] AS sentence, regexp_matches(ss[i], '[0-9]') AS hit FROM s, unnest(range(1, len(ss) + 1)) AS r(i)),
c AS (SELECT *, coalesce(lead(hit) OVER (PARTITION BY doc_id ORDER BY pos), false) AS nx FROM x),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, sentence ORDER BY pos) AS k FROM c WHERE hit OR nx)
SELECT doc_id, count(*) AS n, count(*) FILTER (hit) AS n_hits, min(pos) AS first_pos, sum(length(sentence))::BIGINT AS n_chars FROM k WHERE k = 1 GROUP BY doc_id""",
    "keyword_tiers": f"""WITH x AS (SELECT doc_id, {' + '.join(_IC.format(_sql(p)) for p in STRONG)} AS tier1, {' + '.join(_IC.format(_sql(p)) for p in WEAK)} AS tier2, {_IC.format(_sql(STRONG[0]))} AS s FROM documents)
SELECT doc_id, tier1, tier2, s >= 1 OR tier2 >= 3 AS kept FROM x""",
    "table_gate_route": f"""WITH x AS (SELECT doc_id, text AS c, lower(text || ' ' || text) AS b, {[t.replace(chr(9), ' ') for t in TITLES]}[doc_id % {len(TITLES)} + 1] || ' ' || text AS t FROM documents)
SELECT doc_id, NOT regexp_matches(c, '(?i)' || '{_sql(classify.OUTCOME_TABLE.removeprefix("(?i)"))}') AND contains(b, 'the')::INT + contains(b, 'and')::INT + contains(b, 'der')::INT + contains(b, 'que')::INT + contains(b, 'les')::INT + contains(b, 'ten')::INT >= 2 AS is_input,
  CASE WHEN regexp_matches(t, '(?i)sensitivity\\s+coefficient|normalized\\s+sensitivity|morris|efast') THEN 'sensitivity_analysis' WHEN regexp_matches(t, '(?i)point\\s+of\\s+departure|pod\\s*hed|exposure\\s+estimate|daily\\s+intake') THEN 'simulated_data' ELSE 'model_parameters' END AS role FROM x""",
    "bibliography_strip": r"""WITH m AS (SELECT doc_id, concat_ws(chr(10), text, CASE WHEN doc_id % 2 = 0 THEN '## References' END, '[1] someone', CASE WHEN doc_id % 4 = 0 THEN '# Appendix A' END, 'tail') AS md FROM documents),
h AS (SELECT *, regexp_replace(md, '(?ims)^#{0,4}\s*(?:references|bibliography)\s*$.*', '') AS head FROM m),
r AS (SELECT *, substr(md, length(head) + 1) AS cut FROM h), t AS (SELECT *, substr(cut, length(regexp_extract(cut, '(?im)^#{0,4}\s*(?:references|bibliography)\s*$')) + 1) AS rest FROM r)
SELECT doc_id, head || regexp_extract(rest, '(?ims)^#{1,4}\s*(?:appendix|supplement|table).*') AS kept FROM t""",
    "block_budget": """WITH RECURSIVE l AS (SELECT doc_id, i AS pos, ls[i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), unnest(range(1, len(ls) + 1)) AS r(i) WHERE ls[i] <> ''),
b AS MATERIALIZED (SELECT doc_id, length(line) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN regexp_matches(line, '[0-9|]') THEN 0 ELSE 1 END, pos) AS i FROM l),
g AS (SELECT doc_id, 0::BIGINT AS i, 0::BIGINT AS used, 0::BIGINT AS took FROM (SELECT DISTINCT doc_id FROM b) UNION ALL SELECT g.doc_id, b.i, CASE WHEN used + n <= 600 THEN used + n ELSE used END, CASE WHEN used + n <= 600 THEN took + 1 ELSE took END FROM g JOIN b ON b.doc_id = g.doc_id AND b.i = g.i + 1)
SELECT doc_id, max(took) AS n, max(used) AS used FROM g GROUP BY doc_id HAVING max(took) > 0""",
    "number_parsing": """WITH x AS (SELECT p_partkey, p_partkey % 6 AS k, p_size, p_retailprice AS p, printf('%.2f', p_retailprice) AS pt FROM part)
SELECT p_partkey, CASE k WHEN 0 THEN pt::DOUBLE WHEN 1 THEN p_size::DOUBLE WHEN 2 THEN pt::DOUBLE WHEN 3 THEN p_size::DOUBLE WHEN 4 THEN p_size::DOUBLE END AS value,
  CASE k WHEN 1 THEN 'a' WHEN 4 THEN 'd' END AS mark, CASE k WHEN 2 THEN p_size || ', 99.5' WHEN 3 THEN p_size || ' - 70 (gestation)' END AS spread,
  CASE WHEN k = 3 THEN p_size::DOUBLE END AS low, CASE WHEN k = 3 THEN 70.0::DOUBLE END AS high, CASE WHEN k = 3 THEN 'gestation' END AS note, CASE WHEN k = 0 THEN pt::DOUBLE END AS plain FROM x""",
    "normal_forms": """SELECT p_partkey, lower(p_name) || ' ' || lower(p_brand) AS text_form, regexp_replace(lower(p_name || p_brand), '[^a-z0-9]', '', 'g') AS id_form,
  ['/ugh', 'l/h', 'mg/l'][p_size % 3 + 1] AS unit_form, 'tables' || p_size AS table_form, substr(replace(upper(p_name), ' ', '_') || '_' || replace(p_brand, '#', '_'), 1, 40) AS symbol_form FROM part""",
    "entity_detect": r"""WITH x AS (SELECT doc_id, translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS t FROM documents),
n AS (SELECT doc_id, regexp_split_to_array(t, '[^\pL\pN_]+') AS ws FROM x)
SELECT doc_id, CASE WHEN list_contains(ws, 'THE') THEN 'rat' WHEN list_has_any(ws, ['DER', 'DIE']) THEN 'mouse' WHEN list_contains(ws, 'QUE') THEN 'human' ELSE 'human' END AS species,
  array_to_string(list_sort(list_distinct(list_filter(ws, lambda a: regexp_full_match(a, '[A-Z]{3,8}') AND a NOT IN ('THE', 'AND', 'DER', 'DIE', 'QUE', 'LES')))), ',') AS names FROM n""",
    "doi_like_extract": r"""WITH x AS (SELECT page_id, regexp_extract(url, '/(\d+)(?:[/.?#]|$)', 1) AS n FROM pages) SELECT page_id, CASE WHEN n <> '' THEN '10.1016/j.tox.' || n END AS doi FROM x""",
    "html_metadata": """SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang, len(regexp_extract_all(html, '<h1>')) AS n_h1, len(regexp_extract_all(html, '<p>')) AS n_p FROM pages""",
    "html_link_filter": """WITH x AS (SELECT DISTINCT page_id, unnest(regexp_extract_all(html, 'href="/([a-z]+)"', 1)) AS link FROM pages) SELECT link, count(*) AS n_pages, min(page_id) AS first_page FROM x WHERE length(link) > 3 GROUP BY link""",
    "html_grid": """SELECT page_id, c.* FROM pages, (VALUES ('cell_r1_c0', 'human', 'Adults/human/70 (65, 75)/71', 'Species'), ('cell_r1_c1', '70 (65, 75)', 'Adults/human/70 (65, 75)/71', 'Mean (95% CI)/PFOS'), ('cell_r1_c2', '71', 'Adults/human/70 (65, 75)/71', 'Mean (95% CI)/PFOA'),
  ('cell_r2_c0', 'rat', 'Adults/rat/0.25', 'Species'), ('cell_r2_c1', '0.25', 'Adults/rat/0.25', 'Mean (95% CI)/PFOS')) AS c(cell_id, text, row_path, column_path)""",
    "chat_roles": "SELECT conv_id, role, count(*) AS n, sum(length(text))::BIGINT AS n_chars FROM conversations GROUP BY ALL",
    "line_scan": """WITH p AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS k FROM part)
SELECT p_brand, 3 * k - 2 AS pos, p_name AS line, CASE WHEN p_size % 2 = 0 THEN p_size || ';' || printf('%.2f', p_retailprice) ELSE p_size::VARCHAR END AS found FROM p""",
}
