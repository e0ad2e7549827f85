"""Queries on what stands between the engine and models, services and readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assess, inference, ingest, linescan, repair, retrieve, series
from ..sources import literature, sinks
from .common import read, spread
from .verification import BASE, PARAMETERS, parameters_and_tables


def item_batches(spark, d):
    """Prompts of three parameters each, as a model gets them, and whether
    they fit its context."""
    p, _ = parameters_and_tables(spark, d, tables=False)
    x = inference.batched(p.select("doc", "ord", "name", "symbol"), ["doc"], "ord", 3)
    x = x.groupBy("doc", "batch").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", F.coalesce("symbol", F.lit("?")).alias("s")))), lambda r: r["s"]), "\n").alias("items"))
    text = inference.prompt(inference.ITEMS_PROMPT, title=F.col("doc"), context=F.repeat(F.lit("x"), F.pmod("doc", F.lit(3)).cast("int") * 50), items=F.col("items"))
    return x.select("doc", "batch", text.alias("prompt")).withColumn("fits", inference.fits_context(F.col("prompt"), 4050))


def ontology_link(spark, d):
    """Parts linked to nations by their first word, as an ontology would be."""
    n = read(spark, d, "nation").select(F.col("n_name").alias("alias"), F.initcap("n_name").alias("canonical_name"), F.format_string("N:%04d", F.col("n_nationkey").cast("int")).alias("concept_id"))
    c = read(spark, d, "customer").join(read(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    x = c.select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.lower(F.replace("n_name", F.lit(" "), F.lit("-")))).otherwise(F.col("c_mktsegment")).alias("name"))
    return inference.link(x, n, "name")


def repaired_answers(spark, d):
    """Answers of a model that fails on some, leaves some open and says
    nonsense to others; a second turn mends what it can."""
    p = read(spark, d, "part").select("p_partkey", F.concat(F.lit("V = "), F.col("p_size").cast("string"), F.when(F.col("p_partkey") % 5 == 0, " refuse").when(F.col("p_partkey") % 5 == 1, " cut").when(F.col("p_partkey") % 5 == 2, " nonsense").otherwise("")).alias("t"))

    def model(texts):
        if any("refuse" in t and "Your answer" not in t for t in texts):
            raise ValueError("no")
        return ["nothing" if "nonsense" in t else x[:-1] if "cut" in t else x for t, x in zip(texts, inference.stub(texts), strict=True)]

    kind = "array<struct<symbol: string, value: double>>"
    got = inference.run_with_repair(p, "t", kind, model, fallback=F.from_json(F.lit('[{"symbol": "?"}]'), kind))
    return got.select("p_partkey", "how", F.col("parsed")[0]["symbol"].alias("symbol"), F.col("parsed")[0]["value"].alias("value"))


def dosing_extraction(spark, d):
    p = read(spark, d, "part").select("p_partkey", F.concat(F.lit("Rats got "), F.col("p_size").cast("string"), F.lit(" mg/kg as one "), F.when(F.col("p_partkey") % 3 == 0, "oral").when(F.col("p_partkey") % 3 == 1, "IV").otherwise("skin"), F.lit(" dose.")).alias("t"))
    out = inference.run(p, "t", inference.failover(_down, inference.dosing_stub))
    return out.select("p_partkey", F.inline(F.from_json("answer.json", "array<struct<dose: double, dose_unit: string, route: string>>")))


def _down(texts):
    raise ConnectionError("the first service is down")


def image_sizes(spark, d):
    """The interface for images and files: their bytes in, JSON out."""
    p = read(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 7 != 0, F.encode("p_name", "UTF-8")).alias("image"))
    return inference.run(p, "image", inference.page_stub).select("p_partkey", F.get_json_object("answer.json", "$.bytes").cast("int").alias("n_bytes"))


RESPONSES = {
    "pmc": '{{"esearchresult": {{"idlist": [{k}]}}}}', "europe_pmc": '{{"resultList": {{"result": [{{"pmcid": "PMC{k}", "title": "Title {k} of a paper"}}]}}}}',
    "biorxiv": '{{"collection": [{{"doi": "10.1101/a", "version": "1"}}, {{"doi": "10.1101/{k}", "version": "3"}}]}}', "unpaywall": '{{"best_oa_location": {{"url_for_pdf": "", "url": "http://x.org/{k}"}}}}',
    "semantic_scholar": '{{"title": "T{k}", "openAccessPdf": {{"url": "http://y.org/{k}.pdf"}}}}', "crossref": '{{"message": {{"title": [" Title {k} "]}}}}', "crossref_title": '{{"message": {{"items": [{{"DOI": "10.1/{k}", "title": ["X {k}"]}}]}}}}',
}
SERVICES = tuple(RESPONSES)


def service_answers(spark, d):
    p = read(spark, d, "part").select(F.col("p_partkey").alias("k"))
    n = F.pmod("k", F.lit(len(SERVICES) + 1))
    body = F.lit("{}")
    for i, text in enumerate(RESPONSES.values()):
        a, b = text.replace("{{", "{").replace("}}", "}").split("{k}")[0], text.replace("{{", "{").replace("}}", "}").split("{k}")[1:]
        parts = [F.lit(a)]
        for piece in b:
            parts += [F.col("k").cast("string"), F.lit(piece)]
        body = F.when(n == i, F.concat(*parts)).otherwise(body)
    service = F.get(F.array(*map(F.lit, SERVICES)), F.pmod("k", F.lit(len(SERVICES))).cast("int"))
    service = F.when(n < len(SERVICES), F.get(F.array(*map(F.lit, SERVICES)), n.cast("int"))).otherwise(service)
    x = p.select("k", service.alias("service"), F.when(F.col("k") % 3 == 0, F.concat(F.lit("TITLE:"), "k")).otherwise(F.col("k").cast("string")).alias("key"), body.alias("body"), F.when(F.col("k") % 2 == 0, F.concat(F.lit("TITLE "), F.col("k").cast("string"), F.lit(" of a paper"))).otherwise("something else").alias("title"))
    return literature.answers(x).select("k", "service", "identifier", "found_title", "url")


def uncached_keys(spark, d):
    """What papers ask of services, less what is kept already."""
    p = read(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("https://doi.org/10.1/"), F.col("p_partkey").cast("string"))).alias("doi"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise("123").alias("title"))
    cache = read(spark, d, "part").filter("p_partkey % 9 = 0").select(F.lit("unpaywall").alias("service"), F.concat(F.lit("10.1/"), F.col("p_partkey").cast("string")).alias("key"))
    return literature.missing(literature.keys(p), cache)


def marked_pages(spark, d):
    c = read(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 3 != 0, F.concat(F.lit(" "), "role", F.lit(" "))).alias("text"))
    return literature.marked_pages(c, "conv_id", "turn", "text")


def page_texts(spark, d):
    c = read(spark, d, "conversations").select("conv_id", "turn", "text")
    x = c.filter("turn = 1").select("conv_id", F.when(F.col("conv_id") % 2 == 0, 2).alias("source_page"), F.lit("cell").alias("source_text"))
    return literature.with_page_text(x, c, "conv_id", "turn", "text").select("conv_id", "source_text")


def solver_text(spark, d):
    p, _ = parameters_and_tables(spark, d, tables=False)
    return series.solver_text(p, "doc", "symbol", "name", "value", "unit", "compound", "ord").select("doc", F.sha2("text", 256).alias("text_sha256"))


def parameter_table(spark, d):
    p, _ = parameters_and_tables(spark, d, tables=False)
    none = F.lit(None).cast("string")
    x = p.withColumns({"symbol_standardized": F.lit("std"), "name_standardized": F.when(F.col("ord") % 4 == 0, F.upper("name")), "unit_original": F.lit("?"), "subject_species": F.lit("Rat"), "source_location": F.when(F.col("ord") % 5 == 0, "p. 1"), "status": none})
    t = sinks.parameter_table(x)
    return t.groupBy("Symbol", "Name", "Class", "Unit", "Species", "Compound", "Source").agg(F.count("*").alias("n"), F.count("Value").alias("n_values"))


def line_records(spark, d):
    """Records of tables that stand as lines."""
    p = spread(read(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size"))
    page = F.concat_ws("\n", F.concat(F.lit("Table "), F.col("p_size").cast("string"), F.lit(" in rats")), F.lit("PFOS"), F.lit("PFOA"), F.concat("p_name", F.lit(" (L/kg)")), F.lit("Vd"), F.concat(F.col("p_size").cast("string"), F.lit(" (1, 2)")), F.col("p_size").cast("string"), F.lit("nd"), F.when(F.col("p_partkey") % 2 == 0, "References"), F.lit("Clearance of it"), F.lit("3.5"))
    x = linescan.scan(p.select("p_brand", "p_partkey", page.alias("text")), "p_brand", "p_partkey", "text")
    return linescan.statements(linescan.distinct_scan(x, "p_brand", "p_partkey")).select("p_brand", "p_partkey", "name", "symbol", "value", "low", "high", "unit", "species", "compound", "statement")


def template_answers(spark, d):
    p = read(spark, d, "part")
    one = F.format_string('{"name": "%s", "symbol": "%s", "value": %d, "unit": "%s", "compound": "%s"}', F.when(F.col("p_partkey") % 5 == 0, "Parameter name").otherwise(F.col("p_name")), F.when(F.col("p_partkey") % 3 == 0, "symbol").otherwise("V"), "p_size", F.when(F.col("p_partkey") % 2 == 0, "L").otherwise(""), F.when(F.col("p_partkey") % 7 == 0, "None").otherwise("PFOS"))
    two = F.format_string('{"parameter_name": "range", "start_value": %d, "end_value": %d, "species": "rat"}', "p_size", F.col("p_size") + 3)
    x = p.select("p_partkey", F.concat(F.lit("Sure. {"), F.when(F.col("p_partkey") % 2 == 0, '"parameters"').otherwise('"model_parameters"'), F.lit(": ["), one, F.lit(", "), two, F.lit(', {"name": "open"}]} That is all')).alias("t"))
    return inference.template_records(x, "p_partkey", "t").select("p_partkey", "pos", "name", "symbol", "value", "unit", "compound", "species")


def critic_corrections(spark, d):
    p, _ = parameters_and_tables(spark, d, tables=False)
    k = F.pmod("ord", F.lit(7))
    fields = F.when(k == 1, F.create_map(F.lit("unit"), F.lit("mg"), F.lit("class"), F.lit("x"))).when(k == 2, F.create_map(F.lit("quantitative_data.value"), F.lit("1.5"), F.lit("context.species"), F.lit(None).cast("string"))).when(k == 3, F.create_map(F.lit("value"), F.lit("five"), F.lit("compound"), F.lit("PFBS"))).when(k == 4, F.create_map().cast("map<string,string>"))
    v = p.filter(k > 0).select("doc", "ord", F.when(k == 6, "reject").when(k == 5, "uncertain").otherwise("fix").alias("verdict"), fields.alias("fields"))
    return repair.corrected(p, v, ["doc", "ord"]).select("doc", "ord", "unit", "class", "value", "species", "compound", "llm_corrected")


def record_ids(spark, d):
    p, _ = parameters_and_tables(spark, d, tables=False)
    return p.select("doc", "ord", repair.record_identity().alias("parameter_id"))


def front_matter(spark, d):
    p = read(spark, d, "part")
    lines = F.array(F.lit("# PAGE 1"), F.concat(F.lit("# **"), "p_name", F.lit("** ")), F.lit("# second"), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" https://doi.org/10.1/"), F.col("p_partkey").cast("string"))).otherwise("no"), F.when(F.col("p_partkey") % 3 == 0, "*Journal of it*").otherwise("_Environment_"))
    return ingest.front_matter(p.select("p_partkey", F.posexplode(lines).alias("pos", "line")), "p_partkey")


def answer_forms(spark, d):
    e = read(spark, d, "part")
    pick = lambda xs: F.get(F.array(*map(F.lit, xs)), F.pmod("p_partkey", F.lit(len(xs))).cast("int"))
    return e.select("p_partkey", assess.response_form(pick(SAID)).alias("response"), assess.page_number(pick(PAGES)).alias("page"), assess.stated(pick(QUOTES)).alias("quote"))


SAID, PAGES, QUOTES = ("Yes", " partially ", "N/A", "cannot_answer", "maybe", "NO", "y"), ("3", "3.0", "0", "-1", "iv"), (" a quote ", "N/A", "none", "")


def penalised_pages(spark, d):
    """Pages that are more like the unwanted query lose ten points; then the
    cut-off."""
    p = read(spark, d, "part").select(F.col("p_partkey").alias("page"), (F.col("p_size") / 3.0).alias("score"), (F.pmod("p_partkey", F.lit(17)) / 2.0).alias("against"))
    return retrieve.cutoff(retrieve.penalised(p.select("page", "score"), p.select("page", "against"), "page"), "page", 40, 0.9).select("page", "rank", F.round("score", 4).alias("score"))


QUERIES = {f.__name__: f for f in (
    item_batches, ontology_link, repaired_answers, image_sizes, service_answers, uncached_keys, marked_pages, page_texts, solver_text, parameter_table, line_records, dosing_extraction, template_answers, critic_corrections,
    record_ids, front_matter, answer_forms, penalised_pages,
)}


def _body() -> str:
    rows = []
    for i, text in enumerate(RESPONSES.values()):
        rows.append(f"WHEN {i} THEN replace('{text.replace('{{', '{').replace('}}', '}')}', '{{k}}', k::VARCHAR)")
    return "CASE n " + " ".join(rows) + " ELSE '{}' END"


_P = f"B AS ({BASE}), P AS ({PARAMETERS})"
_SYM = r"CASE WHEN s0 = '' THEN 'param' ELSE s0 END"
ORACLE_SQL = {
    # Lines with their numbers and the table's state; a name's numbers are
    # those after it, and after its symbol, with nothing else between.
    "line_records": r"""WITH G AS (SELECT p_brand, p_partkey, list_filter(['Table ' || p_size || ' in rats', 'PFOS', 'PFOA', p_name || ' (L/kg)', 'Vd', p_size || ' (1, 2)', p_size::VARCHAR, 'nd', CASE WHEN p_partkey % 2 = 0 THEN 'References' END, 'Clearance of it', '3.5'], lambda x: x IS NOT NULL) AS ls FROM part),
L AS (SELECT p_brand, p_partkey, generate_subscripts(ls, 1) AS i, trim(unnest(ls)) AS line FROM G),
N AS (SELECT *, nullif(regexp_extract(line, '^[+-]?[0-9]+(\.[0-9]+)?'), '')::DOUBLE AS v, nullif(regexp_extract(line, '\(\s*([0-9.]+)\s*,\s*([0-9.]+)\s*\)', 1), '')::DOUBLE AS lo, nullif(regexp_extract(line, '\(\s*([0-9.]+)\s*,\s*([0-9.]+)\s*\)', 2), '')::DOUBLE AS hi,
  regexp_matches(line, '^Table\s+[0-9]+') AS opens, regexp_matches(line, 'Figure|References|Discussion|Funding|Declaration') AS closes FROM L),
W AS (SELECT *, count(*) FILTER (opens) OVER w > 0 AND count(*) FILTER (closes) OVER w = 0 AS inside, lead(line) OVER w AS nxt, count(*) FILTER (v IS NULL) OVER w AS others FROM N WINDOW w AS (PARTITION BY p_partkey ORDER BY i)),
H AS (SELECT *, CASE WHEN length(nxt) < 12 AND NOT regexp_matches(nxt, '^[0-9]') THEN nxt ELSE '' END AS symbol FROM W WHERE inside AND v IS NULL AND NOT opens AND length(line) > 2),
R AS (SELECT H.p_brand, H.p_partkey, H.i, H.line AS name, symbol, b.v AS value, b.lo AS low, b.hi AS high, b.i AS at, row_number() OVER (PARTITION BY H.p_partkey, H.i ORDER BY b.i) AS k, coalesce(nullif(regexp_extract(H.line, '\(([^)]+)\)', 1), ''), 'dimensionless') AS unit
  FROM H JOIN W AS b ON b.p_partkey = H.p_partkey AND b.v IS NOT NULL AND b.i > H.i AND b.i <= H.i + 7 AND b.others = H.others + (symbol <> '')::INT),
C AS (SELECT *, CASE k WHEN 2 THEN 'PFOA' ELSE 'PFOS' END AS compound FROM R),
D AS (SELECT *, row_number() OVER (PARTITION BY p_brand, lower(name), value, compound ORDER BY p_partkey, i, k) AS nth FROM C)
SELECT p_brand, p_partkey, name, symbol, value, low, high, unit, 'rat' AS species, compound,
  name || CASE WHEN symbol <> '' THEN ' [' || symbol || ']' ELSE '' END || ' for ' || compound || ', rat = ' || value::VARCHAR || CASE WHEN low IS NOT NULL THEN ' (95% CI: ' || low::VARCHAR || ' to ' || high::VARCHAR || ')' ELSE '' END || ' ' || unit AS statement FROM D WHERE nth = 1""",
    "item_batches": f"""WITH {_P}, R AS (SELECT doc, ord, coalesce(symbol, '?') AS s, ((row_number() OVER (PARTITION BY doc ORDER BY ord) - 1) // 3)::INT AS batch FROM P),
T AS (SELECT doc, batch, 'Paper: ' || doc || chr(10) || chr(10) || repeat('x', (doc % 3 * 50)::INT) || chr(10) || chr(10) || 'Answer these items as JSON:' || chr(10) || string_agg(s, chr(10) ORDER BY ord) AS prompt FROM R GROUP BY doc, batch) SELECT doc, batch, prompt, length(prompt) / 3.5 < 50 AS fits FROM T""",
    "ontology_link": """WITH x AS (SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN lower(replace(n_name, ' ', '-')) ELSE c_mktsegment END AS name, c_custkey % 3 <> 0 AS m, n_name, n_nationkey FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, name, CASE WHEN m THEN array_to_string(list_transform(string_split(lower(n_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') ELSE name END AS canonical_name, CASE WHEN m THEN printf('N:%04d', n_nationkey::INT) END AS concept_id, CASE WHEN m THEN 'matched' ELSE 'unmatched' END AS match_type FROM x""",
    "repaired_answers": """SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'repaired' WHEN 2 THEN 'fallback' ELSE 'first' END AS how, CASE WHEN p_partkey % 5 = 2 THEN '?' ELSE 'V' END AS symbol, CASE WHEN p_partkey % 5 <> 2 THEN p_size::DOUBLE END AS value FROM part""",
    "dosing_extraction": "SELECT p_partkey, p_size::DOUBLE AS dose, 'mg/kg' AS dose_unit, CASE p_partkey % 3 WHEN 0 THEN 'oral' ELSE 'iv' END AS route FROM part WHERE p_partkey % 3 < 2",
    "image_sizes": "SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN strlen(p_name) ELSE 0 END::INT AS n_bytes FROM part",
    "service_answers": f"""WITH x AS (SELECT p_partkey AS k, p_partkey % 8 AS n, CASE WHEN p_partkey % 8 < 7 THEN {list(SERVICES)}[p_partkey % 8 + 1] ELSE {list(SERVICES)}[p_partkey % 7 + 1] END AS service, p_partkey % 3 = 0 AS by_title FROM part), y AS (SELECT *, {_body()} AS b FROM x)
SELECT k, service, CASE WHEN n = 7 OR by_title AND NOT (service = 'europe_pmc' AND k % 2 = 0) THEN NULL WHEN service = 'pmc' THEN 'PMC' || k WHEN service = 'europe_pmc' THEN 'PMC' || k WHEN service = 'biorxiv' THEN '10.1101/' || k WHEN service = 'crossref_title' THEN '10.1/' || k END AS identifier,
  CASE WHEN n = 7 THEN NULL WHEN service = 'europe_pmc' THEN 'Title ' || k || ' of a paper' WHEN service = 'semantic_scholar' THEN 'T' || k WHEN service = 'crossref' THEN 'Title ' || k WHEN service = 'crossref_title' THEN 'X ' || k END AS found_title,
  CASE WHEN n = 7 THEN NULL WHEN service = 'unpaywall' THEN 'http://x.org/' || k WHEN service = 'semantic_scholar' THEN 'http://y.org/' || k || '.pdf' WHEN service = 'biorxiv' THEN 'https://www.biorxiv.org/content/10.1101/' || k || 'v3.full.pdf' END AS url FROM y""",
    "uncached_keys": """WITH d AS (SELECT '10.1/' || p_partkey AS d, p_partkey AS k FROM part WHERE p_partkey % 3 = 0), t AS (SELECT DISTINCT p_name AS t FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 2 = 0 AND length(p_name) > 10),
k AS (SELECT 'pmc' AS service, d || '[DOI]' AS key, 1 AS k FROM d UNION ALL SELECT 'europe_pmc', 'DOI:' || d, 1 FROM d UNION ALL SELECT s, d, k FROM d, (SELECT unnest(['biorxiv', 'medrxiv', 'unpaywall', 'semantic_scholar', 'crossref']) AS s) UNION ALL
  SELECT 'pmc', regexp_replace(t, '[^a-zA-Z0-9 ]', ' ', 'g') || '[Title]', 1 FROM t UNION ALL SELECT 'europe_pmc', 'TITLE:"' || t || '"', 1 FROM t UNION ALL SELECT 'crossref_title', t, 1 FROM t)
SELECT DISTINCT service, key FROM k WHERE NOT (service = 'unpaywall' AND k % 9 = 0)""",
    "marked_pages": "SELECT conv_id, string_agg('<!-- PAGE ' || turn || ' -->' || chr(10) || role, chr(10) || chr(10) ORDER BY turn) AS text FROM conversations WHERE turn % 3 <> 0 GROUP BY conv_id",
    "page_texts": "SELECT a.conv_id, CASE WHEN b.text IS NULL THEN 'cell' ELSE 'cell ' || b.text END AS source_text FROM conversations a LEFT JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = 2 AND a.conv_id % 2 = 0 WHERE a.turn = 1",
    "solver_text": rf"""WITH {_P}, S AS (SELECT *, coalesce(nullif(compound, ''), 'Physiological') AS g, substr(regexp_replace(regexp_replace(coalesce(nullif(symbol, ''), name), '[^A-Za-z0-9_]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 40) AS s0 FROM P),
K AS (SELECT *, {_SYM} AS s FROM S), R AS (SELECT *, row_number() OVER (PARTITION BY doc, g, s ORDER BY ord) AS k FROM K),
L AS (SELECT doc, g, ord, CASE WHEN k > 1 THEN s || '_2' ELSE s END || ' = ' || coalesce(value, 0.0::DOUBLE)::VARCHAR || ', // ' || name || CASE WHEN coalesce(unit, '') <> '' THEN ' [' || unit || ']' ELSE '' END AS l FROM R),
G AS (SELECT doc, g, '// ' || g || chr(10) || string_agg(l, chr(10) ORDER BY ord) AS b FROM L GROUP BY doc, g)
SELECT doc, sha256('$PARAM' || chr(10) || string_agg(b, chr(10) ORDER BY g <> 'Physiological', g) || chr(10) || '$CMT DEPOT CENTRAL' || chr(10) || '$ODE' || chr(10) || 'dxdt_DEPOT = -KA * DEPOT;' || chr(10) || 'dxdt_CENTRAL = KA * DEPOT - CL / V1 * CENTRAL;' || chr(10) || '$TABLE capture CP = CENTRAL / V1;') AS text_sha256 FROM G GROUP BY doc""",
    "parameter_table": f"""WITH {_P} SELECT coalesce(nullif(symbol, ''), 'std') AS "Symbol", coalesce(CASE WHEN ord % 4 = 0 THEN upper(name) END, name) AS "Name", class AS "Class", coalesce(nullif(unit, ''), '?') AS "Unit", coalesce(species, 'Rat') AS "Species", compound AS "Compound",
  CASE WHEN ord % 5 = 0 THEN 'p. 1' ELSE nullif(source_table, '') END AS "Source", count(*) AS n, count(value) AS n_values FROM P GROUP BY ALL""",
    "template_answers": """SELECT p_partkey, 0 AS pos, p_name AS name, CASE WHEN p_partkey % 3 <> 0 THEN 'V' END AS symbol, p_size::DOUBLE AS value, CASE WHEN p_partkey % 2 = 0 THEN 'L' ELSE 'dimensionless' END AS unit, CASE WHEN p_partkey % 7 <> 0 THEN 'PFOS' END AS compound, 'human' AS species FROM part WHERE p_partkey % 5 <> 0
UNION ALL SELECT p_partkey, 1, 'range', NULL, p_size + 1.5::DOUBLE, 'dimensionless', NULL, 'rat' FROM part""",
    "critic_corrections": f"""WITH {_P} SELECT doc, ord, CASE WHEN ord % 7 = 1 THEN 'mg' ELSE unit END AS unit, class, CASE WHEN ord % 7 = 2 THEN 1.5::DOUBLE ELSE value END AS value, CASE WHEN ord % 7 = 2 THEN NULL ELSE species END AS species, compound, ord % 7 BETWEEN 1 AND 3 AS llm_corrected FROM P WHERE ord % 7 <> 6""",
    "record_ids": f"""WITH {_P} SELECT doc, ord, 'param_' || substr(sha256(lower(concat_ws('|', coalesce(source_table, ''), coalesce(nullif(row_id, ''), replace(row_path, '|', '_')), coalesce(nullif(column_id, ''), replace(column_path, '|', '_')), coalesce(cell_id, ''), name, coalesce(symbol, ''), coalesce(compound, ''), coalesce(species, ''), organ, '', population,
  replace(formulation, '|', ','), coalesce(value::VARCHAR, ''), coalesce(start_value::VARCHAR, ''), coalesce(end_value::VARCHAR, ''), coalesce(unit, ''), substr(coalesce(quote, ''), 1, 50)))), 1, 16) AS parameter_id FROM P""",
    "front_matter": "SELECT p_partkey, p_name AS title, CASE WHEN p_partkey % 2 = 0 THEN 'https://doi.org/10.1/' || p_partkey END AS doi, CASE WHEN p_partkey % 3 = 0 THEN 'Journal of it' ELSE 'Environment' END AS journal FROM part",
    "answer_forms": """SELECT p_partkey, ['yes', 'partially', 'not_applicable', 'i_cannot_answer', 'i_cannot_answer', 'no', 'i_cannot_answer'][p_partkey % 7 + 1] AS response, [3, 3, NULL, NULL, NULL][p_partkey % 5 + 1] AS page, CASE WHEN p_partkey % 4 = 0 THEN 'a quote' END AS quote FROM part""",
    "penalised_pages": """WITH s AS (SELECT p_partkey AS page, p_size / 3.0::DOUBLE - CASE WHEN p_partkey % 17 / 2.0::DOUBLE > p_size / 3.0::DOUBLE AND p_size / 3.0::DOUBLE < 10 THEN 10 ELSE 0 END AS score FROM part),
r AS (SELECT *, row_number() OVER (ORDER BY score DESC, page) AS rank, max(score) OVER () AS m FROM s) SELECT page, rank, round(score, 4) AS score FROM r WHERE rank <= 40 AND (rank <= 4 OR score >= 0.9::DOUBLE * m)""",
}
