"""Queries on chunks, pages and uploads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ingest
from .common import LINES, lines, read


def upload_routing(spark, d):
    x = read(spark, d, "part").select("p_partkey", F.concat("p_name", F.element_at(F.array(*map(F.lit, (".PDF", ".json", ".md", ".exe"))), F.pmod("p_partkey", F.lit(4)).cast("int") + 1)).alias("name"))
    good, bad = ingest.route_uploads(x)
    return good.groupBy("kind").agg(F.count("*").alias("n")).unionByName(bad.groupBy(F.col("reason").alias("kind")).agg(F.count("*").alias("n")))


def quick_table_scan(spark, d):
    x = lines(spark, d, "l_returnflag", "l_quantity", "l_linestatus").withColumn("pos", F.col("ord") - 1)
    x = x.withColumn("cells", F.array(F.concat(F.lit(" "), "l_returnflag"), F.col("l_quantity").cast("int").cast("string"), F.when(F.col("ord") % 2 == 0, "mg").otherwise("a unit that is far too long")))
    return ingest.quick_table(x, "l_orderkey", "cells")


def sibling_files(spark, d):
    docs = read(spark, d, "documents").select(F.pmod("doc_id", F.lit(50)).alias("stem"), "doc_id")
    pages = read(spark, d, "pages").select(F.pmod("page_id", F.lit(50)).alias("stem"), "html")
    return ingest.siblings(docs, pages, "stem", "html").groupBy("sibling").agg(F.count("*").alias("n"))


def page_containment(spark, d):
    c = read(spark, d, "conversations")
    pages = c.select("conv_id", F.col("turn").alias("page"), F.col("text").alias("body"))
    caps = c.filter("turn = 1").select("conv_id", F.col("text").alias("caption"), F.split_part("text", F.lit("."), F.lit(1)).alias("title"))
    return ingest.page_of(caps, pages, "conv_id", "caption", "title", "body", "page").select("conv_id", "page")


def source_text(spark, d):
    x = lines(spark, d, "l_returnflag", "l_linestatus")
    cells = x.select("l_orderkey", F.lit("t").alias("tab"), F.col("l_returnflag").alias("row_id"), F.col("l_linestatus").alias("column_id"), F.format_string("c%02d", "ord").alias("cell_id"), F.concat("l_returnflag", "l_linestatus").alias("text"))
    p = x.select("l_orderkey", "ord", F.lit("t").alias("tab"), F.when(F.col("l_orderkey") % 20 == 0, F.col("l_returnflag")).alias("row_id"), F.col("l_linestatus").alias("column_id"), F.lit(None).cast("string").alias("cell_id"))
    return ingest.source_text(p, cells, "l_orderkey", "tab").select("l_orderkey", "ord", "source_text")


def section_routing(spark, d):
    x = lines(spark, d, "l_returnflag")
    title = F.element_at(F.array(*map(F.lit, ("Abstract", "Introduction", "Methods", "References", "Results"))), F.pmod("ord", F.lit(5)).cast("int") + 1)
    x = x.select("l_orderkey", F.col("ord").alias("sec"), F.when(F.col("ord") % 4 == 0, F.col("ord") - 1).alias("parent"), title.alias("title"), F.concat(F.repeat("l_returnflag", F.lit(40)), F.lit("\n\n"), F.repeat("l_returnflag", F.col("ord") * 3)).alias("content"))
    return ingest.sections(x, "l_orderkey", "parent", "sec").select("l_orderkey", "sec", "routing", F.length("content").alias("n_chars"))


def compact_documents(spark, d):
    x = read(spark, d, "conversations")
    items = F.array_sort(F.collect_list(F.struct(F.col("turn").alias("o"), F.col("role").alias("name"), F.col("turn").alias("value"), F.col("text").alias("quote"))))
    got = x.groupBy("conv_id").agg(items.alias("items")).select("conv_id", F.inline(ingest.compact(F.col("items"))))
    return got.select("conv_id", "name", "value", "quote")


def entity_pivot(spark, d):
    x = lines(spark, d, "l_returnflag", "l_quantity").select("l_orderkey", F.col("l_returnflag").alias("label"), F.col("l_quantity").cast("int").cast("string").alias("text"), F.col("ord").alias("start"))
    return ingest.entities_by_line(x, ["l_orderkey"], "label", "text", ["A", "N", "R"])


def latest_version(spark, d):
    o = read(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return ingest.latest(o, "o_custkey", "o_orderkey")


def cached_adapter(spark, d):
    p = read(spark, d, "part").select(F.element_at(F.split("p_name", " "), 1).alias("paper")).distinct()
    f = read(spark, d, "part").select(F.when(F.col("p_partkey") % 40 == 0, F.element_at(F.split("p_name", " "), 1)).otherwise(F.translate("p_name", " ", "_")).alias("stem")).distinct()
    return ingest.cached_prediction(p, f, "paper", "stem")


def otsl_tables(spark, d):
    x = read(spark, d, "part").select("p_partkey", F.concat(F.lit("<otsl><fcel>"), "p_name", F.lit("<fcel>"), F.col("p_size").cast("string"), F.lit("<nl></otsl>")).alias("t"))
    return x.select("p_partkey", ingest.otsl_to_markdown(F.col("t")).alias("md"))


def markdown_facts(spark, d):
    x = read(spark, d, "part").select("p_partkey", F.concat_ws("\n", "p_name", F.when(F.col("p_size") % 2 == 0, "| a | b |"), F.when(F.col("p_size") % 3 == 0, "solved in MATLAB"), F.when(F.col("p_size") % 5 == 0, "Goodness of fit and absorption")).alias("t"))
    return ingest.markdown_facts(x, "p_partkey", "t")


def method_ranking(spark, d):
    x = read(spark, d, "lineitem").groupBy("l_returnflag").agg(F.round(F.avg("l_discount"), 6).alias("a"), F.round(F.avg("l_tax"), 6).alias("b"))
    got = ingest.ranked_methods(x, "l_returnflag", {"a": 0.4, "b": 0.6})
    return got.select("l_returnflag", "rank", F.round("composite", 6).alias("composite"))


QUERIES = {f.__name__: f for f in (
    upload_routing, quick_table_scan, sibling_files, page_containment, source_text, section_routing, compact_documents, entity_pivot, latest_version,
    cached_adapter, otsl_tables, markdown_facts, method_ranking,
)}
_NORM = "trim(regexp_replace(lower({}), '\\s+', ' ', 'g'))"
ORACLE_SQL = {
    "upload_routing": "SELECT ['pdf', 'json', 'md', 'unsupported file type: exe'][p_partkey % 4 + 1] AS kind, count(*) AS n FROM part GROUP BY 1",
    "quick_table_scan": f"WITH {LINES} SELECT l_orderkey, (ord - 1)::INT AS pos, l_returnflag AS name, l_quantity::INT::VARCHAR AS value, CASE WHEN ord % 2 = 0 THEN 'mg' END AS unit FROM L WHERE ord BETWEEN 2 AND 15",
    "sibling_files": "SELECT doc_id % 50 IN (SELECT page_id % 50 FROM pages WHERE contains(html, '<article')) AS sibling, count(*) AS n FROM documents GROUP BY 1",
    "page_containment": f"""WITH c AS (SELECT conv_id, {_NORM.format('text')} AS cap, {_NORM.format("split_part(text, '.', 1)")} AS t FROM conversations WHERE turn = 1),
p AS (SELECT conv_id, turn AS page, {_NORM.format('text')} AS b FROM conversations)
SELECT conv_id, coalesce(min(page) FILTER (cap <> '' AND contains(b, substr(cap, 1, 50))), max(page) FILTER (t <> '' AND contains(b, t))) AS page FROM c JOIN p USING (conv_id) GROUP BY conv_id, cap, t""",
    "source_text": f"""WITH {LINES}, X AS (SELECT * FROM L)
SELECT p.l_orderkey, p.ord, string_agg(c.l_returnflag || c.l_linestatus, ' ' ORDER BY c.ord) AS source_text FROM X p JOIN X c ON p.l_orderkey = c.l_orderkey
WHERE c.l_linestatus = p.l_linestatus AND (p.l_orderkey % 20 <> 0 OR c.l_returnflag = p.l_returnflag) GROUP BY p.l_orderkey, p.ord""",
    "section_routing": f"""WITH {LINES}, X AS (SELECT l_orderkey, ord AS sec, ['Abstract', 'Introduction', 'Methods', 'References', 'Results'][ord % 5 + 1] AS title, 42 + 3 * ord AS n FROM L),
I AS (SELECT l_orderkey, sec - 1 AS sec FROM X WHERE sec % 4 = 0)
SELECT l_orderkey, sec::INT AS sec, CASE WHEN title IN ('Abstract', 'Introduction') THEN 'purpose' ELSE 'model_evidence' END AS routing, (CASE WHEN title = 'Introduction' THEN n - 42 ELSE n END)::INT AS n_chars
FROM X WHERE title <> 'References' AND n >= CASE WHEN title = 'Abstract' THEN 30 ELSE 50 END AND NOT EXISTS (SELECT 1 FROM I WHERE I.l_orderkey = X.l_orderkey AND I.sec = X.sec)""",
    "compact_documents": "SELECT conv_id, role AS name, turn AS value, substr(text, 1, 200) AS quote FROM conversations",
    "entity_pivot": f"""WITH {LINES} SELECT l_orderkey, arg_min(l_quantity::INT::VARCHAR, ord) FILTER (l_returnflag = 'A') AS A, arg_min(l_quantity::INT::VARCHAR, ord) FILTER (l_returnflag = 'N') AS N, arg_min(l_quantity::INT::VARCHAR, ord) FILTER (l_returnflag = 'R') AS R FROM L GROUP BY l_orderkey""",
    "latest_version": "SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1",
    "cached_adapter": """WITH s AS (SELECT DISTINCT CASE WHEN p_partkey % 40 = 0 THEN split_part(p_name, ' ', 1) ELSE replace(p_name, ' ', '_') END AS stem FROM part)
SELECT split_part(stem, '_', 1) AS paper, coalesce(max(stem) FILTER (stem = split_part(stem, '_', 1)), max(stem)) AS stem FROM s GROUP BY 1""",
    "otsl_tables": "SELECT p_partkey, '| ' || p_name || ' | ' || p_size || ' |' || chr(10) AS md FROM part",
    "markdown_facts": "SELECT p_partkey, p_size % 2 = 0 AS has_table, false AS has_equation, p_size % 3 = 0 AS has_software, p_size % 5 = 0 AS has_adme, p_size % 5 = 0 AS has_fit FROM part",
    "method_ranking": """WITH s AS (SELECT l_returnflag, 0.4::DOUBLE * round(avg(l_discount), 6) + 0.6::DOUBLE * round(avg(l_tax), 6) AS c FROM lineitem GROUP BY 1)
SELECT l_returnflag, row_number() OVER (ORDER BY c DESC, l_returnflag) AS rank, round(c, 6) AS composite FROM s""",
}
