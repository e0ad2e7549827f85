"""Ingestion of chunks, pages and uploads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normal_text


def route_uploads(files: DataFrame, name: str = "name") -> tuple[DataFrame, DataFrame]:
    """Files by kind (pdf, json, md), and those of no known kind."""
    ext = F.lower(F.regexp_extract(F.col(name), r"\.([A-Za-z0-9]+)$", 1))
    kind = F.when(ext.isin("pdf", "json", "md"), ext)
    x = files.withColumn("kind", kind)
    return x.filter("kind IS NOT NULL"), x.filter("kind IS NULL").drop("kind").withColumn("reason", F.concat(F.lit("unsupported file type: "), ext))


def quick_table(rows: DataFrame, key: str, cells: str, most: int = 14) -> DataFrame:
    """(key, pos, name, value, unit) of the first data rows of raw tables: the
    unit is the third cell if it is short."""
    x = rows.filter(F.col("pos").between(1, most)).filter(F.size(cells) >= 2)
    third = F.try_element_at(F.col(cells), F.lit(3))
    return x.select(key, "pos", F.trim(F.col(cells)[0]).alias("name"), F.trim(F.col(cells)[1]).alias("value"), F.when(F.length(third) < 20, third).alias("unit"))


def siblings(left: DataFrame, right: DataFrame, stem: str, body: str) -> DataFrame:
    """left with `sibling`: whether a file of the same stem holds an article."""
    ok = right.filter(F.contains(body, F.lit("<article"))).select(stem).distinct().withColumn("sibling", F.lit(True))
    return left.join(ok, stem, "left").withColumn("sibling", F.coalesce("sibling", F.lit(False)))


def page_of(captions: DataFrame, pages: DataFrame, doc: str, caption: str, title: str, body: str, page: str) -> DataFrame:
    """Each caption's page: the first that holds the caption's first 50
    characters, else the last that holds the title; an empty text is nowhere."""
    c = captions.join(pages, doc)
    t = normal_text(F.col(body))
    holds = lambda x: (x != "") & F.contains(t, x)
    by_caption, by_title = holds(F.substring(normal_text(F.col(caption)), 1, 50)), holds(normal_text(F.col(title)))
    return c.groupBy(doc, caption).agg(F.coalesce(F.min(F.when(by_caption, F.col(page))), F.max(F.when(by_title, F.col(page)))).alias("page"))


def source_text(parameters: DataFrame, cells: DataFrame, doc: str, table: str) -> DataFrame:
    """parameters with the text of the cells that their provenance names; a
    provenance part that is null names all."""
    names = ["row_id", "column_id", "cell_id"]
    c = cells.select(doc, table, *(F.col(n).alias("_" + n) for n in names), F.col("text").alias("_text"))
    fits = F.lit(True)
    for n in names:
        fits = fits & (F.col(n).isNull() | (F.col(n) == F.col("_" + n)))
    texts = F.array_sort(F.collect_list(F.when(fits, F.struct("_cell_id", "_text"))))
    keys = parameters.columns
    return parameters.join(c, [doc, table], "left").groupBy(*keys).agg(F.array_join(F.transform(texts, lambda x: x["_text"]), " ").alias("source_text"))


def sections(rows: DataFrame, doc: str, parent: str, ident: str, least: int = 50, abstract: int = 30) -> DataFrame:
    """Leaf sections without references and without what is too short, with
    their routing: purpose or model evidence."""
    t = F.lower(F.coalesce("title", F.lit("")))
    inner = rows.filter(F.col(parent).isNotNull()).select(doc, F.col(parent).alias(ident)).distinct()
    x = rows.join(inner, [doc, ident], "left_anti").filter(~t.rlike("^(?:references?|bibliography)"))
    x = x.filter(F.length("content") >= F.when(t.contains("abstract"), abstract).otherwise(least))
    purpose = t.rlike("abstract|introduction|objective|aim|discussion|conclusion|summary")
    last = F.element_at(F.split("content", "\n\n"), -1)
    return x.withColumns({"routing": F.when(purpose, "purpose").otherwise("model_evidence"), "content": F.when(t.contains("introduction"), last).otherwise(F.col("content"))})


def compact(items: Column, most: int = 200) -> Column:
    """Items (name, value, quote) with short quotes."""
    return F.transform(items, lambda p: F.struct(p["name"].alias("name"), p["value"].alias("value"), F.substring(p["quote"], 1, most).alias("quote")))


def entities_by_line(found: DataFrame, key: list[str], label: str, text: str, labels: list[str]) -> DataFrame:
    """Recognised entities, one row a line, one column a label, the first of each."""
    return found.groupBy(*key).pivot(label, labels).agg(F.min_by(text, "start"))


def latest(df: DataFrame, key: str, version: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.desc(version))
    return df.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")


def cached_prediction(papers: DataFrame, files: DataFrame, key: str, stem: str) -> DataFrame:
    """Each paper's cached file: its exact stem, else the last that begins
    with the key."""
    c = papers.join(files.withColumn(key, F.element_at(F.split(stem, "_"), 1)), key)
    w = Window.partitionBy(key).orderBy((F.col(stem) == F.col(key)).desc(), F.desc(stem))
    return c.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")


def otsl_to_markdown(c: Column) -> Column:
    """Cells of a table in its one-line language as Markdown rows."""
    t = F.regexp_replace(F.regexp_replace(c, r"<(?:fcel|ecel|lcel|ucel|xcel|ched|rhed)>", " | "), r"<nl>", " |\n")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"</?(?:otsl|loc_\d+)>", ""), r" +", " "))


#: Signs of what a paper's Markdown holds.
MARKDOWN_SIGNS = (
    ("has_table", r"(?m)^\s*\|.*\|"), ("has_equation", r"\$\$|\\frac|d[A-Z]\w*/dt"), ("has_software", r"(?i)\b(?:matlab|berkeley madonna|mrgsolve|monolix|acslx|simcyp)\b"),
    ("has_adme", r"(?i)absorption|distribution|metabolism|excretion"), ("has_fit", r"(?i)goodness[- ]of[- ]fit|\bR2\b|\bRMSE\b|fold error"),
)


def markdown_facts(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(key, *(F.coalesce(F.col(text).rlike(p), F.lit(False)).alias(n) for n, p in MARKDOWN_SIGNS))


def ranked_methods(scores: DataFrame, method: str, weights: dict[str, float]) -> DataFrame:
    """Methods by their composite score, best first."""
    total = sum((F.lit(w) * F.col(c) for c, w in weights.items()), F.lit(0.0))
    w = Window.orderBy(F.desc("composite"), method)  # a row a method
    return scores.withColumn("composite", total).withColumn("rank", F.row_number().over(w))


def front_matter(lines: DataFrame, key: str, most: int = 45) -> DataFrame:
    """(key, title, doi, journal) of a paper's first lines of Markdown: the
    first heading that is no page mark, the first line with a DOI's address,
    the first that names a journal."""
    t = F.trim("line")
    low = F.lower(t)
    title = t.startswith("# ") & ~F.contains(low, F.lit("page "))
    journal = F.contains(low, F.lit("journal")) | F.contains(low, F.lit("toxicological sciences")) | F.contains(low, F.lit("environment"))
    strip = lambda c, chars: F.regexp_replace(c, rf"^[{chars}]+|[{chars}]+$", "")
    pick = lambda value, hit: F.min_by(F.when(hit, value), F.when(hit, F.col("pos")))
    return lines.filter(F.col("pos") < most).groupBy(key).agg(
        pick(F.regexp_replace(F.regexp_replace(t, r"^[#* ]+", ""), r"[* ]+$", ""), title).alias("title"), pick(t, F.contains(t, F.lit("doi.org"))).alias("doi"), pick(strip(t, "*_ "), journal).alias("journal"),
    )
