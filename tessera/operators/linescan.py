"""Tables that a page's text has as lines: a caption, headings, and a name, a
symbol and numbers on lines of their own.

Lines are rows.  What a line is follows from itself; which table it is in, and
what that table has said of species and columns, from windows over the lines
before; what a name takes from the seven lines after it.  A line that a name
has taken is no name: lines that no reach of an earlier one touches begin
islands, and only within these few lines is anything settled in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import FORMULATIONS, LIFE_STAGES, SPECIES, acronyms, first_label
from .repair import keep_first

#: What opens and closes a table, tables of outcomes, lines that
#: are headings, and words that are no symbols.
CAPTION = r"(?i)^Table\s+(?:\d+|[IVX]+|S\d+)\b"
CLOSING = ("Figure", "References", "Discussion", "Funding", "Declaration")
OUTCOMES = ("pod", "benchmark dose", "bmd", "sensitivity analysis")
HEADINGS = ("species", "type of variable", "variable", "name", "mean (95% ci)", "mean", "source", "parameter", "value", "unit", "physiological", "chemical-specific")
NO_SYMBOL = ("species", "variable", "name", "source")
#: Years of citations and exponents of a body weight, which are
#: no values.
CITATION = r"\((?:19|20)\d{2}[a-z]?\)|(?i:et\s+al)\.?,?\s*(?:19|20)\d{2}[a-z]?"
EXPONENT = r"kg\^?0\.\d+"

_SIGNED = r"[+-]?\d+(?:\.\d+)?"
VALUE = rf"^({_SIGNED}(?:[eE][+-]?\d+)?)(?:\s*\(\s*({_SIGNED})\s*,\s*({_SIGNED})\s*\))?"

#: Characters of a line that may name columns, and of a symbol, each at most;
#: lines after a name that it may take; characters of a caption that are kept.
COLUMNS_LINE, SYMBOL, AHEAD, KEPT = 29, 11, 7, 100


def _any(text: Column, words: tuple[str, ...]) -> Column:
    return F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(text, w))


def number(line: Column) -> Column:
    """struct(value, low, high) of a line's leading value and its interval,
    without years of citations; null of a line that does not begin so."""
    clean = F.trim(F.regexp_replace(F.regexp_replace(line, CITATION, ""), EXPONENT, "kg"))
    part = lambda k: F.nullif(F.regexp_extract(clean, VALUE, k), F.lit("")).cast("double")
    return F.when(clean.rlike(VALUE), F.struct(part(1).alias("value"), part(2).alias("low"), part(3).alias("high")))


def lines(pages: DataFrame, doc: str, page: str, text: str) -> DataFrame:
    """(doc, page, i, line, number, opens, closes): the lines of each page that
    say something, and whether one opens a table or closes it; a line that
    begins with a number does neither."""
    split = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    x = pages.select(doc, page, F.posexplode(split).alias("i", "line")).withColumn("number", number(F.col("line")))
    bare = F.col("number").isNull()
    x = x.withColumn("opens", bare & F.col("line").rlike(CAPTION))
    return x.withColumn("closes", bare & ~F.col("opens") & _any(F.col("line"), CLOSING))


def _in_tables(x: DataFrame, doc: str, page: str) -> DataFrame:
    """Lines of tables of inputs, from the caption to what closes them."""
    so_far = Window.partitionBy(doc, page).orderBy("i")
    x = x.withColumns({"table": F.count_if("opens").over(so_far), "_next": F.collect_list(F.struct("line", "number", "opens", "closes")).over(so_far.rowsBetween(1, AHEAD))}).filter("table > 0")
    within = Window.partitionBy(doc, page, "table").orderBy("i")
    x = x.withColumns({"caption": F.substring(F.first("line").over(within), 1, KEPT), "_shut": F.max("closes").over(within)})
    return x.filter(~F.col("_shut") & ~_any(F.lower("caption"), OUTCOMES)).drop("_shut")


def _taken(x: DataFrame) -> DataFrame:
    """x with what each line would take as a name: `symbol`, `found` (the
    numbers' lines) and `takes`, how many lines these are."""
    one = F.get("_next", F.lit(0))
    of = one["line"]
    is_symbol = F.coalesce((F.length(of) <= SYMBOL) & ~of.rlike(r"^\d") & ~F.lower(of).isin(*NO_SYMBOL) & ~one["opens"] & ~one["closes"], F.lit(False))
    x = x.withColumn("symbol", F.when(is_symbol, of).otherwise(""))
    rest = F.when(F.col("symbol") != "", F.slice("_next", 2, AHEAD)).otherwise(F.col("_next"))
    x = x.withColumn("_rest", rest)
    end = F.array_position(F.transform("_rest", lambda r: r["number"].isNull()), True)
    named = ~F.col("opens") & ~F.lower("line").isin(*HEADINGS) & (F.length("line") > 2)
    x = x.withColumn("found", F.when(named, F.when(end > 0, F.slice("_rest", F.lit(1), (end - 1).cast("int"))).otherwise(F.col("_rest"))).otherwise(F.slice("_rest", 1, 0)))
    return x.withColumn("takes", F.when(F.size("found") > 0, F.size("found") + (F.col("symbol") != "").cast("int")).otherwise(0)).drop("_rest", "_next")


def _left(x: DataFrame, doc: str, page: str) -> DataFrame:
    """The lines that no name before them has taken."""
    order = Window.partitionBy(doc, page, "table").orderBy("i")
    reach = F.max(F.col("i") + F.col("takes")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    x = x.withColumn("_new", (F.coalesce(reach, F.lit(-1)) < F.col("i")).cast("int")).withColumn("_island", F.sum("_new").over(order)).drop("_new")
    rest = [c for c in x.columns if c not in (doc, page, "table", "_island")]
    x = x.groupBy(doc, page, "table", "_island").agg(F.sort_array(F.collect_list(F.struct("i", *(c for c in rest if c != "i")))).alias("_l"))
    start = F.struct(F.lit(0).alias("free"), F.array().cast("array<int>").alias("at"))
    step = lambda a, r: F.when(r["i"] >= a["free"], F.struct((r["i"] + r["takes"] + 1).cast("int").alias("free"), F.concat(a["at"], F.array(r["i"])).alias("at"))).otherwise(a)
    x = x.withColumn("_at", F.aggregate("_l", start, step)["at"])
    return x.select(doc, page, "table", F.explode(F.filter("_l", lambda r: F.array_contains("_at", r["i"]))).alias("r")).select(doc, page, "table", "r.*")


FIELDS = ("name", "symbol", "value", "low", "high", "value_text", "unit", "caption", "species", "compound", "life_stage", "formulation")


def scan(pages: DataFrame, doc: str, page: str, text: str) -> DataFrame:
    """(doc, page, pos and FIELDS): the records of all pages, a row a page.

    A name is a line of three characters and more of a table, and no heading,
    that numbers follow, perhaps after a line with its symbol; it takes up to
    AHEAD lines.  Its numbers are the columns' compounds' in their order, the
    first one's beyond them.  Species, life stage and formulation are the last
    that the table has told; a caption begins anew.
    """
    x = _left(_taken(_in_tables(lines(pages, doc, page, text), doc, page)), doc, page)
    w = Window.partitionBy(doc, page, "table").orderBy("i")
    last = lambda rules, default=None: F.coalesce(F.last(first_label(F.col("line"), rules), ignorenulls=True).over(w), F.lit(default).cast("string"))
    here = F.when(F.col("opens") | (F.length("line") <= COLUMNS_LINE), acronyms(F.col("line"))).otherwise(F.array().cast("array<string>"))
    x = x.withColumns({
        "species": last(SPECIES, "human"), "life_stage": last(LIFE_STAGES), "formulation": last(FORMULATIONS), "_columns": F.array_distinct(F.flatten(F.collect_list(here).over(w))),
        "unit": F.coalesce(F.trim(F.nullif(F.regexp_extract("line", r"\(([^)]+)\)", 1), F.lit(""))), F.lit("dimensionless")),
    })
    x = x.select("*", F.posexplode("found").alias("k", "f"))
    compound = F.coalesce(F.get("_columns", F.col("k")), F.get("_columns", F.lit(0)))
    pos = (F.row_number().over(Window.partitionBy(doc, page).orderBy("i", "k")) - 1).alias("pos")
    return x.select(
        doc, page, pos, F.col("line").alias("name"), "symbol", *(F.col(f"f.number.{c}").alias(c) for c in ("value", "low", "high")), F.col("f.line").alias("value_text"), "unit", "caption", "species", compound.alias("compound"), "life_stage", "formulation",
    )


def distinct_scan(found: DataFrame, doc: str, page: str) -> DataFrame:
    """Of a document's records with one name, value, compound and species the
    first."""
    return keep_first(found, [doc, F.lower("name"), "value", "compound", "species"], [page, "pos"])


def with_fallback(first: DataFrame, second: DataFrame, doc: str, least: int = 10) -> DataFrame:
    """first, and of documents with fewer than `least` rows there those of
    second besides."""
    enough = first.groupBy(doc).agg(F.count("*").alias("_n")).filter(F.col("_n") >= least).select(doc)
    return first.unionByName(second.join(enough, doc, "left_anti"), allowMissingColumns=True)


def statements(found: DataFrame) -> DataFrame:
    """found with `statement`, a record as a sentence for a model."""
    spread = F.when(F.col("low").isNotNull(), F.format_string(" (95%% CI: %s to %s)", F.col("low").cast("string"), F.col("high").cast("string"))).otherwise("")
    who = F.concat_ws(", ", "compound", "species", "life_stage", "formulation")
    return found.withColumn("statement", F.concat("name", F.when(F.col("symbol") != "", F.concat(F.lit(" ["), "symbol", F.lit("]"))).otherwise(""), F.lit(" for "), who, F.lit(" = "), F.col("value").cast("string"), spread, F.lit(" "), "unit"))
