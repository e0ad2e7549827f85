"""Steps between a model's answers and parameter records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import stable_id


def flatten_blocks(blocks: DataFrame, doc: str, items: str = "parameters") -> DataFrame:
    """Blocks (species, unit, class, parameters array) as parameters; what a
    parameter lacks it has from its block; an id from its identity."""
    x = blocks.select(doc, "block_ord", F.col("species").alias("_sp"), F.col("unit").alias("_un"), F.col("class").alias("_cl"), F.posexplode(items).alias("pos", "p"))
    out = x.select(doc, "block_ord", "pos", F.col("p.name").alias("name"), F.col("p.value").alias("value"), F.coalesce("p.species", "_sp").alias("species"), F.coalesce("p.unit", "_un").alias("unit"), F.coalesce("p.class", "_cl").alias("class"))
    return out.withColumn("parameter_id", stable_id(F.col("name"), F.col("species"), F.col("value").cast("string"), F.col("unit")))


def reroute(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that stay, and rows for the sibling table."""
    p = F.coalesce(predicate, F.lit(False))
    return df.filter(~p), df.filter(p)


def with_value(df: DataFrame) -> DataFrame:
    return df.filter(F.col("value_text").isNotNull() | F.col("value").isNotNull())


#: Units of rates and clearances, symbols of kinetics, and units
#: whose prefix must not be lost.
RATE_UNITS = r"(?i)/h|/min|h\^-1|l/h|ml/min|mg/h/kg|ug/h/kg"
KINETIC_SYMBOLS = r"\b(?:Tmc|Vmax|Kt|Km|QCC|k12|k21|ka)\b"
PREFIXED = ("nmol", "umol", "mmol", "pmol", "mg", "ug", "ng", "pg", "ml", "ul")


def real_doses(df: DataFrame, unit: str, *texts: str) -> DataFrame:
    """Doses without those that are rates or clearances by unit (per day is a
    dose) or name a kinetic symbol in their texts."""
    u = F.coalesce(unit, F.lit(""))
    rate = u.rlike(RATE_UNITS) & ~F.contains(F.lower(u), F.lit("day"))
    return df.filter(~rate & ~F.concat_ws(" ", *texts).rlike(KINETIC_SYMBOLS))


def guard_prefix(original: Column, standard: Column) -> Column:
    """The standard unit, null if a prefixed unit of the original is lost."""
    form = lambda c: F.translate(F.lower(c), "µμ", "uu")
    lost = F.exists(F.array(*map(F.lit, PREFIXED)), lambda p: F.contains(form(original), p) & ~F.contains(form(standard), p))
    return F.when((standard == "") | ~F.coalesce(lost, F.lit(False)), standard)


def of_compound(df: DataFrame, column: str, compound: str, klass: str = "class") -> DataFrame:
    """A compound's rows, the physiological ones and those without compound."""
    return df.filter(F.col(column).isNull() | (F.col(klass) == "physiological") | (F.lower(column) == compound.lower()))


def union_first(parts: list[DataFrame], key: list[str], order: str) -> DataFrame:
    """All parts' rows, of a key the first part's first."""
    out = None
    for i, p in enumerate(parts):
        p = p.withColumn("_part", F.lit(i))
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    w = Window.partitionBy(*key).orderBy("_part", order)
    return out.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k", "_part")


def larger_structure(df: DataFrame, doc: str, items: str, order: str) -> DataFrame:
    """Of a document's versions the one with most items, the first of these."""
    return df.groupBy(doc).agg(F.max_by(F.col(items), F.struct(F.size(items), -F.col(order))).alias(items))


def good_boxes(boxes: DataFrame, page: str, confidence: float = 0.3, low: float = 0.01, high: float = 0.95, tall: float = 10.0) -> DataFrame:
    """The union of a page's boxes that may be a table, with 5 % of the page
    at the sides, 10 % above for the caption and 15 % below for footnotes.

    boxes: page, label, score, x0, y0, x1, y1 (whole pixels), width, height.
    """
    whole = {c: F.col(c).cast("int") for c in ("x0", "y0", "x1", "y1")}
    x = boxes.withColumns(whole)
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    area = F.col("width") * F.col("height")
    ok = (F.col("score") >= confidence) & F.contains(F.lower("label"), F.lit("table")) & (w * h >= area * low) & (w * h <= area * high) & (w != 0) & (F.try_divide(h, w) <= tall)
    pad = lambda c, s: F.floor(F.max(c) * F.lit(s))
    return x.filter(ok).groupBy(page).agg(
        F.greatest(F.lit(0), F.min("x0") - pad("width", 0.05)).cast("long").alias("x0"), F.greatest(F.lit(0), F.min("y0") - pad("height", 0.10)).cast("long").alias("y0"),
        F.least(F.max("width"), F.max("x1") + pad("width", 0.05)).cast("long").alias("x1"), F.least(F.max("height"), F.max("y1") + pad("height", 0.15)).cast("long").alias("y1"),
        F.max("score").alias("best"), F.count("*").alias("n_boxes"),
    )


def title_line(lines: DataFrame, key: str) -> DataFrame:
    """Of a page's first eight lines of more than 20 characters the first that
    is neither authors nor places: few digits, three commas at most."""
    x = lines.withColumn("_t", F.trim("line")).filter(F.length("_t") > 20)
    x = x.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy("pos"))).filter("_k <= 8")
    digits = F.length(F.regexp_replace("_t", "[^0-9]", "")) / F.length("_t")
    commas = F.length("_t") - F.length(F.regexp_replace("_t", ",", ""))
    ok = (digits <= 0.05) & (commas <= 3) & (F.length("_t") < 300)
    return x.filter(ok).groupBy(key).agg(F.min_by("_t", "pos").alias("title"))


def batch_summary(df: DataFrame, ok: str, n: str) -> DataFrame:
    return df.agg(F.count("*").alias("documents"), F.count_if(F.col(ok)).alias("succeeded"), F.count_if(~F.col(ok)).alias("failed"), F.sum(n).alias("total"))
