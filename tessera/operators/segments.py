"""Texts as ordered lines, sentences and blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lines(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(key, F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("pos", "line"))


def islands(rows: DataFrame, key: str, order: str, kind: Column) -> DataFrame:
    """Runs of rows of one kind: (key, run, kind, first, last, n)."""
    w = Window.partitionBy(key).orderBy(order)
    x = rows.withColumn("kind", kind)
    x = x.withColumn("_new", F.coalesce((F.lag("kind").over(w) != F.col("kind")).cast("int"), F.lit(1)))
    x = x.withColumn("run", F.sum("_new").over(w))
    return x.groupBy(key, "run", "kind").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"))


def sentences(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(key, F.posexplode(F.split(F.coalesce(text, F.lit("")), r"(?<=[.!?]) +")).alias("pos", "sentence"))


def with_context(rows: DataFrame, key: str, hit: Column) -> DataFrame:
    """Rows that hit, and the row before each; of equal sentences the first."""
    w = Window.partitionBy(key).orderBy("pos")
    x = rows.withColumn("hit", F.coalesce(hit, F.lit(False)))
    x = x.withColumn("_next", F.coalesce(F.lead("hit").over(w), F.lit(False))).filter("hit OR _next").drop("_next")
    first = Window.partitionBy(key, F.xxhash64("sentence"), "sentence").orderBy("pos")
    return x.withColumn("_k", F.row_number().over(first)).filter("_k = 1").drop("_k")


def within_budget(blocks: DataFrame, key: str, budget: int) -> DataFrame:
    """First fit in order (priority, pos): a block is taken if it still fits.

    What fits hangs on all before, so a document's blocks are folded as one
    array of (pos, size); texts are joined back by place."""
    sizes = F.array_sort(F.collect_list(F.struct("priority", "pos", F.length("block").alias("n"))))
    start = F.struct(F.lit(0).alias("used"), F.array().cast("array<int>").alias("took"))
    fits = lambda a, x: a["used"] + x["n"] <= budget
    fold = F.aggregate(sizes, start, lambda a, x: F.struct(F.when(fits(a, x), a["used"] + x["n"]).otherwise(a["used"]).alias("used"), F.when(fits(a, x), F.array_append(a["took"], x["pos"])).otherwise(a["took"]).alias("took")))
    took = blocks.groupBy(key).agg(fold.alias("f")).select(key, F.explode("f.took").alias("pos"))
    return blocks.join(took, [key, "pos"])


def chat(df: DataFrame, text: str) -> DataFrame:
    """df with a row for each message of ChatML: role, content, pos."""
    pattern = r"(?s)<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>"
    roles, said = (F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(i)) for i in (1, 2))
    return df.withColumn("_m", F.explode(F.arrays_zip(roles.alias("r"), said.alias("s")))).select(*df.columns, F.col("_m.r").alias("role"), F.col("_m.s").alias("content"))


def scan_values(rows: DataFrame, key: str, symbol: str, number: str, ahead: int = 7) -> DataFrame:
    """Symbol lines and the run of numeric lines right after each:
    (key, pos, line, values).  Lookahead as windows, no state."""
    w = Window.partitionBy(key).orderBy("pos")
    nxt = F.array(*(F.lead("line", i).over(w) for i in range(1, ahead + 1)))
    x = rows.withColumn("_n", nxt).filter(F.col("line").rlike(symbol))
    start = F.struct(F.lit(True).alias("go"), F.array().cast("array<string>").alias("vs"))
    ok = lambda a, v: a["go"] & F.coalesce(v.rlike(number), F.lit(False))
    run = F.aggregate("_n", start, lambda a, v: F.struct(ok(a, v).alias("go"), F.when(ok(a, v), F.array_append(a["vs"], v)).otherwise(a["vs"]).alias("vs")), lambda a: a["vs"])
    return x.withColumn("values", run).filter("size(values) > 0").drop("_n")


def matches(df: DataFrame, key: str, text: str, pattern: str, context: int = 0) -> DataFrame:
    """(key, start, found[, context]): every match of a pattern with its place,
    and the text up to `context` characters round it.

    The pieces between the matches tell the places: a match starts after all
    pieces and matches before it.  Rows are told apart by a number of their
    own, so several texts may have one key.
    """
    x = df.select(key, text, F.monotonically_increasing_id().alias("_row"), F.split(text, pattern, -1).alias("_p"), F.regexp_extract_all(text, F.lit(pattern), 0).alias("_m")).filter("size(_m) > 0")
    x = x.select(key, "_row", *([text] if context else []), F.posexplode(F.arrays_zip("_p", "_m")).alias("_k", "_x")).filter("_x._m IS NOT NULL")
    w = Window.partitionBy("_row").orderBy("_k")
    till, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    start = F.sum(F.length("_x._p")).over(till) + F.coalesce(F.sum(F.length("_x._m")).over(before), F.lit(0))
    x = x.withColumn("start", start.cast("int")).withColumn("found", F.col("_x._m"))
    if not context:
        return x.select(key, "start", "found")
    low = F.greatest(F.lit(0), F.col("start") - context)
    return x.select(key, "start", "found", F.substring(F.col(text), low + 1, F.col("start") - low + F.length("found") + context).alias("context"))


#: Words of a block's first line, and of its first 400
#: characters, by what the block is about.
OPENING = ("abstract", "summary", "conclusion", "objective", "purpose")
EVALUATION = (
    "sensitivity", "evaluation", "validation", "goodness", "aafe", "rmse", "fold error", "fold-error", "uncertainty", "variability",
    "monte carlo", "mcmc", "results", "discussion", "comparison",
)
METHODS = (
    "method", "material", "model", "structure", "compartment", "equation", "parameter", "table", "software", "solver", "mrgsolve", "mcsim",
    "simcyp", "gastroplus", "pk-sim", "berkeley madonna", "matlab", "python", "scipy", "desolve", "dosing", "exposure", "calibration",
)

#: Begins of questionnaire items by what they need.
NEEDS = {
    "opening": ("TAN_1.1", "TAN_1.2", "TAN_1.3", "TAN_2.1.1", "TAN_2.1.2", "TAN_2.1.3", "TAN_2.3.1"),
    "methods": ("TAN_2.2", "TAN_2.4.1", "TAN_2.4.2", "TAN_2.4.3", "TAN_2.4.4", "TAN_2.4.5", "TAN_2.4.6", "TAN_2.4.7"),
    "evaluation": ("TAN_2.5", "TAN_2.1.3", "TAN_2.4.2B", "TAN_2.4.2C"),
}


def block_topic(block: Column, place: Column) -> Column:
    """What a block of Markdown is about: opening, evaluation or methods, else
    null; place counts a document's blocks from 0."""
    t = F.lower(block)
    line, head = F.substring_index(t, "\n", 1), F.substring(t, 1, 400)
    has = lambda where, words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(where, w))
    return (
        F.when(line.rlike(r"^#+\s*(?:1\.?\s*)?introduction\b") | (place <= 1) | has(line, OPENING), "opening").when(has(line, EVALUATION) | has(head, EVALUATION), "evaluation")
        .when(has(line, METHODS) | has(head, METHODS) | F.contains(block, F.lit("|")), "methods")
    )


def objective_only(block: Column, most: int = 2000) -> Column:
    """An introduction without its background: its first and last paragraph."""
    ps = F.filter(F.transform(F.split(block, r"\n\s*\n"), F.trim), lambda p: p != "")
    short = lambda p: F.substring(p, 1, most)
    cut = F.concat_ws("\n\n", short(F.element_at(ps, 1)), F.lit("[...]"), short(F.element_at(ps, -1)))
    intro = F.lower(F.substring_index(block, "\n", 1)).rlike(r"^#+\s*(?:1\.?\s*)?introduction\b")
    return F.when(intro & (F.size(ps) > 1), cut).otherwise(block)


def for_items(blocks: DataFrame, items: tuple[str, ...]) -> DataFrame:
    """blocks (doc, pos, block) with `priority`: 0 for what the items need, 1
    for the rest; for within_budget()."""
    wanted = [n for n, begins in NEEDS.items() if any(i.startswith(begins) for i in items)]
    topic = block_topic(F.col("block"), F.col("pos"))
    return blocks.withColumn("priority", F.when(F.coalesce(topic.isin(*wanted), F.lit(False)), 0).otherwise(1)).withColumn("block", objective_only(F.col("block")))
