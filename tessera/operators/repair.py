"""Record repair: dedup, identifiers, fills, donors, splits, supplements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import stable_id


def keep_first(df: DataFrame, key: list[Column | str], order: list[Column | str]) -> DataFrame:
    """The first row, in order, of each key."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")


def unique_ids(df: DataFrame, ident: str, order: list[str], scope: list[str] | None = None) -> DataFrame:
    """Repeats of an id get _2, _3 and so on, in order, without the numbers
    that make an id that a row has as it is."""
    scope = scope or []
    # An id that ends in a number is besides sent to the id before it, as one
    # that is taken there: so rows are dealt and sorted once, and not joined.
    c = F.col
    tail = F.substring_index(ident, "_", -1)
    base = c(ident).substr(F.lit(1), F.length(ident) - F.length(tail) - 1)
    is_taken = F.coalesce((F.length(ident) > F.length(tail)) & tail.rlike(r"\A([2-9]|[1-9]\d{1,8})\z"), F.lit(False))
    own = F.struct(c(ident).alias("id"), F.lit(None).cast("int").alias("n"))
    out = df.withColumn("_x", F.explode(F.when(is_taken, F.array(own, F.struct(base.alias("id"), tail.try_cast("int").alias("n")))).otherwise(F.array(own))))
    out = out.withColumns({"_id": c("_x.id"), "_n": c("_x.n")}).drop("_x")
    w = Window.partitionBy(*scope, "_id")
    out = out.withColumn("_k", F.row_number().over(w.orderBy(c("_n").isNotNull(), *order)))
    out = out.withColumn("_taken", F.collect_set("_n").over(w)).filter("_n IS NULL")
    # The k-th number from 2 on that is not taken.
    free = F.aggregate(F.array_sort("_taken"), c("_k"), lambda n, t: F.when(t <= n, n + 1).otherwise(n))
    return out.withColumn(ident, F.when(c("_k") == 1, c(ident)).otherwise(F.concat_ws("_", c(ident), free.cast("string")))).drop("_id", "_n", "_k", "_taken")


def forward_fill(df: DataFrame, column: str, part: list[str], order: list[str]) -> Column:
    """The last known value up to this row."""
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return F.last(column, ignorenulls=True).over(w)


def running_label(hit: Column, part: list[str], order: list[str], labels: tuple[str, str]) -> Column:
    """The label of rows after a section's repeats: none before the first
    repeat, labels[0] after one, labels[1] after more."""
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    n = F.sum(hit.cast("int")).over(w)
    return F.when(n <= 1, F.lit(None)).when(n == 2, labels[0]).otherwise(labels[1])


def conflicts(df: DataFrame, key: list[str], value: str, order: list[str]) -> DataFrame:
    """Rows after a key's first one: DUPLICATE_ENTRY if the value is the
    first row's, CONFLICTING_ENTRY if not."""
    w = Window.partitionBy(*key).orderBy(*order)
    out = df.withColumns({"_k": F.row_number().over(w), "_first": F.first(value).over(w)})
    rule = F.when(F.col(value).eqNullSafe(F.col("_first")), "DUPLICATE_ENTRY").otherwise("CONFLICTING_ENTRY")
    return out.filter("_k > 1").withColumn("rule", rule).drop("_k", "_first")


def share_of_total(df: DataFrame, total: list[str], part: str) -> DataFrame:
    """Rows of each part of each total, and their share."""
    per = df.groupBy(*total, part).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*total)
    return per.withColumns({"n_total": F.sum("n").over(w), "n_parts": F.count("*").over(w)}).withColumn("share", F.col("n") / F.col("n_total"))


def supplement(rows: DataFrame, more: DataFrame, key: list[str]) -> DataFrame:
    """rows, and those of more whose key no row has."""
    return rows.unionByName(more.join(rows.select(*key).distinct(), key, "left_anti"), allowMissingColumns=True)


#: Symbols that are never inherited, and donors by priority.
OWN_SYMBOLS = ("BW", "BODY WEIGHT", "BODY_WEIGHT", "T1/2", "HALF_LIFE", "HALF-LIFE")
DONORS = ("nonhuman primate", "monkey", "cynomolgus monkey", "rat", "mouse")


def inherit(df: DataFrame, scope: list[str], compound: str, symbol: str, species: str, order: str, target: str = "human", donors: tuple[str, ...] = DONORS, excluded: tuple[str, ...] = OWN_SYMBOLS) -> DataFrame:
    """df, and for each compound that the target species has rows of copies of
    the symbols that it lacks there, with `donor` set.

    One species gives to a compound: the first of donors with any row.  Its
    last row of a symbol counts.  Compounds are told without case, rows
    without one are one group; rows without species or symbol take no part.
    """
    c, own = F.col, [k for k in df.columns if k != "donor"]
    x = df.withColumns({"_c": F.upper(F.coalesce(F.nullif(compound, F.lit("")), F.lit("SYSTEM"))), "_s": F.lower(F.trim(F.coalesce(species, F.lit("")))), "_y": F.trim(F.coalesce(symbol, F.lit("")))})
    key = [*scope, "_c", "_y", "_s"]
    rank = F.create_map(*(v for i, d in enumerate(donors) for v in (F.lit(d), F.lit(i))))
    # What is lent is told on the different symbols and species alone; a copy
    # then stands beside its row, so rows are sorted once and not united.
    per = Window.partitionBy(*scope, "_c")
    told = x.filter("_s <> '' AND _y <> ''").select(*key).distinct().withColumn("_rank", F.try_element_at(rank, c("_s")))
    told = told.withColumns({"_has": F.bool_or(c("_s") == target).over(Window.partitionBy(*scope, "_c", "_y")), "_asks": F.bool_or(c("_s") == target).over(per), "_r": F.min("_rank").over(per)})
    lent = told.filter(c("_asks") & ~c("_has") & (c("_rank") == c("_r")) & ~F.upper("_y").isin(*excluded)).select(*key, F.lit(True).alias("_lent"))
    x = x.withColumn("_k", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(order)))).join(lent.hint("merge"), key, "left")
    row = lambda s, d: F.struct(s.alias("species"), d.cast("string").alias("donor"))
    itself, copy = row(c(species), F.lit(None)), row(F.lit(target), c("_s"))
    x = x.withColumn("_x", F.explode(F.when(c("_lent") & (c("_k") == 1), F.array(itself, copy)).otherwise(F.array(itself))))
    return x.select(*(c("_x.species").alias(k) if k == species else c(k) for k in own), c("_x.donor").alias("donor"))


def best_tier(candidates: DataFrame, key: list[str], tier: str, score: Column, order: list[str]) -> DataFrame:
    """The first candidate of the lowest tier with the highest score."""
    w = Window.partitionBy(*key).orderBy(tier, score.desc(), *order)
    return candidates.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")


def split_values(df: DataFrame, values: str, labels: str) -> DataFrame:
    """A row for each number of a comma-separated text, with the label of the
    same place if there is one.  Fewer than two numbers: the row as it is."""
    number = r"^\s*[+-]?\d+(?:\.\d+)?\s*$"
    items = F.split(F.col(values), ",")
    enough = F.size(F.filter(items, lambda x: x.rlike(number))) >= 2
    one = F.array(F.struct(F.lit(0).alias("pos"), F.lit(None).cast("string").alias("x")))
    many = F.filter(F.transform(items, lambda x, i: F.struct(i.alias("pos"), F.trim(x).alias("x"))), lambda p: p["x"].rlike(number))
    out = df.withColumn("_p", F.explode(F.when(F.coalesce(enough, F.lit(False)), many).otherwise(one)))
    return out.withColumns({"value": F.col("_p.x").try_cast("double"), "label": F.when(F.col("_p.x").isNotNull(), F.try_element_at(F.col(labels), F.col("_p.pos") + 1))}).drop("_p")


def patch(df: DataFrame, changes: DataFrame, key: str, allowed: list[str]) -> DataFrame:
    """df with the known values of changes in the allowed columns."""
    new = changes.select(key, *(F.col(c).alias("_" + c) for c in allowed))
    out = df.join(new, key, "left")
    return out.withColumns({c: F.coalesce("_" + c, c) for c in allowed}).drop(*("_" + c for c in allowed))


def class_views(df: DataFrame, column: str, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows of a class, and all others, those without a class included."""
    inside = F.col(column).eqNullSafe(F.lit(name))
    return df.filter(inside), df.filter(~inside)


def resolve(available: DataFrame, key: str, source: str, priority: list[str]) -> DataFrame:
    """Each key's first available source by priority."""
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col(source))
    return available.withColumn("_r", rank).filter("_r > 0").groupBy(key).agg(F.min_by(source, "_r").alias("resolved"), F.min("_r").cast("long").alias("priority"), F.count("*").alias("n_sources"))


def first_known(df: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """Of each key and column the first value, in order, that is not null."""
    return df.groupBy(key).agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns))


#: Fields that a critic may correct, by their paths, and the
#: flat columns that they are; other names that critics use for them.
CORRECTABLE = {
    "context.compound": "compound", "context.species": "species", "context.population": "population", "context.life_stage": "life_stage", "context.organ": "organ",
    "parameter_name_original": "name", "parameter_name_standardized": "name_standardized", "symbol_original": "symbol", "quantitative_data.value": "value", "quantitative_data.value_text": "value_text",
    "quantitative_data.unit_original": "unit", "quantitative_data.unit_standardized": "unit_standardized", "quantitative_data.uncertainty.lower": "low", "quantitative_data.uncertainty.upper": "high",
    "provenance.source_table": "source_table", "provenance.row_id": "row_id", "provenance.column_id": "column_id", "provenance.cell_id": "cell_id", "provenance.source_quote": "quote", "provenance.status": "status",
}
OTHER_NAMES = {
    "unit": "quantitative_data.unit_original", "unit_original": "quantitative_data.unit_original", "unit_standardized": "quantitative_data.unit_standardized", "value": "quantitative_data.value",
    "value_text": "quantitative_data.value_text", "compound": "context.compound", "species": "context.species", "organ": "context.organ", "parameter_name": "parameter_name_original", "symbol": "symbol_original",
}


def corrected(df: DataFrame, verdicts: DataFrame, key: list[str]) -> DataFrame:
    """df after a critic: verdicts (key, verdict, fields map<string,string>).

    reject drops a row; fix sets the fields that may be corrected, under their
    paths or other names, a null among them included; `needs_review` and
    `llm_corrected` mark what was.  A fix with a number that is none leaves
    its row as it is.
    """
    from ..functions.numbers import gated_double

    kinds = {c: df.schema[c].dataType.typeName() for c in CORRECTABLE.values() if c in df.columns}
    v = verdicts.select(*key, "verdict", F.coalesce("fields", F.create_map().cast("map<string,string>")).alias("_f"))
    out = df.join(v, key, "left").filter(F.coalesce("verdict", F.lit("ok")) != "reject")
    names = {c: [p, *(o for o, q in OTHER_NAMES.items() if q == p)] for p, c in CORRECTABLE.items() if c in kinds}
    told = {c: F.arrays_overlap(F.map_keys("_f"), F.array(*map(F.lit, ns))) for c, ns in names.items()}
    said = {c: F.coalesce(*(F.try_element_at(F.col("_f"), F.lit(n)) for n in ns)) for c, ns in names.items()}
    broken = F.lit(False)
    for c, kind in kinds.items():
        if kind == "double":
            broken = broken | (told[c] & said[c].isNotNull() & gated_double(said[c]).isNull())
    out = out.withColumn("_fix", (F.coalesce("verdict", F.lit("")) == "fix") & (F.size("_f") > 0))
    apply = F.col("_fix") & ~F.coalesce(broken, F.lit(False))
    new = {c: F.when(apply & told[c], gated_double(said[c]) if kinds[c] == "double" else said[c]).otherwise(F.col(c)) for c in names}
    return out.withColumns(new | {"llm_corrected": F.col("_fix"), "needs_review": F.col("_fix")}).drop("verdict", "_f", "_fix")


def record_identity() -> Column:
    """The id of a flat parameter: its place in the source, what it is, its
    context, its value and the begin of its quote."""
    low = lambda c: F.coalesce(c if isinstance(c, Column) else F.col(c).cast("string"), F.lit(""))
    path = lambda ident, p: F.coalesce(F.nullif(ident, F.lit("")), F.array_join(F.coalesce(p, F.array().cast("array<string>")), "_"))
    forms = F.array_join(F.coalesce("formulation", F.array().cast("array<string>")), ",")
    return stable_id(
        F.col("source_table"), path("row_id", "row_path"), path("column_id", "column_path"), F.col("cell_id"), F.col("name"), F.col("symbol"), F.col("compound"), F.col("species"), F.col("organ"), F.col("life_stage"),
        F.col("population"), forms, F.col("value"), F.col("start_value"), F.col("end_value"), F.col("unit"), F.substring(low("quote"), 1, 50),
    )
