"""A benchmark's comparison of extracted with curated parameters.

Both sides are flat rows (doc, ord, compound, species, life_stage, symbol,
name, value, ci_low, ci_high, unit, formulation, ...).  A pair must agree in
value, so pairs come from an equi-join by document and band of values and no
documents are crossed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import benchmark_close, names_agree, units_agree
from ..sources.work import written
from .match import greedy

#: Names of one compound, and words of species by group.
COMPOUND_SYNONYMS = (("RLZ", "RILUZOLE"), ("RLE", "RILUZOLE"), ("RILUTOR", "RILUZOLE"), ("RILUTORASD", "RILUZOLE"))
SPECIES_WORDS = (
    (("primate", "monkey"), "nonhuman primate"), (("mother", "fetus", "infant", "human", "adult", "gestation", "lactation"), "human"), (("rat",), "rat"), (("mouse", "mice"), "mouse"),
)


def compound_form(c: Column) -> Column:
    """Upper case letters and digits; a synonym's first name."""
    x = F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), "[^A-Z0-9]", "")
    names = F.create_map(*(F.lit(v) for pair in COMPOUND_SYNONYMS for v in pair))
    return F.coalesce(F.try_element_at(names, x), x)


def species_form(c: Column) -> Column:
    """The species group whose word a text has, by order; else the text."""
    x = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    out = x
    for words, name in reversed(SPECIES_WORDS):
        out = F.when(F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(x, w)), F.lit(name)).otherwise(out)
    return out


def comparable(df: DataFrame) -> DataFrame:
    """The columns that are compared, in one form; what df has besides (doc,
    ord) stays.

    df: compound, species, subject_species, life_stage, symbol_standardized,
    symbol, name_standardized, name, value, ci_low, ci_high, low, high,
    unit_standardized, unit, formulation, directness, parameter_id,
    derivation, source_table.
    """
    some = lambda *cs: F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in cs), F.lit(""))
    low = lambda c: F.lower(F.trim(c))
    inherited = F.coalesce(F.col("directness") == "inherited_cross_species", F.lit(False)) | F.contains(F.lower(some("parameter_id")), F.lit("inherited")) | F.contains(F.lower(some("derivation")), F.lit("held constant"))
    return df.withColumns({
        "compound": compound_form(F.col("compound")), "species": species_form(some("species", "subject_species", "life_stage")),
        "symbol": F.regexp_replace(F.lower(some("symbol_standardized", "symbol", "name_standardized")), "[^a-z0-9]", ""), "name": low(some("name", "name_standardized")),
        "ci_low": F.coalesce("ci_low", "low"), "ci_high": F.coalesce("ci_high", "high"),
        "unit": F.regexp_replace(low(some("unit_standardized", "unit")), r"\s+", " "), "formulation": low(some("formulation")), "inherited": inherited, "source_table": F.trim(some("source_table")),
    }).drop("subject_species", "life_stage", "symbol_standardized", "name_standardized", "low", "high", "unit_standardized", "directness", "derivation")


def _bands(v: Column, spread: int) -> Column:
    """Keys of a value: steps of 5e-5 up to about 1e-3, where the absolute
    tolerance counts, then powers of 1.05; `spread` steps to either side, in
    both systems where they meet.  Both steps are wider than the tolerance, so
    a spread of 1 meets all.  A key's remainder by 4 tells its kind: steps,
    positive and negative powers, no value."""
    around = lambda x, kind: F.array(*(4 * (x + i) + kind for i in range(-spread, spread + 1)))
    near, far = F.floor(v / 5e-5), F.floor(F.ln(F.abs(v)) / F.ln(F.lit(1.05)))
    meets = 1e-4 if spread else 0.0
    small, large = F.abs(v) < 1e-3 + meets, F.abs(v) >= 1e-3 - meets
    none = F.array().cast("array<bigint>")
    return F.when(v.isNull(), F.array(F.lit(3).cast("bigint"))).otherwise(F.concat(F.when(small, around(near, F.lit(0))).otherwise(none), F.when(large, around(far, F.when(v < 0, 2).otherwise(1))).otherwise(none)))


def near_pairs(prediction: DataFrame, gold: DataFrame, doc: str) -> DataFrame:
    """(doc, pred, ref and both sides' columns as p_ and g_) of all pairs whose
    values agree within 2 % or that have none."""
    side = lambda df, pre: df.select(F.col(doc), *(F.col(c).alias(pre + c) for c in df.columns if c != doc))
    p = side(prediction, "p_").withColumn("_b", F.explode(_bands(F.col("p_value"), 1)))
    g = side(gold, "g_").withColumn("_b", F.explode(_bands(F.col("g_value"), 0)))
    both = p.join(g, [doc, "_b"]).filter(benchmark_close(F.col("p_value"), F.col("g_value"))).drop("_b")
    return both.withColumns({"pred": F.col("p_ord"), "ref": F.col("g_ord")})


def _agrees(c: str, loose: bool = True) -> Column:
    """Equal, or the gold side, or with loose either side, without a value."""
    p, g = F.col("p_" + c), F.col("g_" + c)
    return (g == "") | (p == g) | ((p == "") if loose else F.lit(False))


def _named() -> Column:
    return names_agree(F.col("p_name"), F.col("p_symbol"), F.col("g_name"), F.col("g_symbol"))


def strict(pairs: DataFrame) -> DataFrame:
    return pairs.filter(_named() & _agrees("species") & _agrees("compound"))


def partial(pairs: DataFrame) -> DataFrame:
    return pairs.filter(_named())


def for_listing(pairs: DataFrame) -> DataFrame:
    """The narrower pairs of a listing of differences: equal symbols or
    contained names, and the gold side's species and compound."""
    p, g = F.col("p_name"), F.col("g_name")
    symbol = (F.col("p_symbol") != "") & (F.col("p_symbol") == F.col("g_symbol"))
    name = (p != "") & (g != "") & (F.contains(p, g) | F.contains(g, p))
    return pairs.filter((symbol | name) & _agrees("species", False) & _agrees("compound", False))


def scores(prediction: DataFrame, gold: DataFrame, doc: str) -> DataFrame:
    """A row for each document that either side has: counts, strict and
    partial precision, recall and F1, and accuracies, in percent."""
    pairs = written(partial(near_pairs(prediction, gold, doc)), "near-pairs")  # three branches read them
    hit = greedy(strict(pairs), doc).join(pairs, [doc, "pred", "ref"])
    same = lambda c: F.count_if(F.col("p_" + c) == F.col("g_" + c))
    ci = F.col("g_ci_low").isNotNull() & benchmark_close(F.col("p_ci_low"), F.col("g_ci_low")) & benchmark_close(F.col("p_ci_high"), F.col("g_ci_high"))
    won = hit.groupBy(doc).agg(F.count("*").alias("strict_tp"), F.count_if(units_agree(F.col("p_unit"), F.col("g_unit"))).alias("_unit"), same("species").alias("_species"), same("compound").alias("_compound"), F.count_if(ci).alias("_ci"))
    part = greedy(pairs, doc).groupBy(doc).agg(F.count("*").alias("partial_tp"))
    n_gold = gold.groupBy(doc).agg(F.count("*").alias("ground_truth_count"), F.count("ci_low").alias("_cis"))
    n_pred = prediction.groupBy(doc).agg(F.count("*").alias("extracted_count"))
    x = n_gold.join(n_pred, doc, "full").join(won, doc, "left").join(part, doc, "left").na.fill(0)
    c = F.col
    percent = lambda a, b, empty=0.0: F.round(F.coalesce(100 * F.try_divide(a, b), F.lit(empty)), 2)
    f1 = lambda tp: percent(2 * tp, c("ground_truth_count") + c("extracted_count"))
    out = {"fp": c("extracted_count") - c("strict_tp"), "fn": c("ground_truth_count") - c("strict_tp")}
    for k in ("strict", "partial"):
        tp = c(k + "_tp")
        out |= {k + "_precision": percent(tp, c("extracted_count")), k + "_recall": percent(tp, c("ground_truth_count")), k + "_f1": f1(tp)}
    out["value_accuracy"] = percent(c("strict_tp"), c("ground_truth_count"))
    out |= {k + "_accuracy": percent(c("_" + k), c("ground_truth_count")) for k in ("unit", "species", "compound")}
    return x.withColumns(out | {"ci_accuracy": percent(c("_ci"), c("_cis"), 100.0)}).drop("_unit", "_species", "_compound", "_ci", "_cis")


def differences(prediction: DataFrame, gold: DataFrame, doc: str) -> tuple[DataFrame, DataFrame]:
    """Gold rows that no prediction has, and predictions without a gold row."""
    taken = greedy(for_listing(near_pairs(prediction, gold, doc)), doc)
    rest = lambda df, c: df.join(taken.select(doc, F.col(c).alias("ord")), [doc, "ord"], "left_anti")
    return rest(gold, "ref"), rest(prediction, "pred")
