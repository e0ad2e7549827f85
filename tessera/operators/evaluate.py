"""Evaluation of predicted against reference parameters: matches, fields,
metrics, what is left over, and collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import f1, number_state, ratio, text_state
from ..functions.text import normal_identifier, normal_list, normal_text, normal_unit
from ..sources.work import written
from . import match

#: Contexts whose known values must not differ in a match.
CONTEXT = ("compound", "species", "life_stage", "population", "organ", "formulation")


def _first(*columns: str) -> Column:
    return F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in columns))


def prepared(df: DataFrame) -> DataFrame:
    """df (ord, name, name_standardized, symbol, symbol_standardized, the
    contexts, source_table) with what matches are found by."""
    idents = lambda *cs: F.array_distinct(F.filter(F.array(*(normal_identifier(F.col(c)) for c in cs)), lambda x: x != ""))
    forms = {c: normal_list(F.col(c)) if c == "formulation" else normal_identifier(F.col(c)) for c in CONTEXT}
    return df.withColumns({"_names": idents("name_standardized", "name"), "_symbols": idents("symbol_standardized", "symbol"), "_table": normal_identifier(F.col("source_table")), **{"_" + c: f for c, f in forms.items()}})


def pairs(reference: DataFrame, prediction: DataFrame, doc: str) -> DataFrame:
    """(doc, ref, pred, score): 8 points for a name, 7 for a symbol, 2 for
    each equal context and for the table."""
    return match.candidates(prepared(reference), prepared(prediction), doc, [("_names", 8), ("_symbols", 7)], ["_" + c for c in CONTEXT], ["_table"])


def field_states() -> dict[str, Column]:
    """State of each field of a pair's columns r_... and p_...: match,
    mismatch or, where both are unknown, not_compared."""
    def some(*columns: str, form=normal_text) -> Column:
        return text_state(*(_first(*(s + c for c in columns)) for s in ("r_", "p_")), form)

    def plain(c: str, form=normal_text) -> Column:
        return text_state(F.col("r_" + c), F.col("p_" + c), form)

    fields = {
        "parameter_class": plain("class"), "parameter_subclass": plain("subclass"), "parameter_name": some("name_standardized", "name", form=normal_identifier),
        "symbol": some("symbol_standardized", "symbol", form=normal_identifier), "value": number_state(F.col("r_value"), F.col("p_value")), "unit": some("unit_standardized", "unit", form=normal_unit),
        "provenance_status": plain("status"), "source_table": plain("source_table", normal_identifier), "source_page": plain("source_page", lambda c: F.coalesce(c.cast("string"), F.lit(""))),
    }
    return fields | {f"context.{c}": plain(c, normal_list if c == "formulation" else normal_identifier) for c in CONTEXT}


def matched(reference: DataFrame, prediction: DataFrame, found: DataFrame, doc: str) -> DataFrame:
    """found (doc, ref, pred) with both sides' columns as r_... and p_...."""
    side = lambda df, pre, on: df.select(F.col(doc), F.col("ord").alias(on), *(F.col(c).alias(pre + c) for c in df.columns if c not in (doc, "ord")))
    return found.join(side(reference, "r_", "ref"), [doc, "ref"]).join(side(prediction, "p_", "pred"), [doc, "pred"])


def metrics(reference: DataFrame, prediction: DataFrame, found: DataFrame, doc: str) -> DataFrame:
    """By document: counts, precision, recall and F1 of the matches."""
    n = lambda df, name: df.groupBy(doc).agg(F.count("*").alias(name))
    x = n(reference, "reference_count").join(n(prediction, "prediction_count"), doc, "full").join(n(found, "matched_count"), doc, "left").na.fill(0)
    x = x.withColumns({"precision": ratio(F.col("matched_count"), F.col("prediction_count")), "recall": ratio(F.col("matched_count"), F.col("reference_count"))})
    return x.withColumn("f1", f1(F.col("precision"), F.col("recall")))


def left_over(reference: DataFrame, prediction: DataFrame, all_pairs: DataFrame, doc: str) -> tuple[DataFrame, DataFrame]:
    """References and predictions without a match.  A prediction whose best
    references are several is ambiguous and counts as used."""
    row = lambda is_ref, c, counts: F.when(counts, F.struct(F.lit(is_ref).alias("is_ref"), F.col(c).alias("ord")))
    rows = F.array_compact(F.array(row(True, "ref", F.col("won")), row(False, "pred", F.col("won") | (F.col("ties") > 1))))
    # Both sides read these, so pairs are made once.
    used = written(match.settled(all_pairs, doc).select(doc, F.explode(rows).alias("x")).select(doc, "x.*").distinct(), "used")
    rest = lambda df, is_ref: df.join(used.filter(F.col("is_ref") == is_ref).drop("is_ref"), [doc, "ord"], "left_anti")
    return rest(reference, True), rest(prediction, False)


def json_identity(c: Column) -> Column:
    """A JSON text with its keys sorted and without blanks: equal for equal
    values; a text that is no JSON is its own identity."""
    return F.coalesce(F.to_json(F.try_parse_json(c)), c)


def collections(reference: DataFrame, prediction: DataFrame, doc: str, name: str, item: str) -> DataFrame:
    """By document and collection: items on both sides and how many agree,
    repeats counted."""
    key = [doc, name, "_i"]
    count = lambda df, n: df.withColumn("_i", json_identity(F.col(item))).groupBy(*key).agg(F.count("*").alias(n))
    both = count(reference, "_r").join(count(prediction, "_p"), key, "full").na.fill(0, ["_r", "_p"])
    return both.groupBy(doc, name).agg(F.sum("_r").alias("reference_count"), F.sum("_p").alias("prediction_count"), F.sum(F.least("_r", "_p")).alias("matched"))
