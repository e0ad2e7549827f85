"""From extracted to final parameters: the steps in their order.

Flat parameters have doc, ord and the columns that rules.parameter_rules()
names, with unit_standardized, low, high, reference and status.  The order of
the steps counts: repeats are dropped before ranges are read, and the checks
come before the classes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import units
from ..functions.classify import COMPOUND_WORDS, SYSTEM_WORDS, parameter_class
from ..functions.text import stable_id
from . import evidence, repair, rules

#: What is no parameter of a model but a measurement of a
#: product, by name and unit.
FORMULATION_NAMES, FORMULATION_UNIT = ("contact angle", "particle size", "dissolution"), "°"


def is_formulation(name: Column, unit: Column) -> Column:
    return F.exists(F.array(*map(F.lit, FORMULATION_NAMES)), lambda w: F.contains(F.lower(F.coalesce(name, F.lit(""))), w)) | F.coalesce(unit == FORMULATION_UNIT, F.lit(False))


def identity() -> list[Column]:
    """The nine parts that make two records one, lower case."""
    low = lambda *cs: F.lower(F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in cs), F.lit("")))
    forms = F.lower(F.array_join(F.coalesce("formulation", F.array().cast("array<string>")), ","))
    number = lambda *cs: F.coalesce(F.coalesce(*(F.col(c) for c in cs)).cast("string"), F.lit(""))
    return [low("symbol"), low("name"), low("compound"), low("species"), low("life_stage"), forms, low("organ"), number("value", "start_value"), number("end_value")]


def distinct_records(df: DataFrame, doc: str) -> DataFrame:
    """The first record of each identity.  A column of hashes, so that the
    sort moves 16 bytes and not nine texts; equal hashes are told apart by the
    texts behind them."""
    x = df.withColumns({"_h": F.xxhash64(*identity()), "_i": F.concat_ws("\x00", *identity())})
    w = Window.partitionBy(doc, "_h", "_i").orderBy("ord")
    return x.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k", "_h", "_i")


def missing(found: DataFrame, have: DataFrame, doc: str, words: tuple[str, ...]) -> DataFrame:
    """found (doc, compound) of which have holds no row with the compound and
    one of the words in its name."""
    named = F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(F.lower("name"), w))
    key = have.filter(named & (F.coalesce("compound", F.lit("")) != "")).select(doc, F.lower("compound").alias("_c")).distinct()
    return found.withColumn("_c", F.lower("compound")).join(key, [doc, "_c"], "left_anti").drop("_c")


def from_tables(tables: DataFrame, doc: str, compounds: tuple[str, ...] = (), covered: DataFrame | None = None) -> DataFrame:
    """Records of the cells of input tables: (doc, table_id, row_id, column_id,
    name, symbol, compound, unit, value, value_text, low, high, start_value,
    end_value).

    Tables of outcomes give none.  Columns labelled as variable, parameter,
    name, symbol or description (else the first) describe a row: its longest
    text is the name, the shortest the symbol.  Other columns but those of
    sources, references, methods and notes hold values.  A row with a
    description and no value is a group's header; its unit goes on to the rows
    below until the next header with one.  covered (doc, table_id, row_id,
    column_id): cells that are records already.
    """
    from ..functions.classify import NON_INPUT_TITLE, table_role
    from ..functions.numbers import estimate, span, trailing_unit

    c = F.col
    labels = F.lower(F.array_join(F.flatten(F.transform("columns", lambda k: k["path"])), " "))
    title = F.coalesce(F.nullif("title", F.lit("")), "table_id")
    x = tables.filter((c("status") == "complete") & ~title.rlike(NON_INPUT_TITLE) & (table_role(title, labels) == "model_parameters"))
    path = lambda k: F.lower(F.array_join(k["path"], " "))
    named = F.filter("columns", lambda k: path(k).rlike("variable|parameter|name|symbol|description"))
    x = x.withColumn("_describes", F.transform(F.when(F.size(named) > 0, named).otherwise(F.slice("columns", 1, 1)), lambda k: k["column_id"]))
    x = x.select(doc, "table_id", "table_ord", "columns", "_describes", "subjects", F.posexplode("cells").alias("pos", "x")).select("*", *(F.col(f"x.{f}").alias(f) for f in ("row_id", "column_id", "text", "numeric_value"))).drop("x")
    of_column = F.filter("columns", lambda k: k["column_id"] == c("column_id"))
    x = x.withColumns({"_path": F.lower(F.array_join(F.flatten(F.transform(of_column, lambda k: k["path"])), " ")), "_is_label": F.array_contains("_describes", c("column_id"))})
    x = x.withColumn("_is_value", ~c("_is_label") & (F.size(of_column) > 0) & ~c("_path").rlike("source|reference|ref|method|notes")).drop("columns", "_describes")
    text = F.trim(F.coalesce("text", F.lit("")))
    per = x.groupBy(doc, "table_ord", "row_id").agg(
        F.min("pos").alias("_row"), F.max_by(F.when(c("_is_label"), text), F.when(c("_is_label"), F.struct(F.length(text).alias("n"), (-c("pos")).alias("p")))).alias("name"),
        F.min_by(F.when(c("_is_label"), text), F.when(c("_is_label"), F.struct(F.length(text).alias("n"), c("pos").alias("p")))).alias("symbol"),
        F.min_by(F.when(c("_is_label"), text), F.when(c("_is_label"), c("pos"))).alias("_first"), F.bool_or(c("_is_value") & c("numeric_value").isNotNull()).alias("_has"),
    )
    header = c("_first").isNotNull() & ~c("_has")
    w = Window.partitionBy(doc, "table_ord").orderBy("_row")
    per = per.withColumn("_unit", F.last(F.when(header, units.group_unit(c("_first"))), True).over(w)).filter(~header & (F.coalesce("name", F.lit("")) != "")).drop("_row", "_first", "_has")
    out = x.filter("_is_value").join(per, [doc, "table_ord", "row_id"]).withColumns({"_s": span(text), "_e": estimate(text)})
    value = F.coalesce("numeric_value", "_s.low")
    known = F.filter(F.concat(F.coalesce("subjects", F.array().cast("array<string>")), F.array(*map(F.lit, compounds)).cast("array<string>")), lambda k: F.array_contains(F.split(F.regexp_replace(c("_path"), "[^a-z0-9-]+", " "), " "), F.lower(k)))
    out = out.filter(value.isNotNull()).select(
        doc, "table_id", "row_id", "column_id", "name", F.when(c("symbol") != c("name"), c("symbol")).alias("symbol"),
        F.coalesce(F.get(known, F.lit(0)), F.when(F.size("subjects") == 1, F.get("subjects", F.lit(0)))).alias("compound"), F.coalesce(trailing_unit(c("name")), c("_unit")).alias("unit"),
        F.when(c("_s.low").isNull(), value).alias("value"), text.alias("value_text"), F.coalesce("_e.lower", "_s.low").alias("low"), F.coalesce("_e.upper", "_s.high").alias("high"), c("_s.low").alias("start_value"), c("_s.high").alias("end_value"),
    )
    return out if covered is None else out.join(covered.select(doc, "table_id", "row_id", "column_id").distinct(), [doc, "table_id", "row_id", "column_id"], "left_anti")


def finalize(parameters: DataFrame, tables: DataFrame, doc: str) -> tuple[DataFrame, DataFrame]:
    """Parameters and tables as they are written: unique ids, for those
    without one an id of their identity, and tables without their cells."""
    known = F.when(F.coalesce("parameter_id", F.lit("")) != "", F.col("parameter_id")).otherwise(stable_id(*identity()))
    out = repair.unique_ids(parameters.withColumn("parameter_id", known), "parameter_id", ["ord"], [doc])
    return out, tables.withColumn("cells", F.array().cast(tables.schema["cells"].dataType))


def post_process(parameters: DataFrame, tables: DataFrame, doc: str = "doc") -> DataFrame:
    """These steps over flat parameters (with source_text), in order: rows
    without a value and product measurements go; prefixes, whitelisted units,
    inheritance, repeats, units and ranges, provenance, the four checks,
    classes, ids.  Given ids that begin with param_ stay.  Records of tables,
    lists of values, doses and views are steps of their own (from_tables(),
    split_values(), doses and views), which it does not call."""
    from .extract import guard_prefix

    x = parameters.filter((F.col("value_text").isNotNull() | F.col("value").isNotNull()) & ~is_formulation(F.col("name"), F.col("unit")))
    x = x.withColumn("unit_standardized", guard_prefix(F.col("unit"), F.col("unit_standardized")))
    x = repair.inherit(units.whitelisted(x), [doc], "compound", "symbol", "species", "ord")
    x = x.withColumns({"status": F.when(F.col("donor").isNotNull(), "assumed_default").otherwise(F.col("status")), "directness": F.when(F.col("donor").isNotNull(), "inherited_cross_species").otherwise(F.col("directness"))})
    x = units.normalised(distinct_records(x, doc))
    x = evidence.bind(evidence.cite(x, tables, doc, citing=parameters)).drop("evidence")
    checked = rules.four_checks(x.withColumns({"_low": F.col("low"), "_high": F.col("high"), "low": F.col("start_value"), "high": F.col("end_value"), "location": F.col("source_table")}))
    x = checked.withColumns({"low": F.col("_low"), "high": F.col("_high")}).drop("_low", "_high", "location")
    x = x.withColumn("class", F.when(F.coalesce("class", F.lit("")) != "", F.col("class")).otherwise(parameter_class(F.col("subclass"), F.concat_ws(" ", "name", "symbol"), SYSTEM_WORDS, COMPOUND_WORDS)))
    given = F.col("parameter_id") if "parameter_id" in x.columns else F.lit(None).cast("string")
    return finalize(x.withColumn("parameter_id", F.when(given.startswith("param_"), given).otherwise(stable_id(*identity()))), tables, doc)[0]
