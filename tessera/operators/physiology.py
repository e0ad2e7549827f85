"""Reference physiology by species, as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Symbols and what they are, and their values by species:
#: volumes as fractions of body weight, flows as fractions of cardiac output.
SYMBOLS = (
    ("BW", "Body weight (kg)"), ("QCC", "Cardiac output coefficient — allometric (L/h/kg^0.74)"), ("VLC", "Liver volume fraction (fraction of BW)"),
    ("VKC", "Kidney volume fraction (fraction of BW)"), ("VFC", "Fat volume fraction (fraction of BW)"), ("VMC", "Muscle volume fraction (fraction of BW)"),
    ("VBC", "Blood volume fraction (fraction of BW)"), ("VRC", "Richly perfused tissue volume fraction (fraction of BW)"), ("VSC", "Skin volume fraction (fraction of BW)"),
    ("VLuC", "Lung volume fraction (fraction of BW)"), ("VGC", "Gut volume fraction (fraction of BW)"), ("QLC", "Hepatic blood flow fraction (fraction of cardiac output)"),
    ("QKC", "Renal blood flow fraction (fraction of cardiac output)"), ("QFC", "Fat blood flow fraction (fraction of cardiac output)"), ("QMC", "Muscle blood flow fraction (fraction of cardiac output)"),
    ("QRC", "Richly perfused blood flow fraction (fraction of cardiac output)"), ("QSC", "Skin blood flow fraction (fraction of cardiac output)"), ("QGC", "Gut blood flow fraction (fraction of cardiac output)"),
    ("GFR", "Glomerular filtration rate (L/h)"), ("VfilC", "Filtrate compartment volume fraction (fraction of BW)"), ("Fu_plasma", "Fraction unbound in plasma (compound-specific placeholder)"),
)
VALUES = {
    "human": (70.0, 16.5, 0.026, 0.004, 0.214, 0.400, 0.079, 0.048, 0.001, 0.010, 0.014, 0.227, 0.175, 0.052, 0.175, 0.186, 0.058, 0.181, 7.5, 0.0003, 0.01),
    "rat": (0.25, 15.0, 0.034, 0.007, 0.070, 0.400, 0.074, 0.048, 0.019, 0.005, 0.021, 0.183, 0.141, 0.071, 0.278, 0.183, 0.058, 0.155, 1.0, 0.0003, 0.01),
    "mouse": (0.025, 14.1, 0.055, 0.017, 0.040, 0.380, 0.049, 0.048, 0.017, 0.007, 0.042, 0.161, 0.091, 0.050, 0.352, 0.214, 0.058, 0.143, 0.012, 0.0003, 0.01),
    "nonhuman primate": (5.0, 19.8, 0.022, 0.005, 0.070, 0.380, 0.057, 0.048, 0.020, 0.010, 0.021, 0.200, 0.150, 0.060, 0.210, 0.200, 0.058, 0.150, 0.15, 0.0004, 0.01),
}
ALIASES = (
    ("homo sapiens", "human"), ("h. sapiens", "human"), ("human adult", "human"), ("adult human", "human"), ("rattus norvegicus", "rat"),
    ("sprague-dawley", "rat"), ("wistar", "rat"), ("mus musculus", "mouse"), ("rhesus macaque", "nonhuman primate"),
    ("macaca mulatta", "nonhuman primate"), ("cynomolgus", "nonhuman primate"), ("nhp", "nonhuman primate"),
)


def table(spark: SparkSession) -> DataFrame:
    """(species, symbol, value, description): a row each."""
    return spark.createDataFrame([(s, n, v, d) for s, vs in VALUES.items() for (n, d), v in zip(SYMBOLS, vs, strict=True)], "species string, symbol string, value double, description string")


def species(spark: SparkSession) -> DataFrame:
    return table(spark).select("species").distinct().orderBy("species")


def canonical(c: Column) -> Column:
    """A species' name in the table: trimmed, lower case, no other name."""
    names, x = F.create_map(*(F.lit(v) for pair in ALIASES for v in pair)), F.lower(F.trim(c))
    return F.coalesce(F.try_element_at(names, x), x)


def lookup(asked: DataFrame, name: str, weight: str | None = None) -> DataFrame:
    """asked with a row for each symbol of its species (none for an unknown
    one); a known weight replaces BW."""
    out = asked.withColumn("species", canonical(F.col(name))).join(F.broadcast(table(asked.sparkSession)), "species")
    return out if weight is None else out.withColumn("value", F.when((F.col("symbol") == "BW") & F.col(weight).isNotNull(), F.col(weight)).otherwise(F.col("value")))


def describe(c: Column) -> Column:
    names = F.create_map(*(F.lit(v) for pair in SYMBOLS for v in pair))
    return F.coalesce(F.try_element_at(names, c), F.concat(F.lit("Physiological parameter: "), c))
