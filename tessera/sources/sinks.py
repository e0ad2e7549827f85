"""Sinks: documents, reports, quoted CSV, Markdown, published partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_documents(docs: DataFrame, path: str, key: str) -> None:
    """JSON lines, many documents a file.  Documents that are one row each
    are written by the tasks that made them; only where a key has several rows
    are they brought together."""
    several = docs.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
    out = docs if several.isEmpty() else docs.repartition(key)
    out.write.mode("overwrite").json(path)


def write_quoted_csv(df: DataFrame, path: str) -> None:
    """All fields quoted, quotes doubled, a header."""
    df.write.mode("overwrite").option("header", "true").option("quoteAll", "true").option("escape", '"').csv(path)


def read_quoted_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What write_quoted_csv() has written: line breaks and quotes within
    fields; an empty quoted field is a null, as it is for the writer."""
    return spark.read.schema(schema).option("header", "true").option("multiLine", "true").option("escape", '"').option("nullValue", "").csv(path)


def _digests(df: DataFrame, by: str) -> DataFrame:
    """By partition: rows and a sum of hashes of whole rows, in any order."""
    columns = sorted(c for c in df.columns if c != by)
    return df.groupBy(F.col(by).cast("string").alias(by)).agg(F.count("*").alias("rows"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("digest"))


def publish(df: DataFrame, path: str, by: str) -> None:
    """Replace the partitions of `by` that df has, and no others, and note
    what they hold in a manifest beside them; partition values are texts."""
    out = df.withColumn(by, F.col(by).cast("string"))
    write = lambda x, name: x.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(f"{path}/{name}")
    write(out.repartition(by, F.pmod(F.xxhash64(*out.columns), F.lit(8))), "data")  # up to eight files each
    write(_digests(out, by), "manifest")


def published(spark: SparkSession, path: str, by: str) -> DataFrame:
    """The rows of all partitions."""
    return spark.read.option("recursiveFileLookup", "false").schema(_typed(spark, f"{path}/data", by)).parquet(f"{path}/data")


def _typed(spark: SparkSession, path: str, by: str):
    """The files' schema with the partition as the text that it was."""
    from pyspark.sql.types import StringType, StructField, StructType

    return StructType([*(f for f in spark.read.parquet(path).schema if f.name != by), StructField(by, StringType())])


def verified(spark: SparkSession, path: str, by: str) -> DataFrame:
    """(partition, rows, good): whether what is read is what was noted."""
    noted = spark.read.schema(_typed(spark, f"{path}/manifest", by)).parquet(f"{path}/manifest")
    read = _digests(published(spark, path, by), by).withColumnsRenamed({"rows": "_rows", "digest": "_digest"})
    good = F.col("rows").eqNullSafe(F.col("_rows")) & F.col("digest").eqNullSafe(F.col("_digest"))
    return noted.join(read, by, "full").select(by, F.coalesce("_rows", F.lit(0)).alias("rows"), good.alias("good"))


def markdown_table(df: DataFrame, columns: list[str], order: list[str | Column]) -> DataFrame:
    """One row `text`: a table of few rows, such as a benchmark's methods."""
    cells = F.concat(F.lit("| "), F.concat_ws(" | ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)), F.lit(" |"))
    rows = df.select(F.struct(*order, cells.alias("line")).alias("r")).agg(F.array_sort(F.collect_list("r")).alias("rs"))
    head = ["| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns)]
    return rows.select(F.concat_ws("\n", *map(F.lit, head), F.array_join(F.transform("rs", lambda r: r["line"]), "\n")).alias("text"))


def write_report(report: DataFrame, path: str) -> None:
    """A report, one row, as one JSON file; its fields in their order, nulls
    included."""
    report.limit(1).coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_curve(curve: DataFrame, path: str, key: str) -> None:
    """Simulated curves as CSV with a header, a folder a model."""
    curve.write.mode("overwrite").option("header", "true").partitionBy(key).csv(path)


def parameter_table(parameters: DataFrame) -> DataFrame:
    """The columns that a reader of parameters looks at."""
    some = lambda *cs: F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in cs))
    return parameters.select(
        some("symbol", "symbol_standardized").alias("Symbol"), some("name_standardized", "name").alias("Name"), F.col("class").alias("Class"), F.col("value").alias("Value"), some("unit", "unit_original").alias("Unit"),
        some("species", "subject_species").alias("Species"), F.col("compound").alias("Compound"), F.col("life_stage").alias("Life Stage"), some("source_location", "source_table").alias("Source"), F.col("status").alias("Status"),
    )
