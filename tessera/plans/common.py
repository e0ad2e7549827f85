"""Tables of the driver, and lines in their order within an order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity", "l_discount", "l_tax")


#: Lines for one task, where what is narrow on its way needs much in memory.
LINES_A_TASK = 500_000


#: Rows for one task, where a short row costs much: the parts of a file follow
#: from its bytes, and a small file of many rows would be one task.
ROWS_A_TASK = 20_000


def spread(df: DataFrame) -> DataFrame:
    """df's rows, dealt evenly in parts of ROWS_A_TASK."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_A_TASK)))


def lines(spark: SparkSession, sf_dir: str, *columns: str, dealt: bool = False) -> DataFrame:
    """lineitem with `ord`, the place of a line in its order; dealt by order
    in parts of LINES_A_TASK, if asked for."""
    w = Window.partitionBy("l_orderkey").orderBy(*ORDER)
    out = read(spark, sf_dir, "lineitem")
    if dealt:
        out = out.repartition(max(spark.sparkContext.defaultParallelism, -(-out.count() // LINES_A_TASK)), "l_orderkey")
    out = out.withColumn("ord", F.row_number().over(w))
    return out.select("l_orderkey", "ord", *columns) if columns else out


#: The same in SQL, as a common table expression.
LINES = f"L AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(ORDER)}) AS ord FROM lineitem)"
