"""The alignment of two tokenizers with a row a token, in relational terms
alone: exploded tokens, windowed lengths, a full join on key and end, running
counts of cuts.  It gives what alignment.align() gives, at many times the cost
(README); for tables that are small, or wanted as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .alignment import align, side


def token_rows(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, group, end, a, b): a row for each byte of a text where a token of
    either side ends, with the ids of those that do, and the group, from 0.

    docs: one row a key.  Texts without tokens (see align()) have no rows.
    """
    spark = docs.sparkSession
    ids = align(docs.select(key, text), path_a, path_b, text).select(key, "a", "b")

    def ends(name: str, path: str) -> DataFrame:
        sizes = spark.createDataFrame(list(enumerate(side(path).sizes.tolist())), f"{name} int, size long")  # a row an id of the vocabulary
        w = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
        return ids.select(key, F.posexplode(name).alias("pos", name)).join(F.broadcast(sizes), name).select(key, F.sum("size").over(w).alias("end"), name)

    both = ends("a", path_a).join(ends("b", path_b), [key, "end"], "full")
    cut = F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), 1).otherwise(0)
    before = Window.partitionBy(key).orderBy("end").rowsBetween(Window.unboundedPreceding, -1)
    return both.select(key, F.coalesce(F.sum(cut).over(before), F.lit(0)).alias("group"), "end", "a", "b")


def link_rows(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, group, a, b): a row for each link, a join of the two sides' rows
    of token_rows() by group."""
    one, two = (tokens.filter(F.col(x).isNotNull()).select(key, "group", x) for x in ("a", "b"))
    return one.join(two, [key, "group"])
