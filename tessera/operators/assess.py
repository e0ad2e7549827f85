"""A questionnaire over facts: every document answers every item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import gated_double

#: The items' identifiers.
ITEMS = (
    "TAN_1.1", "TAN_1.2", "TAN_1.3", "TAN_2.1.1", "TAN_2.1.2", "TAN_2.1.3",
    "TAN_2.3.1", "TAN_2.2.1", "TAN_2.4.1", "TAN_2.4.2A", "TAN_2.4.2B", "TAN_2.4.2C",
    "TAN_2.4.3.1", "TAN_2.4.3.2", "TAN_2.4.3.3", "TAN_2.4.3.4", "TAN_2.4.3.5", "TAN_2.4.3.6",
    "TAN_2.4.3.7", "TAN_2.4.3.8", "TAN_2.4.3.9", "TAN_2.4.3.10", "TAN_2.4.3.11", "TAN_2.4.3.12",
    "TAN_2.4.3.13", "TAN_2.4.4", "TAN_2.4.5A", "TAN_2.4.5B", "TAN_2.4.5C", "TAN_2.4.6A",
    "TAN_2.4.6B", "TAN_2.4.7", "TAN_2.5.1A", "TAN_2.5.1B", "TAN_2.5.2A", "TAN_2.5.2B",
)
#: The item about the review itself, and the answer of none.
SELF, NONE = "TAN_1.3", "i_cannot_answer"


#: Spellings of answers.
SPELLINGS = {
    "yes": "yes", "partially": "partially", "no": "no", "not_applicable": "not_applicable", "not applicable": "not_applicable", "n/a": "not_applicable",
    "i_cannot_answer": NONE, "cannot_answer": NONE, "i cannot answer": NONE,
}


def response_form(c: Column) -> Column:
    """An answer in one spelling; what is none is NONE."""
    names = F.create_map(*(F.lit(v) for pair in SPELLINGS.items() for v in pair))
    return F.coalesce(F.try_element_at(names, F.lower(F.trim(c))), F.lit(NONE))


def page_number(c: Column) -> Column:
    """A positive whole number of a text like `3` or `3.0`, else null."""
    n = gated_double(F.trim(c)).cast("int")
    return F.when(n > 0, n)


def stated(c: Column) -> Column:
    """A quote or place, trimmed; null where it only says that there is none."""
    t = F.trim(c)
    return F.when(~F.lower(t).isin("", "n/a", "none"), t)


def questionnaire(docs: DataFrame, answers: DataFrame, doc: str, items: tuple[str, ...] = ITEMS) -> DataFrame:
    """(doc, item_id, response, confidence): all items of all documents.

    answers: (doc, item_id, response, quote, location).  Unknown items are
    ignored, missing ones answered by NONE; a yes without evidence becomes
    NONE; the item on the review itself is yes.  Confidence is high with quote
    and location, medium with one, else low.
    """
    spark = docs.sparkSession
    table = F.broadcast(spark.createDataFrame([(i, n) for n, i in enumerate(items)], "item_id string, item_ord int"))
    some = lambda c: stated(F.col(c)).isNotNull()
    grid = docs.select(doc).distinct().join(table)  # each document by the fixed items
    out = grid.join(answers, [doc, "item_id"], "left")
    quote, place = some("quote"), some("location")
    asked = response_form(F.col("response"))
    gated = F.when(F.col("item_id") == SELF, "yes").when((asked == "yes") & ~quote & ~place, NONE).otherwise(asked)
    sure = F.when(quote & place, "high").when(quote | place, "medium").otherwise("low")
    return out.select(doc, "item_id", "item_ord", gated.alias("response"), F.when(gated == NONE, "low").otherwise(sure).alias("confidence"))


def summary(items: DataFrame, doc: str) -> DataFrame:
    """By document: answers of each kind, completeness, and the gaps."""
    n = lambda r: F.count_if(F.col("response") == r)
    gaps = F.array_sort(F.collect_list(F.when(F.col("response") == NONE, F.col("item_id"))))
    return items.groupBy(doc).agg(
        F.count("*").alias("n_items"), n("yes").alias("n_yes"), n("no").alias("n_no"), n(NONE).alias("n_open"),
        F.round(100 * (F.count("*") - n(NONE)) / F.count("*"), 1).alias("completeness"), F.array_join(F.slice(gaps, 1, 5), ",").alias("gaps"),
    )


def basis_confidence(scores: Column) -> Column:
    """high if all are 2, medium if any is more than 0, else low."""
    return F.when(F.array_min(scores) == 2, "high").when(F.array_max(scores) > 0, "medium").otherwise("low")
