"""Matching of predicted to reference parameters, and its measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import f1, ratio
from ..sources.work import written


def candidates(reference: DataFrame, prediction: DataFrame, doc: str, names: list[tuple[str, int]], context: list[str], bonus: list[str] | None = None) -> DataFrame:
    """Scored pairs (doc, ref, pred, score) of one document.

    Both sides have doc, ord, the columns of names, each an identifier or an
    array of them, and those of context and bonus.  A pair needs an identifier
    in common; each column of names with one is worth its points.  An unequal
    known context kills the pair, an equal one is worth 2, a missing one
    nothing; an equal known bonus column is worth 2, an unequal one nothing.
    Pairs come from one equi-join by (document, column, identifier), so no
    documents are crossed.
    """
    bonus = bonus or []
    rest = [*context, *bonus]

    def told(side: DataFrame, pre: str) -> DataFrame:
        """A row for each identifier: (doc, kind, ident, ord and the rest)."""
        listed = lambda c: F.array_distinct(F.col(c)) if side.schema[c].dataType.typeName() == "array" else F.array(c)
        x = side.select(F.col(doc), F.col("ord").alias(pre + "ord"), *(F.coalesce(F.col(c), F.lit("")).alias(pre + c) for c in rest), F.posexplode(F.array(*(listed(n) for n, _ in names))).alias("kind", "idents"))
        return x.withColumn("ident", F.explode("idents")).drop("idents").filter("ident <> ''")

    known = lambda c: (F.col("r_" + c) != "") & (F.col("p_" + c) != "")
    equal = lambda c: F.col("r_" + c) == F.col("p_" + c)
    both = told(reference, "r_").join(told(prediction, "p_"), [doc, "kind", "ident"])
    for c in context:
        both = both.filter(~known(c) | equal(c))
    points = sum((F.when(known(c) & equal(c), 2).otherwise(0) for c in rest), F.lit(0))
    kinds = {f"_{i}": F.bool_or(F.col("kind") == i) for i in range(len(names))}
    # Texts end at the join: what meets on several identifiers is grouped by numbers.
    pairs = both.select(doc, "r_ord", "p_ord", "kind", points.alias("_rest")).groupBy(doc, "r_ord", "p_ord", "_rest").agg(*(c.alias(n) for n, c in kinds.items()))
    score = sum((F.when(F.col(k), n).otherwise(0) for k, (_, n) in zip(kinds, names, strict=True)), F.col("_rest"))
    return pairs.select(doc, F.col("r_ord").alias("ref"), F.col("p_ord").alias("pred"), score.alias("score"))


def best(pairs: DataFrame, doc: str) -> DataFrame:
    """Each prediction's best pairs, with `ties`, how many they are."""
    w = Window.partitionBy(doc, "pred")
    top = pairs.withColumn("_top", F.max("score").over(w)).filter("score = _top").drop("_top")
    return top.withColumn("ties", F.count("*").over(w))


def settled(pairs: DataFrame, doc: str) -> DataFrame:
    """best(), with `won`, whether one_to_one() keeps the pair."""
    single = F.col("ties") == 1
    w = Window.partitionBy(doc, "ref", single).orderBy(F.desc("score"), "pred")
    return best(pairs, doc).withColumn("won", single & (F.row_number().over(w) == 1))


def one_to_one(pairs: DataFrame, doc: str) -> DataFrame:
    """Predictions with one best reference, each reference once: the greedy
    order (score down, reference, prediction) as a window, which is the same
    because a prediction has one proposal at most."""
    w = Window.partitionBy(doc, "ref").orderBy(F.desc("score"), "pred")
    single = best(pairs, doc).filter("ties = 1").drop("ties")
    return single.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def states(pairs: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """A row for each pair and field: (field, state)."""
    rows = F.array(*(F.struct(F.lit(n).alias("field"), c.alias("state")) for n, c in fields.items()))
    return pairs.select(F.explode(rows).alias("x")).select("x.*")


def agreement(found: DataFrame) -> DataFrame:
    """Counts of states and the share of matches by field."""
    n = lambda s: F.count_if(F.col("state") == s)
    return found.groupBy("field").agg(
        (n("match") + n("mismatch")).alias("compared"), n("match").alias("matched"), n("mismatch").alias("mismatched"),
        n("not_compared").alias("not_compared"), F.try_divide(n("match"), n("match") + n("mismatch")).alias("agreement"),
    )


def prf(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    p, r = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return {"precision": p, "recall": r, "f1": f1(p, r)}


def bag_overlap(a: DataFrame, b: DataFrame, doc: str, item: str) -> DataFrame:
    """Size of the multiset intersection of a's and b's items by document."""
    x, y = (t.groupBy(doc, item).agg(F.count("*").alias(n)) for t, n in ((a, "x"), (b, "y")))
    return x.join(y, [doc, item]).groupBy(doc).agg(F.sum(F.least("x", "y")).alias("common"))


def unmatched(side: DataFrame, used: DataFrame, on: list[str]) -> DataFrame:
    return side.join(used, on, "left_anti")


#: Rounds of greedy() between two looks at what is left.
ROUNDS = 4


def greedy(pairs: DataFrame, doc: str, order: tuple[str, str] = ("pred", "ref")) -> DataFrame:
    """Of acceptable pairs (doc, pred, ref): each prediction, in order, takes
    the first reference that no prediction before it has taken.

    In rounds of windows, all documents at once.  A prediction stands at a
    place of its list of references; of those that stand at one reference the
    first stays and the others go on by one, for good, as a reference only
    ever changes to an earlier prediction.  Predictions with equal lists take
    references in their own order, so each stands at least one place after the
    one before it: a block in which everything matches everything is settled
    in one round, not in one a prediction.  Pairs with a null are nothing,
    repeated ones are one.
    """
    first, second = order
    lists = pairs.select(doc, first, second).dropna().groupBy(doc, first).agg(F.sort_array(F.collect_set(second)).alias("_list"))
    equal = Window.partitionBy(doc, "_list").orderBy(first)
    state = written(lists.withColumn("_nth", F.row_number().over(equal)).withColumn("_at", F.col("_nth")), "greedy")
    stands = F.try_element_at("_list", F.col("_at"))
    while True:
        for _ in range(ROUNDS):
            here = state.withColumn("_ref", stands)
            lost = F.col("_ref").isNotNull() & (F.min(first).over(Window.partitionBy(doc, "_ref")) < F.col(first))
            here = here.withColumn("_go", F.col("_at") + F.when(lost, 1).otherwise(0))
            ahead = F.max(F.col("_go") - F.col("_nth")).over(equal.rowsBetween(Window.unboundedPreceding, 0))
            state = here.select(doc, first, "_list", "_nth", (F.col("_nth") + ahead).alias("_at"))
        state = written(state, "greedy")
        taken = state.select(doc, first, stands.alias(second)).filter(F.col(second).isNotNull())
        if taken.groupBy(doc, second).count().filter("count > 1").isEmpty():
            return taken
