"""A learned filter of texts: classes by counted features.

A text's features are its words, their shapes (runs of letters and digits made
one character each), neighbouring shapes, and the share of words that repeat
the word before.  The fit counts, for each class, the labelled texts that hold
a feature, so it is one pass with sums, over all labelled rows; its weights are
whole thousandths of a logarithm, so sums of them are exact in any order.  The
model has the FEATURES that most of these texts hold, whatever the corpus,
which bounds its broadcast; whole texts of all documents are scored in the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.work import written

#: Features of a model, and the longest; longer ones, of texts without white
#: space, are no features.
FEATURES, LONGEST = 1 << 16, 64
#: A text speaks for its classes as so many independent features would:
#: neighbouring words are not independent.
EVIDENCE = 16
#: Classes of one model.
CLASSES = 64


def shapes(text: Column) -> Column:
    """A text whose words are only shapes."""
    for pattern, sign in (("[a-z]+", "a"), ("[A-Z]+", "A"), ("[0-9]+", "0"), (r"[^\x00-\x7F]+", "~")):
        text = F.regexp_replace(text, pattern, sign)
    return text


def features(rows: DataFrame, text: str, out: str = "feature") -> DataFrame:
    """A row for each different feature of each text, in place of the text; a
    text without words has the share 0 alone."""
    whole = F.coalesce(text, F.lit(""))
    split = lambda x: F.filter(F.split(x, "[ \t\n\r]+"), lambda w: w != "")
    tagged = lambda tag, xs: F.transform(xs, lambda x: F.concat(F.lit(tag), x))
    # A column each, so that none is computed for every place that reads it.
    x = rows.withColumns({"_words": split(whole), "_forms": split(shapes(whole))}).drop(text)
    x = x.withColumn("_n", F.greatest(F.size("_words") - 1, F.lit(0)))
    pairs = lambda c, f: F.zip_with(F.slice(c, 1, F.col("_n")), F.slice(c, 2, F.col("_n")), f)
    x = x.withColumns({"_again": F.size(F.filter(pairs("_words", lambda a, b: a == b), lambda v: v)), "_pairs": F.array_distinct(pairs("_forms", lambda a, b: F.concat(F.lit("d:"), a, F.lit(" "), b)))})
    share = F.concat(F.lit("r:"), F.floor(10 * F.col("_again") / F.greatest(F.col("_n"), F.lit(1))).cast("string"))
    told = F.concat(tagged("w:", F.array_distinct("_words")), tagged("s:", F.array_distinct("_forms")), "_pairs", F.array(share))
    x = x.withColumn("_told", told).drop("_words", "_forms", "_pairs", "_again", "_n")
    # Not explode(): the filter that it infers would compute all of this again.
    return x.withColumn(out, F.explode_outer("_told")).drop("_told").filter(F.length(out) <= LONGEST)


@dataclass
class Model:
    """weights: (feature, w0, w1, ...), a column a class; priors alike."""

    classes: list[str]
    weights: DataFrame
    priors: list[int]


def labelled(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most `most` of labelled rows, those with the least digest of their
    key, so that any order of the table gives the same.  Keys are taken first,
    as each part of the table sends its own `most` to the one task that takes
    them: without texts, which only the rows taken send."""
    first = lambda df, k: df.orderBy(F.md5(F.col(k).cast("string")), k).limit(most)
    taken = F.broadcast(first(rows.select(F.col(key).alias("_taken")), "_taken").distinct())
    return first(rows.join(taken, F.col(key).eqNullSafe(F.col("_taken")), "left_semi"), key)


def most(df: DataFrame, n: str, key: str, k: int) -> DataFrame:
    """The k rows with the highest n, the least keys of equals.  The least n
    that these may have is told by how many rows have each, so that a task
    sends its rows from there on, not k of its own."""
    from pyspark.sql import Window

    each = df.groupBy(n).count().withColumn("_above", F.sum("count").over(Window.orderBy(F.desc(n))) - F.col("count"))
    least = each.filter(F.col("_above") < k).agg(F.min(n)).first()[0]
    return df.filter(F.col(n) >= F.lit(least)).orderBy(F.desc(n), key).limit(k)


def fit(rows: DataFrame, key: str, text: str, label: str) -> Model:
    """A model of labelled rows (key, text, label), label one of CLASSES texts
    at most; rows without a label are nothing, of rows with one key one counts."""
    rows = rows.filter(F.col(label).isNotNull()).select(F.col(key).alias("k"), F.col(label).cast("string").alias("y"), F.col(text).alias("t"))
    counts = {r.y: r["count"] for r in rows.groupBy("y").count().orderBy("y").limit(CLASSES + 1).collect()}
    if len(counts) > CLASSES:
        raise ValueError(f"a model has at most {CLASSES} classes")
    total, spark = sum(counts.values()), rows.sparkSession
    thousandths = lambda x: F.round(1000 * F.ln(x)).cast("long")
    each = [thousandths((F.count_if(F.col("y") == c) + 1) / F.lit(n + 2.0)).alias(f"w{i}") for i, (c, n) in enumerate(counts.items())]
    weights = features(rows.dropDuplicates(["k"]), "t").groupBy("feature").agg(F.count("*").alias("n"), *each)
    weights = most(written(weights, "features"), "n", "feature", FEATURES).drop("n")
    weights = spark.createDataFrame(weights.collect(), weights.schema)
    priors = spark.createDataFrame([(i, n / total) for i, n in enumerate(counts.values())], "i int, p double")
    return Model(list(counts), weights, [r.w for r in priors.select("i", thousandths(F.col("p")).alias("w")).orderBy("i").collect()])


def score(rows: DataFrame, model: Model, key: str, text: str) -> DataFrame:
    """(key, scores): a probability for each class of the model, in its order.

    A class's evidence is its prior and EVIDENCE times the mean of its weights
    over the text's features that the model knows; texts without any have the
    priors.  Rows of one key are parts of one text; a null key is one, too.
    """
    k = range(len(model.classes))
    found = features(rows.select(key, text), text).join(F.broadcast(model.weights), "feature")
    sums = found.groupBy(key).agg(F.count("*").alias("_n"), *(F.sum(f"w{i}").alias(f"_s{i}") for i in k))
    out = rows.select(key).distinct().join(sums.withColumnRenamed(key, "_k"), F.col(key).eqNullSafe(F.col("_k")), "left")
    evidence = [(F.lit(model.priors[i]) + EVIDENCE * F.coalesce(F.col(f"_s{i}") / F.col("_n"), F.lit(0.0))) / 1000 for i in k]
    top = F.greatest(*evidence) if len(evidence) > 1 else evidence[0]
    odds = F.array(*(F.exp(e - top) for e in evidence))
    whole = F.aggregate(odds, F.lit(0.0), lambda a, x: a + x)
    return out.select(key, F.transform(odds, lambda x: x / whole).alias("scores"))


def relevance(rows: DataFrame, model: Model, key: str, text: str, relevant: str, least: float = 0.25, short: int = 50) -> DataFrame:
    """(key, score, keep): the probability of the class `relevant`; texts under
    `short` characters, but for white space around, are kept unasked with 1."""
    at = model.classes.index(relevant)
    long = rows.filter(F.length(F.trim(F.coalesce(text, F.lit("")))) >= short)
    asked = score(long, model, key, text).select(key, F.get("scores", F.lit(at)).alias("score"))
    rest = rows.filter(F.length(F.trim(F.coalesce(text, F.lit("")))) < short).select(key, F.lit(1.0).alias("score"))
    return asked.unionByName(rest).select(key, "score", (F.col("score") >= least).alias("keep"))


def chosen(scores: DataFrame, model: Model) -> DataFrame:
    """scores with `choice`, the class with the highest probability, the first
    of equals, and its `probability`."""
    best = F.array_max("scores")
    return scores.withColumns({"choice": F.get(F.array(*map(F.lit, model.classes)), F.array_position("scores", best).cast("int") - 1), "probability": best})


def auc(scored: DataFrame, score: str, label: str, bins: int = 10_000) -> DataFrame:
    """One row (positives, negatives, auc) of rows with a boolean label: the
    chance that a positive's score is higher than a negative's, equal ones
    counting half.  Scores are compared in `bins` steps, so the only ordered
    table is one of bins."""
    from pyspark.sql import Window

    each = scored.groupBy(F.floor(F.col(score) * bins).alias("bin")).agg(F.count_if(label).alias("p"), F.count_if(~F.col(label)).alias("n"))
    below = F.coalesce(F.sum("n").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    each = each.withColumn("_won", F.col("p") * (below + F.col("n") / 2))
    return each.agg(F.sum("p").alias("positives"), F.sum("n").alias("negatives"), F.try_divide(F.sum("_won"), F.sum("p").cast("double") * F.sum("n")).alias("auc"))
