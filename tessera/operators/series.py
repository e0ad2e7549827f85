"""Time series: interpolation, fit measures, compartment models."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def interpolate(curve: DataFrame, asked: DataFrame, series: str, t: str, y: str) -> DataFrame:
    """asked with y from the curve, linear between its points.

    Before the first and after the last point the first and last pair are
    carried on.  One union and windows: the two nearest points on each side.
    """
    rows = curve.select(series, t, F.col(y).alias("_y"), F.lit(None).cast("long").alias("_id")).unionByName(
        asked.select(series, t, F.lit(None).cast("double").alias("_y"), F.monotonically_increasing_id().alias("_id")))
    point = F.when(F.col("_y").isNotNull(), F.struct(F.col(t).alias("t"), F.col("_y").alias("y")))
    rows = rows.withColumn("_p", point)
    w = Window.partitionBy(series).orderBy(t, F.col("_id").asc_nulls_first())
    past, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    rows = rows.withColumns({"_a": F.last("_p", True).over(past), "_b": F.first("_p", True).over(ahead)})
    # The second nearest: the neighbour of a curve point, carried to its place.
    points = Window.partitionBy(series, F.col("_y").isNull()).orderBy(t, "_id")
    rows = rows.withColumns({"_prev": F.when(F.col("_y").isNotNull(), F.lag("_p").over(points)), "_next": F.when(F.col("_y").isNotNull(), F.lead("_p").over(points))})
    rows = rows.withColumns({"_pa": F.last("_prev", True).over(past), "_nb": F.first("_next", True).over(ahead)})
    low, high = F.coalesce("_a", "_b"), F.coalesce("_b", "_a")
    low = F.when(F.col("_b").isNull(), F.coalesce("_pa", "_a")).otherwise(low)
    high = F.when(F.col("_a").isNull(), F.coalesce("_nb", "_b")).otherwise(high)
    rows = rows.filter("_id IS NOT NULL").withColumns({"_l": low, "_h": high})
    slope = F.try_divide(F.col("_h.y") - F.col("_l.y"), F.col("_h.t") - F.col("_l.t"))
    return rows.select(series, t, (F.col("_l.y") + F.coalesce(slope, F.lit(0.0)) * (F.col(t) - F.col("_l.t"))).alias(y))


def fit_measures(pairs: DataFrame, series: str, simulated: str, observed: str, eps: float = 1e-10) -> DataFrame:
    """R squared, root mean square error, largest fold error and the verdict."""
    mean = Window.partitionBy(series)
    x = pairs.withColumn("_m", F.avg(observed).over(mean))
    s, o = F.col(simulated), F.col(observed)
    out = x.groupBy(series).agg(
        F.sum(F.pow(o - s, 2)).alias("_r"), F.sum(F.pow(o - F.col("_m"), 2)).alias("_t"), F.sqrt(F.avg(F.pow(o - s, 2))).alias("rmse"),
        F.max(F.when((s > 0) & (o > 0), F.greatest(s / o, o / s))).alias("max_fold"), F.count("*").alias("n"),
    )
    out = out.withColumn("r2", 1 - F.col("_r") / (F.col("_t") + eps)).drop("_r", "_t")
    return out.withColumn("verdict", F.when(F.col("r2") > 0.85, "PASS").otherwise("FAIL"))


def simulate(models: DataFrame, key: str, hours: float = 24.0, points: int = 500) -> DataFrame:
    """(key, time, central, peripheral, peripheral2, depot): amounts of linear
    compartment models, one row each with v1, v2, v3, cl, q, q2, ka, dose.

    The system is linear, so its matrix exponential of one step, repeated,
    gives all points; the work is a few dozen numbers a model.
    """
    import numpy as np
    import pyarrow as pa

    schema = f"{key} {models.schema[key].dataType.simpleString()}, time double, central double, peripheral double, peripheral2 double, depot double"

    def expm(a: np.ndarray) -> np.ndarray:
        n = max(0, int(np.ceil(np.log2(max(1e-12, np.abs(a).sum(axis=1).max())))) + 4)
        a, out, term = a / 2**n, np.eye(len(a)), np.eye(len(a))
        for i in range(1, 18):
            term = term @ a / i
            out = out + term
        for _ in range(n):
            out = out @ out
        return out

    def run(batches):
        for b in batches:
            for r, k in zip(b.to_pylist(), b.column(key), strict=True):
                g = lambda c, r=r: r[c] or 0.0
                v1, ka = g("v1") or 1.0, g("ka")
                k12, k21 = (g("q") / v1, g("q") / g("v2")) if g("v2") > 0 else (0.0, 0.0)
                k13, k31 = (g("q2") / v1, g("q2") / g("v3")) if g("v3") > 0 else (0.0, 0.0)
                a = np.array([[-(g("cl") / v1 + k12 + k13), k21, k31, ka], [k12, -k21, 0, 0], [k13, 0, -k31, 0], [0, 0, 0, -ka]])
                step, x = expm(a * hours / (points - 1)), np.zeros(4)
                x[3 if ka > 0 else 0] = g("dose")
                rows = np.empty((points, 4))
                for i in range(points):
                    rows[i] = x
                    x = step @ x
                cols = [pa.array(c) for c in (np.linspace(0, hours, points), *rows.T)]
                yield pa.RecordBatch.from_arrays([pa.array([k.as_py()] * points, b.column(key).type), *cols], [key, "time", "central", "peripheral", "peripheral2", "depot"])

    return models.mapInArrow(run, schema)


#: Parts of symbols by role in a compartment model, in order.
ROLES = ((("V1", "VC"), "v1"), (("V2", "VP"), "v2"), (("V3",), "v3"), (("CL",), "cl"), (("Q2", "Q_T"), "q2"), (("Q",), "q"), (("KA",), "ka"))


def roles(parameters: DataFrame, key: str, symbol: str, value: str, order: str) -> DataFrame:
    """One row a model with the values of its roles; a role's last wins."""
    s = F.upper(symbol)
    role = F.lit(None).cast("string")
    for words, name in reversed(ROLES):
        fits = F.lit(False)
        for w in words:
            fits = fits | F.contains(s, F.lit(w))
        role = F.when(fits, name).otherwise(role)
    x = parameters.withColumn("_role", role)
    return x.groupBy(key).agg(*(F.max_by(value, F.when(F.col("_role") == n, F.col(order))).alias(n) for _, n in ROLES))


def model_text(parameters: DataFrame, key: str, symbol: str, value: str, order: str) -> DataFrame:
    """(key, text): a model's parameter block and its reactions, as text."""
    from ..functions.text import symbol_form

    x = parameters.withColumn("_s", symbol_form(F.col(symbol)))
    w = Window.partitionBy(key, "_s").orderBy(order)
    x = x.withColumn("_k", F.row_number().over(w)).filter("_k <= 2").withColumn("_s", F.when(F.col("_k") == 2, F.concat("_s", F.lit("_2"))).otherwise(F.col("_s")))
    line = F.format_string("  %s = %s;", "_s", F.coalesce(F.col(value), F.lit(0.0)).cast("string"))
    block = x.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l")))), lambda p: p["l"]), "\n").alias("_lines"))
    r = roles(parameters, key, symbol, value, order)
    out = block.join(r, key)
    flows = F.concat_ws(
        "\n", F.when(F.col("ka") > 0, F.lit("  Absorption: A_Depot -> A_Central; ka * A_Depot;")), F.lit("  Elimination: A_Central -> ; (CL / Central) * A_Central;"),
        F.when(F.col("v2") > 0, F.lit("  Distribution1: A_Central -> A_Peripheral; (Q / Central) * A_Central - (Q / Peripheral) * A_Peripheral;")),
        F.when(F.col("v3") > 0, F.lit("  Distribution2: A_Central -> A_Peripheral2; (Q2 / Central) * A_Central - (Q2 / Peripheral2) * A_Peripheral2;")),
    )
    return out.select(key, F.concat_ws("\n", F.lit("model pk_model()"), "_lines", flows, F.lit("end")).alias("text"))


def solver_text(parameters: DataFrame, key: str, symbol: str, name: str, value: str, unit: str, group: str, order: str) -> DataFrame:
    """(key, text): a model for an R solver of compartment models, parameters
    by group (null is Physiological), then compartments and equations.

    A symbol that comes twice in a group gets _2; an unknown value is 0.0.
    """
    from ..functions.text import symbol_form

    x = parameters.withColumns({"_g": F.coalesce(F.nullif(group, F.lit("")), F.lit("Physiological")), "_s": symbol_form(F.coalesce(F.nullif(symbol, F.lit("")), F.col(name)))})
    w = Window.partitionBy(key, "_g", "_s").orderBy(order)
    x = x.withColumn("_k", F.row_number().over(w)).withColumn("_s", F.when(F.col("_k") > 1, F.concat("_s", F.lit("_2"))).otherwise(F.col("_s")))
    note = F.concat(F.coalesce(name, F.lit("")), F.when(F.coalesce(unit, F.lit("")) != "", F.concat(F.lit(" ["), unit, F.lit("]"))).otherwise(""))
    line = F.format_string("%s = %s, // %s", "_s", F.coalesce(F.col(value), F.lit(0.0)).cast("string"), note)
    listed = lambda c: F.array_join(F.transform(F.array_sort(c), lambda p: p["l"]), "\n")
    # Physiological comes first, then compounds by name.
    per = x.groupBy(key, "_g").agg(listed(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l")))).alias("b"))
    block = F.struct((F.col("_g") != "Physiological").alias("o"), F.col("_g").alias("g"), F.concat(F.lit("// "), "_g", F.lit("\n"), "b").alias("l"))
    return per.groupBy(key).agg(listed(F.collect_list(block)).alias("_p")).select(key, F.concat_ws("\n", F.lit("$PARAM"), "_p", F.lit("$CMT DEPOT CENTRAL"), F.lit("$ODE"), F.lit("dxdt_DEPOT = -KA * DEPOT;"), F.lit("dxdt_CENTRAL = KA * DEPOT - CL / V1 * CENTRAL;"), F.lit("$TABLE capture CP = CENTRAL / V1;")).alias("text"))


def replicate(parameters: DataFrame, dosing: DataFrame, observed: DataFrame, key: str, compound: str | None = None, hours: float = 24.0, points: int = 500) -> tuple[DataFrame, DataFrame]:
    """A model's simulation and its fit: scope, roles, simulation, alignment
    with what was observed, measures.

    parameters: key, compound, symbol, value, ord; dosing: key, dose; observed:
    key, time, concentration.  The concentration is the central amount by v1.
    """
    x = parameters
    if compound is not None:
        c = F.lower(F.coalesce("compound", F.lit("")))
        x = x.filter(c.isin("", "physiological", compound.lower()))
    models = roles(x, key, "symbol", "value", "ord").join(dosing.groupBy(key).agg(F.first("dose").alias("dose")), key, "left")
    models = models.withColumn("dose", F.coalesce("dose", F.lit(100.0)))
    curve = simulate(models, key, hours, points).join(models.select(key, F.coalesce("v1", F.lit(1.0)).alias("_v")), key).withColumn("concentration", F.col("central") / F.col("_v")).drop("_v")
    met = interpolate(curve.select(key, "time", "concentration"), observed.select(key, "time"), key, "time", "concentration")
    pairs = met.join(observed.withColumnRenamed("concentration", "observed"), [key, "time"])
    return curve, fit_measures(pairs, key, "concentration", "observed")
