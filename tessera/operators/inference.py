"""The place of models: one interface, and a stub that needs none.

A model is a function from texts to JSON texts.  It runs in Arrow batches; a
text that it fails on gives ok = false and the error, never a failed task.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: From texts, or from the bytes of images or files, to JSON texts.
Model = Callable[[list], list[str]]


def stub(texts: list[str]) -> list[str]:
    """A deterministic model: names with numbers and units, by pattern."""
    found = re.compile(r"([A-Za-z][\w-]*)\s*(?:=|:|of)\s*([+-]?\d+(?:\.\d+)?)\s*([A-Za-z/%^\d-]*)")
    return [json.dumps([{"symbol": s, "value": float(v), "unit": u or None} for s, v, u in found.findall(t)]) for t in texts]


def dosing_stub(texts: list[str]) -> list[str]:
    """Doses with a unit and a route, by pattern."""
    found = re.compile(r"(\d+(?:\.\d+)?)\s*(mg/kg|mg|ug/kg|µg/kg|g)\b[^.]{0,60}?\b(oral|iv|intravenous|dermal)\b", re.IGNORECASE)
    return [json.dumps([{"dose": float(d), "dose_unit": u, "route": r.lower()} for d, u, r in found.findall(t)]) for t in texts]


def page_stub(images: list[bytes]) -> list[str]:
    """What a reader of images answers: here the size of each, as JSON."""
    return [json.dumps({"bytes": len(x)}) for x in images]


def failover(*models: Model, tries: int = 2) -> Model:
    """A model that asks the models in turn, each `tries` times, until one
    answers; the last error is raised."""

    def ask(texts: list) -> list[str]:
        error: Exception | None = None
        for model in models:
            for _ in range(tries):
                try:
                    return model(texts)
                except Exception as e:  # noqa: BLE001  the next one is asked
                    error = e
        raise error or ValueError("no model")

    return ask


def run(df: DataFrame, text: str, model: Model = stub, size: int = 64, out: str = "answer") -> DataFrame:
    """df with `out`: struct(ok, error, json).  A batch that fails is asked
    again text by text, once, so one bad text does not take others with it."""
    schema = df.select("*", F.struct(F.lit(True).alias("ok"), F.lit("").alias("error"), F.lit("").alias("json")).alias(out)).schema
    at, names = df.columns.index(text), [*df.columns, out]
    empty = b"" if df.schema[text].dataType.typeName() == "binary" else ""
    kind = pa.struct([("ok", pa.bool_()), ("error", pa.string()), ("json", pa.string())])

    def one(x: str) -> dict:
        try:
            return {"ok": True, "error": "", "json": model([x])[0]}
        except Exception as e:  # noqa: BLE001  the error is the row's result
            return {"ok": False, "error": f"{type(e).__name__}: {e}"[:500], "json": ""}

    def batches(rows):
        for b in rows:
            texts, got = [empty if x is None else x for x in b.column(at).to_pylist()], []
            for i in range(0, len(texts), size):
                part = texts[i : i + size]
                try:
                    got += [{"ok": True, "error": "", "json": x} for x in model(part)]
                except Exception:  # noqa: BLE001
                    got += map(one, part)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, kind)], names)

    return df.mapInArrow(batches, schema)


def patch_or_drop(rows: DataFrame, verdicts: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """rows after a critic's verdicts: reject drops, fix patches, others stay."""
    v = verdicts.select(*key, "verdict", *(F.col(f).alias("_" + f) for f in fields))
    out = rows.join(v, key, "left").filter(F.coalesce("verdict", F.lit("ok")) != "reject")
    fix = F.col("verdict") == "fix"
    return out.withColumns({f: F.when(fix, F.coalesce("_" + f, f)).otherwise(F.col(f)) for f in fields}).drop("verdict", *("_" + f for f in fields))


def parsed(df: DataFrame, kind: str, out: str = "answer") -> DataFrame:
    """df with `parsed`, the answer as Spark type `kind`, repaired if it was
    cut off, and `problem`, why there is none."""
    from ..functions.python import repair_json
    from ..functions.text import without_fences

    text = without_fences(F.col(f"{out}.json"))
    # from_json makes nulls of what is no JSON, or a list for an object.
    opens = "[" if kind.startswith("array") else "{"
    plain = F.when(F.try_parse_json(text).isNotNull() & F.startswith(text, F.lit(opens)), F.from_json(text, kind))
    df = df.withColumn("_whole", F.when(F.col(f"{out}.ok") & plain.isNull(), repair_json(text)))
    got = F.coalesce(plain, F.when(F.startswith("_whole", F.lit(opens)), F.from_json("_whole", kind)))
    problem = F.when(~F.col(f"{out}.ok"), F.col(f"{out}.error")).when(F.col("parsed").isNull(), F.lit("- Error: the answer is no JSON of the schema"))
    return df.withColumn("parsed", F.when(F.col(f"{out}.ok"), got)).withColumn("problem", problem).drop("_whole")


def run_with_repair(df: DataFrame, text: str, kind: str, model: Model = stub, repairer: Model | None = None, fallback: Column | None = None) -> DataFrame:
    """df with `parsed` and `how`: first, repaired, fallback or none.

    Only rows without an answer of the schema go to the second turn, whose
    prompt holds the first one, the answer and the problem; what fails again
    takes the fallback.
    """
    first = parsed(run(df, text, model), kind)
    bad = first.filter("problem IS NOT NULL")
    turn = F.concat_ws("\n\n", F.col(text), F.concat(F.lit("Your answer:\n"), F.coalesce("answer.json", F.lit(""))), F.concat(F.lit("What is wrong with it:\n"), "problem"), F.lit("Answer again, with valid JSON only."))
    again = parsed(run(bad.withColumn("_turn", turn).drop("answer", "parsed", "problem"), "_turn", repairer or model), kind).drop("_turn")
    good = lambda x, how: x.withColumn("how", F.lit(how))
    none = F.lit(None).cast(kind) if fallback is None else fallback
    failed = again.filter("problem IS NOT NULL").withColumn("parsed", none).withColumn("how", F.when(F.col("parsed").isNotNull(), "fallback").otherwise("none"))
    out = good(first.filter("problem IS NULL"), "first").unionByName(good(again.filter("problem IS NULL"), "repaired")).unionByName(failed)
    return out.drop("answer", "problem")


def batched(items: DataFrame, key: list[str], order: str, k: int) -> DataFrame:
    """items with `batch`, the number of its k items, in order, by key."""
    w = Window.partitionBy(*key).orderBy(order)
    return items.withColumn("batch", F.floor((F.row_number().over(w) - 1) / k).cast("int"))


def fits_context(text: Column, context: int, reserve: int = 4000, per_token: float = 3.5) -> Column:
    """Whether a prompt leaves `reserve` of a model's tokens, at per_token
    characters each."""
    return F.length(text) / F.lit(per_token) < context - reserve


def prompt(template: str, **fields: Column) -> Column:
    """A template's text with its {fields}; an unknown value is empty."""
    parts, at = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        parts += [F.lit(template[at : m.start()]), F.coalesce(fields[m[1]].cast("string"), F.lit(""))]
        at = m.end()
    return F.concat(*parts, F.lit(template[at:]))


#: Templates of prompts: a table's, a batch of questions', a critic's.
TABLE_PROMPT = "Table from {place}:\n\n{table}\n\nExtract every parameter of this table as JSON."
ITEMS_PROMPT = "Paper: {title}\n\n{context}\n\nAnswer these items as JSON:\n{items}"
CRITIC_PROMPT = "Parameter: {parameter}\nFlags: {flags}\nCell: {cell}\n\nAnswer ok, fix, reject or uncertain, and why, as JSON."


def link(df: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """df with canonical_name, concept_id and match_type from names (alias,
    canonical_name, concept_id) of an ontology, by the column's normal form;
    rows without a concept keep their own name and are unmatched."""
    from ..functions.text import normal_identifier

    n = names.withColumn("_a", normal_identifier(F.col("alias"))).groupBy("_a").agg(F.min_by("canonical_name", "concept_id").alias("canonical_name"), F.min("concept_id").alias("concept_id"))
    out = df.withColumn("_a", normal_identifier(F.col(column))).join(n, "_a", "left").drop("_a")
    return out.withColumns({"match_type": F.when(F.col("concept_id").isNotNull(), "matched").otherwise("unmatched"), "canonical_name": F.coalesce("canonical_name", column)})


def relevant(scores: DataFrame, text: str, score: str = "score", least: float = 0.25, short: int = 50) -> DataFrame:
    """Rows that a learned filter's score keeps; short texts stay unasked."""
    return scores.filter((F.length(F.coalesce(text, F.lit(""))) < short) | (F.col(score) >= least))


#: What a template says where an answer should stand.
ECHOES = {"name": ("parameter name", "parameter_name"), "compound": ("chemical compound", "compound", "null", "none"), "species": ("species", "null", "none"), "symbol": ("parameter symbol", "symbol", "null", "none")}
RECORD = "array<struct<name: string, parameter_name: string, symbol: string, value: double, start_value: double, end_value: double, unit: string, compound: string, species: string, ci_low: double, ci_high: double>>"


def template_records(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, name, symbol, value, start_value, end_value, unit, compound,
    species, ci_low, ci_high) of answers that fill a template.

    The list stands under parameters or model_parameters.  A range without a
    value has its middle; what has no value, or a name that is the template's
    own, is left out; other echoes of the template are nothing; species is
    human and the unit dimensionless where none is given.
    """
    body = F.regexp_extract(F.col(text), r"(?s)\{.*\}", 0)
    listed = F.coalesce(*(F.from_json(F.get_json_object(body, f"$.{k}"), RECORD) for k in ("parameters", "model_parameters")))
    x = df.select(key, F.posexplode(listed).alias("pos", "r")).select(key, "pos", "r.*")
    own = lambda c: F.when(~F.lower(c).isin(*ECHOES[c]), F.col(c))
    name = F.coalesce(F.nullif("name", F.lit("")), "parameter_name", F.lit(""))
    value = F.coalesce("value", (F.col("start_value") + F.col("end_value")) / 2)
    x = x.withColumns({"name": name, "value": value}).filter("value IS NOT NULL").filter(~F.exists(F.array(*map(F.lit, ECHOES["name"])), lambda w: F.contains(F.lower("name"), w)))
    return x.select(key, "pos", "name", own("symbol").alias("symbol"), "value", "start_value", "end_value", F.coalesce(F.nullif("unit", F.lit("")), F.lit("dimensionless")).alias("unit"), own("compound").alias("compound"), F.coalesce(own("species"), F.lit("human")).alias("species"), "ci_low", "ci_high")
