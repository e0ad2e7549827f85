"""Operators on small rows with known results."""

import random
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import classify, numbers, units
from tessera.functions import text as T
from tessera.functions.python import repaired
from tessera.operators import assembly, assess, evidence, extract, inference, match, repair, retrieve, rules, segments, series
from tessera.sources import documents, sinks, tables


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("text,want", [("56.9 - 70 (gestation)", (56.9, 70.0, "gestation")), ("1 – 2", (1.0, 2.0, None)), ("70", (None, None, None)), (None, (None, None, None))])
def test_range_cells(spark, text, want):
    assert tuple(one(spark, text, numbers.span)) == want


@pytest.mark.parametrize("text,want", [("70 (65, 75)", (70.0, 65.0, 75.0)), ("70", (None, None, None)), ("5d (1, 2)", (None, 1.0, 2.0)), ("range (1, 2) of 3", (None, 1.0, 2.0))])
def test_estimates(spark, text, want):
    assert tuple(one(spark, text, numbers.estimate)) == want


@pytest.mark.parametrize("text,want", [("5d", None), ("nan", None), ("1_000", None), ("1e3", 1000.0), ("-.5", -0.5), ("", None), (None, None)])
def test_numbers_are_gated(spark, text, want):
    assert one(spark, text, numbers.gated_double) == want


@pytest.mark.parametrize("form,text,want", [
    (T.normal_text, "  A  B ", "a b"), (T.normal_identifier, "CL/F (h)", "clfh"), (T.normal_unit, "L*h^-1", "/lh"), (T.normal_unit, "mg per L", "mg/l"),
    (T.normal_unit, "µg", "ug"), (T.table_form, "Table S1: doses", "tables1"), (T.verification_form, "1 – 2", "1-2"), (T.symbol_form, "k a (1/h)", "k_a_1_h"),
    (T.symbol_form, None, "param"), (T.doi, "https://doi.org/10.1000/ABC.1.", "10.1000/abc.1"), (T.without_fences, "<think>x</think>```json\n{\"a\": [1,],}\n```", '{"a": [1]}'),
])
def test_normal_forms(spark, form, text, want):
    assert one(spark, text, form) == want


def test_matching_of_a_set_with_itself_is_perfect(spark):
    rows = [(1, i, f"n{i}", "s", "A") for i in range(5)]
    df = spark.createDataFrame(rows, "doc long, ord int, name string, symbol string, species string")
    got = match.one_to_one(match.candidates(df, df, "doc", [("name", 8)], ["species"]), "doc").collect()
    assert {(r.ref, r.pred) for r in got} == {(i, i) for i in range(5)}


def test_titles_without_words_are_like_none(spark):
    from tessera.functions.python import title_ratio

    df = spark.createDataFrame([(None, None), ("", "x"), ("漢字", "仮名"), ("A title", " a TITLE ")], "a string, b string")
    assert [r.r > 0.8 for r in df.select(title_ratio("a", "b").alias("r")).collect()] == [False, False, False, True]


def test_conflicting_context_kills_and_ties_are_left_out(spark):
    s = "doc long, ord int, name string, species string"
    ref = spark.createDataFrame([(1, 0, "a", "rat"), (1, 1, "b", ""), (1, 2, "b", "")], s)
    pred = spark.createDataFrame([(1, 0, "a", "human"), (1, 1, "b", "rat"), (1, 2, "c", "")], s)
    pairs = match.candidates(ref, pred, "doc", [("name", 8)], ["species"])
    assert pairs.filter("pred = 0").count() == 0
    assert match.one_to_one(pairs, "doc").count() == 0
    assert match.best(pairs, "doc").filter("ties = 2").count() == 2


def test_greedy_takes_each_reference_once(spark):
    pairs = spark.createDataFrame([(1, p, r) for p in range(3) for r in range(2)] + [(2, 0, 5)], "doc long, pred int, ref int")
    got = match.greedy(pairs, "doc").collect()
    assert sorted((r.doc, r.pred, r.ref) for r in got) == [(1, 0, 0), (1, 1, 1), (2, 0, 5)]


def taken_in_order(pairs):
    """The sequential greedy, a prediction after another."""
    out, used, done = set(), set(), set()
    for d, p, r in sorted({x for x in pairs if None not in x}):
        if (d, p) not in done and (d, r) not in used:
            done.add((d, p))
            used.add((d, r))
            out.add((d, p, r))
    return out


def test_greedy_in_rounds_is_the_sequential_one(spark):
    r = random.Random(11)
    pairs = [(d, r.randrange(25), r.randrange(25)) for d in range(40) for _ in range(r.choice((3, 30, 200)))]
    pairs += [(100, p, q) for p in range(60) for q in (p, p + 1)]  # a chain: each is free for the next
    pairs += [(101, p, q) for p in range(40) for q in range(40 - p)] + [(102, None, 1), (102, 1, None), (None, 1, 1)]
    pairs += [(103, p, q) for p in range(317) for q in range(316)]  # 100,000 pairs of one document, all acceptable
    got = [tuple(x) for x in match.greedy(spark.createDataFrame(pairs, "doc long, pred int, ref int"), "doc").collect()]
    assert len(got) == len(set(got)) and set(got) == taken_in_order(pairs)
    assert match.greedy(spark.createDataFrame([], "doc long, pred int, ref int"), "doc").count() == 0


def test_names_and_symbols_are_sets_and_tables_a_bonus(spark):
    s = "doc long, ord int, names array<string>, symbols array<string>, species string, source string"
    ref = spark.createDataFrame([(1, 0, ["clearance", "cl"], ["cl"], "rat", "t1"), (1, 1, ["volume"], [], None, None)], s)
    pred = spark.createDataFrame([(1, 0, ["cl"], ["cl"], "", "t1"), (1, 1, ["", "volume"], None, "rat", "t2"), (1, 2, ["cl"], [], "human", "t1")], s)
    got = match.candidates(ref, pred, "doc", [("names", 8), ("symbols", 7)], ["species"], ["source"]).collect()
    assert sorted((r.ref, r.pred, r.score) for r in got) == [(0, 0, 17), (1, 1, 8)]


def test_duplicate_ids_skip_taken_suffixes(spark):
    df = spark.createDataFrame([(x, i) for i, x in enumerate(("a", "a", "a_2", "a_4", "a", "a", None, None, "b_2", "b_2"))], "id string, o int")
    ids = {r.o: r.id for r in repair.unique_ids(df, "id", ["o"]).collect()}
    assert [ids[i] for i in range(6)] == ["a", "a_3", "a_2", "a_4", "a_5", "a_6"] and (ids[8], ids[9]) == ("b_2", "b_2_2")


def test_same_value_is_a_duplicate_another_a_conflict(spark):
    df = spark.createDataFrame([("CL", 0.05, 1), ("CL", 0.05, 2), ("CL", 0.06, 3)], "k string, v double, o int")
    assert {(r.o, r.rule) for r in repair.conflicts(df, ["k"], "v", ["o"]).collect()} == {(2, "DUPLICATE_ENTRY"), (3, "CONFLICTING_ENTRY")}


def test_dedup_is_idempotent(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, o int")
    once = repair.keep_first(df, ["k"], ["o"])
    assert once.collect() == repair.keep_first(once, ["k"], ["o"]).collect()


def test_inheritance_takes_one_donor_a_compound(spark):
    rows = [
        ("c", "V", "rat", 1.0, 1), ("C", "Q", "monkey", 2.0, 2), ("c", "Bw", "monkey", 3.0, 3), ("c", "CL", "Human", 4.0, 4), ("c", "Q", "monkey", 5.0, 5), ("c", "CL", "monkey", 9.0, 6),
        ("d", "V", "rat", 6.0, 7), (None, "V", "rat", 7.0, 8), (None, "K", "human", 8.0, 9), ("c", "", "monkey", 1.0, 10),
    ]
    df = spark.createDataFrame(rows, "compound string, symbol string, species string, value double, ord int")
    got = repair.inherit(df, [], "compound", "symbol", "species", "ord").filter("donor IS NOT NULL").collect()
    assert sorted((str(r.compound), r.symbol, r.species, r.value, r.donor) for r in got) == [("None", "V", "human", 7.0, "rat"), ("c", "Q", "human", 5.0, "monkey")]


def test_class_views_hold_every_row_once(spark):
    df = spark.createDataFrame([("physiological",), ("x",), (None,)], "c string")
    a, b = repair.class_views(df, "c", "physiological")
    assert (a.count(), b.count()) == (1, 2)


FLAT = (
    "doc long, ord int, name string, name_original string, symbol string, compound string, class string, subclass string, unit string, value double, value_text string, low double, high double, "
    "start_value double, end_value double, quote string, confidence string, directness string, derivation string, source_table string, row_id string, column_id string, cell_id string, "
    "row_path array<string>, column_path array<string>, species string, organ string, life_stage string, population string, formulation array<string>"
)
PATHS = "array<struct<{}: string, path: array<string>>>"
TABLE = (
    "doc long, table_ord int, table_id string, title string, status string, subjects array<string>, footnotes array<string>, referenced array<string>, table_species array<string>, "
    f"rows {PATHS.format('row_id')}, columns {PATHS.format('column_id')}, cells array<struct<cell_id: string, row_id: string, column_id: string, text: string, numeric_value: double>>"
)
ROW = dict(doc=1, ord=1, name="clearance", symbol="CL", compound="PFOS", subclass="clearance", unit="L/h", value=5.0, value_text="5", source_table="Table 1", row_path=["clearance"], column_path=["PFOS"], species="Human", quote="q", confidence="high")
CITED = dict(doc=1, table_ord=1, table_id="Table 1: values", title="t", status="complete", subjects=["pfos "], footnotes=[], referenced=[], table_species=["human"], rows=[("r1", ["clearance"])], columns=[("k1", ["PFOS"]), ("k2", ["PFOA"])], cells=[("c1", "r1", "k1", "5", 5.0)])


@pytest.mark.parametrize("change,table,want", [
    ({}, {}, []), ({"name": " "}, {}, ["MISSING_NAME"]), ({"unit": None}, {}, ["MISSING_UNIT", "INVALID_UNIT_DIMENSION"]), ({"value_text": "9 a"}, {}, ["VALUE_MISMATCH"]), ({"value_text": "nd"}, {}, []),
    ({"value": 6000.0, "value_text": None}, {"cells": [("c1", "r1", "k1", "6000", 6000.0)]}, ["IMPLAUSIBLE_VALUE"]), ({"low": 1.0}, {}, ["INCOMPLETE_UNCERTAINTY"]),
    ({"value": -5.0, "value_text": "−5"}, {"cells": [("c1", "r1", "k1", "-5", -5.0)]}, ["IMPLAUSIBLE_VALUE", "NEGATIVE_VALUE"]),
    ({"value": -5.0, "value_text": "-5", "quote": "Sensitivity"}, {"cells": [("c1", "r1", "k1", "-5", -5.0)]}, ["IMPLAUSIBLE_VALUE"]),
    ({"source_table": "Table 9"}, {}, ["SOURCE_TABLE_EVIDENCE_MISSING"]), ({}, {"status": "failed"}, ["SOURCE_TABLE_RECONSTRUCTION_FAILED"]), ({"species": "rat"}, {}, ["SOURCE_TABLE_SPECIES_MISMATCH"]),
    ({"cell_id": "c1"}, {"cells": [("c1", "r1", "k1", "7", 7.0)]}, ["CELL_VALUE_MISMATCH"]), ({}, {"cells": [("c1", "r1", "k1", "7", 7.0)]}, ["CELL_NOT_FOUND_IN_SOURCE_TABLE"]),
    ({"quote": "held constant in rats"}, {"cells": [("c1", "r1", "k1", "7", 7.0)]}, []), ({"quote": ""}, {}, ["MISSING_QUOTE_HIGH_CONF"]), ({"row_path": [], "column_path": None}, {}, ["MISSING_TABLE_HIERARCHY"]),
    ({"cell_id": "c1"}, {"subjects": ["PFOS", "PFOA"], "cells": [("c1", "r1", "k2", "5", 5.0)]}, ["CELL_COMPOUND_MISALIGNMENT"]),
    ({}, {"subjects": ["PFOA"], "footnotes": ["PFOS"]}, ["FOOTNOTE_ONLY_COMPOUND"]), ({}, {"subjects": ["PFOA"], "referenced": ["PFOS"]}, ["REFERENCED_ONLY_COMPOUND"]), ({}, {"subjects": []}, []),
    ({"column_path": ["PFOA"]}, {"subjects": ["PFOA"]}, ["COMPOUND_COLUMN_CONFLICT", "SOURCE_TABLE_COMPOUND_MISMATCH"]), ({"column_path": ["x"]}, {"title": "Of pfos"}, []),
    ({"compound": None}, {}, ["MISSING_COMPOUND"]), ({"compound": None, "class": "Physiological"}, {}, []), ({"compound": "Analyte 1", "column_path": ["analyte 1"]}, {"subjects": []}, ["PLACEHOLDER_COMPOUND"]),
])
def test_rules(spark, change, table, want):
    p, t = spark.createDataFrame([ROW | change], FLAT), spark.createDataFrame([CITED | table], TABLE)
    assert [r.rule for r in rules.flags(rules.prepared(p, t, "doc"), rules.parameter_rules(), ["ord"]).collect()] == want


def test_repeats_of_a_key_are_duplicates_or_conflicts(spark):
    rows = [ROW | {"ord": i, "source_table": None} | c for i, c in enumerate(({}, {"compound": "pfos"}, {"value": 6.0, "value_text": "6"}, {"formulation": ["IV"]}, {"value": None}, {"name": "x", "value": None}, {"name": "x", "value": None}))]
    found = rules.flags(rules.prepared(spark.createDataFrame(rows, FLAT), spark.createDataFrame([CITED], TABLE), "doc"), rules.parameter_rules(), ["ord"])
    got = {r.ord: r.rule for r in found.filter("rule LIKE '%_ENTRY'").collect()}
    assert got == {1: "DUPLICATE_ENTRY", 2: "CONFLICTING_ENTRY", 4: "CONFLICTING_ENTRY", 6: "DUPLICATE_ENTRY"}


def test_minorities_of_a_table(spark):
    rows = [ROW | {"ord": i, "name": f"n{i}"} for i in range(7)] + [ROW | {"ord": 9, "compound": "PFOA", "name": "y"}]
    found = rules.flags(rules.prepared(spark.createDataFrame(rows, FLAT), spark.createDataFrame([CITED], TABLE), "doc"), rules.parameter_rules(), ["ord"])
    assert [r.ord for r in found.filter("rule = 'MINORITY_COMPOUND_IN_TABLE'").collect()] == [9]


def test_the_cell_whose_paths_speak_most(spark):
    t = CITED | {"rows": [("r1", ["Vd"]), ("r2", ["clearance"])], "cells": [("a", "r1", "k1", "5", 5.0), ("b", "r2", "k2", "5.1", 5.1), ("c", "r2", "k1", "5 a", None), ("d", "r2", "k1", "5", 5.0)]}
    pick = lambda **c: evidence.match_cell(spark.createDataFrame([ROW | c], FLAT), spark.createDataFrame([t], TABLE), "doc").select("cell.cell_id").first().cell_id
    assert pick() == "c" and pick(cell_id="a") == "a" and pick(row_id="r2", column_id="k2") == "b" and pick(value=None, value_text="none") is None
    assert pick(cell_id="gone", compound="PFOA", column_path=["PFOA"]) == "b"


def test_cells_by_keys_are_those_of_all_pairs(spark):
    """Numbers near each other, near zero and of either sign, texts in one
    another, with and without numbers on either side: every pair is looked at."""
    r = random.Random(7)
    number = lambda: r.choice((None, 0.0, 5e-10, r.uniform(-2e-6, 2e-6), r.choice((1, -1)) * 10 ** r.uniform(-7, 6)))
    word = lambda: r.choice(("nd", "not done", "done", "abc", "xabcx", "ab", "see note", "note", "", "  ", "5 a", "1e-7", "-3"))
    base = [number() or 1.0 for _ in range(30)]
    value = lambda: r.choice((None, number(), r.choice(base) * r.uniform(0.96, 1.04), r.choice(base)))
    tables_, rows = [], []
    for d in range(25):
        of = [(f"c{i}", "", "", word(), value()) for i in range(r.choice((1, 4, 12)))]
        tables_.append(CITED | {"doc": d, "cells": of, "rows": [], "columns": []})
        rows += [ROW | {"doc": d, "ord": i, "value": value(), "value_text": word(), "cell_id": None, "row_id": None, "column_id": None} for i in range(12)]

    def scraped(t):
        import re

        x = re.sub(r"[^0-9.\-eE+]", "", t.split()[0]) if t.split() else ""
        return float(x) if re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", x) else None

    want = {}
    for p in rows:
        low, num = p["value_text"].strip().lower(), p["value"] if p["value"] is not None else scraped(p["value_text"].strip())
        for c, _, _, text, v in tables_[p["doc"]]["cells"]:
            other, n = text.strip().lower(), v if v is not None else scraped(text.strip())
            near = num is not None and n is not None and abs(num - n) <= max(abs(num), abs(n)) * 0.03 + 1e-9
            alike = (num is None or n is None) and low and other and (low == other or min(len(low), len(other)) >= 3 and (low in other or other in low))
            if near or alike:
                want[p["doc"], p["ord"]] = c
                break
    got = evidence.match_cell(spark.createDataFrame(rows, FLAT), spark.createDataFrame(tables_, TABLE), "doc").collect()
    assert {(x.doc, x.ord): x.cell.cell_id for x in got if x.cell} == want and len(got) == len(rows)


def test_the_last_table_of_a_name_is_cited(spark):
    t = spark.createDataFrame([CITED, CITED | {"table_ord": 2, "table_id": "Table 1"}], TABLE)
    p = spark.createDataFrame([ROW | {"ord": i, "source_table": s} for i, s in enumerate(("table 1", "Table 1", "Table 1: values", "Figure 1", None))], FLAT)
    got = {r.ord: r.table_id for r in evidence.cite(p, t, "doc").select("ord", "evidence.table_id").collect()}
    assert got == {0: "Table 1", 1: "Table 1", 2: "Table 1: values", 3: None, 4: None}


def test_records_of_a_table(spark):
    """A group's header gives its unit to the rows below; outcomes give none."""
    cells = [("a", "r0", "k0", "Blood flow (fraction)", None), ("b", "r1", "k0", "QLC", None), ("c", "r1", "k3", "Liver flow", None), ("d", "r1", "k1", "0.2 (0.1, 0.3)", 0.2), ("e", "r1", "k2", "Brown", 1.0), ("f", "r2", "k3", "Weight (kg)", None), ("g", "r2", "k1", "1 - 2", None), ("h", "r2", "k4", "70", 70.0)]
    columns = [("k0", ["Symbol"]), ("k1", ["PFOS"]), ("k2", ["Source"]), ("k3", ["Variable"]), ("k4", ["Mean"])]
    t = CITED | {"columns": columns, "cells": cells, "subjects": ["PFOA"]}
    make = lambda **c: assembly.from_tables(spark.createDataFrame([t | c], TABLE), "doc", ("PFOS",))
    got = {(r.row_id, r.column_id): (r.name, r.symbol, r.compound, r.unit, r.value, r.low, r.high, r.start_value) for r in make().collect()}
    assert got == {("r1", "k1"): ("Liver flow", "QLC", "PFOS", "fraction", 0.2, 0.1, 0.3, None), ("r2", "k1"): ("Weight (kg)", None, "PFOS", "kg", None, 1.0, 2.0, 1.0), ("r2", "k4"): ("Weight (kg)", None, "PFOA", "kg", 70.0, None, None, None)}
    assert make(title="Sensitivity of AUC").count() == 0 and make(status="failed").count() == 0


def test_the_steps_in_their_order(spark):
    p = [ROW | {"ord": 1, "species": "rat"}, ROW | {"ord": 2, "species": "rat"}, ROW | {"ord": 3, "name": "weight", "name_original": "weight", "symbol": "W", "value": None, "value_text": "1 - 2", "unit": None, "subclass": "body_weight"}, ROW | {"ord": 4, "name": "contact angle"}, ROW | {"ord": 5, "value": None, "value_text": None}]
    df = spark.createDataFrame(p, FLAT).withColumns({"unit_standardized": F.col("unit"), "reference": F.lit("Optimized"), "status": F.lit(None).cast("string"), "source_text": F.concat_ws(" ", "symbol", "value_text"), "name_original": F.col("name")})
    got = sorted(assembly.post_process(df, spark.createDataFrame([CITED], TABLE)).collect(), key=lambda r: (r.ord, str(r.donor)))
    assert [(r.ord, r.species, r.donor) for r in got] == [(1, "rat", None), (2, "human", "rat"), (3, "Human", None)]
    assert {r.symbol: (r.value, r.start_value, r.end_value, r.status, r.row_id) for r in got if r.symbol == "W"} == {"W": (None, 1.0, 2.0, "fitted", None)}
    assert len({r.parameter_id for r in got}) == len(got) and {r.cell_id for r in got if r.symbol == "CL"} == {"cell_r1_k1"}


def test_units_of_names_and_headers(spark):
    cases = [("Flow (fraction)", "fraction"), ("x (a b c d)", None), ("x (abcdefghijklmnopqrstuvwxyz)", None), ("none", None)]
    got = [r.u for r in spark.createDataFrame([(c,) for c, _ in cases], "x string").select(units.group_unit(F.col("x")).alias("u")).collect()]
    assert got == [w for _, w in cases]
    errors = [(["a", "b"], "missing", None), (["c"], "wrong", "x" * 50)] * 4
    text = spark.createDataFrame([(errors,)], "e array<struct<path: array<string>, message: string, received: string>>").select(T.first_errors(F.col("e")).alias("t")).first().t
    assert text.splitlines()[:2] == ["- Location 'a -> b': missing", "- Location 'c': wrong (received: '" + "x" * 40 + "')"] and len(text.splitlines()) == 5


def test_four_checks(spark):
    cols = "symbol string, value_text string, source_text string, value double, low double, high double, unit string, subclass string, location string, reference string, status string"
    df = spark.createDataFrame([("ka", "0.5", "the ka 0.5 1/h", 0.5, None, None, "h^-1", "absorption_rate", "p. 1", "ref", "measured"), ("ka", "0.6", "ka 0.5", None, None, None, "kg", "absorption_rate", "", None, None)], cols)
    a, b = rules.four_checks(df).collect()
    assert (a.verification_score, a.needs_review, a.verification_failures) == (1.0, False, [])
    assert (b.verification_score, b.needs_review, len(b.verification_failures)) == (0.0, True, 4)


def test_questionnaire_of_an_empty_document(spark):
    docs = spark.createDataFrame([(1,)], "doc long")
    none = spark.createDataFrame([(1, "TAN_2.1.1", "yes", None, None), (1, "unknown", "yes", "q", "p")], "doc long, item_id string, response string, quote string, location string")
    got = assess.questionnaire(docs, none, "doc").collect()
    assert len(got) == 36 and [r.item_id for r in got if r.response == "yes"] == ["TAN_1.3"]


def test_relevance_by_title_then_words(spark):
    df = spark.createDataFrame([("x", "Funding"), ("x", "Methods"), ("model dose plasma", ""), ("model", ""), (None, None)], "t string, h string")
    got = [r.k for r in df.select(classify.relevant(F.col("t"), F.col("h"), (r"\bAUC\b",)).alias("k")).collect()]
    assert got == [False, True, True, False, False]


@pytest.mark.parametrize("text,want", [
    ('Sure: {"a": [1, 2,], "b": {"c": "x"},}', {"a": [1, 2], "b": {"c": "x"}}), ('{"a": [{"v": 1}, {"v": 2}, {"v"', {"a": [{"v": 1}, {"v": 2}, {}]}),
    ('[{"a": 1}, {"a"', [{"a": 1}, {}]), ("no json", None), ("", None),
])
def test_cut_json_is_repaired(text, want):
    got = repaired(text)
    assert (got and json.loads(got)) == want or (want is not None and json.loads(got) in (want, {"a": [{"v": 1}, {"v": 2}]}, [{"a": 1}]))


def test_model_failures_are_rows(spark):
    def model(texts):
        if "bad" in texts:
            raise ValueError("no")
        return ["[]" for _ in texts]

    got = inference.run(spark.createDataFrame([("a",), ("bad",), (None,)], "t string"), "t", model).select("answer.*").collect()
    assert sorted(r.ok for r in got) == [False, True, True]


def test_interpolation_is_numpys_and_goes_on_outside(spark):
    curve = spark.createDataFrame([("s", float(t), float(t * t)) for t in range(5)], "s string, t double, y double")
    ask = spark.createDataFrame([("s", x) for x in (0.5, 2.0, 3.25, 5.0, -1.0)], "s string, t double")
    got = {r.t: r.y for r in series.interpolate(curve, ask, "s", "t", "y").collect()}
    for x in (0.5, 2.0, 3.25):
        assert got[x] == pytest.approx(np.interp(x, range(5), [t * t for t in range(5)]))
    assert got[5.0] == pytest.approx(16 + 7) and got[-1.0] == pytest.approx(-1)


def test_simulation_of_one_compartment_is_exponential(spark):
    m = spark.createDataFrame([(1, 10.0, None, None, 2.0, None, None, None, 100.0)], "k long, v1 double, v2 double, v3 double, cl double, q double, q2 double, ka double, dose double")
    for r in series.simulate(m, "k", 10.0, 11).collect():
        assert r.central == pytest.approx(100 * np.exp(-0.2 * r.time))


def test_model_text(spark):
    p = spark.createDataFrame([(1, "Vc", 10.0, 1), (1, "k a", 0.5, 2), (1, "Vc", 11.0, 3)], "k long, s string, v double, o int")
    text = series.model_text(p, "k", "s", "v", "o").first().text
    assert "Vc = 10.0;" in text and "Vc_2 = 11.0;" in text and "Elimination" in text


def test_max_sim(spark):
    df = spark.createDataFrame([([[1.0, 0.0], [0.0, 1.0]], [[0.5, 0.5], [0.0, 2.0]])], "q array<array<double>>, p array<array<double>>")
    assert df.select(retrieve.max_sim(F.col("q"), F.col("p")).alias("s")).first().s == 2.5


def test_grid_with_spans_gives_one_record(spark):
    t = '<table><tr><th>Species</th><th>Variable</th><th>Name</th><th>Mean (95% CI) PFOS</th><th>Source</th></tr><tr><td>human</td><td>BW</td><td>Body weight (kg)</td><td>70 (65, 75)</td><td>Optimized</td></tr></table>'
    ev = tables.evidence(tables.cells(spark.createDataFrame([(1, t), (2, None)], "k long, m string"), "k", "m"), ["k", "table_ord"])
    (r,) = tables.unroll(ev, ["k", "table_ord"], compounds=("PFOS",)).collect()
    assert (r.name, r.symbol, r.species, r.compound, r.value, r.ci_low, r.ci_high, r.unit, r.status) == ("Body weight (kg)", "BW", "human", "PFOS", 70.0, 65.0, 75.0, "kg", "fitted")
    assert tables.markdown(tables.cells(spark.createDataFrame([(1, t)], "k long, m string"), "k", "m"), ["k", "table_ord"]).first().text.startswith("| Species |")


def test_spans_fill_their_places_and_end_with_the_table(spark):
    t = "<table><tr><td rowspan=9 colspan=2>a</td><td>b</td></tr><tr><td>c<table><tr><td>in</td></tr></table></td></tr></table><table><tr><td rowspan=0>x</td></tr><tr><td>y</td></tr></table>"
    wide = "<table><tr><th colspan=5000>h</th></tr></table>"
    df = spark.createDataFrame([(1, t), (2, wide), (3, "<td>no table</td>")], "k long, m string")
    got = {}
    for r in tables.cells(df, "k", "m").collect():
        got.setdefault((r.k, r.table_ord), []).append((r.r, r.c, r.text))
    assert sorted(got[1, 0]) == [(0, 0, "a"), (0, 1, "a"), (0, 2, "b"), (1, 0, "a"), (1, 1, "a"), (1, 2, "c")] and got[1, 1] == [(0, 0, "in")]
    assert sorted(got[1, 2]) == [(0, 0, "x"), (1, 0, "x"), (1, 1, "y")] and len(got[2, 0]) == 1000 and (3, 0) not in got


def test_budget_and_sentences(spark):
    b = spark.createDataFrame([(1, 0, 0, "aaaa"), (1, 1, 0, "bbbbbbbb"), (1, 2, 0, "cc")], "d long, pos int, priority int, block string")
    assert {r.pos for r in segments.within_budget(b, "d", 7).collect()} == {0, 2}
    s = segments.sentences(spark.createDataFrame([(1, "One. Two 2! Three. Two 2!")], "d long, t string"), "d", "t")
    assert [r.pos for r in segments.with_context(s, "d", F.col("sentence").rlike("[0-9]")).orderBy("pos").collect()] == [0, 1, 2]


def test_boxes_and_titles(spark):
    rows = [("Table", 0.9, 100.7, 110.0, 400.0, 300.0), ("table", 0.3, 20.0, 200.0, 300.0, 950.0), ("table", 0.9, 0.0, 0.0, 1000.0, 1000.0), ("figure", 0.9, 0.0, 0.0, 500.0, 500.0), ("table", 0.29, 0.0, 0.0, 500.0, 500.0), ("table", 0.9, 5.0, 0.0, 20.0, 900.0)]
    b = spark.createDataFrame([(1, *r, 1000, 1000) for r in rows], "p long, label string, score double, x0 double, y0 double, x1 double, y1 double, width int, height int")
    assert tuple(extract.good_boxes(b, "p").first())[1:] == (0, 10, 450, 1000, 0.9, 2)
    lines = ["short", "A. Author 1, B. Author 2, C. Author 3, D. Author", "Department 12345 of 67890 things", "A model of the kinetics of a thing", "Another line that would do as well"]
    x = spark.createDataFrame([(1, i, t) for i, t in enumerate(lines)], "k long, pos int, line string")
    assert extract.title_line(x, "k").first().title == lines[3]


def test_files_and_sinks(spark, tmp_path):
    doc = {"title": "t", "parameters": [{"parameter_id": "p1", "context": {"subject_species": "rat", "organ": "liver"}, "quantitative_data": {"value": 8}}]}
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text(json.dumps(doc))
    (tmp_path / "in/b.json").write_text("not json")
    docs = documents.json_documents(spark, str(tmp_path / "in"))
    assert sorted(r.title is None for r in docs.select("path", "title", "_corrupt_record").collect()) == [False, True]
    (p,) = documents.parameters(docs.filter("title IS NOT NULL")).collect()
    assert (p.context.species, p.context.compartment, p.quantitative_data.value) == ("rat", "liver", 8.0)
    for i, body in enumerate(({"x": "p"}, {"predictions": {"x": "p"}}, {"predictions": [{"paper_id": "x", "prediction_path": "p"}]})):
        (tmp_path / f"m{i}.json").write_text(json.dumps(body))
        assert [tuple(r) for r in documents.prediction_manifest(spark, str(tmp_path / f"m{i}.json")).collect()] == [("x", "p")]
    sinks.write_quoted_csv(spark.createDataFrame([('a "b"', 1)], "x string, y int"), str(tmp_path / "csv"))
    lines = [x for part in sorted((tmp_path / "csv").glob("part-*")) for x in part.read_text().splitlines()[1:]]
    assert lines[0] == '"a ""b""","1"'
    assert sinks.markdown_table(spark.createDataFrame([(2, "b"), (1, "a")], "n int, x string"), ["n", "x"], ["n"]).first().text.splitlines()[2] == "| 1 | a |"


def test_xml_metadata(spark):
    x = "<article><title-group><article-title>T</article-title></title-group><journal-title>J</journal-title><contrib><name><surname>B</surname><given-names>A</given-names></name></contrib><pub-date><year>2020</year></pub-date></article>"
    r = documents.xml_metadata(spark.createDataFrame([(x,)], "xml string")).first()
    assert (r.title, r.journal, r.year, r.authors) == ("T", "J", 2020, ["A B"])


def test_incremental_run_takes_each_chunk_once(spark, tmp_path):
    from tessera.streaming import incremental

    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    make = lambda ids: spark.createDataFrame([(i, "x") for i in ids], "chunk_id int, t string").withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    for ids in ((1, 2), (2, 3)):
        make(ids).write.mode("append").parquet(src)
        incremental.run(incremental.new_chunks(spark, src, "chunk_id int, t string, ts timestamp"), lambda b: b, out, ck).awaitTermination()
    assert sorted(r.chunk_id for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_texts_of_one_key_have_their_own_places(spark):
    from tessera.operators import segments

    df = spark.createDataFrame([(1, "a 12 b 345"), (1, "cc 12 d"), (2, None)], "k int, t string")
    got = sorted(map(tuple, segments.matches(df, "k", "t", "[0-9]+", 2).collect()))
    assert got == [(1, 2, "12", "a 12 b"), (1, 3, "12", "c 12 d"), (1, 7, "345", "b 345")]


def test_a_citation_binds_by_its_normal_form(spark):
    p, t = spark.createDataFrame([ROW | {"source_table": "TABLE  1", "name_original": "clearance"}], FLAT), spark.createDataFrame([CITED], TABLE)
    assert evidence.bind(evidence.cite(p, t, "doc")).first().cell_id == "cell_r1_k1"


def test_joins_of_cells_are_never_broadcast(spark):
    p, t = spark.createDataFrame([ROW], FLAT), spark.createDataFrame([CITED], TABLE)
    found = rules.flags(rules.prepared(p, t, "doc"), rules.parameter_rules(), ["doc", "ord"])
    found.collect()
    listed = rules.flags_by_row(p.select("doc", "ord"), found, ["doc", "ord"])
    for df in (found, listed, rules.report(found, p, "doc", "ord")):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_cells_by_keys_are_those_of_small_tables(spark, monkeypatch):
    cells = [("a", "r1", "k1", "5", 5.0), ("b", "r1", "k2", "5.1", 5.1), ("c", "r1", "k1", "abc def", None), ("d", "", "", "xx", None)]
    p = spark.createDataFrame([ROW | {"ord": i, "value": v, "value_text": x, "cell_id": None, "row_id": None, "column_id": None} for i, (v, x) in enumerate(((5.0, "5"), (None, "bc d"), (None, "xx"), (9.0, "9"), (None, "")))], FLAT)
    t = spark.createDataFrame([CITED | {"cells": cells}], TABLE)
    picked = lambda: sorted(map(tuple, evidence.match_cell(p, t, "doc").select("ord", "cell.cell_id").collect()))
    few = picked()
    monkeypatch.setattr(evidence, "FEW", 0)
    assert few == picked() == [(0, "a"), (1, "c"), (2, "d"), (3, None), (4, None)]


def test_parts_grow_with_the_lines(spark, monkeypatch):
    from tessera.plans import common, verification
    from tests.conftest import DATA

    monkeypatch.setattr(common, "LINES_A_TASK", 300)
    assert common.lines(spark, DATA, dealt=True).rdd.getNumPartitions() == 20
    monkeypatch.setattr(verification, "LINES_A_TASK", 400)
    base, n = verification.based(spark, DATA)
    assert n == base.rdd.getNumPartitions() == 15


def test_copies_and_ids_stay_with_the_deal_by_document(spark):
    """Rows dealt by document go through both steps with that deal alone."""
    df = spark.createDataFrame([(1, 1, "PFOA", "CL", "rat", "a"), (1, 2, "PFOA", "CL", "rat", "a"), (1, 3, "PFOA", "V", "human", "a_2"), (None, 4, "PFOA", "V", "human", "a")], "doc int, ord int, compound string, symbol string, species string, id string").repartition(4, "doc")
    plan = lambda x: x._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    lent, ids = repair.inherit(df, ["doc"], "compound", "symbol", "species", "ord"), repair.unique_ids(df, "id", ["ord"], ["doc"])
    assert "Union" not in plan(lent) and plan(lent).count("Exchange") == 2 and plan(ids).count("Exchange") == 1
    assert sorted((r.ord, r.species, str(r.donor)) for r in lent.collect()) == [(1, "rat", "None"), (2, "human", "rat"), (2, "rat", "None"), (3, "human", "None"), (4, "human", "None")]
    assert sorted((r.ord, r.id) for r in ids.collect()) == [(1, "a"), (2, "a_3"), (3, "a_2"), (4, "a")]


def test_a_citation_carries_the_first_row_of_each_path(spark):
    path = ["Rat", "CL"]
    t = spark.createDataFrame([CITED | {"rows": [{"row_id": f"r{i}", "path": p} for i, p in enumerate((["V"], path, path, None, ["V"], []))]}], TABLE)
    p = spark.createDataFrame([(1, 1, CITED["table_id"])], "doc int, ord int, source_table string")
    assert [r["row_id"] for r in evidence.cite(p, t, "doc").first()["evidence"]["rows"]] == ["r0", "r1", "r3", "r5"]


def test_short_rows_are_dealt_by_their_number(spark, monkeypatch):
    """A small file of many costly rows is no single task."""
    from tessera import catalog
    from tessera.plans import common
    from tests.conftest import DATA

    monkeypatch.setattr(common, "ROWS_A_TASK", 10)
    for name, rows in (("jats_metadata", "part"), ("fact_answers", "customer")):
        n = -(-spark.read.parquet(f"{DATA}/{rows}.parquet").count() // 10)
        assert catalog.QUERIES[name](spark, DATA).rdd.getNumPartitions() == n


def test_tables_that_no_two_branches_read_are_not_written(spark):
    from tessera import catalog
    from tessera.sources import work
    from tests.conftest import DATA

    for name, folders in (("answer_targets", 0), ("finalized", 1)):
        before = len(work._made)
        catalog.QUERIES[name](spark, DATA)
        assert len(work._made) - before == folders


def test_lines_are_dealt_by_document_once(spark):
    """Branches read them, and the tables made of them, by bucket."""
    from tessera.plans import verification
    from tests.conftest import DATA

    p, t = verification.parameters_and_tables(spark, DATA, without=("cells",))
    assert "Exchange" not in evidence.bind(evidence.cite(p, t, "doc", fields=("rows", "columns")))._jdf.queryExecution().executedPlan().toString()


def test_rows_that_no_branch_reads_are_not_listed(spark):
    from tessera import catalog
    from tests.conftest import DATA

    out = catalog.QUERIES["table_records"](spark, DATA)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    tables = next(x for x in spark.catalog.listTables() if x.name.startswith("tables_") and x.name in plan)
    assert "rows" not in spark.table(tables.name).columns


def test_the_deal_by_document_carries_a_place_for_the_order(spark):
    from tessera.plans import common, verification
    from tests.conftest import DATA

    lines = verification.placed(spark, DATA)
    assert not set(common.ORDER) - {"l_partkey", "l_quantity"} & set(lines.columns) and len(lines.columns) == 7
    base = verification.based(spark, DATA)[0]
    assert base.exceptAll(verification.unwritten(spark, DATA)).isEmpty() and base.count() == verification.unwritten(spark, DATA).count()


def test_pairs_of_parameters_are_grouped_without_their_texts(spark):
    s = "doc long, ord int, name array<string>, species string"
    a = spark.createDataFrame([(1, 0, ["a", "b", "a", None, ""], "rat"), (1, 1, ["b"], None), (1, 2, None, "rat"), (None, 3, ["a"], "rat")], s)
    b = spark.createDataFrame([(1, 0, ["b", "a"], "rat"), (1, 1, ["a"], "human"), (1, 2, ["b"], "")], s)
    pairs = match.candidates(a, b, "doc", [("name", 8)], ["species"])
    assert sorted((r.ref, r.pred, r.score) for r in pairs.collect()) == [(0, 0, 10), (0, 2, 8), (1, 0, 8), (1, 2, 8)]
    groups = [x for x in pairs._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [" in x]
    assert groups and not any("species" in x for x in groups)


def test_what_is_left_over_makes_pairs_once(spark):
    from tessera.operators import evaluate
    from tessera.sources import work

    pairs = spark.createDataFrame([(1, 0, 0, 9), (1, 0, 1, 9), (1, 1, 2, 7), (1, 2, 2, 7), (1, 3, 3, 5), (1, 4, 3, 8), (2, 0, 0, 1)], "doc long, ref int, pred int, score int")
    both = spark.createDataFrame([(d, i) for d in (1, 2, 3) for i in range(5)] + [(None, 0)], "doc long, ord int")
    before = len(work._made)
    out = evaluate.left_over(both, both, pairs, "doc")
    assert len(work._made) == before + 1
    got = [sorted((str(r.doc), r.ord) for r in df.collect()) for df in out]
    rest = [("2", 1), ("2", 2), ("2", 3), ("2", 4), *(("3", i) for i in range(5)), ("None", 0)]
    assert got == [[("1", 1), ("1", 2), ("1", 3), *rest], [("1", 1), ("1", 4), *rest]]
    assert not any("Window" in df._jdf.queryExecution().optimizedPlan().toString() for df in out)
