"""Interfaces to models, services and readers, on rows with known results."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.functions import classify
from tessera.functions import text as T
from tessera.operators import answers, benchmark, inference, linescan, physiology, segments, series
from tessera.sources import literature, sinks

PAGE = """Body before
Table 1. Parameters of PFOS in rats
Species
PFOA
Volume of distribution (L/kg)
Vd
0.17 (0.1, 0.3)
2.5 Brown et al. 2005
Human adult values
Clearance (L/h/kg^0.75)
1.5
References
Clearance of others
9.9
Table 2. Sensitivity analysis of AUC
Vd
0.5"""


def records(spark, *pages):
    got = linescan.scan(spark.createDataFrame(list(enumerate(pages)), "page int, text string").withColumn("doc", F.lit(1)), "doc", "page", "text")
    return [tuple(r[f] for f in linescan.FIELDS) for r in got.orderBy("page", "pos").collect()]


def test_records_of_a_page(spark):
    got = [(r[0], r[1], r[2], r[3], r[4], r[6], r[8], r[9], r[10]) for r in records(spark, PAGE)]
    assert got == [
        ("Volume of distribution (L/kg)", "Vd", 0.17, 0.1, 0.3, "L/kg", "rat", "PFOS", None), ("Volume of distribution (L/kg)", "Vd", 2.5, None, None, "L/kg", "rat", "PFOA", None),
        ("Clearance (L/h/kg^0.75)", "", 1.5, None, None, "L/h/kg^0.75", "human", "PFOS", "adult"),
    ]
    assert records(spark, "", "Table 1\nab\nx", None) == []


def test_a_taken_line_is_no_name(spark):
    """Numbers that a name has taken head nothing; those beyond its reach do,
    and a caption or a closing word is no symbol."""
    many = "Table 1\nName of it\n" + "\n".join(f"{i}.25" for i in range(10))
    assert [(r[0], r[2]) for r in records(spark, many)] == [("Name of it", i + 0.25) for i in range(7)] + [("7.25", 8.25), ("7.25", 9.25)]
    assert [(r[0], r[1], r[7]) for r in records(spark, "Table 1\nFirst\nTable 2\n1.5\n2.5\nRate\n-k1\n3")] == [("Rate", "-k1", "Table 2"), ("1.5", "", "Table 2")][::-1]
    assert records(spark, "Table 1\nFirst\nFigure\n1.5\nSecond\n2.5") == []
    assert [r[2] for r in records(spark, "Table 1\nFirst\n1.5 of Figure 2\nSecond\n2.5")] == [1.5, 2.5]


def test_scans_are_distinct_and_fall_back(spark):
    pages = spark.createDataFrame([(1, 1, PAGE), (1, 2, PAGE), (2, 1, None)], "doc long, page int, text string")
    found = linescan.scan(pages, "doc", "page", "text")
    assert found.count() == 6
    once = linescan.distinct_scan(found, "doc", "page")
    assert sorted((r.page, r.pos) for r in once.collect()) == [(1, 0), (1, 1), (1, 2)]
    other = once.withColumns({"doc": F.lit(2).cast("long"), "extra": F.lit("x")})
    both = linescan.with_fallback(once, other.unionByName(once.withColumn("extra", F.lit("y"))), "doc", 3)
    assert both.groupBy("doc").count().orderBy("doc").collect() == [(1, 3), (2, 3)]
    assert linescan.statements(once).orderBy("pos").first().statement == "Volume of distribution (L/kg) [Vd] for PFOS, rat = 0.17 (95% CI: 0.1 to 0.3) L/kg"


def test_services_are_asked_for_what_is_missing(spark):
    papers = spark.createDataFrame([("https://doi.org/10.1/a", None), (None, "A long enough title"), (" ", "short"), ("10.1/a", "x")], "doi string, title string")
    asked = literature.keys(papers)
    cache = spark.createDataFrame([("unpaywall", "10.1/a", "{}")], "service string, key string, body string")

    def fetch(address):
        if "biorxiv" in address:
            raise OSError("no network")
        return None if "crossref" in address else json.dumps({"from": address})

    kept = literature.refreshed(asked, cache, fetch)
    assert sorted((r.service, r.key) for r in kept.collect()) == sorted([("unpaywall", "10.1/a"), ("pmc", "10.1/a[DOI]"), ("europe_pmc", "DOI:10.1/a"), ("semantic_scholar", "10.1/a"), ("pmc", "A long enough title[Title]"), ("europe_pmc", 'TITLE:"A long enough title"')])
    assert literature.missing(asked, kept).count() == 4


def test_only_articles_are_full_texts(spark):
    bodies = ["<article>" + "x" * 600, "<article>", "y" * 900, "<article><error idDoesNotExist/>" + "x" * 600]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    assert [r.i for r in literature.full_texts(df).collect()] == [0]


def test_models_fail_over_and_are_asked_again(spark):
    calls = []

    def bad(texts):
        calls.append(1)
        raise ValueError("down")

    assert inference.failover(bad, lambda t: ["ok"] * len(t))(["x"]) == ["ok"] and len(calls) == 2
    with pytest.raises(ValueError):
        inference.failover(bad)(["x"])
    df = spark.createDataFrame([(1, "V = 2 L"), (2, "cut off"), (3, None)], "k int, t string")
    model = lambda texts: ['{"v": 1' if t == "cut off" else "[]" if "Your answer" in t else "no json" if not t else '{"v": 2}' for t in texts]
    got = {r.k: (r.how, r.parsed and r.parsed.v) for r in inference.run_with_repair(df, "t", "struct<v: int>", model, fallback=F.struct(F.lit(9).alias("v"))).collect()}
    assert got == {1: ("first", 2), 2: ("first", 1), 3: ("fallback", 9)}
    assert inference.run_with_repair(df.filter("false"), "t", "struct<v: int>", model).count() == 0


def test_prompts_and_filters(spark):
    df = spark.createDataFrame([(0.1, "x" * 60), (0.3, "y" * 60), (0.0, "short"), (None, None)], "score double, t string")
    assert sorted(str(r.t)[:1] for r in inference.relevant(df, "t").collect()) == ["N", "s", "y"]
    text = df.select(inference.prompt("{a}: {b}.", a=F.col("score"), b=F.lit(None)).alias("p")).first().p
    assert text == "0.1: ."
    assert df.select(inference.fits_context(F.lit("x" * 35), 4011).alias("a"), inference.fits_context(F.lit("x" * 35), 4010).alias("b")).first() == (True, False)


def test_blocks_for_items(spark):
    blocks = ["# Title", "Authors", "# 1. Introduction\n\nFirst.\n\nBackground.\n\nAim.", "## Methods\nmodel", "## Results\nAAFE of it", "## Thanks\nto all", "a | b"]
    df = spark.createDataFrame([(1, i, b) for i, b in enumerate(blocks)], "doc long, pos int, block string")
    got = {r.pos: r for r in segments.for_items(df, ("TAN_2.5.1A",)).collect()}
    assert [got[i].priority for i in range(7)] == [1, 1, 1, 1, 0, 1, 1]
    assert got[2].block == "# 1. Introduction\n\n[...]\n\nAim."
    assert [segments.for_items(df, ("TAN_2.4.7", "TAN_1.1")).filter(F.col("pos") == i).first().priority for i in (0, 3, 4, 6)] == [0, 0, 1, 0]


def test_matches_have_their_places_and_contexts(spark):
    df = spark.createDataFrame([(1, "12 a 345é 6"), (2, None), (3, "none"), (4, "7")], "k int, t string")
    got = sorted(tuple(r) for r in segments.matches(df, "k", "t", "[0-9]+", 2).collect())
    assert got == [(1, 0, "12", "12 a"), (1, 5, "345", "a 345é "), (1, 10, "6", "é 6"), (4, 0, "7", "7")]


def test_benchmark_values_meet_across_bands(spark):
    import math
    import random

    r = random.Random(5)
    values = [None, 0.0, 1e-5, -1e-5, 5e-4, 9.99e-4, 1.001e-3, 1.015e-3, -2.0, 1e9] + [r.choice((1, -1)) * 10 ** r.uniform(-6, 6) for _ in range(120)]
    values += [v * (1 + r.uniform(-0.021, 0.021)) for v in values if v]
    s = "doc long, ord int, value double"
    a = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], s)
    got = {(x.pred, x.ref) for x in benchmark.near_pairs(a, a, "doc").collect()}
    near = lambda x, y: x is None and y is None or None not in (x, y) and math.isclose(x, y, rel_tol=0.02, abs_tol=1e-5)
    assert got == {(i, j) for i, x in enumerate(values) for j, y in enumerate(values) if near(x, y)}
    assert benchmark.near_pairs(a, a, "doc").count() == len(got)


def test_benchmark_values_take_three_bands(spark):
    r = [i / 7 for i in range(1, 40)]
    values = [(s * x * 10.0**e, s * x * 10.0**e * k) for e in (-5, -4, -3, 0, 4) for x in r for s in (1, -1) for k in (0.98, 1.0, 1 / 0.98)] + [(v, v + 1e-5) for v in (0.0, -1e-5, -5e-6, 9.99e-4)]
    df = spark.createDataFrame(values, "p double, g double").select("p", benchmark._bands(F.col("p"), 1).alias("p_b"), benchmark._bands(F.col("g"), 0).alias("g_b"))
    assert df.filter(~F.arrays_overlap("p_b", "g_b")).count() == 0 and df.filter("size(g_b) <> 1").count() == 0
    assert df.filter("size(p_b) > 3").filter(~F.abs("p").between(9e-4, 1.1e-3)).count() == 0


def test_a_replication_of_its_own_curve_passes(spark):
    p = spark.createDataFrame([(1, None, "V1", 10.0, 1), (1, "A", "CL", 2.0, 2), (1, "B", "CL", 50.0, 3)], "k long, compound string, symbol string, value double, ord int")
    dose = spark.createDataFrame([(1, 100.0)], "k long, dose double")
    import math

    seen = spark.createDataFrame([(1, float(t), 10 * math.exp(-0.2 * t)) for t in range(1, 20)], "k long, time double, concentration double")
    curve, fit = series.replicate(p, dose, seen, "k", "a")
    assert curve.count() == 500 and fit.first().verdict == "PASS"
    assert series.replicate(p, dose, seen, "k", "b")[1].first().verdict == "FAIL"


def test_reports_curves_and_documents(spark, tmp_path):
    sinks.write_report(spark.createDataFrame([("a", None, 1)], "x string, y string, n int"), f"{tmp_path}/r")
    assert [json.loads(x) for f in tmp_path.glob("r/part-*") for x in f.read_text().splitlines()] == [{"x": "a", "y": None, "n": 1}]
    sinks.write_curve(spark.createDataFrame([(1, 0.0), (2, 1.0)], "k int, t double"), f"{tmp_path}/c", "k")
    assert {p.name for p in tmp_path.glob("c/k=*")} == {"k=1", "k=2"}
    sinks.write_documents(spark.createDataFrame([(i % 2, i) for i in range(6)], "k int, v int"), f"{tmp_path}/d", "k")
    assert spark.read.json(f"{tmp_path}/d").count() == 6


def test_words_of_species_compounds_and_citations(spark):
    one = lambda t, f: spark.createDataFrame([(t,)], "x string").select(f(F.col("x")).alias("y")).first().y
    label = lambda rules: lambda c: classify.first_label(c, rules)
    assert [one(t, label(classify.SPECIES)) for t in ("Wistar", "a Macaque", "rates", "beagle", "infants")] == ["rat", "nonhuman primate", None, "dog", "human"]
    assert one("pfoa, XYZ and AUC of RLZ in BODY", classify.acronyms) == ["PFOA", "RLZ", "XYZ"]
    assert one("Brown et al., 2005a gave (1999) L/h/kg^0.75", T.scrub) == "Brown  gave  L/h/kg"
    assert one("Model structure", classify.is_diagram) and not one("Doses", classify.is_diagram) and not one(None, classify.is_diagram)
    assert [r.species for r in physiology.species(spark).collect()] == ["human", "mouse", "nonhuman primate", "rat"]


def test_an_empty_document_has_one_answer(spark):
    got = answers.answers(spark.createDataFrame([(1,)], "doc long"), "doc").collect()
    assert len(got) == 36 and {(r.item_id, r.confidence) for r in got if r.response != "i_cannot_answer"} == {("TAN_1.3", "low")}
    view = answers.overview(answers.answers(spark.createDataFrame([(1,)], "doc long"), "doc"), "doc").first()
    assert view.n_open == 35 and len(view.gaps) == 35 and view.fit.startswith("1/36")
