"""Queries on whole tables and whole texts, on rows made for their corners."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from tessera.functions import text as T
from tessera.operators import retrieve
from tessera.plans import ingestion, records, texts
from tessera.sources import documents


def documents_at(spark, tmp_path, *rows):
    spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def stripped(md):
    flags = re.I | re.M | re.A
    m = re.search(r"^#{0,4}\s*(?:references|bibliography)\s*$", md, flags)
    if not m:
        return md
    again = re.search(r"^#{1,4}\s*(?:appendix|supplement|table)", md[m.start():], flags)
    return md[:m.start()] + (md[m.start() + again.start():] if again else "")


def test_bibliographies_of_whole_texts(spark, duck, tmp_path):
    docs = dict(duck.sql("SELECT doc_id, text FROM documents").fetchall())
    tail = lambda i: (["## References"] if i % 2 == 0 else []) + ["[1] someone"] + (["# Appendix A"] if i % 4 == 0 else []) + ["tail"]
    got = {r.doc_id: r.kept for r in texts.bibliography_strip(spark, DATA).collect()}
    assert got == {i: stripped("\n".join([t, *tail(i)])) for i, t in docs.items()}
    long = "\U0001f600 word " * 100 + "\n\nReferences\n[1] a\n## Table 1\nb\nBibliography\nc"
    got = {r.doc_id: r.kept for r in texts.bibliography_strip(spark, documents_at(spark, tmp_path, long, long)).collect()}
    assert got == {i: stripped("\n".join([long, *tail(i)])) for i in (0, 1)}
    kept = spark.createDataFrame([(long,), (None,)], "x string").select(T.without_bibliography(F.col("x")).alias("y")).collect()
    assert [r.y for r in kept] == [stripped(long), None]


def test_roles_of_whole_texts(spark, tmp_path):
    far = "the les " * 50
    d = documents_at(spark, tmp_path, far, far + "sensitivity coefficient", far, far, far, far + "point of departure")
    got = [(r.is_input, r.role) for r in texts.table_gate_route(spark, d).orderBy("doc_id").collect()]
    assert got == [(True, "sensitivity_analysis"), (False, "sensitivity_analysis"), (True, "simulated_data"), (True, "simulated_data"), (True, "model_parameters"), (False, "sensitivity_analysis")]


def test_grids_of_whole_pages(spark, tmp_path):
    html = "<html><body><p>" + "x" * 100 + "</p><table><tr><th>a</th><th>b</th></tr><tr><td rowspan=2>1</td><td>2</td></tr><tr><td>3</td></tr></table></body></html>"
    spark.createDataFrame([(7, html), (8, None)], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = [tuple(r) for r in texts.html_grid(spark, str(tmp_path)).collect()]
    own = {(7, "cell_r0_c0", "1", "1/2", "a"), (7, "cell_r0_c1", "2", "1/2", "b"), (7, "cell_r1_c0", "1", "1/3", "a"), (7, "cell_r1_c1", "3", "1/3", "b")}
    assert len(got) == 4 + 2 * 5 and own < set(got)


def test_queries_are_asked_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(0)
    q, p = rng.normal(size=(12_000, 2)), rng.normal(size=(60, 2))
    page = [0] * 40 + [1 + i // 2 for i in range(20)]
    vectors = lambda keys, m, name: spark.createDataFrame([(k, v.tolist()) for k, v in zip(keys, m, strict=True)], f"{name} int, embedding array<float>")
    monkeypatch.setattr(retrieve, "CHUNK", 10)
    got = retrieve.late_interaction(vectors([i % 3 for i in range(12_000)], q, "query"), vectors(page, p, "page"), "query", "page").collect()
    s = q.astype("float32").astype(float) @ p.astype("float32").astype(float).T
    want = {(a, b): s[a::3][:, [k == b for k in page]].max(axis=1).sum() for a in range(3) for b in range(11)}
    assert {(r.query, r.page): r.score for r in got} == pytest.approx(want)


def looked_up(parts):
    """Brute force over all pairs."""
    out = set()
    for k, b, t, s, v in parts:
        found = []
        for k2, b2, t2, s2, v2 in parts:
            if k2 == k or b is None or b2 != b:
                continue
            size, kind = s is not None and s == s2, t is not None and t == t2
            tier = 1 if size and kind else 2 if kind else 3 if None not in (v, v2) and abs(v - v2) <= 0.03 * v else None
            if tier:
                found.append((tier, -2 * size - kind, k2))
        if found:
            tier, score, k2 = min(found)
            out.add((k, tier, -score, k2))
    return out


def test_every_part_is_looked_up(spark, tmp_path):
    rng = np.random.default_rng(1)
    pick = lambda *xs: xs[rng.integers(len(xs))]
    parts = [(i, pick("a", "b", None), pick(*(f"t{j}" for j in range(300)), None), pick(1, 2, 3, None), pick(0.0, -5.0, None, 0.01, 900.0, 927.0, *(float(x) for x in range(900, 1000)))) for i in range(400)]
    spark.createDataFrame(parts, "p_partkey long, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    got = {tuple(r) for r in records.tiered_lookup(spark, str(tmp_path)).select("want", "tier", "score", "found").collect()}
    want = looked_up(parts)
    assert {x[1] for x in want} == {1, 2, 3} and got == want


def test_siblings_among_all_pages(spark, tmp_path):
    spark.createDataFrame([(1, "t"), (2, "t")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "<article>"), (2, "<p>"), (3, "<article>")], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert {tuple(r) for r in ingestion.sibling_files(spark, str(tmp_path)).collect()} == {(True, 1), (False, 1)}


def test_names_are_found_at_any_place(spark):
    names = ["dean_pfas", "main_tan", "Chou", "none", "ab", "x", "", None]
    stems = ["2025_dean_pfas", "dean_pfas_supplement", "tan", "chou", "chou_2019", "zabz", "ABBA"]
    n, p = spark.createDataFrame([(x,) for x in names], "name string"), spark.createDataFrame([(x,) for x in stems], "stem string")

    def file(x):
        held = [] if x is None else [s for s in stems if s.lower() in x.lower() or x.lower() in s.lower()]
        return min(held, key=lambda s: (s.lower() != x.lower(), len(s), s.lower()), default=None)

    want = {x: file(x) for x in names}
    assert (want["dean_pfas"], want["main_tan"], want["none"]) == ("2025_dean_pfas", "tan", None)
    assert {r.name: r.file for r in documents.associate(n, p, "name", "stem").collect()} == want
