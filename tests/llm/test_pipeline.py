"""The pipeline's stages against brute force on small documents."""

import re

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F
from tessera.llm import common, packing, quality, stages, suffix_dedup, tokens
from tests.llm import helpers as h


def test_stages_follow_each_other(spark, tmp_path):
    docs = h.odd_documents(spark).select("doc_id", "text", "lang", "source", "n_chars").filter("doc_id IS NOT NULL")
    item = " ".join(h.PASSAGE.split()[5:25])
    quoting = " ".join(f"own{i}" for i in range(70)) + " " + " ".join(f"Bench{i}" for i in range(12))
    docs = docs.unionByName(spark.createDataFrame([(900, quoting, "en", "s", len(quoting))], docs.schema))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, " ".join(f"bench{i}" for i in range(12)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows, now = [tuple(r) for r in docs.collect()], docs

    def stage(name):
        out = dict(corpus_pipeline.STAGES)[name](spark, now, str(tmp_path))
        assert out.columns == docs.columns
        return spark.createDataFrame(out.collect(), docs.schema)

    texts = [(r[1] or "").encode() for r in rows]
    ok = quality.cascade(quality.Chunk(texts), quality.RULES)
    rows = [r for r, k in zip(rows, ok, strict=True) if k]
    now = stage("quality_rules")
    assert sorted(map(str, now.collect())) == sorted(str(now.sparkSession.createDataFrame([r], docs.schema).first()) for r in rows)

    rows.sort(key=lambda r: r[0])
    first = h.groups([h.shingles(r[1]) for r in rows])
    rows = [r for i, r in enumerate(rows) if first[i] == i]
    now = stage("ngram_join")
    assert sorted(r.doc_id for r in now.collect()) == [r[0] for r in rows]

    marks = h.repeated_bytes([r[1].encode() for r in rows], suffix_dedup.SPAN)
    rows = [(r[0], h.kept_bytes(r[1].encode(), m).decode("utf-8", "ignore")) for r, m in zip(rows, marks, strict=True)]
    now = stage("suffix_dedup")
    assert sorted((r.doc_id, r.text) for r in now.collect()) == rows
    assert all(r.n_chars == len(r.text) for r in now.collect())

    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", h.lower(t))
    windows = {tuple(w[i : i + 10]) for t in (item, " ".join(f"bench{i}" for i in range(12))) for w in [words(t)] for i in range(len(w) - 9)}
    rows = [r for r in rows if not any(tuple(words(r[1])[i : i + 10]) in windows for i in range(len(words(r[1]))))]
    now = stage("decontamination")
    assert sorted((r.doc_id, r.text) for r in now.collect()) == rows and 900 not in {r[0] for r in rows}

    library = tokens.load(tokens.vocabulary_path("byte_bpe_50k.json"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == {r[0] for r in rows}
    total = sum(len(library.encode(r[1], add_special_tokens=False).ids) + 1 for r in rows)
    assert sum(r.length for r in got) == total
    assert np.max([r.offset + r.length for r in got]) <= packing.CAPACITY


def test_texts_with_one_first_hash_are_told_apart(spark, tmp_path, monkeypatch):
    """Of documents whose first hashes are all one, only those that quote an
    item go, and only whole copies are cut."""
    real = common.text_hashes
    one = lambda c: (F.lit(7).cast("long"), real(c)[1])
    monkeypatch.setattr(stages, "text_hashes", one)
    monkeypatch.setattr(suffix_dedup, "text_hashes", one)
    item = " ".join(f"bench{i}" for i in range(12))
    texts = {1: "quoting " + item, 2: "clean words of a text", 3: None, 4: "a " * 150 + "b", 5: "c " * 150 + "d", 6: "e " * 150 + "f", 7: "e " * 150 + "f"}
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert sorted(r.doc_id for r in stages.decontamination(spark, docs, str(tmp_path)).collect()) == [2, 3, 4, 5, 6, 7]
    copies = suffix_dedup.mark_repeats(docs.filter("doc_id IN (2, 3, 6, 7)"))
    assert {r.doc_id: [tuple(x) for x in r.spans] for r in copies.collect()} == {2: [], 3: [], 6: [(0, 301)], 7: [(0, 301)]}


def test_the_second_hash_is_no_function_of_the_first(spark):
    v, w = common.text_hashes(F.col("t"))
    r = spark.createDataFrame([("a text",)], "t string").select("t", v.alias("v"), w.alias("w"))
    assert r.select(F.col("w") != F.xxhash64("t", F.lit(1)), F.col("v") != F.col("w")).first()[:] == (True, True)
