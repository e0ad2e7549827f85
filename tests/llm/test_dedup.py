"""Suffix dedup and n-gram join against brute force."""

import random

import numpy as np
import pytest

from tessera.llm import ngram_join, suffix_dedup, suffix_sort, trie
from tests.llm import helpers as h


@pytest.mark.parametrize("group,local,held", [(2, 24, 40_000), (3, 2, 7), (2000, 24, 40_000), (2000, 2, 50)])
def test_repeats_are_those_of_brute_force(spark, monkeypatch, group, local, held):
    """Each level, and settling in the tasks, gives what counting gives; near
    copies and copies of a passage make hot anchors."""
    for k, v in {"GROUP": group, "LOCAL": local, "HELD": held}.items():
        monkeypatch.setattr(suffix_dedup, k, v)
    r = random.Random(7)
    base, passage = (bytes(r.choice(b"abcdefgh ") for _ in range(n)).decode() for n in (700, 260))
    more = []
    for i in range(40):
        t = list(base)
        for _ in range(r.randint(0, 3)):
            t[r.randrange(len(t))] = "X"
        more += ["".join(t), f"{i} own " + passage + f" own {i * 17}"]
    docs = h.odd_documents(spark).filter("length(text) < 100000 OR text IS NULL").select("doc_id", "text", "lang", "_v")
    docs = docs.unionByName(spark.createDataFrame([(1000 + i, t, "en", "_") for i, t in enumerate(more)], docs.schema)).repartition(6)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    found = suffix_dedup.mark_repeats(docs)
    assert found.columns == ["doc_id", "text", "lang", "_v", "spans"]
    got = found.collect()
    assert {x._v for x in got} == {"x", "_"}
    texts = [(r.text or "").encode() for r in docs.collect()]
    marks = h.repeated_bytes(texts, suffix_dedup.SPAN)
    want = sorted((t, h.kept_bytes(t, m)) for t, m in zip(texts, marks, strict=True))
    assert sorted(((r.text or "").encode(), suffix_dedup.cut((r.text or "").encode(), [s.asDict() for s in r.spans])) for r in got) == want


def test_spans_are_maximal_and_long_texts_whole(spark):
    rows = spark.createDataFrame([(1, "long " * 40_000), (2, None)], "doc_id long, text string")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in suffix_dedup.mark_repeats(rows).collect()}
    assert got == {1: [(0, 200_000)], 2: []}
    assert suffix_dedup.mark_repeats(rows.filter("false")).count() == 0


def test_suffixes_sort_as_bytes():
    r = random.Random(1)
    raw = bytes(r.choice(b"ab") for _ in range(600))
    start = np.arange(0, 500)
    s = suffix_sort.Suffixes(raw, 20)
    group = np.sort(np.array([r.randrange(5) for _ in start]))
    order = s.sort(start, group)
    got = [(int(group[i]), raw[start[i] : start[i] + 20]) for i in order]
    assert got == sorted(got)
    x, y = start[:100], start[100:200]
    want = [next((k for k in range(20) if raw[a + k] != raw[b + k]), 20) for a, b in zip(x, y, strict=True)]
    assert s.extension(x, y).tolist() == want


def test_collisions_are_told_from_equal_bytes(monkeypatch):
    """With hashes that are all alike only the bytes can decide."""
    monkeypatch.setattr(suffix_sort.Suffixes, "_same", lambda self, x, y, n: np.ones(len(x), bool))
    raw = bytes(range(60)) + bytes(range(10, 70))
    _, _, twice, first = suffix_sort.twins(raw, np.array([0, 60]), np.array([0, 0]), np.array([0, 0]), np.array([5, 5]), 50)
    assert len(twice) == 12 and not twice.any() and first.all()


def test_twins_of_windows():
    raw = b"abcdefgh" + b"abcdefgh" + b"xbcdefgh"
    row, dist, twice, first = suffix_sort.twins(raw, np.array([0, 8, 16]), np.zeros(3, int), np.zeros(3, int), np.full(3, 2), 6)
    told = {(int(a), int(b)): (bool(c), bool(d)) for a, b, c, d in zip(row, dist, twice, first, strict=True)}
    assert told[2, 2] == (False, True) and all(t for k, (t, _) in told.items() if k != (2, 2))
    assert [sum(f for (_, d), (_, f) in told.items() if d == k) for k in range(3)] == [1, 1, 2]


@pytest.mark.parametrize("block,heavy,flush,pairs", [(6, 256, 10**6, 0), (6, 256, 10**6, 10**9), (1500, 2, 300, 0), (6, 3, 100, 0)])
def test_components_are_those_of_all_pairs(spark, monkeypatch, block, heavy, flush, pairs):
    for k, v in {"BLOCK": block, "HEAVY": heavy, "FLUSH": flush, "PAIRS": pairs}.items():
        monkeypatch.setattr(ngram_join, k, v)
    r = random.Random(5)
    vocabulary, texts = [f"w{i}" for i in range(400)], list(h.odd_texts())
    for _ in range(3):
        base = [r.choice(vocabulary) for _ in range(60)]
        for _ in range(12):
            w = list(base)
            for _ in range(r.randint(0, 4)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            texts.append(" ".join(w[: r.randint(40, 60)] if r.random() < 0.4 else w))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.join_similar(docs).collect()}
    sets = [h.shingles(t) for t in texts]
    assert got == {i: (len(s), g) for i, (s, g) in enumerate(zip(sets, h.groups(sets), strict=True))}


def test_a_chain_of_unlike_sets_asks_by_shingle(spark, monkeypatch):
    """Sets that share a shingle with the next one only are one block; what is
    alike in it is found though the chain is long."""
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    monkeypatch.setattr(ngram_join, "PAIRS", 0)
    words = lambda i: [f"c{i}x{k}" for k in range(40)]
    texts = []
    for i in range(60):
        texts.append(" ".join(words(i)[:30] + [f"link{i}w{k}" for k in range(12)] + [f"link{i + 1}w{k}" for k in range(12)]))
    for i in (3, 30, 57):
        texts.append(texts[i].replace(f"c{i}x29", "other"))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in ngram_join.join_similar(docs).collect()}
    assert got == dict(enumerate(h.groups([h.shingles(x) for x in texts]))) and got[60] == 3 and got[62] == 57


def test_join_of_odd_and_of_no_rows(spark):
    docs = h.odd_documents(spark)
    assert ngram_join.join_similar(docs).count() == docs.count()
    assert ngram_join.join_similar(h.no_documents(spark)).count() == 0
    nulls = spark.createDataFrame([(None, "a b"), (3, "a b"), (None, None)], "doc_id long, text string")
    assert sorted((r.n_shingles, r.component_id) for r in ngram_join.join_similar(nulls).collect() if r.n_shingles) == [(1, 3), (1, 3)]


def test_trie_finds_what_counting_finds():
    r = random.Random(2)
    t = (75, 100)
    sets = []
    for i in range(60):
        base = sets[r.randrange(len(sets))][2] if sets and r.random() < 0.7 else np.array(r.sample(range(1000), 40), np.uint64)
        keys = np.unique(np.concatenate([base[: r.randint(25, 40)], np.array(r.sample(range(1000), r.randint(0, 6)), np.uint64)]))
        sets.append((i, len(keys), keys))
    alike = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b))
    tree = trie.Trie(t)
    for s in sets[:40]:
        tree.insert(*s)
    for _, n, q in sets[40:]:
        # Each set is a component of its own: all similar ones are found.
        assert sorted(tree.find(n, q)) == [i for i, _, k in sets[:40] if alike(k, q)]
    whole = {tuple(sorted(p)) for p in trie.stars(trie.links(sets, t))}
    pairs = [(a, b) for a, _, k in sets for b, _, m in sets if b < a and alike(k, m)]
    assert whole == {tuple(sorted(p)) for p in trie.stars(pairs)}
    half = trie.ask(sets[:30], sets[30:], {i: i % 2 for i, _, _ in sets}, t)
    assert all(alike(sets[a][2], sets[b][2]) and a % 2 != b % 2 for a, b in half)
    want = {a for a, _, k in sets[30:] if any(alike(k, m) and a % 2 != b % 2 for b, _, m in sets[:30])}
    assert {a for a, _ in half} == want
