import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest

from tessera.llm import packing, sharding, token_counts, tokens
from tests.llm import helpers as h

PATH = tokens.vocabulary_path("byte_bpe_50k.json")


def test_counts_are_the_librarys(spark):
    library = tokens.load(PATH)
    docs = h.odd_documents(spark)
    got = token_counts.count_tokens(docs, PATH)
    assert got.columns == [c for c in docs.columns if c != "n_tokens"] + ["n_tokens"]
    for r in got.collect():
        assert r.n_tokens == len(library.encode(r.text or "", add_special_tokens=False).ids)
    assert token_counts.count_tokens(h.no_documents(spark), PATH).count() == 0


def test_cache_is_bounded_and_right(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 3)
    calls = []
    c = tokens.Cache(lambda x: calls.append(x) or len(x))
    for k in ("a", "bb", "ccc", "dddd", "a", "bb"):
        assert c[k] == len(k)
    assert len(c) <= 3 and calls.count("a") == 1


def test_pieces_and_places(spark):
    library = tokens.load(PATH)
    docs = h.odd_documents(spark)
    got = packing.pack_documents(docs, PATH, capacity=64, with_ids=True).collect()
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in got:
        by_seq[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for places in by_seq.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= 64
    assert len(by_seq) <= -(-sum(r.length for r in got) // 64) * 1.1 + 1
    for r in docs.filter("doc_id > 1").collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
        mine = sorted(by_doc[r.doc_id], key=lambda p: p.piece)
        assert [p.piece for p in mine] == list(range(len(mine))) and all(p.length == 64 for p in mine[1:])
        assert b"".join(p.ids for p in mine) == np.array(ids, "<u4").tobytes()
        assert all(p.ids_crc32 == zlib.crc32(p.ids) and p.start == sum(q.length for q in mine[: p.piece]) for p in mine)
    assert packing.pack_documents(h.no_documents(spark), PATH).count() == 0


@pytest.mark.parametrize("left", [{7: 2, 5: 3, 3: 1}, {9: 1, 4: 2, 2: 5}, {10: 4}, {6: 1, 5: 1, 1: 1}])
def test_fullest_bin_is_that_of_brute_force(left):
    capacity = 20
    got = packing.fullest(left, capacity)
    assert all(0 < m <= left[k] for k, m in got.items()) and max(left) in got
    best = max(s for c in product(*(range(n + 1) for n in left.values())) if (s := sum(k * m for k, m in zip(left, c, strict=True))) <= capacity and c[list(left).index(max(left))])
    assert sum(k * m for k, m in got.items()) == best


def test_plan_gives_every_rank_one_place():
    histogram = {64: 3, 40: 7, 24: 6, 10: 50, 1: 9}
    shares, bins = packing.plan(histogram, 64)
    for k, n in histogram.items():
        assert [s.lo for s in shares[k]] == [0, *(s.hi for s in shares[k])][:-1] and shares[k][-1].hi == n
    assert bins >= -(-sum(k * n for k, n in histogram.items()) // 64)


def test_shards_are_exact_and_slots_gapless(spark):
    docs = h.odd_documents(spark).select("doc_id", "text", "shard")
    got = sharding.shard(docs, ["doc_id", "text"], 4)
    rows = got.collect()
    n = Counter(r.shard for r in rows)
    assert len(rows) == docs.count() and max(n.values()) - min(n.values()) <= 1
    for s in n:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n[s]))
    again = sharding.shard(docs.repartition(5), ["doc_id", "text"], 4).collect()
    key = lambda rs: sorted((r.shard, r.slot, r.doc_id, r.text or "") for r in rs)
    assert key(rows) == key(again)
    assert sharding.shard(h.no_documents(spark), ["doc_id"], 4).count() == 0


def test_matrix_has_its_sums_and_is_uniform():
    rows, sizes = [3, 0, 5, 4], [4, 4, 4]
    total = np.zeros((4, 3))
    for seed in range(600):
        m = sharding.matrix(rows, sizes, seed)
        assert m.sum(axis=1).tolist() == rows and m.sum(axis=0).tolist() == sizes and m.min() >= 0
        total += m
    assert np.abs(total / 600 - np.outer(rows, sizes) / 12).max() < 0.12
