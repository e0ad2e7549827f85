"""The columns that the queries themselves derive, against brute force on a
whole small table; and columns of any name."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from tessera.llm import decontamination, ngram_join, packing, quality, queries, sharding, stages, suffix_dedup, token_counts, tokens, urls, warc
from tests.conftest import DATA
from tests.llm import helpers as h

PATH = tokens.vocabulary_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}


def runs(mark):
    return sum(1 for i, m in enumerate(mark) if m and not (i and mark[i - 1]))


def test_op1(spark, texts):
    raw = {i: t.encode() for i, t in texts.items()}
    marks = dict(zip(raw, h.repeated_bytes(list(raw.values()), 200), strict=True))
    got = suffix_dedup.op1_suffix_dedup(spark, DATA).collect()
    assert len(got) == len(raw)
    for r in got:
        x, m = raw[r.doc_id], marks[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(x), sum(m), runs(m), hashlib.sha256(h.kept_bytes(x, m)).hexdigest())


def test_op5(spark, texts):
    library = tokens.load(PATH)
    got = token_counts.op5_token_counts(spark, DATA).collect()
    assert len(got) == len(texts)
    for r in got:
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 512)


def test_op9(spark, texts):
    library = tokens.load(PATH)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in packing.op9_packing(spark, DATA).collect():
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for i, t in texts.items():
        ids, at = [*library.encode(t, add_special_tokens=False).ids, 2], 0
        for k, p in enumerate(sorted(by_doc[i], key=lambda r: r.piece)):
            own = b"".join(x.to_bytes(4, "little") for x in ids[at : at + p.length])
            assert (p.piece, p.start, p.ids_crc32) == (k, at, zlib.crc32(own)) and (k == 0 or p.length == 1024)
            at += p.length
        assert at == len(ids)
    for ps in by_sequence.values():
        at = 0
        for p in sorted(ps, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
    total = sum(p.length for ps in by_doc.values() for p in ps)
    assert len(by_sequence) <= -(-total // 1024) * 1.02 + 1


def test_op10(spark, texts):
    got = sharding.op10_sharding(spark, DATA).collect()
    assert {r.doc_id for r in got} == set(texts) and {r.law for r in got} == {"rows"}
    for r in got:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), None)
    n = Counter(r.shard for r in got)
    assert set(n) == set(range(40)) and max(n.values()) - min(n.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n[s])) for s in n)


def test_large_draws_have_the_law_of_small_ones():
    """Beyond numpy's bound: mean and variance of the hypergeometric law."""
    import numpy as np

    good, bad, n = 4 * 10**9, 12 * 10**9, 10**6
    rng = np.random.default_rng(3)
    got = np.array([sharding._draw(rng, good, bad, n) for _ in range(400)], float)
    mean, var = n * 0.25, n * 0.25 * 0.75
    assert abs(got.mean() - mean) < 5 * (var / 400) ** 0.5 and 0.8 < got.var() / var < 1.25
    assert sharding._draw(rng, 2 * 10**9, 0, 5) == 5 and sharding._draw(rng, 0, 2 * 10**9, 5) == 0


#: Names that operators use inside, and names of what they add.
NAMES = ("_v", "_w", "_id", "_row", "row", "h", "k", "v", "w", "_host", "_path", "_fit", "_s", "block", "deal", "mix", "rank", "cell", "before", "_bucket", "_rank", "kind", "bucket", "n", "key", "component_id", "kept", "slot")


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, t, "en", "s", len(t or ""), *(f"own {n}" for n in NAMES)) for i, t in enumerate(h.odd_texts())] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"`{n}` string" for n in NAMES))


def own(rows, added=()):
    return all(r[n] == f"own {n}" for r in rows for n in NAMES if n not in added)


@pytest.mark.parametrize("name", ["quality_rules", "ngram_join", "suffix_dedup", "decontamination"])
def test_stages_keep_columns_of_any_name(spark, clashing, tmp_path, name):
    spark.createDataFrame([(1, h.PASSAGE)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = getattr(stages, name)(spark, clashing, str(tmp_path))
    rows = out.collect()
    assert out.columns == clashing.columns and rows and own(rows)


def test_operators_keep_columns_of_any_name(spark, clashing):
    n = clashing.count()
    for out, added in (
        (suffix_dedup.mark_repeats(clashing), ()), (quality.judge(clashing), ("kept",)), (token_counts.count_tokens(clashing, PATH), ()), (sharding.shard(clashing, ["doc_id", "text"], 3), ("slot",)),
        (urls.judge_urls(clashing.withColumnRenamed("text", "url")), ()),
    ):
        rows = out.collect()
        assert len(rows) == n and own(rows, added)
    assert packing.pack_documents(clashing, PATH).count() >= n and ngram_join.join_similar(clashing).count() == n
    items = clashing.select("doc_id", "text", *NAMES).withColumnRenamed("doc_id", "item_id")
    assert decontamination.contaminated(clashing, items).count() == n


def test_archives_of_columns_of_any_name(spark, clashing, tmp_path):
    pages = clashing.withColumnsRenamed({"doc_id": "page_id", "text": "html", "source": "url"})
    folder = f"file://{tmp_path}"
    assert warc.read_archives(warc.write_archives(pages, folder), folder).count() == pages.count()


def test_every_query_is_registered():
    assert [q.split("_")[0] for q in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
