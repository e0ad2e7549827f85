"""Operators 11 to 13 against brute force: links and components of vectors,
whitening in exact numbers, two tokenizers' groups and links."""

import hashlib
import math
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from tessera.llm import alignment, alignment_rows, tokens, vector_links, vectors, whitening
from tests.conftest import DATA
from tests.llm import helpers as h

A, B = (tokens.vocabulary_path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


# -- 11: links of vectors ----------------------------------------------------
def linked(rows, limit=0.95):
    """{row number: (links, component)} by comparing all with all."""
    good = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    near = defaultdict(set)
    for i in good:
        for j in good:
            a, b = ([x / max(map(abs, v)) for x in v] for v in (rows[i][1], rows[j][1]))
            if i != j and len(a) == len(b):
                dot, p, q = (math.fsum(x * y for x, y in zip(s, t, strict=True)) for s, t in ((a, b), (a, a), (b, b)))
                if dot / math.sqrt(p * q) >= limit:
                    near[i].add(j)
    out = {}
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out[i] = (rows[i][0], len(near[i]), min(ids) if ids else None)
    return out


def odd_vectors(kind=float):
    """Groups larger and smaller than a window, with members far from the
    centre, a chain, copies, and every odd case."""
    r = np.random.default_rng(4)
    unit = lambda v: v / np.linalg.norm(v)
    rows = [unit(r.standard_normal(16)) for _ in range(60)]
    centre = unit(r.standard_normal(16))
    rows += [unit(centre + s * unit(r.standard_normal(16))) for s in [0.1] * 90 + [0.25] * 30]
    chain = [unit(r.standard_normal(16))]
    for _ in range(12):
        chain.append(unit(chain[-1] + 0.25 * unit(r.standard_normal(16))))
    rows += chain + [rows[3] * 7, rows[3], rows[3], rows[70], -rows[5]]
    rows = [[kind(x) for x in v] for v in rows]
    rows += [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [0.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0], [-0.0, 1.0], [0.0, 1.0], [1e200, 1e200], [1e200, 1.1e200]]
    ids = [*range(500, 500 + len(rows) - 2), None, 500]
    return list(zip(ids, rows, strict=True))


@pytest.mark.parametrize("window", [16, 1024])
def test_links_are_those_of_all_pairs(spark, window):
    rows = odd_vectors()
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<double>, c string, n_links string")
    got = vector_links.link_vectors(df, window=window, miss=1e-9).collect()
    want = linked(rows)
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == Counter(want.values())
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


def test_a_group_of_a_third_of_all_rows_is_counted_whole(spark):
    """More members than 40 windows: full windows are counted exactly."""
    r = np.random.default_rng(8)
    far = r.standard_normal((800, 24))
    centre = r.standard_normal(24)
    near = centre / np.linalg.norm(centre) + r.uniform(0.02, 0.05, (400, 1)) * r.standard_normal((400, 24))
    x = np.vstack([far, near])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    c = u @ u.T
    assert np.abs(c - 0.95).min() > 1e-9 and (c[800:, 800:] < 0.95).any()
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in vector_links.link_vectors(df, window=8, miss=1e-6).collect()}
    assert [got[i] for i in range(1200)] == ((c >= 0.95).sum(axis=1) - 1).tolist()


def test_op11(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    got = vector_links.op11_vector_links(spark, DATA)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"] and Counter((r.vec_id, r.n_links, r.component_id) for r in got.collect()) == Counter(linked(rows).values())


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vector_links.link_vectors(df).count() == 0


def test_passes_follow_the_number_of_vectors():
    assert vector_links.passes(0) == vector_links.passes(2048) == 1
    sizes = [vector_links.passes(10**k) for k in range(4, 11)]
    assert sizes == sorted(sizes) and sizes[-1] < 400


# -- 12: whitening ------------------------------------------------------------
def whole(rows):
    return [[math.floor(64 * x) + 1_000_000 for x in v] for v in rows]


def covariance(x):
    """n, sums and covariance in exact numbers."""
    n, d = len(x), len(x[0])
    sums = [sum(c) for c in zip(*x, strict=True)]
    cov = [[Fraction(sum(n * n * r[i] * r[j] for r in x) - n * sums[i] * sums[j], n**3) for j in range(d)] for i in range(d)]
    return n, sums, cov


def held_against_exact(got, clean, k):
    x = whole(clean)
    n, sums, cov = covariance(x)
    v = np.array([[float(c) for c in r] for r in cov])
    e = np.linalg.eigvalsh(v)[::-1][:k]
    w = np.array([r.whitened for r in got])
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(r, sums, strict=True)] for r in x])
    assert [r.n for r in got] == [n] * n
    assert [r.deviation for r in got] == [sum((n * a - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
    # w = centred @ q / sqrt(e): its axes must be V's eigenvectors.
    axes = np.linalg.lstsq(centred, w * np.sqrt(e), rcond=None)[0]
    assert np.abs(v @ axes - axes * e).max() <= 1e-9 * e[0] and np.abs(axes.T @ axes - np.eye(k)).max() < 1e-8
    assert np.abs(np.array(got[0].explained) / (e / np.trace(v)) - 1).max() < 1e-9
    assert got[0].identity_error < 1e-9 and np.abs(w.T @ w / n - np.eye(k)).max() < 1e-9


def test_whitening_is_that_of_exact_numbers(spark):
    r = np.random.default_rng(2)
    clean = (r.standard_normal((150, 8)) * [3000, 40, 9, 5, 3, 2, 1, 1] + [1e6, -5e5, 3, 0, 0, 0, 0, 0]).tolist()
    bad = [None, [None] * 8, [float("nan")] * 8, [float("inf")] + [1.0] * 7, [1e17] * 8, [1.0, 2.0], []]
    rows = [(i, v, "x", "y") for i, v in enumerate(clean + bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n string, row string")
    out = whitening.whiten(df, 6).repartition(3)
    got = sorted(out.collect(), key=lambda x: x.vec_id)
    assert out.columns == ["vec_id", "embedding", "row", "n", "deviation", "whitened", "explained", "identity_error"] and len(got) == 150 and all(x.row == "y" for x in got)
    held_against_exact(got, clean, 6)


def test_op12(spark):
    got = whitening.op12_whitening(spark, DATA, 5).collect()
    rows = sorted((r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect())
    by = defaultdict(dict)
    for r in got:
        by[r.vec_id][r.component] = r
    assert sorted(by) == [i for i, _ in rows] and all(sorted(c) == [1, 2, 3, 4, 5] for c in by.values())

    class Row:
        def __init__(self, c):
            self.n, self.deviation, self.identity_error = c[1].n, c[1].deviation, c[1].identity_error
            self.whitened, self.explained = [c[i].whitened for i in range(1, 6)], [c[i].explained for i in range(1, 6)]

    held_against_exact([Row(by[i]) for i, _ in rows], [v for _, v in rows], 5)


def test_components_without_variance_are_null(spark):
    schema = "vec_id long, embedding array<float>"
    (one,) = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])], schema), 4).collect()
    assert (one.n, one.deviation, one.whitened, one.identity_error) == (1, 0, [None, None], None)
    flat = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0]), (2, [3.0, 2.0])], schema), 4).collect()
    assert all(r.whitened[1] is None and r.n == 3 for r in flat) and sorted(round(r.whitened[0] ** 2, 9) for r in flat) == [0.5, 0.5, 2.0]
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0


def test_outer_products_lose_nothing():
    r = np.random.default_rng(6)
    x = np.concatenate([r.standard_normal((2000, 5)) * 1e9, r.standard_normal((2000, 5)) * 1e-6])
    parts = [vectors.Outer(5) for _ in range(4)]
    for p, own in zip(parts, np.array_split(x, 4), strict=True):
        p.rows(own, np.zeros_like(own))
    out = vectors.Outer.merged(5, [p.high.tobytes() for p in parts], [p.low.tobytes() for p in parts])
    for i in range(5):
        for j in range(5):
            want = sum(Fraction(a) * Fraction(b) for a, b in zip(x[:, i].tolist(), x[:, j].tolist(), strict=True))
            got = Fraction(out.high[i, j].item()) + Fraction(out.low[i, j].item())
            assert abs(got - want) <= abs(want) * Fraction(1, 2**95) + Fraction(1, 2**80)


# -- 13: two tokenizers ----------------------------------------------------------
def groups(text):
    """[(ids of A, ids of B)] of a text, byte by byte; None without tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    one = groups.__dict__.setdefault("one", Tokenizer.from_file(A))
    one.encode_special_tokens = True
    two = groups.__dict__.setdefault("two", sentencepiece.SentencePieceProcessor(model_file=B))
    if not text:
        return []
    visible = {c: b for b, c in tokens._visible().items()}
    a = [(i, bytes(visible[c] for c in one.id_to_token(i))) for i in one.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode()) for i in two.encode(text) for p in [two.id_to_piece(i)]]
    if any(b"".join(x for _, x in s) != b" " + text.encode() for s in (a, b)):
        return []
    ends = [[sum(len(x) for _, x in s[: k + 1]) for k in range(len(s))] for s in (a, b)]
    cuts = sorted(set(ends[0]) & set(ends[1]))
    own = lambda s, e: [[i for (i, _), x in zip(s, e, strict=True) if lo < x <= hi] for lo, hi in zip([0, *cuts], cuts, strict=False)]
    return list(zip(own(a, ends[0]), own(b, ends[1]), strict=True))


TEXTS = [
    None, "", " ", "  two  spaces ", "a", "Plain words of a text.", "Plain words of a text.", "<|endoftext|> and <s> </s> <unk>", "▁ the mark itself", "tab\tline\nnul\x00", "中文 🎉 ẞ ﬁ é é",
    "x" * 700, " " * 300 + "y", "the the the and and " * 8, "né né",
]


def test_alignment_of_odd_texts(spark):
    rows = [(i, t, "k", "m") for i, t in enumerate(TEXTS)] + [(5, TEXTS[5], "k", "m")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, a string, groups string")
    out = alignment.align(docs, A, B)
    assert out.columns == ["doc_id", "text", "groups", "a", "b", "a_groups", "b_groups"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        cut = lambda ids, sizes: [ids[sum(sizes[:g]) : sum(sizes[: g + 1])] for g in range(len(sizes))]
        assert list(zip(cut(r.a, r.a_groups), cut(r.b, r.b_groups), strict=True)) == groups(r.text), r.text
    assert alignment.align(docs.limit(0), A, B).count() == 0
    assert not groups(TEXTS[8])  # a text that B does not spell as it is


def test_alignment_in_rows_is_the_same(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    tokens_ = alignment_rows.token_rows(docs, A, B)
    got = Counter((r.doc_id, r.group, r.a, r.b) for r in alignment_rows.link_rows(tokens_).collect())
    assert got == Counter((d, g, a, b) for d, t in enumerate(TEXTS) for g, (x, y) in enumerate(groups(t)) for a in x for b in y)


def corpus(texts):
    """The query's columns by document, from all links."""
    al = {k: groups(t) for k, t in texts.items()}
    n = Counter(p for g in al.values() for p in {(a, b) for x, y in g for a in x for b in y})
    best = Counter()
    for (a, _), c in n.items():
        best[a] = max(best[a], c)
    out = {}
    for k, g in al.items():
        links = [(a, b) for x, y in g for a in x for b in y]
        spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out[k] = (sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(links), sum(n[p] == best[p[0]] for p in links), sum(n[p] for p in links), hashlib.sha256(spelled.encode()).hexdigest() if g else "")
    return out


FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("frequent", [0, 40, 1 << 18])
def test_counts_of_pairs_in_two_tiers(spark, tmp_path, monkeypatch, frequent):
    texts = dict(enumerate([*TEXTS, *[t for t in h.odd_texts() if t is None or len(t) < 3000]]))
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(alignment.pair_sums, "__defaults__", (frequent,))
    got = {r.doc_id: tuple(r[f] for f in FIELDS) for r in alignment.op13_alignment(spark, str(tmp_path)).collect()}
    assert got == corpus(texts)


def test_op13(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").filter("length(text) < 6000 OR text IS NULL").collect()}
    got = {r.doc_id: r for r in alignment.op13_alignment(spark, DATA).collect()}
    assert len(got) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    for k, want in corpus(texts).items():  # counts over the corpus are those of the test above
        assert (got[k].n_a, got[k].n_b, got[k].n_groups, got[k].n_links, got[k].groups_sha256) == (*want[:4], want[6])


def test_large_groups_are_counted_by_their_ids(monkeypatch):
    monkeypatch.setattr(alignment, "LARGE", 2)
    one, two = alignment.side(A), alignment.side(B)
    x = alignment.Aligned.of(TEXTS, one, two)
    got = {(d, p >> alignment.ID_BITS, p & ((1 << alignment.ID_BITS) - 1)): m for d, p, m in zip(*(v.tolist() for v in x.pairs()), strict=True)}
    assert got == Counter((d, a, b) for d, t in enumerate(TEXTS) for u, v in groups(t) for a in u for b in v)
