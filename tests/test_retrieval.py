"""The inverted file against all products."""

import numpy as np
import pytest

from tessera.operators import index


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(3)
    centres = r.standard_normal((12, 24))
    x = centres[r.integers(0, 12, 900)] + 0.6 * r.standard_normal((900, 24))
    x[800:] = centres[0] + 0.05 * r.standard_normal((100, 24))  # one hot cell
    x[5] = x[6]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(900, None)], "k long, embedding array<double>")
    return x, df


def nearest(x, asked, k):
    s = x[asked] @ x.T
    s[np.arange(len(asked)), asked] = -np.inf
    return {(int(q), int(j)) for q, order in zip(asked, np.argsort(-s, axis=1, kind="stable")[:, :k], strict=True) for j in order}


def test_exact_search_is_all_products(rows, monkeypatch):
    x, df = rows
    monkeypatch.setattr(index, "CHUNK", 100)
    monkeypatch.setattr(index, "BLOCK", 16)
    asked = df.filter("k % 20 = 0").withColumnRenamed("k", "q")
    got = index.exact(asked, df, "q", "k", k=7).collect()
    assert {(r.q, r.k) for r in got} == nearest(x, np.arange(0, 900, 20), 7)
    best = {(r.q, r.rank): r.score for r in got}
    assert all(best[q, k] >= best[q, k + 1] for q, k in best if (q, k + 1) in best)


def test_the_index_finds_nearly_all_in_fewer_cells(rows, monkeypatch):
    x, df = rows
    monkeypatch.setattr(index, "CHUNK", 50)
    fitted = index.fit(df, "k", "embedding", k=10)
    assert fitted.probes < len(fitted.centroids) == 30
    asked = df.filter("k % 20 = 0").withColumnRenamed("k", "q")
    found = index.search(asked, df, fitted, "q", "k", k=10)
    want = nearest(x, np.arange(0, 900, 20), 10)
    got = {(r.q, r.k) for r in found.collect()}
    assert len(got & want) >= 0.9 * len(want)
    told = index.recall(found, index.exact(asked, df, "q", "k", k=10), "q", "k").first()
    assert (told.queries, told.wanted, told.found) == (45, 450, len(got & want))


def test_no_rows(rows):
    _, df = rows
    none = df.limit(0)
    fitted = index.fit(none, "k", "embedding")
    assert index.search(none.withColumnRenamed("k", "q"), none, fitted, "q", "k").count() == 0
    assert index.exact(df.filter("k = 900").withColumnRenamed("k", "q"), df, "q", "k").count() == 0
