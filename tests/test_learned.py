"""The learned filter on small tables, and its measure against brute force."""

import random

import pytest

from tessera.operators import learned

DOCS = "k long, text string, label string"


@pytest.fixture(scope="module")
def model(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    rows = [(i, " ".join(word() + ("%%%" if i % 3 == 0 else "") for _ in range(30)), "junk" if i % 3 == 0 else "prose") for i in range(90)]
    rows += [(100, None, "junk"), (101, "", "prose"), (102, "no label here", None)]
    known = spark.createDataFrame(rows, DOCS)
    return learned.fit(known, "k", "text", "label"), known


def test_classes_of_new_texts(spark, model):
    m, _ = model
    new = spark.createDataFrame([(1, "xyz%%% uvw%%% rst%%%", None), (2, "xyz uvw rst", None), (3, None, None), (4, "", None), (None, "a%%%", None)], DOCS)
    got = {r.k: r for r in learned.chosen(learned.score(new, m, "k", "text"), m).collect()}
    assert m.classes == ["junk", "prose"] and got[1].choice == "junk" and got[2].choice == "prose" and len(got) == 5
    assert all(abs(sum(r.scores) - 1) < 1e-9 for r in got.values()) and got[None].choice == "junk"


def test_short_texts_are_kept_unasked(spark, model):
    m, _ = model
    new = spark.createDataFrame([(1, "a%%% " * 3, None), (2, "abcde%%% " * 30, None), (3, None, None), (4, "abcde " * 30, None)], DOCS)
    got = {r.k: (r.score, r.keep) for r in learned.relevance(new, m, "k", "text", "prose").collect()}
    assert got[1] == got[3] == (1.0, True) and not got[2][1] and got[4][1]


def test_most_rows_are_those_of_the_least_digest(spark, model):
    import hashlib

    _, known = model
    want = sorted((r.k for r in known.collect()), key=lambda k: hashlib.md5(str(k).encode()).hexdigest())[:10]
    assert sorted(r.k for r in learned.labelled(known, "k", 10).collect()) == sorted(want)


def test_empty_tables(spark, model):
    m, known = model
    assert learned.score(known.limit(0), m, "k", "text").count() == 0
    assert learned.fit(known.limit(0), "k", "text", "label").classes == []


def test_too_many_classes(spark):
    rows = spark.createDataFrame([(i, "a b", f"c{i}") for i in range(learned.CLASSES + 1)], DOCS)
    with pytest.raises(ValueError, match="classes"):
        learned.fit(rows, "k", "text", "label")


def test_auc_is_the_chance_of_a_higher_score(spark):
    r = random.Random(1)
    rows = [(round(r.random(), 2), r.random() < 0.4) for _ in range(300)]
    got = learned.auc(spark.createDataFrame(rows, "s double, y boolean"), "s", "y").first()
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    want = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    assert (got.positives, got.negatives) == (len(pos), len(neg)) and abs(got.auc - want) < 1e-9


def test_texts_are_sent_of_taken_rows_alone(spark):
    rows = spark.createDataFrame([(i % 40, f"t{i % 40}", "x") for i in range(80)] + [(None, "n", "x")], DOCS)
    got = learned.labelled(rows, "k", 7)
    assert [r.k for r in got.collect()] == [r.k for r in rows.orderBy(learned.F.md5(learned.F.col("k").cast("string")), "k").limit(7).collect()]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("GlobalLimit 7") == 2


def test_the_queries_fit_on_all_labelled_rows(spark):
    import hashlib

    from tessera.catalog import ORACLE_SQL
    from tessera.plans import learned as plan

    ids = [i for i in range(25_200) if i % 5]
    last = max(ids, key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    rows = [(i, "a b" + " alone" * (i == last), "good" if i % 2 else "poor") for i in ids]
    got = plan._model(spark.createDataFrame(rows, "doc_id long, text string, label string"), "label")
    assert got.weights.filter("feature = 'w:alone'").count() == 1
    assert not any("md5" in ORACLE_SQL[q] for q in plan.QUERIES)


def test_most_held_features_are_taken_without_k_of_each_task(spark):
    r = random.Random(2)
    rows = [(f"f{i}", r.randint(1, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "feature string, n long").repartition(6)
    for k in (0, 1, 40, 400, 900):
        want = sorted(rows, key=lambda x: (-x[1], x[0]))[:k]
        assert [tuple(x) for x in learned.most(df, "n", "feature", k).collect()] == want
    few = learned.most(df, "n", "feature", 40)._jdf.queryExecution().optimizedPlan().toString()
    assert ">= 9" in few or ">= 8" in few
