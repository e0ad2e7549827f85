import hashlib
import io

import pyarrow as pa
import pytest
import zstandard

from tessera.llm import decontamination, html_text, quality, urls, warc
from tests.llm import helpers as h


def test_quality_verdicts_hang_on_the_rules_not_on_their_order(spark):
    docs = h.odd_documents(spark)
    got = {(r.doc_id, r.text): r.kept for r in quality.judge(docs, measure=quality.BASE_COLUMNS).collect()}
    texts = [(t or "").encode() for _, t in got]
    for rules in (quality.RULES, quality.RULES[::-1]):
        assert quality.cascade(quality.Chunk(texts), rules).tolist() == list(got.values())
    kept = {i for (i, _), k in got.items() if k}
    assert {0, 1, 2, 3, 6} <= kept and not kept & {7, 8, 9, 10, 11, 12, 21, 22, 23}
    assert quality.judge(h.no_documents(spark)).count() == 0


def test_rules_are_ordered_by_what_is_left_and_by_what_is_new():
    """A rule that rejects what others have rejected comes last; a statistic
    that is there already costs nothing."""
    import numpy as np

    a, b, c = (quality.Rule(n, needs, None) for n, needs in (("a", ("x",)), ("b", ("x", "y")), ("c", ("z",))))
    verdicts = np.array([[1, 1, 0], [1, 1, 0], [0, 0, 1], [0, 0, 0]], bool)
    assert [r.name for r in quality.order((a, b, c), verdicts, {"x": 1.0, "y": 0.1, "z": 2.0})] == ["a", "c", "b"]
    assert [r.name for r in quality.order((a, b, c), verdicts, {"x": 9.0, "y": 1.0, "z": 2.0})] == ["c", "a", "b"]


def test_only_the_living_are_measured():
    texts = [b"few words", b"word! " * 60, b" ".join(b"word%d" % i for i in range(80))]
    chunk = quality.Chunk(texts)
    few, shout, length = (next(r for r in quality.RULES if r.name == n) for n in ("few_words", "shouting", "word_length"))
    assert quality.cascade(chunk, (few, shout, length)).tolist() == [False, False, True]
    assert (chunk.computed("n_words"), chunk.computed("n_bangs"), chunk.computed("word_chars"), chunk.computed("n_lines")) == (3, 2, 1, 0)


def test_repeat_words_of_brute_force():
    import random

    r = random.Random(4)
    texts = [" ".join(r.choice("abc") for _ in range(n)) for n in (0, 1, 2, 3, 5, 9, 40)]
    got = quality.Chunk([t.encode() for t in texts])("n_repeat_words", __import__("numpy").arange(len(texts)))
    for t, n in zip(texts, got, strict=True):
        w = t.split()
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        assert n == len({i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)})


def test_decontamination_of_brute_force(spark, duck):
    item = " ".join(f"Item{i}" for i in range(14))
    items = spark.createDataFrame([(1, item), (2, "Short item, four words"), (3, "zz"), (4, None), (5, "--"), (6, item.lower()), (7, " ".join(f"q{i}" for i in range(8)))], "item_id long, text string")
    w = item.split()
    texts = ["x " * 5 + " ".join(w[2:12]) + " y", " ".join(w[:9]), " ".join(w), "a short ITEM four; words b", "zz top zz", None, "", " ".join(f"Q{i}" for i in range(8)) + " zz", " ".join(w[:12] + ["no"] + w[3:])]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, texts[0]])], "doc_id long, text string")
    got = sorted(tuple(r) for r in decontamination.contaminated(docs, items).collect())
    d, b = docs.toPandas(), items.toPandas()
    sql = decontamination.ORACLE.replace("FROM documents", "FROM d").replace("FROM benchmark)", "FROM b)").replace("WITH d AS", "WITH dd AS").replace("FROM d, ks", "FROM dd, ks").replace("FROM d LEFT", "FROM dd LEFT").replace("b AS (SELECT item_id", "bb AS (SELECT item_id").replace("FROM b, unnest", "FROM bb, unnest")
    import duckdb

    c = duckdb.connect()
    c.register("d", d)
    c.register("b", b)
    assert got == sorted(c.sql(sql).fetchall())
    assert decontamination.contaminated(h.no_documents(spark), items).count() == 0
    assert decontamination.contaminated(docs, items.filter("false")).filter("contaminated").count() == 0


def test_urls(spark):
    rows = [(1, "http://A.example.COM/en/5?x"), (2, "https://b.example.com/en/7/a"), (3, "http://example.net/de/8"), (4, "http://x.net/de/9#t"), (5, None), (6, "nothing"), (7, "http://com"), (8, "ftp://org/es/"), (9, "http://xcom/en/1"), (10, "http://h.io/en/" + "s" * 9000)]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(spark.createDataFrame([r + ("v",) for r in rows], "page_id int, url string, verdict string")).collect()}
    assert got[1] == ("a.example.com", "/en/5", "com/en/", "block") and got[2][2:] == ("example.com/en/7", "allow")
    assert got[3][2:] == ("example.net/de/8", "block") and got[4][2:] == ("net/de/", "allow")
    assert got[5][:3] == ("", "", None) and got[6][:3] == ("", "", None) and got[7][:3] == ("com", "", None)
    assert got[8][2:] == ("org/es/", "block") and got[9][2] is None and len(got) == 10
    assert urls.judge_urls(spark.createDataFrame([], "page_id int, url string")).count() == 0


def test_templates_reject_by_labelled_purity(spark):
    """Urls that no rule fits share the verdict of a template of blocked ones."""
    rules = (("block", "bad.io", "p/1"), ("allow", "good.io", "p/1"))
    rows = [(i, f"http://{x}.io/p/1{i}") for i in range(20) for x in ("bad", "good")] + [(100, "http://bad.io/p/99"), (101, "http://good.io/p/99"), (102, "http://bad.io/other")]
    got = {r.page_id: r.verdict for r in urls.judge_urls(spark.createDataFrame(rows, "page_id int, url string"), rules).collect()}
    assert (got[100], got[101], got[102]) == ("block", "allow", "allow")


def test_url_templates_are_as_deep_as_the_urls(spark):
    deep = [f"http://x.io/a/b/{kind}/{i}" for kind in ("spam", "news") for i in (*range(100, 120), 2)]
    more = ["http://x.io/a/b/c/d/e/f", "http://x.io/a/b", "http://x.io/a", "http://x.io", "http://x.io/a/b/c"]
    rules = (("block", "x.io", "a/b/spam/1"), ("allow", "x.io", "a/b/news/1"))
    df = spark.createDataFrame([(u,) for u in deep + more], "url string")
    got = {r.url: (r.verdict, r.template) for r in urls.judge_urls(df, rules).collect()}
    assert got["http://x.io/a/b/spam/2"] == ("block", "x.io/a/b/spam/<n>")
    assert got["http://x.io/a/b/news/2"] == ("allow", "x.io/a/b/news/<n>")
    assert [got[u][1] for u in more] == ["x.io/a/b/c/d/e/f", "x.io/a/b/", "x.io/a//", "x.io///", "x.io/a/b/c"]


PARAGRAPH = "The quick brown fox and the lazy dog were in the garden, and it was one of the days that all of us have liked for years. "


@pytest.mark.parametrize("page,want", [
    ("<p>" + PARAGRAPH, PARAGRAPH.strip()),
    ("<nav><a href='/'>Home</a></nav><article><h1>T&amp;T</h1><p>Short.</p><p>a <b>b</b>\n c<br>d</p></article><footer>&copy; x</footer>", "T&T\nShort.\na b c d"),
    ("<article><p>One text.</p><div class='comments'><p>" + PARAGRAPH + "</p></div><aside><p>Side</p></aside><form>F</form></article>", "One text."),
    ("<div id='menu'><a>a</a></div><div><h2>Head</h2><p>" + PARAGRAPH * 2 + "</p><p>Short one.</p><p>" + PARAGRAPH + "</p></div><div class='cookie-notice'>" + PARAGRAPH + "</div>", "Head\n" + (PARAGRAPH * 2).strip() + "\nShort one.\n" + PARAGRAPH.strip()),
    ("<script>var a='<p>no</p>'</script><style>x</style><!-- <p>no</p> --><main><p>yes it is</p></main>", "yes it is"),
    ("<article><ul><li><a href='x'>link one</a></li></ul><p>text &lt;tag&gt; &#233;</p></article>", "text <tag> é"),
    ("", ""), ("<<<>>><p", ""),
    ("<article><h1><a href='/x'>Linked title</a></h1><p>" + PARAGRAPH + "</p></article>", "Linked title\n" + PARAGRAPH.strip()),
    ("<article><section id='market-share'><p>" + PARAGRAPH + "</p></section><section class='share-bar'><p>" + PARAGRAPH + "</p></section></article>", PARAGRAPH.strip()),
    ("<article><p>A teaser.</p></article><div><p>" + PARAGRAPH * 3 + "</p><p>Short.</p><p>" + PARAGRAPH * 2 + "</p></div><div>All rights reserved</div>", "A teaser.\n" + (PARAGRAPH * 3).strip() + "\nShort.\n" + (PARAGRAPH * 2).strip()),
    ("<article><p>" + PARAGRAPH + "</p><h2>More</h2><ul><li><a>one</a></li><li><a>two</a></li></ul></article>", PARAGRAPH.strip()),
])
def test_main_text(page, want):
    assert html_text.main_text(page) == want


def test_open_blocks_inherit_as_brute_force_says():
    import random

    r = random.Random(8)
    for _ in range(400):
        first = [r.choice((True, False, None, None)) for _ in range(r.randint(0, 9))]
        heads, edge = [r.choice((0, 0, 2)) for _ in first], r.choice((True, False, None))
        want = []
        for i, v in enumerate(first):
            decided = [(k, x) for k, x in enumerate(first) if x is not None]
            later = [x for k, x in decided if k > i]
            if edge is not None:
                decided += [(-1, edge), (len(first), edge)]
            near = min((abs(k - i) for k, _ in decided), default=None)
            found = {x for k, x in decided if abs(k - i) == near}
            want.append(v if v is not None else later[0] if heads[i] and later else False if not found else bool(edge) if len(found) == 2 else found.pop())
        assert html_text.inherit(first, heads, edge) == want


def test_both_passes_decide_blocks_of_pages(spark):
    """On given pages some blocks are decided by words, some by neighbours."""
    from tests.conftest import DATA

    by = {"words": 0, "neighbours": 0}
    for row in spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "html").collect():
        found = html_text.blocks(row.html or "")
        kept = html_text.labels(found)
        for b, k in zip(found, kept, strict=True):
            v = html_text.decide(b, True)
            if b.main and not b.heading and not b.out:
                by["neighbours" if v is None else "words"] += k
    assert min(by.values()) > 20


def test_op6_query_is_its_operator_page_by_page(spark):
    from tests.conftest import DATA

    pages = {r.page_id: r for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    got = html_text.op6_html_text(spark, DATA).collect()
    assert len(got) == len(pages)
    for r in got:
        text = html_text.main_text(pages[r.page_id].html or "")
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, text, len(text))


def test_extract_of_odd_rows(spark):
    pages = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "<p>" + "word " * 50_000, None)], "page_id long, html string, text string")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert got[1] == got[2] == "" and set(got) == {1, 2, 3}
    assert html_text.extract(pages.filter("false")).count() == 0


def test_bundles_are_seekable_and_plain_zstandard():
    w = warc.BundleWriter(frame=1000)
    records = [warc.make_record(i, f"http://x/{i}", b"p" * (i * 97), hashlib.sha1(b"p" * (i * 97)).hexdigest(), None) for i in range(40)]
    places = [w.add(r) for r in records]
    data = w.finish()
    reader = warc.BundleReader(pa.BufferReader(data))
    for record, (frame, at) in zip(records, places, strict=True):
        assert reader.read(frame)[at : at + len(record)] == record
    assert len(reader.frames) > 3
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read() == b"".join(records)


def test_archives_round_trip(spark, tmp_path):
    big = "<p>" + "ü" * 1000
    rows = [(1, "u", big), (2, None, big), (3, "u\r\nX: y", big), (3, "u", big), (4, "u", None), (5, "u", "small"), (6, "u", "small"), (None, "u", "z" * 2000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, bundle string")
    folder = f"file://{tmp_path}"
    got = warc.read_archives(warc.write_archives(pages, folder), folder, with_payload=True).collect()
    assert sorted((str(r.page_id), bytes(r.payload).decode()) for r in got) == sorted((str(i), t or "") for i, _, t in rows)
    for r in got:
        assert r.payload_digest == hashlib.sha1(bytes(r.payload)).hexdigest() and r.payload_bytes == len(r.payload)
    assert sorted((r.page_id, r.refers_to) for r in got if r.record_type == "revisit") == [(1, 3), (2, 3)]
    assert warc.read_archives(warc.write_archives(pages.filter("false"), folder), folder).count() == 0
