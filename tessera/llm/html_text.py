"""Main text of HTML pages by block rules in two passes.

The page is cut into blocks at block-level tags.  Pass one decides a block by
its link density, its length and the share of stop words, wherever it stands;
menus, forms and the like, and what names itself an advert or a comment, are
out by that sign.  Blocks that are short, or that have few stop words where an
article is expected, stay open.  Pass two gives an open block the label of its
nearest decided neighbours.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, map_arrow

#: Tags by their part in a page.
SKIPPED = frozenset("script style noscript template svg math head title iframe object canvas audio video select textarea button datalist".split())
CONTAINERS = frozenset("div section article main nav header footer aside form ul ol dl table figure details dialog menu fieldset blockquote body".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr td th caption figcaption pre hr address summary legend thead tbody tfoot html center".split())
ALWAYS_OUT = frozenset("nav aside footer form dialog menu fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN = frozenset("article main".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())

#: Words of class and id that name what is not the article, at
#: any place of a name; and those that do only at its begin, as in share-bar
#: but not in market-share.
OUT_WORDS = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertisements advertising banner promos promotion sponsor sponsored sponsors "
    "cookie cookies consent gdpr popup modal overlay paywall "
    "sidebar sidebars widget widgets menu menus nav navbar navigation navigations breadcrumb breadcrumbs toc "
    "footer footers masthead topbar toolbar comments commentlist disqus respond "
    "newsletter subscribe subscription signup login pagination pager".split()
)
FIRST_WORDS = frozenset(
    "notice notices notification notifications alert alerts rail promo comment reply replies discussion related recommended recommendations "
    "share sharing social search copyright legal skip".split()
)
HEADER_WORDS = frozenset("header head topbar site-header".split())

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = frozenset(
    "the of and to in a is that it for on was with as be by at this from or are an not have which but all were when we there can more "
    "le la les de des du un une et est en que qui dans pour par sur pas au aux avec ce se sont ou plus ne il elle "
    "der die das und ist in den von zu mit sich auf für dem nicht ein eine als auch es an werden aus er hat dass sie nach bei um am "
    "el los las y se del por con no una su para al lo como más o pero sus le ha me si sin sobre este ya".split()
)

#: A block of SHORT characters gives no sign by itself; one of LONG does with
#: the stop words of DENSE; above LINKS of its characters in links it is a menu.
SHORT, LONG, DENSE, SPARSE, LINKS = 70, 200, 0.25, 0.12, 0.5

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>", re.DOTALL)
_ATTR = re.compile(r"\b(class|id|role|style)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_WORD = re.compile(r"[^\W\d_]+")


class Block(NamedTuple):
    text: str
    linked: int
    out: bool
    main: bool
    heading: int  # 1 for the title, 2 for other headings, 0


def _named_out(attrs: str, in_main: bool) -> bool:
    if _HIDDEN.search(attrs):
        return True
    for name, *values in _ATTR.findall(attrs):
        value = next((v for v in values if v), "")
        if name.lower() == "role":
            if value.lower() in OUT_ROLES:
                return True
        elif name.lower() != "style":
            for token in value.split():
                words = [x.lower() for x in _PART.findall(token)]
                if words and (words[0] in FIRST_WORDS or not OUT_WORDS.isdisjoint(words) or not in_main and not HEADER_WORDS.isdisjoint(words)):
                    return True
    return False


def blocks(page: str) -> list[Block]:
    """The page's text blocks, white space folded, references decoded."""
    found: list[Block] = []
    stack: list[tuple[str, bool, bool]] = []  # container, out, in the main part
    run: list[str] = []
    linked = link = heading = 0
    at, end = 0, len(page)
    inline_out = None  # a p or the like that is named out

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(run).split())
        if text:
            out, main = (stack[-1][1], stack[-1][2]) if stack else (False, False)
            found.append(Block(text, linked, out or inline_out is not None, main, heading))
        run.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        text = html.unescape(piece)
        run.append(text)
        if link:
            linked += len(" ".join(text.split()))

    while at < end:
        m = _TAG.search(page, at)
        if not m:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        closes, attrs = bool(m[1]), m[3]
        if name in SKIPPED:
            if not closes and not attrs.endswith("/"):
                close = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
                # an unclosed script hides what follows; other tags just open
                at = close.end() if close else end if name in ("script", "style") else at
            continue
        if name == "a":
            link = 0 if closes else 1
        elif name == "br":
            run.append(" ")
        elif name in BLOCKS:
            flush()
            link = 0
            inline_out = None
            if name in CONTAINERS:
                if closes:
                    for k in range(len(stack) - 1, -1, -1):
                        if stack[k][0] == name:
                            del stack[k:]
                            break
                elif not attrs.endswith("/"):
                    out, main = (stack[-1][1], stack[-1][2]) if stack else (False, False)
                    main = main or name in MAIN
                    bad = name in ALWAYS_OUT or name == "header" and not main or name != "body" and _named_out(attrs, main)
                    stack.append((name, out or bad, main))
            elif not closes and attrs and _named_out(attrs, True):
                inline_out = name
            if name in HEADINGS:
                heading = 0 if closes else 1 if name == "h1" else 2
    flush()
    return found


def decide(b: Block, has_main: bool) -> bool | None:
    """Pass one: main text, none, or open.

    has_main: the page has a part that calls itself the article.  There few
    stop words leave a block open, as tables and names have few; outside of it
    only a long block with many is text.
    """
    n = len(b.text)
    if b.out:
        return False
    if b.main and b.heading == 1:
        return True
    if b.linked > LINKS * n:
        return None if b.main and b.heading else False
    if b.heading or n < SHORT:
        return None
    words = _WORD.findall(b.text.lower())
    share = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if b.main:
        return True if share >= SPARSE else None
    if has_main:
        return True if n >= LONG and share >= DENSE else False if share < SPARSE else None
    return True if share >= DENSE or n >= LONG and share >= SPARSE else False if share < SPARSE else None


def inherit(first: list[bool | None], headings: list[int], edge: bool | None) -> list[bool]:
    """Pass two over the blocks of one part: an open block takes the label of
    the nearest decided block; a heading that of the next one.  Of two equally
    near ones that differ, and where there is none, that of the part's edge
    counts; edge, if known, also stands before the first and after the last."""
    n, out = len(first), []
    after: list[int | None] = [None] * n
    near = None
    for i in range(n - 1, -1, -1):
        after[i] = near
        if first[i] is not None:
            near = i
    near = None
    for i, v in enumerate(first):
        if v is not None:
            near = i
            out.append(v)
            continue
        left = (i - near, first[near]) if near is not None else (i + 1, edge)
        right = (after[i] - i, first[after[i]]) if after[i] is not None else (n - i, edge)
        known = [x for x in (left, right) if x[1] is not None]
        if headings[i] and after[i] is not None:
            out.append(bool(right[1]))
        elif not known:
            out.append(False)
        elif len(known) == 2 and left[0] == right[0] and left[1] != right[1]:
            out.append(bool(edge))
        else:
            out.append(bool(min(known)[1]))
    return out


def labels(found: list[Block]) -> list[bool]:
    """Which blocks are of the main text.  The article and the rest of the
    page inherit each for itself; what is out by a sign is no neighbour in the
    article, and decided elsewhere."""
    has_main = any(b.main and not b.out for b in found)
    first = [decide(b, has_main) for b in found]
    out = [False] * len(found)
    for main, edge in ((True, True), (False, False if has_main else None)):
        at = [i for i, b in enumerate(found) if (b.main and not b.out) == main]
        for i, v in zip(at, inherit([first[i] for i in at], [found[i].heading for i in at], edge), strict=True):
            out[i] = v
    return out


def main_text(page: str) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, keep in zip(found, labels(found), strict=True) if keep)


def extract(pages: DataFrame, column: str = "html", out: str = "text") -> DataFrame:
    """pages, without the html, with the main text in `out`.

    A null or empty page has an empty text, as has one without main text; a
    very long page is read whole, by one task; equal rows get equal texts; in
    pass two a tie goes to the article inside of it and against it elsewhere;
    an empty table gives an empty one; a column of pages named `out` is
    replaced.
    """
    pages = pages.drop(*([out] if out != column else []))
    keep = [c for c in pages.columns if c != column]
    schema = pages.select(*keep, F.lit("").alias(out)).schema
    at = pages.columns.index(column)
    kept = [pages.columns.index(c) for c in keep]

    def run(batches):
        for b in chunks(batches, column, 1 << 20):
            texts = [main_text(x) if x else "" for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in kept), pa.array(texts, pa.string())], [*keep, out])

    return map_arrow(pages, run, schema)


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
