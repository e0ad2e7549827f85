"""Connectors to literature services, over a table of their responses.

A service is asked through a function from addresses to texts, which a user
with a network gives; its responses are kept as rows (service, key, body) and
are asked for once.  What a response says is told by expressions over JSON, so
everything but the asking runs without a network.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.python import title_ratio

Fetch = Callable[[str], str | None]

#: The services' public addresses, by the kind of key.
ADDRESSES = {
    "pmc": "https://eutils.ncbi.nlm.nih.gov/entrez/eutils/esearch.fcgi?db=pmc&retmode=json&retmax=1&term={key}",
    "pmc_xml": "https://pmc.ncbi.nlm.nih.gov/api/oai/v1/mh/?verb=GetRecord&metadataPrefix=pmc&identifier=oai:pubmedcentral.nih.gov:{key}",
    "europe_pmc": "https://www.ebi.ac.uk/europepmc/webservices/rest/search?resultType=core&format=json&pageSize=1&query={key}",
    "biorxiv": "https://api.biorxiv.org/details/biorxiv/{key}", "medrxiv": "https://api.biorxiv.org/details/medrxiv/{key}",
    "unpaywall": "https://api.unpaywall.org/v2/{key}", "semantic_scholar": "https://api.semanticscholar.org/graph/v1/paper/DOI:{key}?fields=title,openAccessPdf",
    "crossref": "https://api.crossref.org/works/{key}", "crossref_title": "https://api.crossref.org/works?rows=1&select=DOI,title&query.title={key}",
}


def missing(asked: DataFrame, cache: DataFrame) -> DataFrame:
    """(service, key) that are asked for and not kept yet, once each."""
    return asked.select("service", "key").filter("key <> ''").distinct().join(cache.select("service", "key"), ["service", "key"], "left_anti")


def fetched(wanted: DataFrame, fetch: Fetch) -> DataFrame:
    """(service, key, body) of wanted; a failed or empty response has no row,
    so it is asked for again another time."""

    def run(batches):
        for b in batches:
            rows = []
            for service, key in zip(*(b.column(i).to_pylist() for i in (0, 1)), strict=True):
                try:
                    body = fetch(ADDRESSES[service].format(key=quote(key, safe="/:")))
                except Exception:  # noqa: BLE001  a service that fails is one without an answer
                    body = None
                if body:
                    rows.append((service, key, body))
            cols = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], ["service", "key", "body"])

    return wanted.select("service", "key").mapInArrow(run, "service string, key string, body string")


def refreshed(asked: DataFrame, cache: DataFrame, fetch: Fetch) -> DataFrame:
    """cache, and the responses to what it lacks."""
    return cache.unionByName(fetched(missing(asked, cache), fetch))


def keys(papers: DataFrame, doi: str = "doi", title: str = "title") -> DataFrame:
    """papers as (service, key, and their own columns): a DOI asks all
    services, a title only those that search."""
    d, t = F.regexp_replace(F.trim(doi), r"^https?://doi\.org/", ""), F.trim(title)
    has, words = F.coalesce(d != "", F.lit(False)), (F.length(t) > 10) & t.rlike("[A-Za-z]")
    plain = F.regexp_replace(t, "[^a-zA-Z0-9 ]", " ")
    row = lambda s, k: F.struct(F.lit(s).alias("service"), k.alias("key"))
    by_doi = F.array(row("pmc", F.concat(d, F.lit("[DOI]"))), row("europe_pmc", F.concat(F.lit("DOI:"), d)), *(row(s, d) for s in ("biorxiv", "medrxiv", "unpaywall", "semantic_scholar", "crossref")))
    by_title = F.array(row("pmc", F.concat(plain, F.lit("[Title]"))), row("europe_pmc", F.concat(F.lit('TITLE:"'), t, F.lit('"'))), row("crossref_title", t))
    return papers.withColumn("_k", F.explode(F.when(has, by_doi).when(words, by_title))).select("*", "_k.*").drop("_k")


def _get(path: str) -> Column:
    return F.nullif(F.get_json_object("body", path), F.lit(""))


def answers(responses: DataFrame, title: str = "title") -> DataFrame:
    """responses (service, key, body, title) with identifier, found_title and
    url, as each service tells them.

    A hit by title counts only if its title is like the one asked for.  A
    preprint's last version counts.  Unpaywall's best place gives its file,
    else its page.
    """
    s = F.col("service")
    collection = F.from_json(_get("$.collection"), "array<struct<doi: string, version: string>>")
    last = F.try_element_at(collection, F.lit(-1))
    preprint = F.when(last.isNotNull(), F.concat(F.lit("https://www."), s, F.lit(".org/content/"), last["doi"], F.lit("v"), F.coalesce(last["version"], F.lit("1")), F.lit(".full.pdf")))
    pmc = F.concat(F.lit("PMC"), _get("$.esearchresult.idlist[0]"))
    identifier = F.when(s == "pmc", pmc).when(s == "europe_pmc", _get("$.resultList.result[0].pmcid")).when(s == "crossref_title", _get("$.message.items[0].DOI")).when(s.isin("biorxiv", "medrxiv"), last["doi"])
    found = F.when(s == "europe_pmc", _get("$.resultList.result[0].title")).when(s == "semantic_scholar", _get("$.title")).when(s == "crossref", F.trim(_get("$.message.title[0]"))).when(s == "crossref_title", _get("$.message.items[0].title[0]"))
    url = F.when(s == "unpaywall", F.coalesce(_get("$.best_oa_location.url_for_pdf"), _get("$.best_oa_location.url"))).when(s == "semantic_scholar", _get("$.openAccessPdf.url")).when(s.isin("biorxiv", "medrxiv"), preprint)
    out = responses.withColumns({"identifier": identifier, "found_title": found, "url": url})
    by_title = F.col("key").startswith("TITLE:")
    like = ~by_title | (title_ratio(F.coalesce(title, F.lit("")), F.coalesce("found_title", F.lit(""))) > 0.8)
    return out.withColumn("identifier", F.when(like, F.col("identifier"))).drop("body")


def full_texts(responses: DataFrame) -> DataFrame:
    """Of responses with XML those that hold an article: long enough, and no
    message that there is none."""
    b = F.col("body")
    return responses.filter((F.length(b) >= 500) & F.contains(b, F.lit("<article")) & ~b.rlike("idDoesNotExist|noRecordsMatch"))


def marked_pages(pages: DataFrame, doc: str, page: str, text: str) -> DataFrame:
    """(doc, text): a document's pages in order, each under a mark with its
    number; empty pages are left out."""
    x = pages.filter(F.trim(F.coalesce(text, F.lit(""))) != "")
    mark = F.concat(F.lit("<!-- PAGE "), F.col(page).cast("string"), F.lit(" -->\n"), F.trim(text))
    return x.groupBy(doc).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), mark.alias("m")))), lambda r: r["m"]), "\n\n").alias("text"))


def with_page_text(parameters: DataFrame, pages: DataFrame, doc: str, page: str, text: str, source: str = "source_text") -> DataFrame:
    """parameters whose source text is followed by that of the page they name."""
    p = pages.select(doc, F.col(page).alias("source_page"), F.col(text).alias("_t"))
    return parameters.join(p, [doc, "source_page"], "left").withColumn(source, F.concat_ws(" ", source, "_t")).drop("_t")
