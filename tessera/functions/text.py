"""Normal forms of text, identifiers and units, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normal_text(c: Column) -> Column:
    """Trimmed, lower case, white space folded; null is the empty text."""
    folded = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"(?U)\s+", " ")
    return F.trim(folded)


def normal_identifier(c: Column) -> Column:
    """normal_text without anything but a-z and 0-9; white space is not folded
    first, as none of it stays."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "")


def normal_unit(c: Column) -> Column:
    """One spelling of a unit: micro signs, blanks, stars, x^-1 and per."""
    u = F.translate(normal_text(c), "μµ *", "uu")
    return F.replace(F.regexp_replace(u, r"([a-z]+)\^-1", "/$1"), F.lit("per"), F.lit("/"))


def normal_list(c: Column) -> Column:
    """A list's identifiers, sorted, joined by `|`."""
    return F.array_join(F.sort_array(F.transform(F.coalesce(c, F.array().cast("array<string>")), normal_identifier)), "|")


def table_form(c: Column) -> Column:
    """`Table S1: doses` as `tables1`; other texts without white space."""
    t = F.regexp_replace(normal_text(c), r"(?U)\s+", "")
    head = F.regexp_extract(t, r"^(tables?\d+)", 1)
    return F.when(head != "", head).otherwise(t)


def verification_form(c: Column) -> Column:
    """Dashes unified, no white space, lower case: for verbatim tests."""
    t = F.translate(F.lower(F.coalesce(c, F.lit(""))), "−–—", "---")
    return F.regexp_replace(t, r"(?U)\s+", "")


def symbol_form(c: Column) -> Column:
    """A name that model languages take: word characters, 40 at most."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), "[^A-Za-z0-9_]+", "_")
    t = F.regexp_replace(F.regexp_replace(t, "_+", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(F.substring(t, 1, 40), F.lit("")), F.lit("param"))


def stable_id(*identity: Column) -> Column:
    """param_ and 16 hex digits of the identity's SHA-256."""
    joined = F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("")) for c in identity))
    return F.concat(F.lit("param_"), F.substring(F.sha2(F.lower(joined), 256), 1, 16))


def nonempty(c: Column) -> Column:
    return F.coalesce(F.trim(c) != "", F.lit(False))


def doi(c: Column) -> Column:
    """The first DOI of a text, lower case, without a resolver or last dots."""
    found = F.regexp_extract(F.lower(F.coalesce(c, F.lit(""))), r"(10\.\d{4,9}/[^\s\"'<>]+)", 1)
    return F.nullif(F.regexp_replace(found, r"[.,;]+$", ""), F.lit(""))


def scrub(c: Column) -> Column:
    """Text without the years of citations and the exponents of weights."""
    year = r"(?:19|20)\d{2}[a-z]?"
    t = F.regexp_replace(c, rf"\({year}\)|(?i:et\s+al)\.?,?\s*{year}", "")
    return F.trim(F.regexp_replace(t, r"kg\^?0\.\d+", "kg"))


def without_fences(c: Column) -> Column:
    """A model's answer without thinking and code fences, and without the
    commas before closing brackets that JSON does not allow."""
    t = F.regexp_replace(c, r"(?s)<think>.*?</think>", "")
    inner = F.regexp_extract(t, r"(?s)```(?:json)?\s*(.*?)```", 1)
    t = F.regexp_replace(F.when(inner != "", inner).otherwise(t), r"^\s+|\s+$", "")
    return F.regexp_replace(t, r",\s*([}\]])", "$1")


def without_empty_brackets(c: Column) -> Column:
    """Text without the brackets that removed citations leave, blanks folded."""
    t = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"\(\s*\)", ""), r"\[\s*\]", ""), r"\(\s*;\s*\)", "")
    return F.regexp_replace(t, r"\s{2,}", " ")


def first_errors(errors: Column, k: int = 5) -> Column:
    """A short text of validation errors, array<struct<path: array<string>,
    message: string, received: string>>: the first k, a line each."""
    got = lambda e: F.when(e["received"].isNotNull(), F.concat(F.lit(" (received: '"), F.substring(e["received"], 1, 40), F.lit("')"))).otherwise("")
    return F.array_join(F.transform(F.slice(errors, 1, k), lambda e: F.concat(F.lit("- Location '"), F.array_join(e["path"], " -> "), F.lit("': "), e["message"], got(e))), "\n")


def data_uri(c: Column, kind: str = "image/png") -> Column:
    return F.concat(F.lit(f"data:{kind};base64,"), F.base64(c))


def without_bibliography(c: Column, heading: str = r"(?im)^#{0,4}\s*(?:references|bibliography)\s*$", back: str = r"(?im)^#{1,4}\s*(?:appendix|supplement|table)") -> Column:
    """The text without its list of references; what comes after it again
    under an appendix's or a table's heading stays."""
    cut = F.split(c, heading, 2)
    rest = F.regexp_extract(F.try_element_at(cut, F.lit(2)), back + r"(?s:.*)", 0)
    return F.when(F.size(cut) > 1, F.concat(cut[0], rest)).otherwise(c)
