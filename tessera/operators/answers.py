"""A questionnaire answered from what was extracted, without a model.

facts: one row a document.  Collections of evidence are arrays of
struct(page, section, location, quote); an answer stands only on evidence that
can be looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .assess import ITEMS, NONE, SELF
from .repair import keep_first

EVIDENCE = "array<struct<page: int, section: string, location: string, quote: string>>"

#: Columns of facts, in Spark types.
FACTS = {
    "title": "string", "journal": "string", "purpose": "string", "context_quote": "string", "model_origin": "string", "has_structure": "boolean", "structure_location": "string",
    "n_compartments": "int", "n_connections": "int", "equations_provided": "string", "n_equations": "int", "n_scaling": "int", "n_assumptions": "int", "phases": "array<string>", "categories": "array<string>",
    "n_parameters": "int", "n_referenced": "int", "n_uncertain": "int", "has_distributions": "boolean", "n_pathways": "int", "roles": "array<string>", "metrics": "array<string>", "n_observed": "int", "n_simulated": "int",
    "n_dosing": "int", "n_populations": "int", "n_life_stages": "int", "software": "array<string>", "n_sensitivity": "int", "has_extended": "boolean", "has_key_parameters": "boolean", "has_impact": "boolean",
    **{f"{c}_evidence": EVIDENCE for c in ("context", "determinant", "assumption", "phase", "parameter", "table", "observed", "simulated", "dosing", "sensitivity", "software")},
}

YES, PARTLY = "yes", "partially"

#: What each item rests on, as items (without their prefix), the
#: evidence in its order, each collection with how many at most, and when the
#: answer is yes, or partially; HAS: there is any evidence.
HAS = "HAS"
RULES = (
    ("1.1 1.2", "bibliography parameter:2 table:2", "", HAS),
    ("2.1.1 2.1.2 2.3.1", "context purpose observed:2 simulated:2", "trim(purpose) <> '' AND trim(context_quote) <> ''", HAS),
    ("2.1.3", "context purpose observed:2 simulated:2", "", ""),
    ("2.2.1", "parameter:6 table:6 context purpose", "", "n_parameters > 0"),
    ("2.4.1 2.4.3.1", "context purpose structure determinant assumption", "", "trim(model_origin) <> '' OR has_structure OR n_assumptions > 0"),
    ("2.4.2A", "parameter:8 table:8", "", "n_parameters + n_pathways > 0"),
    ("2.4.2B", "observed:8 simulated:8", "exists(roles, r -> lower(r) = 'calibration')", ""),
    ("2.4.2C", "observed:8 simulated:8", "exists(roles, r -> lower(r) IN ('independent_evaluation', 'external_validation'))", ""),
    ("2.4.3.2", "context purpose structure determinant assumption", "n_compartments + n_connections > 0", ""),
    ("2.4.3.3", "absorption", "array_contains(phases, 'absorption')", ""),
    ("2.4.3.4", "distribution_binding", "array_contains(phases, 'distribution_binding')", ""),
    ("2.4.3.5", "distribution_tissue", "array_contains(phases, 'distribution_tissue')", ""),
    ("2.4.3.6", "metabolism", "array_contains(phases, 'metabolism')", ""),
    ("2.4.3.7", "excretion_recirculation", "array_contains(phases, 'excretion_recirculation')", ""),
    ("2.4.3.8", "barrier_life_stage_transfer", "array_contains(phases, 'barrier_life_stage_transfer')", ""),
    ("2.4.3.9", "assumption determinant", "array_contains(categories, 'tissue_perfusion_diffusion_lumping')", ""),
    ("2.4.3.10", "assumption determinant", "array_contains(categories, 'protein_binding_free_fraction')", ""),
    ("2.4.3.11", "assumption determinant", "array_contains(categories, 'cross_species_cross_chemical_borrowing')", ""),
    ("2.4.3.12", "assumption determinant", "array_contains(categories, 'clearance_resorption_ontogeny')", ""),
    ("2.4.3.13", "assumption determinant", "array_contains(categories, 'dosing_exposure_steady_state')", ""),
    ("2.4.4", "equations", "", "n_equations + n_scaling > 0 OR equations_provided <> 'none'"),
    ("2.4.5A", "parameter:8 table:8", "n_parameters > 0", ""),
    ("2.4.5B", "parameter:8 table:8", "n_parameters > 0 AND n_referenced = n_parameters", "n_referenced > 0"),
    ("2.4.5C", "parameter:8 table:8", "", "has_distributions OR n_uncertain > 0"),
    ("2.4.6A", "dosing:6 observed:5 simulated:5 context purpose", "n_dosing > 0", ""),
    ("2.4.6B", "dosing:6 observed:5 simulated:5 context purpose", "", "n_observed + n_simulated + n_populations + n_life_stages > 0"),
    ("2.4.7", "software", "size(filter(software, s -> trim(s) <> '')) >= 4", "size(filter(software, s -> trim(s) <> '')) > 0"),
    ("2.5.1A", "observed:8 simulated:8", "n_observed > 0 AND n_simulated > 0", "n_observed + n_simulated > 0"),
    ("2.5.1B", "observed:8 simulated:8", "exists(metrics, m -> exists(array('aafe', 'rmse', 'r2', 'r^2', 'mfe', 'goodness'), w -> contains(lower(m), w)))", ""),
    ("2.5.2A", "sensitivity:6 extended", "", "n_sensitivity > 0 OR has_extended"),
    ("2.5.2B", "sensitivity:6 extended", "", "has_key_parameters OR has_impact OR n_sensitivity > 0"),
)
#: What is no collection of facts: a section's name, when it is evidence, and
#: its place and quote.
PIECES = {
    "bibliography": ("bibliographic metadata", "coalesce(nullif(title, ''), nullif(journal, '')) IS NOT NULL", "null", "coalesce(nullif(title, ''), nullif(journal, ''))"),
    "purpose": ("model context / purpose", "trim(purpose) NOT IN ('', 'not_reported')", "null", "context_quote"),
    "structure": ("model structure", "has_structure", "structure_location", "null"),
    "equations": ("model equations", "has_structure", "structure_location", "null"),
    "extended": ("extended sensitivity metadata", "has_extended", "null", "null"),
}
PREFIX = "TAN_"


def with_facts(df: DataFrame) -> DataFrame:
    """df with the columns of FACTS that it lacks; counts, flags and lists that
    are null are 0, false and empty."""
    known = {"int": F.lit(0), "boolean": F.lit(False)}
    own = lambda c, k: F.col(c).cast(k) if c in df.columns else F.lit(None).cast(k)
    return df.withColumns({c: own(c, k) if k == "string" else F.coalesce(own(c, k), known[k] if k in known else F.array().cast(k)) for c, k in FACTS.items()})


def distinct_evidence(c: Column) -> Column:
    """Evidence in its order, once each, without what says nothing."""
    return F.array_distinct(F.filter(c, lambda e: F.coalesce(e["page"].cast("string"), e["section"], e["location"], e["quote"]).isNotNull()))


def _source(name: str) -> Column:
    """One source of evidence, as RULES name it."""
    name, _, most = name.partition(":")
    if name in PIECES:
        section, when, place, quote = PIECES[name]
        piece = F.array(F.struct(F.lit(None).cast("int").alias("page"), F.lit(section).alias("section"), F.expr(place).cast("string").alias("location"), F.expr(quote).cast("string").alias("quote")))
        return F.when(F.expr(when), piece).otherwise(F.array().cast(EVIDENCE))
    if f"{name}_evidence" in FACTS:
        return F.slice(f"{name}_evidence", 1, int(most)) if most else F.col(f"{name}_evidence")
    return F.filter("phase_evidence", lambda e: e["section"] == f"ADME {name}")


def answers(facts: DataFrame, doc: str) -> DataFrame:
    """(doc, item_id, item_ord, response, confidence, evidence): all items of
    all documents, by RULES; an item without a rule has no evidence.

    An answer without a quote, a place or a page becomes NONE, but for the item
    on the review itself.  Confidence is high with a quote that has a place or
    a page, medium with one of them, else low, and low for NONE.
    """
    x = with_facts(facts)
    rule = {PREFIX + i: (sources, yes, partly) for items, sources, yes, partly in RULES for i in items.split()}
    holds = lambda p, e: F.size(e) > 0 if p == HAS else F.coalesce(F.expr(p or "false"), F.lit(False))

    def row(k: int, item: str) -> Column:
        sources, yes, partly = rule.get(item, ("", "", ""))
        e = distinct_evidence(F.concat(F.array().cast(EVIDENCE), *map(_source, sources.split())))
        asked = F.lit(YES) if item == SELF else F.when(holds(yes, e), YES).when(holds(partly, e), PARTLY).otherwise(NONE)
        return F.struct(F.lit(item).alias("item_id"), F.lit(k).alias("item_ord"), asked.alias("asked"), e.alias("evidence"))

    said = lambda c: F.coalesce(~F.lower(F.trim(c)).isin("", "n/a", "none"), F.lit(False))
    some = lambda c: F.coalesce(c != "", F.lit(False))
    x = x.select(doc, F.explode(F.array(*(row(k, i) for k, i in enumerate(ITEMS)))).alias("a")).select(doc, "a.*")
    sound = F.exists("evidence", lambda e: said(e["quote"]) | said(e["location"]) | F.coalesce(e["page"] > 0, F.lit(False)))
    response = F.when((F.col("item_id") != SELF) & ~sound, NONE).otherwise(F.col("asked"))
    place = lambda e: some(e["location"]) | e["page"].isNotNull()
    sure = F.when(F.exists("evidence", lambda e: some(e["quote"]) & place(e)), "high").when(F.exists("evidence", lambda e: some(e["quote"]) | place(e)), "medium").otherwise("low")
    return x.select(doc, "item_id", "item_ord", response.alias("response"), F.when(response == NONE, "low").otherwise(sure).alias("confidence"), "evidence")


def overview(found: DataFrame, doc: str) -> DataFrame:
    """By document: the items with and without evidence, as a sentence, and
    the gaps in their order."""
    open_ = F.col("response") == NONE
    x = found.groupBy(doc).agg(F.count("*").alias("n"), F.count_if(open_).alias("n_open"), F.array_sort(F.collect_list(F.when(open_, F.struct("item_ord", "item_id")))).alias("g"))
    fit = F.format_string("%d/%d items have at least some supported evidence; %d/%d remain " + NONE, F.col("n") - F.col("n_open"), "n", "n_open", "n")
    return x.select(doc, "n_open", fit.alias("fit"), F.transform("g", lambda e: e["item_id"]).alias("gaps"))


def targets(tables: DataFrame, doc: str) -> DataFrame:
    """(doc, targets): the compounds that a document's tables are about,
    sorted, each once."""
    named = F.explode(F.coalesce("subjects", F.array().cast("array<string>")))
    return tables.select(doc, named.alias("s")).groupBy(doc).agg(F.sort_array(F.collect_set("s")).alias("targets"))


def merged_basis(parts: DataFrame, doc: str, keys: tuple[str, ...] = ("collection", "key")) -> DataFrame:
    """Of the pages' findings (doc, page, pos, collection, key, ...) the first
    of each key in each collection, in the pages' order."""
    return keep_first(parts, [doc, *keys], ["page", "pos"])


def search(found: DataFrame, text: str = "", response: str = "all") -> DataFrame:
    """Items whose identifier or any quote of whose evidence holds a text,
    without regard to case, with the given response."""
    t = F.lit(text.strip().lower())
    quoted = F.exists("evidence", lambda e: F.contains(F.lower(F.coalesce(e["quote"], F.lit(""))), t))
    out = found.filter(quoted | F.contains(F.lower("item_id"), t)) if text.strip() else found
    return out if response == "all" else out.filter(F.lower("response") == response)
