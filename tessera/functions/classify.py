"""Keyword rules over texts: relevance, tables, classes, entities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Section titles that are dropped, and those that are kept.
SKIP_TITLES = (
    "acknowledgment", "acknowledgements", "funding", "conflict of interest", "abbreviations", "author contribution", "data availability",
    "ethics", "competing interest", "appendix", "supplementary", "supporting information",
)
KEEP_TITLES = (
    "method", "material", "parameter", "pharmacokinetic", "pbpk", "model", "equation", "result", "sensitivity analysis", "dose", "clearance",
    "absorption", "distribution", "elimination", "estimation", "fitting", "simulation", "compartment",
)

#: Words of supporting context (three make a text relevant).
CONTEXT_WORDS = (
    r"\bparameter\b", r"\bmodel\b", r"\bdose\b", r"\bplasma\b", r"\bconcentration\b", r"\bblood\b", r"\boral\b", r"\bintravenous\b", r"\bIV\b",
    r"\bPBPK\b", r"\bpharmacokinet\b", r"\bpharmacodyn\b", r"\bexponential\b", r"\bequation\b", r"\bfitted\b", r"\bestimated\b", r"\bobserved\b",
    r"\bpredicted\b", r"\bsimulat\b",
)

#: Subclasses that settle a parameter's class.
PHYSIOLOGICAL = (
    "organ_blood_flow_fraction", "blood_flow_fraction", "organ_blood_flow", "organ_volume_fraction", "volume_fraction", "organ_volume",
    "glomerular_filtration", "glomerular_filtration_rate", "cardiac_output", "body_weight", "hematocrit", "milk_flow", "urine_production",
)
BIOCHEMICAL = (
    "partition_coefficient", "fraction_unbound", "absorption_rate_constant", "gastric_emptying_rate", "fecal_elimination_rate_constant",
    "maximal_velocity", "michaelis_menten_constant", "renal_clearance", "metabolic_clearance", "clearance", "biliary_elimination_rate",
    "urinary_excretion_rate", "distribution_volume", "distribution_rate", "elimination_half_life", "bioavailability", "transfer_rate",
    "relative_activity_factor", "microsomal_protein_yield", "fraction_metabolized", "ptc_protein",
)

#: Tables that hold no inputs, and words of those that do.
OUTCOME_TABLE = (
    r"(?i)(sensitivity\s+coefficient|normalized\s+sensitivity|morris\s+screening|efast|point\s+of\s+departure|pod\s*hed|exposure\s+estimate|"
    r"daily\s+intake\s+estimate)"
)
INPUT_WORDS = (
    "bw", "qcc", "qc", "tmc", "kt", "vmax", "km", "k12", "k21", "ka", "kabs", "kfeces", "vcc", "vfilc", "qfilc", "free", "fu", "bioav", "partition",
    "blood flow", "tissue volume", "organ volume", "clearance", "clint", "raf", "hct",
)


def hits(text: Column, patterns: tuple[str, ...]) -> Column:
    """How many of the patterns a text has, case aside."""
    return sum((F.coalesce(text.rlike("(?iU)" + p), F.lit(False)).cast("int") for p in patterns), F.lit(0))


#: Words of a parameter's name, symbol or subclass that tell its
#: class: of the organism, then of the compound.
SYSTEM_WORDS = (
    "body weight", "organ weight", "tissue volume", "volume fraction",
    "cardiac output", "blood flow", "regional blood flow", "plasma flow",
    "glomerular filtration", "renal filtration", "urine flow",
    "fractional blood flow", "fractional tissue volume",
    "water content", "lipid content", "protein content", "neutral lipid",
    "phospholipid", "albumin", "water fraction", "lipid fraction",
    "neutral phospholipid", "acidic phospholipid",
    "enzyme abundance", "transporter expression", "mrna", "cyp abundance",
    "microsomal protein", "hepatocellularity", "liver weight",
    "qco", "qliv", "qkid", "qgut", "qfat", "qsk", "qmam", "qr", "qfil",
    "vblood", "vliv", "vkid", "vgut", "vfat", "vsk", "vr", "vmam", "vfil",
    "bw", "vfet",
    "physiological", "anatomical", "hemodynamic", "species-specific",
    "population", "tissue",
)
COMPOUND_WORDS = (
    "molecular weight", "logp", "logd", "log p", "log d",
    "pka", "solubility", "intrinsic solubility", "particle size",
    "particle density", "particle radius", "lipophilicity",
    "ionization", "dissociation", "henderson",
    "plasma protein binding", "fraction unbound", "fu", "fup", "fub",
    "blood-to-plasma", "blood to plasma", "b/p ratio", "b:p",
    "permeability", "caco-2", "caco2", "papp", "passive permeability",
    "p-glycoprotein", "pgp", "efflux", "influx transporter",
    "membrane permeability",
    "intrinsic clearance", "clint", "cl_int", "metabolic clearance",
    "in vitro clearance", "microsomal clearance", "hepatic clearance",
    "renal clearance", "total clearance", "apparent clearance",
    "half-life", "half life", "t1/2", "elimination rate",
    "metabolic rate", "vmax", "km",
    "inhibition constant", "ki", "ic50", "ec50",
    "volume of distribution", "vd", "vc", "vp",
    "partition coefficient", "tissue-to-plasma", "tissue:plasma",
    "distribution coefficient",
    "absorption rate", "ka", "bioavailability", "fraction absorbed",
    "first-pass", "gut absorption", "dissolution",
)

#: Patterns of which one makes a text relevant.
STRONG_WORDS = (
    r"\bclearance\b", r"\bCL\b", r"\bkelim\b", r"\bkel\b", r"\bk_el\b",
    r"\bhalf[\s-]?life\b", r"\bt½\b", r"\bt_½\b", r"\brate constant\b",
    r"\bvolume of distribution\b", r"\bVd\b", r"\bVss\b", r"\bVc\b",
    r"\bvolume of the\b",
    r"\bbioavailability\b", r"\babsorption rate\b", r"\bka\b", r"\bkabs\b",
    r"\boral bioavailability\b",
    r"\bpartition coefficient\b", r"\bplasma protein binding\b",
    r"\bfree fraction\b", r"\bfu\b", r"\bblood.to.plasma\b",
    r"\bAUC\b", r"\bCmax\b", r"\btmax\b", r"\bMRT\b",
    r"\bpermeability[\s-]?area\b", r"\bPapp\b", r"\bflow rate\b",
    r"\bglomerular filtration\b", r"\bGFR\b", r"\brenal clearance\b",
    r"\bhepatic clearance\b", r"\bmetabolic clearance\b",
    r"\btissue volume\b", r"\btissue blood flow\b",
    r"\bcompartment\b",
)


def has_any(text: Column, words: tuple[str, ...]) -> Column:
    return F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(text, w))


def by_tiers(title: Column, n_strong: Column, n_weak: Column) -> Column:
    """By title if that settles it, else one strong or three weak patterns."""
    t = F.lower(F.coalesce(title, F.lit("")))
    return F.when(has_any(t, SKIP_TITLES), False).when(has_any(t, KEEP_TITLES), True).otherwise((n_strong >= 1) | (n_weak >= 3))


def relevant(text: Column, title: Column, strong: tuple[str, ...] = STRONG_WORDS, weak: tuple[str, ...] = CONTEXT_WORDS) -> Column:
    return by_tiers(title, hits(text, strong), hits(text, weak))


def is_input_table(caption: Column, body: Column, words: tuple[str, ...] = INPUT_WORDS) -> Column:
    """No outcome table, and two or more of the words."""
    both = F.lower(F.concat_ws(" ", caption, body))
    found = F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(both, w))
    return ~F.coalesce(caption.rlike(OUTCOME_TABLE), F.lit(False)) & (F.size(found) >= 2)


#: Titles and labels of tables of sensitivities, and of exposures
#: and points of departure.
SENSITIVITY_TABLE = r"(?i)sensitivity\s+coefficient|normalized\s+sensitivity|morris|efast"
EXPOSURE_TABLE = r"(?i)point\s+of\s+departure|pod\s*hed|exposure\s+estimate|daily\s+intake"


#: Titles of tables of outcomes; captions that promise a diagram.
NON_INPUT_TITLE = r"(?i)sensitivity|exposure|population variability|pod|hed|hazard|risk|cancer|point of departure|biomonitoring|observed|predicted vs|predicted versus|goodness.of.fit|results|outcome"
DIAGRAM_WORDS = (
    r"model structure", r"compartment", r"diagram", r"schematic", r"flowchart", r"flow chart", r"pbpk", r"physiologically", r"\bode\b",
    r"differential equation", r"parameter", r"scheme",
)
#: Compounds and species that a table's text is searched for.
KNOWN_COMPOUNDS = ("PFOS", "PFOA", "PFHxS", "PFBS", "PFNA", "PFDA", "GenX", "HFPO-DA")
KNOWN_SPECIES = ("Nonhuman primate", "Human", "Rat", "Mouse", "Dog", "Monkey", "Cynomolgus monkey")


def is_diagram(caption: Column) -> Column:
    return F.coalesce(F.lower(caption).rlike("|".join(DIAGRAM_WORDS)), F.lit(False))


def terms_in(text: Column, terms: tuple[str, ...], flags: str = "") -> Column:
    """The terms that a text has as whole words, in their order."""
    return F.array_compact(F.array(*(F.when(text.rlike(rf"{flags}\b\Q{t}\E\b"), F.lit(t)) for t in terms)))


def table_terms(head: Column, body: Column, notes: Column) -> Column:
    """struct(subjects, footnotes, species) of a table: compounds of its title
    and columns, else of all its text; those of the notes alone; species."""
    everything = F.concat_ws(" ", head, body, notes)
    first = terms_in(head, KNOWN_COMPOUNDS)
    subjects = F.when(F.size(first) > 0, first).otherwise(terms_in(everything, KNOWN_COMPOUNDS))
    return F.struct(subjects.alias("subjects"), F.array_except(terms_in(notes, KNOWN_COMPOUNDS), subjects).alias("footnotes"), terms_in(everything, KNOWN_SPECIES, "(?i)").alias("species"))


def table_role(title: Column, labels: Column | None = None) -> Column:
    """Where a table's rows belong, by its title and its columns' labels."""
    t = F.concat_ws(" ", title, *([labels] if labels is not None else []))
    return F.when(t.rlike(SENSITIVITY_TABLE), "sensitivity_analysis").when(t.rlike(EXPOSURE_TABLE), "simulated_data").otherwise("model_parameters")


def parameter_class(subclass: Column, text: Column, system: tuple[str, ...], compound: tuple[str, ...]) -> Column:
    """physiological or biochemical: by subclass, by words (those of four
    letters and fewer as whole words), else physiological."""
    s, t = F.lower(F.coalesce(subclass, F.lit(""))), F.lower(F.coalesce(text, F.lit("")))

    def words(ws: tuple[str, ...]) -> Column:
        out = F.lit(False)
        for w in ws:
            out = out | (t.rlike(rf"\b\Q{w}\E\b") if len(w) <= 4 else F.contains(t, F.lit(w)))
        return out

    return (
        F.when(has_any(s, PHYSIOLOGICAL), "physiological").when(has_any(s, BIOCHEMICAL), "biochemical")
        .when(words(system), "physiological").when(words(compound), "biochemical").otherwise("physiological")
    )


def first_label(text: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """The label of the first pattern that a text has."""
    out = F.lit(default)
    for pattern, label in reversed(rules):
        out = F.when(text.rlike(pattern), F.lit(label)).otherwise(out)
    return out


#: Ordered patterns of species, life stage and formulation;
#: known compounds, and acronyms that are none.
SPECIES = (
    (r"(?i)nonhuman primate|monkey|cynomolgus|rhesus|macaque", "nonhuman primate"), (r"(?i)\b(?:rat|rats|sprague-dawley|wistar)\b", "rat"), (r"(?i)\b(?:mouse|mice)\b", "mouse"),
    (r"(?i)\b(?:dog|beagle|canine)\b", "dog"), (r"(?i)human|mother|fetus|infant|child|adult|patient", "human"),
)
LIFE_STAGES = tuple((rf"(?i){w}", w) for w in ("mother", "fetus", "infant", "pup", "gestation", "lactation", "adult"))
FORMULATIONS = tuple((rf"(?i){w}", w) for w in ("rilutor", "asd", "suspension", "tablet", "capsule", "iv", "oral"))
COMPOUNDS = (
    "PFOS", "PFOA", "PFHxS", "PFNA", "PFDA", "PFBA", "PFBS", "DINCH", "MINCH", "RILUZOLE", "RLZ", "RLE", "BPA", "BPS",
    "DIAZEPAM", "MIDAZOLAM", "THEOPHYLLINE", "CAFFEINE",
)
NO_COMPOUNDS = (
    "MCMC", "OECD", "PBPK", "RMSE", "AIC", "BIC", "AUC", "CMAX", "TMAX", "MEAN", "TABLE", "NOTE", "TOTAL", "BODY", "RATE", "FLOW", "TYPE",
    "DOSE", "TIME", "DATA", "YEAR", "AGE", "FIG", "HED", "POD",
)


def acronyms(text: Column, known: tuple[str, ...] = COMPOUNDS, stop: tuple[str, ...] = NO_COMPOUNDS) -> Column:
    """Known names in a text, in upper case, then its acronyms of three to
    eight letters that are not stopped."""
    listed = F.array_compact(F.array(*(F.when(text.rlike(rf"(?i)\b\Q{k}\E\b"), F.lit(k.upper())) for k in known))) if known else F.array().cast("array<string>")
    found = F.array_except(F.regexp_extract_all(text, F.lit(r"(?U)\b([A-Z]{3,8})\b"), 1), F.array(*map(F.lit, stop)))
    return F.array_distinct(F.concat(listed, found))
