"""Queries on the rule engine: parameters against the tables that they cite.

Customers stand for documents, their order lines for parameters and cells; the
columns are mapped so that every rule fires on some rows and not on others.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import evidence, rules
from ..sources.work import dealt
from .common import ORDER, read

#: Lines of a document in their order, as plain SQL for both engines: k is
#: what the mapping draws on, q the quantity as text.
BASE = f"""SELECT o_custkey AS doc, row_number() OVER (PARTITION BY o_custkey ORDER BY l_orderkey, {', '.join(ORDER)}) AS ord, CAST(l_partkey % 97 AS INT) AS k,
  l_quantity AS v, CAST(CAST(l_quantity AS INT) AS STRING) AS q, l_returnflag, l_linestatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

_PICK = "CASE k % {n} " + "{when} END"


def _pick(n: int, *values: str | None) -> str:
    """A CASE over k % n."""
    return _PICK.format(n=n, when=" ".join(f"WHEN {i} THEN " + ("NULL" if v is None else f"'{v}'") for i, v in enumerate(values)))


PARAMETERS = f"""SELECT doc, ord,
  {_pick(9, 'Volume of distribution', 'clearance', 'half-life', 'rate constant ka', 'fraction unbound', ' ', 'AUC', 'organ volume', 'Vmax')} AS name,
  {_pick(9, 'Vd', 'CL', 't1/2', 'ka', 'fu', None, 'AUC', 'VLC', 'Vmax')} AS symbol, {_pick(7, None, 'PFOA', 'PFOS', 'drug X', 'PFOA', 'Bisphenol  A', 'PFHxS')} AS compound,
  CASE WHEN k % 5 = 0 THEN 'Physiological' ELSE 'biochemical' END AS class,
  {_pick(9, 'compartment_volume', 'renal_clearance', None, 'rate_constant', 'fraction_unbound', '', 'auc', 'organ_volume', 'vmax')} AS subclass,
  CASE WHEN k % 11 < 8 THEN {_pick(9, 'L/kg', 'L/h', 'h', '1/h', None, 'mg', 'ug*h/mL', 'mL', 'mg/h')} WHEN k % 11 = 9 THEN ' mL/min' WHEN k % 11 = 10 THEN 'L' END AS unit,
  CASE WHEN k % 13 = 0 THEN NULL WHEN k % 13 = 1 THEN -v WHEN k % 13 = 2 THEN v * 1000 ELSE v END AS value,
  CASE k % 6 WHEN 1 THEN q || ' a' WHEN 2 THEN q || '.0 (1, 2)' WHEN 3 THEN '−' || q WHEN 4 THEN 'nd' WHEN 5 THEN q END AS value_text,
  CASE WHEN k % 4 < 2 THEN CAST(1 AS DOUBLE) END AS low, CASE WHEN k % 4 IN (0, 2) THEN CAST(2 AS DOUBLE) END AS high,
  CASE WHEN k % 26 = 0 THEN CAST(1 AS DOUBLE) END AS start_value, CASE WHEN k % 26 = 0 THEN CAST(2 AS DOUBLE) END AS end_value,
  {_pick(8, None, '', 'Sensitivity table', 'Held constant from rat', 'q', 'q', 'q', 'q')} AS quote, CASE WHEN k % 3 = 0 THEN 'high' ELSE 'medium' END AS confidence,
  CASE WHEN k % 17 = 0 THEN 'inherited_cross_species' END AS directness, CASE WHEN k % 19 = 0 THEN 'held constant' END AS derivation,
  {_pick(10, None, 'table1', 'TABLE  2', 'Table 3', 'Table 4', 'Table 4', 'Fig. 1', 'Table 1: values', 'Table 1: values', '')} AS source_table,
  CASE WHEN k % 5 = 1 THEN 'r' || ord END AS row_id, CASE WHEN k % 5 = 1 THEN 'k' || (ord % 2) WHEN k % 5 = 2 THEN 'K9 ' END AS column_id, CASE WHEN k % 12 = 3 THEN 'c' || ord END AS cell_id,
  {_pick(6, '', 'Clearance', 'Rat|CL', 'Rat|x', 'Human', '')} AS row_path, {_pick(4, '', 'PFOA|Mean', 'PFOS', 'value')} AS column_path,
  {_pick(4, None, 'Human', ' rat', 'dog')} AS species, l_returnflag AS organ, CAST(NULL AS STRING) AS life_stage, l_linestatus AS population,
  CASE WHEN k % 2 = 0 THEN 'IV|oral' ELSE 'oral|iv' END AS formulation FROM B"""

TABLES = """SELECT doc, 1 AS table_ord, 'Table 1: values' AS table_id, CASE WHEN doc % 6 = 0 THEN 'Values of PFHxS' ELSE 'Values' END AS title, 'complete' AS status,
  CASE doc % 3 WHEN 0 THEN '' WHEN 1 THEN 'PFOA|PFOS' ELSE 'pfos' END AS subjects, 'bisphenol a' AS footnotes, 'PFHxS' AS referenced, CASE WHEN doc % 4 = 0 THEN '' ELSE 'human|Rat ' END AS table_species FROM D
UNION ALL SELECT doc, 2, 'Table 2', NULL, 'complete', 'PFOS|Drug X', '', 'PFOA', 'rat' FROM D UNION ALL SELECT doc, 3, 'Table 3', 'x', 'failed', 'PFOS', '', '', '' FROM D
UNION ALL SELECT doc, 4, 'Fig. 1', 'x', NULL, '', '', '', '' FROM D WHERE doc % 2 = 0 UNION ALL SELECT doc, 5, 'Table 1', 'again', 'complete', 'PFHxS', 'PFOA', '', 'dog' FROM D WHERE doc % 5 = 0"""

#: Cells stand in tables 1 and 2, by turns; their rows and columns too.
CELLS = """SELECT doc, CASE WHEN ord % 2 = 0 THEN 1 ELSE 2 END AS table_ord, ord AS pos, 'c' || ord AS cell_id, 'r' || ord AS row_id, 'k' || (ord % 4) AS column_id,
  CASE ord % 3 WHEN 0 THEN q WHEN 1 THEN q || ' (0.5)' ELSE 'ND ' END AS text, CASE WHEN ord % 3 = 0 THEN CASE WHEN k % 5 = 0 THEN v * 1.1D ELSE v END END AS numeric_value,
  CASE k % 3 WHEN 0 THEN 'Rat|Clearance' WHEN 1 THEN 'Human|CL' ELSE 'Vd|PFOA' END AS row_path FROM B"""
COLUMNS = (("k0", "PFOA|Mean"), ("k1", "PFOS"), ("k2", "value"))


def _list(c: str) -> F.Column:
    return F.when(F.col(c) == "", F.array().cast("array<string>")).otherwise(F.split(c, r"\|"))


def parameters(spark, base, *more):
    """Flat parameters of lines, with those of the lines' columns in more."""
    p = spark.sql("".join([PARAMETERS.removesuffix(" FROM B"), *(f", {c}" for c in more), " FROM {B}"]), B=base)
    return p.withColumns({"name_original": F.col("name"), **{c: _list(c) for c in ("row_path", "column_path", "formulation")}})


def heads(spark, base):
    """Tables of the lines' documents, without rows, columns and cells."""
    t = spark.sql(TABLES.replace("FROM D", "FROM {D}"), D=base.select("doc").distinct())
    return t.withColumns({c: _list(c) for c in ("subjects", "footnotes", "referenced", "table_species")})


def parameters_and_tables(spark, d, tables=True, keep=True, without=()):
    """Flat parameters, and with tables=True tables with their rows and cells
    as arrays (but for those of `without`, which a query does not read), which
    are written unless keep=False says that one branch reads them.

    The lines are dealt by document and written once, while they are narrow,
    in buckets that all branches read; the mapped columns are made after that,
    so joins, groups and windows by document and more need no shuffle.
    """
    base, n = based(spark, d)
    p = parameters(spark, base)
    if not tables:
        return p, None
    # Each table of a document is a branch, so its documents are told once.
    t = heads(spark, dealt(base.select("doc").distinct(), "docs", "doc", n) if keep else base)
    c = spark.sql(CELLS.replace("FROM B", "FROM {B}"), B=base).withColumn("row_path", _list("row_path"))
    cell, row = F.struct("pos", "cell_id", "row_id", "column_id", "text", "numeric_value"), F.struct("pos", "row_id", F.col("row_path").alias("path"))
    listed = {n: F.array_sort(F.collect_list(x)).alias(n) for n, x in (("cells", cell), ("rows", row)) if n not in without}
    per = c.groupBy("doc", "table_ord").agg(*listed.values()).hint("merge")
    columns = F.array(*(F.struct(F.lit(i).alias("column_id"), F.split(F.lit(p), r"\|").alias("path")) for i, p in COLUMNS))
    t = t.join(per, ["doc", "table_ord"], "left").withColumn("columns", F.when(F.col(next(iter(listed))).isNotNull(), columns))
    return p, dealt(t, "tables", "doc", n) if keep else t  # as a user has them: read by each branch, not made by each


#: Lines for one task: what is dealt is narrow and grows when it is mapped.
LINES_A_TASK = 200_000


def unwritten(spark, d):
    """The lines of BASE."""
    lines = read(spark, d, "lineitem").join(read(spark, d, "orders"), F.expr("l_orderkey = o_orderkey"))
    return spark.sql(BASE.replace("FROM lineitem JOIN orders ON l_orderkey = o_orderkey", "FROM {lines}"), lines=lines)


def placed(spark, d):
    """Lines with their document and their place in their order, which is
    told where lines meet orders: the deal by document carries the place and
    not the columns that it follows from."""
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*ORDER))
    own = "l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus"
    lines = read(spark, d, "lineitem").select(*own, place.alias("place"))
    return lines.join(read(spark, d, "orders"), F.expr("l_orderkey = o_orderkey")).select("o_custkey", "place", *own)


def based(spark, d):
    """The lines of BASE, dealt by document once, numbered there and written
    in buckets; and the number of these."""
    n = max(spark.sparkContext.defaultParallelism, -(-read(spark, d, "lineitem").count() // LINES_A_TASK))
    base = BASE.replace(", ".join(ORDER), "place").replace("FROM lineitem JOIN orders ON l_orderkey = o_orderkey", "FROM {lines}")
    return dealt(spark.sql(base, lines=placed(spark, d).repartition(n, "o_custkey")), "lines", "doc", n), n


def _flags(spark, d):
    p, t = parameters_and_tables(spark, d)
    return rules.flags(rules.prepared(p, t, "doc"), rules.parameter_rules(), ["doc", "ord"]), p


def rule_flags(spark, d):
    return _flags(spark, d)[0]


def rule_report(spark, d):
    found, p = _flags(spark, d)
    return rules.report(found, p, "doc", "ord")


def worst_first_topk(spark, d):
    return rules.worst_first(rule_flags(spark, d), "doc", "ord")


def cell_match(spark, d):
    x = evidence.match_cell(*parameters_and_tables(spark, d), "doc")
    return x.select("doc", "ord", F.col("evidence.table_id").alias("table_id"), F.col("cell.cell_id").alias("found"), F.array_join("cell.row_path", "|").alias("found_row"), F.array_join("cell.column_path", "|").alias("found_column"))


def bind_provenance(spark, d):
    p, t = parameters_and_tables(spark, d, without=("cells",))
    x = evidence.bind(evidence.cite(p, t, "doc", fields=("rows", "columns")))
    return x.select("doc", "ord", "row_id", "column_id", "cell_id", F.array_join("row_path", "|").alias("row_path"), F.array_join("column_path", "|").alias("column_path"))


QUERIES = {f.__name__: f for f in (rule_flags, rule_report, worst_first_topk, cell_match, bind_provenance)}

_BOTH = rf"""B AS ({BASE}), P AS ({PARAMETERS}), D AS (SELECT DISTINCT doc FROM B), T AS ({TABLES}), C AS ({CELLS.replace('1.1D', '1.1::DOUBLE')}),
K(column_id, column_path) AS (VALUES {', '.join(f"('{i}', '{p}')" for i, p in COLUMNS)}),
TF AS (SELECT *, CASE WHEN regexp_matches(n, '^tables?[0-9]+') THEN regexp_extract(n, '^tables?[0-9]+') ELSE n END AS form FROM (SELECT *, regexp_replace(lower(table_id), '\s+', '', 'g') AS n FROM T)),
NAMES AS (SELECT doc, nm, max(table_ord) AS table_ord FROM (SELECT doc, table_id AS nm, table_ord FROM TF UNION ALL SELECT doc, form, table_ord FROM TF) GROUP BY doc, nm),
PF AS (SELECT *, CASE WHEN regexp_matches(n, '^tables?[0-9]+') THEN regexp_extract(n, '^tables?[0-9]+') ELSE n END AS form FROM (SELECT *, regexp_replace(lower(source_table), '\s+', '', 'g') AS n FROM P)),
CITED AS (SELECT PF.doc, PF.ord, coalesce(a.table_ord, b.table_ord) AS table_ord FROM PF LEFT JOIN NAMES AS a ON a.doc = PF.doc AND a.nm = source_table LEFT JOIN NAMES AS b ON b.doc = PF.doc AND b.nm = PF.form WHERE coalesce(source_table, '') <> ''),
X AS (SELECT P.*, t.table_ord, t.table_id, t.title, t.status, t.subjects, t.footnotes, t.referenced, t.table_species FROM P LEFT JOIN CITED USING (doc, ord) LEFT JOIN T AS t ON t.doc = P.doc AND t.table_ord = CITED.table_ord)"""


def _scrape(x: str) -> str:
    clean = rf"regexp_replace(regexp_extract(trim(replace({x}, '−', '-')), '^\S+'), '[^0-9.\-eE+]', '', 'g')"
    return rf"CASE WHEN regexp_full_match({clean}, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?') THEN {clean}::DOUBLE END"


_CELL = rf"""{_BOTH}, Y AS (SELECT *, coalesce(value, {_scrape('value_text')}) AS num, lower(trim(coalesce(value_text, ''))) AS low_text, lower(coalesce(compound, '')) AS cmp, lower(CASE WHEN name <> '' THEN name ELSE coalesce(symbol, '') END) AS nam,
  lower(replace(row_path, '|', ' ')) AS own_row, lower(replace(column_path, '|', ' ')) AS own_column FROM X),
Z AS (SELECT C.*, K.column_path, coalesce(numeric_value, {_scrape('text')}) AS num, lower(trim(text)) AS low_text, lower(replace(row_path, '|', ' ')) AS of_row, coalesce(lower(replace(K.column_path, '|', ' ')), '') AS of_column FROM C LEFT JOIN K USING (column_id)),
M AS (SELECT Y.doc, Y.ord, Z.pos, Z.cell_id AS found, Z.row_path AS found_row, Z.column_path AS found_column, Z.numeric_value AS cell_value, Z.of_column,
  CASE WHEN Y.cell_id = Z.cell_id THEN 3 WHEN Y.row_id = Z.row_id AND Y.column_id = Z.column_id THEN 2
    WHEN Y.num IS NOT NULL AND Z.num IS NOT NULL THEN CASE WHEN abs(Y.num - Z.num) <= greatest(abs(Y.num), abs(Z.num)) * 0.03::DOUBLE + 1e-9 THEN 1 ELSE 0 END
    WHEN Y.low_text = '' OR Z.low_text = '' THEN 0 WHEN Y.low_text = Z.low_text THEN 1
    WHEN length(Y.low_text) >= 3 AND length(Z.low_text) >= 3 AND (contains(Y.low_text, Z.low_text) OR contains(Z.low_text, Y.low_text)) THEN 1 ELSE 0 END AS rank,
  CASE WHEN cmp <> '' AND contains(of_column, cmp) THEN 5 WHEN cmp <> '' AND contains(of_row, cmp) THEN 3 ELSE 0 END + CASE WHEN nam <> '' AND contains(of_row, nam) THEN 5 WHEN nam <> '' AND contains(of_column, nam) THEN 3 ELSE 0 END
  + CASE WHEN own_row <> '' AND contains(of_row, own_row) THEN 4 ELSE 0 END + CASE WHEN own_column <> '' AND contains(of_column, own_column) THEN 4 ELSE 0 END AS score
  FROM Y JOIN Z ON Y.doc = Z.doc AND Y.table_ord = Z.table_ord),
MATCHED AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc, ord ORDER BY rank DESC, CASE WHEN rank = 1 THEN score ELSE 0 END DESC, pos) AS i FROM M WHERE rank > 0) WHERE i = 1)"""

_NORM = r"trim(regexp_replace(lower(coalesce({}, '')), '\s+', ' ', 'g'))"


def _lists(c: str) -> str:
    return rf"list_transform(list_filter(string_split(coalesce({c}, ''), '|'), lambda s: s <> ''), lambda s: trim(regexp_replace(lower(s), '\s+', ' ', 'g')))"


def _plausible() -> str:
    """The first fitting row of the table of ranges, as CASE."""
    words = lambda ws: " OR ".join(rf"regexp_matches({c}, '(^|[^a-z0-9_]){w.replace('.', chr(92) + '.')}($|[^a-z0-9_])')" for w in ws for c in ("lname", "lsym"))
    units = lambda us: " OR ".join(f"contains(lunit, '{u}')" for u in us)
    return "CASE " + " ".join(f"WHEN ({words(w)}) AND ({units(u)}) THEN value < {lo!r}::DOUBLE OR value > {hi!r}::DOUBLE" for w, u, lo, hi in rules.PLAUSIBLE) + " ELSE false END"


def _wrong_unit() -> str:
    rows = []
    for name, allowed in rules.UNITS:
        empty = "false" if "dimensionless" in allowed else "true"
        rows.append(f"WHEN contains(lower(coalesce(subclass, '')), '{name}') THEN CASE WHEN coalesce(unit, '') = '' THEN {empty} ELSE NOT ({' OR '.join(f'contains(lower(unit), {chr(39)}{u}{chr(39)})' for u in allowed)}) END")
    return "CASE " + " ".join(rows) + " ELSE false END"


_ANY = lambda words, *cols: "(" + " OR ".join(f"contains({c}, '{w}')" for w in words for c in cols) + ")"
_FLAGS = rf"""{_CELL},
SHARES AS (SELECT *, n / sum(n) OVER w AS share, count(*) OVER w AS n_compounds FROM (SELECT doc, source_table, compound, count(*)::DOUBLE AS n FROM P WHERE compound <> '' AND source_table <> '' GROUP BY ALL) WINDOW w AS (PARTITION BY doc, source_table)),
A AS (SELECT X.*, m.found, m.cell_value, m.of_column, share, n_compounds, lower(coalesce(name, '')) AS lname, lower(coalesce(symbol, '')) AS lsym, lower(trim(coalesce(unit, ''))) AS lunit, {_NORM.format('compound')} AS cn, {_NORM.format('species')} AS sn,
  {_scrape('value_text')} AS parsed, {_lists('subjects')} AS ls, {_lists('footnotes')} AS lf, {_lists('referenced')} AS lr, {_lists('table_species')} AS lsp,
  lower(replace(trim(row_path || '|' || column_path, '|'), '|', ' ')) AS paths, X.table_ord IS NOT NULL AND coalesce(status, '') <> 'failed' AS readable, X.table_ord IN (1, 2) AS has_cells
  FROM X LEFT JOIN MATCHED AS m USING (doc, ord) LEFT JOIN SHARES USING (doc, source_table, compound)),
FV AS (SELECT *, first_value(ord) OVER w AS f_ord, first_value(value) OVER w AS f_value, first_value(coalesce(trim(value_text), '')) OVER w AS f_text, first_value(start_value) OVER w AS f_start, first_value(end_value) OVER w AS f_end FROM A
  WINDOW w AS (PARTITION BY doc, lower(coalesce(compound, '')), lower(coalesce(species, '')), organ, population, list_sort(string_split(lower(formulation), '|')), lower(class), lower(coalesce(subclass, '')), lname,
    CASE WHEN column_path <> '' THEN lower(replace(column_path, '|', ' ')) ELSE lower(trim(coalesce(column_id, ''))) END ORDER BY ord)),
S AS (SELECT *, readable AND coalesce(compound, '') <> '' AND len(ls) > 0 AND NOT list_contains(ls, cn) AS stranger, CASE WHEN value IS NULL AND f_value IS NULL THEN f_text = coalesce(trim(value_text), '') OR coalesce(f_start = start_value, false) AND f_end IS NOT DISTINCT FROM end_value
  ELSE coalesce(abs(value - f_value) < 1e-9, false) END AS dup, coalesce(directness, '') = 'inherited_cross_species' OR contains(lower(coalesce(quote, '')), 'held constant') OR contains(lower(coalesce(derivation, '')), 'held constant') AS inherited FROM FV),
F AS (""" + "\nUNION ALL ".join(f"SELECT doc, ord, '{n}' AS rule, '{s}' AS severity FROM S WHERE {w}" for n, s, w in (
    ("MISSING_NAME", "error", "trim(name) = ''"), ("MISSING_COMPOUND", "warning", "coalesce(compound, '') = '' AND class <> 'Physiological'"), ("MISSING_UNIT", "warning", "value_text <> '' AND coalesce(unit, '') = ''"),
    ("VALUE_MISMATCH", "warning", "abs(parsed - value) > abs(parsed) * 0.05::DOUBLE + 1e-9"), ("IMPLAUSIBLE_VALUE", "warning", f"unit <> '' AND value IS NOT NULL AND {_plausible()}"), ("INVALID_UNIT_DIMENSION", "error", _wrong_unit()),
    ("NEGATIVE_VALUE", "error", f"value < 0 AND {_ANY(rules.POSITIVE, 'lname', 'lsym')} AND NOT contains(lower(coalesce(quote, '')), 'sensitivity')"), ("INCOMPLETE_UNCERTAINTY", "warning", "(low IS NULL) <> (high IS NULL)"),
    ("PLACEHOLDER_COMPOUND", "warning", _ANY(rules.PLACEHOLDERS, "lower(compound)")), ("MINORITY_COMPOUND_IN_TABLE", "warning", "n_compounds > 1 AND share < 0.15::DOUBLE"),
    ("MISSING_TABLE_HIERARCHY", "warning", "source_table <> '' AND row_path = '' AND column_path = ''"),
    ("COMPOUND_COLUMN_CONFLICT", "error", "compound <> '' AND paths <> '' AND NOT contains(paths, lower(compound)) AND NOT coalesce(contains(lower(title), lower(compound)), false) AND NOT coalesce(contains(lower(subjects), lower(compound)), false)"),
    ("SOURCE_TABLE_EVIDENCE_MISSING", "error", "source_table <> '' AND table_ord IS NULL"), ("SOURCE_TABLE_RECONSTRUCTION_FAILED", "error", "source_table <> '' AND status = 'failed'"),
    ("FOOTNOTE_ONLY_COMPOUND", "warning", "stranger AND list_contains(lf, cn)"), ("REFERENCED_ONLY_COMPOUND", "warning", "stranger AND NOT list_contains(lf, cn) AND list_contains(lr, cn)"),
    ("SOURCE_TABLE_COMPOUND_MISMATCH", "error", "stranger AND NOT list_contains(lf, cn) AND NOT list_contains(lr, cn)"), ("SOURCE_TABLE_SPECIES_MISMATCH", "error", "readable AND species <> '' AND len(lsp) > 0 AND NOT list_contains(lsp, sn)"),
    ("CELL_VALUE_MISMATCH", "error", "readable AND abs(cell_value - value) > abs(cell_value) * 0.05::DOUBLE + 1e-4 AND abs(cell_value - value) > 0.005::DOUBLE"),
    ("CELL_COMPOUND_MISALIGNMENT", "error", "readable AND found IS NOT NULL AND compound <> '' AND len(list_filter(ls, lambda s: s <> cn AND contains(of_column, s))) > 0 AND NOT contains(of_column, cn)"),
    ("CELL_NOT_FOUND_IN_SOURCE_TABLE", "error", "readable AND has_cells AND found IS NULL AND value IS NOT NULL AND NOT inherited"), ("MISSING_QUOTE_HIGH_CONF", "warning", "confidence = 'high' AND coalesce(quote, '') = ''"),
    ("DUPLICATE_ENTRY", "warning", "ord <> f_ord AND dup"), ("CONFLICTING_ENTRY", "error", "ord <> f_ord AND NOT dup"),
)) + ")"

ORACLE_SQL = {
    "rule_flags": f"WITH {_FLAGS} SELECT * FROM F",
    "rule_report": f"""WITH {_FLAGS}, N AS (SELECT doc, count(*) AS total FROM P GROUP BY 1),
G AS (SELECT doc, count(DISTINCT ord) AS flagged, count(*) AS flags, count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warning') AS warnings FROM F GROUP BY 1)
SELECT doc, total, coalesce(flagged, 0) AS flagged, coalesce(flags, 0) AS flags, coalesce(errors, 0) AS errors, coalesce(warnings, 0) AS warnings, total - coalesce(flagged, 0) AS clean FROM N LEFT JOIN G USING (doc)""",
    "worst_first_topk": f"WITH {_FLAGS}, N AS (SELECT doc, ord, count(*) AS n_flags FROM F GROUP BY ALL) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY n_flags DESC, ord) AS rank FROM N) WHERE rank <= 15",
    "cell_match": f"WITH {_CELL} SELECT X.doc, X.ord, X.table_id, found, found_row, found_column FROM X LEFT JOIN MATCHED USING (doc, ord)",
    "bind_provenance": rf"""WITH {_BOTH}, R AS (SELECT X.doc, X.ord, C.pos, C.row_id, C.row_path, len(list_filter(string_split(C.row_path, '|'), lambda p: contains(lower(p), lower(coalesce(species, ''))))) > 0 AS of_species FROM X JOIN C ON X.doc = C.doc AND X.table_ord = C.table_ord
  WHERE len(list_filter(string_split(lower(C.row_path), '|'), lambda p: lower(trim(symbol)) <> '' AND p = lower(trim(symbol)) OR trim(name) <> '' AND (contains(p, lower(trim(name))) OR contains(lower(trim(name)), p)))) > 0),
R1 AS (SELECT doc, ord, arg_min(row_id, (NOT of_species)::INT * 1000000 + pos) AS rid, arg_min(row_path, (NOT of_species)::INT * 1000000 + pos) AS rp FROM R GROUP BY ALL),
K1 AS (SELECT doc, ord, arg_min(K.column_id, o) AS kid, arg_min(K.column_path, o) AS kp FROM (SELECT X.doc, X.ord, K.column_id, K.column_path, CASE WHEN compound <> '' AND contains(upper(K.column_path), upper(compound)) THEN 0 WHEN regexp_matches(lower(K.column_path), 'mean|value') THEN 10 END + substr(K.column_id, 2)::INT AS o
  FROM X JOIN K ON X.table_ord IN (1, 2) AND EXISTS (SELECT 1 FROM C WHERE C.doc = X.doc AND C.table_ord = X.table_ord)) AS K WHERE o IS NOT NULL GROUP BY ALL)
SELECT X.doc, X.ord, coalesce(rid, row_id) AS row_id, coalesce(kid, column_id) AS column_id, CASE WHEN rid IS NOT NULL AND kid IS NOT NULL THEN 'cell_' || rid || '_' || kid ELSE cell_id END AS cell_id, coalesce(rp, row_path) AS row_path, coalesce(kp, column_path) AS column_path
FROM X LEFT JOIN R1 USING (doc, ord) LEFT JOIN K1 USING (doc, ord)""",
}
