"""Tables in XML and HTML as cells, spans of rows and columns resolved."""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The most columns and rows that a span may take in HTML.
MOST = {"colspan": 1000, "rowspan": 65534}


class _Table:
    """Cells of one table, row by row.  A span from above fills its places as
    the rows come, so it never reaches beyond the last one."""

    def __init__(self, number: int) -> None:
        self.number, self.row, self.head = number, -1, False
        self.full: set[int] = set()
        self.spans: dict[int, list] = {}  # column -> rows left, header, text
        self.open: dict | None = None

    def next_row(self, out: list[tuple]) -> None:
        self.row += 1
        self.full = set(self.spans)
        for c, span in sorted(self.spans.items()):
            out.append((self.number, self.row, c, span[1], span[2]))
            span[0] -= 1
        self.spans = {c: s for c, s in self.spans.items() if s[0]}

    def close_cell(self, out: list[tuple]) -> None:
        cell, self.open = self.open, None
        if not cell:
            return
        at = 0
        while at in self.full:
            at += 1
        text = " ".join("".join(cell["t"]).split())
        for c in range(at, at + cell["colspan"]):
            self.full.add(c)
            out.append((self.number, self.row, c, cell["h"], text))
            if cell["rowspan"] > 1:
                self.spans[c] = [cell["rowspan"] - 1, cell["h"], text]


def _span(attrs: list, name: str) -> int:
    value = dict(attrs).get(name) or ""
    n = int(value) if value.isdigit() else 1
    return MOST[name] if name == "rowspan" and not n else min(max(1, n), MOST[name])


class _Grid(HTMLParser):
    """All tables of a page, tables within tables included."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.cells: list[tuple[int, int, int, bool, str]] = []
        self.stack: list[_Table] = []
        self.seen = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.stack.append(_Table(self.seen))
            self.seen += 1
        elif self.stack:
            t = self.stack[-1]
            if tag == "thead":
                t.head = True
            elif tag == "tr":
                t.close_cell(self.cells)
                t.next_row(self.cells)
            elif tag in ("td", "th") and t.row >= 0:
                t.close_cell(self.cells)
                t.open = {"h": tag == "th" or t.head, "t": [], **{k: _span(attrs, k) for k in MOST}}

    def handle_endtag(self, tag: str) -> None:
        if self.stack and tag in ("td", "th", "tr", "table", "thead"):
            t = self.stack[-1]
            t.close_cell(self.cells)
            if tag == "thead":
                t.head = False
            elif tag == "table":
                self.stack.pop()

    def handle_data(self, data: str) -> None:
        if self.stack and self.stack[-1].open:
            self.stack[-1].open["t"].append(data)

    def end(self) -> list[tuple]:
        self.close()
        for t in self.stack:
            t.close_cell(self.cells)
        return self.cells


def cells(pages: DataFrame, key: str, markup: str) -> DataFrame:
    """(key, table_ord, r, c, is_header, text) of all tables of all pages: a
    row for each place of a grid, spans filled."""
    kind = pages.schema[key].dataType.simpleString()
    types = [pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.string()]
    names = ["table_ord", "r", "c", "is_header", "text"]

    def run(batches):
        for b in batches:
            at, rows = [], []
            for i, page in enumerate(b.column(1).to_pylist()):
                grid = _Grid()
                grid.feed(page or "")
                found = grid.end()
                at += [i] * len(found)
                rows += found
            cols = list(zip(*rows, strict=True)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], [key, *names])

    return pages.select(key, markup).mapInArrow(run, f"{key} {kind}, table_ord int, r int, c int, is_header boolean, text string")


def header_paths(grid: DataFrame, key: list[str]) -> DataFrame:
    """(key, c, path): the header texts above a column, repeats in a row once."""
    w = Window.partitionBy(*key, "c").orderBy("r")
    h = grid.filter("is_header").withColumn("_p", F.lag("text").over(w)).filter("_p IS NULL OR _p <> text")
    pairs = F.array_sort(F.collect_list(F.struct("r", "text")))
    return h.groupBy(*key, "c").agg(F.transform(pairs, lambda x: x["text"]).alias("path"))


def evidence(grid: DataFrame, key: list[str]) -> DataFrame:
    """Cells with text in the body: row_id, column_id, cell_id, text, header
    path, and the row path of its section and first four distinct cells."""
    body = grid.filter("NOT is_header")
    w = Window.partitionBy(*key).orderBy("r")
    body = body.withColumn("i", F.dense_rank().over(w) - 1)
    per = body.groupBy(*key, "i").agg(F.array_sort(F.collect_list(F.struct("c", "text"))).alias("cs"), F.count_distinct("text").alias("_texts"), F.count("*").alias("_cells"))
    section = F.when((F.col("_texts") == 1) & (F.col("_cells") > 1), F.col("cs")[0]["text"])
    run = Window.partitionBy(*key).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    per = per.withColumns({"is_section": section.isNotNull(), "section": F.last(section, True).over(run)})
    first = F.slice(F.array_distinct(F.filter(F.transform("cs", lambda x: x["text"]), lambda t: t != "")), 1, 4)
    per = per.select(*key, "i", "is_section", F.array_compact(F.concat(F.array("section"), first)).alias("row_path"))
    out = body.join(per.filter("NOT is_section"), [*key, "i"]).join(header_paths(grid, key), [*key, "c"], "left").filter("text <> ''")
    ids = {"row_id": F.concat(F.lit("row_"), "i"), "column_id": F.concat(F.lit("col_"), "c"), "cell_id": F.concat(F.lit("cell_r"), "i", F.lit("_c"), "c")}
    return out.withColumns(ids).select(*key, "cell_id", "row_id", "column_id", "text", "row_path", F.col("path").alias("column_path"))


def markdown(grid: DataFrame, key: list[str], notes: DataFrame | None = None) -> DataFrame:
    """(key, text): each table as Markdown lines, followed by its notes (key,
    pos, note), a line each."""
    row = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c", "text"))), lambda x: x["text"]), " | ")
    rows = grid.groupBy(*key, "r").agg(F.concat(F.lit("| "), row, F.lit(" |")).alias("line"))
    lines = F.array_sort(F.collect_list(F.struct("r", "line")))
    out = rows.groupBy(*key).agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("text"))
    if notes is None:
        return out
    below = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "note"))), lambda x: x["note"]), "\n")
    return out.join(notes.groupBy(*key).agg(below.alias("_n")), key, "left").select(*key, F.concat_ws("\n\n", "text", "_n").alias("text"))


def unroll(found: DataFrame, key: list[str], value_columns: str = "mean|estimate|value", compounds: tuple[str, ...] = ()) -> DataFrame:
    """Parameter records of a table's evidence: a row for each numeric cell of
    a value column, with the row's labels, unit and interval."""
    from ..functions.numbers import estimate, gated_double, trailing_unit

    label = F.lower(F.array_join(F.coalesce("column_path", F.array().cast("array<string>")), " > "))
    labels = found.withColumn("label", label)
    one = lambda w: F.max(F.when(F.col("label").rlike(w), F.col("text")))
    rows = labels.groupBy(*key, "row_id").agg(one("species").alias("species"), one("variable|symbol").alias("symbol"), one("name|parameter").alias("name"), one("source|reference").alias("source"))
    values = labels.filter(F.col("label").rlike(value_columns))
    e = estimate(F.col("text"))
    value = F.coalesce(e["value"], gated_double(F.trim("text")))
    compound = F.lit(None).cast("string")
    for c in reversed(compounds):
        compound = F.when(F.contains("label", F.lit(c.lower())), F.lit(c)).otherwise(compound)
    out = values.select(*key, "row_id", "cell_id", value.alias("value"), e["lower"].alias("ci_low"), e["upper"].alias("ci_high"), compound.alias("compound")).filter("value IS NOT NULL")
    return out.join(rows, [*key, "row_id"]).withColumn("unit", trailing_unit(F.col("name"))).withColumn("status", F.when(F.lower("source").rlike("optimi|fitted"), "fitted"))
