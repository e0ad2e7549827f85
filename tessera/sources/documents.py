"""Sources: JSON documents, manifests, predictions, files, XML metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of a flat parameter record, in Spark types.
CONTEXT = "struct<compound: string, species: string, subject_species: string, life_stage: string, formulation: array<string>, compartment: string, organ: string, route: string, population: string>"
QUANTITY = "struct<value_text: string, value: double, start_value: double, end_value: double, ci_low: double, ci_high: double, variance: double, variance_type: string, uncertainty: struct<type: string, lower: double, upper: double, absolute: double, raw_text: string>, unit: string, unit_original: string, unit_standardized: string, unit_inherited: boolean, value_qualifier: string, footnote_marker: string, normalization_basis: string>"
PROVENANCE = "struct<source_table: string, row_id: string, column_id: string, cell_id: string, row_path: array<string>, column_path: array<string>, source_page: int, source_section: string, source_location: string, source_quote: string, reference: string, status: string, parameter_status: string, status_raw: string>"
PARAMETER = f"struct<parameter_id: string, parameter_class: string, parameter_subclass: string, parameter_name_original: string, parameter_name_standardized: string, symbol_original: string, symbol_standardized: string, context: {CONTEXT}, quantitative_data: {QUANTITY}, provenance: {PROVENANCE}, needs_review: boolean, verification_score: double>"
DOCUMENT = f"title string, journal string, year int, authors array<string>, model_parameters array<{PARAMETER}>, parameters array<{PARAMETER}>, _corrupt_record string"
MANIFEST = "corpus_version string, papers array<struct<paper_id: string, pdf_path: string, reference_path: string, title: string, year: int, expected_parameter_count: int, pdf_sha256: string, reference_sha256: string>>"


def json_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row a file; files that are no JSON object have _corrupt_record.
    Old documents' `parameters` count as model_parameters; none is empty."""
    docs = spark.read.schema(DOCUMENT).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path, multiLine=True)
    none = F.array().cast(f"array<{PARAMETER}>")
    docs = docs.withColumn("path", F.col("_metadata.file_path"))
    return docs.withColumn("model_parameters", F.coalesce("model_parameters", "parameters", none)).drop("parameters")


def parameters(docs: DataFrame, doc: str = "path") -> DataFrame:
    """One row a parameter, with ord, its place in the document."""
    x = docs.select(doc, F.posexplode("model_parameters").alias("ord", "p")).select(doc, "ord", "p.*")
    c = x["context"]
    species = F.coalesce(c["species"], c["subject_species"])
    context = c.withField("species", species).withField("subject_species", F.coalesce(c["subject_species"], species))
    organ = F.coalesce(c["organ"], c["compartment"])
    return x.withColumn("context", F.when(c.isNotNull(), context.withField("organ", organ).withField("compartment", F.coalesce(c["compartment"], organ))))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row a paper; `duplicate` marks ids that come twice."""
    papers = spark.read.schema(MANIFEST).json(path, multiLine=True).select("corpus_version", F.inline("papers"))
    twice = papers.groupBy("paper_id").agg((F.count("*") > 1).alias("duplicate"))
    return papers.join(twice, "paper_id")


def prediction_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(paper_id, prediction_path) of a manifest that is a map, a map under
    `predictions`, or a list under it."""
    text = spark.read.text(path, wholetext=True).select("value")
    body = F.coalesce(F.get_json_object("value", "$.predictions"), F.col("value"))
    listed = F.from_json(body, "array<struct<paper_id: string, prediction_path: string>>")
    x = text.select(body.alias("b"), listed.alias("l"))
    is_list = F.ltrim("b").startswith("[")
    one = x.filter(is_list).select(F.inline("l"))
    two = x.filter(~is_list).select(F.explode(F.from_json("b", "map<string,string>")).alias("paper_id", "prediction_path"))
    return one.unionByName(two)


def files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """Paths and SHA-256 of files under a folder, each path once."""
    x = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return x.select("path", "length", F.sha2("content", 256).alias("sha256")).dropDuplicates(["path"])


def pending(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What is not done yet."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


#: Characters of the runs that names are indexed by.
GRAM = 3


def _grams(c: str, n: int = GRAM) -> Column:
    """The different runs of n characters of a name."""
    at = lambda i: F.substring(c, i, F.lit(n))
    return F.when(F.length(c) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), at))).otherwise(F.array().cast("array<string>"))


def holding(inner: DataFrame, outer: DataFrame, i: str, o: str) -> DataFrame:
    """Pairs (i, o) in which outer's name holds inner's of GRAM characters and
    more, at any place.  Outer's runs are the index; inner's name is looked up
    by that of its runs that the fewest names have, and compared whole."""
    index = outer.select(o, F.explode(_grams(o)).alias("_g"))
    common = index.groupBy("_g").count()
    rare = inner.select(i, F.explode(_grams(i)).alias("_g")).join(common, "_g").groupBy(i).agg(F.min_by("_g", F.struct("count", "_g")).alias("_g"))
    return rare.join(index, "_g").filter(F.contains(o, i)).select(i, o)


def associate(names: DataFrame, paths: DataFrame, name: str, stem: str) -> DataFrame:
    """names with `file`: an equal stem (but for case) first, else the
    shortest that holds the name or that the name holds, the first of equals;
    null without one.

    Of stems that differ in case alone the smallest counts; an empty name is in
    all.  Names under GRAM characters are runs themselves: of all stems that
    hold such a name only the best is kept, before anything is joined.
    """
    n = names.select(F.lower(name).alias("_n")).dropna().distinct()
    p = paths.dropna(subset=[stem]).groupBy(F.lower(stem).alias("_p")).agg(F.min(stem).alias("_file"))
    runs = lambda c: F.concat(F.array(F.lit("")), *(_grams(c, k) for k in range(1, GRAM)))
    best = F.struct(F.length("_p").alias("l"), F.col("_p").alias("p"))
    short = p.select("_p", F.explode(runs("_p")).alias("_n")).groupBy("_n").agg(F.min(best).alias("b")).join(n, "_n").select("_n", F.col("b.p").alias("_p"))
    within = n.select("_n", F.explode(runs("_n")).alias("_p")).join(p.select("_p"), "_p").select("_n", "_p")
    equal = n.join(p.select("_p"), F.col("_n") == F.col("_p"))
    long = holding(n, p.select("_p"), "_n", "_p").unionByName(holding(p.select("_p"), n, "_p", "_n"))
    all_ = long.unionByName(short).unionByName(within).unionByName(equal)
    found = all_.groupBy("_n").agg(F.min_by("_p", F.struct((F.col("_n") != F.col("_p")).alias("a"), F.length("_p").alias("b"), F.col("_p").alias("c"))).alias("_p"))
    files = found.join(p, "_p").select(F.col("_n").alias("_lower"), F.col("_file").alias("file"))
    return names.join(files, F.lower(name) == F.col("_lower"), "left").drop("_lower")


def json_rows(spark: SparkSession, path: str, record: str) -> DataFrame:
    """One scan of files of JSON lines: the fields of `record` (a DDL), `error`
    (the text of a line that is no record, else null), and `file`."""
    parsed = F.from_json("value", f"{record}, error string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "error"})
    return spark.read.text(path).select(parsed.alias("r"), F.col("_metadata.file_path").alias("file")).select("r.*", "file")


def scan_report(rows: DataFrame, *by: str) -> DataFrame:
    """How many lines of each file (or of what `by` names) are records and how
    many are not, and the smallest of these; a file never stops the others."""
    return rows.groupBy(*(by or ("file",))).agg(F.count_if(F.col("error").isNull()).alias("records"), F.count("error").alias("errors"), F.min("error").alias("first_error"))


def xml_metadata(articles: DataFrame, xml: str = "xml") -> DataFrame:
    """articles with title, journal, year and authors of their JATS XML."""
    given, surname = (F.expr(f"xpath({xml}, '//contrib/name/{t}/text()')") for t in ("given-names", "surname"))
    authors = F.zip_with(given, surname, lambda g, s: F.concat_ws(" ", g, s))
    return articles.withColumns({
        "title": F.expr(f"xpath_string({xml}, '//title-group/article-title')"), "journal": F.expr(f"xpath_string({xml}, '//journal-title')"),
        "year": F.expr(f"xpath_string({xml}, '(//pub-date/year)[1]')").try_cast("int"), "authors": authors,
    })


def csv_series(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A simulation's time and state columns."""
    return spark.read.schema(", ".join(f"{c} double" for c in ["time", *columns])).csv(path, header=True)


def digitised_series(spark: SparkSession, path: str) -> DataFrame:
    """(series, t, y) of digitised curves."""
    x = spark.read.schema("series string, data array<struct<time: double, concentration: double>>").json(path, multiLine=True)
    return x.select("series", F.explode("data").alias("p")).select("series", F.col("p.time").alias("t"), F.col("p.concentration").alias("y"))
