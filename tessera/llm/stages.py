"""The operators as stages of a corpus pipeline: documents in, documents out.

Every stage takes (spark, docs, sf_dir) and returns the columns of documents,
but for the last.  A stage that changes texts sets n_chars anew.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import chunks, column_bytes, map_arrow, materialize, text_hashes
from .decontamination import contaminated
from .ngram_join import join_similar
from .packing import pack_documents
from .quality import judge
from .suffix_dedup import cut, mark_repeats
from .tokens import vocabulary_path

VOCABULARY = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects.

    A null or empty text is rejected; repeated rows are judged each for
    itself; an empty table stays empty; columns of docs may have any names.
    """
    kept = "kept" + "_" * max(map(len, docs.columns))  # a name that docs has not
    return judge(docs, out=kept).filter(F.col(kept)).drop(kept)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest
    doc_id.

    Of rows with one doc_id one stays, the one with the smallest text (null
    before all others; of equal texts the one with the smallest hash of its
    columns).  Rows without doc_id stay.  A null or wordless text is like
    none.  An empty table stays empty; columns of docs may have any names.
    """
    found = join_similar(docs).filter("doc_id IS NOT NULL")
    per = found.groupBy("doc_id").agg(F.bool_or(F.col("doc_id") == F.col("component_id")).alias("stays"), F.count("*").alias("n"))
    per = materialize(per.filter("NOT stays OR n > 1"), "groups")
    # What goes is the smaller table: texts are only dealt out by doc_id if
    # it is too large to be sent to all.
    packed = docs.select("doc_id", F.struct("*").alias("row"))
    w = Window.partitionBy("doc_id").orderBy(F.asc_nulls_first("row.text"), F.xxhash64("row"))
    one = packed.join(per.filter("stays").select("doc_id"), "doc_id", "left_semi").withColumn("k", F.row_number().over(w)).filter("k = 1")
    rest = packed.join(per.select("doc_id"), "doc_id", "left_anti")
    return rest.select("row.*").unionByName(one.select("row.*"))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes under strings that the corpus repeats.

    A character that a cut leaves in part goes too.  A null text stays null,
    one of repeated strings alone becomes empty; n_chars is set anew
    where there is a text; copies of a whole text all become empty.  An empty table
    stays empty; columns of docs may have any names but `spans`.
    """
    marked = mark_repeats(docs)
    at, chars, schema, names = docs.columns.index("text"), docs.columns.index("n_chars"), docs.schema, docs.columns

    def run(batches):
        for b in chunks(batches, "text", 1 << 20):
            spans, texts, sizes = b.column(len(names)).to_pylist(), [], []
            for raw, null, sp, n in zip(column_bytes(b.column(at)), b.column(at).is_null().to_pylist(), spans, b.column(chars).to_pylist(), strict=True):
                text = None if null else cut(raw, sp).decode("utf-8", "ignore")
                texts.append(text)
                sizes.append(n if null else len(text))
            cols = list(b.columns[: len(names)])
            cols[at], cols[chars] = pa.array(texts, pa.string()), pa.array(sizes, b.column(chars).type)
            yield pa.RecordBatch.from_arrays(cols, names)

    return map_arrow(marked, run, schema)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item.

    The verdict hangs on the text alone, so it goes back by two hashes of the
    text, of the few texts that go.  A null or wordless text stays; repeated
    rows go or stay together; an empty table, or an empty benchmark, changes
    nothing; columns of docs may have any names.
    """
    hashes = [h.alias(n) for h, n in zip(text_hashes(F.col("text")), ("v", "w"), strict=True)]
    key = F.struct(*hashes).alias("key")
    found = contaminated(docs.select(key, "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), key="key")
    # Written, its size is known before texts would be dealt out for a join.
    bad = materialize(found.filter("contaminated").select("key.*").distinct(), "contaminated")
    packed = docs.select(F.struct("*").alias("row"), *hashes)
    return packed.join(bad, ["v", "w"], "left_anti").select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences.

    A null text is an empty one and gives a piece with the end id alone;
    repeated rows are packed each for itself; equal lengths are dealt by
    doc_id and piece; an empty table gives no pieces; other columns of docs
    are not read.
    """
    return pack_documents(docs, vocabulary_path(VOCABULARY))
