"""Token counts: a map-side lookup in two tiers, without any shuffle of texts.

Tier one is a compact table of the lengths of frequent pre-tokens, counted on
a bounded sample of documents and broadcast (FREQUENT entries at most, each of
LONGEST characters at most: its size is bounded whatever the input).  Tier two
is a bounded cache in each Python worker; what it misses is encoded by the
library.  Which pre-tokens are in a tier changes the speed, never the counts.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, map_arrow
from .tokens import LONGEST, Encoder, load, vocabulary_path

#: Documents that the sample for tier one expects, and the entries of tier one.
SAMPLE, FREQUENT = 1_000, 32_768


def frequent_lengths(docs: DataFrame, path: str, text: str = "text", sample: int = SAMPLE, entries: int = FREQUENT) -> dict[str, int]:
    """Tier one: token counts of the most frequent pre-tokens of about
    `sample` documents.  A tokenizer's file must be on every worker at `path`."""
    n = docs.count()
    if not n:
        return {}

    def count(batches):
        seen: Counter[str] = Counter()
        encoder = Encoder(path)
        for b in batches:
            for x in b.column(0).to_pylist():
                seen.update(p for p in encoder.pretokens(x or "") if len(p) <= LONGEST)
        top = seen.most_common(entries)
        yield pa.RecordBatch.from_pydict({"p": [k for k, _ in top], "n": [v for _, v in top]}, schema=pa.schema([("p", pa.string()), ("n", pa.int64())]))

    rows = (
        map_arrow(docs.select(text).sample(min(1.0, sample / n), seed=7), count, "p string, n long")
        .groupBy("p").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "p").limit(entries).collect()
    )
    library = load(path)
    keys = [r.p for r in rows]
    return dict(zip(keys, (len(e.ids) for e in library.encode_batch(keys, add_special_tokens=False)), strict=True))


def count_tokens(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """docs with a column `out`: the tokens of each whole text.

    A null text has 0 tokens, as an empty one; repeated rows are counted each
    for itself; an empty table gives an empty one.  A column of docs named
    `out` is replaced.
    """
    spark: SparkSession = docs.sparkSession
    docs = docs.drop(out)
    table = spark.sparkContext.broadcast(frequent_lengths(docs, path, text))
    at = docs.columns.index(text)
    schema = docs.select("*", F.lit(0).cast("long").alias(out)).schema

    def run(batches):
        encoder = Encoder(path, table.value)
        for b in chunks(batches, text, 1 << 20):
            n = [encoder.count(x) if x else 0 for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n, pa.int64())], [*b.schema.names, out])

    return map_arrow(docs, run, schema)


def op5_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = "byte_bpe_50k.json", limit: int = 512) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    counted = count_tokens(docs, vocabulary_path(vocabulary))
    return counted.select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
