"""The corpus pipeline: quality rules, near duplicates, repeated strings,
benchmark passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import stages
from tessera.llm.common import step

STAGES = [
    ("quality_rules", stages.quality_rules),
    ("ngram_join", stages.ngram_join),
    ("suffix_dedup", stages.suffix_dedup),
    ("decontamination", stages.decontamination),
    ("packing", stages.packing),
]

#: Suffix sorts and packing are not for SQL; tests/llm holds the pipeline
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over documents; each stage is written as
    Parquet and read again by the next."""
    docs, written = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs, written = step(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name, written)
    return STAGES[-1][1](spark, docs, sf_dir)
