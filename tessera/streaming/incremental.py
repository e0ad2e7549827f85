"""Incremental runs: new chunks only, each once, resumable."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def new_chunks(spark: SparkSession, folder: str, schema: str, key: str = "chunk_id", time: str = "ts", late: str = "1 hour") -> DataFrame:
    """A stream of a folder's chunks; a chunk that comes again within the
    watermark is dropped."""
    return spark.readStream.schema(schema).parquet(folder).withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def run(stream: DataFrame, extract: Callable[[DataFrame], DataFrame], target: str, checkpoint: str):
    """Write extract(chunks) of what is there now, a folder a batch.

    What the stream has read, and the keys that it has seen, are in the
    checkpoint; a batch that comes again after a failure replaces its own
    folder.  So each chunk is extracted once, and the target is never read.
    """
    def write(batch: DataFrame, number: int) -> None:
        extract(batch).write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def results(spark: SparkSession, target: str) -> DataFrame:
    """All batches' rows, with `batch`."""
    return spark.read.parquet(target)
