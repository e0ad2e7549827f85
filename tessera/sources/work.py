"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[object, str]] = []
_tables: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a local session without that setting, as in
    tests, gets a temporary folder, a cluster an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that is deleted when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append((spark.sparkContext._jsc, path))
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df's rows, computed once and read back: what is read by several
    branches, or made in rounds, is not made anew by each, nor after a loss."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, name: str, by: str, parts: int) -> DataFrame:
    """As written(), in buckets by a column: a bucket is a task of each branch,
    so joins, groups and windows by that column and more are not shuffled.

    df should come dealt by it in as many parts, or a task writes a file for
    each bucket.  Buckets need a table's name in the session's catalog.  The
    session is told to read all by bucket, as Spark else packs the files of
    what is only mapped, and compact files would be one task; and that a deal
    by part of the keys is enough for a join.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    path = new_path(spark, name)
    table = path.rpartition("/")[2].replace("-", "_")
    df.write.bucketBy(parts, by).option("path", path).saveAsTable(table, format="parquet")
    _tables.append((spark, table))
    return spark.table(table)


@atexit.register
def _clear() -> None:
    for spark, table in _tables:
        try:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        except Exception:  # noqa: BLE001, S110
            pass
    for jsc, path in _made:
        try:
            at = jsc._gateway.jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(jsc.sc().hadoopConfiguration()).delete(at, True)
        except Exception:  # noqa: BLE001, S110  the JVM may be gone already
            pass
