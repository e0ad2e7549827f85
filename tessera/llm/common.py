"""What the operators share: the shared work folder, text columns, batches."""

from __future__ import annotations

import atexit
import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of an Arrow batch, about.
BATCH = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where that setting is empty a local session, as in tests, gets a temporary
    folder; on a cluster, whose machines would not share it, it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


_made: list[tuple[object, str]] = []


def _delete(made: list[tuple[object, str]]) -> None:
    for jsc, path in made:
        try:
            p = jsc.sc().hadoopConfiguration()
            hp = jsc._gateway.jvm.org.apache.hadoop.fs.Path(path)
            hp.getFileSystem(p).delete(hp, True)
        except Exception:  # noqa: BLE001, S110  the JVM may be gone already
            pass


atexit.register(lambda: _delete(_made))


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append((spark.sparkContext._jsc, path))
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back.

    This cuts the lineage: a lost executor costs a read of the written
    files, not a new run of what made them.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def step(make: Callable[[], DataFrame], name: str, source: tuple | None = None) -> tuple[DataFrame, tuple]:
    """make()'s rows, written, and what to give the next step as source.  The
    files that make() wrote on its way, and the source's, are deleted then, so
    a chain of steps holds the files of one."""
    mark = len(_made)
    out = materialize(make(), name)
    kept = _made[-1]
    _delete([x for x in [*_made[mark:-1], source] if x])
    _made[mark:] = [kept]
    if source in _made:
        _made.remove(source)
    return out, kept


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def text_hashes(text: Column) -> tuple[Column, Column]:
    """Two hashes of a text that together tell texts apart: Spark's hash of
    several columns takes the first one's as the next one's seed, so a second
    hash that begins with the text would be a function of the first."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def parts(spark: SparkSession) -> int:
    """Partitions to deal a shuffle into: the session's setting, which a
    cluster sets in proportion to its data."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


def column_bytes(col: pa.Array) -> list[bytes]:
    """A text or binary column as bytes, null as empty."""
    return [x or b"" for x in col.cast(pa.large_binary()).to_pylist()]


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose column holds about `limit` bytes at most
    (a longer single text stands alone)."""
    for b in batches:
        if not b.num_rows:
            continue
        import pyarrow.compute as pc

        n = pc.fill_null(pc.binary_length(b.column(column)), 0).to_pylist()
        start = total = 0
        for i, x in enumerate(n):
            if i > start and total + x > limit:
                yield b.slice(start, i - start)
                start, total = i, 0
            total += x
        yield b.slice(start)


def _give_back() -> None:
    """Return to the system what a task has freed: workers are used again, and
    what a heap keeps of a long text would add up over an executor's workers."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def map_arrow(df: DataFrame, f: Callable, schema: object) -> DataFrame:
    """df.mapInArrow(f, schema), with batches of BATCH bytes, about, unless the
    session has its own limit, and freed memory given back at a task's end."""
    name, spark = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession
    if spark.conf.get(name, None) in (None, f"{64 << 20}b"):  # Spark's default
        spark.conf.set(name, str(BATCH))

    def run(batches):
        try:
            yield from f(batches)
        finally:
            _give_back()

    return df.mapInArrow(run, schema)


def group_arrow(df: DataFrame, f: Callable, schema: object, by: str | list[str] = "bucket") -> DataFrame:
    """df.groupBy(by).applyInArrow(f, schema), where f takes (key, rows)."""

    def run(key, rows):
        try:
            return f(key, rows)
        finally:
            _give_back()

    return df.groupBy(by).applyInArrow(run, schema)
