"""Best-fit packing by minimum bin slack.

Every bin is filled by the fullest feasible combination of the lengths that
are left: a bitset holds the reachable sums, one shift per piece, and the
combination of the highest sum is read back from the layers of the bitset.
The largest length left is in each bin, so that none is left for the end.

The search needs the histogram of lengths only, which has at most `capacity`
rows however many documents there are.  A combination is applied as often as
its lengths allow at once, so the number of combinations is bounded by the
capacity too: after each application some length has fewer pieces left than
one bin could take, which happens at most sum(capacity // length) times.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import chunks, map_arrow, materialize, parts
from .tokens import Encoder, vocabulary_path

CAPACITY, END_ID = 1024, 2


class Share(NamedTuple):
    """Ranks lo..hi-1 of a length go to bins from `bin` on, `each` a bin, the
    first of a bin at `offset`."""

    lo: int
    hi: int
    each: int
    bin: int
    offset: int


def fullest(left: dict[int, int], capacity: int) -> dict[int, int]:
    """Pieces of each length in the fullest bin that holds a largest length."""
    largest = max(left)
    room, layers, bits = capacity - largest, [], 1
    mask = (1 << (room + 1)) - 1
    for length in sorted(left):
        if length > room:
            break
        layers.append((length, bits))
        step = bits
        for _ in range(min(left[length] - (length == largest), room // length)):
            step = (step << length) & mask
            if not step | bits != bits:
                break
            bits |= step
    total, out = bits.bit_length() - 1, Counter({largest: 1})
    for length, before in reversed(layers):
        most = min(left[length] - (length == largest), total // length)
        m = next(m for m in range(most, -1, -1) if before >> (total - m * length) & 1)
        if m:
            out[length] += m
            total -= m * length
    return dict(out)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[dict[int, list[Share]], int]:
    """For each length the shares of its ranks, and the number of bins."""
    left = {k: v for k, v in histogram.items() if v}
    used: Counter[int] = Counter()
    shares: dict[int, list[Share]] = {k: [] for k in left}
    bins = 0
    while left:
        chosen = fullest(left, capacity)
        times, offset = min(left[k] // m for k, m in chosen.items()), 0
        for k in sorted(chosen, reverse=True):
            m = chosen[k]
            shares[k].append(Share(used[k], used[k] + m * times, m, bins, offset))
            offset += m * k
            used[k] += m * times
            left[k] -= m * times
            if not left[k]:
                del left[k]
        bins += times
    return shares, bins


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, text: str = "text", key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]): documents as id
    sequences with end_id at the end, those over capacity cut, the first piece
    the shorter one."""
    docs = docs.select(key, text)
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * with_ids]
    end = end_id.to_bytes(4, "little")

    def run(batches):
        encoder = Encoder(path)
        for b in chunks(batches, text, 1 << 20):
            at, rows = [], []
            for i, x in enumerate(b.column(1).to_pylist()):
                ids = (encoder.ids(x) if x else b"") + end
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for p, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    own = ids[4 * s : 4 * e]
                    at.append(i)
                    rows.append((p, s, e - s, zlib.crc32(own), *[own] * with_ids))
            cols = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], [key, "piece", "start", "length", "ids_crc32", *["ids"] * with_ids])

    return map_arrow(docs, run, schema)


def pack(cut: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """cut (with a column length, 1 to capacity) with sequence_id and offset.

    Pieces of one length are alike to the search and are told apart by rank.
    Ranks are dealt in two levels, (length, bucket) and within, so a length
    that a third of all pieces have is not one task's.
    cut is read twice: pass one that is cheap to read.
    """
    spark = cut.sparkSession
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    shares, _ = plan(histogram, capacity)
    starts = {k: [s.lo for s in v] for k, v in shares.items()}
    plans = spark.sparkContext.broadcast((shares, starts))
    buckets = parts(spark)
    cut = cut.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = (
        cut.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .drop("_n")
    )
    ranked = (
        cut.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_bucket").orderBy(*order)))
        .join(before, ["length", "_bucket"]).withColumn("_rank", F.col("_rank") - 1 + F.col("_before")).drop("_before", "_bucket")
    )
    out = ranked.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).drop("_rank")
    names = ranked.columns
    at, rank = names.index("length"), names.index("_rank")
    fields, schema = out.columns, out.schema

    def run(batches):
        shares, starts = plans.value
        for b in batches:
            seq, off = [], []
            for k, r in zip(b.column(at).to_pylist(), b.column(rank).to_pylist(), strict=True):
                s = shares[k][bisect_right(starts[k], r) - 1]
                q, j = divmod(r - s.lo, s.each)
                seq.append(s.bin + q)
                off.append(s.offset + j * k)
            keep = [c for i, c in enumerate(b.columns) if i != rank]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(seq, pa.int64()), pa.array(off, pa.int64())], fields)

    return map_arrow(ranked, run, schema)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Every document's pieces with their places in sequences of `capacity`.

    A null text is an empty one (its sequence is end_id alone); equal rows are
    packed each for itself; an empty table gives no pieces.  Other columns of
    docs are not read.  with_ids adds the ids themselves.
    """
    cut = materialize(pieces(docs, path, capacity, end_id, with_ids=with_ids), "pieces")
    return pack(cut, capacity)


def op9_packing(spark: SparkSession, sf_dir: str, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    packed = pack_documents(docs, vocabulary_path(vocabulary))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
