"""Sharding: a uniform shuffle with exact shard sizes.

Rows belong to blocks by a hash of their key.  A communication matrix of
blocks by shards is drawn from the multivariate hypergeometric law: it is how
a uniform permutation of all rows would deal each block's rows to the shards,
whose sizes are fixed beforehand, at most one apart.  Each block permutes its
rows and hands them out by its row of the matrix; each shard permutes what it
gets.  Both permutations sort by keyed hashes, so a task that runs again after
an executor is lost deals the same rows to the same places.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Blocks, whatever the input: the matrix has BLOCKS x shards numbers.
BLOCKS = 512


def matrix(rows: list[int], sizes: list[int], seed: int) -> np.ndarray:
    """Counts from block to shard with the given row sums and column sums,
    each block's drawn from what the blocks before it have left."""
    rng, left, out = np.random.default_rng(seed), np.array(sizes, np.int64), []
    for n in rows:
        take = np.zeros_like(left)
        total, need = int(left.sum()), n
        for j, c in enumerate(left.tolist()):  # one hypergeometric draw a shard
            if need and c:
                take[j] = need if total == c else _draw(rng, c, total - c, need)
                need -= int(take[j])
            total -= c
        left -= take
        out.append(take)
    return np.array(out, np.int64).reshape(len(rows), len(sizes))


def _draw(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """One hypergeometric draw.  numpy's goes up to 10**9 of each kind; beyond,
    the law is summed from its mode outwards, by the ratios of neighbouring
    probabilities, and inverted: the same law to double precision."""
    if max(good, bad) < 10**9:
        return int(rng.hypergeometric(good, bad, n))
    total = good + bad
    dev = (n * (good / total) * (bad / total) * ((total - n) / max(1, total - 1))) ** 0.5
    mode = (n + 1) * (good + 1) // (total + 2)
    reach = int(40 * dev) + 40  # what lies farther is under 1e-300
    low, high = max(0, n - bad, mode - reach), min(good, n, mode + reach)
    up, down = np.arange(mode, high, dtype=np.float64), np.arange(mode, low, -1, dtype=np.float64)
    above = np.cumprod((good - up) / (up + 1) * (n - up) / (bad - n + up + 1))
    below = np.cumprod(down / (good - down + 1) * (bad - n + down) / (n - down + 1))
    law = np.cumsum(np.concatenate([below[::-1], [1.0], above]))
    return low + int(np.searchsorted(law, rng.random() * law[-1], "right"))


#: Ranges of a permutation's hashes that are ranked each for itself.
CELLS = 64


def _ranked(rows: DataFrame, group: str, mix: str, out: str) -> DataFrame:
    """rows with `out`, the rank from 0 in each group by (cell, mix, k).  The
    ranks of CELLS ranges of mix are taken apart and added up, so a group is
    no single task's."""
    rows = rows.withColumn("cell", F.shiftrightunsigned(F.col(mix), 58).cast("int"))
    counts = rows.groupBy(group, "cell").agg(F.count("*").alias("c"))
    ahead = Window.partitionBy(group).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(group, "cell", F.coalesce(F.sum("c").over(ahead), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy(group, "cell").orderBy(mix, "k")) - 1
    return rows.withColumn(out, own).join(F.broadcast(before), [group, "cell"]).withColumn(out, (F.col(out) + F.col("before")).cast("long")).drop("before", "cell")


def shard(rows: DataFrame, key: list[str], shards: int, seed: int = 17) -> DataFrame:
    """rows with `shard` (0 to shards - 1) and `slot` (gapless from 0).

    key: columns that tell rows apart; rows equal in all of them are
    interchangeable and spread like any others, so a group of copies does not
    stay together.  Nulls in key are one value; very long keys are hashed
    whole.  Columns of rows named shard or slot are replaced, any other name
    may occur.  An empty table gives an empty one.
    """
    assert CELLS * max(BLOCKS, shards) <= 1 << 20, "the tables of counts are broadcast"
    spark = rows.sparkSession
    rows = rows.drop("shard", "slot")
    packed = rows.select(
        F.struct("*").alias("row"), F.struct(*key).alias("k"), F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(BLOCKS)).cast("int").alias("block"),
        F.xxhash64(F.lit(seed + 1), *key).alias("deal"), F.xxhash64(F.lit(seed + 2), *key).alias("mix"),
    )
    counts = {r.block: r.n for r in packed.groupBy("block").agg(F.count("*").alias("n")).collect()}
    total, blocks = sum(counts.values()), sorted(counts)
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    ends = np.cumsum(matrix([counts[b] for b in blocks], sizes, seed), axis=1)
    dealt = spark.createDataFrame([(int(b), [int(x) for x in e]) for b, e in zip(blocks, ends, strict=True)], "block int, ends array<long>")
    out = _ranked(packed, "block", "deal", "rank").join(F.broadcast(dealt), "block")
    out = out.withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("rank")))).drop("ends", "block", "rank", "deal")
    return _ranked(out, "shard", "mix", "slot").select("row.*", "shard", "slot")


def op10_sharding(spark: SparkSession, sf_dir: str, shards: int = 40) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = docs.select("doc_id", (F.octet_length(raw) + 16).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    return shard(rows, ["doc_id", "size", "text_crc32"], shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
