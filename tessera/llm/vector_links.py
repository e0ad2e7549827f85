"""Near-duplicate embeddings by sorted projection passes.

Equal vectors become one class first.  A pass hashes each class by the signs
of random projections and orders all by the concatenated bits; the order is
cut into blocks of WINDOW vectors, and a vector is compared with its own and
both neighbouring blocks, whose cosines are matrix products.  The number of
passes follows from the number of vectors, so that a pair at the limit is
missed with a probability of about MISS.  A vector carries its blocks of all
passes, so a pair that several passes meet is counted in the first alone and
no pair ever leaves its task: a task emits sums of links, and edges of a
spanning forest, which are united across passes.

A group with more members than a window has pairs that no pass meets.  It
shows by vectors whose window is full of links; those of one component are
taken out of the passes' counts and counted exactly: all within half the
limit's angle of their mean direction are linked with each other without any
comparison, the others are compared with all, in cells of about WINDOW by
WINDOW vectors.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import group_arrow, map_arrow, materialize, parts
from .components import components
from .vectors import clean, lengths

LIMIT, WINDOW, MISS = 0.95, 1024, 1e-4
#: Bits of a pass's key; blocks that a task compares in a row; passes whose
#: vectors are dealt out by one job.
BITS, RUN, AT_ONCE = 63, 8, 4
SEED = 29


def passes(n: int, window: int = WINDOW, limit: float = LIMIT, miss: float = MISS) -> int:
    """Passes after which a pair at the limit is missed with a probability of
    about `miss`.  The bits that n vectors need to fall apart into windows,
    and a quarter more, as data are less even than hashes, must agree."""
    bits = 1.25 * math.log2(max(1.0, n / (2 * window)))
    met = (1 - math.acos(limit) / math.pi) ** bits
    return 1 if met > 1 - miss else math.ceil(math.log(miss) / math.log(1 - met))


def units(blobs: list[bytes], kind: str) -> np.ndarray:
    """Stored vectors of one length as unit vectors in double precision."""
    x = np.frombuffer(b"".join(blobs), kind).reshape(len(blobs), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _packed(rows: DataFrame, key: str, vector: str, kind: str) -> DataFrame:
    """(id, h, dims, v): vectors as bytes and 128 bits of their digest."""

    def run(batches):
        for b in batches:
            n = lengths(b.column(1)).tolist()
            flat, at, blobs = np.asarray(b.column(1).flatten()).astype(kind) + 0.0, 0, []  # -0.0 is 0.0
            for k in n:
                blobs.append(flat[at : at + k].tobytes())
                at += k
            digests = [hashlib.blake2b(x, digest_size=16).digest() for x in blobs]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(digests), pa.array(n, pa.int64()), pa.array(blobs)], ["id", "h", "dims", "v"])

    schema = rows.select(F.col(key).alias("id"), F.lit(b"").alias("h"), F.lit(0).cast("long").alias("dims"), F.lit(b"").alias("v")).schema
    return map_arrow(rows.select(key, vector), run, schema)


def _by_length(b: pa.RecordBatch | pa.Table):
    """(length, row numbers) for each length of vectors."""
    dims = np.asarray(b.column("dims"))
    for d in np.unique(dims).tolist():
        yield d, np.flatnonzero(dims == d)


def _means(classes: DataFrame, kind: str) -> dict[int, np.ndarray]:
    """The mean unit vector of each length of vectors."""

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            blobs = b.column("v").to_pylist()
            for d, at in _by_length(b):
                u = units([blobs[i] for i in at], kind)
                sums[d] = sums.get(d, 0) + np.append(u.sum(axis=0), len(u))
        for d, s in sums.items():
            yield pa.RecordBatch.from_pydict({"dims": [d] * (d + 1), "pos": list(range(d + 1)), "s": s})

    rows = map_arrow(classes.select("dims", "v"), run, "dims long, pos long, s double").groupBy("dims", "pos").agg(F.sum("s").alias("s")).collect()
    out = {r.dims: np.zeros(r.dims + 1) for r in rows}
    for r in rows:
        out[r.dims][r.pos] = r.s
    return {d: s[:-1] / s[-1] for d, s in out.items()}


def _keys(classes: DataFrame, n_passes: int, kind: str) -> DataFrame:
    """(c, dims, pass, key): the signs of BITS projections, from the mean of
    all vectors on, as one number."""
    means = classes.sparkSession.sparkContext.broadcast(_means(classes, kind))
    weights = np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)

    def run(batches):
        for b in batches:
            blobs, c = b.column("v").to_pylist(), np.asarray(b.column("c"))
            for d, at in _by_length(b):
                u = units([blobs[i] for i in at], kind) - means.value[d]
                for p in range(n_passes):
                    planes = np.random.default_rng([SEED, p, d]).standard_normal((d, BITS))
                    keys = (u @ planes > 0) @ weights
                    yield pa.RecordBatch.from_pydict({"c": c[at], "dims": np.full(len(at), d), "pass": np.full(len(at), p), "key": keys})

    return map_arrow(classes.select("c", "dims", "v"), run, "c long, dims long, pass long, key long")


def _placed(classes: DataFrame, n_passes: int, window: int, kind: str) -> DataFrame:
    """classes with `blocks`: where each pass has put them."""
    order = ["pass", "dims", "key", "c"]
    rows = _keys(classes, n_passes, kind).repartitionByRange(parts(classes.sparkSession), *order).sortWithinPartitions(*order)
    rows = materialize(rows.select("c", "pass", F.monotonically_increasing_id().alias("at")), "order")
    part = F.shiftright("at", 33)  # Spark's id: partition, then row
    before, total = [], 0
    for r in rows.groupBy(part.alias("part")).count().orderBy("part").collect():  # a row a partition
        before.append((r.part, total))
        total += r["count"]
    starts = classes.sparkSession.createDataFrame(before, "part long, start long")
    rows = rows.withColumn("part", part).join(F.broadcast(starts), "part")
    blocks = rows.select("c", F.struct("pass", F.expr(f"(start + (at & {(1 << 33) - 1})) div {window}").alias("block")).alias("p"))
    blocks = blocks.groupBy("c").agg(F.transform(F.sort_array(F.collect_list("p")), lambda x: x["block"]).alias("blocks"))
    return materialize(classes.join(blocks, "c"), "placed")


def _linked(a: np.ndarray, b: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of a and b with a cosine of at least the limit.  Products in
    single precision decide, but for those near it."""
    near = 4e-7 * a.shape[1]
    c = a.astype(np.float32) @ b.astype(np.float32).T
    i, j = np.nonzero(c >= np.float32(limit - near))
    close = np.flatnonzero(c[i, j] <= limit + near)
    sure = np.ones(len(i), bool)
    sure[close] = np.einsum("ij,ij->i", a[i[close]], b[j[close]]) >= limit
    return i[sure], j[sure]


def _unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """label with the classes of i[k] and j[k] made one, for all k."""
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]
    return label


def _compare(placed: DataFrame, n_passes: int, window: int, limit: float, kind: str) -> DataFrame:
    """(c, links, root, full): of each task, the copies of other vectors that
    a vector is linked with, a smaller vector of its component (or null), and
    if its window is full; only what no earlier pass meets is counted."""
    schema = "c long, links long, root long, full boolean"

    def run(key, t):
        task = key[0].as_py()
        order = np.lexsort([np.asarray(t.column(x)) for x in ("block", "dims", "pass")])
        t = t.take(pa.array(order))
        c, n, which, block, dims = (np.asarray(t.column(x)) for x in ("c", "n", "pass", "block", "dims"))
        places = np.asarray(t.column("blocks").combine_chunks().flatten()).reshape(len(c), n_passes)
        blobs = t.column("v").to_pylist()
        links, seen, label = np.zeros(len(c)), np.zeros(len(c), np.int64), np.arange(len(c))
        cuts = np.flatnonzero((np.diff(which) != 0) | (np.diff(dims) != 0)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(c)], strict=True):
            u, p = units(blobs[lo:hi], kind), which[lo]
            begin = {b: lo + int(k) for b, k in zip(*np.unique(block[lo:hi], return_index=True), strict=True)}
            end = dict(zip(begin, [*list(begin.values())[1:], hi], strict=True))
            for b in begin:
                for other in (b, b - 1):
                    if other not in begin or other == b < task * RUN:  # the block before the task's own
                        continue
                    i, j = _linked(u[begin[b] - lo : end[b] - lo], u[begin[other] - lo : end[other] - lo], limit)
                    i, j = i + begin[b], j + begin[other]
                    if b == other:
                        i, j = i[i > j], j[i > j]
                    seen += np.bincount(i, minlength=len(c)) + np.bincount(j, minlength=len(c))
                    for q in range(p):
                        new = np.abs(places[i, q] - places[j, q]) > 1
                        i, j = i[new], j[new]
                    links += np.bincount(i, n[j], len(c)) + np.bincount(j, n[i], len(c))
                    label = _unite(label, i, j)
        full = seen >= window // 8
        some = np.flatnonzero((links > 0) | full | (label != np.arange(len(c))))
        tied = label[some] != some
        return pa.Table.from_pydict({"c": c[some], "links": links[some].astype(np.int64), "root": pa.array(c[label[some]], mask=~tied), "full": full[some]})

    own = F.expr(f"block div {RUN}")
    tasks = F.when(F.col("block") % RUN == RUN - 1, F.array(own, own + 1)).otherwise(F.array(own))
    out = None
    for first in range(0, n_passes, AT_ONCE):
        rows = placed.select("c", "dims", "n", "v", "blocks", F.posexplode(F.slice("blocks", first + 1, AT_ONCE)).alias("pass", "block"))
        rows = rows.withColumn("pass", F.col("pass").cast("long") + first).withColumn("task", F.explode(tasks))
        some = materialize(group_arrow(rows, run, schema, by="task"), "links")
        out = some if out is None else out.unionByName(some)
    return out


def _rest(full: DataFrame, window: int, limit: float, kind: str) -> DataFrame:
    """(c, links) of all pairs of `full` (c, root, dims, n, v) with one root,
    each counted, though a group's core is not compared."""
    half = math.sqrt((1 + limit) / 2) + 1e-9

    def spread(batches):
        for b in batches:
            blobs, root = b.column("v").to_pylist(), np.asarray(b.column("root"))
            for d, at in _by_length(b):
                u = units([blobs[i] for i in at], kind)
                yield pa.RecordBatch.from_pydict({"root": root[at], "u": pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * d, u.ravel())})

    def cosines(batches):
        for b in batches:
            blobs, means, out = b.column("v").to_pylist(), b.column("mean"), np.zeros(b.num_rows)
            flat, starts = np.asarray(means.flatten()), np.concatenate([[0], np.cumsum(lengths(means))])
            for d, at in _by_length(b):
                m = np.stack([flat[starts[i] : starts[i] + d] for i in at.tolist()])
                norm = np.sqrt((m * m).sum(axis=1))
                out[at] = np.einsum("ij,ij->i", units([blobs[i] for i in at], kind), m) / np.where(norm > 0, norm, 1)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out >= half)], [*b.schema.names[:-1], "core"])

    def cell(key, t):
        outer, c, n, core = (np.asarray(t.column(x)) for x in ("as_outer", "c", "n", "core"))
        blobs, links = t.column("v").to_pylist(), np.zeros(len(c))
        for _, at in _by_length(t):
            a, b = at[outer[at]], at[~outer[at]]
            if len(a) and len(b):
                i, j = _linked(units([blobs[x] for x in a], kind), units([blobs[x] for x in b], kind), limit)
                i, j = a[i], b[j]
                i, j = i[c[i] != c[j]], j[c[i] != c[j]]
                links += np.bincount(i, n[j], len(c))
                j, i = j[core[j]], i[core[j]]
                links += np.bincount(j, n[i], len(c))
        some = links > 0
        return pa.Table.from_pydict({"c": c[some], "links": links[some].astype(np.int64)})

    sums = map_arrow(full.select("root", "dims", "v"), spread, "root long, u array<double>").select("root", F.posexplode("u").alias("pos", "x")).groupBy("root", "pos").agg(F.sum("x").alias("x"))
    means = sums.groupBy("root").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "x"))), lambda p: p["x"]).alias("mean"))
    rows = full.select("c", "root", "dims", "n", "v").join(means, "root").select("c", "root", "dims", "n", "v", "mean")
    rows = materialize(map_arrow(rows, cosines, "c long, root long, dims long, n long, v binary, core boolean"), "full")
    sizes = rows.groupBy("root").agg(
        F.sum(F.when(F.col("core"), F.col("n")).otherwise(0)).alias("copies"), F.ceil(F.count("*") / window).alias("cells"), F.ceil(F.count_if(~F.col("core")) / window).alias("outer_cells"),
    )
    rows = rows.join(sizes, "root")
    inner = rows.filter("core").select("c", (F.col("copies") - F.col("n")).alias("links"))
    mine = F.xxhash64("c")
    each = lambda most: F.explode(F.sequence(F.lit(0).cast("long"), F.col(most) - 1))
    every = rows.filter("outer_cells > 0").withColumn("a", F.pmod(mine, "cells")).withColumn("o", each("outer_cells")).withColumn("as_outer", F.lit(False))
    outer = rows.filter("NOT core").withColumn("o", F.pmod(mine, "outer_cells")).withColumn("a", each("cells")).withColumn("as_outer", F.lit(True))
    return inner.unionByName(group_arrow(every.unionByName(outer), cell, "c long, links long", by=["root", "a", "o"]))


def link_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", limit: float = LIMIT, window: int = WINDOW, miss: float = MISS) -> DataFrame:
    """rows' keys with `n_links` (other vectors at a cosine of at least
    `limit`), `component_id` (the smallest key reachable by links) and `kept`
    (the key is its component's).

    Vectors that are null, empty or zero, or hold null or non-finite entries,
    link with nothing, and vectors of different lengths don't link with each
    other.  Equal vectors, of repeated rows too, are all linked.  A null key
    is never kept and names a component only where no other key does.  An
    empty table gives no rows; other columns of rows are not read.
    """
    spark = rows.sparkSession
    kind = "<f4" if rows.schema[vector].dataType.elementType.typeName() == "float" else "<f8"
    good = clean(vector, math.inf) & F.exists(vector, lambda x: x != 0)
    alone = rows.filter(~F.coalesce(good, F.lit(False))).select(F.col(key).alias("id"), F.lit(0).cast("long").alias("n_links"), F.col(key).alias("component_id"))
    packed = materialize(_packed(rows.filter(good), key, vector, kind), "vectors")
    classes = packed.groupBy("h").agg(F.first("dims").alias("dims"), F.first("v").alias("v"), F.count("*").alias("n"), F.min("id").alias("least"))
    classes = materialize(classes.withColumn("c", F.monotonically_increasing_id()), "classes")
    n_passes = passes(classes.count(), window, limit, miss)
    placed = _placed(classes.select("c", "dims", "v", "n"), n_passes, window, kind)
    found = _compare(placed, n_passes, window, limit, kind)
    roots = materialize(components(found.filter("root IS NOT NULL").select(F.col("c").alias("a"), F.col("root").alias("b"))), "roots").withColumnRenamed("u", "c")
    counts = found.select("c", "links")
    full = found.filter("full").select("c").distinct().join(roots, "c", "left").select("c", F.coalesce("root", "c").alias("root"))
    full = materialize(placed.join(full, "c"), "full")
    if full.limit(1).count():
        met = _compare(full, n_passes, window, limit, kind)
        counts = counts.unionByName(met.select("c", (-F.col("links")).alias("links"))).unionByName(_rest(full, window, limit, kind))
    tied = roots.unionByName(roots.select(F.col("root").alias("c"), "root").distinct())
    least = tied.join(classes.select("c", "least"), "c").groupBy("root").agg(F.min("least").alias("component_id"))
    known = (
        classes.select("c", "h", "n", "least").join(counts.groupBy("c").agg(F.sum("links").alias("links")), "c", "left")
        .join(tied.join(least, "root").select("c", "component_id"), "c", "left")
        .select("h", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"))
    )
    out = packed.select("id", "h").join(known, "h").drop("h").unionByName(alone)
    return out.select(F.col("id").alias(key), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op11_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
