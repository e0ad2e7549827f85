"""N-gram Jaccard join: all documents whose shingle sets are similar, exactly.

1. Each task turns its documents into sets of hashed shingles and deals them
   as packed postings, a row a bucket, not a row a shingle.  Documents of one
   set are one vertex from here on.
2. A bucket has all postings of its shingles, so it knows how many vertices
   have each.  Those that one vertex has alone can't be shared; the others go
   back to the vertices.  Of a shingle that a task has HEAVY times and more the
   bucket gets the count alone; the postings wait, a row a task, for the sum
   of the counts, so no task holds those of a very common shingle.
3. A vertex with a partner shares at least the threshold's part of its set:
   vertices with fewer shared shingles are done.  The others get their set in
   the global order, rare first, and its prefix: two similar sets share a
   shingle of their prefixes.
4. Vertices that share prefix shingles form blocks, by connected components;
   no similar pair lies across two.
5. In a block the sets are joined by a prefix tree (see trie.py).  A block of
   more than BLOCK sets is dealt out in chunks, each with a few vertices of the
   block as hubs; then what is still outside of the block's largest
   component asks all sets that it shares a prefix shingle with, or all
   chunks of the block, whichever has fewer pairs: either way the join is
   complete for blocks of any size and no task holds one.
6. Links give the components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, column_bytes, group_arrow, map_arrow, materialize, parts
from .components import components
from .hashing import SPACE_LOWER, U, Words, fold, mix
from .trie import ask, links, stars

#: Words of a shingle; similarity of 75 per 100 and more; sets that a task
#: joins at once; vertices, about, that all chunks of a large block hold.
WORDS, SIMILAR, BLOCK, HUBS = 5, (75, 100), 1500, 10
#: Pairs of a large block's rest with all its sets up to which it asks all
#: chunks without counting what it shares; either way gives the same links.
PAIRS = 50_000_000
#: Postings that a task gathers before it deals them out; vertices of a shingle
#: in them from which they are not sent to its bucket.
FLUSH, HEAVY = 1_500_000, 256
LOW48 = U((1 << 48) - 1)


def shingle_sets(texts: list[bytes], k: int = WORDS) -> list[np.ndarray]:
    """Sorted hashes of the distinct k-word shingles of each text; of a text
    of fewer words its whole sequence, of one without words nothing."""
    w = Words(texts, SPACE_LOWER)
    grams, out = fold(w.hash, k), []
    for s, e in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if e - s >= k:
            out.append(np.unique(grams[s : e - k + 1]))
        elif e > s:
            out.append(fold(w.hash[s:e], e - s))
        else:
            out.append(np.empty(0, U))
    return out


def _pack48(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpack48(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


PACKED = "kind int, bucket int, token long, a binary, b binary, c binary, d binary"
_FIELDS = ["kind", "bucket", "token", "a", "b", "c", "d"]
_TYPES = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES, strict=True)], _FIELDS)


def _name(token48, bucket: int, buckets: int):
    """A shingle's number: its 48 bits and its bucket."""
    return token48 * U(buckets) + U(bucket)


def _keys(df, names: np.ndarray) -> np.ndarray:
    """Keys in the global order: by frequency, then by hash; a key is also the
    identity."""
    return (np.minimum(df, 65535).astype(U) << U(48)) | (mix(names) & LOW48)


def postings(docs: DataFrame, buckets: int, key: str, text: str, k: int) -> DataFrame:
    """Packed rows: kind 0 documents (ids, vertices, sizes), kind 1 postings,
    kind 2 the vertices and sizes of a heavy shingle, dealt by task, kind 3
    the heavy shingles of a bucket and their counts."""

    def deal(ids, vertex, size, sets):
        vertex, size = np.array(vertex, U), np.array(size, np.int64)
        lot = int(mix(U([len(sets)]) + vertex[:1])[0] % U(buckets))
        yield 0, lot, None, np.array(ids, np.int64).tobytes(), vertex.tobytes(), size.tobytes(), None
        _, first = np.unique(vertex, return_index=True)  # a set once
        first = first[size[first] > 0]
        if not len(first):
            return
        tokens = np.concatenate([sets[i] for i in first])
        local = np.repeat(np.arange(len(first), dtype=np.uint16), size[first])
        bucket = (tokens % U(buckets)).astype(np.int32)
        tokens = (tokens // U(buckets)) & LOW48
        order = np.argsort(bucket.astype(U) << U(48) | tokens) if buckets <= 1 << 16 else np.lexsort((tokens, bucket))
        tokens, local, bucket = tokens[order], local[order], bucket[order]
        begin = np.flatnonzero(np.r_[True, (tokens[1:] != tokens[:-1]) | (bucket[1:] != bucket[:-1])])
        count = np.diff(np.r_[begin, len(tokens)])
        heavy = np.flatnonzero(count >= HEAVY)
        for i in heavy:
            own = first[local[begin[i] : begin[i] + count[i]]]
            name = _name(tokens[begin[i] : begin[i] + 1], int(bucket[begin[i]]), buckets).view(np.int64)
            yield 2, buckets + (lot + int(name[0] & 0xFFFF)) % buckets, int(name[0]), vertex[own].tobytes(), size[own].astype(np.uint32).tobytes(), None, None
        for g in np.unique(bucket[begin[heavy]]).tolist():
            mine = heavy[bucket[begin[heavy]] == g]
            yield 3, g, None, tokens[begin[mine]].tobytes(), count[mine].astype(np.int64).tobytes(), None, None
        light = np.repeat(count < HEAVY, count)
        tokens, local, bucket = tokens[light], local[light], bucket[light]
        bounds = np.searchsorted(bucket, np.arange(buckets + 1))
        for g in range(buckets):
            s, e = bounds[g], bounds[g + 1]
            if s < e:
                used, index = np.unique(local[s:e], return_inverse=True)
                yield 1, g, None, vertex[first[used]].tobytes(), size[first[used]].astype(np.uint32).tobytes(), _pack48(tokens[s:e]), index.astype(np.uint16).tobytes()

    def run(batches):
        held: tuple[list, list, list, list] = ([], [], [], [])
        total = 0
        for b in chunks(batches, text, 1 << 20):
            sets = shingle_sets(column_bytes(b.column(1)), k)
            for ident, s in zip(b.column(0).to_pylist(), sets, strict=True):
                for h, x in zip(held, (-(1 << 63) if ident is None else ident, xxhash.xxh3_64_intdigest(s.tobytes()), len(s), s), strict=True):
                    h.append(x)
                total += len(s)
                if total >= FLUSH or len(held[0]) >= 60_000:
                    yield _batch(list(deal(*held)))
                    held, total = ([], [], [], []), 0
        if held[0]:
            yield _batch(list(deal(*held)))

    return map_arrow(docs.select(F.col(key).cast("long"), text), run, PACKED)


def _by_vertex(key: np.ndarray, vertex: np.ndarray, size: np.ndarray, buckets: int) -> list[tuple]:
    """Postings packed by the vertices' buckets: (vertices, sizes), counts, keys."""
    home = (vertex % U(buckets)).astype(np.int64)
    order = np.lexsort((vertex, home))
    key, vertex, size, home = key[order], vertex[order], size[order], home[order]
    out, bounds = [], np.searchsorted(home, np.arange(buckets + 1))
    for g in range(buckets):
        s, e = bounds[g], bounds[g + 1]
        if s < e:
            v, first, count = np.unique(vertex[s:e], return_index=True, return_counts=True)
            out.append((1, g, None, v.tobytes(), size[s:e][first].astype(np.uint32).tobytes(), count.astype(np.uint32).tobytes(), key[s:e].tobytes()))
    return out


def _shared(bucket: int, buckets: int, rows: pa.Table) -> list[tuple]:
    """Of a bucket the postings of shingles that two vertices or more have, by
    vertex; and (kind 3) the frequencies of heavy shingles."""
    kinds = rows.column("kind").to_numpy()
    notes, rows = rows.filter(pa.array(kinds == 3)), rows.filter(pa.array(kinds == 1))
    told, n_told = (np.concatenate([np.empty(0, t), *(np.frombuffer(x, t) for x in notes.column(c).to_pylist())]) for c, t in (("a", U), ("b", np.int64)))
    told, index = np.unique(told, return_inverse=True)
    n_told = np.bincount(index, n_told, len(told)).astype(np.int64)
    tokens, vertex, size = [np.empty(0, U)], [np.empty(0, U)], [np.empty(0, np.uint32)]
    for a, b, c, d in zip(*(rows.column(x).to_pylist() for x in "abcd"), strict=True):
        local = np.frombuffer(d, np.uint16)
        tokens.append(_unpack48(c))
        vertex.append(np.frombuffer(a, U)[local])
        size.append(np.frombuffer(b, np.uint32)[local])
    tokens, vertex, size = map(np.concatenate, (tokens, vertex, size))
    order = np.argsort(tokens, kind="stable")
    s = tokens[order]
    same = s[1:] == s[:-1]
    more = np.isin(s, told) if len(told) else np.zeros(len(s), bool)
    more[1:] |= same
    more[:-1] |= same
    order = order[more]
    order = order[np.lexsort((vertex[order], tokens[order]))]
    tokens, vertex, size = tokens[order], vertex[order], size[order]
    keep = np.ones(len(tokens), bool)  # a set dealt by two tasks counts once
    keep[1:] = (tokens[1:] != tokens[:-1]) | (vertex[1:] != vertex[:-1])
    tokens, vertex, size = tokens[keep], vertex[keep], size[keep]
    each, count = np.unique(tokens, return_counts=True)
    df = count.copy()
    at = np.searchsorted(told, each)
    if len(told):
        known = told[np.minimum(at, len(told) - 1)] == each
        df[known] += n_told[at[known]]
        light = np.isin(told, each)
        n_told[light] += count[np.searchsorted(each, told[light])]
    df = np.repeat(df, count)
    ok = df > 1
    out = _by_vertex(_keys(df[ok], _name(tokens[ok], bucket, buckets)), vertex[ok], size[ok], buckets) if ok.any() else []
    return out + [(3, bucket, int(n), x.tobytes(), None, None, None) for n, x in zip(_name(told, bucket, buckets).view(np.int64), n_told, strict=True)]


def _heavy(packed: DataFrame, buckets: int) -> DataFrame:
    """The postings of heavy shingles by vertex, with their frequencies."""
    df = packed.filter("kind = 3").select("token", F.col("a").alias("df"))
    waiting = packed.filter("kind = 2").select("token", "a", "b").join(df, "token")

    def run(batches):
        for batch in batches:
            held: list[tuple] = []
            for i in range(batch.num_rows + 1):
                if held and (i == batch.num_rows or sum(len(x[1]) for x in held) >= FLUSH):
                    yield _batch(_by_vertex(*map(np.concatenate, zip(*held, strict=True)), buckets))
                    held = []
                if i < batch.num_rows:
                    token, a, b, n = (batch.column(k)[i].as_py() for k in range(4))
                    vertex = np.frombuffer(a, U)
                    key = _keys(np.frombuffer(n, np.int64), np.array([token], np.int64).view(U))
                    held.append((np.repeat(key, len(vertex)), vertex, np.frombuffer(b, np.uint32)))

    return map_arrow(waiting, run, PACKED)


def _least(size: np.ndarray | int, t: tuple[int, int]):
    """Elements that a set of a size shares with any similar one, at least."""
    return -(-t[0] * size // t[1])


def ordered_sets(packed: DataFrame, t: tuple[int, int]) -> DataFrame:
    """(v, n, keys, prefix) of the vertices that may have a partner."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        vertex, size, count, keys = [], [], [], []
        for a, b, c, d in zip(*(rows.column(x).to_pylist() for x in "abcd"), strict=True):
            count.append(np.frombuffer(c, np.uint32).astype(np.int64))
            vertex.append(np.frombuffer(a, U))
            size.append(np.frombuffer(b, np.uint32).astype(np.int64))
            keys.append(np.frombuffer(d, U))
        vertex, size, count, keys = map(np.concatenate, (vertex, size, count, keys))
        all_v, index = np.unique(vertex, return_inverse=True)
        n = np.zeros(len(all_v), np.int64)
        n[index] = size
        per = np.repeat(index, count)
        use = (np.bincount(per, minlength=len(all_v)) >= _least(n, t))[per]
        per, keys = per[use], keys[use]
        order = np.lexsort((keys, per))
        per, keys = per[order], keys[order]
        once = np.ones(len(per), bool)  # a heavy shingle of a set dealt by two tasks
        once[1:] = (per[1:] != per[:-1]) | (keys[1:] != keys[:-1])
        per, keys = per[once], keys[once]
        total = np.bincount(per, minlength=len(all_v))
        ok = (total >= _least(n, t)) & (total > 0)
        per, keys = per[ok[per]], keys[ok[per]]
        bounds = np.searchsorted(per, np.arange(len(all_v) + 1))
        at = np.flatnonzero(ok).tolist()
        sets = [keys[bounds[i] : bounds[i + 1]] for i in at]
        # Of the prefix of n - least + 1 the elements that no other has come
        # first; what is left of it is of shared ones.
        prefix = [x[: int(total[i] - _least(int(n[i]), t) + 1)].view(np.int64) for i, x in zip(at, sets, strict=True)]
        return pa.table({"v": pa.array(all_v[ok].view(np.int64)), "n": pa.array(n[ok]), "keys": pa.array([x.tobytes() for x in sets], pa.binary()), "prefix": pa.array(prefix, pa.list_(pa.int64()))})

    return group_arrow(packed, run, "v long, n long, keys binary, prefix array<long>")


def _join(groups: DataFrame, t: tuple[int, int]) -> DataFrame:
    """Links within each group of rows (block, x, y, v, n, keys, comp, query);
    comp and query are null in a first join."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        v, n, keys, comp, query = (rows.column(x).to_pylist() for x in ("v", "n", "keys", "comp", "query"))
        sets = [(ident, n[i], np.frombuffer(keys[i], U)) for i, ident in enumerate(v)]
        if comp and comp[0] is not None:
            parts_ = ([s for s, q in zip(sets, query, strict=True) if q is asks] for asks in (False, True))
            found = ask(*parts_, dict(zip(v, comp, strict=True)), t)
        else:
            found = stars(links(list({s[0]: s for s in sets}.values()), t))
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return groups.groupBy("block", "x", "y").applyInArrow(run, "a long, b long")


def similar_roots(sets: DataFrame, t: tuple[int, int]) -> DataFrame:
    """(u, root): the component of each set that is not its own root."""
    lot = sets.select("v", F.explode("prefix").alias("k"))
    first = lot.groupBy("k").agg(F.min("v").alias("m"), F.count("*").alias("c")).filter("c > 1").drop("c")
    edges = lot.join(first, "k").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    found = components(edges)
    block = found.unionByName(found.select(F.col("root").alias("u"), "root").distinct()).select(F.col("u").alias("v"), F.col("root").alias("block"))
    size = block.groupBy("block").agg(F.count("*").alias("size"))
    block = materialize(block.join(size, "block").withColumns({"k": F.ceil(F.col("size") / BLOCK).cast("int"), "chunk": F.pmod(F.xxhash64("v"), F.ceil(F.col("size") / BLOCK)).cast("int")}), "blocks")
    large = block.filter("k > 1")
    # Hubs are drawn by hash, a bounded number of them from each block.
    drawn = large.filter(F.pmod(F.xxhash64("v", F.lit(3)), F.col("k") * F.lit(max(1, BLOCK // HUBS))) == 0)
    hubs = drawn.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).select("block", "v", "x", F.lit(0).alias("y"))
    none = {"comp": F.lit(None).cast("long"), "query": F.lit(None).cast("boolean")}
    lots = block.select("block", "v", F.col("chunk").alias("x"), F.lit(0).alias("y")).unionByName(hubs)
    # The stars of a block that is one group are its components.
    one = materialize(_join(lots.join(sets.select("v", "n", "keys"), "v").withColumns(none), t), "links")
    if large.isEmpty():
        return one.select(F.col("a").alias("u"), F.col("b").alias("root"))
    # What a large block's largest component does not hold (the rest) asks.
    root = components(one)
    comp = large.join(root.withColumnRenamed("u", "v"), "v", "left").withColumn("comp", F.coalesce("root", "v")).drop("root")
    comp = materialize(comp, "comps")
    sizes = comp.groupBy("block", "comp").agg(F.count("*").alias("c"))
    main = sizes.groupBy("block").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"))
    comp = comp.join(main, "block").withColumn("rest", F.col("comp") != F.col("main")).select("block", "v", "comp", "rest")
    counts = comp.groupBy("block").agg(F.count("*").alias("n"), F.count_if("rest").alias("r")).filter("r > 0")
    by_chunk = F.col("n").cast("double") * F.col("r")
    most = counts.agg(F.max(by_chunk)).first()[0]
    if most is None:
        return root
    if most <= PAIRS:
        return components(one.unionByName(_asked(comp.join(counts, "block"), sets, t)))
    # A pair to be found shares a prefix shingle, so the rest can ask those
    # that share one with it, or all chunks of its block: whichever has fewer
    # pairs.  Copies share many shingles, a chain of unlike sets few.
    met = lot.join(comp, "v")
    shared = met.groupBy("block", "k").agg(F.count("*").alias("n"), F.count_if("rest").alias("r")).filter("r > 0 AND n > 1")
    by_key = shared.groupBy("block").agg(F.sum(F.col("n").cast("double") * F.col("r")).alias("pairs"))
    way = materialize(counts.join(by_key, "block", "left").withColumn("keys", F.coalesce(F.col("pairs") < by_chunk, F.lit(False))).select("block", "keys", "n", "r"), "ways")
    few = comp.join(way.filter("NOT keys"), "block").select("v", "comp", "rest", F.col("block"), "n", "r")
    many = met.join(way.filter("keys").select("block"), "block", "left_semi").join(shared, ["block", "k"]).select("v", "comp", "rest", F.col("k").alias("block"), "n", "r")
    return components(one.unionByName(_asked(few, sets, t)).unionByName(_asked(many, sets, t)))


def _asked(members: DataFrame, sets: DataFrame, t: tuple[int, int]) -> DataFrame:
    """Links from the rest of each block to all its members (v, comp, rest,
    block, n, r: members and rest of the block), in chunks of BLOCK of either."""
    lots = {"x": F.ceil(F.col("n") / BLOCK), "y": F.ceil(F.col("r") / BLOCK)}
    every = lambda c: F.explode(F.sequence(F.lit(0), lots[c].cast("int") - 1)).alias(c)
    own = lambda c, seed: F.pmod(F.xxhash64("v", F.lit(seed)), lots[c].cast("bigint")).cast("int").alias(c)
    asked = members.select("block", own("x", 4), every("y"), "v", "comp", F.lit(False).alias("query"))
    asking = members.filter("rest").select("block", every("x"), own("y", 5), "v", "comp", F.lit(True).alias("query"))
    return _join(asked.unionByName(asking).join(sets.select("v", "n", "keys"), "v"), t)


def join_similar(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = WORDS, t: tuple[int, int] = SIMILAR) -> DataFrame:
    """(key, n_shingles, component_id) for each row of docs.

    key is an integer column.  component_id is the smallest key reachable by
    links.  A null, empty or wordless text has no shingles and is linked with
    nothing; equal rows and equal sets are linked; an empty table gives an
    empty one; a row without key takes part and gets its component's id; other
    columns of docs are not read.
    """
    spark = docs.sparkSession
    buckets = parts(spark)
    dealt = postings(docs, buckets, key, text, k)

    def bucket(key: tuple, rows: pa.Table) -> pa.Table:
        kinds = rows.column("kind").to_numpy()
        # Documents and heavy shingles' postings pass.
        out = [rows.filter(pa.array((kinds == 0) | (kinds == 2))).select(_FIELDS)]
        if ((kinds == 1) | (kinds == 3)).any():
            out.append(pa.Table.from_batches([_batch(_shared(key[0].as_py(), buckets, rows))]))
        return pa.concat_tables(out)

    packed = materialize(group_arrow(dealt, bucket, PACKED), "shared")

    def unpack(batches):
        for b in batches:
            for ids, v, n in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                ids = np.frombuffer(ids, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids, mask=ids == -(1 << 63)), pa.array(np.frombuffer(v, np.int64)), pa.array(np.frombuffer(n, np.int64))], [key, "v", "n_shingles"])

    rows = map_arrow(packed.filter("kind = 0").select("a", "b", "c"), unpack, f"{key} long, v long, n_shingles long")
    shared = packed.filter("kind = 1").unionByName(_heavy(packed, buckets))
    sets = materialize(ordered_sets(shared, t), "sets")
    root = similar_roots(sets, t)
    rows = rows.join(root.withColumnRenamed("u", "v"), "v", "left").withColumn("_c", F.when(F.col("n_shingles") > 0, F.coalesce("root", "v"))).drop("root", "v")
    least = rows.filter("_c IS NOT NULL").groupBy("_c").agg(F.min(key).alias("_m"))
    kind = docs.schema[key].dataType
    return rows.join(least, "_c", "left").select(F.col(key).cast(kind), "n_shingles", F.coalesce("_m", key).cast(kind).alias("component_id"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_similar(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, hash(array_to_string(ws[i:i + 4], ' ')) AS g FROM w, unnest(range(1, greatest(2, len(ws) - 3))) AS r(i) WHERE len(ws) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s AS x JOIN s AS y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT a, b FROM p JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.c AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) AS r ON r.a = w.doc_id
"""
