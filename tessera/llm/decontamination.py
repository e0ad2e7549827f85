"""Benchmark decontamination by winnowing.

Of every window of W consecutive K-word grams the smallest hash is kept, on
documents and on benchmark items alike.  A span of K + W - 1 words that both
have therefore shares a kept gram, chosen at the same place in the span.  Kept
grams are joined by their hash and each match is extended word by word, so a
hit is never a matter of hashes alone.  Items that are shorter than a window
are looked up by the first words of their whole sequence at every position.

The join is a shuffle of what a bitmap of bounded size lets pass; no
fingerprints are sent to the driver.  It joins each different context of a gram
in the documents with each different one in the items, once: a stem that many
items share, in a text that many documents hold, is extended once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, column_bytes, map_arrow, materialize
from .hashing import ALNUM_LOWER, U, Words, fold

#: Words of a gram, grams of a window, and words of a window.
K, W = 5, 6
SPAN = K + W - 1
LEAST, MOST = 1 << 22, 1 << 28


def winnow(h: np.ndarray, w: int = W) -> np.ndarray:
    """Positions of the rightmost smallest hash of each window of w hashes."""
    n = len(h) - w + 1
    if n <= 0:
        return np.empty(0, np.int64)
    best = np.arange(n) + w - 1
    low = h[best]
    for d in range(w - 2, -1, -1):
        at = np.arange(n) + d
        less = h[at] < low
        best = np.where(less, at, best)
        low = np.where(less, h[at], low)
    return best


def _grams(words: Words, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of what can match: kind 0 the winnowed grams, kind k
    all k-grams.  Grams and windows lie within one text."""
    n = np.diff(words.first)
    text = np.repeat(np.arange(len(n)), n)
    k = K if kind == 0 else kind
    h = fold(words.hash, k)
    if not len(h):
        return np.empty(0, np.int64), h
    whole = text[: len(h)] == text[k - 1 : k - 1 + len(h)]
    if kind:
        at = np.flatnonzero(whole)
        return at, h[at]
    best = winnow(h)
    at = np.unique(best[text[: len(best)] == text[SPAN - 1 : SPAN - 1 + len(best)]])
    return at, h[at]


def _context(words: Words, at: int, text: int, before: int, after: int) -> tuple[str, str]:
    lo, hi = max(words.first[text], at - before), min(words.first[text + 1], at + after)
    one = lambda a, b: b" ".join(words.raw[words.starts[i] : words.ends[i]] for i in range(a, b)).decode()
    return one(lo, at), one(at, hi)


def _bit(h: np.ndarray, kind: int, bits: int) -> np.ndarray:
    return ((h + U(kind)) % U(bits)).astype(np.int64)


def item_classes(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(key, words, n): the word sequence of each item that has words.  Items
    of one sequence are one class, matched once."""
    kind = items.schema[key].dataType.simpleString()

    def run(batches):
        for b in chunks(batches, text, 1 << 20):
            w = Words(column_bytes(b.column(1)), ALNUM_LOWER, hashes=False)
            seq = [_context(w, w.first[t], t, 0, 1 << 60)[1] if w.first[t] < w.first[t + 1] else "" for t in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(seq), pa.array(np.diff(w.first), pa.int64())], [key, "words", "n"])

    return map_arrow(items.select(key, text), run, f"{key} {kind}, words string, n long").filter("n > 0")


def item_grams(classes: DataFrame) -> DataFrame:
    """(kind, h, class, before, after) of distinct word sequences."""

    def run(batches):
        for b in batches:
            rows = []
            for cls, seq, n in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                w = Words([seq.encode()], ALNUM_LOWER)
                kind = 0 if n >= SPAN else min(n, K)
                at, h = _grams(w, kind)
                for p, x in zip(at[: 1 if kind else None].tolist(), h.view(np.int64).tolist(), strict=False):
                    rows.append((kind, x, cls, *_context(w, p, 0, SPAN - K, SPAN)))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["kind", "h", "class", "before", "after"])

    return map_arrow(classes.select("class", "words", "n"), run, "kind int, h long, class string, before string, after string").distinct()


def _bitmap(grams: DataFrame) -> tuple[bytes, int, list[int]]:
    """Bits of the grams' hashes, their number and the kinds there are.

    16 bits a gram and more, from LEAST to MOST bits (32 MB), which are built
    by the executors in pieces of 4 KB; beyond two million grams more of the
    documents' grams pass by chance and meet none in the join."""
    n = grams.count()
    bits = min(MOST, max(LEAST, 1 << (16 * n).bit_length()))
    bit = F.pmod(F.col("h") + F.col("kind"), F.lit(bits)) + 1  # as _bit: bits is a power of two
    pieces = grams.groupBy(F.bitmap_bucket_number(bit).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("m"), F.collect_set("kind").alias("kinds")).collect()
    out, kinds = bytearray(bits // 8), set()
    for r in pieces:
        out[(r.b - 1) * 4096 : r.b * 4096] = r.m
        kinds.update(r.kinds)
    return bytes(out), bits, sorted(kinds)


CAND = "array<struct<kind: int, h: long, p: long, before: string, after: string>>"


def candidates(docs: DataFrame, bitmap: bytes, size: int, kinds: list[int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, cand): of each document the grams that may match."""
    kind_of_key = docs.schema[key].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)
    struct = pa.struct([("kind", pa.int32()), ("h", pa.int64()), ("p", pa.int64()), ("before", pa.string()), ("after", pa.string())])

    def run(batches):
        bits = np.frombuffer(sent.value, np.uint8)
        for b in chunks(batches, text, 1 << 20):
            w = Words(column_bytes(b.column(1)), ALNUM_LOWER)
            cand: list[list] = [[] for _ in range(b.num_rows)]
            for kind in kinds:
                at, h = _grams(w, kind)
                bit = _bit(h, kind, size)
                ok = (bits[bit >> 3] >> (bit & 7) & 1).astype(bool)
                at, h = at[ok], h[ok]
                t = np.searchsorted(w.first, at, side="right") - 1
                for p, x, d in zip(at.tolist(), h.view(np.int64).tolist(), t.tolist(), strict=True):
                    before, after = _context(w, p, d, SPAN - K if kind == 0 else 0, SPAN)
                    cand[d].append((kind, x, p - int(w.first[d]), before, after))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(w.first), pa.int64()), pa.array([[dict(zip(struct.names, c, strict=True)) for c in x] for x in cand], pa.list_(struct))], [key, "n_words", "cand"])

    return map_arrow(docs.select(key, text), run, f"{key} {kind_of_key}, n_words long, cand {CAND}")


def _extend(pairs: DataFrame) -> DataFrame:
    """pairs of contexts with left and right, the words that both have before
    and from the gram on: SPAN or more together, or all of a shorter item."""
    cols = ("kind", "h", "before", "after", "ibefore", "iafter")

    def run(batches):
        for b in batches:
            out = []
            for kind, h, db, da, ib, ia in zip(*(b.column(i).to_pylist() for i in range(len(cols))), strict=True):
                d, i = da.split(" "), ia.split(" ")
                if kind:
                    if d[: len(i)] == i:
                        out.append((kind, h, db, da, ib, ia, 0, len(i)))
                    continue
                right = next((k for k, (x, y) in enumerate(zip(d, i, strict=False)) if x != y), min(len(d), len(i)))
                d, i = (db.split(" ") if db else [])[::-1], (ib.split(" ") if ib else [])[::-1]
                left = next((k for k, (x, y) in enumerate(zip(d, i, strict=False)) if x != y), min(len(d), len(i)))
                if left + right >= SPAN:
                    out.append((kind, h, db, da, ib, ia, left, right))
            got = list(zip(*out, strict=True)) or [()] * 8
            kinds = (pa.int32(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(got, kinds, strict=True)], [*cols, "left", "right"])

    return map_arrow(pairs.select(*cols), run, "kind int, h long, before string, after string, ibefore string, iafter string, left long, right long")


def find(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, hits, classes): rows (_row, key, n_words), one for each row of
    docs; hits (_row, class, s, e), word spans; classes (item_key, class).

    A null or wordless text has no words and no hits; equal documents are hit
    each for itself; equal items are one class; empty tables give no hits.
    Other columns of either table are not read.
    """
    cls = materialize(item_classes(items, item_key).withColumn("class", F.sha2("words", 256)), "item-classes")
    grams = materialize(item_grams(cls.select("class", "words", "n").distinct()), "item-grams")
    rows = materialize(candidates(docs, *_bitmap(grams), key, text).withColumn("_row", F.monotonically_increasing_id()), "candidates")
    cand = rows.select("_row", F.explode("cand").alias("c")).select("_row", "c.*")
    theirs = grams.withColumnsRenamed({"before": "ibefore", "after": "iafter"})
    ours, gram, items_ = ["kind", "h", "before", "after"], ["kind", "h"], ["kind", "h", "ibefore", "iafter"]
    alike = materialize(_extend(cand.select(*ours).distinct().join(theirs.select(*items_).distinct(), gram)), "extended")
    hits = cand.join(alike, ours).join(theirs, items_).select("_row", "class", (F.col("p") - F.col("left")).alias("s"), (F.col("p") + F.col("right")).alias("e"))
    return rows.select("_row", key, "n_words"), hits, cls.select(item_key, "class")


def covered(spans: str = "spans") -> F.Column:
    """Words in the union of an array of struct(s, e)."""
    step = F.aggregate(
        F.array_sort(spans), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], a["end"]))).cast("long").alias("n"), F.greatest(a["end"], x["e"]).alias("end")),
        lambda a: a["n"],
    )
    return step


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id") -> DataFrame:
    """A row for each document: key, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows, hits, classes = find(docs, items, key, text, item_key)
    hits = materialize(hits, "hits")
    words = hits.groupBy("_row").agg(F.collect_set(F.struct("s", "e")).alias("spans")).select("_row", covered().alias("n_hit"))
    names = (
        hits.select("_row", "class").distinct().join(classes, "class").select("_row", F.col(item_key).cast("string").alias("i"))
        .groupBy("_row").agg(F.array_sort(F.collect_list("i")).alias("items"))
    )
    zero = F.lit(0).cast("long")
    return rows.join(words, "_row", "left").join(names, "_row", "left").select(
        key, "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce(F.size("items").cast("long"), zero).alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", F.array().cast("array<string>")), ","), 256).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(ws)) AS k, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS g FROM b, unnest(range(1, greatest(2, len(ws) - 8))) AS r(i) WHERE len(ws) > 0),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS g FROM d, ks, unnest(range(1, len(ws) - k + 2)) AS r(i)),
hit AS (SELECT doc_id, i, dw.k AS k, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.g = bw.g),
pos AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM hit)) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s FROM hit GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(pos.n, 0)::BIGINT AS n_hit, coalesce(its.n, 0)::BIGINT AS n_items,
  sha256(coalesce(its.s, '')) AS items_sha256, coalesce(pos.n, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
