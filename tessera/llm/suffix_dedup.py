"""Suffix-array dedup: remove bytes under strings that the corpus repeats.

A string of SPAN bytes counts as repeated if it starts at another place too.
Not every suffix is sorted with every other: of each window of SPAN bytes the
smallest hash of its GRAM-byte strings is its anchor, so equal windows have
equal anchors at equal distances, and only suffixes with a common anchor can
be neighbours.

1. Tasks deal the anchors (one in about 69 bytes) as packed postings.
2. A bucket keeps the anchors that occur twice or more; they go back to their
   texts.  An anchor that a task has LOCAL times goes back from there, and one
   posting of it tells the bucket.  Copies of a whole text are one text.
3. The texts give the bytes round these anchors, dealt by anchor.  A task first
   settles what it can: equal contexts are one, and of an anchor with LOCAL
   contexts the suffixes are sorted there and then (see suffix_sort.py), so
   that a window that a task has many times leaves it once.
4. Within an anchor the suffixes are sorted; equal neighbours, by their bytes,
   are repeated windows.  An anchor that still has more than GROUP contexts is
   dealt anew by ranges of 16 distances and the bytes that all windows of a
   range share, and what has more than GROUP contexts even then by single
   windows, of which each task sends one.  All levels run the same sort.
5. Spans are gathered by text and cut out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, column_bytes, group_arrow, map_arrow, materialize, parts, text_hashes
from .hashing import U, mix, prefix, spans
from .suffix_sort import runs, twins

#: Bytes of a string that counts, and of an anchor; contexts of an anchor that
#: one task sorts; anchors that a task gathers before it deals them out;
#: bytes of contexts that are sorted at once.
SPAN, GRAM, GROUP, FLUSH, SORTED = 200, 64, 2000, 500_000, 1 << 20
#: Places of an anchor that a task settles by itself, and the contexts and
#: their bytes that it gathers for that.
LOCAL, HELD, HELD_BYTES = 24, 40_000, 12 << 20
#: Distances in a range of a hot anchor, level by level.
CHUNKS = (16, 1)
LOW32 = U((1 << 32) - 1)


def anchors(texts: list[bytes], span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, place, low, high, hash): anchors of the windows of the texts;
    the windows begin high to low bytes before the anchor's place."""
    raw = b"".join(texts)
    w = span - gram + 1
    empty = np.empty(0, np.int64)
    if len(raw) < span:
        return empty, empty, empty, empty, empty.astype(U)
    p = prefix(np.frombuffer(raw, np.uint8))
    n = len(raw) - gram + 1
    at = np.arange(n)
    # Rightmost smallest hash of each w grams: minima of blocks of w, from
    # both sides.  The place is in the low bits, counted down.
    key = (spans(p, at, at + gram) & ~LOW32) | (LOW32 - at.astype(U))
    blocks = -(-n // w)
    padded = np.full(blocks * w, ~U(0), U)
    padded[:n] = key
    padded = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(padded, axis=1).reshape(-1)
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    best = np.minimum(behind[: n - w + 1], ahead[w - 1 : n])
    place = (LOW32 - (best & LOW32)).astype(np.int64)
    begin = np.cumsum([0, *map(len, texts)])
    text = np.repeat(np.arange(len(texts)), np.diff(begin))[: len(place)]
    ok = np.flatnonzero(np.arange(len(place)) + span <= begin[text + 1])
    if not len(ok):
        return empty, empty, empty, empty, empty.astype(U)
    place, text = place[ok], text[ok]
    new = np.ones(len(ok), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(ok)] - 1
    a = place[first]
    return text[first], a - begin[text[first]], a - ok[last], a - ok[first], spans(p, a, a + gram)


PACKED = "kind int, bucket int, a binary, b binary, c binary, d binary"
_TYPES = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
_FIELDS = ["kind", "bucket", "a", "b", "c", "d"]
PLACE = np.dtype([("place", "<u4"), ("low", "u1"), ("high", "u1")])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES, strict=True)], _FIELDS)


def _pack(kind: int, home: np.ndarray, buckets: int, *cols: np.ndarray) -> list[tuple]:
    """Rows of columns as bytes, one for each bucket in home."""
    order = np.argsort(home, kind="stable")
    bounds = np.searchsorted(home[order], np.arange(buckets + 1))
    cols = [c[order] for c in cols]
    return [(kind, g, *(c[bounds[g] : bounds[g + 1]].tobytes() for c in cols), *[None] * (4 - len(cols))) for g in range(buckets) if bounds[g] < bounds[g + 1]]


def postings(docs: DataFrame, buckets: int) -> DataFrame:
    """Packed anchors of docs (text, _v): kind 1 (hash, text, place) by hash;
    kind 2 the same by text, of anchors that the task has often."""

    def run(batches):
        held: list[tuple[np.ndarray, ...]] = []
        seen: set[int] = set()
        total = 0

        def deal():
            h, v, where = (np.concatenate(c) for c in zip(*held, strict=True))
            _, index, count = np.unique(h, return_inverse=True, return_counts=True)
            often = count[index] >= LOCAL
            told = ~often
            told[np.unique(np.where(often, index, -1), return_index=True)[1]] = True  # one of each
            rows = _pack(1, (h[told] % U(buckets)).astype(np.int64), buckets, h[told], v[told], where[told])
            return _batch(rows + _pack(2, (mix(v[often].view(U)) % U(buckets)).astype(np.int64), buckets, h[often], v[often], where[often]))

        for b in chunks(batches, "text", 1 << 20):
            new = [(x, v) for x, v in zip(column_bytes(b.column(0)), b.column(1).to_pylist(), strict=True) if len(x) >= SPAN and not (v in seen or seen.add(v))]
            if not new:
                continue
            text, place, low, high, h = anchors([x for x, _ in new])
            where = np.empty(len(h), PLACE)
            where["place"], where["low"], where["high"] = place, low, high
            held.append((h, np.array([v for _, v in new], np.int64)[text], where))
            total += len(h)
            if total >= FLUSH:
                yield deal()
                held.clear()
                seen.clear()
                total = 0
        if total:
            yield deal()

    return map_arrow(docs.select("text", "_v"), run, PACKED)


def _unpacked(rows: pa.Table) -> tuple[np.ndarray, ...]:
    return tuple(np.concatenate([np.frombuffer(x, t) for x in rows.column(c).to_pylist()] or [np.empty(0, t)]) for c, t in zip("abc", (U, np.int64, PLACE), strict=True))


def _twice(buckets: int, rows: pa.Table) -> pa.Table:
    """Of a bucket the anchors with two places or more, packed by text."""
    kind = rows.column("kind").to_numpy()
    known = rows.filter(pa.array(kind == 2))
    h, v, where = _unpacked(rows.filter(pa.array(kind == 1)))
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    more = np.zeros(len(s), bool)
    more[1:] |= same
    more[:-1] |= same
    order = order[more]
    order = order[np.lexsort((where["place"][order], v[order], h[order]))]
    h, v, where = h[order], v[order], where[order]
    keep = np.ones(len(h), bool)  # a text dealt by two tasks counts once
    keep[1:] = (h[1:] != h[:-1]) | (v[1:] != v[:-1]) | (where["place"][1:] != where["place"][:-1])
    h, v, where = h[keep], v[keep], where[keep]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.empty(0, np.int64)
    count = np.diff(np.r_[first, len(h)])
    ok = np.repeat(count, count) > 1
    h, v, where = h[ok], v[ok], where[ok]
    out = [_batch(_pack(2, (mix(v.view(U)) % U(buckets)).astype(np.int64), buckets, h, v, where))]
    return pa.Table.from_batches([*out, *(b for b in known.select(_FIELDS).to_batches())], out[0].schema)


def _by_text(rows: pa.Table) -> pa.Table:
    """(_v, anchors): the repeated anchors of each text, packed."""
    h, v, where = _unpacked(rows)
    order = np.lexsort((where["place"], v))
    h, v, where = h[order], v[order], where[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (v[1:] != v[:-1]) | (where["place"][1:] != where["place"][:-1])
    h, v, where = h[keep], v[keep], where[keep]
    texts, first = np.unique(v, return_index=True)
    bounds = [*first.tolist(), len(v)]
    out = [(h[s:e].tobytes(), where[s:e].tobytes()) for s, e in zip(bounds, bounds[1:], strict=False)]
    cols = list(zip(*out, strict=True)) or [()] * 2
    return pa.table({"_v": pa.array(texts), **{n: pa.array(c, pa.binary()) for n, c in zip(("h", "places"), cols, strict=True)}})


class Contexts:
    """Columns of contexts: the bytes round an anchor h of text v, which hold
    the windows that begin high to low bytes before the anchor; the first
    begins at base.  done: evidence only, whose own spans are known."""

    NAMES = ("h", "_v", "base", "low", "high", "done", "bytes")

    def __init__(self, h, v, base, low, high, done, data) -> None:
        self.h, self.v, self.base, self.low, self.high = (np.asarray(x, np.int64) for x in (h, v, base, low, high))
        self.done, self.data = np.asarray(done, bool), data

    @classmethod
    def of(cls, rows) -> Contexts:
        return cls(*(rows.column(c).to_numpy(zero_copy_only=False) if isinstance(rows, pa.RecordBatch) else rows.column(c).to_numpy() for c in cls.NAMES[:-1]), rows.column("bytes").to_pylist())

    def settle(self, least: int, evidence: bool):
        """(v, s, e) of the spans that stand elsewhere too, as far as these
        contexts tell; and the evidence for other tasks: contexts that hold
        each different window once.  Anchors with fewer than `least` different
        contexts are not sorted."""
        known: dict[tuple, int] = {}
        cls = np.array([known.setdefault(x, len(known)) for x in zip(self.h.tolist(), self.low.tolist(), self.high.tolist(), self.data, strict=True)], np.int64)
        count = np.bincount(cls)
        done = count > 1
        done[cls[self.done]] = True
        own = np.flatnonzero(done[cls] & ~self.done)
        out = [(self.v[own], self.base[own], self.base[own] + self.high[own] - self.low[own] + SPAN)]
        rep = np.unique(cls, return_index=True)[1]  # a row of each class
        rep = rep[np.argsort(self.h[rep], kind="stable")]
        h = self.h[rep]
        bounds = np.flatnonzero(np.r_[True, h[1:] != h[:-1], True]) if len(h) else np.zeros(1, np.int64)
        sizes = np.repeat(np.diff(bounds), np.diff(bounds))
        todo, plain = rep[sizes >= least], rep[sizes < least]
        made = []  # (rows, low, high, done) of evidence
        if evidence:
            made.append((plain, self.low[plain], self.high[plain], done[cls[plain]]))
        for at in self._lots(todo):
            offset = np.cumsum([0, *(len(self.data[i]) for i in at)])[:-1]
            group = np.cumsum(np.r_[0, self.h[at][1:] != self.h[at][:-1]])
            row, dist, twice, first = twins(b"".join(self.data[i] for i in at), offset, group, self.low[at], self.high[at], SPAN)
            full = done[cls[at]]
            hit = np.flatnonzero(twice & ~full[row])
            near, far = runs(row[hit], dist[hit])
            r = at[row[hit[near]]]
            begin, end = dist[hit[far]], dist[hit[near]]
            out.append((self.v[r], self.base[r] + self.high[r] - begin, self.base[r] + self.high[r] - end + SPAN))
            if evidence:
                hit = np.flatnonzero(first)
                settled = (twice | full[row])[hit]
                near, far = runs(row[hit], settled.astype(np.int64), dist[hit])
                made.append((at[row[hit[near]]], dist[hit[near]], dist[hit[far]], settled[near]))
        found = tuple(np.concatenate(x) for x in zip(*out, strict=True))
        if not evidence:
            return found, None
        i, low, high, done = (np.concatenate(x) for x in zip(*made, strict=True))
        skip = self.high[i] - high
        data = [self.data[k][s : s + n] for k, s, n in zip(i.tolist(), skip.tolist(), (high - low + SPAN).tolist(), strict=True)]
        return found, Contexts(self.h[i], np.where(done, 0, self.v[i]), np.where(done, 0, self.base[i] + skip), low, high, done, data)

    def _lots(self, rows: np.ndarray):
        """Rows in lots of whole anchors, of about SORTED bytes."""
        size, begin = 0, 0
        h = self.h[rows]
        ends = np.flatnonzero(np.r_[h[1:] != h[:-1], True]) + 1 if len(rows) else []
        at = 0
        for end in map(int, ends):
            more = sum(len(self.data[i]) for i in rows[at:end])
            if size and size + more > SORTED:
                yield rows[begin:at]
                size, begin = 0, at
            size, at = size + more, end
        if begin < len(rows):
            yield rows[begin:]

    def batch(self, buckets: int, found: tuple) -> pa.RecordBatch:
        """Rows of a table: kind 0 the spans found, kind 1 the contexts."""
        v, s, e = found
        n, m = len(v), len(self.h)
        none = np.zeros(n, np.int64)
        kind = np.repeat([0, 1], [n, m]).astype(np.int8)
        bucket = np.concatenate([none, (self.h.view(U) % U(buckets)).astype(np.int64)]).astype(np.int32)
        cols = [kind, bucket, *(np.concatenate(x) for x in ((none, self.h), (v, self.v), (s, self.base), (e, np.zeros(m, np.int64)), (none, self.low), (none, self.high)))]
        done = np.concatenate([np.zeros(n, bool), self.done])
        types = [pa.int8(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(cols, types, strict=True)), pa.array(done), pa.array([*[None] * n, *self.data], pa.binary())], ["kind", "bucket", "h", "_v", "base", "end", "low", "high", "done", "bytes"])


_CONTEXT = "kind byte, bucket int, h long, _v long, base long, end long, low int, high int, done boolean, bytes binary"


def _settled(gathered, buckets: int, local: int, most: int):
    """Batches of lots of context tuples, each settled as far as it goes."""
    held, size = [], 0

    def emit():
        found, rest = Contexts(*zip(*held, strict=True)).settle(local, True)
        return rest.batch(buckets, found)

    for x in gathered:
        held.append(x)
        size += len(x[6])
        if len(held) >= most or size >= HELD_BYTES:
            yield emit()
            held, size = [], 0
    if held:
        yield emit()


def contexts(texts: DataFrame, buckets: int) -> DataFrame:
    """Of texts (text, _v, h, places) the contexts of repeated anchors."""

    def of(batches):
        for b in chunks(batches, "text", 1 << 20):
            for raw, v, h, places in zip(column_bytes(b.column(0)), *(b.column(i).to_pylist() for i in range(1, 4)), strict=True):
                for x, (place, low, high) in zip(np.frombuffer(h, np.int64).tolist(), np.frombuffer(places, PLACE).tolist(), strict=True):
                    yield x, v, place - high, low, high, False, raw[place - high : place - low + SPAN]

    return map_arrow(texts.select("text", "_v", "h", "places"), lambda batches: _settled(of(batches), buckets, LOCAL, HELD), _CONTEXT)


def ranges(hot: DataFrame, buckets: int, chunk: int) -> DataFrame:
    """Contexts dealt anew, by ranges of `chunk` distances and a hash of the
    bytes that all windows of the range share, in this text or another."""

    def of(batches):
        for b in batches:
            c = Contexts.of(b)
            for h, v, base, low, high, done, data in zip(c.h.tolist(), c.v.tolist(), c.base.tolist(), c.low.tolist(), c.high.tolist(), c.done.tolist(), c.data, strict=True):
                for k in range(low // chunk, high // chunk + 1):
                    first, last = k * chunk, k * chunk + chunk - 1
                    near, far = max(low, first), min(high, last)
                    core = data[high - first : high - last + SPAN]
                    x = xxhash.xxh3_64_intdigest(core, (h + k) & ((1 << 64) - 1))
                    yield x - (x >> 63 << 64), v, base + high - far, near, far, done, data[high - far : high - near + SPAN]

    return map_arrow(hot.select("h", "_v", "base", "low", "high", "done", "bytes"), lambda batches: _settled(of(batches), buckets, LOCAL, HELD), _CONTEXT)


def _written(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Spans found and contexts left of the rows of a level, written."""
    rows = materialize(rows, name)
    return rows.filter("kind = 0").select("_v", F.col("base").alias("s"), F.col("end").alias("e")), rows.filter("kind = 1")


def repeated_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For docs (text, _v, _w, _id): (_v, s, e), spans of repeated bytes in texts;
    (_v, _w), the texts they are of; and (_v, _w, copies), texts and their rows.  _v and _w are
    two hashes of the text; if texts with one _v differ in _w, the spans are
    those of one of them."""
    buckets = parts(docs.sparkSession)
    # One row of each text: the one with the smallest id.
    copies = docs.filter(F.octet_length("text") >= SPAN).groupBy("_v", "_w").agg(F.count("*").alias("copies"), F.min("_id").alias("_id"))
    copies = materialize(copies, "copies")
    twice = group_arrow(postings(docs, buckets), lambda k, t: _twice(buckets, t), PACKED)
    texts = group_arrow(twice, lambda k, t: _by_text(t), "_v long, h binary, places binary")
    one = copies.groupBy("_v").agg(F.min(F.struct("_w", "_id")).alias("_one")).select("_v", "_one.*")
    rows = docs.select("text", "_v", "_w", "_id").join(texts.join(one, "_v"), ["_v", "_w", "_id"])
    found, left = _written(contexts(rows, buckets), "contexts")
    found, sorted_ = [found], []
    for chunk in CHUNKS:
        large = materialize(left.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > GROUP).select("h"), "large")
        if large.isEmpty():
            break
        sorted_.append(left.join(large, "h", "left_anti"))
        more, left = _written(ranges(left.join(large, "h", "left_semi"), buckets, chunk), "ranges")
        found.append(more)

    def sort(key, rows: pa.Table) -> pa.Table:
        (v, s, e), _ = Contexts.of(rows).settle(2, False)
        return pa.table({"_v": pa.array(v, pa.int64()), "s": pa.array(s, pa.int64()), "e": pa.array(e, pa.int64())})

    lots = left
    for x in sorted_:
        lots = lots.unionByName(x)
    out = group_arrow(lots.select("bucket", *Contexts.NAMES), sort, "_v long, s long, e long")
    for x in found:
        out = out.unionByName(x)
    return out, one.select("_v", "_w"), copies.select("_v", "_w", "copies")


def _union(spans_: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans_):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


SPANS = "array<struct<s: long, e: long>>"


def _merged(per: DataFrame) -> DataFrame:
    """per (_v, spans) with overlapping and touching spans made one."""
    kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))

    def run(batches):
        for b in batches:
            out = [[{"s": s, "e": e} for s, e in _union([(x["s"], x["e"]) for x in spans_])] for spans_ in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, kind)], ["_v", "spans"])

    return map_arrow(per, run, f"_v long, spans {SPANS}")


def mark_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with `spans`, the maximal runs [s, e) of repeated bytes of each text.

    A null text is an empty one.  Texts under SPAN bytes have no spans; a text
    that several rows have is repeated as a whole; an empty table gives an
    empty one; a column of docs named spans is replaced, any other name may
    occur.
    """
    docs = docs.drop("spans")
    raw = F.coalesce(F.col(text), F.lit(""))
    hashes = dict(zip(("_v", "_w"), text_hashes(raw), strict=True))
    # The smallest number of a hash of the other columns tells copies apart.
    plain = docs.select(raw.alias("text"), *(h.alias(n) for n, h in hashes.items()), F.xxhash64(*(c for c in docs.columns if c != text), F.lit(0)).alias("_id"))
    found, one, copies = repeated_spans(plain)
    per = _merged(found.groupBy("_v").agg(F.collect_set(F.struct("s", "e")).alias("spans"))).join(one, "_v")
    info = copies.filter("copies > 1").join(per, ["_v", "_w"], "full").select("_v", "_w", F.col("copies").isNotNull().alias("_copied"), F.col("spans").alias("_found"))
    packed = docs.select(F.struct("*").alias("_row"), *(h.alias(n) for n, h in hashes.items()), F.octet_length(raw).cast("long").alias("_n"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("s"), F.col("_n").alias("e")))
    spans_ = F.when(F.col("_copied"), whole).otherwise(F.coalesce("_found", F.array().cast(SPANS)))
    return packed.join(info, ["_v", "_w"], "left").select("_row.*", spans_.alias("spans"))


def cut(raw: bytes, spans_: list[dict]) -> bytes:
    """raw without its spans."""
    keep, at = [], 0
    for x in spans_:
        keep.append(raw[at : x["s"]])
        at = x["e"]
    return b"".join([*keep, raw[at:]])


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")

    def run(batches):
        for b in chunks(batches, "text", 1 << 20):
            rows = []
            for raw, sp in zip(column_bytes(b.column(1)), b.column(2).to_pylist(), strict=True):
                kept = cut(raw, sp)
                rows.append((len(raw), len(raw) - len(kept), len(sp), hashlib.sha256(kept).hexdigest()))
            cols = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c) for c in cols)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return map_arrow(mark_repeats(docs), run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")

