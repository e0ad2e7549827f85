"""Alignment of two tokenizers on the same texts.

A token's end is the sum of the lengths of the tokens up to it; ends that both
tokenizers share cut a text into groups, numbered by the running count of the
cuts before; the tokens of a group, of either side, are linked.  Within the
documents of an Arrow batch these are cumulative sums and lookups over arrays
(two tokens never meet across documents, so nothing is shuffled); what the
corpus says of a pair of ids is counted and joined in Spark's relational
terms: sums by pair, the highest by id, and a join in two tiers.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import chunks, map_arrow, materialize
from .tokens import Encoder, load, vocabulary_path
from .vectors import lengths

#: Pairs of ids whose counts every task gets (16 bytes each).
FREQUENT = 1 << 18
#: A group of more links than this is counted by its different ids.
LARGE = 4096
#: Bits of an id in a pair, and documents of a step.
ID_BITS, STEP = 24, 1 << 14


class _Plain(Encoder):
    """An encoder for which special tokens' strings are plain text."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.library.encode_special_tokens = True
        self.special = re.compile("(?!)")


@dataclass
class Side:
    """A tokenizer: ids of texts, and the bytes of its ids."""

    encode: Callable[[list[str]], list[np.ndarray]]
    spelled: list[bytes]

    def __post_init__(self) -> None:
        self.sizes = np.array([len(x) for x in self.spelled], np.int64)


def byte_level(path: str) -> Side:
    """A byte-level vocabulary of the tokenizers library; it gets the text
    with a space before."""
    encoder, library = _Plain(path), load(path)
    of = {c: bytes([b]) for b, c in encoder.spelling.items()}
    names = [library.id_to_token(i) or "" for i in range(library.get_vocab_size())]
    return Side(lambda texts: [np.frombuffer(encoder.ids(" " + t), "<u4") for t in texts], [b"".join(of.get(c, c.encode()) for c in x) for x in names])


def pieces(path: str) -> Side:
    """A sentencepiece model with byte fallback, which adds the space."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [library.id_to_piece(i) for i in range(library.get_piece_size())]
    spelled = [bytes([int(x[3:5], 16)]) if library.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]
    return Side(lambda texts: [np.array(x, np.uint32) for x in library.encode(texts, num_threads=1)], spelled)


#: By a file's ending.
LIBRARIES = {"json": byte_level, "model": pieces}


def side(path: str) -> Side:
    return LIBRARIES[path.rpartition(".")[2]](path)


@dataclass
class Aligned:
    """Several texts' tokens (ids, one after the other) and groups.

    docs_x[d]:docs_x[d + 1] are the tokens of text d, groups_x[g]:groups_x[g + 1]
    those of group g, and docs_g[d]:docs_g[d + 1] the groups of text d.
    """

    a: np.ndarray
    b: np.ndarray
    docs_a: np.ndarray
    docs_b: np.ndarray
    docs_g: np.ndarray
    groups_a: np.ndarray
    groups_b: np.ndarray

    @classmethod
    def of(cls, texts: list[str | None], one: Side, two: Side) -> Aligned:
        """Texts without tokens: null, empty, or not spelled as they are by
        the bytes of either side."""
        own = [t or "" for t in texts]
        ids = [s.encode(own) for s in (one, two)]
        for d, t in enumerate(own):
            if not t or any(b"".join(map(s.spelled.__getitem__, x[d].tolist())) != b" " + t.encode() for s, x in zip((one, two), ids, strict=True)):
                ids[0][d] = ids[1][d] = np.empty(0, np.uint32)
        flat, docs, ends = [], [], []
        for s, x in zip((one, two), ids, strict=True):
            docs.append(np.cumsum([0, *map(len, x)]))
            flat.append(np.concatenate([np.empty(0, np.uint32), *x]).astype(np.int64))
            ends.append(np.cumsum(s.sizes[flat[-1]]))
        total = int(ends[0][-1]) if len(ends[0]) else 0
        mark = np.zeros(total + 1, np.int8)
        for e in ends:
            mark[e] += 1
        # A token that ends where both do is the last of its group.
        last = [np.flatnonzero(mark[e] == 2) + 1 for e in ends]
        groups = [np.concatenate([[0], x]) for x in last]
        return cls(flat[0], flat[1], docs[0], docs[1], np.searchsorted(groups[0], docs[0]), groups[0], groups[1])

    def links(self) -> np.ndarray:
        """The number of links of each text."""
        each = np.diff(self.groups_a) * np.diff(self.groups_b)
        return np.diff(np.concatenate([[0], np.cumsum(each)])[self.docs_g])

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The different linked pairs of each text: text, pair (the ids, one
        above the other's ID_BITS), links."""
        n_a, n_b = np.diff(self.groups_a), np.diff(self.groups_b)
        doc = np.repeat(np.arange(len(self.docs_g) - 1), np.diff(self.docs_g))
        small = n_a * n_b <= LARGE
        group = np.repeat(np.arange(len(n_a)), np.where(small, n_a, 0))  # of each token of a, in small groups
        a = self.a[np.repeat(small, n_a)]
        times = n_b[group]
        at = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        key = np.repeat((doc[group] << (2 * ID_BITS)) | (a << ID_BITS), times) | self.b[np.repeat(self.groups_b[:-1][group], times) + at]
        keys, counts = [key], [np.ones(len(key), np.int64)]
        for g in np.flatnonzero(~small).tolist():
            x, m = np.unique(self.a[self.groups_a[g] : self.groups_a[g + 1]], return_counts=True)
            y, n = np.unique(self.b[self.groups_b[g] : self.groups_b[g + 1]], return_counts=True)
            keys.append(((int(doc[g]) << (2 * ID_BITS)) | (x[:, None] << ID_BITS) | y[None, :]).ravel())
            counts.append((m[:, None] * n[None, :]).ravel())
        if len(keys) == 1:
            key, total = np.unique(key, return_counts=True)
        else:
            key, back = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.zeros(len(key), np.int64)
            np.add.at(total, back, np.concatenate(counts))
        return key >> (2 * ID_BITS), key & ((1 << (2 * ID_BITS)) - 1), total

    def spelled(self, tables: list[list[bytes]]) -> list[bytes]:
        """Each text's groups as `a1,a2|b1;a3|b2,b3`; tables: the ids as
        numbers followed by `,` and `|`, and by `,` and `;`."""
        n = len(self.a) + len(self.b)
        where_a = np.arange(len(self.a)) + np.repeat(self.groups_b[:-1], np.diff(self.groups_a))
        where_b = np.arange(len(self.b)) + np.repeat(self.groups_a[1:], np.diff(self.groups_b))
        word = np.empty(n, np.int64)
        offset = np.cumsum([0, *map(len, tables)])
        for x, where, last, k in ((self.a, where_a, self.groups_a[1:] - 1, 0), (self.b, where_b, self.groups_b[1:] - 1, 2)):
            own = x + offset[k]
            own[last] = x[last] + offset[k + 1]
            word[where] = own
        words, cuts = list(map([y for t in tables for y in t].__getitem__, word.tolist())), (self.docs_a + self.docs_b).tolist()
        return [b"".join(words[i:j])[:-1] for i, j in zip(cuts, cuts[1:], strict=False)]


def _steps(batches, column: str):
    for b in chunks(batches, column, 1 << 20):
        for at in range(0, b.num_rows, STEP):
            yield b.slice(at, STEP)


def _lists(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(values.astype(np.int32)))


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """docs with `a` and `b`, the ids of both tokenizers, and `a_groups` and
    `b_groups`, how many of them each group has, in the text's order.

    Texts that are null or empty, or that a tokenizer does not spell as they
    are with a space before (it normalises, or knows no token for a
    character), have no tokens: empty arrays.  Special tokens' strings are
    plain text.  Repeated rows are aligned each for itself; a very long text
    is one step, of some 100 bytes of memory a byte; an empty table gives an
    empty one.  Columns of docs named like a new one are replaced.
    """
    names = ["a", "b", "a_groups", "b_groups"]
    docs = docs.drop(*(x for x in names if x != text))
    packed = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    schema = StructType([packed.schema["row"], *StructType.fromDDL(", ".join(f"{x} array<int>" for x in names)).fields])

    def run(batches):
        one, two = side(path_a), side(path_b)
        for b in _steps(batches, "text"):
            x = Aligned.of(b.column(1).to_pylist(), one, two)
            yield pa.RecordBatch.from_arrays([b.column(0), _lists(x.a, x.docs_a), _lists(x.b, x.docs_b), _lists(np.diff(x.groups_a), x.docs_g), _lists(np.diff(x.groups_b), x.docs_g)], ["row", *names])

    return map_arrow(packed, run, schema).select("row.*", *names)


def _digested(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(k, doc_id, n_a, n_b, n_groups, n_links, groups_sha256) of docs
    (doc_id, text), and the different linked pairs as arrays a, b and m."""
    schema = "k long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a array<int>, b array<int>, m array<int>"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        one, two = side(path_a), side(path_b)
        tables = [[b"%d%s" % (i, mark) for i in range(len(s.spelled))] for s, marks in ((one, b",|"), (two, b",;")) for mark in (marks[:1], marks[1:])]
        for b in _steps(batches, "text"):
            x = Aligned.of(b.column(2).to_pylist(), one, two)
            digests = [hashlib.sha256(s).hexdigest() if s else "" for s in x.spelled(tables)]
            doc, pair, m = x.pairs()
            cuts = np.searchsorted(doc, np.arange(b.num_rows + 1))
            counts = [pa.array(v, pa.int64()) for v in (np.diff(x.docs_a), np.diff(x.docs_b), np.diff(x.docs_g), x.links())]
            lists = [_lists(v, cuts) for v in (pair >> ID_BITS, pair & ((1 << ID_BITS) - 1), m)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1).cast(pa.int64()), *counts, pa.array(digests), *lists], names)

    return map_arrow(docs.select(F.monotonically_increasing_id().alias("k"), "doc_id", "text"), run, schema)


def pair_counts(linked: DataFrame) -> DataFrame:
    """(a, b, n, best): how many rows of linked (arrays a and b, each pair of
    ids once a row) hold a pair, and if no pair of that `a` has more."""

    def count(batches):
        for batch in batches:
            a, b = (np.asarray(batch.column(x).flatten(), np.int64) for x in (0, 1))
            pair, n = np.unique((a << ID_BITS) | b, return_counts=True)
            yield pa.RecordBatch.from_pydict({"a": pair >> ID_BITS, "b": pair & ((1 << ID_BITS) - 1), "n": n})

    counts = materialize(map_arrow(linked.select("a", "b"), count, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")), "pairs")
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    return counts.join(top, "a").select("a", "b", "n", (F.col("n") == F.col("top")).alias("best"))


def pair_sums(linked: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """(k, n_best, count_sum) of linked (k, arrays a, b and m): sums of m over
    the pairs that are an id's best, and of m times the pair's count.

    The `frequent` pairs of the highest counts are looked up where the rows
    are; only the others' rows are shuffled to their counts.
    """
    counts = materialize(counts, "counts")
    top = counts.orderBy(F.desc("n"), "a", "b").limit(frequent).toPandas()
    pair = (top.a.to_numpy(np.int64) << ID_BITS) | top.b.to_numpy(np.int64)
    order = np.argsort(pair)
    table = linked.sparkSession.sparkContext.broadcast((pair[order], top.n.to_numpy(np.int64)[order], top.best.to_numpy(bool)[order]))
    fields = "k long, a long, b long, m long, n_best long, count_sum long"

    def run(batches):
        pairs, n, best = table.value
        for batch in batches:
            k, rows = np.asarray(batch.column(0)), lengths(batch.column(1))
            a, b, m = (np.asarray(batch.column(x).flatten(), np.int64) for x in (1, 2, 3))
            doc, own = np.repeat(np.arange(len(k)), rows), (a << ID_BITS) | b
            at = np.minimum(np.searchsorted(pairs, own), max(0, len(pairs) - 1))
            hit = pairs[at] == own if len(pairs) else np.zeros(len(own), bool)
            sums = [np.zeros(len(k), np.int64), np.zeros(len(k), np.int64)]
            if hit.any():
                np.add.at(sums[0], doc[hit], m[hit] * best[at[hit]])
                np.add.at(sums[1], doc[hit], m[hit] * n[at[hit]])
            none, rest = pa.nulls(len(k), pa.int64()), ~hit
            empty = pa.nulls(int(rest.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(k), none, none, none, pa.array(sums[0]), pa.array(sums[1])], names := ["k", "a", "b", "m", "n_best", "count_sum"])
            yield pa.RecordBatch.from_arrays([pa.array(k[doc[rest]]), pa.array(a[rest]), pa.array(b[rest]), pa.array(m[rest]), empty, empty], names)

    found = materialize(map_arrow(linked.select("k", "a", "b", "m"), run, fields), "sums")
    others = found.filter("a IS NOT NULL").select("k", "a", "b", "m").join(counts, ["a", "b"])
    others = others.select("k", F.when(F.col("best"), F.col("m")).otherwise(0).alias("n_best"), (F.col("m") * F.col("n")).alias("count_sum"))
    return found.filter("a IS NULL").select("k", "n_best", "count_sum").unionByName(others).groupBy("k").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def op13_alignment(spark: SparkSession, sf_dir: str, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model") -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    linked = materialize(_digested(docs, vocabulary_path(a), vocabulary_path(b)), "linked")
    sums = pair_sums(linked, pair_counts(linked))
    return linked.join(sums, "k").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
