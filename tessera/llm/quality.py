"""Quality rules: a short-circuit cascade, ordered by rejection per cost.

A rule rejects a document by statistics of its whole text.  Before the run the
seconds that each statistic takes, and the verdict of each rule, are taken on
a bounded sample.  Rules are then ordered one by one: next comes the rule with
the most rejections, of what the rules before it let pass, per second of the
statistics that these have not computed already.  A rule, and the statistics
that only it needs, see only what is still alive.  The order changes the time,
never the verdict: a document is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, column_bytes, map_arrow
from .hashing import SPACE, SPACE_ONLY, U, Words, fold, mix

#: Documents that the sample for costs and selectivities expects.
SAMPLE = 500

#: Characters that count as symbols; bytes that begin no character.
SYMBOLS = b"#*$%&|<>"
NO_CHAR = SPACE + bytes(range(0x80, 0xC0))


def n_words(texts: list[bytes]) -> list[int]:
    return [len(x.split()) for x in texts]


def word_chars(texts: list[bytes]) -> list[int]:
    return [len(x.translate(None, NO_CHAR)) for x in texts]


def n_symbols(texts: list[bytes]) -> list[int]:
    return [len(x) - len(x.translate(None, SYMBOLS)) for x in texts]


def n_bangs(texts: list[bytes]) -> list[int]:
    return [x.count(b"!") for x in texts]


def _lines(x: bytes) -> list[bytes]:
    return [y for y in x.split(b"\n") if y.strip()]


def n_lines(texts: list[bytes]) -> list[int]:
    return [len(_lines(x)) for x in texts]


def n_dup_lines(texts: list[bytes]) -> list[int]:
    return [len(y) - len(set(y)) for y in map(_lines, texts)]


def n_repeat_words(texts: list[bytes]) -> np.ndarray:
    """Words in 3-word windows that the text has twice or more."""
    words = Words(texts, SPACE_ONLY)
    first, h = words.first, words.hash
    n = np.diff(first)
    text = np.repeat(np.arange(len(n)), n)
    gram = fold(h, 3)
    ok = np.flatnonzero(text[: len(gram)] == text[2:]) if len(gram) else np.empty(0, np.int64)
    key = gram[ok] + mix(text[ok].astype(U))
    order = np.argsort(key, kind="stable")
    s = key[order]
    same = s[1:] == s[:-1]
    twice = np.zeros(len(s), bool)
    twice[1:] |= same
    twice[:-1] |= same
    start = ok[order[twice]]
    covered = np.zeros(len(h) + 2, bool)
    for k in range(3):
        covered[start + k] = True
    total = np.concatenate([[0], np.cumsum(covered, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


STATISTICS = {f.__name__: f for f in (n_words, word_chars, n_symbols, n_bangs, n_lines, n_dup_lines, n_repeat_words)}


class Chunk:
    """Statistics of a list of texts, each computed for the texts that are
    asked for, and once."""

    def __init__(self, texts: list[bytes]) -> None:
        self.texts, self._known = texts, {}

    def __call__(self, name: str, at: np.ndarray) -> np.ndarray:
        """Statistic `name` of the texts with the given indexes."""
        have, values = self._known.setdefault(name, (np.zeros(len(self.texts), bool), np.zeros(len(self.texts), np.int64)))
        todo = at[~have[at]]
        if len(todo):
            values[todo] = STATISTICS[name]([self.texts[i] for i in todo])
            have[todo] = True
        return values[at]

    def computed(self, name: str) -> int:
        """For how many texts a statistic has been computed."""
        return int(self._known[name][0].sum()) if name in self._known else 0


class Rule(NamedTuple):
    name: str
    needs: tuple[str, ...]
    rejects: Callable[..., np.ndarray]


#: The limits of the rules.
BASE = (
    Rule("few_words", ("n_words",), lambda n: n < 50),
    Rule("repeated_words", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 50 * n),
)
RULES = (
    *BASE,
    Rule("symbols", ("n_symbols", "n_words"), lambda s, n: 10 * s > n),
    Rule("shouting", ("n_bangs", "n_words"), lambda b, n: 5 * b > n),
    Rule("word_length", ("word_chars", "n_words"), lambda c, n: (c < 3 * n) | (c > 10 * n)),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda d, n: 2 * d > n),
)


def cascade(chunk: Chunk, rules: tuple[Rule, ...]) -> np.ndarray:
    """Which texts no rule rejects."""
    alive = np.arange(len(chunk.texts))
    for rule in rules:
        if not len(alive):
            break
        alive = alive[~rule.rejects(*(chunk(x, alive) for x in rule.needs))]
    out = np.zeros(len(chunk.texts), bool)
    out[alive] = True
    return out


def order(rules: tuple[Rule, ...], verdicts: np.ndarray, cost: dict[str, float], computed: frozenset[str] = frozenset()) -> tuple[Rule, ...]:
    """rules by falling rejection per cost, each on what those before it let
    pass.  verdicts: a row a document, whether each rule rejects it; cost: of
    each statistic for one document; computed: statistics that cost nothing."""
    left, alive, known, out = list(range(len(rules))), np.ones(len(verdicts), bool), set(computed), []
    while left:
        n = max(1, int(alive.sum()))
        gain = lambda i: (verdicts[alive, i].sum() / n) / max(sum(cost[x] for x in rules[i].needs if x not in known), 1e-9)  # noqa: B023, E731
        best = max(left, key=lambda i: (gain(i), -i))
        left.remove(best)
        out.append(rules[best])
        known |= set(rules[best].needs)
        alive &= ~verdicts[:, best]
    return tuple(out)


def ordered(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample: int = SAMPLE) -> tuple[Rule, ...]:
    """rules in the order that order() gives, estimated on about `sample` rows.
    Rows with one set of verdicts are counted, so the driver gets no more than
    2**len(rules) of them a task."""
    n = docs.count()
    if not n:
        return rules
    names = tuple(dict.fromkeys(x for r in rules for x in r.needs))
    schema = pa.schema([("verdicts", pa.int64()), ("n", pa.int64()), *((x, pa.float64()) for x in names)])

    def run(batches):
        seen: dict[int, int] = {}
        spent = dict.fromkeys(names, 0.0)
        for b in chunks(batches, text, 1 << 20):
            chunk, every = Chunk(column_bytes(b.column(0))), np.arange(b.num_rows)
            for x in names:
                began = time.perf_counter()
                chunk(x, every)
                spent[x] += time.perf_counter() - began
            code = sum((np.asarray(r.rejects(*(chunk(x, every) for x in r.needs)), np.int64) << i for i, r in enumerate(rules)), np.zeros(b.num_rows, np.int64))
            for c, k in zip(*np.unique(code, return_counts=True), strict=True):
                seen[int(c)] = seen.get(int(c), 0) + int(k)
        if seen:
            first = [[spent[x]] + [0.0] * (len(seen) - 1) for x in names]
            yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.int64()), pa.array(seen.values(), pa.int64()), *(pa.array(c, pa.float64()) for c in first)], schema=schema)

    found = map_arrow(docs.select(text).sample(min(1.0, sample / n), seed=11), run, "verdicts long, n long, " + ", ".join(f"{x} double" for x in names))
    rows = found.groupBy("verdicts").agg(F.sum("n").alias("n"), *(F.sum(x).alias(x) for x in names)).collect()
    if not rows:
        return rules
    total = sum(r.n for r in rows)
    verdicts = np.repeat([[bool(r.verdicts >> i & 1) for i in range(len(rules))] for r in rows], [r.n for r in rows], axis=0)
    return order(rules, verdicts, {x: sum(r[x] for r in rows) / total for x in names})


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, measure: tuple[str, ...] = (), text: str = "text", out: str = "kept") -> DataFrame:
    """docs with a column for each statistic in `measure` and with the verdict
    in `out`.

    A null text is an empty one; few_words rejects it.  Equal rows get equal
    verdicts, as do texts at a limit whatever the order; an empty table gives
    an empty one; columns of docs with the names of new ones are replaced.
    The cascade comes first: what is measured besides is computed for the rows
    that it has not been computed for.
    """
    docs = docs.drop(*measure, out)
    rules = ordered(docs, rules, text)
    schema = docs.select("*", *(F.lit(0).cast("long").alias(m) for m in measure), F.lit(True).alias(out)).schema
    at, names = docs.columns.index(text), schema.names

    def run(batches):
        for b in chunks(batches, text, 1 << 20):
            chunk = Chunk(column_bytes(b.column(at)))
            kept, every = cascade(chunk, rules), np.arange(len(chunk.texts))
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(chunk(m, every)) for m in measure), pa.array(kept)], names)

    return map_arrow(docs, run, schema)


BASE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = judge(docs, measure=BASE_COLUMNS)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select("doc_id", *BASE_COLUMNS, failed.alias("base_failed"), "kept")


ORACLE = r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, ws[i] || chr(32) || ws[i + 1] || chr(32) || ws[i + 2] AS g FROM w, unnest(range(1, len(ws) - 1)) AS r(i)),
k AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM k WHERE c > 1) GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM w),
s AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (length(t) - length(replace(t, '!', '')))::BIGINT AS n_bangs,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls)::BIGINT AS n_lines,
    coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM w JOIN l USING (doc_id) LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words OR 5 * n_bangs > n_words
    OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM s
"""
