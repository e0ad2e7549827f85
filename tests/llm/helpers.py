"""Small documents with every odd case, and brute-force versions."""

from __future__ import annotations

import random
from collections import Counter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, spans string, shard string, slot string, n_tokens string, length string, component_id string, _v string"
PASSAGE = " ".join(f"shared{i} passage{i * 7 % 11}" for i in range(60))


def odd_texts() -> list[str | None]:
    r = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    prose = [" ".join(r.choice(words) for _ in range(n)) for n in (60, 80, 120, 200)]
    near = prose[3].split()
    near[100] = "changed"
    return [
        *prose, prose[0], prose[0], " ".join(near), None, "", " ", "\n\n", "a", "a b c", "tab\tand\x0bvt\x85nel nbsp  em",
        PASSAGE + " " + prose[1], prose[2] + " " + PASSAGE, "x" * 3000, "ab" * 900, "long " * 40_000, "ÜBER ßtraße 中文 🎉 " * 30, "<|endoftext|> and <|endoftext|>",
        "line one here\n" * 30, "WORD!! " * 60, "a### b$$$ c%%% " * 40, "\x00nul\x00 bytes",
    ]


def odd_documents(spark):
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else "s", len(t or "")) for i, t in enumerate(odd_texts())]
    rows += [(0, rows[0][1], "en", "s", 1), (1, rows[1][1], None, None, None)]  # repeated rows
    return spark.createDataFrame([r + ("x",) * 8 for r in rows], SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def repeated_bytes(texts: list[bytes], span: int) -> list[bytearray]:
    """Which bytes are under strings that start twice, by counting them all."""
    seen = Counter(x[j : j + span] for x in texts for j in range(len(x) - span + 1))
    out = []
    for x in texts:
        mark = bytearray(len(x))
        for j in range(len(x) - span + 1):
            if seen[x[j : j + span]] > 1:
                mark[j : j + span] = b"\1" * span
        out.append(mark)
    return out


def kept_bytes(x: bytes, mark: bytearray) -> bytes:
    return bytes(c for c, m in zip(x, mark, strict=True) if not m)


def lower(t: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def shingles(t: str | None, k: int = 5) -> set:
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t or ""))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def groups(sets: list[set]) -> list[int]:
    """The smallest index that each set reaches by similarity."""
    root = list(range(len(sets)))

    def top(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(sets))]
