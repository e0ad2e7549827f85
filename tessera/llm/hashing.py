"""Prefix polynomial hashes over byte buffers, in numpy, modulo 2**64."""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Powers that a worker keeps; those of a longer buffer go when it is done.
KEPT = 1 << 21
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i up to n."""
    if len(_powers[0]) > n:
        return _powers[0], _powers[1]
    size, made = max(n + 1, 1 << 18), []
    for b in (BASE, INVERSE):
        a = np.full(size, b, U)
        a[0] = 1
        made.append(np.multiply.accumulate(a, out=a))
    if size <= KEPT:
        _powers[:] = made
    return made[0], made[1]


def prefix(buf: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = sum of (buf[k] + 1) * BASE**k for i <= k < j."""
    out = np.empty(len(buf) + 1, U)
    out[0] = 0
    v = buf.astype(U)
    v += U(1)
    v *= powers(len(buf))[0][: len(buf)]
    np.cumsum(v, out=out[1:])
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: all bits of the result depend on all of x."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def spans(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of buf[start:end], equal for equal bytes wherever they stand."""
    return mix((p[end] - p[start]) * powers(len(p))[1][start] + (end - start).astype(U))


def fold(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-grams of a sequence of hashes (len(h) - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, U)
    out = np.zeros(n, U)
    for i in range(k):
        out = out * U(BASE) + h[i : i + n]
    return mix(out + U(k))


class Words:
    """The words of several texts, as hashes and byte spans of one buffer.

    table: bytes.translate table that turns each byte that is not of a word
    into a space.  first[d]:first[d + 1] are the words of text d.
    """

    def __init__(self, texts: list[bytes], table: bytes, hashes: bool = True) -> None:
        self.raw = b" ".join(x.translate(table) for x in texts) + b" "
        buf = np.frombuffer(self.raw, np.uint8)
        inside = np.empty(len(buf) + 1, np.int8)
        inside[0] = 0
        inside[1:] = buf != 32
        step = np.diff(inside)
        self.starts = np.flatnonzero(step == 1)
        self.ends = np.flatnonzero(step == -1)
        begin = np.cumsum([0, *(len(x) + 1 for x in texts)])
        self.begin = begin
        self.first = np.searchsorted(self.starts, begin)
        self.hash = spans(prefix(buf), self.starts, self.ends) if hashes else None


def lower_table(separators: bytes | None = None, words: bytes | None = None) -> bytes:
    """A-Z to a-z; separators, or all but words and bytes over 127, to space."""
    out = bytearray(range(256))
    for c in range(65, 91):
        out[c] = c + 32
    for c in range(256):
        if (separators is not None and c in separators) or (words is not None and c < 128 and out[c] not in words):
            out[c] = 32
    return bytes(out)


#: White space of the word patterns, and the characters of ASCII words.
SPACE = b" \t\n\v\f\r"
SPACE_LOWER = lower_table(separators=SPACE)
ALNUM_LOWER = lower_table(words=b"0123456789abcdefghijklmnopqrstuvwxyz")
SPACE_ONLY = bytes(32 if c in SPACE else c for c in range(256))
