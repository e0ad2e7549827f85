"""Pre-tokens of a byte-level BPE vocabulary, and cached counts and ids."""

from __future__ import annotations

import json
import re
from array import array

#: The pre-token pattern of the vocabulary, spelled for the
#: characters that PLAIN allows, on which it is the same as with Unicode's
#: classes.  Texts with others are read through a copy in which each of these
#: has become a letter, a digit, a sign or a space.
_L, _N = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
PRETOKEN = re.compile(rf"'(?:[sdmt]|ll|ve|re)| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+")
OTHER = re.compile(r"[^\t\n\v\f\r -~\xa0-ɏ‐-‧‰-⁞€]")

#: Entries of each of the two generations of a worker's cache, and the longest
#: cached pre-token.
CACHE, LONGEST = 250_000, 64


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def special_strings(path: str) -> list[str]:
    with open(path, encoding="utf-8") as f:
        return [x["content"] for x in json.load(f)["added_tokens"]]


def _visible() -> dict[int, str]:
    """The vocabulary's spelling of bytes: printable ones stand for
    themselves, the others for the characters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in plain else next(rest)) for b in range(256)}


class Cache(dict):
    """pre-token -> what encode() makes of it.  Two generations: when this one
    is full it becomes the old one, from which what is used again comes back;
    so a worker's memory is bounded whatever the texts hold."""

    def __init__(self, encode, first: dict | None = None) -> None:
        super().__init__(first or {})
        self.encode, self.old, self.most = encode, {}, CACHE + len(first or {})

    def __missing__(self, key: str):
        out = self.old.get(key)
        if out is None:
            out = self.encode(key)
        if len(key) <= LONGEST:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = out
        return out


class Classes(dict):
    """Code point -> a character of its class that PRETOKEN knows, for what
    OTHER finds; the library's own splitter is asked once for each."""

    def __init__(self, library) -> None:
        super().__init__()
        self.split = library.pre_tokenizer.pre_tokenize_str

    def __missing__(self, code: int):
        c = chr(code)
        if OTHER.match(c):
            self[code] = next((x for x in "a1!" if len(self.split(x + c)) == 1), "\t")
        else:
            self[code] = c
        return self[code]


class Encoder:
    """Counts and ids of whole texts, as the library gives them: texts are
    looked up by pre-token, whatever their script.  Only those with a special
    string go to the library as they are."""

    def __init__(self, path: str, frequent: dict[str, int] | None = None) -> None:
        self.library = load(path)
        self.special = re.compile("|".join(map(re.escape, special_strings(path))) or r"(?!)")
        self.spelling, self.model, self.classes = _visible(), self.library.model, Classes(self.library)
        self.counts = Cache(lambda x: len(self._model(x)), frequent)
        self.blobs = Cache(lambda x: array("I", [t.id for t in self._model(x)]).tobytes())

    def _model(self, pretoken: str):
        """The library's model on one pre-token."""
        return self.model.tokenize("".join(map(self.spelling.__getitem__, pretoken.encode())))

    def pretokens(self, text: str) -> list[str]:
        if not OTHER.search(text):
            return PRETOKEN.findall(text)
        return [text[m.start() : m.end()] for m in PRETOKEN.finditer(text.translate(self.classes))]

    def count(self, text: str) -> int:
        if self.special.search(text):
            return len(self.library.encode(text, add_special_tokens=False).ids)
        return sum(map(self.counts.__getitem__, self.pretokens(text)))

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if self.special.search(text):
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.blobs.__getitem__, self.pretokens(text)))
