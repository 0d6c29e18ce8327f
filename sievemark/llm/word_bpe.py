"""Token ids of whole texts by a word-level BPE vocabulary file.

The vocabulary lowers case, drops white space and ends words at it, so the ids of
a text are those of its pre-tokens in turn: runs of letters, digits one by one, runs
of other marks. Pre-tokens repeat, so each worker keeps the ids of those that it has
seen. Texts with special tokens or odd white space go through the tokenizer itself.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from array import array

#: The pre-tokenizer's pattern (fixed by the vocabulary file).
_WORDS = r"[\p{L}]+|'s|'t|'re|'ve|'m|'ll|'d|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same for ASCII in lower case.
_ASCII_WORDS = re.compile(r"[a-z]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\sa-z0-9]+").findall
#: What str.split() takes for white space and the tokenizer does not.
_ODD = re.compile("[\x1c-\x1f\x85]")
_PLAIN = re.compile("[\t\n\x0b\x0c\r ]+")
#: Pre-tokens kept by a worker (about 30 MB), and the longest one kept.
KEPT, LONGEST = 150_000, 64


def _byte_letters() -> dict[int, str]:
    """The public byte-level alphabet: printable Latin-1 stands for itself, the rest from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Kept(dict):
    """Ids by string, made where missing; longer strings are not kept, and all
    are forgotten when there are too many."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> bytes:
        ids = self.make(key)
        if len(key) <= LONGEST:
            if len(self) >= KEPT:
                self.clear()
            self[key] = ids
        return ids


class WordBpe:
    """``encode(text)`` gives the ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, plain_specials: bool = False):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        self.tokenize = self.tokenizer.model.tokenize
        self.find = regex.compile(_WORDS).findall
        self.letters = _byte_letters()
        self.parts = _Kept(self._part)

    def _part(self, word: str) -> bytes:
        """Ids of one pre-token, in lower case."""
        spelled = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))
        return _packed([t.id for t in self.tokenize(spelled)])

    def _whole(self, chunk: str) -> bytes:
        """Ids of a text without white space, by the tokenizer itself."""
        return _packed(self.tokenizer.encode(chunk, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        if "<|" in text or _ODD.search(text):
            return b"".join(map(self._whole, _PLAIN.split(text)))
        if text.isascii():
            return b"".join(map(self.parts.__getitem__, _ASCII_WORDS(text.lower())))
        # The vocabulary lowers each character alone; Python only a sigma by its place.
        low = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()
        return b"".join(map(self.parts.__getitem__, self.find(low)))


def _packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


_loaded: dict[tuple[str, bool], WordBpe] = {}


def encoder(path: str, plain_specials: bool = False) -> WordBpe:
    """One encoder for each worker, kept between tasks."""
    key = (path, plain_specials)
    if key not in _loaded:
        _loaded[key] = WordBpe(path, plain_specials)
    return _loaded[key]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
