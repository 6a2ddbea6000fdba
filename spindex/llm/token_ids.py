"""Token ids of whole texts with a byte-level BPE of the tokenizers library.

The vocabulary's pattern never joins a character that is not white space with
the white space after it, so a text is cut there into units (white space, then
a run without any) that encode independently of each other. A worker keeps the
ids of the units it met in a bounded table; a new unit is encoded by the
library, straight by its BPE model when the unit is one plain word."""

from __future__ import annotations

import os
import re
import sys
from array import array

UNITS = re.compile(r"\s*\S+|\s+")
#: One word of Latin letters, with at most one space before and punctuation after: two pre-tokens.
PLAIN = re.compile("( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([.,:;!?]*)")
#: White space for ``re``, but not for the tokenizer's pattern.
ODD = re.compile("[\x1c-\x1f]")
#: Units kept by a worker; each is at most this long.
KEEP, LONGEST = 1_000_000, 64
#: Longer texts are cut unit by unit, without a list of all their units.
LONG_TEXT = 1 << 20


def byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies spell the 256 bytes:
    printable ones stand for themselves, the others follow from U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


def packed(ids: list[int]) -> bytes:
    own = array("I", ids)
    if sys.byteorder == "big":
        own.byteswap()
    return own.tobytes()


class Encoder(dict):
    """unit -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.tok = Tokenizer.from_file(path)
        self.letters = byte_letters()
        self.marks: dict[str, bytes] = {}
        self.model = self.tok.model
        pre = self.tok.pre_tokenizer
        self.by_unit = (type(pre).__name__ == "ByteLevel" and not pre.add_prefix_space
                        and self.tok.normalizer is None)
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None

    def plain(self, text: str) -> bytes:
        return packed(self.tok.encode(text, add_special_tokens=False).ids)

    def word(self, word: str) -> bytes:
        """Ids of one pre-token."""
        if word.isascii() and word[0] == " ":  # the space has its letter, the others stand for themselves
            spelt = self.letters[32] + word[1:]
        else:
            spelt = word.encode().decode("latin-1").translate(self.letters)
        return packed([t.id for t in self.model.tokenize(spelt)])

    def new_marks(self, marks: str) -> bytes:
        got = self.word(marks)
        if len(marks) <= 3:
            self.marks[marks] = got
        return got

    def __missing__(self, unit: str) -> bytes:
        if m := PLAIN.fullmatch(unit):
            word, marks = m.groups()
            if marks:  # the word may be known by itself, the marks mostly are
                got = self[word] + (self.marks.get(marks) or self.new_marks(marks))
            else:
                got = self.word(word)
        else:
            got = self.plain(unit)
        if len(self) >= KEEP:
            self.clear()
        if len(unit) <= LONGEST:
            self[unit] = got
        return got

    def ids(self, text: str) -> bytes:
        if not self.by_unit or ODD.search(text) or self.added and self.added.search(text):
            return self.plain(text)
        units = UNITS.findall(text) if len(text) <= LONG_TEXT else (m[0] for m in UNITS.finditer(text))
        return b"".join(map(self.__getitem__, units))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file, made once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
