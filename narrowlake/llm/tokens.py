"""Token ids of whole texts with public tokenizers, with a bounded memory of known words."""

from __future__ import annotations

import functools
import re
from array import array
from collections.abc import Callable

import numpy as np
from tokenizers import Tokenizer

from narrowlake.llm.common import only_memory_of, remembers

# Pieces whose ids one Python worker remembers before it drops those not used since; two
# such sets, of about 200 bytes an entry, are held at a time.  Operators that hold little
# else ask for more.
REMEMBERED = 160_000
_BLANK = re.compile(r"(?<=\S) (?=\S)")
# Characters whose kind, case and composed form need no tables: ASCII and the Latin letters
# up to U+024F, without the one whose lower case is two characters.
_LATIN = "A-Za-zªµºÀ-ÖØ-öø-įı-ɏ"
_SIMPLE = re.compile(rf"[\x00-\x7f×÷{_LATIN}]*")
# The two vocabularies' patterns of pre-tokens, for these characters.
_COUNTED = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[0-9]+| ?[^\s{_LATIN}0-9]+|\s+(?!\S)|\s+", re.ASCII
)
_DROPPED = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN}]+|[0-9]|[^\s{_LATIN}0-9]+", re.ASCII)


class _WideBlank(Exception):
    """A piece has white space at an end, so the blank beside it is part of a longer run."""


class Memory(dict):
    """Ids by piece; when full, pieces that were not asked for again are forgotten."""

    def __init__(self, make: Callable[[str], bytes], most: int | None = None):
        self.make, self.most, self.before = make, most or REMEMBERED, {}

    def forget(self) -> None:
        self.clear()
        self.before = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.before.get(piece)
        if ids is None:
            ids = self.make(piece)
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """Ids equal to ``encode(text, add_special_tokens=False)`` of the tokenizers library.

    A text is cut at single blanks, where its pre-tokens end in any case, and the ids of the
    pieces are looked up among those seen before.  A new piece of simple characters is cut
    into pre-tokens, and each that is new goes to the library's model; every other piece
    goes to its encode().  A text that holds the string of a special token is encoded in one
    go, as the library does.
    """

    def __init__(self, path: str, remembered: int | None = None, plain: bool = False):
        """``plain`` takes the strings of special tokens for ordinary text."""
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.model = self.tokenizer.model
        # The two kinds of vocabulary: the blank before a word is part of its ids, or dropped.
        self.blanks_count = self.tokenizer.normalizer is None
        self.letters = byte_letters()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces = Memory(self._piece, remembered)
        self.stems = Memory(self._stem, remembered)

    def ids(self, text: str) -> np.ndarray:
        """The ids of a text as unsigned 32-bit integers."""
        return np.frombuffer(self.packed(text), np.uint32)

    def packed(self, text: str) -> bytes:
        if any(s in text for s in self.specials):
            return self._whole(text)
        if not self.blanks_count:
            return b"".join(map(self.pieces.__getitem__, text.split(" ")))
        try:
            first, *rest = text.split(" ")
            if not rest:
                return self._whole(text)
            if not first or first[-1].isspace():
                raise _WideBlank
            return self._first(first) + b"".join(map(self.pieces.__getitem__, rest))
        except _WideBlank:
            first, *rest = _BLANK.split(text)
            return self._whole(first) + b"".join([self._whole(" " + p) for p in rest])

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _first(self, piece: str) -> bytes:
        """Ids of a piece without a blank before it."""
        if not _SIMPLE.fullmatch(piece):
            return self._whole(piece)
        return b"".join(map(self.stems.__getitem__, _COUNTED.findall(piece)))

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece with the blank before it, where blanks count."""
        if not self.blanks_count:
            if not _SIMPLE.fullmatch(piece):
                return self._whole(piece)
            return b"".join(map(self.stems.__getitem__, _DROPPED.findall(piece.lower())))
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _WideBlank
        if not _SIMPLE.fullmatch(piece):
            return self._whole(" " + piece)
        return b"".join(map(self.stems.__getitem__, _COUNTED.findall(" " + piece)))

    def _stem(self, stem: str) -> bytes:
        """Ids of one pre-token of simple characters."""
        if stem.isascii() and stem.isalpha():
            letters = stem
        else:
            letters = stem.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte.

    Fixed values of the format: printable bytes stand for themselves, the others for the
    code points from 256 on, in order.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b if b in plain else next(others)) for b in range(256)}


@functools.lru_cache(maxsize=4)
def _encoder(path: str, remembered: int | None) -> Encoder:
    own = Encoder(path, remembered)
    for memory in (own.pieces, own.stems):
        remembers("tokens", memory.forget)
    return own


def encoder(path: str, remembered: int | None = None) -> Encoder:
    """One encoder per file and Python worker; workers are used again by later tasks."""
    only_memory_of("tokens")
    return _encoder(path, remembered)


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file, as installed on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)
