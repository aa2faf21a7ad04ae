"""Token ids of whole texts by the public tokenizers, exact and memoised by unit.

A text is cut where a single space stands between two characters that are not
white space.  Both tokenizers part their words there whatever surrounds it, so
ids of the units, joined, are the ids of the text; units repeat, and each
distinct one is encoded once per worker.  A unit made of letters only is one
word of the pre-tokenizer and goes straight to the BPE model; a comma, full stop
or line break after the letters is a word of its own.  A text with any other
run of spaces is encoded whole when the tokenizer keeps white space.
"""

from __future__ import annotations

import sys
from array import array

import numpy as np

CACHE_UNITS = 1_000_000
CACHE_WORDS = 1_500_000

# ASCII punctuation; an apostrophe can join the letters after it, so it is left out.
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies (public rule):
    printable Latin-1 bytes stand for themselves, the others take code points from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


class UnitEncoder:
    """Encode texts with one tokenizer file; ids as little-endian uint16 bytes.

    ``keeps_space``: the tokenizer gives ids to white space (byte-level), so a
    unit carries the space before it.
    """

    def __init__(self, path: str, keeps_space: bool):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        if sys.byteorder != "little":
            raise RuntimeError("ids are kept as little-endian bytes")
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids do not fit 16 bits")
        self.model = self.tokenizer.model
        self.normaliser = self.tokenizer.normalizer
        self.keeps_space = keeps_space
        self.prefix = " " if keeps_space else ""
        self.letters = byte_letters()
        self.units: dict[str, bytes | None] = {}
        self.words: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def word(self, word: str) -> bytes | None:
        """Ids of a run of letters, a space before it counted in.

        None if its normal form is not letters alone (a letter taken apart into letter
        and mark): the pre-tokenizer parts it again, and joins the mark with what follows.
        """
        found = self.words.get(word, b"")
        if found == b"":
            if len(self.words) >= CACHE_WORDS:
                self.words.clear()
            if word.isascii():
                text = word.lower() if self.normaliser else word.replace(" ", self.letters[32])
            else:
                text = self.normaliser.normalize_str(word) if self.normaliser else word
                if self.normaliser and not text.isalpha():
                    self.words[word] = None
                    return None
                text = text.encode().decode("latin-1").translate(self.letters)
            found = self.words[word] = array("H", [t.id for t in self.model.tokenize(text)]).tobytes()
        return found

    def mark(self, mark: str) -> bytes:
        """Ids of a run of ASCII punctuation right after a letter."""
        if mark not in self.marks:
            if len(self.marks) > 10_000:
                self.marks.clear()
            self.marks[mark] = self.whole(mark)
        return self.marks[mark]

    def unit(self, u: str, prefix: str) -> bytes | None:
        """Ids of a unit; None if it cannot stand alone."""
        if self.keeps_space and (not u or u[0].isspace() or u[-1].isspace()):
            return None
        letters = u if u.isalpha() else u.rstrip(MARKS)
        if letters.isalpha():
            ids = self.word(prefix + letters)
            if ids is None:
                return self.whole(prefix + u)
            return ids if letters is u else ids + self.mark(u[len(letters):])
        left, cut, right = u.partition("\n")
        if cut and left and right and not (left[-1].isspace() or right[0].isspace()):
            return self.unit(left, prefix) + self.mark("\n") + self.unit(right, "")
        return self.whole(prefix + u)

    def encode_after_space(self, text: str) -> bytes:
        """Ids of a space and ``text``, for a tokenizer that keeps white space."""
        units, known = text.split(" "), self.units
        for _ in range(2):
            try:
                return b"".join(map(known.__getitem__, units))
            except KeyError:
                if len(known) > CACHE_UNITS:
                    known.clear()
                known.update((u, self.unit(u, self.prefix)) for u in set(units) if u not in known)
            except TypeError:
                break
        return self.whole(" " + text)

    def encode(self, text: str) -> bytes:
        first = b""
        units = text.split(" ")
        if self.keeps_space:
            head = units.pop(0)
            if not head or head[0].isspace() or head[-1].isspace():
                return self.whole(text)
            first = self.whole(head)
        known = self.units
        try:
            return first + b"".join(map(known.__getitem__, units))
        except KeyError:
            if len(known) > CACHE_UNITS:
                known.clear()
            for u in set(units):
                if u not in known:
                    known[u] = self.unit(u, self.prefix)
        except TypeError:
            return self.whole(text)
        try:
            return first + b"".join(map(known.__getitem__, units))
        except TypeError:
            return self.whole(text)


_ENCODERS: dict[tuple[str, bool], UnitEncoder] = {}


def encoder(path: str, keeps_space: bool) -> UnitEncoder:
    """One encoder per Python worker and tokenizer file."""
    key = (path, keeps_space)
    if key not in _ENCODERS:
        _ENCODERS[key] = UnitEncoder(path, keeps_space)
    return _ENCODERS[key]
