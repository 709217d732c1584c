"""Texts cut at spaces into pieces that a tokenizer sees alone, and their ids kept per Python worker.

A piece is a run of other characters with the one space before it. No token of the vocabularies here spans a
border between two pieces, as long as every white space of the text is a single ASCII one. Longer runs are pieces too,
where the tokenizer is known to take them so; else a text with such runs, or other white space, is encoded as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import chain

#: White space and separators that a text isn't cut at.
_OTHER = re.compile("[\t\r\f\v\x1c-\x1f\x85\xa0 ᠎ -​    ⁠　﻿]")
_WIDE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -​    ⁠　﻿]")
_RUNS = ("  ", "\n\n", " \n", "\n ")
#: Pieces of a text with runs of ASCII white space, as byte-level tokenizers take them: a run but for its last character,
#: which belongs to what follows if it is a space, and stands alone if not.
_WITH_RUNS = re.compile(r" ?[^ \t\n\r\f\v]+|[ \t\n\r\f\v]+(?![^ \t\n\r\f\v])|[ \t\n\r\f\v]").findall
#: A word, marks, and perhaps a line break and a word: no token spans these borders either. The letter before the marks is
#: one that no normalizer takes apart, as it might leave an accent that belongs with the marks.
_WORD_AND_MARKS = re.compile("( ?\\w*[0-9A-Za-zÀ-ÖØ-öø-ÿ])([.,!&#*$%]+)(?:(\n)(\\w+))?")
_MARK = re.compile("[.,!&#*$%]").search
#: No text has it: Spark's strings hold no lone surrogates.
_CUT = "\ud800"

#: Pieces kept per worker in each of two generations; when the newer has more, it becomes the older.
KEPT = 900_000


class PieceCache:
    """``encode`` gives the ids, as bytes in the caller's form, of each of some strings; ``between`` joins them."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], kept: int = KEPT, spaces: bool = True, between: bytes = b"", runs: bool = False):
        """spaces: whether a space belongs to the piece after it; else the tokenizer ignores white space. runs: whether
        it takes runs of white space as _WITH_RUNS does."""
        self.encode, self.kept, self.spaces, self.between, self.runs = encode, kept, spaces, between, runs
        self.ids: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _known(self, piece: str) -> bool:
        """Whether the piece's ids are kept; those of the older generation are taken over."""
        if piece in self.ids:
            return True
        if (ids := self.older.get(piece)) is None:
            return False
        self.ids[piece] = ids
        return True

    def _learn(self, missing: set[str]) -> None:
        """Take pieces over from the older generation, and encode the parts of those that it doesn't have either."""
        if self.older:
            missing = {x for x in missing if not self._known(x)}
        parts = {}
        for piece in missing:
            # most pieces have no marks, which is seen sooner than whether they are a word and marks
            if _MARK(piece) and (found := _WORD_AND_MARKS.fullmatch(piece)):
                parts[piece] = [x for x in found.groups() if x]
        words = {x for own in parts.values() for x in own}
        new = list(missing.difference(parts).union(x for x in words if not self._known(x)))
        self.ids.update(zip(new, self.encode(new)))
        for piece, own in parts.items():
            self.ids[piece] = self.between.join([self.ids[x] for x in own])

    def _cut(self, text: str) -> list[str] | None:
        """The pieces of a text, or None if it is encoded as a whole."""
        if self.runs and not _WIDE.search(text):
            if any(x in text for x in _RUNS) or _OTHER.search(text):
                return _WITH_RUNS(text)
        elif _OTHER.search(text) or self.spaces and any(x in text for x in _RUNS):
            return None
        if not self.spaces:
            return text.split()
        pieces = text.replace(" ", _CUT + " ").split(_CUT)
        return pieces if pieces[0] else pieces[1:]

    def of_many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; what is new in all of them is encoded at once."""
        if len(self.ids) > self.kept:
            self.ids, self.older = {}, self.ids
        cuts = [self._cut(text) for text in texts]
        missing = set(chain.from_iterable(cut for cut in cuts if cut)).difference(self.ids)
        if missing:
            self._learn(missing)
        get, between = self.ids.__getitem__, self.between
        return [self.encode([text])[0] if cut is None else between.join(map(get, cut)) for text, cut in zip(texts, cuts)]

    def of(self, text: str) -> bytes:
        return self.of_many([text])[0]
