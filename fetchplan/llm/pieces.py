"""A tokenizers vocabulary with a bounded memo of the pieces between blanks.

A byte-level or word vocabulary never lets a token reach across a blank or line
feed that follows a visible character, so a text's tokens are those of its
pieces in order: each piece holds its leading blank or line feed where the
vocabulary keeps them, and is encoded by the library once for as long as the memo
holds it.  Special strings hold neither and so lie within one piece.

A piece of plain letters goes to the library's merge model directly: the steps before
it (normal forms, small letters, the split before the merges) do nothing else
to it.  Punctuation behind letters is split off first, as the split before the
merges does.  All other pieces go through the whole tokenizer.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

#: ASCII and Latin-1 letters, each of which is its own normal form and has one small letter, behind a blank or line feed and
#: before ASCII punctuation.  The apostrophe may begin a match with letters.
_WORD = re.compile(r"([ \n]?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
#: White space before a blank or line feed, where no cut is proven.
_BLANKS = re.compile(r"\s[ \n]")


def _byte_names() -> dict[int, str]:
    """How byte-level vocabularies write each byte: itself if it is printable, else the next letter from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


_NAMES = _byte_names()

#: Pieces a generation of the memo holds; the one before is kept too.  Bounds a worker's memory, not the result.
MEMO = 150_000


class _Memo(dict):
    """Ids of pieces; one that is missing is encoded when it is asked for."""

    __slots__ = ("encode",)

    def __missing__(self, piece: str) -> bytes:
        return self.encode(piece)


class Pieces:
    #: Longer pieces are encoded anew each time.
    LONG = 256

    def __init__(self, path: str, keeps_blanks: bool, memo: int = MEMO):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.keeps_blanks, self.MEMO = keeps_blanks, memo
        self.ids, self.before = _Memo(), {}
        self.ids.encode = self._learn
        self.raw = [np.array([k], "<u4").tobytes() for k in range(max(self.tokenizer.get_vocab().values(), default=-1) + 1)]
        self.ends: dict[str, bytes] = {}  # ids of a line feed, and of punctuation behind letters
        special = self.tokenizer.get_added_tokens_decoder().values()
        self.plain = not any(_WORD.fullmatch("a" + t.content) or _WORD.fullmatch(t.content) for t in special)

    def split(self, text: str) -> list[str]:
        """Pieces of the text; their concatenation (with blanks, if kept) encodes as the text does."""
        if not self.keeps_blanks:
            return [p for p in text.replace("\n", " ").split(" ") if p]
        blanks = _BLANKS.search(text)
        if not blanks and "\0" not in text:
            out = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
            return out if out[0] else out[1:]
        out = []
        for n, line in enumerate(text.split("\n")):
            first, *rest = line.split(" ")
            out.append("\n" + first if n else first)
            out += [" " + p for p in rest]
        if not blanks:
            return out if out[0] else out[1:]
        whole: list[str] = []
        for p in out:  # a cut is proven only where the character before the blank is visible
            if whole and (not whole[-1] or whole[-1][-1].isspace()):
                whole[-1] += p
            else:
                whole.append(p)
        return [p for p in whole if p]

    def _whole(self, piece: str) -> bytes:
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _end(self, piece: str) -> bytes:
        known = self.ends.get(piece)
        if known is None:
            known = self._whole(piece)
            if len(self.ends) < self.LONG and len(piece) <= self.LONG:
                self.ends[piece] = known
        return known

    def _letters(self, piece: str) -> bytes:
        """Ids of letters, with the blank before them if there is one."""
        if not self.keeps_blanks:
            piece = piece.lower()
        name = piece.replace(" ", _NAMES[32]) if piece.isascii() else piece.encode().decode("latin-1").translate(_NAMES)
        raw = self.raw
        return b"".join([raw[t.id] for t in self.model.tokenize(name)])

    def _encoded(self, piece: str) -> bytes:
        word = _WORD.fullmatch(piece) if self.plain else None
        if word is None:
            return self._whole(piece)
        lead, letters, end = word.groups()
        if end:
            base = lead + letters
            known = self.ids.get(base) or self.before.get(base)
            return (self._encoded(base) if known is None else known) + self._end(end)
        return self._end("\n") + self._letters(letters) if lead == "\n" else self._letters(piece)

    def _learn(self, piece: str) -> bytes:
        """Encode a piece that the memo lacks."""
        known = self.before.get(piece)
        if known is None:
            known = self._encoded(piece)
        if len(piece) <= self.LONG:
            if len(self.ids) >= self.MEMO:
                self.before = dict(self.ids)
                self.ids.clear()
            self.ids[piece] = known
        return known

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.ids.__getitem__, self.split(text)))


@lru_cache(maxsize=4)
def pieces(path: str, keeps_blanks: bool, memo: int = MEMO) -> Pieces:
    return Pieces(path, keeps_blanks, memo)
