"""Token counts with overlap resynchronisation for huge documents.

Texts up to ``chunk_chars`` are encoded whole (through the memo of
``pieces.py``).  A longer one is never encoded whole: overlapping chunks are
encoded on their own, and neighbours are spliced at a proven stable common
boundary.  A chunk goes through the memo too, whose pieces end where matches
end; a piece too long for the memo goes through the library with offsets.

Proof.  The split before the merges reads from left to right without memory,
and merges never cross its matches.  A match end of the left chunk, further
from the chunk's end than the longest look-ahead and special string, is also
one of the whole text.  Where the right chunk's own parse has a match end at
the same character, both read the same text from there on, so the right
chunk's tokens hold from that point.  If the overlap has no such boundary (one
match spans it), it is doubled and the left chunk is encoded again, at the
last up to the end of the text.

Null and empty texts have 0 bytes and 0 tokens.  Special strings inside texts
are handled as the library does by default.  Rows are independent.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fetchplan.llm.columns import buffers, per_row, texts
from fetchplan.llm.pieces import Pieces, pieces

CHUNK_CHARS = 8_192
OVERLAP_CHARS = 512


class Resync:
    def __init__(self, tokenizer, chunk: int, overlap: int, memo: Pieces | None = None):
        self.tokenizer, self.chunk, self.overlap, self.memo = tokenizer, chunk, max(1, overlap), memo
        self.margin = 4 + max([0, *(len(t.content) for t in tokenizer.get_added_tokens_decoder().values())])
        self.widened = 0

    def _matches(self, text: str) -> tuple[np.ndarray, np.ndarray, int]:
        """Match ends within the text, tokens up to each, and the token count, from the library."""
        e = self.tokenizer.encode(text, add_special_tokens=False)
        n = len(e.ids)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        word = np.array([-1 if w is None else w for w in e.word_ids], np.int64)
        ends = np.array([x[1] for x in e.offsets], np.int64)
        last = np.flatnonzero(np.append(word[1:] != word[:-1], True))
        return ends[last], last + 1, n

    def parse(self, text: str, a: int, b: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Match ends within text[a:b] (absolute), tokens up to each, and the token count; with a memo, ends of pieces."""
        if self.memo is None:
            ends, upto, n = self._matches(text[a:b])
            return ends + a, upto, n
        parts, known = self.memo.split(text[a:b]), self.memo.ids
        ends, upto, run, at, n = [], [], [], a, 0

        def close() -> None:
            nonlocal at, n
            if run:
                ends.append(np.cumsum(list(map(len, run))) + at)
                upto.append(np.cumsum(list(map(len, map(known.__getitem__, run)))) // 4 + n)
                at, n = int(ends[-1][-1]), int(upto[-1][-1])
                run.clear()

        if max(map(len, parts), default=0) <= self.memo.LONG:
            run = parts
        else:
            for p in parts:
                if len(p) <= self.memo.LONG:
                    run.append(p)
                    continue
                close()
                e, u, k = self._matches(p)
                ends.append(e + at)
                upto.append(u + n)
                at, n = at + len(p), n + k
        close()
        nothing = np.zeros(0, np.int64)
        return np.concatenate([nothing, *ends]), np.concatenate([nothing, *upto]), n

    def count(self, text: str) -> int:
        start, total = 0, 0  # start: a proven boundary; total: tokens before it
        c = self.chunk
        overlap = self.overlap
        end = min(c + overlap, len(text))
        pos, upto, n = self.parse(text, 0, end)
        base = 0  # tokens of the current chunk before start
        while end < len(text):
            nxt_end = min(c + self.chunk + self.overlap, len(text))
            rpos, rupto, rn = self.parse(text, c, nxt_end)
            while True:
                sure = (pos > max(start, c)) & (pos <= (end - self.margin if end < len(text) else end))
                common = np.intersect1d(pos[sure], rpos)
                if len(common) or end == len(text):
                    break
                overlap *= 2  # no common boundary: widen the overlap and encode the left chunk again
                self.widened += 1
                end = min(c + overlap, len(text))
                pos, upto, n = self.parse(text, start, end)
                base = 0
                if end > nxt_end - self.margin:
                    nxt_end = min(end + self.chunk, len(text))
                    rpos, rupto, rn = self.parse(text, c, nxt_end)
            if not len(common):  # the left chunk now holds the rest of the text
                break
            at = int(common[0])
            total += int(upto[np.searchsorted(pos, at)]) - base
            start, pos, upto, n, end = at, rpos, rupto, rn, nxt_end
            base = int(rupto[np.searchsorted(rpos, at)])
            c, overlap = max(c + self.chunk, end - self.overlap), self.overlap
        return total + n - base


@lru_cache(maxsize=4)
def _resync(path: str, chunk: int, overlap: int) -> Resync:
    memo = pieces(path, True)
    return Resync(memo.tokenizer, chunk, overlap, memo)


def token_counts(docs: DataFrame, tokenizer_path: str, text_col: str = "text", keep: list[str] | None = None,
                 limit: int = 1024, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """Adds ``n_bytes``, ``n_tokens`` and ``over_limit`` to each document, without a shuffle.

    ``tokenizer_path`` names a byte-level vocabulary of the tokenizers library.
    """
    @F.arrow_udf("n_bytes long, n_tokens long, over_limit boolean")
    def count(values: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo, resync = pieces(tokenizer_path, True), _resync(tokenizer_path, chunk_chars, overlap_chars)
        for v in values:
            n_bytes = np.diff(buffers(v)[1])
            n = np.array([resync.count(x) if len(x) > chunk_chars else len(memo.encode(x)) // 4 for x in texts(v)], np.int64)
            yield pa.StructArray.from_arrays([pa.array(n_bytes), pa.array(n), pa.array(n > limit)],
                                             ["n_bytes", "n_tokens", "over_limit"])

    return per_row(docs, count(F.col(text_col)), ["n_bytes", "n_tokens", "over_limit"], keep)
