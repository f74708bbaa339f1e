"""Byte-level BPE encoding and decoding by a monoid tree reduction.

The pattern that splits text before the merges reads from left to right and
keeps no memory: what follows a match depends only on the text after it.  The
parse of a piece of text is therefore an element that can be joined with its
right neighbour's: matches that end short of the left piece's end stay as they
are, a window around the seam is parsed again, and from the first match end
that the window's parse shares with the right piece's own parse onward, the
right piece's tokens hold.  The window grows until there is such an end.

Texts up to ``leaf_chars`` are one leaf.  Longer ones are halved recursively;
an element holds its token ids and its match ends (character and token
position), so joins never look at more text than the window.  Decoding
concatenates the bytes of id ranges up the same tree.

Null and empty texts have no tokens.  Rows are independent of each other.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fetchplan.llm.columns import per_row, texts

#: Characters at a piece's end whose parse may change with what follows ("'l" + "l" is the longest wait).
LOOKAHEAD = 3
LEAF_CHARS = 4_096


class Codec:
    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.lengths = np.array([len(b) for b in self.bytes], dtype=np.int64)

    def encode_whole(self, text: str) -> np.ndarray:
        return np.asarray(self.encoding.encode_to_numpy(text, disallowed_special=()), dtype=np.uint32)

    # an element: ids, match ends in characters, tokens up to each match end
    def leaf(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = self.encode_whole(text)
        ends, sizes = [], []
        for m in self.pattern.finditer(text):
            ends.append(m.end())
            sizes.append(len(m[0].encode("utf-8", "replace")))
        upto = np.concatenate([[0], np.cumsum(self.lengths[ids])])
        return ids, np.array(ends, np.int64), np.searchsorted(upto, np.cumsum(np.array(sizes, np.int64)))

    def join(self, text: str, a: int, mid: int, b: int, left, right):
        """Element of text[a:b] from those of text[a:mid] and text[mid:b]."""
        lids, lends, ltoks = left
        rids, rends, rtoks = right
        keep = int(np.searchsorted(lends, mid - a - LOOKAHEAD, "right"))  # left matches that nothing later can change
        start, start_tok = (int(lends[keep - 1]), int(ltoks[keep - 1])) if keep else (0, 0)
        size = 64
        while True:
            stop = min(mid + size, b)
            wids, wends, wtoks = self.leaf(text[a + start:stop])
            wabs = wends + a + start
            sure = wabs <= (stop - LOOKAHEAD if stop < b else stop)
            common = np.intersect1d(wabs[sure], rends + mid)
            if len(common) or stop == b:
                break
            size *= 2
        if not len(common):  # the window reached the end of the right piece
            cut, used, shift = len(wends), len(wids), len(rends)
            rest = rids[:0], rends[:0], rtoks[:0]
        else:
            at = int(common[0])
            cut = int(np.searchsorted(wabs, at)) + 1
            used = int(wtoks[cut - 1])
            shift = int(np.searchsorted(rends + mid, at)) + 1
            rest = rids[rtoks[shift - 1]:], rends[shift:] + (mid - a), rtoks[shift:] - rtoks[shift - 1]
        ids = np.concatenate([lids[:start_tok], wids[:used], rest[0]])
        ends = np.concatenate([lends[:keep], wends[:cut] + start, rest[1]])
        toks = np.concatenate([ltoks[:keep], wtoks[:cut] + start_tok, rest[2] + start_tok + used])
        return ids, ends, toks

    def tree(self, text: str, a: int, b: int, leaf_chars: int):
        if b - a <= leaf_chars:
            return self.leaf(text[a:b])
        mid = (a + b) // 2
        return self.join(text, a, mid, b, self.tree(text, a, mid, leaf_chars), self.tree(text, mid, b, leaf_chars))

    def encode(self, text: str, leaf_chars: int = LEAF_CHARS) -> np.ndarray:
        return self.encode_whole(text) if len(text) <= leaf_chars else self.tree(text, 0, len(text), leaf_chars)[0]

    def decode(self, ids: np.ndarray, leaf_ids: int = LEAF_CHARS) -> bytes:
        if len(ids) <= leaf_ids:
            return b"".join(map(self.bytes.__getitem__, ids.tolist()))
        mid = len(ids) // 2
        return self.decode(ids[:mid], leaf_ids) + self.decode(ids[mid:], leaf_ids)


@lru_cache(maxsize=4)
def codec(ranks_path: str, pattern: str) -> Codec:
    return Codec(ranks_path, pattern)


def bpe_encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", keep: list[str] | None = None,
               leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """Adds ``ids`` (array<int>) to each document.  A narrow job without a shuffle."""
    @F.arrow_udf("ids array<int>")
    def encode(values: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(ranks_path, pattern)
        for v in values:
            ids = [c.encode(x, leaf_chars) for x in texts(v)]
            yield pa.StructArray.from_arrays([_lists(ids)], ["ids"])

    return per_row(docs, encode(F.col(text_col)), ["ids"], keep)


def bpe_decode(rows: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Adds ``decoded`` (binary) to rows with token ids; null ids decode to no bytes."""
    @F.arrow_udf("decoded binary")
    def decode(values: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(ranks_path, pattern)
        for v in values:
            out = [c.decode(np.array(x or [], dtype=np.uint32)) for x in v.to_pylist()]
            yield pa.StructArray.from_arrays([pa.array(out, type=pa.binary())], ["decoded"])

    return per_row(rows, decode(F.col(ids_col)), ["decoded"], keep)


def bpe_round_trip(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", keep: list[str] | None = None,
                   leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """Adds ``n_tokens`` and the SHA-256 of the ids (little-endian unsigned 32-bit) and of the decoded bytes."""
    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(values: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(ranks_path, pattern)
        for v in values:
            n, a, b = [], [], []
            for x in texts(v):
                ids = c.encode(x, leaf_chars).astype("<u4")
                n.append(len(ids))
                a.append(hashlib.sha256(ids.tobytes()).hexdigest())
                b.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                                             ["n_tokens", "ids_sha256", "decoded_sha256"])

    return per_row(docs, digest(F.col(text_col)), ["n_tokens", "ids_sha256", "decoded_sha256"], keep)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate([*arrays, np.zeros(0, np.uint32)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
