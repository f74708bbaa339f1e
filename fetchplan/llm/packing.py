"""Sum-of-squares online packing of token sequences into windows.

Each task packs the documents it reads, in the order it reads them, so nothing
is shuffled.  A document's ids come from the memo of ``pieces.py`` plus the end
id.  Whole windows are cut off first; the rest goes online into the fill level
that least raises the sum of squares of the level array (how many open windows
stand at each fill), opening a new window where that is best; ties go to the
fuller level.  At the end of a task its open windows are emptied into full
ones by cutting, and the last run of ids is cut into powers of two, which need
no padding.

Memory: ids of open windows and of the window being closed, besides one text.
The number of open windows is bounded by ``max_open``: at that bound the open
windows are emptied into full ones, as at the end.  A lost task packs the same
input again to the same sequences; sequence ids carry the partition number.

Null and empty texts have the end id alone.  Rows that repeat a doc_id are
packed as documents of their own.  An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fetchplan.llm.columns import release, text_blocks
from fetchplan.llm.pieces import pieces

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
#: Open windows a task may hold (at 4096 ids of 4 bytes: 64 MB at most).
MAX_OPEN = 4096
#: Pieces of text a generation of the memo holds (about 250 bytes each, two generations).
MEMO = 700_000
BLOCK_BYTES = 4 << 20


class Packer:
    """Packs (doc, ids) one after another; ``done`` gathers pieces and, if asked, their ids."""

    def __init__(self, capacity: int, first_sequence: int, with_ids: bool = False, max_open: int = MAX_OPEN):
        self.capacity, self.next, self.with_ids, self.max_open = capacity, first_sequence, with_ids, max_open
        self.level = np.zeros(capacity + 1, np.int64)  # open windows by fill
        self.open: list[list] = [[] for _ in range(capacity)]  # stacks of open windows by fill; a window is a list of pieces
        self.done: list[tuple] = []

    def _close(self, window: list) -> None:
        at = 0
        for doc, start, ids, total in window:
            raw = ids.tobytes()
            row = (doc, start, len(ids), zlib.crc32(raw), total, self.next, at)
            self.done.append((*row, ids.tolist()) if self.with_ids else row)
            at += len(ids)
        self.next += 1

    def choose(self, size: int) -> int:
        """Fill level (0: a new window) whose use gives the least sum of squares; ties to the fuller."""
        cap, n = self.capacity, self.level
        to = n[size:cap + 1].copy()  # to[h]: windows at the fill that level h would come to
        cost = 2 * (to + 1) - 2 * n[:cap - size + 1]
        cost[cap - size] = 1 - 2 * n[cap - size]  # a full window leaves the array
        cost[1:][n[1:cap - size + 1] == 0] = np.iinfo(np.int64).max
        cost[0] = 2 * n[size] + 1
        return cap - size - int(np.argmin(cost[::-1]))

    def add(self, doc, ids: np.ndarray) -> None:
        cap, total = self.capacity, len(ids)
        whole = total // cap * cap
        for a in range(0, whole, cap):
            self._close([(doc, a, ids[a:a + cap], total)])
        size = total - whole
        if not size:
            return
        h = self.choose(size)
        window = self.open[h].pop() if h else []
        self.level[h] -= bool(h)
        window.append((doc, whole, ids[whole:].copy(), total))
        if h + size == cap:
            self._close(window)
        else:
            self.open[h + size].append(window)
            self.level[h + size] += 1
            if self.level.sum() >= self.max_open:
                self.flush(False)

    def flush(self, last: bool = True) -> None:
        """Empty the open windows into full ones, fullest first; ``last``: the rest into powers of two."""
        queue = [w for stack in reversed(self.open) for w in stack]
        self.open = [[] for _ in range(self.capacity)]
        self.level[:] = 0
        parts = [p for w in queue for p in w]
        left = sum(len(p[2]) for p in parts)
        sizes = [self.capacity] * (left // self.capacity)
        left %= self.capacity
        for k in reversed(range(self.capacity.bit_length())):
            if left >> k & 1:
                sizes.append(1 << k)
        if not last:
            sizes = sizes[:sum(s == self.capacity for s in sizes)]
        at, used = 0, 0  # piece, ids used of it
        for size in sizes:
            window, room = [], size
            while room:
                doc, start, ids, total = parts[at]
                take = min(room, len(ids) - used)
                window.append((doc, start + used, ids[used:used + take], total))
                room, used = room - take, used + take
                if used == len(ids):
                    at, used = at + 1, 0
            self._close(window)
        rest = [(d, s + used * (i == 0), x[used * (i == 0):], t) for i, (d, s, x, t) in enumerate(parts[at:])]
        if rest:
            fill = sum(len(p[2]) for p in rest)
            self.open[fill].append(rest)
            self.level[fill] += 1


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = 4096, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False, max_open: int = MAX_OPEN, memo: int = MEMO) -> DataFrame:
    """One row per piece: its document, place there, sequence and offset; ``with_ids`` adds the ids themselves.

    ``capacity`` is a power of two; ``tokenizer_path`` names a vocabulary of the
    tokenizers library that drops blanks.  ``memo`` bounds a worker's memory, not the
    result: a job that shares its workers with other stages takes a smaller one.
    """
    if capacity & capacity - 1:
        raise ValueError("capacity must be a power of two")
    names = COLUMNS + ["ids"] * with_ids
    types = [pa.int64()] * 7 + [pa.list_(pa.int32())] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(tokenizer_path, False, memo)
        packer = Packer(capacity, TaskContext.get().partitionId() << 33, with_ids, max_open)
        end = np.array([end_id], "<u4").tobytes()

        def out() -> pa.RecordBatch:
            rows, packer.done = packer.done, []
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            for a, b, some in text_blocks(batch.column(1), BLOCK_BYTES):
                for doc, text in zip(batch.column(0).slice(a, b - a).to_pylist(), some, strict=True):
                    packer.add(doc, np.frombuffer(known.encode(text) + end, "<u4"))
                    if len(packer.done) >= 10_000:
                        yield out()
                del some
            release()
        packer.flush()
        yield out()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA + ", ids array<int>" * with_ids)
