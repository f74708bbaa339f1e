"""Count tables of 64-bit hashes over a whole corpus, partitioned by hash.

Documents are dealt into buckets of bounded size.  Each bucket sends its sorted
distinct hashes with counts to the ranges of the hash, packed; each range adds
up equal hashes and sends every bucket the totals of its own, in their order.
A hash has one entry a bucket at most, so none is hot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fetchplan.llm.columns import buffers, release, row_blocks
from fetchplan.llm.hashing import count_words, word_hashes

BUCKET_BYTES = 8 << 20
RANGE_ROWS = 2_000_000
BLOCK_BYTES = 4 << 20
_BLOB = "part int, bucket int, n long, blob binary"


def text_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and word offsets of texts given as bytes, by blocks."""
    words, ends, before = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)], 0
    for a, b in row_blocks(offsets, BLOCK_BYTES):
        w, at = word_hashes(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        words.append(w)
        ends.append(at[1:] + before)
        before += len(w)
    return np.concatenate(words), np.concatenate(ends)


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """Bytes and words of all texts in column ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = words = 0
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            for a, b in row_blocks(offsets, BLOCK_BYTES):
                words += count_words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            size += int(offsets[-1])
        yield pa.RecordBatch.from_pydict({"size": pa.array([size], pa.int64()), "words": pa.array([words], pa.int64())})

    row = docs.select("text").mapInArrow(run, "size long, words long").agg(F.sum("size"), F.sum("words")).first()
    return int(row[0] or 0), int(row[1] or 0)


def deal(rows: DataFrame, n_buckets: int) -> DataFrame:
    """Documents (doc_id, text) by bucket, as compressed texts of each task's rows; read with ``open_bucket``."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = np.argsort(batch.column(2).to_numpy(), kind="stable")
            batch = batch.take(pa.array(order))
            bucket = batch.column(2).to_numpy()
            data, offsets = buffers(batch.column(1))
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]]) if len(bucket) else np.zeros(1, int)
            parts = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
            lists = [pa.array(cuts, pa.int32()), pa.array(np.diff(offsets))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[cuts[:-1]], pa.int32()), pa.ListArray.from_arrays(lists[0], batch.column(0)),
                 pa.ListArray.from_arrays(lists[0], lists[1]),
                 pa.array([pa.compress(data[offsets[a]:offsets[b]].tobytes(), codec="zstd", asbytes=True) for a, b in parts], pa.binary())],
                names=["bucket", "ids", "sizes", "texts"])

    bucket = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_buckets)).cast("int").alias("bucket")
    packed = rows.select("doc_id", "text", bucket).mapInArrow(
        run, f"bucket int, ids array<{kind}>, sizes array<long>, texts binary")
    return packed.repartition(n_buckets, "bucket")


def open_bucket(table: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """A bucket's document ids, the bytes of its texts and their offsets."""
    ids = pa.concat_arrays([x.flatten() for x in table.column("ids").chunks])
    sizes = [x.as_py() for x in table.column("sizes")]
    texts = [pa.decompress(x.as_py(), sum(n), codec="zstd", asbytes=True) if sum(n) else b""
             for x, n in zip(table.column("texts"), sizes, strict=True)]
    return ids, np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([k for n in sizes for k in n])]).astype(np.int64)


def _planes(x: np.ndarray, kind: str) -> bytes:
    x = x.astype(kind)
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def _from_planes(raw: np.ndarray, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def pack(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """Differences of sorted hashes and their counts by byte plane, compressed."""
    steps = np.diff(hashes, prepend=np.uint64(0))
    return pa.compress(_planes(steps, "<u8") + _planes(counts, "<u4"), codec="zstd", asbytes=True)


def unpack(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(pa.decompress(blob, 12 * n, codec="zstd", asbytes=True), np.uint8)
    return np.cumsum(_from_planes(raw[:8 * n], "<u8"), dtype=np.uint64), _from_planes(raw[8 * n:], "<u4").astype(np.int64)


def range_ends(n: int) -> np.ndarray:
    """Largest hash of each of n equal ranges."""
    return np.array([((k + 1) << 64) // n - 1 for k in range(n)], np.uint64)


def corpus_counts(dealt: DataFrame, count: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]], n_ranges: int) -> DataFrame:
    """Totals over the corpus of each bucket's hashes, as (part, bucket, n, blob) rows; read with ``totals_of``.

    ``count`` gives a bucket's sorted distinct hashes and their counts.
    """
    def explode(key: tuple, table: pa.Table) -> pa.Table:
        hashes, counts = count(table)
        cuts = np.concatenate([[0], np.searchsorted(hashes, range_ends(n_ranges), "right")])
        some = np.flatnonzero(np.diff(cuts))
        blobs = [pack(hashes[cuts[k]:cuts[k + 1]], counts[cuts[k]:cuts[k + 1]]) for k in some]
        del hashes, counts
        release()
        return pa.table({"part": pa.array(some, pa.int32()), "bucket": pa.array([key[0].as_py()] * len(some), pa.int32()),
                         "n": pa.array(np.diff(cuts)[some], pa.int64()), "blob": pa.array(blobs, pa.binary())})

    def total(key: tuple, table: pa.Table) -> pa.Table:
        sizes = table.column("n").to_numpy()
        got = [unpack(x.as_py(), int(n)) for x, n in zip(table.column("blob"), sizes, strict=True)]
        _, at = np.unique(np.concatenate([h for h, _ in got]), return_inverse=True)
        sums = np.bincount(at, weights=np.concatenate([c for _, c in got])).astype(np.int64)[at]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        blobs = [pa.compress(_planes(sums[a:b], "<i8"), codec="zstd", asbytes=True) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        del got, at, sums
        release()
        return pa.table({"part": table.column("part"), "bucket": table.column("bucket"), "n": table.column("n"),
                         "blob": pa.array(blobs, pa.binary())})

    parts = dealt.groupBy("bucket").applyInArrow(explode, _BLOB)
    return parts.repartition(n_ranges, "part").groupBy("part").applyInArrow(total, _BLOB)


def totals_of(table: pa.Table) -> np.ndarray:
    """Totals in the order of the bucket's sorted hashes, from its rows of ``corpus_counts``."""
    out = [np.zeros(0, np.int64)]
    rows = zip(table.column("part").to_pylist(), table.column("n").to_pylist(), table.column("blob"), strict=True)
    for _, n, blob in sorted(rows, key=lambda r: r[0]):
        out.append(_from_planes(np.frombuffer(pa.decompress(blob.as_py(), 8 * n, codec="zstd", asbytes=True), np.uint8), "<i8"))
    return np.concatenate(out)
