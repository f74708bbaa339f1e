"""Stupid-backoff scores from n-gram counts over the whole corpus.

Documents are dealt into buckets by hash.  A bucket explodes its n-grams of all
orders into one sorted table of distinct 64-bit hashes with counts, cut into
ranges of the hash: the count tables are partitioned by hash.  A range's task
sums the counts of equal hashes over all buckets and hands each bucket the
totals of its own n-grams, in their order.  Joined with these, the bucket's
documents look up every n-gram and sum their scores.

Each document is scored against all others: its own counts are taken off
first (``leave_out``).  For a word w after the context c::

    S(w | c) = count(c w) / count(c)          if count(c w) > 0
             = alpha * S(w | c less its first word)   else
    S(w)     = max(count(w), 1/2) / words of the corpus

Tables travel as packed ranges (differences of sorted hashes by byte plane,
compressed), one row for each bucket and range that meet.  An n-gram has one entry
a bucket at most, so no word or passage is hot; bucket and range sizes are
bounded by parameters, at any size of corpus.  Distinct n-grams that share a
64-bit hash share their count.

Words: see ``hashing.py``.  Null, empty and blank texts have no words, score
0 and no mean (null).  Repeated rows are documents of their own, each the
other's corpus.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fetchplan.llm.columns import release
from fetchplan.llm.hash_tables import BUCKET_BYTES, RANGE_ROWS, corpus_counts, corpus_size, deal, open_bucket, text_words, totals_of
from fetchplan.llm.hashing import ngrams

ORDER = 3
ALPHA = 0.4


def grams(words: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams that lie within one text, and the place of their first word."""
    x = ngrams(words, n)
    doc = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    at = np.flatnonzero(doc[:len(x)] == doc[n - 1:]) if n > 1 else np.arange(len(x))
    return x[at], at


def tables(words: np.ndarray, ends: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-grams of all orders, and their counts."""
    return np.unique(np.concatenate([grams(words, ends, n)[0] for n in range(1, order + 1)]), return_counts=True)


def own_counts(entry: np.ndarray, doc: np.ndarray, n_entries: int) -> np.ndarray:
    """How often each n-gram (by its entry in the table) occurs in its own document."""
    key = doc * np.int64(max(1, n_entries)) + entry
    by = np.argsort(key)
    new = np.ones(len(key), bool)
    new[1:] = key[by][1:] != key[by][:-1]
    own = np.empty(len(key), np.int64)
    own[by] = np.diff(np.append(np.flatnonzero(new), len(key)))[np.cumsum(new) - 1]
    return own


def score_texts(words: np.ndarray, ends: np.ndarray, order: int, alpha: float, totals: np.ndarray, corpus: int,
                leave_out: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sum of log scores and words scored at the full order, by text; ``totals`` belong to the sorted n-grams of ``tables``."""
    n_words, doc = np.diff(ends), np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    found = [grams(words, ends, n) for n in range(1, order + 1)]
    place = np.concatenate([at + n for n, (_, at) in enumerate(found)])  # of each n-gram's last word
    entry = np.unique(np.concatenate([x for x, _ in found]), return_inverse=True)[1]
    total = totals[entry] if len(entry) else np.zeros(0, np.int64)
    if leave_out:
        total = total - 1  # itself; where the corpus has it once, that was all
        again = np.flatnonzero(total > 0)
        total[again] -= own_counts(entry[again], doc[place[again]], len(totals)) - 1
    counts, a = [], 0  # by order, at the place of the n-gram's last word
    for x, _ in found:
        c = np.zeros(len(words), np.float64)
        c[place[a:a + len(x)]] = total[a:a + len(x)]
        counts.append(c)
        a += len(x)
    rest = np.maximum(corpus - n_words * leave_out, 1)[doc].astype(np.float64)
    score = np.log(np.maximum(counts[0], 0.5)) - np.log(rest)
    first = np.arange(len(words)) - np.repeat(ends[:-1], n_words)  # words before, in the text
    full = counts[0] > 0
    for n in range(2, order + 1):  # from the shortest context up: the longest seen wins
        has, full = first >= n - 1, counts[n - 1] > 0
        score = np.where(has, score + np.log(alpha), score)
        at = np.flatnonzero(full)
        score[at] = np.log(counts[n - 1][at]) - np.log(counts[n - 2][at - 1])
    size = len(ends) - 1
    return np.bincount(doc, weights=score, minlength=size), np.bincount(doc, weights=full, minlength=size).astype(np.int64)


def backoff_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, alpha: float = ALPHA,
                   leave_out: bool = True, bucket_bytes: int = BUCKET_BYTES, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, n_words, n_full (words whose whole context was met), log_score (sum of natural logs) and mean_log_score."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size, corpus = corpus_size(rows)
    n_ranges = max(1, -(-corpus * order // range_rows))
    dealt = deal(rows, max(1, -(-size // bucket_bytes)))

    def count(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        _, data, offsets = open_bucket(table)
        return tables(*text_words(data, offsets), order)

    def score(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        ids, data, offsets = open_bucket(left)
        words, ends = text_words(data, offsets)
        sums, full = score_texts(words, ends, order, alpha, totals_of(right), corpus, leave_out)
        del words, data, offsets
        release()
        n = np.diff(ends)
        mean = np.divide(sums, n, out=np.zeros(len(n)), where=n > 0)
        return pa.table({"doc_id": ids, "n_words": pa.array(n, pa.int64()), "n_full": pa.array(full, pa.int64()),
                         "log_score": pa.array(sums, pa.float64()), "mean_log_score": pa.array(mean, pa.float64(), mask=n == 0)})

    counted = corpus_counts(dealt, count, n_ranges)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("bucket").cogroup(counted.groupBy("bucket")).applyInArrow(
        score, f"doc_id {kind}, n_words long, n_full long, log_score double, mean_log_score double")
