"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One shared weight per hashed text feature gives a latent quality; ordered
thresholds cut it into grades: P(grade >= k) = sigmoid(latent - threshold_k).
The expected grade is the sum of these, and the tail probability of the top
grade selects documents.

Features are whether a lower-cased word (outer ASCII punctuation stripped)
occurs, hashed to ``2**BITS`` buckets, and binned shares of small letters,
capitals, digits, punctuation, blanks and non-ASCII bytes, of repeated lines, of
words equal to the one before, and of different words.  A bucket takes part if
at least ``MIN_DOCS`` fitted documents show it and its share differs between
grades below and above some threshold by ``MIN_Z`` standard errors; others have
weight 0.  Weights are at most 0: features count against a document only, so
a short text is not turned away for lacking signs of quality.

The model is fitted on a bounded sample of rated documents (``FIT_ROWS``, by
hash of the id; a parameter); scoring covers all whole texts.  A document's
rating is its lowest among repeated ratings; null ratings don't count.  With
no ratings all thresholds are 0 and so every non-empty text has probability 0.5.
Null and empty texts have expected grade 0 and probability 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fetchplan.llm.columns import per_row, release, text_blocks, texts

BITS = 20
FIT_ROWS = 12_000
MIN_DOCS = 6
MIN_Z = 4.5
ROUNDS = 2000
#: Shares of bytes by kind, and how many bytes of them each text is given, so that a few bytes don't make a share.
USUAL = (0.80, 0.02, 0.01, 0.02, 0.15, 0.0)
USUAL_BYTES = 64
#: Shares of repeated lines and words that count as features when reached.
REPEATS = (0.05, 0.1, 0.2, 0.4)
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
GRADES = 3
BLOCK_BYTES = 4 << 20


class Features:
    """Bucket numbers of texts; the memo of words is bounded and does not change results."""

    MEMO = 100_000

    def __init__(self, bits: int):
        self.mask, self.memo = (1 << bits) - 1, {}
        kinds = np.zeros(256, np.int64)
        kinds[128:] = 5
        for c in range(128):
            x = chr(c)
            kinds[c] = 0 if x.islower() else 1 if x.isupper() else 2 if x.isdigit() else 4 if x.isspace() else 3
        self.kinds = kinds

    def _word(self, word: str) -> int:
        return zlib.crc32(b"w" + word.strip(PUNCTUATION).lower().encode("utf-8", "replace")) & self.mask

    def _shape(self, name: str, value: float) -> int:
        return zlib.crc32(f"s{name}:{int(value * 20)}".encode()) & self.mask

    def of(self, text: str) -> np.ndarray:
        words = text.split()
        distinct = set(words)
        memo = self.memo
        try:
            found = [memo[w] for w in distinct]
        except KeyError:
            if len(memo) > self.MEMO:
                memo.clear()
            found = []
            for w in distinct:
                b = memo.get(w)
                if b is None:
                    b = self._word(w)
                    if len(w) <= 64:
                        memo[w] = b
                found.append(b)
        coded = text.encode("utf-8", "replace")
        share = np.bincount(np.frombuffer(coded, np.uint8), minlength=256)
        share = np.bincount(self.kinds, weights=share, minlength=6) + USUAL_BYTES * np.array(USUAL)
        share /= len(coded) + USUAL_BYTES
        lines = [x for x in text.split("\n") if x]
        found += [self._shape(f"k{k}", x) for k, x in enumerate(share.tolist())]
        again = sum(map(eq, words, islice(words, 1, None))) / max(32, len(words))
        for name, value in (("lines", 1 - len(set(lines)) / len(lines) if lines else 0.0), ("runs", again)):
            found += [self._shape(name, step) for step in REPEATS if value >= step]
        found.append(self._shape(f"words{len(words).bit_length()}", len(distinct) / max(1, len(words))))
        return np.unique(np.array(found, np.int64))


@lru_cache(maxsize=2)
def features(bits: int) -> Features:
    return Features(bits)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Model:
    """Weights by bucket (float32) and ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def tails(self, latent: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..., by row."""
        return _sigmoid(latent[:, None] - self.thresholds)


def telling(flat: np.ndarray, grade_of: np.ndarray, grades: np.ndarray, n_grades: int, size: int, min_docs: int,
            min_z: float) -> np.ndarray:
    """Whether each bucket's share of documents differs enough between the grades at and below some threshold."""
    docs = np.bincount(grades, minlength=n_grades)
    shown = np.stack([np.bincount(flat[grade_of == k], minlength=size) for k in range(n_grades)])
    total, best = shown.sum(axis=0), np.zeros(size)
    p = total / max(1, len(grades))
    for k in range(1, n_grades):
        above, below = docs[k:].sum(), docs[:k].sum()
        if above and below:
            error = np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / above + 1 / below))
            best = np.maximum(best, np.abs(shown[k:].sum(axis=0) / above - shown[:k].sum(axis=0) / below) / error)
    return (total >= min_docs) & (best >= min_z)


def fit_rows(rows: list[np.ndarray], grades: np.ndarray, n_grades: int, bits: int = BITS, rounds: int = ROUNDS,
             min_docs: int = MIN_DOCS, min_z: float = MIN_Z, ridge: float = 1e-6, rate: float = 0.1) -> Model:
    """Adam on the cumulative-link likelihood, grades weighted by the inverse root of their frequency."""
    weights, cuts = np.zeros(1 << bits, np.float64), n_grades - 1
    if not len(rows):
        return Model(weights.astype(np.float32), np.zeros(cuts))
    flat = np.concatenate(rows)
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    used = telling(flat, grades[of], grades, n_grades, 1 << bits, min_docs, min_z)
    freq = np.bincount(grades, minlength=n_grades)
    w = (1 / np.sqrt(np.maximum(freq, 1)))[grades]
    same: dict[tuple, float] = {}  # documents alike in grade and features are one row
    for r, grade_, weight in zip(rows, grades.tolist(), w.tolist(), strict=True):
        key = (grade_, r[used[r]].tobytes())
        same[key] = same.get(key, 0.0) + weight
    rows = [np.frombuffer(x, flat.dtype) for _, x in same]
    grades, w = np.array([k for k, _ in same]), np.array(list(same.values()))
    w /= w.sum()
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    names, at = np.unique(np.concatenate(rows), return_inverse=True)
    theta = np.concatenate([np.zeros(len(names)), [-1.0], np.zeros(cuts - 1)])  # weights, first threshold, log gaps
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    k = len(names)
    for t in range(1, rounds + 1):
        thresholds = theta[k] + np.concatenate([[0.0], np.cumsum(np.exp(theta[k + 1:]))])
        latent = np.bincount(of, weights=theta[at], minlength=len(rows))
        s = np.concatenate([np.ones((len(rows), 1)), _sigmoid(latent[:, None] - thresholds), np.zeros((len(rows), 1))], axis=1)
        slope = s * (1 - s)
        i = np.arange(len(rows))
        p = np.maximum(s[i, grades] - s[i, grades + 1], 1e-12)
        up, down = slope[i, grades] / p, slope[i, grades + 1] / p
        g_latent = -w * (up - down)
        g_cut = np.array([np.sum(w * (up * (grades == c + 1) - down * (grades == c))) for c in range(cuts)])
        gaps = np.exp(theta[k + 1:])
        g = np.concatenate([np.bincount(at, weights=g_latent[of], minlength=k) + ridge * theta[:k], [g_cut.sum()],
                            [gaps[j] * g_cut[j + 1:].sum() for j in range(cuts - 1)]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        theta[:k] = np.minimum(theta[:k], 0.0)
    weights[names] = theta[:k]
    return Model(weights.astype(np.float32), theta[k] + np.concatenate([[0.0], np.cumsum(np.exp(theta[k + 1:]))]))


def grade(quality: Column, toxic: Column) -> Column:
    """0: rated poor; 1: rated good but toxic; 2: good.  Null where quality is null."""
    return F.when(quality == 0, 0).when(F.coalesce(toxic, F.lit(0)) != 0, 1).when(quality.isNotNull(), 2)


def fit(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade",
        n_grades: int = GRADES, fit_rows_limit: int = FIT_ROWS, bits: int = BITS) -> Model:
    """Fit on at most ``fit_rows_limit`` rated documents; the driver holds their bucket numbers.

    The sample is the ``fit_rows_limit`` rated ids of smallest hash (a bounded
    set of ids, so it is broadcast); of rows that share an id one is taken.
    """
    rated = (ratings.where(F.col(grade_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.min(grade_col).cast("int").alias("g")))
    sample = rated.orderBy(F.xxhash64("id"), "id").limit(fit_rows_limit)

    @F.arrow_udf("array<int>")
    def buckets(values: Iterator[pa.Array]) -> Iterator[pa.Array]:
        f = features(bits)
        for v in values:
            yield pa.array([f.of(x).tolist() for x in texts(v)], type=pa.list_(pa.int32()))

    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .where(F.coalesce(F.length("text"), F.lit(0)) > 0)
            .join(F.broadcast(sample), "id").groupBy("id", "g").agg(F.min("text").alias("text"))
            .select("id", "g", buckets("text").alias("b")).toArrow())
    rows = rows.sort_by("id")  # the same sums whatever the order of arrival
    lists = rows.column("b").combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks)
    flat, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy()
    flat, ends = flat.astype(np.int64), ends - (ends[0] if len(ends) else 0)
    return fit_rows([flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)],
                    rows.column("g").to_numpy().astype(np.int64), n_grades, bits)


def classify(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None,
             least: float = 0.5) -> DataFrame:
    """Adds ``expected_grade``, ``tail_probability`` (of the top grade) and ``selected`` (at least ``least``).

    A narrow job; the broadcast model holds ``2**BITS`` weights whatever the input.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))
    bits = int(len(model.weights)).bit_length() - 1

    @F.arrow_udf("expected_grade double, tail_probability double, selected boolean")
    def score(values: Iterator[pa.Array]) -> Iterator[pa.Array]:
        f, m = features(bits), Model(*shared.value)
        for v in values:
            latent, empty = np.zeros(len(v)), np.zeros(len(v), bool)
            for a, b, raw in text_blocks(v, BLOCK_BYTES):
                latent[a:b] = [m.weights[f.of(x)].sum(dtype=np.float64) for x in raw]
                empty[a:b] = [not x for x in raw]
                del raw
            tails = m.tails(latent)
            tails[empty] = 0.0
            release()
            yield pa.StructArray.from_arrays([pa.array(tails.sum(axis=1)), pa.array(tails[:, -1].copy()), pa.array(tails[:, -1] >= least)],
                                             ["expected_grade", "tail_probability", "selected"])

    return per_row(docs, score(F.col(text_col)), ["expected_grade", "tail_probability", "selected"], keep)
