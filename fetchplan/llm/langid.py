"""Language ID by cross-parsing entropy.

Per language, a bounded sample of labelled text becomes a suffix automaton.  A
text is cross-parsed against each: the longest match from the current place is
one phrase, then parsing goes on behind it; a byte that the language has never
shown is a phrase of its own.  The phrases, times log2 of the reference's length
and divided by the text's length, estimate the cross entropy in bits a byte; the
language that needs the fewest wins (ties: the smaller name).  The score is one
less the ratio of the best to the second best.

Texts are lower-cased, and every run of ASCII non-letters reads as one blank.
Whole texts are parsed, in lanes of ``LANE`` bytes that numpy steps through
side by side and joins where their phrases fall together: the phrases are those
of one parse from the text's start.

Learning takes, per language, at most ``SAMPLE_TEXTS`` different texts (the
smallest hashes), a stretch of each, ``SAMPLE_BYTES`` bytes in all; these bounds are
parameters.  Rows without text, letters or language are not learned from.

Null text, or text without a letter: ``und`` with score 0, as is every text where
nothing was learned.  Rows are independent; repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fetchplan.llm.columns import per_row, release, text_blocks

SAMPLE_TEXTS = 64
SAMPLE_BYTES = 16_384
LANE = 2048
#: Shares of a language whose smallest hashes are picked first.
SHARES = 64
BLOCK_BYTES = 4 << 20
LETTER = r"\p{L}"

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[:128] = 32
_CLASS[97:123] = np.arange(97, 123)


def normalise(raw: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes with runs of ASCII non-letters as one blank, and each text's offsets."""
    coded = [x.lower().encode("utf-8", "replace") for x in raw]
    sizes = np.cumsum([0, *map(len, coded)])
    data = _CLASS[np.frombuffer(b"".join(coded), dtype=np.uint8)]
    blank = data == 32
    keep = np.ones(len(data), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[sizes[:-1][np.diff(sizes) > 0]] = True
    return data[keep], np.concatenate([[0], np.cumsum(keep)])[sizes]


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings; state 0 is the root."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


class Parser:
    """Counts phrases of many texts against all references at once.

    One table holds the transitions of all automata over the byte classes that occur; state 0 has none.
    States are stored times the number of classes.
    """

    def __init__(self, references: tuple[tuple[str, bytes], ...]):
        self.languages = [name for name, _ in references]
        self.weight = np.log2([len(r) + 1 for _, r in references])
        seen = sorted({c for _, r in references for c in r})
        self.code = np.zeros(256, np.int32)
        self.code[seen] = np.arange(1, len(seen) + 1)
        width = len(seen) + 1
        rows, self.first = [np.zeros((1, width), np.int32)], np.zeros((len(references), width), np.int32)
        at = 1
        for k, (_, r) in enumerate(references):
            automaton = suffix_automaton(r)
            part = np.zeros((len(automaton), width), np.int32)
            for s, to in enumerate(automaton):
                for c, t in to.items():
                    part[s, self.code[c]] = (t + at) * width
            rows.append(part)
            self.first[k] = part[0]
            at += len(automaton)
        self.table = np.concatenate(rows).ravel()

    def phrases(self, data: np.ndarray, offsets: np.ndarray, lane: int = LANE) -> np.ndarray:
        """Phrases by text and language, as one parse of each whole text gives them; an empty text has none.

        Texts of several lanes are parsed in all their lanes side by side, each as if a phrase began at its start.  The parse that
        comes over from the lane before goes on until it begins a phrase where the lane's own parse does: from there on both
        are the same.  A text with a lane that never falls in is parsed in one lane.
        """
        codes, sizes = self.code[data], np.diff(offsets)
        out = np.zeros((len(sizes), len(self.languages)))
        short = np.flatnonzero((sizes > 0) & (sizes <= lane))
        counts, order, *_ = self._steps(codes, offsets[:-1][short], sizes[short])
        out[short[order]] = counts.T
        long = np.flatnonzero(sizes > lane)
        if not len(long):
            return out
        lanes = -(-sizes[long] // lane)
        of = np.repeat(np.arange(len(long)), lanes)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        start = offsets[:-1][long][of] + nth * lane
        length = np.minimum(lane, offsets[1:][long][of] - start)
        counts, order, state, begins = self._steps(codes, start, length, True)
        place = np.argsort(order)  # where a lane stands, by its number
        later = np.flatnonzero(nth > 0)
        lost = self._join(codes, begins, counts, state[:, place[later - 1]], place[later], start[order], length[order])
        for row, total in zip(counts, out.T, strict=True):
            total[long] = np.bincount(of[order], weights=row, minlength=len(long))
        goes_on = (nth < lanes[of] - 1)[order]  # behind a text's last lane nothing depends on it
        for k in long[np.unique(of[order][lost[goes_on[lost]]])]:
            text = data[offsets[k]:offsets[k + 1]]
            out[k] = self.phrases(text, np.array([0, len(text)]), lane=len(text))[0]
        return out

    def _steps(self, codes: np.ndarray, start: np.ndarray, length: np.ndarray, record: bool = False):
        """Phrases of lanes by language, longest lane first; that order; the last states; where phrases begin (step, language, lane)."""
        order = np.argsort(-length, kind="stable")
        start, length = start[order], length[order]
        counts = np.ones((len(self.languages), len(start)), np.int32)  # the phrase that begins with the lane
        state, begins = self.first[:, codes[start]], None
        if record:
            begins = np.ones((int(length[0]), len(self.languages), len(start)), bool)
        if len(start):
            going = len(start) - np.searchsorted(length[::-1], np.arange(1, length[0] + 1), "left")
            for t in range(1, int(length[0])):
                k = int(going[t])
                c = codes[start[:k] + t]
                to = self.table[state[:, :k] + c]
                miss = to == 0
                counts[:, :k] += miss
                state = np.where(miss, self.first[:, c], to)
                if record:
                    begins[t, :, :k] = miss
        return counts, order, state, begins

    def _join(self, codes, begins, counts, state, own, start, length) -> np.ndarray:
        """Corrects the counts of lanes ``own`` that go on from a state; gives those that never fall in."""
        lang, at = (x.ravel() for x in np.meshgrid(np.arange(len(self.languages)), np.arange(len(own)), indexing="ij"))
        into, own = state[lang, at], own[at]
        t, lost = 0, [np.zeros(0, np.int64)]
        while len(own):
            over = t >= length[own]
            if over.any():
                lost.append(own[over])
                lang, into, own = lang[~over], into[~over], own[~over]
                continue
            c = codes[start[own] + t]
            to = self.table[into + c]
            miss, here = to == 0, begins[t, lang, own]
            counts[lang, own] += miss.astype(np.int32) - here
            into = np.where(miss, self.first[lang, c], to)
            going = ~(miss & here)
            lang, into, own = lang[going], into[going], own[going]
            t += 1
        return np.concatenate(lost)

    def predict(self, raw: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best language and the score of each text."""
        data, offsets = normalise(raw)
        size = np.maximum(1, np.diff(offsets))
        bits = self.phrases(data, offsets) * self.weight / size[:, None]
        best = np.argmin(bits, axis=1)
        least = bits[np.arange(len(raw)), best]
        if len(self.languages) > 1:
            second = np.partition(bits, 1, axis=1)[:, 1]
        else:
            second = np.full(len(raw), self.weight[0])
        with np.errstate(invalid="ignore", divide="ignore"):
            score = np.where(second > 0, 1 - least / second, 0.0)
        return best, np.clip(score, 0.0, 1.0)


@lru_cache(maxsize=1)
def parser(references: tuple) -> Parser:
    return Parser(references)


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_texts: int = SAMPLE_TEXTS,
          sample_bytes: int = SAMPLE_BYTES) -> tuple[tuple[str, bytes], ...]:
    """Reference text per language; the driver gets at most ``sample_texts`` stretches of each language."""
    text, lang = F.col(text_col), F.col(lang_col)
    rows = (labelled.where(lang.isNotNull() & text.rlike(LETTER))
            .select(lang.alias("lang"), F.xxhash64(text).alias("h"), text.alias("text")))
    # the smallest hashes of each share of a language, then of the language: no task gets more than its shares' smallest
    chosen = rows.select("lang", "h").distinct().withColumn("share", F.pmod(F.xxhash64("h"), F.lit(SHARES)))
    for part in (["lang", "share"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*part).orderBy("h"))
        chosen = chosen.withColumn("rank", rank).where(F.col("rank") <= sample_texts).drop("rank")
    chosen = chosen.select("lang", "h").collect()
    if not chosen:
        return ()
    keys = {(r["lang"], r["h"]) for r in chosen}
    begin = F.pmod("h", F.greatest(F.length("text") - sample_bytes, F.lit(1)).cast("long")).cast("int") + 1
    some = (rows.where(F.col("h").isin(sorted({h for _, h in keys})))
            .groupBy("lang", "h").agg(F.min(F.substring(F.col("text"), begin, F.lit(sample_bytes))).alias("t")).collect())
    by: dict[str, list] = {}
    for r in sorted(some, key=lambda r: r["h"]):
        if (r["lang"], r["h"]) in keys:
            by.setdefault(r["lang"], []).append(normalise([r["t"]])[0].tobytes())
    out = []
    for name, parts in sorted(by.items()):
        room = sample_bytes
        picked = []
        for left, p in zip(range(len(parts), 0, -1), sorted(parts, key=len), strict=True):  # short ones whole
            picked.append(p[:room // left])
            room -= len(picked[-1])
        out.append((name, b" ".join(picked)))
    return tuple(out)


def held_out(doc_id: Column) -> Column:
    """Documents kept from learning: crc32 of the id as text, mod 4, is 2; a null id isn't one."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, references: tuple[tuple[str, bytes], ...], text_col: str = "text",
             keep: list[str] | None = None) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to each document.  A narrow job without a shuffle."""
    @F.arrow_udf("lang_pred string, score double")
    def predict(values: Iterator[pa.Array]) -> Iterator[pa.Array]:
        p = parser(references) if references else None
        for v in values:
            names, scores = [None] * len(v), np.zeros(len(v))
            if p:
                for a, b, raw in text_blocks(v, BLOCK_BYTES):
                    best, scores[a:b] = p.predict(raw)
                    names[a:b] = [p.languages[k] for k in best]
                    del raw
            release()
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], ["lang_pred", "score"])

    text = F.col(text_col)
    spoken = F.coalesce(text.rlike(LETTER), F.lit(False))
    out = per_row(docs.withColumn("__llm_spoken", spoken), predict(text), ["lang_pred", "score"],
                  [*(docs.columns if keep is None else keep), "__llm_spoken"])
    known = F.col("__llm_spoken") & F.col("lang_pred").isNotNull()
    return out.select(*[F.col(f"`{c}`") for c in out.columns if c not in ("__llm_spoken", "lang_pred", "score")],
                      F.when(known, F.col("lang_pred")).otherwise("und").alias("lang_pred"),
                      F.when(known, F.col("score")).otherwise(0.0).alias("score"))
