"""Words and word n-grams of many texts as 64-bit hashes, in numpy.

A-Z is lower-cased; words are runs of bytes other than blank, tab, line feed,
vertical tab, form feed and carriage return.
"""

from __future__ import annotations

import numpy as np

_LOW = np.arange(256, dtype=np.uint64) + 1
_LOW[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bytes hashed at a time; a longer run without a blank is hashed whole.
STEP = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS = np.cumprod(np.full(64, _BASE, np.uint64), dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        size = max(n, 2 * len(_POWERS))
        if size > 1 << 20:  # not kept
            return np.cumprod(np.full(n, _BASE, np.uint64), dtype=np.uint64)
        _POWERS = np.cumprod(np.full(size, _BASE, np.uint64), dtype=np.uint64)
    return _POWERS


def count_words(data: np.ndarray, offsets: np.ndarray) -> int:
    """Words of all texts together."""
    first = ~_BLANK[data]
    behind = np.ones(len(data) + 1, bool)
    behind[1:] = ~first
    behind[offsets] = True
    return int(np.count_nonzero(first & behind[:-1]))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and the number of words before each text (one more than texts)."""
    n = len(data)
    starts_at = np.zeros(n + 1, bool)
    starts_at[offsets] = True
    hashes, begins = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    a = 0
    while a < n:
        b = min(a + STEP, n)
        while b < n:  # end at a blank or a text's start
            ahead = data[b:b + STEP]
            stop = np.flatnonzero(_BLANK[ahead] | starts_at[b:b + len(ahead)])
            if len(stop):
                b += int(stop[0])
                break
            b += len(ahead)
        part = data[a:b]
        word = ~_BLANK[part]
        first = word.copy()
        first[1:] &= ~word[:-1] | starts_at[a + 1:b]
        begin = np.flatnonzero(first)
        if len(begin):
            at = np.flatnonzero(word)
            nth = np.cumsum(first)[at] - 1
            place = at - begin[nth]
            x = _LOW[part[at]] * _powers(int(place.max()) + 1)[place]
            hashes.append(mix(np.add.reduceat(x, np.searchsorted(at, begin))))
            begins.append(begin + a)
        a = b
    return np.concatenate(hashes), np.searchsorted(np.concatenate(begins), offsets)


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on, for all places but the last n - 1; other n, other hashes."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    size = len(words) - n + 1
    x = np.full(size, n, np.uint64)
    for k in range(n):
        x = mix(x * np.uint64(0xD6E8FEB86659FD93) + words[k:k + size])
    return x
