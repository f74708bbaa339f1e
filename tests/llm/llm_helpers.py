"""Fixture rows and plain counterparts shared by the tests."""

import random
import re

from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                          T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                          T.StructField("n_chars", T.LongType())])

#: Made-up vocabularies; each text draws words from one.
WORDS = {"aa": "bako lume tira sona veki dru mano pilu reta".split(), "zz": "ζωη mykt 漢字 grast schön žlut qip éta wyrm".split()}


def sentence(rng: random.Random, lang: str, n: int) -> str:
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "", ",", ".", "\n"]) for _ in range(n))


def corpus() -> list[tuple]:
    """Rows with nulls everywhere, empty, blank, tiny and long texts, exact and near copies, repeated rows."""
    rng = random.Random(5)
    rows = [(None, "no id here at all", "aa", None, None), (1, None, "aa", "s", 0), (2, "", None, "s", 0), (3, " \n\t ", "aa", None, 3),
            (4, "one", "aa", "s", None), (5, "one", "aa", "s", 3), (6, "One Two", None, None, 7), (7, "12 34 !!", "zz", "s", 8),
            (8, "<|endoftext|> can't stop\x00now  two", "aa", "s", 1), (9, "l" * 700, "aa", "s", 700)]
    for k in range(30):
        lang = "aa" if k % 2 else "zz"
        rows.append((10 + k, sentence(rng, lang, rng.randrange(5, 120)), lang, "hot" if k % 3 else "s", k))
    base = sentence(rng, "aa", 150).split(" ")
    for k in range(12):  # near copies in a chain of growing changes
        changed = list(base)
        for j in range(k):
            changed[5 + 11 * j] = f"new{j}"
        rows.append((50 + k, " ".join(changed), "aa", "s", 1))
    for k in range(8):  # exact copies
        rows.append((70 + k, " ".join(base[::-1]), "aa", "s", 1))
    rows.append((90, sentence(rng, "zz", 30_000), "zz", "s", 1))
    rows += [rows[12], rows[12], (rows[13][0], "other text of a repeated id", "aa", None, None)]
    return rows


def split(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def shingles(text, n):
    w = split(text)
    return frozenset(zip(*(w[k:] for k in range(n)), strict=False)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def roots(nodes, pairs):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {x: find(x) for x in nodes}
