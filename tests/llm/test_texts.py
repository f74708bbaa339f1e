"""Token counts, license scans, byte-level BPE and packing against the libraries and plain code."""

import base64
import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from fetchplan.llm import bpe, license_scan, packing, pieces, token_counts

BYTE_JSON, WORD_JSON, RANKS = (P.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json", "byte_bpe_50k.tiktoken"))


def odd_texts():
    rng = random.Random(1)
    bits = ["a", "b", "'", "'l", "l", " ", "  ", "\n", "\t", "1", "23", "é", "漢", "!", "..", "<|endoftext|>", "<|endo", "\x1c", "Σ", "̈",
            "ing", " the", "😀", "'ll", "'re", "　", "\x85"]
    made = ["".join(rng.choice(bits) for _ in range(rng.randrange(300))) for _ in range(150)]
    return made + ["", "a" * 3000, "  " * 500, "x" * 700 + " " + "1" * 900, "\n" * 300 + "b"]


@pytest.fixture(scope="module")
def byte_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTE_JSON)


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_pieces_encode_as_the_library(byte_tokenizer):
    from tokenizers import Tokenizer

    for path, keeps in ((BYTE_JSON, True), (WORD_JSON, False)):
        whole, memo = Tokenizer.from_file(path), pieces.Pieces(path, keeps)
        memo.MEMO = 50
        for x in odd_texts():
            assert np.frombuffer(memo.encode(x), "<u4").tolist() == ids(whole, x)
        assert not any(len(p) > memo.LONG for p in memo.ids)


@pytest.mark.parametrize("chunk,overlap", [(40, 5), (64, 1), (300, 32)])
def test_resync_counts_whole_texts(byte_tokenizer, chunk, overlap):
    r = token_counts.Resync(byte_tokenizer, chunk, overlap)
    for x in odd_texts():
        assert r.count(x) == len(ids(byte_tokenizer, x))
    assert r.widened > 0


class Counting:
    """A tokenizer that tells how much text it was given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, []

    def encode(self, text, **how):
        self.given.append(text)
        return self.tokenizer.encode(text, **how)

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)


@pytest.mark.parametrize("chunk,overlap", [(40, 5), (64, 1), (300, 32)])
def test_resync_through_the_memo(byte_tokenizer, chunk, overlap):
    memo = pieces.Pieces(BYTE_JSON, True)
    memo.LONG = 20
    r = token_counts.Resync(byte_tokenizer, chunk, overlap, memo)
    for x in [*odd_texts(), "wörd " * 400 + "y" * 900 + " end\n\n  of it." * 50]:
        assert r.count(x) == len(ids(byte_tokenizer, x))
    assert r.widened > 0


def test_chunks_are_encoded_through_the_memo(byte_tokenizer):
    """op1: a chunk's ordinary words do not go through the library with offsets each time."""
    seen = Counting(byte_tokenizer)
    r = token_counts.Resync(seen, 300, 32, pieces.Pieces(BYTE_JSON, True))
    text = "some words, once more; " * 200 + "z" * 700 + " and so on" * 100
    assert r.count(text) == len(ids(byte_tokenizer, text))
    assert set("".join(seen.given)) <= {"z", " "}


def test_punctuation_behind_letters_is_split_off():
    """op1, op5: a word's letters and the marks behind it are encoded apart, so few pieces go through the whole tokenizer."""
    for path, keeps in ((BYTE_JSON, True), (WORD_JSON, False)):
        memo = pieces.Pieces(path, keeps)
        seen = memo.tokenizer = Counting(memo.tokenizer)
        text = " ".join(f"{w}{end}" for w in ("alpha", "Übung", "Beta", "gamma") for end in ("", "!!", "***", ".%%%", ")", "&"))
        assert np.frombuffer(memo.encode(text), "<u4").tolist() == ids(seen.tokenizer, text)
        assert sorted(seen.given) == sorted(["!!", "***", ".%%%", ")", "&"])
        for x in ("it's 'quoted' don't!' x'", "a<|endoftext|>b!", "Ω! é́. ﬁ, ＡＢ!"):
            assert np.frombuffer(memo.encode(x), "<u4").tolist() == ids(seen.tokenizer, x)


def test_token_counts(docs, no_docs, byte_tokenizer):
    extra = docs.withColumn("N_Tokens", F.lit("mine")).withColumn("rank", F.lit(1))
    got = token_counts.token_counts(extra, BYTE_JSON, chunk_chars=2000, overlap_chars=16)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "rank", "n_bytes", "n_tokens", "over_limit"]
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.n_bytes, r.n_tokens) == (len((r.text or "").encode()), len(ids(byte_tokenizer, r.text)))
        assert r.over_limit == (r.n_tokens > 1024)
    assert token_counts.token_counts(no_docs, BYTE_JSON).collect() == []


def test_tree_encode_and_decode():
    import tiktoken

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain, c = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}), bpe.codec(RANKS, P.PATTERN)
    for x in odd_texts():
        want = plain.encode_ordinary(x)
        for leaf in (7, 40, 1 << 20):
            assert c.encode(x, leaf).tolist() == want
        assert c.decode(np.array(want, np.uint32), 5) == x.encode()


def test_bpe_frames(docs, no_docs):
    c = bpe.codec(RANKS, P.PATTERN)
    encoded = bpe.bpe_encode(docs.withColumn("ids", F.lit(1)), RANKS, P.PATTERN, leaf_chars=500)
    for r in bpe.bpe_decode(encoded, RANKS, P.PATTERN).collect():
        assert bytes(r.decoded) == (r.text or "").encode()
        assert r.ids == c.encode_whole(r.text or "").tolist()
    for r in bpe.bpe_round_trip(docs, RANKS, P.PATTERN, leaf_chars=500).collect():
        raw = c.encode_whole(r.text or "").astype("<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(raw), hashlib.sha256(raw.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert bpe.bpe_round_trip(no_docs, RANKS, P.PATTERN).collect() == []


def plain_pack(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD_JSON)
    return [np.array(ids(t, x) + [2], "<u4") for x in texts]


@pytest.mark.parametrize("capacity,max_open", [(64, 4096), (64, 5), (4096, 4096)])
def test_packing(docs, capacity, max_open):
    """Every id of every row lies in one piece; sequences are gapless, and full or a power of two."""
    one_id = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    want = {r.doc_id: x for r, x in zip(*(lambda rows: (rows, plain_pack([r.text for r in rows])))(one_id.collect()), strict=True)}
    rows = packing.pack(one_id.withColumn("start", F.lit("x")), WORD_JSON, capacity=capacity, max_open=max_open, with_ids=True).collect()
    pieces_of, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert r.doc_tokens == len(want[r.doc_id])
        pieces_of[r.doc_id].append((r.start, r.ids))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {d: sum((p for _, p in sorted(x)), []) for d, x in pieces_of.items()} == {d: x.tolist() for d, x in want.items()}
    for x in sequences.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at == capacity or at & (at - 1) == 0


def test_packing_repeats_and_empty(docs, no_docs):
    rows = packing.pack(docs, WORD_JSON).collect()
    assert sum(r.length for r in rows) == sum(map(len, plain_pack([r.text for r in docs.collect()])))
    assert packing.pack(no_docs, WORD_JSON).collect() == []


def test_sum_of_squares_choice():
    """The chosen level gives the least sum of squares of the level array, over all levels that fit."""
    rng = random.Random(3)
    p = packing.Packer(32, 0)
    for _ in range(300):
        size = rng.randrange(1, 32)
        costs = {}
        for h in range(0, 33 - size):
            if h == 0 or p.level[h]:
                after = p.level.copy()
                after[h] -= bool(h)
                if h + size < 32:
                    after[h + size] += 1
                costs[h] = int((after[1:32] ** 2).sum())
        h = p.choose(size)
        assert costs[h] == min(costs.values()) and h == max(k for k in costs if costs[k] == costs[h])
        p.add(1, np.zeros(size, "<u4"))


def expansions(markup):
    """A regular expression of a template over words that each end in one blank."""
    out = ""
    for part in re.findall(r"\[\[|\]\]|\{\{[^}]*\}\}|[^\s\[\]{}]+", markup):
        if part == "[[":
            out += "(?:"
        elif part == "]]":
            out += ")?"
        elif part.startswith("{{"):
            lo, hi = re.search(r":(\d+)-(\d+)", part).groups()
            out += rf"(?:\S+ ){{{lo},{hi}}}"
        else:
            out += re.escape(part) + " "
    return out


LICENSES = ["Licensed under CC BY-NC 4.0.", "cc by cc by CC-BY", "licensed under the GNU General Public License, version 3.",
            "Licensed under the Apache License, Version 2.0.", "licensed under the apache license 2 0", "Released under the MIT License.",
            "Copyright (c) 2020 Foo Bar. All rights reserved.", "copyright all rights reserved", "all rights reserved all rights reserved",
            "copyright a b c d e f g h i all rights reserved", "released under mit license", "under the terms of the MIT license",
            "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
            "général public license", "licensed under the general public license as published by the free software foundation version 2", ""]


def test_license_scan(spark, no_docs):
    rng = random.Random(2)
    vocabulary = sorted({w for m in license_scan.TEMPLATES.values() for w in re.findall(r"[a-z0-9]+", m)})
    texts = LICENSES + [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(40))) for _ in range(100)] + [
        rng.choice(LICENSES) + " filler " + rng.choice(LICENSES) for _ in range(40)] + [None, "x " * 50_000 + "cc by"]
    rows = spark.createDataFrame([(k, x, "mine") for k, x in enumerate(texts)], "doc_id long, text string, Labels string")
    for r in license_scan.license_scan(rows).collect():
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        base = [(label, i, i + len(p.split())) for p, label in license_scan.BASE.items() for i in range(len(ws))
                if ws[i:i + len(p.split())] == p.split()]
        found = list(base)
        if len(ws) < 1000:
            for label, markup in license_scan.TEMPLATES.items():
                for i in range(len(ws)):
                    hits = [j for j in range(i + 1, min(len(ws), i + 40) + 1)
                            if re.fullmatch(expansions(markup), " ".join(ws[i:j]) + " ")]
                    if hits:
                        found.append((label, i, hits[-1]))
        covered = {k for _, a, b in found for k in range(a, b)}
        places = sorted(x[1] for x in base)
        assert (r.n_words, r.n_base) == (len(ws), len(base))
        assert (r.first_word, r.last_word) == ((places[0], places[-1]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({x[0] for x in base})) and r.labels == ",".join(sorted({x[0] for x in found}))
        assert r.score == (len(covered) / len(ws) if ws else 0.0)
        assert sorted((s.label, s.start, s.end) for s in r.spans) == sorted(found)
    assert license_scan.license_scan(no_docs).collect() == []


def test_base_places_come_from_the_automaton(monkeypatch):
    scanner = license_scan.Scanner(license_scan.BASE, license_scan.TEMPLATES)
    text = "cc by cc by all rights reserved general public license"
    got = scanner.scan(text)
    assert (got["n_base"], got["first_word"], got["last_word"], got["base_labels"]) == (4, 0, 7, "cc-by,gpl,reserved")
    assert license_scan.Scanner(license_scan.BASE, {}).scan(text)["spans"] == got["spans"]
    monkeypatch.setattr(scanner.automaton, "matches", lambda ws, at: {})
    assert scanner.scan(text)["n_base"] == 0
