"""License scans: template markup compiled to token automata.

A template is a line of words with two kinds of marked regions::

    released under the [[terms of the]] {{name:1-3}} license

``[[...]]`` is optional wording and ``{{name:lo-hi}}`` stands for ``lo`` to
``hi`` replaceable words; every other word is mandatory and must match exactly.
All templates, and the base phrases as templates without regions, compile into one
token automaton, made deterministic lazily while texts run through it, so a text costs one step per word that can still
belong to a match.

Words: A-Z is lower-cased, and a word is a run of ASCII letters, digits and
non-ASCII characters.  Null and empty texts have no words, no places, empty
labels and score 0.  Rows are independent: repeated rows give repeated results.
"""

from __future__ import annotations

import re
from collections.abc import Hashable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fetchplan.llm.columns import per_row, texts

#: Base phrases and their labels (fixed by the task).
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Template wording and labels.
TEMPLATES = {
    "mit": "[[released]] [[licensed]] under the [[terms of the]] mit license",
    "apache-2.0": "licensed under the apache license [[version]] 2 0",
    "cc-by-variant": "licensed under [[a]] [[the]] [[creative commons]] cc by {{clause:0-2}} {{version:1-1}} 0",
    "gpl-notice": "licensed under the [[gnu]] general public license [[as published by the free software foundation]]"
                  " [[either]] version {{number:1-1}}",
    "copyright-notice": "copyright [[c]] {{holder:1-8}} all rights reserved",
    "mit-permission": "permission is hereby granted free of charge to any person obtaining a copy of this"
                      " {{work:1-3}} and associated documentation files",
    "bsd-redistribution": "redistribution and use in source and binary forms [[with or without modification]]"
                          " are permitted provided that the following conditions are met",
    "bsd-endorsement": "neither the name of {{holder:1-12}} nor the names of [[its]] {{work:0-3}} contributors may be used to endorse or promote"
                       " products derived from this software without specific prior written permission",
    "gpl-or-later": "[[either]] version {{number:1-1}} of the license or at your option any later version",
    "lgpl-notice": "[[gnu]] lesser general public license",
    "agpl-notice": "[[gnu]] affero general public license",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v {{number:1-1}} 0",
    "isc-permission": "permission to use copy modify [[and]] [[or]] distribute this software [[and its documentation]] for any purpose"
                      " [[with or without fee]] [[without fee]] is hereby granted",
    "zlib-warranty": "this software is provided as is without any express or implied warranty",
    "as-is-warranty": "[[the]] software is provided as is without warranty of any kind",
    "cc0": "[[creative commons]] cc0 1 0 [[universal]]",
    "cc-attribution": "creative commons attribution [[noncommercial]] [[sharealike]] [[noderivatives]] [[noderivs]] {{version:1-1}} 0"
                      " [[international]] [[unported]] license",
    "public-domain": "[[dedicated to]] [[released into]] [[placed in]] the public domain",
    "spdx-identifier": "spdx license identifier {{id:1-4}}",
}

TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
FIELDS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
SCHEMA = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double,"
          " spans array<struct<label:string,start:long,end:long>>")
ARROW = pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                   ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
                   ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))])


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(TABLE).split()


class Automaton:
    """Token automaton of all templates; states of the lazily built deterministic form are frozensets."""

    def __init__(self, templates: dict[Hashable, str]):
        self.word: list[dict[bytes, int]] = [{}]
        self.any: list[int | None] = [None]
        self.skip: list[set[int]] = [set()]
        self.accepts: dict[int, Hashable] = {}
        for label, markup in templates.items():
            at = self._new()
            self.skip[0].add(at)
            self.accepts[self._build(re.findall(r"\[\[|\]\]|\{\{[^}]*\}\}|[^\s\[\]{}]+", markup), at)] = label
        self.start = self._closure({0})
        self.first = frozenset(w for s in self.start for w in self.word[s])
        if any(self.any[s] is not None for s in self.start) or self.start & self.accepts.keys():
            raise ValueError("a template must begin with mandatory or optional words")
        self.vocabulary = frozenset(w for s in self.word for w in s)
        self.steps: dict[tuple[frozenset, bytes | None], frozenset] = {}

    def _new(self) -> int:
        self.word.append({})
        self.any.append(None)
        self.skip.append(set())
        return len(self.word) - 1

    def _build(self, parts: list[str], at: int) -> int:
        opened: list[int] = []
        for part in parts:
            if part == "[[":
                opened.append(at)
            elif part == "]]":
                self.skip[opened.pop()].add(at)
            elif part.startswith("{{"):
                lo, hi = map(int, re.fullmatch(r"\{\{\w+:(\d+)-(\d+)\}\}", part).groups())
                ends = []
                for k in range(hi):
                    if k >= lo:
                        ends.append(at)
                    self.any[at] = to = self._new()
                    at = to
                for end in ends:
                    self.skip[end].add(at)
            else:
                to = self._new()
                self.word[at][part.encode()] = to
                at = to
            if part == "[[":  # a state of its own, so that what follows the region can't loop into it
                to = self._new()
                self.skip[at].add(to)
                at = to
                opened[-1] = at
        return at

    def _closure(self, states: set[int]) -> frozenset:
        todo, seen = list(states), set(states)
        while todo:
            for t in self.skip[todo.pop()] - seen:
                seen.add(t)
                todo.append(t)
        return frozenset(seen)

    def step(self, states: frozenset, word: bytes) -> frozenset:
        key = (states, word if word in self.vocabulary else None)
        if key not in self.steps:
            to = {self.word[s][word] for s in states if word in self.word[s]}
            self.steps[key] = self._closure(to | {self.any[s] for s in states if self.any[s] is not None})
        return self.steps[key]

    def matches(self, ws: list[bytes], at: int) -> dict[Hashable, int]:
        """Longest end of each template that matches from word ``at``."""
        found, states, j = {}, self.start, at
        while j < len(ws) and (states := self.step(states, ws[j])):
            j += 1
            for s in states & self.accepts.keys():
                found[self.accepts[s]] = j
        return found


class Scanner:
    def __init__(self, base: dict[str, str], templates: dict[str, str]):
        marked = {(False, label): markup for label, markup in templates.items()}
        self.automaton = Automaton({(True, phrase): phrase for phrase in base} | marked)
        self.base = base

    def scan(self, text: str | None) -> dict:
        ws = words(text)
        spans, places = [], []
        if not self.automaton.first.isdisjoint(ws):
            for i, w in enumerate(ws):
                if w in self.automaton.first:
                    for (plain, name), end in self.automaton.matches(ws, i).items():
                        (places if plain else spans).append((self.base[name] if plain else name, i, end))
        covered = set()
        for _, a, b in places + spans:
            covered.update(range(a, b))
        labels = {x[0] for x in places}
        return {"n_words": len(ws), "n_base": len(places), "first_word": places[0][1] if places else None,
                "last_word": places[-1][1] if places else None, "base_labels": ",".join(sorted(labels)),
                "labels": ",".join(sorted(labels | {x[0] for x in spans})), "score": len(covered) / len(ws) if ws else 0.0,
                "spans": [{"label": x, "start": a, "end": b} for x, a, b in sorted(places + spans, key=lambda s: s[1:])]}


@lru_cache(maxsize=8)
def scanner(base: tuple, templates: tuple) -> Scanner:
    return Scanner(dict(base), dict(templates))


def license_scan(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, base: dict[str, str] | None = None,
                 templates: dict[str, str] | None = None, with_spans: bool = True) -> DataFrame:
    """Adds word count, base places, labels, score and all matched spans to each document.

    ``score`` is the share of the text's words that lie in a base place or a
    template match.  ``spans`` lists every match as label, first word and end.
    A narrow job: no shuffle, one text at a time in memory.
    """
    of = tuple((BASE if base is None else base).items()), tuple((TEMPLATES if templates is None else templates).items())

    @F.arrow_udf(SCHEMA)
    def scan(values: Iterator[pa.Array]) -> Iterator[pa.Array]:
        s = scanner(*of)
        for v in values:
            yield pa.array([s.scan(x) for x in texts(v)], type=ARROW)

    return per_row(docs, scan(F.col(text_col)), FIELDS + ["spans"] * with_spans, keep)
