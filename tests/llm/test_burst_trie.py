"""Conversation trie against prefixes enumerated in plain Python."""

import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from fetchplan.llm import burst_trie

TURNS = "conv_id long, turn long, role string, text string"


def conversations() -> list[tuple]:
    rng = random.Random(8)
    rows = []

    def add(conv, texts, first=0):
        rows.extend((conv, first + k, "user" if k % 2 else "assistant", x) for k, x in enumerate(texts))

    for c in range(-25, 60):  # bases absent, short and long; negative ids
        if c % 9:
            add(c, [rng.choice(["hi there", "bye", "a  b\tc", "", "é 漢 x"]) for _ in range(rng.randrange(0, 7))])
    shared = [f"turn {k}" for k in range(120)]
    for c in range(100, 140):  # long shared starts
        add(c, shared[:rng.randrange(100, 120)] + [rng.choice("xyz")] * rng.randrange(3))
    for c in range(200, 230):  # copies
        add(c, ["same", "same again", "and again"])
    add(300, [f"long {k % 7}" for k in range(500)])  # one conversation holds a large share of all turns
    add(301, [f"long {k % 7}" for k in range(400)])
    add(302, ["only one"])
    rows += [(61, None, "user", "null turn first"), (61, 0, None, None), (61, 5, "user", "gap"), (None, 0, "user", "no id"), (None, None, None, None)]
    rows += [(62, 1, "user", "twice"), (62, 1, "user", "twice"), (62, None, None, "n"), (62, None, None, "n")]
    rng.shuffle(rows)
    return rows


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def plain(rows, group, shares):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    if group:
        given = {}
        for c, v in own.items():
            h = zlib.crc32(str(c).encode()) % shares
            base = c - (abs(c) % group) * (1 if c >= 0 else -1)
            given[c] = own.get(base, [])[:h] + v[h:]
        own = given
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, v in own.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
            if d:
                children[tuple(v[:d - 1])].add(tuple(v[:d]))
        ends[tuple(v)].append(c)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[x] for x in children[p]) or 1
        saved[p] = sum(saved[x] for x in children[p]) + (len(members[p]) - 1) * (words(p[-1][1]) if p else 0)
    for p, m in members.items():
        yield (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
               sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())


@pytest.fixture(scope="module")
def given(spark):
    return spark.createDataFrame(conversations(), TURNS).repartition(5).cache()


def same(got, want):
    assert got.columns == burst_trie.RESULT
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize("limit,chunk", [(20_000, 4096), (50, 64), (1, 7), (400, 3)])
def test_nodes_of_rebuilt_conversations(given, limit, chunk, monkeypatch):
    """Containers that hold everything, burst at several depths, or hold single turns; windows that split conversations."""
    clash = given.withColumns({c: F.lit("x") for c in ("place", "n", "rank", "h1", "depth", "size", "words", "head")})
    rows = burst_trie.rebuilt(burst_trie.turns(clash), group=20, shares=4)
    same(burst_trie.trie(rows, limit=limit, chunk=chunk), plain(conversations(), 20, 4))


def test_nodes_of_conversations_as_they_are(given):
    same(burst_trie.trie(burst_trie.whole(burst_trie.turns(given)), limit=30), plain(conversations(), 0, 0))


def test_ends_are_packed_in_order(given, monkeypatch):
    """Copies by the hundred end in one node: their ids run through the digest in order."""
    many = given.sparkSession.range(1500).select(F.col("id").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("u").alias("role"), F.lit("t").alias("text"))
    got = burst_trie.trie(burst_trie.whole(burst_trie.turns(many))).collect()
    assert [(r.depth, r.n_convs, r.n_leaves, r.saved_tokens) for r in sorted(got, key=lambda r: r.depth)] == [(0, 1500, 1, 1499), (1, 1500, 1, 1499)]
    assert max(got, key=lambda r: r.depth).ends_sha256 == sha256(",".join(map(str, range(1500))).encode()).hexdigest()


def test_packing_of_ids(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(burst_trie, "PACKED", 3)
    rows = [(1, 5, 5, k) for k in range(7)] + [(2, 0, 0, 9), (2, 0, 1, 4), (2, 0, 1, 11)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[a:a + 4], strict=True)], names=["depth", "p1", "p2", "conv_id"])
               for a in range(0, 10, 4)]
    packed = list(burst_trie._packed(iter(batches)))
    assert [r["ids"] for b in packed for r in b.to_pylist()] == ["0,1,2", "3,4,5", "6", "9", "4,11"]
    got = [r for b in burst_trie._digested(iter(packed)) for r in b.to_pylist()]
    assert [(r["conv_id"], r["n"]) for r in got] == [(0, 7), (9, 1), (4, 2)]
    assert got[0]["sha"] == sha256(b"0,1,2,3,4,5,6").hexdigest()


def test_sweep():
    a, b, c = (1, 1), (2, 2), (0, 5)
    nodes = burst_trie.sweep([((a, b), 7, 2, [3, 4], "x"), ((a,), 9, 1, [3], "y"), ((a, c), 8, 1, [3, 1], "z")], 4)
    assert nodes == [[4, 7, -1, 4, 2, 2, 9 + 4, "y"], [5, 8, 0, 1, 0, 1, 0, "z"], [5, 7, 0, 2, 0, 1, 4, "x"]]


def test_no_conversations(spark):
    none = spark.createDataFrame([], TURNS)
    assert burst_trie.trie(burst_trie.rebuilt(burst_trie.turns(none))).collect() == []
    nobody = spark.createDataFrame([(None, 1, "a", "b")], TURNS)
    assert burst_trie.trie(burst_trie.whole(burst_trie.turns(nobody))).collect() == []
    # both turns of conversation 7 fall to an absent base: members of the root only
    got = burst_trie.trie(burst_trie.rebuilt(burst_trie.turns(spark.createDataFrame([(7, 0, "a", "b")], TURNS)), shares=4)).collect()
    assert zlib.crc32(b"7") % 4 > 0 and [tuple(r)[:7] for r in got] == [(7, 0, None, 1, 0, 1, 0)]
