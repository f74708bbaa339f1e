"""Merkle manifest against trees built in plain Python."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from fetchplan.llm import merkle
from fetchplan.llm.ranks import ranked

TAMPERED = "crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0"


def digest(text):
    return sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes, fanout):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i:i + fanout])) for i in range(0, len(out[-1]), fanout)])
    return out


def siblings(tree, i, fanout):
    for nodes in tree[:-1]:
        a = i // fanout * fanout
        yield "".join(nodes[a:i]), "".join(nodes[i + 1:a + fanout])
        i //= fanout


def plain(rows, fanout):
    sources = {}
    for r in rows:
        head = "".join(field(r[c]) for c in ("doc_id", "source", "lang", "n_chars"))
        hit = r.doc_id is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text) if hit else r.text
        leaf = digest(head + field(r.text))
        sources.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, leaf, digest(head + field(text)), r.doc_id))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(sources[s], key=lambda x: x[:3])], fanout) for s in order}
    top = levels([trees[s][-1][0] for s in order], fanout)
    for k, s in enumerate(order):
        for i, (*_, leaf, now, doc) in enumerate(sorted(sources[s], key=lambda x: x[:3])):
            path, h = [*siblings(trees[s], i, fanout), *siblings(top, k, fanout)], now
            for left, right in path:
                h = digest(left + h + right)
            proof = "".join(a + b for a, b in path)
            yield doc, leaf, trees[s][-1][0], top[-1][0], digest(proof), proof, h, h == top[-1][0]


def by_text(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("fanout,span", [(16, 4), (2, 2), (3, 1)])
def test_manifest(docs, fanout, span):
    """Sources that end within one block, and hot ones over many blocks and passes; clashing columns do no harm."""
    more = docs.where("doc_id is null or doc_id != 90").withColumn(
        "source", F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("é\x00"), F.col("doc_id"))).otherwise(F.col("source")))
    clash = more.withColumns({c: F.lit("x") for c in ("leaf", "root", "key", "digest", "rank", "n", "block", "tampered")})
    got = merkle.manifest(clash, F.expr(TAMPERED), with_proofs=True, fanout=fanout, levels=span)
    assert by_text(map(tuple, got.collect())) == by_text(plain(more.collect(), fanout))


def test_manifest_of_little(docs, no_docs):
    empty = merkle.manifest(no_docs, F.expr(TAMPERED))
    one = merkle.manifest(docs.where("doc_id = 4"))
    assert empty.collect() == [] and empty.dtypes == one.dtypes
    row = one.first()
    assert row.leaf == row.subroot == row.root == row.folded_root == digest("1:41:s2:aa-3:one") and row.verified
    assert row.proof_sha256 == digest("")


def test_only_tampered_leaves_fail(docs):
    got = merkle.manifest(docs, F.col("doc_id") == 8).collect()
    assert [r.doc_id for r in got if not r.verified] == []  # no capital letter in it
    got = merkle.manifest(docs.withColumn("text", F.upper("text")), F.col("doc_id").isin(8, 2, 1)).collect()
    assert [r.doc_id for r in got if not r.verified] == [8]


def test_sweeps_hold_few_digests(monkeypatch):
    """The queue holds a few digests per level, however many leaves there are."""
    most, push = [0], merkle.heapq.heappush

    def counted(queue, x):
        push(queue, x)
        most[0] = max(most[0], len(queue))

    monkeypatch.setattr(merkle.heapq, "heappush", counted)
    tree = merkle.forward([digest(str(k)) for k in range(5000)], 4)
    assert [len(x) for x in tree] == [5000, 313, 20, 2, 1] and most[0] <= 16 * 4
    paths = list(merkle.backward(tree, None))
    assert [i for i, _ in paths] == list(range(4999, -1, -1)) and most[0] <= 16 * 5
    assert {merkle.fold(tree[0][i], p)[1] for i, p in paths} == {tree[-1][0]}
    assert merkle._read(merkle._written(paths[7][1])) == paths[7][1] and merkle._read("") is None


def test_ranks(spark):
    rows = spark.createDataFrame([(k % 3 and 1, k // 2 if k % 5 else None) for k in range(2000)], "key int, v int")
    got = ranked(rows, ["key"], ["v"]).collect()
    for key in (0, 1):
        own = sorted((r.rank, r.v) for r in got if r.key == key)
        values = [-1 if v is None else v for _, v in own]
        assert [k for k, _ in own] == list(range(len(own))) and values == sorted(values)
        assert {r.n for r in got if r.key == key} == {len(own)}
