"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf: the SHA-256 of its fields, computed in SQL.  Per source the
leaves stand in the order of their ids; runs of ``FANOUT`` neighbours become the
digest of their concatenated digests, level by level, up to one subroot per
source; the subroots, in the order of the sources, likewise become one root.

A node's label is (its last leaf, its level): children come before their
parents.  A sweep visits labels in order; a priority queue holds each digest
under its parent's label until the sweep reaches that parent, so it holds a few
digests per level.  The sweep is dealt out in blocks of ``FANOUT ** LEVELS``
neighbouring leaves: a block is one task's share, and the queue between
blocks is external, a table in the session's shared folder that Spark sorts by
label before the next pass, which is 4,096 times smaller.  Then the sweep is
reversed: from the root down, every node delivers to its children the siblings
on their way to the root, and each leaf folds them.

A source of any size is spread over its blocks; only the root reaches the driver.
Nulls in any field count as such; null ids come first, and rows equal in id stand
in the order of their digests.  Repeated rows are leaves of their own.  Null ids
are never tampered with.  An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fetchplan.llm.ranks import ranked
from fetchplan.session import checkpoint_dir

FANOUT = 16
#: Levels that a block of the sweep spans.
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: (siblings to the left, siblings to the right, the parent's path): hex digests, the path ends in None.
Path = tuple[str, str, "Path"] | None


def n_levels(n: int, fanout: int = FANOUT) -> int:
    """Levels from ``n`` nodes to one."""
    k = 0
    while n > 1:
        n, k = -(-n // fanout), k + 1
    return k


def forward(digests: list[str], levels: int, fanout: int = FANOUT) -> list[list[str]]:
    """Digests of every level of the tree over ``digests``, from a sweep over labels with a priority queue."""
    tree, queue, last = [digests] + [[] for _ in range(levels)], [], len(digests) - 1

    def send(level: int, i: int, digest: str) -> None:
        if level < levels:
            end = min((i // fanout + 1) * fanout ** (level + 1) - 1, last)
            heapq.heappush(queue, (end, level + 1, i, digest))

    for leaf, digest in enumerate(digests):
        send(0, leaf, digest)
        while queue and queue[0][0] <= leaf:
            end, level, i, _ = queue[0]
            node = sha256()
            while queue and queue[0][:2] == (end, level):
                node.update(heapq.heappop(queue)[3].encode())
            tree[level].append(node.hexdigest())
            send(level, i // fanout, tree[level][-1])
    return tree


def backward(tree: list[list[str]], top: Path, fanout: int = FANOUT) -> Iterator[tuple[int, Path]]:
    """(leaf, path to the root), last leaf first: the labels swept in reverse, parents delivering paths to children."""
    last, levels = len(tree[0]) - 1, len(tree) - 1
    queue: list[tuple[int, int, int, Path]] = [(-last, -levels, 0, top)]
    while queue:
        _, level, i, path = heapq.heappop(queue)
        level = -level
        if not level:
            yield i, path
            continue
        run = tree[level - 1][i * fanout:(i + 1) * fanout]
        for k in range(len(run)):
            child = i * fanout + k
            end = min((child + 1) * fanout ** (level - 1) - 1, last)
            heapq.heappush(queue, (-end, 1 - level, child, ("".join(run[:k]), "".join(run[k + 1:]), path)))


def fold(digest: str, path: Path) -> tuple[str, str]:
    """(siblings on the way, level by level and left to right; the root that digest and siblings give)."""
    siblings = []
    while path:
        left, right, path = path
        siblings += left, right
        digest = sha256((left + digest + right).encode()).hexdigest()
    return "".join(siblings), digest


def _written(path: Path) -> str:
    levels = []
    while path:
        left, right, path = path
        levels.append(f"{left}|{right}")
    return ";".join(levels)


def _read(text: str) -> Path:
    path: Path = None
    for level in reversed(text.split(";") if text else []):
        left, right = level.split("|")
        path = (left, right, path)
    return path


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one (key, block) after another; they come sorted so."""
    rows: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and (row["key"], row["block"]) != (rows[0]["key"], rows[0]["block"]):
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _record_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 5000) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, size)):
        columns = zip(zip(*some, strict=True), schema.types, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], schema=schema)


class Tree:
    """Trees of all keys over ``nodes`` (key binary, rank long, n long, digest binary, further columns)."""

    def __init__(self, nodes: DataFrame, fanout: int = FANOUT, levels: int = LEVELS):
        self.fanout, self.levels, self.span = fanout, levels, fanout ** levels
        self.passes = [self._blocked(nodes)]
        most = nodes.agg(F.max("n")).first()[0] or 1
        self.tops: list[DataFrame] = []
        while True:
            up = self._up(self.passes[-1]).checkpoint()
            self.tops.append(up.where("n = 1").select("key", "digest"))
            most = -(-most // self.span)
            if most == 1:
                break
            self.passes.append(self._blocked(up.where("n > 1")))

    def _blocked(self, nodes: DataFrame) -> DataFrame:
        return nodes.withColumn("block", F.expr(f"rank div {self.span}"))

    def subroots(self) -> DataFrame:
        """(key, digest), one row per key."""
        out = self.tops[0]
        for top in self.tops[1:]:
            out = out.unionByName(top)
        return out

    def _up(self, nodes: DataFrame) -> DataFrame:
        schema = pa.schema([("key", pa.binary()), ("rank", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())])
        fanout, levels, span = self.fanout, self.levels, self.span

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def tops():
                for rows in _blocks(batches):
                    tree = forward([r["digest"].hex() for r in rows], min(levels, n_levels(rows[0]["n"], fanout)), fanout)
                    yield rows[0]["key"], rows[0]["block"], -(-rows[0]["n"] // span), bytes.fromhex(tree[-1][0])

            yield from _record_batches(tops(), schema)

        return (nodes.select("key", "block", "rank", "n", "digest").repartition("key", "block").sortWithinPartitions("key", "block", "rank")
                .mapInArrow(run, "key binary, rank long, n long, digest binary"))

    def _down(self, k: int, paths: DataFrame, emit, schema: pa.Schema, ddl: str, more: list[str]) -> DataFrame:
        """Rows that ``emit(node row, path row, path)`` gives for every node of pass k; ``paths``: (key, rank, path, more) of those above."""
        nodes = self.passes[k]
        kinds, fanout, levels = dict(nodes.dtypes) | dict(paths.dtypes), self.fanout, self.levels
        extra = [c for c in nodes.columns if c not in ("key", "block", "rank", "n", "digest")]
        first = paths.select("key", F.col("rank").alias("block"), F.lit(-1).cast("long").alias("rank"), F.lit(None).cast("long").alias("n"),
                             F.lit(None).cast("binary").alias("digest"), "path", *more,
                             *[F.lit(None).cast(kinds[c]).alias(c) for c in extra])
        rows = nodes.withColumn("path", F.lit(None).cast("string"))
        for c in more:
            rows = rows.withColumn(c, F.lit(None).cast(kinds[c]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def each():
                for above, *rows in _blocks(batches):
                    tree = forward([r["digest"].hex() for r in rows], min(levels, n_levels(rows[0]["n"], fanout)), fanout)
                    for leaf, path in backward(tree, _read(above["path"]), fanout):
                        yield emit(rows[leaf], above, path)

            yield from _record_batches(each(), schema)

        return (first.unionByName(rows).repartition("key", "block").sortWithinPartitions("key", "block", "rank").mapInArrow(run, ddl))

    def paths(self, top: DataFrame, emit, schema: pa.Schema, ddl: str, more: list[str]) -> DataFrame:
        """Every leaf's ``emit`` row, given (key, path, more) of every key's subroot."""
        below = None
        for k in reversed(range(len(self.passes))):
            done = self.tops[k].select("key").join(top, "key").withColumn("rank", F.lit(0).cast("long"))
            paths = done if below is None else done.unionByName(below)
            if k:
                between = pa.schema([("key", pa.binary()), ("rank", pa.int64()), ("path", pa.string())]
                                    + [(c, pa.binary()) for c in more])
                kinds = dict(top.dtypes)
                below = self._down(k, paths, lambda row, above, path: (row["key"], row["rank"], _written(path), *[above[c] for c in more]),
                                   between, "key binary, rank long, path string" + "".join(f", {c} {kinds[c]}" for c in more), more).checkpoint()
        return self._down(0, paths, emit, schema, ddl, more)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """SHA-256 (binary) of the fields: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    return F.unhex(F.sha2(F.concat(*map(_field, values)).cast("binary"), 256))


def manifest(docs: DataFrame, tampered: Column | None = None, with_proofs: bool = False, fanout: int = FANOUT,
             levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row; ``with_proofs`` adds ``proof``.

    ``tampered``: where true, A-Z of the text is lower-cased after the manifest
    was made; the folded root is that of the row as it then stands.  ``proof`` holds
    the siblings' digests in the order in which they are folded.
    """
    checkpoint_dir(docs.sparkSession)
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    given = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"),
                        F.col("n_chars").cast("long"), F.col("text").cast("string"), tampered.alias("tampered"))
    head = [F.col(c) for c in FIELDS[:-1]]
    key = F.when(F.col("source").isNull(), F.lit(b"")).otherwise(F.concat(F.lit(b"\x01"), F.col("source").cast("binary")))
    leaves = given.select("doc_id", key.alias("key"), leaf_digest(*head, F.col("text")).alias("digest"),
                          F.when(F.col("tampered") & (lower != F.col("text")), leaf_digest(*head, lower)).alias("changed")).checkpoint()
    sources = Tree(ranked(leaves, ["key"], ["doc_id", "digest", "changed"]), fanout, levels)
    subroots = sources.subroots().select(F.col("key").alias("source"), "digest").checkpoint()
    whole = Tree(ranked(subroots.withColumn("key", F.lit(b"")), ["key"], ["source"]), fanout, levels)
    found = whole.subroots().first()
    if not found:
        return leaves.where("false").select("doc_id", *[F.hex("digest").alias(c) for c in ("leaf", "subroot", "root", "proof_sha256")],
                                            *[F.hex("digest").alias("proof")] * with_proofs,
                                            F.hex("digest").alias("folded_root"), F.lit(True).alias("verified"))
    root = bytes(found.digest).hex()
    top = whole.subroots().select("key", F.lit("").alias("path"))
    of_source = pa.schema([("key", pa.binary()), ("path", pa.string()), ("subroot", pa.binary())])
    per_source = whole.paths(top, lambda row, above, path: (row["source"], _written(path), row["digest"]), of_source,
                             "key binary, path string, subroot binary", []).checkpoint()

    def proven(row: dict, above: dict, path: Path) -> tuple:
        siblings, folded = fold((row["changed"] or row["digest"]).hex(), path)
        return (row["doc_id"], row["digest"].hex(), above["subroot"].hex(), root, sha256(siblings.encode()).hexdigest(),
                *[siblings] * with_proofs, folded, folded == root)

    names = ["leaf", "subroot", "root", "proof_sha256", *["proof"] * with_proofs, "folded_root"]
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.string()) for c in names], ("verified", pa.bool_())])
    return sources.paths(per_source, proven, schema, "doc_id long, " + ", ".join(f"{c} string" for c in names) + ", verified boolean",
                         ["subroot"])
