"""Prefix trie of conversations, built as a burst trie.

A container holds the suffixes of all conversations below one trie node, its
head.  A container of more than ``limit`` turns bursts by next turn: its head becomes
an inner node and every next turn the head of a container.  As a container's size
is the number of turns below its head, all bursts are decided at once, by one
count per prefix that is combined before it is shuffled; a conversation then goes to the
container at its first prefix that is small enough.  The containers that remain
are dealt over the shards (tasks); each is sorted and swept once, which gives
its nodes, and the heads above add up what their containers report.

A turn is known by two 64-bit hashes of role and text, a prefix by the exclusive
or of its turns' hashes with their places, so prefixes of conversations of any
length come from windows of ``CHUNK`` turns and one carry per window.  Conversations of
equal turns are folded to their smallest id and a count first: however many
copies there are, they are one suffix.

Bounded memory: a container of ``limit`` turns, a window of ``CHUNK`` turns.  Ids of the members
that end in one node are sorted over all partitions and run through one
digest, packed, in one task, since SHA-256 has no other way; they are never held together.

Null roles and texts are empty.  Turns are ordered by number, null first; equal
numbers (repeated rows, too) by the hashes of role and text.  Rows without a conv_id
take no part.  An empty table gives no nodes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fetchplan.llm.ranks import ranked
from fetchplan.session import checkpoint_dir

#: Turns a container holds at most.
LIMIT = 2048
#: Turns of one conversation that a window holds.
CHUNK = 4096
#: Ids a packed row holds at most.
PACKED = 4096
WORDS = r"[^\x20\x09-\x0D]+"
EMPTY = sha256(b"").hexdigest()

RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), n (turns of the conversation), h1, h2 (hashes), words of every turn."""
    checkpoint_dir(conversations.sparkSession)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    given = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), F.xxhash64(role, text).alias("h1"),
        F.xxhash64(F.lit(1), text, role).alias("h2"), F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"))
    return ranked(given.checkpoint(), ["conv_id"], ["turn", "h1", "h2"]).withColumnRenamed("rank", "place").drop("turn")


def rebuilt(own: DataFrame, group: int = 20, shares: int = 4) -> DataFrame:
    """Conversations whose first turns are replaced by those of their group's first conversation.

    Of ``turns`` rows, conversation c gets the first h turns of c - c % group (all if
    it has fewer, none if it is absent), then its own after its first h; h is the
    unsigned crc32 of its decimal id, modulo ``shares``.  Rows: conv_id, depth (from 1), size
    (turns), h1, h2, words; a conversation without turns has one row of depth 0.
    """
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % shares
    convs = own.where("place = 0").select("conv_id", "n", taken.alias("taken"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(bases, "base", "left").withColumn("given", F.least("taken", F.coalesce("base_n", F.lit(0))))
    convs = convs.withColumn("size", F.col("given") + F.greatest(F.col("n") - F.col("taken"), F.lit(0))).drop("n", "base_n").checkpoint()
    columns = ["conv_id", "depth", "size", "h1", "h2", "words"]
    kept = own.join(convs, "conv_id").where("place >= taken").withColumn("depth", F.col("given") + F.col("place") - F.col("taken") + 1)
    # at most shares - 1 turns of a base for each of its group
    first = own.where((F.col("place") < shares - 1) & (F.col("conv_id") % group == 0)).withColumnRenamed("conv_id", "base")
    lent = first.join(convs, "base").where("place < taken").withColumn("depth", F.col("place") + 1)
    none = convs.where("size = 0").select("conv_id", F.lit(0).cast("long").alias("depth"), "size", *[F.lit(0).cast("long").alias(c) for c in columns[3:]])
    return kept.select(*columns).unionByName(lent.select(*columns)).unionByName(none)


def whole(own: DataFrame) -> DataFrame:
    """Conversations as they are, in the form of ``rebuilt``."""
    return own.select("conv_id", (F.col("place") + 1).alias("depth"), F.col("n").alias("size"), "h1", "h2", "words")


def _along(rows: DataFrame, results: dict[str, tuple], descending: bool = False, chunk: int = CHUNK) -> DataFrame:
    """Adds running results along each conversation: name -> (aggregate, column, how two of its results combine)."""
    def order(c: str) -> Column:
        return F.col(c).desc() if descending else F.col(c).asc()

    rows = rows.withColumn("chunk", F.expr(f"depth div {chunk}"))
    within = Window.partitionBy("conv_id", "chunk").orderBy(order("depth")).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy(order("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("conv_id", "chunk").agg(*[fn(c).alias(name) for name, (fn, c, _) in results.items()])
    carry = sums.select("conv_id", "chunk", F.count("*").over(earlier).alias("nth"),
                        *[fn(name).over(earlier).alias(f"__{name}") for name, (fn, _, _) in results.items()]).where("nth > 0").drop("nth")
    rows = rows.withColumns({name: fn(c).over(within) for name, (fn, c, _) in results.items()}).join(carry, ["conv_id", "chunk"], "left")
    added = {name: F.when(F.col(f"__{name}").isNull(), F.col(name)).otherwise(both(F.col(name), F.col(f"__{name}")))
             for name, (_, _, both) in results.items()}
    return rows.withColumns(added).drop("chunk", *[f"__{name}" for name in results])


def _prefixes(rows: DataFrame, chunk: int) -> DataFrame:
    """Adds p1, p2, the id of the prefix that ends in a row, and q1, q2, that of the prefix before."""
    own = {"q1": F.when(F.col("depth") > 0, F.xxhash64("depth", "h1")).otherwise(0),
           "q2": F.when(F.col("depth") > 0, F.xxhash64("depth", "h2", F.lit(2))).otherwise(0)}
    xor = Column.bitwiseXOR
    rows = _along(rows.withColumns(own), {"p1": (F.bit_xor, "q1", xor), "p2": (F.bit_xor, "q2", xor)}, chunk=chunk)
    return rows.withColumns({"q1": xor(F.col("p1"), F.col("q1")), "q2": xor(F.col("p2"), F.col("q2"))})


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of one end after another, comma-joined, at most PACKED a row; they come sorted."""
    names = ["depth", "p1", "p2", "conv_id", "n", "ids"]

    def out(key, ids) -> pa.RecordBatch:
        rows = [[x] for x in (*key, ids[0], len(ids))]
        return pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in rows], pa.array([",".join(map(str, ids))])], names=names)

    here, ids = None, []
    for batch in batches:
        done = []
        for *key, conv in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if key != here or len(ids) == PACKED:
                if ids:
                    done.append(out(here, ids))
                here, ids = key, []
            ids.append(conv)
        if done:
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()
    if ids:
        yield out(here, ids)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per end: its smallest member, how many, and the digest of their ids; packed ids come sorted."""
    names = ["conv_id", "n", "sha"]
    here, first, n, digest = None, 0, 0, sha256()
    for batch in batches:
        done = []
        for *key, conv, count, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if key == here:
                digest.update(b",")
            else:
                if here:
                    done.append((first, n, digest.hexdigest()))
                here, first, n, digest = key, conv, 0, sha256()
            digest.update(ids.encode())
            n += count
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=names)
    if here:
        yield pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([n], pa.int64()), pa.array([digest.hexdigest()])], names=names)


def sweep(suffixes: list[tuple], top: int) -> Iterator[list]:
    """Nodes of one container, from its suffixes: (turn ids, smallest conversation, members, words of each turn, ends digest).

    Sorted, the suffixes are swept once with a stack of the open nodes.  A node is [depth, conversation, index of its parent (-1: the head
    above), members, children, leaves, saved, ends].  ``top``: the depth of the first turn.
    """
    nodes: list[list] = []
    stack: list[int] = []
    words: list[int] = []

    def close(depth: int) -> None:
        while len(stack) > depth:
            node = nodes[stack.pop()]
            node[5] = node[5] or 1
            node[6] += (node[3] - 1) * words.pop()
            if stack:
                above = nodes[stack[-1]]
                above[1] = min(above[1], node[1])
                above[3] += node[3]
                above[4] += 1
                above[5] += node[5]
                above[6] += node[6]

    before: tuple = ()
    for ids, conv, n, counts, ends in sorted(suffixes):
        same = 0
        while same < min(len(ids), len(before)) and ids[same] == before[same]:
            same += 1
        close(same)
        for k in range(same, len(ids)):
            nodes.append([top + k, conv, stack[-1] if stack else -1, 0, 0, 0, 0, EMPTY])
            stack.append(len(nodes) - 1)
            words.append(counts[k])
        end = nodes[stack[-1]]
        end[1], end[3], end[7] = min(end[1], conv), end[3] + n, ends
        before = ids
    close(0)
    return nodes


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of one container after another; rows come sorted by container, conversation and depth."""
    names = ["depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "q1", "q2"]

    def out(top: int, above: tuple, held: dict) -> pa.RecordBatch:
        nodes = sweep([(tuple(x[0]), conv, x[1], x[2], x[3]) for conv, x in held.items()], top)
        rows = [(d, conv, nodes[at][1] if at >= 0 else None, n, children, leaves, saved, ends, *(above if at < 0 else (None, None)))
                for d, conv, at, n, children, leaves, saved, ends in nodes]
        kinds = [pa.string() if c == "ends_sha256" else pa.int64() for c in names]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    here, above, held = None, (), {}
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("top", "c1", "c2", "conv_id", "h1", "h2", "words", "n", "sha", "q1", "q2")]
        for top, c1, c2, conv, h1, h2, words, n, sha, q1, q2 in zip(*columns, strict=True):
            if (top, c1, c2) != here:
                if held:
                    yield out(here[0], above, held)
                here, above, held = (top, c1, c2), (q1, q2), {}
            own = held.setdefault(conv, [[], n, [], EMPTY])
            own[0].append((h1, h2))
            own[2].append(words)
            own[3] = sha or own[3]
    if held:
        yield out(here[0], above, held)


def trie(rows: DataFrame, limit: int = LIMIT, chunk: int = CHUNK) -> DataFrame:
    """Nodes of the trie over ``rebuilt`` or ``whole`` rows: the columns RESULT.

    conv_id: the smallest member; parent_conv_id: the parent's (root: null);
    n_convs: members; n_children, n_leaves: children, and childless nodes in the subtree; saved_tokens:
    over the subtree, each node's (n_convs - 1) times the words of its last turn;
    ends_sha256: of the ids of the members that end there, ascending, comma-joined.
    """
    prefixes = _prefixes(rows, chunk).checkpoint()
    ends = prefixes.where("depth = size").select("depth", "p1", "p2", "conv_id")
    key = ["depth", "p1", "p2"]
    packed = ends.repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id").mapInArrow(
        _packed, "depth long, p1 long, p2 long, conv_id long, n long, ids string")
    folded = packed.repartition(*key).sortWithinPartitions(*key, "conv_id").mapInArrow(_digested, "conv_id long, n long, sha string").checkpoint()
    reps = prefixes.join(folded, "conv_id").withColumn("sha", F.when(F.col("depth") == F.col("size"), F.col("sha"))).checkpoint()
    big = reps.where("depth > 0").groupBy(*key).agg(F.sum(F.col("size") - F.col("depth") + 1).alias("turns")).where(F.col("turns") > limit)
    reps = reps.join(big.select(*key, F.lit(True).alias("head")), key, "left").checkpoint()
    suffixes = reps.where("head is null and depth > 0")
    place = suffixes.groupBy("conv_id").agg(F.min(F.struct(*key)).alias("c")).select(
        "conv_id", F.col("c.depth").alias("top"), F.col("c.p1").alias("c1"), F.col("c.p2").alias("c2"))
    container = ["top", "c1", "c2"]
    below = (suffixes.join(place, "conv_id").select(*container, "conv_id", "depth", "h1", "h2", "words", "n", "sha", "q1", "q2")
             .repartition(*container).sortWithinPartitions(*container, "conv_id", "depth")
             .mapInArrow(_swept, "depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
                                 "saved_tokens long, ends_sha256 string, q1 long, q2 long").checkpoint())
    tops = below.where("parent_conv_id is null").withColumn("depth", F.col("depth") - 1)
    # the heads: all prefixes that burst, and the root
    root = reps.groupBy("conv_id").agg(F.max("size").alias("size"), F.max("n").alias("n"), F.max("sha").alias("sha")).select(
        "conv_id", F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(c) for c in ("p1", "p2", "q1", "q2", "words")], "n",
        F.when(F.col("size") == 0, F.col("sha")).alias("sha"))
    lines = reps.where("head").select(*root.columns).unionByName(root).checkpoint()
    heads = lines.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"), F.max("words").alias("words"),
                                    F.max("sha").alias("sha"), F.max("q1").alias("q1"), F.max("q2").alias("q2"))
    above = F.struct((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2"))
    children = (heads.where("depth > 0").select(above.alias("up")).unionByName(tops.select(F.struct("depth", F.col("q1").alias("p1"), F.col("q2").alias("p2")).alias("up")))
                .groupBy("up").agg(F.count("*").alias("n_children")).select("up.*", "n_children"))
    heads = heads.join(children, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))).checkpoint()
    # what heads and containers add stands at the place of their smallest conversation; sums run up along it, and over all that meet in a head
    adds = (heads.select("conv_id", "depth", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
                         ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
            .unionByName(tops.select("conv_id", "depth", "n_leaves", "saved_tokens"))
            .groupBy("conv_id", "depth").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")))
    lines = lines.select("conv_id", *key).join(adds, ["conv_id", "depth"], "left").na.fill(0, ["n_leaves", "saved_tokens"])
    add = Column.__add__
    lines = _along(lines, {"leaves": (F.sum, "n_leaves", add), "saved": (F.sum, "saved_tokens", add)}, descending=True, chunk=chunk)
    sums = lines.groupBy(*key).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    parents = heads.select(F.col("depth").alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    inner = (heads.join(sums, key).withColumn("ends_sha256", F.coalesce("sha", F.lit(EMPTY))).withColumn("depth", F.col("depth") - 1)
             .join(parents, ["depth", "q1", "q2"], "left").withColumn("depth", F.col("depth") + 1))
    hung = tops.drop("parent_conv_id").join(parents, ["depth", "q1", "q2"]).withColumn("depth", F.col("depth") + 1)
    deeper = below.where("parent_conv_id is not null")
    return inner.select(*RESULT).unionByName(hung.select(*RESULT)).unionByName(deeper.select(*RESULT))
