"""N-gram Jaccard join: a blocked sparse product of document by n-gram incidence.

1.  Columns.  Document frequencies of all n-grams are counted over the whole
    corpus (``hash_tables.py``).  Two sets of sizes a and b with a Jaccard
    similarity of at least t share at least t / (1 + t) * (a + b) n-grams, so each
    has one of them among its ``n - ceil(t * n) + 1`` rarest (in one order for all:
    frequency, then hash).  Only those columns are kept, and of them only
    those that some other document has.
2.  Equal sets become one row of the matrix, a class.
3.  Blocks.  Within a column, classes in order of size are chained where sizes
    allow a link; the connected parts of these chains hold every pair that can
    link.  A part is one block; a large one is split by size class and hash,
    and only blocks whose size classes are equal or next to each other meet.
4.  Product.  For each pair of blocks the incidence matrices of the whole sets are
    multiplied in strips of columns, accumulating overlap counts; pairs below
    the size-derived bound are dropped.  A task gives link counts and a
    spanning forest of its links, never all pairs, so no link is lost and big
    groups of near copies do not blow up.

Sets are of 64-bit hashes: n-grams of one text pair that share a hash (about
n * n / 2**64) would count as equal.

Defined cases: a text of fewer than n words is one n-gram, its whole sequence; null
texts and texts without words have an empty set and link with nothing.
Rows with a null id link with nothing and have a null component.  Rows that
repeat a doc_id are one node, whose component is the union of theirs.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fetchplan.llm.columns import release
from fetchplan.llm.components import connected_components, contract, forest
from fetchplan.llm.hash_tables import BUCKET_BYTES, RANGE_ROWS, corpus_counts, corpus_size, deal, open_bucket, text_words, totals_of
from fetchplan.llm.hashing import mix, ngrams
from fetchplan.session import checkpoint_dir

#: Classes on one side of a block product.
BLOCK = 512
#: Cells of an incidence strip.
STRIP = 4 << 20


def shingle_sets(words: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of every text, sorted within each, and the offsets of the texts' sets."""
    size = np.diff(ends)
    doc = np.repeat(np.arange(len(size)), size)
    x = ngrams(words, n)
    whole = doc[:len(x)] == doc[n - 1:]
    x, of = x[whole], doc[:len(x)][whole]
    few = np.flatnonzero((size > 0) & (size < n))
    if len(few):
        short = [mix(ngrams(words[ends[k]:ends[k + 1]], int(size[k]))) for k in few]
        x, of = np.concatenate([x, *short]), np.concatenate([of, few])
    order = np.lexsort((x, of))
    x, of = x[order], of[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (of[1:] != of[:-1])
    x, of = x[new], of[new]
    return x, np.searchsorted(of, np.arange(len(size) + 1))


def _ceil(a, b):
    return -(-a // b)


def block_links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i in left, j in right, i != j) of sets with a Jaccard similarity of at least ``percent`` / 100."""
    size = np.array([len(s) for s in sets], np.int64)
    column, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    _, column, count = np.unique(column, return_inverse=True, return_counts=True)
    some = count[column] > 1
    row = row[some]
    column = np.unique(column[some], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    n_columns = int(column[-1]) + 1 if len(column) else 0
    place = np.full((2, len(sets)), -1)
    place[0, left], place[1, right] = np.arange(len(left)), np.arange(len(right))
    overlap = np.zeros((len(left), len(right)), np.float32)  # exact below 2**24; larger sets take the strips' sum in float64
    if len(size) and size.max() >= 1 << 24:
        overlap = overlap.astype(np.float64)
    step = max(1, STRIP // max(1, len(sets)))
    for a in range(0, n_columns, step):
        i0, i1 = np.searchsorted(column, [a, a + step])
        r, c = row[i0:i1], column[i0:i1] - a
        strips = []
        for side, members in ((0, left), (1, right)):
            strip = np.zeros((len(members), min(step, n_columns - a)), np.float32)
            own = place[side, r] >= 0
            strip[place[side, r[own]], c[own]] = 1
            strips.append(strip)
        overlap += strips[0] @ strips[1].T
    bound = _ceil(percent * (size[left][:, None] + size[right][None, :]), 100 + percent)
    i, j = np.nonzero(overlap >= bound)
    i, j = left[i], right[j]
    once = i < j if np.array_equal(left, right) else i != j
    return i[once], j[once]


def document_sets(docs: DataFrame, n: int, percent: int, bucket_bytes: int, range_rows: int) -> DataFrame:
    """(doc_id, n, d1, d2, columns, items): set size and digest; for documents that may link, kept columns and the set."""
    size, words = corpus_size(docs)
    dealt = deal(docs, max(1, _ceil(size, bucket_bytes)))

    def count(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        _, data, offsets = open_bucket(table)
        return np.unique(shingle_sets(*text_words(data, offsets), n)[0], return_counts=True)

    def rarest(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        ids, data, offsets = open_bucket(left)
        x, at = shingle_sets(*text_words(data, offsets), n)
        sizes = np.diff(at)
        df = totals_of(right)[np.unique(x, return_inverse=True)[1]] if len(x) else np.zeros(0, np.int64)
        of = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((x, df, of))
        kept = np.arange(len(x)) - at[:-1][of] < (sizes - _ceil(percent * sizes, 100) + 1)[of]
        chosen = order[kept & (df[order] > 1)]
        has = np.bincount(of[chosen], minlength=len(sizes))
        signed = x.view(np.int64)
        d1 = np.add.reduceat(np.append(mix(x), np.uint64(0)), at[:-1]) if len(sizes) else np.zeros(0, np.uint64)
        d2 = np.add.reduceat(np.append(mix(x ^ np.uint64(0xA5A5A5A5A5A5A5A5)), np.uint64(0)), at[:-1]) if len(sizes) else d1
        items = [x[a:b].tobytes() if h else None for a, b, h in zip(at[:-1], at[1:], has, strict=True)]
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(has)]), pa.int32()), pa.array(signed[chosen]))
        del data, offsets, x, df, of, order, kept
        release()
        return pa.table({"doc_id": ids, "n": pa.array(sizes, pa.int64()), "d1": pa.array(d1.view(np.int64)),
                         "d2": pa.array(d2.view(np.int64)), "columns": lists, "items": pa.array(items, pa.binary())})

    counted = corpus_counts(dealt, count, max(1, _ceil(words, range_rows)))
    return dealt.groupBy("bucket").cogroup(counted.groupBy("bucket")).applyInArrow(
        rarest, "doc_id long, n long, d1 long, d2 long, columns array<long>, items binary")


def _chains(percent: int):
    """Links neighbours of each column whose sizes allow it; reads rows sorted by (column, size, id)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            s, n, i = (batch.column(k).to_numpy() for k in range(3))
            if last is not None:
                s, n, i = (np.concatenate([[x], y]) for x, y in zip(last, (s, n, i), strict=True))
            if not len(s):
                continue
            ok = (s[1:] == s[:-1]) & (100 * n[:-1] >= percent * n[1:]) & (i[1:] != i[:-1])
            a, b = np.minimum(i[:-1], i[1:])[ok], np.maximum(i[:-1], i[1:])[ok]
            both = np.unique(np.stack([a, b], axis=1), axis=0)
            last = s[-1], n[-1], i[-1]
            yield pa.RecordBatch.from_pydict({"a": pa.array(both[:, 0], pa.int64()), "b": pa.array(both[:, 1], pa.int64())})

    return run


def class_links(classes: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """(node, links, peer) rows of classes (id, m, n, columns, items): link counts, or one edge of a spanning forest."""
    entries = classes.select(F.explode("columns").alias("s"), "n", "id")
    chain, stars = _chains(percent), contract()
    chains = entries.repartition("s").sortWithinPartitions("s", "n", "id").mapInArrow(lambda rows: stars(chain(rows)), "u long, v long")
    parts = connected_components(chains, "u", "v", contracted=True)
    rows = classes.select("id", "m", "n", "items").join(parts, F.col("id") == F.col("node")).drop("node")
    rows = rows.withColumn("c", F.floor(F.log("n") / F.lit(float(np.log(100 / percent)) + 1e-9)).cast("int"))
    counts = rows.groupBy("component", "c").agg(F.count("*").alias("k"))
    shape = counts.groupBy("component").agg(
        F.sum("k").alias("total"),
        F.map_from_entries(F.collect_list(F.struct("c", F.ceil(F.col("k") / block).cast("int").alias("b")))).alias("blocks"))
    rows = rows.join(shape, "component")

    def blocks_of(c):
        return F.coalesce(F.try_element_at("blocks", c), F.lit(0))

    def each(c, unit):
        return F.transform(F.filter(F.sequence(F.lit(0), F.greatest(blocks_of(c), F.lit(1)) - 1), lambda j: j < blocks_of(c)), unit)

    def unit(c1, b1, c2, b2):
        return F.struct(c1.alias("c1"), b1.alias("b1"), c2.alias("c2"), b2.alias("b2"))

    c, b, none = F.col("c"), F.pmod(F.xxhash64("id"), blocks_of(F.col("c"))).cast("int"), F.lit(-1)
    meets = F.concat(each(c, lambda j: unit(c, F.least(b, j), c, F.greatest(b, j))), each(c + 1, lambda j: unit(c, b, c + 1, j)),
                     each(c - 1, lambda j: unit(c - 1, j, c, b)))
    units = F.when(F.col("total") <= block, F.array(unit(none, none, none, none))).otherwise(meets)
    placed = rows.select("component", F.explode(units).alias("u"), c, b.alias("b"), "id", "m", "items").select(
        "component", "u.*", "c", "b", "id", "m", "items")

    def product(key: tuple, table: pa.Table) -> pa.Table:
        _, c1, b1, c2, b2 = (k.as_py() for k in key)
        table = table.sort_by("id")
        ids, m, at, bs = (table.column(x).to_numpy() for x in ("id", "m", "c", "b"))
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("items")]
        every = np.arange(len(ids))
        left = every if c1 < 0 else np.flatnonzero((at == c1) & (bs == b1))
        right = every if c1 < 0 else np.flatnonzero((at == c2) & (bs == b2))
        i, j = block_links(sets, left, right, percent)
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, i, m[j])
        np.add.at(links, j, m[i])
        label = forest(len(ids), i, j)
        moved = np.flatnonzero(label != every)
        some = np.flatnonzero(links)
        none = np.zeros(len(some), np.int64)
        return pa.table({"node": pa.array(np.concatenate([ids[some], ids[moved]]), pa.int64()),
                         "links": pa.array(np.concatenate([links[some], np.zeros(len(moved), np.int64)]), pa.int64()),
                         "peer": pa.array(np.concatenate([none, ids[label[moved]]]), pa.int64(),
                                          mask=np.arange(len(some) + len(moved)) < len(some))})

    return placed.groupBy("component", "c1", "b1", "c2", "b2").applyInArrow(product, "node long, links long, peer long")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4, percent: int = 85, block: int = BLOCK,
                 bucket_bytes: int = BUCKET_BYTES, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links) and n_links (other documents linked directly)."""
    checkpoint_dir(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sets = document_sets(rows, n, percent, bucket_bytes, range_rows).checkpoint()
    may = F.col("doc_id").isNotNull() & F.col("items").isNotNull()
    classes = (sets.where(may).groupBy("d1", "d2")
               .agg(F.min("doc_id").alias("id"), F.count("*").alias("m"), F.first("n").alias("n"), F.first("columns").alias("columns"),
                    F.first("items").alias("items")).checkpoint())
    found = class_links(classes, percent, block).checkpoint()
    links = found.where("peer is null").groupBy(F.col("node").alias("id")).agg(F.sum("links").alias("links"))
    again = sets.where(may).groupBy("doc_id").agg(F.countDistinct("d1", "d2").alias("k")).where("k > 1").select("doc_id")
    same = (sets.where(may).join(again, "doc_id").join(classes.select("d1", "d2", "id"), ["d1", "d2"])
            .select(F.col("doc_id").alias("node"), F.col("id").alias("peer")))  # rows of one doc_id tie their classes together
    component = connected_components(found.where("peer is not null").select("node", "peer").unionByName(same), "node", "peer")
    facts = (classes.select("d1", "d2", "id", "m").join(links, "id", "left")
             .join(component.withColumnRenamed("node", "id"), "id", "left")
             .select("d1", "d2", F.coalesce("component", "id").alias("component_id"),
                     (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    linked = sets.where(may).select("doc_id", "n", "d1", "d2").join(facts, ["d1", "d2"]).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links")
    return linked.unionByName(sets.where(~may).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links")))
