"""Registered queries of the numbered operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fetchplan.llm import (
    ann,
    bpe,
    burst_trie,
    embedding_join,
    langid,
    license_scan,
    lm,
    merkle,
    ngram_join,
    packing,
    quality,
    token_counts,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def oracle(name: str, sql: str) -> None:
    """DuckDB SQL with the rows of query ``name``, where SQL can express them."""
    ORACLE[name] = sql


#: Words as hashing.py takes them: A-Z lower-cased, split at blanks.
_WORDS = """words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^ \\t\\n\\x0B\\f\\r]+') AS w FROM documents)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                     keep=["doc_id"])


@query
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by four-word shingles at a Jaccard similarity of 0.85, with their components."""
    return ngram_join.jaccard_join(table(spark, sf_dir, "documents"), n=4, percent=85)


oracle("op2_ngram_jaccard", f"""WITH RECURSIVE {_WORDS},
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) >= 4 THEN list_aggregate(w[i:i + 3], 'string_agg', ' ')
                                   ELSE list_aggregate(w, 'string_agg', ' ') END AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM words WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 85 * (a.n + b.n - o)),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles,
       least(d.doc_id, coalesce((SELECT min(y) FROM reach r WHERE r.x = d.doc_id), d.doc_id)) AS component_id,
       (SELECT count(*) FROM links l WHERE l.x = d.doc_id) AS n_links
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id""")


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in every document."""
    return license_scan.license_scan(table(spark, sf_dir, "documents"), keep=["doc_id"], with_spans=False)


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, and what they decode to, as digests."""
    return bpe.bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                              public_tokenizers.PATTERN, keep=["doc_id"])


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings linked at a cosine of 0.95, with their components."""
    return embedding_join.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


oracle("op6_embedding_near_dedup", """WITH RECURSIVE
v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS size FROM v
       WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND a.size > 0 AND b.size > 0
          WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.95),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
c AS (SELECT v.vec_id, least(v.vec_id, coalesce((SELECT min(y) FROM reach r WHERE r.x = v.vec_id), v.vec_id)) AS component_id FROM v)
SELECT vec_id, (SELECT count(*) FROM links l WHERE l.x = c.vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM c""")


@query
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest embeddings of every row whose vec_id is divisible by 50."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probability of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ratings = labels.select("doc_id", quality.grade(F.col("quality"), F.col("toxic")).alias("grade"))
    return quality.classify(docs, quality.fit(docs, ratings), keep=["doc_id"])


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out(F.col("doc_id")))
    references = langid.learn(docs.where(~F.col("held_out") & F.col("doc_id").isNotNull()))
    return langid.identify(docs, references, keep=["doc_id", "held_out"])


@query
def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of every document against all others, sums rounded to 4 places."""
    scores = lm.backoff_scores(table(spark, sf_dir, "documents"))
    return scores.withColumns({c: F.round(c, 4) for c in ("log_score", "mean_log_score")})


oracle("op10_lm_scores", f"""WITH {_WORDS},
t AS (SELECT doc_id, i, w, lag(w) OVER o AS p, lag(w, 2) OVER o AS q
      FROM (SELECT doc_id, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS i FROM words) WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
c1 AS (SELECT w, count(*) AS c FROM t GROUP BY w), o1 AS (SELECT doc_id, w, count(*) AS c FROM t GROUP BY ALL),
c2 AS (SELECT p, w, count(*) AS c FROM t WHERE i > 1 GROUP BY ALL), o2 AS (SELECT doc_id, p, w, count(*) AS c FROM t WHERE i > 1 GROUP BY ALL),
c3 AS (SELECT q, p, w, count(*) AS c FROM t WHERE i > 2 GROUP BY ALL),
o3 AS (SELECT doc_id, q, p, w, count(*) AS c FROM t WHERE i > 2 GROUP BY ALL),
size AS (SELECT doc_id, len(w) AS n, sum(len(w)) OVER () AS corpus FROM words),
counted AS (
  SELECT t.doc_id, t.i, c1.c - o1.c AS n1, c2.c - o2.c AS n2, c3.c - o3.c AS n3,
         lag(c1.c - o1.c) OVER o AS before1, lag(c2.c - o2.c) OVER o AS before2, greatest(size.corpus - size.n, 1) AS rest
  FROM t JOIN size USING (doc_id) JOIN c1 USING (w) JOIN o1 USING (doc_id, w)
  LEFT JOIN c2 ON c2.p = t.p AND c2.w = t.w LEFT JOIN o2 ON o2.doc_id = t.doc_id AND o2.p = t.p AND o2.w = t.w
  LEFT JOIN c3 ON c3.q = t.q AND c3.p = t.p AND c3.w = t.w
  LEFT JOIN o3 ON o3.doc_id = t.doc_id AND o3.q = t.q AND o3.p = t.p AND o3.w = t.w
  WINDOW o AS (PARTITION BY t.doc_id ORDER BY t.i)),
one AS (SELECT *, ln(greatest(CAST(n1 AS DOUBLE), 0.5)) - ln(rest) AS s1 FROM counted),
two AS (SELECT *, CASE WHEN i < 2 THEN s1 WHEN n2 > 0 THEN ln(n2) - ln(before1) ELSE s1 + ln(0.4) END AS s2 FROM one),
three AS (SELECT *, CASE WHEN i < 3 THEN s2 WHEN n3 > 0 THEN ln(n3) - ln(before2) ELSE s2 + ln(0.4) END AS s3 FROM two),
sums AS (SELECT doc_id, sum(s3) AS s, count(*) FILTER (WHERE n3 > 0) AS f FROM three GROUP BY doc_id)
SELECT size.doc_id, CAST(size.n AS BIGINT) AS n_words, coalesce(f, 0) AS n_full, round(coalesce(s, 0.0), 4) AS log_score,
       CASE WHEN size.n > 0 THEN round(s / size.n, 4) END AS mean_log_score
FROM size LEFT JOIN sums ON sums.doc_id = size.doc_id""")


#: Unsigned crc32 of a text of ASCII characters, bit by bit.
def _crc32(text: str) -> str:
    return f"""xor(list_reduce(list_transform(range(1, length({text}) + 1), lambda i: CAST(ascii(substr({text}, i, 1)) AS BIGINT)),
      lambda a, x: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(a, x)),
      4294967295), 4294967295)"""


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and check of every document, a fifth of them with the text in small letters after the manifest was made."""
    decimal = F.col("doc_id").cast("string").cast("binary")
    return merkle.manifest(table(spark, sf_dir, "documents"), tampered=F.crc32(decimal) % 5 == 0)


def _merkle_sql(name: str, key: str, levels: int = 8) -> str:
    """Tables {name}0..{name}{levels} (key, i, h) of runs of 16, from {name}0; a key of one node stays as it is."""
    return ",\n".join(f"""{name}{k + 1} AS (SELECT {key}, i // 16 AS i, CASE WHEN max(c) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h
  FROM (SELECT *, count(*) OVER (PARTITION BY {key}) AS c FROM {name}{k}) GROUP BY {key}, i // 16)""" for k in range(levels))


def _merkle_fold_sql(name: str, key: str, start: str, levels: int = 8) -> str:
    """Rows of ``start`` (key, i, p, f): p grows by the siblings at each level, f folds them."""
    steps, before = [], start
    for k in range(levels):
        run = f"FROM {name}{k} s WHERE s.{key} = b.{key} AND s.i // 16 = b.i // 16 AND s.i"
        side = "(SELECT coalesce(string_agg(s.h, '' ORDER BY s.i), '') {run} {op} b.i)"
        steps.append(f"""{name}f{k} AS (SELECT * EXCLUDE (l, r, c) REPLACE (i // 16 AS i, p || l || r AS p,
    CASE WHEN c = 1 THEN f ELSE sha256(l || f || r) END AS f)
  FROM (SELECT b.*, {side.format(run=run, op='<')} AS l, {side.format(run=run, op='>')} AS r,
               (SELECT count(*) FROM {name}{k} s WHERE s.{key} = b.{key}) AS c FROM {before} b))""")
        before = f"{name}f{k}"
    return ",\n".join(steps)


_LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FIELD = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"
_HEAD = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))

oracle("op12_merkle_manifest", f"""WITH
d AS (SELECT doc_id, coalesce('1' || source, '') AS k, sha256({_HEAD} || {_FIELD.format('text')}) AS h,
       CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN sha256({_HEAD} || {_FIELD.format(_LOW)}) END AS changed FROM documents),
a0 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM d),
{_merkle_sql('a', 'k')},
b0 AS MATERIALIZED (SELECT 0 AS one, k, row_number() OVER (ORDER BY k) - 1 AS i, h FROM a8),
{_merkle_sql('b', 'one')},
leaves AS (SELECT k, i, doc_id, h AS leaf, '' AS p, coalesce(changed, h) AS f FROM a0),
{_merkle_fold_sql('a', 'k', 'leaves')},
subs AS (SELECT 0 AS one, b0.i, af7.* EXCLUDE (i), b0.h AS subroot FROM af7 JOIN b0 USING (k)),
{_merkle_fold_sql('b', 'one', 'subs')}
SELECT doc_id, leaf, subroot, b8.h AS root, sha256(p) AS proof_sha256, f AS folded_root, f = b8.h AS verified FROM bf7, b8""")


@query
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record of WARC archives, written and read back."""
    records = warc.round_trip(table(spark, sf_dir, "pages"), min_bytes=0)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(s, {at}, 5) AS INTEGER) >> {k}) & 31 AS INTEGER) + 1, 1)"
                      for at in range(1, 41, 5) for k in (15, 10, 5, 0))

oracle("op13_warc", f"""WITH
p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS s,
             row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST) AS nth,
             max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)
SELECT page_id, strlen(html) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN nth > 1 THEN last END AS refers_to FROM p""")


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie over all conversations, each begun with the first turns of its group's first one."""
    own = burst_trie.turns(table(spark, sf_dir, "conversations"))
    return burst_trie.trie(burst_trie.rebuilt(own, group=20, shares=4))


oracle("op11_conversation_trie", f"""WITH
t AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i FROM conversations WHERE conv_id IS NOT NULL),
v AS (SELECT c, {_crc32('CAST(c AS VARCHAR)')} % 4 AS h FROM (SELECT DISTINCT c FROM t)),
b AS (SELECT v.c, t.i, t.r, t.x FROM v JOIN t ON t.c = v.c - v.c % 20 AND t.i <= v.h
      UNION ALL SELECT v.c, t.i, t.r, t.x FROM v JOIN t ON t.c = v.c AND t.i > v.h),
s AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY i) AS d, sha256(strlen(r) || ':' || r || x) AS u,
             len(regexp_extract_all(x, '[^ \\t\\n\\x0B\\f\\r]+')) AS w FROM b),
p AS (SELECT c, d, w, sha256(string_agg(u, ',') OVER (PARTITION BY c ORDER BY d)) AS p FROM s UNION ALL SELECT c, 0, 0, '' FROM v),
node AS (SELECT d, p, min(c) AS c, count(*) AS n, max(w) AS w FROM p GROUP BY d, p),
up AS (SELECT node.d, node.p, a.p AS q FROM node JOIN p a ON a.c = node.c AND a.d = node.d - 1),
kids AS (SELECT d - 1 AS d, q AS p, count(*) AS k FROM up GROUP BY ALL),
sub AS (SELECT a.d, a.p, count(*) FILTER (WHERE kids.k IS NULL) AS leaves, sum((m.n - 1) * m.w) AS saved
        FROM node m LEFT JOIN kids ON kids.d = m.d AND kids.p = m.p JOIN p a ON a.c = m.c AND a.d <= m.d GROUP BY ALL),
ends AS (SELECT d, p, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS e
         FROM (SELECT *, max(d) OVER (PARTITION BY c) AS l FROM p) WHERE d = l GROUP BY d, p)
SELECT node.c AS conv_id, node.d AS depth, f.c AS parent_conv_id, node.n AS n_convs, coalesce(k, 0) AS n_children, leaves AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, coalesce(e, sha256('')) AS ends_sha256
FROM node JOIN sub USING (d, p) LEFT JOIN kids USING (d, p) LEFT JOIN ends USING (d, p)
LEFT JOIN up USING (d, p) LEFT JOIN node f ON f.d = node.d - 1 AND f.p = up.q""")
