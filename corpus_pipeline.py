"""Training-data pipeline: language, quality, near duplicates, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows it is given; its
result is written as Parquet and read again as the next stage's docs.  All but
the last return the columns of documents, extra ones included.

* language: a document goes if no language is found in it (no text, or no
  letter).  Languages that fit a short text alike are no reason to drop it.
* quality: a document goes if its probability of the top grade is below one half.
  Ratings come from the table labels.
* near_duplicates: of each group linked by five-word shingles at a Jaccard
  similarity of 0.8, the document of smallest id stays.  Rows that repeat an id and
  its text count as one; other texts of a repeated id are documents of their own,
  behind all others in the order of ids.  Rows with a null id all stay.
* packing: one row per piece of a document in sequences of 4096 tokens.

Null and empty texts go in the first stage.  Empty tables give empty results.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fetchplan.llm import langid, ngram_join, packing, quality
from fetchplan.plans.strategy import bounded_broadcast
from fetchplan.session import checkpoint_dir

MIN_TAIL_PROBABILITY = 0.5
#: Ids of the further texts of a repeated id begin here.
FURTHER = 1 << 62
#: Bytes of ids to drop that are broadcast; more are joined by a shuffle.
MAX_BROADCAST_BYTES = 64 << 20
#: Pieces of text that the packing stage's memo holds: workers live on between stages.
PACKING_MEMO = 150_000


def _renamed(docs: DataFrame, *results: str) -> tuple[DataFrame, list[str], list[str]]:
    """Docs whose columns that clash with an operator's results stand aside under other names."""
    taken = {r.lower() for r in results}
    aside = [f"__kept_{k}" if c.lower() in taken else c for k, c in enumerate(docs.columns)]
    return docs.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(docs.columns, aside, strict=True)]), docs.columns, aside


def _back(df: DataFrame, columns: list[str], aside: list[str]) -> DataFrame:
    return df.select(*[F.col(f"`{a}`").alias(c) for c, a in zip(columns, aside, strict=True)])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own, columns, aside = _renamed(docs, "lang_pred", "score")
    found = langid.identify(own, langid.learn(docs))
    return _back(found.where(F.col("lang_pred") != "und"), columns, aside)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    ratings = labels.select("doc_id", quality.grade(F.col("quality"), F.col("toxic")).alias("grade"))
    own, columns, aside = _renamed(docs, "expected_grade", "tail_probability", "selected")
    rated = quality.classify(own, quality.fit(docs, ratings), least=MIN_TAIL_PROBABILITY)
    return _back(rated.where("selected"), columns, aside)


def _numbered(docs: DataFrame) -> DataFrame:
    """Adds ``__id``: doc_id, but for all but one of the different texts of a repeated id a number of their own."""
    given = docs.withColumns({"__own": F.col("doc_id").cast("long"), "__hash": F.xxhash64(F.lit(0), "text")})
    several = (given.where("__own is not null").groupBy("__own").agg(F.min("__hash").alias("__first"), F.max("__hash").alias("__last"))
               .where("__first != __last").select(F.col("__own").alias("__several"), "__first")).checkpoint()
    given = given.join(bounded_broadcast(several, MAX_BROADCAST_BYTES), F.col("__own") == F.col("__several"), "left")
    further = F.lit(FURTHER) + F.shiftrightunsigned(F.xxhash64("__own", "text"), 3)
    own = F.when(F.col("__several").isNull() | (F.col("__hash") == F.col("__first")), F.col("__own")).otherwise(further)
    return given.withColumn("__id", own).drop("__own", "__hash", "__several", "__first")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    checkpoint_dir(spark)
    numbered = _numbered(docs)
    found = ngram_join.jaccard_join(numbered.select("__id", "text"), id_col="__id", n=5, percent=80)
    drop = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id", F.lit(True).alias("__drop"))
    again = (found.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1")
             .select("doc_id", F.lit(False).alias("__drop")))
    marks = drop.unionByName(again).groupBy("doc_id").agg(F.max("__drop").alias("__drop")).checkpoint()
    marks = marks.select(F.col("doc_id").alias("__mark"), "__drop")
    marked = numbered.join(bounded_broadcast(marks, MAX_BROADCAST_BYTES), F.col("__id") == F.col("__mark"), "left")
    once = marked.where("__drop is null")
    repeated = marked.where("not __drop").dropDuplicates(["__id"])  # combined in every task first
    return once.unionByName(repeated).select(*[F.col(f"`{c}`") for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), memo=PACKING_MEMO)


STAGES = [("language", language), ("quality", quality_filter), ("near_duplicates", near_duplicates), ("packing", packed)]

#: Tokenizers and classifiers have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between stages the rows are written to the session's shared folder."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
