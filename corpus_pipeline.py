"""A corpus pipeline over ``documents``: quality rules, near-duplicates,
benchmark decontamination, mixing, token files.

Every stage but the last returns the columns of its input, whatever else they
are called, and an empty table gives an empty one.  A verdict on a text belongs
to the row that holds it: quality and decontamination judge a row by its text
(quality also by lang and source), so rows without doc_id, or that repeat one,
are each judged by what they hold.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.llm import common, decontaminate, mixing, quality, simhash, tokens
from winnow.llm.common import shared_dir, table


def _content(docs: DataFrame, *names: str) -> Column:
    """A hash of 128 bits of these columns of numbered(docs); a null differs from an empty text."""
    cols = [x for n in names for c in [F.col(f"c{common.place(docs, n)}").cast("string")] for x in (c, c.isNull())]
    return F.concat(F.lpad(F.hex(F.xxhash64(*cols)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit("again"), *cols)), 16, "0"))


def _where(docs: DataFrame, key: Column, keys: DataFrame, how: str) -> DataFrame:
    """The rows of docs whose key is (left_semi) or isn't (left_anti) in the column doc_id of keys."""
    d = common.numbered(docs)
    return d.join(keys.select(F.col("doc_id").alias("key")).distinct(), key == F.col("key"), how).toDF(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    A null or empty text goes, as one of too few words; a null lang or source is a group
    of its own; a long text is judged whole; equal rows, and rows at equal distances, fare alike.
    """
    key = _content(docs, "text", "lang", "source")
    d = common.numbered(docs).select(key.alias("doc_id"), *[F.col(f"c{common.place(docs, n)}").alias(n) for n in ("text", "lang", "source")])
    return _where(docs, key, quality.quality_rules(d).where("kept"), "left_semi")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that of the least doc_id. Links
    are at five-word shingles and a similarity of 0.8.

    Rows that repeat a doc_id are one document: they stay or go together.  A row without doc_id
    can't be the one that stays for others, so it is compared with none and stays.  Texts without words,
    null ones included, are copies of each other; a long text is compared whole.
    """
    first = simhash.near_copies(docs).select(F.col("component_id").alias("doc_id"))
    doc_id = F.col(f"c{common.place(docs, 'doc_id')}")
    d = common.numbered(docs)
    found = _where(docs, doc_id, first.where("doc_id IS NOT NULL"), "left_semi")
    return found.union(d.where(doc_id.isNull()).toDF(*docs.columns))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark.

    A null or empty text shares none and stays; a long one is searched whole; a document that shares passages with several
    items goes once; an empty benchmark takes nothing.
    """
    key = _content(docs, "text")
    d = common.numbered(docs).select(key.alias("doc_id"), F.col(f"c{common.place(docs, 'text')}").alias("text"))
    return _where(docs, key, decontaminate.overlaps(d, table(spark, sf_dir, "benchmark")), "left_anti")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    Rows are drawn one by one, repeated ones and those without doc_id too; a null or
    empty text has size 0 and may be drawn; a null source is one of its own.
    """
    return mixing.mixed(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files of the mix: doc_id, start, n_tokens, ids_crc32 and the file of every document taken.

    A null or empty text has its end id only; rows without doc_id come first; repeated ones follow one another.
    """
    return tokens.tokenised(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_files", token_stage),
]

#: Robust covariances, components and byte-pair merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each is written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
