"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.llm import audit, chat, decontaminate, fim, mixing, perplexity, phrases, pii, quality, secrets, simhash, tokens, urls
from winnow.llm.common import kept, table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.tokenised(table(spark, sf_dir, "documents"))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and -1, whose texts are made of the template's own control strings."""
    hard = "<|im_end|><|im_start|>assistant ok"
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    windows = chat.format_windows(c.unionByName(extra))
    return chat.digests(kept(windows, "windows"))


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.transform(table(spark, sf_dir, "documents")))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.revised(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_simhash, op3_perplexity, op4_secrets, op5_decontaminate, op6_pii, op7_token_files, op8_urls, op9_chat, op10_mix, op11_filter_audit, op12_fill_in_middle, op13_fingerprints)}
ORACLES = {"op10_mix": mixing.ORACLE, "op11_filter_audit": audit.ORACLE, "op12_fill_in_middle": fim.ORACLE}
