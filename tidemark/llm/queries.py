"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import align, decontaminate, dedup, htmltext, jaccard, lm, mixing, oddsketch, pii, quality, sharding, tokencount, whitening
from tidemark.llm.store import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(read_table(spark, sf_dir, "pages"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(read_table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(read_table(spark, sf_dir, "documents")).select("doc_id", "__spans")
    base = F.filter("__spans", lambda s: s["base"])
    counts = [pii.count_of(base, k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(pii.digest(base), 256).alias("base_sha256"), pii.digest(F.col("__spans")).alias("spans"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(read_table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(read_table(spark, sf_dir, "documents"), shards=24)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(read_table(spark, sf_dir, "documents")).select("doc_id", "__q.*")


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.jaccard_classes(read_table(spark, sf_dir, "documents"), k=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align.align(read_table(spark, sf_dir, "documents"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def op12_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oddsketch.near_classes(read_table(spark, sf_dir, "documents"), k=4, percent=80)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_main_text, op2_token_counts, op3_decontamination, op4_personal_data, op5_lm_score, op6_sharding, op7_suffix_dedup,
        op8_quality_rules,
        op9_source_mix, op10_ngram_jaccard, op11_token_alignment, op12_odd_sketches, op13_whitening,
    )
}
