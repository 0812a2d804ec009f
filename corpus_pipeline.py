"""A corpus pipeline: documents to shards, in stages that each read what the last one wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.decontaminate import without_leaks
from tidemark.llm.jaccard import one_per_class
from tidemark.llm.mixing import mixed_documents
from tidemark.llm.quality import quality_filter
from tidemark.llm.sharding import shard_by_bytes
from tidemark.llm.store import read_table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their source's thresholds reject go."""
    return quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, 0.8)."""
    return one_per_class(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot."""
    return shard_by_bytes(docs, shards=24, carry=[c for c in docs.columns if c != "doc_id"])


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source mix", source_mix),
    ("shards", shards),
]

#: Sketches, hashes of shingles and sampling keys have no counterpart in DuckDB.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
