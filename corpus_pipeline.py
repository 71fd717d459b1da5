"""Corpus pipeline: quality rules, one document per group of near copies, mixing of sources, byte-level BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spendlake.llm import bpe, mixing, ngram_join, quality
from spendlake.llm.common import discard, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return quality.keep_good(docs)


def ngram_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 5-word n-grams at a similarity of 0.8 or more: the smallest id."""
    return ngram_join.one_per_component(docs, words=5, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix_rows(docs, weights=(5, 2, 1), share=1.5, most=2.0)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to."""
    return bpe.encode_digests(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_near_copies),
    ("source mix", source_mix),
    ("byte-level BPE", byte_bpe),
]

#: The groups of near copies and the ids have no SQL counterpart; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    last = []
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        discard(*last)
        last = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
