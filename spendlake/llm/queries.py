"""Registered queries of the operators: whole tables, production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from spendlake.llm import bpe, collocations, embed_join, html_text, lm, mixing, ngram_join, quality, rollups, sharding
from spendlake.llm import token_files, toxicity, whitening
from spendlake.llm.common import stored
from spendlake.session import scratch_path


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {"pipeline": Query(corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)}


def query(name: str, sql: str | None = None):
    def register(run):
        REGISTRY[name] = Query(run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_ngram_jaccard_join")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"), words=4, percent=85)


@query("op2_mix_sources", mixing.MIX_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, most=2.0)


@query("op3_shard")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(table(spark, sf_dir, "documents"), shards=16)


@query("op4_lm_scores")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"))


@query("op5_byte_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"))


@query("op6_token_files")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_report(table(spark, sf_dir, "documents"), scratch_path(spark, "token-files"))


ROLLUP_SQL = r"""
WITH firsts AS (SELECT md5(text) AS h, min(doc_id) AS keeper FROM documents GROUP BY 1),
final AS (
  SELECT d.source, d.lang, regexp_replace(d.text, '[A-Za-z0-9_.+-]+@[A-Za-z0-9.-]+', '', 'g') AS text
  FROM documents d JOIN firsts f ON f.h = md5(d.text) AND f.keeper = d.doc_id
),
counts AS (
  SELECT source, lang, 'words-1' AS version, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS tokens FROM final
  UNION ALL
  SELECT source, lang, 'pieces-1', len(regexp_extract_all(text, '\p{L}+|\p{N}+|[^\p{L}\p{N}\x20\x09-\x0D]')) FROM final
)
SELECT source, lang, version, CAST(count(*) AS BIGINT) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens
FROM counts GROUP BY ALL
"""


def _rolled_up(spark: SparkSession, sf_dir: str, counted: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """All documents come in; exact copies but the first are deleted; texts with mail addresses are counted anew without
    them. The last two batches are committed twice, as after a crash."""
    docs = table(spark, sf_dir, "documents")
    rollup = rollups.Rollup(spark, scratch_path(spark, "rollup"))
    rollup.commit(1, counted(docs))
    hashed = docs.select("doc_id", F.md5(F.col("text").cast("binary")).alias("h"))
    keepers = hashed.groupBy("h").agg(F.min("doc_id").alias("keeper"))
    copies = stored(hashed.join(keepers, "h").where("doc_id <> keeper").select("doc_id"), "copies")
    mail = r"[A-Za-z0-9_.+-]+@[A-Za-z0-9.-]+"
    kept = docs.where(F.col("text").contains("@")).where(F.col("text").rlike(mail)).join(copies, "doc_id", "left_anti")
    revised = stored(counted(kept.withColumn("text", F.regexp_replace("text", mail, ""))), "revised")
    for _ in range(2):
        rollup.commit(2, deletes=copies)
    for _ in range(2):
        rollup.commit(3, revised)
    return rollup.totals(3)


@query("op7_token_rollups", ROLLUP_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolled_up(spark, sf_dir, rollups.counted)


@query("op7_tokenizer_rollups")
def op7_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batches, counted by the tokenizers of ops 5 and 6; SQL has neither."""
    vocabulary = bpe.Vocabulary(spark)
    return _rolled_up(spark, sf_dir, lambda docs: rollups.counted_ids(docs, vocabulary))


@query("op8_quality_outliers")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


@query("op9_html_main_text")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op10_embedding_near_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_join.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.93)


@query("op11_toxicity")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("op13_collocations", collocations.COLLOCATION_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
