"""Sharding by jump consistent hashing: no ring table, and one shard more takes only the rows it has to."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm.common import free_name, small_side, stored

#: Rows whose slots one task counts off at a time, on average.
SLOTS = 200_000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key: jump ahead to the next count of shards at which the key moves, until past the count."""
    state = keys.astype(np.uint64)
    shard, ahead = np.zeros(len(state), np.int64), np.zeros(len(state), np.int64)
    moving = np.ones(len(state), bool)
    while moving.any():
        shard[moving] = ahead[moving]
        state[moving] = state[moving] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = (state[moving] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[moving] = ((shard[moving] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        moving = ahead < shards
    return shard


def shard_of(key, shards: int):
    """Column with the shard, from 0, of a key column; a null key has one shard as well."""
    if shards < 1:
        raise ValueError("there has to be a shard")

    @F.pandas_udf("int")
    def run(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy().view(np.uint64), shards), dtype="int32")

    return run(F.xxhash64(key))


def shard_rows(docs: DataFrame, shards: int, key: str = "doc_id", column: str = "shard") -> DataFrame:
    """All rows and columns, and the shard of each; the shard's column gets a free name if it would clash."""
    return docs.withColumn(free_name(docs, column), shard_of(F.col(key), shards))


def write_shards(docs: DataFrame, path: str, shards: int, key: str = "doc_id") -> None:
    """One folder of Parquet per shard; a shard too large for one task gets several files."""
    rows = shard_rows(docs, shards, key)
    name = rows.columns[-1]
    rows.hint("rebalance", name).write.partitionBy(name).parquet(path)


def shard_report(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    Law ``key``: the id and the count of shards decide; ``grown_shard`` is the shard with one shard more, and differs
    from ``shard`` only if it is that new one. Size: UTF-8 bytes of the text (null: none) plus 1. Slots count the rows
    of a shard without gaps: rows are dealt into buckets of a shard by a hash of id and text, buckets follow each other
    by their counts, and only a bucket is put in order. Rows with the same id and text (repeated rows) share a bucket,
    and equal ids, null too, a shard. Empty table: no rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    rows = rows.withColumn("shard", shard_of(F.col("doc_id"), shards)).withColumn("grown_shard", shard_of(F.col("doc_id"), shards + 1))
    rows = stored(rows, "shards")
    count = -(-rows.count() // (shards * SLOTS)) or 1
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(count)))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    starts = starts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("own", F.row_number().over(inside) - 1).join(small_side(starts, shards * count), ["shard", "bucket"])
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("start") + F.col("own")).cast("long").alias("slot"), "grown_shard"
    )
