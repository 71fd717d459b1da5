"""Numbers without gaps over any number of rows: a range-partitioned sort and the counts of its parts.

No task holds more than its own range of the order, and the driver holds nothing: parts are sorted and written with each
row's place in its part, then a part starts where the rows of all parts before it end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.session import scratch_path

#: ``monotonically_increasing_id`` keeps a row's place in its part in its lower 33 bits.
_PLACE = (1 << 33) - 1


def _tie(rows: DataFrame) -> list[Column]:
    """Orders rows that are equal in the stated order, so that many of them still spread over parts; maps have no hash."""
    plain = [F.col(f"`{f.name}`") for f in rows.schema.fields if "map<" not in f.dataType.simpleString() and not isinstance(f.dataType, T.VariantType)]
    return [F.xxhash64(*plain)] if plain else []


def numbered(rows: DataFrame, order: Sequence[str], number: str = "number", parts: int | None = None) -> DataFrame:
    """``rows`` with their number, 1 for the first, in the order of the named columns (nulls first).

    Rows that are equal there are ordered by a hash of all columns; only rows equal in everything cannot be told apart, so
    the numbers are the same whichever task has to be repeated. ``parts`` is the number of parts, the session's number of
    shuffle partitions unless stated. Empty input: no rows. A column called like the number raises.
    """
    if number.lower() in {c.lower() for c in rows.columns}:
        raise ValueError(f"there is a column {number} already")
    spark = rows.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*(F.col(c) for c in order), *_tie(rows)]
    placed = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select(
        F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("row"),
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE)).alias("place"),
    )
    path = scratch_path(spark, "numbered")
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    # One row per part.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("part").agg(F.count("*").alias("own"))
    starts = starts.select("part", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("start"))
    joined = placed.join(F.broadcast(starts), "part")
    return joined.select("row.*", (F.col("start") + F.col("place") + 1).alias(number))


def numbered_within(rows: DataFrame, group: str, order: Sequence[str], number: str = "number", parts: int | None = None) -> DataFrame:
    """``rows`` numbered from 1 within each group (null is a group), however much of all rows one group holds."""
    whole = numbered(rows, (group, *order), number, parts)
    first = whole.groupBy(F.col(group).alias("of_group")).agg(F.min(number).alias("of_first"))
    joined = whole.join(first, F.col(group).eqNullSafe(F.col("of_group")))
    return joined.select(*(F.col(f"`{c}`") for c in rows.columns), (F.col(number) - F.col("of_first") + 1).alias(number))


def text_blocks(failures: DataFrame, by: str = "ad_account_id", text: str = "detail", size: int = 100) -> DataFrame:
    """All texts of an account in order, in rows of at most ``size`` texts each: ``block`` from 0, ``failures`` in it, texts joined.

    A null text counts as a failure and adds no text. The exact number per account is the sum over its blocks.
    """
    if size < 1:
        raise ValueError("a block holds one text at least")
    numbers = numbered_within(failures.select(by, text), by, (text,))
    block = F.call_function("div", F.col("number") - 1, F.lit(size))
    joined = F.array_join(F.array_sort(F.collect_list(text)), "; ")
    return numbers.groupBy(by, block.alias("block")).agg(F.count("*").alias("failures"), joined.alias(text))
