"""Mixing sources to target weights by hash thresholds.

Every row has a place in its source: 60 bits of a hash of its key. A copy of a source is taken up to a threshold in that
order, so a smaller budget always takes a subset of what a larger one takes, and reruns agree. Thresholds come from
histograms of sizes over hash buckets: the bucket in which the budget ends is cut into finer buckets, and only its rows
are summed again, until it holds one hash. Rows are then filtered by their hash; nothing is sorted, and a hot source is
spread over its buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm.common import free_name, small_side, stored

#: Bits of the hash, and of each cut into finer buckets.
HASH_BITS, CUT_BITS = 60, 10
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place(key: Column) -> Column:
    """60 bits of the MD5 of the key's text; a null key has the place of the empty text."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Targets of the sources (``source, source_size``, one row each): ``source, source_size, target``.

    Sources by code point, null last, take the weights in turn. Together they take ``share`` of all sizes, none more
    than ``most`` times its own; what is cut off goes to the others by weight. Sources in the order of cap by weight:
    the first ones end at their cap, and the rest share what is left.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int")).cast("double")
    rows = sizes.withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    rows = (
        rows.withColumn("upto", F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("rest_w", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("total", F.sum("source_size").over(Window.partitionBy()))
    )
    left = F.col("total") * F.lit(float(share)) - (F.col("upto") - F.col("source_size")) * F.lit(float(most))
    rows = rows.withColumn("level", left / F.col("rest_w")).withColumn("open", F.col("level") < F.col("cap") / F.col("w"))
    line = F.max(F.when(F.col("open"), F.col("level"))).over(Window.partitionBy())
    return rows.select("source", "source_size", F.when(F.col("open"), line * F.col("w")).otherwise(F.col("cap")).alias("target"))


def thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with ``base`` (copies of every row) and ``last`` (highest place that gets one more; -1: none).

    Rows: ``source, size, place``. The rows that share the place at which the budget ends are taken together, if that
    comes nearer to the budget.
    """
    size = F.col("source_size")
    base = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(F.lit(0)).cast("long")
    ends = targets.withColumn("base", base).withColumn("budget", F.col("target") - F.col("base") * size)
    cut = ends.where("budget > 0").select(F.col("source").alias("s"), "budget", F.lit(0).cast("long").alias("bucket"), F.lit(0).cast("long").alias("taken"))
    bits, own, many = 0, None, 1
    while bits < HASH_BITS and many:
        bits += CUT_BITS
        rest = HASH_BITS - bits
        held = rows["source"].eqNullSafe(cut["s"]) & (F.shiftright(rows["place"], rest + CUT_BITS) == cut["bucket"])
        inside = rows.join(small_side(cut), held).select("s", "budget", "taken", "size", "place", F.shiftright("place", rest).alias("bucket"))
        sums = inside.groupBy("s", "budget", "taken", "bucket").agg(
            F.sum("size").alias("own"), F.min("place").alias("first"), F.max("place").alias("final")
        )
        upto = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        sums = sums.withColumn("sum", F.col("taken") + F.sum("own").over(upto)).where("sum > budget")
        end = F.min_by(F.struct("budget", "bucket", (F.col("sum") - F.col("own")).alias("taken"), "own", "first", "final"), "bucket")
        cut = stored(sums.groupBy("s").agg(end.alias("e")).select("s", "e.*"), "cut")
        many = cut.where("first < final").count()
    more = F.col("taken") + F.col("own") - F.col("budget") < F.col("budget") - F.col("taken")
    edge = F.shiftleft(F.col("bucket") + F.when(more, 1).otherwise(0), rest) - 1
    edge = cut.select("s", edge.alias("last"))
    joined = targets.join(ends.select(F.col("source").alias("s2"), "base"), F.col("source").eqNullSafe(F.col("s2")))
    joined = joined.join(edge, F.col("source").eqNullSafe(F.col("s")), "left")
    return joined.select("source", "source_size", "target", "base", F.coalesce("last", F.lit(-1)).alias("last"))


def mixed(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
) -> tuple[DataFrame, DataFrame]:
    """Sizes of all rows (``key, source, size, place``) and the thresholds of their sources, both stored."""
    if not weights or min(weights) <= 0 or share < 0 or most <= 0:
        raise ValueError("weights have to be positive, the share not negative and the limit positive")
    rows = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), place(F.col(key)).alias("place"))
    rows = stored(rows, "sizes")
    sizes = stored(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    return rows, stored(thresholds(rows, source_targets(sizes, weights, share, most)), "thresholds")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row per input row: ``doc_id, size, source_size, target, taken`` (words the mix takes of it, repeats counted).

    Size: words of the text, null none. A null source is a source of its own, last in order; sources without words have
    target 0. Rows with the same key (null keys too) are taken alike. Empty table: no rows. Other columns are not read.
    """
    rows, limits = mixed(docs, **options)
    limits = small_side(limits.withColumnRenamed("source", "s"))
    joined = rows.join(limits, F.col("source").eqNullSafe(F.col("s")))
    copies = F.col("base") + (F.col("place") <= F.col("last")).cast("long")
    return joined.select(F.col("key").alias("doc_id"), "size", "source_size", "target", (F.col("size") * copies).alias("taken"))


def mix_rows(docs: DataFrame, key: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, each as often as the mix takes it."""
    _, limits = mixed(docs, key=key, source=source, **options)
    names = {c: free_name(docs, f"mix_{c}") for c in ("source", "base", "last", "copy")}
    limits = small_side(limits.select(*(F.col(c).alias(names[c]) for c in ("source", "base", "last"))))
    joined = docs.join(limits, docs[source].eqNullSafe(limits[names["source"]]))
    copies = F.col(names["base"]) + (place(docs[key]) <= F.col(names["last"])).cast("long")
    repeated = joined.withColumn(names["copy"], F.explode(F.array_repeat(F.lit(0), copies.cast("int"))))
    # Quoted: a name may hold dots.
    return repeated.select(*(docs["`" + c.replace("`", "``") + "`"] for c in docs.columns))


#: The same mix in SQL: budgets by running sums in hash order.
MIX_SQL = r"""
WITH rows AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^ 	-
]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS place
  FROM documents
),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source),
weighed AS (
  SELECT *, CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS w, source_size * 2.0::DOUBLE AS cap
  FROM sizes
),
levels AS (
  SELECT *, (CAST(sum(source_size) OVER () AS BIGINT) * 1.5::DOUBLE
             - CAST(sum(source_size) OVER (ORDER BY cap / w, source NULLS LAST ROWS UNBOUNDED PRECEDING) - source_size AS BIGINT) * 2.0::DOUBLE)
            / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
),
targets AS (
  SELECT source, source_size, CASE WHEN level < cap / w THEN max(CASE WHEN level < cap / w THEN level END) OVER () * w ELSE cap END AS target
  FROM levels
),
based AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS base FROM targets
),
ordered AS (
  SELECT r.*, t.source_size, t.target, t.base, t.target - t.base * t.source_size AS budget,
         sum(size) OVER (PARTITION BY r.source ORDER BY place RANGE UNBOUNDED PRECEDING) AS upto,
         sum(size) OVER (PARTITION BY r.source, place) AS own
  FROM rows r JOIN based t ON r.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (base + CASE WHEN budget > 0 AND (upto <= budget OR upto - budget < budget - (upto - own)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ordered
"""
