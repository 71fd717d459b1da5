"""Connected components of a graph given by its links, without any part of it on the driver.

Alternating star contraction: every round ties each node's neighbours to the smallest of them, first upwards, then
downwards, until only stars are left. A round is two grouped minima (combined before they are shuffled) and two joins,
whose hot side adaptive execution can split; its links are written to the shared folder, so nothing has to be repeated
when executors are lost, and those of the round before are removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import discard, stored


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def _links(rows: DataFrame, *ends: tuple[str, str]) -> DataFrame:
    """A link ``a, b`` for each of the pairs of columns of each row, in one pass over the rows."""
    pairs = F.array(*(F.struct(F.col(a).alias("a"), F.col(b).alias("b")) for a, b in ends))
    return rows.select(F.explode(pairs).alias("link")).select("link.a", "link.b")


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node``, ``component`` (smallest node reached) of every node in a link; links with null or to itself are ignored."""
    edges = links.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b"))
    edges = stored(edges.where("a > b").distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        up = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
        least = _links(edges, ("a", "b"), ("b", "a")).groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = up.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a > b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _links(large.join(least, "a"), ("a", "m"), ("b", "m")).where("a > b")
        last, edges = edges, stored(small.distinct(), "links")
        discard(last)
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(stars.select("component", "component").distinct())
