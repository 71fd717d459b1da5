"""Facts against dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_dimension(
    facts: DataFrame, dimension: DataFrame, on: tuple[str, ...], attributes: dict[str, str]
) -> DataFrame:
    """Daily rows with the current attributes of their entity; rows without one are kept.

    ``attributes`` maps dimension columns to output names. No broadcast is forced: the
    dimension grows with the lake, so the optimiser broadcasts it only while it is small,
    and a hot entity is split by adaptive skew handling.
    """
    current = dimension.select(*on, *(F.col(c).alias(name) for c, name in attributes.items()))
    return facts.join(current, list(on), "left")


def never_seen(facts: DataFrame, dimension: DataFrame, on: tuple[str, ...]) -> DataFrame:
    """Distinct entities that have facts but no dimension row: what a backfill has to fetch."""
    return facts.select(*on).distinct().join(dimension.select(*on), list(on), "left_anti")
