"""Daily reports from delivery rows: level x day x breakdown, roll-ups and comparisons.

Delivery rows are the lowest grain there is: one row per delivery with its ids, its day
(``stat_date``), the additive metrics and the person reached (``person_id``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.functions.metrics import exact_sum, ratios

# Ids that make up the grain of each report level, outermost first.
LEVEL_IDS = {
    "campaign": ("ad_account_id", "campaign_id"),
    "adset": ("ad_account_id", "campaign_id", "ad_set_id"),
    "ad": ("ad_account_id", "campaign_id", "ad_set_id", "ad_id"),
}
ADDITIVE = ("spend", "impressions", "clicks", "inline_link_clicks", "inline_post_engagement")
DAY = "stat_date"


def _level_ids(level: str) -> tuple[str, ...]:
    if level not in LEVEL_IDS:
        raise ValueError(f"unknown level {level!r}, expected one of {sorted(LEVEL_IDS)}")
    return LEVEL_IDS[level]


def _sums(df: DataFrame) -> list[Column]:
    """Sums of the additive metrics present. Money is added as decimals, so the result has no order."""
    money = exact_sum(df, "spend").cast("double").alias("spend")
    counts = [F.sum(m).cast("bigint").alias(m) for m in ADDITIVE[1:] if m in df.columns]
    return [money, *counts]


def _with_ratios(df: DataFrame, reach: bool) -> DataFrame:
    parts = ratios(
        F.col("spend"), F.col("impressions"), F.col("clicks"), F.col("reach") if reach else None
    )
    return df.withColumns(parts)


def report(
    delivery: DataFrame,
    level: str = "ad",
    breakdowns: tuple[str, ...] = (),
    hierarchy: DataFrame | None = None,
    approximate_reach: bool = False,
) -> DataFrame:
    """One row per entity, day and breakdown value.

    Reach counts distinct people at exactly that grain, and the ratios come from the sums;
    neither can be had from a finer report. ``approximate_reach`` replaces the exact count
    by a sketch, which spares the shuffle of (grain, person) pairs.

    ``hierarchy`` has one row per ad with the ids above it (and any names). Without it the
    delivery rows carry those ids themselves. At ad level it is joined to the finished
    rows, one per ad-day, instead of to every delivery row. Delivery of an ad it does not
    know is kept, with NULL ids.
    """
    ids = _level_ids(level)
    late = hierarchy is not None and level == "ad"
    if hierarchy is not None and not late:
        delivery = delivery.join(hierarchy.select("ad_id", *ids), "ad_id", "left")
    grain = ["ad_id"] if late else list(ids)
    person = F.approx_count_distinct("person_id") if approximate_reach else F.count_distinct("person_id")
    rows = delivery.groupBy(*grain, *breakdowns, DAY).agg(*_sums(delivery), person.alias("reach"))
    rows = _with_ratios(rows, reach=True)
    if not late:
        return rows
    names = [c for c in hierarchy.columns if c not in ids]
    measures = [c for c in rows.columns if c != "ad_id"]
    return rows.join(hierarchy, "ad_id", "left").select(*ids, *names, *measures)


def attach(rows: DataFrame, attributes: DataFrame, on: tuple[str, ...]) -> DataFrame:
    """Add attributes (names, objective) to finished report rows, keeping rows without any."""
    return rows.join(attributes, list(on), "left")


def roll_up(rows: DataFrame, level: str) -> DataFrame:
    """Sum report rows to a coarser level; additive metrics only, with the ratios they allow.

    Reach and frequency are left out on purpose: people seen under several entities would count twice.
    """
    out = rows.groupBy(*_level_ids(level), DAY).agg(*_sums(rows))
    return _with_ratios(out, reach=False)


def collapse(rows: DataFrame, breakdowns: tuple[str, ...]) -> DataFrame:
    """Sum a breakdown away: same grain less the breakdown columns, additive metrics only."""
    dropped = {*breakdowns, "reach", "frequency", "cpc", "cpm", "ctr", *ADDITIVE}
    grain = [c for c in rows.columns if c not in dropped]
    return _with_ratios(rows.groupBy(*grain).agg(*_sums(rows)), reach=False)


def reconcile(finer: DataFrame, coarser: DataFrame, level: str) -> DataFrame:
    """Rolled-up finer rows against a coarser report: both values and their difference per metric."""
    grain = [*_level_ids(level), DAY]
    metrics = [m for m in ADDITIVE if m in finer.columns and m in coarser.columns]
    left = finer.groupBy(*grain).agg(*_sums(finer.select(*grain, *metrics)))
    left = left.select(*grain, *(F.col(m).alias(f"{m}_rolled") for m in metrics))
    right = coarser.select(*grain, *(F.col(m).alias(f"{m}_reported") for m in metrics))

    def gap(m: str) -> Column:
        rolled, reported = (F.coalesce(F.col(f"{m}_{s}"), F.lit(0)) for s in ("rolled", "reported"))
        if m == "spend":
            return (rolled.cast("decimal(28,6)") - reported.cast("decimal(28,6)")).cast("double").alias(f"{m}_diff")
        return (rolled - reported).alias(f"{m}_diff")

    return left.join(right, grain, "full_outer").select(
        *grain,
        *(c for m in metrics for c in (f"{m}_rolled", f"{m}_reported", gap(m))),
    )


def independent_breakdowns(delivery: DataFrame, level: str, breakdowns: tuple[str, ...]) -> DataFrame:
    """One row set per breakdown, told apart by ``breakdown``; every total appears once in each set.

    The rows are summed to the joint grain before the grouping sets multiply them.
    """
    ids = [*_level_ids(level), DAY]
    joint = delivery.groupBy(*ids, *breakdowns).agg(*_exact_sums(delivery))
    # grouping() tells a column that is left out of the set from one that is NULL in the data.
    which = F.coalesce(*(F.when(F.grouping(b) == 0, F.lit(b)) for b in breakdowns))
    value = F.coalesce(*(F.when(F.grouping(b) == 0, F.col(b)) for b in breakdowns))
    sets = [[*ids, b] for b in breakdowns]
    totals = joint.groupingSets(sets, *ids, *breakdowns).agg(
        which.alias("breakdown"), value.alias("breakdown_value"), *_exact_sums(joint)
    )
    metrics = [F.col("spend").cast("double").alias("spend"), *(m for m in ADDITIVE[1:] if m in totals.columns)]
    return totals.select(*ids, "breakdown", "breakdown_value", *metrics)


def _exact_sums(df: DataFrame) -> list[Column]:
    """Additive sums with money kept as a decimal, for sums that are summed again."""
    return [exact_sum(df, "spend").alias("spend"), *(F.sum(m).cast("bigint").alias(m) for m in ADDITIVE[1:] if m in df.columns)]
