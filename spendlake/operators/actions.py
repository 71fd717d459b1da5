"""Action lists: building, exploding, costing, video funnels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.functions.metrics import action_total, action_value, cost_per_action, exact_sum, parse_actions, ratio

VIDEO_STAGES = ("play", "p25", "p50", "p75", "p100")
# Columns of a fact table that hold the stages of the video funnel.
VIDEO_COLUMNS = (
    "video_play_actions_json",
    "video_p25_watched_actions_json",
    "video_p50_watched_actions_json",
    "video_p75_watched_actions_json",
    "video_p100_watched_actions_json",
)


def action_lists(events: DataFrame, grain: tuple[str, ...], action_type: str, amount: str) -> DataFrame:
    """One row per grain with ``actions_json``, one entry per action type.

    Amounts are added per type before the list is collected, so a list is as long as there
    are types and no longer, however many events one entity has.
    """
    per_type = events.groupBy(*grain, F.col(action_type).alias("action_type")).agg(
        exact_sum(events, amount).cast("double").alias("amount")
    )
    pair = F.struct("action_type", F.col("amount").cast("string").alias("value"))
    pairs = F.array_sort(F.collect_list(pair))
    return per_type.groupBy(*grain).agg(F.to_json(pairs).alias("actions_json"))


def with_action_value(df: DataFrame, column: str, action_type: str, name: str = "action_value") -> DataFrame:
    return df.withColumn(name, action_value(F.col(column), action_type))


def with_cost_per_action(df: DataFrame, column: str, action_type: str, name: str = "cost_per_action") -> DataFrame:
    return df.withColumn(name, cost_per_action(F.col("spend"), F.col(column), action_type))


def explode_actions(df: DataFrame, column: str, keep: tuple[str, ...]) -> DataFrame:
    """One row per list entry: the kept columns, ``action_type`` and ``value``."""
    entry = F.explode(parse_actions(F.col(column))).alias("entry")
    opened = df.select(*keep, entry)
    return opened.select(*keep, "entry.action_type", F.nullif(F.col("entry.value"), F.lit("")).cast("double").alias("value"))


def video_funnel(df: DataFrame, keep: tuple[str, ...], columns: tuple[str, ...] = VIDEO_COLUMNS) -> DataFrame:
    """Totals of the five video stages and each watched stage's share of plays."""
    totals = df.select(*keep, *(action_total(F.col(c)).alias(s) for c, s in zip(columns, VIDEO_STAGES)))
    shares = {f"{s}_rate": ratio(F.col(s), F.col("play")) for s in VIDEO_STAGES[1:]}
    return totals.withColumns(shares)
