"""Ratios recomputed from sums, and values inside action lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.functions.casts import to_double

# Fixed value: shape of every action list.
ACTION_LIST = "ARRAY<STRUCT<action_type: STRING, value: STRING>>"


def exact_sum(df: DataFrame, amount: str) -> Column:
    """Sum of an amount as a decimal, so the result does not depend on the order of the rows.

    A decimal column keeps its scale; any other is taken to six places, which holds
    charges far below a cent.
    """
    column = F.col(amount)
    return F.sum(column if isinstance(df.schema[amount].dataType, T.DecimalType) else column.cast("decimal(28,6)"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as DOUBLE, NULL when the denominator is zero or missing."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratios(spend: Column, impressions: Column, clicks: Column, reach: Column | None = None) -> dict[str, Column]:
    """frequency (only with reach), cpc, cpm and ctr from additive totals."""
    out = {} if reach is None else {"frequency": ratio(impressions, reach)}
    out["cpc"] = ratio(spend, clicks)
    out["cpm"] = ratio(F.lit(1000.0) * spend.cast("double"), impressions)
    out["ctr"] = ratio(F.lit(100.0) * clicks.cast("double"), impressions)
    return out


def parse_actions(list_json: Column) -> Column:
    """Action-list text to an array of (action_type, value) pairs."""
    return F.from_json(list_json, ACTION_LIST)


def _sum_values(pairs: Column) -> Column:
    valued = F.filter(pairs, lambda p: F.nullif(p["value"], F.lit("")).isNotNull())
    total = F.aggregate(valued, F.lit(0.0), lambda acc, p: acc + to_double(p["value"], "action value"))
    # An empty list would add up to 0.0, which is not the same as "no such action".
    return F.when(F.size(valued) > 0, total)


def action_value(list_json: Column, action_type: str) -> Column:
    """Value of one action type in a list; repeated entries add up, NULL when absent."""
    return _sum_values(F.filter(parse_actions(list_json), lambda p: p["action_type"] == F.lit(action_type)))


def action_total(list_json: Column) -> Column:
    """Sum over all entries of a list, NULL for a missing or empty one."""
    return _sum_values(parse_actions(list_json))


def cost_per_action(spend: Column, list_json: Column, action_type: str) -> Column:
    return ratio(spend, action_value(list_json, action_type))
