"""Action lists per person and day, built from the events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.operators.actions import action_lists, explode_actions, video_funnel, with_action_value, with_cost_per_action
from spendlake.queries.base import query, table

# A person stands for an ad; spend is what their events cost.
GRAIN = ("ad_id", "stat_date")
PER_TYPE_SQL = """
per_type AS (
  SELECT CAST(user_id AS VARCHAR) AS ad_id, CAST(ts AS DATE) AS stat_date, event_type AS action_type,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM events GROUP BY ALL),
days AS (
  SELECT CAST(user_id AS VARCHAR) AS ad_id, CAST(ts AS DATE) AS stat_date,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS spend
  FROM events GROUP BY ALL)"""


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("ad_id"), F.col("ts").cast("date").alias("stat_date"), "event_type", "value"
    )


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    spend = events.groupBy(*GRAIN).agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("spend"))
    return spend.join(action_lists(events, GRAIN, "event_type", "value"), list(GRAIN))


@query(
    "action_value",
    f"""WITH {PER_TYPE_SQL}
SELECT d.ad_id, d.stat_date, d.spend, p.value AS purchases
FROM days d LEFT JOIN (SELECT * FROM per_type WHERE action_type = 'purchase') p USING (ad_id, stat_date)""",
)
def action_value_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_action_value(_facts(spark, sf_dir), "actions_json", "purchase", "purchases")
    return rows.select(*GRAIN, "spend", "purchases")


@query("explode_actions", f"WITH {PER_TYPE_SQL} SELECT ad_id, stat_date, action_type, value FROM per_type")
def explode_actions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_actions(action_lists(_events(spark, sf_dir), GRAIN, "event_type", "value"), "actions_json", GRAIN)


@query(
    "cost_per_action",
    f"""WITH {PER_TYPE_SQL}
SELECT d.ad_id, d.stat_date, d.spend / nullif(p.value, 0) AS cost_per_signup
FROM days d LEFT JOIN (SELECT * FROM per_type WHERE action_type = 'signup') p USING (ad_id, stat_date)""",
)
def cost_per_action_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_cost_per_action(_facts(spark, sf_dir), "actions_json", "signup", "cost_per_signup")
    return rows.select(*GRAIN, "cost_per_signup")


STAGES = {"view": "play", "click": "p25", "signup": "p50", "purchase": "p75", "error": "p100"}
COLUMNS = tuple(f"{stage}_json" for stage in STAGES.values())
STAGE_SQL = ", ".join(f"max(value) FILTER (action_type = '{event}') AS {stage}" for event, stage in STAGES.items())


@query(
    "video_funnel",
    f"""WITH {PER_TYPE_SQL},
stages AS (SELECT ad_id, stat_date, {STAGE_SQL} FROM per_type GROUP BY ALL)
SELECT *, p25 / nullif(play, 0) AS p25_rate, p50 / nullif(play, 0) AS p50_rate,
       p75 / nullif(play, 0) AS p75_rate, p100 / nullif(play, 0) AS p100_rate FROM stages""",
)
def video_funnel_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event type stands for a stage; its entry becomes that stage's own list."""
    events = _events(spark, sf_dir)
    per_type = events.groupBy(*GRAIN, "event_type").agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("v"))
    entry = F.to_json(F.array(F.struct(F.lit("video_view").alias("action_type"), F.col("v").cast("string").alias("value"))))
    lists = per_type.groupBy(*GRAIN).pivot("event_type", list(STAGES)).agg(F.first(entry))
    named = lists.select(*GRAIN, *(F.col(event).alias(f"{stage}_json") for event, stage in STAGES.items()))
    return video_funnel(named, GRAIN, COLUMNS)
