"""Daily reports over the delivery rows, and the comparisons between them."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.operators import report as R
from spendlake.operators.enrich import never_seen, with_dimension
from spendlake.operators.quality import run_audit
from spendlake.operators.reach import merge_reach, reach_of, relative_error, with_sketch
from spendlake.queries.base import (
    ADDITIVE_SQL,
    DELIVERY_SQL,
    RATIOS_SQL,
    ad_id_as_text,
    campaign_names,
    hierarchy,
    markets,
    query,
    raw_delivery,
    report_sql,
    table,
)
from spendlake.queries.landing import waves
from spendlake.session import scratch_path

AD_GRAIN = "ad_account_id, campaign_id, ad_set_id, ad_id, ad_name, ad_set_name, campaign_name"


def ad_delivery(spark: SparkSession, sf_dir: str, breakdowns: tuple[str, ...] = ()) -> DataFrame:
    delivery = raw_delivery(spark, sf_dir)
    return delivery.join(markets(spark, sf_dir), "l_suppkey") if "market" in breakdowns else delivery


def ad_report(spark: SparkSession, sf_dir: str, breakdowns: tuple[str, ...] = ()) -> DataFrame:
    return ad_id_as_text(R.report(ad_delivery(spark, sf_dir, breakdowns), "ad", breakdowns, hierarchy(spark, sf_dir)))


def ad_reports(spark: SparkSession, sf_dir: str, breakdowns: tuple[str, ...] = ()) -> Iterator[DataFrame]:
    """The rows of ``ad_report``, in parts that are to be stored one after the other."""
    columns = ("ad_id", *breakdowns, R.DAY, *R.ADDITIVE, "person_id")
    delivery, rows = ad_delivery(spark, sf_dir, breakdowns).select(*columns), table(spark, sf_dir, "lineitem").count()
    for part, ads in waves(spark, delivery, hierarchy(spark, sf_dir), rows):
        yield ad_id_as_text(R.report(part, "ad", breakdowns, ads))


def level_report(spark: SparkSession, sf_dir: str, level: str) -> DataFrame:
    return R.report(raw_delivery(spark, sf_dir), level, (), hierarchy(spark, sf_dir))


@query("report_ad_day", f"WITH {DELIVERY_SQL}, {report_sql(AD_GRAIN + ', stat_date')} SELECT * FROM report")
def report_ad_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_report(spark, sf_dir)


@query(
    "report_adset_day",
    f"""WITH {DELIVERY_SQL}, {report_sql('ad_account_id, campaign_id, ad_set_id, stat_date')} SELECT * FROM report""",
)
def report_adset_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return level_report(spark, sf_dir, "adset")


@query(
    "report_campaign_day",
    f"""WITH {DELIVERY_SQL},
{report_sql('ad_account_id, campaign_id, campaign_name, objective, stat_date')} SELECT * FROM report""",
)
def report_campaign_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = level_report(spark, sf_dir, "campaign")
    return R.attach(rows, campaign_names(spark, sf_dir), ("ad_account_id", "campaign_id"))


@query(
    "report_ad_market_day",
    f"WITH {DELIVERY_SQL}, {report_sql(AD_GRAIN + ', market, stat_date')} SELECT * FROM report",
)
def report_ad_market_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_report(spark, sf_dir, ("market",))


@query(
    "report_ad_age_gender_day",
    f"WITH {DELIVERY_SQL}, {report_sql(AD_GRAIN + ', age, gender, stat_date')} SELECT * FROM report",
)
def report_ad_age_gender_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_report(spark, sf_dir, ("age", "gender"))


def _roll_sql(grain: str) -> str:
    return f"""WITH {DELIVERY_SQL},
sums AS (SELECT {grain}, stat_date, {ADDITIVE_SQL} FROM delivery GROUP BY ALL)
SELECT *, {RATIOS_SQL} FROM sums"""


@query("rollup_ad_to_adset", _roll_sql("ad_account_id, campaign_id, ad_set_id"))
def rollup_ad_to_adset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.roll_up(ad_report(spark, sf_dir), "adset")


@query("rollup_ad_to_campaign", _roll_sql("ad_account_id, campaign_id"))
def rollup_ad_to_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.roll_up(ad_report(spark, sf_dir), "campaign")


@query(
    "reconcile_levels",
    f"""WITH {DELIVERY_SQL},
ads AS (SELECT ad_account_id, campaign_id, ad_id, stat_date, sum(spend) AS spend, sum(impressions) AS impressions,
               sum(clicks) AS clicks
        FROM delivery WHERE gender <> 'P' GROUP BY ALL),
rolled AS (SELECT ad_account_id, campaign_id, stat_date, sum(spend) AS spend,
                  sum(impressions) AS impressions, sum(clicks) AS clicks FROM ads GROUP BY ALL),
campaigns AS (SELECT ad_account_id, campaign_id, stat_date, sum(spend) AS spend,
                     sum(impressions) AS impressions, sum(clicks) AS clicks FROM delivery GROUP BY ALL)
SELECT ad_account_id, campaign_id, stat_date,
       CAST(r.spend AS DOUBLE) AS spend_rolled, CAST(c.spend AS DOUBLE) AS spend_reported,
       CAST(coalesce(r.spend, 0) - coalesce(c.spend, 0) AS DOUBLE) AS spend_diff,
       CAST(r.impressions AS BIGINT) AS impressions_rolled, CAST(c.impressions AS BIGINT) AS impressions_reported,
       CAST(coalesce(r.impressions, 0) - coalesce(c.impressions, 0) AS BIGINT) AS impressions_diff,
       CAST(r.clicks AS BIGINT) AS clicks_rolled, CAST(c.clicks AS BIGINT) AS clicks_reported,
       CAST(coalesce(r.clicks, 0) - coalesce(c.clicks, 0) AS BIGINT) AS clicks_diff
FROM rolled r FULL JOIN campaigns c USING (ad_account_id, campaign_id, stat_date)""",
)
def reconcile_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad rows that lack one sort of delivery against full campaign rows, so there is something to find."""
    delivery, ads = raw_delivery(spark, sf_dir), hierarchy(spark, sf_dir)
    metrics = ("spend", "impressions", "clicks")
    finer = R.report(delivery.where(F.col("gender") != "P"), "ad", (), ads)
    coarser = R.report(delivery, "campaign", (), ads)
    grain = ("ad_account_id", "campaign_id", "stat_date")
    return R.reconcile(finer.select(*grain, "ad_id", *metrics), coarser.select(*grain, *metrics), "campaign")


@query(
    "collapse_breakdown",
    f"""WITH {DELIVERY_SQL},
sums AS (SELECT {AD_GRAIN}, stat_date, {ADDITIVE_SQL} FROM delivery GROUP BY ALL)
SELECT *, {RATIOS_SQL} FROM sums""",
)
def collapse_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.collapse(ad_report(spark, sf_dir, ("age", "gender")), ("age", "gender"))


@query(
    "independent_breakdowns",
    f"""WITH {DELIVERY_SQL}
SELECT ad_account_id, campaign_id, stat_date,
       CASE WHEN grouping(age) = 0 THEN 'age' ELSE 'gender' END AS breakdown,
       CASE WHEN grouping(age) = 0 THEN age ELSE gender END AS breakdown_value,
       {ADDITIVE_SQL}
FROM delivery
GROUP BY GROUPING SETS ((ad_account_id, campaign_id, stat_date, age), (ad_account_id, campaign_id, stat_date, gender))""",
)
def independent_breakdowns(spark: SparkSession, sf_dir: str) -> DataFrame:
    ads = hierarchy(spark, sf_dir).select("ad_id", "ad_account_id", "campaign_id")
    return R.independent_breakdowns(raw_delivery(spark, sf_dir).join(ads, "ad_id"), "campaign", ("age", "gender"))


@query(
    "run_audit",
    f"""WITH {DELIVERY_SQL}
SELECT ad_account_id, CAST(count(*) AS BIGINT) AS row_count FROM delivery GROUP BY ALL""",
)
def run_audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ads = hierarchy(spark, sf_dir).select("ad_id", "ad_account_id")
    return run_audit(raw_delivery(spark, sf_dir).join(ads, "ad_id"))


@query(
    "fact_with_dim",
    """
WITH facts AS (
  SELECT CAST(o_custkey AS VARCHAR) AS ad_id, CAST(o_orderdate AS DATE) AS stat_date,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS spend
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT ad_id, stat_date, spend, c_name AS ad_name, c_mktsegment AS effective_status
FROM facts LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY') c ON ad_id = CAST(c_custkey AS VARCHAR)""",
)
def fact_with_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimension = table(spark, sf_dir, "customer").where("c_mktsegment <> 'MACHINERY'").withColumnRenamed("c_custkey", "ad_id")
    facts = raw_delivery(spark, sf_dir).groupBy("ad_id", "stat_date").agg(F.sum("spend").cast("double").alias("spend"))
    return ad_id_as_text(
        with_dimension(facts, dimension, ("ad_id",), {"c_name": "ad_name", "c_mktsegment": "effective_status"})
    )


@query(
    "never_seen_entities",
    """
SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS ad_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')""",
)
def never_seen_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimension = table(spark, sf_dir, "customer").where("c_mktsegment <> 'MACHINERY'").withColumnRenamed("c_custkey", "ad_id")
    return ad_id_as_text(never_seen(raw_delivery(spark, sf_dir), dimension, ("ad_id",)))


@query(
    "rollup_reach",
    f"""WITH {DELIVERY_SQL}
SELECT ad_account_id, campaign_id, stat_date, CAST(count(DISTINCT person_id) AS BIGINT) AS reach, true AS sketch_is_close
FROM delivery GROUP BY ALL
UNION ALL
SELECT ad_account_id, campaign_id, CAST(NULL AS DATE), CAST(count(DISTINCT person_id) AS BIGINT), true
FROM delivery GROUP BY ad_account_id, campaign_id""",
)
def rollup_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches stored with the daily ad facts, merged to campaigns per day and over all days, next to the exact counts.

    Close means within five standard errors of the sketch, and one person."""
    ids = ["ad_account_id", "campaign_id"]
    delivery = raw_delivery(spark, sf_dir).join(hierarchy(spark, sf_dir).select(*ids, "ad_id"), "ad_id")
    path = scratch_path(spark, "ad_reach")
    with_sketch(delivery, (*ids, "ad_id", "stat_date")).write.parquet(path)
    facts = spark.read.parquet(path)
    daily = merge_reach(facts, (*ids, "stat_date"))
    ever = merge_reach(daily, tuple(ids)).withColumn("stat_date", F.lit(None).cast("date"))
    merged = daily.unionByName(ever).withColumn("sketched", reach_of())
    exact = delivery.groupBy(*ids, "stat_date").agg(F.count_distinct("person_id").alias("reach"))
    exact = exact.unionByName(delivery.groupBy(*ids).agg(F.count_distinct("person_id").alias("reach")).withColumn("stat_date", F.lit(None).cast("date")))
    grain = [*ids, "stat_date"]
    same = [F.col(f"e.{c}").eqNullSafe(F.col(f"m.{c}")) for c in grain]
    both = exact.alias("e").join(merged.alias("m"), same, "left")
    close = F.abs(F.col("sketched") - F.col("reach")) <= F.lit(1) + F.col("reach") * relative_error()
    return both.select(*(F.col(f"e.{c}").alias(c) for c in grain), "reach", F.coalesce(close, F.lit(False)).alias("sketch_is_close"))
