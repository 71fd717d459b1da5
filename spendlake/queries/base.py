"""Registry of queries, the supplied tables, and the delivery rows they stand for."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.plans.spec import TableSpec


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with SQL that gives the same rows where there is such SQL."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def portable(df: DataFrame) -> DataFrame:
    """Timestamps as epoch seconds, which read the same in every engine and time zone."""
    return df.select(
        *(
            F.unix_seconds(f.name).alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields
        )
    )


# SQL types of a table's columns once timestamps are epoch seconds.
SQL_TYPES = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "boolean": "BOOLEAN", "date": "DATE", "timestamp": "BIGINT"}


def sql_columns(spec: TableSpec, known: dict[str, str]) -> str:
    """SELECT list of a table's columns: the known expressions, NULL for the rest."""
    unknown = set(known) - set(spec.columns)
    if unknown:
        raise ValueError(f"not columns of {spec.name}: {sorted(unknown)}")
    return ",\n  ".join(
        f"CAST({known.get(f.name, 'NULL')} AS {SQL_TYPES[f.dataType.simpleString()]}) AS {f.name}"
        for f in spec.schema.fields
    )


def _flag(condition: Column) -> Column:
    return condition.cast("int")


def raw_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery rows as logged: the ad, the day, the money and counts, the person reached, the breakdown values."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_suppkey",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("spend"),
        F.col("l_quantity").cast("bigint").alias("impressions"),
        _flag(F.col("l_returnflag") == "R").alias("clicks"),
        _flag(F.col("l_linestatus") == "O").alias("inline_link_clicks"),
        _flag(F.col("l_returnflag") == "A").alias("inline_post_engagement"),
        F.col("l_partkey").alias("person_id"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("ad_id"),
        F.col("o_orderdate").cast("date").alias("stat_date"),
        F.col("o_orderpriority").alias("age"),
        F.col("o_orderstatus").alias("gender"),
    )
    return lines.join(orders, "l_orderkey").drop("l_orderkey")


def hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per ad with the ids and names above it."""
    ads = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ad_id"), F.col("c_name").alias("ad_name"), "c_mktsegment", F.col("c_nationkey").alias("n_nationkey")
    )
    nations = table(spark, sf_dir, "nation")
    return ads.join(nations, "n_nationkey").select(
        F.concat(F.lit("act_"), F.col("n_regionkey")).alias("ad_account_id"),
        F.col("n_nationkey").cast("string").alias("campaign_id"),
        F.concat_ws("-", F.col("n_nationkey").cast("string"), "c_mktsegment").alias("ad_set_id"),
        "ad_id",
        "ad_name",
        F.col("c_mktsegment").alias("ad_set_name"),
        F.col("n_name").alias("campaign_name"),
    )


def campaign_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("act_"), F.col("n_regionkey")).alias("ad_account_id"),
        F.col("n_nationkey").cast("string").alias("campaign_id"),
        F.col("n_name").alias("campaign_name"),
        F.col("r_name").alias("objective"),
    )


def markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("string").alias("market")
    )


def ad_id_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("ad_id", F.col("ad_id").cast("string"))


# The same delivery rows in SQL, ids and names included.
DELIVERY_SQL = """
delivery AS (
  SELECT 'act_' || CAST(n_regionkey AS VARCHAR) AS ad_account_id,
         CAST(n_nationkey AS VARCHAR) AS campaign_id,
         CAST(n_nationkey AS VARCHAR) || '-' || c_mktsegment AS ad_set_id,
         CAST(c_custkey AS VARCHAR) AS ad_id,
         c_name AS ad_name, c_mktsegment AS ad_set_name, n_name AS campaign_name, r_name AS objective,
         CAST(o_orderdate AS DATE) AS stat_date,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS spend,
         CAST(l_quantity AS BIGINT) AS impressions,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS clicks,
         CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS inline_link_clicks,
         CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS inline_post_engagement,
         l_partkey AS person_id, o_orderpriority AS age, o_orderstatus AS gender,
         CAST(s_nationkey AS VARCHAR) AS market
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

ADDITIVE_SQL = """CAST(sum(spend) AS DOUBLE) AS spend,
         CAST(sum(impressions) AS BIGINT) AS impressions,
         CAST(sum(clicks) AS BIGINT) AS clicks,
         CAST(sum(inline_link_clicks) AS BIGINT) AS inline_link_clicks,
         CAST(sum(inline_post_engagement) AS BIGINT) AS inline_post_engagement"""

RATIOS_SQL = """spend / nullif(clicks, 0) AS cpc,
       1000.0::DOUBLE * spend / nullif(impressions, 0) AS cpm,
       100.0::DOUBLE * clicks / nullif(impressions, 0) AS ctr"""

FREQUENCY_SQL = "CAST(impressions AS DOUBLE) / nullif(reach, 0) AS frequency"


def report_sql(grain: str, source: str = "delivery", cte: str = "report") -> str:
    """CTE with one row per grain: sums, reach and ratios."""
    return f"""
{cte}_sums AS (
  SELECT {grain}, {ADDITIVE_SQL}, CAST(count(DISTINCT person_id) AS BIGINT) AS reach
  FROM {source} GROUP BY ALL
),
{cte} AS (SELECT *, {FREQUENCY_SQL}, {RATIOS_SQL} FROM {cte}_sums)"""
