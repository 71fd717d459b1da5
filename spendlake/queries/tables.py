"""Tables written and read back: upserts, replacement, and whole runs.

Every query writes a new table in the shared folder, so running it again starts afresh.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.functions.days import date_window, utc_instant
from spendlake.operators.bucketed import BucketedTable, upsert_bucketed
from spendlake.operators.filters import in_days
from spendlake.operators.numbering import numbered_within
from spendlake.operators.report import ADDITIVE, report
from spendlake.operators.upsert import ParquetTable, latest_per_key, replace, upsert
from spendlake.plans import tables as T
from spendlake.plans.jobs import run_dimensions, run_facts
from spendlake.queries import landing as L
from spendlake.queries.base import DELIVERY_SQL, portable, query, raw_delivery, report_sql, sql_columns, table
from spendlake.queries.sources import ADS_KNOWN, AD_SETS_KNOWN, CAMPAIGNS_KNOWN
from spendlake.session import scratch_path
from spendlake.sources.pages import LANDED_PAGE

FIRST_RUN = datetime(2024, 3, 1, tzinfo=timezone.utc)
SECOND_RUN = datetime(2024, 3, 2, tzinfo=timezone.utc)
FIRST_EPOCH, SECOND_EPOCH = int(FIRST_RUN.timestamp()), int(SECOND_RUN.timestamp())
# The days after the newest event and the newest order.
EVENTS_AS_OF = "2024-01-31"
ORDERS_AS_OF = "2001-08-02"


def new_table(spark: SparkSession, spec) -> ParquetTable:
    return ParquetTable(spec, scratch_path(spark, spec.name))


def _stamped(rows: DataFrame, instant: datetime) -> DataFrame:
    return rows.withColumn("ingested_at", F.lit(instant))


def event_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as delivery rows: a user stands for an ad, the event type for who was reached."""
    user = F.col("user_id")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("act_"), (user % 5).cast("string")).alias("ad_account_id"),
        (user % 25).cast("string").alias("campaign_id"),
        (user % 75).cast("string").alias("ad_set_id"),
        user.cast("string").alias("ad_id"),
        F.col("ts").cast("date").alias("stat_date"),
        F.col("value").cast("decimal(18,2)").alias("spend"),
        F.lit(1).alias("impressions"),
        (F.col("event_type") == "click").cast("int").alias("clicks"),
        F.col("event_type").alias("person_id"),
    )


def _first_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped(report(event_delivery(spark, sf_dir), "ad"), FIRST_RUN)


def _revised_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last window again without the errors, and the same rows as days not seen before."""
    window = date_window(EVENTS_AS_OF)
    rows = report(in_days(event_delivery(spark, sf_dir).where("person_id <> 'error'"), "stat_date", *window), "ad")
    # The shift is the window's own width, so shifted days never meet revised ones.
    shift = F.explode(F.array(F.lit(0), F.lit(14)))
    moved = rows.withColumn("shift", shift).withColumn("stat_date", F.date_add("stat_date", F.col("shift")))
    return _stamped(moved, SECOND_RUN)


EVENT_DELIVERY_SQL = """
e AS (
  SELECT 'act_' || CAST(user_id % 5 AS VARCHAR) AS ad_account_id, CAST(user_id % 25 AS VARCHAR) AS campaign_id,
         CAST(user_id % 75 AS VARCHAR) AS ad_set_id, CAST(user_id AS VARCHAR) AS ad_id, CAST(ts AS DATE) AS stat_date,
         CAST(value AS DECIMAL(18,2)) AS spend, 1 AS impressions, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS clicks,
         0 AS inline_link_clicks, 0 AS inline_post_engagement, event_type AS person_id
  FROM events)"""
EVENT_GRAIN = "ad_account_id, campaign_id, ad_set_id, ad_id, stat_date"
FACT_COLUMNS = "ad_account_id, campaign_id, ad_id, stat_date, spend, impressions, clicks, reach, cpc"
UPSERT_SQL = f"""WITH {EVENT_DELIVERY_SQL}, {report_sql(EVENT_GRAIN, 'e')},
f AS (SELECT * FROM e WHERE person_id <> 'error' AND stat_date BETWEEN DATE '2024-01-17' AND DATE '2024-01-30'),
{report_sql(EVENT_GRAIN, 'f', 'revised')},
source AS (SELECT * FROM revised
           UNION ALL SELECT * REPLACE (CAST(stat_date + INTERVAL 14 DAY AS DATE) AS stat_date) FROM revised)
SELECT {FACT_COLUMNS}, CAST({SECOND_EPOCH} AS BIGINT) AS ingested_at FROM source
UNION ALL
SELECT {FACT_COLUMNS}, CAST({FIRST_EPOCH} AS BIGINT) FROM report r
WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.ad_account_id = r.ad_account_id AND s.ad_id = r.ad_id AND s.stat_date = r.stat_date)"""


def fact_output(spark: SparkSession, target: ParquetTable | BucketedTable) -> DataFrame:
    return portable(target.read(spark).select(*FACT_COLUMNS.split(", "), "ingested_at"))


@query("upsert_facts", UPSERT_SQL)
def upsert_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_table(spark, T.AD_DAILY)
    upsert(_first_facts(spark, sf_dir), target)
    upsert(_revised_facts(spark, sf_dir), target)
    return fact_output(spark, target)


@query("upsert_twice", UPSERT_SQL)
def upsert_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running the same revision again changes nothing."""
    target = new_table(spark, T.AD_DAILY)
    upsert(_first_facts(spark, sf_dir), target)
    for _ in range(2):
        upsert(_revised_facts(spark, sf_dir), target)
    return fact_output(spark, target)


@query("upsert_bucketed", UPSERT_SQL)
def upsert_bucketed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two runs into a catalog table bucketed by its key."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    root = scratch_path(spark, T.AD_DAILY.name)
    # The last part of the path is unique, so a query that runs again has a table of its own.
    target = BucketedTable(T.AD_DAILY, root.rsplit("/", 1)[-1].replace("-", "_"), root, buckets)
    upsert_bucketed(_first_facts(spark, sf_dir), target)
    upsert_bucketed(_revised_facts(spark, sf_dir), target)
    return fact_output(spark, target)


# Noon UTC of the first creation day; orders are created over sixty days, the last ten of them recent.
CREATED_FROM = 1672574400
RECENT_FROM = "2023-02-20"


def _order_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("act_"), (F.col("o_custkey") % 5).cast("string")).alias("ad_account_id"),
        F.col("o_orderkey").cast("string").alias("ad_id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("effective_status"),
        F.timestamp_seconds(F.lit(CREATED_FROM) + F.col("o_orderkey") % 60 * 86_400).alias("created_time"),
    )


DIM_SQL = f"""
WITH old AS (SELECT 'act_' || CAST(o_custkey % 5 AS VARCHAR) AS ad_account_id, CAST(o_orderkey AS VARCHAR) AS ad_id,
                    o_orderpriority AS name, o_orderstatus AS effective_status,
                    CAST({CREATED_FROM} + o_orderkey % 60 * 86400 AS BIGINT) AS created_time FROM orders),
recent AS (SELECT * FROM old WHERE created_time >= epoch(TIMESTAMP '{RECENT_FROM} 00:00:00')),
source AS (SELECT ad_account_id, ad_id, 'renamed' AS name, CAST(NULL AS VARCHAR) AS effective_status,
                  created_time {{shift}} AS created_time FROM recent WHERE effective_status = 'F'
           UNION ALL SELECT ad_account_id, 'new-' || ad_id, name, effective_status, created_time FROM recent)
SELECT *, CAST({SECOND_EPOCH} AS BIGINT) AS ingested_at FROM source
UNION ALL
SELECT *, CAST({FIRST_EPOCH} AS BIGINT) FROM old o
WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.ad_account_id = o.ad_account_id AND s.ad_id = o.ad_id)"""


def _upsert_dims(spark: SparkSession, sf_dir: str, shift_days: int) -> DataFrame:
    old = _order_entities(spark, sf_dir)
    recent = old.where(F.col("created_time") >= F.lit(utc_instant(RECENT_FROM)))
    revised = recent.where("effective_status = 'F'").withColumns(
        {
            "name": F.lit("renamed"),
            "effective_status": F.lit(None).cast("string"),
            "created_time": F.col("created_time") + F.make_dt_interval(F.lit(shift_days)),
        }
    )
    added = recent.withColumn("ad_id", F.concat(F.lit("new-"), "ad_id"))
    target = new_table(spark, T.ADS)
    upsert(_stamped(old, FIRST_RUN), target)
    upsert(_stamped(revised.unionByName(added), SECOND_RUN), target)
    columns = ("ad_account_id", "ad_id", "name", "effective_status", "created_time", "ingested_at")
    return portable(target.read(spark).select(*columns))


@query("upsert_dims", DIM_SQL.format(shift=""))
def upsert_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities revised on the day they were created: only those days are rewritten."""
    return _upsert_dims(spark, sf_dir, 0)


@query("upsert_dims_moved", DIM_SQL.format(shift="- 30 * 86400"))
def upsert_dims_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities that come back with another creation day leave their old one."""
    return _upsert_dims(spark, sf_dir, -30)


@query(
    "replace_table",
    """SELECT 'act_' || CAST(o_custkey % 5 AS VARCHAR) AS ad_account_id, CAST(o_orderkey AS VARCHAR) AS ad_id,
       o_orderstatus AS effective_status FROM orders WHERE o_orderstatus <> 'P'""",
)
def replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_table(spark, T.ADS)
    rows = _stamped(_order_entities(spark, sf_dir), FIRST_RUN)
    replace(rows, target)
    replace(rows.where("effective_status <> 'P'"), target)
    return target.read(spark).select("ad_account_id", "ad_id", "effective_status")


@query(
    "dedupe_source",
    """SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS shipped, l_partkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_shipdate DESC, l_partkey DESC, l_extendedprice DESC, l_suppkey DESC) = 1""",
)
def dedupe_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    newest = [F.col(c).desc() for c in ("l_shipdate", "l_partkey", "l_extendedprice", "l_suppkey")]
    kept = latest_per_key(rows, ("l_orderkey", "l_linenumber"), newest)
    return kept.select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("shipped"), "l_partkey", "l_extendedprice")


def _campaign_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as accounts, order priorities as their campaigns: one run per account, its rows numbered and cut into pages."""
    rows = raw_delivery(spark, sf_dir).groupBy("ad_id", "age", "stat_date").agg(
        F.sum("spend").cast("double").alias("spend"),
        *(F.sum(m).cast("bigint").alias(m) for m in ADDITIVE[1:]),
        F.count_distinct("person_id").alias("reach"),
    )
    text = [F.col(m).cast("string").alias(m) for m in (*ADDITIVE, "reach")]
    item = F.struct(
        F.col("stat_date").cast("string").alias("date_start"), F.col("age").alias("campaign_id"),
        F.concat(F.lit("name of "), "age").alias("campaign_name"), F.lit("LEADS").alias("objective"), *text,
    )
    places = numbered_within(rows, "ad_id", ("stat_date", "age"), "place")
    cut = places.select("ad_id", "place", item.alias("item"), (L.div(F.col("place") - 1, L.PAGE) + 1).alias("page"))
    account, run = (F.concat(F.lit(prefix), F.col("ad_id").cast("string")) for prefix in ("act_", "run-"))
    last = cut.groupBy(account.alias("ad_account_id"), run.alias("run_id")).agg(F.max("page").alias("last"))
    return L.landed(cut, account, run, F.col("page"), F.col("place"), F.col("item"), last)


CAMPAIGN_GRAIN = "'act_' || ad_id AS ad_account_id, age AS campaign_id, stat_date"


@query(
    "run_facts",
    f"""WITH {DELIVERY_SQL}, {report_sql(CAMPAIGN_GRAIN)}
SELECT {sql_columns(T.CAMPAIGN_DAILY, {
    **{c: c for c in ("ad_account_id", "campaign_id", "stat_date", *ADDITIVE, "reach")},
    "campaign_name": "'name of ' || campaign_id", "objective": "'LEADS'", "ingested_at": str(SECOND_EPOCH)})}
FROM report WHERE stat_date BETWEEN DATE '2001-07-19' AND DATE '2001-08-01'""",
)
def run_facts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole fact run: submissions and status log gated, pages checked, typed, windowed, upserted."""
    pages = L.through_files(spark, _campaign_pages(spark, sf_dir))
    runs = pages.select("ad_account_id", "run_id").distinct()
    answer = F.to_json(F.struct(F.col("run_id").alias("report_run_id")))
    submissions = runs.select(
        "ad_account_id", F.lit(1).alias("seq"), F.lit(200).alias("code"), answer.alias("body"), F.lit("").alias("error")
    )
    steps = F.array(F.lit("Job Started"), F.lit("Job Running"), F.lit("Job Completed"))
    checks = runs.select("run_id", F.posexplode(steps).alias("round", "async_status"), F.lit("").alias("error"))
    target = new_table(spark, T.CAMPAIGN_DAILY)
    run_facts(pages, submissions, checks, target, window=date_window(ORDERS_AS_OF), ingested_at=SECOND_RUN)
    return portable(target.read(spark))


def _listing_sql(name: str, spec, known: dict[str, str], source: str, id_column: str) -> str:
    return f"""SELECT '{name}' AS entity, ad_account_id, {id_column} AS id, name, created_time, ingested_at
FROM (SELECT {sql_columns(spec, known)} FROM {source})"""


@query(
    "run_dimensions",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        (
            _listing_sql("campaigns", T.CAMPAIGNS, CAMPAIGNS_KNOWN, "supplier", "campaign_id"),
            _listing_sql("ad_sets", T.AD_SETS, AD_SETS_KNOWN, "part", "ad_set_id"),
            _listing_sql("ads", T.ADS, ADS_KNOWN, "customer", "ad_id"),
        )
    )
    + """) WHERE created_time >= epoch(TIMESTAMP '2020-01-21 00:00:00') AND created_time < epoch(TIMESTAMP '2022-01-01 00:00:00')
  AND ad_account_id IN ('act_0', 'act_1', 'act_2')""",
)
def run_dimensions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole dimension run for three accounts; no campaign falls in the window, so that table stays unwritten."""
    pages = {
        "campaigns": L.campaign_listing(spark, sf_dir),
        "ad_sets": _numbered(L.ad_set_listing(spark, sf_dir)),
        "ads": _numbered(L.ad_listing(spark, sf_dir)),
    }
    pages["campaigns"] = _numbered(pages["campaigns"])
    targets = {"campaigns": new_table(spark, T.CAMPAIGNS), "ad_sets": new_table(spark, T.AD_SETS), "ads": new_table(spark, T.ADS)}
    visible = pages["ads"].select("ad_account_id").distinct()
    window = date_window("2022-01-01", start="2020-01-21", end="2021-12-31")
    written = run_dimensions(pages, targets, visible, window=window, accounts="0, 1,act_2,act_9")
    ids = {"campaigns": "campaign_id", "ad_sets": "ad_set_id", "ads": "ad_id"}
    out = None
    for name in written:
        rows = targets[name].read(spark).select(
            F.lit(name).alias("entity"), "ad_account_id", F.col(ids[name]).alias("id"), "name", "created_time", "ingested_at"
        )
        out = rows if out is None else out.unionByName(rows)
    return portable(out)


def _numbered(pages: DataFrame) -> DataFrame:
    """The pages of each account's listing numbered without gaps, which listings cut by key may have: one whole chain each."""
    numbers = numbered_within(pages, "ad_account_id", ("page_no",), "place")
    return numbers.withColumn("page_no", F.col("place")).select(*LANDED_PAGE.names)
