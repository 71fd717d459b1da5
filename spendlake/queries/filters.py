"""Windows, account lists, statuses and the report-run log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.functions.days import as_instant, date_window, day_end_epoch, day_start_epoch
from spendlake.operators.filters import (
    allow_accounts,
    created_between,
    drop_stale,
    in_days,
    is_final,
    unknown_accounts,
    with_local_day,
)
from spendlake.operators.numbering import text_blocks
from spendlake.operators.quality import collate, incomplete_runs, landing_failures, null_key_audit, submission_failures
from spendlake.operators.runs import poll_rounds, run_outcomes, run_status, started_runs
from spendlake.queries import landing as L
from spendlake.queries.base import query, table
from spendlake.queries.sources import _paired
from spendlake.sources.pages import page_chain_check

AS_OF = "1999-07-01"


@query(
    "date_window_filter",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS stat_date FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1999-06-17' AND DATE '1999-06-30'""",
)
def date_window_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("stat_date"))
    return in_days(orders, "stat_date", *date_window(AS_OF))


@query(
    "created_window",
    """SELECT event_id, user_id FROM events
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-19 00:00:00'""",
)
def created_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return created_between(events, "ts", *date_window("2024-01-19")).select("event_id", "user_id")


# Time zones of the accounts, east and west of UTC, with and without summer time.
ZONES = ("America/Los_Angeles", "Europe/Berlin", "Asia/Tokyo", "Australia/Sydney", "UTC")
ZONE_CASES = " ".join(f"WHEN {i} THEN '{z}'" for i, z in enumerate(ZONES))


@query(
    "account_local_day",
    f"""
WITH local AS (
  SELECT 'act_' || CAST(user_id AS VARCHAR) AS ad_account_id, value,
         CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE CASE user_id % 5 {ZONE_CASES} END AS DATE) AS stat_date
  FROM events)
SELECT ad_account_id, stat_date, CAST(count(*) AS BIGINT) AS events,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS spend
FROM local GROUP BY ALL""",
)
def account_local_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("ad_account_id", F.concat(F.lit("act_"), F.col("user_id").cast("string")))
    zone = F.element_at(F.array(*(F.lit(z) for z in ZONES)), (F.col("user_id") % 5 + 1).cast("int"))
    zones = events.select("ad_account_id", zone.alias("time_zone")).distinct()
    local = with_local_day(events, "ts", zones)
    return local.groupBy("ad_account_id", "stat_date").agg(
        F.count("*").alias("events"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("spend")
    )


@query(
    "day_epochs",
    """SELECT o_orderkey, CAST(epoch(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)) AS BIGINT) AS first_second,
       CAST(epoch(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)) + 86399 AS BIGINT) AS last_second FROM orders""",
)
def day_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", day_start_epoch(day).alias("first_second"), day_end_epoch(day).alias("last_second")
    )


ALLOW_LIST = " 12, act_34 ,,999999999, act_7,12,\tx9 "


def _discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.concat(F.lit("act_"), F.col("c_custkey").cast("string")).alias("ad_account_id"))


REQUESTED_SQL = "(VALUES ('act_12'), ('act_34'), ('act_999999999'), ('act_7'), ('act_12'), ('act_x9')) AS r(ad_account_id)"


@query(
    "allow_accounts",
    f"SELECT ad_account_id FROM {REQUESTED_SQL} WHERE ad_account_id IN (SELECT 'act_' || CAST(c_custkey AS VARCHAR) FROM customer)",
)
def allow_accounts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allow_accounts(_discovered(spark, sf_dir), ALLOW_LIST)


@query(
    "unknown_accounts",
    f"SELECT ad_account_id FROM {REQUESTED_SQL} WHERE ad_account_id NOT IN (SELECT 'act_' || CAST(c_custkey AS VARCHAR) FROM customer)",
)
def unknown_accounts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unknown_accounts(_discovered(spark, sf_dir), ALLOW_LIST)


@query(
    "drop_stale",
    """SELECT o_orderkey, status FROM
(SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'DELETED' WHEN 'P' THEN 'ACTIVE' END AS status,
        CASE WHEN o_orderpriority = '5-LOW' THEN 'ARCHIVED' END AS configured FROM orders)
WHERE coalesce(status, '') <> 'DELETED' AND coalesce(configured, '') <> 'ARCHIVED'""",
)
def drop_stale_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "DELETED").when(F.col("o_orderstatus") == "P", "ACTIVE")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        status.alias("effective_status"),
        F.when(F.col("o_orderpriority") == "5-LOW", "ARCHIVED").alias("configured_status"),
    )
    return drop_stale(rows).select("o_orderkey", F.col("effective_status").alias("status"))


# The report-run log: an order is a run, its lines are the status checks of polling rounds.
CHECKS_SQL = """
checks AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS run_id, l_linenumber AS round, l_shipdate AS observed_at,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN CASE WHEN l_quantity > 25 THEN 'Job Failed' ELSE 'Job Skipped' END
              WHEN l_returnflag = 'R' THEN 'Job Completed' WHEN l_linestatus = 'O' THEN 'Job Running' ELSE 'Job Started' END AS status,
         CASE WHEN l_tax > 0.06 THEN 'HTTP 500' ELSE '' END AS error
  FROM lineitem),
finals AS (SELECT run_id, round, status FROM checks WHERE error = '' AND status IN ('Job Completed', 'Job Failed', 'Job Skipped')
           QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY round, status) = 1),
statuses AS (SELECT c.run_id, any_value(f.status) AS final_status, any_value(f.round) AS final_round, max(c.round) AS last_round
             FROM checks c LEFT JOIN finals f USING (run_id) GROUP BY c.run_id)"""


def status_checks(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    returned, open_line = F.col("l_returnflag") == "R", F.col("l_linestatus") == "O"
    failed = F.when(F.col("l_quantity") > 25, "Job Failed").otherwise("Job Skipped")
    status = F.when(returned & ~open_line, failed).when(returned, "Job Completed").when(open_line, "Job Running")
    lines = table(spark, sf_dir, "lineitem") if lines is None else lines
    return lines.select(
        F.col("l_orderkey").cast("string").alias("run_id"),
        F.col("l_linenumber").alias("round"),
        as_instant(F.col("l_shipdate")).alias("observed_at"),
        status.otherwise("Job Started").alias("async_status"),
        F.when(F.col("l_tax") > 0.06, "HTTP 500").otherwise("").alias("error"),
    )


def submitted_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("act_"), F.col("o_custkey").cast("string")).alias("ad_account_id"),
        F.col("o_orderkey").cast("string").alias("run_id"),
    )


@query("run_status", f"WITH {CHECKS_SQL} SELECT run_id, final_status, final_round, last_round FROM statuses")
def run_status_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_status(status_checks(spark, sf_dir))


@query(
    "final_checks",
    f"""WITH {CHECKS_SQL} SELECT status, status IN ('Job Completed', 'Job Failed', 'Job Skipped') AS final,
       CAST(count(*) AS BIGINT) AS checks FROM checks GROUP BY ALL""",
)
def final_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = status_checks(spark, sf_dir).withColumnRenamed("async_status", "status")
    return checks.groupBy("status", is_final(F.col("status")).alias("final")).agg(F.count("*").alias("checks"))


OUTCOMES_SQL = f"""{CHECKS_SQL},
outcomes AS (SELECT 'act_' || CAST(o_custkey AS VARCHAR) AS ad_account_id, CAST(o_orderkey AS VARCHAR) AS run_id,
                    final_status, coalesce(final_status = 'Job Completed', false) AS completed
             FROM orders LEFT JOIN statuses ON run_id = CAST(o_orderkey AS VARCHAR))"""


@query("run_outcomes", f"WITH {OUTCOMES_SQL} SELECT * FROM outcomes")
def run_outcomes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_outcomes(submitted_runs(spark, sf_dir), run_status(status_checks(spark, sf_dir)))


@query(
    "run_gate",
    f"""WITH {OUTCOMES_SQL}
SELECT ad_account_id, run_id, final_status,
       ad_account_id || ' (run ' || run_id || '): ' || coalesce(final_status, 'None') AS detail
FROM outcomes WHERE NOT completed""",
)
def run_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gate before a write would list."""
    outcomes = run_outcomes(submitted_runs(spark, sf_dir), run_status(status_checks(spark, sf_dir)))
    return incomplete_runs(outcomes)


@query(
    "submission_gate",
    f"""WITH {L.BATCH_SQL},
failures AS (SELECT 'act_' || CAST(e.user_id AS VARCHAR) AS ad_account_id,
                    CASE WHEN r.error <> '' THEN r.error ELSE 'no report_run_id in response' END AS failure
             FROM responses r JOIN events e USING (event_id) WHERE r.error <> '' OR r.run_id IS NULL)
SELECT ad_account_id, failure, ad_account_id || ': ' || failure AS detail FROM failures""",
)
def submission_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return submission_failures(started_runs(_paired(spark, sf_dir)))


@query(
    "failure_texts",
    f"""WITH {OUTCOMES_SQL},
failures AS (SELECT ad_account_id, ad_account_id || ' (run ' || run_id || '): ' || coalesce(final_status, 'None') AS detail
             FROM outcomes WHERE NOT completed)
SELECT ad_account_id, CAST(count(*) AS BIGINT) AS failures, string_agg(detail, '; ' ORDER BY detail) AS detail
FROM failures GROUP BY ad_account_id""",
)
def failure_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All failures of an account in one text."""
    outcomes = run_outcomes(submitted_runs(spark, sf_dir), run_status(status_checks(spark, sf_dir)))
    return collate(incomplete_runs(outcomes))


#: Texts in a row.
TEXTS = 100


@query(
    "failure_text_blocks",
    f"""WITH {OUTCOMES_SQL},
failures AS (SELECT ad_account_id, ad_account_id || ' (run ' || run_id || '): ' || coalesce(final_status, 'None') AS detail
             FROM outcomes WHERE NOT completed),
numbered AS (SELECT *, (row_number() OVER (PARTITION BY ad_account_id ORDER BY detail) - 1) // {TEXTS} AS block FROM failures)
SELECT ad_account_id, CAST(block AS BIGINT) AS block, CAST(count(*) AS BIGINT) AS failures, string_agg(detail, '; ' ORDER BY detail) AS detail
FROM numbered GROUP BY ad_account_id, block""",
)
def failure_text_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All failures of an account in rows of bounded size."""
    outcomes = run_outcomes(submitted_runs(spark, sf_dir), run_status(status_checks(spark, sf_dir)))
    return text_blocks(incomplete_runs(outcomes), size=TEXTS)


@query(
    "landing_gate",
    """SELECT 'act_' || CAST(c_custkey AS VARCHAR) AS ad_account_id, 'run-' || CAST(c_custkey AS VARCHAR) AS run_id,
       CASE c_custkey % 4 WHEN 0 THEN 'no page landed' WHEN 1 THEN 'a page is an error' ELSE 'page chain broken' END AS reason
FROM customer WHERE c_custkey % 4 < 3""",
)
def landing_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as runs with a page each: of every four one has none, one an error, one a page that has a next."""
    key = F.col("c_custkey")
    runs = table(spark, sf_dir, "customer").select(
        key.alias("no"), F.concat(F.lit("act_"), key.cast("string")).alias("ad_account_id"), F.concat(F.lit("run-"), key.cast("string")).alias("run_id")
    )
    body = (
        F.when(F.col("no") % 4 == 1, '{"error": {"message": "too many calls"}}')
        .when(F.col("no") % 4 == 2, '{"data": [], "paging": {"next": "https://next"}}')
        .otherwise('{"data": [{"id": "1"}], "paging": {"cursors": {"after": "c"}}}')
    )
    pages = runs.where("no % 4 <> 0").select("ad_account_id", "run_id", F.lit(1).cast("long").alias("page_no"), body.alias("body"))
    return landing_failures(page_chain_check(pages), runs).drop("detail")


@query(
    "poll_rounds",
    f"""WITH {CHECKS_SQL},
rounds AS (SELECT DISTINCT round FROM checks),
ended AS (SELECT final_round AS round, count(*) AS n FROM statuses WHERE final_round IS NOT NULL GROUP BY 1)
SELECT r.round, CAST(coalesce(sum(e.n), 0) AS BIGINT) AS finished,
       CAST((SELECT count(*) FROM statuses) - coalesce(sum(e.n), 0) AS BIGINT) AS pending
FROM rounds r LEFT JOIN ended e ON e.round <= r.round GROUP BY r.round""",
)
def poll_rounds_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poll_rounds(status_checks(spark, sf_dir))


@query(
    "null_key_audit",
    """SELECT CAST(count(*) AS BIGINT) AS row_count,
       CAST(count(*) FILTER (gender IS NULL OR age IS NULL) AS BIGINT) AS null_key_rows,
       CAST(count(*) FILTER (gender IS NULL) AS BIGINT) AS null_gender, CAST(count(*) FILTER (age IS NULL) AS BIGINT) AS null_age
FROM (SELECT nullif(o_orderstatus, 'P') AS gender, nullif(o_orderpriority, '5-LOW') AS age FROM orders)""",
)
def null_key_audit_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        F.nullif("o_orderstatus", F.lit("P")).alias("gender"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("age")
    )
    return null_key_audit(rows, ("gender", "age"))
