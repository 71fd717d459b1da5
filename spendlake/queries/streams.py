"""Streaming forms, run to the end of what has landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.plans import tables as T
from spendlake.plans.spec import TableSpec
from spendlake.queries import landing as L
from spendlake.queries.base import portable, query, table
from spendlake.queries.filters import CHECKS_SQL, status_checks
from spendlake.queries.sources import ACCOUNT_OF_AD
from spendlake.queries.tables import new_table
from spendlake.session import scratch_path
from spendlake.sources.pages import scan_pages
from spendlake.streaming.audit import BatchAudit
from spendlake.streaming.finish import finish
from spendlake.streaming.chains import chain_stream, newest_reports, track_chains
from spendlake.streaming.daily import daily_stream, daily_totals
from spendlake.streaming.gated import gated_stream, with_outcomes
from spendlake.streaming.late import accept, accepted
from spendlake.streaming.reach import daily_people, people_stream
from spendlake.streaming.replay import pages_once
from spendlake.streaming.runs import RUN_DEADLINE_SECONDS, track_runs
from spendlake.streaming.upsert import landed_stream, upsert_stream


def stream_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table as a file stream; as a pattern the path may be one file or a folder of files."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}[.]parquet")


@query(
    "stream_upsert",
    f"""
SELECT {ACCOUNT_OF_AD} AS ad_account_id, CAST(c_custkey AS VARCHAR) AS ad_id,
       CASE WHEN c_custkey // {L.PAGE} % 2 = 0 THEN 'late ' || c_name ELSE c_name END AS name,
       CAST({L.LANDED_EPOCH} + CASE WHEN c_custkey // {L.PAGE} % 2 = 0 THEN 86400 ELSE 0 END AS BIGINT) AS ingested_at
FROM customer""",
)
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All listings land, and later every other page lands again with new names."""
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    target = new_table(spark, T.ADS)
    pages = L.ad_listing(spark, sf_dir)
    late = pages.where("page_no % 2 = 1").withColumns(
        {
            "body": F.regexp_replace("body", '"name":"', '"name":"late '),
            "landed_at": F.col("landed_at") + F.expr("INTERVAL 1 DAY"),
        }
    )
    for arriving in (pages, late):
        arriving.write.mode("append").parquet(landing)
        upsert_stream(landed_stream(spark, landing), target, checkpoint).awaitTermination()
    return portable(target.read(spark).select("ad_account_id", "ad_id", "name", "ingested_at"))


EVENT_DAILY = TableSpec.of(
    "event_daily",
    (
        ("event_type", "event_type", "string"),
        ("date_start", "stat_date", "date"),
        ("events", "events", "bigint"),
        ("spend", "spend", "double"),
        ("reach", "reach", "bigint"),
    ),
    keys=("ad_account_id", "event_type", "stat_date"),
    day_of="stat_date",
)


#: Files of a micro-batch where the order of landing is that of time.
FILES_PER_BATCH = 4


@query(
    "stream_daily",
    """
SELECT 'act_' || CAST(user_id % 5 AS VARCHAR) AS ad_account_id, event_type, CAST(ts AS DATE) AS stat_date,
       CAST(count(*) AS BIGINT) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS spend,
       CAST(max((CAST(ts AS DATE) - DATE '1970-01-01') // 7 * 604800 + 604800) AS BIGINT) AS ingested_at
FROM events GROUP BY ALL""",
)
def stream_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events land week by week, each week a batch or more, under the lookback's own lateness."""
    return portable(_daily_table(spark, sf_dir).drop("reach"))


def _daily_table(spark: SparkSession, sf_dir: str, person: str | None = None) -> DataFrame:
    events, landing, checkpoint = table(spark, sf_dir, "events"), scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    week = F.floor(F.unix_date(F.col("ts").cast("date")) / 7)
    landed = _with_account(events).withColumn("week", week).withColumn("landed_at", F.timestamp_seconds((F.col("week") + 1) * 604800))
    target = new_table(spark, EVENT_DAILY)
    weeks = [r.week for r in landed.select("week").distinct().orderBy("week").collect()]  # bounded by the calendar
    for w in weeks:
        landed.where(F.col("week") == w).drop("week").write.mode("append").parquet(landing)
    stream = spark.readStream.schema(landed.drop("week").schema).option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(landing)
    totals = daily_totals(stream, ("ad_account_id", "event_type"), person=person, landed="landed_at")
    finish(daily_stream(totals, target, checkpoint), checkpoint=checkpoint)
    return target.read(spark)


def _with_account(events: DataFrame) -> DataFrame:
    return events.withColumn("ad_account_id", F.concat(F.lit("act_"), (F.col("user_id") % 5).cast("string")))


@query(
    "stream_daily_reach",
    """
SELECT 'act_' || CAST(user_id % 5 AS VARCHAR) AS ad_account_id, event_type, CAST(ts AS DATE) AS stat_date,
       CAST(count(DISTINCT user_id) AS BIGINT) AS reach, true AS streamed_is_close
FROM events GROUP BY ALL""",
)
def stream_daily_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streamed sketch of reach next to the exact count: close means within a fifth, or one of a few."""
    grain = ["ad_account_id", "event_type", "stat_date"]
    streamed = _daily_table(spark, sf_dir, "user_id").select(*grain, F.col("reach").alias("sketch"))
    events = _with_account(table(spark, sf_dir, "events")).withColumn("stat_date", F.col("ts").cast("date"))
    exact = events.groupBy(*grain).agg(F.count_distinct("user_id").alias("reach"))
    close = F.abs(F.col("sketch") - F.col("reach")) <= F.lit(1) + F.col("reach") * 0.2
    return exact.join(streamed, grain, "left").select(*grain, "reach", F.coalesce(close, F.lit(False)).alias("streamed_is_close"))


@query(
    "stream_exact_reach",
    """
SELECT 'act_' || CAST(user_id % 5 AS VARCHAR) AS ad_account_id, event_type, CAST(ts AS DATE) AS stat_date,
       CAST(count(*) AS BIGINT) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS spend,
       CAST(count(DISTINCT user_id) AS BIGINT) AS reach
FROM events WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 14 DAY GROUP BY ALL""",
)
def stream_exact_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events land quarter by quarter, each followed by a run on the same state; the days closed at the end."""
    events = _with_account(table(spark, sf_dir, "events"))
    landing, out, checkpoint = (scratch_path(spark, name) for name in ("landing", "reach", "checkpoint"))
    quarter = F.year("ts") * 4 + F.quarter("ts")
    for q in [r.q for r in events.select(quarter.alias("q")).distinct().orderBy("q").collect()]:  # bounded by the calendar
        events.where(quarter == q).write.mode("append").parquet(landing)
        people = daily_people(spark.readStream.schema(events.schema).parquet(landing), ("ad_account_id", "event_type"), "user_id")
        finish(people_stream(people, out, checkpoint), checkpoint=checkpoint)
    return spark.read.parquet(out)


@query(
    "stream_replay_proof",
    f"""
WITH ads AS (SELECT {ACCOUNT_OF_AD} AS ad_account_id, CAST(c_custkey AS VARCHAR) AS id, c_custkey // {L.PAGE} + 1 AS page_no FROM customer)
SELECT ad_account_id, id, CAST({L.LANDED_EPOCH} AS BIGINT) AS landed_at FROM ads
UNION ALL SELECT ad_account_id, id, CAST({L.LANDED_EPOCH} + 86400 AS BIGINT) FROM ads WHERE page_no % 2 = 1""",
)
def stream_replay_proof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects appended as their pages land; all pages land a second time in other files, every other page anew a day
    later, that twice as well. Without keys, only the source keeps an object from being there twice."""
    landing, out, checkpoint = (scratch_path(spark, name) for name in ("landing", "objects", "checkpoint"))
    pages = L.ad_listing(spark, sf_dir)
    anew = pages.where("page_no % 2 = 1").withColumn("landed_at", F.col("landed_at") + F.expr("INTERVAL 1 DAY"))
    for arriving in (pages, pages.unionByName(anew), anew):
        arriving.write.mode("append").parquet(landing)
        items = scan_pages(pages_once(landed_stream(spark, landing)))
        objects = items.select("ad_account_id", F.get_json_object("item", "$.id").alias("id"), F.unix_seconds("landed_at").alias("landed_at"))
        writer = objects.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        finish(writer.trigger(availableNow=True).start(), checkpoint=checkpoint)
    return spark.read.parquet(out)


# Polling rounds half an hour apart.
ROUND_SECONDS = 1800
LOG_START = 1704067200


@query(
    "run_tracker",
    f"""WITH {CHECKS_SQL},
timed AS (SELECT run_id, {LOG_START} + round * {ROUND_SECONDS} AS seen, status, error FROM checks),
firsts AS (SELECT run_id, min(seen) AS first_seen FROM timed GROUP BY run_id),
ends AS (SELECT run_id, seen, status FROM timed WHERE error = '' AND status IN ('Job Completed', 'Job Failed', 'Job Skipped')
         QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY seen, status) = 1)
SELECT run_id,
       CASE WHEN e.seen <= first_seen + 3600 THEN e.status ELSE 'Timed Out' END AS status,
       CAST(CASE WHEN e.seen <= first_seen + 3600 THEN e.seen ELSE first_seen + 3600 END AS BIGINT) AS known_at
FROM firsts LEFT JOIN ends e USING (run_id)
WHERE e.seen IS NOT NULL OR first_seen + 3600 < (SELECT max(seen) FROM timed) - 3600""",
)
def run_tracker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as status checks, round by round in files of their own, over several micro-batches.

    Runs for which the log ends within their deadline and the lateness are not reported.
    """
    at = F.timestamp_seconds(F.lit(LOG_START) + F.col("round") * ROUND_SECONDS)
    checks = status_checks(spark, sf_dir).withColumn("observed_at", at)
    checks, rounds = checks.drop("round"), checks
    landing, gate, out, checkpoint = (scratch_path(spark, name) for name in ("landing", "gate", "outcomes", "checkpoint"))
    for low, high in ((1, 2), (3, 4), (5, 2**31 - 1)):
        rounds.where(F.col("round").between(low, high)).drop("round").write.mode("append").parquet(landing)
        landed = spark.readStream.schema(checks.schema).option("maxFilesPerTrigger", 64).parquet(landing)
        # Rounds of up to an hour and a half in one batch, the tracker's own lateness.
        finish(accept(landed, "observed_at", f"{RUN_DEADLINE_SECONDS} seconds", gate, f"{checkpoint}/gate"))
        writer = track_runs(accepted(spark, gate, checks.schema)).writeStream.outputMode("append").format("parquet").option("path", out)
        finish(writer.option("checkpointLocation", f"{checkpoint}/runs").trigger(availableNow=True).start(), checkpoint=f"{checkpoint}/runs")
    return portable(spark.read.schema("run_id STRING, status STRING, checks BIGINT, known_at TIMESTAMP").parquet(out)).drop("checks")


@query(
    "stream_chain_check",
    f"""
WITH listed AS (SELECT DISTINCT {ACCOUNT_OF_AD} AS ad_account_id, c_custkey // {L.PAGE} + 1 AS page_no FROM customer),
ends AS (SELECT ad_account_id, max(page_no) AS last FROM listed GROUP BY ad_account_id),
pages AS (SELECT * FROM listed JOIN ends USING (ad_account_id) WHERE NOT (ad_account_id = 'act_2' AND page_no = 2)),
chains AS (
  SELECT ad_account_id, 'ads' AS run_id, CAST(count(*) AS BIGINT) AS pages, CAST(min(page_no) AS BIGINT) AS first_page,
         CAST(max(page_no) AS BIGINT) AS last_page, CAST(count(*) FILTER (page_no = last) AS BIGINT) AS end_pages,
         CAST(max(page_no) - least(min(page_no), 1) + 1 - count(*) AS BIGINT) AS missing,
         (min(page_no) = 1 AND count(*) = max(page_no) AND max(page_no) = any_value(last)) AS complete
  FROM pages GROUP BY ad_account_id)
SELECT *, NOT complete AS overdue FROM chains""",
)
def stream_chain_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ad listing lands out of order over three rounds hours apart, one account's second page never; a chain is overdue
    once another round has landed. The last account's pages come in the last round."""
    pages = L.ad_listing(spark, sf_dir).where("NOT (ad_account_id = 'act_2' AND page_no = 2)")
    round_ = F.when(F.col("ad_account_id") == "act_4", 2).otherwise(1 - F.col("page_no") % 2)
    pages = pages.withColumn("round", round_).withColumn("landed_at", F.col("landed_at") + F.col("round") * F.expr("INTERVAL 3 HOURS"))
    landing, out, checkpoint = (scratch_path(spark, name) for name in ("landing", "chains", "checkpoint"))
    for number in range(3):
        pages.where(F.col("round") == number).drop("round").write.mode("append").parquet(landing)
        found = track_chains(landed_stream(spark, landing, files_per_batch=1_000_000))
        finish(chain_stream(found, out, checkpoint), checkpoint=checkpoint)
    return newest_reports(spark.read.parquet(out)).drop("error_pages", "seen_at")


#: Of every four runs one failed and of one nothing is heard; a page is a run of its own.
_RUN_KIND_SQL = f"(c_custkey // {L.PAGE} + 1 + c_nationkey % 5) % 4"


def _gated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Ads of the listing, a run for every page, landed on three days with what became of the runs; and the list of pages held.

    Outcomes are known ten minutes after the page. A last day without runs lets the streams pass the others."""
    number = F.substring("ad_account_id", 5, 1).cast("int")
    kind, day = (F.col("page_no") + number) % 4, F.col("page_no") % 3
    pages = L.ad_listing(spark, sf_dir).withColumn("run_id", F.concat_ws("/", "ad_account_id", F.col("page_no").cast("string")))
    pages = pages.withColumns({"kind": kind, "day": day, "landed_at": F.col("landed_at") + day * F.expr("INTERVAL 1 DAY")})
    status = F.when(F.col("kind") == 0, "Job Failed").otherwise("Job Completed")
    outcomes = pages.where("kind <> 1").select("run_id", status.alias("status"), (F.col("landed_at") + F.expr("INTERVAL 10 MINUTES")).alias("known_at"), "day")
    clock = spark.range(1).select(F.lit("none").alias("run_id"), F.lit("Job Completed").alias("status"), (F.lit(L.LANDED_AT).cast("timestamp") + F.expr("INTERVAL 9 DAYS")).alias("known_at"), F.lit(3).alias("day"))
    idle = clock.select(F.lit("act_0").alias("ad_account_id"), "run_id", F.lit(1).cast("bigint").alias("page_no"), F.col("known_at").alias("landed_at"), F.lit('{"data":[]}').alias("body"), "day")
    pages, outcomes = pages.drop("kind").unionByName(idle), outcomes.unionByName(clock)
    landing, known, held, checkpoint = (scratch_path(spark, name) for name in ("landing", "outcomes", "held", "checkpoint"))
    target = new_table(spark, T.ADS)
    for d in range(4):
        pages.where(F.col("day") == d).drop("day").write.mode("append").parquet(landing)
        outcomes.where(F.col("day") == d).drop("day").write.mode("append").parquet(known)
    left = spark.readStream.schema(pages.drop("day").schema).parquet(landing)
    right = spark.readStream.schema(outcomes.drop("day").schema).parquet(known)
    # All days in one batch, then the batch without rows that their watermark calls for.
    finish(gated_stream(with_outcomes(left, right, late="5 days"), target, held, checkpoint), checkpoint=checkpoint)
    return target.read(spark), held


@query(
    "stream_gated_upsert",
    f"""
SELECT {ACCOUNT_OF_AD} AS ad_account_id, CAST(c_custkey AS VARCHAR) AS ad_id, c_name AS name
FROM customer WHERE {_RUN_KIND_SQL} IN (2, 3)""",
)
def stream_gated_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only ads of runs that completed get in."""
    return _gated(spark, sf_dir)[0].select("ad_account_id", "ad_id", "name")


@query(
    "stream_gate_held",
    f"""
SELECT DISTINCT {ACCOUNT_OF_AD} AS ad_account_id, {ACCOUNT_OF_AD} || '/' || CAST(c_custkey // {L.PAGE} + 1 AS VARCHAR) AS run_id,
       CAST(c_custkey // {L.PAGE} + 1 AS BIGINT) AS page_no,
       CASE {_RUN_KIND_SQL} WHEN 0 THEN 'Job Failed' ELSE 'no outcome in time' END AS reason
FROM customer WHERE {_RUN_KIND_SQL} IN (0, 1)""",
)
def stream_gate_held(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages kept out, and why."""
    held = spark.read.parquet(_gated(spark, sf_dir)[1])
    return held.select("ad_account_id", "run_id", "page_no", "reason")


@query(
    "stream_audit",
    f"""
WITH pages AS (SELECT DISTINCT {ACCOUNT_OF_AD} AS ad_account_id, c_custkey // {L.PAGE} + 1 AS page_no FROM customer),
landed AS (SELECT 0 AS batch_id, * FROM pages UNION ALL SELECT 1, * FROM pages WHERE page_no % 2 = 1)
SELECT CAST(batch_id AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS row_count, CAST(min(page_no) AS BIGINT) AS first_page,
       CAST(max(page_no) AS BIGINT) AS last_page, CAST({L.LANDED_EPOCH} + 86400 * batch_id AS BIGINT) AS newest
FROM landed GROUP BY ALL""",
)
def stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All listings land and are upserted as one batch, later every other page again: what each batch carried."""
    landing, checkpoint, records = (scratch_path(spark, name) for name in ("landing", "checkpoint", "audit"))
    target = new_table(spark, T.ADS)
    pages = L.ad_listing(spark, sf_dir)
    later = pages.where("page_no % 2 = 1").withColumn("landed_at", F.col("landed_at") + F.expr("INTERVAL 1 DAY"))
    audit = BatchAudit(
        spark, records, "landed", F.min("page_no").alias("first_page"), F.max("page_no").alias("last_page"),
        F.max(F.unix_seconds("landed_at")).alias("newest"),
    )
    with audit:
        for arriving in (pages, later):
            arriving.write.mode("append").parquet(landing)
            stream = audit.watch(landed_stream(spark, landing, files_per_batch=1_000_000))
            finish(upsert_stream(stream, target, checkpoint), checkpoint=checkpoint)
    return audit.records().drop("stream_id")
