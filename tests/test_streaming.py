import pytest
import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from spendlake.operators.upsert import ParquetTable, upsert
from spendlake.plans.jobs import ARRIVAL, newest_first
from spendlake.plans.spec import TableSpec
from spendlake.sources.pages import LANDED_PAGE, scan_entities
from spendlake.streaming.daily import daily_stream, daily_totals
from spendlake.streaming.finish import LateRows, finish
from spendlake.streaming.runs import TIMED_OUT, track_runs
from spendlake.streaming.upsert import landed_stream, upsert_stream

AT = datetime(2024, 2, 1, tzinfo=timezone.utc)
SPEC = TableSpec.of(
    "ads",
    [("id", "ad_id", "string"), ("name", "name", "string"), ("created_time", "created_time", "timestamp")],
    keys=("ad_account_id", "ad_id"),
    day_of="created_time",
)


def land(spark, where, hour, number, *names):
    data = [{"id": i, "name": n, "created_time": "2024-01-01T00:00:00+0000"} for i, n in names]
    row = ("act_1", "r", number, AT + timedelta(hours=hour), json.dumps({"data": data}))
    spark.createDataFrame([row], LANDED_PAGE).coalesce(1).write.mode("append").parquet(where)


def names(spark, table):
    return {r.ad_id: r["name"] for r in table.read(spark).collect()}


def test_stream_upsert_equals_batch_and_survives_replay(spark, folder):
    landing, table = f"{folder}/landing", ParquetTable(SPEC, f"{folder}/ads")
    land(spark, landing, 0, 1, ("1", "one"), ("2", "two"))
    land(spark, landing, 1, 2, ("2", "zwei"), ("2", "dos"), ("3", "three"))
    upsert_stream(landed_stream(spark, landing, files_per_batch=1), table, f"{folder}/cp").awaitTermination()
    assert names(spark, table) == {"1": "one", "2": "dos", "3": "three"}
    batch = ParquetTable(SPEC, f"{folder}/batch")
    rows = scan_entities(spark.read.schema(LANDED_PAGE).parquet(landing), SPEC, keep=ARRIVAL)
    upsert(rows, batch, newest_first=newest_first())
    assert sorted(map(tuple, batch.read(spark).collect())) == sorted(map(tuple, table.read(spark).collect()))
    before = sorted(map(tuple, table.read(spark).collect()))
    upsert_stream(landed_stream(spark, landing), table, f"{folder}/other-cp").awaitTermination()
    assert sorted(map(tuple, table.read(spark).collect())) == before
    land(spark, landing, 2, 1, ("1", "uno"))
    upsert_stream(landed_stream(spark, landing), table, f"{folder}/cp").awaitTermination()
    assert names(spark, table) == {"1": "uno", "2": "dos", "3": "three"}


DAILY = TableSpec.of(
    "daily",
    [("e", "kind", "string"), ("d", "stat_date", "date"), ("n", "events", "bigint"), ("s", "spend", "double"), ("r", "reach", "bigint")],
    keys=("ad_account_id", "kind", "stat_date"),
    day_of="stat_date",
)


def test_daily_stream_equals_batch(spark, folder):
    events = spark.range(600).select(
        F.lit("act_1").alias("ad_account_id"),
        F.concat(F.lit("k"), (F.col("id") % 3).cast("string")).alias("kind"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 7000).alias("ts"),
        (F.col("id") % 7 * 0.1).alias("value"),
        (F.col("id") % 40).alias("user_id"),
    )
    # Files in order of time, so the lookback of the watermark is not overrun.
    for part in range(3):
        events.where(F.floor(F.col("ts").cast("bigint") % 86400 / 28800) == part).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    table = ParquetTable(DAILY, f"{folder}/daily")
    totals = daily_totals(stream, ("ad_account_id", "kind"), person="user_id", late="60 days", landed="ts")
    finish(daily_stream(totals, table, f"{folder}/cp"))
    got = {(r.kind, r.stat_date): (r.events, r.spend) for r in table.read(spark).collect()}
    want = {(r.kind, r.stat_date): (r.events, r.spend) for r in daily_totals(events, ("ad_account_id", "kind")).collect()}
    assert got == want
    exact = events.groupBy("kind", F.col("ts").cast("date").alias("stat_date")).agg(F.count_distinct("user_id").alias("reach"))
    reach = {(r.kind, r.stat_date): r.reach for r in table.read(spark).collect()}
    assert all(abs(reach[r.kind, r.stat_date] - r.reach) <= 1 for r in exact.collect())


def test_run_tracker(spark, folder):
    def check(run, second, status, error=""):
        return (run, AT + timedelta(seconds=second), status, error)

    schema = "run_id string, observed_at timestamp, async_status string, error string"
    files = [
        [check("done", 0, "Job Running"), check("stuck", 0, "Job Running"), check("error", 0, "Job Completed", "HTTP 500"), check("fail", 5, "Job Failed")],
        [check("done", 15, "Job Completed"), check("error", 15, "Job Skipped"), check("fail", 20, "Job Completed"), check("stuck", 30, "Job Started")],
        [check("late", 10, "Job Running"), check("late", 3700, "Job Completed"), check("young", 3690, "Job Running")],
        [check("clock", 3800, "Job Completed"), check("done", 3800, "Job Completed")],
    ]
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    query = (
        track_runs(stream, late="600 seconds").writeStream.format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    out = spark.read.parquet(f"{folder}/out").select("run_id", "status", (F.unix_seconds("known_at") - int(AT.timestamp())).alias("s"))
    got = {r.run_id: (r.status, r.s) for r in out.collect()}
    assert out.count() == len(got)
    assert got["done"] == ("Job Completed", 15) and got["error"] == ("Job Skipped", 15) and got["fail"] == ("Job Failed", 5)
    assert got["late"] == (TIMED_OUT, 3610) and got["clock"] == ("Job Completed", 3800) and "young" not in got


def test_stuck_run_times_out_once_the_clock_passes(spark, folder):
    schema = "run_id string, observed_at timestamp, async_status string, error string"
    for second, run in ((0, "stuck"), (3700, "other"), (3701, "another")):
        row = (run, AT + timedelta(seconds=second), "Job Running", "")
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    query = (
        track_runs(stream, late="0 seconds").writeStream.format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert [(r.run_id, r.status) for r in spark.read.parquet(f"{folder}/out").collect()] == [("stuck", TIMED_OUT)]


def test_run_with_very_many_checks(spark, folder):
    hot = spark.range(30000).select(
        F.lit("hot").alias("run_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 3000).alias("observed_at"),
        F.when(F.col("id") % 3000 == 2500, "Job Skipped").when(F.col("id") % 3000 > 2600, "Job Completed").otherwise("Job Running").alias("async_status"),
        F.lit("").alias("error"),
    )
    hot.repartition(4).write.parquet(f"{folder}/in")
    query = (
        track_runs(spark.readStream.schema(hot.schema).parquet(f"{folder}/in")).writeStream.format("parquet")
        .option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    row = spark.read.parquet(f"{folder}/out").select("run_id", "status", "checks", F.unix_seconds("known_at").alias("s")).collect()
    assert [tuple(r) for r in row] == [("hot", "Job Skipped", 30000, 1704067200 + 2500)]


CHECK = "run_id string, observed_at timestamp, async_status string, error string"


def _tracked(spark, folder, name, per_trigger, **options):
    stream = spark.readStream.schema(CHECK).option("maxFilesPerTrigger", per_trigger).parquet(f"{folder}/in")
    writer = track_runs(stream, **options).writeStream.format("parquet").option("path", f"{folder}/{name}")
    finish(writer.option("checkpointLocation", f"{folder}/cp-{name}").trigger(availableNow=True).start())
    return sorted((r.run_id, r.status, r.checks) for r in spark.read.parquet(f"{folder}/{name}").collect())


def test_run_tracker_loses_no_check_over_several_batches(spark, folder):
    for run in "abcdef":
        rows = [(run, AT + timedelta(seconds=s), k, "") for s, k in ((0, "Job Started"), (900, "Job Running"), (1800, "Job Completed"))]
        spark.createDataFrame(rows, CHECK).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    at_once = _tracked(spark, folder, "one", 100)
    assert at_once == [(run, "Job Completed", 3) for run in "abcdef"]
    assert _tracked(spark, folder, "many", 1) == at_once
    with pytest.raises(LateRows):
        _tracked(spark, folder, "late", 1, late="0 seconds")


def test_run_tracker_calls_into_python_by_bucket_not_by_run(spark, folder):
    """Runs share buckets, even all of them one: each has the outcome it has alone, and is forgotten after its deadline."""
    first = [(f"r{n}", AT + timedelta(seconds=n % 7), "Job Completed" if n % 3 == 0 else "Job Running", "") for n in range(60)]
    second = [(f"r{n}", AT + timedelta(seconds=60 + n % 7), "Job Failed", "") for n in range(0, 60, 4)]
    clock = [[("clock", AT + timedelta(seconds=s), "Job Running", "")] for s in (4300, 4301)]
    for rows in (first, second, *clock):
        spark.createDataFrame(rows, CHECK).coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def want(n):
        if n % 3 == 0:
            return (f"r{n}", "Job Completed", 1)
        return (f"r{n}", "Job Failed", 2) if n % 4 == 0 else (f"r{n}", TIMED_OUT, 1)

    for buckets in (1, 7, 1024):
        assert _tracked(spark, folder, f"by{buckets}", 1, late="600 seconds", buckets=buckets) == sorted(want(n) for n in range(60))
