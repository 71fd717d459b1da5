"""Plans are part of the contract: no Python in the path, filters pushed, ranks cut before the shuffle."""

import pytest
from pyspark.sql import functions as F

from spendlake.operators.filters import created_between, in_days
from spendlake.operators.upsert import latest_per_key
from spendlake.queries import registry
from spendlake.queries.base import table

SF = "/root/testdata/sf0.001"
WRITES = {
    "upsert_facts", "upsert_twice", "upsert_dims", "upsert_dims_moved", "replace_table", "run_facts", "run_dimensions",
    "stream_upsert", "stream_daily", "stream_daily_reach", "run_tracker", "scan_pages", "scan_ads",
    "scan_report_ad", "scan_report_ad_market", "scan_report_ad_age_gender", "scan_report_ad_set", "scan_report_campaign",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry()) - WRITES))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(registry()[name].run(spark, SF))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, text


def test_created_window_reaches_the_scan(spark):
    text = plan(created_between(table(spark, SF, "events"), "ts", "2024-01-05", "2024-01-06").select("event_id"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_day_window_reaches_the_scan(spark, folder):
    days = spark.range(5).select("id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    days.write.partitionBy("d").parquet(f"{folder}/t")
    text = plan(in_days(spark.read.parquet(f"{folder}/t"), "d", "2024-01-02", "2024-01-03"))
    assert "PartitionFilters: [isnotnull(d" in text


def test_dedupe_ranks_before_the_shuffle(spark):
    rows = table(spark, SF, "lineitem")
    text = plan(latest_per_key(rows, ("l_orderkey", "l_linenumber"), [F.col("l_shipdate").desc()]))
    assert text.count("WindowGroupLimit") == 2


def test_report_aggregates_before_the_shuffle_and_reads_only_its_columns(spark):
    text = plan(registry()["report_ad_day"].run(spark, SF))
    assert "partial_sum" in text and "l_tax" not in text and "o_totalprice" not in text


def test_upsert_compares_by_key_columns_of_touched_days(spark, folder):
    """What decides which rows stay reads neither the other columns nor the other days."""
    from datetime import date

    from spendlake.operators.upsert import ParquetTable, _in, _unmatched, upsert
    from spendlake.plans.tables import AD_DAILY

    days = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int"))
    rows = spark.range(50).select(
        F.lit("act_1").alias("ad_account_id"), F.col("id").cast("string").alias("ad_id"), days.alias("stat_date"),
        F.lit("x" * 50).alias("actions_json"), F.current_timestamp().alias("ingested_at"),
    )
    target = ParquetTable(AD_DAILY, f"{folder}/ads")
    upsert(rows, target)
    files = target.load(spark, target.path(1)).where(_in("stat_date", [date(2024, 1, 2)]))
    text = plan(_unmatched(files.select(*AD_DAILY.keys), rows.select(*AD_DAILY.keys), AD_DAILY.keys, False))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "= 2024-01-02)], PushedFilters" in scan and "ReadSchema: struct<ad_account_id:string,ad_id:string>" in scan


def test_a_hot_day_is_written_by_several_tasks(spark, folder):
    from spendlake.operators.upsert import ParquetTable, upsert
    from spendlake.plans.tables import AD_DAILY

    hot = F.when(F.col("id") % 10 > 0, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02")).cast("date")
    rows = spark.range(60000).select(
        F.lit("act_1").alias("ad_account_id"), F.col("id").cast("string").alias("ad_id"), hot.alias("stat_date"),
        F.sha2(F.col("id").cast("string"), 512).alias("actions_json"), F.current_timestamp().alias("ingested_at"),
    ).repartition(16)
    target = ParquetTable(AD_DAILY, f"{folder}/ads")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "1MB")
    try:
        upsert(rows, target)
    finally:
        spark.conf.set(size, before)
    files = target.load(spark, target.path(1)).select("stat_date", F.input_file_name().alias("f"))
    per_day = {str(r.stat_date): r.n for r in files.groupBy("stat_date").agg(F.count_distinct("f").alias("n")).collect()}
    assert per_day["2024-01-01"] > 3 and per_day["2024-01-02"] <= 3
