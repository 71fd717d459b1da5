from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from spendlake.functions.days import date_window, day_end_epoch, day_start_epoch
from spendlake.operators.enrich import never_seen, with_dimension
from spendlake.operators.filters import (
    NothingToDo,
    allow_accounts,
    created_between,
    drop_stale,
    in_days,
    only_accounts,
    require_rows,
    unknown_accounts,
    with_local_day,
)


def test_default_window():
    assert date_window("2024-01-31") == (date(2024, 1, 17), date(2024, 1, 30))
    assert date_window(date(2024, 1, 31), lookback=1) == (date(2024, 1, 30), date(2024, 1, 30))


def test_given_window_is_taken_as_is():
    assert date_window("2024-01-31", lookback=3, start="2023-05-01", end="2023-04-01") == (date(2023, 5, 1), date(2023, 4, 1))


@pytest.mark.parametrize("options", [{"start": "2024-01-01"}, {"end": "2024-01-01"}, {"lookback": 0}])
def test_bad_window(options):
    with pytest.raises(ValueError):
        date_window("2024-01-31", **options)


def test_in_days_is_inclusive(spark):
    days = spark.createDataFrame([(date(2024, 1, d),) for d in range(1, 6)], "d date")
    assert [r.d.day for r in in_days(days, "d", "2024-01-02", "2024-01-04").orderBy("d").collect()] == [2, 3, 4]


def accounts(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "ad_account_id string")


def listed(df):
    return [r.ad_account_id for r in df.collect()]


def test_allow_list(spark):
    found = accounts(spark, "act_34", "act_12", "act_56")
    assert listed(allow_accounts(found, " 12, act_34 ,,99")) == ["act_12", "act_34"]
    assert listed(unknown_accounts(found, " 12, act_34 ,,99")) == ["act_99"]
    assert listed(allow_accounts(found, "\t34\n,12, 34")) == ["act_34", "act_12", "act_34"]


def test_no_allow_list_takes_all(spark):
    found = accounts(spark, "act_34", "act_12")
    assert sorted(listed(allow_accounts(found, None))) == sorted(listed(allow_accounts(found, ""))) == ["act_12", "act_34"]
    assert listed(unknown_accounts(found, None)) == []
    assert listed(allow_accounts(found, " , ")) == []


def test_only_accounts(spark):
    rows = accounts(spark, "act_1", "act_2", "act_1")
    assert only_accounts(rows, "1").count() == 2 and only_accounts(rows, None).count() == 3


def test_created_window_bounds(spark):
    start = datetime(2024, 1, 5, tzinfo=timezone.utc)
    end = datetime(2024, 1, 6, 23, 59, 59, tzinfo=timezone.utc)
    second, half = timedelta(seconds=1), timedelta(milliseconds=500)
    times = [start, end, start - second, end + second, start - half, end + half]
    rows = spark.createDataFrame(list(enumerate(times)), "no int, t timestamp")
    assert sorted(r.no for r in created_between(rows, "t", "2024-01-05", "2024-01-06").collect()) == [0, 1, 5]
    naive = rows.withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert sorted(r.no for r in created_between(naive, "t", "2024-01-05", "2024-01-06").collect()) == [0, 1, 5]


def test_day_epochs(spark):
    row = spark.range(1).select(F.lit("2024-01-05").cast("date").alias("d")).select(day_start_epoch(F.col("d")), day_end_epoch(F.col("d"))).first()
    assert tuple(row) == (1704412800, 1704499199)


@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Tokyo"])
def test_local_day(spark, session_zone):
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        rows = spark.createDataFrame([("a", 1704078000), ("b", 1704078000), ("c", 1704078000)], "ad_account_id string, s bigint")
        rows = rows.withColumn("at", F.timestamp_seconds("s"))
        zones = spark.createDataFrame([("a", "America/Los_Angeles"), ("b", "Asia/Tokyo")], "ad_account_id string, time_zone string")
        days = {r.ad_account_id: str(r.stat_date) for r in with_local_day(rows, "at", zones).collect()}
        assert days == {"a": "2023-12-31", "b": "2024-01-01", "c": "2024-01-01"}
        naive = rows.withColumn("at", F.lit("2024-01-01 03:00:00").cast("timestamp_ntz"))
        days = {r.ad_account_id: str(r.stat_date) for r in with_local_day(naive, "at", zones).collect()}
        assert days == {"a": "2023-12-31", "b": "2024-01-01", "c": "2024-01-01"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_stale_entities(spark):
    rows = spark.createDataFrame(
        [(1, "ACTIVE", None), (2, "DELETED", None), (3, None, "ARCHIVED"), (4, None, None), (5, "PAUSED", "ACTIVE")],
        "id int, effective_status string, configured_status string",
    )
    assert sorted(r.id for r in drop_stale(rows).collect()) == [1, 4, 5]


def test_empty_guard(spark):
    with pytest.raises(NothingToDo, match="no accounts"):
        require_rows(spark.range(0), "accounts")
    assert require_rows(spark.range(1), "accounts").count() == 1


def test_dimension_joins(spark):
    facts = spark.createDataFrame([("a", "1", 5), ("a", "2", 6), ("a", "2", 7)], "ad_account_id string, ad_id string, n int")
    dims = spark.createDataFrame([("a", "1", "one"), ("b", "2", "other")], "ad_account_id string, ad_id string, name string")
    on = ("ad_account_id", "ad_id")
    joined = with_dimension(facts, dims, on, {"name": "ad_name"}).orderBy("n").collect()
    assert [r.ad_name for r in joined] == ["one", None, None]
    assert [tuple(r) for r in never_seen(facts, dims, on).collect()] == [("a", "2")]
