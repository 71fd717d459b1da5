"""Upserts into bucketed tables: right rows, untouched days untouched, nothing shuffled but the source."""

from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from spendlake.operators.bucketed import BucketedTable, _save, merged, upsert_bucketed
from spendlake.operators.upsert import DuplicateKeys
from spendlake.plans.spec import TableSpec

FACT = TableSpec.of(
    "bucketed_fact",
    [("ad_id", "ad_id", "string"), ("day", "stat_date", "date"), ("spend", "spend", "double")],
    keys=("ad_account_id", "ad_id", "stat_date"),
    day_of="stat_date",
)
D = [date(2024, 1, d) for d in range(1, 6)]
T1, T2 = (datetime(2024, 2, d, tzinfo=timezone.utc) for d in (1, 2))


@pytest.fixture
def fact(spark, folder, request):
    table = BucketedTable(FACT, f"fact_{request.node.name}", f"{folder}/fact", 3)
    yield table
    spark.sql(f"DROP TABLE IF EXISTS {table.name}")


def facts(spark, at, *rows):
    df = spark.createDataFrame([("act_1", *r) for r in rows], "ad_account_id string, ad_id string, stat_date date, spend double")
    return df.withColumn("ingested_at", F.lit(at))


def content(table, spark):
    return sorted((tuple(r) for r in table.read(spark).select("ad_id", "stat_date", "spend").collect()), key=repr)


def files(table):
    return {str(p) for p in Path(table.root).rglob("*.parquet")}


def test_replace_add_keep(spark, fact):
    assert upsert_bucketed(facts(spark, T1, ("a", D[0], 1.0), ("b", D[0], 2.0), ("a", D[1], 3.0), ("c", D[2], 4.0)), fact) == 4
    before = files(fact)
    assert upsert_bucketed(facts(spark, T2, ("a", D[0], None), ("new", D[1], 5.0), ("late", D[4], 6.0)), fact) == 3
    want = [("a", D[0], None), ("b", D[0], 2.0), ("a", D[1], 3.0), ("new", D[1], 5.0), ("c", D[2], 4.0), ("late", D[4], 6.0)]
    assert content(fact, spark) == sorted(want, key=repr)
    assert fact.read(spark).columns == FACT.columns
    untouched = {f for f in before if f"stat_date_part={D[2]}" in f}
    assert untouched and untouched <= files(fact)
    at = {(r.ad_id, r.stat_date): r.ingested_at for r in fact.read(spark).collect()}
    assert at["b", D[0]] < at["a", D[0]] == at["new", D[1]]


def test_the_target_is_not_shuffled(spark, fact, folder):
    rows = [(f"ad{i}", D[i % 4], float(i)) for i in range(200)]
    upsert_bucketed(facts(spark, T1, *rows), fact)
    _save(facts(spark, T2, *rows[:50]), fact, "staged_for_the_plan", f"{folder}/staged", partitioned=False)
    try:
        df = merged(spark, fact, "staged_for_the_plan", D[:2])
        # The optimiser would broadcast sides this small; at scale it sorts and merges.
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = df._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "SelectedBucketsCount: 3 out of 3" in plan
        assert "PartitionFilters: [stat_date_part" in plan
    finally:
        spark.sql("DROP TABLE staged_for_the_plan")


def test_repeats_raise_or_are_chosen_among_and_nothing_is_left(spark, fact):
    upsert_bucketed(facts(spark, T1, ("a", D[0], 1.0)), fact)
    twice = facts(spark, T2, ("a", D[0], 2.0), ("a", D[0], 3.0), ("b", D[1], 1.0))
    with pytest.raises(DuplicateKeys, match="1 key"):
        upsert_bucketed(twice, fact)
    assert content(fact, spark) == [("a", D[0], 1.0)]
    upsert_bucketed(twice, fact, newest_first=[F.col("spend").desc()])
    assert content(fact, spark) == [("a", D[0], 3.0), ("b", D[1], 1.0)]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("staged_")]


def test_null_keys_are_added_and_again(spark, fact):
    rows = facts(spark, T1, (None, D[0], 1.0), (None, D[0], 1.0), ("a", None, 2.0))
    for _ in range(2):
        assert upsert_bucketed(rows, fact) == 3
    assert content(fact, spark) == sorted([(None, D[0], 1.0)] * 4 + [("a", None, 2.0)] * 2, key=repr)


def test_empty_source_and_wrong_table(spark, fact, folder):
    assert upsert_bucketed(facts(spark, T1, ("a", D[0], 1.0)).limit(0), fact) == 0 and not fact.exists(spark)
    with pytest.raises(ValueError, match="day has to be in the key"):
        BucketedTable(TableSpec.of("t", [("d", "d", "date")], keys=("ad_account_id",), day_of="d"), "t", folder, 2)
