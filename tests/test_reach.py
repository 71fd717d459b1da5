"""Sketches of reach against exact counts, merged in any way."""

import random

import pytest
from pyspark.sql import functions as F

from spendlake.operators.reach import merge_reach, reach_of, relative_error, with_sketch

GRAIN = ("campaign", "ad", "day")


@pytest.fixture(scope="module")
def delivery(spark):
    """A third of all rows is one ad's on one day."""
    draw = random.Random(6)
    rows = [(f"c{k % 3}", f"a{k}", draw.randint(1, 9), draw.randint(1, 3000)) for k in range(30) for _ in range(400)]
    rows += [("c0", "a0", 1, draw.randint(1, 20_000)) for _ in range(6000)] + [("c9", "a99", 1, None), ("c1", "a1", None, 5)]
    return spark.createDataFrame(rows, "campaign string, ad string, day int, person_id bigint").repartition(7)


def estimates(df, *grain):
    return {tuple(r[g] for g in grain): r.reach for r in df.withColumn("reach", reach_of()).collect()}


def exact(df, *grain):
    return {tuple(r[g] for g in grain): r.reach for r in df.groupBy(*grain).agg(F.count_distinct("person_id").alias("reach")).collect()}


@pytest.mark.parametrize("grain", [("campaign", "day"), ("campaign",), ("day",)])
def test_merged_sketches_are_close(delivery, grain):
    got = estimates(merge_reach(with_sketch(delivery, GRAIN), grain), *grain)
    want = exact(delivery, *grain)
    assert got.keys() == want.keys() and max(want.values()) > 500
    assert all(abs(got[k] - n) <= 1 + relative_error() * n for k, n in want.items())


def test_merging_in_any_steps_stays_within_the_bound(delivery):
    """Registers are the same however sketches are merged; which of its two estimators a sketch uses is not."""
    facts, want = with_sketch(delivery, GRAIN), exact(delivery, "campaign")
    ways = [facts, merge_reach(facts, ("campaign", "day")), facts.unionByName(facts), with_sketch(delivery, ("campaign",))]
    for way in ways:
        got = estimates(merge_reach(way, ("campaign",)), "campaign")
        assert all(abs(got[k] - n) <= 1 + relative_error(deviations=2.0) * n for k, n in want.items()) and got["c9",] == 0


def test_stored_sketches_need_no_delivery(delivery, folder, spark):
    with_sketch(delivery, GRAIN).write.parquet(f"{folder}/facts")
    merged = merge_reach(spark.read.parquet(f"{folder}/facts"), ("campaign",))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "partial_hll_union_agg" in plan
    assert "ReadSchema: struct<campaign:string,reach_sketch:binary>" in plan


def test_facts_without_sketches(spark, delivery):
    facts = with_sketch(delivery.where("campaign = 'c1'"), GRAIN)
    none = facts.withColumn("reach_sketch", F.lit(None).cast("binary")).withColumn("campaign", F.lit("none"))
    empty = facts.withColumn("reach_sketch", F.lit(b"")).withColumn("campaign", F.lit("empty"))
    got = estimates(merge_reach(facts.unionByName(none).unionByName(empty), ("campaign",)), "campaign")
    assert got["c1",] > 0 and not got["none",] and not got["empty",]
    assert merge_reach(facts.limit(0), ("campaign",)).count() == 0
