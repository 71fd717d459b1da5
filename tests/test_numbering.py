"""Numbers without gaps, texts in blocks, exact streamed reach, pages taken once."""

import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from spendlake.operators.numbering import numbered, numbered_within, text_blocks
from spendlake.sources.pages import LANDED_PAGE
from spendlake.streaming.finish import LateRows, finish
from spendlake.streaming.reach import daily_people, people_stream
from spendlake.streaming.replay import pages_once

AT = datetime(2024, 2, 1, tzinfo=timezone.utc)


def land(spark, rows, schema, where):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(where)


def test_numbers_follow_the_order_without_gaps(spark):
    draw = random.Random(3)
    # A third of all rows has one key, some are null, some equal in everything, and a name needs quotes.
    rows = [("hot" if i % 3 == 0 else draw.choice([None, "a", "b", "c"]), draw.randrange(200), i % 50) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v int, `part.of` int")
    got = sorted(numbered(df, ("k", "v"), parts=7).collect(), key=lambda r: r.number)
    assert [r.number for r in got] == list(range(1, 3001))
    assert [(r.k, r.v) for r in got] == sorted(((k, v) for k, v, _ in rows), key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert Counter(tuple(r)[:3] for r in got) == Counter(rows)
    within = numbered_within(df, "k", ("v",), parts=7).collect()
    for key, n in Counter(k for k, _, _ in rows).items():
        own = sorted((r.number, r.v) for r in within if r.k == key)
        assert [x for x, _ in own] == list(range(1, n + 1)) and [v for _, v in own] == sorted(v for _, v in own)


def test_hot_keys_are_spread_and_nothing_is_numbered_in_one_task(spark):
    df = spark.range(4000).select(F.lit("one").alias("k"), F.col("id").cast("string").alias("x"))
    numbers = numbered(df, ("k",), parts=8)
    parts = spark.read.parquet(*numbers.inputFiles()).groupBy("part").count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < 1500
    windows = [line for line in numbers._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window" in line]
    assert all("place" not in line for line in windows)


def test_numbers_of_nothing(spark):
    assert numbered(spark.createDataFrame([], "k string"), ("k",)).count() == 0
    with pytest.raises(ValueError):
        numbered(spark.createDataFrame([], "Number string"), ("Number",))


def test_blocks_hold_all_texts(spark):
    rows = [("act_1", f"t{i:03d}") for i in range(25)] + [("act_2", "t"), ("act_2", "t"), (None, "n"), ("act_3", None)]
    got = {(r.ad_account_id, r.block): (r.failures, r.detail) for r in text_blocks(spark.createDataFrame(rows, "ad_account_id string, detail string"), size=10).collect()}
    texts = [f"t{i:03d}" for i in range(25)]
    assert got == {
        ("act_1", 0): (10, "; ".join(texts[:10])), ("act_1", 1): (10, "; ".join(texts[10:20])), ("act_1", 2): (5, "; ".join(texts[20:])),
        ("act_2", 0): (2, "t; t"), (None, 0): (1, "n"), ("act_3", 0): (1, ""),
    }


EVENT = "kind string, ts timestamp, value double, who bigint"


def reach_of(spark, folder):
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    finish(people_stream(daily_people(stream, ("kind",), "who", late="2 days"), f"{folder}/out", f"{folder}/cp"), checkpoint=f"{folder}/cp")
    return {(r.kind, r.stat_date.day): (r.events, r.spend, r.reach) for r in spark.read.parquet(f"{folder}/out").collect()}


def test_streamed_reach_is_exact_for_closed_days(spark, folder):
    draw = random.Random(5)
    rows = [(draw.choice(["a", "b", None]), AT + timedelta(hours=draw.randrange(24 * 8)), 0.1, draw.choice([None, *range(30)])) for _ in range(900)]
    rows += [("a", AT + timedelta(days=8), 0.1, 1), ("a", None, 0.1, 1)]
    # A day is spread over batches: every batch holds rows up to two days behind the newest one before.
    rows.sort(key=lambda r: (r[1] or AT) + timedelta(hours=draw.randrange(40)))
    for k in range(0, len(rows), 300):
        land(spark, rows[k : k + 300], EVENT, f"{folder}/in")
    got = reach_of(spark, folder)
    want = {}
    for kind, at, _, who in rows:
        if at is not None and at < AT + timedelta(days=6):
            want.setdefault((kind, at.day), []).append(who)
    assert got == {k: (len(v), pytest.approx(0.1 * len(v)), len(set(v) - {None})) for k, v in want.items()}
    # Later runs go on with the same state and repeat no day.
    land(spark, [("a", AT + timedelta(days=9), 0.1, 2)], EVENT, f"{folder}/in")
    again = reach_of(spark, folder)
    assert {k: v for k, v in again.items() if k in got} == got and {d for _, d in again} - {d for _, d in got} == {7}


def page(no, body, hour=0, run="r"):
    return ("act_1", run, no, AT + timedelta(hours=hour), body)


def test_a_page_of_two_files_is_taken_once(spark, folder):
    def run():
        once = pages_once(spark.readStream.schema(LANDED_PAGE).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in"))
        writer = once.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp")
        finish(writer.trigger(availableNow=True).start(), checkpoint=f"{folder}/cp")
        return sorted((r.run_id or "", r.page_no, r.body) for r in spark.read.parquet(f"{folder}/out").collect())

    first = [page(1, "x"), page(2, "y"), page(2, "y"), page(1, "x", run=None)]
    land(spark, first, LANDED_PAGE, f"{folder}/in")
    want = [("", 1, "x"), ("r", 1, "x"), ("r", 2, "y")]
    assert run() == want
    # The same again, another text under the same numbers, and a later read of the first page.
    land(spark, [*first, page(2, "z"), page(1, "x", hour=5)], LANDED_PAGE, f"{folder}/in")
    want = sorted([*want, ("r", 2, "z"), ("r", 1, "x")])
    assert run() == want
    land(spark, [page(9, "w", hour=60)], LANDED_PAGE, f"{folder}/in")
    land(spark, [page(9, "w", hour=60)], LANDED_PAGE, f"{folder}/in")
    assert run() == sorted([*want, ("r", 9, "w")])
    # Too late to be known for a repeat: not taken silently, nor lost silently.
    land(spark, first[:1], LANDED_PAGE, f"{folder}/in")
    for _ in range(2):
        with pytest.raises(LateRows):
            run()
