"""Late rows, page chains and gated ingest on streams: nothing lost, in any order, on any retry."""

import json
import os
import random
import subprocess
import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from spendlake.operators.upsert import ParquetTable
from spendlake.plans.spec import TableSpec
from spendlake.sources.pages import LANDED_PAGE, page_chain_check
from spendlake.streaming import late
from spendlake.streaming.chains import chain_stream, newest_reports, spans, track_chains
from spendlake.streaming.finish import LateRows, finish
from spendlake.streaming.gated import ERROR_PAGE, NO_OUTCOME, gated_stream, with_outcomes
from spendlake.streaming.runs import track_runs

REPO = Path(__file__).resolve().parents[1]
AT = datetime(2024, 2, 1, tzinfo=timezone.utc)
CHECK = "run_id string, observed_at timestamp, async_status string, error string"


def land(spark, rows, schema, where):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(where)


def checks(*rows):
    return [(run, None if s is None else AT + timedelta(seconds=s), status, "") for run, s, status in rows]


def track(spark, folder):
    """The tracker behind the gate, as a user runs it: land, accept, track."""
    stream = spark.readStream.schema(CHECK).parquet(f"{folder}/in")
    finish(late.accept(stream, "observed_at", "600 seconds", f"{folder}/gate", f"{folder}/cp-gate"))
    schema = spark.read.schema(CHECK).parquet(f"{folder}/in").schema
    writer = track_runs(late.accepted(spark, f"{folder}/gate", schema), late="600 seconds").writeStream.format("parquet")
    finish(writer.option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start(), checkpoint=f"{folder}/cp")
    return sorted((r.run_id, r.status) for r in spark.read.parquet(f"{folder}/out").collect())


def test_late_rows_block_every_start_until_settled(spark, folder):
    land(spark, checks(("a", 0, "Job Running"), ("a", 2000, "Job Completed")), CHECK, f"{folder}/in")
    assert track(spark, folder) == [("a", "Job Completed")]
    land(spark, checks(("b", 100, "Job Completed"), ("c", 1900, "Job Completed"), ("d", None, "Job Completed"), ("e", 1400, "Job Failed")), CHECK, f"{folder}/in")
    for _ in range(3):
        with pytest.raises(LateRows):
            track(spark, folder)
    schema = spark.read.parquet(f"{folder}/in").schema
    kept = late.late_rows(spark, f"{folder}/gate", schema)
    # 1400 is exactly the lateness behind 2000.
    assert sorted((r.run_id, r.batch_id) for r in kept.collect()) == [("b", 1), ("d", 1), ("e", 1)]
    assert late.settle(spark, f"{folder}/gate", "looked up by hand") == 1 and late.settle(spark, f"{folder}/gate", "again") == 0
    assert track(spark, folder) == [("a", "Job Completed"), ("c", "Job Completed")]
    assert late.late_rows(spark, f"{folder}/gate", schema).count() == 0
    land(spark, checks(("f", 1000, "Job Completed")), CHECK, f"{folder}/in")
    with pytest.raises(LateRows):
        track(spark, folder)


def test_a_replayed_batch_is_split_alike(spark, folder):
    """The gate's checkpoint lost after its first batch was written: the same folders, nothing twice."""
    land(spark, checks(("a", 0, "x"), ("a", 50, "y")), CHECK, f"{folder}/in")
    stream = spark.readStream.schema(CHECK).parquet(f"{folder}/in")
    for checkpoint in ("one", "two"):
        finish(late.accept(stream, "observed_at", "10 seconds", f"{folder}/gate", f"{folder}/{checkpoint}"))
    assert spark.read.parquet(f"{folder}/gate/accepted").count() == 2
    late.require_settled(spark, f"{folder}/gate")


def test_dropped_rows_raise_on_every_retry(spark, folder):
    """Without the gate: what a watermark dropped is remembered beside the checkpoint."""
    for second, run in ((0, "a"), (9000, "a"), (9001, "a"), (100, "b")):
        land(spark, checks((run, second, "Job Completed")), CHECK, f"{folder}/in")
    for _ in range(3):
        stream = spark.readStream.schema(CHECK).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        writer = track_runs(stream, late="0 seconds").writeStream.format("parquet").option("path", f"{folder}/out")
        with pytest.raises(LateRows):
            finish(writer.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start(), checkpoint=f"{folder}/cp")


def page(account, run, number, following="https://next", error=False, hour=0):
    body = {"error": {"code": 1}} if error else {"data": [{"id": f"{run}-{number}", "name": "n", "created_time": "2024-01-01T00:00:00+0000"}], "paging": {"next": following}}
    return (account, run, number, AT + timedelta(hours=hour), json.dumps(body))


def test_chains_in_any_order_equal_the_batch_check(spark, folder):
    whole = [page("a", "r", n, None if n == 7 else "x") for n in range(1, 8)]
    gap = [page("a", "gap", n, "" if n == 5 else "x") for n in (1, 2, 4, 5)]
    rows = [*whole, *gap, page("b", "r", 1, ""), page("b", "twice", 1, ""), page("b", "twice", 1, ""), page("c", "zero", 2, ""), page("c", "open", 1), page("c", "open", 2)]
    rows += [page("d", "error", 1), page("d", "error", 2, error=True), page("d", "ends", 1, ""), page("d", "ends", 2, ""), page(None, None, 1, ""), page("e", "unnumbered", None, ""), page("e", "unnumbered", 1, "")]
    random.Random(2).shuffle(rows)
    for k in range(5):
        land(spark, rows[k::5], LANDED_PAGE, f"{folder}/in")
    land(spark, [page("z", "clock", 1, "", hour=9)], LANDED_PAGE, f"{folder}/in")
    land(spark, [page("z", "clock", 2, "", hour=9)], LANDED_PAGE, f"{folder}/in")
    stream = spark.readStream.schema(LANDED_PAGE).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    finish(chain_stream(track_chains(stream), f"{folder}/out", f"{folder}/cp"), checkpoint=f"{folder}/cp")
    reports = spark.read.parquet(f"{folder}/out")
    got = newest_reports(reports)
    want = page_chain_check(spark.read.schema(LANDED_PAGE).parquet(f"{folder}/in"))
    assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
    state = {(r.ad_account_id, r.run_id): r for r in got.collect()}
    assert state["a", "gap"].missing == 1 and state["c", "zero"].missing == 1 and state["a", "r"].missing == 0
    assert {k for k, r in state.items() if r.overdue} == {k for k, r in state.items() if not r.complete and k[0] != "z"}
    assert reports.where("run_id = 'r' and ad_account_id = 'a' and not complete").count() > 0


def test_a_late_page_mends_an_overdue_chain(spark, folder):
    for rows in ([page("a", "r", 1)], [page("z", "c", 1, hour=3)], [page("z", "c", 2, hour=3)], [page("a", "r", 2, "", hour=3)], [page("z", "c", 3, "", hour=6)]):
        land(spark, rows, LANDED_PAGE, f"{folder}/in")
    stream = spark.readStream.schema(LANDED_PAGE).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    finish(chain_stream(track_chains(stream, patience=1800, late="60 seconds"), f"{folder}/out", f"{folder}/cp"))
    reports = spark.read.parquet(f"{folder}/out").where("run_id = 'r'")
    assert reports.where("overdue").count() == 1
    assert newest_reports(reports).select("pages", "complete", "overdue").collect() == [(2, True, False)]


def test_chains_need_neither_the_package_on_workers_nor_a_state_store_setting(tmp_path):
    """A session of its own, started elsewhere, with Spark's default state store: workers cannot import the package."""
    script = tmp_path / "run.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
import __spark_entry__ as driver
print("rows", driver.queries()["stream_chain_check"](spark, "/root/testdata/sf0.001").count())
print("store", spark.conf.get("spark.sql.streaming.stateStore.providerClass", "none").split(".")[-1])
""")
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300)
    assert "rows 5" in done.stdout and "store none" in done.stdout, done.stderr[-3000:]


def test_spans():
    draw = random.Random(3)
    for _ in range(200):
        numbers = [draw.randint(-5, 30) for _ in range(draw.randint(0, 25))]
        got = spans([(n, n) for n in numbers])
        assert [n for low, high in got for n in range(low, high + 1)] == sorted(set(numbers))
        assert all(b[0] > a[1] + 1 for a, b in zip(got, got[1:]))


ADS = TableSpec.of("ads", [("id", "ad_id", "string"), ("name", "name", "string"), ("created_time", "created_time", "timestamp")], keys=("ad_account_id", "ad_id"), day_of="created_time")


def test_only_completed_runs_get_in(spark, folder):
    outcome = "run_id string, status string, known_at timestamp"
    at = lambda hour, minute=0: AT + timedelta(hours=hour, minutes=minute)
    pages = [
        [page("a", "good", 1), page("a", "good", 2, ""), page("a", "bad", 1, ""), page("a", "never", 1, ""), page("a", "early", 1, ""), page("a", "error", 1, error=True)],
        [page("a", "after", 1, "", hour=1), page("a", "good", 3, "", hour=1)],
        [page("a", "next", 1, "", hour=8), page("a", None, 1, "", hour=8)],
        [page("a", "open", 1, "", hour=16)],
    ]
    outcomes = [
        [("good", "Job Completed", at(0, 20)), ("bad", "Job Failed", at(0, 5)), ("early", "Job Completed", at(-3)), ("error", "Job Completed", at(0))],
        [("after", "Job Completed", at(1, 30)), ("never", "Job Completed", at(5))],
        [("next", "Job Skipped", at(8))],
        [("none", "Job Completed", at(16))],
    ]
    table = ParquetTable(ADS, f"{folder}/ads")
    for p, o in zip(pages, outcomes):
        land(spark, p, LANDED_PAGE, f"{folder}/pages")
        land(spark, o, outcome, f"{folder}/outcomes")
        left = spark.readStream.schema(LANDED_PAGE).parquet(f"{folder}/pages")
        right = spark.readStream.schema(outcome).parquet(f"{folder}/outcomes")
        finish(gated_stream(with_outcomes(left, right), table, f"{folder}/held", f"{folder}/cp"), checkpoint=f"{folder}/cp")
    got = sorted(r.ad_id for r in table.read(spark).collect())
    assert got == ["after-1", "good-1", "good-2", "good-3"]
    held = sorted((str(r.run_id), r.page_no, r.reason) for r in spark.read.parquet(f"{folder}/held").collect())
    want = [("None", 1, NO_OUTCOME), ("bad", 1, "Job Failed"), ("early", 1, NO_OUTCOME), ("error", 1, ERROR_PAGE), ("never", 1, NO_OUTCOME), ("next", 1, "Job Skipped")]
    assert held == sorted(want)
