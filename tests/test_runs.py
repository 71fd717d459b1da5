import pytest

from spendlake.operators.quality import GateClosed, broken_chains, collate, gate, incomplete_runs, null_key_audit, observed, run_audit, submission_failures
from spendlake.operators.runs import last_submission, pair_responses, poll_rounds, run_outcomes, run_status, started_runs

DONE, FAILED, SKIPPED, RUNNING = "Job Completed", "Job Failed", "Job Skipped", "Job Running"


def checks(spark, **runs):
    rows = []
    for run, states in runs.items():
        for number, state in enumerate(states, 1):
            rows.append((run, number, None if state == "!" else state, "HTTP 500" if state == "!" else ""))
    return spark.createDataFrame(rows, "run_id string, round int, async_status string, error string")


def test_first_final_status_counts(spark):
    log = checks(
        spark,
        a=[RUNNING, DONE], b=["!", DONE], c=[FAILED], d=[RUNNING, SKIPPED], e=[RUNNING, None, "Job Started"],
        f=[FAILED, DONE], g=[RUNNING, "!"],
    )
    got = {r.run_id: (r.final_status, r.final_round) for r in run_status(log).collect()}
    assert got == {
        "a": (DONE, 2), "b": (DONE, 2), "c": (FAILED, 1), "d": (SKIPPED, 2), "e": (None, None), "f": (FAILED, 1), "g": (None, None),
    }
    rounds = {r["round"]: (r.finished, r.pending) for r in poll_rounds(log).collect()}
    assert rounds == {1: (2, 5), 2: (5, 2), 3: (5, 2)}


def test_final_status_read_with_an_error_does_not_count(spark):
    log = spark.createDataFrame([("a", 1, DONE, "HTTP 500")], "run_id string, round int, async_status string, error string")
    assert run_status(log).first().final_status is None


def test_outcomes_and_gate(spark):
    runs = spark.createDataFrame([("act_1", "a"), ("act_2", "b"), ("act_3", "c")], "ad_account_id string, run_id string")
    outcomes = run_outcomes(runs, run_status(checks(spark, a=[DONE], b=[FAILED])))
    assert {r.run_id: r.completed for r in outcomes.collect()} == {"a": True, "b": False, "c": False}
    with pytest.raises(GateClosed) as closed:
        gate(incomplete_runs(outcomes), "report run(s) did not complete")
    assert str(closed.value) == f"2 report run(s) did not complete -- act_2 (run b): Job Failed; all of them in {closed.value.path}"
    assert closed.value.failures.count() == 2
    gate(incomplete_runs(outcomes.where("completed")), "report run(s) did not complete")


@pytest.mark.parametrize("number", [1, 5000])
def test_gate_lists_all_failures_whatever_their_number(spark, number):
    many = spark.range(number).selectExpr("concat('act_', id) AS ad_account_id", "'x' AS failure")
    with pytest.raises(GateClosed, match=rf"^{number} submission\(s\) -- act_0: x; all of them in ") as closed:
        gate(submission_failures(many), "submission(s)")
    listed = spark.read.parquet(closed.value.path)
    assert closed.value.failures.count() == listed.select("detail").distinct().count() == number


def test_collated_texts(spark):
    rows = spark.createDataFrame([("a", "2"), ("a", "1"), ("b", "3")], "ad_account_id string, detail string")
    assert sorted(tuple(r) for r in collate(rows).collect()) == [("a", 2, "1; 2"), ("b", 1, "3")]


def test_last_submission_per_account(spark):
    log = spark.createDataFrame(
        [("act_1", 1, 200, '{"report_run_id": 5}', ""), ("act_1", 2, 200, '{"report_run_id": 6}', ""), ("act_2", 3, 200, '{"report_run_id": "7"}', "")],
        "ad_account_id string, seq int, code int, body string, error string",
    )
    assert {r.ad_account_id: r.run_id for r in last_submission(started_runs(log)).collect()} == {"act_1": "6", "act_2": "7"}


def test_pairing_by_place(spark):
    requests = spark.createDataFrame([(0, 0, "a"), (0, 1, "b"), (1, 0, "c")], "batch_no int, pos int, ad_account_id string")
    responses = spark.createDataFrame([(0, 1, 400), (0, 0, 200)], "batch_no int, pos int, code int")
    got = {r.ad_account_id: r.code for r in pair_responses(requests, responses).collect()}
    assert got == {"a": 200, "b": 400, "c": None}


def test_audits(spark):
    rows = spark.createDataFrame([("a", None, 1), ("a", "x", 2), ("b", None, None)], "ad_account_id string, market string, n int")
    assert {r.ad_account_id: r.row_count for r in run_audit(rows).collect()} == {"a": 2, "b": 1}
    assert tuple(null_key_audit(rows, ("ad_account_id", "market")).first()) == (3, 2, 0, 2)


def test_observed_counts(spark):
    from pyspark.sql import Observation

    seen = Observation("rows")
    observed(spark.range(10), seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"row_count": 10}


def test_broken_chain_text(spark):
    chains = spark.createDataFrame(
        [("a", "r", 2, 1, 3, 1, False), ("b", "r", 1, 1, 1, 1, True)],
        "ad_account_id string, run_id string, pages long, first_page long, last_page long, end_pages long, complete boolean",
    )
    assert [r.detail for r in broken_chains(chains).collect()] == ["a/r: 2 page(s) numbered 1..3, 1 of them last"]
