"""Report runs: submissions, status checks, outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlake.operators.filters import FINAL_STATUSES, RUN_COMPLETED, is_final

NO_RUN_ID = "no report_run_id in response"


def pair_responses(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Requests with their responses, matched by place in the batch."""
    return requests.join(responses, ["batch_no", "pos"], "left")


def started_runs(submissions: DataFrame) -> DataFrame:
    """Submissions (ad_account_id, seq, code, body, error) with ``run_id`` and ``failure``, "" when started."""
    answer = F.variant_get(F.try_parse_json("body"), "$.report_run_id", "variant")
    # As JSON text, the number 0 and the (valid) id "0" can be told apart.
    given = ~F.coalesce(F.to_json(answer), F.lit("null")).isin("null", '""', "0", "false", "[]", "{}")
    run_id = F.when(given, F.get_json_object("body", "$.report_run_id"))
    failure = F.when(F.col("error") != "", F.col("error")).when(~given, F.lit(NO_RUN_ID)).otherwise(F.lit(""))
    return submissions.withColumns({"run_id": run_id, "failure": failure})


def last_submission(submissions: DataFrame) -> DataFrame:
    """The run that counts per account: the one submitted last."""
    return submissions.groupBy("ad_account_id").agg(F.max_by("run_id", "seq").alias("run_id"))


def run_status(checks: DataFrame) -> DataFrame:
    """First final status per run, NULL while pending.

    ``checks`` is the status log (run_id, round, async_status, error). A check that went
    wrong tells nothing about its run, and nothing after the first final status counts.
    """
    readable = F.coalesce(F.col("error"), F.lit("")) == ""
    # Round and status in one number, so the minimum is kept in a fixed-width hash aggregate:
    # a minimum over a struct would sort every row of the log before the shuffle.
    final_statuses = F.array(*(F.lit(s) for s in FINAL_STATUSES))
    status_no = F.array_position(final_statuses, F.col("async_status")) - 1
    key = F.col("round").cast("bigint") * len(FINAL_STATUSES) + status_no
    first = checks.groupBy("run_id").agg(
        F.min(F.when(readable & is_final(F.col("async_status")), key)).alias("first"), F.max("round").alias("last_round")
    )
    round_type = checks.schema["round"].dataType
    return first.select(
        "run_id",
        F.get(final_statuses, F.pmod(F.col("first"), F.lit(len(FINAL_STATUSES))).cast("int")).alias("final_status"),
        F.call_function("div", "first", F.lit(len(FINAL_STATUSES))).cast(round_type).alias("final_round"),
        "last_round",
    )


def run_outcomes(runs: DataFrame, statuses: DataFrame) -> DataFrame:
    """Every submitted run with its final status; a run without one has not completed."""
    joined = runs.select("ad_account_id", "run_id").join(statuses.select("run_id", "final_status"), "run_id", "left")
    completed = F.coalesce(F.col("final_status") == RUN_COMPLETED, F.lit(False))
    return joined.select("ad_account_id", "run_id", "final_status", completed.alias("completed"))


def failed_submissions(submissions: DataFrame) -> DataFrame:
    """Submissions that started no run, with the reason."""
    return started_runs(submissions).where(F.col("failure") != "")


def poll_rounds(checks: DataFrame) -> DataFrame:
    """Per polling round: runs finished so far and runs still pending.

    The log is first cut to one row per round, and the polling deadline bounds the number
    of rounds, so the running sum over all of them is small however many runs there are.
    """
    endings = run_status(checks).groupBy(F.col("final_round").alias("round")).agg(F.count("*").alias("runs"))
    polled = checks.select("round").distinct().select("round", F.lit(0).cast("bigint").alias("runs"))
    per_round = endings.unionByName(polled).groupBy("round").agg(F.sum("runs").alias("runs"))
    so_far = Window.orderBy(F.col("round").asc_nulls_last())
    finished = F.sum("runs").over(so_far)
    pending = F.sum("runs").over(Window.partitionBy()) - finished
    counted = per_round.select("round", finished.alias("finished"), pending.alias("pending"))
    return counted.where(F.col("round").isNotNull())
