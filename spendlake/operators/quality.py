"""Gates before a write, and audits of what a run saw."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.session import scratch_path

class GateClosed(RuntimeError):
    """Something failed before the write, so nothing was written.

    The message has their exact number, the first one's text, and the ``path`` of the table that lists all.
    """

    def __init__(self, message: str, failures: DataFrame, path: str):
        super().__init__(message)
        self.failures, self.path = failures, path


def incomplete_runs(outcomes: DataFrame) -> DataFrame:
    """One row per run that did not complete, with its text for the log."""
    text = F.format_string(
        "%s (run %s): %s", "ad_account_id", "run_id", F.coalesce("final_status", F.lit("None"))
    )
    return outcomes.where(~F.col("completed")).select("ad_account_id", "run_id", "final_status", text.alias("detail"))


def submission_failures(submissions: DataFrame) -> DataFrame:
    """One row per submission without a run, with its text for the log."""
    text = F.concat_ws(": ", "ad_account_id", "failure")
    return submissions.where(F.col("failure") != "").select("ad_account_id", "failure", text.alias("detail"))


def broken_chains(chains: DataFrame, chain: tuple[str, ...] = ("ad_account_id", "run_id")) -> DataFrame:
    """One row per page chain that cannot be trusted."""
    text = F.concat(
        F.concat_ws("/", *chain),
        F.format_string(
            ": %d page(s) numbered %d..%d, %d of them last", "pages", "first_page", "last_page", "end_pages"
        ),
    )
    return chains.where(~F.col("complete")).select(*chain, text.alias("detail"))


def landing_failures(chains: DataFrame, runs: DataFrame) -> DataFrame:
    """One row per run (run_id, ad_account_id) whose pages did not all land: none at all, an error, or a broken chain."""
    own = chains.drop("ad_account_id").withColumnRenamed("run_id", "chain")
    found = runs.select("ad_account_id", "run_id").join(own, F.col("run_id") == F.col("chain"), "left")
    reason = (
        F.when(F.col("chain").isNull(), "no page landed")
        .when(F.col("error_pages") > 0, "a page is an error")
        .otherwise("page chain broken")
    )
    numbers = F.format_string(
        " (%d page(s) numbered %d..%d, %d of them last)", "pages", "first_page", "last_page", "end_pages"
    )
    landed = F.when(F.col("chain").isNotNull(), numbers)
    text = F.concat(F.concat_ws("/", "ad_account_id", "run_id"), F.lit(": "), reason, F.coalesce(landed, F.lit("")))
    failed = found.where(F.col("chain").isNull() | ~F.col("complete"))
    return failed.select("ad_account_id", "run_id", reason.alias("reason"), text.alias("detail"))


def gate(failures: DataFrame, what: str) -> None:
    """Raise when there is any failure, whatever their number.

    All failures are written to a table in the shared folder; the driver holds their count and one text.
    """
    if failures.isEmpty():
        return
    path = scratch_path(failures.sparkSession, "failures")
    failures.write.parquet(path)
    listed = failures.sparkSession.read.schema(failures.schema).parquet(path)
    found = listed.agg(F.count("*").alias("number"), F.min("detail").alias("first")).first()
    raise GateClosed(f"{found.number} {what} -- {found.first}; all of them in {path}", listed, path)


def collate(failures: DataFrame, by: str = "ad_account_id") -> DataFrame:
    """Per account the number of failures and all their texts in order, joined by "; "."""
    texts = F.array_join(F.array_sort(F.collect_list("detail")), "; ")
    return failures.groupBy(by).agg(F.count("*").alias("failures"), texts.alias("detail"))


def run_audit(rows: DataFrame, account: str = "ad_account_id") -> DataFrame:
    """Rows per account."""
    return rows.groupBy(account).agg(F.count("*").alias("row_count"))


def observed(rows: DataFrame, name: str, *metrics: Column) -> DataFrame:
    """Count rows (and any other aggregate) while they pass, without another job."""
    return rows.observe(name, F.count("*").alias("row_count"), *metrics)


def has_null_key(keys: Sequence[str]) -> Column:
    null = F.lit(False)
    for key in keys:
        null = null | F.col(key).isNull()
    return null


def null_key_audit(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in all, rows with a NULL in any key column, and that count per key column."""
    per_key = [F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys]
    return rows.agg(F.count("*").alias("row_count"), F.count_if(has_null_key(keys)).alias("null_key_rows"), *per_key)
