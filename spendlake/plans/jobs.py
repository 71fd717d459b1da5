"""The two kinds of run: daily facts of one table, and the three dimension tables together."""

from __future__ import annotations

import logging
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.operators.filters import allow_accounts, in_days, only_accounts, require_rows, unknown_accounts
from spendlake.operators.quality import broken_chains, gate, incomplete_runs, landing_failures, run_audit, submission_failures
from spendlake.operators.runs import last_submission, run_outcomes, run_status, started_runs
from spendlake.operators.upsert import CatalogTable, ParquetTable, latest_per_key, merge_staged, stage, upsert
from spendlake.sources.pages import page_chain_check, scan_entities, scan_report

log = logging.getLogger(__name__)

ARRIVAL = ("page_no", "pos")


def newest_first() -> list[Column]:
    """Order in which the rows of one key are preferred: latest run, then last page, then last place."""
    return [F.col("ingested_at").desc_nulls_last(), *(F.col(c).desc() for c in ARRIVAL)]


def completed_runs(submissions: DataFrame, checks: DataFrame) -> DataFrame:
    """Run per account (run_id, ad_account_id), once every submission started and every run completed."""
    started = started_runs(submissions)
    gate(submission_failures(started), "account(s) without a report run")
    runs = last_submission(started)
    gate(incomplete_runs(run_outcomes(runs, run_status(checks))), "report run(s) did not complete")
    return runs


def fact_rows(
    pages: DataFrame,
    runs: DataFrame,
    table: ParquetTable | CatalogTable,
    window: tuple[date, date] | None = None,
    ingested_at: Column | datetime | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Typed rows of the runs' reports, within the window."""
    instant = {} if ingested_at is None else {"ingested_at": ingested_at}
    rows = scan_report(pages, runs, table.spec, keep=keep, **instant)
    return rows if window is None else in_days(rows, table.spec.day_of, *window)


def run_facts(
    pages: DataFrame,
    submissions: DataFrame,
    checks: DataFrame,
    table: ParquetTable | CatalogTable,
    *,
    window: tuple[date, date] | None = None,
    accounts: str | None = None,
    visible_accounts: DataFrame | None = None,
    ingested_at: Column | datetime | None = None,
    dedupe: bool = False,
    audit: str | None = None,
) -> int:
    """Gate the run, type its landed report pages and upsert them; returns the number of rows.

    Any failed submission, unfinished run, or run whose pages did not all land (none, an error
    among them, a broken chain) raises before the write. Without a single row the table is not
    touched, nor created. With ``visible_accounts`` the wanted accounts are those of them that
    ``accounts`` names (all if it names none): unknown ones are warned of, and none at all raises.
    ``audit`` is a folder for the rows per account.
    """
    if visible_accounts is not None:
        wanted = _wanted(visible_accounts, accounts)
        submissions = submissions.join(wanted, "ad_account_id", "left_semi")
    runs = only_accounts(completed_runs(only_accounts(submissions, accounts), checks), accounts)
    # Only the run's own pages are looked at, and every run has to have landed whole.
    pages = pages.join(runs.select("run_id"), "run_id", "left_semi")
    gate(landing_failures(page_chain_check(pages), runs), "run(s) did not land whole")
    rows = fact_rows(pages, runs, table, window, ingested_at, keep=ARRIVAL if dedupe else ())
    if audit is not None:
        run_audit(rows).write.mode("overwrite").parquet(audit)
    count = upsert(rows, table, newest_first=newest_first() if dedupe else None)
    log.info("%s: %d row(s) from the run", table.spec.name, count)
    return count


def _wanted(visible_accounts: DataFrame, accounts: str | None) -> DataFrame:
    """The visible accounts to pull, each once; warns of those asked for in vain, raises if there are none."""
    # Bounded by the list the caller wrote.
    unknown = [r.ad_account_id for r in unknown_accounts(visible_accounts, accounts).collect()]
    if unknown:
        log.warning("requested account(s) not visible, skipped: %s", unknown)
    wanted = require_rows(allow_accounts(visible_accounts, accounts), "ad accounts to pull")
    return wanted.select("ad_account_id").distinct()


def run_dimensions(
    pages: dict[str, DataFrame],
    tables: dict[str, ParquetTable | CatalogTable],
    visible_accounts: DataFrame,
    *,
    window: tuple[date, date] | None = None,
    accounts: str | None = None,
    ingested_at: Column | datetime | None = None,
    dedupe: bool = False,
) -> list[str]:
    """Type the landed listings of every dimension, then merge each table once; returns those written.

    All listings are read, checked and staged before the first table is touched.
    """
    wanted = _wanted(visible_accounts, accounts)
    instant = {} if ingested_at is None else {"ingested_at": ingested_at}
    staged = []
    for name, table in tables.items():
        own = pages[name].join(wanted, "ad_account_id", "left_semi")
        chains = page_chain_check(own)
        gate(broken_chains(chains), f"page chain(s) of {name} broken")
        silent = wanted.join(chains, "ad_account_id", "left_anti")
        missing = silent.select("ad_account_id", F.concat("ad_account_id", F.lit(": no page landed")).alias("detail"))
        gate(missing, f"account(s) without {name}")
        rows = scan_entities(own, table.spec, window, keep=ARRIVAL if dedupe else (), **instant)
        if dedupe:
            rows = latest_per_key(rows, table.spec.keys, newest_first())
        staged.append((name, stage(rows, table)))
    written = []
    for name, rows in staged:
        if rows.is_empty:
            log.warning("no %s in the window, table untouched", name)
            continue
        merge_staged(rows)
        written.append(name)
    return written
