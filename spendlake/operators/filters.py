"""Row filters: days, created windows, account lists, statuses."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.functions.days import local_day, utc_instant
from spendlake.functions.ids import split_accounts

# Final states of a report run, and states of entities that are gone.
RUN_COMPLETED = "Job Completed"
RUN_FAILED = "Job Failed"
RUN_SKIPPED = "Job Skipped"
FINAL_STATUSES = (RUN_COMPLETED, RUN_FAILED, RUN_SKIPPED)
STALE_STATUSES = ("DELETED", "ARCHIVED")


class NothingToDo(Exception):
    """An input that must not be empty is empty; the run stops before writing."""


def in_days(df: DataFrame, column: str, start: date | str, end: date | str) -> DataFrame:
    """Rows whose day is in the window, both ends included; prunes day partitions."""
    return df.where(F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def with_local_day(
    df: DataFrame, instant: str, zones: DataFrame, account: str = "ad_account_id", day: str = "stat_date"
) -> DataFrame:
    """Add the account-local day of an instant; ``zones`` is (account, time_zone), UTC where unknown."""
    naive = isinstance(df.schema[instant].dataType, T.TimestampNTZType)
    zone = F.coalesce(F.col("time_zone"), F.lit("UTC"))
    return df.join(zones.select(account, "time_zone"), account, "left").withColumn(
        day, local_day(F.col(instant), zone, naive=naive)
    )


def created_between(df: DataFrame, column: str, start: date | str, end: date | str) -> DataFrame:
    """Rows created on the whole UTC days of the window.

    A half-open range on the bare column, so it reaches the scan as a pushed filter.
    """
    begin, after = utc_instant(start), utc_instant(end) + timedelta(days=1)
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        low, high = (F.lit(f"{t:%Y-%m-%d %H:%M:%S}").cast("timestamp_ntz") for t in (begin, after))
    else:
        low, high = F.lit(begin), F.lit(after)
    return df.where((F.col(column) >= low) & (F.col(column) < high))


def requested_accounts(df: DataFrame, csv: str) -> DataFrame:
    """The ids of an allow-list text as rows (request_no, ad_account_id), in written order."""
    one = df.sparkSession.range(1)
    return one.select(F.posexplode(split_accounts(F.lit(csv))).alias("request_no", "ad_account_id"))


def _visible(discovered: DataFrame, requested: DataFrame) -> DataFrame:
    # The list is an argument of the run, so the side broadcast cannot grow with the data.
    hits = discovered.select("ad_account_id").join(F.broadcast(requested), "ad_account_id")
    return hits.dropDuplicates(["request_no", "ad_account_id"])


def allow_accounts(discovered: DataFrame, csv: str | None) -> DataFrame:
    """Accounts to pull: all discovered ones, or those of the allow-list that are visible, as requested."""
    if not csv:
        return discovered.select("ad_account_id")
    found = _visible(discovered, requested_accounts(discovered, csv))
    return found.orderBy("request_no").select("ad_account_id")


def unknown_accounts(discovered: DataFrame, csv: str | None) -> DataFrame:
    """Requested accounts that are not visible; worth a warning, not a failure."""
    requested = requested_accounts(discovered, csv or "")
    found = _visible(discovered, requested).select("request_no")
    return requested.join(F.broadcast(found), "request_no", "left_anti").orderBy("request_no").select("ad_account_id")


def only_accounts(df: DataFrame, csv: str | None) -> DataFrame:
    """Rows of the accounts on an allow-list; no list keeps everything."""
    if not csv:
        return df
    return df.join(F.broadcast(requested_accounts(df, csv).select("ad_account_id")), "ad_account_id", "left_semi")


def is_final(status: Column) -> Column:
    """True for a final run status; a missing one is pending."""
    return F.coalesce(status.isin(*FINAL_STATUSES), F.lit(False))


def drop_stale(df: DataFrame, columns: tuple[str, ...] = ("effective_status", "configured_status")) -> DataFrame:
    """Keep entities that are not deleted or archived; an unknown status is kept."""
    for column in columns:
        df = df.where(~F.coalesce(F.col(column).isin(*STALE_STATUSES), F.lit(False)))
    return df


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Stop the run when there is nothing to work on, leaving every table as it is."""
    if df.isEmpty():
        raise NothingToDo(f"no {what}")
    return df
