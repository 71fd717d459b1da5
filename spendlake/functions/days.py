"""Days, windows of days and their bounds."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: width of the rolling window when no dates are given.
LOOKBACK_DAYS = 14


def _day(value: date | str) -> date:
    return date.fromisoformat(value) if isinstance(value, str) else value


def date_window(
    as_of: date | str,
    lookback: int = LOOKBACK_DAYS,
    start: date | str | None = None,
    end: date | str | None = None,
) -> tuple[date, date]:
    """First and last day to pull, both inclusive.

    With both dates given they are the window; with neither it is the ``lookback``
    days that end the day before ``as_of``. One date alone is a mistake and raises.
    """
    if (start is None) != (end is None):
        raise ValueError("give both start and end, or neither")
    if start is not None:
        return _day(start), _day(end)
    if lookback < 1:
        raise ValueError(f"lookback must be at least one day, got {lookback}")
    last = _day(as_of) - timedelta(days=1)
    return last - timedelta(days=lookback - 1), last


def utc_instant(day: date | str) -> datetime:
    """Midnight UTC at which the day begins."""
    return datetime.combine(_day(day), datetime.min.time(), timezone.utc)


def day_start_epoch(day: Column) -> Column:
    """Epoch second at which a DATE begins in UTC."""
    return F.unix_date(day).cast("bigint") * F.lit(86_400)


def day_end_epoch(day: Column) -> Column:
    """Last epoch second of a DATE in UTC."""
    return day_start_epoch(day) + F.lit(86_399)


def local_day(instant: Column, zone: Column, *, naive: bool = False) -> Column:
    """Day of an instant in the given time zone, whatever the session's zone.

    ``naive`` tells that the column is TIMESTAMP_NTZ holding UTC wall-clock time;
    otherwise it is a TIMESTAMP.
    """
    if naive:
        return F.convert_timezone(F.lit("UTC"), zone, instant).cast("date")
    return F.convert_timezone(F.current_timezone(), zone, instant.cast("timestamp_ntz")).cast("date")


def as_instant(wall_clock: Column) -> Column:
    """TIMESTAMP of a TIMESTAMP_NTZ that holds UTC wall-clock time, whatever the session's zone."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), wall_clock).cast("timestamp")
