"""Chains of report pages watched while they land: gaps, repeats, error pages, last pages that do not come.

State of a chain is what its pages amount to: the numbers seen as spans without a gap (a list, one entry as long as
nothing is missing) and a few counts. It does not grow with the pages. Timers in event time tell when nothing new has
come for too long, and later when the chain is forgotten.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from spendlake.session import SETTINGS
from spendlake.sources.pages import STRICT
from spendlake.streaming.runs import RUN_DEADLINE_SECONDS

FOUND = (
    "ad_account_id STRING, run_id STRING, pages BIGINT, first_page BIGINT, last_page BIGINT, end_pages BIGINT, error_pages BIGINT, "
    "missing BIGINT, complete BOOLEAN, overdue BOOLEAN, seen_ms BIGINT"
)
_COMBINED = (
    "ad_account_id STRING, run_id STRING, lows ARRAY<BIGINT>, highs ARRAY<BIGINT>, pages BIGINT, ends BIGINT, errors BIGINT, "
    "unnumbered BIGINT, end_at BIGINT, seen_ms BIGINT"
)
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
#: No last page seen yet.
NO_END = -(2**63)


def _functions():
    """What runs on the executors, and before the stream starts in a process beside the driver. Local, so it travels there
    whole and needs no package there."""

    def spans(numbers: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The same numbers as the fewest spans (low, high), in order."""
        out: list[tuple[int, int]] = []
        for low, high in sorted(numbers):
            if out and low <= out[-1][1] + 1:
                out[-1] = (out[-1][0], max(out[-1][1], high))
            else:
                out.append((low, high))
        return out

    class ChainState(StatefulProcessor):
        """Adds what landed to a chain's state and reports the chain, then again when it is overdue."""

        def __init__(self, patience_ms: int, keep_ms: int, first_page: int):
            self.patience_ms, self.keep_ms, self.first_page = patience_ms, keep_ms, first_page

        def init(self, handle) -> None:
            self.handle = handle
            self.spans = handle.getListState("spans", "low LONG, high LONG")
            self.sums = handle.getValueState("sums", "pages LONG, ends LONG, errors LONG, unnumbered LONG, end_at LONG, seen_ms LONG")

        def close(self) -> None:
            pass

        def _timer(self, at_ms: int, timerValues) -> None:
            # One that lies behind the watermark would never fire.
            self.handle.registerTimer(max(at_ms, timerValues.getCurrentWatermarkInMs() + 1))

        def _report(self, key, known: list[tuple[int, int]], sums: tuple, overdue: bool) -> pd.DataFrame:
            pages, ends, errors, unnumbered, end_at, seen_ms = sums
            numbers = sum(high - low + 1 for low, high in known)
            first, last = (known[0][0], known[-1][1]) if known else (None, None)
            complete = len(known) == 1 and first == self.first_page and pages == numbers and not unnumbered and ends == 1 and end_at == last and not errors
            missing = 0 if not known else last - min(first, self.first_page) + 1 - numbers
            row = (*key, pages, first, last, ends, errors, missing, complete, overdue and not complete, seen_ms)
            columns = [c.split()[0] for c in FOUND.split(", ")]
            return pd.DataFrame([row], columns=columns).astype({"first_page": "Int64", "last_page": "Int64"})

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            sums = self.sums.get() if self.sums.exists() else (0, 0, 0, 0, NO_END, 0)
            known = [(int(low), int(high)) for low, high in self.spans.get()] if self.spans.exists() else []
            for part in rows:
                for lows, highs in zip(part["lows"], part["highs"]):
                    known += list(zip(map(int, lows), map(int, highs)))
                added = [int(part[c].sum()) for c in ("pages", "ends", "errors", "unnumbered")]
                sums = (*(int(a) + b for a, b in zip(sums[:4], added)), max(int(sums[4]), int(part["end_at"].max())), max(int(sums[5]), int(part["seen_ms"].max())))
            known = spans(known)
            if known:
                self.spans.put(known)
            self.sums.update(sums)
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self._timer(sums[5] + self.patience_ms, timerValues)
            yield self._report(key, known, sums, False)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            if not self.sums.exists():
                return
            sums = tuple(map(int, self.sums.get()))
            if expiredTimerInfo.getExpiryTimeInMs() >= sums[5] + self.patience_ms + self.keep_ms:
                self.spans.clear()
                self.sums.clear()
                return
            known = [(int(low), int(high)) for low, high in self.spans.get()] if self.spans.exists() else []
            self._timer(sums[5] + self.patience_ms + self.keep_ms, timerValues)
            report = self._report(key, known, sums, True)
            if report["overdue"].iloc[0]:
                yield report

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One row per chain and input batch, so a chain with any number of pages sends few rows to its task."""
        columns = [c.split()[0] for c in _COMBINED.split(", ")]
        for batch in batches:
            out = []
            for key, part in batch.groupby(["ad_account_id", "run_id"], sort=False, dropna=False):
                known = spans([(int(n), int(n)) for n in part["page_no"].dropna().unique()])
                ends = part["page_no"][part["last"]].dropna()
                key = [None if pd.isna(k) else k for k in key]
                out.append((
                    *key, [a for a, _ in known], [b for _, b in known], len(part), int(part["last"].sum()), int(part["failed"].sum()),
                    int(part["page_no"].isna().sum()), int(ends.max()) if len(ends) else NO_END, int(part["at_ms"].max()),
                ))
            yield pd.DataFrame(out, columns=columns)

    return spans, ChainState, combine


spans, ChainState, combine = _functions()


def track_chains(
    pages: DataFrame,
    patience: int = RUN_DEADLINE_SECONDS,
    late: str = f"{RUN_DEADLINE_SECONDS} seconds",
    keep: int = 14 * 86400,
    first_page: int = 1,
) -> DataFrame:
    """One row per chain (account and run) and micro-batch that brought pages of it, the newest of which tells how it stands.

    The counts and ``complete`` mean what they do in ``page_chain_check``; ``missing`` is how many page numbers are known to
    lie between others (or before the first) and have not landed, whether or not a last page has. A chain that is not
    complete ``patience`` seconds of event time (``landed_at``) after its newest page is reported once more as ``overdue``;
    more pages may still mend it. ``keep`` seconds after that it is forgotten, and a page of it would begin a new chain.
    ``late`` is how far a page may lag behind the newest one of the batches before.

    Pages without a number count, and make their chain incomplete. Needs the RocksDB state store,
    with which ``chain_stream`` starts it whatever the session's own.
    """
    envelope = F.from_json("body", "paging STRUCT<next: STRING>, error STRING", STRICT)
    slim = pages.select("ad_account_id", "run_id", "page_no", F.unix_millis("landed_at").alias("at_ms"), envelope.alias("e")).select(
        "ad_account_id", "run_id", "page_no", "at_ms", (F.coalesce("e.paging.next", F.lit("")) == "").alias("last"), F.col("e.error").isNotNull().alias("failed")
    )
    combined = slim.mapInPandas(combine, _COMBINED).withColumn("landed_at", F.timestamp_millis("seen_ms"))
    state = ChainState(patience * 1000, keep * 1000, first_page)
    found = combined.withWatermark("landed_at", late).groupBy("ad_account_id", "run_id").transformWithStateInPandas(state, FOUND, "Update", "EventTime")
    return found.withColumn("seen_at", F.timestamp_millis("seen_ms")).drop("seen_ms")


def chain_stream(found: DataFrame, folder: str, checkpoint: str):
    """Write the reports of ``track_chains`` under the number of their batch; a replayed batch overwrites its own."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch_id={number}")

    writer = found.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    conf = found.sparkSession.conf
    before = conf.get(STATE_STORE, None)
    # A stream keeps the settings it was started with; the session gets its own back.
    conf.set(STATE_STORE, SETTINGS[STATE_STORE])
    try:
        return writer.trigger(availableNow=True).start()
    finally:
        conf.unset(STATE_STORE) if before is None else conf.set(STATE_STORE, before)


def newest_reports(reports: DataFrame) -> DataFrame:
    """How each chain stands: its report of the last batch, the overdue one if the batch has both."""
    rest = [c for c in reports.columns if c not in ("ad_account_id", "run_id", "batch_id")]
    newest = reports.groupBy("ad_account_id", "run_id").agg(F.max_by(F.struct(*rest), F.struct("batch_id", "overdue", "pages")).alias("r"))
    return newest.select("ad_account_id", "run_id", *(F.col(f"r.{c}").alias(c) for c in rest))
