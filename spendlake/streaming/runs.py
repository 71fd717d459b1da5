"""Tracking report runs from a stream of status checks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from spendlake.operators.filters import FINAL_STATUSES, is_final

# Fixed value: seconds a run may take before it counts as stuck.
RUN_DEADLINE_SECONDS = 3600
TIMED_OUT = "Timed Out"

OUTCOME = "run_id STRING, status STRING, checks BIGINT, known_ms BIGINT"
OUTCOME_COLUMNS = ["run_id", "status", "checks", "known_ms"]
# Lists of equal length with an entry for each run of a bucket.
STATE = "run_ids ARRAY<STRING>, first_ms ARRAY<BIGINT>, checks ARRAY<BIGINT>, done ARRAY<BOOLEAN>, timer_ms ARRAY<BIGINT>"
#: Buckets that runs are dealt into by hash. A call into Python takes a bucket, not a run, and rewrites the bucket's state.
BUCKETS = 1024
COMBINED = "run_id STRING, first_ms BIGINT, last_ms BIGINT, checks BIGINT, final_key BIGINT"
NO_FINAL = 2**63 - 1


def track_runs(
    checks: DataFrame, deadline: int = RUN_DEADLINE_SECONDS, late: str | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """One row per run once its fate is known: first final status, or timed out.

    ``checks`` streams (run_id, observed_at, async_status, error). A check that went wrong
    counts as pending. A run still pending ``deadline`` seconds of event time after its first
    check times out, as does one that finished only after that. State is a few values per
    run, whatever the number of its checks, kept by ``buckets`` of runs: one checkpoint, one number of buckets.

    ``late`` says how far a check may lag behind the newest one of the batches before; a run times
    out only when the stream is that much past its deadline. By default it covers the deadline. A
    backlog that is more out of order needs more: ``streaming.finish`` raises if a check came later.
    """
    late = f"{deadline} seconds" if late is None else late
    limit_ms = deadline * 1000
    kinds = len(FINAL_STATUSES)

    # Both functions are local, so they travel to the executors whole and need no package there.
    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One row per run and input batch, so a run with any number of checks sends few rows to its task."""
        for batch in batches:
            yield batch.groupby("run_id", sort=False, as_index=False).agg(
                first_ms=("at_ms", "min"), last_ms=("at_ms", "max"), checks=("at_ms", "size"), final_key=("final_key", "min")
            )

    def follow(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """The runs of a bucket: those checked now are moved on, those that are not and whose time is over leave."""
        now_ms = state.getCurrentWatermarkMs()
        known = {run: kept for run, *kept in zip(*state.get)} if state.exists else {}
        checked: dict[str, tuple[int, int, int]] = {}
        for batch in batches:
            if batch["first_ms"].isna().any():
                raise ValueError("a check has no observed_at")
            for run, first_ms, seen, final_key in zip(*(batch[c].tolist() for c in ("run_id", "first_ms", "checks", "final_key"))):
                first, count, final = checked.get(run, (NO_FINAL, 0, NO_FINAL))
                checked[run] = min(first, first_ms), count + seen, min(final, final_key)
        told = []
        for run in [run for run, (*_, timer_ms) in known.items() if run not in checked and timer_ms < now_ms]:
            first_ms, seen, done, _ = known.pop(run)
            if not done:
                told.append((run, TIMED_OUT, seen, first_ms + limit_ms))
        for run, (new_first_ms, new_checks, final_key) in checked.items():
            first_ms, seen, done, _ = known.get(run, (NO_FINAL, 0, False, 0))
            if not done:
                first_ms, seen = min(first_ms, new_first_ms), seen + new_checks
                if final_key != NO_FINAL:
                    done = True
                    at_ms, kind = divmod(final_key, kinds)
                    status = FINAL_STATUSES[kind]
                    if at_ms > first_ms + limit_ms:
                        at_ms, status = first_ms + limit_ms, TIMED_OUT
                    told.append((run, status, seen, at_ms))
            # A finished run is remembered until its deadline, so repeated checks do not report it again.
            known[run] = first_ms, seen, done, max(first_ms + limit_ms, now_ms + 1)
        if known:
            state.update((list(known), *map(list, zip(*known.values()))))
            state.setTimeoutTimestamp(max(min(timer_ms for *_, timer_ms in known.values()), now_ms + 1))
        elif state.exists:
            state.remove()
        if told:
            yield pd.DataFrame(told, columns=OUTCOME_COLUMNS)

    at_ms = F.unix_millis(F.col("observed_at").cast("timestamp"))
    final_statuses = F.array(*(F.lit(s) for s in FINAL_STATUSES))
    status_no = F.array_position(final_statuses, F.col("async_status")) - 1
    final = (F.coalesce(F.col("error"), F.lit("")) == "") & is_final(F.col("async_status"))
    # Time and status in one number: the smallest is the first final status.
    final_key = F.when(final, at_ms * kinds + status_no).otherwise(F.lit(NO_FINAL))
    slim = checks.select("run_id", at_ms.alias("at_ms"), final_key.alias("final_key"))
    combined = slim.mapInPandas(combine, COMBINED).withColumn("observed_at", F.timestamp_millis("last_ms"))
    combined = combined.withColumn("bucket", F.pmod(F.xxhash64("run_id"), F.lit(buckets)))
    told = (
        combined.withWatermark("observed_at", late)
        .groupBy("bucket")
        .applyInPandasWithState(follow, OUTCOME, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    )
    return told.select("run_id", "status", "checks", F.timestamp_millis("known_ms").alias("known_at"))
