"""Running a stream to the end of what has landed, without losing late rows silently."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from spendlake.storage import exists, touch


class LateRows(RuntimeError):
    """Rows came later than the watermark allows and were not counted."""


def dropped(progress: dict) -> int:
    return sum(s.get("numRowsDroppedByWatermark", 0) for s in progress["stateOperators"])


def _mark(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-lost-rows"


def require_whole(spark: SparkSession, checkpoint: str) -> None:
    """Raise ``LateRows`` if a stream on this checkpoint ever dropped a row; its results stay incomplete."""
    if exists(spark, _mark(checkpoint)):
        raise LateRows(f"a stream dropped late rows, marked by {_mark(checkpoint)}; start anew with a larger lateness")


def finish(query: StreamingQuery, poll: float = 0.2, checkpoint: str | None = None) -> None:
    """Wait for the end of a stream; stop it and raise ``LateRows`` as soon as its watermark dropped a row.

    With ``checkpoint`` the loss is written down beside it before raising, and every later call raises, too: the batch that
    lost rows is committed, so the next start would not see it. Streams behind the gate of ``late`` never get there.
    """
    spark = SparkSession.active()
    if checkpoint is not None:
        try:
            require_whole(spark, checkpoint)
        except LateRows:
            query.stop()
            raise
    while True:
        ended = query.awaitTermination(poll)
        late = {p["batchId"]: dropped(p) for p in query.recentProgress if dropped(p)}
        if late:
            if checkpoint is not None:
                touch(spark, _mark(checkpoint))
            query.stop()
            raise LateRows(f"rows behind the watermark, by batch: {late}; the stream needs a larger lateness")
        if ended:
            return
