"""Audit of streams: what each micro-batch carried, observed while its rows pass and recorded by a listener.

No second job reads the rows. A record is a folder of its own per stream and batch, written over as a whole, so a batch
that is replayed has one record. The stream is known by the id in its checkpoint, the same after every restart.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.window import Window

from spendlake.operators.quality import observed
from spendlake.storage import exists


class AuditFailed(RuntimeError):
    """A batch was not recorded."""


class BatchAudit(StreamingQueryListener):
    """Records the rows, and any other aggregates, of every micro-batch of the streams that ``watch`` made.

        audit = BatchAudit(spark, path, "landed", F.max("page_no").alias("last_page"))
        with audit:
            finish(upsert_stream(audit.watch(pages), table, checkpoint))
        audit.records()

    ``metrics`` are aliased aggregates (not distinct ones) that give numbers or text. Leaving the block waits until all
    batches of the streams that ended within it are recorded, and raises ``AuditFailed`` if one could not be. The
    rows must pass once: a sink that computes its batch several times is counted as often.
    """

    def __init__(self, spark: SparkSession, path: str, name: str, *metrics: Column, wait: float = 60.0):
        self.spark, self.path, self.name, self.metrics, self.wait = spark, path.rstrip("/"), name, metrics, wait
        self._fields: list[T.StructField] | None = None
        self._started: set[str] = set()
        self._ended: set[str] = set()
        self._errors: list[str] = []

    def watch(self, rows: DataFrame) -> DataFrame:
        """The stream with its rows observed."""
        self._fields = rows.agg(F.count("*").alias("row_count"), *self.metrics).schema.fields
        return observed(rows, self.name, *self.metrics)

    def records(self) -> DataFrame:
        """One row per stream and batch: stream_id, batch_id, row_count and the metrics."""
        schema = T.StructType(list(self._fields)).add("stream_id", T.StringType()).add("batch_id", T.LongType())
        if exists(self.spark, self.path):
            rows = self.spark.read.schema(schema).parquet(self.path)
        else:
            rows = self.spark.createDataFrame([], schema)
        return rows.select("stream_id", "batch_id", *(f.name for f in self._fields))

    def unrecorded(self) -> DataFrame:
        """Ranges of batches without a record before a recorded one: the driver was lost after they were committed."""
        before = F.coalesce(F.lag("batch_id").over(Window.partitionBy("stream_id").orderBy("batch_id")), F.lit(-1))
        gaps = self.records().select("stream_id", (before + 1).alias("first_batch"), (F.col("batch_id") - 1).alias("last_batch"))
        return gaps.where("first_batch <= last_batch")

    def __enter__(self) -> BatchAudit:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, kind, error, trace) -> None:
        limit = time.monotonic() + self.wait
        while (left := self._unfinished()) and time.monotonic() < limit:
            time.sleep(0.05)
        self.spark.streams.removeListener(self)
        if kind is None and (left or self._errors):
            raise AuditFailed("; ".join(self._errors) or f"no word of the end of the streams {sorted(left)}")

    def _unfinished(self) -> set[str]:
        # A stream's end is told after all its batches, so once it came all of them are recorded.
        return self._started - self._ended - {str(q.runId) for q in self.spark.streams.active}

    def onQueryStarted(self, event) -> None:
        self._started.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(self.name)
        if seen is None:
            return
        path = f"{self.path}/stream_id={progress.id}/batch_id={progress.batchId}"
        try:
            # A file sink passes over a replayed batch it has already, so no row is seen; the first record holds.
            if seen["row_count"] == 0 and exists(self.spark, path):
                return
            row = self.spark.range(1, numPartitions=1).select(
                *(F.lit(seen[f.name]).cast(f.dataType).alias(f.name) for f in self._fields)
            )
            row.write.mode("overwrite").parquet(path)
        except Exception as error:  # a listener's own errors reach nobody else
            self._errors.append(f"batch {progress.batchId} of {progress.id}: {error}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.add(str(event.runId))
