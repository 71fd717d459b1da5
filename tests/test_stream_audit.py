"""What every micro-batch carried is recorded once, replays included."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from spendlake.streaming.audit import AuditFailed, BatchAudit
from spendlake.streaming.finish import finish


def land(spark, folder, *numbers):
    spark.createDataFrame([(n,) for n in numbers], "n long").coalesce(1).write.mode("append").parquet(f"{folder}/in")


def run(spark, folder, audit, name="a"):
    rows = audit.watch(spark.readStream.schema("n long").parquet(f"{folder}/in"))
    writer = rows.writeStream.format("parquet").option("path", f"{folder}/out-{name}").option("checkpointLocation", f"{folder}/cp-{name}")
    with audit:
        finish(writer.trigger(availableNow=True).start())


def records(audit):
    return sorted(tuple(r)[1:] for r in audit.records().collect())


def metrics():
    return F.min("n").alias("least"), F.count_if(F.col("n").isNull()).alias("nulls")


def test_batches_are_recorded_over_restarts(spark, folder):
    audit = BatchAudit(spark, f"{folder}/audit", "landed", *metrics())
    land(spark, folder, 1, 2, None)
    run(spark, folder, audit)
    land(spark, folder, 7)
    # Another process: nothing is shared but the folders.
    again = BatchAudit(spark, f"{folder}/audit", "landed", *metrics())
    run(spark, folder, again)
    assert records(again) == [(0, 3, 1, 1), (1, 1, 7, 0)]
    assert again.records().select("stream_id").distinct().count() == 1 and again.unrecorded().isEmpty()
    run(spark, folder, again)  # nothing new landed
    assert len(records(again)) == 2
    run(spark, folder, again, "b")
    assert again.records().groupBy("stream_id").agg(F.sum("row_count").alias("n")).select("n").distinct().first().n == 4


def test_a_replayed_batch_has_one_record(spark, folder):
    audit = BatchAudit(spark, f"{folder}/audit", "landed", *metrics())
    land(spark, folder, 1, 2)
    run(spark, folder, audit)
    land(spark, folder, 3)
    run(spark, folder, audit)
    # As after a driver that was lost before it could commit the batch.
    for file in (Path(folder) / "cp-a" / "commits").glob("*1*"):
        if file.name in ("1", ".1.crc"):
            file.unlink()
    run(spark, folder, audit)
    assert records(audit) == [(0, 2, 1, 0), (1, 1, 3, 0)]


def test_a_sink_that_upserts_counts_each_row_once(spark, folder):
    audit = BatchAudit(spark, f"{folder}/audit", "landed")
    land(spark, folder, *range(50))
    rows = audit.watch(spark.readStream.schema("n long").parquet(f"{folder}/in"))

    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{folder}/sink/{number}")

    with audit:
        finish(rows.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start())
    assert records(audit) == [(0, 50)]


def test_missing_records_are_listed_and_an_empty_audit_has_none(spark, folder):
    audit = BatchAudit(spark, f"{folder}/audit", "landed", *metrics())
    audit.watch(spark.createDataFrame([(1,)], "n long"))
    assert audit.records().columns == ["stream_id", "batch_id", "row_count", "least", "nulls"] and audit.records().isEmpty()
    for number in (1, 2, 5):
        spark.sql("SELECT 1L AS row_count, 1L AS least, 0L AS nulls").write.parquet(f"{folder}/audit/stream_id=s/batch_id={number}")
    assert sorted(tuple(r)[1:] for r in audit.unrecorded().collect()) == [(0, 0), (3, 4)]


def test_a_record_that_cannot_be_written_raises(spark, folder):
    Path(folder, "audit").write_text("a file where the folder should be")
    audit = BatchAudit(spark, f"{folder}/audit", "landed", *metrics())
    land(spark, folder, 1)
    with pytest.raises(AuditFailed, match="batch 0"):
        run(spark, folder, audit)
