"""Late rows of a stream split off before they reach any state, and kept until somebody has dealt with them.

A stateful operator drops what lies behind its watermark and tells only how much. So rows pass a gate first, a stream
without state of its own: it knows the newest instant of all batches before (written down batch by batch), writes a batch's
rows that are not behind it by more than the lateness to ``accepted``, the rest to ``late``, each under the number of the
batch. A batch that is replayed overwrites its own folders and sees the same instant, so nothing is written twice or lost.
The stateful stream reads ``accepted`` with the same lateness, whole batches at a time, and so never drops a row.

As long as late rows lie there, ``accept`` and ``accepted`` raise, on every call, until ``settle`` writes down what was done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from spendlake.storage import exists
from spendlake.streaming.finish import LateRows

_MARK = "newest_us BIGINT, late BIGINT"


def _batches(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A folder with a folder per batch, empty if there is none yet; the batch is a column."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(whole).parquet(path) if exists(spark, path) else spark.createDataFrame([], whole)


def late_batches(spark: SparkSession, folder: str) -> DataFrame:
    """``batch_id, late`` of the batches with late rows that were not settled."""
    marks = _batches(spark, f"{folder}/marks", _MARK).groupBy("batch_id").agg(F.sum("late").alias("late"))
    done = _batches(spark, f"{folder}/settled", "how STRING").select("batch_id").distinct()
    return marks.where(F.col("late") > 0).join(done, "batch_id", "left_anti")


def late_rows(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All late rows that were not settled, with the batch they came in."""
    open_ = late_batches(spark, folder).select("batch_id")
    return _batches(spark, f"{folder}/late", schema).join(open_, "batch_id", "left_semi")


def require_settled(spark: SparkSession, folder: str) -> None:
    """Raise ``LateRows`` while there is any late row that nobody dealt with."""
    found = late_batches(spark, folder).agg(F.count("*").alias("batches"), F.sum("late").alias("rows"), F.min("batch_id").alias("first")).first()
    if found.batches:
        raise LateRows(f"{found.rows} late row(s) in {found.batches} batch(es) from batch {found.first} on, kept in {folder}/late")


def settle(spark: SparkSession, folder: str, how: str) -> int:
    """Write down that the late rows there are now were dealt with, and how; returns the number of batches settled."""
    open_ = late_batches(spark, folder).select("batch_id")
    # Numbers of batches, of which there are few: each is a start of the stream.
    numbers = [r.batch_id for r in open_.collect()]
    for number in numbers:
        spark.createDataFrame([(how,)], "how STRING").coalesce(1).write.mode("overwrite").parquet(f"{folder}/settled/batch_id={number}")
    return len(numbers)


def accept(rows: DataFrame, instant: str, late: str, folder: str, checkpoint: str) -> StreamingQuery:
    """Start the gate: everything that has landed goes to ``accepted`` or ``late`` under ``folder``.

    A row is late if its ``instant`` (a timestamp) is null or lies ``late`` (an interval as text) or more behind the
    newest one of the batches before. Raises ``LateRows`` instead of starting while late rows are not settled.
    """
    spark = rows.sparkSession
    require_settled(spark, folder)

    def split(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        earlier = _batches(session, f"{folder}/marks", _MARK).where(F.col("batch_id") < number)
        newest = earlier.agg(F.max("newest_us")).first()[0]
        at = F.unix_micros(F.col(instant))
        limit = F.unix_micros(F.timestamp_micros(F.lit(newest)) - F.expr(f"INTERVAL {late}")) if newest is not None else None
        is_late = F.col(instant).isNull() if limit is None else F.coalesce(at <= limit, F.lit(True))
        batch.persist()
        try:
            batch.where(~is_late).write.mode("overwrite").parquet(f"{folder}/accepted/batch_id={number}")
            batch.where(is_late).write.mode("overwrite").parquet(f"{folder}/late/batch_id={number}")
            mark = batch.agg(F.max(F.when(~is_late, at)).alias("newest_us"), F.count_if(is_late).alias("late"))
            mark.coalesce(1).write.mode("overwrite").parquet(f"{folder}/marks/batch_id={number}")
        finally:
            batch.unpersist()

    return rows.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def accepted(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The accepted rows as a stream. It takes whole batches, however many files they have: a limit on files could move
    the watermark between two files of one batch. Raises while late rows are not settled."""
    require_settled(spark, folder)
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{folder}/accepted")
