"""Daily totals of a delivery stream, late rows accepted for the lookback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from spendlake.functions.days import LOOKBACK_DAYS, as_instant, local_day
from spendlake.functions.metrics import exact_sum
from spendlake.operators.upsert import CatalogTable, ParquetTable, upsert


def daily_totals(
    events: DataFrame,
    grain: tuple[str, ...],
    instant: str = "ts",
    amount: str = "value",
    person: str | None = None,
    late: str = f"{LOOKBACK_DAYS} days",
    landed: str | None = None,
) -> DataFrame:
    """Rows and amount per grain and UTC day; with ``person`` also the approximate number of people.

    The watermark counts from the newest event seen, so ``late`` has to cover the days that
    files of one backlog may be out of order; ``streaming.finish`` raises if a row came later.
    ``landed`` names when a row landed; the newest of a day is its ``ingested_at``, so replaying a
    batch gives equal rows. Works on batch input too.
    """
    naive = isinstance(events.schema[instant].dataType, T.TimestampNTZType)
    moment = as_instant(F.col(instant)) if naive else F.col(instant)
    timed = events.withColumn(instant, moment).withWatermark(instant, late)
    people = [] if person is None else [F.approx_count_distinct(person).alias("reach")]
    totals = timed.groupBy(*grain, F.window(instant, "1 day").alias("day")).agg(
        F.count("*").alias("events"),
        exact_sum(events, amount).cast("double").alias("spend"),
        *people,
        *([] if landed is None else [F.max(landed).alias("ingested_at")]),
    )
    measures = [c for c in totals.columns if c not in (*grain, "day")]
    return totals.select(*grain, local_day(F.col("day.start"), F.lit("UTC")).alias("stat_date"), *measures)


def daily_stream(totals: DataFrame, table: ParquetTable | CatalogTable, checkpoint: str) -> StreamingQuery:
    """Keep a table of the streamed totals: changed day rows replace their earlier values.

    The totals carry ``ingested_at`` (see ``landed``): a clock read here would differ in a replay.
    """
    if "ingested_at" not in totals.columns:
        raise ValueError("totals need ingested_at: name the landing time of the events")

    def apply(batch: DataFrame, _: int) -> None:
        upsert(batch, table)

    writer = totals.writeStream.outputMode("update").foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
