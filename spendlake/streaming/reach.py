"""Exact reach of a delivery stream: two stateful operators in a chain, in append mode.

The first keeps one entry per grain, day and person as long as the day is open, so a hot entity is spread over its people;
when the watermark closes the day, its people go to the second, which counts them. Nothing is estimated, and the state of
a closed day is gone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from spendlake.functions.days import LOOKBACK_DAYS, as_instant, local_day
from spendlake.functions.metrics import exact_sum


def daily_people(
    events: DataFrame, grain: tuple[str, ...], person: str, instant: str = "ts", amount: str = "value", late: str = f"{LOOKBACK_DAYS} days"
) -> DataFrame:
    """Rows, amount and exact number of people per grain and UTC day, once per day: when the newest event is ``late`` past its end.

    Equals ``count(DISTINCT person)`` over all rows of the day; null is no person, its rows and amounts count. Rows without
    an instant belong to no day. A row later than ``late`` would be dropped: run it by ``streaming.finish``, which raises,
    or behind the gate of ``late``. Days still open at the end of what has landed come with a later run.
    """
    naive = isinstance(events.schema[instant].dataType, T.TimestampNTZType)
    moment = as_instant(F.col(instant)) if naive else F.col(instant)
    timed = events.withColumn(instant, moment).withWatermark(instant, late)
    seen = timed.groupBy(*grain, F.window(instant, "1 day").alias("day"), F.col(person).alias("person")).agg(
        F.count("*").alias("events"), exact_sum(events, amount).alias("spend")
    )
    totals = seen.groupBy(*grain, "day").agg(
        F.sum("events").alias("events"), F.sum("spend").cast("double").alias("spend"), F.count("person").alias("reach")
    )
    return totals.select(*grain, local_day(F.col("day.start"), F.lit("UTC")).alias("stat_date"), "events", "spend", "reach")


def people_stream(people: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append closed days to a folder; its own log keeps a batch that is replayed from being there twice."""
    writer = people.writeStream.outputMode("append").format("parquet").option("path", out)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
