"""Incremental upsert: landed pages arrive as a file stream, each micro-batch is one upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from spendlake.operators.upsert import CatalogTable, ParquetTable, upsert
from spendlake.plans.jobs import ARRIVAL, newest_first
from spendlake.sources.pages import LANDED_PAGE, scan_entities


def landed_stream(spark: SparkSession, path: str, fmt: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    """Pages as they land, oldest files first."""
    reader = spark.readStream.schema(LANDED_PAGE).option("maxFilesPerTrigger", files_per_batch)
    return reader.format(fmt).load(path)


def upsert_stream(
    pages: DataFrame, table: ParquetTable | CatalogTable, checkpoint: str, null_safe: bool = False
) -> StreamingQuery:
    """Upsert every micro-batch of pages and stop when nothing is left to read.

    A batch that is replayed writes the same rows again: keys decide where they go, and
    ``ingested_at`` is the time the page landed, not the time of the run.
    """

    def apply(batch: DataFrame, _: int) -> None:
        rows = scan_entities(batch, table.spec, keep=ARRIVAL)
        upsert(rows, table, null_safe=null_safe, newest_first=newest_first())

    writer = pages.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
