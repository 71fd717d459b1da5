"""Ingest behind a gate: pages are held back until the outcome of their run is known, and only completed runs get in.

Pages and run outcomes are two streams, joined from outside on the left: both sides wait in state, bounded by their
watermarks, until the other side comes or cannot come any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spendlake.operators.filters import RUN_COMPLETED
from spendlake.operators.upsert import CatalogTable, ParquetTable, upsert
from spendlake.plans.jobs import ARRIVAL, newest_first
from spendlake.sources.pages import scan_entities
from spendlake.streaming.runs import RUN_DEADLINE_SECONDS

NO_OUTCOME = "no outcome in time"
ERROR_PAGE = "a page is an error"


def with_outcomes(pages: DataFrame, outcomes: DataFrame, patience: int = RUN_DEADLINE_SECONDS, late: str = "600 seconds") -> DataFrame:
    """Every page once, with ``reason`` why it is kept out: empty, the run's final status, ``no outcome in time`` or an error page.

    ``outcomes`` streams (run_id, status, known_at), one row per run, as ``track_runs`` gives them. An outcome counts if it
    is known between ``patience`` seconds before the page landed and as many after. A page without one comes out when
    both streams have passed that by ``late``, which is also how far rows of a stream may be out of order. A page
    without run or landing time can have no outcome and passes with that reason as soon as its batch does.
    """
    left = pages.withWatermark("landed_at", late)
    right = outcomes.select(F.col("run_id").alias("of_run"), "status", "known_at").withWatermark("known_at", late)
    span = f"INTERVAL {patience} SECONDS"
    near = F.expr(f"run_id = of_run AND known_at >= landed_at - {span} AND known_at <= landed_at + {span}")
    joined = left.join(right, near, "left")
    failed = F.get_json_object("body", "$.error").isNotNull()
    reason = F.when(F.col("status").isNull(), NO_OUTCOME).when(F.col("status") != RUN_COMPLETED, F.col("status")).when(failed, ERROR_PAGE)
    return joined.withColumn("reason", F.coalesce(reason, F.lit(""))).drop("of_run", "status", "known_at")


def gated_stream(paired: DataFrame, table: ParquetTable | CatalogTable, held: str, checkpoint: str, null_safe: bool = False) -> StreamingQuery:
    """Upsert the pages whose run completed; list all others (page and reason) under ``held``, by batch.

    The list is written first and overwritten when a batch is replayed; an upsert that is repeated changes nothing.
    """

    def apply(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            out = batch.where("reason <> ''").select("ad_account_id", "run_id", "page_no", "landed_at", "reason")
            out.write.mode("overwrite").parquet(f"{held}/batch_id={number}")
            good = batch.where("reason = ''").drop("reason")
            if not good.isEmpty():
                upsert(scan_entities(good, table.spec, keep=ARRIVAL), table, null_safe=null_safe, newest_first=newest_first())
        finally:
            batch.unpersist()

    return paired.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
