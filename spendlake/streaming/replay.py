"""Pages that land twice, under whatever file names, taken once: state of page identities, bounded by the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What makes a page the same page; its text counts as well, so pages that differ are never taken for each other.
PAGE_ID = ("ad_account_id", "run_id", "page_no", "landed_at")


def pages_once(pages: DataFrame, late: str = "2 days") -> DataFrame:
    """The stream of pages without repeats of a page that landed up to ``late`` after it was first read.

    A file source knows files, not pages: a landing that is repeated writes new files. Here a page's identity and the hash
    of its text stay in state until ``landed_at`` has moved on by ``late``; the text itself does not. A repeat later than
    that lies behind the watermark, is dropped and counted, so ``streaming.finish`` raises. A page read again later on has
    another ``landed_at`` and passes. Nulls in the identity are equal to each other; repeats of a page without
    ``landed_at`` are found only within a batch.
    """
    known = pages.withColumn("text_hash", F.sha2("body", 256)).withWatermark("landed_at", late)
    return known.dropDuplicatesWithinWatermark([*PAGE_ID, "text_hash"]).drop("text_hash")
