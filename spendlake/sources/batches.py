"""Batch responses: an array of sub-responses whose bodies are JSON text themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.functions.errors import TIMED_OUT, TIMED_OUT_CODE, batch_error, error_struct, is_error_code

ENTRIES = "ARRAY<STRUCT<code: INT, body: STRING>>"


def unpack_batches(responses: DataFrame, body: str = "body") -> DataFrame:
    """One row per sub-response, in order: the other columns, ``pos``, ``code``, ``body`` and ``error``.

    A null entry timed out. An empty or unparsable body becomes ``{}``. ``error`` is "" on success.
    """
    entries = F.from_json(F.col(body), ENTRIES, {"mode": "FAILFAST"})
    others = [c for c in responses.columns if c != body]
    opened = responses.select(*others, F.posexplode(entries).alias("pos", "entry"))
    code, text = F.col("entry.code"), F.col("entry.body")
    # A step of its own, so that an error body is parsed once, and the other bodies not at all.
    read = opened.select(
        *others, "pos", "entry", F.when(F.col("entry").isNotNull() & is_error_code(code), error_struct(text)).alias("problem")
    )
    timed_out = F.col("entry").isNull()
    parsed = F.to_json(F.try_parse_json(F.nullif(text, F.lit(""))))
    return read.select(
        *others,
        "pos",
        F.when(timed_out, F.lit(TIMED_OUT_CODE)).otherwise(code).alias("code"),
        F.coalesce(parsed, F.lit("{}")).alias("body"),
        F.when(timed_out, F.lit(TIMED_OUT)).otherwise(batch_error(code, F.col("problem"))).alias("error"),
    )
