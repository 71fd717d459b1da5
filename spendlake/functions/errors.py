"""Readable text for the service's structured error bodies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Error keys, their order, the labels and lead-ins the messages are made of.
ERROR_FIELDS = "message STRING, error_user_msg STRING, type STRING, code STRING, error_subcode STRING, fbtrace_id STRING"
DETAIL_LEAD_IN = " | Meta error: "
BATCH_LEAD_IN = " -- "
TIMED_OUT = "batch sub-request timed out (null entry)"
TIMED_OUT_CODE = 504
FIRST_ERROR_CODE = 400


def _labelled(label: str, value: Column) -> Column:
    return F.concat(F.lit(label), value)


def _filled(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def _parts(error: Column, user_message: Column) -> Column:
    """Comma-joined parts that are present; concat_ws skips NULLs."""
    return F.concat_ws(
        ", ",
        _filled(error["message"]),
        user_message,
        _labelled("type=", _filled(error["type"])),
        _labelled("code=", error["code"]),
        _labelled("error_subcode=", error["error_subcode"]),
        _labelled("fbtrace_id=", _filled(error["fbtrace_id"])),
    )


def error_struct(body: Column) -> Column:
    """The ``error`` object of a body; NULL for anything that is not a JSON object holding one."""
    parsed = F.from_json(body, f"error STRUCT<{ERROR_FIELDS}>")
    return F.when(F.ltrim(body).startswith("{"), parsed["error"])


def error_detail(body: Column) -> Column:
    """Error text of one response body, with its lead-in; "" when there is nothing to tell."""
    error = error_struct(body)
    parts = _parts(error, _labelled("user_message=", _filled(error["error_user_msg"])))
    return F.when(parts != "", F.concat(F.lit(DETAIL_LEAD_IN), parts)).otherwise(F.lit(""))


def is_error_code(code: Column) -> Column:
    """A sub-response failed when its code is missing or is 400 and above."""
    return code.isNull() | (code >= FIRST_ERROR_CODE)


def batch_error(code: Column, error: Column) -> Column:
    """Error text of one sub-response of a batch from its ``error_struct``; "" when its code tells success."""
    parts = _parts(error, _filled(error["error_user_msg"]))
    head = F.concat(F.lit("HTTP "), F.coalesce(code.cast("string"), F.lit("None")))
    text = F.when(parts != "", F.concat(head, F.lit(BATCH_LEAD_IN), parts)).otherwise(head)
    return F.when(is_error_code(code), text).otherwise(F.lit(""))
