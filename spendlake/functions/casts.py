"""Strict and lenient conversions from parsed JSON leaves to table types.

Numbers and booleans are strict whatever the session's ANSI setting: text that is
not a number stops the job with the column's name. Dates and timestamps that cannot be
read become NULL. All of it is built-in expressions, so it stays in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _reject(value: Column, bad: Column, good: Column, column: str, wanted: str, as_type: str) -> Column:
    message = F.concat(F.lit(f"{column}: not {wanted}: "), value.cast("string"))
    return F.when(bad, F.raise_error(message).cast(as_type)).otherwise(good)


def _or_reject(good: Column, text: Column, column: str, wanted: str, as_type: str) -> Column:
    """``good``, which is null for what cannot be read; NULL and "" give NULL.

    Everything stands here once and briefly: there are many columns, and Java leaves the code of a row uncompiled if it is long.
    """
    message = F.concat(F.lit(f"{column}: not {wanted}: "), text.cast("string"))
    return F.coalesce(good, F.when(text != "", F.raise_error(message).cast(as_type)))


def to_double(text: Column, column: str = "value") -> Column:
    """Text to DOUBLE; NULL and "" give NULL, anything else that is no number raises."""
    # A cast reads Java's type suffix ("1.5d") as part of the number; such text is not a number.
    number = F.when(~text.rlike(r"[0-9.][dDfF] *\z"), text.try_cast("double"))
    return _or_reject(number, text, column, "a number", "double")


def to_bigint(text: Column, column: str = "value") -> Column:
    """Text to BIGINT by way of DOUBLE, truncating toward zero; NaN and out-of-range values raise."""
    return _or_reject(to_double(text, column).try_cast("bigint"), text, column, "a 64-bit whole number", "bigint")


def to_boolean(leaf: Column, column: str = "value") -> Column:
    """VARIANT leaf to BOOLEAN; only JSON true, false and null are accepted."""
    text = json_text(leaf)
    known = F.when(text == "true", F.lit(True)).when(text == "false", F.lit(False))
    return _reject(text, text.isNotNull() & ~text.isin("true", "false"), known, column, "a JSON boolean", "boolean")


def to_date_or_null(text: Column) -> Column:
    return text.try_cast("date")


def to_timestamp_or_null(text: Column) -> Column:
    return text.try_cast("timestamp")


def json_text(leaf: Column) -> Column:
    """VARIANT leaf to compact JSON text; a JSON null or a missing key is NULL."""
    return F.nullif(F.to_json(leaf), F.lit("null"))


def convert(leaf: Column, kind: str, column: str) -> Column:
    """The conversion of one declared kind."""
    match kind:
        case "string":
            return leaf.cast("string")
        case "double":
            return to_double(leaf, column)
        case "bigint":
            return to_bigint(leaf, column)
        case "boolean":
            return to_boolean(leaf, column)
        case "date":
            return to_date_or_null(leaf)
        case "timestamp":
            return to_timestamp_or_null(leaf)
        case "json":
            return json_text(leaf)
        case "variant":
            return F.when(~F.is_variant_null(leaf), leaf)
    raise ValueError(f"column {column}: unknown kind {kind!r}")
