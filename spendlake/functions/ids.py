"""Account id clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: native account ids carry this prefix.
ACCOUNT_PREFIX = "act_"


def strip(text: Column) -> Column:
    """Drop surrounding white space of any sort, not only blanks."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def account_id(text: Column) -> Column:
    """Account id in native form, prefix added when it is missing."""
    bare = strip(text)
    return F.when(bare.startswith(ACCOUNT_PREFIX), bare).otherwise(F.concat(F.lit(ACCOUNT_PREFIX), bare))


def split_accounts(csv: Column) -> Column:
    """Comma-separated ids to an array of native ids in written order, blank entries dropped."""
    return F.transform(F.filter(F.split(csv, ","), lambda x: strip(x) != ""), account_id)
