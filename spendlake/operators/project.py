"""Parsed JSON objects to rows of a declared table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.functions.casts import convert
from spendlake.plans.spec import INGESTED, TableSpec


def project(
    df: DataFrame,
    spec: TableSpec,
    *,
    item: str = "item",
    account: Column | str | None = None,
    ingested_at: Column | datetime | None = None,
    overrides: dict[str, Column] | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One typed row per parsed object, in the table's column order.

    ``item`` names the struct parsed with ``spec.input_schema``. ``account`` is a column
    or a literal id (default: the column called like the id column), ``ingested_at`` the
    run's instant or a column carrying it. ``overrides`` replaces the expression of single
    columns; ``keep`` carries extra input columns along behind the declared ones.
    """
    overrides = dict(overrides or {})
    unknown = sorted(set(overrides) - set(spec.columns))
    if unknown:
        raise ValueError(f"{spec.name}: no such column to override: {unknown}")
    if account is None:
        account = F.col(spec.id_column)
    elif isinstance(account, str):
        account = F.lit(account)
    if ingested_at is None:
        ingested_at = F.col(INGESTED)
    elif isinstance(ingested_at, datetime):
        ingested_at = F.lit(ingested_at)

    def column(name: str, default: Column) -> Column:
        return overrides.get(name, default).alias(name)

    return df.select(
        column(spec.id_column, account.cast("string")),
        *(column(f.column, convert(F.col(f"{item}.{f.api}"), f.kind, f.column)) for f in spec.fields),
        column(INGESTED, ingested_at.cast("timestamp")),
        *keep,
    )


def select_as(df: DataFrame, columns: list[tuple[str, str] | str]) -> DataFrame:
    """Select plain names, or ``(name, SQL expression)`` pairs computed under that name."""
    return df.selectExpr(*(c if isinstance(c, str) else f"{c[1]} AS `{c[0]}`" for c in columns))


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Cast an already computed DataFrame to the table, absent columns as NULL."""
    have = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in spec.schema.fields
        )
    )
