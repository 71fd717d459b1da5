"""Compare a registered query with its SQL, row for row and value for value."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple((type(v).__name__, _plain(v)) for v in (row[i] for i in order)) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark, db, sf_dir, query) -> tuple[int, list[str]]:
    """Number of rows and what differs, nothing when equal."""
    got = query.run(spark, sf_dir)
    got_cols, got_rows = rows_of(got.columns, [tuple(r) for r in got.collect()])
    if query.sql is None:
        return len(got_rows), [] if got_rows else ["no rows"]
    want = db.execute(query.sql)
    want_cols, want_rows = rows_of([d[0] for d in want.description], want.fetchall())
    problems = []
    if got_cols != want_cols:
        problems.append(f"columns {got_cols} != {want_cols}")
    if len(got_rows) != len(want_rows):
        problems.append(f"{len(got_rows)} rows != {len(want_rows)}")
    different = [(g, w) for g, w in zip(got_rows, want_rows) if g != w]
    if different:
        problems.append(f"{len(different)} rows differ, first {different[0][0]} != {different[0][1]}")
    if not got_rows:
        problems.append("no rows")
    return len(got_rows), problems
