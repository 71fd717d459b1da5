"""Helpers the operators share: scratch tables, broadcasts behind a size check, free column names."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.session import scratch_path
from spendlake.storage import CLEAN_SHUFFLES, delete

#: A side is broadcast only if it was counted and has at most this many (narrow) rows.
BROADCAST_ROWS = 1_000_000
#: Bytes of rows that go to Python at a time, however many rows those are, and Spark's setting for it.
BATCH_BYTES, BYTES_AT_A_TIME = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def stored(df: DataFrame, name: str, slim: bool = False) -> DataFrame:
    """The rows written to a new table in the shared folder and read back: cuts lineage, survives lost executors.

    Once the table is whole, nothing reads the shuffles that led to it, so their files go at once. ``slim``: Python gets
    few bytes at a time, for a batch lies several times in an executor's memory. The session's own settings are put back.
    """
    path, conf = scratch_path(df.sparkSession, name), df.sparkSession.conf
    own = {CLEAN_SHUFFLES: "true"} | ({BYTES_AT_A_TIME: str(BATCH_BYTES)} if slim else {})
    before = {setting: conf.get(setting, None) for setting in own}
    try:
        for setting, value in own.items():
            conf.set(setting, value)
        df.write.parquet(path)
    finally:
        for setting, value in before.items():
            conf.unset(setting) if value is None else conf.set(setting, value)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove tables, as ``stored`` returned them, that no later result reads: what was made of them is stored itself."""
    for table in tables:
        delete(table.sparkSession, table.stored_at)


def small_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Marked for broadcast if its counted rows are few; else as it is, for a shuffled join."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def by_part(key: np.ndarray, parts: int) -> np.ndarray:
    """Part of each well-mixed 64-bit key: equal ranges of the key space, so sorted keys have sorted parts."""
    return ((key >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def longs(binary: pa.ChunkedArray | pa.Array, dtype=np.uint64) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype) for x in binary.to_pylist()]


def batch(schema: pa.Schema, *columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def row_slices(column: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts together have about ``limit`` bytes; a longer text is a range of its own."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(column), 0), np.int64)
    total, begin = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > limit:
            yield begin, i
            begin, total = i, 0
        total += int(size)
    if begin < len(sizes):
        yield begin, len(sizes)
