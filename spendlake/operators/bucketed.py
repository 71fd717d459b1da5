"""Upsert into a catalog table bucketed by its key: the target side of the join is read in place, never shuffled.

For catalogs without row-level operations. The table is cut by day and bucketed by its whole key, the staged source has the
same buckets, so each task joins one bucket of both and writes that bucket of the touched days. Only the source is
shuffled, once, when it is staged.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake import storage
from spendlake.operators.project import conform
from spendlake.operators.quality import has_null_key
from spendlake.operators.upsert import DuplicateKeys, latest_per_key
from spendlake.plans.spec import TableSpec
from spendlake.session import scratch_path

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@dataclass(frozen=True)
class BucketedTable:
    """The catalog table ``name`` with its files under ``root``, declared by ``spec``, whose day is part of the key.

    ``buckets`` is fixed when the table is created: about the bytes of one day divided by 128 MB, at least the cores that
    one upsert should use. Rows of one key lie in one bucket, and a hot account or entity spreads by its days.
    """

    spec: TableSpec
    name: str
    root: str
    buckets: int

    def __post_init__(self) -> None:
        if self.spec.day_of not in self.spec.keys:
            raise ValueError(f"{self.spec.name}: the day has to be in the key, or rows could leave the days that are rewritten")

    @property
    def part(self) -> str:
        """Partition column: a copy of the day, since a column cannot both cut and bucket a table."""
        return f"{self.spec.day_of}_part"

    def exists(self, spark: SparkSession) -> bool:
        return spark.catalog.tableExists(self.name)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name).select(*self.spec.columns)


def _save(rows: DataFrame, table: BucketedTable, name: str, path: str, partitioned: bool) -> None:
    """A new table in the buckets of ``table``, one file a bucket (and day)."""
    keys = table.spec.keys
    writer = rows.repartition(table.buckets, *keys).write.format("parquet").option("path", path)
    if partitioned:
        writer = writer.partitionBy(table.part)
    writer.bucketBy(table.buckets, *keys).sortBy(*keys).saveAsTable(name)


@contextmanager
def _touched_days_only(spark: SparkSession):
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def merged(spark: SparkSession, table: BucketedTable, staged: str, days: Sequence) -> DataFrame:
    """The rows of the touched days after the upsert, each task reading one bucket of both tables."""
    keys, columns, part = table.spec.keys, table.spec.columns, F.col(table.part)
    touched = part.isin(*[d for d in days if d is not None])
    touched = touched | part.isNull() if None in days else touched
    old = spark.table(table.name).where(touched).select(*keys, F.struct(*columns).alias("old_row"))
    new = spark.table(staged).select(*keys, F.struct(*columns).alias("new_row"))
    rows = old.join(new, list(keys), "full_outer").select(F.coalesce("new_row", "old_row").alias("row")).select("row.*")
    return rows.withColumn(table.part, F.col(table.spec.day_of))


def upsert_bucketed(source: DataFrame, table: BucketedTable, newest_first: Sequence[Column] | None = None) -> int:
    """Create the table if absent, then replace rows by key and add new ones; never deletes. Returns the source's rows.

    With no rows the table is neither touched nor created. A NULL in a key matches nothing, so such rows are added again
    on each run. A key twice in the source raises ``DuplicateKeys`` unless ``newest_first`` says which row to keep. Days
    not in the source keep their files. The days are exchanged when the job commits, after all tasks are done, so lost
    executors only repeat tasks; a driver lost in the commit itself leaves some days old, some new: run it again.
    """
    spark, keys = source.sparkSession, table.spec.keys
    if newest_first is not None:
        source = latest_per_key(source, keys, newest_first)
    staged, path = f"staged_{uuid.uuid4().hex}", scratch_path(spark, "staged")
    try:
        _save(conform(source, table.spec), table, staged, path, partitioned=False)
        rows = spark.table(staged)
        # Grouped by the bucket columns, so nothing is shuffled for this either.
        repeated = rows.where(~has_null_key(keys)).groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")
        found = repeated.agg(F.count("*").alias("number"), F.min(F.struct(*keys)).alias("example")).first()
        if found.number:
            raise DuplicateKeys(f"source holds {found.number} key(s) more than once, such as {tuple(found.example)}")
        # One row per calendar day in the source.
        per_day = rows.groupBy(F.col(table.spec.day_of).alias("day")).count().collect()
        if per_day and not table.exists(spark):
            _save(rows.withColumn(table.part, F.col(table.spec.day_of)), table, table.name, table.root, partitioned=True)
        elif per_day:
            with _touched_days_only(spark):
                merged(spark, table, staged, [r.day for r in per_day]).write.insertInto(table.name, overwrite=True)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        storage.delete(spark, path)
    return sum(r["count"] for r in per_day)
