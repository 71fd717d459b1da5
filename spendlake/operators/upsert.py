"""Keyed upsert, replacement, and the two kinds of table they write to.

``ParquetTable`` keeps plain Parquet cut by day. Its files sit in a version folder below
the root; readers use the newest version that finished. An upsert rewrites only the day
partitions it touches, in place; a change that cannot be done that way (replacement, a row
that leaves its day) writes a new version.

``CatalogTable`` is a table of a catalog that has row-level operations itself; the upsert is
then one MERGE.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake import storage
from spendlake.functions.days import local_day
from spendlake.operators.project import conform
from spendlake.operators.quality import has_null_key
from spendlake.plans.spec import TableSpec
from spendlake.session import scratch_path

VERSION = "v-"
# Inside a staging folder: the source's rows, the table's rows that stay, and the mark that both are whole.
SOURCE, KEPT, READY = "source", "kept", "ready"


class DuplicateKeys(ValueError):
    """The source of an upsert holds a key more than once."""


@dataclass(frozen=True)
class ParquetTable:
    """Parquet files under ``root``, declared by ``spec``, cut by the day of ``spec.day_of``."""

    spec: TableSpec
    root: str

    @property
    def day_column(self) -> str:
        """Partition column: the day itself, or a derived day next to a timestamp."""
        return self.spec.day_of if self.day_is_stored else f"{self.spec.day_of}_day"

    @property
    def day_is_stored(self) -> bool:
        return isinstance(self.spec.schema[self.spec.day_of].dataType, T.DateType)

    @property
    def day_in_key(self) -> bool:
        return self.day_is_stored and self.spec.day_of in self.spec.keys

    def versions(self, spark: SparkSession) -> list[int]:
        """Finished versions, oldest first."""
        names = [n for n in storage.folders(spark, self.root) if n.startswith(VERSION)]
        done = [n for n in names if storage.exists(spark, f"{self.root}/{n}/_SUCCESS")]
        return sorted(int(n.removeprefix(VERSION)) for n in done)

    def path(self, version: int) -> str:
        return f"{self.root}/{VERSION}{version:08d}"

    def exists(self, spark: SparkSession) -> bool:
        return bool(self.versions(spark))

    def files_schema(self) -> T.StructType:
        fields = [f for f in self.spec.schema.fields if f.name != self.day_column]
        return T.StructType([*fields, T.StructField(self.day_column, T.DateType())])

    def with_day(self, df: DataFrame) -> DataFrame:
        """Rows in file layout: declared columns with the partition day last."""
        rows = conform(df, self.spec)
        if not self.day_is_stored:
            rows = rows.withColumn(self.day_column, local_day(F.col(self.spec.day_of), F.lit("UTC")))
        return rows.select(*self.files_schema().names)

    def load(self, spark: SparkSession, *paths: str) -> DataFrame:
        return spark.read.schema(self.files_schema()).parquet(*paths)

    def staging(self) -> str:
        return f"{self.root}/_staging"

    def read(self, spark: SparkSession, start: date | str | None = None, end: date | str | None = None) -> DataFrame:
        """The newest version, optionally only a window of days (which prunes partitions)."""
        versions = self.versions(spark)
        if not versions:
            raise FileNotFoundError(f"no finished version under {self.root}")
        rows = self.load(spark, self.path(versions[-1]))
        if start is not None:
            rows = rows.where(F.col(self.day_column) >= F.lit(start).cast("date"))
        if end is not None:
            rows = rows.where(F.col(self.day_column) <= F.lit(end).cast("date"))
        return rows.select(*self.spec.columns)


@dataclass(frozen=True)
class CatalogTable:
    """A catalog table with row-level operations, declared by ``spec``."""

    spec: TableSpec
    name: str

    def exists(self, spark: SparkSession) -> bool:
        return spark.catalog.tableExists(self.name)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)


@dataclass(frozen=True)
class Staged:
    """Typed rows written out ahead of a merge, so that the merge parses nothing again.

    ``path`` is a folder of its own: the source's rows, later the rows to keep and the mark that both are whole.
    """

    spark: SparkSession
    table: ParquetTable | CatalogTable
    path: str
    rows: int
    days: tuple[date | None, ...]

    @property
    def is_empty(self) -> bool:
        return self.rows == 0


def latest_per_key(rows: DataFrame, keys: Sequence[str], newest_first: Sequence[Column], null_safe: bool = False) -> DataFrame:
    """One row per key, the first in the given order.

    The rank filter is applied before the shuffle as well, so a key repeated any number of
    times sends one row per task. Rows with a NULL key are no duplicates of each other
    (unless ``null_safe``); an id of their own keeps them, and spreads them over the tasks.
    """
    if null_safe:
        groups, marked = list(keys), rows
    else:
        marked = rows.withColumn("__own", F.when(has_null_key(keys), F.monotonically_increasing_id()))
        groups = [*keys, "__own"]
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*newest_first))
    return marked.withColumn("__rank", rank).where("__rank = 1").select(*rows.columns)


def _write_days(df: DataFrame, path: str, day: str, keys: Sequence[str], mode: str = "error") -> None:
    """Write cut by day. Rebalancing gives each day few files and splits a day that is too big for one task."""
    order = list(dict.fromkeys([day, *keys]))
    writer = df.hint("rebalance", day).sortWithinPartitions(*order).write.partitionBy(day)
    if mode == "dynamic":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite" if mode == "dynamic" else mode).parquet(path)


def stage(source: DataFrame, table: ParquetTable | CatalogTable, null_safe: bool = False) -> Staged:
    """Write the typed source to staging (below a Parquet table's root, else the shared folder) and check its keys.

    Everything that can fail in reading and typing fails here, with the table untouched and
    nothing left behind. Raises ``DuplicateKeys`` when a key occurs twice.
    """
    spark, owned = source.sparkSession, isinstance(table, ParquetTable)
    path = f"{table.staging()}/{uuid.uuid4().hex}" if owned else scratch_path(spark, "source")
    day = F.col(table.day_column) if owned else local_day(F.col(table.spec.day_of).cast("timestamp"), F.lit("UTC"))
    try:
        (table.with_day(source) if owned else conform(source, table.spec)).write.parquet(f"{path}/{SOURCE}")
        rows = _staged_rows(spark, table, path)
        _require_unique(rows, table.spec.keys, null_safe)
        # One row per calendar day in the source, the only thing that comes to the driver.
        per_day = rows.groupBy(day.alias("day")).count().collect()
    except Exception:
        storage.delete(spark, path)
        raise
    return Staged(spark, table, path, sum(r["count"] for r in per_day), tuple(r["day"] for r in per_day))


def _staged_rows(spark: SparkSession, table: ParquetTable | CatalogTable, path: str) -> DataFrame:
    if isinstance(table, ParquetTable):
        return table.load(spark, f"{path}/{SOURCE}")
    return spark.read.schema(table.spec.schema).parquet(f"{path}/{SOURCE}")


def _require_unique(rows: DataFrame, keys: Sequence[str], null_safe: bool) -> None:
    if not null_safe:
        rows = rows.where(~has_null_key(keys))
    repeated = rows.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")
    found = repeated.agg(F.count("*").alias("number"), F.min(F.struct(*keys)).alias("example")).first()
    if found.number:
        raise DuplicateKeys(f"source holds {found.number} key(s) more than once, such as {tuple(found.example)}")


def _in(day: str, days: Sequence[date | None]) -> Column:
    known = F.col(day).isin(*[d for d in days if d is not None])
    return known | F.col(day).isNull() if None in days else known


def _matching(target: DataFrame, keys_only: DataFrame, keys: Sequence[str], null_safe: bool, how: str) -> DataFrame:
    """Target rows with (``left_semi``) or without (``left_anti``) a row of the same key on the other side."""
    if not null_safe:
        return target.join(keys_only, list(keys), how)
    other = keys_only.select(*(F.col(k).alias(f"__other_{k}") for k in keys))
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"__other_{key}"))
    return target.join(other, same, how)


def _unmatched(target: DataFrame, keys_only: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    return _matching(target, keys_only, keys, null_safe, "left_anti")


def merge_staged(staged: Staged, null_safe: bool = False) -> None:
    """Bring staged rows into their table: same key replaces the whole row, new keys are added.

    Only the day partitions in the source are rewritten. Their rows that stay are copied to
    staging first, so the final write reads nothing it overwrites; a lost executor only
    repeats tasks. A staging folder that holds both is marked ready before the first partition
    is touched; a run that stops half-way is put right by the next one, which publishes ready
    folders before anything else.
    """
    spark, table = staged.spark, staged.table
    if staged.is_empty:
        storage.delete(spark, staged.path)
        return
    if isinstance(table, CatalogTable):
        _merge_into(staged, null_safe)
        storage.delete(spark, staged.path)
        return
    recover(spark, table)
    keys, day = table.spec.keys, table.day_column
    source = _staged_rows(spark, table, staged.path)
    versions = table.versions(spark)
    if not versions:
        _write_days(source, table.path(1), day, keys, "overwrite")
    else:
        target = table.load(spark, table.path(versions[-1]))
        touched = _in(day, staged.days)
        if not table.day_in_key and _has_moved(target, touched, source.select(*keys), keys, null_safe):
            # A row leaving its day may empty that partition, which no overwrite would clear.
            stay = _unmatched(target, source.select(*keys), keys, null_safe)
            _new_version(stay.unionByName(source), table, versions)
        else:
            _stage_kept(staged, target.where(touched), null_safe)
            storage.touch(spark, f"{staged.path}/{READY}")
            publish(spark, table, staged.path)
    storage.delete(spark, staged.path)


def recover(spark: SparkSession, table: ParquetTable) -> None:
    """Publish what an upsert that stopped half-way had ready; its table version is still the newest."""
    for name in storage.folders(spark, table.staging()):
        path = f"{table.staging()}/{name}"
        if storage.exists(spark, f"{path}/{READY}"):
            publish(spark, table, path)
            storage.delete(spark, path)


def _stage_kept(staged: Staged, target: DataFrame, null_safe: bool) -> None:
    """Write out the target rows that no source row replaces, next to the source's.

    Whole rows are wide and a re-pulled window replaces nearly all of them, so the rows to
    keep are first found by key columns alone. The rows themselves are then picked by the
    shorter of the two key lists, which spares them a shuffle whenever that list is small
    enough for the optimiser to broadcast.
    """
    spark, table, keys = staged.spark, staged.table, staged.table.spec.keys
    source_keys = _staged_rows(spark, table, staged.path).select(*keys)
    keys_path, rows_path = f"{staged.path}/kept-keys", f"{staged.path}/{KEPT}"
    target_keys, counted = target.select(*keys), Observation()
    unmatched = _unmatched(target_keys, source_keys, keys, null_safe)
    unmatched.observe(counted, F.count("*").alias("kept")).write.parquet(keys_path)
    count = counted.get["kept"]
    if count:
        kept_keys = spark.read.schema(target_keys.schema).parquet(keys_path)
        if count <= staged.rows:
            kept = _matching(target, kept_keys, keys, True, "left_semi")
        else:
            kept = _unmatched(target, source_keys, keys, null_safe)
        kept.write.parquet(rows_path)
    storage.delete(spark, keys_path)


def publish(spark: SparkSession, table: ParquetTable, staged: str) -> None:
    """Overwrite the day partitions present in a staging folder; safe to repeat until it succeeds."""
    paths = [f"{staged}/{name}" for name in (SOURCE, KEPT) if storage.exists(spark, f"{staged}/{name}")]
    current = table.path(table.versions(spark)[-1])
    _write_days(table.load(spark, *paths), current, table.day_column, table.spec.keys, "dynamic")


def _has_moved(target: DataFrame, touched: Column, keys_only: DataFrame, keys: Sequence[str], null_safe: bool) -> bool:
    elsewhere = target.where(~F.coalesce(touched, F.lit(False))).select(*keys)
    return not _matching(elsewhere, keys_only, keys, null_safe, "left_semi").isEmpty()


def _new_version(rows: DataFrame, table: ParquetTable, versions: list[int]) -> None:
    """Write a whole new version; the one before stays for readers that opened it, older ones go."""
    spark = rows.sparkSession
    number = versions[-1] + 1 if versions else 1
    _write_days(rows, table.path(number), table.day_column, table.spec.keys, "overwrite")
    for old in versions[:-1]:
        storage.delete(spark, table.path(old))


def upsert(
    source: DataFrame,
    table: ParquetTable | CatalogTable,
    *,
    null_safe: bool = False,
    newest_first: Sequence[Column] | None = None,
) -> int:
    """Create the table if absent, then replace rows by key and add new ones; never deletes.

    Returns the number of source rows; with none the table is neither touched nor created.

    Matched rows are replaced whole, NULLs and ``ingested_at`` included. A NULL in a key
    equals nothing, so such rows are added again on each run; ``null_safe`` lets NULLs match.
    A key twice in the source raises, unless ``newest_first`` says which of its rows to keep.
    """
    if newest_first is not None:
        source = latest_per_key(source, table.spec.keys, newest_first, null_safe)
    if isinstance(table, ParquetTable):
        recover(source.sparkSession, table)
    staged = stage(source, table, null_safe)
    merge_staged(staged, null_safe)
    return staged.rows


def _merge_into(staged: Staged, null_safe: bool) -> None:
    """One MERGE of staged rows. Where the day is in the key, the span of days bounds the scan of the target."""
    spark, table = staged.spark, staged.table
    rows = _staged_rows(spark, table, staged.path)
    if not table.exists(spark):
        rows.limit(0).writeTo(table.name).partitionedBy(F.partitioning.days(table.spec.day_of)).create()
    target = table.name.rsplit(".", 1)[-1]
    match = F.lit(True)
    for key in table.spec.keys:
        ours, theirs = F.col(f"source.{key}"), F.col(f"{target}.{key}")
        match = match & (theirs.eqNullSafe(ours) if null_safe else theirs == ours)
    day, known = table.spec.day_of, [d for d in staged.days if d is not None]
    if day in table.spec.keys and known and len(known) == len(staged.days):
        match = match & F.col(f"{target}.{day}").between(F.lit(min(known)), F.lit(max(known)))
    rows.alias("source").mergeInto(table.name, match).whenMatched().updateAll().whenNotMatched().insertAll().merge()


def replace(source: DataFrame, table: ParquetTable | CatalogTable) -> int:
    """Make the table exactly the source; returns its number of rows."""
    spark = source.sparkSession
    if isinstance(table, CatalogTable):
        writer = conform(source, table.spec).writeTo(table.name)
        writer.partitionedBy(F.partitioning.days(table.spec.day_of)).createOrReplace()
    else:
        _new_version(table.with_day(source), table, table.versions(spark))
    return table.read(spark).count()
