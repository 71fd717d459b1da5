"""The few file-system questions the table writer asks, through Hadoop's own API (any scheme)."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Spark's setting that removes a query's shuffle files when the query ends.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, as a mark."""
    fs, where = _at(spark, path)
    fs.create(where, True).close()


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path, none when it does not exist."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory())


@contextmanager
def shuffles_removed(spark: SparkSession):
    """For queries that store their result: nothing reads their shuffles again. The session's own setting is put back."""
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEAN_SHUFFLES) if before is None else spark.conf.set(CLEAN_SHUFFLES, before)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)
