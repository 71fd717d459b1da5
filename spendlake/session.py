"""Session settings the engine is meant to run with, and the folder shared by the executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # JSON objects that repeat a key keep the last value instead of failing.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Streaming state may outgrow executor heaps.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

_local_dirs: dict[str, str] = {}


def build_session(app: str = "spendlake", master: str | None = None, settings: dict[str, str] | None = None) -> SparkSession:
    """A session with the recommended settings; ``settings`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for tables that cut lineage or are scratch.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local session
    without that setting gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="spendlake-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; never reused, so a retried job cannot meet old files."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
