"""Landed API pages: reading, unrolling, chain checks, typed scans.

A landed page is one row: who it was fetched for, its place in the chain, and the
response text. Pages may come as Parquet, as JSON lines or as one file per page; a
columnar landing zone is best at scale because it is splittable and compresses the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.operators.filters import created_between
from spendlake.operators.project import project
from spendlake.plans.spec import TableSpec

LANDED_PAGE = (
    T.StructType()
    .add("ad_account_id", T.StringType())
    .add("run_id", T.StringType())
    .add("page_no", T.LongType())
    .add("landed_at", T.TimestampType())
    .add("body", T.StringType())
)
#: A run list is sent to every executor if its ids were measured to take at most this many bytes.
RUN_LIST_BYTES = 64 << 20
ONLY_ID = T.StructType().add("id", T.StringType())
# Malformed responses stop the job instead of turning into missing rows.
STRICT = {"mode": "FAILFAST"}


def read_landed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read landed pages.

    ``parquet`` and ``json`` (one object per line) hold the columns of ``LANDED_PAGE``.
    ``text`` is one response per file, its other columns taken from ``column=value``
    directory names.
    """
    if fmt == "text":
        whole = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
        where = F.input_file_name()
        return whole.select(
            *(
                F.col("value").alias(f.name) if f.name == "body" else _from_path(where, f.name).cast(f.dataType).alias(f.name)
                for f in LANDED_PAGE.fields
            )
        )
    reader = spark.read.schema(LANDED_PAGE)
    return reader.option("mode", "FAILFAST").json(path) if fmt == "json" else reader.format(fmt).load(path)


def _from_path(where: Column, column: str) -> Column:
    """Value of a ``column=value`` folder in a file's address.

    Folder names are escaped, and the address escapes them again; in both a plus is just a plus.
    """
    value = F.nullif(F.regexp_extract(where, f"/{column}=([^/]*)/", 1), F.lit(""))
    for _ in range(2):
        value = F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
    return value


def scan_pages(pages: DataFrame, item_schema: T.StructType | None = None, body: str = "body") -> DataFrame:
    """One row per entry of every page's ``data``, with the page's columns, ``pos`` and ``item``.

    With ``item_schema`` the envelope and its objects are parsed in a single pass down to
    the declared keys; without it ``item`` is the object's JSON text. A page without
    ``data`` has no rows.
    """
    item = item_schema or T.StringType()
    envelope = T.StructType().add("data", T.ArrayType(item))
    parsed = F.from_json(F.col(body), envelope, STRICT)
    others = [c for c in pages.columns if c != body]
    return pages.select(*others, F.posexplode(parsed["data"]).alias("pos", "item"))


def in_page_order(items: DataFrame, chain: tuple[str, ...] = ("ad_account_id", "run_id")) -> DataFrame:
    """Arrival order, for the callers that need one (a global sort)."""
    return items.orderBy(*chain, "page_no", "pos")


def page_chain_check(
    pages: DataFrame,
    chain: tuple[str, ...] = ("ad_account_id", "run_id"),
    first_page: int = 1,
    body: str = "body",
) -> DataFrame:
    """One row per chain of pages with what is needed to trust it, and ``complete``.

    Complete means: pages numbered from ``first_page`` without gap or repeat, only the last one
    lacks ``paging.next`` (a short last page may still carry cursors), and none is an error.
    """
    envelope = F.from_json(F.col(body), "paging STRUCT<next: STRING>, error STRING", STRICT)
    per_page = (
        pages.select(*chain, "page_no", envelope.alias("e"))
        .select(*chain, "page_no", F.coalesce("e.paging.next", F.lit("")).alias("following"), F.col("e.error").isNotNull().alias("failed"))
        .groupBy(*chain, "page_no")
        .agg(F.count("*").alias("copies"), F.count_if(F.col("following") == "").alias("ends"), F.count_if("failed").alias("errors"))
    )
    checked = per_page.groupBy(*chain).agg(
        F.sum("copies").alias("pages"),
        F.min("page_no").alias("first_page"),
        F.max("page_no").alias("last_page"),
        F.sum("ends").alias("end_pages"),
        F.sum("errors").alias("error_pages"),
        F.count("*").alias("numbers"),
        F.max(F.when(F.col("ends") > 0, F.col("page_no"))).alias("end_at"),
    )
    complete = (
        (F.col("first_page") == first_page)
        & (F.col("last_page") - F.col("first_page") + 1 == F.col("numbers"))
        & (F.col("pages") == F.col("numbers"))
        & (F.col("end_pages") == 1)
        & (F.col("end_at") == F.col("last_page"))
        & (F.col("error_pages") == 0)
    )
    return checked.select(
        *chain, "pages", "first_page", "last_page", "end_pages", "error_pages", F.coalesce(complete, F.lit(False)).alias("complete")
    )


def scan_report(pages: DataFrame, runs: DataFrame, spec: TableSpec, **projection) -> DataFrame:
    """Typed rows of the reports in ``runs`` (run_id, ad_account_id), tagged with the run's account.

    The ids of the runs are measured first, so bodies are parsed where they are read whenever the list is short, whatever the
    optimiser's estimate of it; a longer list is joined as the optimiser sees fit.
    """
    runs = runs.select("run_id", "ad_account_id")
    # A row of its own takes some bytes beside its ids.
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in runs.columns), F.lit(64))
    if (runs.agg(F.sum(size)).first()[0] or 0) <= RUN_LIST_BYTES:
        runs = F.broadcast(runs)
    own = pages.drop("ad_account_id").join(runs, "run_id")
    projection.setdefault("ingested_at", F.col("landed_at"))
    return project(scan_pages(own, spec.input_schema), spec, **projection)


def scan_entities(pages: DataFrame, spec: TableSpec, created: tuple | None = None, **projection) -> DataFrame:
    """Typed entity objects of landed listing pages, optionally only those created in a window of days."""
    projection.setdefault("ingested_at", F.col("landed_at"))
    rows = project(scan_pages(pages, spec.input_schema), spec, **projection)
    return rows if created is None else created_between(rows, "created_time", *created)


def entity_ids(pages: DataFrame) -> DataFrame:
    """Account and id of every listed entity."""
    return scan_pages(pages, ONLY_ID).select("ad_account_id", F.col("item.id").alias("id"))


def scan_accounts(pages: DataFrame) -> DataFrame:
    """Visible account ids, with their place in the listing."""
    found = scan_pages(pages, ONLY_ID)
    return found.select(F.col("item.id").alias("ad_account_id"), "page_no", "pos")


def append(*frames: DataFrame) -> DataFrame:
    """All rows of all inputs, repeats kept, columns matched by name."""
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more)
    return out


def table_scan(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or view."""
    return spark.table(name)


def as_page(items: Column, following: Column) -> Column:
    """Response text of a page, for landing data that is not yet in that form."""
    paging = F.struct(F.struct(F.lit("c").alias("after")).alias("cursors"), following.alias("next"))
    return F.to_json(F.struct(items.alias("data"), paging.alias("paging")))
