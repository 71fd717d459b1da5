"""The supplied tables as landed API responses, so that the scans have real text to read.

Every page is cut by a key that is unique in its table, so no page can grow beyond
its fixed number of objects however the rows are spread over accounts or days.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake import storage
from spendlake.queries.base import table
from spendlake.session import scratch_path
from spendlake.sources.pages import LANDED_PAGE, as_page, read_landed

LANDED_AT = "2024-02-01T06:00:00Z"
LANDED_EPOCH = 1706767200
PAGE = 100
BATCH = 50
#: Delivery rows that are reported and landed at a time: their shuffles take some 200 bytes a row on disk.
WAVE_ROWS = 4_000_000
#: Both are read once or twice, and text of pages shrinks to half of what Spark's own choice makes of it.
COMPRESSION = "zstd"


def div(whole: Column, by: int) -> Column:
    """Integer quotient, exact for keys of any size."""
    return F.call_function("div", whole, F.lit(by))


def landed(
    rows: DataFrame, account: Column, run: Column, page_no: Column, order: Column, item: Column, last_page: DataFrame | None
) -> DataFrame:
    """Pages of JSON text; ``last_page`` (account, run, last) tells which page of a chain has no successor."""
    cut = rows.select(
        account.alias("ad_account_id"), run.alias("run_id"), page_no.cast("bigint").alias("page_no"),
        F.struct(order.alias("order"), item.alias("item")).alias("entry"),
    )
    keys = ["ad_account_id", "run_id", "page_no"]
    pages = cut.groupBy(*keys).agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    if last_page is None:
        following = F.lit(None).cast("string")
    else:
        pages = pages.join(last_page, ["ad_account_id", "run_id"])
        following = F.when(F.col("page_no") < F.col("last"), F.lit("https://next"))
    items = F.transform("entries", lambda e: e["item"])
    return pages.select(
        *keys, F.lit(LANDED_AT).cast("timestamp").alias("landed_at"), as_page(items, following).alias("body")
    ).select(*LANDED_PAGE.names)


def through_files(spark: SparkSession, pages: DataFrame | Iterable[DataFrame], fmt: str = "parquet") -> DataFrame:
    """Land the pages, all at once or some at a time, in the shared folder and read them back as a run would.

    What was shuffled for pages is removed as soon as they have landed.
    """
    path = scratch_path(spark, "pages")
    for some in [pages] if isinstance(pages, DataFrame) else pages:
        writer = some.write.format(fmt).mode("append")
        if fmt == "parquet":
            writer = writer.option("compression", COMPRESSION)
        with storage.shuffles_removed(spark):
            writer.save(path)
    return read_landed(spark, path, fmt)


def waves(spark: SparkSession, delivery: DataFrame, ads: DataFrame, rows: int) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Delivery rows, of which there are about ``rows``, with their ads, some ``WAVE_ROWS`` at a time.

    They are cut by the page of their ad, so every row of an ad report and every page of them comes from one wave. If there
    are several, the rows are stored first; those of a wave are removed when the next one is asked for.
    """
    number = -(-rows // WAVE_ROWS)
    if number <= 1:
        yield delivery, ads
        return
    wave = F.pmod(F.xxhash64(div(F.col("ad_id").cast("bigint"), PAGE)), F.lit(number)).cast("int")
    path = scratch_path(spark, "delivery")
    with storage.shuffles_removed(spark):
        delivery.withColumn("wave", wave).write.partitionBy("wave").option("compression", COMPRESSION).parquet(path)
    for k in range(number):
        own = f"{path}/wave={k}"
        stored = spark.read.schema(delivery.schema).parquet(own) if storage.exists(spark, own) else delivery.limit(0)
        yield stored, ads.where(wave == k)
        storage.delete(spark, own)
    storage.delete(spark, path)


def region_account(nation_key: Column) -> Column:
    """Account of a nation: nations go round the regions in key order."""
    return F.concat(F.lit("act_"), (nation_key % 5).cast("string"))


REGION_ACCOUNT_SQL = "'act_' || CAST({0} % 5 AS VARCHAR)"


def ad_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as ad objects, with the odd shapes that occur: text numbers, "", nulls, nested values."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    rows = table(spark, sf_dir, "customer")
    offset = F.when(key % 2 == 0, "+0000").otherwise("-0800")
    created = F.concat(
        F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (key % 60).cast("int")), "yyyy-MM-dd"), F.lit("T22:13:20"), offset
    )
    item = F.struct(
        key.cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.concat_ws("-", nation.cast("string"), "c_mktsegment").alias("adset_id"),
        nation.alias("campaign_id"),
        F.when(key % 7 == 0, "").otherwise(F.col("c_acctbal").cast("string")).alias("bid_amount"),
        F.when(key % 3 > 0, key % 100).alias("priority"),
        created.alias("created_time"),
        F.when(key % 11 == 0, "").otherwise("not a time").alias("updated_time"),
        (nation % 2 == 0).alias("is_autobid"),
        F.when(key % 5 == 0, "DELETED").when(key % 5 == 1, "ARCHIVED").when(key % 5 == 2, "ACTIVE").alias("effective_status"),
        F.struct(F.col("c_mktsegment").alias("kind"), F.array(nation, key).alias("parts")).alias("creative"),
        F.when(key % 4 == 0, F.array().cast("array<string>")).alias("recommendations"),
        F.lit("never declared").alias("account_id"),
    )
    run = F.lit("ads")
    account, page = region_account(nation), div(key, PAGE) + 1
    last = rows.groupBy(account.alias("ad_account_id"), run.alias("run_id")).agg(F.max(page).alias("last"))
    return landed(rows, account, run, page, key, item, last)


def ad_set_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as ad set objects."""
    key = F.col("p_partkey")
    rows = table(spark, sf_dir, "part")
    item = F.struct(
        key.cast("string").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("campaign_id"),
        F.col("p_type").alias("optimization_goal"),
        F.concat(F.col("p_size").cast("string"), F.lit(".9")).alias("bid_amount"),
        F.col("p_retailprice").cast("string").alias("daily_budget"),
        F.when(key % 2 == 0, "").otherwise(F.col("p_retailprice").cast("string")).alias("lifetime_budget"),
        (F.col("p_size") > 25).alias("is_dynamic_creative"),
        F.concat(
            F.date_format(F.date_add(F.lit("2021-06-01").cast("date"), (key % 30).cast("int")), "yyyy-MM-dd"), F.lit("T00:00:00+0000")
        ).alias("created_time"),
        F.struct(F.array("p_brand").alias("brands"), F.struct(F.lit(18).alias("min")).alias("ages")).alias("targeting"),
        F.array(F.lit("standard")).alias("pacing_type"),
    )
    run = F.lit("adsets")
    account, page = F.concat(F.lit("act_"), (key % 3).cast("string")), div(key, PAGE) + 1
    last = rows.groupBy(account.alias("ad_account_id"), run.alias("run_id")).agg(F.max(page).alias("last"))
    return landed(rows, account, run, page, key, item, last)


def campaign_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as campaign objects."""
    key = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier")
    item = F.struct(
        key.cast("string").alias("id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").cast("string").alias("daily_budget"),
        F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("spend_cap"),
        F.when(key % 2 == 0, "OUTCOME_SALES").otherwise("OUTCOME_LEADS").alias("objective"),
        (key % 3 == 0).alias("can_use_spend_cap"),
        F.lit("2022-03-04T05:06:07+0000").alias("created_time"),
        F.when(key % 2 == 0, F.array(F.lit("HOUSING"))).alias("special_ad_categories"),
        F.lit("bare").alias("special_ad_category_country"),
        F.struct(F.col("s_nationkey").alias("pixel_id")).alias("promoted_object"),
    )
    run = F.lit("campaigns")
    account, page = region_account(F.col("s_nationkey")), div(key, PAGE) + 1
    last = rows.groupBy(account.alias("ad_account_id"), run.alias("run_id")).agg(F.max(page).alias("last"))
    return landed(rows, account, run, page, key, item, last)


def account_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as visible accounts."""
    key = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer")
    item = F.struct(F.concat(F.lit("act_"), key.cast("string")).alias("id"))
    return landed(rows, F.lit("me"), F.lit("accounts"), div(key, PAGE) + 1, key, item, None)


def report_pages(rows: DataFrame, item: Column, number: str = "ad_id") -> DataFrame:
    """Report rows as pages, one run per account and day; an entity occurs once a day, so pages are bounded."""
    entity = F.col(number).cast("bigint")
    run = F.concat_ws("/", "ad_account_id", F.col("stat_date").cast("string"))
    return landed(rows, F.lit("unknown"), run, div(entity, PAGE) + 1, entity, item, None)


def report_runs(pages: DataFrame) -> DataFrame:
    """Which account each of those runs belongs to."""
    return pages.select("run_id", F.split_part("run_id", F.lit("/"), F.lit(1)).alias("ad_account_id")).distinct()


def batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as batch responses of 50: started runs, errors of all shapes, null entries, bad bodies."""
    key = F.col("event_id")
    kind = key % 9
    error = F.struct(
        F.concat(F.lit("no "), F.col("event_type")).alias("message"),
        F.when(kind == 1, "try less").alias("error_user_msg"),
        F.lit("OAuthException").alias("type"),
        F.col("user_id").alias("code"),
        F.when(key % 2 == 0, 99).alias("error_subcode"),
        F.when(kind == 2, "").otherwise(key.cast("string")).alias("fbtrace_id"),
    )
    failed = F.to_json(F.struct(error.alias("error")))
    body = (
        F.when(kind.isin(1, 2), failed)
        .when(kind == 3, "<html>")
        .when(kind == 4, "")
        .when(kind == 6, '{"error":{}}')
        .otherwise(F.to_json(F.struct(key.cast("string").alias("report_run_id"))))
    )
    code = F.when(kind == 1, 400).when(kind == 2, 500).when(kind == 3, 503).when(kind == 6, 404).when(kind == 7, F.lit(None)).otherwise(200)
    # Text of each entry by hand, because a struct writer would leave absent codes out of a null entry too.
    entry = F.when(kind == 5, F.lit("null")).otherwise(F.to_json(F.struct(code.cast("int").alias("code"), body.alias("body"))))
    rows = table(spark, sf_dir, "events").select(
        div(key, BATCH).alias("batch_no"), F.struct((key % BATCH).alias("place"), entry.alias("entry")).alias("cell")
    )
    cells = rows.groupBy("batch_no").agg(F.array_sort(F.collect_list("cell")).alias("cells"))
    text = F.concat(F.lit("["), F.array_join(F.transform("cells", lambda c: c["entry"]), ","), F.lit("]"))
    return cells.select("batch_no", text.alias("body"))


BATCH_SQL = f"""
batches AS (
  SELECT event_id, CAST(event_id // {BATCH} AS BIGINT) AS batch_no, CAST(event_id % {BATCH} AS INTEGER) AS pos,
         event_id % 9 AS kind,
         CAST(CASE event_id % 9 WHEN 1 THEN 400 WHEN 2 THEN 500 WHEN 3 THEN 503 WHEN 5 THEN 504 WHEN 6 THEN 404
              WHEN 7 THEN NULL ELSE 200 END AS INTEGER) AS code,
         'no ' || event_type || CASE WHEN event_id % 9 = 1 THEN ', try less' ELSE '' END || ', type=OAuthException, code='
           || CAST(user_id AS VARCHAR) || CASE WHEN event_id % 2 = 0 THEN ', error_subcode=99' ELSE '' END
           || CASE WHEN event_id % 9 = 2 THEN '' ELSE ', fbtrace_id=' || CAST(event_id AS VARCHAR) END AS parts,
         user_id, event_type
  FROM events),
responses AS (
  SELECT event_id, batch_no, pos, code,
         CASE kind WHEN 1 THEN 'HTTP 400 -- ' || parts WHEN 2 THEN 'HTTP 500 -- ' || parts WHEN 3 THEN 'HTTP 503'
              WHEN 5 THEN 'batch sub-request timed out (null entry)' WHEN 6 THEN 'HTTP 404' WHEN 7 THEN 'HTTP None' ELSE '' END AS error,
         CASE WHEN kind IN (0, 7, 8) THEN CAST(event_id AS VARCHAR) END AS run_id
  FROM batches)"""
