"""Scans of landed text: pages, chains, listings, reports, batches, errors, typed tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.functions.errors import DETAIL_LEAD_IN, error_detail
from spendlake.operators.numbering import numbered
from spendlake.operators.project import select_as
from spendlake.operators.report import attach
from spendlake.operators.runs import failed_submissions, last_submission, pair_responses, started_runs
from spendlake.operators.upsert import ParquetTable, upsert
from spendlake.operators.variants import at_paths, key_audit, undeclared_keys
from spendlake.plans import tables as T
from spendlake.plans.spec import TableSpec
from spendlake.queries import landing as L
from spendlake.queries.base import DELIVERY_SQL, campaign_names, portable, query, report_sql, sql_columns, table
from spendlake.queries.reports import AD_GRAIN, ad_reports, level_report
from spendlake.session import scratch_path
from spendlake.sources.batches import unpack_batches
from spendlake.sources.pages import (
    append,
    entity_ids,
    in_page_order,
    page_chain_check,
    scan_accounts,
    scan_entities,
    scan_pages,
    scan_report,
    table_scan,
)

ACCOUNT_OF_AD = L.REGION_ACCOUNT_SQL.format("c_nationkey")


@query(
    "scan_pages",
    f"""
SELECT {ACCOUNT_OF_AD} AS ad_account_id, 'ads' AS run_id, CAST(c_custkey // {L.PAGE} + 1 AS BIGINT) AS page_no,
       CAST(row_number() OVER (PARTITION BY c_nationkey % 5, c_custkey // {L.PAGE} ORDER BY c_custkey) - 1 AS INTEGER) AS pos,
       c_name AS name
FROM customer""",
)
def scan_pages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = scan_pages(L.through_files(spark, L.ad_listing(spark, sf_dir)))
    name = F.get_json_object("item", "$.name").alias("name")
    return items.select("ad_account_id", "run_id", "page_no", "pos", name)


@query(
    "page_chain_check",
    f"""
WITH listed AS (SELECT DISTINCT {ACCOUNT_OF_AD} AS ad_account_id, c_custkey // {L.PAGE} + 1 AS page_no FROM customer),
ends AS (SELECT ad_account_id, max(page_no) AS last FROM listed GROUP BY ad_account_id),
pages AS (SELECT * FROM listed JOIN ends USING (ad_account_id) WHERE NOT (ad_account_id = 'act_2' AND page_no = 2))
SELECT ad_account_id, 'ads' AS run_id, CAST(count(*) AS BIGINT) AS pages, CAST(min(page_no) AS BIGINT) AS first_page,
       CAST(max(page_no) AS BIGINT) AS last_page, CAST(count(*) FILTER (page_no = last) AS BIGINT) AS end_pages,
       CAST(0 AS BIGINT) AS error_pages,
       (min(page_no) = 1 AND count(*) = max(page_no) AND max(page_no) = any_value(last)) AS complete
FROM pages GROUP BY ad_account_id""",
)
def page_chain_check_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing of one account lacks its second page."""
    pages = L.ad_listing(spark, sf_dir).where("NOT (ad_account_id = 'act_2' AND page_no = 2)")
    return page_chain_check(pages)


@query("entity_ids", f"SELECT {ACCOUNT_OF_AD} AS ad_account_id, CAST(c_custkey AS VARCHAR) AS id FROM customer")
def entity_ids_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity_ids(L.ad_listing(spark, sf_dir))


@query(
    "scan_accounts",
    f"""
SELECT 'act_' || CAST(c_custkey AS VARCHAR) AS ad_account_id, CAST(c_custkey // {L.PAGE} + 1 AS BIGINT) AS page_no,
       CAST(row_number() OVER (PARTITION BY c_custkey // {L.PAGE} ORDER BY c_custkey) - 1 AS INTEGER) AS pos
FROM customer""",
)
def scan_accounts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_accounts(L.account_listing(spark, sf_dir))


ADS_KNOWN = {
    "ad_account_id": ACCOUNT_OF_AD,
    "ad_id": "c_custkey",
    "name": "c_name",
    "ad_set_id": "CAST(c_nationkey AS VARCHAR) || '-' || c_mktsegment",
    "campaign_id": "c_nationkey",
    "bid_amount": "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE trunc(c_acctbal) END",
    "priority": "CASE WHEN c_custkey % 3 > 0 THEN c_custkey % 100 END",
    "created_time": """epoch(CAST(DATE '2020-01-01' + CAST(c_custkey % 60 AS INTEGER) AS TIMESTAMP))
        + 80000 + CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE 28800 END""",
    "is_autobid": "c_nationkey % 2 = 0",
    "effective_status": "CASE c_custkey % 5 WHEN 0 THEN 'DELETED' WHEN 1 THEN 'ARCHIVED' WHEN 2 THEN 'ACTIVE' END",
    "creative_json": """'{"kind":"' || c_mktsegment || '","parts":[' || CAST(c_nationkey AS VARCHAR) || ',' ||
        CAST(c_custkey AS VARCHAR) || ']}'""",
    "recommendations_json": "CASE WHEN c_custkey % 4 = 0 THEN '[]' END",
    "ingested_at": str(L.LANDED_EPOCH),
}
AD_SETS_KNOWN = {
    "ad_account_id": "'act_' || CAST(p_partkey % 3 AS VARCHAR)",
    "ad_set_id": "p_partkey",
    "name": "p_name",
    "campaign_id": "p_brand",
    "optimization_goal": "p_type",
    "bid_amount": "p_size",
    "daily_budget": "p_retailprice",
    "lifetime_budget": "CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE p_retailprice END",
    "is_dynamic_creative": "p_size > 25",
    "created_time": "epoch(CAST(DATE '2021-06-01' + CAST(p_partkey % 30 AS INTEGER) AS TIMESTAMP))",
    "targeting_json": """'{"ages":{"min":18},"brands":["' || p_brand || '"]}'""",
    "pacing_type_json": "'[\"standard\"]'",
    "ingested_at": str(L.LANDED_EPOCH),
}
CAMPAIGNS_KNOWN = {
    "ad_account_id": L.REGION_ACCOUNT_SQL.format("s_nationkey"),
    "campaign_id": "s_suppkey",
    "name": "s_name",
    "daily_budget": "s_acctbal",
    "spend_cap": "CASE WHEN s_acctbal > 0 THEN s_acctbal END",
    "objective": "CASE WHEN s_suppkey % 2 = 0 THEN 'OUTCOME_SALES' ELSE 'OUTCOME_LEADS' END",
    "can_use_spend_cap": "s_suppkey % 3 = 0",
    "created_time": "epoch(TIMESTAMP '2022-03-04 05:06:07')",
    "special_ad_categories_json": "CASE WHEN s_suppkey % 2 = 0 THEN '[\"HOUSING\"]' END",
    "special_ad_category_country_json": "'\"bare\"'",
    "promoted_object_json": "'{\"pixel_id\":' || CAST(s_nationkey AS VARCHAR) || '}'",
    "ingested_at": str(L.LANDED_EPOCH),
}


@query("scan_ads", f"SELECT {sql_columns(T.ADS, ADS_KNOWN)} FROM customer")
def scan_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(scan_entities(L.through_files(spark, L.ad_listing(spark, sf_dir), "json"), T.ADS))


@query("scan_ad_sets", f"SELECT {sql_columns(T.AD_SETS, AD_SETS_KNOWN)} FROM part")
def scan_ad_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(scan_entities(L.ad_set_listing(spark, sf_dir), T.AD_SETS))


@query("scan_campaigns", f"SELECT {sql_columns(T.CAMPAIGNS, CAMPAIGNS_KNOWN)} FROM supplier")
def scan_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(scan_entities(L.campaign_listing(spark, sf_dir), T.CAMPAIGNS))


@query(
    "scan_entities_created",
    f"""SELECT * FROM (SELECT {sql_columns(T.ADS, ADS_KNOWN)} FROM customer)
WHERE created_time >= epoch(TIMESTAMP '2020-01-11 00:00:00') AND created_time < epoch(TIMESTAMP '2020-02-01 00:00:00')""",
)
def scan_entities_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = L.ad_listing(spark, sf_dir)
    return portable(scan_entities(pages, T.ADS, ("2020-01-11", "2020-01-31")))


def _facts_known(**more: str) -> dict[str, str]:
    metrics = "spend impressions clicks reach frequency cpc cpm ctr inline_link_clicks inline_post_engagement".split()
    return {
        "ad_account_id": "ad_account_id",
        "stat_date": "stat_date",
        **{m: m for m in metrics},
        "actions_json": """'[{"action_type":"click","value":"' || CAST(clicks AS VARCHAR) || '"}]'""",
        "ingested_at": str(L.LANDED_EPOCH),
        **more,
    }


def _fact_sql(spec: TableSpec, grain: str, **more: str) -> str:
    return f"""WITH {DELIVERY_SQL}, {report_sql(grain + ', stat_date')}
SELECT {sql_columns(spec, _facts_known(**more))} FROM report"""


def _report_pages(spec: TableSpec, rows: DataFrame, number: str) -> DataFrame:
    """Report rows as pages of text, cut by a numeric id."""
    text = [
        F.col(f.column).cast("string").alias(f.api)
        for f in spec.fields
        if f.column in rows.columns and f.kind != "json"
    ]
    click = F.struct(F.lit("click").alias("action_type"), F.col("clicks").cast("string").alias("value"))
    return L.report_pages(rows, F.struct(*text, F.array(click).alias("actions")), number)


def _typed_facts(spark: SparkSession, spec: TableSpec, parts: Iterable[DataFrame], number: str = "ad_id") -> DataFrame:
    """Parts of a report's rows, no page in two of them, to landed pages and back through the typed scan."""
    pages = L.through_files(spark, (_report_pages(spec, rows, number) for rows in parts))
    return portable(scan_report(pages, L.report_runs(pages), spec))


AD_IDS = {
    c: c for c in ("ad_id", "ad_name", "ad_set_id", "ad_set_name", "campaign_id", "campaign_name")
}


@query("scan_report_ad", _fact_sql(T.AD_DAILY, AD_GRAIN, **AD_IDS))
def scan_report_ad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed_facts(spark, T.AD_DAILY, ad_reports(spark, sf_dir))


@query("scan_report_ad_market", _fact_sql(T.AD_MARKET_DAILY, AD_GRAIN + ", market", market="market", **AD_IDS))
def scan_report_ad_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed_facts(spark, T.AD_MARKET_DAILY, ad_reports(spark, sf_dir, ("market",)))


@query(
    "scan_report_ad_age_gender",
    _fact_sql(T.AD_AGE_GENDER_DAILY, AD_GRAIN + ", age, gender", age="age", gender="gender", **AD_IDS),
)
def scan_report_ad_age_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed_facts(spark, T.AD_AGE_GENDER_DAILY, ad_reports(spark, sf_dir, ("age", "gender")))


@query(
    "scan_report_ad_set",
    _fact_sql(T.AD_SET_DAILY, "ad_account_id, campaign_id, ad_set_id", ad_set_id="ad_set_id", campaign_id="campaign_id"),
)
def scan_report_ad_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed_facts(spark, T.AD_SET_DAILY, [level_report(spark, sf_dir, "adset")], "campaign_id")


@query(
    "scan_report_campaign",
    _fact_sql(
        T.CAMPAIGN_DAILY,
        "ad_account_id, campaign_id, campaign_name, objective",
        **{c: c for c in ("campaign_id", "campaign_name", "objective")},
    ),
)
def scan_report_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = attach(level_report(spark, sf_dir, "campaign"), campaign_names(spark, sf_dir), ("ad_account_id", "campaign_id"))
    return _typed_facts(spark, T.CAMPAIGN_DAILY, [rows], "campaign_id")


@query(
    "arrival_order",
    f"""SELECT {ACCOUNT_OF_AD} AS ad_account_id, CAST(c_custkey AS VARCHAR) AS id FROM customer ORDER BY ad_account_id, c_custkey""",
)
def arrival_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = in_page_order(scan_pages(L.ad_listing(spark, sf_dir)))
    return items.select("ad_account_id", F.get_json_object("item", "$.id").alias("id"))


@query(
    "arrival_numbers",
    f"""SELECT {ACCOUNT_OF_AD} AS ad_account_id, CAST(c_custkey AS VARCHAR) AS id,
       CAST(row_number() OVER (ORDER BY {ACCOUNT_OF_AD}, c_custkey) AS BIGINT) AS number FROM customer""",
)
def arrival_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listed object's number in the order of arrival, without gaps."""
    items = scan_pages(L.ad_listing(spark, sf_dir)).select("ad_account_id", "run_id", "page_no", "pos", F.get_json_object("item", "$.id").alias("id"))
    return numbered(items, ("ad_account_id", "run_id", "page_no", "pos")).select("ad_account_id", "id", "number")


@query(
    "append_listings",
    f"""SELECT {ACCOUNT_OF_AD} AS ad_account_id, 'ads' AS run_id, CAST(c_custkey AS VARCHAR) AS id FROM customer
UNION ALL SELECT 'act_' || CAST(p_partkey % 3 AS VARCHAR), 'adsets', CAST(p_partkey AS VARCHAR) FROM part
UNION ALL SELECT {L.REGION_ACCOUNT_SQL.format("s_nationkey")}, 'campaigns', CAST(s_suppkey AS VARCHAR) FROM supplier""",
)
def append_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all runs and accounts together, repeats kept."""
    pages = append(L.ad_listing(spark, sf_dir), L.ad_set_listing(spark, sf_dir), L.campaign_listing(spark, sf_dir))
    id_ = F.get_json_object("item", "$.id").alias("id")
    return scan_pages(pages).select("ad_account_id", "run_id", id_)


@query("table_scan", "SELECT o_orderkey, o_custkey FROM orders")
def table_scan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    return table_scan(spark, "orders").select("o_orderkey", "o_custkey")


@query(
    "unpack_batches",
    f"WITH {L.BATCH_SQL} SELECT batch_no, pos, code, error, run_id FROM responses",
)
def unpack_batches_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = unpack_batches(L.batch_log(spark, sf_dir))
    return rows.select("batch_no", "pos", "code", "error", F.get_json_object("body", "$.report_run_id").alias("run_id"))


@query(
    "pair_responses",
    f"""WITH {L.BATCH_SQL}
SELECT r.batch_no, r.pos, 'act_' || CAST(e.user_id AS VARCHAR) AS ad_account_id, r.code, r.run_id,
       CASE WHEN r.error <> '' THEN r.error WHEN r.run_id IS NULL THEN 'no report_run_id in response' ELSE '' END AS failure
FROM responses r JOIN events e USING (event_id)""",
)
def pair_responses_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    paired = _paired(spark, sf_dir)
    return started_runs(paired).select("batch_no", "pos", "ad_account_id", "code", "run_id", "failure")


def _paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    requests = table(spark, sf_dir, "events").select(
        L.div(key, L.BATCH).alias("batch_no"),
        (key % L.BATCH).cast("int").alias("pos"),
        F.concat(F.lit("act_"), F.col("user_id").cast("string")).alias("ad_account_id"),
        key.alias("seq"),
    )
    return pair_responses(requests, unpack_batches(L.batch_log(spark, sf_dir)))


@query(
    "failed_submissions",
    f"""WITH {L.BATCH_SQL}
SELECT 'act_' || CAST(e.user_id AS VARCHAR) AS ad_account_id, CAST(event_id AS BIGINT) AS seq,
       CASE WHEN r.error <> '' THEN r.error ELSE 'no report_run_id in response' END AS failure
FROM responses r JOIN events e USING (event_id) WHERE r.error <> '' OR r.run_id IS NULL""",
)
def failed_submissions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failed_submissions(_paired(spark, sf_dir)).select("ad_account_id", "seq", "failure")


@query(
    "last_submission",
    f"""WITH {L.BATCH_SQL}
SELECT 'act_' || CAST(e.user_id AS VARCHAR) AS ad_account_id, arg_max(r.run_id, event_id) AS run_id
FROM responses r JOIN events e USING (event_id) WHERE r.error = '' AND r.run_id IS NOT NULL GROUP BY ALL""",
)
def last_submission_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_submission(started_runs(_paired(spark, sf_dir)).where("failure = ''"))


@query(
    "error_detail",
    f"""
SELECT event_id, CASE event_id % 4
  WHEN 0 THEN '{DETAIL_LEAD_IN}no ' || event_type || ', user_message=' || event_type || ', type=T, code=' || CAST(user_id AS VARCHAR)
              || ', error_subcode=7, fbtrace_id=' || CAST(event_id AS VARCHAR)
  WHEN 1 THEN '{DETAIL_LEAD_IN}code=' || CAST(user_id AS VARCHAR)
  ELSE '' END AS detail
FROM events""",
)
def error_detail_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_id") % 4
    full = F.struct(
        F.concat(F.lit("no "), F.col("event_type")).alias("message"),
        F.col("event_type").alias("error_user_msg"),
        F.lit("T").alias("type"),
        F.col("user_id").alias("code"),
        F.lit(7).alias("error_subcode"),
        F.col("event_id").cast("string").alias("fbtrace_id"),
    )
    slim = F.struct(F.lit("").alias("message"), F.col("user_id").alias("code"))
    body = (
        F.when(kind == 0, F.to_json(F.struct(full.alias("error"))))
        .when(kind == 1, F.to_json(F.struct(slim.alias("error"))))
        .when(kind == 2, F.concat(F.lit("["), F.to_json(F.struct(full.alias("error"))), F.lit("]")))
        .otherwise(F.col("props"))
    )
    return table(spark, sf_dir, "events").select("event_id", error_detail(body).alias("detail"))


@query(
    "select_expressions",
    """SELECT c_custkey, upper(c_name) AS c_name, CAST(c_acctbal AS BIGINT) AS balance FROM
       (SELECT c_custkey, c_name, trunc(c_acctbal) AS c_acctbal FROM customer)""",
)
def select_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["c_custkey", ("c_name", "upper(c_name)"), ("balance", "CAST(c_acctbal AS BIGINT)")]
    return select_as(table(spark, sf_dir, "customer"), columns)


@query(
    "json_path_read",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events",
)
def json_path_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value inside a JSON column by its path."""
    k = F.variant_get(F.parse_json("props"), "$.k", "double").alias("k")
    return table(spark, sf_dir, "events").select("event_id", k)


def _listed_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.through_files(spark, L.ad_listing(spark, sf_dir))


@query(
    "variant_paths",
    f"""
SELECT {ACCOUNT_OF_AD} AS ad_account_id, CAST(c_custkey AS VARCHAR) AS ad_id, c_mktsegment AS kind,
       CAST(c_nationkey AS BIGINT) AS first_part, CAST(c_custkey AS BIGINT) AS second_part, CAST(NULL AS VARCHAR) AS missing
FROM customer""",
)
def variant_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ads upserted into a table that stores nested values as VARIANT, read by path without parsing any text."""
    target = ParquetTable(T.ADS.with_variants(), scratch_path(spark, "ads"))
    upsert(scan_entities(_listed_ads(spark, sf_dir), target.spec), target)
    return at_paths(
        target.read(spark),
        ("ad_account_id", "ad_id"),
        {
            "kind": ("creative_json", "$.kind", "string"),
            "first_part": ("creative_json", "$.parts[0]", "bigint"),
            "second_part": ("creative_json", "$.parts[1]", "bigint"),
            "missing": ("creative_json", "$.parts[2].name", "string"),
        },
    )


# Keys of the listed ads with the condition they occur under and the type of their values.
AD_KEYS = (
    ("id", "true", "STRING"),
    ("name", "true", "STRING"),
    ("adset_id", "true", "STRING"),
    ("campaign_id", "true", "BIGINT"),
    ("bid_amount", "true", "STRING"),
    ("priority", "c_custkey % 3 > 0", "BIGINT"),
    ("created_time", "true", "STRING"),
    ("updated_time", "true", "STRING"),
    ("is_autobid", "true", "BOOLEAN"),
    ("effective_status", "c_custkey % 5 <= 2", "STRING"),
    ("creative", "true", "OBJECT<kind: STRING, parts: ARRAY<BIGINT>>"),
    ("recommendations", "c_custkey % 4 = 0", "ARRAY<VOID>"),
    ("account_id", "true", "STRING"),
)
DECLARED_ADS = {f.api for f in T.ADS.fields}


def _key_sql(keys, flag: bool) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {ACCOUNT_OF_AD} AS ad_account_id, '{key}' AS key, {f'{key in DECLARED_ADS} AS declared, ' if flag else ''}"
        f"CAST(count(*) AS BIGINT) AS objects, CAST(0 AS BIGINT) AS nulls, '{shape}' AS shape FROM customer WHERE {when} GROUP BY ALL"
        for key, when, shape in keys
    )


@query("landed_keys", _key_sql(AD_KEYS, True))
def landed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key that the listed ads hold, per account."""
    return key_audit(scan_pages(_listed_ads(spark, sf_dir)), T.ADS, ("ad_account_id",))


@query("undeclared_keys", _key_sql([k for k in AD_KEYS if k[0] not in DECLARED_ADS], False))
def undeclared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that the service sends and no column takes."""
    return undeclared_keys(scan_pages(_listed_ads(spark, sf_dir)), T.ADS, ("ad_account_id",))
