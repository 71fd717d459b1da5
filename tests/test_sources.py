import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from spendlake.functions.errors import DETAIL_LEAD_IN, error_detail
from spendlake.operators.runs import NO_RUN_ID, started_runs
from spendlake.plans.tables import AD_DAILY, ADS
from spendlake.sources.batches import unpack_batches
from spendlake.sources.pages import (
    LANDED_PAGE,
    entity_ids,
    in_page_order,
    page_chain_check,
    read_landed,
    scan_accounts,
    scan_entities,
    scan_pages,
    scan_report,
)

AT = datetime(2024, 2, 1, tzinfo=timezone.utc)


def page(account, run, number, data, following=None, cursors=True):
    body = {} if data is None else {"data": data}
    body["paging"] = {"cursors": {"after": "x"}} if cursors else {}
    if following:
        body["paging"]["next"] = following
    return (account, run, number, AT, json.dumps(body))


def landed(spark, *pages):
    return spark.createDataFrame(list(pages), LANDED_PAGE)


def test_pages_in_order_and_missing_data(spark):
    pages = landed(
        spark,
        page("act_1", "r", 2, None, "n"),
        page("act_1", "r", 1, [{"id": "b"}, {"id": "a"}], "n"),
        page("act_1", "r", 3, [{"id": "c"}]),
    )
    items = in_page_order(scan_pages(pages)).collect()
    assert [json.loads(r["item"])["id"] for r in items] == ["b", "a", "c"]
    assert [(r.page_no, r.pos) for r in items] == [(1, 0), (1, 1), (3, 0)]
    assert [r.id for r in entity_ids(pages).orderBy("id").collect()] == ["a", "b", "c"]
    assert sorted(r.ad_account_id for r in scan_accounts(pages).collect()) == ["a", "b", "c"]


def test_unreadable_page_stops_the_scan(spark):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        scan_pages(landed(spark, ("a", "r", 1, AT, '{"data": ['))).collect()


def test_chain_check(spark):
    pages = landed(
        spark,
        *(page("ok", "r", n, [], "n" if n < 3 else None) for n in (1, 2, 3)),
        *(page("gap", "r", n, [], "n" if n < 3 else None) for n in (1, 3)),
        page("headless", "r", 2, []),
        page("open", "r", 1, [], "n"),
        *(page("early", "r", n, [], "n" if n == 2 else None) for n in (1, 2)),
        *(page("twice", "r", 1, []) for _ in range(2)),
        *(page("two-ends", "r", n, []) for n in (1, 2)),
        page("no-paging", "r", 1, [], cursors=False),
    )
    complete = {r.ad_account_id: r.complete for r in page_chain_check(pages).collect()}
    assert complete == {
        "ok": True, "gap": False, "headless": False, "open": False,
        "early": False, "twice": False, "two-ends": False, "no-paging": True,
    }


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_landed_formats(spark, folder, fmt):
    pages = landed(spark, page("act_1", "r", 1, [{"id": "é"}]))
    pages.write.format(fmt).save(f"{folder}/pages")
    back = read_landed(spark, f"{folder}/pages", fmt)
    assert back.schema.names == LANDED_PAGE.names
    assert back.collect() == pages.collect()


def test_landed_as_one_file_per_page(spark, folder, tmp_path):
    where = tmp_path / "pages" / "ad_account_id=act_1" / "run_id=r" / "page_no=1" / "landed_at=2024-02-01 00%3A00%3A00"
    where.mkdir(parents=True)
    (where / "body.json").write_text('{"data":\n [{"id": "1"}]\n}')
    rows = scan_pages(read_landed(spark, f"{folder}/pages", "text")).collect()
    assert [(r.ad_account_id, r.run_id, r.page_no, r.pos) for r in rows] == [("act_1", "r", 1, 0)]


def test_report_rows_carry_the_runs_account(spark):
    record = {"ad_id": "1", "adset_id": "2", "date_start": "2024-01-05", "spend": "1.25", "impressions": "10.0", "actions": [{"action_type": "x", "value": "1"}]}
    pages = landed(spark, page("?", "r1", 1, [record]), page("?", "unknown", 1, [record]))
    runs = spark.createDataFrame([("r1", "act_7")], "run_id string, ad_account_id string")
    rows = scan_report(pages, runs, AD_DAILY).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.ad_account_id, row.ad_id, row.ad_set_id, row.spend, row.impressions) == ("act_7", "1", "2", 1.25, 10)
    assert json.loads(row.actions_json) == record["actions"] and str(row.stat_date) == "2024-01-05" and row.clicks is None


def test_bodies_stay_where_they_are_read_if_the_run_list_is_short(spark, monkeypatch):
    record = {"ad_id": "1", "date_start": "2024-01-05", "spend": "1.25"}
    landed_pages = landed(spark, *(page("?", f"r{i}", 1, [record]) for i in range(4)))
    runs = spark.createDataFrame([("r1", "act_7"), ("r3", None), (None, "act_8")], "run_id string, ad_account_id string")

    def plan_and_rows():
        rows = scan_report(landed_pages, runs, AD_DAILY).select("ad_account_id", "ad_id")
        return rows._jdf.queryExecution().sparkPlan().toString(), sorted(map(tuple, rows.collect()), key=str)

    # As if the optimiser took the list for a long one.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan, rows = plan_and_rows()
        assert "BroadcastHashJoin" in plan
        monkeypatch.setattr("spendlake.sources.pages.RUN_LIST_BYTES", 64)
        long_plan, long_rows = plan_and_rows()
        assert "SortMergeJoin" in long_plan and "BroadcastHashJoin" not in long_plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows == long_rows == [("act_7", "1"), (None, "1")]


def test_entities_created_in_window(spark):
    times = {
        "first": "2024-01-05T00:00:00+0000", "last": "2024-01-06T23:59:59+0000",
        "before": "2024-01-04T23:59:59+0000", "after": "2024-01-07T00:00:00+0000",
        "fraction before": "2024-01-04T23:59:59.500+0000", "last fraction": "2024-01-06T23:59:59.900+0000",
        "local": "2024-01-06T20:00:00-0800",
    }
    pages = landed(spark, page("act_1", "ads", 1, [{"id": k, "created_time": v} for k, v in times.items()]))
    rows = scan_entities(pages, ADS, ("2024-01-05", "2024-01-06")).collect()
    assert {r.ad_id for r in rows} == {"first", "last", "last fraction"}


def test_batches(spark):
    entries = [
        {"code": 200, "body": json.dumps({"report_run_id": 123})},
        None,
        {"code": 400, "body": json.dumps({"error": {"message": "m", "error_user_msg": "u", "type": "T", "code": 0, "error_subcode": 5, "fbtrace_id": "f"}})},
        {"code": 200, "body": "<html>"},
        {"body": json.dumps({"report_run_id": "9"})},
        {"code": 500},
        {"code": 403, "body": json.dumps({"error": {"message": "", "type": "T", "fbtrace_id": ""}})},
        {"code": 200, "body": json.dumps({"report_run_id": 0})},
        {"code": 200, "body": json.dumps({"report_run_id": "0"})},
    ]
    rows = unpack_batches(spark.createDataFrame([(1, json.dumps(entries))], "batch_no int, body string"))
    got = rows.orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(9))
    assert [r.code for r in got] == [200, 504, 400, 200, None, 500, 403, 200, 200]
    assert [r.error for r in got] == [
        "", "batch sub-request timed out (null entry)", "HTTP 400 -- m, u, type=T, code=0, error_subcode=5, fbtrace_id=f",
        "", "HTTP None", "HTTP 500", "HTTP 403 -- type=T", "", "",
    ]
    assert [json.loads(r.body) for r in got][3:6] == [{}, {"report_run_id": "9"}, {}]
    started = started_runs(rows).orderBy("pos").collect()
    assert [r.run_id for r in started] == ["123", None, None, None, "9", None, None, None, "0"]
    assert [r.failure for r in started][3] == NO_RUN_ID and started[0].failure == "" and started[7].failure == NO_RUN_ID


@pytest.mark.parametrize(
    "body, detail",
    [
        ('{"error": {"message": "m", "error_user_msg": "u", "type": "T", "code": 1, "error_subcode": 2, "fbtrace_id": "f"}}',
         "m, user_message=u, type=T, code=1, error_subcode=2, fbtrace_id=f"),
        ('{"error": {"code": 0}}', "code=0"),
        ('{"error": {"message": "", "type": ""}}', ""),
        ('{"error": {}}', ""),
        ('{"error": null}', ""),
        ('{"data": []}', ""),
        ('[{"error": {"message": "m"}}]', ""),
        ("oops", ""),
        ("", ""),
        (None, ""),
    ],
)
def test_error_detail(spark, body, detail):
    rows = spark.createDataFrame([(body,)], "body string")
    assert rows.select(error_detail(F.col("body"))).first()[0] == (DETAIL_LEAD_IN + detail if detail else "")
