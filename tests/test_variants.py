"""JSON stored as VARIANT: values by path, the scan that reads them, and the audit of keys."""

import json

import pytest
from pyspark.sql import functions as F

from spendlake.operators.upsert import ParquetTable, upsert
from spendlake.operators.variants import at_paths, key_audit, undeclared_keys
from spendlake.plans.spec import TableSpec
from spendlake.sources.pages import LANDED_PAGE, scan_entities, scan_pages

SPEC = TableSpec.of(
    "things",
    [("id", "thing_id", "string"), ("created", "created_time", "timestamp"), ("detail", "detail_json", "json")],
    keys=("ad_account_id", "thing_id"),
    day_of="created_time",
)


def pages(spark, *objects):
    body = json.dumps({"data": list(objects)})
    at = spark.sql("SELECT timestamp'2024-02-01 06:00:00' AS at").first()["at"]
    return spark.createDataFrame([("act_1", "r", 1, at, body)], LANDED_PAGE)


def thing(i, *detail):
    return {"id": str(i), "created": "2024-01-01T00:00:00+0000", **({"detail": detail[0]} if detail else {})}


def test_values_survive_the_table_and_are_read_by_path(spark, folder):
    spec = SPEC.with_variants()
    assert [f.kind for f in spec.fields] == ["string", "timestamp", "variant"] and SPEC.fields[2].kind == "json"
    table = ParquetTable(spec, f"{folder}/things")
    objects = [thing(1, {"a": {"b": [1, "two"]}}), thing(2, {"a": 5}), thing(3, None), thing(4), thing(5, "text"), thing(6, []), thing(7, {"a": {"b": []}})]
    for _ in range(2):
        upsert(scan_entities(pages(spark, *objects), spec), table)
    paths = {"first": ("detail_json", "$.a.b[0]", "bigint"), "second": ("detail_json", "$.a.b[1]", "string")}
    got = at_paths(table.read(spark), ("thing_id",), paths)
    assert sorted(map(tuple, got.collect())) == [("1", 1, "two"), *((str(i), None, None) for i in range(2, 8))]
    # The whole value is there, and a JSON null is NULL as it is with text.
    whole = table.read(spark).select("thing_id", F.to_json("detail_json").alias("j"))
    assert {r.thing_id: r.j and json.loads(r.j) for r in whole.collect()} == {o["id"]: o.get("detail") for o in objects}


def test_a_value_of_another_type_raises_unless_lenient(spark):
    rows = spark.sql("""SELECT 1 AS id, parse_json('{"a": "x"}') AS v""")
    paths = {"a": ("v", "$.a", "bigint")}
    assert at_paths(rows, ("id",), paths, lenient=True).first().a is None
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        at_paths(rows, ("id",), paths).collect()


def test_the_scan_reads_the_path_and_not_the_text(spark, folder):
    spark.sql("""SELECT id, parse_json('{"a": 1, "b": "x"}') AS v FROM range(3)""").write.parquet(f"{folder}/t")
    rows = at_paths(spark.read.parquet(f"{folder}/t"), (), {"a": ("v", "$.a", "bigint")})
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "parse_json" not in plan and "ReadSchema: struct<v:struct<0:bigint>>" in plan
    assert [r.a for r in rows.collect()] == [1, 1, 1]


def test_keys_are_counted_with_their_shape(spark):
    objects = [thing(1, {"x": 1}), thing(2, None), {**thing(3), "extra": 1}, {**thing(4), "extra": "t", "deep": {"k": [1.5]}}, {}]
    items = scan_pages(pages(spark, *objects))
    rows = {r.key: tuple(r)[2:] for r in key_audit(items, SPEC, ("ad_account_id",)).collect()}
    assert rows == {
        "id": (True, 4, 0, "STRING"),
        "created": (True, 4, 0, "STRING"),
        "detail": (True, 2, 1, "OBJECT<x: BIGINT>"),
        "extra": (False, 2, 0, "VARIANT"),
        "deep": (False, 1, 0, "OBJECT<k: ARRAY<DECIMAL(2,1)>>"),
    }
    assert {r.key for r in undeclared_keys(items, SPEC).collect()} == {"extra", "deep"}
    assert undeclared_keys(items, SPEC).columns == ["key", "objects", "nulls", "shape"]


def test_entries_without_keys_and_empty_input(spark):
    items = spark.createDataFrame([("[1]",), ("3",), (None,), ("{}",), ("null",)], "item string")
    assert key_audit(items, SPEC).count() == 0 and key_audit(items.limit(0), SPEC).count() == 0
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        key_audit(spark.createDataFrame([("{",)], "item string"), SPEC).collect()
