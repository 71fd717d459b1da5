import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from spendlake.functions.casts import to_bigint, to_double
from spendlake.operators.project import conform, project, select_as
from spendlake.plans.spec import TableSpec

SPEC = TableSpec.of(
    "t",
    [
        ("s", "s", "string"),
        ("n", "n", "double"),
        ("i", "i", "bigint"),
        ("b", "b", "boolean"),
        ("d", "d", "date"),
        ("t", "t", "timestamp"),
        ("j", "j_json", "json"),
    ],
    keys=("s",),
    day_of="d",
)
NOW = datetime(2024, 2, 1, tzinfo=timezone.utc)


def typed(spark, *texts, **options):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "no int, text string")
    parsed = rows.select("no", F.from_json("text", SPEC.input_schema, {"mode": "FAILFAST"}).alias("item"))
    out = project(parsed, SPEC, account="act_1", ingested_at=NOW, keep=("no",), **options)
    return out.orderBy("no").collect()


def column(spark, name, *values):
    api = name.removesuffix("_json")
    return [r[name] for r in typed(spark, *(json.dumps({api: v}) for v in values), "{}")]


def test_bigint(spark):
    assert column(spark, "i", "123", "123.9", "-1.9", "", None, 7, 7.9) == [123, 123, -1, None, None, 7, 7, None]


@pytest.mark.parametrize("bad", ["abc", "nan", "inf", "1e30", "12f"])
def test_bad_bigint_raises(spark, bad):
    with pytest.raises(Exception, match="i: not a"):
        column(spark, "i", bad)


def test_double(spark):
    assert column(spark, "n", "1.5", "", None, 2, "1e3", " 4 ") == [1.5, None, None, 2.0, 1000.0, 4.0, None]


@pytest.mark.parametrize("bad", ["abc", "1.5d", "1.5F", "1,5", "0x10"])
def test_bad_double_raises(spark, bad):
    with pytest.raises(Exception, match="n: not a number"):
        column(spark, "n", bad)


def test_numbers_are_strict_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="n: not a number"):
            column(spark, "n", "abc")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_boolean(spark):
    assert column(spark, "b", True, False, None) == [True, False, None, None]


@pytest.mark.parametrize("bad", ["true", 1, [], "x"])
def test_bad_boolean_raises(spark, bad):
    with pytest.raises(Exception, match="b: not a JSON boolean"):
        column(spark, "b", bad)


def test_string_takes_scalars_and_nested_values(spark):
    assert column(spark, "s", "x", 5, True, "", None) == ["x", "5", "true", "", None, None]
    assert json.loads(column(spark, "s", [1, 2])[0]) == [1, 2]


def test_date_is_lenient(spark):
    assert column(spark, "d", "2024-01-05", "2024-02-30", "", None) == [date(2024, 1, 5), None, None, None, None]


def test_timestamp_offsets(spark):
    texts = [json.dumps({"t": v}) for v in ("2023-11-14T22:13:20+0000", "2023-11-14T22:13:20-0800", "", "soon")]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "no int, text string")
    parsed = rows.select("no", F.from_json("text", SPEC.input_schema).alias("item"))
    out = project(parsed, SPEC, account="a", ingested_at=NOW, keep=("no",))
    assert [r[0] for r in out.orderBy("no").select(F.unix_seconds("t")).collect()] == [1700000000, 1700028800, None, None]


def test_json_keeps_the_value(spark):
    values = [[{"a": 1}], {}, [], None, {"k": "é€"}, [1, None, "x"], "bare", "null", 1.5, True, {"b": {"c": None}}]
    got = column(spark, "j_json", *values)
    assert got[-1] is None and got[3] is None
    for want, text in zip(values, got):
        if want is not None:
            assert json.loads(text) == want


def test_repeated_key_keeps_the_last(spark):
    assert [r.j_json for r in typed(spark, '{"j": {"a": 1, "a": 2}}')] == ['{"a":2}']


def test_column_order_literals_and_overrides(spark):
    rows = typed(spark, '{"s": "x", "unknown": 1}', overrides={"s": F.lit("fixed")})
    assert list(rows[0].asDict())[:-1] == SPEC.columns
    assert rows[0].ad_account_id == "act_1" and rows[0].s == "fixed"
    with pytest.raises(ValueError, match="no such column"):
        typed(spark, "{}", overrides={"zz": F.lit(1)})


def test_conform_fills_absent_columns(spark):
    rows = conform(spark.range(1).select(F.lit("act_1").alias("ad_account_id"), F.lit(NOW).alias("ingested_at")), SPEC)
    assert rows.columns == SPEC.columns and rows.first().i is None


def test_select_expressions(spark):
    out = select_as(spark.range(1), ["id", ("twice", "id * 2"), ("day", "CAST('2024-01-01' AS date)")])
    assert out.columns == ["id", "twice", "day"] and out.first().day == date(2024, 1, 1)


def test_a_number_is_read_once_a_column(spark):
    """Each conversion stands once in the plan; what is no number, or only Java's, raises as it did."""
    df = spark.createDataFrame([("7",), ("",), (None,), (" 2.9 ",), ("inf",), ("1.5d\t",)], "t string")
    plan = df.select(to_bigint(F.col("t"), "t"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast(") == 2
    assert [r[0] for r in df.select(to_double(F.col("t"))).collect()] == [7.0, None, None, 2.9, float("inf"), 1.5]
    for text in ("x", "1.5d", "2F  ", " ", "nan1"):
        with pytest.raises(Exception, match="t: not a number"):
            spark.createDataFrame([(text,)], "t string").select(to_double(F.col("t"), "t")).collect()
    for text in ("1e30", "NaN", "inf"):
        with pytest.raises(Exception, match="t: not a 64-bit whole number"):
            spark.createDataFrame([(text,)], "t string").select(to_bigint(F.col("t"), "t")).collect()
