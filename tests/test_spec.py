import pytest
from pyspark.sql import types as T

from spendlake.plans import tables
from spendlake.plans.spec import FieldSpec, TableSpec


@pytest.mark.parametrize(
    "spec, count",
    [
        (tables.AD_DAILY, 23),
        (tables.AD_SET_DAILY, 21),
        (tables.CAMPAIGN_DAILY, 20),
        (tables.AD_MARKET_DAILY, 24),
        (tables.AD_AGE_GENDER_DAILY, 25),
        (tables.CAMPAIGNS, 40),
        (tables.AD_SETS, 62),
        (tables.ADS, 34),
    ],
)
def test_declared_columns(spec, count):
    assert len(spec.fields) == count
    assert spec.columns[0] == "ad_account_id" and spec.columns[-1] == "ingested_at"
    assert spec.schema.names == spec.columns
    assert not spec.schema["ad_account_id"].nullable and not spec.schema["ingested_at"].nullable


def test_types_and_ddl():
    spec = TableSpec.of(
        "t",
        [("a", "a_col", "bigint"), ("d", "day", "date"), ("j", "j_json", "json"), ("b", "b", "boolean"), ("t", "at", "timestamp")],
        keys=("ad_account_id",),
        day_of="day",
    )
    assert spec.ddl == (
        "ad_account_id STRING NOT NULL,a_col BIGINT,day DATE,j_json STRING,b BOOLEAN,at TIMESTAMP,ingested_at TIMESTAMP NOT NULL"
    )
    kinds = {f.name: f.dataType for f in spec.input_schema.fields}
    assert kinds == {"a": T.StringType(), "d": T.StringType(), "j": T.VariantType(), "b": T.VariantType(), "t": T.StringType()}


def test_unknown_kind_fails_at_definition():
    with pytest.raises(ValueError, match="unknown kind 'money'"):
        FieldSpec("a", "a", "money")


def test_repeated_and_missing_columns_fail_at_definition():
    with pytest.raises(ValueError, match="twice"):
        TableSpec.of("t", [("a", "x", "string"), ("b", "x", "string")], keys=("x",), day_of="x")
    with pytest.raises(ValueError, match="not declared"):
        TableSpec.of("t", [("a", "x", "string")], keys=("y",), day_of="x")


def test_breakdowns_are_not_requested():
    assert "comscore_market" not in tables.AD_MARKET_DAILY.requested_fields
    assert len(tables.AD_MARKET_DAILY.requested_fields) == 23
    assert not {"age", "gender"} & set(tables.AD_AGE_GENDER_DAILY.requested_fields)
    assert "date_start" in tables.AD_DAILY.requested_fields


def test_other_id_column_and_added_field():
    spec = TableSpec.of("t", [("d", "day", "date")], keys=("owner",), day_of="day", id_column="owner")
    assert spec.columns == ["owner", "day", "ingested_at"]
    assert spec.with_field("x", "x_json", "json").columns == ["owner", "day", "x_json", "ingested_at"]


def test_metrics_are_the_same_in_all_facts():
    metrics = [f.column for f in tables.AD_DAILY.fields][-16:]
    assert all([f.column for f in t.fields][-16:] == metrics for t in tables.FACTS.values())
