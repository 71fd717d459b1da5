from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from spendlake import storage
from spendlake.operators.upsert import CatalogTable, DuplicateKeys, ParquetTable, latest_per_key, merge_staged, replace, stage, upsert
from spendlake.plans.spec import TableSpec

FACT = TableSpec.of(
    "fact",
    [("ad_id", "ad_id", "string"), ("market", "market", "string"), ("date_start", "stat_date", "date"), ("spend", "spend", "double")],
    keys=("ad_account_id", "ad_id", "market", "stat_date"),
    day_of="stat_date",
)
DIM = TableSpec.of(
    "dim",
    [("id", "ad_id", "string"), ("name", "name", "string"), ("created_time", "created_time", "timestamp")],
    keys=("ad_account_id", "ad_id"),
    day_of="created_time",
)
D = [date(2024, 1, d) for d in range(1, 10)]
T1, T2 = datetime(2024, 2, 1, tzinfo=timezone.utc), datetime(2024, 2, 2, tzinfo=timezone.utc)


def facts(spark, at, *rows):
    schema = "ad_id string, market string, stat_date date, spend double"
    return spark.createDataFrame(list(rows), schema).withColumns({"ad_account_id": F.lit("act_1"), "ingested_at": F.lit(at)})


def dims(spark, at, *rows):
    out = spark.createDataFrame(list(rows), "ad_id string, name string, created string")
    return out.withColumns({"ad_account_id": F.lit("act_1"), "ingested_at": F.lit(at), "created_time": F.col("created").cast("timestamp")})


def content(table, spark):
    names = [f.column for f in table.spec.fields if f.kind != "timestamp"]
    return sorted((tuple(r) for r in table.read(spark).select(*names).collect()), key=repr)


@pytest.fixture
def fact(folder):
    return ParquetTable(FACT, f"{folder}/fact")


@pytest.fixture
def dim(folder):
    return ParquetTable(DIM, f"{folder}/dim")


def test_insert_replace_keep(spark, fact):
    upsert(facts(spark, T1, ("a", "m", D[0], 1.0), ("b", "m", D[0], 2.0), ("a", "m", D[1], 3.0), ("c", "m", D[2], 4.0)), fact)
    upsert(facts(spark, T2, ("a", "m", D[0], None), ("new", "m", D[1], 5.0), ("late", "m", D[4], 6.0)), fact)
    assert content(fact, spark) == sorted(
        [("a", "m", D[0], None), ("b", "m", D[0], 2.0), ("a", "m", D[1], 3.0), ("new", "m", D[1], 5.0), ("c", "m", D[2], 4.0), ("late", "m", D[4], 6.0)],
        key=repr,
    )
    at = {r.ad_id: r.at for r in fact.read(spark).where(F.col("stat_date") == D[0]).select("ad_id", F.unix_seconds("ingested_at").alias("at")).collect()}
    assert at == {"a": int(T2.timestamp()), "b": int(T1.timestamp())}
    assert fact.read(spark).schema.names == FACT.columns
    assert storage.folders(spark, f"{fact.root}/_staging") == []


def test_repeating_changes_nothing(spark, fact):
    first = facts(spark, T1, ("a", "m", D[0], 1.0), ("b", "m", D[1], 2.0))
    again = facts(spark, T2, ("a", "m", D[0], 9.0), ("c", "m", D[1], 3.0))
    upsert(first, fact)
    upsert(again, fact)
    once = content(fact, spark)
    upsert(again, fact)
    assert content(fact, spark) == once


def test_small_source_and_small_rest_take_both_ways(spark, fact):
    """Few rows into many, then many rows into few: the rows to keep are picked by either key list."""
    upsert(facts(spark, T1, *((str(i), "m", D[0], float(i)) for i in range(50))), fact)
    upsert(facts(spark, T2, ("0", "m", D[0], -1.0)), fact)
    upsert(facts(spark, T2, *((str(i), "m", D[0], -2.0) for i in range(1, 49))), fact)
    assert {r[0]: r[3] for r in content(fact, spark)} == {"0": -1.0, "49": 49.0, **{str(i): -2.0 for i in range(1, 49)}}


def test_only_days_not_seen_before(spark, fact):
    upsert(facts(spark, T1, ("a", "m", D[0], 1.0)), fact)
    upsert(facts(spark, T2, ("a", "m", D[3], 2.0)), fact)
    assert content(fact, spark) == [("a", "m", D[0], 1.0), ("a", "m", D[3], 2.0)]


def test_hot_day_and_hot_key_history(spark, fact):
    """Most rows on one day, revised in part: every row is still there once."""
    upsert(facts(spark, T1, *((str(i), "m", D[0] if i % 10 else D[1], 1.0) for i in range(2000))), fact)
    upsert(facts(spark, T2, *((str(i), "m", D[0], 2.0) for i in range(2000) if i % 10 and i % 3 == 0)), fact)
    assert fact.read(spark).count() == 2000
    assert fact.read(spark).where("spend = 2.0").count() == sum(1 for i in range(2000) if i % 10 and i % 3 == 0)


def test_merge_statement_is_what_a_catalog_table_gets(spark, folder):
    """No catalog here has row-level operations; the refusal shows that the MERGE was formed and sent."""
    spark.sql(f"CREATE TABLE merge_probe ({DIM.ddl}) USING parquet LOCATION '{folder}/probe'")
    try:
        for null_safe in (False, True):
            with pytest.raises(Exception, match="does not support MERGE INTO TABLE"):
                upsert(dims(spark, T1, ("1", "one", "2024-01-01T10:00:00Z")), CatalogTable(DIM, "merge_probe"), null_safe=null_safe)
        upsert(dims(spark, T1).limit(0), CatalogTable(DIM, "merge_probe"))
    finally:
        spark.sql("DROP TABLE merge_probe")


def test_null_in_key_never_matches(spark, fact):
    rows = [("a", None, D[0], 1.0), ("b", "m", D[0], 2.0), ("a", None, None, 3.0)]
    upsert(facts(spark, T1, *rows), fact)
    upsert(facts(spark, T2, *rows), fact)
    assert [r[0] for r in content(fact, spark)] == ["a", "a", "a", "a", "b"]


def test_null_safe_matches(spark, fact):
    rows = [("a", None, D[0], 1.0), ("b", "m", D[0], 2.0), ("a", None, None, 3.0)]
    upsert(facts(spark, T1, *rows), fact, null_safe=True)
    upsert(facts(spark, T2, *((a, m, d, s + 1) for a, m, d, s in rows)), fact, null_safe=True)
    assert sorted(r[3] for r in content(fact, spark)) == [2.0, 3.0, 4.0]


def test_duplicate_source_key_raises_and_leaves_the_table(spark, fact):
    upsert(facts(spark, T1, ("a", "m", D[0], 1.0)), fact)
    with pytest.raises(DuplicateKeys, match="act_1"):
        upsert(facts(spark, T2, ("a", "m", D[0], 2.0), ("a", "m", D[0], 3.0)), fact)
    assert content(fact, spark) == [("a", "m", D[0], 1.0)]
    upsert(facts(spark, T2, ("a", "m", D[0], 2.0), ("a", "m", D[0], 3.0)), fact, newest_first=[F.col("spend").desc()])
    assert content(fact, spark) == [("a", "m", D[0], 3.0)]


def test_dedupe_keeps_null_key_rows(spark):
    rows = facts(spark, T1, ("a", None, D[0], 1.0), ("a", None, D[0], 2.0), ("b", "m", D[0], 1.0), ("b", "m", D[0], 2.0))
    kept = latest_per_key(rows, FACT.keys, [F.col("spend").desc()])
    assert sorted((r.ad_id, r.spend) for r in kept.collect()) == [("a", 1.0), ("a", 2.0), ("b", 2.0)]
    assert latest_per_key(rows, FACT.keys, [F.col("spend").desc()], null_safe=True).count() == 2


def test_empty_source_creates_nothing(spark, fact):
    upsert(facts(spark, T1).limit(0), fact)
    assert not fact.exists(spark)
    upsert(facts(spark, T1, ("a", "m", D[0], 1.0)), fact)
    upsert(facts(spark, T1).limit(0), fact)
    assert len(content(fact, spark)) == 1


def test_failed_staging_leaves_the_table(spark, fact):
    upsert(facts(spark, T1, ("a", "m", D[0], 1.0)), fact)
    broken = facts(spark, T2, ("a", "m", D[0], 2.0)).withColumn("spend", F.raise_error(F.lit("cannot read")).cast("double"))
    with pytest.raises(Exception, match="cannot read"):
        upsert(broken, fact)
    assert content(fact, spark) == [("a", "m", D[0], 1.0)]


def test_dimension_revised_in_place(spark, dim):
    upsert(dims(spark, T1, ("1", "one", "2024-01-01T10:00:00Z"), ("2", "two", "2024-01-01T11:00:00Z"), ("3", "three", "2024-01-05T00:00:00Z")), dim)
    upsert(dims(spark, T2, ("1", "uno", "2024-01-01T10:00:00Z")), dim)
    assert content(dim, spark) == [("1", "uno"), ("2", "two"), ("3", "three")]
    assert dim.versions(spark) == [1]


def test_dimension_that_changes_day_is_not_doubled(spark, dim):
    upsert(dims(spark, T1, ("1", "one", "2024-01-01T10:00:00Z"), ("2", "two", "2024-01-02T10:00:00Z")), dim)
    upsert(dims(spark, T2, ("1", "uno", "2024-01-03T10:00:00Z")), dim)
    assert content(dim, spark) == [("1", "uno"), ("2", "two")]
    assert dim.versions(spark) == [1, 2]
    upsert(dims(spark, T2, ("1", "eins", "2024-01-02T10:00:00Z")), dim)
    assert content(dim, spark) == [("1", "eins"), ("2", "two")]
    assert dim.versions(spark) == [2, 3]


def test_dimension_without_creation_time(spark, dim):
    upsert(dims(spark, T1, ("1", "one", None), ("2", "two", "2024-01-02T10:00:00Z")), dim)
    upsert(dims(spark, T2, ("1", "uno", "2024-01-02T10:00:00Z")), dim)
    upsert(dims(spark, T2, ("2", "dos", None)), dim)
    assert content(dim, spark) == [("1", "uno"), ("2", "dos")]


def test_replace(spark, fact):
    assert replace(facts(spark, T1, ("a", "m", D[0], 1.0), ("b", "m", D[1], 2.0)), fact) == 2
    assert replace(facts(spark, T2, ("c", "m", D[2], 3.0)), fact) == 1
    assert content(fact, spark) == [("c", "m", D[2], 3.0)]


def test_unfinished_version_is_ignored(spark, fact, tmp_path):
    upsert(facts(spark, T1, ("a", "m", D[0], 1.0)), fact)
    (tmp_path / "fact" / "v-00000002" / "stat_date=2024-01-01").mkdir(parents=True)
    assert content(fact, spark) == [("a", "m", D[0], 1.0)]
    assert replace(facts(spark, T1, ("b", "m", D[0], 1.0)), fact) == 1


def test_read_window_prunes_partitions(spark, fact):
    upsert(facts(spark, T1, *(("a", "m", d, 1.0) for d in D)), fact)
    window = fact.read(spark, D[1], D[3])
    assert window.count() == 3
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(stat_date" in plan


def test_stage_then_merge(spark, fact):
    staged = stage(facts(spark, T1, ("a", "m", D[0], 1.0)), fact)
    assert staged.rows == 1 and not fact.exists(spark)
    merge_staged(staged)
    assert content(fact, spark) == [("a", "m", D[0], 1.0)]


def test_crash_while_publishing_loses_nothing(spark, fact, monkeypatch):
    """A day is deleted before its new files are moved in; the next upsert puts it right."""
    import spendlake.operators.upsert as module

    upsert(facts(spark, T1, ("kept", "m", D[0], 1.0), ("a", "m", D[0], 2.0)), fact)
    write = module._write_days

    def crash(df, path, day, keys, mode="error"):
        if mode == "dynamic":
            storage.delete(spark, f"{path}/stat_date=2024-01-01")
            raise RuntimeError("lost")
        write(df, path, day, keys, mode)

    monkeypatch.setattr(module, "_write_days", crash)
    again = facts(spark, T2, ("a", "m", D[0], 3.0))
    with pytest.raises(RuntimeError, match="lost"):
        upsert(again, fact)
    monkeypatch.setattr(module, "_write_days", write)
    upsert(again, fact)
    assert content(fact, spark) == [("a", "m", D[0], 3.0), ("kept", "m", D[0], 1.0)]
    assert storage.folders(spark, f"{fact.root}/_staging") == []


def test_failed_staging_leaves_no_files(spark, fact):
    with pytest.raises(DuplicateKeys):
        upsert(facts(spark, T1, ("a", "m", D[0], 1.0), ("a", "m", D[0], 2.0)), fact)
    assert storage.folders(spark, f"{fact.root}/_staging") == []
