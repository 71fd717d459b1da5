"""Ad reports that are landed in waves: the same rows, and no more on disk than pages and one wave."""

import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from spendlake.queries import landing, registry, reports, sources
from spendlake.session import shared_dir

TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "customer": "c_custkey bigint, c_name string, c_mktsegment string, c_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string",
}
REPORTS = ("scan_report_ad", "scan_report_ad_market", "scan_report_ad_age_gender")


@pytest.fixture
def tables(spark, tmp_path):
    """Three ads to a page or fewer, an ad that is not known, an order twice, null keys, names and metrics."""
    rows = {
        "nation": [(k, f"N{k}", k % 2) for k in range(4)],
        "supplier": [(k, k % 4) for k in range(5)] + [(5, None)],
        "customer": [(k, None if k == 40 else f"c{k}", "S", k % 4) for k in range(0, 2000, 40)],
        "orders": [(k, None if k == 7 else 777 if k == 8 else k % 50 * 40, "OF"[k % 2], datetime(1995, 1, 1 + k % 3), "1-U") for k in [*range(90), 3]] + [(None, 40, "O", None, None)],
        "lineitem": [(k % 95, k % 7, None if k == 11 else k % 6, None if k % 13 == 0 else k % 9.0, k / 4, "RAN"[k % 3], "OF"[k % 2]) for k in range(400)],
    }
    for name, schema in TABLES.items():
        spark.createDataFrame(rows[name], schema).write.parquet(f"{tmp_path}/tables/{name}.parquet")
    return f"{tmp_path}/tables"


@pytest.mark.parametrize("name", REPORTS)
def test_waves_give_the_same_rows(spark, tables, monkeypatch, name):
    run, seen, own = registry()[name].run, [], landing.waves

    def waves(*args):
        for delivery, ads in own(*args):
            seen.append((delivery.count(), ads.count()))
            yield delivery, ads

    monkeypatch.setattr(reports, "waves", waves)
    before = set(Path(shared_dir(spark)).glob("*"))
    whole = sorted(map(tuple, run(spark, tables).collect()), key=repr)
    assert len(seen) == 1 and len(whole) > 50
    monkeypatch.setattr(landing, "WAVE_ROWS", 90)
    assert sorted(map(tuple, run(spark, tables).collect()), key=repr) == whole
    (rows, ads), *parts = seen
    assert len(parts) == 5 and sum(n > 0 for n, _ in parts) > 2
    assert (sum(n for n, _ in parts), sum(n for _, n in parts)) == (rows, ads)
    assert not [p for p in set(Path(shared_dir(spark)).iterdir()) - before if p.name.startswith("delivery")]


def test_shuffles_go_once_pages_have_landed(spark, tables, monkeypatch):
    """Of what was shuffled for a report and its pages nothing stays on disk: the count of the rows may, a few bytes."""

    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = [files.apply(i).getName() for i in range(files.size())]
        return {x.split("_")[1] for x in names if x.startswith("shuffle_")}

    left, read = [], sources.L.read_landed

    def landed(*args):
        until = time.time() + 20
        while len(shuffles() - before) > 1 and time.time() < until:
            time.sleep(0.2)
        left.append(len(shuffles() - before))
        return read(*args)

    before = shuffles()
    monkeypatch.setattr(landing, "read_landed", landed)
    monkeypatch.setattr(landing, "WAVE_ROWS", 90, raising=False)
    found = registry()["scan_report_ad_market"].run(spark, tables)
    assert left == [min(left[0], 1)] and found.count() > 50


def test_no_delivery_at_all(spark, tables, monkeypatch):
    monkeypatch.setattr(landing, "WAVE_ROWS", 90)
    monkeypatch.setattr(reports, "raw_delivery", lambda s, d, own=reports.raw_delivery: own(s, d).where(F.lit(False)))
    assert registry()["scan_report_ad"].run(spark, tables).count() == 0
