from datetime import date

import pytest
from pyspark.sql import functions as F

from spendlake.operators import report as R

D1, D2 = date(2024, 1, 1), date(2024, 1, 2)
COLUMNS = (
    "ad_account_id string, campaign_id string, ad_set_id string, ad_id string, stat_date date, "
    "spend double, impressions int, clicks int, person_id int, age string, gender string"
)


@pytest.fixture(scope="module")
def delivery(spark):
    rows = [
        ("act_1", "c1", "s1", "a1", D1, 0.10, 10, 1, 1, "18", "f"),
        ("act_1", "c1", "s1", "a1", D1, 0.20, 20, 0, 1, "18", "m"),
        ("act_1", "c1", "s1", "a2", D1, 0.30, 5, 0, 1, "25", "f"),
        ("act_1", "c1", "s2", "a3", D1, 1.00, 0, 0, 2, None, "f"),
        ("act_1", "c1", "s1", "a1", D2, 2.00, 4, 2, 3, "25", None),
    ]
    return spark.createDataFrame(rows, COLUMNS)


def by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_ad_level(delivery):
    got = by(R.report(delivery, "ad"), "ad_id", "stat_date")
    row = got["a1", D1]
    assert (row.spend, row.impressions, row.clicks, row.reach) == (0.3, 30, 1, 1)
    assert (row.frequency, row.cpc, row.ctr) == (30.0, 0.3, 100.0 / 30)
    assert got["a3", D1].cpm is None and got["a3", D1].cpc is None


def test_reach_does_not_add_up(delivery):
    ads, campaigns = R.report(delivery, "ad"), R.report(delivery, "campaign")
    assert ads.where(F.col("stat_date") == D1).agg(F.sum("reach")).first()[0] == 3
    assert campaigns.where(F.col("stat_date") == D1).first().reach == 2
    assert "reach" not in R.roll_up(ads, "campaign").columns


def test_roll_up_equals_coarser_report(delivery):
    rolled = by(R.roll_up(R.report(delivery, "ad"), "campaign"), "campaign_id", "stat_date")
    direct = by(R.report(delivery, "campaign"), "campaign_id", "stat_date")
    assert rolled.keys() == direct.keys()
    for key, row in rolled.items():
        assert all(row[c] == direct[key][c] for c in row.asDict())


def test_cross_tab_sums_to_the_plain_report(delivery):
    cross = R.report(delivery, "ad", ("age", "gender"))
    collapsed = by(R.collapse(cross, ("age", "gender")), "ad_id", "stat_date")
    plain = by(R.report(delivery, "ad"), "ad_id", "stat_date")
    assert {k: (r.spend, r.impressions, r.clicks, r.cpc) for k, r in collapsed.items()} == {
        k: (r.spend, r.impressions, r.clicks, r.cpc) for k, r in plain.items()
    }


def test_hierarchy_joined_late_or_early_gives_the_same(delivery):
    ids = ["ad_account_id", "campaign_id", "ad_set_id", "ad_id"]
    hierarchy = delivery.select(*ids).distinct()
    bare = delivery.drop("ad_account_id", "campaign_id", "ad_set_id")
    for level in ("ad", "adset", "campaign"):
        direct, joined = R.report(delivery, level), R.report(bare, level, hierarchy=hierarchy)
        assert direct.exceptAll(joined.select(*direct.columns)).isEmpty()
        assert joined.select(*direct.columns).exceptAll(direct).isEmpty()


def test_reconcile_finds_the_gap(delivery):
    ads = R.report(delivery.where("ad_id <> 'a3'"), "ad")
    campaigns = R.report(delivery.where(F.col("stat_date") == D1), "campaign")
    got = by(R.reconcile(ads, campaigns, "campaign"), "stat_date")
    assert got[D1,].spend_diff == -1.0 and got[D1,].impressions_diff == 0
    assert got[D2,].spend_reported is None and got[D2,].spend_diff == 2.0


def test_independent_breakdowns_count_each_total_once_per_set(delivery):
    got = R.independent_breakdowns(delivery, "campaign", ("age", "gender"))
    totals = by(got.groupBy("breakdown").agg(F.round(F.sum("spend"), 2).alias("spend")), "breakdown")
    assert {k[0]: r.spend for k, r in totals.items()} == {"age": 3.6, "gender": 3.6}
    assert got.where("breakdown = 'age' AND breakdown_value IS NULL").count() == 1


def test_approximate_reach_is_close(spark):
    rows = spark.range(20000).select(
        *(F.lit("x").alias(c) for c in ("ad_account_id", "campaign_id", "ad_set_id", "ad_id")),
        F.lit(D1).alias("stat_date"), F.lit(1.0).alias("spend"), F.lit(1).alias("impressions"), F.lit(0).alias("clicks"),
        (F.col("id") % 5000).alias("person_id"),
    )
    reach = R.report(rows, "ad", approximate_reach=True).first().reach
    assert abs(reach - 5000) < 500


def test_charges_below_a_cent_add_up(spark):
    rows = spark.range(1000).select(
        *(F.lit("x").alias(c) for c in ("ad_account_id", "campaign_id", "ad_set_id", "ad_id")),
        F.lit(D1).alias("stat_date"), F.lit(0.0005).alias("spend"), F.lit(1).alias("impressions"), F.lit(0).alias("clicks"),
        F.col("id").alias("person_id"),
    )
    assert R.report(rows, "ad").first().spend == 0.5


def test_delivery_of_an_unknown_ad_is_kept(delivery):
    hierarchy = delivery.where("ad_id <> 'a3'").select("ad_account_id", "campaign_id", "ad_set_id", "ad_id").distinct()
    bare = delivery.drop("ad_account_id", "campaign_id", "ad_set_id")
    for level in ("ad", "campaign"):
        got = R.report(bare, level, hierarchy=hierarchy)
        assert got.agg(F.round(F.sum("spend"), 2)).first()[0] == 3.6
        assert got.where("campaign_id IS NULL").first().spend == 1.0


def test_unknown_level(delivery):
    with pytest.raises(ValueError, match="unknown level"):
        R.report(delivery, "account")
