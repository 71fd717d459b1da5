from pyspark.sql import functions as F

from spendlake.functions.metrics import action_total, action_value
from spendlake.operators.actions import action_lists, explode_actions, video_funnel, with_cost_per_action

LIST = '[{"action_type":"lead","value":"2"},{"action_type":"view","value":"1.25"},{"action_type":"lead","value":"3"}]'


def values(spark, action, *lists):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(lists)], "no int, j string")
    return [r[0] for r in rows.orderBy("no").select(action_value(F.col("j"), action)).collect()]


def test_action_value(spark):
    assert values(spark, "lead", LIST, "[]", None, '[{"action_type":"lead","value":""}]') == [5.0, None, None, None]
    assert values(spark, "view", LIST) == [1.25] and values(spark, "none", LIST) == [None]


def test_total_and_cost(spark):
    rows = spark.createDataFrame([(10.0, LIST), (10.0, "[]"), (10.0, '[{"action_type":"lead","value":"0"}]')], "spend double, j string")
    assert [r[0] for r in rows.select(action_total(F.col("j"))).collect()] == [6.25, None, 0.0]
    assert [r.c for r in with_cost_per_action(rows, "j", "lead", "c").collect()] == [2.0, None, None]


def test_explode(spark):
    rows = spark.createDataFrame([("a", LIST), ("b", None), ("c", "[]")], "id string, j string")
    assert sorted(tuple(r) for r in explode_actions(rows, "j", ("id",)).collect()) == [
        ("a", "lead", 2.0), ("a", "lead", 3.0), ("a", "view", 1.25)
    ]


def test_lists_have_one_entry_per_type(spark):
    events = spark.createDataFrame([("a", "x", 1.5), ("a", "x", 2.0), ("a", "w", 1.0), ("b", "x", 4.0)], "id string, t string, v double")
    got = {r.id: r.actions_json for r in action_lists(events, ("id",), "t", "v").collect()}
    assert got["a"] == '[{"action_type":"w","value":"1.0"},{"action_type":"x","value":"3.5"}]'


def test_video_funnel(spark):
    one = '[{{"action_type":"video_view","value":"{}"}}]'
    rows = spark.createDataFrame(
        [("a", *(one.format(n) for n in (200, 100, 50, 25, 10))), ("b", None, *(one.format(1) for _ in range(4)))],
        "id string, p0 string, p1 string, p2 string, p3 string, p4 string",
    )
    got = {r.id: r for r in video_funnel(rows, ("id",), ("p0", "p1", "p2", "p3", "p4")).collect()}
    assert (got["a"].play, got["a"].p25_rate, got["a"].p100_rate) == (200.0, 0.5, 0.05)
    assert got["b"].play is None and got["b"].p25_rate is None and got["b"].p25 == 1.0
