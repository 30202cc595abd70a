import math

from pyspark.sql import functions as F

from courtside.operators import (
    arg_extreme, conditional_rate, latest_snapshot, rate_by_group, seed_within,
    share_of_total, top_k,
)


def test_top_k_nulls_last_and_tiebreak(spark):
    df = spark.createDataFrame([("b", 10.0), ("a", 10.0), ("c", None), ("d", 5.0)],
                               "name string, v double")
    assert [r.name for r in top_k(df, "v", 2, tiebreak=["name"]).collect()] == ["a", "b"]
    # ascending bottom-k: NULL never first
    assert [r.name for r in top_k(df, "v", 3, descending=False, tiebreak=["name"]).collect()] \
        == ["d", "a", "b"]


def test_top_k_plans_take_ordered(spark):
    df = spark.range(100).withColumn("v", F.col("id") % 7)
    plan = top_k(df, "v", 5, tiebreak=["id"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_rate_denominators_and_all_null(spark):
    df = spark.createDataFrame([("p", 1), ("p", 0), ("p", None), ("q", None), ("q", None)],
                               "k string, f int")
    rows = {r.k: r for r in rate_by_group(df, ["k"], "f", "rows").collect()}
    assert rows["p"].attempts == 3 and rows["p"].fg_pct == 33.3
    assert rows["q"].attempts == 2 and rows["q"].fg_pct is None
    nn = {r.k: r for r in rate_by_group(df, ["k"], "f", "non_null").collect()}
    assert nn["p"].attempts == 2 and nn["p"].fg_pct == 50.0
    assert nn["q"].attempts == 0 and nn["q"].fg_pct is None


def test_rate_having_bound_inclusive(spark):
    df = spark.createDataFrame([("p", 1)] * 10 + [("q", 1)] * 9, "k string, f int")
    got = rate_by_group(df, ["k"], "f", min_attempts=10).collect()
    assert [r.k for r in got] == ["p"]


def test_share_of_total_sums_to_100(spark):
    df = spark.createDataFrame([("p", "a", 3), ("p", "b", 3), ("p", "c", 1), ("q", "a", 2)],
                               "player string, zone string, n long")
    got = share_of_total(df, "n", ["player"], share="s").collect()
    by = {}
    for r in got:
        by.setdefault(r.player, []).append(r.s)
    assert abs(sum(by["p"]) - 100) <= 0.2 and by["q"] == [100.0]
    plan = share_of_total(df, "n", ["player"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_seed_within_no_gaps_and_limit(spark):
    rows = [("East", f"t{i}", i / 20) for i in range(15)] + [("West", f"w{i}", 0.5) for i in range(12)]
    df = spark.createDataFrame(rows, "conference string, team string, win_pct double")
    got = seed_within(df, "conference", "win_pct", tiebreak=["team"], k=10).collect()
    for conf in ("East", "West"):
        seeds = sorted(r.conference_seed for r in got if r.conference == conf)
        assert seeds == list(range(1, 11))
    # equal win_pct: names decide
    west = sorted((r.conference_seed, r.team) for r in got if r.conference == "West")
    assert west[0][1] == "w0" and west[1][1] == "w1"


def test_arg_extreme_ties_nan_null(spark):
    from courtside.operators import display_key, first_in_order
    df = spark.createDataFrame(
        [("a", 5.0, 1.0), ("b", 9.0, 3.0), ("c", 9.0, 2.0), ("d", float("nan"), 4.0),
         ("e", None, 5.0), ("f", 1.0, None)],
        "name string, v double, ppg double")
    key = display_key("ppg", tiebreak=["name"])  # display order: e d b c a f
    r = df.agg(arg_extreme("name", "v", key).alias("mx"),
               arg_extreme("name", "v", key, largest=False).alias("mn"),
               first_in_order("name", key).alias("first")).collect()[0]
    assert r.mx == "b" and r.mn == "f" and r.first == "e"
    plan = df.agg(first_in_order("name", key))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_latest_snapshot_keys_and_idempotent(spark):
    rows = [("s", 1, "2025-01-01", 10), ("s", 2, "2025-01-01", 20), ("s", 1, "2025-01-02", 11)]
    df = spark.createDataFrame(rows, "season string, player_id int, date string, v int") \
        .withColumn("date", F.to_date("date"))
    by_player = latest_snapshot(df, ["season", "player_id"])
    got = sorted((r.player_id, r.v) for r in by_player.collect())
    assert got == [(1, 11), (2, 20)]
    by_season = sorted(r.v for r in latest_snapshot(df, ["season"]).collect())
    assert by_season == [11]
    again = sorted((r.player_id, r.v) for r in latest_snapshot(by_player, ["season", "player_id"]).collect())
    assert again == got


def test_latest_snapshot_keeps_rows_with_a_null_key(spark):
    rows = [(None, "2025-01-01", 1), (None, "2025-01-02", 2), (1, "2025-01-01", 3), (1, None, 4)]
    df = spark.createDataFrame(rows, "player_id long, date string, v int").withColumn("date", F.to_date("date"))
    for few in (False, True):
        assert sorted(r.v for r in latest_snapshot(df, ["player_id"], few_keys=few).collect()) == [2, 3]


def test_conditional_rate(spark):
    df = spark.createDataFrame([(1, "a"), (0, "a"), (None, "a"), (1, "b")], "f int, k string")
    got = df.agg(conditional_rate("f", F.col("k") == "a").alias("a"), conditional_rate("f", F.col("k") == "c").alias("c")).first()
    assert got.a == 50.0 and got.c is None


def test_positions_are_exact_over_ranges(spark):
    from courtside.operators.ranking import positions
    rows = [(f"t{i:03d}", float(i % 40) if i % 17 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "team string, pct double")
    got = {r.team: r.position for r in positions(df, "pct", ["team"], ranges=7).collect()}
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert got == {t: i + 1 for i, (t, _) in enumerate(order)}
    assert positions(df.limit(0), "pct", ["team"]).count() == 0
    plan = positions(df, "pct", ["team"])._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number() windowspecdefinition(_range" in plan


def test_cards_ignore_nan(spark):
    from courtside.plans.dashboard import k_players
    rows = [("A", 20.0, 0.5, 0.4, 10.0), ("B", float("nan"), float("nan"), 0.3, float("nan"))]
    d = spark.createDataFrame(rows, "player_name string, ppg double, fg_pct double, three_pct double, efficiency double")
    k = k_players(d).first()
    assert (k.scoring_leader, k.scoring_leader_ppg, k.top_efficiency_player, k.top_efficiency, k.best_fg_pct) == ("A", 20.0, "A", 10.0, 50.0)
