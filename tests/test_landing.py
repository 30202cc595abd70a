import os

import pytest
from pyspark.sql import functions as F

from courtside.plans.normalize import build_processed, process
from courtside.plans.templates import run_query
from courtside.sinks.files import land_all, land_snapshot, write_processed
from courtside.sources.landing import read_landing, resolve_columns, tracked_players
from courtside.sources.processed import read_processed, register_table
from courtside.streaming import stream_landing

from conftest import write_text

VARIANT_A = ("TeamID,TeamCity,TeamName,TeamAbbreviation,Conference,Division,WINS,LOSSES,WinPCT,"
             "HOME,ROAD,L10,PointsPG,OppPointsPG,DiffPointsPG")
VARIANT_B = "TeamID,TeamCity,TeamName,TeamSlug,Conference,Division,L,W,PCT,HOME,AWAY,L10,PPG,OppPPG,DIFF"
VARIANT_C = ("teamid,Conference,TeamCity,TeamName,TeamAbbreviation,Division,losses,wins,WinPCT,"
             "HOME,ROAD,L10,PointsPG,OppPointsPG,DiffPointsPG")
VARIANT_D = ("TeamID,TeamCity,TeamName,TeamAbbreviation,Conference,Division,WINS,LOSSES,WinPCT,"
             "HOME,ROAD,PointsPG,OppPointsPG,DiffPointsPG")

SHOT_HEADER = ("GAME_ID,PLAYER_ID,PLAYER_NAME,TEAM_ID,TEAM_NAME,PERIOD,MINUTES_REMAINING,"
               "SECONDS_REMAINING,EVENT_TYPE,ACTION_TYPE,SHOT_TYPE,SHOT_ZONE_BASIC,SHOT_ZONE_AREA,"
               "SHOT_DISTANCE,LOC_X,LOC_Y,SHOT_MADE_FLAG").lower() + ",season"

PLAYER_HEADER = ("PLAYER_ID,player_name,team_abbreviation,games_played,minutes_per_game,"
                 "points_per_game,assists_per_game,rebounds_per_game,steals_per_game,"
                 "blocks_per_game,field_goal_pct,three_point_pct,free_throw_pct,efficiency_rating,season")


def _shot(game, pid, name, period, minutes, dist, flag):
    return (f"{game},{pid},{name},1610612737,Hawks,{period},{minutes},10,Made Shot,Jump Shot,"
            f"2PT Field Goal,Mid-Range,Center(C),{dist},10,20,{flag},2024-25")


def test_resolve_columns_errors_name_candidates(spark):
    df = spark.createDataFrame([(1, 2)], "TeamID int, W int")
    out = resolve_columns(df, {"team_id": ["TeamID"], "wins": ["WINS", "W"]})
    assert out.columns == ["team_id", "wins"]
    with pytest.raises(KeyError) as e:
        resolve_columns(df, {"losses": ["LOSSES", "L"]})
    assert "LOSSES" in str(e.value) and "TeamID" in str(e.value)


def test_header_drift_binds_by_name(spark, workdir):
    base = f"{workdir}/team_standings/season=2024-25"
    write_text(f"{base}/date=2025-01-01/standings.csv",
               VARIANT_A + "\n1,Atlanta,Hawks,ATL,East,SE,10,5,0.667,6-2,4-3,7-3,110.5,105.2,5.3\n")
    write_text(f"{base}/date=2025-01-02/standings.csv",
               VARIANT_B + "\n1,Atlanta,Hawks,hawks,East,SE,5,11,0.688,6-2,5-3,7-3,111,105,6\n")
    write_text(f"{base}/date=2025-01-03/standings.csv",
               VARIANT_C + "\n1,East,Atlanta,Hawks,ATL,SE,6,12,0.667,6-2,5-3,7-3,111,105,6\n")
    raw = read_landing(spark, workdir, "team_standings")
    got = {str(r.date): (r.wins, r.losses, r.team_abbreviation, r.season) for r in raw.collect()}
    assert got["2025-01-01"] == ("10", "5", "ATL", "2024-25")
    assert got["2025-01-02"] == ("11", "5", "hawks", "2024-25")
    assert got["2025-01-03"] == ("12", "6", "ATL", "2024-25")
    # newest snapshot only, typed and derived
    p = process(raw, "team_standings").collect()
    assert len(p) == 1 and p[0].wins == 12 and p[0].total_games == 18
    assert p[0].net_rating == 6.0 and p[0].win_pct_label == "Elite"


def test_missing_required_header_raises(spark, workdir):
    write_text(f"{workdir}/team_standings/season=2024-25/date=2025-01-01/standings.csv",
               VARIANT_D + "\n1,Atlanta,Hawks,ATL,East,SE,10,5,0.667,6-2,4-3,110.5,105.2,5.3\n")
    with pytest.raises(Exception) as e:
        read_landing(spark, workdir, "team_standings").collect()
    assert "L10" in str(e.value) and "TeamID" in str(e.value)


def test_players_edge_rows(spark, workdir):
    base = f"{workdir}/player_stats/season=2024-25"
    write_text(f"{base}/date=2025-01-01/player_stats.csv", PLAYER_HEADER + "\n"
               "7,Old Row,ATL,10,30,20,5,5,1,1,0.5,0.4,0.8,25,2024-25\n")
    write_text(f"{base}/date=2025-01-02/player_stats.csv", PLAYER_HEADER + "\n"
               "7,De'Aaron X,SAC,20.0,34.1,n/a,5,5,1,1,0.5,nan,,25,2024-25\n"
               "8,Other Guy,ATL,19,20,21.5,5,5,1,1,0.5,0.35,0.9,18,2024-25\n")
    p = build_processed(spark, workdir, "player_stats")
    rows = {r.player_id: r for r in p.collect()}
    assert set(rows) == {7, 8}  # newest snapshot only
    r = rows[7]
    assert r.games_played == 20 and r.points_per_game is None
    assert r.three_point_pct is None and r.free_throw_pct is None
    assert r.true_shooting_pct is None and r.season == "2024-25"
    assert dict(p.dtypes)["player_id"] == "bigint" and dict(p.dtypes)["games_played"] == "int"


def test_shots_layouts_snapshots_and_duplicates(spark, workdir):
    base = f"{workdir}/shot_charts/season=2024-25"
    # reference layout: one file per player under the date folder
    write_text(f"{base}/date=2025-01-01/player_1.csv", SHOT_HEADER + "\n"
               + _shot("0022400001", 1, "A", 4, 5, 3, 1) + "\n")
    write_text(f"{base}/date=2025-01-01/player_2.csv", SHOT_HEADER + "\n"
               + _shot("0022400002", 2, "B", 4, 6, 25, 0) + "\n")
    # player 1 only on D2, with two identical rows
    write_text(f"{base}/date=2025-01-02/player_1.csv", SHOT_HEADER + "\n"
               + _shot("0022400003", 1, "A", 1, 2, 12, "") + "\n"
               + _shot("0022400003", 1, "A", 1, 2, 12, "") + "\n")
    p = build_processed(spark, workdir, "shot_charts")
    rows = p.collect()
    by_player = {}
    for r in rows:
        by_player.setdefault(r.player_id, []).append(r)
    assert len(by_player[1]) == 2 and all(r.game_id == "0022400003" for r in by_player[1])
    assert len(by_player[2]) == 1 and by_player[2][0].game_id == "0022400002"
    assert by_player[1][0].shot_made_flag is None and by_player[1][0].made_label is None
    assert by_player[1][0].shot_zone_label == "Mid"
    assert by_player[2][0].shot_zone_label == "Three" and by_player[2][0].made_label == "Missed"


def test_land_players_one_by_one_and_manifest(spark, workdir):
    root = f"{workdir}/landing"
    cols = "game_id string, player_name string, shot_made_flag int"
    p1 = spark.createDataFrame([("0022400001", "A", 1)], cols)
    p2 = spark.createDataFrame([("0022400002", "B", 0), ("0022400002", "B", 0)], cols)
    empty = spark.createDataFrame([], cols)
    m1 = land_all(spark, {"shot_charts": {1: p1}}, root, "2024-25", "2025-01-01")
    m2 = land_all(spark, {"shot_charts": {2: p2, 3: empty},
                          "player_stats": spark.createDataFrame([(1,)], "x int")},
                  root, "2024-25", "2025-01-01")
    assert [(r.status, r.rows) for r in m1.collect()] == [("success", 1)]
    status = {(r.dataset, r.entity_id): (r.status, r.rows) for r in m2.collect()}
    assert status[("shot_charts", 2)] == ("success", 2)
    assert status[("shot_charts", 3)] == ("empty", 0)
    assert status[("player_stats", None)] == ("success", 1)
    back = spark.read.option("header", True).csv(f"{root}/shot_charts")
    assert sorted(r.player_id for r in back.select("player_id").distinct().collect()) == [1, 2]
    assert back.count() == 3  # identical shots both kept
    assert back.where("game_id = '0022400001'").count() == 1


def test_manifest_records_errors_without_stopping(spark, workdir):
    bad = spark.createDataFrame([(1,)], "x int").select(F.raise_error(F.lit("boom")).cast("string").alias("x"))
    good = spark.createDataFrame([(1,)], "x int")
    m = land_all(spark, {"team_standings": bad, "player_stats": good}, f"{workdir}/l",
                 "2024-25", "2025-01-01")
    st = {r.dataset: r for r in m.collect()}
    assert st["team_standings"].status == "error" and "boom" in st["team_standings"].message
    assert st["player_stats"].status == "success"


def test_write_processed_replaces_one_season_only(spark, workdir):
    out = f"{workdir}/processed/t"
    a = spark.createDataFrame([(1, "2023-24"), (2, "2024-25")], "v int, season string")
    write_processed(a, out)
    b = spark.createDataFrame([(3, "2024-25")], "v int, season string")
    write_processed(b, out)
    got = sorted((r.season, r.v) for r in read_processed(spark, "t", path=out).collect())
    assert got == [("2023-24", 1), ("2024-25", 3)]


def test_catalog_picks_up_new_season_and_sql_binds_values(spark, workdir):
    out = f"{workdir}/processed/shot_charts"
    cols = ("player_name string, shot_zone_label string, shot_made_flag int, period int, "
            "minutes_remaining int, season string")
    write_processed(spark.createDataFrame([("De'Aaron X", "Close", 1, 4, 5, "2023-24")], cols), out)
    name = register_table(spark, "shot_charts", out, database="cs_test")
    assert spark.table("cs_test.shot_charts").count() == 1
    write_processed(spark.createDataFrame([("De'Aaron X", "Mid", 0, 4, 6, "2024-25")], cols), out)
    register_table(spark, "shot_charts", out, database="cs_test")
    assert spark.table("cs_test.shot_charts").count() == 2
    got = run_query(spark, "d_shooters", shots=name, season="2024-25").collect()
    assert [r.player_name for r in got] == ["De'Aaron X"]
    plan = run_query(spark, "d_shooters", shots=name, season="2024-25") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-25" in plan


def test_tracked_players_short_and_long_lists(spark):
    df = spark.range(5000).withColumnRenamed("id", "player_id")
    assert tracked_players(df, [1, 2, 3]).count() == 3
    assert tracked_players(df, list(range(0, 4000, 2))).count() == 2000
    assert tracked_players(df, []).count() == 0


def test_tracked_players_as_a_table_filter_the_scan(spark, workdir):
    spark.range(20_000).selectExpr("id AS player_id", "id % 50 AS x").write.parquet(f"{workdir}/shots")
    spark.range(4_000).selectExpr("id", "id % 10 AS kind").write.parquet(f"{workdir}/players")
    shots = spark.read.parquet(f"{workdir}/shots")
    ids = spark.read.parquet(f"{workdir}/players").where("kind = 3").select("id")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = tracked_players(shots, ids)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "might_contain" in plan and plan.index("might_contain") < plan.index("Relation")
        assert got.count() == 400
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert tracked_players(shots, ids.union(spark.sql("SELECT CAST(NULL AS BIGINT)"))).count() == 400


def test_stream_landing_processes_only_new_files(spark, workdir):
    root, out = f"{workdir}/landing", f"{workdir}/processed/team_standings"
    ck = f"{workdir}/ck"
    cols = ("team_id string, team_city string, team_name string, team_abbreviation string, "
            "conference string, division string, wins string, losses string, win_pct string, "
            "home_record string, away_record string, last_10_record string, "
            "points_per_game string, opp_points_per_game string, point_differential string")
    d1 = spark.createDataFrame([("1", "Atlanta", "Hawks", "ATL", "East", "SE", "10", "5", "0.667",
                                 "6-2", "4-3", "7-3", "110.5", "105.2", "5.3")], cols)
    land_snapshot(d1, root, "team_standings", "2024-25", "2025-01-01")
    stream_landing(spark, root, "team_standings", out, checkpoint=ck)
    assert spark.read.parquet(out).count() == 1
    d2 = d1.withColumn("wins", F.lit("11"))
    land_snapshot(d2, root, "team_standings", "2024-25", "2025-01-02")
    stream_landing(spark, root, "team_standings", out, checkpoint=ck)
    got = spark.read.parquet(out)
    assert got.count() == 2
    assert sorted(r.wins for r in got.collect()) == [10, 11]
    assert dict(got.dtypes)["wins"] == "int" and "net_rating" in got.columns


def test_stream_landing_shots_bulk_layout(spark, workdir):
    root, out, ck = f"{workdir}/landing", f"{workdir}/processed/shot_charts", f"{workdir}/ck"
    from courtside.schemas import SHOT_COLUMNS
    row = ("0022400001", "7", "A", "1", "Hawks", "4", "5", "10", "Made Shot", "Jump Shot",
           "2PT Field Goal", "Mid-Range", "Center(C)", "12", "10", "20", "1")
    df = spark.createDataFrame([row, row], ", ".join(f"{c} string" for c in SHOT_COLUMNS))
    land_snapshot(df, root, "shot_charts", "2024-25", "2025-01-01")
    stream_landing(spark, root, "shot_charts", out, checkpoint=ck)
    got = spark.read.parquet(out).collect()
    assert len(got) == 2 and got[0].game_id == "0022400001" and got[0].shot_zone_label == "Mid"
    assert got[0].player_id == 7 and got[0].made_label == "Made"


def test_run_date_format():
    from courtside.sinks.files import run_date
    d = run_date()
    assert len(d) == 10 and d[4] == "-" and d[7] == "-"


def test_run_daily_lands_processes_and_registers(spark, workdir):
    from courtside.plans.pipeline import run_daily
    players = spark.createDataFrame(
        [("7", "A Player", "ATL", "30", "34", "25.5", "5", "6", "1", "1", "0.5", "0.4", "0.8", "25")],
        "PLAYER_ID string, PLAYER string, TEAM string, GP string, MIN string, PTS string, "
        "AST string, REB string, STL string, BLK string, FG_PCT string, FG3_PCT string, "
        "FT_PCT string, EFF string")
    m = run_daily(spark, {"player_stats": players}, f"{workdir}/raw", f"{workdir}/processed",
                  "2024-25", "2025-01-02", database="cs_daily", datasets=("player_stats",))
    assert [r.status for r in m.collect()] == ["success"]
    got = run_query(spark, "p_top20", players="cs_daily.player_stats", season="2024-25",
                    min_games=20).collect()
    assert [(r.player_name, r.ppg) for r in got] == [("A Player", 25.5)]


def test_unknown_columns_quotes_ids_and_null_keys_lose_no_row(spark, workdir):
    base = f"{workdir}/shot_charts/season=2024-25"
    extra = SHOT_HEADER.replace("player_name", "scout,player_name")
    row = _shot("0022400001", "9007199254740993", "NAME", 4, 5, 3, 1).replace("NAME", 'x,"Al ""Ace"" B, Jr"')
    write_text(f"{base}/date=2025-01-02/shots.csv", extra + "\n" + row + "\n"
               + _shot("0022400002", "n/a", "NAME", 4, 5, 3, 0).replace("NAME", "y,C") + "\n"
               + _shot("0022400003", "", "NAME", 4, 5, 3, 0).replace("NAME", ",D") + "\n")
    got = {r.game_id: r for r in build_processed(spark, workdir, "shot_charts").collect()}
    assert set(got) == {"0022400001", "0022400002", "0022400003"}
    first = got["0022400001"]
    assert (first.player_id, first.player_name, first.shot_distance, first.shot_zone_area) == (9007199254740993, 'Al "Ace" B, Jr', 3, "Center(C)")
    assert got["0022400002"].player_id is None and got["0022400002"].player_name == "C"


def test_text_survives_landing(spark, workdir):
    from courtside.schemas import SHOT_COLUMNS
    names = ['Al "Ace" B, Jr', "O'Neal", "back\\slash", '"', ",", "plain"]
    rows = [tuple(n if c == "player_name" else str(i) for c in SHOT_COLUMNS) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in SHOT_COLUMNS))
    land_snapshot(df, workdir, "shot_charts", "2024-25", "2025-01-02")
    assert sorted(r.player_name for r in read_landing(spark, workdir, "shot_charts").collect()) == sorted(names)


def test_many_header_versions_in_one_read(spark, workdir):
    base = f"{workdir}/team_standings/season=2024-25"
    for i in range(20):
        write_text(f"{base}/date=2025-01-{i + 1:02d}/standings.csv",
                   f"NEW{i}," + VARIANT_A + f"\nz,1,Atlanta,Hawks,ATL,East,SE,{i},5,0.667,6-2,4-3,7-3,110.5,105.2,5.3\n")
    assert sorted(int(r.wins) for r in read_landing(spark, workdir, "team_standings").collect()) == list(range(20))
    newest = build_processed(spark, workdir, "team_standings")
    assert [r.wins for r in newest.collect()] == [19]
    files = [f for f in read_landing(spark, workdir, "team_standings", newest_only=True).inputFiles() if f.endswith(".csv")]
    assert files and all("date=2025-01-20" in f for f in files)


def test_shots_landed_in_both_layouts_count_once(spark, workdir):
    base = f"{workdir}/shot_charts/season=2024-25/date=2025-01-01"
    write_text(f"{base}/all.csv", SHOT_HEADER + "\n" + _shot("g1", 1, "A", 4, 5, 3, 1) + "\n")
    write_text(f"{base}/player_id=1/p.csv", SHOT_HEADER + "\n" + _shot("g1", 1, "A", 4, 5, 3, 1) + "\n")
    write_text(f"{base}/player_id=2/p.csv", SHOT_HEADER + "\n" + _shot("g2", 2, "B", 4, 5, 3, 1) + "\n")
    assert sorted(r.game_id for r in read_landing(spark, workdir, "shot_charts").collect()) == ["g1", "g2"]


def test_selecting_starts_no_job_and_landed_rows_are_not_shuffled(spark, workdir):
    from courtside.operators import latest_snapshot
    from courtside.sources import standins
    base = f"{workdir}/team_standings/season=2024-25/date=2025-01-01"
    write_text(f"{base}/s.csv", VARIANT_A + "\n1,Atlanta,Hawks,ATL,East,SE,10,5,0.667,6-2,4-3,7-3,110.5,105.2,5.3\n")
    sc = spark.sparkContext
    sc.setJobGroup("plans", "plans")
    try:
        latest_snapshot(spark.range(5).withColumn("date", F.lit("2025-01-01")), ["id"])
        standins.player_stats(spark, "/root/testdata/sf0.001", "1997-98")
        assert not sc.statusTracker().getJobIdsForGroup("plans")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    # one scan of the files; the table of file parts is small and known to be, so it is broadcast
    plan = read_landing(spark, workdir, "team_standings")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def _crooked_rows(n):
    """Rows whose texts hold line breaks, blank lines, commas, doubled quotes, carriage returns, header copies."""
    texts = ["plain", 'a\n"b",c', "\n", "x\r\ny", '"', '"\n"', "tail\n", "\n\n\n", "\u00e9\n\u4e16", SHOT_HEADER, "q" * 300 + "\n" + "r" * 300, " lead", "a,\"\"\n,"]
    return [(f"g{i}", str(i % 7), texts[i % len(texts)], texts[(i * 5 + 1) % len(texts)]) for i in range(n)]


def _crooked_file(path, rows, line_end="\n"):
    import csv
    import io
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=line_end)
    writer.writerow(SHOT_HEADER.split(","))
    for game, player, name, action in rows:
        writer.writerow([game, player, name, "1", "T", 1, 2, 3, "e", action, "2PT", "z", "a", 5, 6, 7, 1, "2024-25"])
    data = out.getvalue().encode()
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)
    return len(data)


@pytest.mark.parametrize("part, line_end", [("64m", "\n"), ("8k", "\n"), ("700", "\n"), ("4k", "\r\n")])
def test_line_breaks_in_quotes_over_file_parts(spark, workdir, part, line_end):
    base = f"{workdir}/shot_charts/season=2024-25/date=2025-01-02"
    rows = _crooked_rows(600)
    size = _crooked_file(f"{base}/crooked.csv", rows, line_end)
    plain = [(f"p{i}", "9", "plain", "dunk") for i in range(500)]
    _crooked_file(f"{base}/plain.csv", plain, line_end)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", part)
    try:
        landed = read_landing(spark, workdir, "shot_charts")
        got = sorted((r.game_id, r.player_id, r.player_name, r.action_type) for r in landed.collect())
        if part != "64m":
            from courtside.sources.landing import _lines
            from courtside.sources.records import part_facts
            facts = part_facts(_lines(spark, [f"{base}/*.csv"])).collect()
            crooked = [f for f in facts if f["_path"].endswith("crooked.csv")]
            assert len(crooked) >= 3 and len(crooked) >= size // 8200
            assert any(f["_before"] % 2 for f in crooked) or part == "4k"
            assert all(f["_odd"] == 0 and f["_before"] == 0 for f in facts if f["_path"].endswith("plain.csv"))
        from courtside.sources.landing import _lines
        from courtside.sources.records import counts, part_facts
        for name, n in (("crooked", 600), ("plain", 500)):
            lines = _lines(spark, [f"{base}/{name}.csv"])
            assert counts(lines, part_facts(lines)).agg(F.sum("n")).first()[0] == n
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sorted(rows + plain)


def test_written_line_breaks_come_back(spark, workdir):
    from courtside.schemas import SHOT_COLUMNS
    names = ["a\nb", "\n", 'x "y"\nz', " spaced ", "c\rd", "plain"]
    rows = [tuple(n if c == "player_name" else str(i) for c in SHOT_COLUMNS) for i, n in enumerate(names)]
    land_snapshot(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in SHOT_COLUMNS)), workdir, "shot_charts", "2024-25", "2025-01-02")
    assert sorted(r.player_name for r in read_landing(spark, workdir, "shot_charts").collect()) == sorted(names)


def test_an_open_quote_and_a_header_alone(spark, workdir):
    base = f"{workdir}/shot_charts/season=2024-25/date=2025-01-02"
    write_text(f"{base}/open.csv", SHOT_HEADER + "\n" + _shot("g1", 1, "A", 4, 5, 3, 1) + "\n" + _shot("g2", 1, '"B', 4, 5, 3, 1) + "\n" + _shot("g3", 1, "C", 4, 5, 3, 1) + "\n")
    write_text(f"{base}/none.csv", SHOT_HEADER + "\n")
    write_text(f"{base}/empty.csv", "")
    got = sorted(r.game_id for r in read_landing(spark, workdir, "shot_charts").collect())
    assert got == ["g1", "g2"]  # the rest of the file is one field


def test_a_data_line_equal_to_the_header_is_data(spark, workdir):
    base = f"{workdir}/shot_charts/season=2024-25/date=2025-01-02"
    write_text(f"{base}/s.csv", "\ufeff" + SHOT_HEADER + "\n" + _shot("g1", 1, "A", 4, 5, 3, 1) + "\n" + SHOT_HEADER + "\n\n")
    got = sorted((r.game_id, r.player_name) for r in read_landing(spark, workdir, "shot_charts").collect())
    assert got == [("g1", "A"), ("game_id", "player_name")]


def test_write_processed_follows_the_size(spark, workdir):
    import glob
    rows = spark.range(400_000).selectExpr("id AS v", "sha2(cast(id AS string), 256) AS t", "'2024-25' AS season")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        for n in (1000, 400_000):
            write_processed(rows.limit(n).repartition(8), f"{workdir}/t{n}")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    few, many = (len(glob.glob(f"{workdir}/t{n}/season=2024-25/*.parquet")) for n in (1000, 400_000))
    assert few == 1 and many >= 4


def test_added_column_shows_in_the_catalog(spark, workdir):
    out = f"{workdir}/t"
    write_processed(spark.createDataFrame([(1, "2023-24")], "a int, season string"), out)
    register_table(spark, "grown", out, database="cs_grown")
    write_processed(spark.createDataFrame([(2, 7, "2024-25")], "a int, b int, season string"), out)
    register_table(spark, "grown", out, database="cs_grown")
    got = {r.a: r.b for r in spark.table("cs_grown.grown").collect()}
    assert got == {1: None, 2: 7}


def test_run_query_rejects_unknown_parameters(spark):
    with pytest.raises(TypeError, match="min_gmaes"):
        run_query(spark, "p_top20", season="x", min_gmaes=3)


def test_run_sql_binds_values(spark):
    from courtside.plans.templates import run_sql
    spark.createDataFrame([("De'Aaron X", 1), ("B", 2)], "player_name string, v int").createOrReplaceTempView("cs_bound")
    got = run_sql(spark, "SELECT v FROM IDENTIFIER(:t) WHERE player_name = :p", t="cs_bound", p="De'Aaron X")
    assert [r.v for r in got.collect()] == [1]


def test_manifest_keeps_the_whole_message(spark, workdir):
    bad = spark.createDataFrame([(1,)], "x int").select(F.raise_error(F.lit("boom" * 2000)).cast("string").alias("x"))
    m = land_all(spark, {"team_standings": bad}, f"{workdir}/l", "2024-25", "2025-01-01").first()
    assert m.status == "error" and "boom" * 2000 in m.message


def test_daily_shots_keep_players_that_did_not_land(spark, workdir):
    from courtside.plans.pipeline import run_daily
    from courtside.schemas import SHOT_COLUMNS
    cols = ", ".join(f"{c} string" for c in SHOT_COLUMNS if c != "player_id")
    def shots(game):
        return spark.createDataFrame([tuple(game if c == "game_id" else "4" for c in SHOT_COLUMNS if c != "player_id")], cols)
    args = (f"{workdir}/raw", f"{workdir}/processed", "2024-25")
    run_daily(spark, {"shot_charts": {1: shots("g1"), 2: shots("g2")}}, *args, "2025-01-01", database="cs_merge")
    run_daily(spark, {"shot_charts": {1: shots("g3"), 3: shots("g4")}}, *args, "2025-01-02", database="cs_merge")
    got = sorted((r.player_id, r.game_id) for r in read_processed(spark, "shot_charts", path=f"{workdir}/processed/shot_charts").collect())
    assert got == [(1, "g3"), (2, "g2"), (3, "g4")]


def test_save_result_formats(spark, workdir):
    from courtside.sinks.files import save_result
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    save_result(df, f"{workdir}/p")
    save_result(df, f"{workdir}/c", "csv")
    assert spark.read.parquet(f"{workdir}/p").collect() == df.collect()
    assert spark.read.option("header", True).csv(f"{workdir}/c").columns == ["x", "y"]
    with pytest.raises(ValueError):
        save_result(df, f"{workdir}/x", "xml")


def test_a_day_landed_again_replaces_its_rows_in_the_stream(spark, workdir):
    from courtside.streaming import read_deliveries, read_streamed
    root, out, ck = f"{workdir}/landing", f"{workdir}/streamed", f"{workdir}/ck"
    base = f"{root}/shot_charts/season=2024-25"

    def run():
        stream_landing(spark, root, "shot_charts", out, checkpoint=ck)
        return sorted((str(r.date), r.player_id, r.game_id) for r in read_streamed(spark, out, "shot_charts").collect())

    write_text(f"{base}/date=2025-01-01/player_1.csv", SHOT_HEADER + "\n" + _shot("g1", 1, "A", 4, 5, 3, 1) + "\n" + _shot("g2", 1, "A", 4, 5, 3, 1) + "\n")
    write_text(f"{base}/date=2025-01-01/player_2.csv", SHOT_HEADER + "\n" + _shot("g3", 2, "B", 4, 5, 3, 1) + "\n")
    assert run() == [("2025-01-01", 1, "g1"), ("2025-01-01", 1, "g2"), ("2025-01-01", 2, "g3")]
    # the next day, a correction of player 1's first day in a folder of its own, and player 2's taken back
    write_text(f"{base}/date=2025-01-02/player_2.csv", SHOT_HEADER + "\n" + _shot("g4", 2, "B", 4, 5, 3, 1) + "\n")
    write_text(f"{base}/date=2025-01-01/player_id=1/p.csv", SHOT_HEADER + "\n" + _shot("g5", 1, "A\nB", 4, 5, 3, 1).replace("A\nB", '"A\nB"') + "\n")
    assert run() == [("2025-01-01", 1, "g5"), ("2025-01-01", 2, "g3"), ("2025-01-02", 2, "g4")]
    write_text(f"{base}/date=2025-01-01/player_id=2/none.csv", SHOT_HEADER + "\n")
    assert run() == [("2025-01-01", 1, "g5"), ("2025-01-02", 2, "g4")]
    counts = sorted((r["load"], str(r.date), r.player_id, r.rows) for r in read_deliveries(spark, out, "shot_charts").collect())
    assert counts == [(0, "2025-01-01", 1, 2), (0, "2025-01-01", 2, 1), (1, "2025-01-01", 1, 1), (1, "2025-01-02", 2, 1), (2, "2025-01-01", 2, 0)]


def test_a_retried_batch_counts_once(spark, workdir, monkeypatch):
    from courtside.streaming import landing_stream as LS
    root, out, ck = f"{workdir}/landing", f"{workdir}/streamed", f"{workdir}/ck"
    base = f"{root}/shot_charts/season=2024-25"
    write_text(f"{base}/date=2025-01-01/player_1.csv", SHOT_HEADER + "\n" + _shot("g1", 1, "A", 4, 5, 3, 1) + "\n")
    stream_landing(spark, root, "shot_charts", out, checkpoint=ck)
    write_text(f"{base}/date=2025-01-01/player_id=1/again.csv", SHOT_HEADER + "\n" + _shot("g2", 1, "A", 4, 5, 3, 1) + "\n")
    replace = LS._replace

    def fails_after_the_rows(df, path, *parts):
        if path.endswith("_deliveries"):
            raise RuntimeError("lost")
        replace(df, path, *parts)

    monkeypatch.setattr(LS, "_replace", fails_after_the_rows)
    with pytest.raises(Exception, match="lost"):
        stream_landing(spark, root, "shot_charts", out, checkpoint=ck)
    # rows of the failed batch are there but belong to no delivery
    assert [r.game_id for r in LS.read_streamed(spark, out, "shot_charts").collect()] == ["g1"]
    monkeypatch.setattr(LS, "_replace", replace)
    stream_landing(spark, root, "shot_charts", out, checkpoint=ck)
    assert [(r.game_id, r["load"]) for r in LS.read_streamed(spark, out, "shot_charts").collect()] == [("g2", 1)]
    assert LS.read_deliveries(spark, out, "shot_charts").count() == 2


def test_ten_thousand_players_in_one_write(spark, workdir):
    from courtside.sinks.files import Entities
    rows = spark.range(300).selectExpr("id % 30 * 400 AS player_id", "cast(id AS string) AS game_id", "'a\nb' AS player_name")
    expected = spark.range(10_000).selectExpr("id AS player_id")
    sc = spark.sparkContext
    sc.setJobGroup("landing", "landing")
    try:
        m = land_all(spark, {"shot_charts": Entities(rows, expected)}, f"{workdir}/l", "2024-25", "2025-01-01")
        jobs = len(sc.statusTracker().getJobIdsForGroup("landing"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 40
    # one plan for any number of players: nothing in it is per player
    assert len(m._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    got = {r.entity_id: (r.status, r.rows) for r in m.collect()}
    assert len(got) == 10_000 + 5  # players 10000, 10400 ... 11600 weren't expected
    assert got[0] == ("success", 10) and got[11_600] == ("success", 10) and got[1] == ("empty", 0)


def test_manifest_of_entities_records_errors_and_null_ids(spark, workdir):
    from courtside.sinks.files import Entities
    bad = spark.range(3).select(F.col("id").alias("player_id"), F.raise_error(F.lit("boom")).cast("string").alias("x"))
    m = land_all(spark, {"shot_charts": Entities(bad, spark.range(2).withColumnRenamed("id", "player_id"))}, f"{workdir}/a", "S", "2025-01-01")
    assert sorted((r.entity_id, r.status) for r in m.collect()) == [(0, "error"), (1, "error")] and "boom" in m.first().message
    odd = spark.createDataFrame([(None, "a"), (1, "b")], "player_id long, game_id string")
    m = land_all(spark, {"shot_charts": Entities(odd, None)}, f"{workdir}/b", "S", "2025-01-01")
    assert sorted(((r.entity_id, r.status, r.rows) for r in m.collect()), key=str) == [(1, "success", 1), (None, "success", 1)]


def _season(spark, rows):
    return spark.createDataFrame(rows, "v int, season string")


def test_publish_switches_at_once_and_a_failed_run_changes_nothing(spark, workdir, monkeypatch):
    from courtside.sinks import publish as P
    path, db = f"{workdir}/t", "cs_publish"
    read = lambda: sorted((r.season, r.v) for r in read_processed(spark, "t", database=db).collect())
    assert P.publish(_season(spark, [(1, "2023-24"), (2, "2024-25")]), "t", path, db) == 1
    before = read_processed(spark, "t", database=db)  # a reader that began before the next version
    assert P.publish(_season(spark, [(3, "2024-25"), (4, "it's")]), "t", path, db) == 2
    assert read() == [("2023-24", 1), ("2024-25", 3), ("it's", 4)]
    assert sorted((r.season, r.v) for r in before.collect()) == [("2023-24", 1), ("2024-25", 2)]

    def fails(*args, **named):
        raise RuntimeError("between write and publish")

    with monkeypatch.context() as m:
        m.setattr(P, "switch", fails)
        with pytest.raises(RuntimeError):
            P.publish(_season(spark, [(9, "2023-24")]), "t", path, db)
    assert read() == [("2023-24", 1), ("2024-25", 3), ("it's", 4)]
    with monkeypatch.context() as m:  # a write that breaks off leaves no manifest
        m.setattr(P, "write_processed", fails)
        with pytest.raises(RuntimeError):
            P.publish(_season(spark, [(9, "2023-24")]), "t", path, db)
    # nothing of the failed runs comes in with the next one
    assert P.publish(_season(spark, [(5, "2024-25")]), "t", path, db) == 4
    assert read() == [("2023-24", 1), ("2024-25", 5), ("it's", 4)]
    assert sorted(r.v for r in P.read_published(spark, path, 1).collect()) == [1, 2]
    # a season filter reads that season's folder alone
    plan = read_processed(spark, "t", database=db).where("season = '2024-25'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "versions/4-" in plan
    assert P.expire_versions(spark, path, keep=1) and read() == [("2023-24", 1), ("2024-25", 5), ("it's", 4)]
    assert P.versions(spark, path) == [4] and P.expire_versions(spark, path, keep=1) == []


def test_published_seasons_with_added_columns(spark, workdir):
    from courtside.sinks import publish as P
    path = f"{workdir}/t"
    P.publish(_season(spark, [(1, "a")]), "grown", path, "cs_publish")
    P.publish(spark.createDataFrame([(2, 0.5, "b")], "v long, w double, season string"), "grown", path, "cs_publish")
    assert {r.season: (r.v, r.w) for r in read_processed(spark, "grown", path=path).collect()} == {"a": (1, None), "b": (2, 0.5)}
    assert P.publish(_season(spark, []), "grown", path, "cs_publish") == 2


def test_a_failed_daily_run_leaves_the_published_season(spark, workdir, monkeypatch):
    from courtside.plans import pipeline
    from courtside.schemas import SHOT_COLUMNS
    from courtside.sinks import publish as P
    cols = ", ".join(f"{c} string" for c in SHOT_COLUMNS)
    def shots(*games):
        return spark.createDataFrame([tuple(g if c == "game_id" else p if c == "player_id" else "4" for c in SHOT_COLUMNS) for g, p in games], cols)
    args = (f"{workdir}/raw", f"{workdir}/processed", "2024-25")
    read = lambda: sorted((r.player_id, r.game_id) for r in read_processed(spark, "shot_charts", database="cs_failed").collect())
    pipeline.run_daily(spark, {"shot_charts": shots(("g1", "1"), ("g2", "2"))}, *args, "2025-01-01", database="cs_failed")
    with monkeypatch.context() as m:
        m.setattr(P, "switch", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            pipeline.run_daily(spark, {"shot_charts": shots(("g3", "1"))}, *args, "2025-01-02", database="cs_failed")
    assert read() == [(1, "g1"), (2, "g2")]
    pipeline.run_daily(spark, {"shot_charts": shots(("g3", "1"))}, *args, "2025-01-02", database="cs_failed")
    assert read() == [(1, "g3"), (2, "g2")]


def test_one_players_shots_skip_most_of_a_season(spark, workdir):
    """A clustered season: the scan of one player's shots reads less than a tenth of the rows."""
    from courtside.plans import dashboard as D
    from courtside.schemas import SHOT_CHARTS
    names = {f.name for f in SHOT_CHARTS.fields}
    rows = spark.range(300_000).selectExpr(
        "concat('Player ', case when id % 3 = 0 then 0 else id % 997 end) AS player_name", "'2024-25' AS season",
        *[f"cast({'1' if f.dataType.simpleString() != 'string' else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}" for f in SHOT_CHARTS.fields if f.name not in ("player_name", "season")])
    assert set(rows.columns) == names

    def scanned(path):
        df = D.d_shots(read_processed(spark, "shots", path=path), "2024-25", "Player 500")
        got = df.count()
        df = D.d_shots(read_processed(spark, "shots", path=path), "2024-25", "Player 500")
        df.write.format("noop").mode("overwrite").save()
        return got, df

    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        write_processed(rows, f"{workdir}/clustered", cluster_by=["player_name"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    import glob

    import pyarrow.parquet as pq
    files = glob.glob(f"{workdir}/clustered/season=2024-25/*.parquet")
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in files]
    assert len(files) >= 15 and max(sizes) < 45_000  # the player with a third of the rows lies in several files
    holding = 0
    for f in files:
        m = pq.ParquetFile(f).metadata
        at = m.schema.to_arrow_schema().names.index("player_name")
        for g in range(m.num_row_groups):
            s = m.row_group(g).column(at).statistics
            holding += m.row_group(g).num_rows if s.min <= "Player 500" <= s.max else 0
    got, df = scanned(f"{workdir}/clustered")
    assert got == rows.where("player_name = 'Player 500'").count() > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(player_name,Player 500)" in plan and holding < 30_000


def test_compaction_joins_small_files_and_keeps_corrections(spark, workdir, monkeypatch):
    import glob

    from courtside.streaming import compact, compaction, drop_loads, read_streamed
    root, out, ck = f"{workdir}/landing", f"{workdir}/streamed", f"{workdir}/ck"
    base = f"{root}/shot_charts/season=2024-25"
    read = lambda: sorted((str(r.date), r.player_id, r.game_id, r["load"]) for r in read_streamed(spark, out, "shot_charts").collect())
    rows_files = lambda: len(glob.glob(f"{out}/**/season=*/**/*.parquet", recursive=True))
    for day in range(1, 7):
        for player in range(4):
            write_text(f"{base}/date=2025-01-{day:02d}/player_{player}.csv", SHOT_HEADER + "\n" + _shot(f"g{day}-{player}", player, "A", 4, 5, 3, 1) + "\n")
        if day == 4:
            write_text(f"{base}/date=2025-01-01/player_id=1/p.csv", SHOT_HEADER + "\n" + _shot("again", 1, "A", 4, 5, 3, 1) + "\n")
        stream_landing(spark, root, "shot_charts", out, checkpoint=ck)
    before = read()
    assert len(before) == 24 and ("2025-01-01", 1, "again", 3) in before

    def fails(*args, **named):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(compaction, "write_processed", fails)
        with pytest.raises(RuntimeError):
            compact(spark, out, "shot_charts")
    assert read() == before and drop_loads(spark, out) == 0
    folder = compact(spark, out, "shot_charts")
    assert read() == before and len(glob.glob(f"{folder}/season=*/*.parquet")) == 1
    assert compact(spark, out, "shot_charts") is not None  # run again before the loads are dropped: the same rows
    assert read() == before
    assert drop_loads(spark, out) == 7 and read() == before and rows_files() == 1
    assert compact(spark, out, "shot_charts") is None
    # later days and corrections of compacted ones
    write_text(f"{base}/date=2025-01-07/player_1.csv", SHOT_HEADER + "\n" + _shot("g7-1", 1, "A", 4, 5, 3, 1) + "\n")
    write_text(f"{base}/date=2025-01-02/player_id=2/p.csv", SHOT_HEADER + "\n" + _shot("late", 2, "A", 4, 5, 3, 1) + "\n")
    stream_landing(spark, root, "shot_charts", out, checkpoint=ck)
    after = read()
    assert len(after) == 25 and ("2025-01-02", 2, "late", 6) in after and ("2025-01-02", 2, "g2-2", 1) not in after
    compact(spark, out, "shot_charts", least_files=1)
    drop_loads(spark, out)
    assert read() == after


def test_compaction_sorts_no_more_rows_in_a_task_than_memory_allows(spark, workdir, monkeypatch):
    import glob

    from courtside.streaming import compact, compaction, read_streamed
    root, out, ck = f"{workdir}/landing", f"{workdir}/streamed", f"{workdir}/ck"
    for day in (1, 2):  # rows that compress well: the files are far below the target
        lines = [_shot("g", p % 50, f"P{p % 50:02d}", 4, 5, 3, 1) for p in range(4000)]
        write_text(f"{root}/shot_charts/season=2024-25/date=2025-01-0{day}/all.csv", "\n".join([SHOT_HEADER, *lines, ""]))
        stream_landing(spark, root, "shot_charts", out, checkpoint=ck)
    before = read_streamed(spark, out, "shot_charts").groupBy("date", "player_name").count().collect()
    monkeypatch.setattr(compaction, "SORT_BYTES", 500_000)
    files = glob.glob(compact(spark, out, "shot_charts") + "/season=*/*.parquet")
    rows = [spark.read.parquet(f).count() for f in files]
    # 8,000 rows of about 350 bytes
    assert sum(rows) == 8000 and len(rows) >= 5 and max(rows) * 350 < 2 * 500_000
    assert sorted(read_streamed(spark, out, "shot_charts").groupBy("date", "player_name").count().collect()) == sorted(before)


def test_players_folders_are_written_as_sparks_writer_does(spark, workdir, monkeypatch):
    import glob

    from courtside.sinks import files
    rows = [(1, 'Al "Ace", J', " x ", None), (1, "a\nb", "", 2.5), (None, "a\r\nb", "é", 1e20), (2, None, None, None), (3, "#", '"', -0.0)]
    df = spark.createDataFrame(rows, 'player_id long, name string, `a,b` string, v double').withColumn("team", F.lit("x/y%z"))
    df = df.unionByName(df.withColumn("player_id", F.col("player_id") + 100)).withColumn("season", F.concat(F.lit("S:"), F.coalesce("player_id", F.lit(0)) % 2))

    def contents(root):
        found = {}
        for f in glob.glob(f"{root}/shot_charts/season=*/date=*/player_id=*/*.csv"):
            with open(f, newline="") as text:
                head, rest = text.read().split("\n", 1)
            found.setdefault(os.path.dirname(f)[len(root):], []).append((head, rest))
        return {k: ({h for h, _ in v}, sorted("".join(r for _, r in v).split("\n"))) for k, v in found.items()}

    land_snapshot(df, f"{workdir}/a", "shot_charts", None, "2025-01-01", by_player=True)
    with monkeypatch.context() as m:  # a store that pyarrow doesn't open
        m.setattr(files, "store_uri", lambda spark, path: None)
        land_snapshot(df, f"{workdir}/b", "shot_charts", None, "2025-01-01", by_player=True)
    got = contents(f"{workdir}/a")
    assert got == contents(f"{workdir}/b") and len(got) == 7
    # only the folders with rows are replaced, and what an unfinished run left isn't read
    write_text(f"{workdir}/a/shot_charts/season=S%3A0/date=2025-01-01/player_id=2/part-0.csv.tmp", "x")
    again = spark.createDataFrame([(2, "new")], "player_id long, name string").withColumn("season", F.lit("S:0"))
    land_snapshot(again, f"{workdir}/a", "shot_charts", None, "2025-01-01", by_player=True)
    now = contents(f"{workdir}/a")
    place = "/shot_charts/season=S%3A0/date=2025-01-01/player_id=2"
    assert now.pop(place) == ({"name"}, ["", "new"]) and got.pop(place) and now == got
    assert os.listdir(f"{workdir}/a{place}") == [os.path.basename(f) for f in glob.glob(f"{workdir}/a{place}/*.csv")]


def test_players_files_take_few_tasks_and_no_lookup_by_the_driver(spark, workdir, monkeypatch):
    from courtside.sources import records
    base = f"{workdir}/shot_charts/season=2024-25/date=2025-01-01"
    for p in range(40):
        write_text(f"{base}/player_id={p}/p.csv", SHOT_HEADER + "\n" + _shot(f"g{p}", p, '"A\nB"', 4, 5, 3, 1) + "\n")
    lines = records.player_lines(spark, [f"{workdir}/shot_charts/season=*/date=*"])
    assert lines.inputFiles() and "binaryFile" in lines._jdf.queryExecution().analyzed().toString()
    small = sorted(map(tuple, read_landing(spark, workdir, "shot_charts").collect()), key=str)
    monkeypatch.setattr(records, "SMALL_BYTES", 100)  # all files in parts
    large = sorted(map(tuple, read_landing(spark, workdir, "shot_charts").collect()), key=str)
    assert small == large and len(small) == 40 and small[0][2] == "A\nB"


def test_players_files_are_opened_once_and_bound_without_a_join(spark, workdir, monkeypatch):
    """Files in players' folders, listed and read whole by tasks, give what Spark's own reader gives."""
    base = f"{workdir}/a/shot_charts/season=2024-25/date=2025-01-01"
    swapped = ",".join(SHOT_HEADER.split(",")[::-1])
    for p in range(12):
        row = _shot(f"g{p}", p, f'"A ""{p}"", B"', 4, 5, 3, "" if p % 2 else 1)
        text = {0: f"{SHOT_HEADER}\n{row}\n", 1: f"\ufeff{SHOT_HEADER.upper()}\r\n\r\n{row}\r\n{SHOT_HEADER}", 2: f"{SHOT_HEADER}\n"}.get(p % 4)
        if text is None:
            text = f"{swapped}\n" + ",".join(row.replace(", B", " B").split(",")[::-1]) + "\n"
        write_text(f"{base}/player_id={p}/p.csv", text)
    for p, name in enumerate(["n%2Fa", "a b", "x%é", "7"]):  # as folders are written; the file has no player
        cells = _shot(f"h{p}", "", "C", 4, 5, 3, 1)
        write_text(f"{base}/player_id={name}/p [1].csv", f"{SHOT_HEADER}\n{cells}\n")
    plan = read_landing(spark, f"{workdir}/a", "shot_charts")._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan and "Join" not in plan
    # the driver names the few files beside players' folders; hidden and unfinished files aren't read
    write_text(f"{base}/all {{1}}.csv", f"{SHOT_HEADER}\n{_shot('g0', 0, 'bulk', 4, 5, 3, 1)}\n{_shot('b', 99, 'bulk', 4, 5, 3, 1)}\n")
    for name in (".x.csv", "_x.csv", "x.csv.tmp"):
        write_text(f"{base}/{name}", "bad")
        write_text(f"{base}/player_id=1/{name}", "bad")
    write_text(f"{base}/player_id=1/_a=b.csv", f"{SHOT_HEADER}\n{_shot('i', 1, 'D', 4, 5, 3, 1)}\n")
    write_text(f"{base}/player_id=5/deep/p.csv", "bad")
    write_text(f"{base}/player_id=6/empty.csv", "")
    # a record over several lines, an open quote
    write_text(f"{base}/player_id=50/p.csv", f"{SHOT_HEADER}\n" + _shot("j", 50, '"A\n\nB"', 4, 5, 3, 1) + "\n" + _shot("k", 50, '"C', 4, 5, 3, 1))
    write_text(f"{workdir}/a/shot_charts/season=2024-25/date=2025-01-02/player_id=0/p.csv", f"{SHOT_HEADER}\n{_shot('l', 0, 'next', 4, 5, 3, 1)}\n")

    def rows():
        return sorted(map(tuple, read_landing(spark, f"{workdir}/a", "shot_charts").collect()), key=str)

    def counted():
        from courtside.sinks.files import landed_counts
        return sorted(map(tuple, landed_counts(spark, base).collect()), key=str)

    got, n = rows(), counted()
    assert len(got) == 3 + 6 + 3 + 4 + 1 + 2 + 1 - 1 + 2  # of 12 files, the odd names, _a=b, 50, the next day; 0 counts once; beside
    assert {r[1] for r in got if r[0] in ("h0", "h1", "h2", "h3")} == {"n%2Fa", "a b", "x%é", "7"} and ("j", "50", "A\n\nB") in {r[:3] for r in got}
    monkeypatch.setattr("courtside.sources.records.SMALL_BYTES", 400)  # some in parts
    monkeypatch.setattr("courtside.sources.player_files.MOST_BESIDE", 0)  # those beside players' folders by a pattern
    assert rows() == got
    monkeypatch.setattr("courtside.sources.player_files.store_uri", lambda spark, path: None)  # a store that pyarrow doesn't open
    assert rows() == got and counted() == n


def test_players_folders_are_dealt_by_number(spark, workdir, monkeypatch):
    monkeypatch.setattr("courtside.stores.FOLDERS_A_TASK", 5, raising=False)
    df = spark.range(60).selectExpr("id AS player_id", "'x' AS team")
    sc = spark.sparkContext
    tracker = sc.statusTracker()
    sc.setJobGroup("land", "land")
    try:
        land_snapshot(df, workdir, "shot_charts", "2024-25", "2025-01-01", by_player=True)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for j in tracker.getJobIdsForGroup("land") for s in tracker.getJobInfo(j).stageIds]
    assert 12 in [i.numTasks for i in map(tracker.getStageInfo, stages) if i]  # 60 folders settled, five a task; names alone are too few bytes for two tasks
    assert len(os.listdir(f"{workdir}/shot_charts/season=2024-25/date=2025-01-01")) == 60


def test_header_history_reads_first_lines_only(spark, workdir):
    from courtside.sources.headers import column_history, file_headers
    base = f"{workdir}/team_standings/season=2024-25"
    rest = "\n1,Atlanta,Hawks,ATL,East,SE,10,5,0.667,6-2,4-3,7-3,110.5,105.2,5.3\n"
    for day, variant in ((1, VARIANT_A), (2, VARIANT_A), (4, VARIANT_B), (5, VARIANT_A), (9, "﻿" + VARIANT_A + "\r")):
        write_text(f"{base}/date=2025-01-{day:02d}/standings.csv", variant + rest)
    write_text(f"{base}/date=2025-01-10/standings.csv", "")
    # a data line that isn't text: whoever reads it fails
    with open(f"{base}/date=2025-01-09/standings.csv", "ab") as f:
        f.write(b"\xff" * 100_000)
    got = {(r.column, r.spelling, r.position, str(r.first_day), str(r.last_day), r.days) for r in column_history(spark, workdir, "team_standings").collect()}
    assert ("wins", "WINS", 7, "2025-01-01", "2025-01-02", 2) in got and ("wins", "WINS", 7, "2025-01-05", "2025-01-09", 2) in got
    assert ("wins", "W", 8, "2025-01-04", "2025-01-04", 1) in got and ("losses", "L", 7, "2025-01-04", "2025-01-04", 1) in got
    assert ("team_id", "TeamID", 1, "2025-01-01", "2025-01-09", 5) in got
    lengths = [len(r.header) for r in file_headers(spark, workdir, "team_standings").where("header IS NOT NULL").collect()]
    assert len(lengths) == 5 and max(lengths) < 200
