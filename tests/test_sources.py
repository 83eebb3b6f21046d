"""Sources, sinks, matching, ledger walks, names and the streaming form on small inputs."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from courtframes.functions import rules
from courtframes.functions.text import clock_seconds, free_throw, margin, person_name
from courtframes.operators import events as ev
from courtframes.operators import matching, possessions
from courtframes.sources import raw, tables
from courtframes.streaming import frames as stream


@pytest.fixture(scope="module")
def games(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("games")
    side = lambda t: {"teamid": t, "abbreviation": f"T{t}", "players": [{"playerid": t + 1, "firstname": "A", "lastname": "B", "jersey": "7", "position": "G"}]}
    moments = [[1, 1000 + 40 * k, 720.0 - 0.04 * k, None if k == 1 else 24.0, None, [[-1, -1, 1.0, 2.0, 3.0], [100, 101, 4.0, 5.0, 0.0]]] for k in range(3)] + [[1, 2000, 700.0, 20.0, None, []]]
    game = {"gameid": "21500001", "gamedate": "2016-01-01", "events": [{"eventId": "7", "home": side(100), "visitor": side(200), "moments": moments}, {"eventId": "8", "home": side(100), "visitor": side(200), "moments": []}]}
    (folder / "a.json").write_text(json.dumps(game))
    (folder / "b.json").write_text("{}")
    return raw.read_games(spark, str(folder))


def test_raw_json(games):
    rows = raw.entity_rows(games).orderBy("unix_ms", "team_id").collect()
    assert len(rows) == 6 and rows[0].game_id == "0021500001" and rows[0].z == 3.0
    assert [r.shot_clock for r in rows[::2]] == [24.0, None, 24.0]
    (event,) = raw.tracking_events(games).collect()
    assert (event.event_id, event.n_moments, event.t_start_ms, event.t_end_ms) == (7, 4, 1000, 2000)
    assert {(r.side, r.player_id) for r in raw.roster(games).collect()} == {("home", 101), ("visitor", 201)}
    assert [r.reason for r in raw.problems(games).collect()] == ["no_game"]


def test_pbp_csv(spark, tmp_path):
    head = "GAME_ID,EVENTNUM,EVENTMSGTYPE,EVENTMSGACTIONTYPE,PERIOD,PCTIMESTRING,PLAYER1_ID,PLAYER1_TEAM_ID,SCORE,SCOREMARGIN,HOMEDESCRIPTION,VISITORDESCRIPTION"
    (tmp_path / "p.csv").write_text(f"{head}\n21500001,2,1,5,1,11:40,203.0,1610.0,2 - 0,-2,,Layup\n21500001,3,99,0,1,bad,,,,TIE,x,\n")
    a, b = tables.read_pbp(spark, str(tmp_path / "p.csv")).orderBy("event_num").collect()
    assert (a.game_id, a.pctime_sec, a.p1_id, a.score_visitor, a.score_home, a.score_margin, a.msg_name) == ("0021500001", 700, 203, 2, 0, -2, "made")
    assert (b.pctime_sec, b.p1_id, b.score_margin, b.msg_name) == (None, None, 0, "other")


def test_catalog_round_trip(spark, tmp_path):
    store = tables.Catalog(spark, str(tmp_path))
    df = spark.createDataFrame([("g1", 1, "pass", 1.0, None), ("g2", 2, "shot", None, "x")], "game_id string, t int, event_type string, a double, b string")
    store.write(df, "events", "v1", by_game=True, order=["t"])
    assert store.table("events", "v1", "g1", ["t"]).collect()[0].t == 1
    assert set(store.events(["pass"], "v1").columns) == {"game_id", "t", "event_type", "a"}
    store.write(df.withColumn("t", F.col("t") + F.when(F.col("t") == 2, 1).otherwise(0)), "events", "v2")
    state = lambda x, y: tables.compare_manifests(store.manifest(["events"], x), store.manifest(["events"], y)).first().state
    assert state("v1", "v1") == "same" and state("v1", "v2") == "different"
    wide = df.withColumn("x_start", F.lit(1)).withColumn("shot_x", F.lit(2))
    assert "x_start" not in tables.public_columns(wide).columns and "shot_x" in tables.public_columns(wide, "shot").columns
    assert tables.pick_games(df, 1).count() == 1


def test_greedy_match_and_resolution(spark):
    old = spark.createDataFrame([("k", 1, 1000), ("k", 2, 1100), ("z", 3, 0)], "kind string, id int, t long")
    new = spark.createDataFrame([("k", 11, 1090), ("k", 12, 1210), ("z", 13, 900)], "kind string, id int, t long")
    got = matching.greedy_match(old, new, ["kind"], "t", "id", "id", 200)
    assert {(r.old_id, r.new_id) for r in got.collect()} == {(2, 11)}
    names = spark.createDataFrame([("ann", "A"), ("bob", "B"), ("cy", "C")], "name string, team string")
    known = spark.createDataFrame([("ann", "A", 1), ("bob", "X", 2), ("cy", "D", 3), ("cy", "E", 4)], "name string, team string, id int")
    assert {(r.name, r.id, r.match) for r in matching.resolve(names, known, "name", "team", "id").collect()} == {("ann", 1, "name_group"), ("bob", 2, "name"), ("cy", None, "none")}


PBP = "game_id string, event_num int, period int, pctime_sec double, msg_type int, action_type int, p1_team_id long, p1_id long, p3_team_id long, description string, p1_is_team boolean"


def _pbp(spark, rows):
    return spark.createDataFrame([("g", n, 1, float(c), m, 0, t, None if t is None else t + 1, p3, d, team) for n, (c, m, t, p3, d, team) in enumerate(rows)], PBP)


def test_possession_walk(spark):
    a, b = 100, 200
    held = _pbp(spark, [(720, 12, None, None, "", False), (720, 10, a, a, "", False), (700, 2, a, None, "MISS", False), (698, 4, b, None, "", False), (690, 10, a, a, "", False), (690, 5, b, None, "Lost Ball", False), (680, 1, a, None, "3PT", False), (600, 13, None, None, "", False)])
    rows = possessions.possessions(held).orderBy("poss_seq").collect()
    # the period ends on a basket, so the other team has the ball at its end
    assert [r.offense_team_id for r in rows] == [a, b, a, b]
    assert [r.end_type for r in rows] == ["defensive_rebound", "jump_ball_lost", "made_fg", "period_end"] and rows[2].points == 3
    late = _pbp(spark, [(720, 12, None, None, "", False), (700, 3, a, None, "MISS Free Throw 1 of 2", False), (700, 3, a, None, "Free Throw 2 of 2", False), (700, 4, a, None, "Team Rebound", True), (650, 2, b, None, "MISS", False), (600, 13, None, None, "", False)])
    rows = possessions.possessions(late).orderBy("poss_seq").collect()
    assert [(r.offense_team_id, r.end_type) for r in rows] == [(a, "made_ft"), (b, "period_end")]
    andone = _pbp(spark, [(720, 12, None, None, "", False), (700, 1, a, None, "Layup", False), (700, 6, b, None, "", False), (700, 3, a, None, "Free Throw 1 of 1", False), (680, 2, b, None, "MISS", False), (600, 13, None, None, "", False)])
    rows = possessions.possessions(andone).orderBy("poss_seq").collect()
    assert [(r.offense_team_id, r.points, r.end_type) for r in rows] == [(a, 3, "made_ft"), (b, 0, "period_end")]
    found = {r.event_num: (r.poss_seq, r.role) for r in possessions.possession_map(andone, possessions.possessions(andone)).collect()}
    assert found[1] == (0, "offense") and found[2] == (0, "defense") and found[4] == (1, "offense")


def test_text_and_rules(spark):
    df = spark.createDataFrame([("José A. B. Núñez Jr.", "11:05", "TIE", "MISS O'Neal Free Throw Clear Path 1 of 2")], "n string, c string, m string, d string")
    r = df.select(person_name(F.col("n")).alias("n"), clock_seconds(F.col("c")).alias("c"), margin(F.col("m")).alias("m"), free_throw(F.col("d")).alias("f")).first()
    assert (r.n, r.c, r.m) == ("jose ab nunez", 665, 0)
    assert tuple(r.f) == ("clear path", 1, 2, False)
    state = spark.range(1).select(rules.in_penalty(F.lit(1), F.lit(300.0), F.lit(4), F.lit(0)).alias("a"), rules.in_penalty(F.lit(5), F.lit(300.0), F.lit(2), F.lit(0)).alias("b"), rules.in_penalty(F.lit(4), F.lit(100.0), F.lit(1), F.lit(1)).alias("c"), rules.shot_clock_after_foul(F.lit(9.0), F.lit(True)).alias("d")).first()
    assert (state.a, state.b, state.c, state.d) == (True, False, True, 14.0)


def test_screen_on_scripted_frames(spark):
    rows = []
    for k in range(30):
        t = 1000 + 40 * k
        places = {-1: (2000, 2500, 400), 1001: (2100, 2500, 0), 1002: (3000, 2500, 0), 1003: (3000, 2900, 0), 2001: (3000, 2750, 0), 2002: (6000, 100, 0)}
        for p, (x, y, z) in places.items():
            team = -1 if p == -1 else 100 if p < 2000 else 200
            rows.append((1, 1, t, team, p, x, y, z))
    entities = spark.createDataFrame(rows, "game_id int, period int, unix_ms long, team_id int, player_id int, x_cft int, y_cft int, z_cft int")
    index = entities.groupBy("game_id", "period", "unix_ms").agg(F.lit(0).cast("long").alias("segment_id"), F.lit(True).alias("has_ball"))
    handlers = ev.handler(entities, index)
    assert {r.handler_id for r in handlers.collect()} == {1001}
    found = {(r.s, r.u, r.d) for r in ev.screens(entities, handlers).collect()}
    assert (1002, 1003, 2001) in found and all(s != 1001 for s, _, _ in found)


def test_streaming_dedup(spark, tmp_path):
    rows = [(1, 1, 1000 + 40 * k, -1 if p == 0 else 100, p) for k in range(50) for p in range(3)]
    df = spark.createDataFrame(rows + rows[:60], "game_id int, period int, unix_ms long, team_id int, player_id int")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    live = stream.dedup_entities(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    q = live.writeStream.format("memory").queryName("deduped").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("deduped").count() == len(rows)
