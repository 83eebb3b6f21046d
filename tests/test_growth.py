"""Steps that must not grow faster than their tables: plans without rows laid out by row of the log, searches of sorted times, and dense logs."""

from __future__ import annotations

import re
import time

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtframes.functions.text import free_throw
from courtframes.operators import events as ev
from courtframes.operators import frames as fr
from courtframes.operators import kernels as kn
from courtframes.operators import ledger, shot_clock, shots
from courtframes.operators import possessions as po
from tests.test_shots import OFF, SHOOTER, _scene


def _plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_releases_lay_no_frames_out_by_row(spark):
    scene = _scene(spark)
    pbp = spark.createDataFrame([("g", e, 1, 697.0, 1 + e % 2, OFF, SHOOTER) for e in range(400)], "game_id string, event_num int, period int, pctime_sec double, msg_type int, p1_team_id long, p1_id long")
    side = spark.createDataFrame([("g", OFF, 1, True)], "game_id string, team_id long, period int, attacks_left boolean")
    found = shots.releases(scene, fr.frame_index(scene), pbp, side)
    assert "sort_array(collect_list" not in _plan(found)
    rows = sorted(found.collect(), key=lambda r: r.event_num)
    # each attempt lies behind the one before it, until the clock's frames are used up
    times = [r.t_release_ms for r in rows if r.t_release_ms is not None]
    assert len(rows) == 400 and times == sorted(set(times)) and {r.method for r in rows[len(times) :]} == {"unlocated"}


def test_forward_searches_read_a_key_once(spark):
    left = spark.createDataFrame([(1, 5), (1, 10), (1, 30)], "k int, t int")
    right = spark.createDataFrame([(1, 10, "a"), (1, 20, "b")], "k int, t int, v string")
    found = kn.asof(left, right, ["k"], "t", ["v"], forward=True)
    assert "unboundedfollowing" not in _plan(found).lower()
    assert {(r.t, r.match_t, r.v) for r in found.collect()} == {(5, 10, "a"), (10, 10, "a"), (30, None, None)}


def test_times_of_many_possessions_beside_many_frames():
    n, frames = 20_000, 200_000
    index = pd.DataFrame({"unix_ms": 40 * np.arange(frames), "segment_id": 0, "game_clock_cs": 72000.0 - np.arange(frames) // 3})
    ends = pd.DataFrame({"game_id": 1, "period": 1, "poss_seq": np.arange(n), "end_event_num": np.arange(n), "end_type": "turnover", "t_ms": None, "method": None, "clock_cs": 72000.0 - 3 * np.arange(n)})
    begun = time.process_time()
    out = ledger._timed(ends, index)
    assert time.process_time() - begun < 6
    assert out["t_end_ms"].is_monotonic_increasing and set(out["end_time_method"]) == {"clock"}


def test_rows_of_one_clock_ask_once(spark):
    scene = _scene(spark)
    index = fr.frame_index(scene)
    pbp = spark.createDataFrame([("g", e, 1, 697, 1, OFF) for e in range(300)], "game_id string, event_num int, period int, pctime_sec int, msg_type int, p1_team_id long")
    found = fr.locate_clock(index, pbp.select("game_id", "period", "event_num", (pbp["pctime_sec"] * 100).alias("clock_cs")))
    assert len({r.unix_ms for r in found.collect()}) == 1 and found.count() == 300
    places = fr.shot_positions(scene, pbp)
    assert places.count() == 300 and places.select("ball_x_cft", "n_frames").distinct().count() == 1
    # what meets the frames are clocks, so their join comes before the one with the rows of the log
    for df in (found, places):
        assert re.search(r"Generate explode[^\n]*\n[^\n]*Aggregate", _plan(df))


def test_imputed_clock_folds_resets_once(spark):
    index = spark.createDataFrame([(1, 1, 40 * i, 72000 - 4 * i) for i in range(1000)], "game_id long, period long, unix_ms long, game_clock_cs long")
    resets = spark.createDataFrame([(1, 1, 40 * i, None, "full" if i % 20 == 0 else "min14") for i in range(100, 900, 10)], "game_id long, period long, unix_ms long, t_run_ms long, rule string")
    found = shot_clock.imputed(index, resets)
    assert "concat(" not in _plan(found)
    got = {r.unix_ms // 40: r.shot_clock_imputed_cs for r in found.collect()}
    assert (got[0], got[99], got[100], got[110], got[115], got[999]) == (2400, 2400 - 4 * 99, 2400, 2360, 2340, 2360 - 4 * 109)


def test_possessions_run_their_windows_once(spark):
    rows = [("g", 1, 1, 720, 12, 0, None, None, ""), ("g", 2, 1, 700, 1, 1, 100, None, "Layup"), ("g", 3, 1, 680, 3, 1, 200, None, "Free Throw 1 of 1"), ("g", 4, 1, 0, 13, 0, None, None, "")]
    pbp = spark.createDataFrame(rows, "game_id string, event_num int, period int, pctime_sec int, msg_type int, p1_id long, p1_team_id long, p3_team_id long, description string")
    found = po.possessions(pbp)
    assert _plan(found).count("LogicalRDD") == 1
    assert [(r.poss_seq, r.offense_team_id, r.points, r.end_type) for r in found.orderBy("poss_seq").collect()] == [(0, 100, 2, "made_fg"), (1, 200, 1, "made_ft"), (2, 100, 0, "period_end")][: found.count()] and found.count() >= 2


def test_free_throws_are_read_without_failing_casts(spark):
    texts = ["", "MISS Free Throw 1 of 2", "Free Throw Flagrant 2 of 3", "Free Throw Technical", "free throw Clear Path x of 2", "a Free Throw 1 free throw 2 of 2", "Free Throw of 3"]
    read = spark.createDataFrame([(t,) for t in texts], "t string").select(free_throw(F.col("t")).alias("f"))
    assert "try" not in _plan(read).lower()
    assert [tuple(r.f) for r in read.collect()] == [
        ("", None, None, True), ("", 1, 2, False), ("flagrant", 2, 3, True), ("technical", None, None, True), ("clear path", None, None, True), ("", 1, None, True), ("", None, 3, True),
    ]


def test_facts_behind_a_release_lay_no_frames_out_by_shot(spark):
    scene = _scene(spark)
    shots_ = spark.createDataFrame([("g", e, 1, 1 + e % 2, OFF, SHOOTER, True, 40 * e) for e in range(200)], "game_id string, event_num int, period int, msg_type int, team_id long, shooter_id long, attacks_left boolean, t_release_ms long")
    held = ev.handler(scene, fr.frame_index(scene))
    found = shots.after_release(shots_, scene, held)
    assert "sequence(" not in _plan(found) and found.count() == 200


def test_moments_by_the_clock_read_no_entities(spark):
    scene = _scene(spark)
    index = spark.createDataFrame(fr.frame_index(scene).collect())
    pbp = spark.createDataFrame([("g", e, 1, 697.0, 1 + e % 2, OFF, SHOOTER) for e in range(3)], "game_id string, event_num int, period int, pctime_sec double, msg_type int, p1_team_id long, p1_id long")
    side = spark.createDataFrame([("g", OFF, 1, True)], "game_id string, team_id long, period int, attacks_left boolean")
    found = shots.terminal_times(scene, index, pbp, side, refine=False)
    # log, sides and index alone
    assert _plan(found).count("LogicalRDD") == 3
    times = [r.t_terminal_ms for r in found.orderBy("event_num").collect()]
    assert times == sorted(set(times)) and times[0] == index.filter("game_clock_cs between 69700 and 69799").orderBy(F.abs(2 * (F.col("game_clock_cs") - 69700) - 100), "unix_ms").first().unix_ms


def test_tasks_of_frames_follow_the_rows(spark):
    rows = spark.range(1000).selectExpr("id % 7 as k", "id as v")
    assert kn.dealt(rows, ["k"], rows=100).rdd.getNumPartitions() == 10
    assert kn.dealt(rows.filter("v < 10"), ["k"], of=rows, rows=100).rdd.getNumPartitions() == 10
    assert kn.dealt(rows, ["k"]).rdd.getNumPartitions() == 4
    raw = spark.createDataFrame([("g", 1, 40 * i, -1, -1, 0, 0, 0, 72000 - 4 * i, 2400, 1, i) for i in range(50)], "game_id string, period int, unix_ms long, team_id long, player_id long, x_cft int, y_cft int, z_cft int, game_clock_cs int, shot_clock_cs int, event_id int, moment_idx int")
    # a dealing by number is kept as it is, however small its parts
    assert "RepartitionByExpression [game_id#" in _plan(fr.dedup_entities(raw)) and ", 4" in next(line for line in _plan(fr.dedup_entities(raw)).splitlines() if "RepartitionByExpression" in line)


def _dealings(df: DataFrame) -> int:
    return _plan(df).count("RepartitionByExpression")


def test_steps_of_handlers_are_dealt_by_their_rows(spark):
    scene = _scene(spark)
    index = fr.frame_index(scene)
    made = ev.handler(scene, index)
    held = spark.createDataFrame(made.collect(), made.schema)
    side = spark.createDataFrame([("g", OFF, 1, True)], "game_id string, team_id long, period int, attacks_left boolean")
    assert _dealings(made) == 2
    assert _dealings(ev.touches(held)) == 1 and _dealings(ev.flights(held, scene)) == 2
    assert _dealings(ev.incomplete_passes(ev.flights(held, scene), held)) == 3
    # frames between release and catch are counted along the segment, and both places come from one dealing of players; touches are read for both sides
    moves = _plan(ev.transfers(held, scene))
    assert "explode" not in moves and moves.count("RepartitionByExpression") == 3 and moves.count("Join") == 2
    assert _dealings(ev.approaches(scene, held, side)) == 2 and _dealings(ev.postups(scene, held, side)) == 2


def test_screens_meet_in_one_list_of_players(spark):
    scene = _scene(spark)
    made = ev.handler(scene, fr.frame_index(scene))
    held = spark.createDataFrame(made.collect(), made.schema)
    plan = _plan(ev.screens(scene, held))
    assert plan.count("Join") == 1 and plan.count("RepartitionByExpression") == 2


def test_rules_of_release_read_one_stored_search(spark):
    scene = _scene(spark)
    index = fr.frame_index(scene)
    pbp = spark.createDataFrame([("g", e, 1, 697.0, 1 + e % 2, OFF, SHOOTER) for e in range(40)], "game_id string, event_num int, period int, pctime_sec double, msg_type int, p1_team_id long, p1_id long")
    side = spark.createDataFrame([("g", OFF, 1, True)], "game_id string, team_id long, period int, attacks_left boolean")
    asked = shots.searched(scene, index).cache()
    for rule in ({}, {"shooter_only": True}):
        own = shots.terminal_times(scene, index, pbp, side, **rule).collect()
        found = shots.terminal_times(scene, index, pbp, side, asked=asked, **rule).collect()
        assert sorted(map(str, own)) == sorted(map(str, found)) and own
