"""Steps that shuffle, spill and write no more than they need: shared dealings, few passes over a game, and the same rows as the plain steps."""

from __future__ import annotations

import random

from courtframes.operators import events as ev
from courtframes.operators import frames as fr
from courtframes.operators import kernels as kn
from courtframes.operators import possessions as po
from courtframes.operators import shots
from tests.test_growth import _dealings, _plan
from tests.test_shots import OFF, SHOOTER, _scene


def _kept(spark, df):
    return spark.createDataFrame(df.collect(), df.schema)


def _rows(df):
    return sorted(map(str, df.collect()))


def _walks(spark):
    """A ball that goes from player to player, at times without a ball or without players."""
    rng, rows, at, up = random.Random(3), [], 0, 0
    for i in range(1500):
        at, up = (rng.randrange(6), rng.choice([0, 0, 6])) if rng.random() < 0.03 else (at, up - 1)
        row = ("g", 1 + i // 800, 1_000_000 + 40 * i + 5000 * (i // 300), 70000 - 4 * i)
        if rng.random() < 0.995:
            rows.append((*row, -1, -1, 1000 * at + 60, 2500, 1100 if up > 0 else 300 + i % 7, 2400, 0, i))
        if rng.random() < 0.995:
            rows += [(*row, 100 * (1 + p % 2), p, 1000 * p + rng.randrange(-30, 30), 2500 + rng.choice([0, 0, 200]), 0, 2400, 0, i) for p in range(6)]
    return spark.createDataFrame(rows, "game_id string, period int, unix_ms long, game_clock_cs long, team_id long, player_id long, x_cft long, y_cft long, z_cft long, shot_clock_cs long, event_id long, moment_idx long")


def test_handlers_and_searches_read_one_dealing_of_players(spark):
    for scene in (_scene(spark), _walks(spark)):
        index = _kept(spark, fr.frame_index(scene))
        made = ev.ball_frames(scene, index, shots.HAND_CFT)
        assert _dealings(made) == 1
        near = _kept(spark, made)
        held = ev.handler(scene, index, near)
        assert _rows(held.drop("bx", "by")) == _rows(ev.handler(scene, index)) and _dealings(held) == 1
        # of frames without a ball searches ask the clock alone
        asked, want = shots.searched_near(near), shots.searched(scene, index)
        assert _dealings(asked) == 1 and "Join" not in _plan(asked)
        teams = lambda df: df.selectExpr(*[f"array_sort({c}) as {c}" if c == "teams" else c for c in want.columns])
        assert _rows(teams(asked.filter("ball"))) == _rows(teams(want.filter("ball")))
        clocks = ["game_id", "period", "unix_ms", "segment_id", "game_clock_cs", "ball"]
        assert _rows(asked.select(*clocks)) == _rows(want.select(*clocks))
        held = _kept(spark, held)
        assert _dealings(ev.flights(held, scene)) == 1 and _rows(ev.flights(held, scene)) == _rows(ev.flights(held.drop("bx", "by"), scene))


def test_few_changes_go_to_the_players(spark, monkeypatch):
    scene = _walks(spark)
    held = _kept(spark, ev.handler(scene, fr.frame_index(scene)))
    pairs, want = _kept(spark, ev.changes(held)), _rows(ev.transfers(held, scene))
    found = ev.transfers(held, scene, pairs)
    assert len(want) > 5 and _rows(found) == want and _dealings(found) == 0
    monkeypatch.setattr(ev, "FEW_PAIRS", 3)
    found = ev.transfers(held, scene, pairs)
    assert _rows(found) == want and _dealings(found) == 1


def test_facts_behind_a_release_come_from_one_dealing(spark):
    scene = _scene(spark)
    own = spark.createDataFrame([("g", e, 1, 1 + e % 2, OFF, SHOOTER, True, 1_447_287_043_000 + 40 * e) for e in range(100)], "game_id string, event_num int, period int, msg_type int, team_id long, shooter_id long, attacks_left boolean, t_release_ms long")
    held = _kept(spark, ev.handler(scene, fr.frame_index(scene)))
    plan = shots.after_release(own, scene, held)
    assert _dealings(plan) == 1 and plan._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_possessions_pass_a_game_six_times(spark):
    rows = [("g", 1, 1, 720, 12, 0, None, None, ""), ("g", 2, 1, 700, 1, 1, 100, None, "Layup"), ("g", 3, 1, 680, 3, 1, 200, None, "Free Throw 1 of 1"), ("g", 4, 1, 0, 13, 0, None, None, "")]
    pbp = spark.createDataFrame(rows, "game_id string, event_num int, period int, pctime_sec int, msg_type int, p1_id long, p1_team_id long, p3_team_id long, description string")
    passes = [line for line in _plan(po.possessions(pbp)).splitlines() if "Window [" in line and ("[game_id#" in line.rsplit(" AS ", 1)[1])]
    by_game = [line for line in passes if "period#" not in line.rsplit(" AS ", 1)[1]]
    assert 0 < len(by_game) <= 6
    # texts are read below the first dealing and go no further
    assert not any("description#" in line for line in passes)


def test_dealings_stay_within_the_unsorted_shuffle(spark):
    assert [kn.tasks_of(n * 10**6) for n in (1, 75, 450, 800, 1000)] == [1, 75, 200, 200, 250]
    assert kn.tasks_of(1000, 100) == 10
