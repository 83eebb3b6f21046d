"""Half-court windows on a written game, and grids over a written window."""

from __future__ import annotations

import numpy as np
import pytest

from courtframes.operators import grids as gr
from courtframes.operators import windows as wd

OWN, OTHER = [11, 12, 13, 14, 15], [21, 22, 23, 24, 25]


@pytest.fixture(scope="module")
def game(spark):
    """60 s of frames: the ball comes over the middle at 4 s and at 44 s, is behind it from 30 s, and a substitute of 21 plays from 50 s."""
    rows = []
    for k in range(1500):
        t = 40 * k
        x = 8000 if t < 4000 or 30_000 <= t < 44_000 else 1000
        rows.append((1, 1, t, -1, -1, x, 2500, 300))
        rows += [(1, 1, t, 100, p, 900 + p, 2000, 0) for p in OWN] + [(1, 1, t, 200, 26 if p == 21 and t >= 50_000 else p, 700 + p, 3000, 0) for p in OTHER]
    entities = spark.createDataFrame(rows, "game_id int, period int, unix_ms long, team_id long, player_id long, x_cft long, y_cft long, z_cft long").cache()
    index = spark.createDataFrame([(1, 1, 40 * k, 0 if k < 1400 else 1, 72000 - 4 * k, None if k < 100 else 2400 - 4 * (k % 600)) for k in range(1500)], "game_id int, period int, unix_ms long, segment_id long, game_clock_cs long, shot_clock_cs long").cache()
    direction = spark.createDataFrame([(1, 1, 100, True), (1, 1, 200, False)], "game_id int, period int, team_id long, attacks_left boolean")
    return entities, index, direction


def _times(spark, rows):
    return spark.createDataFrame([(1, 1, n, kind, team, t, t, None, None) for n, kind, team, t in rows], "game_id int, period int, event_num long, msg_type int, team_id long, t_pbp_ms long, t_terminal_ms long, shooter_inferred_id long, method string")


def test_reasons_and_windows(spark, game):
    rows = [(1, 1, 100, 29_000), (2, 2, 100, 29_600), (3, 2, 200, 29_900), (4, 6, 200, 40_000), (5, 5, 100, 44_200), (6, 9, None, None), (7, 2, 100, 48_000), (8, 13, None, 52_000), (9, 2, 100, 57_000), (10, 1, 300, 58_000)]
    got = {r.event_num: r for r in wd.half_court_windows(_times(spark, rows), *game).collect()}
    assert {n: r.outcome for n, r in got.items()} == {
        1: "accepted", 2: "no_crossing:short_window:fg_missed", 3: "frontcourt_too_short", 4: "accepted", 5: "frontcourt_too_short", 6: "terminal_not_located:timeout",
        7: "no_crossing:always_frontcourt:fg_missed", 8: "no_crossing:always_frontcourt:period_end", 9: "no_crossing:always_frontcourt:fg_missed", 10: "offense_unknown_team",
    }
    first = got[1]
    assert (first.t_cross_ms, first.t_start_ms, first.t_end_ms, first.cropped, first.is_transition) == (4000, 5500, 29_500, True, False)
    assert (first.offense_ids, first.defense_ids, first.n_frames, first.w_start_ms, first.prev_event_num) == (OWN, OTHER, 600, 0, None)
    # a foul with the ball in the right half is the attack of the team that goes right
    assert (got[4].offense_team_id, got[4].attacks_left) == (200, False) and got[7].w_start_ms == 44_200 and got[7].prev_event_num == 5


def test_gaps_substitutes_and_second_chances(spark, game):
    one = lambda t: {r.event_num: r for r in wd.half_court_windows(_times(spark, [(1, 4, None, 31_000), (2, 2, 100, t)]), *game).collect()}[2]
    assert (one(48_000).outcome, one(48_000).t_start_ms) == ("accepted", 44_000)
    assert one(54_000).outcome == "lineup_change" and one(58_000).outcome == "gap_in_window"
    assert one(54_000).offense_ids is None
    rows = _times(spark, [(1, 1, 100, 10_000), (2, 2, 100, 20_000)])
    rebounds = spark.createDataFrame([(1, 1, 9_000), (1, 1, 12_000), (1, 1, 15_000), (1, 1, 19_900), (1, 1, None)], "game_id int, period int, t_control_ms long")
    got = {r.event_num: r for r in wd.half_court_windows(rows, *game, rebounds).collect()}
    assert got[1].t_start_ms == 4000 and (got[2].outcome, got[2].t_start_ms) == ("accepted", 15_000)


def test_changes_between_two_tables(spark, game):
    old = wd.half_court_windows(_times(spark, [(1, 2, 100, 20_000), (2, 2, 100, 48_000), (3, 2, 100, 49_000)]), *game)
    new = wd.half_court_windows(_times(spark, [(1, 2, 100, 19_000), (2, 2, 100, 44_100), (3, 2, 100, 49_000)]), *game)
    assert {r.event_num: (r.change, r.end_moved_ms) for r in wd.window_changes(old, new).collect()} == {1: ("moved", -1000), 2: ("dropped", -3900), 3: ("rejected", 0)}
    assert wd.window_changes(old.limit(0), new.limit(0)).count() == 0 and wd.half_court_windows(_times(spark, [(1, 2, 100, 0)]).limit(0), *game).count() == 0


def test_grid_is_numpy_interpolation(spark):
    rng = np.random.default_rng(5)
    times = np.sort(rng.choice(np.arange(0, 4000, 13), 90, replace=False))
    ids = [-1, *OWN, *OTHER]
    xy = {p: rng.integers(0, 5000, (len(times), 3)) for p in ids}
    rows = [(1, 1, int(t), -1 if p < 0 else 100 if p in OWN else 200, p, *(int(v) for v in xy[p][i])) for i, t in enumerate(times) for p in ids]
    entities = spark.createDataFrame(rows, "game_id int, period int, unix_ms long, team_id long, player_id long, x_cft long, y_cft long, z_cft long")
    windows = spark.createDataFrame([(1, 1, 7, 307, 3011, False, OWN[::-1], OTHER)], "game_id int, period int, window long, t_start_ms long, t_end_ms long, attacks_left boolean, offense_ids array<long>, defense_ids array<long>")
    for hz in (5, 25):
        got = gr.grid_entities(windows, entities, hz=hz, n_steps=4 * hz).orderBy("role", "slot", "step").collect()
        assert len(got) == 11 * 4 * hz
        grid = 307 + np.arange(4 * hz) * 1000 / hz
        valid, inside = grid <= 3011, (times >= 107) & (times <= 3211)
        for p in ids:
            role, slot = ("ball", 0) if p < 0 else ("off", OWN.index(p)) if p in OWN else ("def", OTHER.index(p))
            own = [r for r in got if (r.role, r.slot) == (role, slot)]
            x = 9400 - np.interp(np.minimum(grid, 3011), times[inside], xy[p][inside, 0])
            n, v = int(valid.sum()), np.zeros(len(grid))
            v[1 : n - 1] = (x[2:n] - x[: n - 2]) * hz / 2
            v[0], v[n - 1] = (x[1] - x[0]) * hz, (x[n - 1] - x[n - 2]) * hz
            assert [r.valid for r in own] == valid.tolist() and {r.player_id for r in own} == {p}
            np.testing.assert_allclose([r.x_cft for r in own], x)
            np.testing.assert_allclose([r.vx for r in own], v, atol=1e-6)
    places = gr.grid_entities(windows, entities)
    far = gr.grid_distances(places).filter("step = 3").collect()
    assert len(far) == 35
    at = {(r.role, r.slot): r for r in places.filter("step = 3").collect()}
    for r in far:
        a, b = at[r.role, r.slot], at[r.to_role, r.to_slot]
        assert r.distance_cft == pytest.approx(np.hypot(a.x_cft - b.x_cft, a.y_cft - b.y_cft))
    assert gr.grid_entities(windows.limit(0), entities).count() == 0
