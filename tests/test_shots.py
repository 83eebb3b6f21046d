"""Shot releases on a written scene: a pass, a hold, an arc into the hoop."""

from __future__ import annotations

import pytest

from courtframes.operators import frames as fr
from courtframes.operators import shots, spans

T0, OFF, SHOOTER, BIG, PASSER = 1_447_287_043_000, 100, 1000, 1001, 1002


def _scene(spark, arc_x=None):
    rows = []
    for i in range(125):
        t = i * 0.04
        if t < 0.6:
            bx, bz = 3500, 400
        elif t < 0.9:
            bx, bz = 3500 - 1000 * (t - 0.6) / 0.3, 600
        elif t < 2:
            bx, bz = 2500, 320
        elif t < 3:
            f = t - 2
            bx, bz = 2500 - 1975 * f, 800 + 1800 * f - 1600 * f * f
            bx = arc_x if arc_x and t >= 2.8 else bx
        else:
            bx, bz = arc_x or 525, max(0, 1000 - 3000 * (t - 3))
        row = ("g", 1, T0 + 40 * i, int(70090 - 4 * i))
        rows.append((*row, -1, -1, int(bx), 2500, int(bz), 2400, 0, i))
        rows += [(*row, OFF, p, x, y, 0, 2400, 0, i) for p, x, y in ((SHOOTER, 2500, 2550), (BIG, 625, 2600), (PASSER, 3500, 2500))]
    return spark.createDataFrame(rows, "game_id string, period int, unix_ms long, game_clock_cs long, team_id long, player_id long, x_cft long, y_cft long, z_cft long, shot_clock_cs long, event_id long, moment_idx long")


def _run(spark, scene, log, known=True):
    pbp = spark.createDataFrame([("g", e, 1, float(c), m, OFF, p) for e, c, m, p in log], "game_id string, event_num int, period int, pctime_sec double, msg_type int, p1_team_id long, p1_id long")
    side = spark.createDataFrame([("g", OFF, 1, True)] if known else [], "game_id string, team_id long, period int, attacks_left boolean")
    return {r.event_num: r for r in shots.releases(scene, fr.frame_index(scene), pbp, side).collect()}


@pytest.fixture(scope="module")
def scene(spark):
    return _scene(spark).cache()


def test_release_by_rim_contact(spark, scene):
    r = _run(spark, scene, [(5, 697, 1, SHOOTER)])[5]
    assert r.method == "rim" and r.shooter_inferred_id == SHOOTER and T0 + 2000 <= r.t_release_ms <= T0 + 2200


def test_release_by_highest_point(spark):
    r = _run(spark, _scene(spark, arc_x=3000), [(5, 697, 1, SHOOTER)])[5]
    assert r.method == "apex" and r.shooter_inferred_id == SHOOTER


def test_unknown_shooter_stranger_and_unknown_side(spark, scene):
    assert _run(spark, scene, [(5, 697, 1, None)])[5].method == "rim"
    r = _run(spark, scene, [(5, 697, 1, 77)])[5]
    assert r.method == "rim_anyhand" and r.shooter_inferred_id == SHOOTER
    r = _run(spark, scene, [(5, 697, 1, SHOOTER)], known=False)[5]
    assert (r.method, r.t_release_ms, r.t_pbp_ms) == ("unlocated", None, None)
    assert _run(spark, scene, [(5, 300, 1, SHOOTER)])[5].method == "unlocated"


def test_second_attempt_looks_after_the_first(spark, scene):
    rows = _run(spark, scene, [(5, 697, 2, SHOOTER), (6, 697, 1, SHOOTER)])
    assert rows[5].method == "rim" and rows[6].t_release_ms > rows[5].t_release_ms
    # a stoppage after the shot leaves no rim contact to the attempt behind it
    late = _run(spark, scene, [(5, 696, 5, None), (6, 696, 1, SHOOTER)])[6]
    assert late.method == "pbp" and late.t_release_ms == late.t_pbp_ms


def test_facts_after_the_release(spark, scene):
    own = spark.createDataFrame([("g", 1, 5, 2, OFF, SHOOTER, True, T0 + 3000, T0 + 2100, SHOOTER, "rim"), ("g", 1, 6, 1, OFF, SHOOTER, True, T0 + 3900, T0 + 2100, SHOOTER, "rim"), ("g", 1, 7, 2, OFF, SHOOTER, None, None, None, None, "unlocated")], "game_id string, period int, " + shots.OUT)
    held = spark.createDataFrame([("g", 1, T0 + 40 * i, 0, BIG if i >= 90 else -1, OFF) for i in range(125)], "game_id string, period int, unix_ms long, segment_id long, handler_id long, control_team_id long")
    rows = {r.event_num: r for r in shots.settle_releases(shots.after_release(own, scene, held)).collect()}
    assert rows[6].method == "duplicate_release" and rows[6].t_release_ms is None and rows[6].t_rim_ms is None
    r = rows[5]
    assert (r.control_id, r.t_control_ms, r.offensive_rebound) == (BIG, T0 + 3600, True)
    assert T0 + 2800 < r.t_rim_ms <= T0 + 3040 and r.t_landing_ms > r.t_rim_ms
    assert rows[7].method == "unlocated" and (rows[7].t_rim_ms, rows[7].control_id, rows[7].offensive_rebound) == (None, None, None)


def test_direction_check_by_the_hoop_reached(spark, scene):
    pbp = spark.createDataFrame([("g", e, 1, c, 1, OFF, SHOOTER) for e, c in ((5, 697.0), (6, 400.0))], "game_id string, event_num int, period int, pctime_sec double, msg_type int, p1_team_id long, p1_id long")
    for left, agree in ((True, 1), (False, 0)):
        side = spark.createDataFrame([("g", OFF, 1, left)], "game_id string, team_id long, period int, attacks_left boolean")
        r = spans.direction_check(scene, pbp, side).collect()[0]
        assert (r.n_shots_rim, r.n_agree, r.n_no_rim) == (1, agree, 0)


def test_windows_between_inside_and_outside_possessions(spark):
    ledger = spark.createDataFrame([("g", 1, 1, 100, 0, 1000), ("g", 1, 2, 200, 1000, 2000), ("g", 1, 3, 100, None, None)], "game_id string, period int, poss_seq long, offense_team_id long, t_start_ms long, t_end_ms long")
    windows = spark.createDataFrame([("g", 1, n, a, b, 100) for n, a, b in (("tie", 500, 1500), ("second", 900, 1900), ("moment", 1000, 1000), ("outside", 5000, 6000))], "game_id string, period int, window string, lo long, hi long, team_id long")
    got = {r.window: (r.poss_seq, r.overlap_frac, r.offense_match) for r in spans.attach_possession(windows, ledger).collect()}
    assert got == {"tie": (1, 0.5, True), "second": (2, 0.9, False), "moment": (2, 1.0, False), "outside": (None, 0.0, None)}
