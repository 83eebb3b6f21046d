"""Possessions, free throws and their fouls on written cases."""

from __future__ import annotations

import pytest

from courtframes.operators import frames, playbyplay, possessions

A, B = 1610, 1611
ROW = "game_id string, event_num int, period int, pctime_sec double, msg_type int, action_type int, p1_team_id long, p1_id long, p3_team_id long, description string, p1_is_team boolean, score_margin int"


def _rows(spark, rows, end=True):
    """(event, clock, type, action, player, team, winner, text, team row)."""
    own = [(1, 720.0, 12, 0, None, None, None, "", False), (2, 719.0, 10, 0, 11, A, A, "Jump Ball", False), *rows]
    own += [(99, 0.0, 13, 0, None, None, None, "", False)] if end else []
    full = [("g", e, 1, float(c), m, a, t, p, w, d, k, None) for e, c, m, a, p, t, w, d, k in own]
    return spark.createDataFrame(full, ROW)


def _walk(spark, rows, **options):
    return possessions.possessions(_rows(spark, rows, **options)).orderBy("poss_seq").collect()


HELD = [(3, 700, 10, 0, 11, A, B, "Jump Ball: Tip to B", False), (4, 700, 5, 40, 11, A, None, "Poss Lost Ball Turnover", False), (5, 690, 1, 1, 21, B, None, "Jump Shot", False)]
LATE = [(3, 700, 3, 11, 11, A, None, "MISS Free Throw 1 of 2", False), (4, 700, 3, 12, 11, A, None, "Free Throw 2 of 2", False), (5, 700, 4, 0, None, A, None, "Team Rebound", True), (6, 690, 2, 1, 21, B, None, "MISS Jump Shot", False)]
CLEAR = [(3, 700, 3, 25, 11, A, None, "Free Throw Clear Path 1 of 2", False), (4, 700, 3, 26, 11, A, None, "Free Throw Clear Path 2 of 2", False), (5, 690, 1, 1, 11, A, None, "Jump Shot", False)]
REVERSED = [(6, 700, 3, 12, 11, A, None, "Free Throw 2 of 2", False), (7, 700, 3, 11, 11, A, None, "Free Throw 1 of 2", False), (8, 690, 1, 1, 21, B, None, "Jump Shot", False)]
PUTBACK = [(3, 700, 2, 1, 11, A, None, "MISS Jump Shot", False), (4, 699, 1, 1, 12, A, None, "Putback Layup", False), (5, 699, 4, 0, 12, A, None, "REBOUND (Off:1)", False), (6, 680, 10, 0, 21, B, A, "Jump Ball: Tip to A", False), (7, 680, 5, 40, 21, B, None, "Poss Lost Ball Turnover", False)]


def test_period_that_ends_on_a_basket_and_a_held_ball(spark):
    rows = _walk(spark, HELD)
    assert [r.offense_team_id for r in rows] == [A, B, A]
    assert [r.end_type for r in rows] == ["jump_ball_lost", "made_fg", "period_end"]
    assert [r.event_nums for r in rows] == [[1, 2, 3, 4], [5], [99]] and rows[0].start_type == "jump_ball"


def test_late_team_rebound(spark):
    rows = _walk(spark, LATE)
    assert [(r.offense_team_id, r.end_type) for r in rows] == [(A, "made_ft"), (B, "period_end")]
    assert rows[0].event_nums == [1, 2, 3, 4, 5] and rows[0].n_oreb == 0 and (rows[0].n_fta, rows[0].points) == (2, 1)


def test_clear_path_keeps_the_ball(spark):
    rows = _walk(spark, CLEAR)
    assert (rows[0].offense_team_id, rows[0].points, rows[0].end_type) == (A, 4, "made_fg")


def test_reversed_numbers_of_free_throws(spark):
    assert [r.end_type for r in _walk(spark, REVERSED)][:2] == ["made_ft", "made_fg"]


def test_putback_and_map(spark):
    rows = _walk(spark, PUTBACK)
    assert [r.end_type for r in rows][:2] == ["made_fg", "jump_ball_lost"] and rows[0].n_oreb == 1
    pbp = _rows(spark, PUTBACK)
    found = {r.event_num: r.poss_seq for r in possessions.possession_map(pbp, possessions.possessions(pbp)).collect()}
    assert found[3] == found[4] == found[5] == 0 and found[6] == found[7] == 1


def test_extra_free_throw_technical_and_unrecorded_changes(spark):
    rows = [(3, 700, 1, 1, 11, A, None, "3PT Shot", False), (4, 700, 6, 2, 21, B, None, "", False), (5, 700, 3, 10, 11, A, None, "MISS Free Throw 1 of 1", False), (6, 698, 4, 0, 21, B, None, "", False)]
    rows += [(7, 690, 3, 16, 12, A, None, "Free Throw Technical", False), (8, 680, 2, 1, 12, A, None, "MISS", False), (9, 679, 5, 1, 21, B, None, "Bad Pass", False)]
    got = [(r.offense_team_id, r.start_type, r.end_type, r.points, r.tech_offense, r.tech_defense, r.n_fta) for r in _walk(spark, rows, end=False)]
    assert got == [
        (A, "jump_ball", "defensive_rebound", 3, 0, 0, 1),
        (B, "defensive_rebound", "unrecorded_change", 0, 0, 1, 0),
        (A, "unrecorded_change", "unrecorded_change", 0, 0, 0, 0),
        (B, "unrecorded_change", "turnover", 0, 0, 0, 0),
        (A, "turnover", "game_end", 0, 0, 0, 0),
    ]


def test_empty_play_by_play(spark):
    assert possessions.possessions(_rows(spark, []).limit(0)).count() == 0


@pytest.mark.parametrize("action,text,kind,linked", [(11, "Free Throw Technical", "technical", True), (17, "Free Throw Technical", "technical", True), (18, "Free Throw Technical", "technical", True), (19, "Free Throw Technical", "technical", True), (2, "Free Throw Technical", "technical", False), (9, "Free Throw Clear Path 1 of 2", "clear_path", True), (14, "MISS Free Throw Flagrant 1 of 2", "flagrant", True), (2, "Free Throw 1 of 2", "regular", True), (4, "Free Throw 1 of 2", "regular", True)])
def test_free_throws_take_the_foul_they_follow(spark, action, text, kind, linked):
    rows = [(3, 700, 6, action, 21, B, None, "", False), (4, 700, 3, 10, 11, A, None, text, False)]
    found = playbyplay.free_throw_links(_rows(spark, rows)).collect()
    assert [(r.kind, r.foul_event_num) for r in found] == [(kind, 3 if linked else None)]


def test_margin_before_terminal_events(spark):
    rows = [(3, 700, 1, 1, 11, A, None, "Layup", False), (4, 690, 1, 1, 21, B, None, "Layup", False), (5, 680, 5, 1, 11, A, None, "", False)]
    pbp = _rows(spark, rows).selectExpr("* except(score_margin)", "case event_num when 3 then 2 when 4 then 0 end as score_margin")
    assert [(r.event_num, r.margin_before) for r in frames.terminal_events(pbp).orderBy("event_num").collect()] == [(3, 0), (4, 2), (5, 0), (99, 0)]


def test_clock_reading_after_a_time(spark):
    index = spark.createDataFrame([("g", 1, 1000 + 40 * k, k // 5, 5000 + 4 * (k % 5)) for k in range(10)], "game_id string, period int, unix_ms long, segment_id long, game_clock_cs int")
    asked = spark.createDataFrame([("g", 1, 1, 4950, None), ("g", 1, 2, 4950, 1100)], "game_id string, period int, n int, clock_cs int, after_ms long")
    got = {r.n: r.unix_ms for r in frames.locate_clock(index, asked).collect()}
    assert got == {1: 1000, 2: 1120}
