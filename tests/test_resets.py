"""Resets of the shot clock against a plain walk over random scenes."""

from __future__ import annotations

import random
from statistics import median

import pytest

from courtframes.operators import resets as rs

SCHEMAS = {
    "ledger": "game_id int, period int, poss_seq int, t_start_ms long, offense_team_id int, start_type string",
    "shots": "game_id int, period int, made boolean, t_rim_ms long, t_control_ms long",
    "inbounds": "game_id int, period int, t_catch_ms long",
    "fouls": "game_id int, period int, event_num int, committed_by_team int, detail string, n_free_throws int",
    "pbp": "game_id int, period int, event_num int, msg_type int, action_type int, p1_team_id int",
    "aligned": "game_id int, event_num int, t_ms long",
    "index": "game_id int, period int, unix_ms long, clock_frozen boolean",
    "ball": "game_id int, period int, unix_ms long, bx long, by long",
    "direction": "game_id int, period int, team_id int, attacks_left boolean",
}
STARTS = ["defensive_rebound", "turnover", "made_basket_inbound", "period_start"]
DETAILS = ["personal", "personal_take", "shooting", "flagrant_1", "defensive_3_seconds", "delay_of_game", "offensive"]


def scene(rng, game, period, sparse):
    """Tables of one period of 4,000 frames and a few dozen calls, as lists of rows."""
    t0, out = 10**7 * (2 * game + period), {name: [] for name in SCHEMAS}
    when = lambda: t0 + 40 * rng.randrange(4000)
    x, y = 4700, 2500
    for k in range(4000):
        x, y = min(9700, max(-300, x + rng.randrange(-250, 251))), min(5300, max(-300, y + rng.randrange(-150, 151)))
        out["index"].append((game, period, t0 + 40 * k, (k // 50) % 4 == 0))
        out["ball"].append((game, period, t0 + 40 * k, x, y))
    for i in range(4 if sparse else 12):
        out["ledger"].append((game, period, i, None if i == 3 else when(), rng.choice([1, 2]), rng.choice(STARTS)))
        rim = when()
        out["shots"].append((game, period, rng.choice([True, False, False, None]), rng.choice([rim, rim, None]), rng.choice([rim + 800, None])))
        out["inbounds"].append((game, period, rng.choice([when(), None])))
        num = 1000 * period + i
        if rng.random() < 0.5:
            out["fouls"].append((game, period, num, rng.choice([1, 2, None]), rng.choice(DETAILS), rng.choice([0, 0, 2])))
        else:
            out["pbp"].append((game, period, num, 7, rng.choice([5, 5, 4]), rng.choice([1, 2, None])))
        out["aligned"].append((game, num, rng.choice([when(), when(), when(), None])))
    out["direction"] += [(game, period, 1, True), (game, period, 2, False)] if period == 1 else [(game, period, 1, False)]
    return out


def plain(s, hold, lag, same):
    at = {num: t for _, num, t in s["aligned"]}
    left = {team: side for _, _, team, side in s["direction"]}
    starts = sorted((t, seq, team) for _, _, seq, t, team, _ in s["ledger"] if t is not None)
    offense = lambda t: next((team for u, _, team in reversed(starts) if u <= t), None)
    rows = []
    for _, _, made, rim, control in s["shots"]:
        if made is False and rim is not None:
            rows.append((rim, 0, "rim", control, "full") if hold else (control + lag if control is not None else rim, 0, "rim", None, "full"))
    rims = [r[0] for r in rows]
    for _, _, _, t, _, kind in s["ledger"]:
        if t is not None and not (kind == "defensive_rebound" and same and any(t - same <= r <= t for r in rims)):
            rows.append((t + (lag if kind in ("defensive_rebound", "turnover") else 0), 1, f"poss:{kind}", None, "full"))
    for _, _, num, team, detail, thrown in s["fouls"]:
        t = at.get(num)
        if t is None or team is None:
            continue
        against = offense(t) is not None and team != offense(t)
        if detail == "flagrant_1":
            rows.append((t, 2, "flagrant", None, "full"))
        elif against and detail in ("personal", "personal_take") and thrown == 0:
            run = next((u for _, _, u, frozen in s["index"] if u > t and not frozen), None)
            spots = [x for _, _, u, x, _ in s["ball"] if run is not None and run - 200 <= u <= run + 400]
            if spots and offense(t) in left:
                half = "front" if (median(spots) < 4700) == left[offense(t)] else "back"
                rows.append((t, 2, f"foul_{half}court", None, "min14" if half == "front" else "full"))
        elif against and detail in ("defensive_3_seconds", "delay_of_game"):
            rows.append((t, 2, detail, None, "min14"))
    for _, _, num, _, action, team in s["pbp"]:
        t = at.get(num)
        if action == 5 and t is not None and offense(t) is not None and team != offense(t):
            rows.append((t, 3, "kicked_ball", None, "min14"))
    rows.sort(key=lambda r: (r[0], r[1], r[2], -1 if r[3] is None else r[3]))
    catches = sorted(t for _, _, t in s["inbounds"] if t is not None)
    out = []
    for i, (t, _, cause, run, rule) in enumerate(rows):
        nxt = rows[i + 1][0] if i + 1 < len(rows) else None
        how = "own" if run is not None else "none"
        if run is None:
            catch = next((c for c in catches if c >= t), None)
            if catch is not None and catch - t <= 180_000 and (nxt is None or catch < nxt):
                run, how = catch, "catch"
        if run is None and not cause.startswith(("rim", "poss:defensive", "poss:period")):
            seen = [b for b in s["ball"] if t < b[2] <= min(t + 60_000, t + 60_000 if nxt is None else nxt)]
            gone = next((i for i, b in enumerate(seen) if not (-50 <= b[3] <= 9450 and -50 <= b[4] <= 5050)), None)
            back = None if gone is None else next((b[2] for b in seen[gone:] if 100 < b[3] < 9300 and 100 < b[4] < 4900), None)
            if back is not None:
                run, how = back + 300, "back"
        out.append(((t, run, rule, cause), how))
    return out


@pytest.mark.parametrize("hold,lag,same", [(True, 0, 6000), (False, 200, 0)])
def test_resets_are_the_plain_walk(spark, hold, lag, same):
    rng = random.Random(21)
    tables, want, seen = {name: [] for name in SCHEMAS}, [], set()
    for game in range(8):
        for period in (1, 2):
            s = scene(rng, game, period, game < 5)
            for name, rows in s.items():
                tables[name] += rows
            for row, how in plain(s, hold, lag, same):
                want.append((game, period, *row))
                seen |= {how, row[3]}
    made = {name: spark.createDataFrame(rows, SCHEMAS[name]) for name, rows in tables.items()}
    found = rs.shot_clock_resets(*[made[n] for n in SCHEMAS], hold_at_rim=hold, lag_ms=lag, same_ms=same)
    got = [tuple(r) for r in found.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert seen >= {"catch", "back", "none", "rim", "flagrant", "kicked_ball", "foul_frontcourt", "foul_backcourt", "poss:defensive_rebound", "defensive_3_seconds"}


def test_empty_tables_set_nothing(spark):
    assert rs.shot_clock_resets(*[spark.createDataFrame([], schema) for schema in SCHEMAS.values()]).count() == 0
