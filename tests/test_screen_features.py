"""Screen features against a plain walk over random scenes, and one scene with written values."""

from __future__ import annotations

import math
import random

import pytest

from courtframes.operators import screen_features as sf

ENTITY = "game_id int, period int, unix_ms long, team_id int, player_id int, x_cft long, y_cft long, z_cft long"
HANDLER = "game_id int, period int, unix_ms long, segment_id long, has_ball boolean, cand_id int, handler_id int"
FOUND = "game_id int, period int, s int, u int, d int, t_contact_ms long, t_start_ms long"
SIDES = "game_id int, period int, team_id int, attacks_left boolean"


def scene(rng, game, period):
    """Frames {t: {player: (x, y)}}, state {t: (segment, has_ball, cand, handler)}."""
    spots = {p: [rng.randrange(2000, 4000), rng.randrange(1500, 3500)] for p in range(10)}
    frames, state, t, segment = {}, {}, 10**6 * (game + period), 0
    pull = [0, 0]
    for k in range(420):
        hole = rng.random() < 0.01
        t += 2000 if hole else 40
        segment += hole
        if k % 30 == 0:
            pull = [rng.randrange(-40, 41), rng.randrange(-40, 41)]
        for p, xy in spots.items():
            xy[0] += rng.randrange(-30, 31) + pull[0] * (p % 3)
            xy[1] += rng.randrange(-30, 31) + pull[1] * (p % 2)
        if rng.random() < 0.02:
            spots[3] = list(spots[4])
        frames[t] = {p: tuple(xy) for p, xy in spots.items() if rng.random() > 0.003}
        state[t] = (segment, rng.random() < 0.9, rng.choice([-1, 1, 2]), rng.choice([-1, 0, 1, 2, 3]))
    return frames, state


def smoothed(frames):
    """{(t, player): (mx, my, vx, vy)} by five rows of a player."""
    out = {}
    for p in range(10):
        ts = [t for t in frames if p in frames[t]]
        mean = {}
        for i, t in enumerate(ts):
            near = [frames[x][p] for x in ts[max(0, i - 2) : i + 3]]
            mean[t] = tuple(sum(v[a] for v in near) / len(near) for a in (0, 1))
        for i, t in enumerate(ts):
            v = (None, None)
            if 0 < i < len(ts) - 1 and ts[i + 1] - t <= 60 and t - ts[i - 1] <= 60:
                v = tuple((mean[ts[i + 1]][a] - mean[ts[i - 1]][a]) / ((ts[i + 1] - ts[i - 1]) / 1000) for a in (0, 1))
            out[t, p] = (*mean[t], *v)
    return out


def plain(frames, state, soft, s, u, d, tc, left):
    ts = [t for t in frames if tc - 2000 <= t <= tc + 3000]
    at = lambda ms: next((t for t in ts if t >= tc + ms), ts[-1])
    raw = lambda t, p: frames[t].get(p)
    way = lambda a, b: None if a is None or b is None else (b[0] - a[0], b[1] - a[1])
    size = lambda v: None if v is None else math.hypot(*v)
    dot = lambda a, b: a[0] * b[0] + a[1] * b[1]
    mean = lambda t, p: soft[t, p][:2] if (t, p) in soft else None
    speed = lambda t, p: None if (t, p) not in soft or soft[t, p][2] is None else math.hypot(*soft[t, p][2:])
    feet = lambda v: None if v is None else v / 100

    def angle(a, b):
        if a is None or b is None or size(a) <= 1e-4 or size(b) <= 1e-4:
            return None
        return math.degrees(math.acos(max(-1, min(1, dot(a, b) / (size(a) * size(b))))))

    def guard(t, p, but=None):
        foes = [(size(way(frames[t][p], xy)), q) for q, xy in frames[t].items() if q // 5 != p // 5 and q != but] if p in frames[t] else []
        return min(foes)[1] if foes else None

    ps, out = raw(tc, s), {}
    hoop = (525 if left else 8875, 2500)
    axis = way(ps, hoop)
    out["screener_def_id"] = guard(tc, s, d)
    before = at(-500)
    user_way, def_way = way(mean(before, u), mean(tc, u)), way(mean(before, d), mean(tc, d))
    coming = []
    for t in ts:
        if tc - 2000 < t < tc and mean(t, s) and soft[t, s][2] is not None:
            v = way(mean(t, s), ps)
            if size(v) > 1e-4 and dot(soft[t, s][2:], v) / size(v) > 200:
                coming.append(t)
    out["t_approach_ms"] = max(coming, default=tc - 2000)
    t_pass = None
    ok = lambda t: state[t][0] == state[tc][0] and u in frames[t]
    later = [t for t in ts if t >= tc - 1500]
    while later and not ok(later[0]):
        later.pop(0)
    if user_way and size(user_way) > 1e-4 and later:
        sign = lambda t: (lambda x: (x > 0) - (x < 0))(dot(way(ps, raw(t, u)), user_way))
        for t in later[1:]:
            if not ok(t) or t >= tc + 3000:
                break
            if sign(later[0]) != 0 and sign(t) != sign(later[0]):
                t_pass = t
                break
    out["t_pass_ms"], out["t_end_ms"] = t_pass, min(tc + 3000, max(tc + 1500, (t_pass or 0) + 1000))
    v = way(ps, raw(t_pass, u)) if t_pass else None
    out["side_passed"] = None if v is None else "left" if -axis[0] * v[1] + axis[1] * v[0] > 0 else "right"
    near = [guard(t, u) for t in ts if tc - 1000 <= t <= at(-200)]
    near = [x for x in near if x is not None]
    out["user_def_id"] = min(set(near), key=lambda x: (-near.count(x), x)) if near else None
    out["min_dist_ft"] = feet(size(way(ps, raw(tc, d))))
    out["min_dist_screener_user_ft"] = feet(min((size(way(raw(t, s), raw(t, u))) for t in ts if abs(t - tc) <= 1000 and s in frames[t] and u in frames[t]), default=None))
    out["screener_speed_fts"], out["user_speed_fts"] = feet(speed(tc, s)), feet(speed(tc, u))
    out["approach_angle_deg"] = angle(user_way, axis)
    out["def_approach_angle_deg"] = angle(def_way, way(mean(before, d), ps))
    moved = way(mean(tc, s), mean(at(1500), s))
    out["screener_dx_1p5s"] = feet(moved and moved[0])
    out["screener_to_basket_1p5s_ft"] = moved and dot(moved, axis) / size(axis) / 100
    out["screened_def_to_user_1s_ft"] = feet(size(way(raw(at(1000), d), raw(at(1000), u))))
    out["screener_def_to_user_1s_ft"] = feet(size(way(raw(at(1000), out["screener_def_id"]), raw(at(1000), u))))
    for name, a, b in (("m05_0", before, tc), ("m03_0", at(-300), tc), ("0_p03", tc, at(300))):
        sp = [x for x in (speed(t, s) for t in ts if a <= t <= b) if x is not None]
        path = way(mean(a, s), mean(b, s))
        some = b > a
        out[f"scr_mean_speed_{name}"] = sum(sp) / len(sp) / 100 if sp and some else None
        out[f"scr_max_speed_{name}"] = max(sp) / 100 if sp and some else None
        out[f"scr_disp_{name}_ft"] = feet(size(path)) if some else None
        out[f"scr_disp_along_def_{name}_ft"] = dot(path, def_way) / size(def_way) / 100 if some and path and def_way and size(def_way) > 1e-4 else None
    sp = [x for x in (speed(t, d) for t in ts if before <= t <= tc) if x is not None]
    out["def_mean_speed_m05_0"] = sum(sp) / len(sp) / 100 if sp and before < tc else None
    out["xy_shared_at_contact"] = any(p in frames[tc] and any(q != p and xy == frames[tc][p] for q, xy in frames[tc].items()) for p in (s, u, d))
    out["handler_id"], out["on_ball"] = state[tc][3], state[tc][3] == u
    out["ball_in_flight_at_contact"] = state[tc][1] and state[tc][2] < 0
    far = min(math.hypot(ps[0] / 100 - x, ps[1] / 100 - 25) for x in (5.25, 88.75))
    cap = lambda x: min(30, x or 0)
    total = -1.6387 + 0.1047 * cap(out["user_speed_fts"]) + 0.1028 * cap(out["def_mean_speed_m05_0"]) + 0.0544 * far - 0.427 * (out["min_dist_ft"] or 0)
    total += 0.6751 * (t_pass is not None) - 1.4002 * out["ball_in_flight_at_contact"] + 0.4662 * out["on_ball"]
    out["screen_confidence"] = 1 / (1 + math.exp(-total))
    return out


def test_features_are_the_plain_walk(spark):
    rng = random.Random(11)
    entities, states, found, sides, want = [], [], [], [], {}
    for game in (1, 2):
        for period in (1, 2):
            frames, state = scene(rng, game, period)
            soft = smoothed(frames)
            for t, spots in frames.items():
                entities += [(game, period, t, -1, -1, 0, 0, 0)] + [(game, period, t, 100 + p // 5, p, x, y, 0) for p, (x, y) in spots.items()]
                states.append((game, period, t, *state[t]))
            sides += [(game, period, 100, period == 1), (game, period, 101, period == 2)] if game == 1 else []
            for _ in range(40):
                tc = rng.choice(list(frames))
                team = rng.randrange(2)
                s, u = rng.sample(range(5 * team, 5 * team + 5), 2)
                d = rng.randrange(5 - 5 * team, 10 - 5 * team)
                if s in frames[tc] and (game, period, s, u, d, tc) not in want:
                    found.append((game, period, s, u, d, tc, tc - 200))
                    left = True if game == 2 else (team == 0) == (period == 1)
                    want[game, period, s, u, d, tc] = plain(frames, state, soft, s, u, d, tc, left)
    tables = spark.createDataFrame(entities, ENTITY), spark.createDataFrame(states, HANDLER), spark.createDataFrame(sides, SIDES)
    got = {(r.game_id, r.period, r.s, r.u, r.d, r.t_contact_ms): r.asDict() for r in sf.screen_features(spark.createDataFrame(found, FOUND), *tables).collect()}
    assert got.keys() == want.keys() and len(want) > 100
    for key, values in want.items():
        for name, v in values.items():
            assert got[key][name] == (pytest.approx(v, abs=1e-6) if isinstance(v, float) else v), (key, name)
    seen = list(want.values())
    assert sum(v["t_pass_ms"] is not None for v in seen) > 20 and {v["side_passed"] for v in seen} == {None, "left", "right"}
    assert len({r["event_uid"] for r in got.values()}) >= len(got) - 2
    assert sf.screen_features(spark.createDataFrame([], FOUND), *tables).count() == 0


def test_written_scene(spark):
    """The user runs right past a standing screener at 10 ft/s, the defender a foot and a half behind."""
    entities, states = [], []
    for k in range(200):
        t, x = 40 * k, 2000 + 40 * (k - 100)
        for team, p, px, py in ((-1, -1, x, 2400), (100, 1, 2000, 2000), (100, 2, x, 2100), (200, 6, x - 150, 2100), (200, 7, 1700, 2000)):
            entities.append((1, 1, t, team, p, px, py, 0))
        states.append((1, 1, t, 0, True, 2, 2))
    found = [(1, 1, 1, 2, 6, 4160, 4000)]
    r = sf.screen_features(spark.createDataFrame(found, FOUND), spark.createDataFrame(entities, ENTITY), spark.createDataFrame(states, HANDLER), spark.createDataFrame([(1, 1, 100, True)], SIDES)).first()
    assert (r.t_pass_ms, r.side_passed, r.user_def_id, r.screened_def_is_user_def, r.screener_def_id) == (4000, "left", 6, True, 7)
    assert (r.on_ball, r.ball_in_flight_at_contact, r.xy_shared_at_contact, r.t_end_ms, r.t_approach_ms) == (True, False, False, 5660, 2160)
    assert [round(v, 4) for v in (r.user_speed_fts, r.screener_speed_fts, r.def_mean_speed_m05_0, r.scr_max_speed_m05_0)] == [10, 0, 10, 0]
    assert round(r.min_dist_ft, 4) == round(math.hypot(0.1, 1.0), 4) and round(r.approach_angle_deg, 1) == round(180 - math.degrees(math.atan2(5, 14.75)), 1)
