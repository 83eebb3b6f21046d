"""Registered queries of the alignment of the log to the frames, over a lens whose clocks meet and whose ball reaches the rim; and of screens."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from courtframes.operators import alignment as al
from courtframes.operators import events as ev
from courtframes.operators import frames as fr
from courtframes.operators import ledger as lg
from courtframes.operators import possessions as po
from courtframes.operators import screen_features as sf
from courtframes.operators import screens as sc
from courtframes.operators import shots as sh
from courtframes.plans.lenses import FRAMES_RIM, FRAMES_SCREEN, PBP_NEAR, spark_view, sql_view
from courtframes.plans import reference_pbp  # noqa: F401  its views come first
from courtframes.plans.reference import _VIEWS, frames, index, pbp, query
from courtframes.plans.reference_events import handlers
from courtframes.sources.layers import stored

_VIEWS["pnear_v"] = sql_view(PBP_NEAR)


def near_log(spark, d):
    return stored(spark, d, "pbp_near", lambda: spark_view(spark, d, PBP_NEAR))


def rim_frames(spark, d):
    return stored(spark, d, "frames_rim", lambda: spark_view(spark, d, FRAMES_RIM))


def rim_near(spark, d):
    return stored(spark, d, "near_rim", lambda: ev.ball_frames(rim_frames(spark, d), index(spark, d), sh.HAND_CFT))


def rim_held(spark, d):
    """Handlers with the ball's place."""
    return stored(spark, d, "handlers_rim", lambda: ev.handler(rim_frames(spark, d), index(spark, d), rim_near(spark, d)))


def rim_handlers(spark, d):
    return rim_held(spark, d).drop("bx", "by")


def rim_direction(spark, d):
    return stored(spark, d, "direction_rim", lambda: fr.attack_direction(rim_frames(spark, d), near_log(spark, d)))


def rim_shots(spark, d):
    return stored(spark, d, "shots_rim", lambda: sh.shot_events(rim_frames(spark, d), index(spark, d), near_log(spark, d), rim_direction(spark, d), rim_handlers(spark, d), sh.searched_near(rim_near(spark, d))))


def rim_flights(spark, d):
    return stored(spark, d, "flights_rim", lambda: ev.flights(rim_held(spark, d), rim_frames(spark, d)))


def rim_pairs(spark, d):
    return stored(spark, d, "pairs_rim", lambda: ev.changes(rim_handlers(spark, d)))


def rim_passes(spark, d):
    return stored(spark, d, "passes_rim", lambda: ev.transfers(rim_handlers(spark, d), rim_frames(spark, d), rim_pairs(spark, d)))


def near_rows(spark, d):
    return stored(spark, d, "log_near", lambda: al.log_rows(near_log(spark, d)))


def aligned(spark, d):
    """The near log on the time axis."""
    own = index(spark, d)
    build = lambda: al.align(near_log(spark, d), own, rim_shots(spark, d), ev.clock_stops(own), rim_flights(spark, d), rim_passes(spark, d), near_rows(spark, d))
    return stored(spark, d, "aligned_rim", build)


@query("l2_rim_shot_events")
def _(spark, d):
    return rim_shots(spark, d)


@query("l2_alignment")
def _(spark, d):
    return aligned(spark, d)


@query("l2_aligned_stop_causes")
def _(spark, d):
    return al.aligned_stop_causes(ev.clock_stops(index(spark, d)), aligned(spark, d), rim_shots(spark, d))


@query("l2_turnover_links")
def _(spark, d):
    return al.turnover_links(rim_passes(spark, d), aligned(spark, d))


_VIEWS["onlog_v"] = "select game_id, period, event_num, msg_type, p1_id, pctime_sec * 100 as clock_cs from pnear_v where msg_type not in (1, 2, 3, 4)"
_VIEWS["onstop_v"] = """select l.game_id, l.event_num, s.t_onset_ms, s.onset_exact, count(*) over (partition by l.game_id, l.event_num) as n_stops, row_number() over (partition by l.game_id, l.event_num order by abs(s.game_clock_cs - l.clock_cs - 50), s.t_onset_ms) as rn
    from onlog_v l join stop_v s on s.game_id = l.game_id and s.period = l.period and s.game_clock_cs >= l.clock_cs - 50 and s.game_clock_cs < l.clock_cs + 150"""
_VIEWS["lostball_v"] = """select m.game_id, m.period, m.giver, m.t_release_ms, m.t_catch_ms, i.game_clock_cs from moves_v m join index_v i on i.game_id = m.game_id and i.period = m.period and i.unix_ms = m.t_catch_ms where not m.same_team"""
_VIEWS["onpass_v"] = """select l.game_id, l.event_num, min(b.t_catch_ms) as t, arg_min(b.t_release_ms, b.t_catch_ms) as link from onlog_v l join lostball_v b on b.game_id = l.game_id and b.period = l.period and b.giver = l.p1_id and b.game_clock_cs between l.clock_cs - 100 and l.clock_cs + 200
    where l.msg_type = 5 group by all"""
_VIEWS["onclock_v"] = """select game_id, event_num, unix_ms as t from (select r.game_id, r.event_num, i.unix_ms, row_number() over (partition by r.game_id, r.event_num
      order by not (game_clock_cs >= clock_cs and game_clock_cs < clock_cs + 100), segment_id, abs(2 * (game_clock_cs - clock_cs) - 100), unix_ms) as rn
      from onlog_v r join index_v i on i.game_id = r.game_id and i.period = r.period and abs(game_clock_cs - clock_cs) <= 100) where rn = 1"""
_VIEWS["onaxis_v"] = """select l.*, coalesce(p.t, s.t_onset_ms, c.t) as t_ms, case when p.t is not null then 'pass' when s.t_onset_ms is not null then 'clock_stop' when c.t is not null then 'clock_match' else 'unlocated' end as method,
      case when p.t is not null then 4 when s.t_onset_ms is not null then case when n_stops > 1 then 2 when onset_exact then 4 else 3 end when c.t is not null then 1 else 0 end as quality,
      case when p.t is null then s.t_onset_ms end as stop_ms, coalesce(p.link, s.t_onset_ms) as link_ms
    from onlog_v l left join onpass_v p on p.game_id = l.game_id and p.event_num = l.event_num left join (select * from onstop_v where rn = 1) s on s.game_id = l.game_id and s.event_num = l.event_num and l.msg_type in (5, 6, 7, 9, 10, 11, 18)
    left join onclock_v c on c.game_id = l.game_id and c.event_num = l.event_num"""


@query("l2_aligned_stops", """select a.game_id, a.period, a.event_num, a.msg_type, a.t_ms, a.method, a.quality, case when quality >= 2 then 'tracking_event' when quality = 1 then 'clock_only' else 'unmatched' end as match_level, a.clock_cs - i.game_clock_cs as residual_cs, a.stop_ms, a.link_ms,
    (select count(*) from stop_v s where s.game_id = a.game_id and s.period = a.period and abs(s.game_clock_cs - a.clock_cs) <= 200) as n_stops_near
    from onaxis_v a asof left join index_v i on i.game_id = a.game_id and i.period = a.period and i.unix_ms <= a.t_ms""")
def _(spark, d):
    """Rows that hang on no attempt and no throw, by the whole operator."""
    own, held = index(spark, d), handlers(spark, d)
    log = near_log(spark, d).filter("msg_type not in (1, 2, 3, 4)")
    shots = spark.createDataFrame([], "game_id bigint, event_num bigint, method string, t_release_ms bigint, t_control_ms bigint, control_id bigint, control_team_id bigint")
    rows = al.align(log, own, shots, ev.clock_stops(own), ev.flights(held, frames(spark, d)), ev.transfers(held, frames(spark, d)))
    return rows.drop("n", "m")


def near_ledger(spark, d):
    return stored(spark, d, "possessions_near", lambda: po.possessions(near_log(spark, d)))


def rim_ledger(spark, d):
    """Possessions of the near log on the time axis."""
    build = lambda: lg.ledger_times(near_ledger(spark, d), near_log(spark, d), aligned(spark, d), index(spark, d), rim_direction(spark, d))
    return stored(spark, d, "ledger_rim", build)


@query("p5_ledger_times")
def _(spark, d):
    return rim_ledger(spark, d)


def refined_ledger(spark, d):
    """The ledger with boundaries where control changes hands."""
    build = lambda: lg.ledger_times(near_ledger(spark, d), near_log(spark, d), aligned(spark, d), index(spark, d), rim_direction(spark, d), rim_handlers(spark, d))
    return stored(spark, d, "ledger_refined", build)


@query("p6_refined_ledger")
def _(spark, d):
    return refined_ledger(spark, d)


_VIEWS["onear_v"] = _VIEWS["order_v"].replace("pbp_v", "pnear_v")
_VIEWS["say_v"] = "select game_id, pos, event_num, msg_type, p1_team_id as team, pctime_sec as c from onear_v where msg_type in (1, 2, 4, 5, 6, 7, 10, 12, 13)"
_VIEWS["said_v"] = "select *, lag(msg_type) over w as last_type, lag(team) over w as last_team, lag(event_num) over w as last_num from say_v window w as (partition by game_id order by pos)"
_VIEWS["putback_v"] = "select game_id, pos, event_num, msg_type, team, c, last_num as missed from said_v where msg_type in (1, 2) and last_type = 2 and last_team is not distinct from team"


@query("p3_putback_order", """select r.game_id, r.event_num, s.event_num as putback_event_num, s.missed as missed_shot_event_num
    from onear_v r join putback_v s on s.game_id = r.game_id and s.pos < r.pos and s.team is not distinct from r.p1_team_id and s.c = r.pctime_sec
    left join onear_v n on n.game_id = r.game_id and n.pos = r.pos + 1
    where r.msg_type = 4 and not exists (select 1 from say_v b where b.game_id = r.game_id and b.pos > s.pos and b.pos < r.pos and (b.msg_type in (1, 2, 4, 12, 13) or b.c <> s.c))
      and (s.msg_type = 1 or (n.msg_type = 4 and n.p1_team_id is not distinct from r.p1_team_id and n.pctime_sec = r.pctime_sec))""")
def _(spark, d):
    return lg.putback_order(near_log(spark, d))


def _screens(cap: int) -> str:
    """SQL of the screens under a speed cap."""
    return f"""select game_id, segment_id, s, u, d, arg_min(period, unix_ms) as period, min(unix_ms) as t_start_ms, max(unix_ms) as t_end_ms, count(*) as n_frames, arg_min(unix_ms, sd2 * 10000000000000 + unix_ms) as t_contact_ms from (
      select *, sum(fresh) over (partition by game_id, segment_id, s, u, d order by unix_ms rows unbounded preceding) as run_id from (
        select *, case when unix_ms - lag(unix_ms) over (partition by game_id, segment_id, s, u, d order by unix_ms) <= 60 then 0 else 1 end as fresh from (
          select s.game_id, s.period, s.unix_ms, s.segment_id, s.player_id as s, u.player_id as u, f.player_id as d, (s.x_cft - f.x_cft) * (s.x_cft - f.x_cft) + (s.y_cft - f.y_cft) * (s.y_cft - f.y_cft) as sd2
          from (select o.* from mine_v o join speed_v v on v.game_id = o.game_id and v.period = o.period and v.unix_ms = o.unix_ms and v.player_id = o.player_id where v.speed < {cap} and o.player_id <> o.handler_id) s
          join mine_v u on u.game_id = s.game_id and u.period = s.period and u.unix_ms = s.unix_ms and u.player_id <> s.player_id and (s.x_cft - u.x_cft) * (s.x_cft - u.x_cft) + (s.y_cft - u.y_cft) * (s.y_cft - u.y_cft) <= 640000
          join foe_v f on f.game_id = u.game_id and f.period = u.period and f.unix_ms = u.unix_ms and f.of = u.player_id) where sd2 <= 360000))
      group by game_id, segment_id, s, u, d, run_id having count(*) >= 5"""


_VIEWS["mine_v"] = "select p.game_id, p.period, p.unix_ms, p.team_id, p.player_id, p.x_cft, p.y_cft, h.segment_id, h.handler_id from frames_v p join handler_v h on h.game_id = p.game_id and h.period = p.period and h.unix_ms = p.unix_ms and h.control_team_id = p.team_id where p.team_id <> -1"
_VIEWS["foe_v"] = """select * from (select u.game_id, u.period, u.unix_ms, u.player_id as of, f.player_id, f.x_cft, f.y_cft, row_number() over (partition by u.game_id, u.period, u.unix_ms, u.player_id order by (u.x_cft - f.x_cft) * (u.x_cft - f.x_cft) + (u.y_cft - f.y_cft) * (u.y_cft - f.y_cft), f.player_id) as rn
      from mine_v u join frames_v f on f.game_id = u.game_id and f.period = u.period and f.unix_ms = u.unix_ms and f.team_id = 300 - u.team_id) where rn = 1"""
_VIEWS["setscreen_v"] = _screens(sc.SET_CFT)
_VIEWS["anyscreen_v"] = _screens(sc.MOVING_CFT)
_VIEWS["spot_v"] = "select game_id, period, unix_ms, player_id, x_cft, y_cft from frames_v where team_id <> -1"
_AT = "game_id = a.game_id and {0}.period = a.period and {0}.unix_ms = a.{1} and {0}.player_id = a.{2}"


@query("l2_set_screens", "select * from setscreen_v")
def _(spark, d):
    return ev.screens(frames(spark, d), handlers(spark, d))


_MOVING = f"""select * exclude (then_ms, closing), round(closing, 3) as closing_cft from (select a.*, sqrt((ts.x_cft - td.x_cft) ** 2 + (ts.y_cft - td.y_cft) ** 2) - sqrt((ns.x_cft - nd.x_cft) ** 2 + (ns.y_cft - nd.y_cft) ** 2) as closing from (
      select m.*, (select max(unix_ms) from index_v i where i.game_id = m.game_id and i.period = m.period and i.unix_ms <= m.t_contact_ms - 500) as then_ms from anyscreen_v m
      where not exists (select 1 from setscreen_v e where e.game_id = m.game_id and e.period = m.period and e.s = m.s and e.u = m.u and e.d = m.d and m.t_contact_ms between least(e.t_start_ms, e.t_contact_ms - 1000) and greatest(e.t_end_ms, e.t_contact_ms + 1000))) a
    join spot_v ns on ns.{_AT.format("ns", "t_contact_ms", "s")} join spot_v nd on nd.{_AT.format("nd", "t_contact_ms", "d")}
    join spot_v ts on ts.{_AT.format("ts", "then_ms", "s")} join spot_v td on td.{_AT.format("td", "then_ms", "d")}) where closing >= 100"""


def _over(sql: str, base: str, other: str) -> str:
    """The SQL, and the views below it, with one base view in place of another."""
    words = lambda text: {n for n in _VIEWS if re.search(rf"\b{n}\b", text)}
    rests = lambda name: name == base or any(rests(n) for n in words(_VIEWS[name]) - {name})
    for name in words(sql):
        if rests(name):
            new = other if name == base else f"{name[:-2]}_{other}"
            if new not in _VIEWS:
                _VIEWS[new] = _over(_VIEWS[name], base, other)
            sql = re.sub(rf"\b{name}\b", new, sql)
    return sql


_VIEWS["fscreen_v"] = sql_view(FRAMES_SCREEN)


@query("l2_moving_screens", _over(_MOVING, "frames_v", "fscreen_v"))
def _(spark, d):
    own = stored(spark, d, "frames_screen", lambda: spark_view(spark, d, FRAMES_SCREEN))
    held = stored(spark, d, "handlers_screen", lambda: ev.handler(own, index(spark, d)))
    return sc.moving_screens(own, held).withColumn("closing_cft", F.round("closing_cft", 3))


_VIEWS["moving_v"] = _MOVING
_VIEWS["soft_v"] = """select game_id, period, unix_ms, team_id, player_id, x, y, mx, my, case when near then (mx2 - mx0) / step end as vx, case when near then (my2 - my0) / step end as vy,
      case when near then sqrt(((mx2 - mx0) / step) ** 2 + ((my2 - my0) / step) ** 2) end as sp
    from (select *, lead(unix_ms) over w - unix_ms <= 60 and unix_ms - lag(unix_ms) over w <= 60 as near, (lead(unix_ms) over w - lag(unix_ms) over w) / 1000.0 as step, lead(mx) over w as mx2, lag(mx) over w as mx0, lead(my) over w as my2, lag(my) over w as my0
      from (select game_id, period, unix_ms, team_id, player_id, x_cft as x, y_cft as y, avg(x_cft) over w as mx, avg(y_cft) over w as my from frames_v where team_id <> -1
        window w as (partition by game_id, player_id, period order by unix_ms rows between 2 preceding and 2 following)) window w as (partition by game_id, player_id, period order by unix_ms))"""
_VIEWS["contact_v"] = """select row_number() over (order by game_id, period, s, u, d, t_contact_ms) as id, game_id, period, s, u, d, t_contact_ms as tc, t_start_ms from
    (select game_id, period, s, u, d, t_contact_ms, t_start_ms from setscreen_v union select game_id, period, s, u, d, t_contact_ms, t_start_ms from moving_v)"""
_VIEWS["scene_v"] = """select c.id, c.tc, h.unix_ms as t, h.segment_id as seg, h.handler_id, coalesce(h.has_ball and h.cand_id < 0, false) as free, s as sid, u as uid, d as did, a.x as sx, a.y as sy, a.mx as smx, a.my as smy, a.vx as svx, a.vy as svy, a.sp as ssp, a.team_id as team,
      b.x as ux, b.y as uy, b.mx as umx, b.my as umy, b.sp as usp, e.x as dx, e.y as dy, e.mx as dmx, e.my as dmy, e.sp as dsp
    from contact_v c join handler_v h on h.game_id = c.game_id and h.period = c.period and h.unix_ms between c.tc - 2000 and c.tc + 3000
    left join soft_v a on a.game_id = h.game_id and a.period = h.period and a.unix_ms = h.unix_ms and a.player_id = c.s left join soft_v b on b.game_id = h.game_id and b.period = h.period and b.unix_ms = h.unix_ms and b.player_id = c.u
    left join soft_v e on e.game_id = h.game_id and e.period = h.period and e.unix_ms = h.unix_ms and e.player_id = c.d"""


def _first_at(ms: int, name: str) -> str:
    """Columns of the first frame at or after a time of the contact, else of the last, under a prefix."""
    return f"(select id as {name}_id, {', '.join(f'coalesce(arg_min({c}, t) filter (t >= tc + {ms}), arg_max({c}, t)) as {name}_{c}' for c in ('t', 'smx', 'smy', 'umx', 'umy', 'dmx', 'dmy', 'ux', 'uy', 'dx', 'dy'))} from scene_v group by id) {name} on {name}_id = c.id"


_VIEWS["mark_v"] = f"""select c.*, z.seg, z.handler_id, z.free, z.sx, z.sy, z.smx, z.smy, z.ssp, z.usp, z.ux, z.uy, z.umx, z.umy, z.dx, z.dy, z.dmx, z.dmy, z.team, case when coalesce(attacks_left, true) then 525 else 8875 end as hx, b.*, m.*, p.*, l.*, o.*, g.*
    from contact_v c join scene_v z on z.id = c.id and z.t = z.tc join {_first_at(-500, "b")} join {_first_at(-300, "m")} join {_first_at(300, "p")} join {_first_at(1500, "l")} join {_first_at(1000, "o")} join {_first_at(-200, "g")}
    left join direction_v s on s.game_id = c.game_id and s.period = c.period and s.team_id = z.team"""
_VIEWS["stride_v"] = """select w.*, first_value(sgn) over (partition by id order by t) as sgn0, first_value(t) over (partition by id order by t) as t_open from (
      select z.id, z.t, z.ux, z.uy, k.sx, k.sy, k.hx, k.tc, case when (k.umx - k.b_umx) ** 2 + (k.umy - k.b_umy) ** 2 > 0.00000001 then sign((z.ux - k.sx) * (k.umx - k.b_umx) + (z.uy - k.sy) * (k.umy - k.b_umy)) end as sgn
      from scene_v z join mark_v k on k.id = z.id where z.t >= z.tc - 1500 and z.seg = k.seg and z.ux is not null) w"""
_VIEWS["through_v"] = """select id, min(t) as t_pass, arg_min(case when (hx - sx) * (sy - uy) + (2500 - sy) * (ux - sx) > 0 then 'left' else 'right' end, t) as side from stride_v where sgn0 <> 0 and sgn <> sgn0 and t < tc + 3000 group by id"""
_VIEWS["guards_v"] = """select z.id, z.t, z.tc, arg_min(f.player_id, ((f.x - z.ux) ** 2 + (f.y - z.uy) ** 2) * 100000 + f.player_id) as u_guard, arg_min(f.player_id, ((f.x - z.sx) ** 2 + (f.y - z.sy) ** 2) * 100000 + f.player_id) filter (f.player_id <> z.did) as s_guard
    from scene_v z join contact_v c on c.id = z.id join soft_v f on f.game_id = c.game_id and f.period = c.period and f.unix_ms = z.t and f.team_id <> z.team group by all"""


def _turn(ax: str, ay: str, bx: str, by: str) -> str:
    """Degrees between two vectors."""
    size = f"(sqrt(({ax}) ** 2 + ({ay}) ** 2) * sqrt(({bx}) ** 2 + ({by}) ** 2))"
    return f"case when {size} > 0.00000001 then degrees(acos(greatest(-1.0, least(1.0, (({ax}) * ({bx}) + ({ay}) * ({by})) / {size})))) end"


def _moved(a: str, b: str, name: str) -> str:
    at = lambda p, c: f"k.{p}_{c}" if p else f"k.{c}"
    x, y, size = f"({at(b, 'smx')} - {at(a, 'smx')})", f"({at(b, 'smy')} - {at(a, 'smy')})", "sqrt((k.dmx - k.b_dmx) ** 2 + (k.dmy - k.b_dmy) ** 2)"
    lo, hi = (f"k.{p}_t" if p else "k.tc" for p in (a, b))
    speeds = f"from scene_v z where z.id = k.id and z.t between {lo} and {hi})"
    return f"""case when {hi} > {lo} then (select avg(ssp) {speeds} / 100 end as scr_mean_speed_{name}, case when {hi} > {lo} then (select max(ssp) {speeds} / 100 end as scr_max_speed_{name},
      case when {hi} > {lo} then sqrt({x} ** 2 + {y} ** 2) / 100 end as scr_disp_{name}_ft, case when {hi} > {lo} and {size} > 0.0001 then ({x} * (k.dmx - k.b_dmx) + {y} * (k.dmy - k.b_dmy)) / {size} / 100 end as scr_disp_along_def_{name}_ft"""


_FEATURES = f"""select k.game_id, k.period, k.s, k.u, k.d, k.tc as t_contact_ms, k.team as offense_team_id, k.handler_id, j.user_def_id, q.s_guard as screener_def_id, j.user_def_id = k.d as screened_def_is_user_def, k.handler_id = k.u as on_ball, k.free as ball_in_flight_at_contact,
      exists (select 1 from soft_v a join soft_v b on b.game_id = a.game_id and b.period = a.period and b.unix_ms = a.unix_ms and b.x = a.x and b.y = a.y and b.player_id <> a.player_id where a.game_id = k.game_id and a.period = k.period and a.unix_ms = k.tc and a.player_id in (k.s, k.u, k.d)) as xy_shared_at_contact,
      k.t_start_ms as t_set_start_ms, coalesce((select max(z.t) from scene_v z where z.id = k.id and z.t > k.tc - 2000 and z.t < k.tc and (z.svx * (k.sx - z.smx) + z.svy * (k.sy - z.smy)) / nullif(sqrt((k.sx - z.smx) ** 2 + (k.sy - z.smy) ** 2), 0) > 200), k.tc - 2000) as t_approach_ms,
      h.t_pass as t_pass_ms, least(k.tc + 3000, greatest(k.tc + 1500, coalesce(h.t_pass, 0) + 1000)) as t_end_ms, sqrt((k.sx - k.dx) ** 2 + (k.sy - k.dy) ** 2) / 100 as min_dist_ft,
      (select sqrt(min((z.sx - z.ux) ** 2 + (z.sy - z.uy) ** 2)) / 100 from scene_v z where z.id = k.id and z.t between k.tc - 1000 and k.tc + 1000) as min_dist_screener_user_ft,
      k.sx / 100.0 as x_ft, k.sy / 100.0 as y_ft, k.ssp / 100 as screener_speed_fts, k.usp / 100 as user_speed_fts, {_turn("k.umx - k.b_umx", "k.umy - k.b_umy", "k.hx - k.sx", "2500 - k.sy")} as approach_angle_deg, h.side as side_passed,
      (k.l_smx - k.smx) / 100 as screener_dx_1p5s, (k.l_smy - k.smy) / 100 as screener_dy_1p5s, ((k.l_smx - k.smx) * (k.hx - k.sx) + (k.l_smy - k.smy) * (2500 - k.sy)) / sqrt((k.hx - k.sx) ** 2 + (2500 - k.sy) ** 2) / 100 as screener_to_basket_1p5s_ft,
      sqrt((k.o_dx - k.o_ux) ** 2 + (k.o_dy - k.o_uy) ** 2) / 100 as screened_def_to_user_1s_ft, sqrt((f.x - k.o_ux) ** 2 + (f.y - k.o_uy) ** 2) / 100 as screener_def_to_user_1s_ft, {_turn("k.dmx - k.b_dmx", "k.dmy - k.b_dmy", "k.sx - k.b_dmx", "k.sy - k.b_dmy")} as def_approach_angle_deg,
      {_moved("b", "", "m05_0")}, {_moved("m", "", "m03_0")}, {_moved("", "p", "0_p03")}, case when k.tc > k.b_t then (select avg(dsp) from scene_v z where z.id = k.id and z.t between k.b_t and k.tc) / 100 end as def_mean_speed_m05_0
    from mark_v k left join through_v h on h.id = k.id join guards_v q on q.id = k.id and q.t = q.tc left join soft_v f on f.game_id = k.game_id and f.period = k.period and f.unix_ms = k.o_t and f.player_id = q.s_guard
    left join (select id, arg_max(u_guard, n * 100000 - u_guard) as user_def_id from (select r.id, r.u_guard, count(*) as n from guards_v r join mark_v y on y.id = r.id where r.t between r.tc - 1000 and y.g_t group by all) group by id) j on j.id = k.id"""
_SCORED = f"""select *, 1 / (1 + exp(-(-1.6387 + 0.1047 * least(30, coalesce(user_speed_fts, 0)) + 0.1028 * least(30, coalesce(def_mean_speed_m05_0, 0)) + 0.0544 * least(sqrt((x_ft - 5.25) ** 2 + (y_ft - 25) ** 2), sqrt((x_ft - 88.75) ** 2 + (y_ft - 25) ** 2))
      - 0.427 * coalesce(min_dist_ft, 0) + 0.6751 * cast(t_pass_ms is not null as int) - 1.4002 * cast(ball_in_flight_at_contact as int) + 0.4662 * cast(on_ball as int)))) as screen_confidence, concat_ws(':', game_id, 'screen_candidate', t_contact_ms, concat_ws('-', s, u)) as event_uid from ({_FEATURES})"""
_MEASURED = ["min_dist_ft", "min_dist_screener_user_ft", "x_ft", "y_ft", "screener_speed_fts", "user_speed_fts", "approach_angle_deg", "screener_dx_1p5s", "screener_dy_1p5s", "screener_to_basket_1p5s_ft", "screened_def_to_user_1s_ft", "screener_def_to_user_1s_ft", "def_approach_angle_deg"]
_MEASURED += [f"scr_{what}_{span}{unit}" for span in ("m05_0", "m03_0", "0_p03") for what, unit in (("mean_speed", ""), ("max_speed", ""), ("disp", "_ft"), ("disp_along_def", "_ft"))] + ["def_mean_speed_m05_0", "screen_confidence"]


@query("l2_screen_features", _over("select * replace (" + ", ".join(f"round({c}, 3) + 0.0 as {c}" for c in _MEASURED) + f") from ({_SCORED})", "frames_v", "fscreen_v"))
def _(spark, d):
    """Features of the set and moving screens of the lens that has both."""
    own = stored(spark, d, "frames_screen", lambda: spark_view(spark, d, FRAMES_SCREEN))
    held = stored(spark, d, "handlers_screen", lambda: ev.handler(own, index(spark, d)))
    columns = ["game_id", "period", "s", "u", "d", "t_contact_ms", "t_start_ms"]
    pairs = stored(spark, d, "screen_pairs_screen", lambda: ev.screen_pairs(own, held, sc.MOVING_CFT))
    found = stored(spark, d, "screens_screen", lambda: ev.screen_runs(pairs, sc.SET_CFT).select(*columns).unionByName(sc.moving_screens(own, held, pairs=pairs).select(*columns)).distinct())
    sides = stored(spark, d, "direction_screen", lambda: fr.attack_direction(own, pbp(spark, d)))
    rows = sf.screen_features(found, own, held, sides)
    return rows.withColumns({c: F.round(c, 3) + F.lit(0.0) for c in _MEASURED})
