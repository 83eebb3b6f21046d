"""Registered queries of even grids over the half-court windows of the slow game."""

from __future__ import annotations

from pyspark.sql import functions as F

from courtframes.operators import grids as gr
from courtframes.operators import shot_clock as sc
from courtframes.plans.reference import _VIEWS, index, query
from courtframes.plans.reference_alignment import rim_frames, rim_handlers
from courtframes.plans.reference_windows import _IN_LENS, clock_windows
from courtframes.sources.layers import stored


def spans(spark, d):
    """Accepted windows, as grids read them."""
    return clock_windows(spark, d).filter("outcome = 'accepted'").select("game_id", "period", F.col("event_num").alias("window"), "t_start_ms", "t_end_ms", "attacks_left", "offense_ids", "defense_ids")


def places(spark, d):
    return stored(spark, d, "grid_places", lambda: gr.grid_entities(spans(spark, d), rim_frames(spark, d)))


def clocks(spark, d):
    return gr.grid_clocks(spans(spark, d), index(spark, d))


def states(spark, d):
    return gr.grid_states(spans(spark, d), rim_handlers(spark, d), sc.filled(index(spark, d)))


def _rounded(table, *names):
    return table.withColumns({c: F.round(c, 5) for c in names})


_G = "game_id, period, win"
_ON = "{a}.game_id = {b}.game_id and {a}.period = {b}.period and {a}.win = {b}.win"
_on = lambda a, b: _ON.format(a=a, b=b)
_VIEWS["gwin_v"] = "select game_id, period, event_num as win, t_start as t0, t_end as t1, attacks_left, ours, theirs from wout_v where outcome = 'accepted'"
_VIEWS["gstep_v"] = "select *, t0 + 200 * step as t_ms, t0 + 200 * step <= t1 as valid, least(t0 + 200 * step, t1) as te from gwin_v cross join (select unnest(range(121)) as step)"
_VIEWS["gchan_v"] = """select game_id, period, win, 'ball' as role, 0 as slot, cast(-1 as bigint) as player_id from gwin_v
    union all select game_id, period, win, 'off', i - 1, ours[i] from gwin_v cross join (select unnest(range(1, 6)) as i) union all select game_id, period, win, 'def', i - 1, theirs[i] from gwin_v cross join (select unnest(range(1, 6)) as i)"""
_VIEWS["gsamp_v"] = f"""select c.*, f.unix_ms, case when attacks_left then x_cft else 9400 - x_cft end as x, case when attacks_left then y_cft else 5000 - y_cft end as y, z_cft as z
    from gchan_v c join gwin_v w on {_on('c', 'w')} join frames_v f on f.game_id = c.game_id and f.period = c.period and f.player_id = c.player_id and f.unix_ms between t0 - 200 and t1 + 200"""
_VIEWS["gpoint_v"] = f"""select s.game_id, s.period, s.win, s.step, s.valid, s.t_ms, c.role, c.slot, c.player_id, s.te, (select max(unix_ms) from gsamp_v m where {_on('m', 's')} and m.player_id = c.player_id and m.unix_ms <= s.te) as ta,
      (select min(unix_ms) from gsamp_v m where {_on('m', 's')} and m.player_id = c.player_id and m.unix_ms > s.te) as tb from gstep_v s join gchan_v c on {_on('c', 's')}"""
_LINE = "case when ta is not null and tb is not null then a.{c} + (b.{c} - a.{c}) * ((te - ta) / (tb - ta)) else coalesce(a.{c}, b.{c})::double end as {c}"
_VIEWS["gplace_v"] = f"""select p.*, {', '.join(_LINE.format(c=c) for c in 'xyz')} from gpoint_v p left join gsamp_v a on {_on('a', 'p')} and a.player_id = p.player_id and a.unix_ms = ta left join gsamp_v b on {_on('b', 'p')} and b.player_id = p.player_id and b.unix_ms = tb"""
_V = "case when not valid then 0 when lead(valid) over w and step > 0 then (lead({c}) over w - lag({c}) over w) / 0.4::double when lead(valid) over w then (lead({c}) over w - {c}) / 0.2::double when step > 0 then ({c} - lag({c}) over w) / 0.2::double else 0 end as v{c}"
_VIEWS["gmove_v"] = f"select *, {_V.format(c='x')}, {_V.format(c='y')} from gplace_v window w as (partition by game_id, period, win, role, slot order by step)"
_PLACES = f"{_G} as window, role, slot, step, valid, t_ms, player_id, round(x, 5) as x_cft, round(y, 5) as y_cft, round(z, 5) as z_cft, round(vx, 5) as vx, round(vy, 5) as vy".replace("win as window", 'win as "window"')


@query("m7_grid_places", _IN_LENS(f"select {_PLACES} from gmove_v"))
def _(spark, d):
    return _rounded(gr.grid_entities(spans(spark, d), rim_frames(spark, d)), "x_cft", "y_cft", "z_cft", "vx", "vy")


_VIEWS["gclock_v"] = f"""select s.game_id, s.period, s.win, s.step, case when ta is not null and tb is not null then a.game_clock_cs + (b.game_clock_cs - a.game_clock_cs) * ((te - ta) / (tb - ta)) else coalesce(a.game_clock_cs, b.game_clock_cs)::double end as clock,
      case when n_shown >= 2 and coalesce(f.shot_clock_cs, case when f.unix_ms is null then a.shot_clock_cs end) is not null then case when sa is not null and sb is not null then x.shot_clock_cs + (y.shot_clock_cs - x.shot_clock_cs) * ((te - sa) / (sb - sa)) else coalesce(x.shot_clock_cs, y.shot_clock_cs)::double end end as shot
    from (select s.*, (select max(unix_ms) from index_v i where i.game_id = s.game_id and i.period = s.period and i.unix_ms between t0 - 200 and te) as ta, (select min(unix_ms) from index_v i where i.game_id = s.game_id and i.period = s.period and i.unix_ms > te and i.unix_ms <= t1 + 200) as tb,
        (select min(unix_ms) from index_v i where i.game_id = s.game_id and i.period = s.period and i.unix_ms >= te and i.unix_ms <= t1 + 200) as tf,
        (select max(unix_ms) from index_v i where i.game_id = s.game_id and i.period = s.period and i.unix_ms between t0 - 200 and te and shot_clock_cs is not null) as sa, (select min(unix_ms) from index_v i where i.game_id = s.game_id and i.period = s.period and i.unix_ms > te and i.unix_ms <= t1 + 200 and shot_clock_cs is not null) as sb,
        (select count(*) from index_v i where i.game_id = s.game_id and i.period = s.period and i.unix_ms between t0 - 200 and t1 + 200 and shot_clock_cs is not null) as n_shown from gstep_v s) s
    left join index_v a on a.game_id = s.game_id and a.period = s.period and a.unix_ms = ta left join index_v b on b.game_id = s.game_id and b.period = s.period and b.unix_ms = tb left join index_v f on f.game_id = s.game_id and f.period = s.period and f.unix_ms = tf
    left join index_v x on x.game_id = s.game_id and x.period = s.period and x.unix_ms = sa left join index_v y on y.game_id = s.game_id and y.period = s.period and y.unix_ms = sb"""


@query("m7_grid_clocks", _IN_LENS('select game_id, period, win as "window", step, round(clock, 5) as game_clock_cs, round(shot, 5) as shot_clock_cs from gclock_v'))
def _(spark, d):
    return _rounded(clocks(spark, d), "game_clock_cs", "shot_clock_cs")


_VIEWS["gnear_v"] = """select s.game_id, s.period, s.win, s.step, s.valid, h.has_ball and h.cand_id < 0 as free, f.shot_clock_filled_cs, f.fill_method
    from gstep_v s join handler_v h on h.game_id = s.game_id and h.period = s.period and h.unix_ms between t0 - 1000 and t1 + 1000 left join filled_v f on f.game_id = h.game_id and f.period = h.period and f.unix_ms = h.unix_ms
    qualify row_number() over (partition by s.game_id, s.period, s.win, s.step order by abs(h.unix_ms - s.te), h.unix_ms) = 1"""
_VIEWS["gheld_v"] = """select s.game_id, s.period, s.win, s.step, coalesce(list_position(ours, h.handler_id), 0) - 1 as slot from gstep_v s join handler_v h on h.game_id = s.game_id and h.period = s.period and h.unix_ms between t0 and t1 and h.has_ball
    qualify row_number() over (partition by s.game_id, s.period, s.win, s.step order by abs(h.unix_ms - s.te), h.unix_ms) = 1"""
_VIEWS["gstate_v"] = f"select n.*, case when valid then coalesce(slot, -1) else -1 end as handler_slot from gnear_v n left join gheld_v h on {_on('h', 'n')} and h.step = n.step"


@query("m8_grid_states", _IN_LENS("""select game_id, period, win as "window", step, handler_slot, valid and coalesce(free, false) as ball_in_flight, case when valid then shot_clock_filled_cs end as shot_clock_filled_cs, case when valid then fill_method end as fill_method from gstate_v"""))
def _(spark, d):
    return states(spark, d)


@query("m9_grid_long", _IN_LENS(f"""select {_PLACES.replace(_G, 'p.game_id, p.period, p.win').replace(' step', ' p.step').replace(' slot', ' p.slot').replace(' valid', ' p.valid')}, round(clock, 5) as game_clock_cs, round(shot, 5) as shot_clock_cs, role = 'off' and handler_slot = p.slot as is_handler
    from gmove_v p join gclock_v c on {_on('c', 'p')} and c.step = p.step join gstate_v h on {_on('h', 'p')} and h.step = p.step"""))
def _(spark, d):
    found = gr.grid_long(places(spark, d), clocks(spark, d), states(spark, d))
    return _rounded(found, "x_cft", "y_cft", "z_cft", "vx", "vy", "game_clock_cs", "shot_clock_cs")


@query("m5_grid_distances", _IN_LENS(f"""select a.game_id, a.period, a.win as "window", a.step, a.role, a.slot, b.role as to_role, b.slot as to_slot, round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 5) as distance_cft, case when b.role = 'ball' then round(sqrt(b.vx * b.vx + b.vy * b.vy), 5) end as ball_speed
    from gmove_v a join gmove_v b on {_on('a', 'b')} and a.step = b.step and (a.role <> 'ball' and b.role = 'ball' or a.role = 'off' and b.role = 'def')"""))
def _(spark, d):
    return _rounded(gr.grid_distances(places(spark, d)), "distance_cft", "ball_speed")


_VIEWS["gcand_v"] = """select w.game_id, w.period, w.win, b.unix_ms, case when b.bz <= 1000 then coalesce((select arg_min(list_position(ours, p.player_id) - 1, (p.x_cft - b.bx) * (p.x_cft - b.bx) + (p.y_cft - b.bw) * (p.y_cft - b.bw) + list_position(ours, p.player_id) / 100.0) from frames_v p
      where p.game_id = b.game_id and p.period = b.period and p.unix_ms = b.unix_ms and list_contains(ours, p.player_id) and (p.x_cft - b.bx) * (p.x_cft - b.bx) + (p.y_cft - b.bw) * (p.y_cft - b.bw) <= 90000), -1) else -1 end as cand_slot
    from gwin_v w join pball_v b on b.game_id = w.game_id and b.period = w.period and b.unix_ms between t0 and t1"""
_VIEWS["gcrun_v"] = """select *, sum(case when before is null or before <> cand_slot then 1 else 0 end) over (partition by game_id, period, win order by unix_ms rows unbounded preceding) as run
    from (select *, lag(cand_slot) over (partition by game_id, period, win order by unix_ms) as before from gcand_v)"""
_VIEWS["gsticky_v"] = """select game_id, period, win, run, coalesce(last_value(case when n >= 10 or (v <> -1 and nv = -1 and nn >= 10) then v end ignore nulls) over (partition by game_id, period, win order by run rows unbounded preceding), -1) as state
    from (select *, lead(v) over (partition by game_id, period, win order by run) as nv, lead(n) over (partition by game_id, period, win order by run) as nn from (select game_id, period, win, run, any_value(cand_slot) as v, count(*) as n from gcrun_v group by all))"""


@query("l2_window_handlers", _IN_LENS(f"""select r.game_id, r.period, r.win as "window", r.unix_ms, r.cand_slot, s.state as handler_slot from gcrun_v r join gsticky_v s on {_on('r', 's')} and r.run = s.run"""))
def _(spark, d):
    return gr.window_handlers(spans(spark, d), rim_frames(spark, d))
