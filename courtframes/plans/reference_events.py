"""Registered queries of the second layer: handler, touches, flights, transfers, stops, geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from courtframes.operators import events as ev
from courtframes.operators import frames as fr
from courtframes.operators import shots as sh
from courtframes.operators import spans as sp
from courtframes.plans.reference import _VIEWS, direction, frames, index, pbp, query
from courtframes.sources.layers import stored


def handlers(spark, d):
    return stored(spark, d, "handlers", lambda: new_handlers(spark, d))


def new_handlers(spark, d):
    return ev.handler(frames(spark, d), index(spark, d))


def moves(spark, d):
    return stored(spark, d, "moves", lambda: ev.transfers(handlers(spark, d), frames(spark, d)))


def approaches(spark, d):
    return stored(spark, d, "approaches", lambda: ev.approaches(frames(spark, d), handlers(spark, d), sides(spark, d)))


def sides(spark, d):
    return stored(spark, d, "direction", lambda: direction(spark, d))


_F = "game_id, period, unix_ms"
_VIEWS["pball_v"] = f"select {_F}, x_cft as bx, y_cft as bw, z_cft as bz from frames_v where team_id = -1"
_VIEWS["pdist_v"] = """select p.game_id, p.period, p.unix_ms, p.team_id, p.player_id, p.x_cft, p.y_cft, b.bx, b.bw, b.bz, (x_cft - bx) * (x_cft - bx) + (y_cft - bw) * (y_cft - bw) as d2,
    count(*) over (partition by p.game_id, p.period, p.unix_ms, x_cft, y_cft) > 1 as shared from frames_v p join pball_v b on p.game_id = b.game_id and p.period = b.period and p.unix_ms = b.unix_ms where p.team_id <> -1"""
_VIEWS["cand_v"] = f"""select i.game_id, i.period, i.unix_ms, i.segment_id, i.has_ball, b.bz, n.d2 as cand_d2, case when ok then n.player_id else -1 end as cand_id, case when ok then n.team_id else -1 end as cand_team, ok and n.d2 = s.d2 as cand_ambiguous,
      i.has_ball and b.bz <= 1000 as held
    from index_v i left join pball_v b using ({_F}) left join (select *, bz <= 1000 and d2 <= 90000 as ok, row_number() over (partition by {_F} order by d2, player_id) as rn from pdist_v) n on n.game_id = i.game_id and n.period = i.period and n.unix_ms = i.unix_ms and n.rn = 1
    left join (select *, row_number() over (partition by {_F} order by d2, player_id) as rn from pdist_v) s on s.game_id = i.game_id and s.period = i.period and s.unix_ms = i.unix_ms and s.rn = 2"""


def _runs(view: str, value: str) -> str:
    return f"""select *, sum(case when p is null or p <> {value} then 1 else 0 end) over (partition by game_id, segment_id order by unix_ms rows unbounded preceding) as run_id
      from (select *, lag({value}) over (partition by game_id, segment_id order by unix_ms) as p from {view})"""


_VIEWS["crun_v"] = _runs("cand_v", "cand_team")
_VIEWS["control_v"] = """select c.* exclude (p, run_id), w.state as control from crun_v c join (
      with recursive t as (select game_id, segment_id, run_id, min(cand_team) as v, count(*) as n from crun_v group by all),
      walk as (select *, case when v <> -1 and n >= 10 then v else -1 end as state from t where run_id = 1
        union all select t.game_id, t.segment_id, t.run_id, t.v, t.n, case when t.v = -1 or t.v = w.state then w.state
          when t.n >= 25 or (w.v = -1 and w.n >= 10) or (w.state = -1 and t.n >= 10) then t.v else w.state end
        from walk w join t on t.game_id = w.game_id and t.segment_id = w.segment_id and t.run_id = w.run_id + 1) select * from walk) w
    on w.game_id = c.game_id and w.segment_id = c.segment_id and w.run_id = c.run_id"""
_VIEWS["hcand_v"] = """select c.*, case when c.held and q.d2 <= 90000 then q.player_id else -1 end as hc from control_v c
    left join (select *, row_number() over (partition by game_id, period, unix_ms, team_id order by d2, player_id) as rn from pdist_v) q on q.game_id = c.game_id and q.period = c.period and q.unix_ms = c.unix_ms and q.team_id = c.control and q.rn = 1"""
_VIEWS["hrun_v"] = _runs("hcand_v", "hc")
_VIEWS["handler_v"] = """select c.game_id, c.period, c.unix_ms, c.segment_id, c.has_ball, c.bz, c.cand_id, c.cand_d2, coalesce(c.cand_ambiguous, false) as cand_ambiguous, c.control as control_team_id, w.state as handler_id from hrun_v c join (
      with recursive t0 as (select game_id, segment_id, run_id, min(hc) as v, count(*) as n from hrun_v group by all),
      t as (select *, lead(v) over (partition by game_id, segment_id order by run_id) as nv, lead(n) over (partition by game_id, segment_id order by run_id) as nn from t0),
      walk as (select *, case when n >= 10 or (v <> -1 and nv = -1 and nn >= 10) then v else -1 end as state from t where run_id = 1
        union all select t.*, case when t.n >= 10 or (t.v <> -1 and t.nv = -1 and t.nn >= 10) then t.v else w.state end
        from walk w join t on t.game_id = w.game_id and t.segment_id = w.segment_id and t.run_id = w.run_id + 1) select * from walk) w
    on w.game_id = c.game_id and w.segment_id = c.segment_id and w.run_id = c.run_id"""


@query("l2_handler", "select * from handler_v")
def _(spark, d):
    return new_handlers(spark, d)


_VIEWS["trun_v"] = _runs("handler_v", "handler_id")
_VIEWS["touch_v"] = """select game_id, segment_id, period, handler_id, min(unix_ms) as t_start_ms, max(unix_ms) as t_end_ms, count(*) as n_frames, bool_or(cand_ambiguous) as cand_ambiguous, run_id as touch,
    max(unix_ms) filter (cand_id = handler_id) as mine_last, min(unix_ms) filter (cand_id = handler_id) as mine_first from trun_v where handler_id >= 0 group by game_id, segment_id, period, handler_id, run_id"""


@query("l2_touches", "select game_id, segment_id, period, handler_id, t_start_ms, t_end_ms, n_frames, cand_ambiguous from touch_v")
def _(spark, d):
    return ev.touches(handlers(spark, d))


_VIEWS["free_v"] = f"""select h.*, b.bx, b.bw, h.has_ball and h.cand_id < 0 as free, lag(handler_id) over w as before, lead(unix_ms) over w is null as last, lag(bx) over w as lx, lag(bw) over w as ly, lag(h.has_ball and h.cand_id < 0) over w as lfree,
    (least((bx - 525) * (bx - 525), (bx - 8875) * (bx - 8875)) + (bw - 2500) * (bw - 2500) < 40000) and h.bz > 800 and h.bz < 1150 as rim
    from handler_v h left join pball_v b using ({_F}) window w as (partition by h.game_id, h.segment_id order by h.unix_ms)"""
_VIEWS["frun_v"] = "select *, sum(case when p is null or p <> free then 1 else 0 end) over (partition by game_id, segment_id order by unix_ms rows unbounded preceding) as run_id from (select *, lag(free) over (partition by game_id, segment_id order by unix_ms) as p from free_v)"
_VIEWS["flight_v"] = """select f.* exclude (from_raw, t), case when from_raw >= 0 then from_raw end as from_id, q.handler_id as to_id, q.unix_ms as t_to_ms from (
      select game_id, segment_id, period, min(unix_ms) as t_start_ms, max(unix_ms) as t_end_ms, max(unix_ms) as t, count(*) as n_frames, arg_min_null(before, unix_ms) as from_raw, arg_min_null(bx, unix_ms) as x_start, arg_min_null(bw, unix_ms) as y_start, arg_max_null(bx, unix_ms) as x_end,
        arg_max_null(bw, unix_ms) as y_end, max(bz) as max_z, round(coalesce(sum(case when lfree then sqrt((bx - lx) * (bx - lx) + (bw - ly) * (bw - ly)) end), 0), 4) as path_cft, coalesce(bool_or(rim), false) as reaches_rim, min(unix_ms) filter (rim) as t_rim_ms, arg_max_null(last, unix_ms) as ends_segment
      from frun_v where free group by game_id, segment_id, period, run_id having count(*) >= 2) f
    asof left join (select game_id, segment_id, unix_ms, handler_id from handler_v where cand_id >= 0 and handler_id >= 0) q on q.game_id = f.game_id and q.segment_id = f.segment_id and f.t < q.unix_ms"""


@query("l2_flights", "select * from flight_v")
def _(spark, d):
    return ev.flights(handlers(spark, d), frames(spark, d)).withColumn("path_cft", F.round("path_cft", 4))


_VIEWS["moves_v"] = """select p.game_id, p.segment_id, p.period, giver, taker, t_release_ms, t_catch_ms, n_free, (g.x_cft - t.x_cft) * (g.x_cft - t.x_cft) + (g.y_cft - t.y_cft) * (g.y_cft - t.y_cft) as d2,
      case when n_free >= 2 then 'pass' when (g.x_cft - t.x_cft) * (g.x_cft - t.x_cft) + (g.y_cft - t.y_cft) * (g.y_cft - t.y_cft) <= 90000 then 'handoff' when (g.x_cft - t.x_cft) * (g.x_cft - t.x_cft) + (g.y_cft - t.y_cft) * (g.y_cft - t.y_cft) <= 250000 then 'ambiguous' else 'strip' end as kind,
      g.team_id = t.team_id as same_team
    from (select *, (select count(*) from free_v f where f.free and f.game_id = a.game_id and f.segment_id = a.segment_id and f.unix_ms between a.t_release_ms and a.t_catch_ms) as n_free
      from (select game_id, segment_id, period, handler_id as giver, lead(handler_id) over w as taker, coalesce(mine_last, t_end_ms) as t_release_ms, coalesce(lead(mine_first) over w, lead(t_start_ms) over w) as t_catch_ms
            from touch_v window w as (partition by game_id, segment_id order by touch)) a where taker is not null and taker <> giver) p
    left join frames_v g on g.game_id = p.game_id and g.period = p.period and g.unix_ms = p.t_catch_ms and g.player_id = p.giver
    left join frames_v t on t.game_id = p.game_id and t.period = p.period and t.unix_ms = p.t_catch_ms and t.player_id = p.taker"""


@query("l2_transfers", "select * from moves_v")
def _(spark, d):
    return ev.transfers(handlers(spark, d), frames(spark, d))


_VIEWS["stop_v"] = """select game_id, period, r_t as t_last_running_ms, clock_left_cs, t_on as t_onset_ms, exact as onset_exact, k_t as t_start_ms, t_end_ms, game_clock_cs, t_last - t_on as duration_ms, n + 1 as n_frozen_frames, t_last - t_on < 1000 as micro_freeze, coalesce(after_dt > 60, false) as ends_at_gap
    from (select *, case when exact then k_t else least(k_t, r_t + 10 * clock_left_cs) end as t_on from (
      select game_id, period, max(unix_ms) as t_last, count(*) as n, arg_min_null(game_clock_cs, unix_ms) as game_clock_cs, arg_min_null(k_t, unix_ms) as k_t, arg_min_null(r_t, unix_ms) as r_t, arg_max_null(after_t, unix_ms) as t_end_ms, arg_max_null(after_dt, unix_ms) as after_dt,
        greatest(0, arg_min_null(r_clock, unix_ms) - arg_min_null(game_clock_cs, unix_ms)) as clock_left_cs, not arg_min_null(k_gap, unix_ms) and not arg_min_null(r_gap, unix_ms) and not arg_min_null(r_frozen, unix_ms) as exact
      from (select *, sum(case when p is null or p <> clock_frozen then 1 else 0 end) over (partition by game_id, period order by unix_ms rows unbounded preceding) as run_id
            from (select *, lag(clock_frozen) over w as p, lag(unix_ms) over w as k_t, lag(gap) over w as k_gap, lag(unix_ms, 2) over w as r_t, lag(gap, 2) over w as r_gap, lag(clock_frozen, 2) over w as r_frozen, lag(game_clock_cs, 2) over w as r_clock,
                    lead(unix_ms) over w as after_t, lead(dt_ms) over w as after_dt from index_v window w as (partition by game_id, period order by unix_ms)))
      where clock_frozen group by game_id, period, run_id) where r_t is not null) where t_last - t_on >= 200"""


@query("l2_clock_stops", "select * from stop_v")
def _(spark, d):
    return ev.clock_stops(index(spark, d))


@query("l2_stop_coverage", "select s.game_id, s.period, s.t_onset_ms, count(*) as n_frames, count(*) filter (has_ball and n_players = 10) as n_full, count(*) filter (has_ball) as n_ball from stop_v s join index_v i on i.game_id = s.game_id and i.period = s.period and i.unix_ms >= s.t_onset_ms - 3000 and i.unix_ms < s.t_onset_ms group by all")
def _(spark, d):
    own = index(spark, d)
    return ev.stop_coverage(ev.clock_stops(own), own)


@query("m1_shared_places", f"select {_F}, player_id from pdist_v where shared")
def _(spark, d):
    return ev.shared_places(frames(spark, d))


_VIEWS["sole_v"] = """select p.game_id, p.period, p.unix_ms, p.team_id, p.player_id, p.x_cft, p.y_cft, n.n > 1 as shared from (select * from frames_v where team_id <> -1) p
    join (select game_id, period, unix_ms, x_cft, y_cft, count(*) as n from frames_v where team_id <> -1 group by all) n on p.game_id = n.game_id and p.period = n.period and p.unix_ms = n.unix_ms and p.x_cft = n.x_cft and p.y_cft = n.y_cft"""


@query("m2_pair_distances", "select a.game_id, a.period, a.unix_ms, a.player_id as id_a, b.player_id as id_b, case when not (a.shared or b.shared) then (a.x_cft - b.x_cft) * (a.x_cft - b.x_cft) + (a.y_cft - b.y_cft) * (a.y_cft - b.y_cft) end as d2, a.shared or b.shared as xy_shared from (select * from sole_v where team_id = 100) a join (select * from sole_v where team_id = 200) b on a.game_id = b.game_id and a.period = b.period and a.unix_ms = b.unix_ms")
def _(spark, d):
    return ev.pair_distances(frames(spark, d))


@query("m3_ball_distances", f"select {_F}, team_id, player_id, case when not shared then d2 end as d2 from pdist_v")
def _(spark, d):
    return ev.ball_distances(frames(spark, d))


_VIEWS["speed_v"] = """select game_id, period, unix_ms, player_id, case when t2 - unix_ms <= 60 and unix_ms - t0 <= 60 then sqrt((x2 - x0) * (x2 - x0) + (y2 - y0) * (y2 - y0)) / ((t2 - t0) / 1000.0) end as speed from (
      select *, lead(unix_ms) over w as t2, lag(unix_ms) over w as t0, lead(xs) over w as x2, lag(xs) over w as x0, lead(ys) over w as y2, lag(ys) over w as y0 from (
        select *, avg(x_cft) over w as xs, avg(y_cft) over w as ys from frames_v where team_id <> -1 window w as (partition by game_id, player_id, period order by unix_ms rows between 2 preceding and 2 following))
      window w as (partition by game_id, player_id, period order by unix_ms))"""


@query("m4_player_speeds", "select game_id, period, unix_ms, player_id, round(speed, 4) as speed from speed_v")
def _(spark, d):
    return ev.player_speeds(frames(spark, d)).withColumn("speed", F.round("speed", 4))


@query(
    "m6_snapshots",
    f"""select {_F}, string_agg(player_id, ',' order by player_id) as ids, string_agg(d2, ',' order by player_id) as ball_d2, any_value(pair_d2) as pair_d2 from pdist_v join (
      select a.game_id, a.period, a.unix_ms, string_agg((a.x_cft - b.x_cft) * (a.x_cft - b.x_cft) + (a.y_cft - b.y_cft) * (a.y_cft - b.y_cft), ',' order by a.player_id, b.player_id) as pair_d2
      from pdist_v a join pdist_v b on a.game_id = b.game_id and a.period = b.period and a.unix_ms = b.unix_ms and a.team_id < b.team_id group by all) using ({_F}) where unix_ms % 5 = 0 group by {_F}""",
)
def _(spark, d):
    own = frames(spark, d)
    return ev.snapshots(own, own.filter("unix_ms % 5 = 0"))


@query("l2_dribbles")
def _(spark, d):
    return ev.dribbles(handlers(spark, d), frames(spark, d))


_VIEWS["approach_v"] = """select game_id, period, segment_id, player_id, min(unix_ms) as t_start_ms, max(unix_ms) as t_end_ms, count(*) as n_frames, case when arg_min_null(has_it, unix_ms) then 'drive' else 'cut' end as kind from (
      select *, sum(case when p is null or p <> nears then 1 else 0 end) over (partition by game_id, player_id, period, segment_id order by unix_ms rows unbounded preceding) as run_id from (
        select *, lag(nears) over (partition by game_id, player_id, period, segment_id order by unix_ms) as p from (
          select r.*, h.segment_id, coalesce(r.rate > 500, false) and h.control_team_id = r.team_id as nears, h.handler_id = r.player_id as has_it from (
            select *, -(lead(dist) over w - lag(dist) over w) / ((lead(unix_ms) over w - lag(unix_ms) over w) / 1000.0) as rate from (
              select f.*, sqrt((x_cft - case when coalesce(attacks_left, true) then 525 else 8875 end) ** 2 + (y_cft - 2500) ** 2) as dist from frames_v f left join direction_v s on s.game_id = f.game_id and s.team_id = f.team_id and s.period = f.period where f.team_id <> -1)
            window w as (partition by game_id, player_id, period order by unix_ms)) r join handler_v h using (game_id, period, unix_ms))))
    where nears group by game_id, period, segment_id, player_id, run_id having count(*) >= 8 and (not arg_min_null(has_it, unix_ms) or arg_min_null(dist, unix_ms) >= 1000)"""


@query("l2_drives_cuts", "select * from approach_v")
def _(spark, d):
    return ev.approaches(frames(spark, d), handlers(spark, d), sides(spark, d))


@query("l2_screens")
def _(spark, d):
    return ev.screens(frames(spark, d), handlers(spark, d))


@query("l2_postups")
def _(spark, d):
    return ev.postups(frames(spark, d), handlers(spark, d), sides(spark, d), frames=10)


_VIEWS["located_v"] = """select game_id, period, event_num, msg_type, p1_id as player_id, p1_team_id as team_id, unix_ms as t_ms from (select r.*, i.unix_ms, row_number() over (partition by r.game_id, r.event_num
      order by not (game_clock_cs >= r.pctime_sec * 100 and game_clock_cs < r.pctime_sec * 100 + 100), segment_id, abs(2 * (game_clock_cs - r.pctime_sec * 100) - 100), unix_ms) as rn
      from pbp_v r join index_v i on i.game_id = r.game_id and i.period = r.period and abs(game_clock_cs - r.pctime_sec * 100) <= 100) where rn = 1"""
_VIEWS["transfer_v"] = """select t.game_id, t.segment_id, t.period, t.giver, t.taker, t.t_release_ms, t.t_catch_ms, case when t.giver <= 1005 then 100 else 200 end as team_id from (
      select game_id, segment_id, period, handler_id as giver, lead(handler_id) over w as taker, coalesce(mine_last, t_end_ms) as t_release_ms, coalesce(lead(mine_first) over w, lead(t_start_ms) over w) as t_catch_ms
      from touch_v window w as (partition by game_id, segment_id order by touch)) t where taker is not null and taker <> giver"""


def _moves(spark, d):
    return moves(spark, d).select("game_id", "segment_id", "period", "giver", "taker", "t_release_ms", "t_catch_ms", F.when(F.col("giver") <= 1005, 100).otherwise(200).alias("team_id"))


def _located(spark, d):
    """Play-by-play rows put on the time axis by their clock."""
    return stored(spark, d, "located", lambda: _new_located(spark, d))


def _new_located(spark, d):
    rows = pbp(spark, d).select("game_id", "period", "event_num", "msg_type", F.col("p1_id").alias("player_id"), F.col("p1_team_id").alias("team_id"), (F.col("pctime_sec") * 100).alias("clock_cs"))
    return fr.locate_clock(index(spark, d), rows).select("game_id", "period", "event_num", "msg_type", "player_id", "team_id", F.col("unix_ms").alias("t_ms"))


@query("l2_dead_ball", """select t.*, coalesce(abs(b.game_clock_cs - a.game_clock_cs) < 1, false) as dead_ball from (select *, coalesce(t_catch_ms, t_release_ms) as t0, coalesce(t_catch_ms, t_release_ms) + 1000 as t1 from transfer_v) t
    asof left join index_v a on a.game_id = t.game_id and a.period = t.period and t.t0 >= a.unix_ms asof left join index_v b on b.game_id = t.game_id and b.period = t.period and t.t1 >= b.unix_ms""".replace("select t.*,", "select t.* exclude (t0, t1),"))
def _(spark, d):
    return ev.mark_dead_ball(_moves(spark, d), index(spark, d))


@query(
    "l2_after_made",
    """select t.*, exists (select 1 from (select m.game_id, m.period, m.team_id, m.t_ms, least(m.t_ms + 10000, (select min(h.unix_ms) from handler_v h where h.game_id = m.game_id and h.period = m.period and h.unix_ms > m.t_ms and h.handler_id >= 0 and (case when h.handler_id <= 1005 then 100 else 200 end) <> m.team_id)) as t_end
        from located_v m where m.msg_type = 1) s where s.game_id = t.game_id and s.period = t.period and s.team_id = t.team_id and t.t_release_ms >= s.t_ms and t.t_release_ms < s.t_end) as after_made_fg from transfer_v t""",
)
def _(spark, d):
    held = handlers(spark, d).filter("handler_id >= 0").select("game_id", "period", "unix_ms", F.when(F.col("handler_id") <= 1005, 100).otherwise(200).alias("team_id"))
    return ev.mark_after_made(_moves(spark, d), _located(spark, d).filter("msg_type = 1"), held)


@query("l2_pass_is_shot", "select t.*, exists (select 1 from located_v s where s.msg_type in (1, 2) and s.game_id = t.game_id and s.period = t.period and s.player_id = t.giver and abs(s.t_ms - t.t_release_ms) <= 200) as is_shot from transfer_v t")
def _(spark, d):
    return ev.mark_is_shot(_moves(spark, d), _located(spark, d).filter("msg_type in (1, 2)"))


@query("l2_stop_causes", """select s.*, coalesce(['foul', 'violation', 'turnover', 'jump_ball', 'timeout', 'replay', 'ejection'][(select min(case msg_type when 6 then 1 when 7 then 2 when 5 then 3 when 10 then 4 when 9 then 5 when 18 then 6 when 11 then 7 end) from located_v l
    where l.game_id = s.game_id and l.period = s.period and l.t_ms between s.t_onset_ms - 2000 and s.t_onset_ms + 2000)], 'unknown') as cause from stop_v s""")
def _(spark, d):
    return ev.stop_causes(ev.clock_stops(index(spark, d)), _located(spark, d))


_VIEWS["halves_v"] = """
    select * from (with recursive r as (select game_id, period, run_id, bool_or(front) as front, min(unix_ms) as t0, max(unix_ms) as t1, count(*) as n from (
        select *, sum(case when p is null or p <> front then 1 else 0 end) over (partition by game_id, period order by unix_ms rows unbounded preceding) as run_id
        from (select *, lag(front) over (partition by game_id, period order by unix_ms) as p from (select game_id, period, unix_ms, bx < 4700 as front from pball_v))) group by all),
      walk as (select game_id, period, run_id, cast(1 as bigint) as merged_id, front from r where run_id = 1
        union all select r.game_id, r.period, r.run_id, cast(w.merged_id + case when r.t1 - r.t0 < 400 or w.front = r.front then 0 else 1 end as bigint), case when r.t1 - r.t0 < 400 or w.front = r.front then w.front else r.front end
        from walk w join r on r.game_id = w.game_id and r.period = w.period and r.run_id = w.run_id + 1)
    select w.game_id, w.period, merged_id, bool_or(w.front) as front, min(t0) as t_start, max(t1) as t_end, cast(sum(n) as bigint) as n from walk w join r on r.game_id = w.game_id and r.period = w.period and r.run_id = w.run_id group by w.game_id, w.period, merged_id)"""


@query("p11_half_runs", "select * from halves_v")
def half_runs(spark, d):
    ball = frames(spark, d).filter("team_id = -1").select("game_id", "period", "unix_ms", (F.col("x_cft") < 4700).alias("front"))
    return ev.half_runs(ball)


@query("l2_screen_groups")
def _(spark, d):
    return ev.group_screens(ev.screens(frames(spark, d), handlers(spark, d)))


@query("l2_incomplete_passes", """select game_id, segment_id, giver, t_release_ms, period, t_start_ms, t_end_ms, ends_segment from (select *, row_number() over (partition by game_id, segment_id, giver, t_release_ms order by t_start_ms) as rn from (
      select f.game_id, f.segment_id, f.period, f.from_id as giver, f.t_start_ms, f.t_end_ms, f.ends_segment, coalesce(h.unix_ms, f.t_start_ms) as t_release_ms
      from (select * from flight_v where from_id is not null and to_id is null and not reaches_rim) f
      asof left join (select game_id, segment_id, cand_id, unix_ms from handler_v where cand_id >= 0) h on h.game_id = f.game_id and h.segment_id = f.segment_id and h.cand_id = f.from_id and f.t_start_ms >= h.unix_ms)) where rn = 1""")
def _(spark, d):
    held = handlers(spark, d)
    return ev.incomplete_passes(ev.flights(held, frames(spark, d)), held)


@query("l2_shot_windows", """select f.game_id, f.segment_id, f.period, f.t_start_ms as t_from_ms, coalesce(t.t_start_ms, f.t_end_ms) as t_to_ms from (select * from flight_v where reaches_rim) f
    asof left join (select game_id, segment_id, t_start_ms from touch_v where n_frames >= 10) t on t.game_id = f.game_id and t.segment_id = f.segment_id and f.t_end_ms < t.t_start_ms""")
def _(spark, d):
    held = handlers(spark, d)
    return ev.shot_windows(ev.flights(held, frames(spark, d)), ev.touches(held))


_VIEWS["shotat_v"] = """select l.game_id, l.period, l.event_num, l.msg_type, l.team_id, l.player_id as shooter_id, s.attacks_left, l.t_ms as t_pbp_ms, l.t_ms + 40 * (l.event_num % 5) - 80 as t_release_ms
    from located_v l join direction_v s on s.game_id = l.game_id and s.period = l.period and s.team_id = l.team_id where l.msg_type in (1, 2)"""


def _shots(spark, d):
    """Attempts released about the frame of their clock, for the steps behind the release."""
    rows = _located(spark, d).filter("msg_type in (1, 2)").withColumnRenamed("player_id", "shooter_id").join(sides(spark, d).select("game_id", "period", "team_id", "attacks_left"), ["game_id", "period", "team_id"])
    return rows.select("game_id", "period", "event_num", "msg_type", "team_id", "shooter_id", "attacks_left", F.col("t_ms").alias("t_pbp_ms"), (F.col("t_ms") + 40 * (F.col("event_num") % 5) - 80).alias("t_release_ms"))


@query("l2_shot_releases")
def _(spark, d):
    return sh.releases(frames(spark, d), index(spark, d), pbp(spark, d), direction(spark, d))


@query("l2_shot_events")
def _(spark, d):
    return sh.shot_events(frames(spark, d), index(spark, d), pbp(spark, d), direction(spark, d), handlers(spark, d))


_VIEWS["fallball_v"] = "select *, coalesce(bz < lag(bz) over (partition by game_id, period order by unix_ms), false) as lower from pball_v"
_VIEWS["firm_v"] = "select game_id, period, unix_ms, segment_id, handler_id, control_team_id, count(*) over (partition by game_id, segment_id, run_id order by unix_ms desc) as n_left from trun_v"
_VIEWS["facts_v"] = """select s.* exclude (t_at), l.unix_ms as t_landing_ms, l.bx as x_landing, l.bw as y_landing, case when c.segment_id = g.segment_id then c.unix_ms end as t_control_ms, case when c.segment_id = g.segment_id then c.handler_id end as control_id,
      case when c.segment_id = g.segment_id then c.control_team_id end as control_team_id, case when c.segment_id = g.segment_id and msg_type = 2 then c.control_team_id = team_id end as offensive_rebound
    from (select s.*, x_release, y_release, t_rim_ms, coalesce(t_rim_ms, t_release_ms) as t_at from shotat_v s left join (
        select s.game_id, s.event_num, arg_min(bx, unix_ms) as x_release, arg_min(bw, unix_ms) as y_release, min(unix_ms) filter ((bx - case when attacks_left then 525 else 8875 end) ** 2 + (bw - 2500) ** 2 < 40000 and bz > 800 and bz < 1150) as t_rim_ms
        from shotat_v s join pball_v b on b.game_id = s.game_id and b.period = s.period and b.unix_ms between s.t_release_ms and s.t_release_ms + 3000 group by all) r on r.game_id = s.game_id and r.event_num = s.event_num) s
    left join lateral (select b.unix_ms, b.bx, b.bw from fallball_v b where b.game_id = s.game_id and b.period = s.period and b.unix_ms > s.t_rim_ms and b.unix_ms <= s.t_release_ms + 3000 and lower and bz < 900 order by b.unix_ms limit 1) l on true
    asof left join firm_v g on g.game_id = s.game_id and g.period = s.period and s.t_at <= g.unix_ms
    asof left join (select * from firm_v where handler_id >= 0 and n_left >= 10) c on c.game_id = s.game_id and c.period = s.period and s.t_at <= c.unix_ms"""


@query("l2_after_release", "select * from facts_v")
def _(spark, d):
    return sh.after_release(_shots(spark, d), frames(spark, d), handlers(spark, d))


@query("l2_settled_releases", """select * exclude (twin, nxt, t_release_ms, x_release, y_release, t_rim_ms, t_landing_ms, x_landing, y_landing, t_control_ms, control_id, control_team_id, offensive_rebound),
      case when not twin then t_release_ms end as t_release_ms, case when not twin then x_release end as x_release, case when not twin then y_release end as y_release, case when not twin and (nxt is null or t_rim_ms < nxt) then t_rim_ms end as t_rim_ms,
      case when not twin and (nxt is null or t_landing_ms < nxt) then t_landing_ms end as t_landing_ms, case when not twin and (nxt is null or t_landing_ms < nxt) then x_landing end as x_landing, case when not twin and (nxt is null or t_landing_ms < nxt) then y_landing end as y_landing,
      case when not twin and (nxt is null or t_control_ms < nxt) then t_control_ms end as t_control_ms, case when not twin and (nxt is null or t_control_ms < nxt) then control_id end as control_id, case when not twin and (nxt is null or t_control_ms < nxt) then control_team_id end as control_team_id,
      case when not twin and (nxt is null or t_control_ms < nxt) then offensive_rebound end as offensive_rebound, case when twin then 'duplicate_release' else 'rim' end as method
    from (select f.*, (select min(o.t_release_ms) from facts_v o where o.game_id = f.game_id and o.period = f.period and o.t_release_ms > f.t_release_ms) as nxt,
      exists (select 1 from facts_v o where o.game_id = f.game_id and o.period = f.period and o.t_release_ms = f.t_release_ms and (abs(o.t_pbp_ms - o.t_release_ms), o.event_num) < (abs(f.t_pbp_ms - f.t_release_ms), f.event_num)) as twin from facts_v f)""")
def _(spark, d):
    return sh.settle_releases(sh.after_release(_shots(spark, d), frames(spark, d), handlers(spark, d)).withColumn("method", F.lit("rim")))


@query("l2_touch_endings", """select t.game_id, t.segment_id, t.period, t.handler_id, t.t_start_ms, t.t_end_ms, t.n_frames, t.cand_ambiguous, case when exists (select 1 from shotat_v s where s.game_id = t.game_id and s.period = t.period and s.shooter_id = t.handler_id and s.t_release_ms between t.t_end_ms - 200 and t.t_end_ms + 200) then 'shot'
      else coalesce((select arg_min(case when not m.same_team then 'turnover' when m.kind = 'handoff' then 'handoff' else 'pass' end, m.t_release_ms) from moves_v m where m.game_id = t.game_id and m.period = t.period and m.giver = t.handler_id and m.t_release_ms between t.t_end_ms - 200 and t.t_end_ms + 200), 'none') end as ends_with from touch_v t""")
def _(spark, d):
    return sh.touch_endings(ev.touches(handlers(spark, d)), _shots(spark, d), moves(spark, d))


@query("l2_approach_endings", """select a.*, case when a.kind = 'drive' then case when exists (select 1 from shotat_v s where s.game_id = a.game_id and s.period = a.period and s.shooter_id = a.player_id and s.t_release_ms between a.t_start_ms and a.t_end_ms + 500) then 'shot'
        when exists (select 1 from moves_v m where m.game_id = a.game_id and m.period = a.period and m.giver = a.player_id and not m.same_team and m.t_release_ms between a.t_start_ms and a.t_end_ms + 500) then 'turnover'
        when exists (select 1 from moves_v m where m.game_id = a.game_id and m.period = a.period and m.giver = a.player_id and m.t_release_ms between a.t_start_ms and a.t_end_ms + 500) then 'pass'
        when exists (select 1 from located_v l where l.msg_type = 6 and l.game_id = a.game_id and l.period = a.period and l.t_ms between a.t_start_ms and a.t_end_ms + 500) then 'foul' else 'none' end end as end_reason,
      case when a.kind = 'cut' then (select min(m.t_catch_ms) from moves_v m where m.game_id = a.game_id and m.period = a.period and m.taker = a.player_id and m.same_team and m.t_catch_ms between a.t_start_ms and a.t_end_ms + 500) end as t_catch_ms from approach_v a""")
def _(spark, d):
    fouls = _located(spark, d).filter("msg_type = 6").select("game_id", "period", F.col("t_ms").alias("t"))
    return sh.approach_endings(approaches(spark, d), _shots(spark, d), moves(spark, d), fouls)


@query("l2_empty_frames", "select m.*, (select count(*) from handler_v h where h.handler_id < 0 and h.game_id = m.game_id and h.period = m.period and h.unix_ms > m.t_release_ms and h.unix_ms < m.t_catch_ms) as n_no_handler_frames from moves_v m")
def _(spark, d):
    return sh.empty_frames(moves(spark, d), handlers(spark, d))


@query("v3_repeated_ids", "select kind, cast(sum(n) as bigint) as n_events, count(*) as n_ids, count(*) filter (n > 1) as n_repeated from (select kind, concat(game_id, ':', t_start_ms - t_start_ms % 10000, ':', player_id) as uid, count(*) as n from approach_v group by all) group by kind")
def _(spark, d):
    return sh.repeated_ids(approaches(spark, d).withColumn("uid", F.concat_ws(":", "game_id", F.col("t_start_ms") - F.col("t_start_ms") % 10000, "player_id")), "uid", "kind")


_VIEWS["spell_v"] = "select game_id, period, merged_id as poss_seq, case when front then 100 else 200 end as offense_team_id, t_start as t_start_ms, t_end as t_end_ms from halves_v"
_VIEWS["window_v"] = 'select game_id, period, concat(segment_id, chr(58), player_id, chr(58), t_start_ms) as "window", case when player_id <= 1005 then 100 else 200 end as team_id, t_start_ms as lo, case when t_start_ms % 3 = 0 then t_start_ms else t_end_ms end as hi from approach_v'


def _ledger(spark, d):
    """Stretches of the ball in one half, as possessions."""
    halves = stored(spark, d, "half_runs", lambda: half_runs(spark, d))
    return halves.select("game_id", "period", F.col("merged_id").alias("poss_seq"), F.when(F.col("front"), 100).otherwise(200).cast("long").alias("offense_team_id"), F.col("t_start").alias("t_start_ms"), F.col("t_end").alias("t_end_ms"))


def _windows(spark, d):
    """Drives and cuts as windows, a third of them without length."""
    return approaches(spark, d).select("game_id", "period", F.concat_ws(":", "segment_id", "player_id", "t_start_ms").alias("window"), F.when(F.col("player_id") <= 1005, 100).otherwise(200).cast("long").alias("team_id"), F.col("t_start_ms").alias("lo"), F.when(F.col("t_start_ms") % 3 == 0, F.col("t_start_ms")).otherwise(F.col("t_end_ms")).alias("hi"))


@query("p7_window_possession", """select w.*, poss_seq, round(coalesce(frac, 0), 6) as overlap_frac, offense_team_id = team_id as offense_match from window_v w left join (
      select *, row_number() over (partition by game_id, period, "window" order by frac desc, case when part = 0 then -poss_seq else poss_seq end) as rn from (
        select w.game_id, w.period, w."window", l.poss_seq, l.offense_team_id, least(hi, t_end_ms) - greatest(lo, t_start_ms) as part, case when hi > lo then (least(hi, t_end_ms) - greatest(lo, t_start_ms)) / (hi - lo) else 1.0 end as frac
        from window_v w join spell_v l on l.game_id = w.game_id and l.period = w.period and (case when hi > lo then t_start_ms < hi and t_end_ms > lo else lo between t_start_ms and t_end_ms end))) b
    on b.game_id = w.game_id and b.period = w.period and b."window" = w."window" and rn = 1""")
def _(spark, d):
    return sp.attach_possession(_windows(spark, d), _ledger(spark, d)).withColumn("overlap_frac", F.round("overlap_frac", 6))


_VIEWS["lineup_v"] = "select game_id, period, unix_ms, string_agg(player_id, ',' order by player_id) filter (team_id = 100) as a, string_agg(player_id, ',' order by player_id) filter (team_id = 200) as b from frames_v where team_id <> -1 and (player_id <> 1003 or unix_ms % 4000 < 3000) group by all"


@query("p12_lineups", """select l.game_id, l.period, l.poss_seq as span, offense_team_id as team_id, l.t_start_ms, l.t_end_ms, case when offense_team_id = 100 then f.a else f.b end as own_ids, case when offense_team_id = 100 then f.b else f.a end as other_ids, f.a = g.a and f.b = g.b as lineup_stable
    from spell_v l asof left join lineup_v f on f.game_id = l.game_id and f.period = l.period and l.t_start_ms <= f.unix_ms asof left join lineup_v g on g.game_id = l.game_id and g.period = l.period and l.t_end_ms >= g.unix_ms""")
def _(spark, d):
    # one player leaves and returns, so that not all line-ups are stable
    there = frames(spark, d).filter("player_id <> 1003 or unix_ms % 4000 < 3000")
    rows = sp.lineups(_ledger(spark, d).select("game_id", "period", F.col("poss_seq").alias("span"), F.col("offense_team_id").alias("team_id"), "t_start_ms", "t_end_ms"), there)
    return rows.withColumns({c: F.array_join(c, ",") for c in ("own_ids", "other_ids")})


@query("f13_peaks", """select game_id, period, unix_ms, min(case when not rising then unix_ms end) over (partition by game_id, period order by unix_ms rows between current row and unbounded following) as up_ms,
      max(case when not falling then unix_ms end) over (partition by game_id, period order by unix_ms rows unbounded preceding) as down_ms
    from (select *, coalesce(lead(bz) over w > bz, false) as rising, coalesce(lag(bz) over w > bz, false) as falling from pball_v window w as (partition by game_id, period order by unix_ms))""")
def _(spark, d):
    return sh.peaks(ev.ball_rows(frames(spark, d))).select("game_id", "period", "unix_ms", "up_ms", "down_ms")


@query("f16_approach_start", """select game_id, period, unix_ms, player_id, last_value(case when before is null or before < d2 then unix_ms end ignore nulls) over (partition by game_id, period, player_id order by unix_ms rows unbounded preceding) as t_approach
    from (select game_id, period, unix_ms, player_id, d2, lag(d2) over (partition by game_id, period, player_id order by unix_ms) as before from (select game_id, period, unix_ms, player_id, case when not shared then d2 end as d2 from pdist_v) where d2 is not null)""")
def _(spark, d):
    rows = ev.ball_distances(frames(spark, d)).filter("d2 is not null").select("game_id", "period", "unix_ms", "player_id", "d2")
    return sp.approach_start(rows, ["game_id", "period", "player_id"], "unix_ms", "d2").drop("d2")


@query("f18_grid_labels", """select g.game_id, g.period, g.span, g.unix_ms, coalesce(case when b.unix_ms is null or a.unix_ms - g.unix_ms < g.unix_ms - b.unix_ms then a.handler_id else b.handler_id end, -1) as handler_id
    from (select game_id, period, span, unnest(range(t0, t1 + 1, 200)) as unix_ms from (select game_id, period, segment_id as span, min(unix_ms) + 7 as t0, max(unix_ms) + 7 as t1 from index_v group by all)) g
    asof left join handler_v b on b.game_id = g.game_id and b.period = g.period and g.unix_ms >= b.unix_ms asof left join handler_v a on a.game_id = g.game_id and a.period = g.period and g.unix_ms <= a.unix_ms""")
def _(spark, d):
    own = index(spark, d).groupBy("game_id", "period", F.col("segment_id").alias("span")).agg((F.min("unix_ms") + 7).alias("t_start_ms"), (F.max("unix_ms") + 7).alias("t_end_ms"))
    return sp.grid_labels(own, handlers(spark, d), "handler_id", 200)


_VIEWS["hit_v"] = """select p.game_id, p.period, p.event_num, p.p1_team_id as team_id, arg_min(x < 4700, unix_ms) filter (z > 800 and z < 1150 and (least((x - 525) ** 2, (x - 8875) ** 2) + (y - 2500) ** 2 < 40000)) as rim_left
    from pbp_v p join (select game_id, period, unix_ms, game_clock_cs, x_cft as x, y_cft as y, z_cft as z from frames_v where team_id = -1) b on b.game_id = p.game_id and b.period = p.period and b.game_clock_cs between p.pctime_sec * 100 - 200 and p.pctime_sec * 100 + 500
    where p.msg_type in (1, 2) and p.p1_team_id is not null group by all"""


@query("l1_direction_check", """select h.game_id, count(*) filter (rim_left is not null and attacks_left is not null) as n_shots_rim, count(*) filter (rim_left = attacks_left) as n_agree, count(*) filter (rim_left is null) as n_no_rim
    from hit_v h left join direction_v s on s.game_id = h.game_id and s.period = h.period and s.team_id = h.team_id group by h.game_id""")
def _(spark, d):
    return sp.direction_check(frames(spark, d), pbp(spark, d), direction(spark, d))
