"""Registered query of the shot clock's resets, over the log of all kinds of calls and the frames whose ball reaches the rim."""

from __future__ import annotations

from pyspark.sql import functions as F

from courtframes.operators import events as ev
from courtframes.operators import frames as fr
from courtframes.operators import playbyplay as pb
from courtframes.operators import possessions as po
from courtframes.operators import reports as rp
from courtframes.operators import resets as rs
from courtframes.operators import shot_clock as sc
from courtframes.operators import shots as sh
from courtframes.operators import spans as sp
from courtframes.plans.lenses import FRAMES_RIM, PBP_CALLS, spark_view, sql_view
from courtframes.plans.reference import _VIEWS, index, query
from courtframes.plans.reference_alignment import _over, rim_frames, rim_handlers
from courtframes.sources.layers import stored

_VIEWS["pcalls_v"] = sql_view(PBP_CALLS)
_VIEWS["frim_v"] = sql_view(FRAMES_RIM)


def calls(spark, d):
    return stored(spark, d, "pbp_calls", lambda: spark_view(spark, d, PBP_CALLS))


def located(spark, d):
    """Rows of the log on the time axis by their clock."""
    rows = calls(spark, d).select("game_id", "period", "event_num", "msg_type", F.col("p1_id").alias("player_id"), F.col("p1_team_id").alias("team_id"), (F.col("pctime_sec") * 100).alias("clock_cs"))
    return stored(spark, d, "located_calls", lambda: fr.locate_clock(index(spark, d), rows).withColumnRenamed("unix_ms", "t_ms").drop("clock_cs"))


def sides(spark, d):
    return stored(spark, d, "direction_calls", lambda: fr.attack_direction(rim_frames(spark, d), calls(spark, d)))


def timed_ledger(spark, d):
    """Possessions that start where the clock of their first row is."""
    at = located(spark, d).select("game_id", F.col("event_num").cast("long").alias("start_event_num"), F.col("t_ms").alias("t_start_ms"))
    return stored(spark, d, "ledger_calls", lambda: po.possessions(calls(spark, d)).join(at, ["game_id", "start_event_num"], "left"))


def attempts(spark, d):
    """Attempts released about the frame of their clock, with rim contact and control after it."""
    shots = located(spark, d).filter("msg_type in (1, 2)").withColumnRenamed("player_id", "shooter_id").join(sides(spark, d).select("game_id", "period", "team_id", "attacks_left"), ["game_id", "period", "team_id"])
    shots = shots.select("game_id", "period", "event_num", "msg_type", "team_id", "shooter_id", "attacks_left", F.col("t_ms").alias("t_pbp_ms"), (F.col("t_ms") + 40 * (F.col("event_num") % 5) - 80).alias("t_release_ms"))
    return sh.after_release(shots, rim_frames(spark, d), rim_handlers(spark, d)).withColumn("made", F.col("msg_type") == 1)


def fouls(spark, d):
    """Fouls with the free throws that the other team takes at their clock."""
    log = calls(spark, d)
    thrown = log.filter("msg_type = 3").groupBy("game_id", "period", "pctime_sec", F.col("p1_team_id").alias("thrower")).count()
    called = pb.foul_states(log).select("game_id", "period", "event_num", "pctime_sec", F.col("p1_team_id").alias("committed_by_team"), "detail")
    both = called.join(thrown, ["game_id", "period", "pctime_sec"], "left").groupBy(*called.columns)
    return both.agg(F.coalesce(F.sum(F.when(F.col("thrower") != F.col("committed_by_team"), F.col("count"))), F.lit(0)).alias("n_free_throws"))


def clock_resets(spark, d):
    moves = ev.transfers(rim_handlers(spark, d), rim_frames(spark, d)).select("game_id", "period", "t_release_ms", "t_catch_ms")
    inbounds = ev.mark_dead_ball(moves, index(spark, d)).filter("dead_ball")
    build = lambda: rs.shot_clock_resets(timed_ledger(spark, d), attempts(spark, d), inbounds, fouls(spark, d), calls(spark, d), located(spark, d), index(spark, d), ev.ball_rows(rim_frames(spark, d)), sides(spark, d))
    return stored(spark, d, "resets_calls", build)


_VIEWS["rstart_v"] = "select l.game_id, l.period, l.poss_seq, l.offense_team_id, l.start_type, t.t_ms from ledger_v l join located_v t on t.game_id = l.game_id and t.event_num = l.start_event_num"
_VIEWS["rhold_v"] = "select game_id, period, t_ms, arg_max(offense_team_id, poss_seq) as offense from rstart_v group by all"
_VIEWS["rrim_v"] = "select game_id, period, t_rim_ms as t, t_control_ms as run from facts_v where msg_type = 2 and t_rim_ms is not null"
_VIEWS["rcall_v"] = """select f.*, h.offense, coalesce(f.team <> h.offense, false) as defensive from (
      select f.game_id, f.period, f.event_num, f.p1_team_id as team, f.detail, t.t_ms, (select count(*) from pbp_v p where p.msg_type = 3 and p.game_id = f.game_id and p.period = f.period and p.pctime_sec = f.pctime_sec and p.p1_team_id <> f.p1_team_id) as n_ft
      from foul_v f join located_v t on t.game_id = f.game_id and t.event_num = f.event_num where f.p1_team_id is not null) f asof left join rhold_v h on h.game_id = f.game_id and h.period = f.period and f.t_ms >= h.t_ms"""
_VIEWS["rhalf_v"] = """select c.game_id, c.period, c.event_num, c.t_ms, case when (median(b.bx) < 4700) = any_value(s.attacks_left) then 'front' else 'back' end as half
    from (select c.*, (select min(i.unix_ms) from index_v i where i.game_id = c.game_id and i.period = c.period and not i.clock_frozen and i.unix_ms > c.t_ms) as t_run from rcall_v c
      where defensive and n_ft = 0 and detail in ('personal', 'personal_block', 'personal_take', 'loose_ball', 'inbound')) c
    join pball_v b on b.game_id = c.game_id and b.period = c.period and b.unix_ms between c.t_run - 200 and c.t_run + 400 join direction_v s on s.game_id = c.game_id and s.period = c.period and s.team_id = c.offense group by all"""
_VIEWS["rkick_v"] = """select k.*, h.offense from (select p.game_id, p.period, p.p1_team_id as team, t.t_ms from pbp_v p join located_v t on t.game_id = p.game_id and t.event_num = p.event_num where p.msg_type = 7 and p.action_type = 5) k
    asof join rhold_v h on h.game_id = k.game_id and h.period = k.period and k.t_ms >= h.t_ms"""
_VIEWS["rall_v"] = """select game_id, period, t, run, 'full' as rule, 'rim' as cause, 0 as rank from rrim_v
    union all select game_id, period, t_ms, null, 'full', concat('poss:', start_type), 1 from rstart_v s where not (start_type = 'defensive_rebound' and exists (select 1 from rrim_v r where r.game_id = s.game_id and r.period = s.period and r.t between s.t_ms - 6000 and s.t_ms))
    union all select game_id, period, t_ms, null, 'full', 'flagrant', 2 from rcall_v where detail in ('flagrant_1', 'flagrant_2')
    union all select game_id, period, t_ms, null, 'min14', detail, 2 from rcall_v where defensive and detail in ('defensive_3_seconds', 'technical', 'delay_of_game')
    union all select game_id, period, t_ms, null, case when half = 'front' then 'min14' else 'full' end, concat('foul_', half, 'court'), 2 from rhalf_v
    union all select game_id, period, t_ms, null, 'min14', 'kicked_ball', 3 from rkick_v where team is distinct from offense"""
_VIEWS["rseq_v"] = "select *, least(coalesce(nxt, t + 60000), t + 60000) as most from (select *, lead(t) over (partition by game_id, period order by t, rank, cause, run nulls first) as nxt from rall_v)"
_VIEWS["rin_v"] = """select t.game_id, t.period, t.t_catch_ms as t_in from (select *, coalesce(t_catch_ms, t_release_ms) as t0, coalesce(t_catch_ms, t_release_ms) + 1000 as t1 from transfer_v) t asof left join index_v a on a.game_id = t.game_id and a.period = t.period and t.t0 >= a.unix_ms
    asof left join index_v b on b.game_id = t.game_id and b.period = t.period and t.t1 >= b.unix_ms where coalesce(abs(b.game_clock_cs - a.game_clock_cs) < 1, false) and t_catch_ms is not null"""
_VIEWS["rout_v"] = """select r.*, (select min(t_in) from rin_v i where i.game_id = r.game_id and i.period = r.period and i.t_in >= r.t) as t_in,
      (select min(b.unix_ms) from pball_v b where b.game_id = r.game_id and b.period = r.period and b.unix_ms > r.t and b.unix_ms <= r.most and (bx < -50 or bx > 9450 or bw < -50 or bw > 5050)) as t_out from rseq_v r"""
_RESETS = """select game_id, period, t as unix_ms, coalesce(run, case when t_in - t <= 180000 and (nxt is null or t_in < nxt) then t_in end, case when regexp_matches(cause, '^(poss:made_basket_inbound|poss:made_ft_inbound|poss:turnover|foul_|kicked_ball|defensive_3_seconds|technical|delay_of_game|flagrant)')
      then (select min(b.unix_ms) + 300 from pball_v b where b.game_id = r.game_id and b.period = r.period and b.unix_ms >= r.t_out and b.unix_ms <= r.most and bx > 100 and bx < 9300 and bw > 100 and bw < 4900) end) as t_run_ms, rule, cause from rout_v r"""


_IN_LENS = lambda sql: _over(_over(sql, "frames_v", "frim_v"), "pbp_v", "pcalls_v")


@query("p20_shot_clock_resets", _IN_LENS(_RESETS))
def _(spark, d):
    return clock_resets(spark, d)


_VIEWS["rnum_v"] = f"select game_id, period, unix_ms, coalesce(t_run_ms, unix_ms) as t_run_ms, rule, row_number() over (partition by game_id, period order by unix_ms, coalesce(t_run_ms, unix_ms), rule) as n from ({_RESETS})"
_VIEWS["rclock_v"] = """select r.*, coalesce(a.game_clock_cs, z.last) as gc, coalesce(b.game_clock_cs, z.last) as gc_run from rnum_v r asof left join index_v a on a.game_id = r.game_id and a.period = r.period and r.unix_ms <= a.unix_ms
    asof left join index_v b on b.game_id = r.game_id and b.period = r.period and r.t_run_ms <= b.unix_ms join (select game_id, period, arg_max(game_clock_cs, unix_ms) as last from index_v group by all) z on z.game_id = r.game_id and z.period = r.period"""
_VIEWS["rstate_v"] = """with recursive walk as (
      select game_id, period, cast(0 as bigint) as n, min(unix_ms) as unix_ms, cast(2400 as bigint) as value, min(unix_ms) as t_run_ms, cast(arg_min(game_clock_cs, unix_ms) as bigint) as gc_run from index_v group by game_id, period
      union all select r.game_id, r.period, r.n, r.unix_ms, case when r.rule = 'full' then 2400 else greatest(1400, least(2400, greatest(0, w.value - case when r.unix_ms >= w.t_run_ms then greatest(0, w.gc_run - r.gc) else 0 end))) end, r.t_run_ms, r.gc_run
      from walk w join rclock_v r on r.game_id = w.game_id and r.period = w.period and r.n = w.n + 1)
    select * from walk qualify row_number() over (partition by game_id, period, unix_ms order by t_run_ms desc, n desc) = 1"""
_VIEWS["rshown_v"] = """select i.game_id, i.period, i.unix_ms, i.game_clock_cs, least(2400, greatest(0, s.value - case when i.unix_ms >= s.t_run_ms then greatest(0, s.gc_run - i.game_clock_cs) else 0 end)) as v
    from index_v i asof join rstate_v s on s.game_id = i.game_id and s.period = i.period and i.unix_ms >= s.unix_ms"""


def imputed_clock(spark, d):
    return stored(spark, d, "imputed_calls", lambda: sc.imputed(index(spark, d), clock_resets(spark, d)).withColumn("shot_clock_imputed_cs", F.col("shot_clock_imputed_cs").cast("long")))


@query("p21_clock_of_resets", _IN_LENS("select game_id, period, unix_ms, least(v, game_clock_cs)::bigint as shot_clock_imputed_cs, v > game_clock_cs as imputed_off from rshown_v"))
def _(spark, d):
    return imputed_clock(spark, d)


@query("p22_shot_clock_table", _IN_LENS("""select game_id, period, unix_ms, case when fill_method in ('observed', 'off_game_clock', 'carry_forward') then shot_clock_filled_cs else least(v, r.game_clock_cs) end as shot_clock_cs,
    case when fill_method in ('observed', 'off_game_clock', 'carry_forward') then fill_method else concat('imputed:', fill_method) end as fill_method, fill_method not in ('observed', 'off_game_clock', 'carry_forward') as is_imputed from filled_v f join rshown_v r using (game_id, period, unix_ms)"""))
def _(spark, d):
    return sc.table(sc.filled(index(spark, d)), imputed_clock(spark, d))


@query("x12_shot_clock_backtest", _IN_LENS("""select game_id, count(*) as n, quantile_cont(e, 0.5)::double as median_error, round(avg((e <= 100)::int), 6) as within_1, round(avg((e <= 200)::int), 6) as within_2
    from (select game_id, abs(least(v, r.game_clock_cs) - shot_clock_filled_cs) as e from filled_v f join rshown_v r using (game_id, period, unix_ms) where fill_method = 'observed') group by game_id"""))
def _(spark, d):
    seen = sc.filled(index(spark, d)).filter("fill_method = 'observed'").join(imputed_clock(spark, d), ["game_id", "period", "unix_ms"])
    out = rp.error_summary(seen, "shot_clock_imputed_cs", "shot_clock_filled_cs", ["game_id"])
    return out.select("game_id", "n", "median_error", F.round("within_1", 6).alias("within_1"), F.round("within_2", 6).alias("within_2"))


_VIEWS["rend_v"] = """select game_id, end_pos, min(poss_seq) as poss_seq from (select l.game_id, l.poss_seq, coalesce(o.pos, (select max(p.pos) from order_v p where p.game_id = l.game_id and p.period = l.period)) as end_pos
    from ledger_v l left join order_v o on o.game_id = l.game_id and o.event_num = l.end_event_num) group by all"""


@query("p10_event_owners", _IN_LENS("""select o.game_id, o.event_num, coalesce(e.poss_seq, z.last) as poss_seq from order_v o asof left join rend_v e on e.game_id = o.game_id and o.pos <= e.end_pos
    join (select game_id, max(poss_seq) as last from ledger_v group by all) z on z.game_id = o.game_id"""))
def _(spark, d):
    return sp.event_owners(calls(spark, d), po.possessions(calls(spark, d)))


_VIEWS["rspan_v"] = """select game_id, period, t0, max(t1) as t1, arg_max(offense, t1 * 1000 + offense) as offense from (select l.game_id, l.period, l.offense_team_id as offense, a.t_ms as t0, b.t_ms as t1 from ledger_v l
    join located_v a on a.game_id = l.game_id and a.event_num = l.start_event_num join located_v b on b.game_id = l.game_id and b.event_num = l.end_event_num) group by game_id, period, t0"""


@query("l2_constrained_control", _IN_LENS("""select h.* replace (case when h.control_team_id = s.offense and h.unix_ms <= s.t1 then h.control_team_id else -1 end as control_team_id) from handler_v h
    asof left join rspan_v s on s.game_id = h.game_id and s.period = h.period and h.unix_ms >= s.t0"""))
def _(spark, d):
    ends = located(spark, d).select("game_id", F.col("event_num").cast("long").alias("end_event_num"), F.col("t_ms").alias("t_end_ms"))
    return sp.constrained_control(rim_handlers(spark, d), timed_ledger(spark, d).join(ends, ["game_id", "end_event_num"]))
