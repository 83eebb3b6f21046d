"""Registered queries of half-court windows, over the log of a slow game and the frames whose ball reaches the rim."""

from __future__ import annotations

from pyspark.sql import functions as F

from courtframes.operators import frames as fr
from courtframes.operators import possessions as po
from courtframes.operators import shots as sh
from courtframes.operators import windows as wd
from courtframes.plans.lenses import FRAMES_RIM, PBP_SLOW, spark_view, sql_view
from courtframes.plans.reference import _MARGIN, _SCORES, _VIEWS, index, query
from courtframes.plans.reference_alignment import _over, rim_frames, rim_handlers
from courtframes.sources.layers import stored

_VIEWS["pslow_v"] = sql_view(PBP_SLOW)
_VIEWS["frim_v"] = sql_view(FRAMES_RIM)
_IN_LENS = lambda sql: _over(_over(sql, "frames_v", "frim_v"), "pbp_v", "pslow_v")


def calls(spark, d):
    return stored(spark, d, "pbp_slow", lambda: spark_view(spark, d, PBP_SLOW))


def sides(spark, d):
    return stored(spark, d, "direction_slow", lambda: fr.attack_direction(rim_frames(spark, d), calls(spark, d)))


def ledger(spark, d):
    """Possessions of the slow game between the moments of their rows."""
    rows = calls(spark, d).select("game_id", "period", "event_num", (F.col("pctime_sec") * 100).alias("clock_cs"))
    at = fr.locate_clock(index(spark, d), rows)
    when = lambda e, t: at.select("game_id", F.col("event_num").cast("long").alias(e), F.col("unix_ms").alias(t))
    build = lambda: po.possessions(calls(spark, d)).join(when("start_event_num", "t_start_ms"), ["game_id", "start_event_num"]).join(when("end_event_num", "t_end_ms"), ["game_id", "end_event_num"])
    return stored(spark, d, "ledger_slow", build)


def searched(spark, d):
    return stored(spark, d, "searched_rim", lambda: sh.searched(rim_frames(spark, d), index(spark, d)))


def times(spark, d, name="own", **rule):
    asked = (lambda: searched(spark, d)) if rule.get("refine", True) else (lambda: None)
    return stored(spark, d, f"terminals_{name}", lambda: sh.terminal_times(rim_frames(spark, d), index(spark, d), calls(spark, d), sides(spark, d), asked=asked(), **rule))


def windows(spark, d, name="own", **rule):
    return stored(spark, d, f"windows_{name}", lambda: wd.half_court_windows(times(spark, d, name, **rule), rim_frames(spark, d), index(spark, d), sides(spark, d)))


def clock_windows(spark, d):
    return windows(spark, d, "clock", refine=False)


_VIEWS["wplace_v"] = """select r.game_id, r.event_num, list(i.unix_ms order by not (game_clock_cs >= clock_cs and game_clock_cs < clock_cs + 100), segment_id, abs(2 * (game_clock_cs - clock_cs) - 100), unix_ms) as places
    from (select game_id, period, event_num, pctime_sec * 100 as clock_cs from pbp_v where msg_type in (1, 2, 5, 6, 7, 9, 13)) r join index_v i on i.game_id = r.game_id and i.period = r.period and abs(game_clock_cs - clock_cs) <= 100 group by all"""
_VIEWS["wend_v"] = """select p.game_id, p.period, p.event_num, p.msg_type, p.p1_team_id as team_id, w.places, row_number() over (partition by p.game_id, p.period order by p.event_num) as n
    from pbp_v p left join wplace_v w on w.game_id = p.game_id and w.event_num = p.event_num where p.msg_type in (1, 2, 5, 6, 7, 9, 13)"""
_VIEWS["wtime_v"] = """with recursive walk as (
      select *, places[1] as t, coalesce(places[1], -1) as prev from wend_v where n = 1
      union all select x.*, list_filter(x.places, lambda p: p > w.prev)[1] as t, coalesce(list_filter(x.places, lambda p: p > w.prev)[1], w.prev) as prev from walk w join wend_v x on x.game_id = w.game_id and x.period = w.period and x.n = w.n + 1)
    select * exclude (places, prev) from walk"""
_VIEWS["wfrom_v"] = """select w.*, t + 500 as t_end, last_value(case when t is not null then event_num end ignore nulls) over o as prev_event_num, coalesce(last_value(t ignore nulls) over o, t0) as since,
      msg_type in (1, 2, 5) and team_id is not null as named from wtime_v w left join (select game_id, period, min(unix_ms) as t0 from index_v group by all) f on f.game_id = w.game_id and f.period = w.period
    window o as (partition by w.game_id, w.period order by event_num rows between unbounded preceding and 1 preceding)"""
_VIEWS["wmid_v"] = """select w.game_id, w.event_num, median(bx) as bx from wfrom_v w join pball_v b on b.game_id = w.game_id and b.period = w.period and b.unix_ms between w.t - 500 and w.t + 500 where not named group by all"""
_VIEWS["wside_v"] = """select w.*, m.bx as mid, case when w.named or o.team_id is not null or d.attacks_left then d.attacks_left end as attacks_left, case when w.named then w.team_id when o.team_id is not null or d.attacks_left then d.team_id end as offense, o.team_id as defense from wfrom_v w left join wmid_v m on m.game_id = w.game_id and m.event_num = w.event_num
    left join direction_v d on d.game_id = w.game_id and d.period = w.period and case when named then d.team_id = w.team_id else abs(m.bx - 4700) >= 300 and d.attacks_left = (m.bx < 4700) end
    left join direction_v o on o.game_id = d.game_id and o.period = d.period and o.team_id <> d.team_id"""
_VIEWS["wball_v"] = """select w.game_id, w.event_num, arg_max(front, unix_ms) as ends_front, max(unix_ms) filter (not front) as back
    from (select w.game_id, w.event_num, b.unix_ms, case when attacks_left then bx < 4700 else bx > 4700 end as front from wside_v w join pball_v b on b.game_id = w.game_id and b.period = w.period and b.unix_ms > w.since and b.unix_ms <= w.t_end where defense is not null) w group by all"""
_VIEWS["wcross_v"] = """select w.*, b.ends_front, b.back, case when ends_front then (select min(unix_ms) from pball_v n where n.game_id = w.game_id and n.period = w.period and n.unix_ms > b.back) end as t_cross
    from wside_v w left join wball_v b on b.game_id = w.game_id and b.event_num = w.event_num"""
_VIEWS["wspan_v"] = "select *, case when t_end - t_cross >= 1000 then greatest(t_cross, t_end - 24000) end as t_start from wcross_v"
_VIEWS["wframe_v"] = """select w.game_id, w.event_num, count(*) as n_frames, count(distinct segment_id) as n_segments, arg_min(i.game_clock_cs, unix_ms) as clock_0, arg_max(i.game_clock_cs, unix_ms) as clock_1, arg_min_null(i.shot_clock_cs, unix_ms) as shot_0
    from wspan_v w join index_v i on i.game_id = w.game_id and i.period = w.period and i.unix_ms between w.t_start and w.t_end group by all"""
_VIEWS["wwho_v"] = """select game_id, event_num, count(*) as n_people, list(player_id order by player_id) filter (own and 100 * n >= 95 * n_frames) as ours, list(player_id order by player_id) filter (not own and 100 * n >= 95 * n_frames) as theirs
    from (select w.game_id, w.event_num, f.team_id, f.player_id, f.team_id = w.offense as own, n_frames, count(*) as n from wspan_v w join wframe_v c on c.game_id = w.game_id and c.event_num = w.event_num
      join frames_v f on f.game_id = w.game_id and f.period = w.period and f.unix_ms between w.t_start and w.t_end and f.team_id <> -1 group by all) group by all"""
_VIEWS["wout_v"] = """select w.*, kind, n_frames, clock_0, clock_1, shot_0, ours, theirs, case when t is null then concat('terminal_not_located:', kind) when not named and (mid is null or abs(mid - 4700) < 300) then 'offense_ambiguous' when offense is null then 'direction_missing' when defense is null then 'offense_unknown_team' when ends_front is null then 'no_ball_frames'
      when t_cross is null then concat('no_crossing:', case when t_end - since < 1500 then 'short_window:' when ends_front and back is null then 'always_frontcourt:' else 'ends_backcourt:' end, kind)
      when t_start is null then 'frontcourt_too_short' when n_frames < 2 or n_segments <> 1 then 'gap_in_window' when n_people > 10 then 'lineup_change' when n_people < 10 or len(ours) <> 5 or len(theirs) <> 5 then 'missing_players' else 'accepted' end as outcome
    from (select *, case msg_type when 1 then 'fg_made' when 2 then 'fg_missed' when 5 then 'turnover' when 6 then 'foul' when 7 then 'violation' when 9 then 'timeout' else 'period_end' end as kind from wspan_v) w
    left join wframe_v f on f.game_id = w.game_id and f.event_num = w.event_num left join wwho_v p on p.game_id = w.game_id and p.event_num = w.event_num"""
_WINDOWS = """select game_id, period, event_num, kind as terminal_type, outcome, prev_event_num, case when defense is not null and t is not null then since end as w_start_ms, t as t_pbp_ms, t as t_terminal_ms, case when msg_type in (1, 2) then 'pbp' end as method,
    null::bigint as shooter_inferred_id, offense as offense_team_id, defense as defense_team_id, attacks_left, t_cross as t_cross_ms, t_start as t_start_ms, t_end as t_end_ms, case when t_start is not null then t_end - t_cross > 24000 end as cropped,
    case when outcome = 'accepted' then t_end - t_cross < 4000 end as is_transition, case when outcome = 'accepted' then n_frames end as n_frames, case when outcome = 'accepted' then clock_0 end as game_clock_start_cs,
    case when outcome = 'accepted' then clock_1 end as game_clock_end_cs, case when outcome = 'accepted' then shot_0 end as shot_clock_start_cs, case when outcome = 'accepted' then ours end as offense_ids, case when outcome = 'accepted' then theirs end as defense_ids from wout_v"""


def _flat(table):
    """Lists as text, which both engines write alike."""
    return table.withColumns({c: F.concat_ws(",", F.col(c).cast("array<string>")) for c in ("offense_ids", "defense_ids")})


_FLAT = f"select * replace (coalesce(array_to_string(offense_ids, ','), '') as offense_ids, coalesce(array_to_string(defense_ids, ','), '') as defense_ids) from ({_WINDOWS})"


@query("p17_clock_windows", _IN_LENS(_FLAT))
def _(spark, d):
    """Windows that end at the clock's moment of their row."""
    return _flat(clock_windows(spark, d))


@query("p17_reject_counts", _IN_LENS("select game_id, outcome, count(*) as n from wout_v group by all"))
def _(spark, d):
    return wd.reject_counts(clock_windows(spark, d))


@query("p17_window_margins", _IN_LENS(f"""select w.game_id, w.event_num, w.offense as offense_team_id, case when w.offense = 100 then m.margin_before else -m.margin_before end as score_margin_offense from wout_v w join (
      select game_id, event_num, cast(coalesce(last_value(score_margin ignore nulls) over (partition by game_id order by event_num rows between unbounded preceding and 1 preceding), 0) as bigint) as margin_before
      from (select *, {_SCORES} from (select *, {_MARGIN} as margin from pbp_v))) m on m.game_id = w.game_id and m.event_num = w.event_num where outcome = 'accepted'"""))
def _(spark, d):
    """The lead of the attacking team before the row that ends a window; team 100 is at home."""
    scored = calls(spark, d).selectExpr("*", f"{_MARGIN} as margin").selectExpr("*", _SCORES)
    homes = calls(spark, d).select("game_id").distinct().withColumn("home_team_id", F.lit(100).cast("long"))
    kept = clock_windows(spark, d).filter("outcome = 'accepted'")
    return wd.window_margin(kept, fr.terminal_events(scored), homes).select("game_id", "event_num", "offense_team_id", "score_margin_offense")


@query("p17_half_court_windows")
def _(spark, d):
    """Windows that end at the release of their attempt, with the possession they overlap most."""
    return wd.window_keys(windows(spark, d), ledger(spark, d))


@query("p17_second_chances")
def _(spark, d):
    """Windows with those that begin at an offensive rebound."""
    shots = times(spark, d).filter("msg_type = 2").withColumnRenamed("t_terminal_ms", "t_release_ms").join(sides(spark, d).select("game_id", "period", "team_id", "attacks_left"), ["game_id", "period", "team_id"])
    after = sh.after_release(shots, rim_frames(spark, d), rim_handlers(spark, d)).filter("control_team_id = team_id").select("game_id", "period", "t_control_ms")
    return wd.half_court_windows(times(spark, d), rim_frames(spark, d), index(spark, d), sides(spark, d), after)


@query("p18_window_changes")
def _(spark, d):
    """What changes where an attempt ends with the shooter's own hand alone."""
    return wd.window_changes(windows(spark, d), windows(spark, d, "shooter", shooter_only=True))


@query("p18_change_report")
def _(spark, d):
    return wd.change_report(wd.window_changes(windows(spark, d), windows(spark, d, "shooter", shooter_only=True)))
