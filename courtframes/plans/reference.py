"""Registered queries of the tracking operators, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtframes.operators import frames as fr
from courtframes.operators import kernels as kn
from courtframes.plans.lenses import FRAMES, FRAMES_RAW, PBP, SERIES, spark_view, sql_view
from courtframes.sources.layers import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_VIEWS = {"frames_v": sql_view(FRAMES), "frames_raw_v": sql_view(FRAMES_RAW), "pbp_v": sql_view(PBP), "series_v": sql_view(SERIES)}
_VIEWS["dedup_v"] = """select * exclude (rn) from (select *, row_number() over (partition by game_id, period, unix_ms, team_id, player_id order by event_id, moment_idx) as rn from frames_raw_v) where rn = 1"""
_VIEWS["index_v"] = """
select *, cast(sum(case when gap or clock_jump then 1 else 0 end) over (partition by game_id order by period, unix_ms rows unbounded preceding) - 1 as bigint) as segment_id
from (select * exclude (rise), dt_ms is null or dt_ms > 60 as gap, coalesce(rise > 100, false) as clock_jump, coalesce(abs(rise) < 1, false) as clock_frozen
      from (select *, unix_ms - lag(unix_ms) over w as dt_ms, game_clock_cs - lag(game_clock_cs) over w as rise
            from (select f.*, g.game_clock_cs, s.shot_clock_cs
                  from (select game_id, period, unix_ms, count(*) as n_entities, count(*) filter (team_id <> -1) as n_players, bool_or(team_id = -1) as has_ball
                        from dedup_v group by all) f
                  left join (select game_id, period, unix_ms, game_clock_cs from (select *, row_number() over (partition by game_id, period, unix_ms order by n desc, game_clock_cs) as r
                             from (select game_id, period, unix_ms, game_clock_cs, count(*) as n from dedup_v where game_clock_cs is not null group by all)) where r = 1) g using (game_id, period, unix_ms)
                  left join (select game_id, period, unix_ms, shot_clock_cs from (select *, row_number() over (partition by game_id, period, unix_ms order by n desc, shot_clock_cs) as r
                             from (select game_id, period, unix_ms, shot_clock_cs, count(*) as n from dedup_v where shot_clock_cs is not null group by all)) where r = 1) s using (game_id, period, unix_ms))
            window w as (partition by game_id, period order by unix_ms)))"""


def with_views(sql: str) -> str:
    """The SQL below the views it names, and those that they name."""
    needed: list[str] = []

    def add(text: str) -> None:
        for name, body in _VIEWS.items():
            if name in text and name not in needed:
                add(body)
                needed.append(name)

    add(sql)
    return ("with " + ", ".join(f"{n} as materialized ({_VIEWS[n]})" for n in needed) + " " if needed else "") + sql


def query(name: str, sql: str | None = None):
    def put(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = with_views(sql)
        return f

    return put


def frames(spark, d):
    return stored(spark, d, "frames", lambda: spark_view(spark, d, FRAMES))


def raw(spark, d):
    return stored(spark, d, "raw", lambda: spark_view(spark, d, FRAMES_RAW))


def pbp(spark, d):
    return stored(spark, d, "pbp", lambda: spark_view(spark, d, PBP))


def series(spark, d):
    return spark_view(spark, d, SERIES)


def index(spark, d):
    return stored(spark, d, "frame_index", lambda: new_index(spark, d))


def new_index(spark, d):
    """The index from a table of its own, as it reads no places, which are most of what `raw` writes."""
    clocks = [*fr.ENTITY, "event_id", "moment_idx", "game_clock_cs", "shot_clock_cs"]
    return fr.frame_index(fr.dedup_entities(stored(spark, d, "raw_clocks", lambda: spark_view(spark, d, FRAMES_RAW).select(*clocks))))


# --- first layer -----------------------------------------------------------------------------


@query("l1_dedup_entities", "select * from dedup_v")
def _(spark, d):
    return fr.dedup_entities(raw(spark, d))


@query("l1_frame_index", "select * from index_v")
def _(spark, d):
    return new_index(spark, d)


@query("l1_segments", "select game_id, period, count(*) as n_frames, count(distinct segment_id) as n_segments, count(*) filter (clock_jump) as n_jumps, max(dt_ms) as max_dt_ms from index_v group by all")
def segments(spark, d):
    return index(spark, d).groupBy("game_id", "period").agg(
        F.count("*").alias("n_frames"), F.countDistinct("segment_id").alias("n_segments"), F.count_if("clock_jump").alias("n_jumps"), F.max("dt_ms").alias("max_dt_ms")
    )


@query(
    "l1_dedup_report",
    """select * from (select game_id, count(distinct (event_id, moment_idx)) as raw_moments, count(*) as raw_rows from frames_raw_v group by all)
    join (select game_id, count(*) as unique_rows from dedup_v group by all) using (game_id)
    join (select game_id, count(*) as unique_frames, count(*) filter (gap and dt_ms is not null) as n_gaps, count(*) filter (clock_jump) as n_clock_jumps,
          count(distinct segment_id) as n_segments, count(*) filter (n_players <> 10) as frames_not_10_players, count(*) filter (not has_ball) as frames_no_ball,
          count(*) filter (clock_frozen) as frames_clock_frozen, count(*) filter (shot_clock_cs is null) as shot_clock_null_frames from index_v group by all) using (game_id)""",
)
def _(spark, d):
    source = raw(spark, d)
    entities = fr.dedup_entities(source)
    return fr.dedup_report(source, entities, fr.frame_index(entities))


@query(
    "l1_validate_raw",
    """unpivot (select * from (select game_id, count(*) filter (n > 1) as duplicate_entities, count(*) filter (kinds > 1) as conflicting_entities
        from (select game_id, count(*) as n, count(distinct (x_cft, y_cft, z_cft)) as kinds from frames_raw_v group by game_id, period, unix_ms, team_id, player_id) group by game_id)
      join (select game_id, count(*) filter (x_cft < 0 or x_cft > 9400 or y_cft < 0 or y_cft > 5000) as out_of_bounds, count(*) filter (shot_clock_cs is null) as null_shot_clock,
        count(*) filter (team_id = -1 and player_id <> -1) as ball_with_player from frames_raw_v group by game_id) using (game_id))
    on duplicate_entities, conflicting_entities, out_of_bounds, null_shot_clock, ball_with_player into name "check" value n_rows""",
)
def _(spark, d):
    return fr.validate_raw(raw(spark, d))


_VIEWS["shotpos_v"] = """select s.game_id, s.period, s.event_num, s.p1_team_id, median(x_cft) as ball_x_cft, median(y_cft) as ball_y_cft, count(*) as n_frames
    from pbp_v s join frames_v b on b.game_id = s.game_id and b.period = s.period and b.team_id = -1 and abs(b.game_clock_cs - s.pctime_sec * 100) <= 100
    where s.msg_type in (1, 2) and s.p1_team_id is not null group by all"""


@query("l1_shot_positions", "select * from shotpos_v")
def _(spark, d):
    return fr.shot_positions(frames(spark, d), pbp(spark, d))


_VIEWS["direction_v"] = """
    select t.game_id, t.team_id, p.period, t.first_left = (p.period <= 2) as attacks_left, coalesce(n_shots, 0) as n_shots, coalesce(n_left, 0) as n_left
    from (select game_id, team_id, case when 2 * votes = total then team_id = top else 2 * votes > total end as first_left
          from (select *, sum(votes) over (partition by game_id) as total, max(team_id) over (partition by game_id) as top
                from (select game_id, p1_team_id as team_id, sum(case when (ball_x_cft < 4700) = (period <= 2) then 1 else -1 end) as votes from shotpos_v group by all))) t
    join (select distinct game_id, period from frames_v) p on p.game_id = t.game_id
    left join (select game_id, p1_team_id as team_id, period, count(*) as n_shots, count(*) filter (ball_x_cft < 4700) as n_left from shotpos_v group by all) s
      on s.game_id = t.game_id and s.team_id = t.team_id and s.period = p.period"""


@query("l1_attack_direction", "select * from direction_v")
def direction(spark, d):
    return fr.attack_direction(frames(spark, d), pbp(spark, d))


#: Points of 100 less those of 200 so far, at scoring rows; the lens has no margin of its own.
_MARGIN = """sum(case when p1_team_id = 100 then 1 else -1 end * case when msg_type = 1 then case when description like '%3PT%' then 3 else 2 end when msg_type = 3 and description not like 'MISS%' then 1 else 0 end)
      over (partition by game_id order by event_num rows unbounded preceding)"""
_SCORES = "case when msg_type = 1 or (msg_type = 3 and description not like 'MISS%') then margin end as score_margin"


@query(
    "l1_terminal_events",
    f"""select game_id, event_num, period, pctime_sec, msg_type, cast(coalesce(last_value(score_margin ignore nulls) over (partition by game_id order by event_num rows between unbounded preceding and 1 preceding), 0) as bigint) as margin_before
    from (select *, {_SCORES} from (select *, {_MARGIN} as margin from pbp_v)) qualify msg_type in (1, 2, 5, 6, 7, 9, 13)""",
)
def _(spark, d):
    scored = pbp(spark, d).selectExpr("*", f"{_MARGIN} as margin").selectExpr("*", _SCORES)
    return fr.terminal_events(scored)


@query(
    "l1_locate_clock",
    """select game_id, period, event_num, clock_cs, unix_ms from (select r.*, i.unix_ms, row_number() over (partition by r.game_id, r.event_num
      order by not (game_clock_cs >= clock_cs and game_clock_cs < clock_cs + 100), segment_id, abs(2 * (game_clock_cs - clock_cs) - 100), unix_ms) as rn
      from (select game_id, period, event_num, pctime_sec * 100 as clock_cs from pbp_v) r join index_v i on i.game_id = r.game_id and i.period = r.period and abs(game_clock_cs - clock_cs) <= 100) where rn = 1""",
)
def _(spark, d):
    readings = pbp(spark, d).select("game_id", "period", "event_num", (F.col("pctime_sec") * 100).alias("clock_cs"))
    return fr.locate_clock(index(spark, d), readings)


@query(
    "l1_video_time",
    """select f.game_id, f.unix_ms, case when f.unix_ms <= a.valid_until_ms then a.video_ms + f.unix_ms - a.unix_ms end as video_ms from (select game_id, unix_ms from index_v) f
    asof left join (select game_id, unix_ms, (unix_ms - 1447287043000) * 2 as video_ms, unix_ms + 20000 as valid_until_ms from index_v where unix_ms % 1001 < 7) a on a.game_id = f.game_id and f.unix_ms >= a.unix_ms""",
)
def _(spark, d):
    own = index(spark, d).select("game_id", "unix_ms")
    anchors = own.filter("unix_ms % 1001 < 7").select("game_id", "unix_ms", ((F.col("unix_ms") - 1447287043000) * 2).alias("video_ms"), (F.col("unix_ms") + 20000).alias("valid_until_ms"))
    return fr.locate_video(own, anchors)


# --- kernels ---------------------------------------------------------------------------------

_VIEWS["runs_v"] = """select key, run_id, min(code) as code, min(t_ms) as t_start, max(t_ms) as t_end, count(*) as n from
    (select *, cast(sum(case when pc is null or pc <> code then 1 else 0 end) over (partition by key order by t_ms rows unbounded preceding) as bigint) as run_id
     from (select *, lag(code) over (partition by key order by t_ms) as pc from series_v)) group by key, run_id"""


@query("f3_runs", "select * from runs_v")
def series_runs(spark, d):
    return kn.runs(series(spark, d), ["key"], "t_ms", ["code"])


@query("f2_segments", "select key, k, cast(sum(case when dt is null or dt > 100 then 1 else 0 end) over (partition by key order by t_ms rows unbounded preceding) - 1 as bigint) as segment_id from (select *, t_ms - lag(t_ms) over (partition by key order by t_ms) as dt from series_v)")
def _(spark, d):
    s = series(spark, d)
    dt = F.col("t_ms") - F.lag("t_ms").over(kn.over(["key"], ["t_ms"]))
    s = s.withColumn("dt", dt)
    return kn.segment(s, ["key"], ["t_ms"], F.col("dt").isNull() | (F.col("dt") > 100)).select("key", "k", "segment_id")


@query("f1_lag_lead", "select key, k, v - lag(v) over w as delta, lead(v) over w as next_v from series_v window w as (partition by key order by t_ms)")
def _(spark, d):
    w = kn.over(["key"], ["t_ms"])
    return series(spark, d).select("key", "k", (F.col("v") - F.lag("v").over(w)).alias("delta"), F.lead("v").over(w).alias("next_v"))


@query("f4_forward_fill", "select key, k, last_value(case when v % 3 = 0 then v end ignore nulls) over (partition by key order by t_ms rows unbounded preceding) as filled from series_v")
def _(spark, d):
    w = kn.over(["key"], ["t_ms"]).rowsBetween(Window.unboundedPreceding, 0)
    return series(spark, d).select("key", "k", F.last(F.when(F.col("v") % 3 == 0, F.col("v")), ignorenulls=True).over(w).alias("filled"))


@query("f5_smooth", "select key, k, case when v % 3 <> 0 and count(w3) over w >= 3 then round(avg(w3) over w, 6) end as s from (select *, case when v % 3 <> 0 then v end as w3 from series_v) window w as (partition by key order by t_ms rows between 2 preceding and 2 following)")
def _(spark, d):
    s = series(spark, d).withColumn("w3", F.when(F.col("v") % 3 != 0, F.col("v")))
    return kn.smooth(s, ["key"], ["t_ms"], "w3", 5, 3, keep_null=True, name="s").select("key", "k", F.round("s", 6).alias("s"))


@query("f6_speed", """select key, k, case when t2 - t_ms <= 60 and t_ms - t0 <= 60 then round(sqrt((v2 - v0) * (v2 - v0) + (k2 - k0) * (k2 - k0)) / ((t2 - t0) / 1000.0), 6) end as speed from
    (select *, lead(t_ms) over w as t2, lag(t_ms) over w as t0, lead(v) over w as v2, lag(v) over w as v0, lead(k) over w as k2, lag(k) over w as k0 from series_v window w as (partition by key order by t_ms))""")
def _(spark, d):
    return kn.central_speed(series(spark, d), ["key"], "t_ms", "v", "k", 60).select("key", "k", F.round("speed", 6).alias("speed"))


_VIEWS["codes_v"] = "select key, k, t_ms, case when v % 5 < 2 then -1 else 1 + cast(floor(k / 7) as bigint) % 3 end as code from series_v"
_VIEWS["coderuns_v"] = """select key, run_id, min(code) as code, min(t_ms) as t_start, max(t_ms) as t_end, count(*) as n from
    (select *, cast(sum(case when pc is null or pc <> code then 1 else 0 end) over (partition by key order by t_ms rows unbounded preceding) as bigint) as run_id
     from (select *, lag(code) over (partition by key order by t_ms) as pc from codes_v)) group by key, run_id"""


def code_runs(spark, d):
    s = series(spark, d).select("key", "k", "t_ms", F.when(F.col("v") % 5 < 2, -1).otherwise(1 + F.floor(F.col("k") / 7) % 3).cast("long").alias("code"))
    return kn.runs(s, ["key"], "t_ms", ["code"])


@query("f7_sticky", """select key, run_id, coalesce(last_value(case when n >= 3 or (code <> -1 and nc = -1 and nn >= 3) then code end ignore nulls) over (partition by key order by run_id rows unbounded preceding), -1) as state
    from (select *, lead(code) over (partition by key order by run_id) as nc, lead(n) over (partition by key order by run_id) as nn from coderuns_v)""")
def _(spark, d):
    return kn.sticky(code_runs(spark, d), ["key"], "code", 3).select("key", "run_id", "state")


@query("f8_hysteresis", """
    select key, r.run_id, r.state as control from (
      with recursive walk as (
        select key, run_id, n, code, case when code <> -1 and n >= 2 then code else -1 end as state from coderuns_v where run_id = 1
        union all
        select c.key, c.run_id, c.n, c.code,
               case when c.code = -1 or c.code = w.state then w.state
                    when c.n >= 4 or (w.code = -1 and w.n >= 2) or (w.state = -1 and c.n >= 2) then c.code else w.state end
        from walk w join coderuns_v c on c.key = w.key and c.run_id = w.run_id + 1)
      select * from walk) r""")
def _(spark, d):
    return kn.hysteresis(code_runs(spark, d), ["key"], "code", 2, 4).select("key", "run_id", "control")


@query("f9_merge_runs", """
    select * from (with recursive walk as (
      select key, run_id, cast(1 as bigint) as merged_id, code from coderuns_v where run_id = 1
      union all
      select c.key, c.run_id, cast(w.merged_id + case when c.t_end - c.t_start < 120 or w.code = c.code then 0 else 1 end as bigint),
             case when c.t_end - c.t_start < 120 or w.code = c.code then w.code else c.code end
      from walk w join coderuns_v c on c.key = w.key and c.run_id = w.run_id + 1)
    select w.key, merged_id, min(w.code) as code, min(t_start) as t_start, max(t_end) as t_end, cast(sum(n) as bigint) as n from walk w join coderuns_v c on c.key = w.key and c.run_id = w.run_id group by w.key, merged_id)""")
def _(spark, d):
    return kn.merge_runs(code_runs(spark, d), ["key"], "code", 120)


_VIEWS["marks_v"] = "select key, t_ms, k as mark from series_v where v % 4 = 0"
_VIEWS["asks_v"] = "select key, t_ms, k from series_v where v % 4 = 1"


def marks(spark, d):
    s = series(spark, d)
    return s.filter("v % 4 = 1").select("key", "t_ms", "k"), s.filter("v % 4 = 0").select("key", "t_ms", F.col("k").alias("mark"))


@query("c11_asof_backward", "select a.key, a.t_ms, a.k, m.t_ms as match_t_ms, m.mark from asks_v a asof left join marks_v m on a.key = m.key and a.t_ms >= m.t_ms")
def _(spark, d):
    return kn.asof(*marks(spark, d), ["key"], "t_ms", ["mark"])


@query("c12_asof_forward", "select a.key, a.t_ms, a.k, m.t_ms as match_t_ms, m.mark from asks_v a asof left join marks_v m on a.key = m.key and a.t_ms <= m.t_ms")
def _(spark, d):
    return kn.asof(*marks(spark, d), ["key"], "t_ms", ["mark"], forward=True)


@query("c13_asof_tolerance", "select a.key, a.t_ms, a.k, case when a.t_ms - m.t_ms <= 90 then m.t_ms end as match_t_ms, case when a.t_ms - m.t_ms <= 90 then m.mark end as mark from asks_v a asof left join marks_v m on a.key = m.key and a.t_ms >= m.t_ms")
def _(spark, d):
    return kn.asof(*marks(spark, d), ["key"], "t_ms", ["mark"], tolerance=90)


@query("c15_nearest", """select a.key, a.t_ms, a.k, m.t_ms as match_t_ms, m.mark from asks_v a left join
    (select a.key, a.k, m.t_ms, m.mark, row_number() over (partition by a.key, a.k order by abs(m.t_ms - a.t_ms), m.t_ms) as rn from asks_v a join marks_v m on a.key = m.key) m on m.key = a.key and m.k = a.k and m.rn = 1""")
def _(spark, d):
    return kn.nearest(*marks(spark, d), ["key"], "t_ms", ["mark"])


_VIEWS["spans_v"] = "select key, k as span, t_ms as lo, t_ms + 150 + v % 200 as hi from series_v where k % 6 = 0"


def spans(spark, d, mod=6, name="span", lo="lo", hi="hi"):
    return series(spark, d).filter(F.col("k") % mod == 0).select("key", F.col("k").alias(name), F.col("t_ms").alias(lo), (F.col("t_ms") + 150 + F.col("v") % 200).alias(hi))


@query("c8_point_in_interval", "select a.key, a.t_ms, a.k, s.span, s.lo, s.hi from asks_v a join spans_v s on a.key = s.key and a.t_ms between s.lo and s.hi")
def _(spark, d):
    return kn.range_join(marks(spark, d)[0], spans(spark, d), ["key"], "t_ms", "lo", "hi", 400)


@query("c7_band_join", "select a.key, a.k, m.mark, m.t_ms - a.t_ms as apart from asks_v a join marks_v m on a.key = m.key and abs(m.t_ms - a.t_ms) <= 120")
def _(spark, d):
    a, m = marks(spark, d)
    wide = a.select("key", "k", F.col("t_ms").alias("at"), (F.col("t_ms") - 120).alias("lo"), (F.col("t_ms") + 120).alias("hi"))
    return kn.range_join(m, wide, ["key"], "t_ms", "lo", "hi", 400).select("key", "k", "mark", (F.col("t_ms") - F.col("at")).alias("apart"))


_VIEWS["others_v"] = "select key, k as other, t_ms as b_lo, t_ms + 150 + v % 200 as b_hi from series_v where k % 5 = 0"
_VIEWS["overlap_v"] = "select a.*, b.other, b.b_lo, b.b_hi, greatest(lo, b_lo) as o_lo, least(hi, b_hi) as o_hi from spans_v a join others_v b on a.key = b.key and a.lo < b.b_hi and a.hi > b.b_lo"


@query("c9_interval_overlap", "select * from overlap_v")
def _(spark, d):
    return kn.overlaps(spans(spark, d), spans(spark, d, 5, "other", "b_lo", "b_hi"), ["key"], 400, ("lo", "hi"), ("b_lo", "b_hi"))


@query("c10_longest_overlap", "select key, span, lo, hi, other, b_lo, b_hi, o_lo, o_hi from (select *, row_number() over (partition by key, span order by o_hi - o_lo desc, other) as rn from overlap_v) where rn = 1")
def _(spark, d):
    return kn.longest_overlap(spans(spark, d), spans(spark, d, 5, "other", "b_lo", "b_hi"), ["key"], ["span"], "other", 400, ("lo", "hi"), ("b_lo", "b_hi"))


@query("c18_ordinal_pairs", "select a.key, a.nth, a.k, m.mark from (select key, k, row_number() over (partition by key order by t_ms) as nth from asks_v) a join (select key, mark, row_number() over (partition by key order by t_ms) as nth from marks_v) m using (key, nth)")
def _(spark, d):
    a, m = marks(spark, d)
    return kn.ordinal_pairs(a, m, ["key"], ["t_ms"], ["t_ms"]).select("key", F.col("nth").cast("long").alias("nth"), "k", "mark")


@query("f10_first_hold", """select a.key, a.k, a.t_ms, min(greatest(t_start, a.t_ms)) as t_hold from asks_v a join runs_v r on a.key = r.key and r.n >= 2 and r.t_end >= a.t_ms and r.t_end - greatest(r.t_start, a.t_ms) >= 40 group by all""")
def _(spark, d):
    return kn.first_hold(marks(spark, d)[0], series_runs(spark, d), ["key"], "t_ms", 2, 40)


@query("f11_longest_run", "select key, max(n) as longest from runs_v where code = 'click' group by key")
def _(spark, d):
    return series_runs(spark, d).filter("code = 'click'").groupBy("key").agg(F.max("n").alias("longest"))


@query("f12_last_crossing", """select key, min(case when t_ms > lf then t_ms end) as t_cross from (select *, max(case when not (v % 10 < 7) then t_ms end) over (partition by key) as lf from series_v) group by key""")
def _(spark, d):
    return kn.last_crossing(series(spark, d).withColumn("flag", F.col("v") % 10 < 7), ["key"], "t_ms", "flag")


@query("f14_minima", """select key, k, prominence from (select *, least(max(v) over (partition by key order by t_ms rows between 4 preceding and 1 preceding), max(v) over (partition by key order by t_ms rows between 1 following and 4 following)) - v as prominence,
    v <= lag(v) over (partition by key order by t_ms) and v <= lead(v) over (partition by key order by t_ms) as low from series_v) where low and prominence >= 20""")
def _(spark, d):
    return kn.minima(series(spark, d), ["key"], ["t_ms"], "v", 4, 20).select("key", "k", "prominence")


@query("f15_anchored_groups", """select s.key, s.k, w.g as group_start from (with recursive walk as (
      select key, k, t_ms, t_ms as g from series_v where k = 1
      union all select s.key, s.k, s.t_ms, case when s.t_ms - w.g > 300 then s.t_ms else w.g end from walk w join series_v s on s.key = w.key and s.k = w.k + 1) select * from walk) w join series_v s on s.key = w.key and s.k = w.k""")
def _(spark, d):
    return kn.anchored_groups(series(spark, d).select("key", "k", "t_ms"), ["key"], "t_ms", 300).select("key", "k", "group_start")


@query("f14_thin", """select key, k from (with recursive walk as (
      select key, k, t_ms, t_ms as g, true as kept from series_v where k = 1
      union all select s.key, s.k, s.t_ms, case when s.t_ms - w.g >= 200 then s.t_ms else w.g end, s.t_ms - w.g >= 200 from walk w join series_v s on s.key = w.key and s.k = w.k + 1) select * from walk) where kept""")
def _(spark, d):
    return kn.thin(series(spark, d), ["key"], "t_ms", 200).select("key", "k")


@query("f17_resample", """select g.key, g.span, g.t_ms, round(coalesce(case when a.t_ms > b.t_ms then b.v + (g.t_ms - b.t_ms) / cast(a.t_ms - b.t_ms as double) * (a.v - b.v) else b.v end, a.v), 6) as v
    from (select key, span, unnest(range(lo, lo + 321, 80)) as t_ms from spans_v) g
    asof left join series_v b on b.key = g.key and g.t_ms >= b.t_ms asof left join series_v a on a.key = g.key and g.t_ms <= a.t_ms""")
def _(spark, d):
    s = series(spark, d).select("key", "t_ms", F.col("v").cast("double").alias("v"))
    windows = spans(spark, d).select("key", "span", F.col("lo").alias("t_start"), (F.col("lo") + 320).alias("t_end"))
    out = kn.resample(s, windows, ["key"], "span", "t_ms", ["v"], 80)
    return out.withColumn("v", F.round(F.when(F.col("v").isNull(), None).otherwise(F.col("v")), 6))


@query("f20_suffix_copies", "select event_id, case when n > 1 then concat(uid, ':', r) else uid end as uid from (select event_id, uid, count(*) over (partition by uid) as n, row_number() over (partition by uid order by event_id) - 1 as r from (select event_id, concat(key, '-', v) as uid from series_v))")
def _(spark, d):
    s = series(spark, d).select("event_id", F.concat_ws("-", "key", "v").alias("uid"))
    return kn.suffix_copies(s, "uid", ["event_id"])


@query("e6_first_by_order", "select key, code, k, t_ms from (select *, row_number() over (partition by key, code order by t_ms, k) as rn from series_v) where rn = 1")
def _(spark, d):
    s = series(spark, d)
    return s.groupBy("key", "code").agg(F.min_by(F.struct("k", "t_ms"), F.struct("t_ms", "k")).alias("r")).select("key", "code", "r.*")


@query("e_aggregates", """select code, count(*) as n, cast(sum(v) as bigint) as total, round(avg(v), 6) as mean, min(v) as low, max(v) as high, count(*) filter (v % 2 = 0) as n_even, count(distinct key) as keys,
    round(quantile_cont(v, 0.05), 6) as q05, round(median(v), 6) as q50, round(quantile_cont(v, 0.95), 6) as q95, array_to_string(list_sort(list(distinct v % 5)), ',') as rests from series_v group by code""")
def _(spark, d):
    q = lambda p: F.round(F.percentile("v", F.lit(p)), 6)
    return series(spark, d).groupBy("code").agg(
        F.count("*").alias("n"), F.sum("v").alias("total"), F.round(F.avg("v"), 6).alias("mean"), F.min("v").alias("low"), F.max("v").alias("high"), F.count_if(F.col("v") % 2 == 0).alias("n_even"),
        F.countDistinct("key").alias("keys"), q(0.05).alias("q05"), q(0.5).alias("q50"), q(0.95).alias("q95"), F.array_join(F.array_sort(F.collect_set(F.col("v") % 5)), ",").alias("rests"),
    )


@query("e4_mode", "select key, v5 as mode from (select key, v % 5 as v5, row_number() over (partition by key order by count(*) desc, v % 5) as rn from series_v group by key, v % 5) where rn = 1")
def _(spark, d):
    return series(spark, d).groupBy("key").agg(F.mode(F.col("v") % 5, True).alias("mode"))


@query("h4_key_difference", "select coalesce(a.key, b.key) as key, coalesce(a.k, b.k) as k, case when a.key is null then 'added' when b.key is null then 'dropped' when a.v is not distinct from b.v then 'kept' else 'moved' end as change from (select key, k, v from series_v where k % 3 <> 0) a full join (select key, k, v + case when k % 7 = 0 then 1 else 0 end as v from series_v where k % 4 <> 0) b on a.key = b.key and a.k = b.k")
def _(spark, d):
    s = series(spark, d)
    b = s.filter("k % 4 <> 0").withColumn("v", F.col("v") + F.when(F.col("k") % 7 == 0, 1).otherwise(0))
    return kn.key_difference(s.filter("k % 3 <> 0"), b, ["key", "k"], "v")


@query("h5_column_parity", """unpivot (select count(*) filter (a.v is distinct from b.v) as v, count(*) filter (a.code is distinct from b.code) as code from series_v a join (select key, k, v + case when k % 7 = 0 then 1 else 0 end as v, case when k % 9 = 0 then null else code end as code from series_v) b on a.key = b.key and a.k = b.k) on v, code into name "column" value n_different""")
def _(spark, d):
    s = series(spark, d).select("key", "k", "v", "code")
    b = s.select("key", "k", (F.col("v") + F.when(F.col("k") % 7 == 0, 1).otherwise(0)).alias("v"), F.when(F.col("k") % 9 != 0, F.col("code")).alias("code"))
    return kn.column_parity(s, b, ["key", "k"])


@query("a14_content_hash")
def _(spark, d):
    return kn.content_hash(series(spark, d))
