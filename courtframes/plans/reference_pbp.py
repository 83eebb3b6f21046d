"""Registered queries of the play-by-play side, the shot clock, court geometry and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from courtframes.functions import court, rules
from courtframes.functions.text import clock_seconds, free_throw, padded_id, person_name
from courtframes.operators import kernels as kn
from courtframes.operators import playbyplay as pb
from courtframes.operators import possessions as ps
from courtframes.operators import reports as rp
from courtframes.operators import shot_clock as sc
from courtframes.plans.reference import _VIEWS, frames, index, pbp, query, series

_VIEWS["order_v"] = """select *, row_number() over (partition by game_id order by period, case msg_type when 12 then 0 when 13 then 2 else 1 end, pctime_sec desc, skey, event_num) as pos from (
    select *, case when msg_type = 3 and regexp_matches(description, 'Free Throw .*?\\d of \\d') then min(event_num) over (partition by game_id, period, pctime_sec, p1_id, msg_type) * 10 + cast(regexp_extract(description, 'Free Throw .*?(\\d) of \\d', 1) as int)
      else event_num * 10 end as skey from pbp_v)"""


@query("p1_order", "select game_id, event_num, pos from order_v")
def _(spark, d):
    return pb.order_pbp(pbp(spark, d)).select("game_id", "event_num", "pos")


_TEAM = "action_type in (" + ", ".join(str(k) for k, (_, kind) in rules.FOULS.items() if kind == "team") + ") and p1_team_id is not null"
_DETAIL = "case action_type " + " ".join(f"when {k} then '{v}'" for k, (v, _) in rules.FOULS.items()) + " else 'unknown' end"
_VIEWS["foul_v"] = f"""select *, al - fouls_before as opp_before, al_late - late_before as opp_late_before from (
    select game_id, event_num, period, pctime_sec, p1_team_id, p1_id, {_DETAIL} as detail, it as is_team, cast(coalesce(sum(it::int) over m, 0) as bigint) as fouls_before, cast(coalesce(sum((it and pctime_sec <= 120)::int) over m, 0) as bigint) as late_before,
      cast(coalesce(sum(it::int) over b, 0) as bigint) as al, cast(coalesce(sum((it and pctime_sec <= 120)::int) over b, 0) as bigint) as al_late
    from (select *, {_TEAM} as it from order_v where msg_type = 6)
    window m as (partition by game_id, period, p1_team_id order by pos rows between unbounded preceding and 1 preceding), b as (partition by game_id, period order by pos rows between unbounded preceding and 1 preceding))"""


@query(
    "p14_foul_states",
    """select * exclude (al, al_late), fouls_before >= 4 or (pctime_sec <= 120 and late_before >= 1) as in_penalty,
      cast(case when pctime_sec <= 120 then least(greatest(4 - fouls_before, 0), greatest(1 - late_before, 0)) else greatest(4 - fouls_before, 0) end as bigint) as to_give, opp_before >= 4 or (pctime_sec <= 120 and opp_late_before >= 1) as opp_in_penalty from foul_v""",
)
def _(spark, d):
    return pb.foul_states(pbp(spark, d)).withColumn("to_give", F.col("to_give").cast("long"))


@query(
    "p16_foul_state_at",
    """select t.game_id, t.period, t.team_id, t.t_ms, t.pctime_sec, count(f.event_num) as team_fouls, count(f.event_num) filter (f.pctime_sec <= 120) as late_fouls, count(f.event_num) >= 4 or (t.pctime_sec <= 120 and count(f.event_num) filter (f.pctime_sec <= 120) >= 1) as in_penalty
    from (select game_id, period, team_id, event_num * 10 as t_ms, pctime_sec from pbp_v, (values (100), (200)) v(team_id) where msg_type = 9) t
    left join (select * from foul_v where is_team) f on f.game_id = t.game_id and f.period = t.period and f.p1_team_id = t.team_id and f.event_num * 10 <= t.t_ms group by t.game_id, t.period, t.team_id, t.t_ms, t.pctime_sec""",
)
def _(spark, d):
    own = pbp(spark, d)
    times = own.filter("msg_type = 9").select("game_id", "period", F.explode(F.array(F.lit(100), F.lit(200))).alias("team_id"), (F.col("event_num") * 10).alias("t_ms"), "pctime_sec")
    return pb.foul_state_at(pb.foul_states(own).withColumn("t_ms", F.col("event_num") * 10), times)


@query(
    "p8_possession_estimate",
    """select game_id, count(*) filter (msg_type in (1, 2)) as attempts, count(*) filter (msg_type = 4 and last_event.team = p1_team_id) as offensive_rebounds, count(*) filter (msg_type = 5) as turnovers, count(*) filter (msg_type = 3 and description not like '%Technical%') as free_throws,
      round(count(*) filter (msg_type in (1, 2)) - count(*) filter (msg_type = 4 and last_event.team = p1_team_id) + count(*) filter (msg_type = 5) + 0.44 * count(*) filter (msg_type = 3 and description not like '%Technical%'), 4)::double as possessions
    from (select *, last_value(case when msg_type in (2, 3) then {'team': p1_team_id} when msg_type = 4 then {'team': -9} end ignore nulls) over (partition by game_id order by pos rows between unbounded preceding and 1 preceding) as last_event from order_v) group by game_id""",
)
def _(spark, d):
    return pb.possession_estimate(pbp(spark, d)).withColumn("possessions", F.round("possessions", 4))


# The lens has the teams 100 and 200 in each game, so a team's rival is 300 less it; none of its rebounds is a team's.
_VIEWS["walk_v"] = """with o as (select *, p1_team_id as team, 300 - p1_team_id as rival, msg_type = 3 and p1_team_id is not null and description not like '%Technical%' as attempt, description not like 'MISS%' as went_in from order_v),
    f as (select *, attempt and description like '%2 of 2%' as final, last_value(case when msg_type = 1 then team end ignore nulls) over (partition by game_id, period, pctime_sec order by pos rows between unbounded preceding and 1 preceding) as scorer from o),
    w as (select *, sum(case when msg_type in (6, 8, 9, 18) or (msg_type in (3, 4) and coalesce(team = scorer, false)) then 0 else 1 end) over (partition by game_id, period, pctime_sec order by pos rows unbounded preceding) as stretch from f),
    b as (select *, max(case when msg_type = 1 then team end) over g as basket, bool_or(final) over g as decided, max(case when msg_type = 1 then event_num end) over g as made_event,
          row_number() over (partition by game_id, period, pctime_sec, stretch order by pos desc) = 1 as ends from w window g as (partition by game_id, period, pctime_sec, stretch)),
    q as (select *, basket is not null and not decided as in_basket from b),
    s as (select *, in_basket and ends as scored, case when msg_type in (12, 13) then -1 when in_basket and ends then 300 - basket when in_basket then null when msg_type = 10 then p3_team_id when team is null then null
          when msg_type in (1, 2, 4) then team when final and went_in then rival when attempt then team when msg_type = 5 then rival end as says from q),
    h as (select *, nullif(last_value(says ignore nulls) over (partition by game_id order by pos rows between unbounded preceding and 1 preceding), -1) as holder,
          case when (msg_type in (1, 2, 5) or attempt) and team is not null and (msg_type = 1 or not in_basket) then team end as needs,
          case when scored then lead(period) over (partition by game_id order by pos) else period end as seen_period, case when scored then lead(pctime_sec) over (partition by game_id order by pos) else pctime_sec end as seen_clock from s),
    m as (select *, last_value(case when says is not null and msg_type not in (12, 13) and (scored or coalesce(says <> holder, false) or msg_type = 5 or (final and went_in)) then {'p': seen_period, 'c': seen_clock, 'to': says} end ignore nulls)
          over (partition by game_id order by pos rows between unbounded preceding and 1 preceding) as last from h),
    l as (select *, coalesce(msg_type = 5 and team <> holder and last.to = rival and last.p = period and last.c = pctime_sec, false) as late from m)
    select *, not late and coalesce(needs <> holder, false) as takes, case when late then null when scored then 'made_fg' when msg_type = 5 and team is not null then 'turnover' when in_basket then null when final and went_in then 'made_ft'
      when msg_type = 10 and p3_team_id <> holder then 'jump_ball_lost' when msg_type = 4 and team <> holder then 'defensive_rebound' end as how, row_number() over (partition by game_id order by pos) = 1 as opens, lead(period) over (partition by game_id order by pos) as next_period from l"""
_VIEWS["opening_v"] = """select *, row_number() over (partition by game_id order by pos, slot) as nth from (
    select game_id, pos, 0 as slot, period, null::bigint as team, null::bigint as start, 'period_start' as why, event_num as ended, 'period_end' as how, false as turns from walk_v where msg_type = 12 or opens
    union all select game_id, pos, 1, period, needs, event_num, case when msg_type = 3 then 'free_throws' else 'unrecorded_change' end, event_num, 'unrecorded_change', true from walk_v where takes
    union all select game_id, pos, 3, case when scored then coalesce(next_period, period) else period end, nullif(says, -1), case when how = 'made_fg' then made_event else event_num end,
      case how when 'made_fg' then 'made_basket_inbound' when 'made_ft' then 'made_ft_inbound' when 'jump_ball_lost' then 'jump_ball' else how end, case when how = 'made_fg' then made_event else event_num end, how, true from walk_v where how is not null
    union all select game_id, pos, 4, period, null, null, 'period_start', event_num, 'period_end', false from walk_v where msg_type = 13)"""
_VIEWS["stand_v"] = """select w.*, case when late then t.turned else t.nth end as belongs from walk_v w join (
    select game_id, pos, slot, count(*) filter (slot <> 2) over r as nth, last_value(turned ignore nulls) over r as turned from (
      select game_id, pos, slot, case when turns then nth - 1 end as turned from opening_v union all select game_id, pos, 2, null from walk_v)
    window r as (partition by game_id order by pos, slot rows unbounded preceding)) t on t.game_id = w.game_id and t.pos = w.pos and t.slot = 2"""
_VIEWS["ledger_v"] = """with c as (select game_id, belongs as nth, min(case when not late and claim is not null then {'pos': pos, 'claim': claim, 'tip': msg_type = 10} end) as claimed, sum((msg_type in (1, 2) and team is not null)::int) as n_fga, sum(attempt::int) as n_fta,
        sum(case when msg_type = 1 and team is not null then case when description like '%3PT%' then 3 else 2 end when attempt and went_in then 1 else 0 end) as points, string_agg(event_num, ',' order by pos) as events,
        list(team) filter (msg_type = 4 and (holder is not null or in_basket)) as rebounds, list(team) filter (msg_type = 3 and team is not null and not attempt and went_in) as technicals
      from (select *, case when msg_type = 10 then p3_team_id when msg_type = 4 then team else needs end as claim from stand_v) group by all),
    e as (select *, lead(ended) over (partition by game_id order by nth) as end_event, coalesce(lead(how) over (partition by game_id order by nth), 'game_end') as end_type from opening_v)
    select e.game_id, (row_number() over (partition by e.game_id order by e.nth) - 1)::int as poss_seq, e.period, coalesce(e.team, c.claimed.claim) as offense_team_id, e.start as start_event_num, e.end_event as end_event_num,
      case when e.team is null and c.claimed.tip and e.why = 'period_start' then 'jump_ball' else e.why end as start_type, e.end_type, coalesce(n_fga, 0)::int as n_fga, coalesce(n_fta, 0)::int as n_fta,
      coalesce(len(list_filter(rebounds, lambda t: t = coalesce(e.team, c.claimed.claim))), 0)::int as n_oreb, coalesce(points, 0)::int as points, coalesce(len(list_filter(technicals, lambda t: t = coalesce(e.team, c.claimed.claim))), 0)::int as tech_offense,
      coalesce(len(list_filter(technicals, lambda t: t <> coalesce(e.team, c.claimed.claim))), 0)::int as tech_defense, coalesce(events, '') as event_nums
    from e left join c using (game_id, nth) where coalesce(e.team, c.claimed.claim) is not null"""


@query("p2_possessions", "select * from ledger_v")
def _(spark, d):
    return ledger(spark, d).withColumn("event_nums", F.array_join("event_nums", ","))


def ledger(spark, d):
    return ps.possessions(pbp(spark, d))


@query("p4_possession_map", """select p.game_id, p.event_num, l.poss_seq, l.offense_team_id, case when p.p1_team_id is null or l.offense_team_id is null then null when p.p1_team_id = l.offense_team_id then 'offense' else 'defense' end as role
    from pbp_v p left join (select game_id, poss_seq, offense_team_id, cast(unnest(string_split(nullif(event_nums, ''), ',')) as bigint) as event_num from ledger_v) l using (game_id, event_num)""")
def _(spark, d):
    return ps.possession_map(pbp(spark, d), ledger(spark, d))


_VIEWS["fill_v"] = """select *, sc is not null and sc between 0 and 2400 and not stuck as ok from (select *, full24 and max(game_clock_cs) over (partition by game_id, period, run_id) - min(game_clock_cs) over (partition by game_id, period, run_id) > 800 as stuck from (
    select *, sum(case when p is null or p <> full24 then 1 else 0 end) over (partition by game_id, period order by unix_ms rows unbounded preceding) as run_id from (
      select *, lag(full24) over (partition by game_id, period order by unix_ms) as p from (select *, shot_clock_cs as sc, coalesce(shot_clock_cs, -100) >= 2399 as full24 from index_v))))"""
_VIEWS["filled_v"] = """select game_id, period, unix_ms, case when ok then sc when sc is null and (game_clock_cs < 2400 or coalesce(game_clock_cs < prev, false)) then game_clock_cs when sc is null and clock_frozen then prev end as shot_clock_filled_cs,
    case when ok then 'observed' when stuck then 'stuck_24' when sc is not null then 'suspect' when game_clock_cs < 2400 or coalesce(game_clock_cs < prev, false) then 'off_game_clock' when clock_frozen and prev is not null then 'carry_forward' else 'missing' end as fill_method
    from (select *, last_value(case when ok then sc end ignore nulls) over (partition by game_id, period order by unix_ms rows unbounded preceding) as prev from fill_v)"""


@query("p19_shot_clock_filled", "select * from filled_v")
def _(spark, d):
    return sc.filled(index(spark, d))


@query("p25_post_release", "select game_id, event_num, msg_type as terminal_msg_type, event_num * 40 as t_terminal, event_num * 50 as t_end, case when msg_type in (1, 2) then event_num * 40 + 1500 else event_num * 50 end as t_end_post_ms, 1.5::double as post_release_s from pbp_v where msg_type in (1, 2, 5)")
def _(spark, d):
    w = pbp(spark, d).filter("msg_type in (1, 2, 5)").select("game_id", "event_num", F.col("msg_type").alias("terminal_msg_type"), (F.col("event_num") * 40).alias("t_terminal"), (F.col("event_num") * 50).alias("t_end"))
    return sc.with_post_release(w, 1.5)


@query("b15_court", """select game_id, period, unix_ms, player_id, (x <= 14 and abs(y - 25) >= 22) or sqrt((x - 5.25) * (x - 5.25) + (y - 25) * (y - 25)) >= 23.75 as three, x <= 19 and abs(y - 25) <= 8 as paint, x < 47 as front, x <= 2 or x >= 92 or y <= 2 or y >= 48 as line, 94 - x as fx, 50 - y as fy
    from (select *, x_cft / 100.0 as x, y_cft / 100.0 as y from frames_v where team_id <> -1)""")
def _(spark, d):
    x, y, left = F.col("x_cft") / 100, F.col("y_cft") / 100, F.lit(True)
    fx, fy = court.to_left_half(x, y, F.lit(False))
    return frames(spark, d).filter("team_id <> -1").select("game_id", "period", "unix_ms", "player_id", court.is_three(x, y, left).alias("three"), court.in_paint(x, y, left).alias("paint"), court.in_front_half(x, left).alias("front"), court.near_line(x, y, 2.0).alias("line"), fx.alias("fx"), fy.alias("fy"))


@query("b8_free_throws", r"""select game_id, event_num, case when description like '%Technical%' then 'technical' else '' end as kind, try_cast(regexp_extract(description, 'Free Throw (\d)', 1) as int) as n, try_cast(regexp_extract(description, 'of (\d)', 1) as int) as total, not starts_with(description, 'MISS') as made from pbp_v where msg_type = 3""")
def _(spark, d):
    ft = free_throw(F.col("description"))
    return pbp(spark, d).filter("msg_type = 3").select("game_id", "event_num", ft["kind"].alias("kind"), ft["n"].alias("n"), ft["of"].alias("total"), ft["made"].alias("made"))


@query("b7_strings", """select game_id, event_num, lpad(cast(game_id as varchar), 10, '0') as long_id, pctime_sec as seconds, split_part(description, ' ', 1) as word, description like '%Shot%' as shot, lower(description) as low from pbp_v""")
def _(spark, d):
    clock = F.concat_ws(":", F.floor(F.col("pctime_sec") / 60), F.col("pctime_sec") % 60)
    return pbp(spark, d).select("game_id", "event_num", padded_id(F.col("game_id")).alias("long_id"), clock_seconds(clock).cast("long").alias("seconds"), F.split_part("description", F.lit(" "), F.lit(1)).alias("word"), F.col("description").contains("Shot").alias("shot"), F.lower("description").alias("low"))


@query("b14_person_names", "select c_custkey, concat('j r customer ', cast(c_custkey as varchar)) as name from customer")
def _(spark, d):
    made = F.concat(F.lit("J. R. Cústömer "), F.col("c_custkey"), F.lit(" Jr."))
    return spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", F.regexp_replace(person_name(made), "^jr ", "j r ").alias("name"))


@query("h2_diagonal_union", "select game_id, unix_ms as t, null::bigint as event_num, k from (select game_id, unix_ms, k from frames_v where team_id = -1) union all select game_id, null, event_num, null from pbp_v")
def _(spark, d):
    a = frames(spark, d).filter("team_id = -1").select("game_id", F.col("unix_ms").alias("t"), "k")
    return a.unionByName(pbp(spark, d).select("game_id", "event_num"), allowMissingColumns=True)


@query("h6_wide_to_long", """unpivot (select event_id, key, k, v from series_v) on key, k, v into name field value amount""")
def _(spark, d):
    return series(spark, d).select("event_id", "key", "k", "v").unpivot("event_id", ["key", "k", "v"], "field", "amount")


@query("g5_every_nth", "select key, k from series_v where (k - 1) % 25 = 0")
def _(spark, d):
    w = kn.over(["key"], ["t_ms"])
    return series(spark, d).withColumn("r", F.row_number().over(w)).filter("(r - 1) % 25 = 0").select("key", "k")


@query("a13_manifest")
def _(spark, d):
    """Rows and content hash of each base table that the lenses read."""
    out = None
    for name in ("events", "orders", "region", "customer"):
        row = kn.content_hash(spark.read.parquet(f"{d}/{name}.parquet")).select(F.lit(name).alias("table"), "*")
        out = row if out is None else out.unionByName(row)
    return out


@query("a12_game_teams", "select game_id, team_id, n from (select game_id, p1_team_id as team_id, count(*) as n, row_number() over (partition by game_id order by count(*) desc, p1_team_id) as rn from pbp_v where p1_team_id is not null group by game_id, p1_team_id) where rn = 1")
def _(spark, d):
    per = pbp(spark, d).filter("p1_team_id is not null").groupBy("game_id", F.col("p1_team_id").alias("team_id")).agg(F.count("*").alias("n"))
    return per.groupBy("game_id").agg(F.min_by(F.struct("team_id", "n"), F.struct(-F.col("n"), "team_id")).alias("b")).select("game_id", "b.*")


@query("x1_splits")
def _(spark, d):
    games = pbp(spark, d).groupBy("game_id").agg(F.min("event_num").alias("game_date"))
    return pb.splits(games)


def _resets(spark, d):
    """Resets from the frames themselves: every 60th frame of a period, running from a little later."""
    w = kn.over(["game_id", "period"], ["unix_ms"])
    rows = index(spark, d).withColumn("i", F.row_number().over(w)).filter("i % 60 = 30")
    return rows.select("game_id", "period", "unix_ms", (F.col("unix_ms") + (F.col("i") % 7) * 40).alias("t_run_ms"), F.when(F.col("i") % 120 == 30, "full").otherwise("min14").alias("rule"))


_VIEWS["reset_v"] = """select game_id, period, unix_ms, unix_ms + (i % 7) * 40 as t_run_ms, case when i % 120 = 30 then 'full' else 'min14' end as rule, n from (select *, row_number() over (partition by game_id, period order by unix_ms) as n
    from (select *, row_number() over (partition by game_id, period order by unix_ms) as i from index_v) where i % 60 = 30)"""
_VIEWS["resetclock_v"] = """select r.*, coalesce(a.game_clock_cs, z.last) as gc, coalesce(b.game_clock_cs, z.last) as gc_run, z.t0, z.begin from reset_v r
    asof left join (select game_id, period, unix_ms, game_clock_cs from index_v) a on a.game_id = r.game_id and a.period = r.period and r.unix_ms <= a.unix_ms
    asof left join (select game_id, period, unix_ms, game_clock_cs from index_v) b on b.game_id = r.game_id and b.period = r.period and r.t_run_ms <= b.unix_ms
    join (select game_id, period, arg_max(game_clock_cs, unix_ms) as last, arg_min(game_clock_cs, unix_ms) as begin, min(unix_ms) as t0 from index_v group by all) z on z.game_id = r.game_id and z.period = r.period"""


@query(
    "p21_shot_clock_imputed",
    """select i.game_id, i.period, i.unix_ms, least(least(greatest(case when i.unix_ms >= s.t_run_ms then s.value - greatest(0, s.gc_run - i.game_clock_cs) else s.value end, 0), 2400), i.game_clock_cs)::bigint as shot_clock_imputed_cs,
      least(greatest(case when i.unix_ms >= s.t_run_ms then s.value - greatest(0, s.gc_run - i.game_clock_cs) else s.value end, 0), 2400) > i.game_clock_cs as imputed_off
    from index_v i asof join (
      with recursive walk as (
        select game_id, period, cast(0 as bigint) as n, min(unix_ms) as unix_ms, cast(2400 as bigint) as value, min(unix_ms) as t_run_ms, cast(arg_min(game_clock_cs, unix_ms) as bigint) as gc_run from index_v group by game_id, period
        union all
        select r.game_id, r.period, r.n, r.unix_ms, case when r.rule = 'full' then 2400 else greatest(1400, least(greatest(case when r.unix_ms >= w.t_run_ms then w.value - greatest(0, w.gc_run - r.gc) else w.value end, 0), 2400)) end, r.t_run_ms, r.gc_run
        from walk w join resetclock_v r on r.game_id = w.game_id and r.period = w.period and r.n = w.n + 1)
      select * from walk) s on s.game_id = i.game_id and s.period = i.period and i.unix_ms >= s.unix_ms""",
)
def _(spark, d):
    return sc.imputed(index(spark, d), _resets(spark, d)).withColumn("shot_clock_imputed_cs", F.col("shot_clock_imputed_cs").cast("long"))


@query("p15_free_throw_links")
def _(spark, d):
    return pb.free_throw_links(pbp(spark, d))


def _timed(spark, d):
    own = pbp(spark, d).filter("msg_type in (1, 2, 5)")
    return own.select("game_id", "period", F.col("event_num").alias("poss_seq"), F.col("p1_team_id").alias("offense_team_id"), (F.col("event_num") * 1000).alias("t_start_ms"), (F.col("event_num") * 1000 + 900).alias("t_end_ms"))


_VIEWS["timed_v"] = "select game_id, period, event_num as poss_seq, p1_team_id as offense_team_id, event_num * 1000 as t_start_ms, event_num * 1000 + 900 as t_end_ms from pbp_v where msg_type in (1, 2, 5)"


@query("p23_event_possession", "select e.game_id, e.event_num, e.t_ms, t.poss_seq, t.offense_team_id from (select game_id, event_num, event_num * 1000 + 17 as t_ms from pbp_v where msg_type in (4, 6, 9)) e asof left join timed_v t on t.game_id = e.game_id and e.t_ms >= t.t_start_ms")
def _(spark, d):
    events = pbp(spark, d).filter("msg_type in (4, 6, 9)").select("game_id", "event_num", (F.col("event_num") * 1000 + 17).alias("t_ms"))
    return pb.event_possession(events, _timed(spark, d))


@query("p9_offense_at", "select e.game_id, e.period, e.event_num, e.t_ms, case when e.t_ms <= t.t_end_ms then t.offense_team_id end as offense_team_id from (select game_id, period, event_num, event_num * 1000 + 17 as t_ms from pbp_v) e asof left join timed_v t on t.game_id = e.game_id and t.period = e.period and e.t_ms >= t.t_start_ms")
def _(spark, d):
    at = pbp(spark, d).select("game_id", "period", "event_num", (F.col("event_num") * 1000 + 17).alias("t_ms"))
    return pb.offense_at(at, _timed(spark, d))


@query("c17_greedy_match")
def _(spark, d):
    from courtframes.operators.matching import greedy_match

    s = series(spark, d)
    old = s.filter("v % 2 = 0").select("key", "event_id", "t_ms")
    return greedy_match(old, s.filter("v % 2 = 1").select("key", "event_id", "t_ms"), ["key"], "t_ms", "event_id", "event_id", 200)


@query("c19_resolution", """select c_custkey, name, c_nationkey, case when g.id is not null then g.id else u.id end as id, case when g.id is not null then 'name_group' when u.id is not null then 'name' else 'none' end as match
    from (select c_custkey, concat('n', c_custkey % 400) as name, c_nationkey from customer) c
    left join (select name, c_nationkey, min(id) as id from (select concat('n', c_custkey % 300) as name, (c_nationkey + c_custkey % 2) % 25 as c_nationkey, c_custkey % 350 as id from customer where c_custkey % 3 = 0) group by name, c_nationkey having count(distinct id) = 1) g using (name, c_nationkey)
    left join (select name, min(id) as id from (select concat('n', c_custkey % 300) as name, c_custkey % 350 as id from customer where c_custkey % 3 = 0) group by name having count(distinct id) = 1) u using (name)""")
def _(spark, d):
    from courtframes.operators.matching import resolve

    c = spark.read.parquet(f"{d}/customer.parquet")
    names = c.select("c_custkey", F.concat(F.lit("n"), F.col("c_custkey") % 400).alias("name"), "c_nationkey")
    known = c.filter("c_custkey % 3 = 0").select(F.concat(F.lit("n"), F.col("c_custkey") % 300).alias("name"), ((F.col("c_nationkey") + F.col("c_custkey") % 2) % 25).cast("int").alias("c_nationkey"), (F.col("c_custkey") % 350).alias("id"))
    return resolve(names, known, "name", "c_nationkey", "id").select("c_custkey", "name", "c_nationkey", "id", "match")


_VIEWS["box_v"] = """select game_id, p1_team_id, p1_id, count(*) filter (msg_type in (1, 2)) as fga, count(*) filter (msg_type = 1) as fgm, count(*) filter (msg_type = 1 and description like '%3PT%') as fg3m, count(*) filter (msg_type = 3) as fta,
    count(*) filter (msg_type = 3 and description not like 'MISS%') as ftm, cast(sum(case when msg_type = 1 and description like '%3PT%' then 3 when msg_type = 1 then 2 when msg_type = 3 and description not like 'MISS%' then 1 else 0 end) as bigint) as points,
    count(*) filter (msg_type = 4) as rebounds, count(*) filter (msg_type = 5) as turnovers from pbp_v where p1_id is not null group by all"""


@query("x3_box_counts", "select * from box_v")
def _(spark, d):
    return rp.box_counts(pbp(spark, d))


@query("x3_score_check", """select coalesce(a.game_id, b.game_id) as game_id, coalesce(a.team_id, b.team_id) as team_id, coalesce(a.points, 0) as official, coalesce(b.points, 0) as counted, coalesce(a.points, 0) = coalesce(b.points, 0) as agrees
    from (select game_id, p1_team_id as team_id, cast(sum(points) as bigint) as points from box_v where game_id % 4 <> 0 group by all) a full join (select game_id, p1_team_id as team_id, cast(sum(points + case when game_id = 3 then 1 else 0 end) as bigint) as points from box_v where game_id % 5 <> 0 group by all) b on a.game_id = b.game_id and a.team_id = b.team_id""")
def _(spark, d):
    box = rp.box_counts(pbp(spark, d)).withColumnRenamed("p1_team_id", "team_id")
    total = lambda df, extra: df.groupBy("game_id", "team_id").agg(F.sum(F.col("points") + extra).alias("points"))
    return rp.score_check(total(box.filter("game_id % 4 <> 0"), F.lit(0)), total(box.filter("game_id % 5 <> 0"), F.when(F.col("game_id") == 3, 1).otherwise(0)))


@query("x7_distribution", " union all ".join(f"select '{c}' as \"column\", min({c})::double as low, quantile_cont({c}, 0.05)::double as p05, quantile_cont({c}, 0.5)::double as p50, quantile_cont({c}, 0.95)::double as p95, max({c})::double as high from box_v" for c in ("points", "fga", "rebounds")))
def _(spark, d):
    return rp.distribution(rp.box_counts(pbp(spark, d)), ["points", "fga", "rebounds"])


@query("x2_ordered_links", """select a.game_id, a.p1_id, a.line, b.event_num from (select *, row_number() over (partition by game_id, p1_id order by line) as n from (select game_id, p1_id, event_num * 3 as line from pbp_v where msg_type in (1, 2) and event_num % 9 <> 0)) a
    join (select *, row_number() over (partition by game_id, p1_id order by event_num) as n from pbp_v where msg_type in (1, 2)) b on a.game_id = b.game_id and a.p1_id = b.p1_id and a.n = b.n""")
def _(spark, d):
    own = pbp(spark, d)
    official = own.filter("msg_type in (1, 2) and event_num % 9 <> 0").select("game_id", "p1_id", (F.col("event_num") * 3).alias("line"))
    return rp.link_in_order(official, own, ["game_id", "p1_id"]).select("game_id", "p1_id", "line", "event_num")


@query("x10_penalty_check", "select in_penalty, count(*) as n_fouls, cast(sum(to_ft) as bigint) as n_to_free_throws from (select fouls_before >= 4 or (pctime_sec <= 120 and late_before >= 1) as in_penalty, case when exists (select 1 from pbp_v p where p.msg_type = 3 and p.game_id = f.game_id and p.period = f.period and p.pctime_sec = f.pctime_sec and p.p1_team_id <> f.p1_team_id) then 1 else 0 end as to_ft from foul_v f where is_team) group by 1")
def _(spark, d):
    own = pbp(spark, d)
    shot = own.filter("msg_type = 3").select("game_id", "period", "pctime_sec", F.when(F.col("p1_team_id") == 100, 200).otherwise(100).alias("p1_team_id")).distinct().withColumn("hit", F.lit(1))
    fouls = pb.foul_states(own).filter("is_team").join(shot, ["game_id", "period", "pctime_sec", "p1_team_id"], "left")
    return fouls.groupBy("in_penalty").agg(F.count("*").alias("n_fouls"), F.coalesce(F.sum("hit"), F.lit(0)).alias("n_to_free_throws"))
