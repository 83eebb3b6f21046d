"""Views that give the driver's tables the shapes of tracking data.

Integer-only SQL that Spark and DuckDB read alike: coordinates in hundredths of a foot, clocks in
hundredths of a second.  A lens names base tables in braces; `spark_view` binds them to DataFrames, and
`sql_view` leaves their plain names.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Fifteen games of frames with one ball and ten players.  The ball stays by one player for 28 frames of
#: 40, then flies.  Every 97th frame is followed by a hole, the clock freezes for 20 frames of 251 and is set
#: up by 1.5 s for 9 frames of 1009.
FRAMES = """
select f.game_id, f.period, f.unix_ms, f.game_clock_cs, case when f.k % 7 = 0 then null else f.shot_clock_cs end as shot_clock_cs, f.k,
       case when p.i = 0 then -1 when p.i <= 5 then 100 else 200 end as team_id,
       case when p.i = 0 then -1 else 1000 + p.i end as player_id,
       abs((case when q % 5 = 0 then 3 else 30 + 7 * q end * f.k + 997 * q + 131 * f.game_id) % 18800 - 9400) + case when p.i > 0 then 0 when f.k % 40 < 28 then 100 else 700 end as x_cft,
       abs((case when q % 5 = 0 then 2 else 20 + 5 * q end * f.k + 577 * q + 71 * f.game_id) % 10000 - 5000) as y_cft,
       case when p.i > 0 then 0 when f.k % 40 < 28 then abs((f.k * 37) % 600 - 300) else 300 + abs((f.k * 53) % 1600 - 800) end as z_cft
from (select g.game_id, g.k, g.period, 1447287043000 + 40 * g.k + 2000 * cast(floor(g.k / 97) as bigint) as unix_ms,
             72000 - 4 * (g.j - case when g.j % 251 between 100 and 119 then g.j % 251 - 100 else 0 end) + case when g.j % 1009 >= 1000 then 150 else 0 end as game_clock_cs,
             2400 - (g.j * 4) % 2400 as shot_clock_cs,
             1 + (cast(floor(g.k / 40) as bigint) * 7 + g.game_id) % 10 as h
      from (select game_id, k, period, cast(row_number() over (partition by game_id, period order by k) as bigint) as j
            from (select game_id, k, cast(1 + floor(4 * (k - 1) / n) as bigint) as period
                  from (select user_id % 15 as game_id, cast(row_number() over (partition by user_id % 15 order by ts, event_id) as bigint) as k,
                               count(*) over (partition by user_id % 15) as n from {events}) e0) e1) g) f
cross join (select cast(r_regionkey as bigint) as i from {region} union all select cast(r_regionkey as bigint) + 5 from {region}
            union all select cast(r_regionkey as bigint) + 10 from {region} where r_regionkey = 0) p
cross join lateral (select case when p.i = 0 then f.h else p.i end as q) w
"""

#: FRAMES as a source gives it: every 7th frame stands again in a later event, and every 101st is split in a
#: ball-only moment with another clock and a players-only moment.
FRAMES_RAW = f"""
select game_id, period, unix_ms, team_id, player_id, x_cft, y_cft, z_cft, shot_clock_cs,
       game_clock_cs + case when k % 101 = 0 and team_id = -1 then 40 else 0 end as game_clock_cs,
       cast(floor(k / 50) as bigint) as event_id, (k % 50) * 2 + case when k % 101 = 0 and team_id = -1 then 1 else 0 end as moment_idx from ({FRAMES}) r0
union all
select game_id, period, unix_ms, team_id, player_id, x_cft, y_cft, z_cft, shot_clock_cs, game_clock_cs, cast(floor(k / 50) as bigint) + 1000000 as event_id, (k % 50) * 2 as moment_idx
from ({FRAMES}) r1 where k % 7 = 0
"""

#: Play-by-play of the same games, from orders.
PBP = """
select game_id, event_num, period, 720 - cast(floor(720 * (j - 1) / m) as bigint) as pctime_sec, msg_type, a % 5 as action_type,
       case when msg_type in (12, 13) then null else team_id end as p1_team_id,
       case when msg_type in (12, 13) then null else case when team_id = 100 then 1001 else 1006 end + a % 5 end as p1_id,
       case when msg_type = 10 then case when a % 3 = 0 then 200 else 100 end end as p3_team_id,
       case msg_type when 1 then case when a % 3 = 0 then '3PT Jump Shot' else 'Layup' end
                     when 2 then 'MISS Jump Shot'
                     when 3 then concat(case when a % 5 = 0 then 'MISS ' else '' end, 'Free Throw ', case when a % 7 = 0 then 'Technical' else concat(cast(1 + a % 2 as varchar(1)), ' of 2') end)
                     else '' end as description
from (select *, case when j = 1 then 12 when j = m then 13 when r < 5 then 1 when r < 9 then 2 when r < 13 then 4 when r < 15 then 5 when r < 17 then 6 when r < 18 then 3 when r < 19 then 9 else 10 end as msg_type
      from (select *, cast(row_number() over (partition by game_id, period order by event_num) as bigint) as j, count(*) over (partition by game_id, period) as m,
                   (a * 7 + game_id) % 20 as r, case when (a + cast(floor(a / 3) as bigint)) % 2 = 0 then 100 else 200 end as team_id
            from (select *, cast(1 + floor(4 * (event_num - 1) / n) as bigint) as period
                  from (select o_custkey % 15 as game_id, cast(row_number() over (partition by o_custkey % 15 order by o_orderdate, o_orderkey) as bigint) as event_num,
                               count(*) over (partition by o_custkey % 15) as n, o_orderkey as a from {orders}) o0) o1) o2) o3
"""

#: A keyed series of codes and values in time order, for the generic kernels.
SERIES = """
select user_id as key, cast(row_number() over (partition by user_id order by ts, event_id) as bigint) as k, event_id, event_type as code, cast(floor(value) as bigint) as v,
       cast(sum(40 + case when event_id % 11 = 0 then 500 else event_id % 7 end) over (partition by user_id order by ts, event_id rows unbounded preceding) as bigint) as t_ms
from {events}
"""


def spark_view(spark: SparkSession, sf_dir: str, lens: str) -> DataFrame:
    names = set(re.findall(r"\{(\w+)\}", lens))
    return spark.sql(lens, **{n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names})


def sql_view(lens: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", lens)

#: FRAMES where the ball of every third flight passes over a rim, by turns of either hoop, and comes down behind it.
FRAMES_RIM = f"""
select game_id, period, unix_ms, game_clock_cs, shot_clock_cs, k, team_id, player_id,
       case when up then case when floor(k / 120) % 2 = 0 then 525 else 8875 end + 40 * (k % 40 - 34) else x_cft end as x_cft,
       case when up then 2500 + 20 * (k % 40 - 34) else y_cft end as y_cft,
       case when up then 1250 - 60 * (k % 40 - 32) else z_cft end as z_cft
from (select r.*, team_id = -1 and floor(k / 40) % 3 = 0 and k % 40 >= 32 as up from ({FRAMES}) r) u
"""

#: PBP with a clock that runs as far as the frames' does, so that most rows lie in frames; an attempt stands close to the end of a flight.
PBP_NEAR = f"""
select q.game_id, event_num, period, 720 - cast(floor(f.n * (j - 1) / (100 * m)) as bigint) as pctime_sec, msg_type, action_type, p1_team_id, p1_id, p3_team_id, description
from (select p.*, row_number() over (partition by game_id, period order by event_num) as j, count(*) over (partition by game_id, period) as m from ({PBP}) p) q
join (select user_id % 15 as game_id, count(*) as n from {{events}} group by user_id % 15) f on q.game_id = f.game_id
"""

#: FRAMES where player 1003 walks up to 1010 in every cycle of 40 frames, and 1004 stands by 1010: moving screens.
FRAMES_SCREEN = f"""
select r.game_id, r.period, r.unix_ms, r.game_clock_cs, r.shot_clock_cs, r.k, r.team_id, r.player_id,
       case when r.player_id = 1003 then z.x_cft + 700 - 28 * (r.k % 40) when r.player_id = 1004 then z.x_cft + 60 else r.x_cft end as x_cft,
       case when r.player_id = 1003 then z.y_cft + 40 when r.player_id = 1004 then z.y_cft + 240 + 30 * (r.k % 40) else r.y_cft end as y_cft, r.z_cft
from ({FRAMES}) r join (select game_id, k, x_cft, y_cft from ({FRAMES}) z0 where player_id = 1010) z on z.game_id = r.game_id and z.k = r.k
"""

#: PBP_NEAR with fouls of every class, and kicked balls and other violations in place of every second timeout.
PBP_CALLS = f"""
select game_id, event_num, period, pctime_sec, case when turned then 7 else msg_type end as msg_type, case when turned then 4 + cast(floor(event_num / 2) as bigint) % 2 when msg_type = 6 then event_num % 31 else action_type end as action_type,
       p1_team_id, p1_id, p3_team_id, description
from (select *, msg_type = 9 and event_num % 2 = 0 as turned from ({PBP_NEAR}) c0) c1
"""

#: PBP_CALLS as a slow game: rows between every 50th are rebounds, so that windows between rows that end a possession have room for a crossing.
PBP_SLOW = f"""
select game_id, event_num, period, pctime_sec, case when event_num % 50 = 0 or msg_type in (12, 13) then msg_type else 4 end as msg_type, action_type, p1_team_id, p1_id, p3_team_id, description from ({PBP_CALLS}) s0
"""
