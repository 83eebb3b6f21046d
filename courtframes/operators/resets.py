"""When the shot clock is set anew (P20): possession starts, missed shots at the rim, fouls and kicked balls, and when it runs again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtframes.functions import court
from courtframes.operators import kernels as kn
from courtframes.operators.events import PERIOD
from courtframes.operators.playbyplay import VIOLATION

# Fouls that set the clock by where the ball comes in, and those that keep at least 14 s; the code of a kicked ball.
COMMON = ("personal", "personal_block", "personal_take", "loose_ball", "inbound")
KEEPING = ("defensive_3_seconds", "technical", "delay_of_game")
KICKED = 5
# Resets that a throw-in follows, by the beginning of their cause.
THROW_INS = ("poss:made_basket_inbound", "poss:made_ft_inbound", "poss:turnover", "foul_", "kicked_ball", "defensive_3_seconds", "technical", "delay_of_game", "flagrant")
# Possessions that begin in play; reach of an inbound catch and of a ball that goes out and comes back, and from back to touched, in ms.
LIVE = ("defensive_rebound", "turnover", "unrecorded_change")
CATCH_MS, OUT_MS, TOUCH_MS = 180_000, 60_000, 300


def _reset(rows: DataFrame, rule: Column, cause: Column, rank: int, run: Column | None = None) -> DataFrame:
    """Resets of one source; the rank orders those of one time."""
    run = F.lit(None) if run is None else run
    return rows.select(*PERIOD, F.col("unix_ms").cast("long").alias("unix_ms"), run.cast("long").alias("t_run_ms"), rule.alias("rule"), cause.alias("cause"), F.lit(rank).alias("rank"))


def _restart_half(rows: DataFrame, index: DataFrame, ball: DataFrame, direction: DataFrame) -> DataFrame:
    """rows with half: front or back, where the ball is (median of 0.6 s) when the clock first runs after unix_ms; null where that is not known."""
    runs = index.filter(~F.col("clock_frozen")).select(*PERIOD, "unix_ms").withColumn("__runs", F.lit(True))
    started = kn.asof(rows.withColumn("unix_ms", F.col("unix_ms") + 1), runs, PERIOD, "unix_ms", ["__runs"], forward=True).withColumn("unix_ms", F.col("unix_ms") - 1).drop("__runs")
    spans = started.select(*PERIOD, "event_num", (F.col("match_unix_ms") - 200).alias("__lo"), (F.col("match_unix_ms") + 400).alias("__hi")).filter("__lo is not null")
    near = kn.range_join(ball, spans, PERIOD, "unix_ms", "__lo", "__hi", 1000).groupBy(*PERIOD, "event_num").agg(F.median("bx").alias("__x"))
    sides = direction.select(*PERIOD, F.col("team_id").alias("offense"), "attacks_left")
    found = started.drop("match_unix_ms").join(near, [*PERIOD, "event_num"]).join(sides, [*PERIOD, "offense"])
    return found.withColumn("half", F.when((F.col("__x") < court.LENGTH * 50) == F.col("attacks_left"), "front").otherwise("back")).select(*rows.columns, "half")


def shot_clock_resets(
    ledger: DataFrame, shots: DataFrame, inbounds: DataFrame, fouls: DataFrame, pbp: DataFrame, aligned: DataFrame, index: DataFrame, ball: DataFrame, direction: DataFrame,
    hold_at_rim: bool = True, lag_ms: int = 0, same_ms: int = 6000,
) -> DataFrame:
    """game_id, period, unix_ms, t_run_ms, rule (full or min14) and cause of each reset, the input of `shot_clock.imputed`.

    Full at each possession start, but for a defensive rebound within same_ms of a miss at the rim, which has set it before; at the rim contact
    of a missed shot, running from the next control (or, unless hold_at_rim, at that control); at flagrant fouls; at common fouls of the
    defence without free throws that are thrown in from the back half.  min14 at those from the front half, at the defence's three seconds,
    technicals, delays and kicked balls.  lag_ms moves resets in play.

    Where nothing says when the clock runs again, it is the next inbound catch before the next reset, else, at causes of a throw-in, when the
    ball has left the court and come back.  shots: made, t_rim_ms, t_control_ms; a shot of unknown outcome sets nothing.  fouls: event_num,
    committed_by_team, detail, n_free_throws.  aligned: event_num, t_ms.  ball: bx, by in hundredths of a foot.  Every search in time is an as-of
    or a bucketed range join, so no period's rows all meet; events without a time, and fouls without a team, set nothing.
    """
    starts = ledger.filter("t_start_ms is not null").select(*PERIOD, "poss_seq", F.col("t_start_ms").alias("unix_ms"), "offense_team_id", "start_type")
    holds = starts.groupBy(*PERIOD, "unix_ms").agg(F.max_by("offense_team_id", "poss_seq").alias("offense"))
    at = aligned.filter("t_ms is not null").select("game_id", F.col("event_num").cast("long").alias("event_num"), F.col("t_ms").cast("long").alias("unix_ms"))
    # missed shots at the rim
    misses = shots.filter((F.col("made") == F.lit(False)) & F.col("t_rim_ms").isNotNull())
    control = F.col("t_control_ms")
    misses = misses.select(*PERIOD, (F.col("t_rim_ms") if hold_at_rim else F.coalesce(control + lag_ms, "t_rim_ms")).alias("unix_ms"), (control if hold_at_rim else F.lit(None)).alias("run"))
    rim = _reset(misses, F.lit("full"), F.lit("rim"), 0, F.col("run"))
    # possession starts
    if same_ms > 0:
        known = rim.select(*PERIOD, F.col("unix_ms").alias("__lo"), (F.col("unix_ms") + same_ms).alias("__hi"))
        rebounds = kn.range_join(starts.filter("start_type = 'defensive_rebound'"), known, PERIOD, "unix_ms", "__lo", "__hi", same_ms, how="left_anti")
        starts = starts.filter("start_type is distinct from 'defensive_rebound'").unionByName(rebounds)
    in_play = F.when(F.col("start_type").isin(*LIVE), lag_ms).otherwise(0)
    possession = _reset(starts.withColumn("unix_ms", F.col("unix_ms") + in_play), F.lit("full"), F.concat(F.lit("poss:"), F.coalesce("start_type", F.lit(""))), 1)
    # fouls and kicked balls, with the team in possession
    called = fouls.filter("committed_by_team is not null").select("game_id", "period", F.col("event_num").cast("long").alias("event_num"), "committed_by_team", "detail", "n_free_throws").join(at, ["game_id", "event_num"])
    called = kn.asof(called, holds, PERIOD, "unix_ms", ["offense"]).drop("match_unix_ms").withColumn("defensive", F.coalesce(F.col("committed_by_team") != F.col("offense"), F.lit(False)))
    flagrant = _reset(called.filter(F.col("detail").isin("flagrant_1", "flagrant_2")), F.lit("full"), F.lit("flagrant"), 2)
    keeping = _reset(called.filter(F.col("defensive") & F.col("detail").isin(*KEEPING)), F.lit("min14"), F.col("detail"), 2)
    common = _restart_half(called.filter(F.col("defensive") & F.col("detail").isin(*COMMON) & (F.col("n_free_throws") == 0)), index, ball, direction)
    common = _reset(common, F.when(F.col("half") == "front", "min14").otherwise("full"), F.concat(F.lit("foul_"), "half", F.lit("court")), 2)
    kicked = pbp.filter((F.col("msg_type") == VIOLATION) & (F.col("action_type") == KICKED)).select("game_id", "period", F.col("event_num").cast("long").alias("event_num"), "p1_team_id").join(at, ["game_id", "event_num"])
    kicked = kn.asof(kicked, holds, PERIOD, "unix_ms", ["offense"]).filter("offense is not null and p1_team_id is distinct from offense")
    kicked = _reset(kicked, F.lit("min14"), F.lit("kicked_ball"), 3)
    found = reduce(DataFrame.unionByName, [rim, possession, flagrant, keeping, common, kicked])
    return _running(found, inbounds, ball).select(*PERIOD, "unix_ms", "t_run_ms", "rule", "cause")


def _running(found: DataFrame, inbounds: DataFrame, ball: DataFrame) -> DataFrame:
    """found with t_run_ms from the next inbound catch or from the ball that comes back in, where it has none."""
    found = found.withColumn("next", F.lead("unix_ms").over(kn.over(PERIOD, ["unix_ms", "rank", "cause", "t_run_ms"])))
    catches = inbounds.filter("t_catch_ms is not null").select(*PERIOD, F.col("t_catch_ms").cast("long").alias("unix_ms")).distinct().withColumn("__c", F.lit(True))
    rows = kn.asof(found, catches, PERIOD, "unix_ms", ["__c"], forward=True, tolerance=CATCH_MS)
    own = F.col("match_unix_ms")
    caught = F.when(F.col("__c") & (F.col("next").isNull() | (own < F.col("next"))), own)
    rows = rows.withColumn("t_run_ms", F.coalesce("t_run_ms", caught)).drop("match_unix_ms", "__c")
    x, y = F.col("bx"), F.col("by")
    wide, high = court.LENGTH * 100, court.WIDTH * 100
    away = (x < -50) | (x > wide + 50) | (y < -50) | (y > high + 50)
    inside = (x > 100) & (x < wide - 100) & (y > 100) & (y < high - 100)
    spots = lambda rule: ball.filter(rule).select(*PERIOD, "unix_ms").distinct().withColumn("__b", F.lit(True))
    most = F.least(F.coalesce("next", F.col("t") + OUT_MS), F.col("t") + OUT_MS)
    rows = rows.withColumn("t", F.col("unix_ms")).withColumn("unix_ms", F.col("t") + 1)
    rows = kn.asof(rows, spots(away), PERIOD, "unix_ms", ["__b"], forward=True)
    # a reset whose ball does not go out asks for a frame behind all others, and gets none
    rows = rows.withColumn("unix_ms", F.when(F.col("match_unix_ms") <= most, F.col("match_unix_ms")).otherwise(F.lit(2**62))).drop("match_unix_ms", "__b")
    rows = kn.asof(rows, spots(inside), PERIOD, "unix_ms", ["__b"], forward=True)
    thrown = reduce(lambda a, b: a | b, [F.col("cause").startswith(c) for c in THROW_INS])
    back = F.when(thrown & (F.col("match_unix_ms") <= most), F.col("match_unix_ms") + TOUCH_MS)
    return rows.withColumn("t_run_ms", F.coalesce("t_run_ms", back)).withColumn("unix_ms", F.col("t")).drop("t", "match_unix_ms", "__b")
