"""Windows and moments against possessions, line-ups, grids and hoops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtframes.operators import kernels as kn
from courtframes.operators.events import FRAME, PERIOD, ball_rows, player_rows
from courtframes.operators.playbyplay import offense_at, order_pbp
from courtframes.operators.shots import HOOP_LEFT_CFT, HOOP_RIGHT_CFT, HOOP_Y_CFT

BUCKET_MS = 4000
# Clock window and rim measures of the direction check.
CHECK_BEFORE_CS, CHECK_AFTER_CS = 500, 200
CHECK_RIM_CFT, CHECK_LOW_CFT, CHECK_HIGH_CFT = 200, 800, 1150


def attach_possession(windows: DataFrame, ledger: DataFrame) -> DataFrame:
    """windows (game, period, window, lo, hi, team_id) with the possession they overlap most, of equals the first (P7).

    overlap_frac is the share of the window inside it.  A window without length takes the last possession that
    holds its moment, with share 1.  A window outside all has no possession and share 0.
    """
    one = [*PERIOD, "window"]
    own = ledger.filter("t_start_ms is not null").select(*PERIOD, "poss_seq", "offense_team_id", "t_start_ms", "t_end_ms")
    spans = windows.select(*one, "lo", "hi")
    best = kn.longest_overlap(spans.filter("hi > lo"), own, PERIOD, ["window"], "poss_seq", BUCKET_MS, ("lo", "hi"), ("t_start_ms", "t_end_ms"))
    best = best.select(*one, "poss_seq", "offense_team_id", ((F.col("o_hi") - F.col("o_lo")) / (F.col("hi") - F.col("lo"))).alias("overlap_frac"))
    inside = kn.range_join(spans.filter("hi <= lo").withColumnRenamed("lo", "t").drop("hi"), own, PERIOD, "t", "t_start_ms", "t_end_ms", BUCKET_MS)
    at = inside.groupBy(*one).agg(F.max(F.struct("poss_seq", "offense_team_id")).alias("__p")).select(*one, "__p.*", F.lit(1.0).alias("overlap_frac"))
    found = windows.join(best.unionByName(at), one, "left")
    return found.select(*windows.columns, "poss_seq", F.coalesce("overlap_frac", F.lit(0.0)).alias("overlap_frac"), (F.col("offense_team_id") == F.col("team_id")).alias("offense_match"))


def lineups(spans: DataFrame, entities: DataFrame) -> DataFrame:
    """spans (game, period, span, team_id, t_start_ms, t_end_ms) with the players of the first frame at or after the start (P12).

    own_ids and other_ids are sorted; lineup_stable tells whether the last frame at or before the end has the same
    players.  Only the frames asked for are joined with players.
    """
    players = player_rows(entities).select(*FRAME, F.col("team_id").alias("side"), "player_id")
    times = players.select(*FRAME).distinct()
    one = [*PERIOD, "span"]

    def at(column: str, forward: bool) -> DataFrame:
        asked = spans.select(*one, F.col(column).alias("unix_ms"))
        return kn.asof(asked, times, PERIOD, "unix_ms", [], forward=forward).select(*one, F.col("match_unix_ms").alias("unix_ms"), F.lit(forward).alias("first"))

    wanted = at("t_start_ms", True).unionByName(at("t_end_ms", False))
    there = wanted.join(players, FRAME).groupBy(*one).agg(
        *[F.array_sort(F.collect_list(F.when(cond, F.struct("side", "player_id")))).alias(name) for name, cond in (("__a", F.col("first")), ("__b", ~F.col("first")))]
    )
    ids = lambda same: F.transform(F.filter("__a", lambda p: (p["side"] == F.col("team_id")) == same), lambda p: p["player_id"])
    out = spans.join(there, one, "left").withColumn("__known", F.size(F.coalesce("__a", F.array().cast("array<struct<side:bigint,player_id:bigint>>"))) > 0)
    return out.select(*spans.columns, F.when(F.col("__known"), ids(True)).alias("own_ids"), F.when(F.col("__known"), ids(False)).alias("other_ids"), F.when(F.col("__known"), F.col("__a") == F.col("__b")).alias("lineup_stable"))


def approach_start(df: DataFrame, keys: list[str], time: str, distance: str, name: str = "t_approach") -> DataFrame:
    """Each row with the start of the approach it ends: back over rows whose distance does not grow (F16).

    The walk stops behind a row that is nearer than the next one or has no distance.
    """
    w = kn.over(keys, [time])
    before = F.lag(distance).over(w)
    starts = F.when(before.isNull() | (before < F.col(distance)) | F.col(distance).isNull(), F.col(time))
    return df.withColumn("__start", starts).withColumn(name, F.last("__start", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__start")


def grid_labels(spans: DataFrame, labels: DataFrame, value: str, step: int) -> DataFrame:
    """value of the nearest labelled frame at each step of each span (game, period, span, t_start_ms, t_end_ms); -1 where
    the period has none, of equally near frames the earlier (F18)."""
    grid = spans.select(*PERIOD, "span", F.explode(F.sequence("t_start_ms", "t_end_ms", F.lit(step).cast("long"))).alias("unix_ms"))
    found = kn.nearest(grid, labels.select(*FRAME, value), PERIOD, "unix_ms", [value])
    return found.select(*PERIOD, "span", "unix_ms", F.coalesce(value, F.lit(-1)).alias(value))


def direction_check(entities: DataFrame, pbp: DataFrame, direction: DataFrame) -> DataFrame:
    """Per game: shots whose first rim contact near their clock is at the hoop the team attacks (L1.5).

    n_shots_rim counts shots with a contact and a known direction, n_agree those that agree, n_no_rim those with frames
    but no contact.  Shots and ball are dealt by buckets of the clock.
    """
    width = CHECK_BEFORE_CS + CHECK_AFTER_CS
    shots = pbp.filter(F.col("msg_type").isin(1, 2) & F.col("p1_team_id").isNotNull()).select(*PERIOD, "event_num", F.col("p1_team_id").alias("team_id"), (F.col("pctime_sec") * 100).alias("at"))
    # shots of one clock look at the same frames, which are read once
    asked = shots.select(*PERIOD, "at").distinct().withColumn("bucket", F.explode(F.sequence(F.floor((F.col("at") - CHECK_AFTER_CS) / width), F.floor((F.col("at") + CHECK_BEFORE_CS) / width))))
    clock = entities.filter("team_id = -1").select(*FRAME, "game_clock_cs")
    ball = ball_rows(entities).join(clock, FRAME).withColumn("bucket", F.floor(F.col("game_clock_cs") / width))

    def at(hoop: int) -> Column:
        dx, dy = F.col("bx") - hoop, F.col("by") - HOOP_Y_CFT
        return (F.col("bz") > CHECK_LOW_CFT) & (F.col("bz") < CHECK_HIGH_CFT) & (dx * dx + dy * dy < CHECK_RIM_CFT * CHECK_RIM_CFT)

    near = asked.join(ball, [*PERIOD, "bucket"]).filter((F.col("game_clock_cs") >= F.col("at") - CHECK_AFTER_CS) & (F.col("game_clock_cs") <= F.col("at") + CHECK_BEFORE_CS))
    hits = near.groupBy(*PERIOD, "at").agg(F.min(F.when(at(HOOP_LEFT_CFT) | at(HOOP_RIGHT_CFT), F.struct("unix_ms", at(HOOP_LEFT_CFT).alias("left")))).alias("hit"))
    told = shots.join(hits, [*PERIOD, "at"]).join(direction.select(*PERIOD, "team_id", "attacks_left"), [*PERIOD, "team_id"], "left")
    known = F.col("hit").isNotNull() & F.col("attacks_left").isNotNull()
    return told.groupBy("game_id").agg(F.count_if(known).alias("n_shots_rim"), F.count_if(known & (F.col("hit.left") == F.col("attacks_left"))).alias("n_agree"), F.count_if(F.col("hit").isNull()).alias("n_no_rim"))


def event_owners(pbp: DataFrame, ledger: DataFrame) -> DataFrame:
    """game_id, event_num and the poss_seq of the possession that each row of the log lies in; an end event belongs to the one it ends (P10).

    The owner is the first possession that ends at or after the row in the log's order; one without an end event ends with its period, and
    rows behind all ends belong to the last possession.  Of possessions with one end event, as at a change that a basket reveals,
    the first owns it and all are over behind it.  Games without possessions give no rows.
    """
    rows = order_pbp(pbp).select("game_id", "period", "pos", F.col("event_num").cast("long").alias("event_num"))
    places = rows.select("game_id", F.col("event_num").alias("end_event_num"), F.col("pos").alias("__end"))
    closing = rows.groupBy("game_id", "period").agg(F.max("pos").alias("__close"))
    ends = ledger.select("game_id", "period", "poss_seq", F.col("end_event_num").cast("long").alias("end_event_num")).join(places, ["game_id", "end_event_num"], "left").join(closing, ["game_id", "period"], "left")
    ends = ends.groupBy("game_id", F.coalesce("__end", "__close").alias("pos")).agg(F.min("poss_seq").alias("poss_seq")).filter("pos is not null")
    last = ledger.groupBy("game_id").agg(F.max("poss_seq").alias("__last"))
    found = kn.asof(rows, ends, ["game_id"], "pos", ["poss_seq"], forward=True).join(last, "game_id")
    return found.select("game_id", "event_num", F.coalesce("poss_seq", "__last").alias("poss_seq"))


def constrained_control(handlers: DataFrame, ledger: DataFrame) -> DataFrame:
    """handlers with control_team_id -1 wherever the ledger (t_start_ms, t_end_ms) has another team, or none, in possession (L2.29)."""
    times = offense_at(handlers.select("game_id", "period", F.col("unix_ms").alias("t_ms")), ledger).withColumnsRenamed({"t_ms": "unix_ms", "offense_team_id": "__offense"})
    rows = handlers.join(times, ["game_id", "period", "unix_ms"], "left")
    agreed = F.when(F.col("control_team_id") == F.col("__offense"), F.col("control_team_id")).otherwise(F.lit(-1))
    return rows.withColumn("control_team_id", agreed).select(*handlers.columns)
