"""Second layer: ball handler, touches, flights, passes, stops, dribbles, screens, drives and geometry.

Window expressions over (game, segment) or (game, period) on integer hundredths; no rule reads a game
as a whole in one place.  Distances are compared squared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtframes.operators import kernels as kn
from courtframes.operators.frames import BALL

SEGMENT = ["game_id", "segment_id"]
PERIOD = ["game_id", "period"]
FRAME = ["game_id", "period", "unix_ms"]
# Reach of a handler and height of a held ball, frames of the holding rules at 25 Hz.
REACH_CFT, HELD_Z_CFT = 300, 1000
HOLD, SWITCH = 10, 25
RIM_CFT, RIM_LOW_CFT, RIM_HIGH_CFT = 200, 800, 1150
# Fixed value: changes of handler that are sent to all tasks, about 130 bytes each.
FEW_PAIRS = 2_000_000


def _apart2(ax: str, ay: str, bx: str, by: str) -> Column:
    dx, dy = F.col(ax) - F.col(bx), F.col(ay) - F.col(by)
    return dx * dx + dy * dy


def ball_rows(entities: DataFrame) -> DataFrame:
    return entities.filter(F.col("team_id") == BALL).select(*FRAME, F.col("x_cft").alias("bx"), F.col("y_cft").alias("by"), F.col("z_cft").alias("bz"))


def player_rows(entities: DataFrame) -> DataFrame:
    return entities.filter(F.col("team_id") != BALL).select(*FRAME, "team_id", "player_id", "x_cft", "y_cft")


def nearest_players(entities: DataFrame) -> DataFrame:
    """Per frame with a ball: nearest and second nearest player, and the nearest of each of both teams.

    Rows are dealt by frame once, over tasks by their number; ball, ranks and the result share that dealing.
    """
    frame = Window.partitionBy(*FRAME)
    entities = kn.dealt(entities.select(*FRAME, "team_id", "player_id", "x_cft", "y_cft", "z_cft"), FRAME, entities)
    is_ball = F.col("team_id") == BALL
    ball = [F.max(F.when(is_ball, F.col(c))).over(frame).alias(b) for c, b in (("x_cft", "bx"), ("y_cft", "by"), ("z_cft", "bz"))]
    d = entities.select(*FRAME, "team_id", "player_id", "x_cft", "y_cft", *ball).filter(~is_ball & F.col("bx").isNotNull()).withColumn("d2", _apart2("x_cft", "y_cft", "bx", "by"))
    by_distance = ["d2", "player_id"]
    d = d.select("*", F.row_number().over(frame.orderBy(*by_distance)).alias("n"), F.row_number().over(Window.partitionBy(*FRAME, "team_id").orderBy(*by_distance)).alias("n_team"), F.min("team_id").over(frame).alias("team_a"))
    at = lambda n, c: F.max(F.when(F.col("n") == n, F.col(c)))
    of = lambda own, c: F.max(F.when((F.col("n_team") == 1) & ((F.col("team_id") == F.col("team_a")) == own), F.col(c)))
    return d.groupBy(*FRAME).agg(
        F.max("bz").alias("bz"), at(1, "player_id").alias("near_id"), at(1, "team_id").alias("near_team"), at(1, "d2").alias("near_d2"), at(2, "d2").alias("second_d2"),
        *[of(own, c).alias(f"{name}_{side}") for own, side in ((True, "a"), (False, "b")) for c, name in (("team_id", "team"), ("player_id", "best_id"), ("d2", "best_d2"))],
    )


def ball_frames(entities: DataFrame, index: DataFrame, hand_cft: int) -> DataFrame:
    """One row per frame of the index or with a ball, for `handler` and the search of releases, so that both read one dealing of the players.

    segment_id, has_ball and game_clock_cs of the index, null outside it; `ball` and its place; the columns of `nearest_players`, null without
    players; hands, the players within hand_cft of the ball from the nearest on, and teams.  A frame has one ball row and two teams at most.
    """
    is_ball, place = F.col("team_id") == BALL, lambda c: F.max(F.when(F.col("team_id") == BALL, F.col(c)))
    rows = kn.dealt(entities.select(*FRAME, "team_id", "player_id", "x_cft", "y_cft", "z_cft"), FRAME, entities)
    players = F.collect_list(F.when(~is_ball, F.struct("x_cft", "y_cft", "player_id", "team_id")))
    rows = rows.groupBy(*FRAME).agg(F.max(is_ball).alias("ball"), place("x_cft").alias("bx"), place("y_cft").alias("by"), place("z_cft").alias("bz"), players.alias("players")).filter("ball")

    def away(p: Column) -> Column:
        dx, dy = p["x_cft"] - F.col("bx"), p["y_cft"] - F.col("by")
        return F.struct((dx * dx + dy * dy).alias("d2"), p["player_id"].alias("player_id"), p["team_id"].alias("team_id"))

    rows = rows.withColumn("near", F.when(F.col("bx").isNotNull() & (F.size("players") > 0), F.array_sort(F.transform("players", away)))).withColumn("teams", F.array_distinct(F.transform("near", lambda p: p["team_id"])))
    rows = rows.withColumn("team_a", F.array_min("teams"))
    first = lambda own: F.get(F.filter("near", lambda p: (p["team_id"] == F.col("team_a")) == own), F.lit(0))
    near, second = F.get("near", F.lit(0)), F.get("near", F.lit(1))
    rows = rows.withColumns({"__a": first(True), "__b": first(False), "hands": F.filter("near", lambda p: p["d2"] <= hand_cft * hand_cft)}).select(
        *FRAME, "ball", "bx", "by", "bz", near["player_id"].alias("near_id"), near["team_id"].alias("near_team"), near["d2"].alias("near_d2"), second["d2"].alias("second_d2"),
        *[F.col(f"__{side}.{c}").alias(f"{name}_{side}") for side in ("a", "b") for c, name in (("team_id", "team"), ("player_id", "best_id"), ("d2", "best_d2"))],
        *[F.col(f"hands.{c}").cast("array<bigint>").alias(f"hand_{c}") for c in ("player_id", "team_id")], F.array_compact("teams").cast("array<bigint>").alias("teams"),
    )
    return index.select(*FRAME, "segment_id", "has_ball", "game_clock_cs").join(rows, FRAME, "full")


def handler(entities: DataFrame, index: DataFrame, near: DataFrame | None = None) -> DataFrame:
    """One row per frame of the index: candidate, controlling team and handler; with near, a stored table of `ball_frames`, the ball's place too.

    The candidate is the nearest player within reach of a held ball.  A team takes control by a long run
    of candidates, or by one after a loose ball; the handler is the controlling team's candidate, held
    over short losses.  -1 is nobody.
    """
    held = F.col("has_ball") & (F.col("bz") <= HELD_Z_CFT)
    reach = REACH_CFT * REACH_CFT
    place = [] if near is None else ["bx", "by"]
    if near is None:
        rows = index.select(*FRAME, "segment_id", "has_ball").join(nearest_players(entities), FRAME, "left")
    else:
        rows = near.filter("segment_id is not null").withColumn("bz", F.when(F.col("near_d2").isNotNull(), F.col("bz")))
    close = F.coalesce(held & (F.col("near_d2") <= reach), F.lit(False))
    rows = rows.select(
        *FRAME, "segment_id", "has_ball", "bz", *place, "team_a", "team_b", "best_id_a", "best_id_b", "best_d2_a", "best_d2_b",
        F.when(close, F.col("near_id")).otherwise(-1).alias("cand_id"),
        F.when(close, F.col("near_team")).otherwise(-1).alias("cand_team"),
        F.col("near_d2").alias("cand_d2"),
        (close & F.coalesce(F.col("near_d2") == F.col("second_d2"), F.lit(False))).alias("cand_ambiguous"),
        F.coalesce(held, F.lit(False)).alias("__held"),
    )
    rows = kn.mark_runs(kn.dealt(rows, SEGMENT, index), SEGMENT, ["unix_ms"], ["cand_team"])
    rows = _spread(rows, "cand_team", lambda t: kn.hysteresis(t, SEGMENT, "cand_team", HOLD, SWITCH), "control")
    of_control = lambda c: F.when(F.col("control") == F.col("team_a"), F.col(f"{c}_a")).when(F.col("control") == F.col("team_b"), F.col(f"{c}_b"))
    own = F.coalesce(F.col("__held") & (of_control("best_d2") <= reach), F.lit(False))
    rows = rows.withColumn("__cand", F.when(own, of_control("best_id")).otherwise(-1))
    rows = kn.mark_runs(rows, SEGMENT, ["unix_ms"], ["__cand"])
    rows = _spread(rows, "__cand", lambda t: kn.sticky(t, SEGMENT, "__cand", HOLD), "state")
    return rows.select(*FRAME, "segment_id", "has_ball", "bz", *place, "cand_id", "cand_d2", "cand_ambiguous", F.col("control").alias("control_team_id"), F.col("state").alias("handler_id"))


def _spread(rows: DataFrame, value: str, rule, name: str) -> DataFrame:
    """The result of a rule over runs, on each row of its run.

    A run carries its rows as an array through the rule, so rows are neither planned twice nor joined again.
    """
    own = [c for c in rows.columns if c not in (*SEGMENT, "run_id", value)]
    table = rows.groupBy(*SEGMENT, "run_id").agg(F.first(value).alias(value), F.count("*").alias("n"), F.collect_list(F.struct(*own)).alias("__rows"))
    return rule(table).select(*SEGMENT, value, name, F.explode("__rows").alias("__row")).select(*SEGMENT, value, "__row.*", name)


def touches(handlers: DataFrame) -> DataFrame:
    """Runs of one handler in a segment."""
    table = kn.runs(kn.dealt(handlers, SEGMENT), SEGMENT, "unix_ms", ["handler_id"], F.first("period").alias("period"), F.bool_or("cand_ambiguous").alias("cand_ambiguous"))
    return table.filter("handler_id >= 0").select(*SEGMENT, "period", "handler_id", F.col("t_start").alias("t_start_ms"), F.col("t_end").alias("t_end_ms"), F.col("n").alias("n_frames"), "cand_ambiguous")


def _at_rim(x: str, y: str, z: str) -> Column:
    d = lambda hoop: (F.col(x) - hoop) * (F.col(x) - hoop) + (F.col(y) - 2500) * (F.col(y) - 2500)
    return (F.least(d(525), d(8875)) < RIM_CFT * RIM_CFT) & (F.col(z) > RIM_LOW_CFT) & (F.col(z) < RIM_HIGH_CFT)


def flights(handlers: DataFrame, entities: DataFrame, min_frames: int = 2) -> DataFrame:
    """Stretches of a segment in which the ball is there and nobody is a candidate; handlers may know the ball's place."""
    rows = handlers if "bx" in handlers.columns else kn.dealt(handlers, FRAME).join(ball_rows(entities).drop("bz"), FRAME, "left")
    rows = kn.dealt(rows, SEGMENT, handlers).withColumn("free", F.col("has_ball") & (F.col("cand_id") < 0))
    w = kn.over(SEGMENT, ["unix_ms"])
    step = F.hypot(F.col("bx") - F.lag("bx").over(w), F.col("by") - F.lag("by").over(w))
    receiver = F.when((F.col("cand_id") >= 0) & (F.col("handler_id") >= 0), F.struct("handler_id", "unix_ms"))
    ahead = F.last(receiver, ignorenulls=True).over(kn.over(SEGMENT, [F.desc("unix_ms")]).rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.select(
        "*", F.lag("handler_id").over(w).alias("before"), ahead.alias("ahead"), F.when(F.lag("free").over(w), step).alias("step"),
        F.lead("unix_ms").over(w).isNull().alias("last"), _at_rim("bx", "by", "bz").alias("rim"),
    )
    t = "unix_ms"
    table = kn.runs(
        rows, SEGMENT, t, ["free"], F.first("period").alias("period"), F.min_by("before", t).alias("from_id"), F.max_by("ahead", t).alias("to"),
        F.min_by("bx", t).alias("x_start"), F.min_by("by", t).alias("y_start"), F.max_by("bx", t).alias("x_end"), F.max_by("by", t).alias("y_end"),
        F.max("bz").alias("max_z"), F.coalesce(F.sum("step"), F.lit(0.0)).alias("path_cft"), F.min(F.when(F.col("rim"), F.col(t))).alias("t_rim_ms"), F.max_by("last", t).alias("ends_segment"),
    )
    return table.filter(F.col("free") & (F.col("n") >= min_frames)).select(
        *SEGMENT, "period", F.col("t_start").alias("t_start_ms"), F.col("t_end").alias("t_end_ms"), F.col("n").alias("n_frames"), F.when(F.col("from_id") >= 0, F.col("from_id")).alias("from_id"),
        F.col("to.handler_id").alias("to_id"), F.col("to.unix_ms").alias("t_to_ms"), "x_start", "y_start", "x_end", "y_end", "max_z", "path_cft", F.col("t_rim_ms").isNotNull().alias("reaches_rim"), "t_rim_ms", "ends_segment",
    )


def changes(handlers: DataFrame) -> DataFrame:
    """Changes of handler inside a segment: giver, taker, t_release_ms, t_catch_ms and n_free.

    The giver's last and the taker's first candidate frame bound the change; n_free counts the frames
    between them without a candidate.
    """
    rows = kn.mark_runs(kn.dealt(handlers, SEGMENT), SEGMENT, ["unix_ms"], ["handler_id"], "touch")
    # frames without a candidate are counted along the segment: those between two frames are a difference
    free = F.coalesce(F.col("has_ball") & (F.col("cand_id") < 0), F.lit(False)).cast("long")
    rows = rows.withColumn("upto", F.sum(free).over(kn.over(SEGMENT, ["unix_ms"]).rowsBetween(Window.unboundedPreceding, 0))).withColumn("until", F.col("upto") - free)
    is_mine = F.col("cand_id") == F.col("handler_id")
    mine = F.when(is_mine, F.col("unix_ms"))
    table = rows.filter("handler_id >= 0").groupBy(*SEGMENT, "touch", "handler_id").agg(
        F.first("period").alias("period"), F.min("unix_ms").alias("t0"), F.max("unix_ms").alias("t1"), F.max(mine).alias("mine_last"), F.min(mine).alias("mine_first"),
        F.coalesce(F.max(F.when(is_mine, F.col("until"))), F.max("until")).alias("until"), F.coalesce(F.min(F.when(is_mine, F.col("upto"))), F.min("upto")).alias("upto"),
    )
    w = kn.over(SEGMENT, ["touch"])
    nxt = lambda c: F.lead(c).over(w)
    return table.select(
        *SEGMENT, "period", F.col("handler_id").alias("giver"), nxt("handler_id").alias("taker"), F.coalesce("mine_last", "t1").alias("t_release_ms"), F.coalesce(nxt("mine_first"), nxt("t0")).alias("t_catch_ms"), (nxt("upto") - F.col("until")).alias("n_free")
    ).filter(F.col("taker").isNotNull() & (F.col("giver") != F.col("taker")))


def transfers(handlers: DataFrame, entities: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Changes of handler inside a segment: a pass after a flight, a handoff at close quarters.

    Kind: pass with at least two frames without a candidate between (n_free), else handoff when both stand within
    3 ft at the catch, ambiguous within 5 ft, strip beyond.  pairs: the table of `changes`, stored.  It has a row in dozens of frames, so
    while its rows are few it goes to the players; beyond, and where it is not given, players are dealt.
    """
    few = pairs is not None and pairs.count() <= FEW_PAIRS
    pairs = changes(handlers) if pairs is None else pairs
    # both players' places are read from one pass over the players, or one dealing by frame
    at = [*PERIOD, "t_catch_ms"]
    players, asked = player_rows(entities).withColumnRenamed("unix_ms", "t_catch_ms"), pairs.select(*at, "giver", "taker")
    there = (players.join(F.broadcast(asked), at) if few else kn.dealt(players, at, entities).join(asked, at)).filter("player_id = giver or player_id = taker")
    place = lambda who, x: F.max(F.when(F.col("player_id") == F.col(who), F.struct(F.col("x_cft").alias("x"), F.col("y_cft").alias("y"), "team_id"))).alias(x)
    places = there.groupBy(*at, "giver", "taker").agg(place("giver", "g"), place("taker", "t"))
    out = pairs.join(places, [*at, "giver", "taker"], "left").withColumn("d2", _apart2("g.x", "g.y", "t.x", "t.y"))
    kind = F.when(F.col("n_free") >= 2, "pass").when(F.col("d2") <= 300 * 300, "handoff").when(F.col("d2") <= 500 * 500, "ambiguous").otherwise("strip")
    return out.select(*SEGMENT, "period", "giver", "taker", "t_release_ms", "t_catch_ms", "n_free", "d2", kind.alias("kind"), (F.col("g.team_id") == F.col("t.team_id")).alias("same_team"))


def clock_stops(index: DataFrame, min_ms: int = 200, micro_ms: int = 1000) -> DataFrame:
    """Runs of a frozen clock in a period, also across holes, with the onset estimated before holes."""
    w = kn.over(PERIOD, ["unix_ms"])
    lag = lambda c, k: F.lag(c, k).over(w)
    rows = index.select(
        *PERIOD, "unix_ms", "game_clock_cs", "clock_frozen", lag("unix_ms", 1).alias("k_t"), lag("gap", 1).alias("k_gap"), lag("unix_ms", 2).alias("r_t"), lag("gap", 2).alias("r_gap"),
        lag("clock_frozen", 2).alias("r_frozen"), lag("game_clock_cs", 2).alias("r_clock"), F.lead("unix_ms").over(w).alias("after_t"), F.lead("dt_ms").over(w).alias("after_dt"),
    )
    first = lambda c: F.min_by(c, "unix_ms").alias(c)
    table = kn.runs(
        rows, PERIOD, "unix_ms", ["clock_frozen"], *[first(c) for c in ("game_clock_cs", "k_t", "k_gap", "r_t", "r_gap", "r_frozen", "r_clock")],
        F.max_by("after_t", "unix_ms").alias("t_end_ms"), F.max_by("after_dt", "unix_ms").alias("after_dt"),
    )
    left = F.greatest(F.lit(0), F.col("r_clock") - F.col("game_clock_cs"))
    exact = ~F.col("k_gap") & ~F.col("r_gap") & ~F.col("r_frozen")
    out = table.filter(F.col("clock_frozen") & F.col("r_t").isNotNull()).withColumn("clock_left_cs", left).withColumn("onset_exact", exact)
    out = out.withColumn("t_onset_ms", F.when(F.col("onset_exact"), F.col("k_t")).otherwise(F.least("k_t", F.col("r_t") + 10 * F.col("clock_left_cs"))))
    out = out.withColumn("duration_ms", F.col("t_end") - F.col("t_onset_ms")).filter(F.col("duration_ms") >= min_ms)
    return out.select(
        *PERIOD, F.col("r_t").alias("t_last_running_ms"), "clock_left_cs", "t_onset_ms", "onset_exact", F.col("k_t").alias("t_start_ms"), "t_end_ms", "game_clock_cs", "duration_ms",
        (F.col("n") + 1).alias("n_frozen_frames"), (F.col("duration_ms") < micro_ms).alias("micro_freeze"), F.coalesce(F.col("after_dt") > 60, F.lit(False)).alias("ends_at_gap"),
    )


def stop_coverage(stops: DataFrame, index: DataFrame, pre_ms: int = 3000) -> DataFrame:
    """Frames, complete frames and frames with a ball in the time before each stop."""
    spans = stops.select(*PERIOD, "t_onset_ms", (F.col("t_onset_ms") - pre_ms).alias("lo"), (F.col("t_onset_ms") - 1).alias("hi"))
    inside = kn.range_join(index.select(*FRAME, "has_ball", "n_players"), spans, PERIOD, "unix_ms", "lo", "hi", 4000)
    return inside.groupBy(*PERIOD, "t_onset_ms").agg(F.count("*").alias("n_frames"), F.count_if(F.col("has_ball") & (F.col("n_players") == 10)).alias("n_full"), F.count_if("has_ball").alias("n_ball"))


def dribbles(handlers: DataFrame, entities: DataFrame, floor_cft: int = 100, prominence_cft: int = 100, half: int = 8, gap_ms: int = 200, reach_cft: int = 400) -> DataFrame:
    """Bounces in a touch: low local minima of the ball's height that stand out on both sides, with the
    ball falling before and rising after, near the handler, and each at least gap_ms after the last."""
    rows = kn.mark_runs(handlers, SEGMENT, ["unix_ms"], ["handler_id"], "touch").filter("handler_id >= 0")
    me = player_rows(entities).select(*FRAME, F.col("player_id").alias("handler_id"), "x_cft", "y_cft")
    rows = rows.join(ball_rows(entities).drop("bz"), FRAME, "left").join(me, [*FRAME, "handler_id"], "left")
    keys = [*SEGMENT, "touch"]
    w = kn.over(keys, ["unix_ms"])
    z, to = F.col("bz"), lambda k: F.lead("bz", k).over(w)
    falling = (F.lag("bz", 2).over(w) > z) & (to(2) > z)
    low = kn.minima(rows.withColumn("__turn", falling), keys, ["unix_ms"], "bz", half, prominence_cft)
    near = _apart2("x_cft", "y_cft", "bx", "by") <= reach_cft * reach_cft
    low = low.filter((F.col("bz") <= floor_cft) & F.col("__turn") & near)
    return kn.thin(low, keys, "unix_ms", gap_ms).select(*SEGMENT, "period", "handler_id", F.col("unix_ms").alias("t_bounce_ms"), F.col("bz").alias("z_cft"), "prominence")


def shared_places(entities: DataFrame) -> DataFrame:
    """Players whose exact place another player of the frame shares."""
    n = F.count("*").over(Window.partitionBy(*FRAME, "x_cft", "y_cft"))
    return player_rows(entities).withColumn("n", n).filter("n > 1").select(*FRAME, "player_id")


def pair_distances(entities: DataFrame) -> DataFrame:
    """Squared distance of opponents in a frame, null where either shares its place."""
    n = F.count("*").over(Window.partitionBy(*FRAME, "x_cft", "y_cft"))
    players = player_rows(entities).withColumn("shared", n > 1)
    a = players.select(*FRAME, F.col("team_id").alias("team_a"), F.col("player_id").alias("id_a"), F.col("x_cft").alias("ax"), F.col("y_cft").alias("ay"), F.col("shared").alias("sa"))
    b = players.select(*FRAME, F.col("team_id").alias("team_b"), F.col("player_id").alias("id_b"), F.col("x_cft").alias("bx"), F.col("y_cft").alias("by"), F.col("shared").alias("sb"))
    both = a.join(b, FRAME).filter("team_a < team_b")
    shared = F.col("sa") | F.col("sb")
    return both.select(*FRAME, "id_a", "id_b", F.when(~shared, _apart2("ax", "ay", "bx", "by")).alias("d2"), shared.alias("xy_shared"))


def ball_distances(entities: DataFrame) -> DataFrame:
    """Squared distance of each player to the ball, null where the player's place is shared."""
    n = F.count("*").over(Window.partitionBy(*FRAME, "x_cft", "y_cft"))
    players = player_rows(entities).withColumn("shared", n > 1).join(ball_rows(entities), FRAME)
    return players.select(*FRAME, "team_id", "player_id", F.when(~F.col("shared"), _apart2("x_cft", "y_cft", "bx", "by")).alias("d2"))


def player_speeds(entities: DataFrame, frames: int = 5) -> DataFrame:
    """Speed in hundredths of a foot per second from smoothed places; null beside holes."""
    return _with_speed(entities, frames).select(*FRAME, "player_id", "speed")


def _with_speed(entities: DataFrame, frames: int = 5) -> DataFrame:
    keys = ["game_id", "player_id", "period"]
    rows = kn.dealt(player_rows(entities), keys, entities)
    for c in ("x_cft", "y_cft"):
        rows = kn.smooth(rows, keys, ["unix_ms"], c, frames)
    return kn.central_speed(rows, keys, "unix_ms", "x_cft_smooth", "y_cft_smooth", 60).drop("x_cft_smooth", "y_cft_smooth")


def snapshots(entities: DataFrame, moments: DataFrame) -> DataFrame:
    """For each asked frame the sorted player ids, their squared ball distances and all pair distances
    of the two teams row by row, as arrays."""
    asked = moments.select(*FRAME).distinct()
    players = player_rows(entities).join(asked, FRAME).join(ball_rows(entities), FRAME, "left")
    one = F.struct("player_id", "team_id", "x_cft", "y_cft", _apart2("x_cft", "y_cft", "bx", "by").alias("d2"))
    rows = players.groupBy(*FRAME).agg(F.array_sort(F.collect_list(one)).alias("p"), F.min("team_id").alias("first"))
    mine, theirs = F.filter("p", lambda q: q["team_id"] == F.col("first")), F.filter("p", lambda q: q["team_id"] != F.col("first"))
    sq = lambda a, b: (a["x_cft"] - b["x_cft"]) * (a["x_cft"] - b["x_cft"]) + (a["y_cft"] - b["y_cft"]) * (a["y_cft"] - b["y_cft"])
    pairs = F.flatten(F.transform(mine, lambda a: F.transform(theirs, lambda b: sq(a, b))))
    text = lambda c: F.array_join(c.cast("array<string>"), ",")
    return rows.select(*FRAME, text(F.transform("p", lambda q: q["player_id"])).alias("ids"), text(F.transform("p", lambda q: q["d2"])).alias("ball_d2"), text(pairs).alias("pair_d2"))


def approaches(entities: DataFrame, handlers: DataFrame, direction: DataFrame, speed_cft: int = 500, frames: int = 8) -> DataFrame:
    """Drives and cuts: runs of frames in which a player of the controlling team nears the attacked hoop
    faster than speed_cft per second; a drive when the player is the handler at its start."""
    keys = ["game_id", "player_id", "period"]
    side = direction.select("game_id", "team_id", "period", "attacks_left")
    # handlers come to the players first, so that rates and runs share one dealing by player; a frame without handler counts for rates alone
    state = handlers.select(*FRAME, "segment_id", "handler_id", "control_team_id", F.lit(True).alias("known"))
    rows = kn.dealt(player_rows(entities), FRAME, entities).join(state, FRAME, "left").join(side, ["game_id", "team_id", "period"], "left")
    hoop = F.when(F.coalesce("attacks_left", F.lit(True)), 525).otherwise(8875)
    rows = rows.select(
        *FRAME, "player_id", "segment_id", "known", F.hypot(F.col("x_cft") - hoop, F.col("y_cft") - 2500).alias("dist"),
        (F.col("control_team_id") == F.col("team_id")).alias("attacks"), (F.col("handler_id") == F.col("player_id")).alias("has_it"),
    )
    w = kn.over(keys, ["unix_ms"])
    rate = -(F.lead("dist").over(w) - F.lag("dist").over(w)) / ((F.lead("unix_ms").over(w) - F.lag("unix_ms").over(w)) / 1000)
    rows = kn.dealt(rows, keys, entities).withColumn("rate", rate).filter("known")
    rows = rows.withColumn("nears", F.coalesce(F.col("rate") > speed_cft, F.lit(False)) & F.col("attacks"))
    table = kn.runs(rows, [*keys, "segment_id"], "unix_ms", ["nears"], F.min_by("has_it", "unix_ms").alias("has_it"), F.min_by("dist", "unix_ms").alias("d0"), F.max_by("dist", "unix_ms").alias("d1"))
    kept = table.filter(F.col("nears") & (F.col("n") >= frames) & (~F.col("has_it") | (F.col("d0") >= 1000)))
    return kept.select("game_id", "period", "segment_id", "player_id", F.col("t_start").alias("t_start_ms"), F.col("t_end").alias("t_end_ms"), F.col("n").alias("n_frames"), F.when(F.col("has_it"), "drive").otherwise("cut").alias("kind"))


def screens(entities: DataFrame, handlers: DataFrame, slow_cft: int = 600, near_cft: int = 600, user_cft: int = 800, frames: int = 5) -> DataFrame:
    """Set screens: a slow player of the team in control, other than the handler, stands within near_cft of
    the nearest opponent of a team-mate within user_cft, for at least `frames` frames of a segment."""
    return screen_runs(screen_pairs(entities, handlers, slow_cft, near_cft, user_cft), slow_cft, frames)


def screen_pairs(entities: DataFrame, handlers: DataFrame, slow_cft: int = 600, near_cft: int = 600, user_cft: int = 800) -> DataFrame:
    """Frames in which a player s stands as in a screen for u by u's nearest opponent d, with the speed of s and the squared distance of s and d.

    A frame's players are one list, so screener, user and opponents meet in it without joins.
    """
    one = F.struct("team_id", "player_id", "x_cft", "y_cft", "speed")
    people = kn.dealt(_with_speed(entities), FRAME, entities).groupBy(*FRAME).agg(F.collect_list(one).alias("people"))
    control = handlers.filter("control_team_id >= 0").select(*FRAME, "segment_id", "handler_id", F.col("control_team_id").alias("team_id"))
    rows = people.join(control, FRAME)
    apart2 = lambda a, b: (a["x_cft"] - b["x_cft"]) * (a["x_cft"] - b["x_cft"]) + (a["y_cft"] - b["y_cft"]) * (a["y_cft"] - b["y_cft"])
    own = F.filter("people", lambda p: p["team_id"] == F.col("team_id"))
    screener = F.filter("own", lambda p: (p["speed"] < slow_cft) & (p["player_id"] != F.col("handler_id")))
    rows = rows.withColumns({"own": own, "foes": F.filter("people", lambda p: p["team_id"] != F.col("team_id"))}).drop("people")
    rows = rows.withColumn("ps", F.explode(screener))
    rows = rows.withColumn("pu", F.explode(F.filter("own", lambda p: (p["player_id"] != F.col("ps.player_id")) & (apart2(F.col("ps"), p) <= user_cft * user_cft))))
    foe = F.array_min(F.transform("foes", lambda p: F.struct(apart2(F.col("pu"), p).alias("d2"), p["player_id"].alias("d"), apart2(F.col("ps"), p).alias("sd2"))))
    near = rows.select(*FRAME, "segment_id", F.col("ps.player_id").alias("s"), F.col("pu.player_id").alias("u"), F.col("ps.speed").alias("speed"), foe.alias("f"))
    return near.filter(F.col("f.sd2") <= near_cft * near_cft).select(*FRAME, "segment_id", "s", "u", "f.d", "f.sd2", "speed")


def screen_runs(pairs: DataFrame, slow_cft: int = 600, frames: int = 5) -> DataFrame:
    """Stretches of the pairs whose screener is slower than slow_cft, of at least `frames` frames."""
    near = pairs.filter(F.col("speed") < slow_cft)
    keys = ["game_id", "segment_id", "s", "u", "d"]
    w = kn.over(keys, ["unix_ms"])
    starts = F.lag("unix_ms").over(w).isNull() | (F.col("unix_ms") - F.lag("unix_ms").over(w) > 60)
    marked = kn.segment(near.withColumn("__new", starts), keys, ["unix_ms"], F.col("__new"), "run_id")
    out = marked.groupBy(*keys, "run_id").agg(F.first("period").alias("period"), F.min("unix_ms").alias("t_start_ms"), F.max("unix_ms").alias("t_end_ms"), F.count("*").alias("n_frames"), F.min_by("unix_ms", F.struct("sd2", "unix_ms")).alias("t_contact_ms"))
    return out.filter(F.col("n_frames") >= frames).drop("run_id")


def postups(entities: DataFrame, handlers: DataFrame, direction: DataFrame, frames: int = 25) -> DataFrame:
    """Runs in which the handler is slow, within 18 ft of the attacked hoop and has an opponent within 4 ft.

    The defender is the most frequent nearest opponent of the run, the least id of equals.
    """
    # the handler is laid beside all players of the frame, which are dealt by frame once
    held = handlers.filter("handler_id <> -1").select(*FRAME, "segment_id", F.col("handler_id").alias("holder"))
    rows = kn.dealt(player_rows(entities), FRAME, entities).join(held, FRAME)
    own = F.struct("team_id", "x_cft", "y_cft")
    rows = rows.withColumn("me", F.max(F.when(F.col("player_id") == F.col("holder"), own)).over(Window.partitionBy(*FRAME))).filter(F.col("me.team_id") != F.col("team_id"))
    near = rows.groupBy(*FRAME, "segment_id", F.col("holder").alias("player_id"), F.col("me.team_id").alias("team_id"), F.col("me.x_cft").alias("mx"), F.col("me.y_cft").alias("my")).agg(
        F.min(F.struct(_apart2("me.x_cft", "me.y_cft", "x_cft", "y_cft").alias("d2"), F.col("player_id").alias("foe"))).alias("f")
    )
    near = near.filter(F.col("f.d2") <= 400 * 400).join(direction.select("game_id", "team_id", "period", "attacks_left"), ["game_id", "team_id", "period"], "left")
    hoop = F.when(F.coalesce("attacks_left", F.lit(True)), 525).otherwise(8875)
    near = near.filter((F.col("mx") - hoop) * (F.col("mx") - hoop) + (F.col("my") - 2500) * (F.col("my") - 2500) <= 1800 * 1800)
    near = near.join(player_speeds(entities).filter("speed < 400"), [*FRAME, "player_id"])
    keys = ["game_id", "segment_id", "player_id"]
    gap = F.col("unix_ms") - F.lag("unix_ms").over(kn.over(keys, ["unix_ms"]))
    marked = kn.segment(near.withColumn("__new", gap.isNull() | (gap > 60)), keys, ["unix_ms"], F.col("__new"), "run_id")
    out = marked.groupBy(*keys, "run_id").agg(F.first("period").alias("period"), F.min("unix_ms").alias("t_start_ms"), F.max("unix_ms").alias("t_end_ms"), F.count("*").alias("n_frames"), F.mode(F.col("f.foe"), True).alias("defender_id"))
    return out.filter(F.col("n_frames") >= frames).drop("run_id")


def screen_score(features: dict[str, Column], weights: dict[str, float], bias: float) -> Column:
    """Logistic score of a weighted sum of features."""
    total = F.lit(bias)
    for name, w in weights.items():
        total = total + w * features[name]
    return 1 / (1 + F.exp(-total))


def mark_dead_ball(moves: DataFrame, index: DataFrame, wait_ms: int = 1000) -> DataFrame:
    """Transfers after whose catch (or release, without one) the clock still stands wait_ms later."""
    clock = index.select(*FRAME, "game_clock_cs")
    rows = moves.withColumn("unix_ms", F.coalesce("t_catch_ms", "t_release_ms"))
    rows = kn.asof(rows, clock, PERIOD, "unix_ms", ["game_clock_cs"]).drop("match_unix_ms").withColumnRenamed("game_clock_cs", "__g0")
    rows = kn.asof(rows.withColumn("unix_ms", F.col("unix_ms") + wait_ms), clock, PERIOD, "unix_ms", ["game_clock_cs"])
    stands = F.coalesce(F.abs(F.col("game_clock_cs") - F.col("__g0")) < 1, F.lit(False))
    return rows.select(*moves.columns, stands.alias("dead_ball"))


def mark_after_made(moves: DataFrame, made: DataFrame, holders: DataFrame, most_ms: int = 10_000) -> DataFrame:
    """Transfers by the scoring team from a made basket until the other team first holds the ball.

    moves and made carry team_id, made its time t_ms, holders one row per held frame with its team_id.
    """
    teams = holders.select("game_id", "team_id").distinct()
    rival = made.join(teams.withColumnRenamed("team_id", "__rival"), "game_id").filter("team_id <> __rival")
    rival = rival.select("game_id", "period", F.col("__rival").alias("team_id"), F.col("team_id").alias("scorer"), F.col("t_ms").alias("t0"), (F.col("t_ms") + 1).alias("unix_ms"))
    taken = kn.asof(rival, holders.select(*FRAME, "team_id").distinct().withColumn("__held", F.lit(True)), [*PERIOD, "team_id"], "unix_ms", ["__held"], forward=True)
    spans = taken.groupBy(*PERIOD, "scorer", "t0").agg(F.least(F.min("match_unix_ms"), F.col("t0") + most_ms).alias("__end"))
    spans = spans.select(*PERIOD, F.col("scorer").alias("team_id"), "t0", "__end")
    keys = [*PERIOD, "team_id", "t_release_ms"]
    hit = kn.range_join(moves.select(*keys).distinct(), spans, [*PERIOD, "team_id"], "t_release_ms", "t0", "__end", most_ms, closed=False).select(*keys).distinct()
    return moves.join(hit.withColumn("__hit", F.lit(True)), keys, "left").select(*moves.columns, F.coalesce("__hit", F.lit(False)).alias("after_made_fg"))


def mark_is_shot(moves: DataFrame, shots: DataFrame, within_ms: int = 200) -> DataFrame:
    """Transfers whose giver shoots (player_id, t_ms) within the given time of the release."""
    near = shots.select("game_id", "period", F.col("player_id").alias("giver"), F.col("t_ms").alias("__t")).distinct()
    near = near.withColumn("__lo", F.col("__t") - within_ms).withColumn("__hi", F.col("__t") + within_ms)
    keys = [*PERIOD, "giver", "t_release_ms"]
    hit = kn.range_join(moves.select(*keys).distinct(), near, [*PERIOD, "giver"], "t_release_ms", "__lo", "__hi", 4 * within_ms).select(*keys).distinct()
    return moves.join(hit.withColumn("__hit", F.lit(True)), keys, "left").select(*moves.columns, F.coalesce("__hit", F.lit(False)).alias("is_shot"))


def half_runs(places: DataFrame, min_ms: int = 400) -> DataFrame:
    """Runs of front and back court of the ball in a period (front: boolean column); short ones join the run before."""
    table = kn.runs(places, PERIOD, "unix_ms", ["front"])
    return kn.merge_runs(table, PERIOD, "front", min_ms)


def group_screens(found: DataFrame, width_ms: int = 1000) -> DataFrame:
    """Screens of one screener and defender within width_ms of a group's first share dup_start, those of one
    screener share group_start."""
    one = kn.anchored_groups(found, ["game_id", "period", "s", "d"], "t_start_ms", width_ms, "dup_start")
    return kn.anchored_groups(one, ["game_id", "period", "s"], "t_start_ms", width_ms, "group_start")


def stop_causes(stops: DataFrame, rows: DataFrame, within_ms: int = 2000) -> DataFrame:
    """Each stop with the first in rank of the play-by-play rows (t_ms, msg_type) near its onset."""
    # Rank of causes.
    ranks = {6: "foul", 7: "violation", 5: "turnover", 10: "jump_ball", 9: "timeout", 18: "replay", 11: "ejection"}
    order = F.create_map(*[F.lit(x) for i, k in enumerate(ranks) for x in (k, i)])
    names = F.array(*[F.lit(n) for n in ranks.values()])
    spans = stops.select(*PERIOD, "t_onset_ms", (F.col("t_onset_ms") - within_ms).alias("__lo"), (F.col("t_onset_ms") + within_ms).alias("__hi"))
    known = rows.filter(F.col("msg_type").isin(list(ranks))).select(*PERIOD, "t_ms", order[F.col("msg_type")].alias("__rank"))
    best = kn.range_join(known, spans, PERIOD, "t_ms", "__lo", "__hi", 2 * within_ms).groupBy(*PERIOD, "t_onset_ms").agg(F.min("__rank").alias("__rank"))
    return stops.join(best, [*PERIOD, "t_onset_ms"], "left").select(*stops.columns, F.coalesce(F.get(names, F.col("__rank")), F.lit("unknown")).alias("cause"))


def incomplete_passes(found: DataFrame, handlers: DataFrame) -> DataFrame:
    """Flights from a handler to nobody in the segment that miss the rim, with the giver's last candidate
    frame as release; flights of one giver and release count once, the first."""
    lost = found.filter(F.col("from_id").isNotNull() & F.col("to_id").isNull() & ~F.col("reaches_rim"))
    lost = lost.select(*SEGMENT, "period", F.col("from_id").alias("giver"), F.col("t_start_ms").alias("unix_ms"), "t_end_ms", "ends_segment")
    mine = handlers.filter("cand_id >= 0").select(*SEGMENT, F.col("cand_id").alias("giver"), "unix_ms", F.lit(True).alias("__c"))
    rows = kn.asof(lost, mine, [*SEGMENT, "giver"], "unix_ms", ["__c"], of=handlers).withColumn("t_release_ms", F.coalesce("match_unix_ms", "unix_ms"))
    first = F.min_by(F.struct("period", F.col("unix_ms").alias("t_start_ms"), "t_end_ms", "ends_segment"), "unix_ms").alias("f")
    return rows.groupBy(*SEGMENT, "giver", "t_release_ms").agg(first).select(*SEGMENT, "giver", "t_release_ms", "f.*")


def shot_windows(found: DataFrame, held: DataFrame, frames: int = HOLD) -> DataFrame:
    """From a flight that reaches the rim to the next touch of the segment that lasts `frames`, else its end."""
    rim = found.filter("reaches_rim").select(*SEGMENT, "period", "t_start_ms", "t_end_ms", (F.col("t_end_ms") + 1).alias("unix_ms"))
    firm = held.filter(F.col("n_frames") >= frames).select(*SEGMENT, F.col("t_start_ms").alias("unix_ms"), F.lit(True).alias("__h"))
    rows = kn.asof(rim, firm, SEGMENT, "unix_ms", ["__h"], forward=True)
    return rows.select(*SEGMENT, "period", F.col("t_start_ms").alias("t_from_ms"), F.coalesce("match_unix_ms", "t_end_ms").alias("t_to_ms"))
