"""Even grids over windows of play: places, velocities, clocks, handler and distances at every step (M5, M7-M9), and the handler inside a window (L2.2).

A window is a row with game_id, period, window, t_start_ms, t_end_ms, attacks_left, offense_ids and defense_ids.  Samples meet windows once, by
a range join; then each sample writes the steps up to the next one of its channel, so no grid is joined with samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtframes.operators import kernels as kn
from courtframes.operators.events import BALL, FRAME, HELD_Z_CFT, HOLD, PERIOD, REACH_CFT, ball_rows, player_rows

# Length of a grid in s, how far samples beyond a window count, in ms, for places and for states; the court in hundredths of a foot.
MOST_S = 24.0
PLACE_SLACK_MS, STATE_SLACK_MS = 200, 1000
LENGTH_CFT, WIDTH_CFT = 9400, 5000
BUCKET_MS = 4000
WINDOW = [*PERIOD, "window"]
CHANNEL = [*WINDOW, "role", "slot"]


def _near_windows(samples: DataFrame, windows: DataFrame, slack: int, *more: str) -> DataFrame:
    """samples in each window or within `slack` of it, with its start, end and the columns named."""
    spans = windows.select(*WINDOW, F.col("t_start_ms").alias("t0"), F.col("t_end_ms").alias("t1"), *more)
    spans = spans.withColumns({"__lo": F.col("t0") - slack, "__hi": F.col("t1") + slack})
    return kn.range_join(samples, spans, PERIOD, "unix_ms", "__lo", "__hi", BUCKET_MS).drop("__lo", "__hi")


def _steps(samples: DataFrame, keys: list[str], values: list[str], hz: int, n_steps: int) -> DataFrame:
    """One row per key and step: step, t_step (its moment, the window's end beyond that), valid, and the samples around it, __a and __b.

    __a is the last sample at or before the moment and __b the first behind it; before the first sample __a is that one, and behind the last __b is null.
    """
    w = kn.over(keys, ["unix_ms"])
    me = F.struct("unix_ms", *values)
    rows = samples.select(*keys, "t0", "t1", me.alias("__a"), F.lead(me).over(w).alias("__b"), F.lag("unix_ms").over(w).isNull().alias("__first"), "unix_ms")
    nth = lambda t: F.ceil((t - F.col("t0")) * hz / 1000)  # noqa: E731  first step at or after t
    last = F.least(F.floor((F.col("t1") - F.col("t0")) * hz / 1000), F.lit(n_steps - 1))
    lo = F.when(F.col("__first"), 0).otherwise(F.greatest(F.lit(0), nth(F.col("__a.unix_ms"))))
    hi = F.when(F.col("__b").isNull(), last).otherwise(F.least(last, nth(F.col("__b.unix_ms")) - 1))
    begins, ends = F.col("__first") | (F.col("__a.unix_ms") <= F.col("t1")), F.col("__b").isNull() | (F.col("t1") < F.col("__b.unix_ms"))
    none = F.array().cast("array<bigint>")
    own = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(none)
    behind = F.when(begins & ends & (last < n_steps - 1), F.sequence(last + 1, F.lit(n_steps - 1).cast("long"))).otherwise(none)
    laid = rows.withColumn("__last", last).withColumn("step", F.explode(F.concat(own, behind)))
    valid = F.col("step") <= F.col("__last")
    return laid.withColumn("valid", valid).withColumn("t_step", F.when(valid, F.col("t0") + F.col("step") * 1000 / F.lit(hz)).otherwise(F.col("t1").cast("double")))


def _line(c: str) -> Column:
    """The channel's value on the line between both samples, held before the first and behind the last."""
    a, b, t = F.col("__a"), F.col("__b"), F.col("t_step")
    inside = b.isNotNull() & (t >= a["unix_ms"])
    return F.when(inside, a[c] + (b[c] - a[c]) * ((t - a["unix_ms"]) / (b["unix_ms"] - a["unix_ms"]))).otherwise(a[c].cast("double"))


def _nearest(c: str) -> Column:
    """The value of the nearer sample, of equally near ones the earlier."""
    a, b, t = F.col("__a"), F.col("__b"), F.col("t_step")
    return F.when(b.isNull() | (t - a["unix_ms"] <= b["unix_ms"] - t), a[c]).otherwise(b[c])


def grid_size(hz: int, after_ms: int = 0, most_s: float = MOST_S) -> int:
    return round((most_s + after_ms / 1000) * hz) + 1


def grid_entities(windows: DataFrame, entities: DataFrame, hz: int = 5, n_steps: int | None = None, flip_to_left: bool = True, after_ms: int = 0) -> DataFrame:
    """Eleven rows per window and step: role (ball, off, def), slot by player id, place and velocity a second (M7).

    Steps begin at t_start_ms; those behind t_end_ms + after_ms are not valid and hold the place at that end, with no velocity.  With
    `flip_to_left` the court is turned where the attack goes right.  A player or ball without a row in or near the window has no rows here.
    """
    n_steps = n_steps or grid_size(hz, after_ms)
    windows = windows.withColumn("t_end_ms", F.col("t_end_ms") + after_ms).withColumns({"__off": F.array_sort("offense_ids"), "__def": F.array_sort("defense_ids")})
    near = _near_windows(entities.select(*FRAME, "team_id", "player_id", "x_cft", "y_cft", "z_cft"), windows, PLACE_SLACK_MS, "attacks_left", "__off", "__def")
    is_ball = F.col("team_id") == BALL
    at = lambda c: F.array_position(c, F.col("player_id"))
    role = F.when(is_ball, "ball").when(at("__off") > 0, "off").when(at("__def") > 0, "def")
    slot = F.when(is_ball, 0).otherwise(F.greatest(at("__off"), at("__def")) - 1).cast("int")
    near = near.withColumns({"role": role, "slot": slot}).filter("role is not null")
    if flip_to_left:
        near = near.withColumns({"x_cft": F.when(F.col("attacks_left"), F.col("x_cft")).otherwise(LENGTH_CFT - F.col("x_cft")), "y_cft": F.when(F.col("attacks_left"), F.col("y_cft")).otherwise(WIDTH_CFT - F.col("y_cft"))})
    rows = _steps(near, CHANNEL, ["player_id", "x_cft", "y_cft", "z_cft"], hz, n_steps)
    rows = rows.select(*CHANNEL, "step", "valid", (F.col("t0") + F.floor(F.col("step") * 1000 / F.lit(hz))).alias("t_ms"), F.col("__a.player_id").alias("player_id"), *[_line(c).alias(c) for c in ("x_cft", "y_cft", "z_cft")])
    w = kn.over(CHANNEL, ["step"])
    dt = 1 / hz

    def velocity(c: str) -> Column:
        there = F.when(F.lead("valid").over(w), F.lead(c).over(w))
        back, here = F.lag(c).over(w), F.col(c)
        v = F.when(there.isNotNull() & back.isNotNull(), (there - back) / (2 * dt)).when(there.isNotNull(), (there - here) / dt).when(back.isNotNull(), (here - back) / dt)
        return F.coalesce(F.when(F.col("valid"), v), F.lit(0.0))

    return rows.withColumns({"vx": velocity("x_cft"), "vy": velocity("y_cft")})


def grid_clocks(windows: DataFrame, index: DataFrame, hz: int = 5, n_steps: int | None = None, after_ms: int = 0) -> DataFrame:
    """Game and shot clock per window and step, on the line between frames (M7).

    The shot clock is null where the first frame at or behind the step shows none, or where fewer than two frames of the window do.
    """
    n_steps = n_steps or grid_size(hz, after_ms)
    windows = windows.withColumn("t_end_ms", F.col("t_end_ms") + after_ms)
    near = _near_windows(index.select(*FRAME, "game_clock_cs", "shot_clock_cs"), windows, PLACE_SLACK_MS)
    near = near.withColumn("shown", F.col("shot_clock_cs").isNotNull())
    rows = _steps(near, WINDOW, ["game_clock_cs", "shown"], hz, n_steps)
    ahead = F.when(F.col("__b").isNull() | (F.col("t_step") <= F.col("__a.unix_ms")), F.col("__a.shown")).otherwise(F.col("__b.shown"))
    clock = rows.select(*WINDOW, "step", _line("game_clock_cs").alias("game_clock_cs"), ahead.alias("__shown"))
    some = near.filter("shown").withColumn("__n", F.count("*").over(Window.partitionBy(*WINDOW))).filter("__n >= 2")
    shot = _steps(some, WINDOW, ["shot_clock_cs"], hz, n_steps).select(*WINDOW, "step", _line("shot_clock_cs").alias("__shot"))
    return clock.join(shot, [*WINDOW, "step"], "left").select(*WINDOW, "step", "game_clock_cs", F.when(F.col("__shown"), F.col("__shot")).alias("shot_clock_cs"))


def grid_states(windows: DataFrame, handlers: DataFrame, filled: DataFrame | None = None, hz: int = 5, n_steps: int | None = None, after_ms: int = 0) -> DataFrame:
    """handler_slot, ball_in_flight and the filled shot clock at the frame nearest to each step (M8).

    handler_slot is the handler's place among the attacking five, at the nearest frame of the window with a ball; -1 for nobody, the defence and steps behind the end.
    """
    n_steps = n_steps or grid_size(hz, after_ms)
    windows = windows.withColumn("t_end_ms", F.col("t_end_ms") + after_ms).withColumn("__off", F.array_sort("offense_ids"))
    names = []
    held = handlers.select(*FRAME, "has_ball", "handler_id", "cand_id")
    if filled is not None:
        names = ["shot_clock_filled_cs", "fill_method"]
        held = held.join(filled.select(*FRAME, *names), FRAME, "left")
    near = _near_windows(held, windows, STATE_SLACK_MS, "__off")
    near = near.withColumn("handler_slot", (F.array_position("__off", F.col("handler_id")) - 1).cast("int")).withColumn("in_flight", F.col("has_ball") & (F.col("cand_id") < 0))
    states = _steps(near, WINDOW, ["in_flight", *names], hz, n_steps).select(*WINDOW, "step", "valid", *[_nearest(c).alias(c) for c in ("in_flight", *names)])
    own = near.filter("has_ball and unix_ms between t0 and t1")
    slots = _steps(own, WINDOW, ["handler_slot"], hz, n_steps).select(*WINDOW, "step", _nearest("handler_slot").alias("handler_slot"))
    out = states.join(slots, [*WINDOW, "step"], "left")
    valid = F.col("valid")
    return out.select(
        *WINDOW, "step", F.when(valid, F.coalesce("handler_slot", F.lit(-1))).otherwise(-1).alias("handler_slot"), (valid & F.coalesce("in_flight", F.lit(False))).alias("ball_in_flight"), *[F.when(valid, F.col(c)).alias(c) for c in names]
    )


def grid_long(places: DataFrame, clocks: DataFrame, states: DataFrame) -> DataFrame:
    """Eleven rows per step with clocks and who handles the ball (M9)."""
    one = [*WINDOW, "step"]
    rows = places.join(clocks.join(states.select(*one, "handler_slot"), one, "left"), one, "left")
    return rows.withColumn("is_handler", (F.col("role") == "off") & F.coalesce(F.col("handler_slot") == F.col("slot"), F.lit(False))).drop("handler_slot")


def grid_distances(places: DataFrame) -> DataFrame:
    """Distances per step of each attacker to each defender and of each player to the ball, with the ball's speed (M5).

    The eleven rows of a step are brought together once; its pairs come from that short array.
    """
    me = F.struct("role", "slot", "x_cft", "y_cft", "vx", "vy")
    steps = places.groupBy(*WINDOW, "step").agg(F.array_sort(F.collect_list(me)).alias("__all"))
    steps = steps.withColumn("a", F.explode("__all")).filter("a.role <> 'ball'")
    meets = lambda p: (p["role"] == "ball") | ((F.col("a.role") == "off") & (p["role"] == "def"))
    steps = steps.select(*WINDOW, "step", "a", F.explode(F.filter("__all", meets)).alias("b"))
    dx, dy = F.col("a.x_cft") - F.col("b.x_cft"), F.col("a.y_cft") - F.col("b.y_cft")
    speed = F.when(F.col("b.role") == "ball", F.sqrt(F.col("b.vx") * F.col("b.vx") + F.col("b.vy") * F.col("b.vy")))
    return steps.select(*WINDOW, "step", F.col("a.role").alias("role"), F.col("a.slot").alias("slot"), F.col("b.role").alias("to_role"), F.col("b.slot").alias("to_slot"), F.sqrt(dx * dx + dy * dy).alias("distance_cft"), speed.alias("ball_speed"))


def window_handlers(windows: DataFrame, entities: DataFrame, frames: int = HOLD) -> DataFrame:
    """Handler among the attacking five alone at each ball frame of a window (L2.2): window, unix_ms, cand_slot, handler_slot; -1 is nobody.

    The candidate is the nearest of the five, of equally near ones the lower slot, within reach of a ball that is not too high; it is held as
    `kernels.sticky` holds it.
    """
    spans = windows.withColumn("__off", F.array_sort("offense_ids"))
    ball = _near_windows(ball_rows(entities), spans, 0, "__off").drop("t0", "t1")
    players = player_rows(entities).select(*FRAME, "player_id", "x_cft", "y_cft")
    slot = (F.array_position("__off", F.col("player_id")) - 1).cast("int")
    dx, dy = F.col("x_cft") - F.col("bx"), F.col("y_cft") - F.col("by")
    near = F.min(F.when(slot >= 0, F.struct((dx * dx + dy * dy).alias("d2"), slot.alias("slot"))))
    rows = ball.join(players, FRAME, "left").groupBy(*WINDOW, "unix_ms").agg(near.alias("__n"), F.max("bz").alias("bz"))
    able = (F.col("__n.d2") <= REACH_CFT * REACH_CFT) & (F.col("bz") <= HELD_Z_CFT)
    rows = rows.select(*WINDOW, "unix_ms", F.when(able, F.col("__n.slot")).otherwise(-1).alias("cand_slot"))
    marked = kn.mark_runs(rows, WINDOW, ["unix_ms"], ["cand_slot"])
    # a run carries its frames through the rule
    table = marked.groupBy(*WINDOW, "run_id").agg(F.first("cand_slot").alias("cand_slot"), F.count("*").alias("n"), F.collect_list("unix_ms").alias("__ts"))
    return kn.sticky(table, WINDOW, "cand_slot", frames, name="handler_slot").select(*WINDOW, F.explode("__ts").alias("unix_ms"), "cand_slot", "handler_slot")


def last_handler(window_held: DataFrame, moments: DataFrame) -> DataFrame:
    """moments (game_id, period, window, t_ms) with the last handler's slot at or before them, -1 for none (L2.2)."""
    asked = moments.select(*WINDOW, "t_ms")
    some = window_held.filter("handler_slot >= 0").select(*WINDOW, F.col("unix_ms").alias("t_ms"), "handler_slot")
    return kn.asof(asked, some, WINDOW, "t_ms", ["handler_slot"]).select(*WINDOW, "t_ms", F.coalesce("handler_slot", F.lit(-1)).alias("handler_slot"))
