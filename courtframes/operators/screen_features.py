"""What happens around a screen's contact (L2.21), and how likely it is a real screen (L2.23)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtframes.operators import events as ev
from courtframes.operators import kernels as kn
from courtframes.operators.events import FRAME, PERIOD, player_rows

# The time around a contact that is looked at, in ms; the speed of an approach, in hundredths of a foot a second.
BEFORE_MS, AFTER_MS = 2000, 3000
APPROACH_CFT = 200
MATCHUP_MS = (-1000, -200)
# Weights of the published score, by feature.
SCORE_BIAS = -1.6387
SCORE_WEIGHTS = {"user_speed_fts": 0.1047, "def_mean_speed_m05_0": 0.1028, "dist_basket_ft": 0.0544, "min_dist_ft": -0.4270, "has_pass": 0.6751, "ball_in_flight_at_contact": -1.4002, "on_ball": 0.4662}

SCREEN = [*PERIOD, "s", "u", "d", "t_contact_ms"]


def motion(entities: DataFrame, frames: int = 5) -> DataFrame:
    """Player rows with smoothed places mx, my and, away from holes, central velocities vx, vy and speed, in hundredths of a foot (a second)."""
    keys = ["game_id", "player_id", "period"]
    rows = kn.dealt(player_rows(entities), keys, entities)
    for c, name in (("x_cft", "mx"), ("y_cft", "my")):
        rows = kn.smooth(rows, keys, ["unix_ms"], c, frames, name=name)
    w = kn.over(keys, ["unix_ms"])
    ahead, back = F.lead("unix_ms").over(w), F.lag("unix_ms").over(w)
    near = (ahead - F.col("unix_ms") <= 60) & (F.col("unix_ms") - back <= 60)
    rate = lambda c: F.when(near, (F.lead(c).over(w) - F.lag(c).over(w)) / ((ahead - back) / 1000))
    return rows.withColumns({"vx": rate("mx"), "vy": rate("my")}).withColumn("speed", F.hypot("vx", "vy"))


def _way(a: Column, b: Column, x: str = "x_cft", y: str = "y_cft") -> tuple[Column, Column]:
    """The vector from a to b."""
    return b[x] - a[x], b[y] - a[y]


def _dot(a, b) -> Column:
    return a[0] * b[0] + a[1] * b[1]


def _long(a) -> Column:
    return F.hypot(a[0], a[1])


def _angle(a, b) -> Column:
    """Degrees between two vectors; null where one has no length."""
    size = _long(a) * _long(b)
    return F.when((_long(a) > 1e-4) & (_long(b) > 1e-4), F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), _dot(a, b) / size)))))


def _around(found: DataFrame, entities: DataFrame, handlers: DataFrame) -> DataFrame:
    """One row for each screen and frame near its contact: the three players, who guards whom, handler and segment.

    Frames are made whole first, about ten players in a list, so a screen meets some 125 rows and not ten times as many.
    """
    width = BEFORE_MS + AFTER_MS
    bucket = F.floor(F.col("unix_ms") / width)
    deal = [*PERIOD, "__bucket"]
    # players and the state of a frame are dealt by stretch of time once; frames are made and screens found in that dealing
    own = F.struct("player_id", "team_id", "x_cft", "y_cft", "mx", "my", "vx", "vy", "speed")
    state = F.struct(F.col("segment_id").alias("segment"), "handler_id", (F.col("has_ball") & (F.col("cand_id") < 0)).alias("free"))
    parts = motion(entities).select(*FRAME, own.alias("player"), F.lit(None).alias("state")).unionByName(handlers.select(*FRAME, F.lit(None).alias("player"), state.alias("state")))
    frames = kn.dealt(parts.withColumn("__bucket", bucket), deal, entities).groupBy(*FRAME, "__bucket").agg(F.collect_list("player").alias("players"), F.max("state").alias("state"))
    frames = frames.filter(F.size("players") > 0).select(*FRAME, "__bucket", "players", "state.*")
    spans = found.select(*SCREEN).withColumns({"__lo": F.col("t_contact_ms") - BEFORE_MS, "__hi": F.col("t_contact_ms") + AFTER_MS})
    spans = spans.withColumn("__bucket", F.explode(F.sequence(F.floor(F.col("__lo") / width), F.floor(F.col("__hi") / width))))
    rows = frames.join(spans, deal).filter("unix_ms between __lo and __hi").drop("__bucket", "__lo", "__hi")
    one = lambda who: F.get(F.filter("players", lambda p: p["player_id"] == F.col(who)), F.lit(0))
    rows = rows.withColumns({"ps": one("s"), "pu": one("u"), "pd": one("d")})
    apart2 = lambda p, q: (p["x_cft"] - q["x_cft"]) * (p["x_cft"] - q["x_cft"]) + (p["y_cft"] - q["y_cft"]) * (p["y_cft"] - q["y_cft"])

    def guard(who: str, but: Column | None = None) -> Column:
        me = F.col(who)
        foes = F.filter("players", lambda p: (p["team_id"] != me["team_id"]) & (F.lit(True) if but is None else p["player_id"] != but))
        return F.array_min(F.transform(foes, lambda p: F.struct(apart2(p, me).alias("d2"), p["player_id"].alias("id"))))["id"]

    shared = lambda who: F.exists("players", lambda p: (p["player_id"] != F.col(who)["player_id"]) & (p["x_cft"] == F.col(who)["x_cft"]) & (p["y_cft"] == F.col(who)["y_cft"]))
    return rows.withColumns({"s_guard": guard("ps", F.col("d")), "u_guard": guard("pu"), "shared": F.coalesce(shared("ps"), F.lit(False)) | F.coalesce(shared("pu"), F.lit(False)) | F.coalesce(shared("pd"), F.lit(False))})


def screen_features(found: DataFrame, entities: DataFrame, handlers: DataFrame, direction: DataFrame) -> DataFrame:
    """One row per screen of `found` (game_id, period, s, u, d, t_contact_ms, t_start_ms), in feet, feet a second and degrees.

    Every window around a contact (approach, pass, matchup, motion before and after) reads the same dealing of frames by screen: one bucketed
    join, windows that lay the contact beside each frame, one aggregate.  A time t of the contact is the first frame at or after it, else the
    last one; frames beyond 3 s, as behind a hole, are not looked at.

    t_approach_ms: last time before the contact that the screener comes at 2 ft/s or more than that toward the contact's place, else 2 s before.
    t_pass_ms: from 1.5 s before to 3 s after, the user first crosses the line through the screener across the user's way of the last half
    second, inside the contact's segment and before the user is missed in a frame.  user_def_id: the most frequent nearest opponent of the
    user from 1 s to 0.2 s before (least id of equals).  screener_def_id: the screener's nearest opponent but the screened one.
    Without a direction the attack goes left.  A table without screens gives none; values that need a missing player are null.
    """
    w = Window.partitionBy(*SCREEN)
    whole = w.orderBy("unix_ms").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t, t0 = F.col("unix_ms"), F.col("t_contact_ms")
    at = t == t0
    fields = F.struct("unix_ms", "ps", "pu", "pd")
    rows = _around(found, entities, handlers)
    first = lambda ms: F.first(F.when(t >= t0 + ms, t), ignorenulls=True).over(whole)
    rows = rows.withColumns({
        "now": F.first(F.when(at, fields), ignorenulls=True).over(whole), "then": F.first(F.when(t >= t0 - 500, fields), ignorenulls=True).over(whole),
        "segment0": F.first(F.when(at, F.col("segment")), ignorenulls=True).over(whole), "t_last": F.max(t).over(whole),
        "matchup_end": first(MATCHUP_MS[1]), "t_ahead": first(300), "guard0": F.first(F.when(at, F.col("s_guard")), ignorenulls=True).over(whole),
    })
    place = F.col("now.ps")
    user_way = _way(F.col("then.pu"), F.col("now.pu"), "mx", "my")
    def_way = _way(F.col("then.pd"), F.col("now.pd"), "mx", "my")
    # the user's side of the line through the screener
    there = (t >= t0 - 1500) & (F.col("segment") == F.col("segment0")) & F.col("pu").isNotNull()
    way = _long(user_way) > 1e-4
    rows = rows.withColumns({"there": F.coalesce(there, F.lit(False)), "side": F.when(way, F.signum(_dot(_way(place, F.col("pu")), user_way)))})
    rows = rows.withColumn("open", F.first(F.when(F.col("there"), F.struct("unix_ms", "side")), ignorenulls=True).over(whole))
    missed = F.min(F.when(~F.col("there") & (t > F.greatest(F.col("open.unix_ms"), t0 - 1500)), t)).over(w)
    past = F.col("there") & (t > F.col("open.unix_ms")) & (t < t0 + AFTER_MS) & (F.col("open.side") != 0) & (F.col("side") != F.col("open.side"))
    rows = rows.withColumn("missed", missed).withColumn("past", F.coalesce(past & (F.col("missed").isNull() | (t < F.col("missed"))), F.lit(False)))
    # aggregates over the frames of one screen
    pick = lambda ms: F.coalesce(F.min_by(fields, F.when(t >= t0 + ms, t)), F.max_by(fields, t))
    toward = _way(F.struct(F.col("ps.mx").alias("x_cft"), F.col("ps.my").alias("y_cft")), place)
    comes = (F.col("ps.vx") * toward[0] + F.col("ps.vy") * toward[1]) / F.when(_long(toward) > 1e-4, _long(toward)) > APPROACH_CFT
    guard_at = lambda who: F.get(F.filter("players", lambda p: p["player_id"] == F.col(who)), F.lit(0))
    after_1s = F.struct("pu", "pd", guard_at("guard0").alias("pg"))
    spans = {"m05_0": (t >= t0 - 500) & (t <= t0), "m03_0": (t >= t0 - 300) & (t <= t0), "0_p03": (t >= t0) & (t <= F.coalesce("t_ahead", "t_last"))}
    moved = {f"{f.__name__}_{name}": f(F.when(span, F.col("ps.speed"))) for name, span in spans.items() for f in (F.avg, F.max)}
    out = rows.groupBy(*SCREEN).agg(
        F.first("now").alias("now"), F.first("then").alias("then"), F.max(F.when(at, F.col("handler_id"))).alias("handler_id"), F.max(F.when(at, F.col("free"))).alias("free"),
        F.max(F.when(at, F.col("shared"))).alias("xy_shared_at_contact"), F.first("guard0").alias("screener_def_id"),
        F.max(F.when(comes & (t > t0 - BEFORE_MS) & (t < t0), t)).alias("t_comes"), F.min_by(F.struct("unix_ms", "pu"), F.when(F.col("past"), t)).alias("passed"),
        F.min(F.when((t >= t0 - 1000) & (t <= t0 + 1000), _long(_way(F.col("ps"), F.col("pu"))))).alias("su"),
        F.mode(F.when((t >= t0 + MATCHUP_MS[0]) & (t <= F.col("matchup_end")), F.col("u_guard")), True).alias("user_def_id"),
        pick(1500).alias("late"), pick(-300).alias("m03"), pick(300).alias("p03"), F.coalesce(F.min_by(after_1s, F.when(t >= t0 + 1000, t)), F.max_by(after_1s, t)).alias("soon"),
        F.avg(F.when(spans["m05_0"], F.col("pd.speed"))).alias("def_speed"), *[v.alias(n) for n, v in moved.items()],
    )
    sides = direction.select(*PERIOD, F.col("team_id").alias("offense_team_id"), "attacks_left")
    out = out.withColumn("offense_team_id", F.col("now.ps.team_id")).join(sides, [*PERIOD, "offense_team_id"], "left").join(found.select(*SCREEN, "t_start_ms"), SCREEN)
    now, hoop = F.col("now.ps"), F.struct(F.when(F.coalesce("attacks_left", F.lit(True)), 525).otherwise(8875).alias("x_cft"), F.lit(2500).alias("y_cft"))
    axis = _way(now, hoop)
    turn = -axis[0] * (F.col("passed.pu.y_cft") - now["y_cft"]) + axis[1] * (F.col("passed.pu.x_cft") - now["x_cft"])
    left = _way(now, F.col("late.ps"), "mx", "my")
    t_pass = F.col("passed.unix_ms")
    feet = lambda c: c / 100
    apart = lambda a, b: feet(_long(_way(F.col(a), F.col(b))))
    cols = {
        "screened_def_is_user_def": F.col("user_def_id") == F.col("d"), "on_ball": F.col("handler_id") == F.col("u"), "ball_in_flight_at_contact": F.coalesce("free", F.lit(False)),
        "t_set_start_ms": F.col("t_start_ms"), "t_approach_ms": F.coalesce("t_comes", t0 - BEFORE_MS), "t_pass_ms": t_pass,
        "t_end_ms": F.least(t0 + AFTER_MS, F.greatest(t0 + 1500, t_pass + 1000)), "min_dist_ft": apart("now.ps", "now.pd"), "min_dist_screener_user_ft": feet(F.col("su")),
        "x_ft": feet(now["x_cft"]), "y_ft": feet(now["y_cft"]), "screener_speed_fts": feet(now["speed"]), "user_speed_fts": feet(F.col("now.pu.speed")),
        "approach_angle_deg": _angle(user_way, axis), "side_passed": F.when(turn > 0, "left").when(turn <= 0, "right"),
        "screener_dx_1p5s": feet(left[0]), "screener_dy_1p5s": feet(left[1]), "screener_to_basket_1p5s_ft": feet(_dot(left, axis) / F.when(_long(axis) > 0, _long(axis))),
        "screened_def_to_user_1s_ft": apart("soon.pd", "soon.pu"), "screener_def_to_user_1s_ft": apart("soon.pg", "soon.pu"),
        "def_approach_angle_deg": _angle(def_way, (now["x_cft"] - F.col("then.pd.mx"), now["y_cft"] - F.col("then.pd.my"))),
    }
    for name, (a, b) in {"m05_0": ("then", "now"), "m03_0": ("m03", "now"), "0_p03": ("now", "p03")}.items():
        real, path = F.col(f"{b}.unix_ms") > F.col(f"{a}.unix_ms"), _way(F.col(f"{a}.ps"), F.col(f"{b}.ps"), "mx", "my")
        cols |= {f"scr_mean_speed_{name}": F.when(real, feet(F.col(f"avg_{name}"))), f"scr_max_speed_{name}": F.when(real, feet(F.col(f"max_{name}"))), f"scr_disp_{name}_ft": F.when(real, feet(_long(path)))}
        cols[f"scr_disp_along_def_{name}_ft"] = F.when(real & (_long(def_way) > 1e-4), feet(_dot(path, def_way) / _long(def_way)))
    cols["def_mean_speed_m05_0"] = F.when(F.col("now.unix_ms") > F.col("then.unix_ms"), feet(F.col("def_speed")))
    out = out.select(*SCREEN, "offense_team_id", "handler_id", "user_def_id", "screener_def_id", "xy_shared_at_contact", *[c.alias(n) for n, c in cols.items()])
    uid = F.concat_ws(":", "game_id", F.lit("screen_candidate"), "t_contact_ms", F.concat_ws("-", "s", "u"))
    return out.withColumn("screen_confidence", screen_confidence()).withColumn("event_uid", uid)


def screen_confidence() -> Column:
    """The published score over the columns of `screen_features`; speeds count up to 30 ft/s, a missing value as zero."""
    place = [F.hypot(F.col("x_ft") - hoop, F.col("y_ft") - 25.0) for hoop in (5.25, 88.75)]
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    values = {name: zero(F.col(name).cast("double")) for name in ("min_dist_ft", "ball_in_flight_at_contact", "on_ball")}
    values |= {name: F.least(F.greatest(zero(F.col(name)), F.lit(0.0)), F.lit(30.0)) for name in ("user_speed_fts", "def_mean_speed_m05_0")}
    values |= {"dist_basket_ft": zero(reduce(F.least, place)), "has_pass": F.col("t_pass_ms").isNotNull().cast("double")}
    return ev.screen_score(values, SCORE_WEIGHTS, SCORE_BIAS)
