"""First layer: clean frames, continuity segments, attack direction, clock lookups, checks.

Coordinates are hundredths of a foot and clocks hundredths of a second, as integers, so results
do not depend on the order of summation.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtframes.operators.kernels import dealt, over, segment

ENTITY = ["game_id", "period", "unix_ms", "team_id", "player_id"]
FRAME = ["game_id", "period", "unix_ms"]
BALL = -1
GAP_MS = 60
JUMP_CS = 100


def dedup_entities(raw: DataFrame) -> DataFrame:
    """One row per entity and time: the first by event and moment.

    Rows are dealt by frame, and sorted once; the frame index reuses the dealing.
    """
    first = F.row_number().over(over(ENTITY, ["event_id", "moment_idx"]))
    return dealt(raw, FRAME).withColumn("__nth", first).filter("__nth = 1").drop("__nth")


def frame_index(entities: DataFrame) -> DataFrame:
    """One row per frame: its most frequent clocks (the least of equals), counts and continuity flags.

    A segment begins at a period's start, after a hole of more than 60 ms, or where the clock rises by more
    than a second; segments count from zero in each game.
    """
    clocks = ["game_clock_cs", "shot_clock_cs"]
    # in each frame a clock's rows are counted by windows, so that the mode is a plain maximum of numbers
    votes = entities.select("*", *[F.count(c).over(Window.partitionBy(*FRAME, c)).alias(f"__n_{c}") for c in clocks])
    most = Window.partitionBy(*FRAME)
    votes = votes.select("*", *[F.max(f"__n_{c}").over(most).alias(f"__most_{c}") for c in clocks])
    frames = votes.groupBy(*FRAME).agg(
        *[F.min(F.when(F.col(f"__n_{c}") == F.col(f"__most_{c}"), F.col(c))).alias(c) for c in clocks],
        F.count("*").alias("n_entities"),
        F.count_if(F.col("team_id") != BALL).alias("n_players"),
        F.max(F.col("team_id") == BALL).alias("has_ball"),
    )
    w = over(["game_id", "period"], ["unix_ms"])
    rise = F.col("game_clock_cs") - F.lag("game_clock_cs").over(w)
    flagged = frames.withColumn("dt_ms", F.col("unix_ms") - F.lag("unix_ms").over(w)).withColumn("__rise", rise)
    flagged = flagged.select(
        *frames.columns,
        "dt_ms",
        (F.col("dt_ms").isNull() | (F.col("dt_ms") > GAP_MS)).alias("gap"),
        F.coalesce(F.col("__rise") > JUMP_CS, F.lit(False)).alias("clock_jump"),
        F.coalesce(F.abs("__rise") < 1, F.lit(False)).alias("clock_frozen"),
    )
    return segment(flagged, ["game_id"], ["period", "unix_ms"], F.col("gap") | F.col("clock_jump"))


def dedup_report(raw: DataFrame, entities: DataFrame, index: DataFrame) -> DataFrame:
    """One row per game: sizes before and after, holes, clock corrections."""
    before = raw.groupBy("game_id").agg(F.countDistinct("event_id", "moment_idx").alias("raw_moments"), F.count("*").alias("raw_rows"))
    rows = entities.groupBy("game_id").agg(F.count("*").alias("unique_rows"))
    frames = index.groupBy("game_id").agg(
        F.count("*").alias("unique_frames"),
        F.count_if(F.col("gap") & F.col("dt_ms").isNotNull()).alias("n_gaps"),
        F.count_if("clock_jump").alias("n_clock_jumps"),
        F.countDistinct("segment_id").alias("n_segments"),
        F.count_if(F.col("n_players") != 10).alias("frames_not_10_players"),
        F.count_if(~F.col("has_ball")).alias("frames_no_ball"),
        F.count_if("clock_frozen").alias("frames_clock_frozen"),
        F.count_if(F.col("shot_clock_cs").isNull()).alias("shot_clock_null_frames"),
    )
    return before.join(rows, "game_id").join(frames, "game_id")


def validate_raw(raw: DataFrame) -> DataFrame:
    """One row per game and kind of irregularity with its count; zero counts too."""
    key = ["game_id", "period", "unix_ms", "team_id", "player_id"]
    per = raw.groupBy(*key).agg(F.count("*").alias("n"), F.countDistinct("x_cft", "y_cft", "z_cft").alias("kinds"))
    entity = per.groupBy("game_id").agg(F.count_if(F.col("n") > 1).alias("duplicate_entities"), F.count_if(F.col("kinds") > 1).alias("conflicting_entities"))
    bounds = raw.groupBy("game_id").agg(
        F.count_if((F.col("x_cft") < 0) | (F.col("x_cft") > 9400) | (F.col("y_cft") < 0) | (F.col("y_cft") > 5000)).alias("out_of_bounds"),
        F.count_if(F.col("shot_clock_cs").isNull()).alias("null_shot_clock"),
        F.count_if((F.col("team_id") == BALL) & (F.col("player_id") != -1)).alias("ball_with_player"),
    )
    kinds = ["duplicate_entities", "conflicting_entities", "out_of_bounds", "null_shot_clock", "ball_with_player"]
    return entity.join(bounds, "game_id").unpivot("game_id", kinds, "check", "n_rows")


def shot_positions(entities: DataFrame, pbp: DataFrame, tolerance_cs: int = 100) -> DataFrame:
    """Median ball place around each shot of the play-by-play, in frames whose clock is within tolerance.

    Both sides are dealt by buckets of the clock, so a period's frames do not meet all its shots.
    """
    width = 2 * tolerance_cs
    shots = pbp.filter(F.col("msg_type").isin(1, 2) & F.col("p1_team_id").isNotNull()).select("game_id", "period", "event_num", "p1_team_id", (F.col("pctime_sec") * 100).alias("at"))
    # shots of one clock look at the same frames, which are read once
    asked = shots.select("game_id", "period", "at").distinct().withColumn("bucket", F.explode(F.sequence(F.floor((F.col("at") - tolerance_cs) / width), F.floor((F.col("at") + tolerance_cs) / width))))
    ball = entities.filter(F.col("team_id") == BALL).select("game_id", "period", "game_clock_cs", "x_cft", "y_cft", F.floor(F.col("game_clock_cs") / width).alias("bucket"))
    near = asked.join(ball, ["game_id", "period", "bucket"]).filter(F.abs(F.col("game_clock_cs") - F.col("at")) <= tolerance_cs)
    places = near.groupBy("game_id", "period", "at").agg(F.median("x_cft").alias("ball_x_cft"), F.median("y_cft").alias("ball_y_cft"), F.count("*").alias("n_frames"))
    return shots.join(places, ["game_id", "period", "at"]).select("game_id", "period", "event_num", "p1_team_id", "ball_x_cft", "ball_y_cft", "n_frames")


def attack_direction(entities: DataFrame, pbp: DataFrame) -> DataFrame:
    """Per game, team and period: whether the team attacks left.

    Every shot votes for its side, counted reversed in the second half; the other team's votes count the
    other way.  A tie is right in the first half.  votes_left and n_shots are the period's own.
    """
    shots = shot_positions(entities, pbp).withColumn("left", F.col("ball_x_cft") < 4700)
    sign = F.when(F.col("left") == (F.col("period") <= 2), 1).otherwise(-1)
    own = shots.groupBy("game_id", F.col("p1_team_id").alias("team_id")).agg(F.sum(sign).alias("votes"))
    total = Window.partitionBy("game_id")
    side = own.withColumn("first_left", 2 * F.col("votes") - F.sum("votes").over(total) > 0)
    # of two teams exactly one attacks left in the first half: the tie goes to the larger id
    side = side.withColumn("first_left", F.when(2 * F.col("votes") - F.sum("votes").over(total) == 0, F.col("team_id") == F.max("team_id").over(total)).otherwise(F.col("first_left")))
    periods = entities.select("game_id", "period").distinct()
    seen = shots.groupBy("game_id", F.col("p1_team_id").alias("team_id"), "period").agg(F.count("*").alias("n_shots"), F.count_if("left").alias("n_left"))
    out = side.join(periods, "game_id").join(seen, ["game_id", "team_id", "period"], "left")
    return out.select("game_id", "team_id", "period", (F.col("first_left") == (F.col("period") <= 2)).alias("attacks_left"), F.coalesce("n_shots", F.lit(0)).alias("n_shots"), F.coalesce("n_left", F.lit(0)).alias("n_left"))


def terminal_events(pbp: DataFrame) -> DataFrame:
    """Rows that may end a possession, with the score margin before them.

    score_margin (home less visitors) stands at scoring rows only; the margin before a row is the last one listed, zero at first.
    """
    margin = F.last("score_margin", ignorenulls=True).over(over(["game_id"], ["event_num"]).rowsBetween(Window.unboundedPreceding, -1))
    marked = pbp.withColumn("margin_before", F.coalesce(margin, F.lit(0)).cast("long"))
    return marked.filter(F.col("msg_type").isin(1, 2, 5, 6, 7, 9, 13)).select("game_id", "event_num", "period", "pctime_sec", "msg_type", "margin_before")


def locate_clock(index: DataFrame, readings: DataFrame, bin_cs: int = 100) -> DataFrame:
    """Frame of each clock reading (clock_cs): in the bin above it, else within a bin around it.

    Where readings have after_ms, not null, only later frames count.  Of several segments the lowest, inside it the frame nearest the bin's centre, then the earliest.
    """
    keys = ["game_id", "period"]
    # rows of one clock ask once
    asks = ["game_id", "period", "clock_cs", *(c for c in ("after_ms",) if c in readings.columns)]
    asked = readings.select(*asks).distinct().withColumn("__b", F.explode(F.sequence(F.floor((F.col("clock_cs") - bin_cs) / bin_cs), F.floor((F.col("clock_cs") + bin_cs) / bin_cs))))
    frames = index.select(*keys, "unix_ms", "segment_id", "game_clock_cs", F.floor(F.col("game_clock_cs") / bin_cs).alias("__b"))
    apart = F.col("game_clock_cs") - F.col("clock_cs")
    near = asked.join(frames, [*keys, "__b"]).withColumn("__in", (apart >= 0) & (apart < bin_cs)).filter(F.abs(apart) <= bin_cs)
    if "after_ms" in readings.columns:
        near = near.filter("after_ms is null or unix_ms > after_ms")
    rank = F.struct(~F.col("__in"), "segment_id", F.abs(2 * apart - bin_cs), "unix_ms")
    found = near.groupBy(*asks).agg(F.min_by("unix_ms", rank).alias("unix_ms"))
    rows, found = readings.distinct().alias("r"), found.alias("f")
    on = [F.col(f"r.{c}") == F.col(f"f.{c}") for c in asks if c != "after_ms"] + [F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}")) for c in asks if c == "after_ms"]
    return rows.join(found, on).select("r.*", "f.unix_ms")


class Readings:
    """The frames of one period as a fold asks for them: the frame of a clock reading behind a moment that never falls from call to call."""

    def __init__(self, t: np.ndarray, segment: np.ndarray, clock: np.ndarray, bin_cs: int = 100):
        order = np.argsort(clock, kind="stable")
        order = order[~np.isnan(clock[order])]
        self._t, self._segment, self._clock, self._bin = t[order], segment[order], clock[order], bin_cs
        self._places: dict[float, tuple[list[int], int]] = {}

    def place(self, clock: float, after: int) -> int | None:
        """First frame later than `after`: in the bin above the clock, else within a bin around it; lowest segment, middle, earliest."""
        if clock not in self._places:
            i, j = self._clock.searchsorted(clock - self._bin), self._clock.searchsorted(clock + self._bin, "right")
            apart, t = self._clock[i:j] - clock, self._t[i:j]
            order = np.lexsort((t, np.abs(2 * apart - self._bin), self._segment[i:j], ~((apart >= 0) & (apart < self._bin))))
            self._places[clock] = t[order].tolist(), 0
        places, k = self._places[clock]
        while k < len(places) and places[k] <= after:
            k += 1
        self._places[clock] = (places, k) if k < len(places) else ([], 0)
        return places[k] if k < len(places) else None


def locate_video(frames: DataFrame, anchors: DataFrame) -> DataFrame:
    """Video time in ms of frames from the latest anchor of the game that is still valid."""
    from courtframes.operators.kernels import asof

    found = asof(frames, anchors, ["game_id"], "unix_ms", ["video_ms", "valid_until_ms"])
    inside = F.col("unix_ms") <= F.col("valid_until_ms")
    return found.select(*frames.columns, F.when(inside, F.col("video_ms") + F.col("unix_ms") - F.col("match_unix_ms")).alias("video_ms"))


