"""Half-court windows (P17) and what another rule of release changes in them (P18)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtframes.operators import kernels as kn
from courtframes.operators.events import PERIOD, ball_rows, player_rows
from courtframes.operators.spans import attach_possession

# Kinds of rows that may end a possession, and those of them whose own team attacks.
KINDS = {1: "fg_made", 2: "fg_missed", 5: "turnover", 6: "foul", 7: "violation", 9: "timeout", 13: "period_end"}
OWN_ATTACK = (1, 2, 5)
# Measures of windows, in ms, hundredths of a foot and hundredths of the frames.
PAD_MS, FRONT_MS, MOST_MS, TRANSITION_MS, SHORT_MS, AROUND_MS = 500, 1000, 24_000, 4000, 1500, 500
HALF_CFT, MIDDLE_CFT = 4700, 300
PRESENT = 95
BUCKET_MS = 4000
ONE = [*PERIOD, "event_num"]


def _named(prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.lit(":"), F.create_map(*[F.lit(v) for kv in KINDS.items() for v in kv])[F.col("msg_type")])


def _attacks(rows: DataFrame, ball: DataFrame, direction: DataFrame) -> DataFrame:
    """rows with offense_team_id, defense_team_id, attacks_left, and __why_side where the side is not known.

    Attempts and turnovers name their team; for other rows the half in which the ball is tells it, unless that is near the middle.
    """
    named = F.col("msg_type").isin(*OWN_ATTACK) & F.col("team_id").isNotNull()
    asked = rows.filter(~named & F.col("t_terminal_ms").isNotNull()).select(*ONE, (F.col("t_terminal_ms") - AROUND_MS).alias("__lo"), (F.col("t_terminal_ms") + AROUND_MS).alias("__hi"))
    near = kn.range_join(ball, asked, PERIOD, "unix_ms", "__lo", "__hi", BUCKET_MS).groupBy(*ONE).agg(F.median("bx").alias("__bx"))
    teams = direction.groupBy("game_id").agg(F.min("team_id").alias("__a"), F.max("team_id").alias("__b"))
    lefts = direction.filter("attacks_left").groupBy(*PERIOD).agg(F.count("*").alias("__n_left"), F.min("team_id").alias("__left"))
    rows = rows.join(near, ONE, "left").join(teams, "game_id", "left").join(lefts, PERIOD, "left")
    rival = lambda team: F.when(F.col("__a") != F.col("__b"), F.when(team == F.col("__a"), F.col("__b")).when(team == F.col("__b"), F.col("__a")))
    by_ball = F.when(F.col("__n_left") == 1, F.when(F.col("__bx") < HALF_CFT, F.col("__left")).otherwise(rival(F.col("__left"))))
    middle = F.col("__bx").isNull() | (F.abs(F.col("__bx") - HALF_CFT) < MIDDLE_CFT)
    rows = rows.withColumn("offense_team_id", F.when(named, F.col("team_id")).when(~middle, by_ball))
    rows = rows.withColumn("defense_team_id", rival(F.col("offense_team_id")))
    side = direction.select(*PERIOD, F.col("team_id").alias("offense_team_id"), "attacks_left")
    why = F.when(~named & middle, "offense_ambiguous").when(F.col("offense_team_id").isNull(), "direction_missing").when(F.col("defense_team_id").isNull(), "offense_unknown_team").when(F.col("attacks_left").isNull(), "direction_missing")
    return rows.join(side, [*PERIOD, "offense_team_id"], "left").withColumn("__why_side", why).drop("__bx", "__a", "__b", "__n_left", "__left")


def half_court_windows(times: DataFrame, entities: DataFrame, index: DataFrame, direction: DataFrame, rebounds: DataFrame | None = None) -> DataFrame:
    """One row per row of the log that may end a possession: its window, or the first test that it fails (P17).

    times is what `shots.terminal_times` gives.  A window lies between the moment before and half a second behind the row's own.  It starts at the
    last time the ball comes to the front half, at most 24 s before its end (`cropped`), must last a second there, lie in one segment of
    frames and show the same five players of either team.  outcome is 'accepted' or the reason; columns up to the failed test are filled.
    With rebounds (game_id, period, t_control_ms of offensive ones), a window whose ball never leaves the front half starts at the last of them.

    Every test is an aggregate over a range join of frames with windows, and windows of a period overlap by half a second at most, so a
    frame meets one or two of them.
    """
    ball = ball_rows(entities).withColumn("__next", F.lead("unix_ms").over(kn.over(PERIOD, ["unix_ms"])))
    earlier = kn.over(PERIOD, ["event_num"]).rowsBetween(Window.unboundedPreceding, -1)
    placed = F.when(F.col("t_terminal_ms").isNotNull(), F.struct("event_num", "t_terminal_ms"))
    rows = times.withColumn("__prev", F.last(placed, ignorenulls=True).over(earlier))
    rows = rows.join(index.groupBy(*PERIOD).agg(F.min("unix_ms").alias("__t0")), PERIOD, "left")
    rows = rows.withColumn("prev_event_num", F.col("__prev.event_num")).withColumn("t_end_ms", F.col("t_terminal_ms") + PAD_MS)
    rows = _attacks(rows, ball, direction)
    known = F.col("t_terminal_ms").isNotNull() & F.col("__why_side").isNull()
    rows = rows.withColumn("w_start_ms", F.when(known, F.coalesce("__prev.t_terminal_ms", "__t0")))

    spans = rows.filter(known).select(*ONE, "attacks_left", (F.col("w_start_ms") + 1).alias("__lo"), F.col("t_end_ms").alias("__hi"))
    front = F.when(F.col("attacks_left"), F.col("bx") < HALF_CFT).otherwise(F.col("bx") > HALF_CFT)
    back_at = F.when(~front, F.col("unix_ms"))
    seen = kn.range_join(ball, spans, PERIOD, "unix_ms", "__lo", "__hi", BUCKET_MS).groupBy(*ONE).agg(
        F.max_by(front, "unix_ms").alias("__ends_front"), F.max(back_at).alias("__back"), F.max_by("__next", back_at).alias("__cross")
    )
    rows = rows.join(seen, ONE, "left").withColumn("t_cross_ms", F.when(F.col("__ends_front") & F.col("__back").isNotNull(), F.col("__cross")))
    stays = F.col("__ends_front") & F.col("__back").isNull()
    if rebounds is not None:
        taken = rebounds.filter("t_control_ms is not null").select(*PERIOD, F.col("t_control_ms").alias("unix_ms"), F.lit(True).alias("__taken")).distinct()
        asked = rows.filter(stays).select(*ONE, (F.col("t_end_ms") - FRONT_MS).alias("unix_ms"))
        last = kn.asof(asked, taken, PERIOD, "unix_ms", ["__taken"]).select(*ONE, F.col("match_unix_ms").alias("__second"))
        rows = rows.join(last, ONE, "left").withColumn("t_cross_ms", F.coalesce("t_cross_ms", F.when(F.col("__second") > F.col("w_start_ms"), F.col("__second")))).drop("__second")
    length = F.col("t_end_ms") - F.col("t_cross_ms")
    rows = rows.withColumn("cropped", F.when(length >= FRONT_MS, length > MOST_MS)).withColumn("t_start_ms", F.when(length >= FRONT_MS, F.greatest("t_cross_ms", F.col("t_end_ms") - MOST_MS)))

    spans = rows.filter("t_start_ms is not null").select(*ONE, "offense_team_id", F.col("t_start_ms").alias("__lo"), F.col("t_end_ms").alias("__hi"))
    frames = index.select(*PERIOD, "unix_ms", "segment_id", "game_clock_cs", "shot_clock_cs")
    whole = kn.range_join(frames, spans.drop("offense_team_id"), PERIOD, "unix_ms", "__lo", "__hi", BUCKET_MS).groupBy(*ONE).agg(
        F.count("*").alias("n_frames"), (F.min("segment_id") == F.max("segment_id")).alias("__whole"),
        F.min_by("game_clock_cs", "unix_ms").alias("game_clock_start_cs"), F.max_by("game_clock_cs", "unix_ms").alias("game_clock_end_cs"), F.min_by("shot_clock_cs", "unix_ms").alias("shot_clock_start_cs"),
    )
    people = player_rows(entities).select(*PERIOD, "unix_ms", "team_id", "player_id")
    counts = kn.range_join(people, spans, PERIOD, "unix_ms", "__lo", "__hi", BUCKET_MS).groupBy(*ONE, "offense_team_id", "team_id", "player_id").agg(F.count("*").alias("n"))
    there = counts.groupBy(*ONE).agg(F.array_sort(F.collect_list(F.struct("player_id", "n", (F.col("team_id") == F.col("offense_team_id")).alias("own")))).alias("__people"))
    rows = rows.join(whole, ONE, "left").join(there, ONE, "left")
    full = lambda own: F.transform(F.filter("__people", lambda p: (p["own"] == own) & (100 * p["n"] >= PRESENT * F.col("n_frames"))), lambda p: p["player_id"])
    rows = rows.withColumns({"offense_ids": full(True), "defense_ids": full(False)})
    n_people = F.coalesce(F.size("__people"), F.lit(0))
    fives = (n_people == 10) & (F.size("offense_ids") == 5) & (F.size("defense_ids") == 5)
    never = F.when(F.col("t_end_ms") - F.col("w_start_ms") < SHORT_MS, _named("no_crossing:short_window")).when(stays, _named("no_crossing:always_frontcourt")).otherwise(_named("no_crossing:ends_backcourt"))
    outcome = (
        F.when(F.col("__t0").isNull(), "period_untracked")
        .when(F.col("t_terminal_ms").isNull(), _named("terminal_not_located"))
        .when(F.col("__why_side").isNotNull(), F.col("__why_side"))
        .when(F.col("__ends_front").isNull(), "no_ball_frames")
        .when(F.col("t_cross_ms").isNull(), never)
        .when(F.col("t_start_ms").isNull(), "frontcourt_too_short")
        .when(~F.coalesce(F.col("__whole") & (F.col("n_frames") >= 2), F.lit(False)), "gap_in_window")
        .when(n_people > 10, "lineup_change")
        .when(~F.coalesce(fives, F.lit(False)), "missing_players")
        .otherwise("accepted")
    )
    rows = rows.withColumn("outcome", outcome).withColumn("terminal_type", F.create_map(*[F.lit(v) for kv in KINDS.items() for v in kv])[F.col("msg_type")])
    kept = lambda c: F.when(F.col("outcome") == "accepted", F.col(c)).alias(c)
    return rows.select(
        *ONE, "terminal_type", "outcome", "prev_event_num", "w_start_ms", "t_pbp_ms", "t_terminal_ms", "method", "shooter_inferred_id", "offense_team_id", "defense_team_id", "attacks_left", "t_cross_ms", "t_start_ms", "t_end_ms", "cropped",
        F.when(F.col("outcome") == "accepted", length < TRANSITION_MS).alias("is_transition"), *[kept(c) for c in ("n_frames", "game_clock_start_cs", "game_clock_end_cs", "shot_clock_start_cs", "offense_ids", "defense_ids")],
    )


def window_keys(windows: DataFrame, ledger: DataFrame) -> DataFrame:
    """Accepted windows with window_uid and the possession they overlap most."""
    kept = windows.filter("outcome = 'accepted'")
    asked = kept.select(*PERIOD, F.col("event_num").alias("window"), F.col("t_start_ms").alias("lo"), F.col("t_end_ms").alias("hi"), F.col("offense_team_id").alias("team_id"))
    found = attach_possession(asked, ledger).select(*PERIOD, F.col("window").alias("event_num"), "poss_seq", "overlap_frac", "offense_match")
    return kept.join(found, ONE, "left").withColumn("window_uid", F.concat_ws(":", "game_id", "event_num"))


def window_margin(windows: DataFrame, terminals: DataFrame, homes: DataFrame) -> DataFrame:
    """windows with score_margin_offense: margin_before (home less visitors) of the row that ends them, from the attacking team's side."""
    margin = terminals.select("game_id", "event_num", "margin_before")
    rows = windows.join(margin, ["game_id", "event_num"], "left").join(homes.select("game_id", "home_team_id"), "game_id", "left")
    return rows.withColumn("score_margin_offense", F.when(F.col("offense_team_id") == F.col("home_team_id"), F.col("margin_before")).otherwise(-F.col("margin_before"))).drop("margin_before", "home_team_id")


def reject_counts(windows: DataFrame) -> DataFrame:
    return windows.groupBy("game_id", "outcome").agg(F.count("*").alias("n"))


def window_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Each row of either table of windows: kept, moved, added or dropped as a window, with both outcomes and how far its end moved (P18)."""
    side = lambda df, p: df.select(*ONE, *[F.col(c).alias(f"{p}_{c}") for c in ("outcome", "t_start_ms", "t_end_ms")])
    both = side(old, "old").join(side(new, "new"), ONE, "full")
    was, now = (F.coalesce(F.col(f"{p}_outcome") == "accepted", F.lit(False)) for p in ("old", "new"))
    same = F.col("old_t_start_ms").eqNullSafe(F.col("new_t_start_ms")) & F.col("old_t_end_ms").eqNullSafe(F.col("new_t_end_ms"))
    change = F.when(was & now, F.when(same, "kept").otherwise("moved")).when(was, "dropped").when(now, "added").otherwise("rejected")
    return both.select(*ONE, "old_outcome", "new_outcome", change.alias("change"), (F.col("new_t_end_ms") - F.col("old_t_end_ms")).alias("end_moved_ms"))


def change_report(changes: DataFrame) -> DataFrame:
    """Rows per change and pair of outcomes, with the median move of the end and the largest."""
    return changes.groupBy("change", "old_outcome", "new_outcome").agg(F.count("*").alias("n"), F.median("end_moved_ms").alias("median_moved_ms"), F.max(F.abs("end_moved_ms")).alias("most_moved_ms"))
