"""Play-by-play: row order, foul states, free throws and their fouls, estimates, splits.

pbp columns: game_id, event_num, period, pctime_sec (counts down), msg_type, action_type, p1_team_id, p1_id,
p3_team_id, description and, optionally, p1_is_team for rows about a team.  Work of this grain is small
per game and parallel over games.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtframes.functions import rules
from courtframes.functions.text import free_throw
from courtframes.operators.kernels import asof, over

# Message types of the play-by-play.
MADE, MISSED, FREE_THROW, REBOUND, TURNOVER, FOUL, VIOLATION, SUBSTITUTION, TIMEOUT, JUMP_BALL, START, END, REPLAY = 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 13, 18


def order_pbp(pbp: DataFrame, of_game: dict[str, Column] | None = None) -> DataFrame:
    """pbp with `pos`, the row's place in its game.

    By period; period starts first and ends last; clock down; event number.  The attempts of a trip (free throws of one
    player at one clock) stand together where its first is listed, in order of attempt.  A column __ft, the `free_throw` of the
    description, is taken as it is.  of_game: aggregates of a game by name, which come from the same pass over its rows.
    """
    attempt = F.col("__ft") if "__ft" in pbp.columns else free_throw(F.col("description"))
    numbered = (F.col("msg_type") == FREE_THROW) & attempt["of"].isNotNull()
    rows = pbp.withColumn("__attempt", F.when(numbered, attempt["n"]))
    trip = Window.partitionBy("game_id", "period", "pctime_sec", "p1_id", "msg_type")
    listed = F.when(F.col("__attempt").isNotNull(), F.min("event_num").over(trip)).otherwise(F.col("event_num"))
    phase = F.when(F.col("msg_type") == START, -1).when(F.col("msg_type") == END, 1).otherwise(0)
    place = F.struct(F.col("period"), phase, -F.col("pctime_sec"), listed, F.coalesce("__attempt", F.lit(0)), F.col("event_num"))
    rows, game = rows.withColumn("__place", place), over(["game_id"], ["__place"])
    whole = game.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.select("*", F.row_number().over(game).cast("long").alias("pos"), *[c.over(whole).alias(name) for name, c in (of_game or {}).items()]).drop("__place", "__attempt")


def foul_states(pbp: DataFrame) -> DataFrame:
    """Each foul with both teams' team fouls before it, in the period and in the last two minutes."""
    rows = order_pbp(pbp).filter(F.col("msg_type") == FOUL)
    team = rows.withColumn("is_team", rules.is_team_foul(F.col("action_type")) & F.col("p1_team_id").isNotNull())
    late = F.col("pctime_sec") <= rules.TWO_MINUTES_S
    before = Window.partitionBy("game_id", "period").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    mine = before.partitionBy("game_id", "period", "p1_team_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    count = lambda cond, w: F.coalesce(F.sum(cond.cast("int")).over(w), F.lit(0))
    out = team.select(
        "game_id", "event_num", "period", "pctime_sec", "pos", "p1_team_id", "p1_id", rules.foul_detail(F.col("action_type")).alias("detail"), "is_team",
        count(F.col("is_team"), mine).alias("fouls_before"), count(F.col("is_team") & late, mine).alias("late_before"),
        count(F.col("is_team"), before).alias("__all"), count(F.col("is_team") & late, before).alias("__all_late"),
    )
    out = out.withColumn("opp_before", F.col("__all") - F.col("fouls_before")).withColumn("opp_late_before", F.col("__all_late") - F.col("late_before"))
    state = lambda f, a, b: f(F.col("period"), F.col("pctime_sec"), F.col(a), F.col(b))
    return out.drop("__all", "__all_late", "pos").select(
        "*", state(rules.in_penalty, "fouls_before", "late_before").alias("in_penalty"), state(rules.fouls_to_give, "fouls_before", "late_before").alias("to_give"),
        state(rules.in_penalty, "opp_before", "opp_late_before").alias("opp_in_penalty"),
    )


def foul_state_at(fouls: DataFrame, times: DataFrame) -> DataFrame:
    """Team fouls of each team at many times at once; both sides carry game_id, period and the time `t_ms`,
    times also a team_id and a clock."""
    own = fouls.filter("is_team").withColumn("late", (F.col("pctime_sec") <= rules.TWO_MINUTES_S).cast("int"))
    w = over(["game_id", "period", "p1_team_id"], ["t_ms", "event_num"]).rowsBetween(Window.unboundedPreceding, 0)
    run = own.select("game_id", "period", F.col("p1_team_id").alias("team_id"), "t_ms", "event_num", F.count("*").over(w).alias("n"), F.sum("late").over(w).alias("n_late"))
    last = run.groupBy("game_id", "period", "team_id", "t_ms").agg(F.max("n").alias("n"), F.max("n_late").alias("n_late"))
    found = asof(times, last, ["game_id", "period", "team_id"], "t_ms", ["n", "n_late"])
    n, late = F.coalesce("n", F.lit(0)), F.coalesce("n_late", F.lit(0))
    return found.select(*times.columns, n.alias("team_fouls"), late.alias("late_fouls"), rules.in_penalty(F.col("period"), F.col("pctime_sec"), n, late).alias("in_penalty"))


def possession_estimate(pbp: DataFrame, team_rebounds: bool = False) -> DataFrame:
    """Per game attempts - offensive rebounds + turnovers + 0.44 free throws, technical ones apart.

    A rebound is offensive when the team of the last missed shot or free throw takes it; the first
    rebound after a shot uses it up.
    """
    rows = order_pbp(pbp)
    w = over(["game_id"], ["pos"]).rowsBetween(Window.unboundedPreceding, -1)
    event = F.when(F.col("msg_type").isin(MISSED, FREE_THROW), F.struct(F.col("p1_team_id").alias("team"), F.col("msg_type").alias("msg"))).when(
        F.col("msg_type") == REBOUND, F.struct(F.lit(None).cast(dict(rows.dtypes)["p1_team_id"]).alias("team"), F.lit(0).alias("msg"))
    )
    by_team = F.coalesce(F.col("p1_is_team"), F.lit(False)) if "p1_is_team" in pbp.columns else F.lit(False)
    rows = rows.withColumn("__last", F.last(event, ignorenulls=True).over(w))
    counts = ~by_team | (F.lit(team_rebounds) & (F.col("__last.msg") == MISSED))
    offensive = (F.col("msg_type") == REBOUND) & (F.col("__last.team") == F.col("p1_team_id")) & counts
    common = (F.col("msg_type") == FREE_THROW) & ~F.col("description").contains("Technical")
    out = rows.groupBy("game_id").agg(
        F.count_if(F.col("msg_type").isin(MADE, MISSED)).alias("attempts"), F.count_if(offensive).alias("offensive_rebounds"), F.count_if(F.col("msg_type") == TURNOVER).alias("turnovers"), F.count_if(common).alias("free_throws")
    )
    return out.withColumn("possessions", F.col("attempts") - F.col("offensive_rebounds") + F.col("turnovers") + 0.44 * F.col("free_throws"))


def splits(games: DataFrame, train: float = 0.8, val: float = 0.1, folds: int = 5, seed: int = 9) -> DataFrame:
    """Games with split, parity by date order, and fold by a seeded hash rank.

    The latest games by date are the test part; validation is picked among the earlier by the hash.
    Games are a few thousand, so ranks over all of them are one small task.
    """
    by_date, by_hash = Window.orderBy("game_date", "game_id"), Window.orderBy(F.xxhash64("game_id", F.lit(seed)), "game_id")
    n = F.count("*").over(Window.partitionBy(F.lit(0)))
    rows = games.select("game_id", "game_date", F.row_number().over(by_date).alias("i"), (F.row_number().over(by_hash) % folds).alias("fold"), n.alias("n"))
    early = rows.withColumn("early", F.col("i") <= F.floor(F.col("n") * (train + val)))
    rank = F.row_number().over(Window.partitionBy("early").orderBy(F.xxhash64("game_id", F.lit(seed + 1)), "game_id"))
    split = F.when(~F.col("early"), "test").when(F.col("r") <= F.floor(F.col("n") * val), "val").otherwise("train")
    return early.withColumn("r", rank).select("game_id", "game_date", split.alias("split"), ((F.col("i") - 1) % 2).alias("parity"), "fold")


def is_terminal(msg_type: Column) -> Column:
    return msg_type.isin(MADE, MISSED, TURNOVER, FOUL, VIOLATION, TIMEOUT, END)


def free_throw_links(pbp: DataFrame) -> DataFrame:
    """Free throws with the foul each comes from.

    The first of a trip takes the latest foul of the other team at its clock that no trip has used
    (technical free throws take technical fouls, which serve again); later ones of the shooter keep the trip's.
    Which fouls are used depends on the rows before, so a game's fouls and free throws are read in order.
    """
    ft = free_throw(F.col("description"))
    rows = order_pbp(pbp).filter(F.col("msg_type").isin(FOUL, FREE_THROW) & ((F.col("msg_type") == FOUL) | F.col("p1_team_id").isNotNull()))
    technical = F.when(F.col("msg_type") == FOUL, rules.is_technical(F.col("action_type"))).otherwise(ft["kind"] == "technical")
    rows = rows.select("game_id", "pos", "event_num", "period", "pctime_sec", "msg_type", F.col("p1_team_id").alias("team"), F.col("p1_id").alias("player"), technical.alias("technical"), ft["n"].alias("n"), ft["of"].alias("of"), F.replace(ft["kind"], F.lit(" "), F.lit("_")).alias("kind"), ft["made"].alias("made"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        open_fouls: dict[tuple, list] = {}
        trips: dict[tuple, int] = {}
        out = []
        for r in pdf.sort_values("pos").itertuples(index=False):
            place = (r.period, r.pctime_sec, r.technical)
            if r.msg_type == FOUL:
                open_fouls.setdefault(place, []).append((r.event_num, r.team))
                continue
            link = trips.get((r.player, r.technical)) if not pd.isna(r.n) and r.n > 1 else None
            if link is None:
                here = open_fouls.get(place, [])
                fits = [k for k, (_, team) in enumerate(here) if team != r.team and (r.technical or not pd.isna(team))]
                if fits:
                    link = here[fits[-1]][0]
                    if not r.technical:
                        here.pop(fits[-1])
            if link is not None:
                trips[r.player, r.technical] = link
            out.append((r.game_id, r.event_num, r.period, r.pctime_sec, r.team, r.player, r.n, r.of, r.kind or "regular", r.made, link))
        return pd.DataFrame(out, columns=names).astype({"n": "Int64", "of": "Int64", "foul_event_num": "Int64"})

    kinds = dict(pbp.dtypes)
    schema = f"game_id {kinds['game_id']}, event_num long, period long, pctime_sec {kinds['pctime_sec']}, team_id long, player_id long, n long, of long, kind string, made boolean, foul_event_num long"
    names = [c.split()[0] for c in schema.split(", ")]
    return rows.groupBy("game_id").applyInPandas(run, schema)


def event_possession(events: DataFrame, ledger: DataFrame) -> DataFrame:
    """Events (game_id, t_ms, ...) with the possession that began last, without a check of its end."""
    starts = ledger.filter("t_start_ms is not null").select("game_id", F.col("t_start_ms").alias("t_ms"), "poss_seq", "offense_team_id")
    starts = starts.groupBy("game_id", "t_ms").agg(F.max(F.struct("poss_seq", "offense_team_id")).alias("p")).select("game_id", "t_ms", "p.*")
    return asof(events, starts, ["game_id"], "t_ms", ["poss_seq", "offense_team_id"]).drop("match_t_ms")


def offense_at(frames: DataFrame, ledger: DataFrame) -> DataFrame:
    """Team in possession at each frame (game_id, period, t_ms), null between possessions."""
    spans = ledger.filter("t_start_ms is not null").select("game_id", "period", F.col("t_start_ms").alias("t_ms"), "t_end_ms", "offense_team_id")
    spans = spans.groupBy("game_id", "period", "t_ms").agg(F.max(F.struct("t_end_ms", "offense_team_id")).alias("p")).select("game_id", "period", "t_ms", "p.*")
    found = asof(frames, spans, ["game_id", "period"], "t_ms", ["t_end_ms", "offense_team_id"])
    return found.select(*frames.columns, F.when(F.col("t_ms") <= F.col("t_end_ms"), F.col("offense_team_id")).alias("offense_team_id"))
