"""Moving screens (L2.20): screens of a player who is not slow enough for a set one, and closes in on the defender."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtframes.operators import events as ev
from courtframes.operators import kernels as kn
from courtframes.operators.events import FRAME, PERIOD, player_rows

# Speed caps in hundredths of a foot a second, how far the screener closes in and in what time, how near a set screen is the same one.
SET_CFT, MOVING_CFT = 600, 900
CLOSING_CFT, CLOSING_MS = 100, 500
SAME_MS = 1000
TRIPLE = ["s", "u", "d"]


def moving_screens(entities: DataFrame, handlers: DataFrame, frames: int = 5, same_ms: int = SAME_MS, pairs: DataFrame | None = None) -> DataFrame:
    """Screens under the wider speed cap, with closing_cft: how much nearer the screener is to the defender at the contact than half a second before.

    Those that close in by less than a foot are none, nor are those whose contact lies in or near a set screen of the same screener, user and defender: an
    anti range join over buckets of time, so a triple's screens do not all meet.  pairs: those of `events.screen_pairs` under the wider cap, where they are stored.
    """
    pairs = ev.screen_pairs(entities, handlers, slow_cft=MOVING_CFT) if pairs is None else pairs
    found, sets = (ev.screen_runs(pairs, cap, frames) for cap in (MOVING_CFT, SET_CFT))
    near = sets.select("game_id", "period", *TRIPLE, (F.least("t_start_ms", F.col("t_contact_ms") - same_ms)).alias("__lo"), F.greatest("t_end_ms", F.col("t_contact_ms") + same_ms).alias("__hi"))
    found = kn.range_join(found, near, [*PERIOD, *TRIPLE], "t_contact_ms", "__lo", "__hi", 4 * same_ms, how="left_anti")
    players = player_rows(entities)
    moments = players.select(*PERIOD, F.col("unix_ms").alias("__before")).distinct().withColumn("__frame", F.lit(True))
    rows = kn.asof(found.withColumn("__before", F.col("t_contact_ms") - CLOSING_MS), moments, PERIOD, "__before", ["__frame"])
    rows = rows.drop("__before", "__frame").withColumnRenamed("match___before", "__before")
    # places of both players at both times are read from one dealing of the players by frame
    one = [*PERIOD, "s", "d", "t_contact_ms"]
    asked = rows.select(*one, F.explode(F.array("t_contact_ms", "__before")).alias("unix_ms")).distinct()
    there = kn.dealt(players, FRAME, entities).join(asked, FRAME).filter("player_id = s or player_id = d")
    place = lambda who: F.max(F.when(F.col("player_id") == F.col(who), F.struct("x_cft", "y_cft")))
    places = there.groupBy(*one, "unix_ms").agg(*[place(who).alias(f"__{who}") for who in ("s", "d")])
    for at, name in (("t_contact_ms", "now"), ("__before", "then")):
        named = places.select(*one, F.col("unix_ms").alias("__at"), *[F.col(f"__{who}").alias(f"__{name}_{who}") for who in ("s", "d")])
        rows = rows.withColumn("__at", F.col(at)).join(named, [*one, "__at"], "left").drop("__at")
    apart = lambda name: F.hypot(F.col(f"__{name}_s.x_cft") - F.col(f"__{name}_d.x_cft"), F.col(f"__{name}_s.y_cft") - F.col(f"__{name}_d.y_cft"))
    rows = rows.withColumn("closing_cft", apart("then") - apart("now"))
    return rows.filter(F.col("closing_cft") >= CLOSING_CFT).select(*found.columns, "closing_cft")
