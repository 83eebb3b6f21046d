"""Nested game JSON as tables: entity rows, raw events, rosters.

A moment is an array of mixed types, so moments are read as strings and cast field by field.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLAYER = "struct<playerid:bigint,firstname:string,lastname:string,jersey:string,position:string>"
_SIDE = f"struct<teamid:bigint,abbreviation:string,players:array<{_PLAYER}>>"
GAME = f"gameid string, gamedate string, events array<struct<eventId:string,home:{_SIDE},visitor:{_SIDE},moments:array<array<string>>>>"
ENTITY = T.ArrayType(T.ArrayType(T.DoubleType()))


def read_games(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: gameid, gamedate, events; files that are no game have null gameid.  See `problems`."""
    text = spark.read.text(path, wholetext=True).withColumn("file", F.input_file_name())
    return text.select("file", F.from_json("value", GAME).alias("g")).select("file", F.lpad("g.gameid", 10, "0").alias("game_id"), "g.gamedate", "g.events")


def problems(games: DataFrame) -> DataFrame:
    """Files without an id or without events, as rows instead of failures."""
    empty = F.coalesce(F.size("events"), F.lit(0)) <= 0
    reason = F.when(F.col("game_id").isNull(), "no_game").when(empty, "no_events")
    return games.select("file", "game_id", reason.alias("reason")).filter("reason is not null")


def _moments(games: DataFrame) -> DataFrame:
    events = games.filter("game_id is not null").select("game_id", F.posexplode("events").alias("event_pos", "e"))
    rows = events.select("game_id", "event_pos", F.col("e.eventId").try_cast("int").alias("event_id"), F.posexplode("e.moments").alias("moment_idx", "m"))
    return rows.select(
        "game_id", "event_pos", "event_id", "moment_idx", F.get("m", F.lit(0)).try_cast("tinyint").alias("period"), F.get("m", F.lit(1)).try_cast("bigint").alias("unix_ms"),
        F.get("m", F.lit(2)).try_cast("float").alias("game_clock"), F.get("m", F.lit(3)).try_cast("float").alias("shot_clock"), F.from_json(F.get("m", F.lit(5)), ENTITY).alias("entities"),
    )


def entity_rows(games: DataFrame) -> DataFrame:
    """One row per moment and entity; moments without entities give none."""
    e = F.col("x")
    rows = _moments(games).select("game_id", "event_id", "moment_idx", "period", "unix_ms", "game_clock", "shot_clock", F.explode("entities").alias("x"))
    return rows.select(
        "game_id", "event_id", "moment_idx", "period", "unix_ms", "game_clock", "shot_clock", e[0].cast("long").alias("team_id"), e[1].cast("long").alias("player_id"),
        e[2].cast("float").alias("x"), e[3].cast("float").alias("y"), e[4].cast("float").alias("z"),
    )


def tracking_events(games: DataFrame) -> DataFrame:
    """Per raw event the number of moments and the clock and time of the first and the last."""
    own = F.struct("moment_idx", "period", "unix_ms", "game_clock")
    rows = _moments(games).groupBy("game_id", "event_pos", "event_id").agg(F.count("*").alias("n_moments"), F.min(own).alias("first"), F.max(own).alias("last"))
    return rows.select("game_id", "event_id", "n_moments", F.col("first.period").alias("period"), F.col("first.unix_ms").alias("t_start_ms"), F.col("first.game_clock").alias("clock_start"), F.col("last.unix_ms").alias("t_end_ms"), F.col("last.game_clock").alias("clock_end"))


def roster(games: DataFrame) -> DataFrame:
    """Players of both teams from the first event that lists any."""
    events = games.filter("game_id is not null").select("game_id", F.posexplode("events").alias("event_pos", "e"))
    sides = events.select("game_id", "event_pos", F.explode(F.array(F.struct(F.lit("home").alias("side"), F.col("e.home").alias("t")), F.struct(F.lit("visitor").alias("side"), F.col("e.visitor").alias("t")))).alias("s"))
    listed = sides.filter(F.size("s.t.players") > 0)
    first = listed.groupBy("game_id", "s.side").agg(F.min_by("s", "event_pos").alias("s"))
    rows = first.select("game_id", "side", F.col("s.t.teamid").alias("team_id"), F.col("s.t.abbreviation").alias("team"), F.explode("s.t.players").alias("p"))
    return rows.select("game_id", "side", "team_id", "team", F.col("p.playerid").alias("player_id"), F.col("p.firstname").alias("first_name"), F.col("p.lastname").alias("last_name"), "p.jersey", "p.position")
