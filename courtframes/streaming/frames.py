"""Streaming form of entity dedup and of frame rows, for feeds that arrive while a game runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ENTITY = ["game_id", "period", "unix_ms", "team_id", "player_id"]


def dedup_entities(raw: DataFrame, delay: str = "10 seconds") -> DataFrame:
    """First arrival of each entity and time; rows later than the watermark are dropped by it.

    State is kept for the watermark's delay only, not for the game.
    """
    timed = raw.withColumn("at", F.timestamp_millis("unix_ms")).withWatermark("at", delay)
    return timed.dropDuplicatesWithinWatermark(ENTITY)


def frame_rows(entities: DataFrame, width: str = "1 second") -> DataFrame:
    """Entities, players and balls per game, period and window of time, emitted once the window closes."""
    return entities.groupBy("game_id", "period", F.window("at", width)).agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("team_id") != -1).alias("n_players"), F.count_if(F.col("team_id") == -1).alias("n_balls"), F.approx_count_distinct("unix_ms").alias("n_frames")
    )
