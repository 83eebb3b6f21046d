"""Counts and distributions over the tables: box scores, links of official shots, acceptance reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtframes.operators import kernels as kn
from courtframes.operators.playbyplay import FREE_THROW, MADE, MISSED, REBOUND, TURNOVER


def box_counts(pbp: DataFrame) -> DataFrame:
    """Per game and player: attempts, makes, threes, free throws, points, rebounds and turnovers."""
    msg, text = F.col("msg_type"), F.col("description")
    made, three, free = msg == MADE, text.contains("3PT"), msg == FREE_THROW
    scored = free & ~F.upper(text).startswith("MISS")
    return pbp.filter(F.col("p1_id").isNotNull()).groupBy("game_id", "p1_team_id", "p1_id").agg(
        F.count_if(msg.isin(MADE, MISSED)).alias("fga"), F.count_if(made).alias("fgm"), F.count_if(made & three).alias("fg3m"), F.count_if(free).alias("fta"), F.count_if(scored).alias("ftm"),
        F.sum(F.when(made & three, 3).when(made, 2).when(scored, 1).otherwise(0)).alias("points"), F.count_if(msg == REBOUND).alias("rebounds"), F.count_if(msg == TURNOVER).alias("turnovers"),
    )


def score_check(official: DataFrame, counted: DataFrame) -> DataFrame:
    """Full outer comparison of points per game and team (team_id, points), missing ones as 0."""
    a = official.select("game_id", "team_id", F.col("points").alias("official"))
    b = counted.select("game_id", "team_id", F.col("points").alias("counted"))
    both = a.join(b, ["game_id", "team_id"], "full").fillna(0, ["official", "counted"])
    return both.withColumn("agrees", F.col("official") == F.col("counted"))


def distribution(df: DataFrame, columns: list[str]) -> DataFrame:
    """Least, 5th, 50th and 95th percentile and largest value of each column, in one pass."""
    at = [0.0, 0.05, 0.5, 0.95, 1.0]
    row = df.agg(*[F.percentile(c, F.array(*[F.lit(p) for p in at])).alias(c) for c in columns])
    long = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("q")) for c in columns]))
    return row.select(long.alias("r")).select("r.column", *[F.get("r.q", F.lit(i)).alias(n) for i, n in enumerate(("low", "p05", "p50", "p95", "high"))])


def link_in_order(shots: DataFrame, pbp: DataFrame, keys: list[str]) -> DataFrame:
    """Official shots with the play-by-play row of the same ordinal in their key; source order is `line`."""
    rows = pbp.filter(F.col("msg_type").isin(MADE, MISSED)).select(*keys, "event_num")
    return kn.ordinal_pairs(shots, rows, keys, ["line"], ["event_num"]).drop("nth")


def error_summary(pairs: DataFrame, got: str, truth: str, by: list[str]) -> DataFrame:
    """Median error and shares within one and two units of paired values, per group."""
    err = F.abs(F.col(got) - F.col(truth))
    return pairs.filter(F.col(got).isNotNull() & F.col(truth).isNotNull()).groupBy(*by).agg(
        F.count("*").alias("n"), F.percentile(err, F.lit(0.5)).alias("median_error"), F.avg((err <= 100).cast("double")).alias("within_1"), F.avg((err <= 200).cast("double")).alias("within_2")
    )
