"""Table sources and sinks: play-by-play CSV, versioned table catalog, manifests, public export, subsets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtframes.functions.text import clock_seconds, margin, padded_id
from courtframes.operators.kernels import content_hash

# Names of play-by-play message codes.
MESSAGES = {1: "made", 2: "missed", 3: "free_throw", 4: "rebound", 5: "turnover", 6: "foul", 7: "violation", 8: "substitution", 9: "timeout", 10: "jump_ball", 11: "ejection", 12: "period_start", 13: "period_end", 18: "replay"}
# Columns of the play-by-play file and the names they get.
INTEGERS = {"EVENTNUM": "event_num", "EVENTMSGTYPE": "msg_type", "EVENTMSGACTIONTYPE": "action_type", "PERIOD": "period"}
PERSONS = {f"PLAYER{i}_{a}": f"p{i}_{b}" for i in (1, 2, 3) for a, b in (("ID", "id"), ("TEAM_ID", "team_id"))}


def read_strings(spark: SparkSession, path: str) -> DataFrame:
    """CSV with every column as a string and NA as null; callers cast what they use."""
    return spark.read.csv(path, header=True, inferSchema=False, nullValue="NA", quote='"', escape='"')


def read_pbp(spark: SparkSession, path: str) -> DataFrame:
    """Typed play-by-play: padded ids, clock in seconds, scores, margin with TIE as 0, message names."""
    raw = read_strings(spark, path)
    names = F.create_map(*[F.lit(x) for kv in MESSAGES.items() for x in kv])
    number = lambda c: F.col(c).try_cast("double").try_cast("bigint")
    score = F.split("SCORE", " - ")
    rows = raw.select(
        padded_id(F.col("GAME_ID")).alias("game_id"), *[number(a).cast("int").alias(b) for a, b in INTEGERS.items()], clock_seconds(F.col("PCTIMESTRING")).alias("pctime_sec"),
        *[number(a).alias(b) for a, b in PERSONS.items() if a in raw.columns], F.get(score, F.lit(0)).try_cast("int").alias("score_visitor"), F.get(score, F.lit(1)).try_cast("int").alias("score_home"),
        margin(F.col("SCOREMARGIN")).alias("score_margin"), F.col("HOMEDESCRIPTION").alias("home_desc"), F.col("VISITORDESCRIPTION").alias("visitor_desc"),
    )
    return rows.withColumn("msg_name", F.coalesce(names[F.col("msg_type")], F.lit("other")))


@dataclass(frozen=True)
class Catalog:
    """Tables of versions under one root: <root>/<version>/<name>; frame-grain ones are dealt by game."""

    spark: SparkSession
    root: str

    def table(self, name: str, version: str = "latest", game_id: str | None = None, columns: list[str] | None = None) -> DataFrame:
        """The filter and the columns reach the scan."""
        df = self.spark.read.parquet(f"{self.root}/{version}/{name}")
        df = df if game_id is None else df.filter(F.col("game_id") == game_id)
        return df if columns is None else df.select(*columns)

    def events(self, types: list[str] | None = None, version: str = "latest", game_id: str | None = None) -> DataFrame:
        """Events of the types, without columns that these never fill; one aggregation finds those."""
        df = self.table("events", version, game_id)
        df = df if types is None else df.filter(F.col("event_type").isin(types))
        filled = df.agg(*[F.count(f"`{c}`").alias(c) for c in df.columns]).first()
        return df.select(*[f"`{c}`" for c in df.columns if filled[c] or c == "event_type"])

    def write(self, df: DataFrame, name: str, version: str = "latest", by_game: bool = False, order: list[str] | None = None) -> None:
        """zstd Parquet; by_game makes one folder per game, with its rows in order."""
        if by_game:
            df = df.repartition("game_id").sortWithinPartitions("game_id", *(order or []))
        writer = df.write.mode("overwrite").option("compression", "zstd")
        (writer.partitionBy("game_id") if by_game else writer).parquet(f"{self.root}/{version}/{name}")

    def manifest(self, names: list[str], version: str = "latest") -> DataFrame:
        """One row per table: rows, order-free content hash, schema."""
        out = None
        for name in names:
            df = self.table(name, version)
            df = df.select(*sorted(df.columns))
            row = content_hash(df).select(F.lit(name).alias("table"), "*", F.lit(df.schema.simpleString()).alias("schema"))
            out = row if out is None else out.unionByName(row)
        return out


def compare_manifests(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Each table of either side: same, different, missing (theirs only) or extra (ours only)."""
    both = ours.alias("a").join(theirs.alias("b"), "table", "full")
    same = (F.col("a.n_rows") == F.col("b.n_rows")) & (F.col("a.content_hash").eqNullSafe(F.col("b.content_hash")))
    state = F.when(F.col("a.n_rows").isNull(), "missing").when(F.col("b.n_rows").isNull(), "extra").when(same, "same").otherwise("different")
    return both.select("table", state.alias("state"))


def public_columns(df: DataFrame, policy: str = "none") -> DataFrame:
    """Columns that may be published: all, without coordinates (none), or with those of shots only (shot)."""
    place = lambda c: c in ("x", "y", "z") or c.startswith(("x_", "y_", "z_")) or c.endswith(("_x", "_y", "_z", "_xy"))
    if policy == "all":
        return df
    keep = [c for c in df.columns if not place(c) or (policy == "shot" and "shot" in c)]
    return df.select(*keep)


def pick_games(games: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n games in order of a seeded hash, for subsets that do not change with the order of rows."""
    return games.orderBy(F.xxhash64("game_id", F.lit(seed)), "game_id").limit(n)
