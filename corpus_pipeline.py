"""Corpus pipeline over `documents`: quality rules, line dedup, near-dedup, substring dedup, packing.

Each stage works on all rows its predecessor kept; its result is written as Parquet to the shared folder and
read again.  All stages but the last return the columns of their input.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtframes.llm import line_dedup, packing, quality_rules, simhash, substring
from courtframes.llm.common import materialise, table


def _with_length(docs: DataFrame) -> DataFrame:
    """n_chars, where it is there, follows the changed text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the isolation forests reject go."""
    return quality_rules.judge(docs, table(spark, sf_dir, "labels")).filter("kept").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines, and of single lines of content, are cut from texts; no document goes."""
    return _with_length(line_dedup.dedup_lines(docs, line_words=line_dedup.LINE_WORDS).select(*docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row of the smallest id stays, without an id only where no row has one.

    Rows are told apart by id and all that they hold, so rows of one id that are near nothing all stay.
    """
    key = F.struct(
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        F.xxhash64("text").alias("version"),
        F.xxhash64(*docs.columns).alias("all"),
    )
    # all columns of docs in one, so that no name can clash
    keyed = docs.select(key.alias("row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("text").alias("text"))
    groups = simhash.components(keyed, id_col="row")
    first = groups.filter("row = component_id").select("row").distinct()
    return keyed.select("row", "doc").join(first, "row", "left_semi").dropDuplicates(["row"]).select("doc.*")


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document also has are cut from texts; no document goes."""
    return _with_length(substring.cut_passages(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", drop_low_quality),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeated_passages),
    ("packing", pack),
]

#: Forests, passages and packing are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
