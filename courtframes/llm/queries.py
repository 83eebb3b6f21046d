"""The registered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtframes.llm.common import table


def _held_out(modulus: int, rest: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) == rest


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtframes.llm import substring

    return substring.repeated_passages(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtframes.llm import simhash

    return simhash.components(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtframes.llm import toxicity

    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), allowed=~_held_out(4, 2))
    return toxicity.predict(docs, model).select("doc_id", _held_out(4, 2).alias("held_out"), "score", "predicted")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtframes.llm import quality_rules

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs, table(spark, sf_dir, "labels")).drop("text", "anomaly")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtframes.llm import line_dedup

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, line_words=line_dedup.LINE_WORDS)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtframes.llm import langid

    docs = table(spark, sf_dir, "documents").withColumn("held_out", _held_out(4, 2))
    found = langid.predict(docs, langid.fit(docs.filter("not held_out")))
    return found.select("doc_id", _held_out(4, 2).alias("held_out"), "lang_pred", "score")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtframes.llm import bpe

    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtframes.llm import embedding

    return embedding.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtframes.llm import quality_crf

    docs = table(spark, sf_dir, "documents")
    model = quality_crf.fit(docs, table(spark, sf_dir, "labels"), allowed=~_held_out(5, 0))
    return quality_crf.predict(docs, model).select("doc_id", _held_out(5, 0).alias("held_out"), "score", "predicted")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtframes.llm import packing

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtframes.llm import exact_dedup

    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtframes.llm import hard_negatives

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), "vec_id % 50 = 0")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from courtframes.llm import runs

    return runs.periodic_runs(runs.with_tails(table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def oracle_sql() -> dict[str, str]:
    from courtframes.llm import exact_dedup, hard_negatives, line_dedup

    return {"op5_line_dedup": line_dedup.oracle(), "op11_exact_dedup": exact_dedup.oracle(), "op12_hard_negatives": hard_negatives.oracle()}
