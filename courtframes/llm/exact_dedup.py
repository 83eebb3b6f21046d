"""Exact duplicates by skew-safe combining, in DataFrame operations alone.

Texts are equal when they are the same without ASCII blanks.  Rows are combined in three steps, and each step groups on the whole
normalised text beside its digest, so no result rests on the digest.  First every task combines its own rows (the partial side
of the first aggregate), so a text with very many copies leaves a task as one row.  Then the local winners of a digest and text are
merged under a salt, so that what all tasks say of one text is met by several tasks.  Last the winners of the salts are combined.

A document learns its group by its digest alone where the digest has one text among all rows, as counted.  If any digest had two,
documents would be joined on digest and text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtframes.llm.common import materialise

#: Tasks that share what all tasks say of one text.
SALTS = 16
_BLANKS = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without ASCII blanks; null is empty."""
    text = F.coalesce(text, F.lit(""))
    for c in _BLANKS:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _rows(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column] | None) -> DataFrame:
    """own (all columns of docs), id, chars, sha, norm and key; the key is the digest that deals rows."""
    text = F.col(f"`{text_col}`")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(F.length(text), F.lit(0)).alias("chars"),
        normalised(text).alias("norm"),
    ).withColumn("sha", F.unhex(F.sha2("norm", 256)))
    return rows.withColumn("key", digest(F.col("sha")) if digest else F.col("sha"))


def groups(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """(key, norm, keep_id, keep_chars, size) of each text: the longest original, then the least id; a null id comes last."""
    # one number that grows with the length and falls with the id, so that aggregates stay of fixed width
    rank = F.expr(f"cast(chars as decimal(10, 0)) * {1 << 64}BD - coalesce(cast(id as decimal(20, 0)), {1 << 63}BD)")
    local = rows.select("key", "norm", "id", "chars", rank.alias("rank"), F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))
    merged = local.groupBy("key", "norm", "salt").agg(F.max_by("id", "rank").alias("id"), F.max("rank").alias("rank"), F.max("chars").alias("chars"), F.count(F.lit(1)).alias("size"))
    return merged.groupBy("key", "norm").agg(F.max_by("id", "rank").alias("keep_id"), F.max("chars").alias("keep_chars"), F.sum("size").alias("size"))


def _judged(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column] | None, salts: int) -> DataFrame:
    rows = _rows(docs, id_col, text_col, digest)
    texts = groups(rows, salts)
    # without the texts: a row for each of them
    told = materialise(texts.drop("norm"), "texts")
    by = ["key"]
    if told.groupBy("key").count().filter("count > 1").limit(1).count():
        by, told = ["key", "norm"], materialise(texts, "texts")
    # only texts that repeat have news for their rows; both sides are plain shuffles, whose skewed parts adaptive execution splits
    repeated = told.filter("size > 1")
    found = rows.join(repeated, by, "left")
    alone = F.col("size").isNull()
    return found.select(
        "own",
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] | None = None, salts: int = SALTS) -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points in its original text stays, then that of the least id; a null id comes
    after all others.  Null texts are empty, and empty and blank texts are equal.  Repeated rows count in group_size, and rows
    that share the id and the length of the one that stays are one document and stay alike.  An empty table gives no rows;
    other columns play no part, whatever their names.  digest replaces the SHA-256 that deals rows; the result does not depend on it.
    """
    found = _judged(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), "id", "text", digest, salts)
    return found.select(F.col("own.id").alias(id_col), "keep_id", "group_size", "kept", "text_sha256")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows of docs that stay, with all their columns; see exact_duplicates."""
    return _judged(docs, id_col, text_col, None, salts).filter("kept").select(*[F.col("own").getField(c).alias(c) for c in docs.columns])


def oracle() -> str:
    """DuckDB SQL of exact_duplicates over documents."""
    return r"""
    with n as (select doc_id, length(coalesce(text, '')) as chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm from documents),
    w as (select norm, count(*) as size, first(doc_id order by chars desc, doc_id nulls last) as keep_id, max(chars) as keep_chars from n group by norm)
    select n.doc_id, w.keep_id, cast(w.size as bigint) as group_size,
           n.doc_id is not distinct from w.keep_id and n.chars = w.keep_chars as kept, sha256(n.norm) as text_sha256
    from n join w on n.norm = w.norm"""
