"""Matching of rows between tables: greedy one-to-one in time, and names through a cascade of keys."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def greedy_match(old: DataFrame, new: DataFrame, keys: list[str], time: str, old_id: str, new_id: str, tolerance: int) -> DataFrame:
    """One-to-one pairs of equal keys within tolerance, closest first, then by old and new id.

    Candidates come from a join on keys and time buckets; only keys with candidates are read in order, each by itself.
    """
    a = old.select(*keys, F.col(old_id).alias("old_id"), F.col(time).alias("ta"), F.explode(F.array(*[F.floor(F.col(time) / tolerance) + d for d in (-1, 0, 1)])).alias("__b"))
    b = new.select(*keys, F.col(new_id).alias("new_id"), F.col(time).alias("tb"), F.floor(F.col(time) / tolerance).alias("__b"))
    near = a.join(b, [*keys, "__b"]).withColumn("dt", F.abs(F.col("ta") - F.col("tb"))).filter(F.col("dt") <= tolerance).select(*keys, "old_id", "new_id", "dt")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right, take = set(), set(), []
        for i, (x, y) in enumerate(zip(pdf["old_id"], pdf["new_id"])):
            if x not in left and y not in right:
                left.add(x), right.add(y), take.append(i)
        return pdf.iloc[take]

    # pairs that share neither end with others of their key need no order
    w = Window.partitionBy
    alone = (F.count("*").over(w(*keys, "old_id")) == 1) & (F.count("*").over(w(*keys, "new_id")) == 1)
    marked = near.withColumn("__alone", alone)
    single = marked.filter("__alone").drop("__alone")
    rest = marked.filter("not __alone").drop("__alone")
    walked = rest.groupBy(*keys).applyInPandas(lambda pdf: run(pdf.sort_values(["dt", "old_id", "new_id"])), rest.schema)
    return single.unionByName(walked)


def resolve(names: DataFrame, known: DataFrame, name: str, group: str, target: str) -> DataFrame:
    """names with target found by name and group, else by a name that is unique in known; `match` says which."""
    unique = lambda df, by: df.groupBy(*by).agg(F.min(target).alias(target), F.countDistinct(target).alias("__n")).filter("__n = 1").drop("__n")
    first = names.join(unique(known, [name, group]), [name, group], "left")
    second = first.filter(F.col(target).isNull()).drop(target).join(unique(known, [name]), name, "left")
    label = lambda df, text: df.withColumn("match", F.when(F.col(target).isNotNull(), text).otherwise("none"))
    return label(first.filter(F.col(target).isNotNull()), "name_group").unionByName(label(second, "name"))


def best_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key by several criteria."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__r = 1").drop("__r")
