"""Registered queries against their SQL at the smallest size, and kernels against plain loops."""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from courtframes.operators import kernels as kn

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
NAMES = [n for n in __spark_entry__.oracle_sql() if not n.startswith("op")]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: round(float(v), 4) if isinstance(v, float) else int(v) if isinstance(v, bool) else v
    return sorted(repr(tuple(plain(r[i]) for i in order)) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    got = __spark_entry__.queries()[name](spark, SF)
    expected = duck.sql(__spark_entry__.oracle_sql()[name])
    assert sorted(got.columns) == sorted(expected.columns)
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows(expected.columns, expected.fetchall())


def _series(spark, seqs):
    rows = [(k, i, v) for k, seq in enumerate(seqs) for i, v in enumerate(seq)]
    return spark.createDataFrame(rows, "key int, t int, v int")


def _rle(seq):
    out = []
    for v in seq:
        if out and out[-1][0] == v:
            out[-1][1] += 1
        else:
            out.append([v, 1])
    return out


def test_state_kernels_match_loops(spark):
    rng = random.Random(3)
    seqs = [[v for _ in range(rng.randint(1, 25)) for v in [rng.choice([-1, 1, 2])] * rng.randint(1, 7)] for _ in range(150)]
    table = kn.runs(_series(spark, seqs), ["key"], "t", ["v"])
    sticky = {(r.key, r.run_id): r.state for r in kn.sticky(table, ["key"], "v", 3).collect()}
    control = {(r.key, r.run_id): r.control for r in kn.hysteresis(table, ["key"], "v", 2, 5).collect()}
    for key, seq in enumerate(seqs):
        runs, held, team = _rle(seq), -1, -1
        for i, (v, n) in enumerate(runs):
            after = runs[i + 1] if i + 1 < len(runs) else None
            if n >= 3 or (v != -1 and after and after[0] == -1 and after[1] >= 3):
                held = v
            assert sticky[key, i + 1] == held
            loose = i > 0 and runs[i - 1][0] == -1 and runs[i - 1][1] >= 2
            if v not in (-1, team) and (n >= 5 or loose or (team == -1 and n >= 2)):
                team = v
            assert control[key, i + 1] == team


def test_folds_match_loops(spark):
    rng = random.Random(4)
    seqs = [sorted(rng.sample(range(5000), rng.randint(1, 40))) for _ in range(50)]
    df = spark.createDataFrame([(k, t) for k, s in enumerate(seqs) for t in s], "key int, t int")
    groups = {(r.key, r.t): r.group_start for r in kn.anchored_groups(df, ["key"], "t", 300).collect()}
    kept = {(r.key, r.t) for r in kn.thin(df, ["key"], "t", 200).collect()}
    for key, seq in enumerate(seqs):
        start, last = None, None
        for t in seq:
            if start is None or t - start > 300:
                start = t
            assert groups[key, t] == start
            fits = last is None or t - last >= 200
            assert ((key, t) in kept) == fits
            last = t if fits else last


def test_asof_without_matches_and_empty_sides(spark):
    left = spark.createDataFrame([(1, 10, "a"), (2, 5, "b")], "key int, t int, name string")
    right = spark.createDataFrame([(1, 12, 7)], "key int, t int, x int")
    assert {(r.name, r.x) for r in kn.asof(left, right, ["key"], "t", ["x"]).collect()} == {("a", None), ("b", None)}
    assert {(r.name, r.x) for r in kn.asof(left, right, ["key"], "t", ["x"], forward=True).collect()} == {("a", 7), ("b", None)}
    assert kn.asof(left.limit(0), right, ["key"], "t", ["x"]).count() == 0
    assert {r.x for r in kn.asof(left, right.limit(0), ["key"], "t", ["x"]).collect()} == {None}


def test_content_hash_ignores_order(spark):
    df = spark.range(100).withColumn("x", F.col("id") % 7)
    assert kn.content_hash(df).collect() == kn.content_hash(df.orderBy(F.desc("x")).repartition(7)).collect()
    assert kn.content_hash(df).collect() != kn.content_hash(df.withColumn("x", F.col("x") + 1)).collect()
