"""Owners of log rows against a plain walk, and control that the ledger masks."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from courtframes.operators import possessions
from courtframes.operators import spans as sp
from courtframes.operators.playbyplay import order_pbp
from tests.test_possessions import A, B, _rows


def test_owners_are_the_plain_walk(spark):
    rng = random.Random(13)
    kinds = [(1, "Jump Shot"), (2, "MISS Jump Shot"), (4, "Rebound"), (5, "Turnover"), (6, "Foul"), (9, "")]
    parts = []
    for period in (1, 2, 3):
        log = [(n, 700 - n % 1000, *(lambda k: (k[0], 1, 21, rng.choice([A, B]), None, k[1], False))(rng.choice(kinds))) for n in range(1000 * period, 1000 * period + 300)]
        rows = _rows(spark, log).withColumn("period", F.lit(period))
        # the helper's own first and last rows get numbers of the period
        parts.append(rows.withColumn("event_num", F.when(F.col("event_num") < 50, F.col("event_num") + 1000 * period - 10).when(F.col("event_num") == 99, 1000 * period + 400).otherwise(F.col("event_num"))))
    pbp = parts[0].unionByName(parts[1]).unionByName(parts[2])
    ledger = possessions.possessions(pbp)
    ends = [(r.poss_seq, r.period, r.end_event_num) for r in ledger.orderBy("poss_seq").collect()]
    want, k = {}, 0
    for r in order_pbp(pbp).orderBy("pos").collect():
        while k < len(ends) - 1 and ends[k][1] < r.period:
            k += 1
        want[r.event_num] = ends[k][0]
        # possessions that one row ends are all over behind it
        while r.event_num == ends[k][2] and k < len(ends) - 1:
            k += 1
    got = {r.event_num: r.poss_seq for r in sp.event_owners(pbp, ledger).collect()}
    assert [(e, got.get(e), o) for e, o in want.items() if got.get(e) != o] == []
    assert len(got) == len(want) and len(set(got.values())) > 100
    assert sp.event_owners(pbp, ledger.limit(0)).count() == 0


def test_control_outside_the_ledger_is_nobodys(spark):
    handlers = spark.createDataFrame([(1, 1, t, team) for t, team in ((0, 100), (40, 100), (80, 200), (120, 200), (160, -1), (900, 200))] + [(1, 2, 40, 100)], "game_id int, period int, unix_ms long, control_team_id int")
    ledger = spark.createDataFrame([(1, 1, 40, 120, 100), (1, 1, 120, 200, 200), (1, 1, None, None, 100)], "game_id int, period int, t_start_ms long, t_end_ms long, offense_team_id int")
    got = {(r.period, r.unix_ms): r.control_team_id for r in sp.constrained_control(handlers, ledger).collect()}
    assert got == {(1, 0): -1, (1, 40): 100, (1, 80): -1, (1, 120): 200, (1, 160): -1, (1, 900): -1, (2, 40): -1}
