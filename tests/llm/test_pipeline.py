"""The pipeline stage by stage on a small corpus with planted cases."""

from __future__ import annotations

import random

import corpus_pipeline
from pyspark.sql import functions as F
from courtframes.llm.common import materialise, table

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    rng = random.Random(1)
    text = lambda n: "\n".join(" ".join(f"w{rng.randrange(3000)}" for _ in range(12)) for _ in range(n))
    clean, passage = [text(12) for _ in range(6)], " ".join(f"p{i}" for i in range(60))
    planted = [(10**6 + i, t, "en", "planted", len(t)) for i, t in enumerate(clean)]
    planted += [(10**6 + 10 + i, clean[0], "en", "planted", len(clean[0])) for i in range(3)]
    planted += [(10**6 + 20 + i, f"{text(6)} {passage}\n{text(6)}", "en", "planted", 0) for i in range(3)]
    planted += [(10**6 + 30, "one two " * 60, "en", "planted", 480), (10**6 + 31, None, None, None, None)]
    docs = spark.createDataFrame(planted, docs.schema).unionByName(docs)
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
        kept[name] = {r.doc_id: r.text for r in docs.filter("doc_id >= 1000000").collect()}
    clean_ids = {10**6 + i for i in range(6)} | {10**6 + 20 + i for i in range(3)}
    assert not {10**6 + 30, 10**6 + 31} & set(kept["quality rules"])
    assert all(clean_ids <= set(k) for k in kept.values())
    assert kept["line dedup"][10**6] == clean[0] and kept["line dedup"][10**6 + 11] == ""
    assert len({10**6 + 10 + i for i in range(3)} & set(kept["simhash near-dedup"])) <= 1
    last = kept["substring dedup"]
    assert [passage in last[10**6 + 20 + i] for i in range(3)] == [True, False, False]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.groupBy("sequence_id").sum("length").filter("`sum(length)` > 4096").count() == 0
    assert pieces.select("doc_id").distinct().count() == docs.count()


def test_repeated_single_lines_go(spark):
    rng = random.Random(4)
    line = lambda n=12: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    again, short, joined = line(), "so it goes", "w" * 60
    rows = [(1, f"{line()}\n{again}\n{line()}"), (2, f"{line()}\n{again}\n{line()}\n{again}"), (3, again), (4, joined), (5, joined)]
    rows += [(6, f"{line()}\n{short}\n{line()}"), (7, f"{short}\n{line()}"), (8, short), (9, line()), (9, line()), (10, None), (None, line())]
    docs = spark.createDataFrame([(i, t, "en", "planted", 0) for i, t in rows], table(spark, SF, "documents").schema).repartition(3)
    got = sorted(tuple(r) for r in corpus_pipeline.drop_repeated_lines(spark, docs, SF).select("doc_id", "text").fillna("null").fillna(0).collect())
    expected = [(i or 0, "null" if t is None else t) for i, t in rows]
    kept = rows[1][1].split("\n")
    expected[1:5] = [(2, f"{kept[0]}\n{kept[2]}"), (3, ""), (4, joined), (5, "")]
    assert got == sorted(expected)


def test_near_dedup_keeps_rows_that_are_near_nothing(spark):
    rng = random.Random(2)
    a, b, c, d, e = (" ".join(f"w{rng.randrange(3000)}" for _ in range(80)) for _ in range(5))
    rows = [(None, a), (None, a), (None, b), (1, b), (2, c), (2, d), (2, d), (3, d), (4, c), (5, e)]
    schema = table(spark, SF, "documents").schema
    docs = spark.createDataFrame([(i, t, "en", "planted", len(t)) for i, t in rows], schema).repartition(5)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, a), (1, b), (2, c), (2, d), (5, e)], key=str)
    pieces = corpus_pipeline.pack(spark, corpus_pipeline.drop_near_duplicates(spark, docs, SF), SF)
    assert sorted((r.doc_id for r in pieces.collect()), key=str) == sorted([None, 1, 2, 2, 5], key=str)


def test_passages_are_cut_from_the_text_of_an_id_that_has_them(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    shared, clean = text(70), text(200)
    rows = [(1, f"{text(50)} {shared}"), (2, clean), (2, f"{shared} {text(40)}"), (None, text(90))]
    docs = spark.createDataFrame([(i, t, "en", "planted", len(t)) for i, t in rows], table(spark, SF, "documents").schema)
    got = {r.text for r in corpus_pipeline.cut_repeated_passages(spark, docs, SF).collect()}
    assert {rows[0][1], clean, rows[3][1]} <= got and len(got) == 4
    assert sum(shared in t for t in got) == 1


def test_stages_on_empty_rejected_and_clashing_tables(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    base = table(spark, SF, "documents").schema
    names = ["row", "doc", "gone", "id", "version", "component_id", "fp", "key", "node", "kept", "n_removed"]
    rows = [(1, text(90), "en", "planted", 0), (2, text(60), None, None, None), (3, "short", "en", "planted", 5), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, base)
    wide = docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    for start, left in ((docs.limit(0), set()), (docs.filter("doc_id = 3"), set()), (wide, {1, 2})):
        now = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = materialise(stage(spark, now, SF), "stage")
            assert set(now.columns) <= set(start.columns) and set(base.names) <= set(now.columns)
        assert {r.doc_id for r in now.collect()} == left
        assert {r.doc_id for r in corpus_pipeline.pack(spark, now, SF).collect()} == left
