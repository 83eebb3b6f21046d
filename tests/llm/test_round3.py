"""Exact dedup, hard negatives and periodic runs against brute force, with the awkward cases."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict
from zlib import crc32

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from courtframes.llm import exact_dedup, hard_negatives, queries, runs

DOCS = "doc_id long, text string"
SF = "/root/testdata/sf0.01"
BLANK = re.compile("[\x20\x09-\x0d]")
WORD = re.compile("[^\x20\x09-\x0d]+")


def answers(sql):
    con = duckdb.connect()
    for name in ("documents", "embeddings"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con.execute(sql).fetchall()


@pytest.fixture(scope="module")
def awkward(spark):
    long = "word " * 50_000
    texts = [None, "", " \t\n\x0b\x0c\r", "a b", "ab", "a\nb", "a  b", "Ab", "日本 語", "日本語", long, long + " ", "a\xa0b", "a b"]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(3, "a b", "x", 2), (None, "ab  ", "x", 1), (None, "日本語", "x", 1), (6, "ab", "y", 3)]
    return spark.createDataFrame(rows, DOCS + ", keep_id string, size int").repartition(5)


def brute_groups(rows):
    found = defaultdict(list)
    for i, t in rows:
        found[BLANK.sub("", t or "")].append((-len(t or ""), i is None, i or 0, i))
    out = []
    for text, own in found.items():
        best = min(own)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(x[3], best[3], len(own), x == best, sha) for x in own]
    return sorted(out, key=str)


@pytest.mark.parametrize("digest", [None, lambda sha: F.substring(sha, 1, 0), lambda sha: F.expr("cast(ascii(hex(sha)) % 3 as string)")])
def test_exact_duplicates(spark, awkward, digest):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    found = exact_dedup.exact_duplicates(awkward, digest=digest, salts=3)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == brute_groups(rows)


def test_exact_duplicates_depend_on_no_dealing(spark):
    rows = [(i, f"t {i % 7}" + " " * (i % 5)) for i in range(500)]
    want = brute_groups(rows)
    for n in (1, 4, 37):
        assert sorted(map(tuple, exact_dedup.exact_duplicates(spark.createDataFrame(rows, DOCS).repartition(n)).collect()), key=str) == want


def test_exact_dedup_keeps_whole_rows(spark, awkward):
    kept = exact_dedup.drop_duplicates(awkward)
    assert kept.schema == awkward.schema
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in brute_groups([(r.doc_id, r.text) for r in awkward.collect()]) if r[3]}
    assert exact_dedup.exact_duplicates(awkward.limit(0)).count() == exact_dedup.drop_duplicates(awkward.limit(0)).count() == 0


def test_exact_dedup_sql(spark):
    found = queries.op11_exact_dedup(spark, SF)
    assert sorted(map(tuple, found.collect())) == sorted(answers(exact_dedup.oracle()))


def brute_negatives(rows, anchor, positives=5, negatives=3):
    rows = {i: (label, np.floor(np.array(x, float) * 256).astype(object)) for i, label, x in rows}
    out = []
    for a, (label, x) in rows.items():
        if not anchor(a):
            continue
        scored = sorted((-int(sum(x * y)), i, own) for i, (own, y) in rows.items() if i != a and len(y) == len(x))
        for p, pos, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [(n, i) for n, i, own in scored if own != label and 50 * -p <= 100 * -n <= 95 * -p]
            out += [(a, pos, k + 1, i, -p, -n) for k, (n, i) in enumerate(inside[:negatives])]
    return sorted(out)


@pytest.mark.parametrize("kind", ["random", "ties", "zero"])
def test_hard_negatives(spark, monkeypatch, kind):
    monkeypatch.setattr(hard_negatives, "BLOCK", 60)
    monkeypatch.setattr(hard_negatives, "BATCH", 7)
    rng = np.random.default_rng(3)
    x = {"random": rng.standard_normal((400, 12)), "ties": rng.integers(-1, 2, (400, 5)) / 2, "zero": rng.integers(0, 2, (400, 4)) * rng.integers(0, 2, (400, 1))}[kind]
    rows = [(i, int(rng.integers(0, 4)), [float(v) for v in y]) for i, y in enumerate(x)]
    found = hard_negatives.hard_negatives(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>"), "vec_id % 10 = 0")
    got = sorted(tuple(r) for r in found.collect())
    assert got == brute_negatives([(i, own, np.float32(y)) for i, own, y in rows], lambda i: i % 10 == 0)
    assert got


def test_hard_negatives_awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 1.0]), (1, 1, [1.0, 0.9]), (2, 2, [0.6, 0.6]), (2, 2, [0.6, 0.6]), (3, 2, [0.5, nan]), (4, 2, [0.5, None]), (5, 2, None), (6, None, [0.7, 0.7]), (7, 2, [inf, 0.0])]
    rows += [(None, 2, [0.7, 0.7]), (8, 2, [0.7]), (9, 2, []), (10, 1, []), (11, 1, [1e300, -1e300]), (12, 2, [1e300, 0.0]), (13, 3, [0.0, 0.0]), (20, 1, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<double>, block string")
    got = sorted(tuple(r) for r in hard_negatives.hard_negatives(df, "vec_id in (0, 9)").collect())
    assert [r[:4] for r in got if r[1] == 1] == [(0, 1, 1, 2)] and {r[0] for r in got} == {0}
    assert hard_negatives.hard_negatives(df.limit(0), "vec_id = 0").count() == 0


def test_hard_negatives_sql(spark):
    found = queries.op12_hard_negatives(spark, SF)
    want = answers(f"select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from ({hard_negatives.oracle()})")
    assert sorted(map(tuple, found.collect())) == sorted(want) and want


def test_reading_ends_early():
    rng = np.random.default_rng(1)
    x = np.zeros((4000, 3))
    x[:, 0] = rng.permutation(4000)
    lists = hard_negatives.Lists(x, np.arange(4000))
    rows, scores = lists.read(np.array([1.0, 0, 0]), lambda r, s, t: len(s) >= 5 and t < np.partition(s, len(s) - 5)[len(s) - 5])
    assert len(rows) < 50 and set(np.sort(scores)[-5:]) == {3999, 3998, 3997, 3996, 3995}


def brute_runs(w):
    n, found = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)  # the smallest comes first
            i = j
    return sorted((s, length, q) for (s, length), q in found.items())


def brute_document(i, text):
    w = WORD.findall(text or "")
    n, h = len(w), None if i is None else crc32(str(i).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    found = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
    drop = {k for s, length, q in found for k in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (i, len(found), *best, None if not found else 1000 * best[1] // best[2], sha("".join(f"{s},{length},{q}\n" for s, length, q in found)), sha(" ".join(x for k, x in enumerate(w) if k not in drop)))


def test_transform_multiplies_exactly():
    rng = np.random.default_rng(0)
    for s in (1, 2, 4, 64, 1024):
        b, w = rng.integers(0, 50_000, (3, s)), rng.integers(0, 50_000, (3, 2 * s - 1))
        w[0, s // 2 : s // 2 + s] = b[0]
        want = [[sum((int(x) - int(y)) ** 2 for x, y in zip(b[r], w[r, j : j + s])) % runs.PRIME for j in range(s)] for r in range(3)]
        assert runs.mismatches(b, w).tolist() == want
        assert want[0][s // 2] == 0


def test_runs_against_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        texts = []
        for _ in range(rng.randrange(1, 6)):
            w = [rng.randrange(3) for _ in range(rng.randrange(0, 40))]
            for _ in range(rng.randrange(0, 4)):
                base = [rng.randrange(rng.choice([1, 2, 5, 50])) for _ in range(rng.randrange(1, 20))]
                w += (base * rng.randrange(1, 9))[: rng.randrange(1, 120)]
            texts.append(w)
        first = np.append(0, np.cumsum([len(w) for w in texts]))
        code = np.array([c for w in texts for c in w], np.int64)
        want = [(int(lo) + s, length, q) for lo, w in zip(first, texts) for s, length, q in sorted(brute_runs(w), key=lambda r: (r[0], r[2]))]
        assert [tuple(r) for r in runs.find_runs(code, first).tolist()] == want


def test_periodic_runs_of_documents(spark):
    rng = random.Random(2)
    texts = [None, "", " \n", "a", "a a a a a a", "a a a a a", "A a A a A a A a", "x y  z\tx y z\nx y z x y z x", "b\xa0b " * 7, "q " * 5000]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(200))) for _ in range(150)]
    texts.append(" ".join(f"w{rng.randrange(10**6)}" for _ in range(3000)))
    rows = [(i, t) for i, t in enumerate(texts)] + [(4, "a a a a a a"), (None, "a a a a a a a")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], DOCS + ", runs int, id string").repartition(3)
    got = sorted(map(tuple, runs.periodic_runs(runs.with_tails(df)).collect()), key=str)
    assert got == sorted((brute_document(*r) for r in rows), key=str)
    assert runs.periodic_runs(runs.with_tails(df.limit(0))).count() == 0


def test_periodic_runs_of_a_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    short = docs.filter("length(text) < 6000")
    got = {r.doc_id: tuple(r) for r in runs.periodic_runs(runs.with_tails(short)).collect()}
    want = {r.doc_id: brute_document(r.doc_id, r.text) for r in short.select("doc_id", "text").collect()}
    assert got == want


def test_pieces_of_a_text_do_not_matter(spark, monkeypatch):
    df = spark.createDataFrame([(i, "a b c " * 300 + f"t{i} " * 9 + "z" * i) for i in range(20)], DOCS)
    want = sorted(map(tuple, runs.periodic_runs(df).collect()))
    monkeypatch.setattr(runs, "JOINED", 7)
    monkeypatch.setattr(runs, "BATCH", 64)
    raw = runs.collapse_runs(df)
    assert sorted(map(tuple, runs.digests(raw).collect())) == want
