"""Text operators against brute force, round trips and held-out accuracy, with the awkward cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from tokenizers import Tokenizer

from courtframes.llm import bpe, common, embedding, langid, line_dedup, packing, quality_crf, quality_rules, simhash, substring, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def words(rng, n, pool=4000):
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty, blank, long, tied and repeated texts, with columns whose names clash."""
    rng = random.Random(1)
    texts = [None, "", "   ", "\n\n", "a", "Ünï 日本 🎉 'll", "x" * 20_000, words(rng, 30_000), "same text here now", "same text here now", "tail \n", " head"]
    rows = [(i, t, None, None, None, "x", 1) for i, t in enumerate(texts)] + [(8, "same text here now", None, None, None, "x", 1)]
    return spark.createDataFrame(rows, DOCS + ", fp string, n_lines int").repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 1, 1), (8, 0, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def corpus(spark):
    return common.table(spark, SF, "documents"), common.table(spark, SF, "labels")


def test_bpe_matches_library_and_decodes(spark, awkward):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load(path).ranks, special_tokens={})
    texts = dict(awkward.select("doc_id", "text").collect())
    rows = bpe.encode_documents(awkward, path).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        text = texts[r.doc_id] or ""
        ids = np.array(enc.encode_ordinary(text), "<u4")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode_documents(awkward.limit(0), path).count() == 0


def test_bpe_tree_on_random_pieces():
    tree = bpe.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tree.ranks, special_tokens={})
    rng = random.Random(2)
    parts = ["a", "aa", "th", "ing", "é", "日", " ", "\n", "1", "!!", "　", "\x1c", "\x85", "\xa0", "'s", "Zz" * 30]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    got = []
    for ids, bounds in bpe.encode_column(pa.array(texts), tree, bpe.split_pattern(), bpe.Memory()):
        got += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    assert got == [enc.encode_ordinary(t) for t in texts]


def test_packing_covers_every_id_once(spark, awkward):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack(awkward, path, capacity=256).collect()
    tokenizer = Tokenizer.from_file(path)
    texts = dict(awkward.select("doc_id", "text").collect())
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids = np.array(tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids + [2], "<u4")
        copies = 2 if doc == 8 else 1
        assert sum(p.length for p in pieces) == copies * len(ids)
        for p in pieces:
            assert p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack(awkward.limit(0), path).count() == 0


def test_packing_ids_match_library_on_odd_texts(spark):
    rng = random.Random(4)
    parts = ["a", "Aa", "th", "é", "È", "ß", "日本", " ", "  ", "\n", "\t", ".", ",", "1", "12", "!!", "'s", "'LL", "don't", "<|endoftext|>", "<|EndOfText|>"]
    parts += ["<|startoftext|>", "<|", "|>", "\u0301", "e\u0301", "İ", "×", "÷", "\u3000", "\x85", "\xa0", "ſ", "\u212a", "क\u093c", "#", "-", "🎉", "ǆ", "\x1c", "Σ", "ŉ", "x" * 50]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in packing.tokenised(docs, path).collect()}
    for i, text in enumerate(texts):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [2], "<u4")
        assert got[i] == (len(ids), zlib.crc32(ids.tobytes())), text


def test_packing_takes_the_cheapest_sequence_with_room():
    rng = np.random.default_rng(5)
    for _ in range(30):
        lengths = rng.choice([1, 7, 50, 60, 100], int(rng.integers(0, 40)))
        sequence, offset = packing.pack_lengths(lengths, 100)
        left, first = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)), 0
        while left:
            n, later = -(-sum(lengths[i] for i in left) // 100), []
            load, used = [0.0] * n, [0] * n
            for i in left:
                room = [k for k in range(n) if used[k] + lengths[i] <= 100]
                if not room:
                    later.append(i)
                    continue
                k = min(room, key=lambda k: (load[k], k))
                assert (sequence[i], offset[i]) == (first + k, used[k])
                used[k] += lengths[i]
                load[k] += lengths[i] + lengths[i] ** 2 / 1024
            first, left = first + n, later


def test_packing_spreads_one_document_and_repeated_rows(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.createDataFrame([(1, "a b " * 30_000), *[(2, "one text here")] * 300, (None, None)], "doc_id long, text string")
    rows = packing.pack(docs, path, capacity=16).collect()
    assert sum(r.length for r in rows if r.doc_id == 1) == 60_001 and sum(r.doc_id == 2 for r in rows) == 300
    assert max(Counter(r.sequence_id % (-(-len(rows) // packing.GROUP_PIECES)) for r in rows).values()) < 1.3 * packing.GROUP_PIECES
    used = Counter()
    for r in rows:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 16


def test_packing_is_tight_and_balanced():
    lengths = np.random.default_rng(3).integers(1, 4097, 2000)
    sequence, offset = packing.pack_lengths(lengths, 4096)
    used = np.bincount(sequence, weights=lengths)
    assert used.max() <= 4096 and lengths.sum() / (4096 * (used > 0).sum()) > 0.93


def test_simhash_components_match_brute_force(spark, awkward):
    rng = random.Random(5)
    base = [words(rng, 60) for _ in range(15)]
    near = [" ".join(w if rng.random() > 0.02 else "changed" for w in t.split()) for t in base for _ in range(6)]
    rows = [(100 + i, t) for i, t in enumerate(base + near)]
    docs = awkward.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r for r in simhash.components(docs).collect()}
    texts = dict(docs.collect())

    def fingerprint(text):
        w = (text or "").encode().lower().split()
        if not w:
            return 0
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = {d: fingerprint(t) for d, t in texts.items()}
    ids = sorted(fps)
    low = {d: d for d in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if (fps[a] ^ fps[b]).bit_count() <= 2 and low[b] < low[a]:
                    low[a], changed = low[b], True
    assert {d: r.fingerprint for d, r in got.items()} == {d: f"{f:016x}" for d, f in fps.items()}
    assert {d: r.component_id for d, r in got.items()} == low
    assert simhash.components(docs.limit(0)).count() == 0


@pytest.mark.parametrize("level", [1, 3, 5])
def test_filters_of_large_labels_hold_few_vectors_and_lose_no_pairs(level):
    rng = np.random.default_rng(level)
    for dim in (64, 128):
        share = embedding.SHARE / 4**level
        assert embedding.level_of(int(4**level * embedding.FILL / embedding.SHARE), dim) == level
        a, z = (embedding._unit(rng.standard_normal((300, dim))) for _ in range(2))
        z = embedding._unit(z - (z * a).sum(1, keepdims=True) * a)
        found = [embedding.list_decode(x, embedding.TURNS + 2 * level, embedding.CODES << level, share) for x in (a, 0.931 * a + np.sqrt(1 - 0.931**2) * z)]
        assert np.mean([len(np.intersect1d(x, y)) > 0 for x, y in zip(*found)]) >= 0.99
        # a vector is in so many filters of a turn, whatever the level, so each holds `share` of them
        assert 3 < np.mean([len(x) for x in found[0]]) / (embedding.TURNS + 2 * level) < 5.5
    assert embedding.level_of(10**12, 3) == 0


def test_embedding_levels_by_label(spark):
    rng = np.random.default_rng(9)
    base = rng.standard_normal((120, 64))
    near = base + 0.3 * rng.standard_normal((120, 64))
    rows = [(i, [float(v) for v in x], 1 if i % 3 else 2) for i, x in enumerate(base)] + [(1000 + i, [float(v) for v in x], 1 if i % 3 else 2) for i, x in enumerate(near)]
    df = spark.createDataFrame([*rows, (None, rows[0][1], 2)], "vec_id long, embedding array<double>, label int")
    plain, levels = ({r.vec_id: tuple(r) for r in embedding.near_duplicates(df, fill=f).collect()} for f in (256, 1e-3))
    assert plain == levels and plain[None] == (None, 0, None, None) and sum(r[1] for r in plain.values()) > 200


def test_embedding_links_match_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = []
    for b in rng.standard_normal((25, 64)):
        for _ in range(int(rng.integers(1, 12))):
            v = b + rng.standard_normal(64) * np.linalg.norm(b) / 8 * rng.uniform(0.05, 0.4)
            rows.append(([float(x) for x in v.astype(np.float32)], int(rng.integers(0, 2))))
    rows += [rows[0]] * 20
    odd = [(None, 1), ([0.0] * 64, 1), ([1.0] * 64, None), ([float("nan")] * 64, 1), ([1.0, None] * 32, 1), ([], 1)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows + odd)], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in embedding.near_duplicates(df).collect()}
    u = np.array([r[0] for r in rows])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    same = np.array([r[1] for r in rows])
    close = (u @ u.T >= 0.93) & (same[:, None] == same[None, :]) & ~np.eye(len(u), dtype=bool)
    links = np.array([got[i].n_links for i in range(len(rows))])
    assert (links <= close.sum(1)).all()
    assert links.sum() >= 0.98 * close.sum()
    for i in range(len(rows), len(rows) + len(odd)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert embedding.near_duplicates(df.limit(0)).count() == 0


def test_vectors_of_extreme_size_and_mixed_length(spark):
    rng = np.random.default_rng(16)
    v = rng.standard_normal(32)
    rows = [v * 1e200, v * 1e-200, v, v[:16], v[:16] * 3, np.append(v[:31], 50.0)]
    df = spark.createDataFrame([(i, [float(x) for x in r], 1, 5) for i, r in enumerate(rows)], "vec_id long, embedding array<double>, label int, node int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding.near_duplicates(df).collect()}
    assert got == {0: (2, 0), 1: (2, 0), 2: (2, 0), 3: (1, 3), 4: (1, 3), 5: (0, 5)}


def test_connected_components(spark):
    rng = random.Random(7)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(70)] + [(500, k) for k in range(501, 700)] + [(3, 3)]
    got = dict(common.connected_components(spark.createDataFrame(edges, "u long, v long").repartition(5)).collect())
    low = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    assert all(got.get(n, n) == c for n, c in low.items())


def test_line_dedup_matches_loop(spark, awkward):
    rng = random.Random(8)
    pool = [f"line {i}" for i in range(30)] + ["", ""]
    rows = [(100 + i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))) for i in range(80)]
    docs = awkward.select("doc_id", "text").distinct().unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    seen = set()
    for doc, text in sorted(docs.collect()):
        lines = text.split("\n") if text is not None else []
        gone = set()
        for i in range(len(lines) - 1):
            run = (lines[i], lines[i + 1])
            if any(run):
                gone |= {i, i + 1} if run in seen else set()
                seen.add(run)
        expected = None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
        assert (got[doc].text, got[doc].n_lines, got[doc].n_removed) == (expected, len(lines), len(gone))
    assert line_dedup.dedup_lines(awkward).count() == awkward.count()
    assert line_dedup.dedup_lines(awkward.limit(0)).count() == 0


def test_line_dedup_cuts_single_lines_of_content(spark, awkward):
    rng = random.Random(18)
    full = [f"a line of content number {i}" for i in range(25)] + ["x" * 40, "  " + "y" * 39 + "  "]
    pool = full + [f"line {i}" for i in range(40)] + ["", " "]
    rows = [(100 + i, "\n".join(rng.choice(pool) for _ in range(rng.choice([1, 1, 3, 9])))) for i in range(90)]
    docs = awkward.select("doc_id", "text").distinct().unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs, line_words=line_dedup.LINE_WORDS).collect()}
    runs, singles = set(), set()
    for doc, text in sorted(docs.collect()):
        lines = text.split("\n") if text is not None else []
        gone = set()
        for i in range(len(lines)):
            run = tuple(lines[i : i + 2])
            if len(run) == 2 and any(run):
                gone |= {i, i + 1} if run in runs else set()
                runs.add(run)
            if len(lines[i].strip(" ")) >= 40 or len(re.findall(r"[^ \t-\r]+", lines[i])) >= 5:
                gone |= {i} if lines[i] in singles else set()
                singles.add(lines[i])
        expected = None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
        assert (got[doc].text, got[doc].n_lines, got[doc].n_removed) == (expected, len(lines), len(gone))


def test_compact_windows_match_brute_force():
    rng = np.random.default_rng(9)
    for _ in range(100):
        first = np.append(0, np.cumsum(rng.integers(0, 40, 4)))
        tokens = rng.integers(1, 12, first[-1]).astype(np.uint64)
        width = int(rng.integers(2, 8))
        expected = set()
        for a, b in zip(first[:-1], first[1:]):
            for c in range(a, b):
                lo = hi = c
                while lo > a and tokens[lo - 1] > tokens[c]:
                    lo -= 1
                while hi < b - 1 and tokens[hi + 1] >= tokens[c]:
                    hi += 1
                if hi - lo + 1 >= width:
                    expected.add((lo, c, hi))
        assert set(zip(*[x.tolist() for x in substring.compact_windows(tokens, first, width)])) == expected


def test_passages_are_found_and_cut(spark, awkward):
    rng = random.Random(10)
    shared, other = words(rng, 60), words(rng, 120)
    edited = " ".join("new" if i in (30, 80) else w for i, w in enumerate(other.split()))
    texts = [f"{words(rng, 100)} {shared} {words(rng, 90)}", f"{words(rng, 40)} {shared}", f"{shared} {words(rng, 70)}", f"{words(rng, 30)} {other} {words(rng, 30)}", f"{words(rng, 60)} {edited} {words(rng, 20)}", words(rng, 300)]
    docs = spark.createDataFrame([(100 + i, t, None, None, None) for i, t in enumerate(texts)], DOCS).unionByName(awkward.select(*[c.split()[0] for c in DOCS.split(", ")]))
    rows = substring.repeated_passages(docs).collect()
    classes = {}
    for r in rows:
        classes[r.doc_id] = classes[r.match_doc_id] = r.class_id
        assert r.similarity >= 0.8 and r.end_word - r.start_word >= 50
    assert {d: c for d, c in classes.items() if d >= 100} == {100: 100, 101: 100, 102: 100, 103: 103, 104: 103}
    cut = {r.doc_id: r.text for r in substring.cut_passages(docs).collect()}
    assert cut[100] == texts[0] and cut[105] == texts[5] and cut[103] == texts[3]
    assert shared not in cut[101] and cut[101].split() == texts[1].split()[:40]
    assert cut[102].split() == texts[2].split()[60:]
    assert cut[0] is None and cut[1] == ""
    assert substring.repeated_passages(docs.limit(0)).count() == 0


def test_every_stand_of_a_passage_is_found(spark):
    rng = random.Random(11)
    shared = [words(rng, 60) for _ in range(40)]
    rows = []
    for i, p in enumerate(shared):
        middle = " ".join(p.split()[20:40])
        rows.append((2 * i, f"{words(rng, 50)} {p} {words(rng, 50)}"))
        rows.append((2 * i + 1, f"{words(rng, 50)} {middle} {words(rng, 50)} {p} {words(rng, 50)} {p} {words(rng, 50)}"))
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    cut = {r.doc_id: r.text for r in substring.cut_passages(docs).collect()}
    assert all(cut[i] == t for i, t in rows if i % 2 == 0)
    assert [sum(p in cut[2 * i + 1] for i, p in enumerate(shared)), max(len(cut[2 * i + 1].split()) for i in range(40))] == [0, 220]


def test_matching_places_by_diagonal():
    rng = np.random.default_rng(12)
    for _ in range(20):
        a, b = rng.integers(0, 9, 300).astype(np.uint32), rng.integers(0, 9, 260).astype(np.uint32)
        b[40:120] = a[100:180]
        found = [set(substring._diagonals(a, b, np.ones(300, bool), np.ones(260, bool), 46)) for substring.MATCHES in (1 << 22, 0)]
        assert found[0] == found[1] and any(p <= 100 and q >= 179 and p - r == 60 for p, q, r, _ in found[0])
    substring.MATCHES = 1 << 22
    none = np.arange(50, dtype=np.uint32)
    assert not list(substring._diagonals(none, none + np.uint32(100), np.ones(50, bool), np.ones(50, bool), 46))


def test_links_do_not_hang_on_batches(spark):
    rng = random.Random(13)
    phrase, rows = words(rng, 9), []
    for i in range(150):
        rows.append((i, f"{words(rng, 60)} {phrase} {words(rng, 60)}"))
    near = rows[5][1].split()
    near[20], near[64 + 30] = "other", "changed"
    rows.append((1000, " ".join(near)))
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    for parts in (1, 7, 151):
        found = {(r.match_doc_id, r.doc_id) for r in substring.passage_links(docs.repartition(parts)).collect()}
        assert found == {(5, 1000)}


def test_passage_links_against_all_pairs(spark, corpus):
    """Whatever the dealing, the same rows; each pair of texts that all-pairs comparison verifies is in one class."""
    docs = corpus[0].select("doc_id", "text")
    found = [{tuple(r) for r in substring.passage_links(docs.repartition(parts)).collect()} for parts in (2, 13, 64)]
    assert found[0] == found[1] == found[2] and found[0]
    low = {}

    def least(x):
        while low.setdefault(x, x) != x:
            x = low[x]
        return x

    for r in found[0]:
        a, b = least(r[0]), least(r[3])
        low[max(a, b)] = min(a, b)
    rows = docs.orderBy("doc_id").collect()
    hashes, first, _ = substring.shingles(*[np.concatenate(x) for x in zip(*[(np.frombuffer((r.text or "").encode() + b"\n", np.uint8),) for r in rows])], np.append(0, np.cumsum([len((r.text or "").encode()) + 1 for r in rows])))
    own = [hashes[i:j] for i, j in zip(first[:-1], first[1:])]
    holders = {}
    for i, x in enumerate(own):
        for h in np.unique(x).tolist():
            holders.setdefault(h, []).append(i)
    common_shingles = {(a, b) for group in holders.values() for k, b in enumerate(group) for a in group[:k]}
    true = [(a, b) for a, b in common_shingles if substring.verify_pair(own[a], own[b], 46, 0.8)]
    exact = [(a, b) for a, b in true if np.isin(substring._rolled(own[a], 46), substring._rolled(own[b], 46)).any()]
    together = lambda pairs: sum(least(rows[a].doc_id) == least(rows[b].doc_id) for a, b in pairs)
    assert len(exact) > 50 and together(exact) == len(exact)
    assert len(true) > len(exact) and together(true) >= 0.99 * len(true)


def test_a_text_between_true_copies_does_not_part_them(spark):
    """Texts that share a phrase but not the passage stand, by id, before and between two copies."""
    rng = random.Random(14)
    phrase = words(rng, 24)
    rows = [(i, f"{words(rng, 60)} {phrase} {words(rng, 60)}") for i in range(40)]
    passage = f"{words(rng, 30)} {phrase} {words(rng, 30)}"
    rows[10], rows[30] = ((i, f"{words(rng, 50)} {passage} {words(rng, 50)}") for i in (10, 30))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.match_doc_id, r.doc_id) for r in substring.passage_links(docs).collect()} == {(10, 30)}


@pytest.mark.parametrize("shared", [45, 48, 49])
def test_copies_are_linked_whatever_the_earliest_text_shares(spark, shared):
    """The earliest text of each group shares less than the passage with two later texts, which share all of it."""
    rng = random.Random(shared)
    rows = []
    for g in range(150):
        passage = words(rng, 50, 10**6).split()
        part = passage[:shared] if g % 2 else passage[-shared:]
        for k, own in enumerate((part, passage, passage)):
            rows.append((1000 * k + g, f"{words(rng, 40, 10**6)} {' '.join(own)} {words(rng, 40, 10**6)}"))
    # many texts with most of one passage, before and between its copies
    passage = words(rng, 50, 10**6).split()
    rows += [(10_000 + i, f"{words(rng, 30, 10**6)} {' '.join(passage if i in (7, 31, 32) else passage[i % 3 : i % 3 + 46])} {words(rng, 30, 10**6)}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = {(r.match_doc_id, r.doc_id) for r in substring.passage_links(docs).collect()}
    assert {(1000 + g, 2000 + g) for g in range(150)} <= found
    classes = {r.doc_id: r.class_id for r in substring.repeated_passages(docs).collect()}
    assert classes[10_031] == classes[10_032] and len({(a, b) for a, b in found if a >= 10_000 and {a, b} <= {10_007, 10_031, 10_032}}) >= 2


def test_names_of_stretches():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 1 << 32, 200).astype(np.uint32)
    rolled = substring._rolled(x, 46)
    assert len(np.unique(rolled)) == len(rolled) == 155
    assert np.array_equal(substring._rolled(x[30:90], 46), rolled[30:45])
    b = np.concatenate([x[50:95], rng.integers(0, 1 << 32, 100).astype(np.uint32)])
    names = lambda a, b: substring._stretches(a, b, 46, np.isin(b, a)).view(np.uint64).tolist()
    rank = substring.ranks_of(b, 1)
    least = [i + int(rank[i : i + 46].argmin()) for i in range(len(b) - 45)]
    assert names(x, b) == sorted(substring._rolled(b, 46)[[i for i, p in enumerate(least) if p < 45]].tolist()) and len(names(x, b)) > 5
    assert not names(x, x[20:120]) and not names(x, b[:40]) and not names(x, b[45:])
    base = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    assert (np.diff(substring.ranks_of((base >> np.uint64(32)).astype(np.uint32), 3)[np.argsort(substring.tokens_of(base, 3))].astype(np.int64)) >= 0).all()


def test_equal_texts_and_repeated_rows_in_passages(spark):
    rng = random.Random(15)
    text = words(rng, 80)
    rows = [(3, text), (3, text), (5, text), (5, words(rng, 70)), (9, text), (None, text), (11, "few words " * 3), (12, "few words " * 3)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, __gone int, node string").repartition(5)
    found = sorted((r.match_doc_id, r.doc_id, r.start_word, r.end_word, r.class_id) for r in substring.repeated_passages(docs).collect())
    assert found == [(3, 5, 0, 80, 3), (3, 9, 0, 80, 3)]
    cut = sorted(substring.cut_passages(docs).collect(), key=str)
    assert len(cut) == len(rows) and {len((r.text or "").split()) for r in cut if r.doc_id in (5, 9)} == {0, 70}


def test_quality_rules_statistics(spark, awkward, labels):
    rows = quality_rules.judge(awkward, labels).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        w = (r.text or "").encode().split()
        w = [x.decode() for x in w]
        windows = list(zip(w, w[1:], w[2:]))
        repeated = {x for x in windows if windows.count(x) > 1} if len(w) < 100 else None
        assert r.n_words == len(w) and r.word_chars == sum(map(len, w))
        if repeated is not None:
            marks = {i + k for i, x in enumerate(windows) if x in repeated for k in range(3)}
            assert r.n_repeat_words == len(marks)
        lines = [x for x in (r.text or "").split("\n") if x.encode().split()]
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in r.text or "") and r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality_rules.judge(awkward.limit(0), labels.limit(0)).count() == 0


def _accuracy(rows, truth, key):
    pairs = [(getattr(r, key), truth[r.doc_id]) for r in rows if r.doc_id in truth]
    return sum(a == b for a, b in pairs) / len(pairs)


def test_isolation_depths_match_a_plain_walk():
    rng = np.random.default_rng(20)
    rows = np.vstack([rng.standard_normal((200, 3)), rng.standard_normal((5, 3)) * 9])
    forest = quality_rules.IsolationForest(rows, trees=20, tree_rows=64)
    total = np.zeros(len(rows))
    for feature, value, left, length in forest.trees:
        for i, row in enumerate(rows):
            at = 0
            while left[at] != at:
                at = left[at] + (row[feature[at]] >= value[at])
            total[i] += length[at]
    assert np.allclose(forest.score(rows), 2.0 ** (-total / 20 / forest.norm))
    assert forest.score(rows)[200:].mean() > forest.score(rows)[:200].mean()


def test_boosted_trees_match_plain_trees():
    rng = np.random.default_rng(21)
    x = rng.integers(0, 6, (120, 3)).astype(float)
    y = ((x[:, 0] > 2) ^ (x[:, 1] > 3)).astype(float)
    model = toxicity.BoostedTrees(x, y, rounds=3, depth=2, bins=8)

    def gain(g, h):
        return g.sum() ** 2 / (h.sum() + 1)

    f = np.full(len(y), model.start)
    for _ in range(3):
        q = 1 / (1 + np.exp(-f))
        g, h = y - q, q * (1 - q)
        leaves = [np.arange(len(y))]
        for _ in range(2):
            parts = []
            for own in leaves:
                best, found = 1e-9, (own, own[:0])
                for j in range(3):
                    for edge in model.edges[j]:
                        a, b = own[x[own, j] < edge], own[x[own, j] >= edge]
                        if (now := gain(g[a], h[a]) + gain(g[b], h[b]) - gain(g[own], h[own])) > best + 1e-12:
                            best, found = now, (a, b)
                parts += found
            leaves = parts
        for own in leaves:
            f[own] += 0.2 * g[own].sum() / (h[own].sum() + 1)
    assert np.allclose(f, model.margin(x))


def test_isotonic_steps_are_the_least_squares_rising_ones():
    rng = np.random.default_rng(22)
    for _ in range(20):
        x = rng.permutation(12).astype(float)
        y = rng.integers(0, 2, 12).astype(float)
        got = toxicity.Isotonic(x, y)(np.sort(x))
        own = y[np.argsort(x)]
        # the minimax form of isotonic regression
        plain = [max(min(own[i : j + 1].mean() for j in range(k, 12)) for i in range(k + 1)) for k in range(12)]
        assert np.allclose(got, plain)


def test_toxicity_features_on_a_plain_text():
    texts = ["you vile dog", "you dear dog"] * 30
    lexicon = toxicity.Lexicon(texts, np.array([1, 0] * 30))
    assert set(lexicon.words) == {"vile"}
    text = b"You V1LE vile!! DOG and some words more and more before you come"
    row = dict(zip(toxicity.FEATURES, toxicity.features(np.frombuffer(text, np.uint8), np.array([0, len(text)]), lexicon)[0]))
    n = len(text.split())
    assert row["lexicon density"] == 2 / n and row["obfuscated lexicon density"] == 1 / n and row["obfuscation rate"] == 1 / n
    assert row["second person density"] == 2 / n and row["near second person"] == 1 and row["exclamation"] == 2 / n


def test_quality_rules_part_the_labels(spark, corpus):
    docs, labels = corpus
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in quality_rules.judge(docs, labels).collect() if not r.base_failed and r.doc_id in truth]
    assert np.mean([r.kept for r in rows if truth[r.doc_id] == 1]) > 0.99
    assert np.mean([r.kept for r in rows if truth[r.doc_id] == 0]) < 0.2


def test_language_id(spark, corpus, awkward):
    docs, _ = corpus
    held = docs.filter("crc32(cast(cast(doc_id as string) as binary)) % 4 = 2")
    model = langid.fit(docs.filter("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2"))
    truth = {r.doc_id: r.lang for r in held.collect()}
    assert _accuracy(langid.predict(held, model).collect(), truth, "lang_pred") > 0.97
    odd = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(awkward, model).collect()}
    assert all(odd[i] == ("und", 0.0) for i in (0, 1, 2, 3))
    assert all(0 <= s <= 1 for _, s in odd.values())
    nothing = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(awkward, nothing).collect()} == {"und"}


def test_suffix_automaton_phrases_match_greedy_search():
    rng = random.Random(11)
    learned = "".join(rng.choice("abc ") for _ in range(400))
    model = langid.CrossParser({"x": [learned], "y": ["zd zd"]})
    squeezed = re.sub(" +", " ", learned).lstrip()
    texts = ["".join(rng.choice("abc d") for _ in range(n)) for n in (0, 1, 5, 200, 64, 65)] + [learned, learned + "d" + learned, learned[7:300]]
    texts = [re.sub(" +", " ", t) for t in texts]
    expected = []
    for text in texts:
        phrases, at = 0, 0
        while at < len(text):
            n = 1
            while at + n < len(text) and text[at : at + n + 1] in squeezed:
                n += 1
            phrases, at = phrases + 1, at + n
        expected.append(phrases)
    symbols = model.alphabet.letters(np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32))
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    for piece in (1, 3, 16, 64, 512):
        assert model.phrases(symbols, offsets, piece)[0].tolist() == expected


def test_models_do_not_depend_on_how_rows_are_dealt(spark, corpus):
    docs, labels = corpus
    fields, parsers = [], []
    for parts in (1, 13):
        dealt = docs.repartition(parts)
        fields.append(quality_crf.fit(dealt, labels))
        parsers.append(langid.fit(dealt))
    assert np.array_equal(fields[0].weight, fields[1].weight) and np.array_equal(fields[0].scale, fields[1].scale)
    assert parsers[0].langs == parsers[1].langs and all(np.array_equal(x, y) for a, b in zip(parsers[0].tables, parsers[1].tables) for x, y in zip(a, b))


def test_language_samples_are_whole_texts(spark, monkeypatch):
    rng = random.Random(6)
    long = "".join(rng.choice("abcdef") for _ in range(60_000))
    rows = [(long, "long"), ("b" * 700, "long"), *[(f"c{chr(97 + i)}d", "short") for i in range(20)], *[("same", "short")] * 50, (None, "none"), ("e", None)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = langid.fit(docs)
    assert model.langs == ["long", "short"]
    # all of the long text is known: one phrase
    symbols = model.alphabet.letters(np.frombuffer(long.encode("utf-32-le"), np.uint32))
    assert model.phrases(symbols, np.array([0, len(symbols)])).astype(int).tolist()[0] == [1]
    assert model.nbytes() < 40e6
    assert len(langid.fit(docs, fit_docs=5).tables[1].row) < len(model.tables[1].row)
    monkeypatch.setattr(langid, "MODEL_BYTES", 1000)
    with pytest.raises(ValueError, match="fewer rows"):
        langid.predict(docs.withColumnRenamed("lang", "doc_id"), model)


@pytest.mark.parametrize("module,label,least", [(toxicity, "toxic", 0.97), (quality_crf, "quality", 0.97)])
def test_classifiers_on_held_out_rows(spark, awkward, labels, module, label, least):
    docs, marks = common.table(spark, LARGER, "documents"), common.table(spark, LARGER, "labels")
    held = "crc32(cast(cast(doc_id as string) as binary)) % 4 = 2"
    from pyspark.sql import functions as F

    model = module.fit(docs, marks, allowed=~F.expr(held))
    truth = {r.doc_id: r[label] for r in marks.filter(held).collect()}
    assert _accuracy(module.predict(docs.filter(held), model).collect(), truth, "predicted") > least
    odd = module.predict(awkward, model).collect()
    assert len(odd) == awkward.count() and all(0 <= r.score <= 1 for r in odd)
    assert module.fit(awkward, labels) is None
    assert module.predict(awkward, None).count() == awkward.count()
    assert module.predict(awkward.limit(0), model).count() == 0


def test_line_field_marginals_match_enumeration():
    rng = np.random.default_rng(12)
    crf = quality_crf.LineCRF(3)
    crf.weight, crf.pair = rng.standard_normal(3), rng.standard_normal((2, 2))
    x, first = rng.standard_normal((7, 3)), np.array([0, 4, 5, 7])
    good, _, _ = crf.marginals(x, first)
    for a, b in zip(first[:-1], first[1:]):
        total, seen = 0.0, np.zeros(b - a)
        for code in range(2 ** (b - a)):
            y = [(code >> i) & 1 for i in range(b - a)]
            weight = np.exp(sum(y[i] * (x[a + i] @ crf.weight) for i in range(b - a)) + sum(crf.pair[y[i], y[i + 1]] for i in range(b - a - 1)))
            total += weight
            seen += weight * np.array(y)
        assert np.allclose(good[a:b], seen / total)
