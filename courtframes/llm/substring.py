"""Near-duplicate passages by compact windows.

Tokens are hashed shingles of five words.  Under one min-hash function, a compact window (l, c, r)
stands for all passages that begin in [l, c] and end in [c, r]: their least hash is that of c.  Windows
are the nodes of the Cartesian tree of the hashes whose span holds a passage of the least length.  Such
a node is the minimum of at least one stretch of that length, so two sliding extrema find the few
nodes, and a stack over them alone gives l and r.

Equal texts are one text, told by its hash.  Windows of the same hash value are grouped by the shingles at four fixed
distances from the centre: by all four, by both of one side, and by each alone.  In each group every text is linked to the
earliest one, so a passage in n texts gives some n links, and which links are tried is a function of the table alone.  All passages of a linked pair are then laid out over both texts and
verified by the Jaccard similarity of their shingles, as 32-bit hashes.

The earliest text of a group may share too little with the others, which share a passage.  So where a text shares the least
shingle of a stretch of the least length with the earliest text but not the stretch, the stretch is named by the hash of its shingles, and of the texts
with one name each is linked to the earliest, in a second turn of verification.  These texts share the whole stretch, so no link fails,
and a third turn would find nothing.  Hence two texts with the same passage, word for word, are always in one class: the first text of the group of
the passage's least shingle either has it, and then both links to it hold, or has that shingle alone, and then the passage has a name in both texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtframes.llm.common import Scratch, connected_components, materialise, slices, tidy, words_of

SHINGLE = 5
PASSAGE_WORDS = 50
SIMILARITY = 0.8
FUNCTIONS = 4
#: Unshared shingles between shared ones that do not end a passage: two changed words side by side.
GAP = 2 * SHINGLE
#: Matching places of two texts that are sorted at once.
MATCHES = 1 << 22
#: Distances from a window's centre at which 16 bits of the shingle are kept.  A passage of 50 words that
#: holds the centre holds both of one side; a shared phrase of under 14 words holds none.
PROBES = (-20, -10, 10, 20)
PROBE_BITS = 16
#: Groups of one key: which probes agree.  Those that agree in all four are linked before.
GROUPS = ((0, 1), (2, 3), (0,), (1,), (2,), (3,))
BROADCAST_IDS = 1_000_000
#: In place of a document, in rows that only tell other batches of a key.
TELLS = -(1 << 63)

_M = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective finaliser over uint64."""
    x = x ^ np.uint64((seed * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def tokens_of(base: np.ndarray, function: int) -> np.ndarray:
    """Min-hash tokens of shingles: in order of the upper half of a hash of the shingle's upper half, which stays known when texts are verified."""
    with np.errstate(over="ignore"):
        return ranks_of(base >> np.uint64(32), function) << np.uint64(32) | base & np.uint64(0xFFFFFFFF)


def ranks_of(short: np.ndarray, function: int) -> np.ndarray:
    return mix(short.astype(np.uint64), function) >> np.uint64(32)


def shingles(data: np.ndarray, offsets: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """uint64 hash of each shingle of a slice, the first shingle of each text, and each text's words; short texts have none."""
    words = words_of(data, offsets)
    coded = words.strings().dictionary_encode()
    digest = xxhash.xxh64_intdigest
    names = np.array([digest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()], np.uint64)
    word = names[coded.indices.to_numpy(zero_copy_only=False)] if len(names) else np.zeros(0, np.uint64)
    size = np.diff(words.per_text)
    count = np.maximum(size - n + 1, 0)
    first = np.append(0, np.cumsum(count))
    if len(word) < n:
        return np.zeros(0, np.uint64), first, size
    with np.errstate(over="ignore"):
        rolled = word[: len(word) - n + 1].copy()
        for k in range(1, n):
            rolled = rolled * _M + word[k : len(word) - n + 1 + k]
        rolled = mix(rolled)
    # shingles that run over the end of a text are left out
    inside = np.ones(len(rolled) + n - 1, bool)
    ends = words.per_text[1:]
    for k in range(1, n):
        at = ends - k
        inside[at[(at >= 0) & (at >= words.per_text[:-1])]] = False
    return rolled[inside[: len(rolled)]], first, size


def _sliding(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Extremum of each stretch of width values, by running extrema over blocks from both ends."""
    op = np.minimum if least else np.maximum
    n = len(x) - width + 1
    pad = -len(x) % width
    rows = np.append(x, np.full(pad, x[-1], x.dtype)).reshape(-1, width)
    up = op.accumulate(rows, axis=1).ravel()
    down = op.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(down[:n], up[width - 1 : width - 1 + n])


def compact_windows(tokens: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(l, c, r) of all nodes of the texts' Cartesian trees that span at least width tokens.

    Of equal least hashes the leftmost is the node.
    """
    none = np.zeros(0, np.int64)
    if len(tokens) < width:
        return none, none, none
    low = _sliding(tokens, width, True)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    low[text[: len(low)] != text[width - 1 :]] = 0  # stretches across texts
    wide = np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)])
    c = np.flatnonzero((_sliding(wide, width, False) == tokens) & (tokens != 0))
    begin, end = first[text[c]].tolist(), first[text[c] + 1].tolist()
    left, right = [0] * len(c), [0] * len(c)
    stack: list[int] = []
    values, places, owner = tokens[c].tolist(), c.tolist(), text[c].tolist()
    for i, (v, p) in enumerate(zip(values, places)):
        if stack and owner[stack[-1]] != owner[i]:
            for j in stack:
                right[j] = end[j] - 1
            stack = []
        while stack and values[stack[-1]] > v:
            right[stack.pop()] = p - 1
        left[i] = places[stack[-1]] + 1 if stack else begin[i]
        stack.append(i)
    for j in stack:
        right[j] = end[j] - 1
    l, r = np.array(left, np.int64), np.array(right, np.int64)
    keep = r - l + 1 >= width
    return l[keep], c[keep], r[keep]


def _window_rows(nodes: np.ndarray, base: np.ndarray, first: np.ndarray, width: int, functions: int) -> list[tuple[np.ndarray, ...]]:
    """(key, text of the slice, probes) of all windows of each text; probes holds 16 bits of each of the four."""
    found: list[tuple[np.ndarray, ...]] = []
    if not len(base):
        return found
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    high = base >> np.uint64(64 - PROBE_BITS)
    for k in range(1, functions + 1):
        tokens = tokens_of(base, k)
        _, c, _ = compact_windows(tokens, first, width)
        if not len(c):
            continue
        t = text[c]
        low, end = first[t], first[t + 1]
        probes = np.zeros(len(c), np.uint64)
        for n, step in enumerate(PROBES):
            at = c + step
            inside = (at >= low) & (at < end)
            seen = high[np.where(inside, at, 0)]
            out = np.flatnonzero(~inside)
            # beyond the text's ends stands something that no other text has there
            with np.errstate(over="ignore"):
                seen[out] = mix(nodes[t[out]].view(np.uint64), 90 + n) >> np.uint64(64 - PROBE_BITS)
            probes |= seen << np.uint64(PROBE_BITS * n)
        found.append((tokens[c], t, probes))
    return found


#: Kinds of rows of the first pass, as salts: windows to be tried against others of their key have 0, those known to share
#: their key a number above, rows that stand for a text one below.
def _salt(x: np.ndarray) -> np.ndarray:
    return (mix(x.view(np.uint64), 96) >> np.uint64(33)).astype(np.int64) + 1


def _first_pass(docs: DataFrame, width: int, functions: int, id_col: str, text_col: str) -> DataFrame:
    """(key, node, doc, probes, salt): windows whose key stands in several texts, and for each document a row with its
    text in key and its words in probes.

    A key that several texts of one batch share needs no test: two rows of the batch go to its key's task, to tell
    other batches, and the others go anywhere.  So no task takes all rows of a frequent key, and none are left out.
    """

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, nodes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            rows, size = [], []
            for a, b, data, offsets in slices(batch.column(2)):
                base, first, words = shingles(data, offsets)
                rows += [(key, text + a, probes) for key, text, probes in _window_rows(nodes[a:b], base, first, width, functions)]
                size.append(words)
            yield _batch([nodes, nodes, ids, np.concatenate(size) if size else np.zeros(0, np.int64), -_salt(ids)])
            if not rows:
                continue
            key, text, probes = (np.concatenate(c) for c in zip(*rows))
            # numbers of texts in order of (text, id), so that of equal texts the least id stands first
            order = np.lexsort((ids, nodes))
            rank = np.empty(len(ids), np.int64)
            rank[order] = np.arange(len(ids))
            order = np.lexsort((probes, rank[text], key))
            key, text, probes = key[order].view(np.int64), text[order], probes[order].view(np.int64)
            node, doc = nodes[text], ids[text]
            begins = np.append(True, key[1:] != key[:-1])
            other = begins | np.append(True, node[1:] != node[:-1])
            # a window that stands twice in the same surroundings counts once, and of equal texts the first alone
            pick = np.flatnonzero(other | np.append(True, probes[1:] != probes[:-1]))
            pick = pick[doc[pick] == doc[np.flatnonzero(other)][np.cumsum(other)[pick] - 1]]
            number = np.cumsum(begins) - 1
            texts = np.bincount(number, weights=other)  # distinct texts of each key
            # two texts of each shared key, so that whichever text a row of another batch is of, it passes the test
            starts = np.flatnonzero(begins)
            ends = np.append(starts[1:], len(key)) - 1
            told = np.concatenate([starts[texts > 1], ends[texts > 1]])
            yield _batch([key[pick], node[pick], doc[pick], probes[pick], np.where(texts[number[pick]] > 1, _salt(node[pick]), 0)])
            yield _batch([key[told], node[told], np.full(len(told), TELLS), probes[told], np.zeros(len(told), np.int64)])

    def _batch(columns: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    names = ["key", "node", "doc", "probes", "salt"]
    rows = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long"), F.xxhash64(text_col), text_col)
    rows = rows.mapInArrow(run, ", ".join(f"{n} long" for n in names))
    own = Window.partitionBy("key", "salt")
    # most keys are of one text and end here
    rows = rows.select("*", F.min("node").over(own).alias("low"), F.max("node").over(own).alias("high"))
    return materialise(rows.filter((F.col("salt") != 0) | (F.col("low") < F.col("high")) & (F.col("doc") != TELLS)).drop("low", "high"), "windows")


def _with_first(rows: DataFrame, on: list[str], scratch: Scratch) -> DataFrame:
    """(first, node) of the rows of groups of several documents, where first is the group's least document.

    The first ones are found by partial aggregates and stored, so both sides of the join are plain shuffles, whose
    skewed parts adaptive execution splits.
    """
    first = rows.groupBy(*on).agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    first = scratch(first.filter("first < last").drop("last"), "firsts")
    return rows.join(first, on).filter("doc <> first").select("first", "node").distinct()


def window_links(docs: DataFrame, passage_words: int = PASSAGE_WORDS, functions: int = FUNCTIONS, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Pairs of texts to be verified, (a, b, a_doc, b_doc) with a the earlier one, and all documents, (node, doc, words).

    a and b are hashes of texts, and the documents those of least id with these texts.
    """
    rows = _first_pass(docs, passage_words - SHINGLE + 1, functions, id_col, text_col)
    known = rows.filter("salt < 0").select("node", "doc", F.col("probes").alias("words"))
    shared = rows.filter("salt >= 0").select("key", "node", "doc", "probes")
    scratch = Scratch()
    all_four = _with_first(shared, ["key", "probes"], scratch)
    # one of each group stands for it among the groups that agree less
    least = shared.groupBy("key", "probes").agg(F.min("doc").alias("doc"))
    bits = lambda n: F.shiftright("probes", PROBE_BITS * n).bitwiseAND((1 << PROBE_BITS) - 1)
    group = [F.xxhash64("key", F.lit(g), *map(bits, own)) for g, own in enumerate(GROUPS)]
    less = scratch(least.select(F.col("doc").alias("node"), "doc", F.explode(F.array(*group)).alias("group")), "groups")
    less = _with_first(less, ["group"], scratch)
    earliest = scratch(known.groupBy("node").agg(F.min("doc").alias("doc")), "texts")
    a, b = earliest.select(F.col("doc").alias("a_doc"), F.col("node").alias("a")), earliest.select(F.col("node").alias("b"), F.col("doc").alias("b_doc"))
    all_four = all_four.select(F.col("first").alias("a_doc"), F.col("node").alias("b")).join(b, "b")
    less = less.select(F.col("first").alias("a_doc"), F.col("node").alias("b_doc")).join(b, "b_doc")
    pairs = all_four.select("a_doc", "b", "b_doc").unionByName(less.select("a_doc", "b", "b_doc")).filter("a_doc < b_doc").distinct().join(a, "a_doc").filter("a <> b")
    pairs = materialise(pairs.select("a", "b", "a_doc", "b_doc"), "pairs")
    scratch.drop()
    return pairs, known


def _segments(shared: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last of runs of shared places with gaps of at most GAP, of at least width places."""
    at = np.flatnonzero(shared)
    if not len(at):
        return at, at
    cut = np.flatnonzero(np.diff(at) > GAP + 1)
    lo, hi = at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)]
    keep = hi - lo + 1 >= width
    return lo[keep], hi[keep]


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _diagonals(a: np.ndarray, b: np.ndarray, left: np.ndarray, right: np.ndarray, width: int) -> Iterator[tuple[int, int, int, int]]:
    """Stretches where marked places of both texts agree at equal distance, with gaps of at most GAP and without gaps."""
    x, y = np.flatnonzero(left), np.flatnonzero(right)
    if not len(x) or not len(y):
        return
    x = x[np.argsort(a[x], kind="stable")]
    low, high = np.searchsorted(a[x], b[y], "left"), np.searchsorted(a[x], b[y], "right")
    count = high - low
    if count.sum() <= MATCHES:
        at = np.repeat(low - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(count.sum())
        x, y = x[at], np.repeat(y, count)
        order = np.lexsort((y, x - y))
        parts = iter([(x[order], y[order])])
    else:  # texts of few shingles over and over: one diagonal at a time
        parts = ((at + max(d, 0), at + max(-d, 0)) for d in range(1 - len(b), len(a)) if len(at := _agree(a, b, left, right, d)) >= width // (GAP + 1))
    for x, y in parts:
        if not len(y):
            continue
        for gap in (GAP, 0):
            ends = np.append(np.flatnonzero((np.diff(x - y) != 0) | (np.diff(y) > gap + 1)), len(y) - 1)
            begins = np.append(0, ends[:-1] + 1)
            whole = y[ends] - y[begins] + 1 >= width
            for i, j in zip(begins[whole], ends[whole]):
                yield int(x[i]), int(x[j]), int(y[i]), int(y[j])


def _agree(a: np.ndarray, b: np.ndarray, left: np.ndarray, right: np.ndarray, d: int) -> np.ndarray:
    x, y = max(d, 0), max(-d, 0)
    n = min(len(a) - x, len(b) - y)
    return np.flatnonzero((a[x : x + n] == b[y : y + n]) & left[x : x + n] & right[y : y + n])


def verify_pair(a: np.ndarray, b: np.ndarray, width: int, similarity: float, in_b: np.ndarray | None = None) -> list[tuple[int, int, int, int, float]]:
    """Shingle ranges (first and last, in a and in b) and similarity of all passages of b that a has too.

    Runs of shared shingles are compared run by run; where such a run is more than one passage, the
    stretches that agree at equal distance are compared.
    """
    in_a, in_b = np.isin(a, b), np.isin(b, a) if in_b is None else in_b
    a_lo, a_hi = _segments(in_a, width)
    b_lo, b_hi = _segments(in_b, width)
    found: list[tuple[int, int, int, int, float]] = []
    if not len(a_lo) or not len(b_lo):
        return found
    covered = np.zeros(len(b), bool)
    a_sets = [np.unique(a[p : q + 1]) for p, q in zip(a_lo, a_hi)]
    for r, s in zip(b_lo.tolist(), b_hi.tolist()):
        own = np.unique(b[r : s + 1])
        for i, other in enumerate(a_sets):
            if min(len(own), len(other)) < similarity * max(len(own), len(other)):
                continue
            both = len(np.intersect1d(own, other, assume_unique=True))
            if (like := both / (len(own) + len(other) - both)) >= similarity:
                found.append((int(a_lo[i]), int(a_hi[i]), r, s, like))
                covered[r : s + 1] = True
                break
    left, right = np.zeros(len(a), bool), np.zeros(len(b), bool)
    for lo, hi, mark in ((a_lo, a_hi, left), (b_lo, b_hi, right)):
        for p, q in zip(lo, hi):
            mark[p : q + 1] = True
    for p, q, r, s in _diagonals(a, b, left & in_a, right & in_b & ~covered, width):
        if not covered[r : s + 1].all() and (like := jaccard(a[p : q + 1], b[r : s + 1])) >= similarity:
            found.append((p, q, r, s, like))
            covered[r : s + 1] = True
    return found


def _stretches(a: np.ndarray, b: np.ndarray, width: int, shared: np.ndarray) -> np.ndarray:
    """Names of the stretches of b of width shingles whose least token, under the first function, a has too, and which do not stand in a.

    Such a token put both texts in one group, wherever b's stretch stands a second time.
    """
    if len(b) < width:
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        least = _sliding(ranks_of(b, 1) << np.uint64(1) | ~shared, width, True)
        some = np.flatnonzero(least & np.uint64(1) == 0)
        if not len(some):
            return some
        own = _rolled(b, width)[some]
    if len(a) >= width:
        own = own[~np.isin(own, _rolled(a, width))]
    return np.unique(own).view(np.int64)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 ** 64."""
    base = [int(_M), pow(int(_M), -1, 1 << 64)]
    out = []
    with np.errstate(over="ignore"):
        for x in base:
            row = np.ones(1, np.uint64)
            while len(row) < n:
                row = np.concatenate([row, row * np.uint64(pow(x, len(row), 1 << 64))])
            out.append(row)
    return out[0], out[1]


def _rolled(x: np.ndarray, width: int) -> np.ndarray:
    """uint64 hash of each stretch of width values."""
    if len(x) < width:
        return np.zeros(0, np.uint64)
    up, down = _powers(1 << max(16, len(x).bit_length()))
    with np.errstate(over="ignore"):
        total = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(mix(x.astype(np.uint64), 97) * up[: len(x)], out=total[1:])
        return mix((total[width:] - total[:-width]) * down[: len(x) - width + 1], 98)


def passage_links(docs: DataFrame, passage_words: int = PASSAGE_WORDS, similarity: float = SIMILARITY, functions: int = FUNCTIONS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verified passages that repeat: doc_id, start_word, end_word, match_doc_id, match_start_word,
    match_end_word, similarity; doc_id is the larger of the two ids and word ranges exclude their ends.

    Documents of one text are linked, whole, to the first of them, which alone is linked to other texts.  Texts shorter
    than a passage, null texts and null ids give nothing; rows with the same id are one document and never match each
    other.  Repetition inside one text is not reported.  Empty tables give no rows.  The rows depend on the table alone,
    not on how it is dealt.
    """
    return _version_links(docs, passage_words, similarity, functions, id_col, text_col).drop("version").distinct()


def _version_links(docs: DataFrame, passage_words: int = PASSAGE_WORDS, similarity: float = SIMILARITY, functions: int = FUNCTIONS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """passage_links and version, the hash of the text that the word range is in: an id can have several."""
    width = passage_words - SHINGLE + 1
    pairs, known = window_links(docs, passage_words, functions, id_col, text_col)
    ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("a_doc").alias("doc")), F.struct(F.col("b").alias("node"), F.col("b_doc").alias("doc"))))
    wanted = materialise(pairs.select(ends.alias("e")).select("e.*").distinct(), "ids")
    # ids are broadcast only when their number is small; beyond it both sides are shuffled
    few = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("node"), F.col(text_col).alias("text")).join(few, ["doc", "node"], "left_semi")

    @tidy
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, _, data, offsets in slices(batch.column(1)):
                base, first, _ = shingles(data, offsets)
                short = (base >> np.uint64(32)).astype(np.uint32)
                found += [short[i:j].tobytes() for i, j in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["node", "shingles"])

    texts = rows.select("node", "text").mapInArrow(hashed, "node long, shingles binary")
    # where rows repeat, one of each text is enough
    repeats = known.join(wanted, ["doc", "node"], "left_semi").groupBy("doc", "node").count().filter("count > 1").limit(1).count()
    texts = materialise(texts.dropDuplicates(["node"]) if repeats else texts, "shingles")
    scratch = Scratch()
    tried = scratch(_verified(pairs, texts, width, similarity, True), "tried")
    links = tried.filter("stretch is null").drop("stretch")
    again = _with_first(tried.filter("stretch is not null").select("stretch", F.col("version").alias("node"), F.col("doc_id").alias("doc")), ["stretch"], scratch)
    # the text that an earliest document has among those that were tried
    first = pairs.select(F.col("b").alias("a"), F.col("b_doc").alias("a_doc")).distinct()
    again = again.select(F.col("first").alias("a_doc"), F.col("node").alias("b")).join(first, "a_doc").join(first.select(F.col("a").alias("b"), F.col("a_doc").alias("b_doc")), "b")
    again = again.filter("a <> b and a_doc < b_doc").distinct().join(pairs, ["a", "b", "a_doc", "b_doc"], "left_anti")
    again = materialise(again.select("a", "b", "a_doc", "b_doc"), "again")
    found = materialise(links.unionByName(_verified(again, texts, width, similarity, False).drop("stretch")), "links")
    scratch.drop()
    # documents of one text
    group = known.filter(F.col("words") >= passage_words).distinct()
    first = group.groupBy("node").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first < last")
    copies = group.join(materialise(first.drop("last"), "copies"), "node").filter("doc <> first")
    zero, words = F.lit(0).cast("long"), F.col("words")
    copies = copies.select(F.col("doc").alias("doc_id"), zero.alias("start_word"), words.alias("end_word"), F.col("first").alias("match_doc_id"), zero.alias("match_start_word"), words.alias("match_end_word"), F.lit(1.0).alias("similarity"), F.col("node").alias("version"))
    return found.unionByName(copies)


def _verified(pairs: DataFrame, texts: DataFrame, width: int, similarity: float, name_stretches: bool) -> DataFrame:
    """Passages of pairs (a, b, a_doc, b_doc), and where asked for, rows with the name of a stretch of b in stretch."""
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("shingles").alias("left")), "a")
    both = both.join(texts.select(F.col("node").alias("b"), F.col("shingles").alias("right")), "b").select("a_doc", "b_doc", "b", "left", "right")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                out, named = [], []
                for row in batch.slice(at, 256).to_pylist():
                    a, b = (np.frombuffer(row[k], np.uint32) for k in ("left", "right"))
                    shared = np.isin(b, a)
                    for p, q, r, s, like in verify_pair(a, b, width, similarity, shared):
                        out.append((row["b_doc"], r, s + SHINGLE, row["a_doc"], p, q + SHINGLE, like, row["b"], None))
                    if name_stretches and len(own := _stretches(a, b, width, shared)):
                        named.append((row["b_doc"], row["b"], own))
                columns = list(zip(*out)) if out else [()] * 9
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64() if i == 6 else pa.int64()) for i, c in enumerate(columns)], names=names)
                if named:
                    size = [len(x) for _, _, x in named]
                    none = pa.nulls(sum(size), pa.int64())
                    doc, node = (pa.array(np.repeat(np.array(c, np.int64), size)) for c in list(zip(*named))[:2])
                    yield pa.RecordBatch.from_arrays([doc, none, none, none, none, none, none.cast(pa.float64()), node, pa.array(np.concatenate([x for _, _, x in named]))], names=names)

    names = ["doc_id", "start_word", "end_word", "match_doc_id", "match_start_word", "match_end_word", "similarity", "version", "stretch"]
    return both.mapInArrow(run, ", ".join(f"{n} {'double' if n == 'similarity' else 'long'}" for n in names))


def repeated_passages(docs: DataFrame, **options) -> DataFrame:
    """passage_links and class_id, the smallest document id that links reach."""
    links = materialise(passage_links(docs, **options), "passages")
    classes = connected_components(links.select(F.col("doc_id").alias("u"), F.col("match_doc_id").alias("v")))
    return links.join(classes.select(F.col("node").alias("doc_id"), F.col("component").alias("class_id")), "doc_id")


def cut_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs with each passage taken out that an earlier document, by id, also has; the first copy stays.

    A passage goes from its first word up to the next word that stays.  Other texts are unchanged, null
    texts stay null, and no row is dropped.
    """
    links = _version_links(docs, id_col=id_col, text_col=text_col, **options)
    gone = links.groupBy("doc_id", "version").agg(F.collect_set(F.struct("start_word", "end_word")).alias("gone"))
    columns = docs.columns
    # all columns of docs in one, so that no name can clash
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("version"))
    joined = whole.join(gone, ["doc_id", "version"], "left")
    place = columns.index(text_col)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = batch.column(0).flatten()
            spans, texts = batch.column(1).to_pylist(), out[place].to_pylist()
            for i, own in enumerate(spans):
                if own and texts[i] is not None:
                    texts[i] = _without(texts[i].encode(), [(s["start_word"], s["end_word"]) for s in own])
            out[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(out, names=columns)

    return joined.select("row", "gone").mapInArrow(run, docs.schema)


def _without(data: bytes, spans: list[tuple[int, int]]) -> str:
    raw = np.frombuffer(data, np.uint8)
    inside = ~np.isin(raw, np.array([0x20, *range(9, 14)], np.uint8))
    starts = np.flatnonzero(inside & np.append(True, ~inside[:-1]))
    ends = np.append(starts, len(raw))
    drop = np.zeros(len(raw) + 1, np.int64)
    for lo, hi in spans:
        drop[ends[lo]] += 1
        drop[ends[min(hi, len(starts))]] -= 1
    return raw[np.cumsum(drop[:-1]) == 0].tobytes().decode()
