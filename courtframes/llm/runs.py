"""Periodic runs of words by block convolution.

A run is a stretch of words with smallest period q, at least 4 * q words and LEAST words long, that no neighbour extends.  At the
dyadic scale s, for periods in [s, 2 * s), texts are cut into blocks of s words.  A run of such a period begins with a
whole block, which stands again q words on.  The sum of squared differences between a block and each place of
the window that follows comes from one cyclic convolution, by a number-theoretic transform over integers modulo a
prime; where it is zero, the block occurs, and the distance seeds an extension to both sides.  Extensions compare words, so a sum that
is zero by the modulus alone does no harm.

Before its transform a block is dropped only if it cannot begin such a run: some word of it does not come
again at any distance in [s, 2 * s) or [2 * s, 4 * s), which a search in the sorted places of words tells, or it lies, with its
window, in a run of a smaller period, of which all its distances are multiples.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtframes.llm.common import Words, slices, tidy, words_of

#: A run has at least EXPONENT periods and LEAST words.
EXPONENT, LEAST = 4, 6
#: A prime with roots of unity of order 2 ** 23, and its generator; beyond blocks of 2 ** 22 words sums would need a larger one.
PRIME, ROOT, ORDER = 998_244_353, 3, 23
#: Numbers that are transformed at once.
BATCH = 1 << 19
#: Words of a block whose places are looked up before the transform, at most.
PROBES = 8
#: Words that are joined at once.
JOINED = 1 << 18

_P = np.uint64(PRIME)


def _mod(x: np.ndarray) -> np.ndarray:
    return x - x // _P * _P


@lru_cache(maxsize=64)
def _twiddles(half: int, inverse: bool) -> np.ndarray:
    root = pow(ROOT, (PRIME - 1) // (2 * half), PRIME)
    root = pow(root, PRIME - 2, PRIME) if inverse else root
    out = np.ones(1, np.uint64)
    while len(out) < half:  # powers by doubling
        out = np.concatenate([out, _mod(out * np.uint64(pow(root, len(out), PRIME)))])
    return out


def ntt(x: np.ndarray) -> np.ndarray:
    """Forward transform of each row, whose length is a power of two; in bit-reversed order."""
    m, n = x.shape
    half = n // 2
    while half:
        pairs = x.reshape(m, -1, 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        x = np.stack([_mod(a + b), _mod((a + _P - b) * _twiddles(half, False))], axis=2)
        half //= 2
    return x.reshape(m, n)


def inverse_ntt(x: np.ndarray) -> np.ndarray:
    """Rows in order from transforms in bit-reversed order."""
    m, n = x.shape
    half = 1
    while half < n:
        pairs = x.reshape(m, -1, 2, half)
        a, b = pairs[:, :, 0], _mod(pairs[:, :, 1] * _twiddles(half, True))
        x = np.stack([_mod(a + b), _mod(a + _P - b)], axis=2)
        half *= 2
    return _mod(x.reshape(m, n) * np.uint64(pow(n, PRIME - 2, PRIME)))


def mismatches(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sum of squared differences, modulo PRIME, of each block of s numbers at each of the s places of its window of 2 * s - 1."""
    m, s = blocks.shape
    b, w = blocks.astype(np.uint64), windows.astype(np.uint64)
    wide = np.zeros((2, m, 2 * s), np.uint64)
    wide[0, :, :s], wide[1, :, : 2 * s - 1] = b[:, ::-1], w
    product = inverse_ntt(_mod(ntt(wide[0]) * ntt(wide[1])))[:, s - 1 : 2 * s - 1]
    sums = np.zeros((m, 2 * s), np.uint64)
    np.cumsum(_mod(w * w), axis=1, out=sums[:, 1:])
    squares = _mod(b * b).sum(axis=1)[:, None] + sums[:, s:] - sums[:, :s]
    return _mod(squares + np.uint64(2) * (_P - product))


def _again(keys: np.ndarray, code: np.ndarray, at: np.ndarray, low: int, high: int, end: np.ndarray, width: int) -> np.ndarray:
    """Whether the word at each place stands at a distance in [low, high) too, before the text's end."""
    own = code[at] * width
    i = np.searchsorted(keys, own + np.minimum(at + low, width - 1))
    i = np.minimum(i, len(keys) - 1)
    return (keys[i] >= own + at + low) & (keys[i] < own + np.minimum(at + high, end))


def _reach(code: np.ndarray, i: int, d: int, low: int, high: int) -> tuple[int, int]:
    """The stretch [x, y) around i where words d apart are the same, between low and high; (i, i) if they differ at i."""
    y, step = i, 64
    while y + d < high:
        m = min(step, high - d - y)
        off = np.flatnonzero(code[y : y + m] != code[y + d : y + d + m])
        if len(off):
            y += int(off[0])
            break
        y, step = y + m, step * 2
    if y == i:
        return i, i
    x, step = i, 64
    while x > low:
        m = min(step, x - low)
        off = np.flatnonzero(code[x - m : x] != code[x - m + d : x + d])
        if len(off):
            x += int(off[-1]) + 1 - m
            break
        x, step = x - m, step * 2
    return x, y


def _primes(n: int) -> list[int]:
    found, p = [], 2
    while p * p <= n:
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return found + [n] * (n > 1)


def _primitive(code: np.ndarray, x: int, d: int) -> bool:
    word = code[x : x + d]
    return not any((word[: d - d // p] == word[d // p :]).all() for p in _primes(d))


def find_runs(code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(start, length, period) of all runs of texts in one array of word numbers, by start and period.

    Text i is code[first[i]:first[i + 1]]; word numbers are not negative.  Starts are places in code.
    """
    n = len(code)
    out: list[tuple[int, int, int]] = []
    if not n:
        return np.zeros((0, 3), np.int64)
    code = code.astype(np.int64)
    size = np.diff(first)
    end = np.repeat(first[1:], size)
    begin = np.repeat(first[:-1], size)
    keys = np.sort(code * n + np.arange(n))
    covered = np.zeros(n, np.int64)
    scale = 1
    while EXPONENT * scale <= size.max() and 2 * scale <= 1 << ORDER:
        s = np.arange(0, n, scale)
        s = s[(s + 3 * scale <= end[s]) & (covered[s] < s + 3 * scale)]
        for k in sorted({j * (scale - 1) // max(1, PROBES - 1) for j in range(PROBES)}):
            for reach in (1, 2):
                s = s[_again(keys, code, s + k, reach * scale, 2 * reach * scale, end[s], n)]
        seeds = [np.zeros((2, 0), np.int64)]
        step = max(1, BATCH // (2 * scale))
        for at in range(0, len(s), step):
            own = s[at : at + step, None]
            place = own + scale + np.arange(2 * scale - 1)
            inside = place < end[own]
            window = np.where(inside, code[np.where(inside, place, 0)] + 1, 0)
            row, distance = np.nonzero(mismatches(code[own + np.arange(scale)] + 1, window) == 0)
            seeds.append(np.stack([own[row, 0], distance + scale]))
        start, d = np.concatenate(seeds, axis=1)
        fresh = covered[start] < start + d + scale
        start, d = start[fresh], d[fresh]
        order = np.lexsort((start, d))
        found = _extend(code, start[order], d[order], begin, end)
        if found:
            out += found
            for x, length, _ in found:
                covered[x] = max(covered[x], x + length)
            np.maximum.accumulate(covered, out=covered)
        scale *= 2
    runs = np.array(sorted((x, d, length) for x, length, d in set(out)), np.int64).reshape(-1, 3)
    return runs[:, [0, 2, 1]]


def _extend(code: np.ndarray, start: np.ndarray, d: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs around seeds, which are sorted by distance and place."""
    found, k, n = [], 0, len(start)
    upto = np.append(np.flatnonzero(np.diff(d)) + 1, n) if n else []
    for stop in upto:
        while k < stop:
            i, q = int(start[k]), int(d[k])
            x, y = _reach(code, i, q, int(begin[i]), int(end[i]))
            if y - x + q >= max(LEAST, EXPONENT * q) and _primitive(code, x, q):
                found.append((x, y - x + q, q))
            # seeds inside the stretch say the same
            k = max(k + 1, k + int(np.searchsorted(start[k:stop], y)))
    return found


def _joined(words: Words, source: np.ndarray, kept: np.ndarray, first: np.ndarray) -> list[bytes]:
    """The kept words of each text with one space between them; source is the place of each word in words."""
    at = np.flatnonzero(kept)
    edge = np.searchsorted(at, first)
    parts: list[list[bytes]] = [[] for _ in range(len(first) - 1)]
    text = 0
    for lo in range(0, len(at), JOINED):
        own = source[at[lo : lo + JOINED]]
        size = words.offsets[own + 1] - words.offsets[own] + 1
        ends = np.cumsum(size)
        place = np.arange(ends[-1]) + np.repeat(words.offsets[own] - (ends - size), size)
        data = words.data[np.minimum(place, len(words.data) - 1)]
        data[ends - 1] = 0x20
        raw, ends = data.tobytes(), np.append(0, ends)
        hi = lo + len(own)
        while edge[text + 1] <= lo:
            text += 1
        t = text
        while t < len(parts) and edge[t] < hi:
            a, b = max(edge[t], lo) - lo, min(edge[t + 1], hi) - lo
            parts[t].append(raw[ends[a] : ends[b]])
            t += 1
    return [b"".join(p)[:-1] for p in parts]


_RUNS = "array<struct<start:long,length:long,period:long>>"


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, runs, collapsed) of each row: all runs as (start, length, period) by start and period, and the text's words, joined by
    one space, without those that any run has after its first period.

    Words are stretches without ASCII blanks, compared exactly.  Null and blank texts have no words, no runs and an empty
    collapsed text.  Repeated rows give equal rows, an empty table none; other columns play no part.
    """

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in slices(batch.column(1)):
                words = words_of(data, offsets, lower=False)
                code = words.strings().dictionary_encode().indices.to_numpy(zero_copy_only=False)
                first = words.per_text
                runs = find_runs(code, first)
                change = np.zeros(len(code) + 1, np.int64)
                np.add.at(change, runs[:, 0] + runs[:, 2], 1)
                np.add.at(change, runs[:, 0] + runs[:, 1], -1)
                collapsed = _joined(words, np.arange(len(code)), np.cumsum(change[:-1]) == 0, first)
                edge = np.searchsorted(runs[:, 0], first)
                own = np.repeat(first[:-1], np.diff(edge))
                spans = pa.StructArray.from_arrays([pa.array(c) for c in (runs[:, 0] - own, runs[:, 1], runs[:, 2])], names=["start", "length", "period"])
                lists = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), spans)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(first)), lists, pa.array(collapsed, pa.binary()).cast(pa.string())], names=names)

    names = ["id", "n_words", "runs", "collapsed"]
    kind = dict(docs.select(F.col(f"`{id_col}`").alias("id")).dtypes)["id"]
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_words long, runs {_RUNS}, collapsed string").withColumnRenamed("id", id_col)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """n_runs, the greatest run (ties: smallest start, then period), and digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    told = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    rows = found.withColumn("best", best)
    return rows.select(
        id_col,
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        F.sha2(told.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def with_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) where one id in ten, by CRC32 of its decimal form, has its words from some place on repeat with some period.

    A text that is changed is its words joined by one space; the others, and those of null ids, stay as they are.
    """

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = np.array([1 if i is None else crc32(str(i).encode()) for i in batch.column(0).to_pylist()], np.int64)
            pick = np.flatnonzero(crc % 10 == 0)
            changed = []
            for a, b, data, offsets in slices(batch.column(1).take(pa.array(pick))):
                words = words_of(data, offsets, lower=False)
                first = words.per_text
                source = np.arange(first[-1])
                for g, lo, hi in zip(crc[pick[a:b]] // 10, first[:-1], first[1:]):
                    if n := hi - lo:
                        begin = g % n
                        period = 1 + (n - begin) // (3 + g % 8)
                        source[lo + begin : hi] = lo + begin + np.arange(n - begin) % period
                changed += _joined(words, source, np.ones(len(source), bool), first)
            mask = np.zeros(len(batch), bool)
            mask[pick] = True
            texts = pc.replace_with_mask(batch.column(1), pa.array(mask), pa.array(changed, pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], names=[id_col, text_col])

    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    return rows.mapInArrow(run, rows.schema)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return digests(collapse_runs(docs, id_col, text_col), id_col)
