"""Quality rules with an isolation forest over the rules' statistics.

Each tree splits a small random sample at random features and values; a document whose statistics
are isolated after few splits is anomalous.  One forest is grown for each statistic and one for all,
on a bounded sample of labelled rows (`fit_rows`).  A document is rejected if any forest's score exceeds
the forest's threshold.  Thresholds are calibrated on that sample: no more than `good_loss` of the rows
with label 1 may be lost by a forest, and among such thresholds the one that parts the labels best is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtframes.llm.common import labelled_sample, slices, tidy, words_of

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_bang", "n_lines"]
FIT_ROWS = 8192
TREES, TREE_ROWS = 128, 256
GOOD_LOSS = 0.0005

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _ids(words) -> np.ndarray:
    return words.strings().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _sum(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(flags, dtype=np.int64))
    return total[bounds[1:]] - total[bounds[:-1]]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """STATS and EXTRA of each text of a slice, one row each."""
    words = words_of(data, offsets, lower=False)
    n = len(offsets) - 1
    per = words.per_text
    n_words = np.diff(per)
    ids = _ids(words)
    text_of = np.repeat(np.arange(n), n_words)
    chars = (words.data & 0xC0) != 0x80  # first bytes of code points
    word_chars = _sum(chars, words.offsets[per])
    # three-word windows, named within their text
    repeat = np.zeros(len(ids), bool)
    if len(ids) > 2:
        start = np.flatnonzero(text_of[:-2] == text_of[2:])
        pair = _name(text_of[start], ids[start])
        pair = _name(pair, ids[start + 1])
        pair = _name(pair, ids[start + 2])
        twice = start[np.bincount(pair)[pair] > 1] if len(pair) else start
        for k in range(3):
            repeat[twice + k] = True
    breaks = np.flatnonzero(data == 0x0A)
    # lines begin at texts and after line feeds; a line's number of words shows whether it is blank
    begin = np.unique(np.concatenate([offsets[:-1], breaks + 1])) if len(data) else np.zeros(0, np.int64)
    begin = begin[begin < len(data)]
    end = np.append(begin[1:], len(data))
    inside = ~np.isin(data, np.array([0x20, *range(9, 14)], np.uint8))
    filled = np.append(0, np.cumsum(inside))
    with_word = filled[end] > filled[begin]
    line_text = np.searchsorted(offsets, begin, "right") - 1
    # the line feed that ends a line is no part of it
    stop = end - ((end > begin) & (data[np.maximum(end, 1) - 1] == 0x0A)) if len(begin) else end
    spans = np.empty(2 * len(begin) + 1, np.int64)
    spans[0:-1:2], spans[1::2], spans[-1] = begin, stop, len(data)
    lines = pa.LargeStringArray.from_buffers(len(spans) - 1, pa.py_buffer(spans), pa.py_buffer(np.ascontiguousarray(data)))
    code = lines.take(pa.array(np.arange(0, 2 * len(begin), 2))).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    key = _name(line_text, code)
    _, earliest = np.unique(key, return_index=True)
    dup = np.ones(len(key), bool)
    dup[earliest] = False
    dup &= with_word
    n_dup = np.bincount(line_text[dup], minlength=n)
    n_lines = np.bincount(line_text[with_word], minlength=n)
    by_text = lambda flags: _sum(flags, offsets)
    return np.column_stack([
        n_words, word_chars, by_text(_SYMBOL[data]), n_dup, _sum(repeat, per),
        by_text(data == 0x21), n_lines,
    ]).astype(np.int64)


def _name(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dense names of the pairs of two small non-negative integers."""
    if not len(a):
        return np.zeros(0, np.int64)
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]


def features(stats: np.ndarray) -> np.ndarray:
    """Rates that rules look at; texts of any length are comparable."""
    n, chars, symbols, dups, repeats, bang, lines = stats.astype(float).T
    words = np.maximum(n, 1)
    return np.column_stack([chars / words, symbols / words, dups / np.maximum(lines, 1), repeats / words, bang / words])


def base_failed(stats: np.ndarray) -> np.ndarray:
    return (stats[:, 0] < 50) | (100 * stats[:, 4] > 50 * stats[:, 0])


class IsolationForest:
    """Trees as arrays of nodes: feature, value, left child (right is the next), path length of leaves."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 11):
        rng = np.random.default_rng(seed)
        size = min(tree_rows, len(rows))
        self.depth = max(1, int(np.ceil(np.log2(max(2, size)))))
        self.norm = max(_expected(size), 1e-9)
        self.trees = [self._grow(rows[rng.choice(len(rows), size, replace=False)], rng) for _ in range(trees)]

    def _grow(self, rows: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
        feature, value, left, length = [0], [0.0], [0], [0.0]
        todo = [(0, rows, 0)]
        while todo:
            at, own, depth = todo.pop()
            wide = np.flatnonzero(own.max(axis=0) > own.min(axis=0)) if len(own) else np.zeros(0, int)
            if depth >= self.depth or len(own) <= 1 or not len(wide):
                left[at], length[at] = at, depth + _expected(len(own))
                continue
            f = int(rng.choice(wide))
            cut = rng.uniform(own[:, f].min(), own[:, f].max())
            feature[at], value[at], left[at] = f, cut, len(feature)
            for part in (own[own[:, f] < cut], own[own[:, f] >= cut]):
                todo.append((len(feature), part, depth + 1))
                feature.append(0), value.append(np.inf), left.append(0), length.append(0.0)
        return np.array(feature), np.array(value), np.array(left), np.array(length)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """2^(-mean path / expected path): near 1 for documents that few splits isolate."""
        total = np.zeros(len(rows))
        index = np.arange(len(rows))
        for feature, value, left, length in self.trees:
            at = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                inner = left[at] != at
                right = rows[index, feature[at]] >= value[at]
                at = np.where(inner, left[at] + right, at)
            total += length[at]
        return 2.0 ** (-total / len(self.trees) / self.norm)


def _expected(n: int) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def threshold(scores: np.ndarray, good: np.ndarray, good_loss: float = GOOD_LOSS) -> float:
    """Least score to reject: above all but good_loss of the good rows, and best at parting the labels."""
    if not good.any():
        return np.inf
    ordered = np.sort(scores[good])
    least = ordered[min(len(ordered) - 1, int(np.ceil(len(ordered) * (1 - good_loss))))]
    cuts = np.unique(scores[scores > least])
    if not len(cuts):
        return np.inf
    bad = np.sort(scores[~good])
    gain = (len(bad) - np.searchsorted(bad, cuts)) - (len(ordered) - np.searchsorted(ordered, cuts))
    best = int(np.argmax(gain))
    below = scores[scores < cuts[best]]
    return float((cuts[best] + below.max()) / 2) if len(below) else float(cuts[best])


class Forests:
    """A forest for each feature and one for all, each with its threshold."""

    def __init__(self, rows: np.ndarray, good: np.ndarray):
        self.parts = [[i] for i in range(rows.shape[1])] + [[*range(rows.shape[1])]]
        self.forests = [IsolationForest(rows[:, p]) for p in self.parts]
        self.limits = np.array([threshold(s, good) for s in self._scores(rows).T])

    def _scores(self, rows: np.ndarray) -> np.ndarray:
        return np.column_stack([f.score(rows[:, p]) for f, p in zip(self.forests, self.parts)])

    def judge(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score of the forest of all features, and whether no forest rejects."""
        scores = self._scores(rows)
        return scores[:, -1], (scores < self.limits).all(axis=1)


def _stats_column(column: pa.Array) -> np.ndarray:
    found = [statistics(data, offsets) for _, _, data, offsets in slices(column)]
    return np.concatenate(found) if found else np.zeros((0, len(STATS) + len(EXTRA)), np.int64)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Forests | None:
    """Forests from at most fit_rows labelled documents, taken in order of a hash of the id."""
    rows = labelled_sample(docs, labels, label_col, fit_rows, None, id_col, text_col)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = _stats_column(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(stats), pa.list_(pa.int64())), batch.column(2).cast(pa.int64())], names=["id", "stats", "label"])

    got = rows.mapInArrow(run, f"id {dict(docs.select(id_col).dtypes)[id_col]}, stats array<long>, label long").toPandas()
    got = got.sort_values("id", kind="stable")
    stats = np.array(got["stats"].tolist(), np.int64).reshape(-1, len(STATS) + len(EXTRA))
    good = got["label"].to_numpy() == 1
    use = ~base_failed(stats)
    stats, good = stats[use], good[use]
    if len(stats) < 16:
        return None
    x = features(stats)
    return Forests(x, good)


def judge(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """All columns of docs, the statistics, base_failed, anomaly and kept.

    A null text has no words and fails the base rules.  With fewer than 16 usable labelled rows no
    forest is grown and the base rules decide alone.  Repeated rows are judged alike; an empty table
    gives no rows.  Columns of docs with names of the result are replaced.
    """
    model = fit(docs, labels, fit_rows, id_col, text_col, label_col)
    added = [*STATS, "base_failed", "anomaly", "kept"]
    extra = [c for c in docs.columns if c not in added]
    docs = docs.select(*[F.col(f"`{c}`") for c in extra])
    place = extra.index(text_col)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = _stats_column(batch.column(place))
            failed = base_failed(stats)
            score, kept = np.zeros(len(stats)), ~failed
            if model and len(stats):
                score, normal = model.judge(features(stats))
                kept &= normal
            own = [pa.array(stats[:, i]) for i in range(len(STATS))] + [pa.array(failed), pa.array(score), pa.array(kept)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], names=[*extra, *added])

    kinds = [T.LongType()] * len(STATS) + [T.BooleanType(), T.DoubleType(), T.BooleanType()]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *map(T.StructField, added, kinds)]))
