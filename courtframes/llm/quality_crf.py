"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad.  A line's potential depends on features of itself and of its neighbours, and
neighbouring labels depend on each other; documents' labels are taken as labels of all their lines in
training.  The document's score is the mean, weighted by length, of the forward-backward chances that its
lines are good, put on the scale of the label by a logistic curve.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from courtframes.llm.common import labelled_sample, slices, tidy, words_of

FIT_ROWS = 4096
ROUNDS = 120
OWN = 14


def _flags(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a:b] = True
    return out


_SYMBOL = _flags((0x23, 0x27), (0x2A, 0x2B), (0x3C, 0x3D), (0x3E, 0x3F), (0x7C, 0x7D))
_UPPER, _LOWER, _DIGIT, _HIGH = _flags((65, 91)), _flags((97, 123)), _flags((48, 58)), _flags((0x80, 0x100))


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each line with those of both neighbours, its length in words, and where texts begin."""
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == 0x0A) + 1
    begin = np.sort(np.concatenate([offsets[:-1], breaks]), kind="stable")
    # a feed at the end of a text begins an empty line of that text, next to the following text's first
    text = np.sort(np.concatenate([np.arange(n), np.searchsorted(offsets[1:], breaks - 1, "right")]), kind="stable")
    first = np.searchsorted(text, np.arange(n + 1))
    bounds = np.append(begin, len(data))
    words = words_of(data, bounds)
    per, count = words.per_text, np.diff(words.per_text)
    ids = words.strings().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = np.maximum(count, 1)

    def by_byte(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(flags, dtype=np.int64))[bounds]).astype(float)

    def by_word(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(flags, dtype=np.int64))[per]).astype(float)

    same = np.zeros(len(ids), bool)
    same[1:] = ids[1:] == ids[:-1]
    same[per[:-1][per[:-1] < len(ids)]] = False
    line_of = np.repeat(np.arange(len(count)), count)
    distinct = np.zeros(len(count))
    if len(ids):
        pair = np.unique(line_of * (int(ids.max()) + 1) + ids)
        distinct = np.bincount(pair // (int(ids.max()) + 1), minlength=len(count)).astype(float)
    upper, letters = by_byte(_UPPER[data]), by_byte(_LOWER[data] | _HIGH[data])
    symbols, bangs = by_byte(_SYMBOL[data]), by_byte(data == 0x21)
    filled = count > 0
    own = np.column_stack([
        filled, np.log1p(count) / 4, np.minimum(symbols / size, 2), symbols > 0, np.minimum(bangs / size, 2), bangs > 0,
        upper / np.maximum(upper + letters, 1), filled & (upper > letters), by_word(same) / size, by_word(same) > 0,
        distinct / size, np.minimum(np.diff(words.offsets[per]) / size / 8, 3), np.minimum(by_byte(_DIGIT[data]) / size, 3),
        np.minimum(by_byte((data == 0x2E) | (data == 0x2C)) / size, 1),
    ]).astype(np.float64)
    return with_neighbours(own, first), count.astype(float), first


def with_neighbours(own: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Features of each line, of the line before and of that after it in the same text, and where it stands."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    edge = np.zeros((len(own), 3))
    edge[:, 0] = 1
    edge[first[:-1], 1] = 1
    edge[first[1:] - 1, 2] = 1
    return np.column_stack([own, before, after, edge])


class LineCRF:
    """Weights of potentials of label good, and of each pair of neighbouring labels."""

    def __init__(self, width: int = 3 * OWN + 3):
        self.weight, self.pair = np.zeros(width), np.zeros((2, 2))
        self.scale = np.array([1.0, 0.0])

    def marginals(self, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chance that each line is good, of each pair of labels at each line and the next, log partition."""
        size = np.diff(first)
        order = np.argsort(-size, kind="stable")
        start, size = first[:-1][order], size[order]
        unary = np.zeros((len(x), 2))
        unary[:, 1] = x @ self.weight
        longest = int(size[0]) if len(size) else 0
        alive = np.searchsorted(-size, -np.arange(longest), "left")
        fore, back = unary.copy(), np.zeros_like(unary)
        for i in range(1, longest):
            at = start[: alive[i]] + i
            fore[at] += np.logaddexp(fore[at - 1, 0, None] + self.pair[0], fore[at - 1, 1, None] + self.pair[1])
        for i in range(longest - 2, -1, -1):
            at = start[: alive[i + 1]] + i
            then = unary[at + 1] + back[at + 1]
            back[at] = np.logaddexp(then[:, 0, None] + self.pair[:, 0], then[:, 1, None] + self.pair[:, 1])
        whole = np.logaddexp(*(fore + back).T)
        good = np.exp(fore[:, 1] + back[:, 1] - whole)
        inner = np.ones(len(x), bool)
        inner[first[1:] - 1] = False
        at = np.flatnonzero(inner)
        pairs = np.exp(fore[at][:, :, None] + self.pair + (unary[at + 1] + back[at + 1])[:, None, :] - whole[at, None, None])
        return good, pairs, whole

    def fit(self, x: np.ndarray, first: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS, rate: float = 0.1, shrink: float = 1e-3) -> LineCRF:
        """Adam on the mean log-likelihood per document; documents of both labels weigh as they occur."""
        size = np.diff(first)
        y = np.repeat(labels, size).astype(float)
        # a document counts once, however many lines it has
        share = np.repeat(1 / size, size)
        inner = np.ones(len(x), bool)
        inner[first[1:] - 1] = False
        n = len(labels)
        state = [np.zeros(len(self.weight) + 4) for _ in range(2)]
        for t in range(1, rounds + 1):
            good, pairs, _ = self.marginals(x, first)
            g_unary = x.T @ (share * (y - good)) / n - shrink * self.weight
            seen = np.zeros((2, 2))
            w = share[inner]
            seen[0, 0], seen[1, 1] = w[y[inner] == 0].sum(), w[y[inner] == 1].sum()
            g_pair = (seen - np.einsum("i,ijk->jk", w, pairs)) / n - shrink * self.pair
            g = np.concatenate([g_unary, g_pair.ravel()])
            state[0] = 0.9 * state[0] + 0.1 * g
            state[1] = 0.99 * state[1] + 0.01 * g * g
            step = rate * (state[0] / (1 - 0.9**t)) / (np.sqrt(state[1] / (1 - 0.99**t)) + 1e-8)
            self.weight = self.weight + step[:-4]
            self.pair = self.pair + step[-4:].reshape(2, 2)
        return self

    def share(self, x: np.ndarray, length: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log-odds of the mean chance of lines to be good, weighted by length in words."""
        good, _, _ = self.marginals(x, first)
        length = np.maximum(length, 1e-6)  # a text without words takes the mean of its empty lines
        share = np.add.reduceat(good * length, first[:-1]) / np.add.reduceat(length, first[:-1])
        share = np.clip(share, 1e-6, 1 - 1e-6)
        return np.log(share / (1 - share))

    def calibrate(self, odds: np.ndarray, labels: np.ndarray) -> None:
        """A rising logistic curve from the share of good lines to the chance of the label, by Newton's method."""
        x = np.column_stack([odds, np.ones(len(odds))])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ self.scale, -30, 30)))
            step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 0.1 * np.eye(2), x.T @ (labels - p) - 0.1 * (self.scale - [1.0, 0.0]))
            self.scale = self.scale + np.clip(step, -1, 1)
        self.scale[0] = max(self.scale[0], 0.05)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        odds = self.share(*line_features(data, offsets))
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * odds + self.scale[1], -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, allowed=None, fit_rows: int = FIT_ROWS, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> LineCRF | None:
    """A field fitted on all lines of at most fit_rows labelled documents.  None without both labels.

    Features are taken on the executors; the rows come to the driver in order of id and text, so the weights do not
    depend on how rows are dealt.
    """

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for _, _, data, offsets in slices(batch.column(1)):
                x, _, first = line_features(data, offsets)
                rows += [x[a:b, :OWN].astype(np.float32).tobytes() for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary()), batch.column(2)], names=["id", "x", "label"])

    sample = labelled_sample(docs, labels, label_col, fit_rows, allowed, id_col, text_col)
    got = sample.mapInArrow(run, f"id {dict(sample.dtypes)['id']}, x binary, label int").toPandas().sort_values("id", kind="stable")
    y = (got["label"].to_numpy() == 1).astype(int)
    if len(y) < 20 or y.min() == y.max():
        return None
    crf = LineCRF()
    own = np.frombuffer(b"".join(got["x"]), np.float32).reshape(-1, OWN).astype(float)
    first = np.append(0, np.cumsum([len(v) // (4 * OWN) for v in got["x"]]))
    x = with_neighbours(own, first)
    crf.fit(x, first, y)
    crf.calibrate(crf.share(x, np.expm1(4 * x[:, 1]), first), y)
    return crf


def predict(docs: DataFrame, model: LineCRF | None, limit: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) of each row.  A null text is one empty line, like an empty text; without a
    model every score is 0.5.  Repeated rows are scored alike; an empty table gives no rows."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(data, offsets) if model else np.full(len(offsets) - 1, 0.5) for _, _, data, offsets in slices(batch.column(1))]
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= limit).astype(np.int32))], names=[id_col, "score", "predicted"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {dict(docs.select(id_col).dtypes)[id_col]}, score double, predicted int")
