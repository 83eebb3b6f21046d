"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is learned: words, and word beginnings of four and five letters, that stand far more often in
labelled toxic documents than in others.  Features are densities of lexicon words, plain and
with obfuscation undone, their nearness to second-person words, and rates of capitals, punctuation
and obfuscation.  The labelled sample, of at most `fit_rows` rows, is dealt into folds; a fold's features
are taken with a lexicon of the other folds, the trees are grown on all folds but the first, and the first
calibrates them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from courtframes.llm.common import labelled_sample, slices, tidy, words_of

FIT_ROWS = 8192
LEXICON = 1000
NEAR = 5
FOLDS = 5
LEAST_SHARE = 0.01
TRIM = ".,!?;:\"'()[]*-_|#%&$"
#: Second-person words.
SECOND_PERSON = ["you", "your", "yours", "ya", "u", "tu", "te", "ti", "toi", "ton", "vous", "votre", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tú", "usted", "ustedes", "vosotros"]
#: Signs that stand for letters.
DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": None, ".": None, "-": None, "_": None})


class Lexicon:
    def __init__(self, texts: list[str], toxic: np.ndarray, size: int = LEXICON):
        seen = (Counter(), Counter())
        for text, y in zip(texts, toxic.tolist()):
            words = {w.strip(TRIM) for w in text.lower().split()}
            seen[y].update({("w", w) for w in words if len(w) > 1} | {("p", w[:k]) for w in words for k in (4, 5) if len(w) >= k})
        n = np.maximum(np.bincount(toxic.astype(int), minlength=2), 1)
        odds = {}
        for key, count in seen[1].items():
            if count >= max(3, LEAST_SHARE * n[1]):
                odds[key] = float(np.log((count + 0.1) / n[1]) - np.log((seen[0][key] + 0.5) / n[0]))
        top = sorted((k for k in odds if odds[k] > 2), key=lambda k: (-odds[k] * np.log1p(seen[1][k]), k))[:size]
        self.words = {w: odds["w", w] for kind, w in top if kind == "w"}
        self.heads = {w: odds["p", w] for kind, w in top if kind == "p"}

    def weights(self, words: pa.Array) -> np.ndarray:
        """Log-odds of distinct lower-case words, zero for those in neither list."""
        out = _look(words, self.words)
        for k in (4, 5):
            out = np.maximum(out, _look(pc.utf8_slice_codeunits(words, 0, k), {h: v for h, v in self.heads.items() if len(h) == k}))
        return out


def _look(words: pa.Array, table: dict[str, float]) -> np.ndarray:
    if not table:
        return np.zeros(len(words))
    at = pc.fill_null(pc.index_in(words, value_set=pa.array(list(table), words.type)), len(table))
    return np.append(np.fromiter(table.values(), float), 0.0)[at.to_numpy(zero_copy_only=False)]


FEATURES = ["lexicon density", "log of lexicon words", "mean log-odds", "largest log-odds", "obfuscated lexicon density", "near second person", "second person density", "capitals", "punctuation", "exclamation", "obfuscation rate", "log of words"]

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def features(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    n = len(offsets) - 1
    words = words_of(data, offsets, lower=False)
    per, count = words.per_text, np.diff(words.per_text)
    coded = words.strings().dictionary_encode()
    names = pc.utf8_trim(pc.utf8_lower(coded.dictionary), TRIM)
    weight = lexicon.weights(names)
    # words that mix letters with signs or digits inside
    mixed = pc.match_substring_regex(names, r"[A-Za-z][0-9@$!*._\-]+[A-Za-z]").to_numpy(zero_copy_only=False)
    plain = np.zeros(len(names))
    if mixed.any():
        undone = [w.translate(DISGUISE) for w in names.filter(pa.array(mixed)).to_pylist()]
        plain[mixed] = lexicon.weights(pa.array(undone, pa.large_string()))
    second = pc.is_in(names, value_set=pa.array(SECOND_PERSON, names.type)).to_numpy(zero_copy_only=False)
    code = coded.indices.to_numpy(zero_copy_only=False)
    weight, plain, mixed, second = (x[code] if len(x) else np.zeros(0) for x in (weight, plain, mixed, second))
    text_of = np.repeat(np.arange(n), count)

    def total(x: np.ndarray) -> np.ndarray:
        run = np.append(0.0, np.cumsum(x, dtype=float))
        return run[per[1:]] - run[per[:-1]]

    hit = (weight > 0) | (plain > 0)
    near = np.zeros(len(hit), bool)
    at = np.flatnonzero(hit)
    if len(at) and second.any():
        spots = np.flatnonzero(second)
        right = np.searchsorted(spots, at)
        for side in (np.minimum(right, len(spots) - 1), np.maximum(right - 1, 0)):
            s = spots[side]
            near[at] |= (np.abs(s - at) <= NEAR) & (text_of[s] == text_of[at])
    largest = np.zeros(n)
    np.maximum.at(largest, text_of[at], np.maximum(weight, plain)[at])
    per_byte = lambda flags: np.diff(np.append(0, np.cumsum(flags, dtype=np.int64))[offsets])
    letters = np.maximum(per_byte(_LETTER[data]), 1)
    size = np.maximum(count, 1)
    hits = total(hit)
    return np.column_stack([
        hits / size, np.log1p(hits), total(weight) / np.maximum(hits, 1), largest, total(plain > 0) / size, total(near) / np.maximum(hits, 1),
        total(second) / size, per_byte((data >= 65) & (data <= 90)) / letters, per_byte(_PUNCT[data]) / size, per_byte(data == 0x21) / size,
        total(mixed) / size, np.log1p(count),
    ])


class BoostedTrees:
    """Logistic boosting of small trees over quantile bins."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, least: float = 1.0):
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        code = self._code(x)
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start, self.rate, self.depth = float(np.log(p / (1 - p))), rate, depth
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        f = np.full(len(y), self.start)
        for _ in range(rounds):
            q = 1 / (1 + np.exp(-f))
            g, h = y - q, np.maximum(q * (1 - q), 1e-6)
            feature, cut, value = np.zeros(2**depth, int), np.full(2**depth, bins, int), np.zeros(2 ** (depth + 1))
            node = np.ones(len(y), int)
            for level in range(depth):
                width = 2 ** (level + 1)
                best = np.full(width, 1e-9)
                for j in range(x.shape[1]):
                    at = node * bins + code[:, j]
                    gs, hs = (np.bincount(at, weights=w, minlength=width * bins).reshape(width, bins).cumsum(axis=1) for w in (g, h))
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = gs**2 / (hs + least) + (gt - gs) ** 2 / (ht - hs + least) - gt**2 / (ht + least)
                    b = gain.argmax(axis=1)
                    better = gain[np.arange(width), b] > best
                    better[: width // 2] = False
                    own = np.flatnonzero(better)
                    best[own], feature[own], cut[own] = gain[own, b[own]], j, b[own]
                node = 2 * node + (code[np.arange(len(y)), feature[node]] > cut[node])
            top = len(value)
            value = rate * np.bincount(node, weights=g, minlength=top) / (np.bincount(node, weights=h, minlength=top) + least)
            f += value[node]
            self.trees.append((feature, cut, value))

    def _code(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T)])

    def margin(self, x: np.ndarray) -> np.ndarray:
        code, f, row = self._code(x), np.full(len(x), self.start), np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.ones(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + (code[row, feature[node]] > cut[node])
            f += value[node]
        return f


class Isotonic:
    """Least-squares rising steps by pooling adjacent violators, joined by straight lines."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        order = np.argsort(x, kind="stable")
        blocks: list[list[float]] = []  # mean, weight, least x, largest x
        for a, b in zip(x[order].tolist(), y[order].tolist()):
            blocks.append([b, 1.0, a, a])
            while len(blocks) > 1 and (blocks[-2][0] >= blocks[-1][0] or blocks[-2][3] == blocks[-1][2]):
                m, w, _, hi = blocks.pop()
                last = blocks[-1]
                last[0] = (last[0] * last[1] + m * w) / (last[1] + w)
                last[1] += w
                last[3] = hi
        self.x = np.array([v for b in blocks for v in (b[2], b[3])])
        self.y = np.array([v for b in blocks for v in (b[0], b[0])])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.interp(x, self.x, self.y) if len(self.x) else np.full(len(x), 0.5)


class ToxicityModel:
    def __init__(self, texts: list[str], toxic: np.ndarray):
        fold = np.arange(len(texts)) % FOLDS
        x = np.zeros((len(texts), len(FEATURES)))
        for k in range(FOLDS):
            inside = np.flatnonzero(fold != k)
            self.lexicon = Lexicon([texts[i] for i in inside], toxic[inside])
            x[fold == k] = self.features(pa.array([texts[i] for i in np.flatnonzero(fold == k)], pa.large_string()))
        self.lexicon = Lexicon(texts, toxic)
        trees = fold > 0
        self.trees = BoostedTrees(x[trees], toxic[trees].astype(float))
        self.calibration = Isotonic(self.trees.margin(x[~trees]), toxic[~trees].astype(float))

    def features(self, column: pa.Array) -> np.ndarray:
        found = [features(data, offsets, self.lexicon) for _, _, data, offsets in slices(column)]
        return np.concatenate(found) if found else np.zeros((0, len(FEATURES)))

    def score(self, column: pa.Array) -> np.ndarray:
        margin = self.trees.margin(self.features(column))
        # a hundredth of the uncalibrated chance keeps the order inside steps
        return np.clip(0.99 * self.calibration(margin) + 0.01 / (1 + np.exp(-margin)), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, allowed=None, fit_rows: int = FIT_ROWS, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel | None:
    """None where fewer than 20 labelled rows are there, or one class alone.

    Texts of the sample, bounded in number, come to the driver, where the model is fitted.
    """
    got = labelled_sample(docs, labels, label_col, fit_rows, allowed, id_col, text_col).toPandas().sort_values(["id", "text"], kind="stable")
    y = (got["label"].to_numpy() == 1).astype(int)
    if len(y) < 20 or y.min() == y.max():
        return None
    return ToxicityModel(got["text"].fillna("").tolist(), y)


def predict(docs: DataFrame, model: ToxicityModel | None, limit: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) of each row.  Null and empty texts are scored as texts without words;
    without a model every score is 0.  Repeated rows are scored alike; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            score = own.score(batch.column(1)) if own and len(batch) else np.zeros(len(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= limit).astype(np.int32))], names=[id_col, "score", "predicted"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {dict(docs.select(id_col).dtypes)[id_col]}, score double, predicted int")
