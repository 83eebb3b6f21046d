"""Language identification by cross-parsing against suffix automata.

For each language a suffix automaton recognises every substring of labelled text.  A document is
parsed greedily into the longest phrases that the automaton knows; in the language that fits, phrases are
long and few.  Phrases are normalised by the number of symbols parsed, and the language with the
fewest wins.  A missing transition starts a new phrase from the root, so numpy parses thousands of pieces in lock-step.
Most states have one transition, which is kept by itself; only those that branch have a full row.

Texts are parsed whole.  A long text is dealt into pieces of PIECE symbols that are first parsed each by itself; then a
piece is parsed again from the state in which the piece before it ends, until it comes to a state that it already had
at that place, from where on nothing changes.  So the phrases are those of one parse from the text's first symbol.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtframes.llm.common import slices, tidy

#: The sample of a language: so many labelled rows, whole, whatever their length.
FIT_DOCS = 48
#: The automata are broadcast, so their size is checked first.
MODEL_BYTES = 512 << 20
#: Symbols that are parsed in lock-step; no result depends on it.
PIECE = 512
COMMON, RARE = 200, 32
SHARPNESS = 40.0


class Alphabet:
    """Code points to symbols: 0 for what is no letter, the commonest letters of the sample, and
    RARE buckets that the other letters share, so tables stay narrow for any script."""

    def __init__(self, texts: list[str]):
        counts = Counter(c for t in texts for c in t.lower() if c.isalpha())
        found = sorted(sorted(counts, key=lambda c: (-counts[c], c))[:COMMON])
        self.size = 1 + len(found) + RARE
        self.table = np.zeros(0x110000, np.uint8)
        for lo, hi in _letter_ranges():
            self.table[lo:hi] = 1 + len(found) + np.arange(lo, hi) % RARE
        for i, c in enumerate(found, 1):
            for form in {c, c.upper(), c.title()}:
                if len(form) == 1:
                    self.table[ord(form)] = i

    def letters(self, codes: np.ndarray) -> np.ndarray:
        return self.table[codes]


def _letter_ranges() -> list[tuple[int, int]]:
    points = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], points.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def squeeze(symbols: np.ndarray) -> np.ndarray:
    """Mask that keeps one of each run of symbol 0."""
    keep = symbols != 0
    keep[1:] |= symbols[:-1] != 0
    return keep


class Automaton(NamedTuple):
    """Transitions: next[s] for symbol[s], and full[row[s] + c] for others, with the top bit where a new phrase begins.

    Row 0 is that of a state without other transitions.  The last state is that before a phrase, where each symbol begins one; unknown
    symbols are phrases of their own.
    """

    symbol: np.ndarray  # uint8, OTHER where no transition is kept by itself
    next: np.ndarray  # uint32
    row: np.ndarray  # uint32
    full: np.ndarray  # uint32

    def step(self, at: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        out = self.next[at]
        miss = np.flatnonzero(self.symbol[at] != symbols)
        out[miss] = self.full[self.row[at[miss]] + symbols[miss]]
        return out


def automaton(symbols: np.ndarray, size: int) -> Automaton:
    """The suffix automaton of the symbols, which are below size."""
    # a state's first transition is in two arrays, further ones in a dictionary of those states that have any
    symbol, target, link, length = array("h", [-1]), array("q", [-1]), array("q", [-1]), array("q", [0])
    more: dict[int, dict[int, int]] = {}
    last = 0
    for c in symbols.tolist():
        new = len(symbol)
        symbol.append(-1)
        target.append(-1)
        link.append(0)
        length.append(length[last] + 1)
        p, q = last, -1
        while p >= 0:
            if symbol[p] == c:
                q = target[p]
                break
            if symbol[p] < 0:
                symbol[p], target[p] = c, new
            else:
                own = more.setdefault(p, {})
                if (q := own.setdefault(c, new)) != new:
                    break
            p = link[p]
        if p >= 0:
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = len(symbol)
                symbol.append(symbol[q])
                target.append(target[q])
                link.append(link[q])
                length.append(length[p] + 1)
                if q in more:
                    more[clone] = dict(more[q])
                while p >= 0:
                    if symbol[p] == c and target[p] == q:
                        target[p] = clone
                    elif p in more and more[p].get(c) == q:
                        more[p][c] = clone
                    else:
                        break
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    n = len(symbol)
    first, to = np.array(symbol, np.int64), np.array(target, np.int64)
    root = np.full(size, n, np.int64)
    if n > 1:
        root[list(more.get(0, {}))] = list(more.get(0, {}).values())
        root[first[0]] = to[0]
    full = np.tile(root | BREAK, (1 + len(more), 1))
    row = np.zeros(n + 1, np.int64)
    for k, (state, own) in enumerate(more.items(), 1):
        full[k, list(own)] = list(own.values())
        full[k, first[state]] = to[state]
        row[state] = k * size
    alone = (first >= 0) & (row[:n] == 0)
    return Automaton(
        np.append(np.where(alone, first, OTHER), OTHER).astype(np.uint8),
        np.append(np.where(alone, to, 0), 0).astype(np.uint32),
        row.astype(np.uint32),
        full.ravel().astype(np.uint32),
    )


BREAK, OTHER = 1 << 31, 255


class CrossParser:
    def __init__(self, texts: dict[str, list[str]]):
        self.langs = sorted(texts)
        self.alphabet = Alphabet([t for lang in self.langs for t in texts[lang]])
        self.tables = []
        for lang in self.langs:
            codes = np.frombuffer("\n".join(texts[lang]).encode("utf-32-le"), np.uint32)
            symbols = self.alphabet.letters(codes)
            self.tables.append(automaton(symbols[squeeze(symbols)], self.alphabet.size))

    def nbytes(self) -> int:
        return self.alphabet.table.nbytes + sum(part.nbytes for table in self.tables for part in table)

    def phrases(self, symbols: np.ndarray, offsets: np.ndarray, piece: int = PIECE) -> np.ndarray:
        """Phrases of each text (a stretch of symbols) in each language."""
        n = len(offsets) - 1
        out = np.zeros((len(self.langs), n))
        size = np.diff(offsets)
        parts = -(-size // piece)
        row = np.repeat(np.arange(n), parts)
        if not len(row):
            return out
        nth = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = offsets[row] + piece * nth
        length = np.minimum(piece, offsets[row + 1] - begin)
        order = np.argsort(-length, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        row, length = row[order], length[order]
        # the piece after and whether one is before, in this order; -1 where a text ends
        after = np.where(np.append(nth[1:], 0) > 0, np.append(place[1:], 0), -1)[order]
        follows = np.flatnonzero(nth[order] > 0)
        before = place[order[follows] - 1]
        padded = np.append(symbols, np.zeros(piece, symbols.dtype))
        columns = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, piece)[begin[order]].T)
        alive = np.searchsorted(-length, -np.arange(piece), "left").tolist()
        states, breaks = np.empty(columns.shape, np.uint32), np.zeros(columns.shape, bool)
        for k, table in enumerate(self.tables):
            start = len(table.row) - 1
            state = np.full(len(row), start, np.uint32)
            for i, m in enumerate(alive):
                if not m:
                    break
                at = table.step(state[:m], columns[i, :m])
                np.greater_equal(at, BREAK, out=breaks[i, :m])
                at &= BREAK - 1
                states[i, :m] = state[:m] = at
            todo, entry = follows, state[before]
            while len(todo):
                i, own, at, ended = 0, todo, entry, []
                while len(own):
                    done = length[own] <= i
                    if done.any():
                        ended.append(own[done])
                        state[own[done]] = at[done]
                        own, at = own[~done], at[~done]
                        continue
                    at = table.step(at, columns[i, own])
                    breaks[i, own] = at >= BREAK
                    at &= BREAK - 1
                    new = at != states[i, own]
                    states[i, own] = at
                    own, at = own[new], at[new]
                    i += 1
                # pieces that came to their end in another state hand it on
                todo = np.concatenate(ended) if ended else np.zeros(0, np.int64)
                todo = todo[after[todo] >= 0]
                todo, entry = after[todo], state[todo]
            counts = np.zeros(len(row), np.int64)
            for i, m in enumerate(alive):
                counts[:m] += breaks[i, :m]
            out[k] = np.bincount(row, weights=counts, minlength=n)
        return out

    def predict(self, texts_data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each text of a slice."""
        n = len(offsets) - 1
        text = texts_data.tobytes().decode()
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        # offsets in code points
        heads = np.append(0, np.cumsum((texts_data & 0xC0) != 0x80))
        offsets = heads[offsets]
        symbols = self.alphabet.letters(codes)
        keep = squeeze(symbols)
        keep[offsets[:-1][offsets[:-1] < len(keep)]] = True
        kept = np.append(0, np.cumsum(keep))
        symbols, offsets = symbols[keep], kept[offsets]
        letters = np.append(0, np.cumsum(symbols != 0))
        has = letters[offsets[1:]] > letters[offsets[:-1]]
        rate = self.phrases(symbols, offsets) / np.maximum(np.diff(offsets), 1)
        best = rate.argmin(axis=0) if len(self.langs) else np.zeros(n, int)
        weight = np.exp(-SHARPNESS * (rate - rate.min(axis=0))) if len(self.langs) else np.ones((1, n))
        score = np.where(has, 1 / weight.sum(axis=0), 0.0) if len(self.langs) else np.zeros(n)
        return [self.langs[b] if h and self.langs else "und" for b, h in zip(best, has)], score


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS, text_col: str = "text", lang_col: str = "lang") -> CrossParser:
    """Automata of a sample of each language: its first fit_docs distinct texts in order of their hash.

    Texts are taken whole, whatever their length.  Distinct texts are counted first and thinned by their hash, so no language is gathered
    whole, and copies count once.  The sample does not depend on how rows are dealt.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).withColumn("h", F.xxhash64("text"))
    rows = rows.filter("lang is not null and text is not null and length(text) > 0")
    langs = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"), F.min("h").alias("least")).collect()
    if not langs:
        return CrossParser({})
    scale = 1 << 30
    # at least a language's text of the least hash
    share = F.create_map(*[F.lit(x) for r in langs for x in (r["lang"], int(min(1.0, 2 * fit_docs / max(1, r["n"])) * scale))])
    least = F.create_map(*[F.lit(x) for r in langs for x in (r["lang"], r["least"])])
    lang = F.col("lang")
    picked = rows.filter((F.pmod("h", F.lit(scale)) < share[lang]) | (F.col("h") == least[lang])).groupBy("lang", "h").agg(F.min("text").alias("text"))
    # a window holds the thinned texts of a language, some 2 * fit_docs
    order = Window.partitionBy("lang").orderBy("h")
    got = picked.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= fit_docs).select("lang", "h", "text").toPandas()
    return CrossParser({lang: g.sort_values("h", kind="stable")["text"].tolist() for lang, g in got.groupby("lang")})


def predict(docs: DataFrame, model: CrossParser, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of each row; `und` with score 0 for texts that are null or have no letter.

    Ties go to the first language by name.  A model without languages gives `und`.  Repeated rows are
    predicted alike; an empty table gives no rows.  A model of more than MODEL_BYTES is an error, as it is broadcast.
    """
    if (size := model.nbytes()) > MODEL_BYTES:
        raise ValueError(f"the automata take {size} bytes; fit them on fewer rows")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = shared.value
        for batch in batches:
            langs, scores = [], []
            for _, _, data, offsets in slices(batch.column(1)):
                lang, score = parser.predict(data, offsets)
                langs += lang
                scores.append(score)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else np.zeros(0))], names=[id_col, "lang_pred", "score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {dict(docs.select(id_col).dtypes)[id_col]}, lang_pred string, score double")
