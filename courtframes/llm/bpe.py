"""Byte-level BPE encoding and decoding as a tree reduction.

encode(x + y) is not encode(x) + encode(y), but it differs only near the seam.  A sequence of tokens
is the BPE encoding of its bytes exactly when each two neighbours are stable, that is, when encoding
the bytes of the two gives the two again: merges are ordered by rank and then by place, so a merge
across a seam would also take place between the two neighbours alone.  Hence `join` re-encodes a
window of tokens on both sides of the seam, and widens it until the tokens next to the window are
stable against it; those farther out then provably stay.  Joining is associative, with the empty
sequence as its unit, so pieces are encoded by halves and joined up a tree.

Pieces are the matches of the split pattern.  A seam between pieces never merges, so the upper part of
the tree, over the pieces of a text, is concatenation, and so is the whole tree of decoding.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from courtframes.llm.common import slices, tidy

LEAF = 6
CACHE = 120_000
NEVER = 1 << 40
#: White space of the split pattern: the Unicode property, as the library that is matched takes it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def split_pattern(pattern: str = public_tokenizers.PATTERN) -> regex.Pattern:
    return regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]"))


class TreeBPE:
    """Encoder and decoder over a table of byte strings and their ranks; caches are bounded."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.windows: dict[bytes, tuple[int, ...]] = {}
        self.seams: dict[tuple[int, int], bool] = {}

    def merged(self, data: bytes) -> tuple[int, ...]:
        """Plain merging, for leaves and windows: the pair of lowest rank first, the leftmost of equals."""
        got = self.windows.get(data)
        if got is not None:
            return got
        parts = [data[i : i + 1] for i in range(len(data))]
        rank = self.ranks.get
        pairs = [rank(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) != NEVER:
            at = pairs.index(best)
            parts[at : at + 2] = [new := parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = rank(parts[at - 1] + new, NEVER)
            if at < len(pairs):
                pairs[at] = rank(new + parts[at + 1], NEVER)
        got = tuple(map(self.ranks.__getitem__, parts))
        if len(data) <= 12:
            if len(self.windows) > CACHE:
                self.windows.clear()
            self.windows[data] = got
        return got

    def stable(self, a: int, b: int) -> bool:
        got = self.seams.get((a, b))
        if got is None:
            if len(self.seams) > CACHE:
                self.seams.clear()
            got = self.seams[a, b] = self.merged(self.bytes_of[a] + self.bytes_of[b]) == (a, b)
        return got

    def join(self, x: tuple[int, ...], y: tuple[int, ...]) -> tuple[int, ...]:
        if not x or not y or self.stable(x[-1], y[0]):
            return x + y
        left, right = len(x) - 1, 1
        while True:
            window = self.merged(b"".join(map(self.bytes_of.__getitem__, x[left:] + y[:right])))
            left_ok = left == 0 or self.stable(x[left - 1], window[0])
            right_ok = right == len(y) or self.stable(window[-1], y[right])
            if left_ok and right_ok:
                return x[:left] + window + y[right:]
            left -= not left_ok
            right += not right_ok

    def encode_bytes(self, data: bytes) -> tuple[int, ...]:
        """The tree over the bytes of one piece."""
        if len(data) <= LEAF:
            return self.merged(data)
        mid = len(data) // 2
        return self.join(self.encode_bytes(data[:mid]), self.encode_bytes(data[mid:]))

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode()
        whole = self.ranks.get(data)
        return (whole,) if whole is not None else self.encode_bytes(data)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def load(path: str) -> TreeBPE:
    with open(path, "rb") as f:
        return TreeBPE({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


_NEXT = np.zeros(256, bool)
_NEXT[0x21:0x7F] = True
_NEXT[0xC3:0xE1] = True  # lead bytes of letters; those that also begin white space are left out
_GRAPHIC = np.zeros(256, bool)
_GRAPHIC[0x21:0x7F] = True


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where no piece of the split pattern can cross, about one for each word.

    Between texts, before a space that a visible character follows, and around a line feed between
    visible characters.
    """
    at = np.zeros(len(data) + 1, bool)
    if len(data) > 2:
        after = _NEXT[data[2:]]
        np.logical_and(data[1:-1] == 0x20, after, out=at[1:-2])
        line = np.flatnonzero((data[1:-1] == 0x0A) & after & _GRAPHIC[data[:-2]]) + 1
        at[line] = at[line + 1] = True
        at[offsets[1:] - 1] = False  # a text's last byte was judged by the next text's first
    at[offsets] = True
    return np.flatnonzero(at)


class Memory:
    """Bounded map from a span of text to its ids as bytes: two generations, so common spans stay."""

    def __init__(self, size: int = CACHE) -> None:
        self.size = size
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get(self, span: str) -> bytes | None:
        got = self.young.get(span)
        if got is None and (got := self.old.get(span)) is not None:
            self.put(span, got)
        return got

    def put(self, span: str, ids: bytes) -> None:
        if len(span) <= 40:
            if len(self.young) >= self.size:
                self.old, self.young = self.young, {}
            self.young[span] = ids

    def all(self, spans: list[str], encode: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """Ids of each span; those not known are encoded together."""
        found = list(map(self.young.get, spans))
        missing = []
        for i, got in enumerate(found):
            if got is None:
                found[i] = got = self.get(spans[i])
                if got is None:
                    missing.append(i)
        if missing:
            for i, ids in zip(missing, encode([spans[i] for i in missing])):
                found[i] = ids
                self.put(spans[i], ids)
        return found


def gather(coded: pa.DictionaryArray, found: list[bytes], at: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a slice from those of its distinct spans, and the place where each text begins.

    at: where spans begin in the bytes; offsets: where texts begin in the bytes.
    """
    sizes = np.fromiter(map(len, found), np.int32, len(found)) >> 2
    flat = np.frombuffer(b"".join(found), np.uint32)
    start = np.cumsum(sizes, dtype=np.int64) - sizes
    code = coded.indices.to_numpy(zero_copy_only=False)
    size = sizes[code]
    ends = np.cumsum(size, dtype=np.int64)
    take = np.repeat(start[code] - (ends - size), size)
    take += np.arange(len(take))
    bounds = np.append(0, ends)[np.searchsorted(at, offsets)]
    return flat[take], bounds


def span_array(data: np.ndarray, at: np.ndarray) -> pa.DictionaryArray:
    spans = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data)))
    return spans.dictionary_encode()


def encode_column(column: pa.Array, bpe: TreeBPE, pattern: regex.Pattern, memory: Memory) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each slice of texts: ids of all texts, and the places where texts begin."""

    def encode(spans: list[str]) -> list[bytes]:
        out = []
        for span in spans:
            pieces = pattern.findall(span)
            if len(pieces) == 1:
                out.append(array("I", bpe.encode_piece(span)).tobytes())
            else:
                out.append(b"".join([memory.get(p) or array("I", bpe.encode_piece(p)).tobytes() for p in pieces]))
        return out

    for _, _, data, offsets in slices(column):
        at = cuts(data, offsets)
        coded = span_array(data, at)
        yield gather(coded, memory.all(coded.dictionary.to_pylist(), encode), at, offsets)


def encode_documents(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids.

    Null and empty texts give no ids and the hashes of nothing.  Texts of any length are encoded
    whole.  Rows stay as many as they are, repeated ones too; other columns are not read.
    """

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, pattern, memory = load(ranks), split_pattern(), _MEMORY.setdefault(ranks, Memory())
        for batch in batches:
            counts, shas, decoded, lists = [], [], [], []
            for ids, bounds in encode_column(batch.column(1), bpe, pattern, memory):
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    own = ids[a:b]
                    counts.append(b - a)
                    shas.append(hashlib.sha256(own.astype("<u4", copy=False)).hexdigest())
                    decoded.append(hashlib.sha256(bpe.decode(own.tolist())).hexdigest())
                    if with_ids:
                        lists.append(own.astype(np.int64))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(decoded, pa.string())]
            if with_ids:
                columns.append(pa.array(lists, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    kind = dict(docs.select(id_col).dtypes)[id_col]
    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>" * with_ids
    return docs.select(id_col, text_col).mapInArrow(run, schema)


#: Of this Python worker, by rank file.
_MEMORY: dict[str, Memory] = {}
