"""Cost-balanced packing of tokenised documents into fixed sequences.

Each document's ids, with an end token, are cut every `capacity` ids.  A piece costs
linear * length + quadratic * length^2, an estimate of feed-forward plus attention work.  Pieces are
dealt by hash into groups of bounded size; inside a group, pieces in descending cost go to the
sequence of lowest cost that still has room, over as many sequences as the tokens need, and what
fits in none opens further sequences.  Only lengths and checksums are shuffled, never ids or text.

Texts are tokenised by distinct words: spans that no token crosses are coded as a dictionary, spans that
this worker has met are remembered, and the others go to the tokenizer together.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from courtframes.llm.bpe import Memory, gather, span_array
from courtframes.llm.common import _LOWER, _WS, materialise, slices, tidy

PIECE = "start long, length long, ids_crc32 long, doc_tokens long"
GROUP_PIECES = 2048
#: Bytes of texts whose spans are coded as one dictionary.
SLICE = 8 << 20
#: Spans that a worker remembers, in each of two generations.
SPANS = 300_000
#: Words that are given to the tokenizer as one text.
JOINED = 2000


@lru_cache(maxsize=2)
def load(path: str) -> tuple[Tokenizer, np.ndarray, dict[bytes, int]]:
    """A tokenizer of ordinary text, which of its ids end a word, and its special tokens by their bytes.

    Spans are lowered before they reach the tokenizer, so it must not take a lowered text for a special
    token; those are found in the text as it is written.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    ends = np.zeros(tokenizer.get_vocab_size(), bool)
    ends[[i for token, i in tokenizer.get_vocab(with_added_tokens=False).items() if token.endswith("</w>")]] = True
    special = {t.content.encode(): i for i, t in tokenizer.get_added_tokens_decoder().items() if t.special}
    return tokenizer, ends, special


#: 0 letter, 2 ASCII sign other than an apostrophe, 3 anything else.  Between 0 and 2 no contraction begins, and
#: combining marks are in 3.
_KIND = np.full(256, 3, np.uint8)
_KIND[[*range(65, 91), *range(97, 123)]] = 0
_KIND[[i for i in range(0x21, 0x7F) if not chr(i).isalnum() and i != 0x27]] = 2
#: Letters of Latin-1 are as ASCII ones: byte 0xC3 and a byte other than those of the signs for times and divided by.
_LATIN = np.zeros(256, bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False
_WORD = re.compile("[a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")


def _spans(data: np.ndarray, offsets: np.ndarray, special: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes without white space, where spans begin in them, and where texts begin in them.

    The split pattern takes letters, single digits and other visible runs apart and drops white space;
    it never joins what stands on both sides of white space, nor a letter and a full stop or comma, nor does
    normalisation.  A special token is a span in capitals, as no other span is.
    """
    raw, data = data, _LOWER[data]
    kind = _KIND[data]
    lead = np.flatnonzero(data == 0xC3)
    lead = lead[_LATIN[data[np.minimum(lead + 1, len(data) - 1)]]]
    kind[lead] = kind[lead + 1] = 0
    data[lead[data[lead + 1] < 0x9F] + 1] += 0x20  # capitals
    keep = ~_WS[data]
    first = np.zeros(len(data), bool)
    if len(data):
        np.logical_xor(kind[1:] == 0, kind[:-1] == 0, out=first[1:])
        first[1:] &= (kind[1:] != 3) & (kind[:-1] != 3)
        first[1:] |= ~keep[:-1]
        first[0] = True
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    if any(mark in (whole := raw.tobytes()) for mark in special):
        for found in re.finditer(b"|".join(map(re.escape, special)), whole):
            a, b = found.span()
            text = np.searchsorted(offsets, a, "right")
            if b > offsets[text]:  # over the end of a text
                continue
            data[a:b] = np.frombuffer(found.group().upper(), np.uint8)
            first[a + 1 : b] = False
            first[a] = True
            if b < len(data):
                first[b] = True
    first &= keep
    before = np.zeros(len(data) + 1, np.int64 if len(data) >> 31 else np.int32)
    np.cumsum(keep, out=before[1:])
    return data[keep], before[np.append(np.flatnonzero(first), len(data))].astype(np.int64), before[offsets]


def _encode(tokenizer: Tokenizer, ends: np.ndarray, special: dict[str, int], spans: list[str]) -> list[bytes]:
    """Ids of each span.  Plain words are joined by spaces into texts; each ends in the id of a word's end."""
    found: list[bytes | None] = [None] * len(spans)
    plain = [i for i, s in enumerate(spans) if len(s) <= 40 and _WORD.fullmatch(s) and s not in special]
    chunks = [plain[k : k + JOINED] for k in range(0, len(plain), JOINED)]
    for chunk, coded in zip(chunks, tokenizer.encode_batch_fast([" ".join([spans[i] for i in c]) for c in chunks], add_special_tokens=False)):
        ids = np.array(coded.ids, np.uint32)
        stop = np.flatnonzero(ends[ids]) + 1
        if len(stop) != len(chunk):
            continue  # these go one by one
        data, at = ids.tobytes(), 0
        for i, b in zip(chunk, (4 * stop).tolist()):
            found[i], at = data[at:b], b
    rest = [i for i, got in enumerate(found) if got is None]
    for i in rest:
        if spans[i] in special:
            found[i] = np.array([special[spans[i]]], np.uint32).tobytes()
    rest = [i for i in rest if found[i] is None]
    for i, coded in zip(rest, tokenizer.encode_batch_fast([spans[i] for i in rest], add_special_tokens=False)):
        found[i] = np.array(coded.ids, np.uint32).tobytes()
    return found


def tokenised(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of each document: id, start, length, ids_crc32, doc_tokens, and part, the row's number in its task.

    Null and empty texts have the end token alone.  A special token's own string in a text is that token, as
    the library takes it.  Repeated rows give pieces of their own.
    """

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, ends, special = load(vocabulary)
        memory = _MEMORY.setdefault(vocabulary, Memory(SPANS))
        capitals = {k.upper().decode(): v for k, v in special.items()}
        end, seen = np.array([end_id], np.uint32), 0
        for batch in batches:
            keys, starts, lengths, crcs, totals = [], [], [], [], []
            for row, _, data, offsets in slices(batch.column(1), SLICE):
                data, at, texts = _spans(data, offsets, special)
                coded = span_array(data, at)
                ids, bounds = gather(coded, memory.all(coded.dictionary.to_pylist(), lambda spans: _encode(tokenizer, ends, capitals, spans)), at, texts)
                for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    own, total = np.append(ids[a:b], end).astype("<u4", copy=False), b - a + 1
                    for s in range(0, total, capacity):
                        piece = own[s : s + capacity]
                        keys.append(row + i)
                        starts.append(s)
                        lengths.append(len(piece))
                        crcs.append(zlib.crc32(piece))
                        totals.append(total)
            rows = np.array(keys, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), *(pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals)), pa.array(rows + seen)], names=names)
            seen += len(batch)

    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "part"]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {dict(docs.select(id_col).dtypes)[id_col]}, {PIECE}, part long")


#: Of this Python worker, by vocabulary file.
_MEMORY: dict[str, Memory] = {}


def pack_lengths(lengths: np.ndarray, capacity: int, linear: float = 1.0, quadratic: float = 1 / 1024) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece of one group."""
    lengths = lengths.astype(np.int64)
    cost = linear * lengths + quadratic * lengths.astype(float) ** 2
    order = np.lexsort((np.arange(len(lengths)), -cost))
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    first, left = 0, order
    while len(left):
        n = max(1, -(-int(lengths[left].sum()) // capacity))
        load, room = np.zeros(n), np.full(n, capacity)
        later = []
        for i in left:
            size = lengths[i]
            fits = room >= size
            at = int(np.argmin(np.where(fits, load, np.inf)))
            if not fits[at]:
                later.append(i)
                continue
            sequence[i], offset[i] = first + at, capacity - room[at]
            room[at] -= size
            load[at] += cost[i]
        first += n
        left = np.array(later, np.int64)
    return sequence, offset


def pack(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 2, linear: float = 1.0, quadratic: float = 1 / 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    The pieces, without ids or text, are stored and counted, and dealt into groups by the hash of a document's
    id, a piece's start and the row's place in its task, so long documents and repeated rows spread over groups;
    each group leaves at most a few sequences with padding.  An empty table gives no rows.
    """
    pieces = materialise(tokenised(docs, vocabulary, capacity, end_id, id_col, text_col), "pieces")
    groups = max(1, -(-pieces.count() // GROUP_PIECES))
    pieces = pieces.withColumn("packing_group", F.pmod(F.xxhash64(F.col(id_col), F.col("start"), F.col("ids_crc32"), F.col("part")), F.lit(groups)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([id_col, "start", "ids_crc32", "part"], kind="stable", ignore_index=True)
        sequence, offset = pack_lengths(pdf["length"].to_numpy(), capacity, linear, quadratic)
        return pdf.assign(sequence_id=sequence * groups + pdf["packing_group"], offset=offset).drop(columns=["packing_group", "part"])

    kind = dict(docs.select(id_col).dtypes)[id_col]
    return pieces.groupBy("packing_group").applyInPandas(run, f"`{id_col}` {kind}, {PIECE}, sequence_id long, offset long")
