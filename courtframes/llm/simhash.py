"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are deduplicated first, so copies cost nothing.  Distinct fingerprints are dealt into
tiles by the population counts of their four 16-bit quarters; two fingerprints within the radius have
counts that differ by no more than the radius in sum, so other pairs of tiles are skipped.  Large tiles
are cut by hash.  Each pair of tiles is compared whole by numpy exclusive-or and bit counts, and
gives a spanning forest of its links, so a tile of near copies gives rows in proportion to its size.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtframes.llm.common import connected_components, materialise, slices, tidy, union_find, words_of

SEED = 42
TILE = 4096
BLOCK = 1 << 21


def shingle_spans(data: np.ndarray, offsets: np.ndarray, n: int = 3) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Lowered words joined by single spaces, and where each shingle begins and ends in it.

    Also the first shingle of each text.  A text of fewer words has one shingle, all its words.
    """
    words = words_of(data, offsets)
    count = len(words.offsets) - 1
    size = np.diff(words.offsets)
    joined = np.full(len(words.data) + count, 0x20, np.uint8)
    shift = np.repeat(np.arange(count), size)
    joined[np.arange(len(words.data)) + shift] = words.data
    begin = words.offsets[:-1] + np.arange(count)
    end = begin + size
    per = np.diff(words.per_text)
    shingles = np.where(per == 0, 0, np.maximum(per - n + 1, 1))
    first = np.append(0, np.cumsum(shingles))
    word = np.repeat(words.per_text[:-1] - first[:-1], shingles) + np.arange(first[-1])
    last = np.minimum(word + n - 1, np.repeat(words.per_text[1:] - 1, shingles))
    return joined.tobytes(), begin[word], end[last], first


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Signed 64-bit fingerprint of each text of a slice; zero without words."""
    joined, begin, end, first = shingle_spans(data, offsets)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(begin.tolist(), end.tolist())], np.uint64)
    counts = np.diff(first)
    out = np.zeros(len(counts), np.uint64)
    row, step = 0, 1 << 17
    while row < len(counts):
        stop = max(row + 1, int(np.searchsorted(first, first[row] + step, "right")) - 1)
        total = np.zeros((stop - row, 64), np.int64)
        for at in range(int(first[row]), int(first[stop]), step):
            until = min(at + step, int(first[stop]))
            bits = np.unpackbits(hashes[at:until].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            rows = np.flatnonzero((first[row + 1 : stop + 1] > at) & (first[row:stop] < until) & (counts[row:stop] > 0))
            total[rows] += np.add.reduceat(bits, np.maximum(first[row:stop][rows] - at, 0), axis=0, dtype=np.int64)
        over = total * 2 > counts[row:stop, None]
        out[row:stop] = (over.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        row = stop
    return out.view(np.int64)


def with_fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): 64-bit fingerprint of lowered 3-word shingles; null and wordless texts have 0."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprints(data, offsets) for _, _, data, offsets in slices(batch.column(1))]
            fp = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], names=[id_col, "fp"])

    kind = dict(docs.select(id_col).dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, fp long")


def links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """(u, v) links that connect the given distinct fp within the radius: a forest per pair of tiles."""
    quarter = [F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(0xFFFF)).cast("int") for i in range(4)]
    place = lambda q: q[0] + 32 * q[1] + 1024 * q[2] + 32768 * q[3]
    tiles = distinct.select("fp", place(quarter).alias("place"))
    # at most 17^4 places, whatever the number of rows
    sizes = tiles.groupBy("place").agg(F.ceil(F.count("*") / TILE).cast("int").alias("parts"))
    tiles = (
        tiles.join(F.broadcast(sizes), "place")
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        .groupBy("place", "part")
        .agg(F.collect_list("fp").alias("fps"))
    )
    tiles = materialise(tiles, "tiles")
    steps = [s for s in itertools.product(range(-radius, radius + 1), repeat=4) if sum(map(abs, s)) <= radius and place(s) >= 0]
    index = tiles.select("place", "part")
    near = index.select(F.col("place").alias("p"), F.col("part").alias("i"), F.explode(F.array(*[F.lit(place(s)) for s in steps])).alias("step"))
    near = near.join(index.select(F.col("place").alias("q"), F.col("part").alias("j")), F.col("p") + F.col("step") == F.col("q"))
    near = near.filter("p < q or i <= j").select("p", "i", "q", "j")
    a = tiles.select(F.col("place").alias("p"), F.col("part").alias("i"), F.col("fps").alias("a"))
    b = tiles.select(F.col("place").alias("q"), F.col("part").alias("j"), F.col("fps").alias("b"))
    pairs = near.join(a, ["p", "i"]).join(b, ["q", "j"]).select((F.expr("p = q and i = j")).alias("same"), "a", "b")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(k).flatten().to_numpy() for k in (1, 2))
            xo, yo = (np.append(0, np.cumsum(batch.column(k).value_lengths().to_numpy())) for k in (1, 2))
            us, vs = [], []
            for k, same in enumerate(batch.column(0).to_pylist()):
                u, v = _forest(x[xo[k] : xo[k + 1]], y[yo[k] : yo[k + 1]], same, radius)
                us.append(u)
                vs.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in (us, vs)], names=["u", "v"])

    return pairs.mapInArrow(run, "u long, v long")


def _forest(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles, block by block of the exclusive-or matrix."""
    both = a if same else np.concatenate([a, b])
    label = np.arange(len(both))
    shift = 0 if same else len(a)
    step = max(1, BLOCK // max(1, len(b)))
    for at in range(0, len(a), step):
        close = np.bitwise_count(a[at : at + step, None] ^ b[None, :]) <= radius
        i, j = np.nonzero(close)
        i, j = label[i + at], label[j + shift]
        keep = i != j
        if keep.any():
            label = union_find(len(both), i[keep], j[keep])[label]
    own = np.flatnonzero(label != np.arange(len(both)))
    return both[own], both[label[own]]


def components(docs: DataFrame, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id (smallest id reachable).

    Null, empty and wordless texts share fingerprint zero and link like any other.  Repeated rows stay
    and share a component.  An empty table gives no rows.  Other columns are not read.
    """
    marked = materialise(with_fingerprint(docs, id_col, text_col), "fingerprints")
    groups = materialise(marked.groupBy("fp").agg(F.min(id_col).alias("low")), "groups")
    linked = connected_components(links(groups.select("fp"), radius))
    groups = groups.join(linked, groups["fp"] == linked["node"], "left").select("fp", "low", F.coalesce("component", "fp").alias("component"))
    # both are stored, so that a large component and a frequent fingerprint are split as skewed parts of plain joins
    groups = materialise(groups, "groups")
    lowest = materialise(groups.groupBy("component").agg(F.min("low").alias("component_id")), "lowest")
    names = materialise(groups.join(lowest, "component").select("fp", "component_id"), "names")
    return marked.join(names, "fp").select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
