"""Embedding near-duplicates by spherical-cap filters.

Directions form random product codes: after each of `turns` random rotations the dimensions fall into two
blocks with `codes` random unit vectors each, and a filter is a pair of them.  A vector is list-decoded to every
filter in whose cap it lies; caps are so high that a random direction lies in `share` of a turn's.  Codes of
one block that cannot reach the cap with the best of the other are left out, the rest are combined.  Vectors meet on filters and label and are
verified by cosine in double precision.  A pair that shares several filters counts in the least.

A filter holds about `share` of the vectors of its label.  So labels have levels by their size: at each level a block has twice the
codes, a cap a quarter of the share, and there are two turns more, which keeps the recall; a filter then holds some FILL vectors, however large the
label.  A level is left out where its caps would be narrower than near-duplicates are apart, as in few dimensions.
Equal vectors are one vector with a weight, and a large filter is cut into parts by hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtframes.llm.common import connected_components, materialise, tidy, union_find

TURNS, CODES = 10, 128
SHARE = 2.5e-4
PART = 1024
BIN = 20_000
#: Vectors that a filter holds on average, at most, by levels of its label; and the height up to which levels go.
FILL, HIGHEST = 256, 0.7


@lru_cache(maxsize=64)
def product_code(dim: int, codes: int, share: float, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """A rotation, the codes of both blocks (of length sqrt(1/2)) and the height of the caps."""
    rng = np.random.default_rng(seed)
    turn, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
    half = max(1, dim // 2)
    blocks = []
    for size in (half, dim - half):
        c = rng.standard_normal((codes, size))
        blocks.append(c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-30) * np.sqrt(0.5))
    if codes > CODES:
        return turn, *blocks, cap_height(dim, share)
    probe = _unit(rng.standard_normal((128, dim)))
    sums = (probe[:, :half] @ blocks[0].T)[:, :, None] + (probe[:, half:] @ blocks[1].T)[:, None, :]
    least = float(np.quantile(sums, 1 - share, method="lower"))
    return turn, *blocks, least


@lru_cache(maxsize=256)
def cap_height(dim: int, share: float) -> float:
    """Height of the cap that a random direction lies in with probability share: the density of angles is sin ** (dim - 2)."""
    angle = np.geomspace(1e-4, np.pi, 200_000)
    density = np.exp(max(0, dim - 2) * np.log(np.maximum(np.sin(angle), 1e-300)))
    area = np.append(0, np.cumsum((density[1:] + density[:-1]) * np.diff(angle)))
    return float(np.cos(np.interp(share, area / area[-1], angle)))


def level_of(size: int, dim: int, share: float = SHARE, fill: int = FILL) -> int:
    """The least level at which a filter of a label of so many vectors holds `fill` of them, as far as heights allow."""
    level = 0
    while size * share / 4**level > fill and cap_height(dim, share / 4 ** (level + 1)) <= HIGHEST:
        level += 1
    return level


def list_decode(vectors: np.ndarray, turns: int = TURNS, codes: int = CODES, share: float = SHARE, seed: int = 7) -> list[np.ndarray]:
    """Sorted filters of each unit vector: in each turn all pairs of codes with summed product of at least the cap."""
    out: list[list[np.ndarray]] = [[] for _ in vectors]
    for t in range(turns):
        turn, first, second, least = product_code(vectors.shape[1], codes, share, seed + t)
        half = first.shape[1]
        turned = vectors @ turn
        a, b = turned[:, :half] @ first.T, turned[:, half:] @ second.T
        for row, x, y in zip(out, a, b):
            i = np.flatnonzero(x + y.max() >= least)
            j = np.flatnonzero(y + x.max() >= least)
            p, q = np.nonzero(x[i, None] + y[None, j] >= least)
            row.append((t * codes + i[p]) * codes + j[q])
    return [np.concatenate(row) for row in out]


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one.  They are scaled first, so that squares of very large or small components are finite."""
    vectors = vectors / np.maximum(np.abs(vectors).max(axis=1, keepdims=True), 5e-324)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _compare(vectors: np.ndarray, filters: np.ndarray, here: int, side: np.ndarray, weight: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Link counts and a spanning forest of two parts of one filter; a pair counts only in its least filter."""
    unit = _unit(np.stack(vectors).astype(np.float64))
    left = np.flatnonzero(side <= 1)  # 0: one part against itself
    right = np.flatnonzero(side != 1)
    close = unit[left] @ unit[right].T >= threshold
    close &= left[:, None] != right[None, :]
    i, j = np.nonzero(close)
    if not len(i):
        return None
    root = union_find(len(unit), left[i], right[j])
    lower = [x[x < here] for x in filters]
    at, name = np.repeat(np.arange(len(lower)), list(map(len, lower))), np.concatenate(lower)
    _, code, times = np.unique(name, return_inverse=True, return_counts=True)
    shared = times[code] > 1
    if shared.any():
        kept, code = np.unique(code[shared], return_inverse=True)
        member = np.zeros((len(lower), len(kept)), np.float32)
        member[at[shared], code] = 1
        close &= ~(member[left] @ member[right].T > 0)
    links = np.zeros(len(unit), np.int64)
    links[left] += close @ weight[right]
    if (side == 1).any():
        links[right] += weight[left] @ close
    return links, root


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", turns: int = TURNS, codes: int = CODES, share: float = SHARE, fill: int = FILL, seed: int = 7) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Only vectors of the same non-null label are compared.  Vectors that are null, empty, zero or hold null
    or non-finite components link with nothing.  Equal vectors link.  An empty table gives no rows.  A row whose id is null
    links with nothing, and its component and kept are null.
    """
    vectors = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label"))
    sound = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & F.expr("forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('inf'))") & F.expr("exists(vector, x -> x <> 0)")
    marked = vectors.select("id", F.when(sound, F.struct("label", "vector")).alias("content"))
    # the content's hash only deals rows; groups are formed on the content itself
    nodes = marked.filter("content is not null").groupBy("content").agg(F.min("id").alias("node"), F.count("*").alias("weight"))
    nodes = materialise(nodes.select("node", "weight", "content.label", "content.vector"), "nodes")

    @tidy
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            sizes = column.value_lengths().to_numpy()
            of_label = batch.column(2).to_numpy(zero_copy_only=False)
            flat, ends = column.flatten().to_numpy().astype(np.float64), np.cumsum(sizes)
            found: list = [None] * len(sizes)
            kinds = [(dim, level_of(int(n), int(dim), share, fill)) for dim, n in zip(sizes, of_label)]
            for dim, level in sorted(set(kinds)):
                rows = [r for r, kind in enumerate(kinds) if kind == (dim, level)]
                own = _unit(np.stack([flat[ends[r] - dim : ends[r]] for r in rows]))
                for at in range(0, len(rows), 2048):
                    got = list_decode(own[at : at + 2048], turns + 2 * level, codes << level, share / 4**level, seed)
                    for r, f in zip(rows[at : at + 2048], got):
                        found[r] = f
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["node", "filters"])

    # vectors of each label and dimension: a row for each
    of_label = materialise(nodes.groupBy("label", F.size("vector").alias("dim")).agg(F.count("*").alias("n")), "labels")
    sized = nodes.withColumn("dim", F.size("vector")).join(of_label, ["label", "dim"])
    coded = sized.select("node", "vector", "n").mapInArrow(decode, "node long, filters array<bigint>").join(nodes, "node")
    coded = materialise(coded.withColumn("dim", F.size("vector")), "filters")
    rows = coded.select("node", F.explode("filters").alias("filter"), "label", "dim")
    sizes = rows.groupBy("filter", "label", "dim").agg(F.count("*").alias("n")).filter("n > 1").select("filter", "label", "dim", "n", F.ceil(F.col("n") / PART).cast("int").alias("parts"))
    sizes = materialise(sizes, "sizes")
    rows = rows.join(sizes.drop("n"), ["filter", "label", "dim"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    # a part meets itself and every other part of its filter
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    rows = rows.select("node", "filter", "label", "dim", "part", other).select(
        "node", "filter", "label", "dim",
        F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
        F.expr("case when part = other then 0 when part < other then 1 else 2 end").alias("side"),
    )
    # tiles are small, so tasks take bins of them; the number of bins follows the number of rows
    bins = max(1, (sizes.agg(F.sum(F.col("n") * F.col("parts"))).first()[0] or 0) // BIN)
    tile = ["filter", "label", "dim", "i", "j"]
    rows = rows.withColumn("bin", F.pmod(F.xxhash64(*tile), F.lit(bins)))
    tiles = rows.join(coded.select("node", "weight", "vector", "filters"), "node")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([*tile, "node"], kind="stable", ignore_index=True)
        new = (pdf[tile] != pdf[tile].shift()).any(axis=1).to_numpy()
        edges = np.append(np.flatnonzero(new), len(pdf))
        node, weight, side, here = (pdf[c].to_numpy() for c in ("node", "weight", "side", "filter"))
        vector, filters = pdf["vector"].to_numpy(), pdf["filters"].to_numpy()
        out = []
        for a, b in zip(edges[:-1], edges[1:]):
            got = _compare(vector[a:b], filters[a:b], int(here[a]), side[a:b], weight[a:b], threshold)
            if got is not None:
                links, root = got
                keep = (links > 0) | (root != np.arange(b - a))
                out.append((node[a:b][keep], links[keep], node[a:b][root[keep]]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pd.DataFrame(dict(zip(["node", "n", "root"], columns)))

    found = tiles.groupBy("bin").applyInPandas(run, "node long, n long, root long")
    found = materialise(found, "links")
    linked = connected_components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    groups = (
        nodes.select("node", "label", "vector", "weight")
        .join(counts, "node", "left")
        .join(linked, "node", "left")
        .select("label", "vector", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    )
    # stored, so that many copies of one vector are split as a skewed part of a plain join
    groups = materialise(groups.select(F.struct("label", "vector").alias("content"), "n_links", "component_id"), "groups")
    return marked.join(groups, "content", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").cast("long").alias("component_id"),
        (F.col("id") == F.coalesce("component_id", "id")).alias("kept"),
    )
