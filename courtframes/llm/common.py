"""Helpers shared by the text operators: shared storage, word arrays, connected components.

Text work in Python runs over Arrow batches, cut into slices of a few MB, with numpy over
the UTF-8 bytes of a slice, so memory per task does not follow the size of a partition.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 2 << 20

_WS = np.zeros(256, bool)
_WS[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Temporary folders of local sessions without a shared one, by application.
_OWN_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, or set as the checkpoint folder.

    Where neither is set, a session whose executors run in the driver's own process takes a temporary folder; a
    cluster would lose data there, so it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[\d*,]+\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN_DIRS:
            _OWN_DIRS[app] = tempfile.mkdtemp(prefix="courtframes-")
        found = _OWN_DIRS[app]
    return found


def materialise(df: DataFrame, what: str = "cut") -> DataFrame:
    """Cut the lineage: write to the shared folder as Parquet and read back with the same schema."""
    spark = df.sparkSession
    path = f"{_own_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/courtframes-{spark.sparkContext.applicationId}"


def clean_up(spark: SparkSession) -> None:
    """Delete all that this application has materialised, once no result is read any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Scratch:
    """Materialised tables that are deleted together as soon as what they were for is stored."""

    def __init__(self) -> None:
        self.tables: list[DataFrame] = []

    def __call__(self, df: DataFrame, what: str) -> DataFrame:
        self.tables.append(materialise(df, what))
        return self.tables[-1]

    def drop(self) -> None:
        for df in self.tables:
            drop_materialised(df)
        self.tables = []


def drop_materialised(df: DataFrame) -> None:
    """Delete the files of a materialised table that no later plan reads."""
    spark = df.sparkSession
    for name in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _release() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(run: Callable) -> Callable:
    """A mapInArrow function that gives free memory back when its task ends, as Python workers live on."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _release()

    return wrapped


class Words(NamedTuple):
    """Words of a slice of texts: ASCII-lowered bytes of all words without gaps between them."""

    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than words
    per_text: np.ndarray  # int64, first word of each text, one more than texts

    def strings(self) -> pa.Array:
        return pa.LargeStringArray.from_buffers(
            len(self.offsets) - 1, pa.py_buffer(self.offsets), pa.py_buffer(self.data)
        )


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about max_bytes; null texts are empty.

    A single longer text is a slice of its own and stays whole.
    """
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    if not n:
        return
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + max_bytes, "right")) - 1)
        yield row, end, data[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> Words:
    """Words are maximal runs of bytes other than space and 0x09-0x0D."""
    if lower:
        data = _LOWER[data]
    inside = ~_WS[data]
    first = np.empty(len(data), bool)
    first[:1] = True
    np.logical_not(inside[:-1], out=first[1:])
    edges = offsets[:-1]
    first[edges[edges < len(data)]] = True
    first &= inside
    starts = np.flatnonzero(first)
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=before[1:])
    word_offsets = np.append(before[starts], before[-1])
    return Words(data[inside], word_offsets, np.searchsorted(starts, offsets))


def union_find(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node of the component of each of n nodes, by rounds of hooking and pointer jumping."""
    label = np.arange(n)
    while len(a):
        x, y = label[a], label[b]
        far = x != y
        if not far.any():
            break
        a, b, x, y = a[far], b[far], x[far], y[far]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        u, v = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = union_find(len(nodes), at[: len(u)], at[len(u) :])
        own = root != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(nodes[root[own]])], names=["u", "v"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of (u, v) edges; component is the smallest node reachable.

    Alternating large-star and small-star rounds over edges that always point from the larger to the
    smaller node; the number of edges never grows.  Each round is written to the shared folder, so a
    lost executor costs one round.  Edges are first contracted batch by batch into forests.
    Null ends and loops are ignored; repeated edges are harmless; no edges give no rows.
    """
    u, v = F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")
    edges = edges.select(u, v).filter("u <> v").mapInArrow(_contract, "u long, v long")
    edges = materialise(edges.distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # stored, so that the join's sides are plain shuffles, whose skewed parts adaptive execution splits
        low = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "low")
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large, "large")
        drop_materialised(low)
        low = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .filter("u <> v")
            .distinct()
        )
        after = materialise(small, "edges")
        state = [
            df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() for df in (edges, after)
        ]
        for used in (edges, large, low):
            drop_materialised(used)
        edges = after
        if tuple(state[0]) == tuple(state[1]):
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, rows: int, allowed=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, label) of at most `rows` labelled documents, first by a hash of the id.

    `allowed` is a condition on id_col.  The picked ids are bounded by `rows`, so they are broadcast.
    Repeated labels of one id count once, with the largest; null ids and labels are left out.  Of rows with one id the
    text of the least hash counts, so a repeated id does not enlarge the sample.
    """
    picked = labels.select(F.col(id_col), F.col(label_col).cast("int").alias("label")).filter(F.col(id_col).isNotNull() & F.col("label").isNotNull())
    if allowed is not None:
        picked = picked.filter(allowed)
    picked = picked.groupBy(id_col).agg(F.max("label").alias("label")).orderBy(F.xxhash64(id_col), id_col).limit(rows)
    found = docs.select(F.col(id_col), F.col(text_col)).join(F.broadcast(picked), id_col)
    found = found.groupBy(F.col(id_col).alias("id"), "label").agg(F.min(F.struct(F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))).alias("t"))
    return found.select("id", "t.text", "label")
