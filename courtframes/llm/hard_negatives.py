"""Hard negatives by Fagin's threshold algorithm over integer vectors.

Rows fall into blocks by a hash of their id, anchors into batches, and each batch meets each block.  In a block every dimension has a
list of its rows sorted by that component.  An anchor reads the lists from the end that its own sign favours, all to
one depth; each row that comes up is scored whole, by the integer inner product.  No row that has not come up can exceed
the threshold, the product of the anchor with the components last read.  So reading ends once the threshold
lies strictly below the kth score found, where ties cannot matter any more either.

Positives are found first, over lists of the anchor's label.  Each positive then opens a window of scores, and reading for
negatives ends once the threshold lies strictly below the kth score of each window, or below the whole window.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtframes.llm.common import materialise

#: Rows of a block and anchors of a batch; no result depends on them.
BLOCK, BATCH = 4096, 2048
POSITIVES, NEGATIVES = 5, 3
#: A negative scores between these percentages of its positive.
LOW, HIGH = 50, 95
#: Sorted access begins with so many rows of each list, and goes on to so many times as many.
DEPTH, STEP = 16, 4


class Lists:
    """The sorted lists of a block: for each dimension the sorted components, and each row's place among them.  Ids ascend."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.vectors, self.ids = vectors, ids
        order = np.argsort(vectors.T, axis=1, kind="stable")
        self.sorted = np.take_along_axis(vectors.T, order, axis=1)
        self.place = np.empty(order.shape, np.int32)
        np.put_along_axis(self.place, order, np.arange(len(ids), dtype=np.int32)[None, :], axis=1)

    def read(self, anchor: np.ndarray, enough: Callable[[np.ndarray, np.ndarray, float], bool]) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of all rows that came up until enough(rows, scores, threshold) held."""
        n = len(self.ids)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        if not len(up) + len(down):  # all scores are zero, and no list tells rows apart
            return np.arange(n), np.zeros(n)
        # the depth at which a row first comes up: lists are read from their end where the anchor is positive
        depth = np.minimum(n - 1 - self.place[up].max(axis=0, initial=-1), self.place[down].min(axis=0, initial=n))
        rows, scores, whole = np.zeros(0, np.int64), np.zeros(0, self.vectors.dtype), None
        begin, end = 0, min(DEPTH, n)
        while True:
            new = np.flatnonzero((depth >= begin) & (depth < end))
            # many rows at once are scored by one product with the block, few by their own
            if whole is None and 4 * len(new) > n:
                whole = self.vectors @ anchor
            rows = np.append(rows, new)
            scores = np.append(scores, self.vectors[new] @ anchor if whole is None else whole[new])
            threshold = self.sorted[up, n - end] @ anchor[up] + self.sorted[down, end - 1] @ anchor[down]
            if len(rows) == n or enough(rows, scores, threshold):
                return rows, scores
            begin, end = end, min(STEP * end, n)


def _first(rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by row."""
    at = np.flatnonzero(scores >= least) if (least := _kth(scores, k)) is not None else np.arange(len(scores))
    return at[np.lexsort((rows[at], -scores[at]))[:k]]


def _kth(scores: np.ndarray, k: int):
    return np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else None


def _matrix(*frames: pd.DataFrame) -> list[np.ndarray]:
    """Vectors of both sides as floats of a width in which all their products are exact, else as Python integers."""
    both = [np.stack(f["vector"].to_numpy()).astype(np.float64) for f in frames]
    most = [float(np.abs(m).max(initial=0)) for m in both]
    bound = most[0] * most[1] * max(1, both[0].shape[1])
    if bound < 2.0**53:
        return [m.astype(np.float32) for m in both] if bound < 2.0**24 else both
    return [np.array([[int(v) for v in row] for row in m], object).reshape(m.shape) for m in both]


def _long(scores: np.ndarray) -> list[int]:
    return [max(-(1 << 63), min((1 << 63) - 1, int(s))) for s in scores]


def positives_of(anchors: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The first k rows of each anchor's label in a block, without the anchor itself."""
    out = []
    if len(anchors) and len(rows):
        rows = rows.sort_values("id", ignore_index=True)
        ours, theirs = _matrix(anchors, rows)
        own = rows["label"].to_numpy()
        for label, group in anchors.reset_index(drop=True).groupby("label").groups.items():
            at = np.flatnonzero(own == label)
            if not len(at):
                continue
            lists = Lists(theirs[at], rows["id"].to_numpy()[at])
            for i in group:
                me = anchors["id"].iloc[i]

                def enough(found, scores, threshold):
                    least = _kth(scores[lists.ids[found] != me], k)
                    return least is not None and threshold < least

                found, scores = lists.read(ours[i], enough)
                other = lists.ids[found] != me
                found, scores = found[other], scores[other]
                first = _first(found, scores, k)
                out += [(me, p, s) for p, s in zip(lists.ids[found[first]], _long(scores[first]))]
    return pd.DataFrame(out, columns=["anchor_id", "positive_id", "score"])


def negatives_of(anchors: pd.DataFrame, rows: pd.DataFrame, k: int, low: int, high: int) -> pd.DataFrame:
    """The first k rows of other labels in each window of each anchor, in a block."""
    out = []
    if len(anchors) and len(rows):
        rows = rows.sort_values("id", ignore_index=True)
        ours, theirs = _matrix(anchors, rows)
        lists, labels = Lists(theirs, rows["id"].to_numpy()), rows["label"].to_numpy()
        for i, (me, label, positives) in enumerate(zip(anchors["id"], anchors["label"], anchors["positives"])):
            # a score s is in a window if low * p <= 100 * s <= high * p
            windows = [(p["positive_id"], p["score"], -(-low * p["score"] // 100), high * p["score"] // 100) for p in positives]
            windows = [w for w in windows if w[2] <= w[3]]
            if not windows:
                continue
            others = labels != label

            def enough(found, scores, threshold):
                open_ = [w for w in windows if threshold >= w[2]]
                if any(threshold >= w[3] for w in open_):  # no score of the window is above the threshold
                    return False
                scores = scores[others[found]]
                for _, _, least, most in open_:
                    kth = _kth(scores[(scores >= least) & (scores <= most)], k)
                    if kth is None or threshold >= kth:
                        return False
                return True

            found, scores = lists.read(ours[i], enough)
            other = others[found]
            found, scores = found[other], scores[other]
            for positive, score, least, most in windows:
                inside = np.flatnonzero((scores >= least) & (scores <= most))
                first = inside[_first(found[inside], scores[inside], k)]
                out += [(me, positive, score, n, s) for n, s in zip(lists.ids[found[first]], _long(scores[first]))]
    return pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])


def _meet(anchors: DataFrame, rows: DataFrame, batches: int, blocks: int, run: Callable, schema: str) -> DataFrame:
    """run(anchors, rows) of each batch of anchors with each block of rows, of one dimension."""
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    by = ["dim", "batch", "block"]
    left = anchors.withColumn("batch", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(batches)).cast("int")).withColumn("block", each(blocks))
    right = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("batch", each(batches))
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(run, schema)


def hard_negatives(vectors: DataFrame, anchor: Column | str, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """For each anchor and each of its first positives, the first negatives in the positive's window:
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    anchor is a condition on the columns of vectors.  Components become floor(scale * x), and scores are exact integers, at the
    ends of a long where they exceed it; higher ones come first, then smaller ids.  Rows whose id, label or vector is null, or whose vector has
    a null or non-finite component, take no part.  An id names a row: of several, that of the least label and vector
    takes part, so repeated rows count once.  Only vectors of one length are compared, zero and empty ones with a score of zero.
    Anchors without positives or negatives give no rows, and an empty table gives none.
    """
    v = F.col(vector_col)
    sound = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # floors beyond a long are at its ends
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    rows = vectors.filter(sound).select(F.col(id_col).cast("long").alias("id"), F.struct(F.col(label_col).cast("long").alias("label"), whole.alias("vector"), F.expr(anchor).alias("anchor") if isinstance(anchor, str) else anchor.alias("anchor")).alias("row"))
    rows = rows.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.*").withColumn("dim", F.size("vector"))
    rows = materialise(rows, "vectors")
    n, n_anchors = rows.agg(F.count("*"), F.count_if("anchor")).first()
    blocks, batches = max(1, -(-n // BLOCK)), max(1, -(-n_anchors // BATCH))
    anchors, rows = rows.filter("anchor").drop("anchor"), rows.drop("anchor")

    best = _meet(anchors, rows, batches, blocks, lambda a, b: positives_of(a, b, positives), "anchor_id long, positive_id long, score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id")
    best = best.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= positives)
    best = best.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "score")).alias("positives"))
    anchors = materialise(anchors.join(best.withColumnRenamed("anchor_id", "id"), "id"), "anchors")

    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = _meet(anchors, rows, batches, blocks, lambda a, b: negatives_of(a, b, negatives, low, high), schema)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def oracle() -> str:
    """DuckDB SQL of the registered query over embeddings."""
    return """
    with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                      list_transform(embedding, lambda x: floor(256 * cast(x as double))) as x
               from embeddings
               where label is not null and embedding is not null
                 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
    s as (select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, cast(list_inner_product(a.x, b.x) as bigint) as score
          from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
    p as (select anchor_id, id as positive_id, score as positive_score from s where same
          qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
    select p.anchor_id, p.positive_id, cast(row_number() over w as integer) as rank, s.id as negative_id, p.positive_score, s.score as negative_score
    from p join s on s.anchor_id = p.anchor_id and not s.same and 50 * p.positive_score <= 100 * s.score and 100 * s.score <= 95 * p.positive_score
    window w as (partition by p.anchor_id, p.positive_id order by s.score desc, s.id)
    qualify row_number() over w <= 3"""
