"""Relational and time-series kernels, generic over column names.

All are lazy DataFrame expressions.  `keys` deal rows, `order` puts the rows of a key in order; ties in
order are the caller's to break.  Window kernels shuffle once by their keys; kernels over the same keys
reuse that partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def over(keys: list[str], order: list[str | Column]):
    return Window.partitionBy(*keys).orderBy(*order)


#: Rows that one task sorts, about; the number of tasks up to which a shuffle is written without a sort of the rows behind it
#: (Spark's own bypass, 200 unless set), as a sort of more rows than fit spills nearly all of them; rows of a task where the bypass would be lost.
TASK_ROWS = 1_000_000
UNSORTED_TASKS = 200
MOST_ROWS = 4 * TASK_ROWS


def dealt(df: DataFrame, keys: list[str], of: DataFrame | None = None, rows: int = TASK_ROWS) -> DataFrame:
    """df dealt by keys over as many tasks as the rows of `of` (df itself) ask for, so that a task's sort does not grow with the table.

    The rows are counted, which a stored table answers from its footers; give as `of` a table that df is a part of.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, tasks_of((df if of is None else of).count(), rows)), *keys)


def tasks_of(n: int, rows: int = TASK_ROWS) -> int:
    """Tasks for n rows: one for each `rows`, but no more than a shuffle without a sort can have while they hold four times as many at most."""
    return max(min(-(-n // rows), UNSORTED_TASKS), -(-n // (rows * MOST_ROWS // TASK_ROWS)))


def segment(df: DataFrame, keys: list[str], order: list[str], starts: Column, name: str = "segment_id") -> DataFrame:
    """Number of the stretch each row is in; a row where `starts` is true begins a new one, from zero."""
    count = F.sum(F.coalesce(starts, F.lit(False)).cast("int")).over(over(keys, order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn(name, (count - 1).cast("long"))


def mark_runs(df: DataFrame, keys: list[str], order: list[str], values: list[str], name: str = "run_id") -> DataFrame:
    """Number of the run of equal values (nulls are equal) each row is in, from one."""
    w = over(keys, order)
    first = F.row_number().over(w) == 1
    changed = first
    for v in values:
        changed = changed | ~F.lag(v).over(w).eqNullSafe(F.col(v))
    return df.withColumn(name, F.sum(changed.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))


def runs(df: DataFrame, keys: list[str], order: str, values: list[str], *more: Column) -> DataFrame:
    """One row per run: keys, run_id, values, t_start, t_end, n and any further aggregates."""
    marked = mark_runs(df, keys, [order], values)
    return marked.groupBy(*keys, "run_id").agg(
        *[F.first(v).alias(v) for v in values], F.min(order).alias("t_start"), F.max(order).alias("t_end"), F.count("*").alias("n"), *more
    )


def sticky(run_table: DataFrame, keys: list[str], value: str, min_len: int, none: int = -1, name: str = "state") -> DataFrame:
    """Value held over runs: a run is taken when long enough, or when it is a short holding run right
    before a long run without holder; else the last taken value goes on.  Before any, `none`."""
    w = over(keys, ["run_id"])
    holds = F.col(value) != none
    loose_next = (F.lead(value).over(w) == none) & (F.lead("n").over(w) >= min_len)
    taken = (F.col("n") >= min_len) | (holds & F.coalesce(loose_next, F.lit(False)))
    last = F.last(F.when(taken, F.col(value)), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return run_table.withColumn(name, F.coalesce(last, F.lit(none)))


def hysteresis(run_table: DataFrame, keys: list[str], value: str, min_len: int, switch_len: int, loose_after: bool = False, none: int = -1, name: str = "control") -> DataFrame:
    """Two-state control: the value changes at a run that is long (`switch_len`) or follows a long loose
    run; before the first, a run of `min_len` suffices.  Runs without a value keep the state."""
    w = over(keys, ["run_id"])
    some = F.col(value) != none
    loose = lambda f: F.coalesce((f(value).over(w) == none) & (f("n").over(w) >= min_len), F.lit(False))
    strong = some & ((F.col("n") >= switch_len) | loose(F.lag))
    if loose_after:
        strong = strong | (some & loose(F.lead))
    able = strong | (some & (F.col("n") >= min_len))
    ran = w.rowsBetween(Window.unboundedPreceding, 0)
    marked = run_table.withColumn("__able", able).withColumn("__nth", F.sum(able.cast("int")).over(ran))
    taken = strong | (F.col("__able") & (F.col("__nth") == 1))
    last = F.last(F.when(taken, F.col(value)), ignorenulls=True).over(ran)
    return marked.withColumn(name, F.coalesce(last, F.lit(none))).drop("__able", "__nth")


def merge_runs(run_table: DataFrame, keys: list[str], value: str, min_span: int) -> DataFrame:
    """Runs where those spanning less than min_span join the run before, and equal neighbours unite."""
    w = over(keys, ["run_id"])
    stands = (F.row_number().over(w) == 1) | (F.col("t_end") - F.col("t_start") >= min_span)
    kept = run_table.withColumn("__stands", stands)
    before = F.last(F.when(F.col("__stands"), F.col(value)), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.col("__stands") & ~before.eqNullSafe(F.col(value)) | (F.row_number().over(w) == 1)
    group = F.sum(opens.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")
    marked = kept.withColumn("merged_id", group)
    return marked.groupBy(*keys, "merged_id").agg(F.min_by(value, "run_id").alias(value), F.min("t_start").alias("t_start"), F.max("t_end").alias("t_end"), F.sum("n").alias("n"))


def smooth(df: DataFrame, keys: list[str], order: list[str], value: str, frames: int, min_samples: int = 1, keep_null: bool = False, name: str | None = None) -> DataFrame:
    """Centred moving average over `frames` rows with at least min_samples values."""
    w = over(keys, order).rowsBetween(-(frames // 2), frames - 1 - frames // 2)
    mean = F.when(F.count(value).over(w) >= min_samples, F.avg(value).over(w))
    if keep_null:
        mean = F.when(F.col(value).isNotNull(), mean)
    return df.withColumn(name or f"{value}_smooth", mean)


def central_speed(df: DataFrame, keys: list[str], time: str, x: str, y: str, max_step: int, name: str = "speed") -> DataFrame:
    """Distance over time between both neighbours, per second of a millisecond axis; null beside holes."""
    w = over(keys, [time])
    there, back = (lambda c: F.lead(c).over(w)), (lambda c: F.lag(c).over(w))
    near = (there(time) - F.col(time) <= max_step) & (F.col(time) - back(time) <= max_step)
    way = F.hypot(there(x) - back(x), there(y) - back(y))
    return df.withColumn(name, F.when(near, way / ((there(time) - back(time)) / 1000)))


def asof(left: DataFrame, right: DataFrame, keys: list[str], time: str, values: list[str], forward: bool = False, tolerance: int | None = None, of: DataFrame | None = None) -> DataFrame:
    """left with the values of the latest right row at or before (forward: first at or after) its time.

    One union and one window per key, no range join; right rows of equal time must be unique by key and
    time.  right's own time comes as match_<time>; beyond the tolerance all are null.  With `of`, a table that both sides are
    about parts of, rows are dealt over tasks by its number of rows.
    """
    extra = [c for c in left.columns if c not in keys + [time]]
    side = left.select(*keys, time, F.struct(*[F.col(c) for c in extra]).alias("__left"), F.lit(None).cast(right.select(F.struct(time, *values)).schema[0].dataType).alias("__right"), F.lit(1).alias("__side"))
    other = right.select(*keys, F.col(time), F.lit(None).cast(side.schema["__left"].dataType).alias("__left"), F.struct(time, *values).alias("__right"), F.lit(2 if forward else 0).alias("__side"))
    # forward reads the key backwards: a frame that ends at the last row would be read anew for each row
    w = over(keys, [F.desc(time), F.desc("__side")] if forward else [time, "__side"])
    found = F.last("__right", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = side.unionByName(other)
    out = (rows if of is None else dealt(rows, keys, of)).withColumn("__found", found).filter("__side = 1")
    if tolerance is not None:
        gap = F.abs(F.col("__found")[time] - F.col(time))
        out = out.withColumn("__found", F.when(gap <= tolerance, F.col("__found")))
    return out.select(*keys, time, *[F.col("__left")[c].alias(c) for c in extra], F.col("__found")[time].alias(f"match_{time}"), *[F.col("__found")[v].alias(v) for v in values])


def nearest(left: DataFrame, right: DataFrame, keys: list[str], time: str, values: list[str]) -> DataFrame:
    """left with the values of the right row nearest in time; of equally near rows the earlier."""
    back = asof(left, right, keys, time, values)
    names = [f"match_{time}", *values]
    back = back.select(*left.columns, F.struct(*names).alias("__back"))
    both = asof(back, right, keys, time, values, forward=True).withColumn("__ahead", F.struct(*names))
    t = F.col(time)
    ahead = F.col("__back")[names[0]].isNull() | (F.col("__ahead")[names[0]] - t < t - F.col("__back")[names[0]])
    pick = F.when(ahead, F.col("__ahead")).otherwise(F.col("__back"))
    return both.select(*left.columns, *[pick[n].alias(n) for n in names])


def range_join(points: DataFrame, spans: DataFrame, keys: list[str], time: str, lo: str, hi: str, bucket: int, closed: bool = True, how: str = "inner") -> DataFrame:
    """Points with the spans that hold them.  Spans are laid over buckets of time, so the join is on
    keys and bucket and no key's rows meet all its spans."""
    laid = spans.withColumn("__bucket", F.explode(F.sequence(F.floor(F.col(lo) / bucket), F.floor(F.col(hi) / bucket))))
    dealt = points.withColumn("__bucket", F.floor(F.col(time) / bucket))
    inside = (F.col(f"p.{time}") >= F.col(f"s.{lo}")) & ((F.col(f"p.{time}") <= F.col(f"s.{hi}")) if closed else (F.col(f"p.{time}") < F.col(f"s.{hi}")))
    on = inside & (F.col("p.__bucket") == F.col("s.__bucket"))
    for k in keys:
        on = on & (F.col(f"p.{k}") == F.col(f"s.{k}"))
    own = [F.col(f"p.{c}") for c in points.columns]
    other = [F.col(f"s.{c}") for c in spans.columns if c not in points.columns]
    return dealt.alias("p").join(laid.alias("s"), on, how).select(*own, *(other if how != "left_semi" and how != "left_anti" else []))


def overlaps(a: DataFrame, b: DataFrame, keys: list[str], bucket: int, a_span: tuple[str, str], b_span: tuple[str, str]) -> DataFrame:
    """Pairs of spans that overlap, with o_lo and o_hi of the common part; each pair once."""
    lay = lambda df, s: df.withColumn("__bucket", F.explode(F.sequence(F.floor(F.col(s[0]) / bucket), F.floor(F.col(s[1]) / bucket))))
    (al, ah), (bl, bh) = a_span, b_span
    on = (F.col("a.__bucket") == F.col("b.__bucket")) & (F.col(f"a.{al}") < F.col(f"b.{bh}")) & (F.col(f"a.{ah}") > F.col(f"b.{bl}"))
    # the bucket in which the common part begins names the pair
    on = on & (F.col("a.__bucket") == F.floor(F.greatest(F.col(f"a.{al}"), F.col(f"b.{bl}")) / bucket))
    for k in keys:
        on = on & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    other = [F.col(f"b.{c}") for c in b.columns if c not in a.columns]
    return lay(a, a_span).alias("a").join(lay(b, b_span).alias("b"), on).select(
        *[F.col(f"a.{c}") for c in a.columns], *other, F.greatest(F.col(f"a.{al}"), F.col(f"b.{bl}")).alias("o_lo"), F.least(F.col(f"a.{ah}"), F.col(f"b.{bh}")).alias("o_hi")
    )


def longest_overlap(a: DataFrame, b: DataFrame, keys: list[str], a_id: list[str], b_rank: str, bucket: int, a_span: tuple[str, str], b_span: tuple[str, str]) -> DataFrame:
    """For each span of a the span of b with the longest common part, of equals the first by b_rank."""
    found = overlaps(a, b, keys, bucket, a_span, b_span)
    best = F.struct((F.col("o_hi") - F.col("o_lo")).alias("overlap"), (-F.col(b_rank)).alias("__rank"))
    names = [c for c in found.columns if c not in keys + a_id]
    return found.groupBy(*keys, *a_id).agg(F.max_by(F.struct(*names), best).alias("__b")).select(*keys, *a_id, "__b.*")


def first_hold(anchors: DataFrame, run_table: DataFrame, keys: list[str], anchor: str, min_n: int, step: int) -> DataFrame:
    """Start of the first run, cut at the anchor, that lasts min_n steps of `step` at or after it.

    Runs of a key do not overlap.  Either the run that the anchor lies in is long enough behind it, or the first whole one that begins later
    holds; each is an as-of search, so no anchor meets all runs of its key.
    """
    long = run_table.filter((F.col("n") >= min_n) & (F.col("t_end") - F.col("t_start") >= (min_n - 1) * step)).select(*keys, F.col("t_start").alias(anchor), "t_end")
    own = asof(anchors.distinct(), long, keys, anchor, ["t_end"])
    here = F.col("t_end") - F.col(anchor) >= (min_n - 1) * step
    own = own.select(*anchors.columns, F.when(here, F.col(anchor)).alias("__here"))
    found = asof(own, long, keys, anchor, ["t_end"], forward=True)
    return found.select(*anchors.columns, F.coalesce("__here", f"match_{anchor}").alias("t_hold")).filter("t_hold is not null")


def last_crossing(df: DataFrame, keys: list[str], time: str, flag: str) -> DataFrame:
    """First time of the true rows that hold to the end; null when never false or false at the end."""
    last_false = F.max(F.when(~F.col(flag), F.col(time)))
    seen = df.withColumn("__false", last_false.over(Window.partitionBy(*keys)))
    return seen.groupBy(*keys).agg(F.min(F.when(F.col(time) > F.col("__false"), F.col(time))).alias("t_cross"))


def anchored_groups(df: DataFrame, keys: list[str], time: str, width: int, name: str = "group_start") -> DataFrame:
    """Start of each row's group: a group takes what comes within width of its first row.

    Not a session, which measures from the last row.  A fold over the sorted times of one key.
    """
    times = df.groupBy(*keys).agg(F.array_sort(F.collect_set(time)).alias("__ts"))
    empty = F.array().cast(f"array<{dict(df.dtypes)[time]}>")
    starts = F.aggregate("__ts", empty, lambda acc, t: F.when((F.size(acc) == 0) | (t - F.element_at(acc, -1) > width), F.concat(acc, F.array(t))).otherwise(acc))
    groups = times.select(*keys, F.explode(starts).alias(name))
    marks = groups.withColumn(time, F.col(name))
    return asof(df, marks, keys, time, [name]).drop(f"match_{time}")


def thin(df: DataFrame, keys: list[str], time: str, gap: int) -> DataFrame:
    """Rows kept greedily in order, each at least gap after the last kept one of its key."""
    times = df.groupBy(*keys).agg(F.array_sort(F.collect_set(time)).alias("__ts"))
    empty = F.array().cast(f"array<{dict(df.dtypes)[time]}>")
    kept = F.aggregate("__ts", empty, lambda acc, t: F.when((F.size(acc) == 0) | (t - F.element_at(acc, -1) >= gap), F.concat(acc, F.array(t))).otherwise(acc))
    return df.join(times.select(*keys, F.explode(kept).alias(time)), [*keys, time], "left_semi")


def minima(df: DataFrame, keys: list[str], order: list[str], value: str, half: int, prominence: float) -> DataFrame:
    """Rows at a local minimum that stands out from both sides by `prominence` within half rows."""
    w = over(keys, order)
    here = F.col(value)
    side = lambda a, b: F.max(value).over(w.rowsBetween(a, b))
    marked = df.withColumn("__low", (here <= F.lag(value).over(w)) & (here <= F.lead(value).over(w))).withColumn("prominence", F.least(side(-half, -1), side(1, half)) - here)
    return marked.filter(F.col("__low") & (F.col("prominence") >= prominence)).drop("__low")


def ordinal_pairs(a: DataFrame, b: DataFrame, keys: list[str], a_order: list[str], b_order: list[str]) -> DataFrame:
    """nth row of a with the nth row of b inside a key."""
    left = a.withColumn("nth", F.row_number().over(over(keys, a_order)))
    right = b.withColumn("nth", F.row_number().over(over(keys, b_order)))
    return left.join(right, [*keys, "nth"])


def suffix_copies(df: DataFrame, uid: str, order: list[str]) -> DataFrame:
    """uid with a number from :0 behind it where it stands more than once, on all its copies."""
    w = Window.partitionBy(uid)
    n, k = F.count("*").over(w), F.row_number().over(w.orderBy(*order)) - 1
    return df.withColumn("__uid", F.when(n > 1, F.concat_ws(":", F.col(uid), k)).otherwise(F.col(uid))).drop(uid).withColumnRenamed("__uid", uid)


def resample(samples: DataFrame, windows: DataFrame, keys: list[str], window_id: str, time: str, values: list[str], step: int) -> DataFrame:
    """Values on an even grid over each window, linear between neighbouring samples, held at the ends."""
    grid = windows.select(*keys, window_id, F.explode(F.sequence(F.col("t_start"), F.col("t_end"), F.lit(step))).alias(time))
    back = asof(grid, samples, keys, time, values)
    before = [f"match_{time}", *values]
    back = back.select(*keys, time, window_id, F.struct(*before).alias("__b"))
    both = asof(back, samples, keys, time, values, forward=True).withColumn("__a", F.struct(*before))
    bt, at = F.col("__b")[before[0]], F.col("__a")[before[0]]
    share = F.when(at > bt, (F.col(time) - bt) / (at - bt)).otherwise(0.0)
    line = lambda v: F.coalesce(F.col("__b")[v] + share * (F.col("__a")[v] - F.col("__b")[v]), F.col("__b")[v], F.col("__a")[v])
    return both.select(*keys, window_id, time, *[line(v).alias(v) for v in values])


def content_hash(df: DataFrame) -> DataFrame:
    """Row count and a hash that does not depend on row order: equal tables have equal rows here."""
    return df.select(F.xxhash64(*df.columns).cast("decimal(38,0)").alias("h")).agg(F.count("*").alias("n_rows"), F.sum("h").cast("string").alias("content_hash"))


def column_parity(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """One row per other column: rows of both tables whose values differ, null-safe, in one pass."""
    names = [c for c in a.columns if c not in keys and c in b.columns]
    both = a.alias("a").join(b.alias("b"), keys)
    counts = both.agg(*[F.count_if(~F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`"))).alias(c) for c in names])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n_different")) for c in names])).alias("r")).select("r.*")


def key_difference(a: DataFrame, b: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Every key of either table: added, dropped, kept or moved."""
    both = a.select(*keys, F.col(value).alias("__a"), F.lit(True).alias("__ina")).join(b.select(*keys, F.col(value).alias("__b"), F.lit(True).alias("__inb")), keys, "full")
    kind = F.when(F.col("__ina").isNull(), "added").when(F.col("__inb").isNull(), "dropped").when(F.col("__a").eqNullSafe(F.col("__b")), "kept").otherwise("moved")
    return both.select(*keys, kind.alias("change"))
