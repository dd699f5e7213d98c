"""Scale helpers for analytic windows whose natural partition key has few
groups (a symbol, a venue, a pair). Each spreads one key over segments of its
time order, so that no task holds a whole key, while giving exactly the single-partition
answer. Segments follow the data (``time_segments``): a key with a third of all rows gets a
third of the partitions, also where all its rows lie in one minute.

* ``halo_rows``: copy each row into the later buckets whose frames can reach
  it, so a range frame of ``lookback`` seconds runs per (key, bucket).
* ``bucketed_prev``: ``lag`` by key in time order, computed per (key, segment)
  with the previous segment's last row carried across the edges.
* ``bucketed_last``: as-of fill (last non-null value at or before each row).
* ``asof_fill``: the same for several sources onto given points, in one pass.
* ``max_drawdown``: largest fall of a running sum below its running peak,
  for large keys combined from per-segment summaries.
* ``distributed_percent_rank``: exact percent_rank per group via a range
  partitioned sort of distinct values (no single-partition window).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.session import scratch_path


def _seconds(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c) / F.lit(1_000_000)


def halo_rows(df: DataFrame, t_seconds: str, lookback: int, bucket: int) -> DataFrame:
    """Add ``_bucket`` and ``_home``: each row appears in its own bucket
    (``_home`` true) and in later buckets up to ``t + lookback`` (history
    only). A range frame of at most ``lookback`` seconds evaluated per
    (key, _bucket) then sees every row it would see per key."""
    b0 = F.floor(F.col(t_seconds) / F.lit(bucket)).cast("long")
    b1 = F.floor((F.col(t_seconds) + F.lit(lookback)) / F.lit(bucket)).cast("long")
    out = df.withColumn("_b0", b0).withColumn("_bucket", F.explode(F.sequence(b0, b1)))
    return out.withColumn("_home", F.col("_bucket") == F.col("_b0")).drop("_b0")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: every later reader gets the
    same rows from the same files, and a lost executor costs its tasks only."""
    path = scratch_path(df.sparkSession, "stored", name, unique=True)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def time_segments(df: DataFrame, keys, order_cols, partitions: int | None = None) -> DataFrame:
    """Add ``_tb``, the segment of a row: rows are range-partitioned by (keys, order), and the
    partition is the segment. A key gets as many segments as its share of all rows asks for,
    however its rows lie in time; segments of a key follow each other in order. The rows are
    stored, as two samplings of the ranges may differ.

    ``order_cols`` should tell the rows of a key apart (a time and an id): rows that agree in all of them stay in one segment."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *keys, *order_cols).withColumn("_tb", F.spark_partition_id().cast("long"))
    return stored(ranged, "segments")


def _segmented(df: DataFrame, keys, order_cols, ts_col: str, bucket_seconds: int | None) -> DataFrame:
    """Adaptive segments, or fixed time buckets where a width is given (for summaries that are kept), or those a row names already."""
    if "_tb" in df.columns:
        return df
    if bucket_seconds is None:
        return time_segments(df, keys, order_cols)
    return df.withColumn("_tb", F.floor(_seconds(ts_col) / F.lit(bucket_seconds)).cast("long"))


def _carried(d: DataFrame, edges: DataFrame, keys) -> DataFrame:
    """Rows with the carry of their segment. Keys may be null."""
    on = [*keys, "_tb"]
    right = edges.select(*[F.col(c).alias("_e" + c) for c in on], *[c for c in edges.columns if c not in on])
    same = [d[c].eqNullSafe(right["_e" + c]) for c in on]
    return d.join(right, same, "left").drop(*["_e" + c for c in on])


def bucketed_prev(df: DataFrame, keys, order_cols, value_cols, ts_col: str, bucket_seconds: int | None = None,
                  prefix: str = "prev_") -> DataFrame:
    """``prefix + v`` = value of the previous row of the same key in
    ``order_cols`` order (``lag(v)`` over keys). Rows are windowed per
    (key, segment); the first row of a segment takes the last row of the
    nearest earlier one, from an aggregate with one row per (segment, key)."""
    keys, order_cols, value_cols = list(keys), list(order_cols), list(value_cols)
    d = _segmented(df, keys, order_cols, ts_col, bucket_seconds)
    last = F.max(F.struct(*[F.struct(F.col(c).isNotNull(), F.col(c)).alias(f"o{i}") for i, c in enumerate(order_cols)],
                          F.struct(*value_cols).alias("v")))["v"]
    edges = d.groupBy(*keys, "_tb").agg(last.alias("_last"))
    wb = Window.partitionBy(*keys).orderBy("_tb")
    carry = edges.select(*keys, "_tb", F.lag("_last").over(wb).alias("_carry"))
    w = Window.partitionBy(*keys, "_tb").orderBy(*order_cols)
    d = d.select("*", *[F.lag(v).over(w).alias(prefix + v) for v in value_cols], (F.row_number().over(w) == 1).alias("_first"))
    j = _carried(d, carry, keys)
    for v in value_cols:
        j = j.withColumn(prefix + v, F.when(F.col("_first"), F.col("_carry")[v]).otherwise(F.col(prefix + v)))
    return j.drop("_tb", "_first", "_carry")


def bucketed_last(df: DataFrame, keys, order_cols, value_col: str, ts_col: str, bucket_seconds: int | None,
                  out_col: str) -> DataFrame:
    """``out_col`` = last non-null ``value_col`` at or before each row of the
    same key (``last(v, ignorenulls)`` over an unbounded-preceding frame),
    computed per (key, segment); rows of a segment before its first value take
    the last value of the nearest earlier segment that has one, from an
    aggregate with one row per (segment, key)."""
    keys, order_cols = list(keys), list(order_cols)
    d = _segmented(df, keys, order_cols, ts_col, bucket_seconds)
    held = F.when(F.col(value_col).isNotNull(), F.struct(
        *[F.struct(F.col(c).isNotNull(), F.col(c)).alias(f"o{i}") for i, c in enumerate(order_cols)], F.col(value_col).alias("v")))
    edges = d.groupBy(*keys, "_tb").agg(F.max(held)["v"].alias("_last"))
    wf = Window.partitionBy(*keys).orderBy("_tb").rowsBetween(Window.unboundedPreceding, -1)
    fill = edges.select(*keys, "_tb", F.last("_last", ignorenulls=True).over(wf).alias("_carry"))
    w = Window.partitionBy(*keys, "_tb").orderBy(*order_cols)
    d = d.withColumn(out_col, F.last(value_col, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = _carried(d, fill, keys)
    return out.withColumn(out_col, F.coalesce(F.col(out_col), F.col("_carry"))).drop("_tb", "_carry")


def asof_fill(points: DataFrame, t_col: str, sources: dict[str, DataFrame], keys) -> DataFrame:
    """``points`` with a column for each source: its last value at or before ``t_col`` for the same
    key, null where there is none yet. A source has the keys, ``at`` (a timestamp) and ``value``
    (double); null values are skipped, of several at one time the largest counts.

    All sources and points are laid out once by (key, time) and filled in one pass over the
    segments, so many sources cost one shuffle and no range join."""
    keys, names = list(keys), list(sources)
    rows = points.select(*keys, F.col(t_col).alias("_ts"), F.lit(1).alias("_kind"), F.lit("").alias("_of"),
                         *[F.lit(None).cast("double").alias(n) for n in names],
                         F.struct(*[c for c in points.columns if c not in keys]).alias("_point"))
    none = F.lit(None).cast(rows.schema["_point"].dataType).alias("_point")
    for name, s in sources.items():
        one = s.where(F.col("value").isNotNull()).groupBy(*keys, "at").agg(F.max(F.col("value").cast("double")).alias("_v"))
        rows = rows.unionByName(one.select(*keys, F.col("at").alias("_ts"), F.lit(0).alias("_kind"), F.lit(name).alias("_of"),
                                           *[(F.col("_v") if n == name else F.lit(None).cast("double")).alias(n) for n in names], none))
    d = time_segments(rows, keys, ["_ts", "_kind", "_of"])
    held = [F.max(F.when(F.col(n).isNotNull(), F.struct("_ts", F.col(n).alias("v"))))["v"].alias("_last_" + n) for n in names]
    before = Window.partitionBy(*keys).orderBy("_tb").rowsBetween(Window.unboundedPreceding, -1)
    edges = d.groupBy(*keys, "_tb").agg(*held).select(
        *keys, "_tb", *[F.last("_last_" + n, ignorenulls=True).over(before).alias("_carry_" + n) for n in names])
    up = Window.partitionBy(*keys, "_tb").orderBy("_ts", "_kind", "_of").rowsBetween(Window.unboundedPreceding, 0)
    d = d.select(*keys, "_tb", "_kind", "_point", *[F.last(n, ignorenulls=True).over(up).alias(n) for n in names])
    out = _carried(d.where("_kind = 1"), edges, keys)
    return out.select(*keys, "_point.*", *[F.coalesce(n, "_carry_" + n).alias(n) for n in names])


def max_drawdown(df: DataFrame, keys, order_cols, value_col: str, ts_col: str, bucket_seconds: int | None = None,
                 out_col: str = "max_drawdown", sums=(), maxima=(), sets=()) -> DataFrame:
    """Per key: max over rows of (running peak of the cumulative sum, starting
    at 0) minus the cumulative sum. Values are summed as DECIMAL so the answer
    does not depend on summation order. Rows without a value change nothing; a key without any value gets null.

    Keys are counted by hash class first. Keys of small classes run as they are, each in one window. Those of a class that
    may hold a large key are cut into segments, whose summaries (total, lowest running sum, highest running sum, internal
    drawdown) are combined in time order on the small per-segment table, so no task holds a large key.

    ``sums``, ``maxima`` and ``sets`` are (name, Column) pairs that the same aggregation totals (or
    collects, for few distinct values) for each key, so that other figures of the key need no second pass."""
    keys, order_cols = list(keys), list(order_cols)
    names = [[n for n, _ in x] for x in (sums, maxima, sets)]
    segmented = lambda d: combine_drawdown(
        drawdown_segments(d, keys, order_cols, value_col, ts_col, bucket_seconds, sums, maxima, sets), keys, out_col, *names)
    if bucket_seconds is not None:
        return segmented(df)
    key_class = F.pmod(F.xxhash64(*keys), F.lit(KEY_CLASSES))
    sizes = df.groupBy(key_class.alias("c")).agg(F.count(F.lit(1)).alias("n"))
    large = [r["c"] for r in sizes.where(F.col("n") > KEY_ROWS).collect()]  # KEY_CLASSES at most
    small = df.where(~key_class.isin(large)) if large else df
    out = drawdown_in_windows(small, keys, order_cols, value_col, out_col, sums, maxima, sets)
    return out.unionByName(segmented(df.where(key_class.isin(large)))) if large else out


def drawdown_in_windows(df: DataFrame, keys, order_cols, value_col: str, out_col: str = "max_drawdown", sums=(), maxima=(), sets=()) -> DataFrame:
    """``max_drawdown`` of keys that are small: a window for each."""
    one = _summaries(df.withColumn("_v", F.col(value_col).cast(_DEC)), list(keys), list(order_cols), sums, maxima, sets)
    zero = F.lit(0).cast(_DEC)
    return one.select(*keys, F.when(F.col("_values") > 0, F.greatest("_inner", zero - F.col("_low"), zero)).cast("double").alias(out_col),
                      *[n for x in (sums, maxima, sets) for n, _ in x])


_DEC = "decimal(38,12)"
KEY_CLASSES = 1 << 16  # hash classes of keys
KEY_ROWS = 250_000  # a class with more rows may hold a large key; its keys are cut into segments


def drawdown_segments(df: DataFrame, keys, order_cols, value_col: str, ts_col: str, bucket_seconds: int | None = None,
                      sums=(), maxima=(), sets=()) -> DataFrame:
    """One summary per (key, segment ``_tb``) for ``combine_drawdown``. With fixed time buckets a
    summary depends on the rows of that bucket only, so it can be stored."""
    keys, order_cols = list(keys), list(order_cols)
    slim = df.select(*dict.fromkeys([*keys, *order_cols, ts_col, *[c for c in df.columns if c == "_tb"]]), F.col(value_col).cast(_DEC).alias("_v"),
                     *[c.alias(n) for n, c in [*sums, *maxima, *sets]])
    own = [[(n, F.col(n)) for n, _ in x] for x in (sums, maxima, sets)]
    return _summaries(_segmented(slim, keys, order_cols, ts_col, bucket_seconds), [*keys, "_tb"], order_cols, *own)


def _summaries(d: DataFrame, keys, order_cols, sums, maxima, sets) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_cum", F.sum("_v").over(w))
    d = d.withColumn("_peak", F.max("_cum").over(w))
    return d.groupBy(*keys).agg(
        F.max(F.col("_peak") - F.col("_cum")).alias("_inner"),       # drawdown from a peak inside the bucket
        F.min("_cum").alias("_low"),
        F.max("_cum").alias("_high"),
        F.sum("_v").alias("_total"), F.count("_v").alias("_values"),
        *[F.sum(c).alias(n) for n, c in sums], *[F.max(c).alias(n) for n, c in maxima], *[F.collect_set(c).alias(n) for n, c in sets])


def unit_summaries(df: DataFrame, keys, value_col: str, sums=(), maxima=()) -> DataFrame:
    """Each row as the summary of a segment of its own; its lowest and highest running sum are its total, so
    ``drawdown_segments``' columns for them stay null."""
    v, none = F.col(value_col).cast(_DEC), F.lit(None).cast(_DEC)
    return df.select(*keys, none.alias("_inner"), none.alias("_low"), none.alias("_high"), v.alias("_total"),
                     v.isNotNull().cast("long").alias("_values"), *[c.alias(n) for n, c in [*sums, *maxima]])


def fold_units(units: DataFrame, keys, order_cols, sums=(), maxima=()) -> DataFrame:
    """``unit_summaries`` of a key, a segment's say, to one summary."""
    own = [[(n, F.col(n)) for n in x] for x in (sums, maxima)]
    return _summaries(units.withColumn("_v", F.col("_total")), list(keys), list(order_cols), *own, ())


def combine_drawdown(seg: DataFrame, keys, out_col: str = "max_drawdown", sums=(), maxima=(), sets=(), order=("_tb",)) -> DataFrame:
    """Summaries of a key's buckets, in time order, to its drawdown and totals."""
    keys, dec = list(keys), _DEC
    wb = Window.partitionBy(*keys).orderBy(*order)
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    low, high = [F.coalesce(c, "_total") for c in ("_low", "_high")]
    seg = seg.withColumn("_offset", F.coalesce(F.sum("_total").over(before), F.lit(0).cast(dec)))
    # running peak before the bucket: max(0, max over earlier buckets of offset + high)
    seg = seg.withColumn("_peak_before", F.greatest(F.lit(0).cast(dec),
                                                    F.coalesce(F.max(F.col("_offset") + high).over(before),
                                                               F.lit(0).cast(dec))))
    seg = seg.withColumn("_dd", F.greatest(F.col("_inner"), F.col("_peak_before") - F.col("_offset") - low,
                                           F.lit(0).cast(dec)))
    return seg.groupBy(*keys).agg(
        F.when(F.sum("_values") > 0, F.max("_dd")).cast("double").alias(out_col),
        *[F.sum(n).alias(n) for n in sums], *[F.max(n).alias(n) for n in maxima],
        *[F.array_distinct(F.flatten(F.collect_list(n))).alias(n) for n in sets])


def distributed_percent_rank(df: DataFrame, group_cols, value_col: str, out_col: str = "percent_rank",
                             partitions: int | None = None) -> DataFrame:
    """Exact ``percent_rank() over (partition by group order by value)``
    without a single-partition window: count rows per distinct (group, value)
    (map-side combine collapses hot values), sort the distinct values with a
    range partitioning, take prefix counts per partition from a table of
    (partitions x groups) rows, and join the rank back to the rows. The ranged
    values are stored: both readers of the partitions see the same ranges."""
    g = list(group_cols)
    n_parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    vals = df.where(F.col(value_col).isNotNull()).groupBy(*g, value_col).agg(F.count(F.lit(1)).alias("_cnt"))
    ranged = stored(vals.repartitionByRange(n_parts, *g, value_col).withColumn("_pid", F.spark_partition_id()), "ranks")
    # rows strictly below each value inside its range partition
    wl = Window.partitionBy("_pid", *g).orderBy(value_col).rowsBetween(Window.unboundedPreceding, -1)
    # a part's rows meet again by the range of its number: the one exchange of this branch
    local = ranged.repartitionByRange(n_parts, "_pid").withColumn("_below_local", F.coalesce(F.sum("_cnt").over(wl), F.lit(0)))
    per_part = ranged.groupBy("_pid", *g).agg(F.sum("_cnt").alias("_part_n"))
    wp = Window.partitionBy(*g).orderBy("_pid")
    offsets = per_part.select(
        "_pid", *g,
        F.coalesce(F.sum("_part_n").over(wp.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.sum("_part_n").over(Window.partitionBy(*g)).alias("_n"))
    # a range partition spans a contiguous run of groups, so offsets has about
    # partitions + groups rows; AQE broadcasts it when its measured size allows
    ranks = local.join(offsets, ["_pid", *g]).select(
        *g, value_col,
        F.when(F.col("_n") > 1, (F.col("_offset") + F.col("_below_local")) / (F.col("_n") - 1))
        .otherwise(F.lit(0.0)).alias(out_col))
    return df.join(ranks, [*g, value_col], "left")


def running_mean_before(df: DataFrame, keys, t_seconds: str, value_col: str, lag: int, bucket_seconds: int,
                        out_col: str) -> DataFrame:
    """``out_col`` = mean of non-null ``value_col`` over rows of the same key
    whose time is at most (own time - ``lag``): the unbounded range frame
    ``avg(v) over (partition by keys order by t range between unbounded
    preceding and lag preceding)`` without a task per key.

    Values and lookups (at t - lag) are unioned and bucketed by time; running
    sums run per (key, bucket); bucket totals are prefixed over the small
    per-bucket table and added back."""
    keys = list(keys)
    cols = df.columns
    v = F.col(value_col).cast("double")
    row_t = df.select(F.struct(*cols)).schema[0].dataType
    # one pass: every row yields its value (kind 0) and its lookup (kind 1)
    both = df.select(*keys, F.explode(F.array(
        F.struct(F.col(t_seconds).cast("long").alias("_t"), F.lit(0).alias("_kind"), v.alias("_v"),
                 F.lit(None).cast(row_t).alias("_row")),
        F.struct((F.col(t_seconds) - F.lit(lag)).cast("long").alias("_t"), F.lit(1).alias("_kind"),
                 F.lit(None).cast("double").alias("_v"), F.struct(*cols).alias("_row")))).alias("_x"))
    both = both.select(*keys, "_x.*").where((F.col("_kind") == 1) | F.col("_v").isNotNull())
    u = both.withColumn("_tb", F.floor(F.col("_t") / F.lit(bucket_seconds)).cast("long"))
    w = Window.partitionBy(*keys, "_tb").orderBy("_t", "_kind")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    u = u.select("*", F.sum("_v").over(run).alias("_rs"), F.count("_v").over(run).alias("_rc"),
                 F.sum("_v").over(whole).alias("_ts"), F.count("_v").over(whole).alias("_tc"),
                 (F.row_number().over(w) == 1).alias("_first"))
    edges = u.where("_first").select(*keys, "_tb", F.coalesce("_ts", F.lit(0.0)).alias("_ts"), "_tc")
    before = Window.partitionBy(*keys).orderBy("_tb").rowsBetween(Window.unboundedPreceding, -1)
    pre = edges.select(*keys, "_tb", F.coalesce(F.sum("_ts").over(before), F.lit(0.0)).alias("_ps"),
                       F.coalesce(F.sum("_tc").over(before), F.lit(0)).alias("_pc"))
    q = u.where(F.col("_kind") == 1).join(pre, [*keys, "_tb"], "left")
    s = F.coalesce("_rs", F.lit(0.0)) + F.col("_ps")
    c = F.col("_rc") + F.col("_pc")
    return q.select("_row.*", F.when(c > 0, s / c).alias(out_col))
