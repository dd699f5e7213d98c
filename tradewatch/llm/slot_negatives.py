"""Hard-negative mining by slot-decomposed selection.

An anchor's positives are its nearest rows of the same label. Each positive allows
negatives in a window of scores below it. The windows of one anchor overlap, so rows
are not selected window by window: the windows' upper limits cut the scores into
disjoint slots, and only the first k rows of each slot are kept. What lies below an
upper limit is that limit's slot and all lower ones, so merging the slots from the
highest allowed one downwards gives the first k rows of every window, in one pass
over the rows.

Scale: anchors are answered in blocks. The components of a block, at most CELLS
numbers, are sent to the tasks; the rows stay where they are. A task scores its rows
against the block in tiles and keeps k rows per anchor and slot, so it hands on a
number of rows that depends on the block alone, however many rows it has read and
however many of them share a label or a vector. Every block's answers are written
before the next block starts.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.llm.common import saved, shared_dir

CELLS = 1 << 21  # components of a block of anchors
TILE = 1 << 21  # scores that a task holds at once
EXACT = float(1 << 53)  # sums of products below this are exact in double precision
TOP, LOW = 2 ** 63 - 1, -2 ** 63  # scores lie above LOW
FOUND = "anchor long, slot int, score long, vec_id long, rid long"


def usable(rows: DataFrame, id_col: str, vector: str, label: str, scale: int) -> DataFrame:
    """rid, vec_id, label, v of the rows that take part; components are floor(scale * x)."""
    v = F.col("v").cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * float(scale)) < float("inf"))
    # from 2^52 on a double is a whole number already
    whole = lambda y: F.when(F.abs(y) < float(1 << 52), F.floor(y).cast("double")).otherwise(y)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    src = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).alias("v"), F.col(label).cast("decimal(20,0)").alias("label"))
    src = src.filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").filter(F.forall(v, finite))
    return src.select(F.monotonically_increasing_id().alias("rid"), "vec_id", moved.cast("long").alias("label"),
                      F.transform(v, lambda x: whole(x * float(scale))).alias("v"))


def matrix(column, width: int | None = None) -> np.ndarray:
    """The vectors of an Arrow column as rows; components that a vector lacks are 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, at = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.diff(column.offsets.to_numpy())
    width = (int(at.max()) if len(at) else 0) if width is None else width
    if len(at) and (at == width).all():
        return flat.reshape(len(at), width)
    out, inside = np.zeros((len(at), width)), np.arange(len(flat)) - np.repeat(np.cumsum(at) - at, at)
    row, keep = np.repeat(np.arange(len(at)), at), inside < width
    out[row[keep], inside[keep]] = flat[keep]
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of ``a`` with those of ``b``. Scores that no long holds become the nearest long."""
    most = (np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0)) * a.shape[1]
    if most < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in r] for r in m], object).reshape(m.shape)
    return np.clip(whole(a).dot(whole(b).T), -TOP, TOP).astype(np.int64)


class Best:
    """The first k rows per (anchor, slot) seen so far: highest score, then smallest vec_id, then rid."""

    def __init__(self, anchors: int, slots: int, k: int):
        self.k, self.slots = k, slots
        self.least = np.full(anchors * slots, LOW, np.int64)  # score of the k-th row, once there is one
        self.kept = [np.empty(0, np.int64) for _ in range(4)]  # group, score, vec_id, rid
        self.new, self.waiting = [], 0

    def add(self, group, score, vec_id, rid) -> None:
        hit = score >= self.least[group]
        self.new.append([x[hit] for x in (group, score, vec_id, rid)])
        self.waiting += int(hit.sum())
        if self.waiting > TILE:
            self.settle()

    def settle(self) -> None:
        if not self.new:
            return
        group, score, vec_id, rid = (np.concatenate(x) for x in zip(self.kept, *self.new, strict=True))
        order = np.lexsort((rid, vec_id, ~score, group))
        group, score, vec_id, rid = (x[order] for x in (group, score, vec_id, rid))
        start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.empty(0, np.int64)
        place = np.arange(len(group)) - np.repeat(start, np.diff(np.r_[start, len(group)]))
        last = place == self.k - 1
        self.least[group[last]] = score[last]
        keep = place < self.k
        self.kept, self.new, self.waiting = [x[keep] for x in (group, score, vec_id, rid)], [], 0

    def batches(self, anchor_rids: np.ndarray):
        self.settle()
        group, score, vec_id, rid = self.kept
        names = ["anchor", "slot", "score", "vec_id", "rid"]
        for i in range(0, len(group), 1 << 16):
            g = group[i:i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(anchor_rids[g // self.slots]), pa.array((g % self.slots).astype(np.int32)),
                                              *[pa.array(x[i:i + (1 << 16)]) for x in (score, vec_id, rid)]], names=names)


def _tiles(batches, anchors: dict):
    """label, vec_id, rid and scores (rows x anchors) of some rows at a time."""
    n, width = max(1, len(anchors["rid"])), anchors["v"].shape[1]
    step = max(1, TILE // max(n, width, 1))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            b = batch.slice(at, step)
            lab, vec_id, rid = (b.column(c).to_numpy() for c in ("label", "vec_id", "rid"))
            yield lab, vec_id, rid, products(matrix(b.column("v"), width), anchors["v"])


def _positives(block, k: int):
    def run(batches):
        anchors = block.value
        best = Best(len(anchors["rid"]), 1, k)
        for lab, vec_id, rid, score in _tiles(batches, anchors):
            row, a = np.nonzero((lab[:, None] == anchors["label"]) & (rid[:, None] != anchors["rid"]) & (score >= best.least))
            best.add(a, score[row, a], vec_id[row], rid[row])
        yield from best.batches(anchors["rid"])
    return run


def _slots(block, k: int):
    """Rows of other labels by slot. ``upper`` has an anchor's distinct upper limits from the
    highest down, ``lower`` the least lower limit: nothing below it lies in a window."""
    def run(batches):
        anchors = block.value
        upper, lower = anchors["upper"], anchors["lower"]
        slots = upper.shape[1]
        best = Best(len(anchors["rid"]), slots, k)
        for lab, vec_id, rid, score in _tiles(batches, anchors):
            row, a = np.nonzero((lab[:, None] != anchors["label"]) & (score <= upper[:, 0]) & (score >= lower))
            s = score[row, a]
            slot = (s[:, None] <= upper[a]).sum(axis=1) - 1  # the lowest limit that lies above
            best.add(a * slots + slot, s, vec_id[row], rid[row])
        yield from best.batches(anchors["rid"])
    return run


def limits(score: Column, low: tuple[int, int], high: tuple[int, int]) -> tuple[Column, Column]:
    """Least and greatest integer n with low * score <= n <= high * score for a score of 0 or more;
    fractions are given as (numerator, denominator) and worked out without an overflow."""
    part = lambda f, up: (F.expr(f"score DIV {f[1]}") * f[0]
                          + F.expr(f"((score % {f[1]}) * {f[0]} + {f[1] - 1 if up else 0}) DIV {f[1]}"))
    return part(low, True), part(high, False)


def hard_negatives(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", *, every: int = 100,
                   positives: int = 5, k: int = 10, low: tuple[int, int] = (3, 10), high: tuple[int, int] = (9, 10),
                   scale: int = 256, cells: int = CELLS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``; a score is the inner product
    of floor(scale * x). A positive's negatives are the first ``k`` rows of another label with a
    score from low to high times its own (fractions; a negative score has no such rows).

    A row with a null id, label or vector, or with a null component or one that is not finite (once scaled), takes no part. Rows that
    repeat, or share an id, are rows of their own: each is an anchor or a candidate. Components that the
    shorter of two vectors lacks count as 0; a vector without any scores 0. An empty table gives an empty
    result; other columns are not read, whatever their names."""
    spark = rows.sparkSession
    src = saved(usable(rows, id_col, vector, label, scale), "negatives-rows")
    anchors = src.filter(F.col("vec_id") % every == 0)
    n, width = anchors.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    blocks = -(-n * max(width or 1, 1) // cells)
    anchors = saved(anchors.withColumn("block", F.pmod(F.xxhash64("rid"), F.lit(max(blocks, 1)))).repartition("block")
                    .sortWithinPartitions("block", "rid"), "negatives-anchors")
    base = f"{shared_dir(spark).rstrip('/')}/tradewatch-llm/negatives-found-{uuid.uuid4().hex[:12]}"
    empty = spark.createDataFrame([], FOUND)
    empty.write.parquet(f"{base}/positives")
    empty.write.parquet(f"{base}/slots")
    lower, upper = limits(F.col("score"), low, high)
    for i in range(blocks):
        got = anchors.filter(F.col("block") == i).select("rid", "label", "v").toArrow()
        if not got.num_rows:
            continue
        block = {"rid": got["rid"].to_numpy(), "label": got["label"].to_numpy(), "v": matrix(got["v"])}
        sent = spark.sparkContext.broadcast(block)
        near = saved(_first(src.mapInArrow(_positives(sent, positives), FOUND), positives), "negatives-near")
        sent.unpersist()
        near.write.mode("append").parquet(f"{base}/positives")
        window = near.filter("score >= 0").select("anchor", lower.alias("lower"), upper.alias("upper")).filter("lower <= upper")
        # at most ``positives`` rows for each anchor of the block
        window = window.groupBy("anchor").agg(F.min("lower").alias("lower"), F.sort_array(F.collect_set("upper"), False).alias("upper")).toArrow()
        if not window.num_rows:
            continue
        at = np.searchsorted(block["rid"], window["anchor"].to_numpy())
        ends = np.full((len(at), positives), LOW, np.int64)
        for r, x in enumerate(window["upper"].to_pylist()):
            ends[r, :len(x)] = x
        part = {c: block[c][at] for c in ("rid", "label", "v")} | {"upper": ends, "lower": window["lower"].to_numpy()}
        # limits that are missing are below every score that counts: their slots stay empty
        sent = spark.sparkContext.broadcast(part)
        _first(src.mapInArrow(_slots(sent, k), FOUND), k).write.mode("append").parquet(f"{base}/slots")
        sent.unpersist()
    near, slots = (spark.read.schema(FOUND).parquet(f"{base}/{x}") for x in ("positives", "slots"))
    near = near.filter("score >= 0").select("anchor", F.col("vec_id").alias("positive_id"), F.col("rid").alias("prid"),
                                            F.col("score").alias("positive_score"), lower.alias("lower"), upper.alias("upper"))
    # at most k rows for each of an anchor's slots
    order = F.struct((-F.col("score")).alias("down"), "vec_id", "rid", "score")
    merged = slots.groupBy("anchor").agg(F.sort_array(F.collect_list(order)).alias("c"))
    below = F.slice(F.filter("c", lambda x: x["score"] <= F.col("upper")), 1, k)  # the slots from the limit's own downwards
    out = near.join(merged, "anchor").select("*", F.posexplode(F.filter(below, lambda x: x["score"] >= F.col("lower"))).alias("at", "x"))
    ids = src.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id")).filter(F.col("anchor_id") % every == 0)
    return out.join(ids, "anchor").select(
        "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("negative_id"), "positive_score",
        F.col("x.score").alias("negative_score"))


def _first(found: DataFrame, k: int) -> DataFrame:
    """The tasks' rows merged: the first k of each (anchor, slot); k rows of a task at most meet in one group."""
    rank = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id", "rid"))
    return found.withColumn("r", rank).filter(F.col("r") <= k).drop("r")
