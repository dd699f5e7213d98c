"""Mixing sources to target sizes by subset-sum budget fitting.

The corpus is reduced to a histogram: documents by source and exact length in
words. Sources share the corpus size by weight; none gets more than three times
its own. A source's target is met by whole passes over it and a subset for the
remaining budget: each length gives its share, and a bounded-knapsack table over
the length counts fits what is left, so the subset sums to the budget or near it.
The documents of a length are taken in seeded order.

Scale: rows are shuffled as (id, source, length) only. The histogram of a
source has a row per distinct length, however many documents it has. The
seeded order within one length is found by hash buckets (counts first, then ranks
inside buckets of about the square root of the group), so no task holds a
length that a third of all rows share. Per-source totals stay distributed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.llm.common import saved, with_rid

WORD = r"[^\x20\x09-\x0D]+"
REPEATS = 3  # a source is taken at most so many times
SPARE = 1 << 15  # words left for the knapsack table to fit


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length (> 0) to take so that their sum is the
    budget, or, where the table does not reach it, comes near it from either side."""
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    share = [int(c) * budget for c in counts]  # Python integers: exact
    take = np.array([s // total for s in share], np.int64)
    left = budget - int((lengths * take).sum())
    for i in sorted(range(len(lengths)), key=lambda i: (-(share[i] % total), lengths[i])):  # largest remainders
        if left - lengths[i] >= SPARE and take[i] < counts[i]:
            take[i] += 1
            left -= int(lengths[i])
    for i in np.argsort(-lengths, kind="stable"):
        k = int(min(counts[i] - take[i], max(0, left - SPARE) // lengths[i]))
        take[i] += k
        left -= k * int(lengths[i])
    free = np.flatnonzero((take < counts) & (lengths <= left))
    if left >= 4 * SPARE and len(free):  # only texts nearly as long as the budget are free
        i = free[lengths[free].argmax()]
        take[i] += 1
        left -= int(lengths[i])
    take += knapsack(lengths, counts - take, left)
    left = budget - int((lengths * take).sum())
    free = np.flatnonzero((take < counts) & (lengths < 2 * left))  # one more comes nearer than none
    if len(free):
        take[free[np.abs(lengths[free] - left).argmin()]] += 1
    return take


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded subset sum: reach[s] tells whether a sum s is possible, by[s] the
    bundle (a length, some power of two times) that first reached it."""
    reach, by, bundles = np.zeros(budget + 1, bool), np.full(budget + 1, -1, np.int64), []
    reach[0] = True
    for i in np.argsort(lengths, kind="stable"):
        n, k = int(min(counts[i], budget // lengths[i])), 1
        while n > 0 and not reach[budget]:
            k = min(k, n)
            w = int(lengths[i]) * k
            if w <= budget:
                new = reach[:-w] & ~reach[w:]
                by[w:][new] = len(bundles)
                reach[w:] |= new
                bundles.append((i, k, w))
            n, k = n - k, 2 * k
    take, s = np.zeros(len(lengths), np.int64), int(np.flatnonzero(reach)[-1])
    while s:
        i, k, w = bundles[by[s]]
        take[i] += k
        s -= w
    return take


def _fit_source(pdf: pd.DataFrame) -> pd.DataFrame:
    """Passes over the source and the subset of each length; one source's histogram in."""
    size, goal = int(pdf["source_size"].iloc[0]), int(round(pdf["target"].iloc[0]))
    passes = min(goal // size, REPEATS) if size else 0
    pdf = pdf.assign(passes=passes, take=0)
    words = (pdf["size"] > 0).to_numpy()
    if size and passes < REPEATS and words.any():
        pdf.loc[words, "take"] = fit(pdf.loc[words, "size"].to_numpy(), pdf.loc[words, "n"].to_numpy(), goal - passes * size)
    return pdf[["z", "source", "size", "n", "source_size", "target", "passes", "take"]]


def targets(hist: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """z, source, source_size, target for the sources of a histogram (z, source, size, n).

    Weights go round in code-point order, null last. A source whose share is above three
    times its size gets that; the excess is shared again by weight until none is."""
    totals = hist.groupBy("z", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    ranged = saved(totals.repartitionByRange("z", "source").sortWithinPartitions("z", "source").withColumn(
        "at", F.monotonically_increasing_id()), "sources")
    part, row = F.shiftright("at", 33), F.col("at").bitwiseAND(2 ** 33 - 1)
    before = (ranged.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("k"))  # a row per partition
              .withColumn("before", F.sum("k").over(Window.orderBy("p")) - F.col("k")))
    place = (F.col("before") + row) % len(weights)
    src = saved(ranged.withColumn("p", part).join(before, "p").select(
        "z", "source", "source_size", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")).cast("long").alias("w")),
        "source-weights")
    whole = F.coalesce(F.sum("source_size"), F.lit(0))
    rest, total_w = src.agg(whole, F.coalesce(F.sum("w"), F.lit(0))).first()
    all_size, capped = rest, -1
    while total_w:
        over = (F.col("source_size").cast("decimal(20,0)") * REPEATS * F.lit(total_w).cast("decimal(17,0)")
                < F.lit(rest).cast("decimal(20,0)") * F.col("w").cast("decimal(17,0)"))
        k, size, w, all_w = src.agg(F.count_if(over), F.coalesce(F.sum(F.when(over, F.col("source_size"))), F.lit(0)),
                                    F.coalesce(F.sum(F.when(over, F.col("w"))), F.lit(0)), F.sum("w")).first()
        if k == capped or w == all_w:
            break
        capped, rest, total_w = k, all_size - REPEATS * size, all_w - w
    share = F.col("w") * F.lit(float(rest)) / F.lit(float(total_w or 1))
    return src.select("z", "source", "source_size", F.least(F.col("source_size") * float(REPEATS), share).alias("target"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
          weights: tuple[int, ...] = (1, 2, 3), seed: int = 17, rid: str | None = None) -> DataFrame:
    """One row per row of ``docs``: rid, doc_id, size, source_size, target, copies, taken.

    size counts words (null: 0); copies is 0 to 3, taken is copies * size. Null
    is a source of its own. The order within a length depends on the seed and the id
    only (rows that share an id follow each other), so reruns agree. An empty
    table gives an empty result; other columns are not read, whatever their names.
    ``rid`` names the column of a ``numbered`` table that has the row number."""
    src = docs.select(*([F.col(rid).alias("rid")] if rid else []), F.col(id_col).alias("doc_id"), F.col(text).alias("t"), F.col(source).alias("s"))
    rows = saved((src if rid else with_rid(src, "rid")).select(
        "rid", "doc_id", F.regexp_count(F.coalesce("t", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.col("s").isNull().alias("z"), F.coalesce("s", F.lit("")).alias("source")), "mix-sizes")
    hist = saved(rows.groupBy("z", "source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-histogram")
    plan = saved(hist.join(targets(hist, weights), ["z", "source"]).groupBy("z", "source").applyInPandas(
        _fit_source, "z boolean, source string, size long, n long, source_size long, target double, passes long, take long"), "mix-plan")
    mark = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"))
    bucket = F.pmod(F.col("mark"), F.ceil(F.sqrt("n"))).cast("long")
    rows = saved(rows.join(plan, ["z", "source", "size"]).withColumn("mark", mark).withColumn("b", bucket), "mix-planned")
    group = ["z", "source", "size"]
    some = rows.filter("take > 0 AND take < n")
    counts = some.groupBy(*group, "b").agg(F.count(F.lit(1)).alias("k"))
    counts = counts.withColumn("before", F.sum("k").over(Window.partitionBy(*group).orderBy("b")) - F.col("k")).drop("k")
    rank = F.row_number().over(Window.partitionBy(*group, "b").orderBy("mark", "doc_id", "rid"))
    extra = (some.join(counts, [*group, "b"]).withColumn("r", rank).filter("before + r <= take").select("rid", F.lit(1).alias("extra")))
    done = rows.filter("take = 0 OR take = n").withColumn("copies", F.col("passes") + (F.col("take") > 0).cast("long"))
    some = some.join(extra, "rid", "left").withColumn("copies", F.col("passes") + F.coalesce("extra", F.lit(0))).drop("extra")
    return done.unionByName(some).select("rid", "doc_id", "size", "source_size", "target", F.col("copies").cast("int").alias("copies"),
                                         (F.col("copies") * F.col("size")).alias("taken"))
