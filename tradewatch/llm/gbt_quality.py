"""Quality classifier: histogram gradient-boosted trees over document statistics.

Spark computes the statistics of every whole text and scores every row. The
trees are fitted with numpy on a bounded sample of the labelled rows
(SAMPLE_ROWS, the ones with the smallest hash of their id, so the same at every
run). Fitted trees are complete and flattened into three arrays; all rows of a
batch walk them together, level by level.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import saved, with_rid

SAMPLE_ROWS = 20_000
TREES, DEPTH, RATE, BINS, L2, LEAST = 60, 4, 0.15, 64, 1.0, 8.0

NAMES = ("words", "bytes_per_word", "distinct_words", "top_word", "repeat_pairs", "upper", "digits", "marks", "symbols",
         "shouts", "bars", "spaces", "wide", "lines", "distinct_lines", "words_per_line", "ends", "longest_word")

_CLASS = np.zeros(256, np.int64)  # byte -> class
for _k, _set in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?\"'()-", b"#*$%&<>@~^_=+{}[]\\/", b"!", b"|",
                           b" \t\n\r\x0b\x0c", bytes(range(128, 256))), 1):
    _CLASS[list(_set)] = _k


def statistics(text: str | None) -> list[float]:
    """The statistics of a text, in the order of NAMES; all 0 without words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    by = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=9) / len(raw)
    count = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ends = sum(x.rstrip()[-1:] in b".!?:;\"" for x in lines)
    pairs = len(set(zip(words, words[1:], strict=False)))
    return [float(np.log1p(n)), len(raw) / n, len(count) / n, max(count.values()) / n, 1 - pairs / max(1, n - 1),
            by[1], by[2], by[3], by[4], by[5], by[6], by[7], by[8], float(np.log1p(len(lines))),
            len(set(lines)) / len(lines), n / len(lines), ends / len(lines), float(min(100, max(map(len, count))))]


def _measure(batches):
    for batch in batches:
        x = [statistics(t.as_py()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), pa.array(x, pa.list_(pa.float64()))],
                                         names=["rid", "doc_id", "x"])


class Trees:
    """Complete trees of one depth: feature and threshold of each inner node, values of the leaves."""

    def __init__(self, bias: float, feature: np.ndarray, threshold: np.ndarray, leaf: np.ndarray):
        self.bias, self.feature, self.threshold, self.leaf = bias, feature, threshold, leaf

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for the rows of x."""
        z, rows = np.full(len(x), self.bias), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            while len(at) and at[0] < inner:  # all rows are on one level
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            z += leaf[at - inner]
        return 1 / (1 + np.exp(-z))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees for labels 0 and 1, from per-feature histograms of gradients."""
    inner, leaves = 2 ** DEPTH - 1, 2 ** DEPTH
    if not len(y):
        return Trees(0.0, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    share = (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    width, m = BINS, x.shape[1]
    feature, threshold, leaf = np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf), np.zeros((TREES, leaves))
    z = np.full(len(y), bias)
    for k in range(TREES):
        p = 1 / (1 + np.exp(-z))
        g, h = p - y, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first, nodes = 2 ** level - 1, 2 ** level
            cell = (((at - first)[:, None] * m + np.arange(m)) * width + binned).ravel()
            sums = [np.bincount(cell, np.repeat(w, m), nodes * m * width).reshape(nodes, m, width) for w in (g, h, np.ones(len(y)))]
            left = [s.cumsum(axis=2) for s in sums]
            whole = [s[:, :, -1:] for s in left]
            gain = (left[0] ** 2 / (left[1] + L2) + (whole[0] - left[0]) ** 2 / (whole[1] - left[1] + L2) - whole[0] ** 2 / (whole[1] + L2))
            gain[(left[2] < LEAST) | (whole[2] - left[2] < LEAST)] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            cut = np.full(nodes, width)  # no split: every row goes left
            for i in range(nodes):
                f, b = divmod(int(best[i]), width)
                if gain[i, f, b] > 1e-9 and b < len(edges[f]):
                    feature[k, first + i], threshold[k, first + i], cut[i] = f, edges[f][b], b
            node = at - first
            at = 2 * at + 1 + (binned[np.arange(len(y)), feature[k, at]] > cut[node])
        sg, sh = (np.bincount(at - inner, w, leaves) for w in (g, h))
        leaf[k] = -RATE * sg / (sh + L2)
        z += leaf[k][at - inner]
    return Trees(bias, feature, threshold, leaf)


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
           sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Rows whose crc32 of the id's text leaves 1 modulo 3 are held out: their labels are not
    read. A row scores the same whatever its id, source or language. Null and empty texts
    are scored from statistics of 0. An id with several labels counts with the largest; null labels
    and ids are left out. Without labels every score is 0.5. An empty
    table gives an empty result; other columns are not read, whatever their names."""
    id_type = dict(docs.dtypes)[id_col]
    src = with_rid(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), "rid")
    stats = saved(src.select("rid", "doc_id", "text").mapInArrow(_measure, f"rid long, doc_id {id_type}, x array<double>"), "statistics")
    rest = F.pmod(F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0)), F.lit(3))
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("y")).filter("doc_id IS NOT NULL AND y IS NOT NULL")
    known = saved(known.filter(rest != 1).groupBy("doc_id").agg(F.max("y").alias("y")), "training-labels")
    n = known.count()
    if n > sample_rows:  # a fifth more than needed, so that not every task offers a whole sample
        known = known.filter(F.xxhash64("doc_id") / F.lit(2.0 ** 64) + 0.5 <= 1.2 * sample_rows / n)
    sample = (stats.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "rid").limit(sample_rows).select("x", "y").toPandas())
    x = np.stack(sample["x"].to_numpy()) if len(sample) else np.zeros((0, len(NAMES)))
    trees = docs.sparkSession.sparkContext.broadcast(fit(x, sample["y"].to_numpy(np.float64)))  # some kilobytes

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                s = trees.value.score(batch.column("x").flatten().to_numpy().reshape(-1, len(NAMES)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"])

    return stats.select("doc_id", (rest == 1).alias("held_out"), "x").mapInArrow(
        run, f"doc_id {id_type}, held_out boolean, score double, predicted int")
