"""Near-duplicate detection with HyperMinHash sketches.

A sketch has 128 registers. The top 7 bits of a shingle's hash choose the
register; of the smallest remaining value the register keeps the count of
leading zeros (6 bits) and the 10 bits after the first one. Empty registers
borrow from a filled one by a fixed random order (densification), so that a
register of two sets agrees with the probability of their Jaccard similarity
J whatever their size.

Four registers make a band, which is one 64-bit key. Sets linked at J >= 0.85
share at least one of the 32 bands but for a chance of (1 - 0.85^4)^32, below
1e-10. Sets of fewer than 6 shingles link only if equal (5 against 6 is 0.833,
6 against 7 is 0.857); equal sets are one class from the start.

In a bucket (band, key) no list of all pairs is made first: every member is
tested against the bucket's most central member, which links groups of copies
in one step and in linear work. Only members that still lie in different
components are then tested against each other, found through their rarest
shingles (see ``_cross_pairs``). Tests are: size ratio, the collision-corrected estimate from the registers,
then the full sets.
"""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.llm.common import saved, source_rows
from tradewatch.llm.components import components
from tradewatch.llm.shingles import WordHashes, shingle_set

REGISTERS, ROWS = 128, 4
BANDS = REGISTERS // ROWS
MANTISSA = 10
THRESHOLD = 85  # percent
HELD_SHINGLES = 1 << 21  # shingles a task keeps of the texts it has just compared
LEAST_SET = 6  # smaller sets reach 85 % only when equal
SLACK = 0.25  # of the estimate; over six standard deviations from 128 shingles on
ESTIMATE_FROM = 128
_BITS = 64 - 7
_ORDER = np.stack([np.random.default_rng(7_000 + j).permutation(REGISTERS) for j in range(REGISTERS)])


def registers(s: np.ndarray) -> np.ndarray:
    """128 uint16 registers of a sorted, non-empty set of 64-bit hashes."""
    slot = (s >> np.uint64(_BITS)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])  # sorted, so the first of a slot is its least
    least = s[first] & np.uint64((1 << _BITS) - 1)
    _, width = np.frexp(least.astype(np.float64))  # bit length, but for rounding up at a power of two
    width = np.where((width > 0) & (least < (np.uint64(1) << np.maximum(width - 1, 0).astype(np.uint64))), width - 1, width)
    zeros = np.minimum(_BITS - width, 63).astype(np.uint64)
    body = np.where(width > 0, least << (np.uint64(64) - np.maximum(width, 1).astype(np.uint64)), np.uint64(0))
    mantissa = (body << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    filled, codes = np.zeros(REGISTERS, bool), np.zeros(REGISTERS, np.uint16)
    filled[slot[first]] = True
    codes[slot[first]] = (zeros << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    if not filled.all():
        for j in np.flatnonzero(~filled):
            o = _ORDER[j]
            codes[j] = codes[o[filled[o].argmax()]]
    return codes


def estimate(a: np.ndarray, b: np.ndarray, na, nb) -> np.ndarray:
    """Jaccard estimates of rows of registers, less the share of registers that
    agree by accident: about 0.17 / 2^10 for sets of equal size, fewer else."""
    x = na / nb
    c = 0.169919 / 2 ** MANTISSA * 4 * x / (1 + x) ** 2
    return np.maximum(0, ((a == b).mean(axis=-1) - c) / (1 - c))


_SKETCH = "rid long, doc_id {id}, n long, d1 long, d2 long, bands array<long>"


def _sketches(batches):
    words = WordHashes()
    for batch in batches:
        n, d1, d2, bands = [], [], [], []
        for text in batch.column("text"):
            s = shingle_set(text.as_py(), words)
            n.append(len(s))
            d = xxhash.xxh3_128_digest(s.tobytes())
            d1.append(int.from_bytes(d[:8], "little", signed=True))
            d2.append(int.from_bytes(d[8:], "little", signed=True))
            bands.append(registers(s).view(np.int64) if len(s) >= LEAST_SET else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("rid"), batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(d1, pa.int64()),
             pa.array(d2, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
            names=["rid", "doc_id", "n", "d1", "d2", "bands"])


def _similar_sketches(batches):
    """Pairs whose sketches leave a similarity of the threshold possible."""
    for batch in batches:
        if not batch.num_rows:
            continue
        na, nb = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("na", "nb"))
        ra, rb = (batch.column(c).flatten().to_numpy().view(np.uint16).reshape(-1, REGISTERS) for c in ("ba", "bb"))
        ok = (estimate(ra, rb, na, nb) >= THRESHOLD / 100 - SLACK) | (np.minimum(na, nb) < ESTIMATE_FROM)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok))


def linked_sets(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= THRESHOLD * (len(x) + len(y) - both)


def _confirmed(batches):
    """Pairs whose full shingle sets reach the threshold."""
    words, sets, held = WordHashes(), OrderedDict(), 0

    def of(rid, text):
        nonlocal held
        if rid not in sets:
            made = shingle_set(text.as_py(), words)
            while sets and held + len(made) > HELD_SHINGLES:
                held -= len(sets.popitem(last=False)[1])
            sets[rid] = made
            held += len(made)
        return sets[rid]

    for batch in batches:
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        ta, tb = batch.column("ta"), batch.column("tb")
        ok = [linked_sets(of(x, ta[i]), of(y, tb[i])) for i, (x, y) in enumerate(zip(a, b, strict=True))]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))


def _verified(pairs: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """Of the pairs (a, b) those that are linked."""
    near = (pairs.join(reps.selectExpr("rid AS a", "n AS na", "bands AS ba"), "a")
            .join(reps.selectExpr("rid AS b", "n AS nb", "bands AS bb"), "b")
            .filter(f"100 * least(na, nb) >= {THRESHOLD} * greatest(na, nb)")
            .select("a", "b", "na", "nb", "ba", "bb").mapInArrow(_similar_sketches, "a long, b long"))
    near = saved(near, "near-pairs")
    return (near.join(texts.selectExpr("rid AS b", "text AS tb"), "b").join(texts.selectExpr("rid AS a", "text AS ta"), "a")
            .select("a", "b", "ta", "tb").mapInArrow(_confirmed, "a long, b long"))


def _set_rows(batches):
    """One row per shingle of each text: rid, root, n, h."""
    words = WordHashes()
    for batch in batches:
        for i, text in enumerate(batch.column("text")):
            s = shingle_set(text.as_py(), words).view(np.int64)
            size = pa.array(np.full(len(s), len(s)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(s), batch.column(c)[i].as_py(), np.int64)) for c in ("rid", "root")]
                + [size, pa.array(s)], names=["rid", "root", "n", "h"])


def _cross_pairs(mixed: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of rows that share a bucket but lie in different components, as
    (smaller, larger) number: every one that can reach the threshold.

    ``mixed``: rid, root. Shingles are ordered from the rarest among these rows.
    Of a linked pair of sizes n <= m, all common shingles lie at or after the
    first common one, so its positions leave at least ceil(85 (n + m) / 185)
    shingles in both; that bounds how far either list has to be read, and
    rejects most pairs of edited copies, whose edits are rare, unseen."""
    rows = saved(texts.join(mixed, "rid").select("rid", "root", "text")
                 .mapInArrow(_set_rows, "rid long, root long, n long, h long"), "mixed-shingles")
    # aggregates are stored before they are joined: a join with two plain sides is split where a key holds many rows
    shared = saved(rows.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "shared-shingles")
    own = Window.partitionBy("rid")  # one text's shingles
    rows = rows.join(shared, "h").select(
        "h", "rid", "root", "n",
        (F.col("n") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("c", "h")) - 1).alias("pos"))
    rows = saved(rows.filter(f"pos <= n - ceil({THRESHOLD} * n / 100)"), "rare-shingles")
    crossing = saved(rows.groupBy("h").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 != r1").select("h"), "crossing-shingles")
    rows = rows.join(crossing, "h", "left_semi")
    # sizes of a linked pair differ by at most one step of this scale
    rows = rows.withColumn("g", F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / THRESHOLD))).cast("int"))
    short = rows.filter(f"pos <= n - ceil({2 * THRESHOLD} * n / {100 + THRESHOLD})").withColumn("g", F.explode(F.array(F.col("g"), F.col("g") + 1)))
    long = rows.selectExpr("h", "g", "rid AS rid2", "root AS root2", "n AS n2", "pos AS pos2")
    return short.join(long, ["h", "g"]).filter(
        f"root != root2 AND (n < n2 OR n = n2 AND rid < rid2) AND 100 * n >= {THRESHOLD} * n2 "
        f"AND least(n - pos, n2 - pos2) >= ceil({THRESHOLD} * (n + n2) / {100 + THRESHOLD})"
    ).select(F.least("rid", "rid2").alias("a"), F.greatest("rid", "rid2").alias("b")).distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", rid: str | None = None) -> DataFrame:
    """One row per row of ``docs``: rid, doc_id, n_shingles, component_id, kept.

    Texts are lower-cased (A-Z) and shingled by five words; rows are linked when
    their sets have a Jaccard similarity of 0.85 or more. component_id is the
    smallest id reachable (null only if all are null), and that row is kept; of
    rows that share the id, the first. Null, empty and blank texts have no shingles and
    link with nothing. An empty table gives an empty result; other columns are
    not read, whatever their names. ``rid``: see ``source_rows``."""
    id_type = dict(docs.dtypes)[id_col]
    src = source_rows(docs, rid, doc_id=id_col, text=text)
    sketch = saved(src.select("rid", "doc_id", "text").mapInArrow(_sketches, _SKETCH.format(id=id_type)), "sketches")

    reps = saved(sketch.filter("n > 0").groupBy("d1", "d2").agg(
        F.min("rid").alias("rid"), F.first("n").alias("n"), F.first("bands").alias("bands")), "set-classes")
    rows = reps.filter(f"n >= {LEAST_SET}").select("rid", "n", F.posexplode("bands").alias("band", "key"))
    sizes = saved(rows.groupBy("band", "key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "bucket-sizes")
    members = saved(rows.join(sizes, ["band", "key"]), "buckets")
    texts = saved(src.join(members.select("rid").distinct(), "rid", "left_semi").select("rid", "text"), "bucket-texts")

    # the most central member of a bucket: the one whose own buckets hold the most rows
    central = members.groupBy("rid").agg(F.sum("c").alias("w"))
    heads = saved(members.join(central, "rid").groupBy("band", "key")
                  .agg(F.max(F.struct(F.col("w"), (-F.col("rid")).alias("r"))).alias("top"))
                  .select("band", "key", (-F.col("top.r")).alias("a")), "bucket-heads")
    tested = saved(members.join(heads, ["band", "key"]).filter("rid != a").select("a", F.col("rid").alias("b")).distinct(), "star-pairs")
    links = saved(_verified(tested, reps, texts), "star-links")
    roots = components(links.selectExpr("a AS u", "b AS v"))

    left = saved(members.filter("c > 2").join(roots.selectExpr("node AS rid", "root"), "rid", "left").select(
        "band", "key", "rid", F.coalesce("root", "rid").alias("root")), "rooted-buckets")
    split = saved(left.groupBy("band", "key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 != r1")
                  .select("band", "key"), "split-buckets")
    mixed = left.join(split, ["band", "key"], "left_semi").select("rid", "root").distinct()
    done = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = saved(_cross_pairs(mixed, texts).join(done, ["a", "b"], "left_anti"), "cross-pairs")
    if not more.isEmpty():
        links = links.unionByName(_verified(more, reps, texts))
        roots = components(links.selectExpr("a AS u", "b AS v"))

    own = sketch.filter("n > 0").join(reps.selectExpr("d1", "d2", "rid AS rep"), ["d1", "d2"]).select("rid", "doc_id", "n", "rep")
    own = own.unionByName(sketch.filter("n = 0").select("rid", "doc_id", "n", F.col("rid").alias("rep")))
    own = saved(own.join(roots.selectExpr("node AS rep", "root"), "rep", "left").select(
        "rid", "doc_id", "n", F.coalesce("root", "rep").alias("root")), "members")
    best = saved(own.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "rid")).alias("best")), "component-ids")
    return own.join(best, "root").select(
        "rid", "doc_id", F.col("n").alias("n_shingles"), F.col("best.doc_id").alias("component_id"),
        (F.col("rid") == F.col("best.rid")).alias("kept"))
