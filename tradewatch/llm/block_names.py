"""Exact deduplication by deterministic block naming, in DataFrame operations.

The bytes of each normalised text are cut into blocks of a fixed size. Equal
blocks get one integer name: the distinct blocks are sorted and numbered. Then
adjacent names are paired and the distinct pairs are sorted and numbered in the
same way, level by level, until every document has one name. Two documents
have the same (level, name) if, and only if, their texts are equal.

A 64-bit hash only routes a block to its name. Where one hash has several
distinct blocks, names are looked up by the block itself, so no collision
merges two texts.

Scale: a text crosses the network once, after equal blocks of a partition have
been merged. Everything else moves integers: levels shrink by half. A block or
a pair that a third of all rows hold is merged before each shuffle; lookups are
plain sort-merge joins, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import ascii_lower, saved, source_rows

BLOCK_BYTES = 4096
NONE = -(2 ** 62)  # stands for the missing right half of an odd pair


def _blocks(text: Column, block_bytes: int, each) -> Column:
    """``each(block, i)`` for the blocks of a text, in order; [] for an empty text."""
    cut = lambda b: F.transform(
        F.sequence(F.lit(0), F.ceil(F.octet_length(b) / F.lit(block_bytes)).cast("int") - 1),
        lambda i: each(F.substring(b, i * block_bytes + 1, F.lit(block_bytes)), i))
    # the one-element array makes the normalised text a value that is computed once
    return F.flatten(F.transform(F.array(text.cast("binary")),
                                 lambda b: F.when(F.octet_length(b) > 0, cut(b)).otherwise(F.slice(cut(b), 1, 0))))


def _numbered(df: DataFrame, cols: list[str]) -> DataFrame:
    """Sort distinct rows within their partitions and number them."""
    return df.sortWithinPartitions(*cols).withColumn("name", F.monotonically_increasing_id())


def block_identity(docs: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES,
                   hash_of=F.xxhash64, carry: tuple[str, ...] = (), rid: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``rid``, the ``carry`` columns, ``text_sha256``
    (of the normalised text), ``level`` and ``name``. A null text is empty; an empty text
    has level -1. ``hash_of`` routes blocks and never decides (tests pass a weak one). ``rid``: see ``source_rows``."""
    rows = source_rows(docs, rid, text=text, **{f"c_{i}": c for i, c in enumerate(carry)})
    norm = ascii_lower(F.coalesce("text", F.lit("")))
    src = rows.select("rid", *[f"c_{i}" for i in range(len(carry))], norm.alias("norm"))
    base = saved(src.select(
        "rid", *[f"c_{i}" for i in range(len(carry))],
        F.sha2(F.col("norm"), 256).alias("text_sha256"),
        _blocks(F.col("norm"), block_bytes, lambda b, i: hash_of(b)).alias("hs")), "block-hashes")

    texts = src.select(F.explode(_blocks(F.col("norm"), block_bytes, lambda b, i: b)).alias("block"))
    texts = texts.withColumn("h", hash_of(F.col("block")))
    distinct = texts.groupBy("h", "block").agg(F.count(F.lit(1)).alias("n"))
    names = saved(_numbered(distinct, ["block"]).select("h", "name"), "block-names")
    per_hash = saved(names.groupBy("h").agg(F.min("name").alias("name"), F.count(F.lit(1)).alias("variants")), "block-hash-names")

    cur = base.select("rid", F.size("hs").alias("n"), F.posexplode("hs").alias("pos", "h"))
    cur = saved(cur.join(per_hash, "h").select("rid", "n", "pos", "h", "name", "variants"), "block-level0")
    clashes = cur.filter("variants > 1")
    if not clashes.isEmpty():
        cur = cur.filter("variants = 1").unionByName(_by_block(src, block_bytes, hash_of, clashes))
    cur = cur.select("rid", "n", "pos", "name")

    done = cur.filter("n = 1").select("rid", F.lit(0).alias("level"), "name")
    level, left = 0, saved(cur.filter("n > 1"), "block-many")
    while not left.isEmpty():
        level += 1
        pairs = saved(
            left.groupBy("rid", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
                F.max("n").alias("n"),
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(NONE)).alias("b")), "block-pairs")
        named = saved(_numbered(pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("k")), ["a", "b"])
                      .select("a", "b", "name"), "block-pair-names")
        left = saved(pairs.join(named, ["a", "b"])
                     .select("rid", F.ceil(F.col("n") / 2).cast("int").alias("n"), "pos", "name"), "block-level")
        done = done.unionByName(left.filter("n = 1").select("rid", F.lit(level).alias("level"), "name"))
        left = left.filter("n > 1")
    empty = base.filter(F.size("hs") == 0).select("rid", F.lit(-1).alias("level"), F.lit(0).cast("long").alias("name"))
    out = base.join(done.unionByName(empty), "rid")
    return out.select("rid", *[F.col(f"c_{i}").alias(c) for i, c in enumerate(carry)], "text_sha256", "level", "name")


def _by_block(src, block_bytes, hash_of, clashes) -> DataFrame:
    """Names for the rows of hashes that several distinct blocks share, by the block."""
    rows = src.select(
        "rid", F.explode(_blocks(F.col("norm"), block_bytes,
                                 lambda b, i: F.struct(i.alias("pos"), hash_of(b).alias("h"), b.alias("block")))).alias("x"))
    rows = saved(rows.select("rid", "x.*").join(clashes.select("h").distinct(), "h", "left_semi"), "block-clashes")
    named = _numbered(rows.groupBy("block").agg(F.count(F.lit(1)).alias("k")), ["block"])
    named = saved(named.select("block", (-F.col("name") - 1).alias("own")), "block-clash-names")  # apart from the others
    found = rows.join(named, "block").select("rid", "pos", "own")
    return clashes.join(found, ["rid", "pos"]).select(
        "rid", "n", "pos", "h", F.col("own").alias("name"), "variants")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                 block_bytes: int = BLOCK_BYTES, hash_of=F.xxhash64, rid: str | None = None) -> DataFrame:
    """One row per row of ``docs``: rid, doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z only; null counts as
    empty. Of equal texts the row with the largest id stays (of rows that also
    share the id, the last one); a null id is smaller than any. An empty table
    gives an empty result; other columns are not read, whatever their names. ``rid``: see ``source_rows``."""
    rows = saved(block_identity(docs, text, block_bytes, hash_of, carry=(id_col,), rid=rid)
                 .withColumnRenamed(id_col, "doc_id"), "block-identity")
    # a table of its own, so that the join below has two plain sides and a large group can be split
    best = saved(rows.groupBy("level", "name").agg(F.max(F.struct("doc_id", "rid")).alias("best"),
                                                   F.count(F.lit(1)).alias("group_size")), "block-groups")
    return rows.join(best, ["level", "name"]).select(
        "rid", "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("best.rid")).alias("kept"), "text_sha256")
