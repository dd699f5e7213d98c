"""Benchmark decontamination by a positional inverted index, in DataFrame operations.

The test items are cut into windows of consecutive words. One scan of the training texts
stores the postings (term, document, place) of the words that any window has. The
terms of a window are ranked by their number of postings. Each posting of the rarest
term, moved back by the term's offset, is a place where the window may start; the list is
intersected with the moved postings of the second rarest term and, for what is left, with
those of all others. A window whose terms all stand at their places is an exact match;
one whose terms all stand within ``slop`` words of them is a proximity match.

Scale: texts are read once and never shuffled. Of a window only the postings of its
rarest term are listed; the second rarest is joined on (document, place, term), so a
frequent word, a long text or a passage that a third of all documents hold spreads over
all tasks. Tables are broadcast only where their size has been counted (``small``); beyond that
the same joins are shuffled, and adaptive execution splits them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.llm.common import ascii_lower, saved

# Words are runs of what stands between these, once A-Z are lower-cased; A-Z are letters here.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
SLOP = 2
END = -1  # the term of a posting that tells a document's number of words
SMALL_BYTES = 32 << 20


def is_small(df: DataFrame, most: int, text: str | None = None) -> bool:
    """Whether the rows of a stored table, counted, are within ``most`` bytes."""
    size = F.count(F.lit(1)) * 40
    if text:
        size = size + F.coalesce(F.sum(F.octet_length(text)), F.lit(0))
    return df.agg(size).first()[0] <= most


def small(df: DataFrame, most: int, text: str | None = None) -> DataFrame:
    """A stored table, marked for broadcast where it is small."""
    return F.broadcast(df) if is_small(df, most, text) else df


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), BETWEEN), lambda w: w != "")


def windows_of(items: DataFrame, item_col: str, text: str, window: int) -> tuple[DataFrame, DataFrame]:
    """The distinct windows (wid, terms), and (wid, item) of every item that has one."""
    words = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                         F.transform(words_of(F.col(text)), ascii_lower).alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    held = saved(words.select("item", F.explode(F.transform(starts, lambda s: F.slice("words", s, window))).alias("terms")).distinct(), "index-held")
    named = saved(held.select("terms").distinct().withColumn("wid", F.monotonically_increasing_id()), "index-windows")
    return named, saved(held.join(named, "terms").select("wid", "item"), "index-items")


def postings_of(docs: DataFrame, id_col: str, text: str, terms: DataFrame, most: int) -> DataFrame:
    """term, rid, pos of the words that are in ``terms`` (word, term), from one scan; and a row
    (END, rid, number of words, doc_id) for every document."""
    words = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    words = words.select("rid", "doc_id", F.posexplode(F.concat(words_of(F.col("text")), F.array(F.lit("")))).alias("pos", "raw"))
    words = words.select("rid", "doc_id", "pos", ascii_lower(F.col("raw")).alias("word"))
    terms = terms.unionByName(terms.sparkSession.range(1).select(F.lit("").alias("word"), F.lit(END).cast("long").alias("term")))
    found = words.withColumn("h", F.xxhash64("word")).join(small(saved(terms.withColumn("h", F.xxhash64("word")), "index-terms"), most, "word"), ["h", "word"])
    return saved(found.select("term", "rid", "pos", F.when(F.col("term") == END, F.col("doc_id")).alias("doc_id")), "index-postings")


def _placed(cand: DataFrame, plan: DataFrame, postings: DataFrame, slop: int, most: int) -> DataFrame:
    """wid, rid, s, bit, d: terms of the candidates (wid, rid, s) that stand d words from their place.
    ``plan`` says which terms are looked for."""
    there = postings.select("rid", "pos", "term")
    for key, of in (("term", plan), ("rid", cand)):  # no more postings than can match, where that costs no shuffle
        wanted = saved(of.select(key).distinct(), "index-wanted")
        there = there.join(F.broadcast(wanted), key, "left_semi") if is_small(wanted, most) else there
    looked = cand.join(plan.select("wid", "off", "term", "bit"), "wid").withColumn("d", F.explode(F.sequence(F.lit(-slop), F.lit(slop))))
    looked = looked.withColumn("pos", F.col("s") + F.col("off") + F.col("d"))
    return looked.join(there, ["rid", "pos", "term"]).select("wid", "rid", "s", "bit", "d")


def matches(postings: DataFrame, windows: DataFrame, terms: DataFrame, slop: int = SLOP, most: int = SMALL_BYTES) -> DataFrame:
    """wid, rid, s, k, exact: the places s (from 0) where windows of k words match, exactly or by proximity."""
    freq = saved(postings.filter(F.col("term") != END).groupBy("term").agg(F.count(F.lit(1)).alias("freq")), "index-frequencies")
    placed = windows.select("wid", F.size("terms").alias("k"), F.posexplode("terms").alias("off", "word")).join(terms, "word").join(freq, "term", "left")
    ranks = Window.partitionBy("wid")  # the words of one window
    plan = saved(placed.select(
        "wid", "k", "off", "term", F.expr("shiftleft(1L, off)").alias("bit"),
        F.row_number().over(ranks.orderBy("freq", "off")).alias("rank"), F.count("freq").over(ranks).alias("known"))
        .filter("known = k").drop("known"), "index-plan")  # a word that no text has: the window is nowhere
    seeds = saved(plan.filter("rank = 1").select("wid", "k", "term", "off", "bit"), "index-seeds")
    cand = saved(postings.join(small(seeds, most), "term").select("wid", "rid", (F.col("pos") - F.col("off")).alias("s"), "k"), "index-starts")
    pairs = _placed(cand.filter("k > 1"), plan.filter("rank = 2"), postings, slop, most)
    left = saved(pairs.select("wid", "rid", "s").distinct(), "index-pairs")
    others = _placed(left, saved(plan.filter("rank > 1").join(left.select("wid").distinct(), "wid", "left_semi"), "index-others"), postings, slop, most)
    stand = others.groupBy("wid", "rid", "s").agg(F.bit_or("bit").alias("near"), F.bit_or(F.when(F.col("d") == 0, F.col("bit"))).alias("there"))
    full = F.expr("shiftleft(1L, k) - 1")
    stand = stand.join(seeds.select("wid", "k", "bit"), "wid").filter(F.col("near").bitwiseOR(F.col("bit")) == full).select(
        "wid", "rid", "s", "k", (F.coalesce("there", F.lit(0)).bitwiseOR(F.col("bit")) == full).alias("exact"))
    return saved(stand.unionByName(cand.filter("k = 1").select("wid", "rid", "s", "k", F.lit(True).alias("exact"))), "index-matches")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, slop: int = SLOP, most: int = SMALL_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit (words inside an exact match), n_items (items with
    an exact match), items_sha256 (their ids, sorted as strings, comma-joined), contaminated (n_hit > 0),
    n_near (items with a proximity match and no exact one).

    A window is ``window`` consecutive words of an item (at most 62); an item of fewer is one window, one without words none.
    Null texts have no words. Items are told apart by id: rows that share one are one item, and a
    null id is the empty string. Rows of ``docs`` that repeat, or share an id, stay apart. An empty table of documents
    gives an empty result, one of items clean documents; other columns are not read, whatever
    their names. ``most`` bounds what is broadcast and never changes the result."""
    windows, held = windows_of(items, item_col, item_text, window)
    terms = saved(windows.select(F.explode("terms").alias("word")).distinct().withColumn("term", F.monotonically_increasing_id()), "index-vocabulary")
    postings = postings_of(docs, id_col, text, terms, most)
    found = matches(postings, windows, terms, slop, most)
    exact = found.filter("exact")
    hit = exact.select("rid", F.explode(F.sequence("s", F.col("s") + F.col("k") - 1)).alias("pos")).distinct()
    hit = saved(hit.groupBy("rid").agg(F.count(F.lit(1)).alias("n_hit")), "index-hits")
    # a table of its own, so that a window that many documents or items have is split
    seen = saved(found.groupBy("rid", "wid").agg(F.bool_or("exact").alias("exact")), "index-seen")
    named = seen.join(held, "wid").groupBy("rid", "item").agg(F.bool_or("exact").alias("exact"))
    named = named.groupBy("rid").agg(  # the items of one document
        F.sort_array(F.collect_list(F.when(F.col("exact"), F.col("item")))).alias("names"), F.count_if(~F.col("exact")).alias("n_near"))
    rows = postings.filter(F.col("term") == END).select("rid", "doc_id", F.col("pos").cast("long").alias("n_words"))
    n_hit, names = F.coalesce("n_hit", F.lit(0)), F.coalesce("names", F.array().cast("array<string>"))
    return rows.join(hit, "rid", "left").join(saved(named, "index-names"), "rid", "left").select(
        "doc_id", "n_words", n_hit.cast("long").alias("n_hit"), F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))
