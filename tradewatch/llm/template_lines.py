"""Line deduplication by a log-template tree of fixed depth.

A line is parsed into tokens; tokens with a digit are variable fields. The
tree's path is the token count, then the first LEADING tokens; the leaf below it
holds the variants of a line (equal but for the fields found so far). Where a leaf has several
variants, those close to a seed variant are instances of one template, and the positions
they differ in are variable fields as well. Close are variants that agree in most of the tokens behind
the leading ones and in a token that is no field. A leaf holds as many templates as it has such families,
each with MIN_DOCS documents. Other variants are templates by themselves.

A template recurs if MIN_DOCS documents hold it, or two where it is one variant of LONG fixed tokens or
more. Its lines are dropped, but for the ones in the document with the smallest id, so that no text is lost
altogether where whole documents are copies. Lines of fields only are nobody's template and stay.

Scale: lines move as hashes, texts never do. They are read twice: for the hashes of all lines, then
for the tokens of lines whose leaf has several variants, told by a bitmap of fixed size.
Counts are aggregated before each shuffle by (variant, document), so a line that a
third of all documents hold is never in one task; lookups are sort-merge joins,
which adaptive execution splits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.llm.common import numbered, saved

LEADING = 4
MIN_DOCS = 3
LONG = 10
CLOSE = 0.6  # share of the tokens behind the leading ones that agree with the seed
BITS = 25  # leaves are looked up in a bitmap of so many address bits; what it lets pass by chance is joined away
SEEN = 200_000  # bounds memory only: variants a task remembers to have sent
CELL = ["leaf", "pos", "tok"]
_DIGIT = regex.compile(rb"[0-9]")
_FIELD = regex.compile(rb"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*")


def tokens(line: str) -> list[bytes]:
    """Words of a line; those with a digit become a field."""
    raw = line.encode("utf-8", "surrogatepass")
    if _DIGIT.search(raw):
        raw = _FIELD.sub(b"<*>", raw)
    return raw.split()


def _hash(x: bytes) -> int:
    return xxhash.xxh3_64_intdigest(x) - (1 << 63)


def leaf_and_variant(t: list[bytes]) -> tuple[int, int]:
    return _hash(b"%d " % len(t) + b" ".join(t[:LEADING])), _hash(b" ".join(t))


FIELD = _hash(b"<*>")


def _parse(batches):
    """(rid, line, leaf, variant, long) of every line with a token, and (rid, -1, doc_id) for every text.
    A line of fields only has no leaf and no variant."""
    for batch in batches:
        rid, line, leaf, variant, long, ids = [], [], [], [], [], []
        for n, (r, text) in enumerate(zip(batch.column("rid").to_pylist(), batch.column("text"), strict=True)):
            rows = [(-1, None, None, None)]
            for i, x in enumerate((text.as_py() or "").split("\n")):
                t = tokens(x)
                if t:
                    fixed = len(t) - t.count(b"<*>")
                    rows.append((i, *leaf_and_variant(t), fixed >= LONG) if fixed else (i, None, None, False))
            rid += [r] * len(rows)
            ids += [n] + [None] * (len(rows) - 1)
            for to, values in zip((line, leaf, variant, long), zip(*rows, strict=True), strict=True):
                to += values
        yield pa.RecordBatch.from_arrays(
            [pa.array(rid, pa.int64()), pa.array(line, pa.int32()), pa.array(leaf, pa.int64()), pa.array(variant, pa.int64()), pa.array(long, pa.bool_()),
             batch.column("doc_id").take(pa.array(ids, pa.int64()))],
            names=["rid", "line", "leaf", "variant", "long", "doc_id"])


def _variant_tokens(bitmap):
    """Token hashes of lines whose leaf is in the bitmap; a task sends a variant once, as far as it remembers."""
    def run(batches):
        bits, seen = bitmap.value, set()
        for batch in batches:
            leaf, variant, toks = [], [], []
            for text in batch.column("text"):
                for x in (text.as_py() or "").split("\n"):
                    t = tokens(x)
                    if len(t) <= LEADING:
                        continue
                    a, b = leaf_and_variant(t)
                    at = a & ((1 << BITS) - 1)
                    if bits[at >> 3] >> (at & 7) & 1 and b not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(b)
                        leaf.append(a)
                        variant.append(b)
                        toks.append(np.array([_hash(w) for w in t], np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf, pa.int64()), pa.array(variant, pa.int64()), pa.array(toks, pa.list_(pa.int64()))], names=["leaf", "variant", "toks"])
    return run


def _bitmap(leaves: DataFrame) -> np.ndarray:
    """A bit for every leaf: 2^BITS bits, whatever their number."""
    words = leaves.select(F.expr(f"(leaf & {(1 << BITS) - 1}) DIV 32").alias("w"), F.expr(f"shiftleft(1L, cast((leaf & {(1 << BITS) - 1}) % 32 AS INT))").alias("b"))
    got, out = words.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow(), np.zeros(1 << (BITS - 5), "<u4")
    out[got["w"].to_numpy()] = got["b"].to_numpy()
    return out.view(np.uint8)


def _instances(src: DataFrame, variants: DataFrame, min_docs: int) -> DataFrame:
    """leaf, variant, template: the variants that are instances of a template of several.

    A leaf can have many. Each round finds, in all leaves at once, the variants that agree with a seed,
    the highest-ranked among its like; they and the seed are a template if they have ``min_docs`` documents.
    The rest goes to the next round, until no two agree."""
    leaves = variants.groupBy("leaf").agg(F.count(F.lit(1)).alias("k"), F.sum("docs").alias("all_docs"))
    leaves = saved(leaves.filter((F.col("k") > 1) & (F.col("all_docs") >= min_docs)).select("leaf"), "template-leaves")
    sent = src.sparkSession.sparkContext.broadcast(_bitmap(leaves))
    toks = saved(src.select("text").mapInArrow(_variant_tokens(sent), "leaf long, variant long, toks array<long>"), "template-tokens")
    asked = saved(variants.join(leaves, "leaf", "left_semi").select("leaf", "variant", "docs"), "template-asked")
    rows = saved(toks.join(asked, ["leaf", "variant"]).groupBy("leaf", "variant").agg(  # a row from each task
        F.first("docs").alias("docs"), F.first("toks").alias("toks")), "template-variants")
    left, found = rows, None
    while True:
        links = _seed_links(left, rows)
        if links.isEmpty():
            break
        below = links.select("leaf", F.col("variant").alias("head")).distinct()
        seeds = saved(links.select("leaf", "head").distinct().join(below, ["leaf", "head"], "left_anti"), "template-seeds")
        near = links.join(seeds, ["leaf", "head"]).groupBy("leaf", "variant").agg(F.max(F.struct("hw", "head"))["head"].alias("template"))
        seeds = seeds.select("leaf", F.col("head").alias("variant"), F.col("head").alias("template"))
        group = saved(near.unionByName(seeds).join(rows.select("leaf", "variant", "docs"), ["leaf", "variant"]), "template-groups")
        enough = saved(group.groupBy("leaf", "template").agg(F.sum("docs").alias("s")).filter(F.col("s") >= min_docs).select("leaf", "template"), "templates")
        done = saved(group.join(enough, ["leaf", "template"]).select("leaf", "variant", "template"), "template-members")
        found = done if found is None else found.unionByName(done)
        # a seed without enough documents is a template by itself; the variants near it may be near another
        gone = saved(done.select("leaf", "variant").unionByName(seeds.select("leaf", "variant")).distinct(), "template-gone")
        left = saved(left.join(gone, ["leaf", "variant"], "left_anti"), "template-left")
    return rows.limit(0).select("leaf", "variant", F.col("variant").alias("template")) if found is None else found


def _ranked(left: DataFrame) -> DataFrame:
    """leaf, pos, tok, variant, w: the cells in which the variants left meet, and the rank of each.

    Variants meet in the cells (position, token) of their leaf behind the leading tokens. Two that agree in k of m
    positions share one of their m - k + 1 rarest cells each, so only those are kept. Where all leading tokens are fields,
    close variants share a cell that is no field: there cells of fields come last, and none is kept. The rank
    is the number of variants met in all cells, so a line that many documents hold weighs as one."""
    m = F.greatest(F.size("toks") - LEADING, F.lit(0))
    bare = F.forall(F.slice("toks", 1, LEADING), lambda x: x == FIELD)
    cells = saved(left.select("leaf", "variant", m.alias("m"), bare.alias("bare"), F.posexplode(F.slice("toks", LEADING + 1, m)).alias("pos", "tok")), "template-cells")
    sizes = saved(cells.groupBy(*CELL).agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "template-cell-sizes")
    cells = saved(cells.join(sizes, CELL), "template-shared-cells")  # a cell of one variant is rarer than these
    own, field = Window.partitionBy("leaf", "variant"), F.col("bare") & (F.col("tok") == FIELD)
    place = F.col("m") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy(field, "c", "pos", "tok"))
    ranked = cells.select(*CELL, "variant", F.sum("c").over(own).alias("w"), place.alias("place"), field.alias("field"),
                          (F.col("m") - F.ceil(CLOSE * F.col("m")) + 1).alias("rarest"))
    return saved(ranked.filter("place <= rarest AND NOT field").select(*CELL, "variant", "w"), "template-ranked")


def _seed_links(left: DataFrame, rows: DataFrame) -> DataFrame:
    """leaf, variant, head, hw: the links of the variants left that tell the seeds and who is close to them.

    Every variant is compared with the highest-ranked one, the head, of each of its cells. One that is close to a head is no
    seed. Only the others, a few in a family of any size, are compared with all in those of their cells that another heads.
    So no link of a seed is left out; of links between two that are no seeds enough are found to tell that."""
    ranked = _ranked(left)
    heads = ranked.groupBy(*CELL).agg(F.count(F.lit(1)).alias("c"), F.max(F.struct("w", "variant")).alias("top")).filter("c > 1")
    heads = saved(heads.select(*CELL, F.col("top.w").alias("hw"), F.col("top.variant").alias("head")), "template-heads")
    led = saved(ranked.join(heads, CELL).filter("head != variant"), "template-led")
    links = _close(led.select("leaf", "variant", "head", "hw"), rows)
    rest = saved(led.join(links.select("leaf", "variant").distinct(), ["leaf", "variant"], "left_anti").select(*CELL, "variant", "w"), "template-rest")
    return links.unionByName(_links(left, rows, ranked, rest))


def _links(left: DataFrame, rows: DataFrame, ranked: DataFrame | None = None, asked: DataFrame | None = None) -> DataFrame:
    """leaf, variant, head, hw: every variant left with every higher-ranked one it is close to; with ``asked``
    only those that meet in its cells, one of the two being the variant asked for."""
    ranked = _ranked(left) if ranked is None else ranked
    met = (ranked if asked is None else asked).join(ranked.select(*CELL, F.col("variant").alias("other"), F.col("w").alias("ow")), CELL)
    up = F.expr("ow > w OR ow = w AND other > variant")
    lower, higher = F.when(up, F.col("variant")).otherwise(F.col("other")), F.when(up, F.col("other")).otherwise(F.col("variant"))
    return _close(met.filter("other != variant").select("leaf", lower.alias("variant"), higher.alias("head"), F.greatest("w", "ow").alias("hw")), rows)


def _close(met: DataFrame, rows: DataFrame) -> DataFrame:
    """leaf, variant, head, hw: the pairs that met and are close."""
    pairs = saved(met.distinct(), "template-pairs")
    toks = rows.select("leaf", "variant", "toks")
    pairs = pairs.join(toks, ["leaf", "variant"]).join(toks.select("leaf", F.col("variant").alias("head"), F.col("toks").alias("ht")), ["leaf", "head"])
    agree = F.zip_with("toks", "ht", lambda x, y: F.when(x == y, x))
    same = F.size(F.array_compact(F.slice(agree, LEADING + 1, F.greatest(F.size("toks") - LEADING, F.lit(0)))))
    fixed = F.exists(agree, lambda x: x != FIELD)
    close = (same >= CLOSE * (F.size("toks") - LEADING)) & F.coalesce(fixed, F.lit(False))
    return saved(pairs.filter(close).select("leaf", "variant", "head", "hw"), "template-links")


def line_verdicts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS,
                  rid: str | None = None) -> DataFrame:
    """One row per row of ``docs``: rid, doc_id, n_lines (with a token), n_recurring,
    dropped: the sorted places (from 0) of the lines to drop.

    Lines are split at \\n. A null or blank text has no lines. Of rows that share an id
    the first counts as smaller; a null id is larger than any. An empty table gives an empty
    result; other columns are not read, whatever their names. ``rid`` names the column of a
    ``numbered`` table that has the row number; without it rows are numbered here, in one scan."""
    number = F.col(rid) if rid else F.monotonically_increasing_id()
    src = docs.select(number.alias("rid"), F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    parsed = saved(src.mapInArrow(_parse, f"rid long, line int, leaf long, variant long, long boolean, doc_id {dict(src.dtypes)['doc_id']}"), "lines")
    ids, every = parsed.filter("line < 0").select("rid", "doc_id"), parsed.filter("line >= 0")
    lines = every.filter("variant IS NOT NULL").select("rid", "line", "leaf", "variant", "long")
    once = lines.groupBy("leaf", "variant", "rid").agg(F.max("long").alias("long"))
    variants = saved(once.groupBy("leaf", "variant").agg(F.count(F.lit(1)).alias("docs")), "line-variants")
    instances = saved(_instances(src, variants, min_docs), "template-instances")
    # the template of a line is named by its seed, or by its own variant
    placed = saved(lines.join(instances, ["leaf", "variant"], "left").select(
        "rid", "line", "leaf", F.coalesce("template", "variant").alias("template"),
        (F.col("template").isNull() & F.col("long")).alias("long")), "line-templates")
    held = placed.groupBy("leaf", "template", "rid").agg(F.max("long").alias("long"))
    enough = (F.col("n") >= min_docs) | F.col("long") & (F.col("n") >= min(min_docs, 2))
    often = saved(held.groupBy("leaf", "template").agg(F.count(F.lit(1)).alias("n"), F.max("long").alias("long")).filter(enough).select(
        "leaf", "template"), "recurring")
    hits = saved(placed.drop("long").join(often, ["leaf", "template"]).join(ids, "rid"), "recurring-lines")
    first = saved(hits.groupBy("leaf", "template").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "rid"))["rid"].alias("first")), "first-holders")
    found = hits.join(first, ["leaf", "template"]).groupBy("rid").agg(  # lines of one text
        F.count(F.lit(1)).alias("n_recurring"), F.sort_array(F.collect_list(F.when(F.col("rid") != F.col("first"), F.col("line")))).alias("dropped"))
    counts = every.groupBy("rid").agg(F.count(F.lit(1)).alias("n_lines"))
    return ids.join(counts, "rid", "left").join(found, "rid", "left").select(
        "rid", "doc_id", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("n_recurring", F.lit(0)).alias("n_recurring"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))


def without_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the recurring lines taken out of the text; null stays null."""
    rows = numbered(docs)
    kept = line_verdicts(rows, id_col, text, min_docs, "__rid").select(F.col("rid").alias("__rid"), F.col("dropped").alias("__dropped"))
    rows = rows.join(kept, "__rid")
    line = F.filter(F.split(F.col(text), "\n"), lambda x, i: ~F.array_contains(F.col("__dropped"), i))
    clean = F.when(F.size("__dropped") > 0, F.array_join(line, "\n")).otherwise(F.col(text))
    return rows.withColumn(text, clean).select(*docs.columns)
