"""Line-first quality rules, in DataFrame operations.

Each line is judged alone: navigation (with separators, or an item a line), no sentence
punctuation in a short line, symbols and shouting in place of
it, boilerplate, repeats of an earlier line. Failing lines are removed; a document goes if a base
rule rejects it (too few words, too much repeated wording) or if it loses too
much of its text with its lines.

Everything is computed inside the row, so nothing is shuffled and a hot
source costs no more than its share. Repeated wording is found by sorting the document's
own 3-word windows, which is n log n in its length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import SPACES

SYMBOL = "[#*$%&|<>]"
BOILERPLATE = (r"(?i)\b(all rights reserved|cookies?|privacy policy|terms of (use|service)|licen[sc]ed under"
               r"|released under the|subscribe|sign in|log in|click here)\b")


# How a line that is part of prose ends: a mark, a closing bracket or quote.
ENDED = r"[.!?:;,…\"')\]»”][\x20\x09-\x0D]*$"


@dataclass(frozen=True)
class LineRules:
    min_words: int = 50
    max_repeat_pct: int = 50
    item_words: int = 4  # a line of so few words without an end mark is a menu item or a label
    separators_per_word: float = 0.2  # " | " and " > " between words: navigation
    symbols_per_word: float = 0.5
    shouts_per_word: float = 0.5  # "!" in place of sentence punctuation
    boilerplate_words: int = 20  # a longer line that mentions such a phrase is prose
    max_loss_pct: int = 50  # of the words, with the removed lines


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows found twice or more, the first included. Windows are sorted by
    hash, then by their words, so equal ones are neighbours and no collision counts."""
    def count(w):
        n = F.size(w)
        win = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(
            F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"),
            F.get(w, i).alias("a"), F.get(w, i + 1).alias("b"), F.get(w, i + 2).alias("c"), i.alias("i")))

        def same(x, y):
            return (x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

        def places(s):
            near = F.filter(s, lambda x, j: F.coalesce((j > 0) & same(F.get(s, F.greatest(j - 1, F.lit(0))), x), F.lit(False))
                            | F.coalesce(same(F.get(s, j + 1), x), F.lit(False)))
            return F.sort_array(F.transform(near, lambda x: x["i"]))

        def covered(p):  # a window covers three words, less those the next one covers
            return F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))),
                               F.lit(0).cast("long"), lambda a, x: a + x)

        return F.when(n < 3, F.lit(0).cast("long")).otherwise(_once(F.sort_array(win), lambda s: _once(places(s), covered)))

    return _once(words, count)


def _line(line: Column, r: LineRules) -> Column:
    """Words of a line, and whether it fails for its own content."""
    return _once(F.size(_words(line)), lambda n: F.struct(n.alias("n"), (
        (F.regexp_count(line, F.lit(r" [|>»] ")) >= F.greatest(F.lit(3), n * r.separators_per_word))
        | (F.regexp_count(line, F.lit(SYMBOL)) > n * r.symbols_per_word)
        | (F.regexp_count(line, F.lit("!")) > n * r.shouts_per_word)
        | ((n <= r.item_words) & ~line.rlike(ENDED))
        | ((n <= r.boilerplate_words) & line.rlike(BOILERPLATE))).alias("bad")))


def judged(docs: DataFrame, id_col: str = "doc_id", text: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, kept_words, base_failed, kept, cleaned_sha256 (of the
    text without its failing lines, as ``cleaned`` gives it).

    A null text has no words. Lines without a word count for nothing. An empty
    table gives an empty result; other columns are not read, whatever their names."""
    t = F.coalesce(F.col(text), F.lit(""))
    n, rep, left = F.col("m.w.n"), F.col("m.w.rep"), F.col("m.l.left")
    base = (n < rules.min_words) | (100 * rep > rules.max_repeat_pct * n)
    return docs.select(F.col(id_col).alias("doc_id"), _measures(t, rules, True).alias("m")).select(
        "doc_id", n.alias("n_words"), F.col("m.w.chars").alias("word_chars"), F.col("m.symbols").alias("n_symbols"),
        F.col("m.l.dup").alias("n_dup_lines"), rep.alias("n_repeat_words"), left.alias("kept_words"),
        base.alias("base_failed"), (~base & (100 * (n - left) <= rules.max_loss_pct * n)).alias("kept"),
        F.sha2(F.col("m.l.text"), 256).alias("cleaned_sha256"))


def keeps(text: Column, rules: LineRules = LineRules()) -> Column:
    """The verdict on a text as one condition."""
    return _once(_measures(F.coalesce(text, F.lit("")), rules), lambda m: (
        (m["w"]["n"] >= rules.min_words) & (100 * m["w"]["rep"] <= rules.max_repeat_pct * m["w"]["n"])
        & (100 * (m["w"]["n"] - m["l"]["left"]) <= rules.max_loss_pct * m["w"]["n"])))


def cleaned(text: Column, rules: LineRules = LineRules()) -> Column:
    """The text without failing lines, repeats of earlier lines and lines
    without a word. Null gives an empty text."""
    ok = F.filter(F.array_distinct(F.split(F.coalesce(text, F.lit("")), "\n")),
                  lambda v: v.rlike(r"[^\x20\x09-\x0D]") & ~_line(v, rules)["bad"])
    return F.array_join(ok, "\n")


def _measures(t: Column, r: LineRules, with_text: bool = False) -> Column:
    def lines(x):
        return F.filter(F.split(x, "\n"), lambda v: v.rlike(r"[^\x20\x09-\x0D]"))

    return _once(t, lambda x: F.struct(
        _once(_words(x), lambda w: F.struct(
            F.size(w).cast("long").alias("n"), F.char_length(F.array_join(w, "")).cast("long").alias("chars"),
            _repeat_words(w).alias("rep"))).alias("w"),
        F.regexp_count(x, F.lit(SYMBOL)).cast("long").alias("symbols"),
        _once(lines(x), lambda v: _once(F.array_distinct(v), lambda d: _once(F.transform(d, lambda y: _line(y, r)), lambda j: F.struct(
            (F.size(v) - F.size(d)).cast("long").alias("dup"),
            F.aggregate(j, F.lit(0).cast("long"), lambda a, y: a + F.when(y["bad"], 0).otherwise(y["n"])).alias("left"),
            *([F.array_join(F.filter(d, lambda y, i: ~F.get(j, i)["bad"]), "\n").alias("text")] if with_text else []))))).alias("l")))
