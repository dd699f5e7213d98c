"""Secret scan: fixed patterns, and a battery of randomness tests with control
of the false-discovery rate.

Candidates are runs of key characters. Each gets an inferred encoding (decimal,
hex, base 32, base 64) and three tests of being drawn evenly from that
alphabet: chi-squared of the symbol counts, the number of runs above and
below the alphabet's middle, and the serial correlation of neighbours. Words of
a language fail them: few letters, few classes, alternating vowels.

A secret is what can be told from words. So the battery is turned round: the
corpus gives, by length, how far words get in it. The p-value of a candidate is the
share of ordinary words of its length class that look at least as random, and
Benjamini-Hochberg per length class decides which candidates stand out. Short
runs need more than long ones, as by chance many short words look random.

Scale: rows are scanned once; what is compared over the corpus are counts by
(length class, score step), a table of fixed size whatever the corpus.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.llm.common import saved, with_rid

# fixed values: the base patterns
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
# texts without one of these hold no assignment
HINTS = ("passw", "secret", "token", "api_key", "apikey")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
WORD = re.compile(r"[^\W\d_]{16,}|[A-Za-z]{8,}(?:[-_/][A-Za-z]+)+")
LENGTHS = (16, 20, 24, 32, 40, 64, 128)  # lower ends of the length classes
STEPS = 64  # steps of the score
RATE = 0.01  # false-discovery rate


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by start, then kind as listed."""
    out = []
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


_ALPHABETS = (("decimal", re.compile(r"\d+"), "0123456789"), ("hex", re.compile(r"[0-9a-f]+|[0-9A-F]+"), "0123456789abcdef"),
              ("base32", re.compile(r"[A-Z2-7]+=*"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
              ("upper", re.compile(r"[A-Z0-9]+"), "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
              ("base64", re.compile(r"[A-Za-z0-9+/_-]+=*"), "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"))


def _normal_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(run: str) -> tuple[str, float, float, float]:
    """Encoding, and the p-values of the uniformity, runs and serial tests."""
    name, symbols = next(((n, s) for n, p, s in _ALPHABETS if p.fullmatch(run)), ("base64", _ALPHABETS[-1][2]))
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    body = body.lower() if name == "hex" else body
    x = np.array([symbols.find(c) for c in body])
    x = x[x >= 0]
    n, k = len(x), len(symbols)
    if n < 2:
        return name, 0.0, 0.0, 0.0
    # symbols in four equal classes beside the counts of single ones: both must look even
    count = np.bincount(x, minlength=k)
    chi = float(((count - n / k) ** 2).sum() * k / n)
    uniform = 0.5 * math.erfc((((chi / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1)))) / math.sqrt(2))
    part = np.bincount(x * 4 // k, minlength=4)
    chi4 = float(((part - n / 4) ** 2).sum() * 4 / n)
    uniform = min(uniform, 0.5 * math.erfc((((chi4 / 3) ** (1 / 3) - (1 - 2 / 27)) / math.sqrt(2 / 27)) / math.sqrt(2)))
    high = x >= k / 2
    a, b = int(high.sum()), int((~high).sum())
    mean, var = 1 + 2 * a * b / n, 2 * a * b * (2 * a * b - n) / (n * n * max(1, n - 1))
    runs = _normal_tail((1 + int((high[1:] != high[:-1]).sum()) - mean) / math.sqrt(var)) if var > 0 else 0.0
    d = x - x.mean()
    power = float((d * d).sum())
    serial = _normal_tail(float((d[1:] * d[:-1]).sum()) / power * math.sqrt(n)) if power else 0.0
    return name, uniform, runs, serial


def score(run: str) -> int:
    """0 to STEPS - 1: how random a run looks, as the log of Fisher's joint p-value
    with the weakest test at its own."""
    _, u, r, s = battery(run)
    p = max(min(u, r, s) * 3, 1e-16)
    return min(STEPS - 1, int((STEPS - 1) * (1 + math.log10(min(1.0, p)) / 16)))


def length_class(n: int) -> int:
    return sum(n >= x for x in LENGTHS) - 1


def _scan(batches):
    for batch in batches:
        base, cand, words = [], [], []
        for text in batch.column("text"):
            t = text.as_py() or ""
            base.append([{"kind": k, "start": a, "end": b} for k, a, b in base_spans(t)])
            found, seen = [], {}
            for m in CANDIDATE.finditer(t):
                run = m.group()
                if WORD.fullmatch(run):
                    key = (length_class(len(run)), score(run))
                    seen[key] = seen.get(key, 0) + 1
                elif run.isascii():
                    found.append({"start": m.start(), "end": m.end(), "cls": length_class(len(run)), "step": score(run)})
            cand.append(found)
            words.append([{"cls": c, "step": s, "n": n} for (c, s), n in seen.items()])
        yield pa.RecordBatch.from_arrays(
            [batch.column("rid"), batch.column("doc_id"), pa.array(base, _SPANS), pa.array(cand, _CANDS), pa.array(words, _WORDS)],
            names=["rid", "doc_id", "base", "cand", "words"])


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_CANDS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("cls", pa.int32()), ("step", pa.int32())]))
_WORDS = pa.list_(pa.struct([("cls", pa.int32()), ("step", pa.int32()), ("n", pa.int64())]))
_SCHEMA = ("rid long, doc_id {id}, base array<struct<kind: string, start: long, end: long>>, "
           "cand array<struct<start: long, end: long, cls: int, step: int>>, words array<struct<cls: int, step: int, n: long>>")


def cutoffs(scanned: DataFrame, rate: float = RATE) -> dict[int, int]:
    """Length class -> the smallest score that Benjamini-Hochberg lets pass. The
    counts compared have at most len(LENGTHS) * STEPS rows, whatever the corpus.

    Longer words look less random than shorter ones, so the words of a class
    and of all shorter ones are its null distribution, which stays on the safe side."""
    words = scanned.select(F.explode("words").alias("w")).groupBy("w.cls", "w.step").agg(F.sum("w.n").alias("words"))
    words = words.withColumn("cls", F.explode(F.sequence(F.col("cls"), F.lit(len(LENGTHS) - 1)))).groupBy("cls", "step").agg(F.sum("words").alias("words"))
    cands = scanned.select(F.explode("cand").alias("c")).groupBy("c.cls", "c.step").agg(F.count(F.lit(1)).alias("cands"))
    both = words.join(cands, ["cls", "step"], "full").fillna(0, ["words", "cands"])
    up = Window.partitionBy("cls").orderBy(F.desc("step"))
    whole = Window.partitionBy("cls")
    p = (F.sum("words").over(up) + 1) / (F.sum("words").over(whole) + 1)  # words at least as random
    t = both.withColumn("p", p).withColumn("k", F.sum("cands").over(up)).withColumn("m", F.sum("cands").over(whole))
    passed = t.filter((F.col("cands") > 0) & (F.col("p") * F.col("m") <= F.lit(rate) * F.col("k")))
    return {r["cls"]: r["least"] for r in passed.groupBy("cls").agg(F.min("step").alias("least")).collect()}


def secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text", rate: float = RATE) -> DataFrame:
    """One row per row of ``docs``: rid, doc_id, and found, the array of (start,
    order, kind, end) of all spans by start, then kind; order is the kind's place.

    The kinds are the fixed patterns and "random", for runs outside of those that pass
    the battery. Offsets count code points, the end exclusive. A null text counts as empty;
    an empty table gives an empty result; other columns are not read, whatever their names."""
    id_type = dict(docs.dtypes)[id_col]
    src = with_rid(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), "rid")
    scanned = saved(src.select("rid", "doc_id", "text").mapInArrow(_scan, _SCHEMA.format(id=id_type)), "secret-spans")
    least = cutoffs(scanned, rate)
    limits = F.array(*[F.lit(least.get(c, STEPS)) for c in range(len(LENGTHS))])
    base = F.transform("base", lambda b: F.struct(
        b["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), b["kind"]).cast("int").alias("order"),
        b["kind"].alias("kind"), b["end"].alias("end")))
    more = F.filter("cand", lambda c: (c["step"] >= F.get(limits, c["cls"])) & ~F.exists(
        F.col("base"), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    more = F.transform(more, lambda c: F.struct(
        c["start"].alias("start"), F.lit(len(KINDS) + 1).alias("order"), F.lit("random").alias("kind"), c["end"].alias("end")))
    return scanned.select("rid", "doc_id", F.sort_array(F.concat(base, more)).alias("found"))


def digest_columns(found: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base kinds, and all spans as text."""
    joined = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("found", lambda s: s["kind"] != "random")
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *map(count, (*KINDS, "random")), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))
