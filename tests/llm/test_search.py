"""Hard negatives and benchmark passages against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from tradewatch.llm import slot_negatives
from tradewatch.llm.positional_index import contamination
from tradewatch.llm.slot_negatives import hard_negatives, products

from .conftest import EDGE, prose, rows

VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
    *[T.StructField(c, T.StringType()) for c in ("rid", "v", "score", "slot", "anchor", "block", "lower", "upper", "rank", "c")]])


def vectors(spark, data):
    return spark.createDataFrame([(*r, *["clash"] * 10) for r in data], VECTORS)


def brute_negatives(data, every=100, positives=5, k=10):
    rows = []
    for i, (vid, v, lab) in enumerate(data):
        if vid is None or v is None or lab is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        rows.append((i, vid, [math.floor(256 * float(np.float32(x))) for x in v], math.fmod(lab + 1, 10) if vid % 7 == 0 else lab))
    out = []
    for i, vid, v, lab in rows:
        if vid % every:
            continue
        ranked = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), wid, j, wl) for j, wid, w, wl in rows if j != i)
        for s, pid, _, _ in [r for r in ranked if r[3] == lab][:positives]:
            found = [r for r in ranked if r[3] != lab and -30 * s <= -100 * r[0] <= -90 * s][:k]
            out += [(vid, pid, n + 1, r[1], -s, -r[0]) for n, r in enumerate(found)]
    return sorted(out)


def drawn(seed, n, dims=6, labels=4):
    r = random.Random(seed)
    return [(i, [r.choice([-.5, -.25, 0., .125, .25, .5, .7]) for _ in range(dims)], r.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("seed,n,cells,tile", [(1, 400, 1 << 21, 1 << 21), (2, 700, 12, 64)])
def test_negatives_equal_brute_force(spark, monkeypatch, seed, n, cells, tile):
    """Few distinct components, so scores tie; small blocks and tiles in the second case."""
    monkeypatch.setattr(slot_negatives, "TILE", tile)
    data = drawn(seed, n)
    data += [(100_000 + i, data[100][1], i % 3) for i in range(60)]  # a vector that many rows share
    got = hard_negatives(vectors(spark, data).repartition(5), cells=cells)
    assert sorted(map(tuple, got.collect())) == brute_negatives(data) != []


def test_negatives_on_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = drawn(3, 120, labels=2) + [
        (0, [.5] * 6, 1), (0, [.5] * 6, 1), (100, [.5] * 6, 0), (300, [.1] * 6, 7), (400, [nan] * 6, 1), (500, [.1, None], 1), (600, None, 1),
        (700, [.3] * 6, None), (800, [inf] * 6, 1), (None, [.9] * 6, 1), (900, [], 1), (1000, [.5] * 3, 1), (1100, [.5] * 9, 1), (1200, [0.] * 6, 1), (1300, [-.5] * 6, 1)]
    assert sorted(map(tuple, hard_negatives(vectors(spark, data)).collect())) == brute_negatives(data) != []
    assert hard_negatives(vectors(spark, [])).count() == 0
    assert hard_negatives(vectors(spark, [(1, [.5], 1)])).count() == 0  # no anchor
    assert hard_negatives(vectors(spark, [(100, [.5], 1), (200, [.5], 1)])).count() == 0  # no other label


def test_products_of_large_components():
    a = np.array([[2.0 ** 40, 1.0], [2.0 ** 80, 0.0]])
    assert products(a, a).tolist() == [[2 ** 63 - 1, 2 ** 63 - 1], [2 ** 63 - 1, 2 ** 63 - 1]]
    assert products(np.array([[2.0 ** 30, 1.0]]), np.array([[2.0 ** 30, 1.0]])).tolist() == [[2 ** 60 + 1]]


def item_words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_contamination(docs, items, window=10, slop=2):
    """By looking at every place of every text."""
    texts = [item_words(t) for _, t in docs]
    freq = Counter(w for t in texts for w in t)
    wins = {}
    for i, t in items:
        w = item_words(t)
        for s in range(max(len(w) - window, 0) + 1) if w else ():
            wins.setdefault(tuple(w[s:s + window]), set()).add("" if i is None else str(i))
    out = []
    for (i, _), w in zip(docs, texts, strict=True):
        hit, names, near = set(), set(), set()
        for win, held in wins.items():
            k = len(win)
            for s in range(len(w) - k + 1):
                if tuple(w[s:s + k]) == win:
                    hit |= set(range(s, s + k))
                    names |= held
            if all(x in freq for x in win):
                rare = min(range(k), key=lambda j: (freq[win[j]], j))
                for s in [p - rare for p, x in enumerate(w) if x == win[rare]]:
                    if all(win[j] in w[max(s + j - slop, 0):max(s + j + slop + 1, 0)] for j in range(k)):
                        near |= held
        sha = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(names), sha, bool(hit), len(near - names)))
    return sorted(out, key=str)


def bench(spark, items):
    return spark.createDataFrame([(*r, "clash", "clash") for r in items], "item_id long, text string, term string, wid string")


def planted():
    """Passages of items in texts: whole, cut short, with a word more, in capitals, at both ends, many times."""
    r = random.Random(5)
    texts = [prose(100 + i, 25).split() for i in range(6)]
    items = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(10, "zulu"), (11, "Alpha-q, beta"), (12, " .,! "), (None, prose(300, 12)), (None, prose(301, 12)), (0, prose(302, 11)), (13, "ha " * 14)]
    docs = [(i, prose(i, r.randrange(5, 80))) for i in range(60)]
    for n in range(30):
        t = texts[n % 6]
        a, b = sorted(r.sample(range(26), 2))
        cut = t[a:b]
        if n % 4 == 1 and len(cut) > 4:
            cut.insert(3, "inserted")
        body = [prose(900 + n, r.randrange(30)), "; ".join(cut).upper() if n % 5 == 0 else " ".join(cut), prose(700 + n, r.randrange(30))]
        docs.append((100 + n, " ".join(body)))
    docs += [(200, "ZULU zulu é zulu"), (201, "alpha-q (BETA)"), (202, prose(300, 12) + " " + prose(302, 11)), (203, "ha " * 40), (204, "É" + items[0][1]), (204, items[0][1])]
    near = prose(301, 12).split()
    docs += [(210, " ".join([*near[:6], "inserted", *near[6:]])), (211, " ".join([*near[:5], *near[6:]])), (212, " ".join([*near[:6], *["inserted"] * 3, *near[6:]]))]
    docs += [(1000 + i, " ".join(texts[1])) for i in range(40)]  # a passage that many texts hold
    return docs, items


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_contamination_equals_brute_force(spark, stored, most):
    docs, items = planted()
    docs += EDGE
    got = contamination(stored(rows(*docs)), bench(spark, items), most=most).collect()
    assert sorted(map(tuple, got), key=str) == brute_contamination(docs, items)
    assert {r.n_near for r in got} != {0}


def test_contamination_of_empty_tables(spark, stored):
    docs = stored(rows((1, "alpha beta"), (2, None)))
    assert contamination(stored([], "none"), bench(spark, [(1, "alpha")])).count() == 0
    for items in ([], [(1, None), (2, ""), (3, "...")], [(1, "gamma")]):
        got = contamination(docs, bench(spark, items)).collect()
        assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in got) == [(1, 2, 0, 0, False), (2, 0, 0, 0, False)]


def test_a_planted_passage_in_a_very_long_text(spark, stored):
    long = prose(1, 60_000).split()
    items = [(7, " ".join(long[40_000:40_010])), (8, prose(2, 30))]
    got = contamination(stored(rows((1, " ".join(long)), (2, prose(3, 50)))), bench(spark, items)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in got) == [(1, 60_000, 10, 1), (2, 50, 0, 0)]
