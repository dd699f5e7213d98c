"""Exact and near deduplication against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewatch.llm.block_names import exact_groups
from tradewatch.llm.components import components
from tradewatch.llm.hyperminhash import LEAST_SET, estimate, near_groups, registers
from tradewatch.llm.shingles import WordHashes, shingle_set

from .conftest import EDGE, WORDS, prose, rows


def lower(t):
    return (t or "").encode().lower().decode()


def weak_hash(block):
    return F.pmod(F.xxhash64(block), F.lit(3)).cast("long")


@pytest.mark.parametrize("block_bytes,hash_of", [(4096, F.xxhash64), (16, weak_hash)])
def test_exact_groups(stored, block_bytes, hash_of):
    data = EDGE + [(20 + i, prose(i % 3, 30) + "x" * (i % 2)) for i in range(12)]
    got = exact_groups(stored(rows(*data)), block_bytes=block_bytes, hash_of=hash_of).collect()
    assert len(got) == len(data)
    groups = defaultdict(list)
    for i, t in data:
        groups[hashlib.sha256(lower(t).encode()).hexdigest()].append(i)
    for r in got:
        ids = groups[r.text_sha256]
        best = max((i for i in ids if i is not None), default=None)
        assert r.group_size == len(ids) and r.keep_id == best
    for sha, ids in groups.items():
        kept = [r for r in got if r.text_sha256 == sha and r.kept]
        assert len(kept) == 1 and kept[0].doc_id == max((i for i in ids if i is not None), default=None)


def test_empty_tables(stored):
    empty = stored([])
    assert exact_groups(empty).count() == 0
    assert near_groups(empty).count() == 0


def shingles(t):
    w = lower(t).encode().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(data):
    sets = [shingles(t) for _, t in data]
    root = list(range(len(data)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(data)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    return sets, [find(i) for i in range(len(data))]


def edited(text, n, seed):
    r, w = random.Random(seed), text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = r.choice(WORDS) + "new" + str(r.randrange(1000))
    return " ".join(w)


def near_cases():
    base, data = prose(7, 150), []
    data += [edited(base, k % 7, k) for k in range(40)]  # a group around the threshold
    data += [prose(k, 12) for k in range(5)] + [prose(k, 12) + " tail" for k in range(5)]  # small sets
    data += [prose(99, 60) + " " + prose(200 + k, 60) for k in range(20)]  # a shared passage
    data += ["to to to to to to " * 3 + w for w in WORDS[:6]] + ["a b c", "A b  c", "a b c d"]
    return EDGE + [(100 + i, t) for i, t in enumerate(data)]


def test_near_groups(stored):
    data = near_cases()
    got = near_groups(stored(rows(*data))).collect()
    assert len(got) == len(data)
    sets, root = brute_components(data)
    least = defaultdict(lambda: None)
    for (i, _), r in zip(data, root, strict=True):
        if i is not None:
            least[r] = i if least[r] is None else min(i, least[r])
    want = sorted((str(i), len(s), str(least[r])) for (i, _), s, r in zip(data, sets, root, strict=True))
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == want
    assert sum(r.kept for r in got) == len(set(root))
    assert all(r.doc_id == r.component_id for r in got if r.kept)


def test_small_sets_link(stored):
    """6 shingles against 7 reach 6/7; 5 against 6 stay under the threshold."""
    data = [(10 * k + j, t) for k in range(8) for j, t in enumerate(
        (prose(k, 10), prose(k, 10) + " tail", "front " + prose(k, 10), prose(50 + k, 9), prose(50 + k, 9) + " tail"))]
    got = {r.doc_id: r.component_id for r in near_groups(stored(rows(*data))).collect()}
    assert got == {10 * k + j: 10 * k + (0 if j < 3 else j) for k in range(8) for j in range(5)}


def test_shingle_hashes_do_not_collide_on_two_words():
    words = WordHashes()
    r = random.Random(3)
    for _ in range(50):
        t = " ".join(r.choice("ab") for _ in range(200))
        assert len(shingle_set(t, words)) == len(shingles(t))


@pytest.mark.parametrize("n,j", [(LEAST_SET + 1, 0.875), (40, 0.85), (2000, 0.85)])
def test_registers_agree_as_the_sets(n, j):
    r = np.random.default_rng(n)
    near, shared = [], 0
    for _ in range(200):
        u = np.unique(r.integers(0, 2 ** 64, n, np.uint64))
        k = round(j * len(u))
        half = (len(u) - k + 1) // 2
        a, b = np.unique(u[r.permutation(len(u))[:0]]), u
        order = r.permutation(len(u))
        a, b = np.sort(u[order[:k + half]]), np.sort(np.r_[u[order[:k]], u[order[k + half:]]])
        x, y = registers(a), registers(b)
        near.append(float(estimate(x, y, len(a), len(b))))
        shared += bool((x.view(np.int64) == y.view(np.int64)).any())
    assert abs(np.mean(near) - k / len(u)) < 0.02
    assert shared == 200


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 9), (9, 8), (20, 21), (21, 20), (5, 5)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 8: 8, 9: 8, 10: 8, 20: 20, 21: 20} | {100 + i: 100 for i in range(41)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
