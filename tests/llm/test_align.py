"""Cross-tokenizer groups against the libraries and brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tradewatch.llm import fragment_align
from tradewatch.llm.fragment_align import Aligner, aligned, composed, ranges
from tradewatch.llm.trie_bpe import _byte_chars

from .conftest import EDGE, prose, rows

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TOKENS = Tokenizer.from_file(A)
TOKENS.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=B)
with open(A, encoding="utf-8") as _a, open(B, "rb") as _b:
    ALIGNER = Aligner(_a.read(), _b.read())
CHARS = _byte_chars()


def a_bytes(i):
    return bytes(CHARS[c] for c in TOKENS.id_to_token(i))


def b_bytes(i):
    p = PIECES.id_to_piece(i)
    return bytes([int(p[3:5], 16)]) if PIECES.is_byte(i) else p.replace("▁", " ").encode()


def brute_links(text):
    """Ids of both libraries, groups, and links by comparing all byte ranges; None where the bytes differ."""
    if not text:
        return None
    a, b = TOKENS.encode(" " + text, add_special_tokens=False).ids, PIECES.encode(text)
    want = (" " + text).encode()
    if b"".join(map(a_bytes, a)) != want or b"".join(map(b_bytes, b)) != want:
        return None
    spans = []
    for ids, size in ((a, a_bytes), (b, b_bytes)):
        at, out = 0, []
        for i in ids:
            out.append((i, at, at + len(size(i))))
            at = out[-1][2]
        spans.append(out)
    common = sorted({x[2] for x in spans[0]} & {x[2] for x in spans[1]})
    groups, low = [], 0
    for end in common:
        groups.append("|".join(",".join(str(i) for i, s, e in x if low <= s and e <= end) for x in spans))
        low = end
    links = [(i, j) for i, s, e in spans[0] for j, u, v in spans[1] if s < v and u < e]
    return len(a), len(b), groups, links


def brute_rows(data):
    found = [(i, brute_links(t)) for i, t in data]
    count = Counter(x for _, f in found if f for x in f[3])
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for i, f in found:
        if not f:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        out.append((i, n_a, n_b, len(groups), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=str)


ALPHABET = "ab the'lrevsdmt\t\n\r \x1c\x85\xa0 ​　é中文字🙂½²09.,;{}<0x41>|▁s/endoftext"


@given(st.text(alphabet=ALPHABET, min_size=1, max_size=60))
@settings(max_examples=400, deadline=None)
def test_units_encode_as_the_libraries(text):
    units = ALIGNER.units(" " + text)
    assert "".join(units) == " " + text
    want = brute_links(text)
    assert ("▁" in text) == (want is None)
    if want:
        cuts = {u: ALIGNER.tokens(u) for u in set(units)}
        assert [i for u in units for i in cuts[u][0].ids] == TOKENS.encode(" " + text, add_special_tokens=False).ids
        assert [i for u in units for i in cuts[u][1].ids] == PIECES.encode(text)
        ALIGNER.infos.clear()
        ALIGNER.known(set(units) | {" and", "\n\tothers"})
        infos = [ALIGNER.infos[u] for u in units]
        assert all(x[1:4] == (len(cuts[u][0].ids), len(cuts[u][1].ids), x[0].count(";") + 1) for u, x in zip(units, infos, strict=True))
        assert ";".join(x[0] for x in infos) == ";".join(want[2])
        assert sorted(p for x in infos for p in x[4].tolist()) == sorted(a << fragment_align.PAIR | b for a, b in want[3])


@given(st.text(alphabet=ALPHABET.replace("▁", ""), min_size=1, max_size=200), st.integers(1, 30))
@settings(max_examples=400, deadline=None)
def test_ranges_cover_a_text_once(text, chunk):
    """The tokens of all ranges, open ones included, are the text's."""
    found, a, b, bytes_before = list(ranges(" " + text, ALIGNER, chunk)), 0, 0, 0
    for no, (part, low, high) in enumerate(found):
        units, (closed, prefix, suffix) = ALIGNER.fragment(part, low, high, no == 0)
        ALIGNER.known({u for u in units if isinstance(u, str)})
        infos = [ALIGNER.infos[u] if isinstance(u, str) else u[0] for u in units]
        a += sum(x[1] for x in infos) + len(prefix[0]) + len(suffix[0])
        b += sum(x[2] for x in infos) + len(prefix[1]) + len(suffix[1])
        assert closed or not units and suffix == ([], [])
        bytes_before += high - low
    assert bytes_before == len((" " + text).encode())
    assert (a, b) == (len(TOKENS.encode(" " + text, add_special_tokens=False).ids), len(PIECES.encode(text)))


def samples():
    r = random.Random(8)
    data = EDGE[:9] + [(20 + n, "".join(r.choice(ALPHABET.replace("▁", "")) for _ in range(r.randrange(1, 300)))) for n in range(60)]
    data += [(100 + n, prose(n % 7, r.randrange(3, 120))) for n in range(30)]  # some texts repeat
    data += [(200, "a▁b"), (201, "▁" * 300), (202, "<|endoftext|> </s> <s>"), (203, "中文字没有空格" * 60), (204, " " * 400), (205, "\n\n\t " * 90), (206, "é" * 500), (206, "é" * 500), (207, "🙂" * 200)]
    return data


@pytest.mark.parametrize("chunk,block", [(1 << 16, 1 << 22), (50, 400), (7, 100)])
def test_rows_equal_brute_force(stored, chunk, block):
    data = samples()
    got = aligned(stored(rows(*data)), A, B, chunk=chunk, block_chars=block).collect()
    assert sorted(map(tuple, got), key=str) == brute_rows(data)


def test_empty_tables(stored):
    assert aligned(stored([], "none"), A, B).count() == 0
    got = aligned(stored(rows((1, None), (2, ""), (None, "▁"))), A, B).collect()
    assert sorted(map(tuple, got), key=str) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")]


def test_composition_is_associative(spark):
    """Any number of fragments, open ones among them, gives the seams of composing them one by one."""
    r, data, want = random.Random(3), [], {}
    for rid in range(40):
        n, token = r.randrange(1, 12), iter(range(10_000))
        parts = [(True, [], [], [], [])]
        for _ in range(n):
            some = lambda: [next(token) for _ in range(r.randrange(1, 3))]
            parts.append((False, some(), some(), [], []) if r.random() < .4 else (True, some(), some(), some(), some()))
        parts.append((True, [next(token)], [next(token)], [], []))
        data += [(rid, no, *p) for no, p in enumerate(parts)]
        open_a, open_b, seams = [], [], []
        for no, (closed, pa, pb, sa, sb) in enumerate(parts):
            if closed:
                if open_a + pa:
                    seams.append((2 * no - 1, open_a + pa, open_b + pb))
                open_a, open_b = sa, sb
            else:
                open_a, open_b = open_a + pa, open_b + pb
        want[rid] = seams
    df = spark.createDataFrame(data, "rid long, no long, closed boolean, pa array<int>, pb array<int>, sa array<int>, sb array<int>")
    assert {x.rid: [tuple(s) for s in x.seams] for x in composed(df).collect()} == want
