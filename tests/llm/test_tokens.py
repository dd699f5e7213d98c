"""Encoding, decoding and edit-aware counts against the tokenizers library."""

import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tradewatch.llm import trie_bpe
from tradewatch.llm.edit_counts import CountTree, Counts, edit_counts, redactions
from tradewatch.llm.trie_bpe import TrieBpe, encoded

from .conftest import EDGE, prose, rows

VOCAB = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(VOCAB)
PLAIN = Tokenizer.from_file(VOCAB)
PLAIN.encode_special_tokens = True
with open(VOCAB, encoding="utf-8") as _f:
    CODER = TrieBpe(_f.read())


def check(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    n, ids_sha, back_sha, ids = CODER.digest(CODER.pieces(text), True)
    assert ids == want and n == len(want) and CODER.decode(ids) == text
    assert ids_sha == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
    assert back_sha == hashlib.sha256(LIBRARY.decode(want, skip_special_tokens=False).encode()).hexdigest()


@given(st.text(alphabet="ab the'lrevsdmt\t\n\r \x1c\x85\xa0 ​　é中🙂½²09.,<|endoftext>", max_size=60))
@settings(max_examples=300, deadline=None)
def test_encodes_as_the_library(text):
    check(text)


def test_special_strings_and_long_words(monkeypatch):
    for t in ["<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "", "x" * 5000, "=-" * 900, "\n" * 99 + "a", prose(1, 3000)]:
        check(t)
    monkeypatch.setattr(trie_bpe, "CHUNK_CHARS", 50)  # texts in runs, and a cache that empties
    monkeypatch.setattr(trie_bpe, "CHUNK_WORDS", 7)
    monkeypatch.setattr(trie_bpe, "CACHE_WORDS", 20)
    check(prose(2, 400) + "<|endoftext|>" + prose(3, 100) + "  \n x")


def test_op_rows(stored):
    data = EDGE + [(40, "a<|endoftext|>b")]
    got = encoded(stored(rows(*data)), VOCAB, with_ids=True).collect()
    want = sorted(str((i, LIBRARY.encode(t or "", add_special_tokens=False).ids)) for i, t in data)
    assert sorted(str((r.doc_id, r.ids)) for r in got) == want
    assert {r.ids_sha256 for r in got if not r.n_tokens} == {hashlib.sha256(b"").hexdigest()}
    assert encoded(stored([], "none"), VOCAB).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_counts_follow_edits(seed):
    r = random.Random(seed)
    alphabet, counts = "ab cd  \t\n'lrve s012,!é中", Counts(CODER)
    for size in (0, 1, 30, 3000):
        text = "".join(r.choice(alphabet) for _ in range(size))
        tree = CountTree(text, counts)
        for _ in range(15):
            a = r.randint(0, len(text))
            b = min(len(text), a + r.choice([0, 0, 1, 3, 80]))
            new = "".join(r.choice(alphabet) for _ in range(r.choice([0, 1, 2, 9])))
            tree.edit(a, b, new)
            text = text[:a] + new + text[b:]
            assert tree.text == text and tree.total == len(PLAIN.encode(text, add_special_tokens=False).ids)
        if size == 3000:
            assert tree.encoded < 1000  # not the whole text, fifteen times


def test_edit_counts(stored):
    text = prose(4, 200) + " mail ann.b@site.example.com or 10.1.2.3, card 4111111111111111. " + prose(5, 200)
    data = EDGE + [(60, text), (61, "a@b.c"), (62, "<|endoftext|>")]
    got = {}
    for r in edit_counts(stored(rows(*data)), VOCAB).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, t in data:
        t = t or ""
        new = t
        for a, b, x in reversed(redactions(t)):
            new = new[:a] + x + new[b:]
        sizes = {(r.n_tokens, r.n_tokens_after, r.n_edits) for r in got[i]}
        assert (len(PLAIN.encode(t, add_special_tokens=False).ids), len(PLAIN.encode(new, add_special_tokens=False).ids), len(redactions(t))) in sizes
    assert got[60][0].n_edits == 3 and got[60][0].n_encoded_again < 80
    assert edit_counts(stored([], "none"), VOCAB).count() == 0
