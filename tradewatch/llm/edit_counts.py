"""Token counts that follow edits.

A text is kept as its pre-tokens with their token counts, in blocks that are
the leaves of a segment tree; every node holds the characters and the tokens below
it. An edit is found by descending the tree. Only the pre-tokens it touches are
split and encoded again, with the boundary context that the pre-tokenizer looks
at; splitting goes on behind the edit until it meets an old boundary, from where the old
pre-tokens hold. The changed leaves are replaced and the sums on their way to the root updated.
"""

from __future__ import annotations

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.trie_bpe import CHUNK_CHARS, WORDS, TrieBpe, loaded

BLOCK = 64  # pre-tokens of a new leaf
CONTEXT = 2  # characters before an edit that a pre-token's end may look at

# edits of the registered query: personal data is replaced by what it is
REDACT = regex.compile(r"(?P<EMAIL>[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)|(?P<IP>\b\d{1,3}(?:\.\d{1,3}){3}\b)|(?P<NUMBER>\b\d{12,19}\b)")


def redactions(text: str) -> list[tuple[int, int, str]]:
    """(start, end, new text) of the edits that replace personal data, from the front."""
    return [(m.start(), m.end(), f"[{m.lastgroup}]") for m in REDACT.finditer(text)]


class CountTree:
    """Pre-tokens of one text under a segment tree of character and token sums."""

    def __init__(self, text: str, counts):
        self.text, self.counts, self.encoded = text, counts, 0
        words = WORDS.findall(text)
        self.width = 1
        while self.width * BLOCK < len(words):
            self.width *= 2
        self.leaves = [words[i * BLOCK:(i + 1) * BLOCK] for i in range(self.width)]
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        n = counts(words)
        for i, leaf in enumerate(self.leaves):
            self._sum(i, n)
        for k in range(self.width - 1, 0, -1):
            self._add(k)

    def _sum(self, i: int, n) -> None:
        self.chars[self.width + i] = sum(map(len, self.leaves[i]))
        self.tokens[self.width + i] = sum(n[w] for w in self.leaves[i])

    def _add(self, k: int) -> None:
        self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
        self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf with the character at ``place`` (or the last one with any), and where it starts."""
        k, start = 1, 0
        while k < self.width:
            k *= 2
            if place >= start + self.chars[k] and self.chars[k + 1]:
                start += self.chars[k]
                k += 1
        return k - self.width, start

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace text[start:end] by ``new``."""
        first, at = self._leaf_at(max(0, start - CONTEXT))
        keep = 0  # pre-tokens of the first leaf that end before the context
        while keep < len(self.leaves[first]) and at + len(self.leaves[first][keep]) < start - CONTEXT + 1:
            at += len(self.leaves[first][keep])
            keep += 1
        self.text = self.text[:start] + new + self.text[end:]
        shift = len(new) - (end - start)
        # old boundaries behind the edit, as places in the new text
        leaf, k, place = first, keep, at
        found, where = [], at
        for m in WORDS.finditer(self.text, at):
            while leaf < self.width and (place + shift < where or place < end):
                if k < len(self.leaves[leaf]):
                    place += len(self.leaves[leaf][k])
                    k += 1
                else:
                    leaf, k = leaf + 1, 0
            if where >= start + len(new) and place >= end and place + shift == where and leaf < self.width:
                break
            found.append(m.group())
            where = m.end()
        else:
            leaf, k = self.width, 0
        self.encoded += len(found)
        last = min(leaf, self.width - 1)
        merged = self.leaves[first][:keep] + found + (self.leaves[leaf][k:] if leaf < self.width else [])
        n = self.counts(merged)
        for i in range(first, last + 1):
            self.leaves[i] = merged if i == first else []
            self._sum(i, n)
        touched = {(self.width + i) // 2 for i in range(first, last + 1)}
        while touched and touched != {0}:
            for node in touched:
                self._add(node)
            touched = {node // 2 for node in touched}


def edit_counts(docs: DataFrame, vocabulary: str, edits=redactions, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens (before), n_edits, n_words (pre-tokens before),
    n_encoded_again, n_tokens_after.

    ``edits`` gives (start, end, new text) of a text, from the front, not overlapping. Strings of special
    tokens count as ordinary text. A null text is empty: no tokens, no edits. An empty table gives an
    empty result; other columns are not read, whatever their names."""
    with open(vocabulary, encoding="utf-8") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())  # one or two megabytes
    id_type = dict(docs.dtypes)[id_col]

    def run(batches):
        coder = loaded(file)
        counts = Counts(coder)
        for batch in batches:
            rows = []
            for texts in _groups(batch.column("text")):
                split = [WORDS.findall(x) for x in texts]
                n = counts({w for words in split for w in words})  # the words of several texts share one walk
                before = [(sum(map(n.__getitem__, words)), len(words)) for words in split]
                for x, (total, words) in zip(texts, before, strict=True):
                    todo = edits(x)
                    if not todo:
                        rows.append((total, 0, words, 0, total))
                        continue
                    tree, shift = CountTree(x, counts), 0
                    for start, end, new in todo:
                        tree.edit(start + shift, end + shift, new)
                        shift += len(new) - (end - start)
                    rows.append((total, len(todo), words, tree.encoded, tree.total))
            names = ["n_tokens", "n_edits", "n_words", "n_encoded_again", "n_tokens_after"]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(5))], names=["doc_id", *names])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, n_tokens long, n_edits long, n_words long, n_encoded_again long, n_tokens_after long")


def _groups(texts):
    """Texts in groups of up to CHUNK_CHARS characters; a longer one is a group by itself."""
    group, chars = [], 0
    for t in texts:
        x = t.as_py() or ""
        if group and chars + len(x) > CHUNK_CHARS:
            yield group
            group, chars = [], 0
        group.append(x)
        chars += len(x)
    if group:
        yield group


class Counts:
    """Token counts of pre-tokens; new ones are encoded together."""

    LIMIT = 600_000  # bounds memory only: a full cache is emptied

    def __init__(self, coder: TrieBpe):
        self.coder, self.known = coder, {}

    def __call__(self, words) -> dict[str, int]:
        new = {w for w in words if w not in self.known}
        if new:
            if len(self.known) + len(new) > self.LIMIT:
                self.known.clear()
                new = set(words)
            for w, ids in self.coder.encode_words(new).items():
                self.known[w] = len(ids)
        return self.known
