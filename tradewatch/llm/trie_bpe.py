"""Byte-pair encoding and decoding by prefix-sharing trie traversal.

The encoding of a prefix of a word is fixed by its last token: the one
vocabulary entry t that ends the prefix such that t may follow the last token of
the prefix without t. So the distinct words are put in a trie, and a
depth-first walk carries the last token of every prefix from a node to its
children; a prefix that several words share is encoded once. A word's ids are read back
from its node towards the root.

Two tokens may stand side by side if no merge across their boundary comes due before
the tokens that hold its two halves are complete.

Sorted words visit the trie in depth-first order, so the trie is a stack of
the current path, not a structure in memory. Every task encodes the distinct
words of its own rows; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import json
from itertools import islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The white space of the pre-tokenizer: Unicode's, without the separators 1C to 1F that Python adds.
_S = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
CACHE_WORDS = 400_000  # these bound memory only: a full cache is emptied
CHUNK_CHARS = 1 << 20  # texts are taken together up to this many characters
CHUNK_WORDS = 200_000  # and a longer text in runs of so many words


def _byte_chars() -> dict[str, int]:
    """The characters that stand for bytes in the vocabulary: printable Latin-1
    for itself, the others in order from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = {chr(b): b for b in plain}, 256
    for b in range(256):
        if chr(b) not in out or b not in plain:
            out[chr(n)] = b
            n += 1
    return out


class TrieBpe:
    """Encoder and decoder of a byte-level BPE file (the text of its JSON)."""

    def __init__(self, file: str):
        spec = json.loads(file)
        chars = _byte_chars()
        raw = lambda t: bytes(map(chars.__getitem__, t))
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {raw(t): i for t, i in vocab.items() if t not in self.special}
        self.bytes = {i: b for b, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.merge = {}  # (left, right) -> the place of the merge
        parts = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            a, b = vocab[a], vocab[b]
            whole = self.ids[self.bytes[a] + self.bytes[b]]
            self.merge[a, b] = rank
            parts.setdefault(whole, (a, b, rank))
        never = len(self.merge)
        # (token, when it is merged into the next) from the token inwards along its right and left edge
        self.right, self.left = {}, {}
        for edge, side in ((self.right, 1), (self.left, 0)):
            for t in self.bytes:
                path, until = [(t, never)], t
                while until in parts:
                    rank, until = parts[until][2], parts[until][side]
                    path.append((until, rank))
                edge[t] = path
        # tokens that their own bytes encode to: no merge across the halves comes before the last one
        self.own = {t for t in self.ids.values()
                    if t not in parts or not self._crossed(*parts[t])}
        self.ids = {b: i for b, i in self.ids.items() if i in self.own}
        self.size = {i: len(b) for b, i in self.ids.items()}
        self.names = {i: str(i) for i in self.bytes}
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.beside, self.cache = {}, {}

    def _crossed(self, a: int, b: int, before: int | None = None) -> bool:
        """Whether a merge across the boundary a|b comes due (with a rank below ``before``)."""
        limit = len(self.merge) if before is None else before
        for x, x_until in self.right[a]:
            for y, y_until in self.left[b]:
                rank = self.merge.get((x, y), limit)
                # on equal rank the merge further left goes first
                if rank < limit and rank < x_until and rank <= y_until:
                    return True
        return False

    def encode_words(self, words) -> dict[str, list[int]]:
        """Ids of distinct words by one walk of their trie."""
        out, path, last = {}, b"", []  # last[i]: the last token of path[:i + 1]
        ids, size, beside = self.ids, self.size, self.beside
        if len(beside) > 4 * CACHE_WORDS:
            beside.clear()
        for text in sorted(words):  # code points and UTF-8 bytes have one order
            word = text.encode("utf-8", "surrogatepass")
            same, most = 0, min(len(path), len(word))
            while same < most and path[same] == word[same]:
                same += 1
            del last[same:]
            for end in range(same + 1, len(word) + 1):
                start = end
                while True:  # one of the suffixes is the last token
                    start -= 1
                    t = ids.get(word[start:end])
                    if t is None:
                        continue
                    if not start:
                        break
                    pair = last[start - 1] << 20 | t
                    ok = beside.get(pair)
                    if ok is None:
                        ok = beside[pair] = not self._crossed(last[start - 1], t)
                    if ok:
                        break
                last.append(t)
            path, at, found = word, len(word), []
            while at:
                t = last[at - 1]
                found.append(t)
                at -= size[t]
            found.reverse()
            out[text] = found
        return out

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")

    def pieces(self, text: str):
        """Runs of pre-tokens of a text; a special token's string is a pre-token of its own."""
        at = 0
        for m in self.split.finditer(text) if self.split else ():
            yield from self._runs(text[at:m.start()])
            yield [m.group()]
            at = m.end()
        yield from self._runs(text[at:] if at else text)

    def _runs(self, text: str):
        if len(text) <= CHUNK_CHARS:
            yield WORDS.findall(text)
            return
        found = (m.group() for m in WORDS.finditer(text))
        while run := list(islice(found, CHUNK_WORDS)):
            yield run

    def known(self, words: set[str]) -> None:
        """Fill the cache: word -> its ids joined by commas, and what they decode to."""
        new = {w for w in words if w not in self.cache}
        if new and len(self.cache) + len(new) > CACHE_WORDS:
            self.cache.clear()
            new = words
        special = new & self.special.keys()
        found = self.encode_words(new - special) | {w: [self.special[w]] for w in special}
        names, pieces = self.names, self.bytes
        for w, t in found.items():
            self.cache[w] = ",".join([names[i] for i in t]), b"".join([pieces[i] for i in t])

    def digest(self, runs, with_ids: bool) -> tuple:
        """Count, digest of the ids, digest of the decoded text, and the ids of one text."""
        ids, back, n, all_ids = hashlib.sha256(), hashlib.sha256(), 0, []
        for run in runs:
            if not run:
                continue
            try:
                got = [self.cache[w] for w in run]
            except KeyError:
                self.known(set(run))
                got = [self.cache[w] for w in run]
            line = ",".join([g[0] for g in got])
            ids.update(("," + line if n else line).encode())
            n += line.count(",") + 1
            # a text is cut between whole characters only, so each run decodes by itself
            back.update(b"".join([g[1] for g in got]).decode("utf-8", "replace").encode())
            if with_ids:
                all_ids += map(int, line.split(","))
        return n, ids.hexdigest(), back.hexdigest(), all_ids


_LOADED: dict = {}


def loaded(file) -> TrieBpe:
    """One coder per worker process and vocabulary."""
    if file.value not in _LOADED:
        _LOADED.clear()
        _LOADED[file.value] = TrieBpe(file.value)
    return _LOADED[file.value]


def encoded(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256, and
    ids on demand.

    ``vocabulary`` is the path of a byte-level BPE file as the tokenizers library
    reads it; the driver reads it and sends it out (one or two megabytes). A null
    text counts as empty: no tokens, and the digests of nothing. An empty table gives
    an empty result; other columns are not read, whatever their names."""
    with open(vocabulary, encoding="utf-8") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())
    id_type = dict(docs.dtypes)[id_col]

    def run(batches):
        coder = loaded(file)
        for batch in batches:
            texts, at = batch.column("text"), 0
            while at < len(texts):
                group, chars = [], 0
                while at < len(texts) and (not group or chars < CHUNK_CHARS):
                    t = texts[at].as_py() or ""
                    chars += len(t)
                    at += 1
                    if len(t) > CHUNK_CHARS and group:
                        at -= 1
                        break
                    group.append(coder.pieces(t) if len(t) > CHUNK_CHARS else list(coder.pieces(t)))
                if isinstance(group[0], list):
                    coder.known({w for runs in group for r in runs for w in r})
                rows = [coder.digest(runs, with_ids) for runs in group]
                cols = [batch.column("doc_id").slice(at - len(group), len(group)), pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols.append(pa.array([r[3] for r in rows], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)
