"""Cross-tokenizer alignment by an associative fragment monoid.

Two tokenizers cut the same bytes. Offsets where tokens of both end cut a text into
groups; tokens of one group overlap those of no other. A byte range of a text yields a fragment: the
tokens that end in it, as an open prefix (up to the first common end), closed groups, and an
open suffix (behind the last common end). Two adjacent fragments compose: the suffix of one and the
prefix of the other become a closed group, a seam. Composition is associative, so the
fragments of a very long text are made in different tasks and composed as a tree.

Encoding is local to units: no token of either tokenizer has white space behind another character, or a
full stop or comma behind a letter, so texts are cut there, and the distinct units of a run are encoded once. Cuts of byte ranges
ignore units; a range is encoded from the start of its first unit, and tokens that end outside it belong to its neighbours.

How often the corpus links a pair of ids is counted in two steps, by blocks of some million
characters: a block hands on each of its pairs once, with a count; the corpus-wide counts
return to the block, where units refer to pairs by position. Texts are read once and never
shuffled (but for very long ones); a document moves as the positions of its units.

Scale: pairs are merged within blocks before each shuffle, so a pair that every text has
is one row a block; joins on the pair have two plain sides, which adaptive execution splits. The
pairs of a block are bounded by its size, the vocabularies (a few megabytes) are broadcast.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import saved
from tradewatch.llm.trie_bpe import _S, WORDS, TrieBpe

CHUNK = 1 << 16  # characters of a byte range
BLOCK = 1 << 22  # characters of a block
RUN = 1 << 19  # characters encoded together
CACHE_UNITS, CACHE_WORDS = 500_000, 200_000  # these bound memory only: a full cache is emptied
JOINED = 20_000  # units encoded together
MARK = "▁"
PAIR = 20  # bits of the second id in a pair
FRAGMENT = "rid long, doc_id {id}, at long, n_a long, n_b long, n_groups long, sha string, groups string, units array<int>"
OPEN = "closed boolean, pa array<int>, pb array<int>, sa array<int>, sb array<int>"
TABLE = "block long, pairs array<long>, counts array<long>, unit_at array<int>, unit_pairs array<int>, "


class Cut:
    """Tokens as ids and the byte offsets where they end."""

    def __init__(self, ids: list[int], sizes):
        self.ids, self.ends, at = ids, [], 0
        for i in ids:
            at += sizes[i]
            self.ends.append(at)

    def within(self, low: int, high: int) -> list[tuple[int, int]]:
        return [(i, e) for i, e in zip(self.ids, self.ends, strict=True) if low < e <= high]


def grouped(a: list[tuple[int, int]], b: list[tuple[int, int]]):
    """The closed groups [(ids of a, ids of b)] of tokens (id, end), and the open rest behind the last common end."""
    common, groups, i, j = {e for _, e in a} & {e for _, e in b}, [], 0, 0
    for end in sorted(common):
        x = i
        while a[x][1] != end:
            x += 1
        y = j
        while b[y][1] != end:
            y += 1
        groups.append(([t for t, _ in a[i:x + 1]], [t for t, _ in b[j:y + 1]]))
        i, j = x + 1, y + 1
    return groups, ([t for t, _ in a[i:]], [t for t, _ in b[j:]])


class Aligner:
    """Encodes units by both tokenizers and cuts them into groups."""

    def __init__(self, a_file: str, b_file: bytes):
        self.a = TrieBpe(a_file)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = self.a.size, list(map(len, self.b_bytes))
        kept = [p for i, p in enumerate(pieces) if not self.b.is_byte(i)]
        # break characters: no piece has them behind what the first tokenizer cuts from them
        held = lambda before, c: any(re.search(before + (MARK if c == " " else re.escape(c)), p) for p in kept)
        space = "".join(c for c in " \n\t" if not held(f"[^{_S}{MARK}]", c))
        stop = "".join(c for c in ".,;:!?" if not held(r"[^\W\d_]", c))
        letter = r"[^\W\d_]"
        at = [rf"(?<=[^{_S}])[{space}]"] * bool(space) + [rf"(?<={letter})[{stop}]"] * bool(stop)
        self.starts = re.compile("|".join(at) or r"(?!)")
        run = rf"[^{_S}{stop}]*" + rf"(?:(?<!{letter})[{stop}]+[^{_S}{stop}]*)*" * bool(stop)
        self.unit = re.compile(rf"(?:[{_S}]+{rf'|[{stop}]+' * bool(stop)})?{run}(?:{rf'(?![{space}])' * bool(space)}[{_S}]+{run})*")
        self.space = space
        self.first = self.b.encode("a")
        self.a_sizes, self.b_sizes = np.zeros(max(self.a_size) + 1, np.int64), np.array(self.b_size, np.int64)
        self.a_sizes[list(self.a_size)] = list(self.a_size.values())
        self.own = np.zeros(len(self.a_sizes), bool)
        self.own[list(self.a.own)] = True
        self.fast = tiktoken.Encoding("ranks", pat_str=WORDS.pattern, mergeable_ranks={b: i for i, b in self.a.bytes.items() if b.decode("utf-8", "ignore") not in self.a.special},
                                      special_tokens={})
        # an id's name with what may follow it: within a group, at its end; for the second id at a unit's end as well
        self.names = [f"{i}{x}" for i in range(len(self.a_sizes)) for x in ",|"] + [f"{i}{x}" for i in range(len(pieces)) for x in ",;\n"]
        self.b_names_at = 2 * len(self.a_sizes)
        self.words, self.infos = {}, {}

    def units(self, text: str) -> list[str]:
        found = self.unit.findall(text)
        found.pop()  # nothing, at the end
        return found

    def a_words(self, words: list[str]) -> list[list[int]]:
        new = set(words) - self.words.keys()
        if len(self.words) + len(new) > CACHE_WORDS:
            self.words.clear()
            new = set(words)
        self._encode(list(new))
        return [self.words[w] for w in words]

    def _encode(self, words: list[str]) -> None:
        """Ids of distinct words by a fast coder that merges by rank, kept where they are the merges' encoding: the
        one sequence of tokens in which each may stand beside the next. The others are encoded by the merges."""
        if not words:
            return
        found = [self.fast.encode_ordinary(w) for w in words]
        ids = np.fromiter(chain.from_iterable(found), np.int64)
        word = np.repeat(np.arange(len(words)), [len(x) for x in found])
        inside = word[1:] == word[:-1]
        pairs, place = np.unique(ids[:-1][inside] << PAIR | ids[1:][inside], return_inverse=True)
        fits = np.array([self._beside(int(x)) for x in pairs], bool)
        other = set(word[1:][inside][~fits[place]].tolist()) | set(word[~self.own[ids]].tolist())
        self.words.update(zip(words, found, strict=True))
        self.words.update(self.a.encode_words([words[i] for i in other]))

    def _beside(self, pair: int) -> bool:
        ok = self.a.beside.get(pair)
        if ok is None:
            ok = self.a.beside[pair] = not self.a._crossed(pair >> PAIR, pair & (1 << PAIR) - 1)
        return ok

    def tokens(self, unit: str) -> tuple[Cut, Cut]:
        """Both tokenizers' tokens of a unit. It stands behind a letter, as in a text: the space that the
        model adds goes to the letter."""
        ids, skip = self.b.encode("a" + unit), len(self.first)
        self.same(unit, ids[:skip] == self.first, ids[skip:])
        return Cut([t for w in self.a_words(WORDS.findall(unit)) for t in w], self.a_size), Cut(ids[skip:], self.b_size)

    def same(self, text: str, begun: bool, ids) -> None:
        if not begun or b"".join([self.b_bytes[i] for i in ids]) != text.encode("utf-8", "surrogatepass"):
            raise ValueError("the second model changes texts that don't have its mark for spaces")

    def known(self, units: set[str]) -> None:
        """Fill the cache: unit -> info. The distinct units are joined and encoded as texts: where one
        ends and the next begins, both tokenizers cut."""
        new = units - self.infos.keys()
        if new and len(self.infos) + len(new) > CACHE_UNITS:
            self.infos.clear()
            new = units
        # units at the ends of texts may lack the break before or behind them
        whole = [u for u in new if u[0] in self.space and not u[-1].isspace()]
        for u in new.difference(whole):
            a, b = self.tokens(u)
            self.infos[u] = self.info(grouped(a.within(0, a.ends[-1]), b.within(0, b.ends[-1]))[0])
        for i in range(0, len(whole), JOINED):
            self._joined(whole[i:i + JOINED])

    def _joined(self, units: list[str]) -> None:
        parts, skip, b_ids = ["".join(units[i:i + 64]) for i in range(0, len(units), 64)], len(self.first), []
        for part, ids in zip(parts, self.b.encode(["a" + x for x in parts]), strict=True):
            self.same(part, ids[:skip] == self.first, ids[skip:])
            b_ids += ids[skip:]
        words = self.a_words(WORDS.findall("".join(parts)))
        a, b = np.fromiter(chain.from_iterable(words), np.int64), np.array(b_ids, np.int64)
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        ends = np.cumsum([len(u.encode("utf-8", "surrogatepass")) for u in units])
        # links: at every end of a token one pair of tokens stands before it
        every = np.union1d(a_ends, b_ends)
        pairs = a[np.searchsorted(a_ends, every)] << PAIR | b[np.searchsorted(b_ends, every)]
        # text: the ids of a group in order, each with what follows it
        common = a_ends[np.isin(a_ends, b_ends, assume_unique=True)]
        a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        a_last, b_last = a_ends == common[a_group], (b_ends == common[b_group]).astype(np.int64)
        b_last += np.isin(b_ends, ends, assume_unique=True)
        out = np.empty(len(a) + len(b), np.int64)
        before_a, before_b = np.searchsorted(b_group, a_group, "left"), np.searchsorted(a_group, b_group, "right")
        out[np.arange(len(a)) + before_a] = a * 2 + a_last
        out[np.arange(len(b)) + before_b] = self.b_names_at + b * 3 + b_last
        text = "".join(map(self.names.__getitem__, out.tolist())).split("\n")
        cuts = [np.searchsorted(x, ends, "right") for x in (a_ends, b_ends, common, every)]
        sizes = [np.diff(c, prepend=0).tolist() for c in cuts[:3]]
        at = [0, *cuts[3].tolist()]
        for i, u in enumerate(units):
            self.infos[u] = text[i], sizes[0][i], sizes[1][i], sizes[2][i], pairs[at[i]:at[i + 1]]

    def info(self, groups) -> tuple:
        """(text of the groups, tokens of a, tokens of b, groups, linked pairs)"""
        pairs = []
        for a, b in groups:
            if len(a) == 1:
                pairs += [a[0] << PAIR | t for t in b]
            elif len(b) == 1:
                pairs += [t << PAIR | b[0] for t in a]
            else:
                i, j, x, y = 0, 0, self.a_size[a[0]], self.b_size[b[0]]
                while True:
                    pairs.append(a[i] << PAIR | b[j])
                    if x < y:  # no ends meet inside a group
                        i += 1
                        x += self.a_size[a[i]]
                    elif y < x:
                        j += 1
                        y += self.b_size[b[j]]
                    else:
                        break
        names = ";".join([",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups])
        return names, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), np.array(pairs, np.int64)

    def fragment(self, text: str, low: int, high: int, first: bool):
        """Of the tokens of ``text`` (whole units) that end in its bytes (low, high]: the units whose groups are
        all closed here, by name or as (groups,), and the open parts (closed, prefix, suffix). ``first``: the text begins here."""
        units = self.units(text)
        size = [len(u.encode("utf-8", "surrogatepass")) for u in units]
        cut, total = {u: self.tokens(u) for u in {units[0], units[-1]}}, sum(size)
        if len(units) == 1:
            a, b = cut[units[0]]
            groups, rest = grouped(a.within(low, high), b.within(low, high))
            middle = []
        else:
            (a, b), (c, d), before = cut[units[0]], cut[units[-1]], total - size[-1]
            groups, _ = grouped(a.within(low, size[0]), b.within(low, size[0]))
            tail, rest = grouped(c.within(0, high - before), d.within(0, high - before))
            middle = [*units[1:-1], *([(self.info(tail),)] if tail else [])]
        if not first and not groups and not middle:
            return [], (False, rest, ([], []))
        prefix = ([], []) if first else groups.pop(0)
        return [*([(self.info(groups),)] if groups else []), *middle], (True, prefix, rest)


def ranges(text: str, aligner: Aligner, chunk: int):
    """(text, low, high) of the byte ranges of a long text. Cuts come every ``chunk`` characters, whatever stands there;
    one that falls into the unit of the cut before it is left out, so that no unit is encoded more than twice."""
    starts = np.array([0, *(m.start() for m in aligner.starts.finditer(text)), len(text)])
    cuts = [0]
    for c in range(chunk, len(text), chunk):
        if starts[np.searchsorted(starts, c, "right") - 1] >= cuts[-1]:
            cuts.append(c)
    cuts.append(len(text))
    size = lambda s: len(s.encode("utf-8", "surrogatepass"))
    for c, d in zip(cuts, cuts[1:], strict=False):
        u, v = int(starts[np.searchsorted(starts, c, "right") - 1]), int(starts[np.searchsorted(starts, d, "left")])
        low = size(text[u:c])
        yield text[u:v], low, low + size(text[c:d])


class Places(dict):
    """unit -> its position in the block, given as units appear; ``infos`` has what is known of them, in that order."""

    def __init__(self, known: dict):
        super().__init__()
        self.known, self.infos = known, []

    def __missing__(self, unit):
        self.infos.append(self.known[unit])
        self[unit] = at = len(self)
        return at

    def put(self, info) -> int:
        """The position of groups that are no whole unit."""
        if (info[0],) not in self:
            self[info[0],] = len(self)
            self.infos.append(info)
        return self[info[0],]


class Block:
    """Fragments of some texts: their units by position, and the block's pairs with counts."""

    def __init__(self, number: int, known: dict):
        self.number, self.places, self.chars, self.rows = number, Places(known), 0, []

    def add(self, rid, doc_id, at, units, opened=None, payload=False, chars=0) -> None:
        """``units`` are names, or (info,) of groups that are no whole unit."""
        idx = [self.places[u] if isinstance(u, str) else self.places.put(u[0]) for u in units] if payload else list(map(self.places.__getitem__, units))
        self.chars += chars
        self.rows.append((rid, doc_id, at, idx, opened, payload))

    def batch(self, id_type, open_parts: bool) -> pa.RecordBatch:
        infos, k = self.places.infos, len(self.rows)
        names, lists = [x[0] for x in infos], [r[3] for r in self.rows]
        counts = np.array([x[1:4] for x in infos], np.int64).reshape(-1, 3)
        size = np.array(list(map(len, lists)), np.int64)
        used, ends = np.fromiter(chain.from_iterable(lists), np.int64, size.sum()), np.cumsum(size)
        sizes, times = np.array([len(x[4]) for x in infos], np.int64), np.bincount(used, minlength=len(infos))
        sums = np.diff(np.vstack([np.zeros((1, 3), np.int64), np.cumsum(counts[used], axis=0)])[np.r_[0, ends]], axis=0)
        texts = [";".join([names[i] for i in idx]) for idx in lists]
        sha = [None if r[5] else hashlib.sha256(t.encode()).hexdigest() if r[3] else "" for r, t in zip(self.rows, texts, strict=True)]
        groups = [t if r[5] else None for r, t in zip(self.rows, texts, strict=True)]
        parts = {c: [] for c in ("closed", "pa", "pb", "sa", "sb")}
        for r in self.rows if open_parts else ():
            closed, prefix, suffix = r[4] or (True, ([], []), ([], []))
            for c, x in zip(parts, (closed, *prefix, *suffix), strict=True):
                parts[c].append(x)
        flat = np.concatenate([np.empty(0, np.int64), *[x[4] for x in infos]])
        pairs, place = np.unique(flat, return_inverse=True)
        per_pair = np.bincount(place, np.repeat(times, sizes), len(pairs)).astype(np.int64)
        table = {"pairs": pairs, "counts": per_pair, "unit_at": np.cumsum(sizes) - sizes, "unit_pairs": place}
        types = {"pairs": pa.int64(), "counts": pa.int64(), "unit_at": pa.int32(), "unit_pairs": pa.int32()}
        out = {"block": pa.array([self.number] * (k + 1), pa.int64())}
        out |= {c: pa.array([None] * k + [np.asarray(x).astype(types[c].to_pandas_dtype())], pa.list_(types[c])) for c, x in table.items()}
        cols = {"rid": [r[0] for r in self.rows], "at": [r[2] for r in self.rows], **dict(zip(("n_a", "n_b", "n_groups"), sums.T.tolist(), strict=True))}
        out |= {"rid": pa.array([*cols["rid"], None], pa.int64()), "doc_id": pa.array([*[r[1] for r in self.rows], None], id_type)}
        out |= {c: pa.array([*cols[c], None], pa.int64()) for c in ("at", "n_a", "n_b", "n_groups")}
        out |= {"sha": pa.array([*sha, None], pa.string()), "groups": pa.array([*groups, None], pa.string())}
        offsets = pa.array(np.r_[0, ends, ends[-1] if k else 0], pa.int32(), mask=np.r_[np.zeros(k, bool), True, False])
        out["units"] = pa.ListArray.from_arrays(offsets, pa.array(used.astype(np.int32)))
        if open_parts:
            out |= {c: pa.array([*x, None], pa.bool_() if c == "closed" else pa.list_(pa.int32())) for c, x in parts.items()}
        return pa.RecordBatch.from_arrays(list(out.values()), names=list(out))


_LOADED: dict = {}


def loaded(files) -> Aligner:
    """One aligner per worker process and pair of vocabularies."""
    if files.value not in _LOADED:
        _LOADED.clear()
        _LOADED[files.value] = Aligner(*files.value)
    return _LOADED[files.value]


def _numbers(branch: int):
    """Block numbers of a task: the same ones when it runs again."""
    at = branch << 58 | TaskContext.get().partitionId() << 28
    while True:
        yield at
        at += 1


def _runs(batches):
    """Rows as dicts, some at a time."""
    run, chars = [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
            run.append(row)
            chars += len(row["text"] or "")
            if chars >= RUN:
                yield run
                run, chars = [], 0
    if run:
        yield run


def _whole(files, id_type, block_chars):
    """Texts of one byte range."""
    def work(batches):
        aligner, numbers = loaded(files), _numbers(0)
        block = Block(next(numbers), aligner.infos)
        for run in _runs(batches):
            # with the model's mark for spaces in it, a text's tokens are not the text's
            texts = [aligner.units(" " + r["text"]) if r["text"] and MARK not in r["text"] else [] for r in run]
            aligner.known(set(chain.from_iterable(texts)))
            for r, units in zip(run, texts, strict=True):
                block.add(r["rid"], r["doc_id"], 0, units, chars=len(r["text"] or ""))
            if block.chars >= block_chars:
                yield block.batch(id_type, False)
                block = Block(next(numbers), aligner.infos)
        if block.rows:
            yield block.batch(id_type, False)
    return work


def _ranged(files, chunk):
    """The byte ranges of long texts; one of no text where the tokens can't be the text's."""
    def work(batches):
        aligner = loaded(files)
        for batch in batches:
            for i in range(batch.num_rows):
                rid, doc_id, text = (batch.column(c)[i] for c in ("rid", "doc_id", "text"))
                text = " " + text.as_py()
                found = [("", 0, 0)] if MARK in text else list(ranges(text, aligner, chunk))
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rid.as_py()] * n, pa.int64()), pa.array([doc_id.as_py()] * n, doc_id.type), pa.array(range(n), pa.int64()),
                     *[pa.array([x[k] for x in found]) for k in range(3)]], names=["rid", "doc_id", "no", "text", "low", "high"])
    return work


def _fragments(files, id_type, block_chars):
    def work(batches):
        aligner, numbers = loaded(files), _numbers(1)
        block = Block(next(numbers), aligner.infos)
        for run in _runs(batches):
            found = [aligner.fragment(r["text"], r["low"], r["high"], r["no"] == 0) if r["text"] else ([], None) for r in run]
            aligner.known({u for units, _ in found for u in units if isinstance(u, str)})
            for r, (units, opened) in zip(run, found, strict=True):
                block.add(r["rid"], r["doc_id"], 2 * r["no"], units, opened, True, len(r["text"]))
            if block.chars >= block_chars:
                yield block.batch(id_type, True)
                block = Block(next(numbers), aligner.infos)
        if block.rows:
            yield block.batch(id_type, True)
    return work


def _seams(files, id_type, block_chars):
    """Groups closed by composition, as fragments between those of their byte ranges."""
    def work(batches):
        aligner, numbers = loaded(files), _numbers(2)
        block = Block(next(numbers), aligner.infos)
        for batch in batches:
            for r in batch.to_pylist():
                info = aligner.info([(r["a"], r["b"])])
                block.add(r["rid"], r["doc_id"], r["at"], [(info,)], None, True, len(info[0]))
                if block.chars >= block_chars:
                    yield block.batch(id_type, False)
                    block = Block(next(numbers), aligner.infos)
        if block.rows:
            yield block.batch(id_type, False)
    return work


def composed(fragments: DataFrame) -> DataFrame:
    """rid, seams of every document: its fragments (rid, no, closed, pa, pb, sa, sb) composed pairwise, level by level."""
    none = F.array().cast("array<int>")
    seam = "array<struct<at:long,a:array<int>,b:array<int>>>"
    part = ["closed", "pa", "pb", "sa", "sb", "start", "seams"]
    cur = saved(fragments.select("rid", "no", "closed", "pa", "pb", "sa", "sb", F.col("no").alias("start"), F.array().cast(seam).alias("seams")), "align-level")

    def joined(x: Column, y: Column) -> Column:
        a, b = F.concat(x["sa"], y["pa"]), F.concat(x["sb"], y["pb"])
        made = F.when(x["closed"] & y["closed"] & (F.size(a) > 0), F.array(F.struct((2 * y["start"] - 1).alias("at"), a.alias("a"), b.alias("b")))).otherwise(F.array().cast(seam))
        tail = lambda s, p: F.when(y["closed"], y[s]).when(x["closed"], F.concat(x[s], y[p])).otherwise(none)
        head = lambda p: F.when(x["closed"], x[p]).otherwise(F.concat(x[p], y[p]))
        return F.struct((x["closed"] | y["closed"]).alias("closed"), head("pa").alias("pa"), head("pb").alias("pb"), tail("sa", "pa").alias("sa"),
                        tail("sb", "pb").alias("sb"), F.when(x["closed"], x["start"]).otherwise(y["start"]).alias("start"),
                        F.concat(x["seams"], made, y["seams"]).alias("seams"))

    while cur.filter("no > 0").limit(1).count():
        half = lambda odd: F.first(F.when(F.col("no") % 2 == odd, F.struct(*part)), ignorenulls=True)
        two = cur.groupBy("rid", F.floor(F.col("no") / 2).alias("no")).agg(half(0).alias("x"), half(1).alias("y"))  # two rows at most
        z = F.when(F.col("y").isNull(), F.col("x")).otherwise(joined(F.col("x"), F.col("y")))
        cur = saved(two.select("rid", "no", z.alias("z")).select("rid", "no", "z.*"), "align-level")
    return cur.select("rid", "seams")


def _scored(id_type):
    """Fragments with the links that are their second id's best, and the sum of the links' counts. A
    partition has its blocks one after the other: pairs with counts, then the units, then the fragments."""
    def work(batches):
        number = count = best = unit_best = unit_sum = None
        for batch in batches:
            out, kinds, blocks = [], batch.column("kind").to_numpy(), batch.column("block").to_numpy()
            edges = np.flatnonzero(np.r_[True, (kinds[1:] != kinds[:-1]) | (blocks[1:] != blocks[:-1])]) if len(kinds) else []
            for low, high in zip(edges, [*edges[1:], len(kinds)], strict=True):
                part = batch.slice(low, high - low)
                if blocks[low] != number:
                    number = blocks[low]
                    unit_best = unit_sum = np.empty(0, np.int64)
                if kinds[low] == 0:
                    order = np.argsort(part.column("ats")[0].values.to_numpy())
                    count, best = (part.column(c)[0].values.to_numpy(zero_copy_only=False)[order].astype(np.int64) for c in ("counts", "bests"))
                elif kinds[low] == 1:
                    at, pairs = (part.column(c)[0].values.to_numpy() for c in ("unit_at", "unit_pairs"))
                    if len(pairs):
                        unit_sum, unit_best = (np.add.reduceat(x[pairs], at) for x in (count, best))
                else:
                    units = part.column("units")
                    ids, ends = units.flatten().to_numpy(), units.offsets.to_numpy()
                    ends = ends - ends[0]
                    sums = [np.r_[0, np.cumsum(x[ids])] for x in (unit_best, unit_sum)]
                    out.append(pa.RecordBatch.from_arrays(
                        [*[part.column(c) for c in ("rid", "doc_id", "at", "n_a", "n_b", "n_groups", "sha")],
                         *[pa.array(s[ends[1:]] - s[ends[:-1]], pa.int64()) for s in sums]],
                        names=["rid", "doc_id", "at", "n_a", "n_b", "n_groups", "sha", "n_best", "count_sum"]))
            yield from out
    return work, f"rid long, doc_id {id_type}, at long, n_a long, n_b long, n_groups long, sha string, n_best long, count_sum long"


def _digests(batches):
    """rid, sha of documents whose fragments come one after the other, in order. Groups are hashed as they come."""
    rid, sha, some = None, None, False
    for batch in batches:
        ids, shas = [], []
        for r, g in zip(batch.column("rid").to_pylist(), batch.column("groups"), strict=True):
            if r != rid:
                if rid is not None:
                    ids.append(rid)
                    shas.append(sha.hexdigest() if some else "")
                rid, sha, some = r, hashlib.sha256(), False
            g = g.as_py()
            if g:
                sha.update((";" + g if some else g).encode())
                some = True
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(shas, pa.string())], names=["rid", "sha"])
    if rid is not None:
        yield pa.RecordBatch.from_arrays([pa.array([rid], pa.int64()), pa.array([sha.hexdigest() if some else ""])], names=["rid", "sha"])


def pair_counts(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(block, at, pair) of every block's pairs, and the corpus-wide pair, count, best: whether no other pair of its second id is more frequent."""
    held = blocks.filter("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("at", "x")).select(
        "block", "at", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    second = F.col("pair").bitwiseAND((1 << PAIR) - 1)
    totals = saved(held.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", second), "align-pairs")
    most = saved(totals.groupBy("b").agg(F.max("count").alias("most")), "align-best")
    return held.drop("n"), saved(totals.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best")), "align-counts")


def aligned(docs: DataFrame, a_vocabulary: str, b_model: str, id_col: str = "doc_id", text: str = "text",
            chunk: int = CHUNK, block_chars: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b (tokens), n_groups, n_links (overlapping pairs of tokens),
    n_best (links whose pair of ids is as frequent as any of the second id), count_sum (of the links' pairs' counts), groups_sha256.

    ``a_vocabulary`` is the path of a byte-level BPE file and gets a space and the text, ``b_model`` that of a
    sentencepiece model that adds the space itself. Strings of special tokens are plain text. A null or empty text, and
    one whose tokens' bytes differ from it (it has the model's mark for spaces), has no tokens: zeros and an empty digest; it
    counts nowhere. Rows that repeat, or share an id, stay apart and each count. An empty table gives an empty result; other
    columns are not read, whatever their names. ``chunk`` and ``block_chars`` never change the result."""
    spark, kind = docs.sparkSession, dict(docs.dtypes)[id_col]
    with open(a_vocabulary, encoding="utf-8") as a, open(b_model, "rb") as b:
        files = spark.sparkContext.broadcast((a.read(), b.read()))
    src = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    id_type = docs.select(id_col).limit(0).toArrow().schema.field(0).type
    fragment = FRAGMENT.format(id=kind)
    long = F.coalesce(F.char_length("text"), F.lit(0)) >= chunk
    whole = saved(src.filter(~long).mapInArrow(_whole(files, id_type, block_chars), TABLE + fragment), "align-whole")
    cuts = saved(src.filter(long).mapInArrow(_ranged(files, chunk), f"rid long, doc_id {kind}, no long, text string, low long, high long"), "align-ranges")
    ranged = saved(cuts.repartition("rid", "no").mapInArrow(_fragments(files, id_type, block_chars), TABLE + fragment + ", " + OPEN), "align-fragments")
    opened = ranged.filter("rid IS NOT NULL").withColumn("no", F.expr("at DIV 2"))
    seams = composed(opened).select("rid", F.explode("seams").alias("s")).select("rid", "s.*")
    names = opened.filter("no = 0").select("rid", "doc_id")
    seams = saved(saved(seams.join(names, "rid"), "align-seams").mapInArrow(_seams(files, id_type, block_chars), TABLE + fragment), "align-seam-blocks")
    parts = [whole, ranged.select(*whole.columns), seams]
    held, counts = pair_counts(parts[0].unionByName(parts[1]).unionByName(parts[2]))

    def lined(df: DataFrame, order: int) -> DataFrame:
        have = {"ats": "array<int>", "counts": "array<long>", "bests": "array<boolean>", "at": "long", "unit_at": "array<int>", "unit_pairs": "array<int>", "rid": "long", "doc_id": kind,
                "n_a": "long", "n_b": "long", "n_groups": "long", "sha": "string", "units": "array<int>"}
        return df.select("block", F.lit(order).alias("kind"), *[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in have.items()])

    # one row a block, as many entries as the block has pairs
    back = held.join(counts, "pair").groupBy("block").agg(F.collect_list(F.struct("at", "count", "best")).alias("p"))
    rows = lined(back.select("block", F.col("p.at").alias("ats"), F.col("p.count").alias("counts"), F.col("p.best").alias("bests")), 0)
    for x in parts:
        rows = rows.unionByName(lined(x.filter("pairs IS NOT NULL").select("block", "unit_at", "unit_pairs"), 1))
        rows = rows.unionByName(lined(x.filter("rid IS NOT NULL").drop("pairs", "counts", "unit_at", "unit_pairs", "groups"), 2))
    work, schema = _scored(kind)
    scored = saved(rows.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(work, schema), "align-scored")
    # documents of several fragments: numbers are added, groups are hashed in order
    pieces = ranged.filter("rid IS NOT NULL").select("rid", "at", "groups").unionByName(seams.filter("rid IS NOT NULL").select("rid", "at", "groups"))
    digest = pieces.repartition("rid").sortWithinPartitions("rid", "at").mapInArrow(_digests, "rid long, sha string")
    number = ["n_a", "n_b", "n_groups", "n_best", "count_sum"]
    many = scored.filter("sha IS NULL").groupBy("rid").agg(F.max("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in number]).join(digest, "rid")
    one = scored.filter("sha IS NOT NULL").select("rid", "doc_id", *number, "sha")
    return one.unionByName(many.select(*one.columns)).select(
        "doc_id", "n_a", "n_b", "n_groups", (F.col("n_a") + F.col("n_b") - F.col("n_groups")).alias("n_links"), "n_best", "count_sum",
        F.col("sha").alias("groups_sha256"))

