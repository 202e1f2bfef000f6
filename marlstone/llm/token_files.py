"""Token ids in grammar-compressed files.

Documents are put into ascending order of doc_id, encoded, closed by an end id, and cut into
shards of about ``SHARD_IDS`` ids, each of whole documents. A shard is compressed by Re-Pair:
the most frequent pair of neighbouring symbols is replaced by a nonterminal and the pairs around
it are counted anew, again and again, down to pairs of ``LEAST`` occurrences. Pairs that don't
change each other's counts or order are replaced together.

A row of the table is a shard: ``part`` and ``shard`` give its place, ``first`` the ids before it
within its part, ``doc_ids`` and ``doc_tokens`` its documents; and as little-endian numbers
``terminals`` (the ids that occur), ``rules`` (pairs of symbols; a symbol is a terminal's place or
the number of terminals plus a rule's place), ``lengths`` (the ids that each rule expands to),
``symbols`` (``width`` bytes each) and ``marks`` (ids before every ``MARK``-th symbol). Lengths
and marks find any range of ids without expanding what lies before it.
"""

from __future__ import annotations

import contextlib
import os
import re
import struct
import zlib
from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch_path, worker_cache

#: Ids of a shard: it ends with the document that reaches them.
SHARD_IDS = 1 << 20
#: Occurrences below which a pair is left alone.
LEAST = 16
#: Symbols between two marks.
MARK = 1024
#: Bytes of the texts that are encoded together.
TEXT_BYTES = 4 << 20

#: A run of letters, then a run of marks: two tokens of their own.
_MARKED = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]+)")
_LINES = re.compile("(\n+)")


class _Boundary(ValueError):
    """A word whose tokens depend on the white space around it."""


class ByteEncoder:
    """Token ids, as little-endian unsigned 32-bit bytes, of whole texts by a byte-level BPE vocabulary.

    The vocabulary's pattern never joins across a single space between two other characters; the
    space goes to what follows. So such a text's ids are those of its words, each with the space
    before it, and words are remembered, at most ``2 * remembered`` of them. Texts with other white
    space are encoded as a whole, but for line ends between words and white space at the end.
    """

    def __init__(self, vocabulary_file: str, remembered: int = 700_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary_file)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]  # what the library cuts texts at
        self.kept = bytes([*range(33, 127), *range(161, 173), *range(174, 256)])  # bytes that stand for themselves; the others follow from U+0100 on
        moved = [b for b in range(256) if b not in self.kept]
        self.letters = {b: 256 + i for i, b in enumerate(moved)}
        self.blank_letter = chr(self.letters[32])
        self.spelled = np.array([self.letters.get(b, b) for b in range(256)], "<u2")
        self.bare = Tokenizer(self.model)
        tokens = [t for t in self.tokenizer.get_vocab() if chr(self.letters[0]) in t]
        self.apart = self.model.token_to_id(tokens[0]) if tokens == [chr(self.letters[0])] else None
        self.most = remembered
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.blank: dict[str, bytes] = {}
        self.young["\n"] = self._white("\n")
        self.mark_ids = {m: self.whole(m) for m in ",.;:!?"}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _run(self, run: str) -> bytes:
        """A run of letters, with a space before it or not, is one piece of the pattern."""
        raw = run.encode()
        if raw.startswith(b" ") and not raw[1:].translate(None, self.kept):
            letters = self.blank_letter + raw[1:].decode("latin-1")
        else:
            letters = raw.decode("latin-1").translate(self.letters)
        return struct.pack(f"<{len(ids)}I", *ids) if (ids := [t.id for t in self.model.tokenize(letters)]) else b""

    def _white(self, run: str) -> bytes:
        if run not in self.blank:
            if len(self.blank) > 1000:
                self.blank.clear()
            self.blank[run] = self.whole(run)
        return self.blank[run]

    def word(self, w: str) -> bytes:
        """Ids of a word, which may begin with one space."""
        got = self.young.get(w)
        if got is None:
            got = self.old.get(w)
            if got is None:
                got = self._unknown(w)
            if "\n" not in w:  # two words and a line end are seldom met again
                self.young[w] = got
        return got

    def _runs(self, runs: list[str]) -> list[bytes]:
        """``_run`` of each. No merge reaches across a byte 0, so many runs are one call of the library's model."""
        if self.apart is None:
            return list(map(self._run, runs))
        some = [self.spelled[np.frombuffer("\0".join(runs[i : i + 64]).encode(), np.uint8)].tobytes().decode("utf-16-le") for i in range(0, len(runs), 64)]
        ids: list[int] = []
        for coded in self.bare.encode_batch_fast(some, add_special_tokens=False):
            ids += coded.ids
            ids.append(self.apart)
        flat = np.array(ids, "<u4")
        raw, cuts = flat.tobytes(), (4 * (flat == self.apart).nonzero()[0]).tolist()
        return [raw[i:j] for i, j in zip([0, *(c + 4 for c in cuts)], cuts, strict=False)]

    def _fill(self, words: list[str], found: list[bytes | None]) -> list[int]:
        """Puts the ids of words that are not remembered into their places; the places of those that depend on what is around them."""
        young, old, mark_ids = self.young, self.old, self.mark_ids
        fresh: dict[str, bytes] = {}
        waiting, bound = [], []
        for i in [i for i, got in enumerate(found) if got is None]:
            w = words[i]
            mark = mark_ids.get(w[-1:])
            plain = w if mark is None else w[:-1]
            if not (plain[1:] if plain[:1] == " " else plain).isalpha():  # else letters, with one mark or none: the mark is a piece of its own
                got = old.get(w)
                if got is not None:
                    young[w] = found[i] = got
                    continue
                m = _MARKED.fullmatch(w, w[:1] == " ")
                if m is None:
                    try:
                        found[i] = self.word(w)
                    except _Boundary:
                        found[i] = b""
                        bound.append(i)
                    continue
                plain, mark = w[: len(w) - len(m[2])], self.word(m[2])
            got = young.get(plain)
            if got is None:
                got = old.get(plain)
                if got is None:
                    fresh[plain] = b""
                    waiting.append((i, plain, mark))
                    continue
                young[plain] = got
            found[i] = got if mark is None else got + mark
        young.update(zip(fresh, self._runs(list(fresh)), strict=True))
        for i, plain, mark in waiting:
            found[i] = young[plain] if mark is None else young[plain] + mark
        return bound

    def _unknown(self, w: str) -> bytes:
        bare = w[1:] if w.startswith(" ") else w
        if bare.isalpha():
            return self._run(w)
        if m := _MARKED.fullmatch(bare):
            return self.word(w[: len(w) - len(m[2])]) + self.word(m[2])
        if not bare or bare[0].isspace() or bare[-1].isspace():
            raise _Boundary(w)
        parts = _LINES.split(w)
        if len(parts) == 1:
            return self.whole(w)
        if any(part[0].isspace() for part in parts[2::2]) or any(part[-1].isspace() for part in parts[::2]):
            raise _Boundary(w)
        out = self.word(parts[0])
        for lines, part in zip(parts[1::2], parts[2::2], strict=True):
            out += (self._white(lines[1:]) if len(lines) > 1 else b"") + self._white("\n") + self.word(part)
        return out

    def __call__(self, text: str | None) -> bytes:
        return self.several([text])[0]

    def several(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids. Arrow finds the distinct words of all texts together."""
        if len(self.young) > self.most:
            self.young, self.old = {"\n": self._white("\n")}, self.young
        out, places, bodies, tails = [b""] * len(texts), [], [], []
        for i, text in enumerate(texts):
            if not text:
                continue
            body = text.rstrip(" \t\n\r")
            if "\0" in body or not body or any(s in body for s in self.special):
                out[i] = self.whole(text)
                continue
            places.append(i)
            tails.append(text[len(body) :])
            if "\n" in body and not ("\n\n" in body or " \n" in body or "\n " in body):
                body = body.replace("\n", "\0\n\0")  # a line end between words is a piece of its own
            bodies.append(body.replace(" ", "\0 "))
        if not bodies:
            return out
        ends = np.array([b.count("\0") + 1 for b in bodies]).cumsum()
        coded = pc.split_pattern(pa.array(["\0".join(bodies)], pa.large_string()), "\0").values.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.young.get, words))
        at, bound = coded.indices.to_numpy(), [False] * len(bodies)
        if None in found and (open_words := self._fill(words, found)):
            bound = np.logical_or.reduceat(np.isin(at, open_words), np.append(0, ends[:-1])).tolist()
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts, n = sizes.cumsum() - sizes, sizes[at]
        stops = n.cumsum()
        ids = np.frombuffer(b"".join(found), "<u4")[np.repeat(starts[at] + n - stops, n) + np.arange(stops[-1])]
        raw, cuts = ids.tobytes(), (4 * stops[ends - 1]).tolist()
        for i, tail, begin, end, whole in zip(places, tails, [0, *cuts], cuts, bound, strict=False):
            out[i] = self.whole(texts[i]) if whole else raw[begin:end] + (self._white(tail) if tail else b"")
        return out


# -- Re-Pair of one shard --------------------------------------------------------------------------


#: A place in a round's order that no pair has.
_NONE = (1 << 31) - 1
#: Pairs that a round looks at, at least and at most; those of equal counts go together.
_ROUND = (8, 2048)


def _grouped(pairs: np.ndarray, places: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs with at least ``least`` places, how many each has, and these places: pair by pair, in rising order."""
    if pairs.dtype == np.uint32:  # pair and place in one number are sorted without an index
        held = pairs.astype(np.uint64) << np.uint64(32) | places.astype(np.uint64)
        held.sort()
        at = (held & np.uint64(0xFFFFFFFF)).view(np.int64)
        held >>= np.uint64(32)
    else:
        order = np.lexsort((places, pairs))
        at, held = places[order], pairs[order]
    starts = np.append(True, held[1:] != held[:-1]).nonzero()[0][: len(held)]
    sizes = np.diff(starts, append=len(held))
    often = sizes >= least
    return held[starts[often]].astype(pairs.dtype), sizes[often], at[np.repeat(often, sizes)]


def _overlapping(at: np.ndarray, owner: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Which places of pairs of equal symbols overlap one that is replaced, from the left."""
    begins = np.append(True, (after[at[:-1]] != at[1:]) | (owner[1:] != owner[:-1])).nonzero()[0][: len(at)]
    return (np.arange(len(at)) - np.repeat(begins, np.diff(begins, append=len(at)))) & 1 == 1


def _losing(mine: np.ndarray, by_next: np.ndarray, by_last: np.ndarray, whole: int) -> tuple[list[int], np.ndarray]:
    """The pairs of a round that lose places to pairs replaced before them, and how many places.

    ``mine``: the ranks of the pairs of some places; ``by_next`` and ``by_last``: those of the
    pairs that share their second and their first symbol there. A pair that loses places waits,
    so it takes none away.
    """
    one, other = np.minimum(by_next, by_last), np.maximum(by_next, by_last)
    two = other < mine
    edges = np.unique(np.concatenate((mine << 32 | one, (mine << 32 | other)[two])))
    waits = [False] * (whole + 1)
    for i, by in zip((edges >> 32).tolist(), (edges & 0xFFFFFFFF).tolist(), strict=True):
        if not waits[by]:
            waits[i] = True
    waiting = np.array(waits)
    lost = ~waiting[one] | (two & ~waiting[np.minimum(other, whole)])
    return waiting.nonzero()[0].tolist(), np.bincount(mine[lost], minlength=whole)


def replace_pairs(seq: np.ndarray, symbols: int, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, pairs) of Re-Pair: the most frequent pair becomes the symbol ``symbols`` + i, again and again.

    It ends with the pairs of fewer than ``least`` occurrences, or with ``most`` pairs; of equally
    frequent ones the smallest goes first. A round takes the next pairs of that order together, as
    far as none changes what follows: a pair that loses places to one before it waits for the next
    round, and the round ends where such a pair, or a pair that arose, would come before the next.
    """
    n = len(seq)
    bits, kind = (16, np.uint32) if symbols + most <= 1 << 16 and n < 1 << 32 else (32, np.uint64)
    shift, mask, gone = kind(bits), kind((1 << bits) - 1), np.uint32(0xFFFFFFFF)
    text = np.append(seq, gone).astype(np.uint32)  # a place after the last, which no pair reaches
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    keys, sizes, pool = _grouped(text[: n - 1].astype(kind) << shift | text[1:n], np.arange(n - 1), least)
    keys, sizes, used = np.append(kind(0), keys), np.append(0, sizes), len(pool)  # pair 0 stands for those not kept
    starts, count, bound = sizes.cumsum() - sizes, sizes.copy(), sizes.copy()  # places now; pairs of equal symbols may have less occurrences
    number, rank = np.zeros(n + 1, np.int64), np.full(len(keys), _NONE)  # of the pair at a place; of a pair in the round
    number[pool] = np.repeat(np.arange(len(keys)), sizes)
    rules: list[tuple[int, int]] = []
    width = _ROUND[0]
    while len(rules) < most:
        value = np.minimum(count, bound)
        level = max(int(np.partition(value, -width)[-width]) if width < len(value) else 0, least)
        some = (value >= level).nonzero()[0]
        if not len(some):
            break
        owner = np.repeat(np.arange(len(some)), sizes[some])
        at = pool[np.arange(len(owner)) + np.repeat(starts[some] + sizes[some] - sizes[some].cumsum(), sizes[some])]
        stay = (number[at] == some[owner]).nonzero()[0]
        at, owner = at[stay], owner[stay]
        counts, real = count[some], None
        alike = keys[some] >> shift == keys[some] & mask
        if alike.any():
            runs = alike[owner].nonzero()[0]
            spare = _overlapping(at[runs], owner[runs], after)
            counts = counts - np.bincount(owner[runs[spare]], minlength=len(some))
            bound[some] = counts
            real = np.ones(len(at), bool)
            real[runs[spare]] = False
            runs_at, runs_of = at[runs], some[owner[runs]]
            number[runs_at[spare]] = 0
        order = np.lexsort((keys[some], -counts))
        order = order[: np.count_nonzero(counts >= level)]
        whole = stop = min(len(order), most - len(rules))
        if stop:
            ranked = list(zip((-counts[order]).tolist(), keys[some[order]].tolist(), strict=True))
            mine = np.full(len(some), _NONE)
            mine[order[:stop]] = np.arange(stop)
            rank[some] = mine
            a, r = at, mine[owner]
            if stop < len(some):
                here = (r < stop).nonzero()[0]
                a, r, real = a[here], r[here], None if real is None else real[here]
            s, h = after[a], before[a]
            at_s, at_h = number[s], number[h]
            by_next, by_last = rank[at_s], rank[at_h]
            hit = ((by_next < r) | (by_last < r)).nonzero()[0]
            goes = real
            waiting: list[int] = []
            if len(hit):
                waiting, lost = _losing(r[hit], by_next[hit], by_last[hit], whole)
                for i in waiting:
                    less = 0 if alike[order[i]] else int(lost[i])
                    stop = min(stop, max(i + 1, bisect(ranked, (ranked[i][0] + less, ranked[i][1]))))
                out = np.zeros(whole, bool)
                out[waiting] = True
                out[stop:] = True
                rank[some[order[:whole][out]]] = _NONE
                goes = ~out[r] if real is None else real & ~out[r]
            if goes is not None:
                a, s, h, r, at_s, at_h = a[goes], s[goes], h[goes], r[goes], at_s[goes], at_h[goes]
            waits = set(waiting)
            chosen = [i for i in range(stop) if i not in waits]
            base = symbols + len(rules)
            made = np.zeros(whole + 1, np.uint32)
            made[chosen] = np.arange(base, base + len(chosen))
            new, b, g = made[r], after[s], before[h]
            on, off = rank[number[b]], rank[number[g]]  # of the pairs that begin and end next to it: replaced already?
            follows = np.where(on <= r, made[np.minimum(on, whole)], text[b])
            precedes = np.where(off < r, made[np.minimum(off, whole)], text[h])
            inside, inner = b < n, (h >= 0) & (off != r)  # two of one new symbol are found from the left one
            arisen = np.concatenate(((new.astype(kind) << shift | follows)[inside], (precedes.astype(kind) << shift | new)[inner]))
            found, found_sizes, found_pool = _grouped(arisen, np.concatenate((a[inside], np.where(off < r, g, h)[inner])), least)
            newest = np.maximum(found >> shift, found & mask).astype(np.int64) - base
            cut = stop
            for key, size, i in zip(found.tolist(), found_sizes.tolist(), newest.tolist(), strict=True):
                if chosen[i] + 1 < cut:
                    cut = min(cut, max(chosen[i] + 1, bisect(ranked, (-size, key))))
            if cut < stop:
                stop = cut
                goes = r < stop
                a, s, b, h, new, off, at_s, at_h = a[goes], s[goes], b[goes], h[goes], new[goes], off[goes], at_s[goes], at_h[goes]
                chosen = [i for i in chosen if i < stop]
                goes = newest < len(chosen)
                found, found_sizes, found_pool = found[goes], found_sizes[goes], found_pool[np.repeat(goes, found_sizes)]
            rank[some] = _NONE
            count -= np.bincount(np.concatenate((at_s, at_h[off >= stop])), minlength=len(count))
            count[some[order[chosen]]] = count[0] = 0
            number[a] = number[s] = number[h] = 0
            text[a], text[s] = new, gone
            after[a], before[b] = b, a
            rules += [(ranked[i][1] >> bits, ranked[i][1] & int(mask)) for i in chosen]
            if len(found):
                of, key = np.repeat(np.arange(len(found)), found_sizes), np.repeat(found, found_sizes)
                alive = (text[found_pool] == key >> shift) & (text[after[found_pool]] == key & mask)
                number[found_pool[alive]] = len(keys) + of[alive]
                if used + len(found_pool) > len(pool):
                    pool = np.append(pool[:used], np.empty(used // 2 + len(found_pool), pool.dtype))
                pool[used : used + len(found_pool)] = found_pool
                starts = np.append(starts, used + found_sizes.cumsum() - found_sizes)
                used += len(found_pool)
                now = np.bincount(of[alive], minlength=len(found))
                keys, sizes = np.append(keys, found), np.append(sizes, found_sizes)
                count, bound, rank = np.append(count, now), np.append(bound, now), np.append(rank, np.full(len(found), _NONE))
        if alike.any():  # those that are still there take all their places back
            there = (text[runs_at] == keys[runs_of] & mask) & (text[after[runs_at]] == keys[runs_of] & mask)
            number[runs_at[there]] = runs_of[there]
            count[some[alike]] = np.bincount(runs_of[there], minlength=len(count))[some[alike]]
        width = min(2 * width, _ROUND[1]) if stop == whole else max(width // 2, _ROUND[0])
    out = text[:n]
    return out[out != gone], np.array(rules, np.uint32).reshape(-1, 2)


def compress(ids: np.ndarray, least: int = LEAST) -> dict[str, np.ndarray]:
    """terminals, rules, lengths, symbols and marks of one shard's ids (unsigned 32-bit)."""
    terminals = np.unique(ids) if len(ids) == 0 or ids.max() > 1 << 24 else np.flatnonzero(np.bincount(ids)).astype(np.uint32)
    place = np.zeros(int(terminals[-1]) + 1 if len(terminals) and terminals[-1] <= 1 << 24 else 0, np.uint32)
    if len(place):
        place[terminals] = np.arange(len(terminals))
    seq = place[ids] if len(place) else np.searchsorted(terminals, ids).astype(np.uint32)
    room = (1 << 16 if len(terminals) <= 60_000 else 1 << 24) - len(terminals)
    seq, table = replace_pairs(seq, len(terminals), max(least, 2), room) if len(seq) > 1 else (seq, np.empty((0, 2), np.uint32))
    lengths = [1] * len(terminals)
    for left, right in table.tolist():  # a rule refers to earlier symbols only
        lengths.append(lengths[left] + lengths[right])
    lengths = np.array(lengths, np.int64)
    before = np.concatenate([[0], np.cumsum(lengths[seq])])
    return {"terminals": terminals, "rules": table, "lengths": lengths[len(terminals) :], "symbols": seq, "marks": before[:-1:MARK]}


def _expansions(terminals: np.ndarray, rules: np.ndarray) -> list[bytes]:
    raw = terminals.astype("<u4").tobytes()
    out = [raw[i : i + 4] for i in range(0, len(raw), 4)]
    for left, right in rules.tolist():
        out.append(out[left] + out[right])
    return out


def expand(packed: dict[str, np.ndarray]) -> np.ndarray:
    """All ids of a shard."""
    each = _expansions(packed["terminals"], packed["rules"])
    flat = np.frombuffer(b"".join(each), "<u4")
    lengths = np.concatenate([np.ones(len(packed["terminals"]), np.int64), packed["lengths"]]).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    seq = packed["symbols"]
    n = lengths[seq]
    return flat[np.repeat(starts[seq] - (np.cumsum(n) - n), n) + np.arange(n.sum())] if len(seq) else np.empty(0, "<u4")


def expand_range(packed: dict[str, np.ndarray], begin: int, end: int) -> np.ndarray:
    """The ids ``begin`` to ``end`` of a shard: only symbols from the mark before them on are looked at."""
    terminals, rules, marks = packed["terminals"], packed["rules"], packed["marks"]
    if begin >= end:
        return np.empty(0, "<u4")
    lengths = np.concatenate([np.ones(len(terminals), np.int64), packed["lengths"]])
    mark = int(np.searchsorted(marks, begin, "right")) - 1
    at, i, out = int(marks[mark]), mark * MARK, []
    while at < end:
        todo = [int(packed["symbols"][i])]
        i += 1
        while todo:
            s = todo.pop()
            n = int(lengths[s])
            if at + n <= begin or at >= end:
                at += n
            elif s < len(terminals):
                out.append(terminals[s])
                at += 1
            else:
                left, right = rules[s - len(terminals)].tolist()
                todo += [right, left]
    return np.array(out, "<u4")


# -- files -------------------------------------------------------------------------------------------

_SCHEMA = "part int, shard int, first long, n_ids long, least_doc long, largest_doc long, doc_ids array<long>, doc_tokens array<long>, width int, terminals binary, rules binary, lengths binary, symbols binary, marks binary"


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch of (id, text) in parts of about ``TEXT_BYTES``, a longer text alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64)
    begin = held = 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > TEXT_BYTES:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += size
    yield batch.slice(begin)


def _packed_row(part: int, shard: int, first: int, docs: list, pieces: list[bytes], least: int) -> pa.RecordBatch:
    packed = compress(np.frombuffer(b"".join(pieces), "<u4"), least)
    width = 2 if len(packed["terminals"]) + len(packed["rules"]) <= 1 << 16 else 4
    sizes = [len(p) // 4 for p in pieces]
    known = [d for d in docs if d is not None]
    blobs = [packed["terminals"].astype("<u4"), packed["rules"].astype(f"<u{width}"), packed["lengths"].astype("<u8"), packed["symbols"].astype(f"<u{width}"), packed["marks"].astype("<u8")]
    row = [part, shard, first, sum(sizes), min(known, default=None), max(known, default=None), docs, sizes, width, *(b.tobytes() for b in blobs)]
    kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 4, *[pa.list_(pa.int64())] * 2, pa.int32(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], [f.split()[0] for f in _SCHEMA.split(", ")])


def _unpacked(row: dict) -> dict[str, np.ndarray]:
    kinds = {"terminals": "<u4", "rules": f"<u{row['width']}", "lengths": "<u8", "symbols": f"<u{row['width']}", "marks": "<u8"}
    out = {k: np.frombuffer(row[k], kind) for k, kind in kinds.items()}
    return out | {"rules": out["rules"].reshape(-1, 2), "lengths": out["lengths"].astype(np.int64), "symbols": out["symbols"].astype(np.int64), "marks": out["marks"].astype(np.int64)}


def write_ids(docs: DataFrame, vocabulary_file: str, path: str, end_id: int = 0, shard_ids: int = SHARD_IDS, least: int = LEAST) -> None:
    """Writes the ids of every whole text of ``docs`` (doc_id, text) below ``path``, in ascending order of doc_id.

    Null text is empty text: its only id is ``end_id``. Null ids come last; rows of one doc_id are
    ordered by a hash of their texts, and are documents of their own.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    ordered = rows.orderBy(F.asc_nulls_last("doc_id"), F.xxhash64("text")).select("doc_id", "text")
    end = np.array([end_id], "<u4").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = worker_cache("token_files")
        encode = encoders.setdefault(vocabulary_file, None) or ByteEncoder(vocabulary_file)
        encoders[vocabulary_file] = encode
        part, shard, first, held = TaskContext.get().partitionId(), 0, 0, 0
        ids, pieces = [], []
        for b in batches:
            for some in _portions(b):
                for doc_id, raw in zip(some.column(0).to_pylist(), encode.several(some.column(1).to_pylist()), strict=True):
                    ids.append(doc_id)
                    pieces.append(raw + end)
                    held += len(pieces[-1]) // 4
                    if held >= shard_ids:
                        yield _packed_row(part, shard, first, ids, pieces, least)
                        shard, first, held, ids, pieces = shard + 1, first + held, 0, [], []
        if ids:
            yield _packed_row(part, shard, first, ids, pieces, least)

    ordered.mapInArrow(pack, _SCHEMA).write.mode("overwrite").parquet(path)


def read_ids(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """One row per document, read back from the files: doc_id, start, n_tokens, ids_crc32 (and ids, as binary).

    ``start`` counts the ids of all documents before it.
    """
    shards = spark.read.parquet(path)
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # one row a part: as many as the sort has shuffle partitions
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).select(F.col("part").alias("of_part"), F.coalesce(before, F.lit(0)).alias("before"))
    fields = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if keep_ids else "")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                raw = expand(_unpacked(row)).tobytes()
                ends = np.cumsum(row["doc_tokens"])
                starts = ends - row["doc_tokens"]
                each = [raw[4 * a : 4 * z] for a, z in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(row["before"] + row["first"] + starts), pa.array(row["doc_tokens"], pa.int64()), pa.array([zlib.crc32(x) for x in each], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(each, pa.binary())] if keep_ids else []), [f.split()[0] for f in fields.split(", ")])

    needed = ["first", "doc_ids", "doc_tokens", "width", "terminals", "rules", "lengths", "symbols", "marks"]
    return shards.join(F.broadcast(parts), F.col("part") == F.col("of_part")).select("before", *needed).mapInArrow(unpack, fields)


def fetch(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of some documents: only their shards are read, only their ranges are expanded."""
    wanted = sorted(set(doc_ids))
    asked = F.lit(False)
    for d in wanted:
        asked = asked | ((F.col("least_doc") <= d) & (F.col("largest_doc") >= d))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = set(wanted)
        for b in batches:
            for row in b.to_pylist():
                packed, at = _unpacked(row), 0
                for doc_id, n in zip(row["doc_ids"], row["doc_tokens"], strict=True):
                    if doc_id in known:
                        yield pa.RecordBatch.from_pydict({"doc_id": pa.array([doc_id], pa.int64()), "ids": pa.array([expand_range(packed, at, at + n).tolist()], pa.list_(pa.int64()))})
                    at += n

    return spark.read.parquet(path).where(asked).mapInArrow(unpack, "doc_id long, ids array<long>")


def token_files(docs: DataFrame, vocabulary_file: str, path: str | None = None, **options) -> DataFrame:
    """``write_ids``, then ``read_ids``: doc_id, start, n_tokens, ids_crc32.

    Null text is empty text, null ids come last, repeated rows are documents of their own, extra
    columns are ignored, an empty table gives an empty result. Texts of any length are encoded
    whole; a shard holds whole documents, so one of more than ``shard_ids`` ids is a shard alone.
    """
    path = path or scratch_path(docs.sparkSession, "token-files")
    write_ids(docs, vocabulary_file, path, **options)
    return read_ids(docs.sparkSession, path)
