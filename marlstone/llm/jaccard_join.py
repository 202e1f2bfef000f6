"""N-gram Jaccard join over signature trees, and the components of its links.

Two documents link when their sets of 5-word shingles have a Jaccard similarity of at least
``percent`` / 100. The join is exact up to collisions of 64-bit shingle hashes.

1. Copies (equal texts but for white space) are grouped first; one node stands for each group.
2. Every document is read for its signature (a bitmap of its shingles) and for shingles that many
   documents share. A shingle that a task sees ``local`` times is reported, so any shingle with a
   count above ``local`` times the number of tasks is found. Those common shingles sort last in
   the order of all shingles.
3. Partitions: in that order, linked sets share a shingle among the first n - ceil(t n) + 1 of
   each. Of the nodes that meet in such a shingle, that in whose order it stands earliest leads.
   All nodes that met under one leader are a block. A common shingle is dealt over several
   tasks by a hash of the node; the leader of all is the earliest of the leaders of its parts.
4. In each block a signature tree is built: leaves hold the OR of their nodes' bitmaps and the
   range of their sizes, inner nodes the OR and range of their children. First the tree is
   searched with the signature of the block's leader. Links found this way join most near copies
   to their original, so that a large group costs a star, not all pairs.
5. In each block that then still holds several components the tree is traversed against itself;
   a pair of tree nodes is pruned if the most that two of their sets can share falls short of
   what the smallest sizes need, if the size ranges exclude each other, or if both hold one
   component only.
6. Pairs that survive are verified on the shingle sets of the whole texts.
7. Components of all links: star contraction on a table in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, keep_decided, materialise, worker_cache
from .exact_dedup import normalised_text

K = 5
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
NOTHING = np.empty(0, np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * M2
    x = (x ^ (x >> np.uint64(29))) * M1
    return x ^ (x >> np.uint64(32))


_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[ord("A") : ord("Z") + 1] += np.uint64(32)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2 ** 64
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 ** 64, up to the longest text seen."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << n.bit_length()
        steps = np.full((2, size), 1, np.uint64)
        steps[0, 1:], steps[1, 1:] = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
        _powers = tuple(np.multiply.accumulate(steps, axis=1))
    return _powers


def word_hashes(text: str) -> np.ndarray:
    """64-bit hash of each lower-cased word of a text, in order: a polynomial of its bytes, mixed.

    One prefix sum over the bytes gives all words at once.
    """
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    space = np.ones(len(raw) + 2, bool)
    space[1:-1] = _SPACE[raw]
    start = np.flatnonzero(space[:-2] & ~space[1:-1])
    end = np.flatnonzero(~space[1:-1] & space[2:]) + 1
    if not len(start):
        return NOTHING
    up, down = _power_table(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_LOWER[raw] * up[: len(raw)], out=total[1:])
    return _mix((total[end] - total[start]) * down[start])


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles; of a shorter text, its whole sequence."""
    h = word_hashes(text) if text else NOTHING
    if not len(h):
        return NOTHING
    width = min(K, len(h))
    n = len(h) - width + 1
    x = np.full(n, width, np.uint64)
    for k in range(width):
        x += h[k : k + n] * _PLACES[k]
    return np.unique(_mix(x))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


# -- signature trees ---------------------------------------------------------------------------

#: Members of a leaf.
LEAF = 8


def popcount(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits).sum(-1, dtype=np.int64)


def signature(tokens: np.ndarray, log2_bits: int) -> np.ndarray:
    """Bitmap (uint64 words) of a token set; bits go by the top of the hash, so it folds by halves."""
    out = np.zeros(1 << log2_bits, np.uint8)
    out[(tokens >> np.uint64(64 - log2_bits)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").view(np.uint64)


def signature_bits(n: int) -> int:
    """Log2 of the width for a set of ``n``: two to four bits a shingle, from 2,048 bits to 65,536."""
    return min(16, max(11, (2 * n - 1).bit_length()))


def fold(bits: np.ndarray, log2_from: int, log2_to: int) -> np.ndarray:
    """Bitmaps (last axis) of the same sets at a smaller width."""
    if log2_from == log2_to:
        return bits
    if bits.ndim == 2 and len(bits) > 256:  # unpacked bits take eight times the room
        return np.concatenate([fold(bits[i : i + 256], log2_from, log2_to) for i in range(0, len(bits), 256)])
    b = np.unpackbits(bits.view(np.uint8), axis=-1, bitorder="little")
    b = b.reshape(*b.shape[:-1], 1 << log2_to, -1).any(-1)
    return np.packbits(b, axis=-1, bitorder="little").view(np.uint64)


class SignatureTree:
    """Members in order of size: ``bits`` (members, words), ``n`` their sizes, ``component``.

    ``levels[0]`` are the leaves. Of every tree node: OR of bitmaps, smallest and largest size,
    most tokens lost to shared bits, and its one component or -1.
    """

    def __init__(self, bits: np.ndarray, n: np.ndarray, component: np.ndarray):
        self.bits, self.n, self.component = bits, n, component
        self.lost = n - popcount(bits)
        self.levels = []
        low, high, lost, own, comp = n, n, self.lost, bits, component
        first = True
        while first or len(low) > 1:
            starts = np.arange(0, len(low), LEAF if first else 4)
            same = np.minimum.reduceat(comp, starts) == np.maximum.reduceat(comp, starts)
            comp_up = np.where(same, np.minimum.reduceat(comp, starts), -1)
            comp_up = np.where(np.minimum.reduceat(comp, starts) < 0, -1, comp_up)
            own = np.bitwise_or.reduceat(own, starts, axis=0)
            low, high, lost, comp = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts), np.maximum.reduceat(lost, starts), comp_up
            self.levels.append((own, low, high, lost, comp))
            first = False

    def may_link(self, bits_a, low_a, high_a, lost_a, comp_a, bits_b, low_b, high_b, lost_b, comp_b, percent):
        """False where no set of a can link to one of another component of b."""
        most = popcount(bits_a & bits_b) + np.minimum(lost_a, lost_b)
        most = np.minimum(most, np.minimum(high_a, high_b))
        need = -(-percent * (low_a + low_b) // (100 + percent))
        sizes = (100 * high_a >= percent * low_b) & (100 * high_b >= percent * low_a)
        return (most >= need) & sizes & ~((comp_a == comp_b) & (comp_a >= 0))

    def search(self, bits: np.ndarray, n: int, percent: int) -> np.ndarray:
        """Members that the bounds let link to a set of ``n`` tokens with these ``bits``."""
        lost = n - int(popcount(bits))
        one = (n, n, lost, -1)
        at = np.zeros(1, np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            own, low, high, most_lost, _ = (x[at] for x in self.levels[level])
            at = at[self.may_link(own, low, high, most_lost, np.zeros(len(at)), bits, *one, percent)]
            wide, below = (LEAF, len(self.n)) if level == 0 else (4, len(self.levels[level - 1][1]))
            at = (at[:, None] * wide + np.arange(wide)).ravel()
            at = at[at < below]
        return at[self.may_link(self.bits[at], self.n[at], self.n[at], self.lost[at], np.zeros(len(at)), bits, *one, percent)]

    def pairs(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Member pairs (i < j) of different components that the bounds do not exclude."""
        top = len(self.levels) - 1
        stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, a, b = stack.pop()
            if len(a) > 4096:
                half = len(a) // 2
                stack += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
                continue
            t = self.levels[level]
            ok = self.may_link(*(x[a] for x in t), *(x[b] for x in t), percent)
            # a tree node against itself: only its own one component excludes it
            ok |= (a == b) & (t[4][a] < 0)
            a, b = a[ok], b[ok]
            if not len(a):
                continue
            wide, below = (LEAF, len(self.n)) if level == 0 else (4, len(self.levels[level - 1][1]))
            x = (a[:, None] * wide + np.arange(wide))[:, :, None] + np.zeros((1, 1, wide), np.int64)
            y = (b[:, None] * wide + np.arange(wide))[:, None, :] + np.zeros((1, wide, 1), np.int64)
            x, y = x.ravel(), y.ravel()
            keep = (x < below) & (y < below) & ((x < y) if level == 0 else (x <= y))
            x, y = x[keep], y[keep]
            if level:
                stack.append((level - 1, x, y))
                continue
            for s in range(0, len(x), 8192):
                i, j = x[s : s + 8192], y[s : s + 8192]
                c = self.component
                ok = self.may_link(self.bits[i], self.n[i], self.n[i], self.lost[i], c[i], self.bits[j], self.n[j], self.n[j], self.lost[j], c[j], percent)
                if ok.any():
                    yield i[ok], j[ok]


# -- components --------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes in ``edges`` (a, b): the smallest node each can reach.

    Alternating large-star and small-star contraction; every round is one table in the shared
    folder, and no node gathers its neighbours in a task: only minima are kept, in partial
    aggregates. Rounds grow with the logarithm of the longest chain.
    """
    e = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    while True:
        # large star: larger neighbours of a node go to the smallest of its neighbourhood
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "node")
        large = both.join(least, F.col("a") == F.col("node")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialise(large.where("a <> b").distinct(), "cc")
        # small star: smaller neighbours and the node itself go to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("k")).withColumnRenamed("a", "node")
        small = large.join(low, F.col("a") == F.col("node"))
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select(F.col("node").alias("a"), F.col("m").alias("b")))
        small = materialise(small.where("a <> b").distinct(), "cc")
        # done when every node has one parent and no parent has a parent
        many = small.groupBy("a").count().where("count > 1").limit(1).count()
        deep = small.alias("x").join(small.alias("y"), F.col("x.b") == F.col("y.a"), "left_semi").limit(1).count()
        discard(e, large)
        e = small
        if not many and not deep:
            break
    return e.select(F.col("a").alias("node"), F.col("b").alias("component"))


# -- the join ----------------------------------------------------------------------------------


def _prefix_order(tokens: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Token hashes in the order of all shingles: the common ones last, each part by hash."""
    if not len(common):
        return tokens
    late = common[np.minimum(np.searchsorted(common, tokens), len(common) - 1)] == tokens
    return np.concatenate([tokens[~late], tokens[late]])


def _seen(local: int, at_once: int = 1_000_000):
    """Per task: size and signature of every node, and the shingles counted ``local`` times or more among ``at_once``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker_cache("jaccard")
        kept, size = [], 0

        def counted():
            x, n = np.unique(np.concatenate(kept), return_counts=True)
            return pd.DataFrame({"node": -1, "token": x[n >= local].view(np.int64), "n": n[n >= local], "bits": None})

        for b in batches:
            for begin in range(0, len(b), 1000):
                part = b.iloc[begin : begin + 1000]
                sets = [shingle_set(t) for t in part.text]
                kept += sets
                size += sum(map(len, sets))
                if size > at_once:
                    yield counted()
                    kept, size = [], 0
                yield pd.DataFrame({"node": part.node.to_numpy(), "token": 0, "n": [len(x) for x in sets], "bits": [signature(x, signature_bits(len(x))).tobytes() for x in sets]})
        if kept:
            yield counted()

    return run


def _postings(common: np.ndarray, percent: int):
    """``common``: shingles and the parts that each is dealt over, two columns in order of the first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker_cache("jaccard")
        late, parts = common.value
        for b in batches:
            for begin in range(0, len(b), 300):
                part = b.iloc[begin : begin + 300]
                tokens, nodes, sizes, places = [NOTHING], [], [], [np.empty(0, np.int32)]
                for node, t in zip(part.node, part.text, strict=True):
                    x = shingle_set(t)
                    if len(x):
                        tokens.append(_prefix_order(x, late)[: prefix_length(len(x), percent)])
                        nodes.append(node)
                        sizes.append(len(x))
                        places.append((20 * np.arange(len(tokens[-1])) // len(x)).astype(np.int32))
                many = [len(x) for x in tokens[1:]]
                token, node = np.concatenate(tokens), np.repeat(np.array(nodes, np.int64), many)
                dealt = np.zeros(len(token), np.int32)
                if len(late):
                    at = np.minimum(np.searchsorted(late, token), len(late) - 1)
                    split = np.flatnonzero((late[at] == token) & (parts[at] > 1))
                    dealt[split] = 1 + (_mix(node[split].view(np.uint64)) % parts[at[split]].astype(np.uint64)).astype(np.int32)
                yield pd.DataFrame({"token": token.view(np.int64), "part": dealt, "node": node, "n": np.repeat(np.array(sizes, np.int32), many), "place": np.concatenate(places)})

    return run


def _runs(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Batches cut where the key changes, with the first row of each run; the input is sorted by the key.

    The parts of a run that is still open are held as they came and put together once.
    """
    rest: list[pd.DataFrame] = []

    def closed() -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
        if rest:
            whole = pd.concat(rest, ignore_index=True) if len(rest) > 1 else rest[0]
            rest.clear()
            yield whole, _starts(whole, key)

    for b in batches:
        if not len(b):
            continue
        last = int(_starts(b, key)[-1])
        if rest and any(b[k].iloc[0] != rest[0][k].iloc[-1] for k in key):
            yield from closed()
        if last:
            rest.append(b.iloc[:last])
            yield from closed()
        rest.append(b.iloc[last:])
    yield from closed()


def _starts(b: pd.DataFrame, key: list[str]) -> np.ndarray:
    new = np.zeros(len(b), bool)
    new[0] = True
    for k in key:
        v = b[k].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def _meetings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(token, leader, place, node, n) of every (shingle, part) that two nodes or more have, the leader included.

    The leader of a shingle is the node in whose order it stands earliest, in twentieths of its
    set, then the smallest. An original comes before its edited copies: their own shingles are
    rarer and stand before the shared ones. ``token`` is null but for shingles in several parts,
    of which a single node is reported, too.
    """
    for b, starts in _runs(batches, ["token", "part"]):
        sizes = np.diff([*starts, len(b)])
        node, place = b.node.to_numpy(), b.place.to_numpy()
        run_of = np.repeat(np.arange(len(starts)), sizes)
        least = np.minimum.reduceat(place, starts)[run_of]
        early = np.flatnonzero(place == least)
        _, first = np.unique(run_of[early], return_index=True)
        leader = node[early[first]][run_of]
        dealt = b.part.to_numpy() > 0
        shared = (np.maximum.reduceat(node, starts) > np.minimum.reduceat(node, starts))[run_of] | dealt
        token = pd.array(b.token.to_numpy()[shared], dtype="Int64")
        token[~dealt[shared]] = pd.NA
        yield pd.DataFrame({"token": token, "leader": leader[shared], "place": least[shared], "node": node[shared], "n": b.n.to_numpy()[shared]})


class _Signatures:
    """The bitmaps of a batch by width, and how near pairs of them can be."""

    def __init__(self, raw, n: np.ndarray):
        self.n = n
        self.width = np.array([(8 * len(x)).bit_length() - 1 for x in raw])
        self.place = np.zeros(len(n), np.int64)
        self.at: dict[tuple[int, int], np.ndarray] = {}
        for w in np.unique(self.width):
            mine = np.flatnonzero(self.width == w)
            self.place[mine] = np.arange(len(mine))
            self.at[w, w] = np.frombuffer(b"".join(raw[i] for i in mine), np.uint64).reshape(len(mine), -1)

    def of(self, members: np.ndarray, w_to: int) -> np.ndarray:
        """Bitmaps of members of one width, at that width or a smaller one."""
        w = int(self.width[members[0]])
        if (w, w_to) not in self.at:
            self.at[w, w_to] = fold(self.at[w, w], w, w_to)
        return self.at[w, w_to][self.place[members]]

    def may_link(self, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
        ok = np.zeros(len(i), bool)
        need = -(-percent * (self.n[i] + self.n[j]) // (100 + percent))
        kind = self.width[i] * 64 + self.width[j]
        for k in np.unique(kind):
            at = np.flatnonzero(kind == k)
            w = int(min(k // 64, k % 64))
            for s in range(0, len(at), 8192):
                p = at[s : s + 8192]
                a, b = self.of(i[p], w), self.of(j[p], w)
                lost = np.minimum(self.n[i[p]] - popcount(a), self.n[j[p]] - popcount(b))
                ok[p] = popcount(a & b) + lost >= need[p]
        return ok


def _search(percent: int):
    """Pairs (leader, node) of each (block, part) by a search of its signature tree with the leader's signature."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b, starts in _runs(batches, ["leader", "part"]):
            node, n, leader = (b[c].to_numpy(np.int64) for c in ("node", "n", "leader"))
            signed = _Signatures(b.bits.to_list(), n)
            sizes = np.diff([*starts, len(b)])
            run_of = np.repeat(np.arange(len(starts)), sizes)
            own = np.flatnonzero(node == leader)
            _, first = np.unique(run_of[own], return_index=True)
            head = np.full(len(starts), -1)
            head[run_of[own[first]]] = own[first]
            small = np.flatnonzero((sizes[run_of] <= LEAF) & (node != leader))  # one leaf: all of them at once
            i, j = head[run_of[small]], small
            ok = signed.may_link(i, j, percent)
            out = [np.stack([i[ok], j[ok]])]
            for run_no in np.flatnonzero(sizes > LEAF):
                i = head[run_no]
                members = starts[run_no] + np.argsort(n[starts[run_no] : starts[run_no] + sizes[run_no]], kind="stable")
                near = members[np.abs(signed.width[members] - signed.width[i]) <= 1]  # linked sets differ by one width at most
                w = int(signed.width[near].min())
                folded = np.empty((len(near), (1 << w) // 64), np.uint64)
                for width in np.unique(signed.width[near]):
                    mine = signed.width[near] == width
                    folded[mine] = signed.of(near[mine], w)
                tree = SignatureTree(folded, n[near], near)
                j = near[tree.search(signed.of(np.array([i]), w)[0], int(n[i]), percent)]
                out.append(np.stack([np.full(len(j), i), j]))
            i, j = np.concatenate(out, axis=1)
            pairs = pd.DataFrame({"a": leader[i], "b": node[j]})
            yield pairs[pairs.a != pairs.b]

    return run


def _traverse(percent: int):
    """Candidate pairs of each (block, tile pair) by dual traversal of signature trees."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b, starts in _runs(batches, ["leader", "t1", "t2"]):
            node, n, comp, tile = (b[c].to_numpy(np.int64) for c in ("node", "n", "comp", "tile"))
            cross = (b.t1 != b.t2).to_numpy()
            signed = _Signatures(b.bits.to_list(), n)
            sizes = np.diff([*starts, len(b)])
            run_of = np.repeat(np.arange(len(starts)), sizes)
            small = sizes[run_of] <= LEAF
            out_a, out_b = [], []
            for d in range(1, LEAF):  # small blocks are one leaf: their pairs, all blocks at once
                if d >= len(b):
                    break
                i = np.flatnonzero((run_of[:-d] == run_of[d:]) & small[d:])
                j = i + d
                ok = (comp[i] != comp[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])) & (~cross[i] | (tile[i] != tile[j]))
                i, j = i[ok], j[ok]
                ok = signed.may_link(i, j, percent)
                out_a.append(i[ok])
                out_b.append(j[ok])
            for s, size in zip(starts, sizes):
                if size <= LEAF:
                    continue
                members = s + np.argsort(n[s : s + size], kind="stable")
                width = signed.width[members]
                for w in np.unique(width):  # linked sets differ by one width at most
                    pick = members[(width == w) | (width == w + 1)]
                    own = signed.width[pick] == w
                    folded = np.empty((len(pick), (1 << int(w)) // 64), np.uint64)
                    for side in (own, ~own):
                        if side.any():
                            folded[side] = signed.of(pick[side], int(w))
                    for i, j in SignatureTree(folded, n[pick], comp[pick]).pairs(percent):
                        ok = own[i] | own[j]
                        i, j = pick[i[ok]], pick[j[ok]]
                        ok = ~cross[i] | (tile[i] != tile[j])
                        out_a.append(i[ok])
                        out_b.append(j[ok])
            i, j = np.concatenate(out_a or [np.empty(0, np.int64)]), np.concatenate(out_b or [np.empty(0, np.int64)])
            first = node[i] < node[j]
            yield pd.DataFrame({"a": np.where(first, node[i], node[j]), "b": np.where(first, node[j], node[i])}).drop_duplicates()

    return run


#: Bits of the filter that keeps texts nobody asks for out of a shuffle: a fixed 8 MB.
FILTER_BITS = 26


def _asked_for(wanted: DataFrame) -> np.ndarray:
    """A bitmap of hashed nodes (one column), combined in the tasks: of a fixed size, and some other nodes pass it."""
    slot = F.pmod(F.xxhash64(wanted.columns[0]), F.lit(1 << FILTER_BITS))
    bits = wanted.select(slot.alias("s")).select(F.shiftright("s", 6).alias("word"), F.expr("shiftleft(1L, cast(s & 63 as int))").alias("bit"))
    found = bits.groupBy("word").agg(F.bit_or("bit").alias("bit")).toPandas()  # 2 ** 20 rows at most
    table = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    table[found.word.to_numpy(np.int64)] = found.bit.to_numpy(np.int64).view(np.uint64)
    return table


def _in_bitmap(table: np.ndarray, slots: pd.Series) -> np.ndarray:
    s = slots.to_numpy(np.int64)
    return (table[s >> 6] >> (s & 63).astype(np.uint64)) & np.uint64(1) > 0


def _wanted_only(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts but for most of those whose node is not in ``wanted``; a join must still follow."""
    shared = texts.sparkSession.sparkContext.broadcast(_asked_for(wanted))

    @F.pandas_udf("boolean")
    def asked(slots: pd.Series) -> pd.Series:
        return pd.Series(_in_bitmap(shared.value, slots))

    return texts.where(asked(F.pmod(F.xxhash64("node"), F.lit(1 << FILTER_BITS))))


def _verify(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose texts link. Each text is joined to its pairs; a node of many pairs is dealt by Spark's skew join."""

    def checked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, last_set = None, NOTHING
        for p in batches:
            ok = np.zeros(len(p), bool)
            for i, (a, x, y) in enumerate(zip(p.a, p.x, p.y, strict=True)):
                if a != last:
                    last, last_set = a, shingle_set(x)
                ok[i] = linked(last_set, shingle_set(y), percent)
            yield p.loc[ok, ["a", "b"]]

    texts = _wanted_only(texts, pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))))
    x, y = texts.select(F.col("node").alias("_x"), F.col("text").alias("x")), texts.select(F.col("node").alias("_y"), F.col("text").alias("y"))
    both = pairs.select("a", "b").join(x, F.col("a") == F.col("_x")).join(y, F.col("b") == F.col("_y"))
    return both.select("a", "b", "x", "y").mapInPandas(checked, "a long, b long")


def _grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ids, groups, nodes): rows (doc_id, key), one row per distinct text (key, first, node), and its text."""
    key = F.unhex(F.md5(normalised_text(F.col("text"))))
    keyed = docs.select("doc_id", "text").withColumn("key", key)
    ids = materialise(keyed.select("doc_id", "key"), "jaccard-ids")
    groups = ids.groupBy("key").agg(F.min("doc_id").alias("first"))
    groups = materialise(groups.withColumn("node", F.monotonically_increasing_id()), "jaccard-groups")
    firsts = groups.withColumnsRenamed({"key": "_key", "first": "_first"}).hint("shuffle_hash")
    nodes = keyed.join(firsts, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_first")))
    return ids, groups, materialise(nodes.select("node", F.col("_first").isNotNull().alias("named"), "text"), "jaccard-nodes")


def _blocks(named: DataFrame, seen: DataFrame, percent: int, most_common: int, part_rows: int) -> DataFrame:
    """(leader, node, s, n): nodes that share ``s`` prefix shingles under a leader, itself included."""
    frequent = seen.where("node < 0").groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(most_common).toPandas()
    frequent = frequent.assign(token=frequent.token.to_numpy(np.int64).view(np.uint64)).sort_values("token")
    common = named.sparkSession.sparkContext.broadcast((frequent.token.to_numpy(), (frequent.n.to_numpy(np.int64) // part_rows + 1).astype(np.int32)))  # most_common at most

    postings = named.mapInPandas(_postings(common, percent), "token long, part int, node long, n int, place int")
    met = postings.repartition("token", "part").sortWithinPartitions("token", "part", "node").mapInPandas(_meetings, "token long, leader long, place int, node long, n int")
    met = met.groupBy("token", "leader", "place", "node", "n").agg(F.count("*").alias("s"))
    met = materialise(met, "jaccard-parts")
    # a shingle in several parts: the earliest of their leaders leads all; most_common rows at most
    dealt = met.where("token IS NOT NULL")
    heads = dealt.groupBy("token").agg(F.min(F.struct("place", "leader")).alias("head"), F.count("*").alias("k")).where("k > 1").select(F.col("token").alias("_token"), F.col("head.leader").alias("_leader"))
    dealt = dealt.join(F.broadcast(heads), F.col("token") == F.col("_token")).select(F.col("_leader").alias("leader"), "node", "n", "s")
    both = met.where("token IS NULL").select("leader", "node", "n", "s").unionByName(dealt)
    both = materialise(both.groupBy("leader", "node").agg(F.sum("s").alias("s"), F.max("n").alias("n")), "jaccard-met")
    discard(met)
    return both


def _dealt(rows: DataFrame, part_rows: int) -> DataFrame:
    """Adds ``parts`` to rows of (leader, node): of so many rows each that a part of a block fits a task.

    Only blocks larger than a part are joined, which are few.
    """
    large = rows.groupBy("leader").agg(F.count("*").alias("rows")).where(F.col("rows") > part_rows)
    large = materialise(large.select(F.col("leader").alias("_leader"), F.ceil(F.col("rows") / part_rows).cast("int").alias("_parts")), "jaccard-large")
    side = F.broadcast(large) if large.count() <= MOST_BROADCAST else large
    return rows.join(side, F.col("leader") == F.col("_leader"), "left").withColumn("parts", F.coalesce("_parts", F.lit(1))).drop("_leader", "_parts")


#: Parts that a leader or a component is joined in.
SALTS = 16
#: Large blocks up to this number are made known to every task; more are joined by a shuffle.
MOST_BROADCAST = 200_000


def _star_pairs(met: DataFrame, signed: DataFrame, percent: int, part_rows: int) -> DataFrame:
    """Pairs (a leader, a node of its block) that the search of its signature tree leaves.

    Only nodes that share a twentieth of their shingles with the leader are searched here; what
    is missed is found by the traversal.
    """
    near = _dealt(met.where("node = leader OR 20 * s >= n"), part_rows)
    near = near.select("leader", "node", "parts", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"))
    parts = F.sequence(F.lit(0), F.col("parts") - 1)
    heads = near.where("node = leader").select("leader", "node", F.explode(parts).alias("part"))  # the leader goes to every part
    rows = near.where("node <> leader").select("leader", "node", "part").unionByName(heads)
    rows = rows.join(signed, F.col("node") == F.col("s_node")).drop("s_node")
    return rows.repartition("leader", "part").sortWithinPartitions("leader", "part").mapInPandas(_search(percent), "a long, b long")


def _tree_pairs(met: DataFrame, known: DataFrame, signed: DataFrame, percent: int, tile_rows: int, part_rows: int) -> DataFrame:
    """Pairs of different components in blocks that hold several, by dual traversal.

    The nodes of a block's largest component need comparing with the others only: they are dealt
    over tiles, and the others go to each. Where the others alone are more than ``tile_rows``, all
    nodes are dealt, and every pair of tiles is traversed.
    """
    held = met.select("leader", "node").join(known.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
    held = materialise(held.select("leader", "node", F.coalesce("component", "node").alias("comp")), "jaccard-held")
    sizes = held.groupBy("leader", "comp").agg(F.count("*").alias("n"))
    blocks = sizes.groupBy("leader").agg(F.count("*").alias("comps"), F.sum("n").alias("size"), F.max(F.struct("n", "comp")).alias("main")).where("comps > 1")
    few = F.col("size") - F.col("main.n") <= tile_rows
    tiles = F.when(few, F.ceil(F.col("main.n") / part_rows)).otherwise(F.ceil(F.col("size") / tile_rows)).cast("int")
    blocks = blocks.select(F.col("leader").alias("_leader"), F.when(few, F.col("main.comp")).alias("main"), few.alias("few"), tiles.alias("tiles"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")
    left = held.withColumn("salt", salt).join(blocks, (F.col("leader") == F.col("_leader")) & (F.col("salt") == F.col("_salt"))).drop("_leader", "_salt", "salt")
    left = left.withColumn("tile", F.pmod(F.xxhash64("node", F.lit(1)), F.col("tiles")).cast("int"))
    everywhere = F.sequence(F.lit(0), F.col("tiles") - 1)
    left = left.withColumn("other", F.explode(F.when(F.coalesce(F.col("comp") == F.col("main"), F.lit(False)), F.array("tile")).otherwise(everywhere)))
    left = left.withColumn("tile", F.when(F.col("few"), F.col("other")).otherwise(F.col("tile")))
    left = left.select("leader", F.least("tile", "other").alias("t1"), F.greatest("tile", "other").alias("t2"), "tile", "node", "comp")
    rows = left.join(signed, F.col("node") == F.col("s_node")).drop("s_node")
    found = rows.repartition("leader", "t1", "t2").sortWithinPartitions("leader", "t1", "t2", "n", "node").mapInPandas(_traverse(percent), "a long, b long")
    pairs = materialise(found.distinct(), "jaccard-pairs")
    discard(held)
    return pairs


def find_links(nodes: DataFrame, percent: int = 75, local: int = 8, most_common: int = 1_000_000, tile_rows: int = 20_000, part_rows: int = 1_000) -> tuple[DataFrame, DataFrame]:
    """(sizes, links) of ``nodes`` (node, named, text): sets' sizes, and links that span all components.

    Nodes that are not ``named`` have a size, but no link.
    """
    seen = materialise(nodes.select("node", "text").mapInPandas(_seen(local), "node long, token long, n long, bits binary"), "jaccard-seen")
    sizes = seen.where("node >= 0").select("node", "n").distinct()
    signed = seen.where("node >= 0").select(F.col("node").alias("s_node"), "n", "bits").dropDuplicates(["s_node"])
    named = nodes.where("named").select("node", "text")
    met = _blocks(named, seen, percent, most_common, part_rows)
    stars = materialise(_star_pairs(met, signed, percent, part_rows), "jaccard-stars")
    star_links = materialise(_verify(stars, named, percent), "jaccard-links")
    known = components(star_links)
    pairs = _tree_pairs(met, known, signed, percent, tile_rows, part_rows)
    tree_links = materialise(_verify(pairs, named, percent), "jaccard-links")
    sizes = materialise(sizes, "jaccard-sizes")
    discard(seen, met, stars, known, pairs)
    return sizes, star_links.unionByName(tree_links)


def _components(docs: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """(ids, table): rows (doc_id, key), and key, root, n_shingles, component_id of each distinct text."""
    ids, groups, nodes = _grouped(docs)
    sizes, links = find_links(nodes, **options)
    discard(nodes)
    member = components(links).withColumnsRenamed({"node": "_m"})
    sized = sizes.withColumnsRenamed({"node": "_s", "n": "n_shingles"})
    table = groups.join(sized, F.col("node") == F.col("_s")).join(member, F.col("node") == F.col("_m"), "left")
    table = materialise(table.select("key", "first", "n_shingles", F.coalesce("component", "node").alias("root")), "jaccard-table")
    # components of several texts only, and each in ``SALTS`` parts, for one may hold very many
    roots = table.groupBy("root").agg(F.count("*").alias("n"), F.min(F.struct("first", "key")).alias("stays")).where("n > 1")
    roots = roots.select(F.col("root").alias("_root"), "stays", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salt = F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")
    table = table.withColumn("salt", salt).join(roots, (F.col("root") == F.col("_root")) & (F.col("salt") == F.col("_salt")), "left")
    alone = F.col("stays").isNull()
    return ids, table.select("key", "n_shingles", F.when(alone, F.col("first")).otherwise(F.col("stays.first")).alias("component_id"), F.when(alone, F.col("key")).otherwise(F.col("stays.key")).alias("stays_key"))


def jaccard_components(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    ``component_id``: the smallest doc_id that links lead to, the document itself included. Null,
    empty and blank texts have no shingle and no link: their component is their own doc_id. A
    null doc_id takes part in no link and has a null component. Rows that repeat a doc_id with
    different texts are each joined by their own text. Extra columns are ignored; an empty table
    gives an empty result. A number of links a document is not given: it would take all pairs
    of a group. ``options``: see ``find_links``.
    """
    ids, table = _components(docs, **options)
    found = ids.join(table.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key"))
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return found.select("doc_id", "n_shingles", component.alias("component_id"))


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents, with all their columns, one row of each component of linked texts.

    It is a row of the smallest doc_id, and of its texts in that component the smallest by key.
    Rows are told apart by doc_id and text, not by doc_id alone. Documents without shingles (null,
    empty, blank) and those with a null doc_id are all kept. Extra columns are kept, whatever
    their names; an empty table gives an empty result.
    """
    ids, table = _components(docs, **options)
    linked = table.where("n_shingles > 0").select(F.col("key").alias("_key"), "component_id", "stays_key")
    rows = ids.where("doc_id IS NOT NULL").join(linked, F.col("key") == F.col("_key"))
    stays = (F.col("doc_id") == F.col("component_id")) & (F.col("key") == F.col("stays_key"))
    decided = rows.groupBy("doc_id", "key").agg(F.max(stays).alias("stays"), F.count("*").alias("n")).where("n > 1 OR NOT stays")
    decided = materialise(decided.select("doc_id", "key", "stays"), "jaccard-decided")
    return keep_decided(docs, decided, lambda text: F.unhex(F.md5(normalised_text(text))))
