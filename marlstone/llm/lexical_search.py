"""Ranked lexical search over a bit-sliced impact index.

Documents are dealt into shards of at most ``SHARD`` documents, which the map task that reads
them makes: no posting is shuffled to build the index. Within a shard the documents are numbered
by rising doc_id. The posting list of a term in a shard holds the numbers of its documents and
the bits of their impacts as ``IMPACT_BITS`` bitmaps, bit b of all its impacts together.

A search reads only the lists of the terms asked, one group a shard:

1. Impacts are multiplied by the term's weight with shifts and bitwise additions, over all asked
   lists of the shard at once.
2. The products become bitmaps over the shard's documents, and each item's sum is made by bitwise
   carry arithmetic: 64 documents a machine word, all items of a step together.
3. The best k documents are found by descending the slices of the sum, the most significant first:
   a bitmap of documents that are surely in, one of documents that are still equal.

A shard gives at most k rows an item; Spark ranks those. Memory depends on the size of a shard,
not on the corpus.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, materialise, scratch_path

#: Documents and tokens of a shard: it ends with the document that reaches either.
SHARD, SHARD_TOKENS = 8192, 4_000_000
#: Bits of an impact: (1e9 * tf) div (1000 * tf + 8 * m) is below 1e6 for m of 25 or more.
IMPACT_BITS = 20
#: Items that are summed together, and terms whose bitmaps are held at a time.
ITEMS_TOGETHER, TERMS_TOGETHER = 256, 1024
#: Items of a block: a shard is searched once for each block.
BLOCK = 4096
#: Asked (item, term) pairs up to this number go to every task; more are joined by a shuffle.
MOST_BROADCAST = 1_000_000
#: A-Z become a-z; every other ASCII character but 0-9 and a-z separates terms.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text in order; a separator is one ASCII byte, so no character is cut."""
    return text.translate(_PLAIN).split() if text else []


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[list[bytes]]]]:
    """(ids, terms of each text) in small parts of the batches."""
    for b in batches:
        for begin in range(0, b.num_rows, 256):
            part = b.slice(begin, 256)
            yield part.column(0).to_pylist(), [terms_of(t) for t in part.column(1).cast(pa.large_binary()).to_pylist()]


def corpus_facts(docs: DataFrame) -> tuple[int, int]:
    """(documents with a term, all their terms)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in _texts(batches):
            sizes = [len(t) for t in found if t]
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(sizes)], pa.int64()), "l": pa.array([sum(sizes)], pa.int64())})

    one = docs.select(F.lit(0).alias("_"), "text").mapInArrow(count, "n long, l long").agg(F.sum("n").alias("n"), F.sum("l").alias("l")).first()
    return one.n or 0, one.l or 0


def bit_slices(values: np.ndarray, starts: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): bit b of each list's values as one bitmap, a list's bitmaps one after another.

    ``starts``: where each list begins in ``values``; a bitmap ends at a whole byte.
    """
    sizes = np.diff(starts, append=len(values))
    width = -(-sizes // 8)
    first = np.concatenate([[0], np.cumsum(width)])
    place = np.arange(len(values)) - np.repeat(starts, sizes) + np.repeat(8 * first[:-1], sizes)
    byte_list = np.repeat(np.arange(len(sizes)), width)
    target = np.arange(first[-1]) - first[byte_list] + bits * first[byte_list]
    out, cells = np.zeros(bits * first[-1], np.uint8), np.zeros(8 * first[-1], np.uint8)
    for b in range(bits):
        cells[place] = (values >> b) & 1
        out[target + b * width[byte_list]] = np.packbits(cells)
    return out, bits * first


def _shard_rows(shard: int, ids: list, tokens: list[np.ndarray], terms: dict[bytes, int], n: int, total: int) -> Iterator[pa.RecordBatch]:
    """The rows of one shard: its doc_ids (under the null term), then one row a term."""
    known = np.array([i is not None for i in ids])
    order = np.lexsort((np.array([i or 0 for i in ids], np.int64), ~known))
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    sizes = np.array([len(t) for t in tokens], np.int64)
    keys, tf = np.unique((np.concatenate(tokens).astype(np.int64) << 32) | np.repeat(rank, sizes), return_counts=True)
    term, at = keys >> 32, keys & 0xFFFFFFFF
    m = 25 + (75 * sizes * n) // total
    impacts = (1_000_000_000 * tf) // (1000 * tf + 8 * m[order][at])
    starts = np.flatnonzero(np.diff(term, prepend=-1))
    data, offsets = bit_slices(impacts, starts, IMPACT_BITS)
    ends = np.append(starts, len(at))
    places = at.astype("<u2" if len(ids) <= 65536 else "<u4")
    held = np.array([i or 0 for i in ids], np.int64)[order]
    yield _index_batch(shard, pa.array([None], pa.string()), [len(ids)], pa.array([held.tobytes()]), pa.array([known[order].astype(np.uint8).tobytes()]))
    names = pa.array(list(terms), pa.binary()).cast(pa.string())
    for begin in range(0, len(names), 50_000):
        a, b = begin, min(begin + 50_000, len(names))
        at_bytes = pa.array([places[ends[i] : ends[i + 1]].tobytes() for i in range(a, b)], pa.binary())
        raw = data[offsets[a] : offsets[b]]
        sliced = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer((offsets[a : b + 1] - offsets[a]).astype("<i4").tobytes()), pa.py_buffer(raw.tobytes())])
        yield _index_batch(shard, names.slice(a, b - a), np.diff(ends[a : b + 1]), at_bytes, sliced)


def _index_batch(shard: int, term, n, places, slices) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(term), shard, np.int64)), term, pa.array(np.asarray(n, np.int32)), places, slices], ["shard", "term", "n", "places", "slices"])


class ImpactIndex:
    """A stored index: ``lists`` (shard, term, n, places, slices), and the facts its impacts rest on.

    Rows of the null term hold a shard's doc_ids in order, and which of them are not null.
    """

    def __init__(self, lists: DataFrame, documents: int, tokens: int):
        self.lists, self.documents, self.tokens = lists, documents, tokens

    @classmethod
    def build(cls, docs: DataFrame, path: str | None = None, shard: int = SHARD, shard_tokens: int = SHARD_TOKENS) -> ImpactIndex:
        """Indexes every whole text of ``docs`` (doc_id, text) below ``path``, or in the shared folder.

        Texts without a term, null ones too, are not in the index. Repeated rows are documents of
        their own. Extra columns are ignored; an empty table gives an empty index.
        """
        n, total = corpus_facts(docs)

        def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = TaskContext.get().partitionId() << 32
            ids, tokens, held = [], [], 0
            terms: defaultdict[bytes, int] = defaultdict()
            terms.default_factory = terms.__len__
            for doc_ids, found in _texts(batches):
                for doc_id, words in zip(doc_ids, found, strict=True):
                    if not words:
                        continue
                    ids.append(doc_id)
                    tokens.append(np.fromiter(map(terms.__getitem__, words), np.int32, len(words)))
                    held += len(words)
                    if len(ids) == shard or held >= shard_tokens:
                        yield from _shard_rows(number, ids, tokens, terms, n, total)
                        number += 1
                        ids, tokens, held = [], [], 0
                        terms.clear()
            if ids:
                yield from _shard_rows(number, ids, tokens, terms, n, total)

        path = path or scratch_path(docs.sparkSession, "impact-index")
        schema = "shard long, term string, n int, places binary, slices binary"
        docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(index, schema).write.option("compression", "zstd").mode("overwrite").parquet(f"{path}/lists")
        facts = docs.sparkSession.range(1).select(F.lit(n).cast("long").alias("documents"), F.lit(total).cast("long").alias("tokens"))
        facts.write.mode("overwrite").parquet(f"{path}/facts")
        return cls.load(docs.sparkSession, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ImpactIndex:
        one = spark.read.parquet(f"{path}/facts").first()
        return cls(spark.read.parquet(f"{path}/lists"), one.documents, one.tokens)

    def weights(self, terms: DataFrame) -> DataFrame:
        """(term, w) of those ``terms`` (term, distinct) that a document holds."""
        found = self.lists.where("term IS NOT NULL").select("term", "n").join(terms, "term", "left_semi")
        df = found.groupBy("term").agg(F.sum("n").alias("df"))
        w = F.floor(1000 * F.log(F.lit(2 * self.documents + 2).cast("double") / (2 * F.col("df") + 1)))
        return df.select("term", w.cast("long").alias("w"))


def asked_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, qtf) of items (item_id, text); rows of one item_id are one item."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, found in _texts(batches):
            for item, words in zip(ids, found, strict=True):
                count = Counter(words)
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(count), pa.int64()), pa.array(list(count), pa.binary()).cast(pa.string()), pa.array(count.values(), pa.int64())], ["item_id", "term", "qtf"])

    each = items.select(F.col("item_id").cast("long"), "text").mapInArrow(split, "item_id long, term string, qtf long")
    return each.groupBy("item_id", "term").agg(F.sum("qtf").alias("qtf"))


# -- arithmetic on slices; slice 0 is the least significant ---------------------------------------


def add_slices(total: np.ndarray, addend: np.ndarray, shift: int = 0) -> None:
    """``total`` += ``addend`` * 2 ** ``shift``, bitwise with a carry; both (slices, ...).

    ``total`` has slices enough for the sum.
    """
    carry = np.zeros_like(total[0])
    differ, both = np.empty_like(carry), np.empty_like(carry)
    for b in range(shift, len(total)):
        a = total[b]
        if b - shift < len(addend):
            x = addend[b - shift]
            np.bitwise_and(a, x, out=both)
            np.bitwise_xor(a, x, out=differ)
            np.bitwise_xor(differ, carry, out=a)
            differ &= carry
            np.bitwise_or(both, differ, out=carry)
        else:
            if not carry.any():
                return
            np.bitwise_and(a, carry, out=both)
            a ^= carry
            carry, both = both, carry


def times_weights(slices: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The slices of each column's values times its weight: a shifted addition for each bit of a weight."""
    most = int(weights.max(initial=0)).bit_length()
    out = np.zeros((len(slices) + most, slices.shape[1]), np.uint8)
    for b in range(most):
        chosen = np.where((weights >> b) & 1, np.uint8(255), np.uint8(0))
        add_slices(out, slices & chosen, b)
    return out


def top_slices(total: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sure, tied) bitmaps for each item of ``total`` (slices, items, words): its k largest values above 0.

    ``sure`` holds at most k documents; where fewer, ``tied`` holds those of one equal value that fill up.
    """
    tied = np.bitwise_or.reduce(total, axis=0)
    sure = np.zeros_like(tied)
    for s in total[::-1]:
        high = tied & s
        found = sure | high
        n = np.bitwise_count(found).sum(axis=1, dtype=np.int64)[:, None]
        tied = np.where(n > k, high, np.where(n < k, tied & ~s, np.uint64(0)))
        sure = np.where(n > k, sure, found)
    return sure, tied


def _bitmaps(products: np.ndarray, places: list[np.ndarray], columns: list[slice], width: int) -> np.ndarray:
    """(slices, lists, words) of some lists: their products as bitmaps over the documents of the shard."""
    at = np.concatenate(places)
    sizes = np.array([len(p) for p in places])
    held = np.concatenate([np.arange(8 * c.start, 8 * c.start + n) for c, n in zip(columns, sizes, strict=True)])
    byte = np.repeat(np.arange(len(places)), sizes) * width + (at >> 3)
    starts = np.flatnonzero(np.diff(byte, prepend=-1))
    mask = (128 >> (at & 7)).astype(np.uint8)
    out = np.zeros((len(products), len(places) * width), np.uint8)
    for b, row in enumerate(products):
        bits = (row[held >> 3] >> (7 - (held & 7)).astype(np.uint8)) & 1
        out[b, byte[starts]] = np.bitwise_or.reduceat(bits * mask, starts)
    return out.reshape(len(products), len(places), width).view(np.uint64)


def search_shard(lists: list[tuple[np.ndarray, np.ndarray, int]], asking: list[list[tuple[int, int]]], documents: int, items: int, k: int, together: tuple[int, int] = (ITEMS_TOGETHER, TERMS_TOGETHER)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, place, score) of the k best documents of each item 0..items-1 in one shard.

    ``lists``: (places, slices, weight) of each term; ``asking``: its (item, repeats). Equal scores
    are ranked by place. ``together``: items and terms that are summed at a time.
    """
    width = 8 * -(-documents // 64)
    slices = np.concatenate([s for _, s, _ in lists], axis=1)
    bytes_of = np.array([s.shape[1] for _, s, _ in lists])
    ends = np.cumsum(bytes_of)
    products = times_weights(slices, np.repeat(np.array([w for _, _, w in lists], np.int64), bytes_of))
    most = np.zeros(items, object)
    for (_, _, w), asked in zip(lists, asking, strict=True):
        for item, repeats in asked:
            most[item] += int(w) * repeats << IMPACT_BITS
    out = [(np.empty(0, np.int64),) * 3]
    for begin in range(0, items, together[0]):
        end = min(begin + together[0], items)
        total = np.zeros((max(int(x).bit_length() for x in most[begin:end]) + 1, end - begin, width // 8), np.uint64)
        mine = [(t, [(i - begin, r) for i, r in asked if begin <= i < end]) for t, asked in enumerate(asking)]
        mine = sorted((x for x in mine if x[1]), key=lambda x: -len(x[1]))
        for first in range(0, len(mine), together[1]):
            part = mine[first : first + together[1]]
            maps = _bitmaps(products, [lists[t][0] for t, _ in part], [slice(ends[t] - bytes_of[t], ends[t]) for t, _ in part], width)
            steps: dict[tuple[int, int], tuple[list[int], list[int]]] = {}
            taken: Counter = Counter()
            for t, (_, asked) in enumerate(part):
                for item, repeats in asked:
                    for shift in (b for b in range(repeats.bit_length()) if repeats >> b & 1):
                        to, of = steps.setdefault((taken[item, shift], shift), ([], []))
                        taken[item, shift] += 1
                        to.append(item)
                        of.append(t)
            for (_, shift), (to, of) in steps.items():
                sums = total[:, to]
                add_slices(sums, maps[:, of], shift)
                total[:, to] = sums
        sure, tied = top_slices(total, k)
        for i in range(end - begin):
            at = np.flatnonzero(np.unpackbits(sure[i].view(np.uint8)))
            if len(at) < k:
                at = np.concatenate([at, np.flatnonzero(np.unpackbits(tied[i].view(np.uint8)))[: k - len(at)]])
            bits = (total[:, i].view(np.uint8)[:, at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
            score = (bits.astype(np.int64) << np.arange(len(total))[:, None]).sum(axis=0)
            out.append((np.full(len(at), begin + i), at, score))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def search(index: ImpactIndex, items: DataFrame, k: int = 10) -> DataFrame:
    """The k best documents of each item (item_id, text): item_id, rank, doc_id, score (above 0).

    Scores are exact integers; equal ones are ranked by rising doc_id, a null one last. Items
    without a term that any document holds, null and empty texts too, have no rows. Rows that repeat
    an item_id are one item, a null id included; rows that repeat a document are documents of
    their own. An empty index or no items give an empty result.
    """
    asked = materialise(asked_terms(items), "impact-asked")
    n_asked = asked.count()
    few = n_asked <= MOST_BROADCAST
    blocks = max(1, -(-asked.select("item_id").distinct().count() // BLOCK))
    terms = asked.select("term").distinct()
    weights = materialise(index.weights(F.broadcast(terms) if few else terms), "impact-weights")
    blocked = asked.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int"))
    asking = blocked.join(weights, "term").groupBy("term", "block", "w").agg(F.collect_list(F.struct(F.col("item_id").alias("i"), F.col("qtf").alias("r"))).alias("asking"))
    asking = materialise(asking, "impact-asking")
    lists = index.lists.where("term IS NOT NULL").join(F.broadcast(asking) if few else asking, "term").select("shard", "block", "places", "slices", "n", "w", "asking")
    ids = index.lists.where("term IS NULL").select(F.col("shard").alias("of_shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.col("places").alias("ids"), F.col("slices").alias("known"), F.col("n").alias("documents"))

    together = ITEMS_TOGETHER, TERMS_TOGETHER

    def best(found: pa.Table, held: pa.Table) -> pa.Table:
        columns = {"item_id": pa.int64(), "doc_id": pa.int64(), "score": pa.int64()}
        if not found.num_rows:
            return pa.table({c: pa.array([], t) for c, t in columns.items()})
        documents = held.column("documents")[0].as_py()
        kind = "<u2" if documents <= 65536 else "<u4"
        numbers: dict[int | None, int] = {}
        lists, asking = [], []
        for b in found.to_batches():
            for places, slices, w, who in zip(*(b.column(c).to_pylist() for c in ("places", "slices", "w", "asking")), strict=True):
                lists.append((np.frombuffer(places, kind).astype(np.int64), np.frombuffer(slices, np.uint8).reshape(IMPACT_BITS, -1), w))
                asking.append([(numbers.setdefault(x["i"], len(numbers)), x["r"]) for x in who])
        item, place, score = search_shard(lists, asking, documents, len(numbers), k, together)
        names = pa.array(list(numbers), pa.int64())
        known = np.frombuffer(held.column("known")[0].as_py(), np.uint8).astype(bool)[place]
        doc = pa.array(np.frombuffer(held.column("ids")[0].as_py(), "<i8")[place], pa.int64(), mask=~known)
        return pa.table({"item_id": names.take(pa.array(item)), "doc_id": doc, "score": pa.array(score, pa.int64())})

    pairs = lists.groupBy("shard", "block").cogroup(ids.groupBy("of_shard", "block")).applyInArrow(best, "item_id long, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    discard(asked, weights)
    return ranked.select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``search`` over an index of ``docs`` built for it."""
    return search(ImpactIndex.build(docs), items, k)
