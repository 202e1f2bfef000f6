import random
import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm import lexical_search as search
from tests.llm.helpers import awkward, frame


def terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lowered)


def brute(docs, items, k=10):
    held = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n, total = len(held), sum(c.total() for _, c in held)
    df = Counter(w for _, c in held for w in c)
    asked: dict = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, q in asked.items():
        scored = []
        for d, c in held:
            m = 25 + (75 * c.total() * n) // total
            s = sum(r * floor(1000 * log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m)) for w, r in q.items() if w in c)
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(item, i, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()], key=repr)


ITEMS = "item_id long, text string"


@pytest.mark.parametrize("shard", [1, 7, 64, 8192])
def test_awkward_tables_match_brute_force(spark, shard):
    rows = awkward()
    items = [(i, r[1]) for i, r in enumerate(rows[:12])] + [(50, None), (51, ""), (52, "zzz unknown"), (None, rows[0][1]), (53, "abc abc ABC " * 9), (53, "the abc"), (54, rows[-4][1]), (55, "Éa éa \x00éa;9")]
    docs = frame(spark, rows).repartition(3).withColumn("term", F.lit(1)).withColumn("shard", F.lit("x"))
    index = search.ImpactIndex.build(docs, shard=shard)
    got = found(search.search(index, spark.createDataFrame(items, ITEMS).withColumn("n", F.lit(0))))
    assert got == brute([(r[0], r[1]) for r in rows], items)


def test_ties_go_by_doc_id_and_shards_end_at_tokens(spark):
    docs = [(i, "one two three") for i in range(200, 0, -1)] + [(500, "four")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = search.search(search.ImpactIndex.build(df, shard_tokens=20), spark.createDataFrame([(1, "two")], ITEMS))
    assert found(got) == brute(docs, [(1, "two")])
    assert [r.doc_id for r in got.orderBy("rank").collect()] == list(range(1, 11))


def test_items_in_blocks_and_by_shuffle(spark, monkeypatch):
    rows = awkward()
    items = [(i, rows[i % 40][1]) for i in range(30)]
    monkeypatch.setattr(search, "BLOCK", 7)
    monkeypatch.setattr(search, "MOST_BROADCAST", 3)
    monkeypatch.setattr(search, "ITEMS_TOGETHER", 2)
    monkeypatch.setattr(search, "TERMS_TOGETHER", 5)
    got = search.rank_documents(frame(spark, rows), spark.createDataFrame(items, ITEMS), k=4)
    assert found(got) == brute([(r[0], r[1]) for r in rows], items, 4)


def test_empty_tables(spark):
    rows, none = frame(spark, awkward()), frame(spark, [])
    items = spark.createDataFrame([(1, "abc")], ITEMS)
    assert search.rank_documents(none, items).count() == 0
    assert search.rank_documents(rows, items.where("false")).count() == 0
    blank = spark.createDataFrame([(1, None), (2, " .; ")], "doc_id long, text string")
    assert search.rank_documents(blank, items).count() == 0


def test_a_stored_index_is_read_again(spark, tmp_path):
    rows = awkward()
    path = f"file://{tmp_path}/index"
    search.ImpactIndex.build(frame(spark, rows), path)
    items = [(1, rows[2][1])]
    assert found(search.search(search.ImpactIndex.load(spark, path), spark.createDataFrame(items, ITEMS))) == brute([(r[0], r[1]) for r in rows], items)


def values_of(slices):
    bits = np.unpackbits(slices.view(np.uint8), axis=-1)
    return (bits.astype(np.int64) << np.arange(len(slices)).reshape(-1, *[1] * (bits.ndim - 1))).sum(axis=0)


def test_bitwise_arithmetic():
    rng = random.Random(4)
    lists = [[rng.randrange(1 << 20) for _ in range(rng.randint(1, 30))] for _ in range(9)]
    flat = np.array([x for one in lists for x in one])
    starts = np.cumsum([0] + [len(one) for one in lists[:-1]])
    data, offsets = search.bit_slices(flat, starts, 20)
    each = [data[a:b].reshape(20, -1) for a, b in zip(offsets, offsets[1:])]
    for one, got in zip(lists, each, strict=True):
        assert values_of(got)[: len(one)].tolist() == one
    weights = np.array([rng.randrange(20_000) for _ in lists])
    together = np.concatenate(each, axis=1)
    products = values_of(search.times_weights(together, np.repeat(weights, [x.shape[1] for x in each])))
    assert products.tolist() == [x * w for one, w in zip(lists, weights) for x in one + [0] * (-len(one) % 8)]


def test_top_of_slices():
    rng = np.random.default_rng(3)
    for most in (2, 9, 1000):
        values = rng.integers(0, most, (5, 128))
        total = np.stack([np.packbits((values >> b) & 1, axis=1).view(np.uint64) for b in range(10)])
        sure, tied = search.top_slices(total, 7)
        for v, s, t in zip(values, sure, tied, strict=True):
            s, t = np.flatnonzero(np.unpackbits(s.view(np.uint8))), np.flatnonzero(np.unpackbits(t.view(np.uint8)))
            want = sorted(range(128), key=lambda i: (-v[i], i))[:7]
            assert sorted([*s, *t[: 7 - len(s)]]) == sorted(i for i in want if v[i] > 0)
