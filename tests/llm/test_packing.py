import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

from marlstone.llm.packing import TightestBin, WordEncoder, pack, place, plan_best_fit
from marlstone.llm.vocabularies import vocabulary

from .helpers import awkward, frame

V = vocabulary("word_bpe_49k.json")


def encoded(texts):
    t = Tokenizer.from_file(V)
    t.encode_special_tokens = True
    return [np.array(t.encode(x or "", add_special_tokens=False).ids, "<u4").tobytes() for x in texts]


def test_word_encoder_equals_the_tokenizer():
    rng = random.Random(3)
    parts = ["the", "The", "it's", "don't", "é", "É", "Σας", "ΣΑΣ", "!!", ",", ".", "a.", "b,", "x1.", "…", "“q”", "12", "<|endoftext|>", " ", " ", "\x85", "\x1c", " ", "\n", "\t", "İ", "ﬁ", "é", "́", "日本", "_", "a_b", "K", "www.", "i'm,"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(800)] + ["", None, "word " * 3000]
    for remembered in (5, 10_000):
        encode = WordEncoder(V, remembered)
        got = [x for i in range(0, len(texts), 50) for x in encode(texts[i : i + 50])]
        assert got == encoded(texts)


def best_fit_decreasing(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(bins) if r >= n]
        if fits:
            i = min(fits, key=lambda i: bins[i])
            bins[i] -= n
        else:
            bins.append(capacity - n)
    return bins


def test_plan_packs_as_best_fit_decreasing_one_by_one():
    rng = random.Random(4)
    for _ in range(60):
        capacity = rng.choice([10, 37, 100])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 150))]
        plan, sequences = plan_best_fit(Counter(lengths), capacity)
        left = best_fit_decreasing(lengths, capacity)
        assert sequences == len(left)
        used = defaultdict(int)
        runs = defaultdict(list)
        for n, rank, first, offset in plan:
            runs[n].append((rank, first, offset))
        for n, count in sorted(Counter(lengths).items(), reverse=True):
            bounds = [*runs[n], (count, 0, 0)]
            for (a, first, offset), (b, _, _) in zip(bounds, bounds[1:]):
                for i in range(b - a):
                    assert used[first + i] == offset
                    used[first + i] += n
        assert Counter(capacity - u for u in used.values()) == Counter(left)


def test_tightest_bin():
    tree = TightestBin(10)
    assert tree.at_least(3) is None
    for r in (2, 5, 9):
        tree.set(r, True)
    assert [tree.at_least(n) for n in (1, 2, 3, 5, 6, 10)] == [2, 2, 5, 5, 9, None]
    tree.set(5, False)
    assert tree.at_least(3) == 9


def checked(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_all_pieces_are_packed_without_gaps(spark):
    rows = awkward()
    got = pack(frame(spark, rows), V, capacity=64, keep_ids=True).collect()
    sequences = checked(got, 64)
    want = Counter()
    for r, ids in zip(rows, encoded([r[1] for r in rows])):
        ids += b"\x01\0\0\0"
        want.update((r[0], n, at // 4, len(ids[at : at + 256]) // 4, zlib.crc32(ids[at : at + 256])) for n, at in enumerate(range(0, len(ids), 256)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in got)
    assert sequences == len(best_fit_decreasing([r.length for r in got], 64))


def test_empty_and_single_length(spark):
    assert pack(frame(spark, []), V).count() == 0
    df = spark.createDataFrame([(i // 2, i % 2, 4) for i in range(500)], "row_no long, piece int, length long")
    assert checked(place(df, 9).collect(), 9) == 250


def test_repeated_rows_and_ids_beside_nulls(spark):
    rows = [(9007199254740993, "a few words", None, None, None), (None, None, None, None, None)] * 300
    got = pack(frame(spark, rows), V, capacity=16).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert checked(got, 16) == len(best_fit_decreasing([r.length for r in got], 16))
