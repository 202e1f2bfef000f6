import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from marlstone.llm.source_mix import fit_counts, mix_sources, repeat_mixed, share_targets

from .helpers import awkward, frame, words_of


def test_fit_finds_the_nearest_subset_sum():
    rng = random.Random(1)
    for _ in range(300):
        lengths = sorted(rng.sample(range(60), rng.randint(1, 12)))
        counts = [rng.randint(0, 4) for _ in lengths]
        total = sum(a * b for a, b in zip(lengths, counts))
        budget = rng.randint(0, total + 3)
        x = fit_counts(np.array(lengths), np.array(counts), budget)
        assert all(0 <= a <= b for a, b in zip(x, counts))
        reach = {0}
        for a, b in zip(lengths, counts):
            for _ in range(b):
                reach |= {r + a for r in reach}
        assert abs(sum(np.array(lengths) * x) - min(budget, total)) == min(abs(r - min(budget, total)) for r in reach)


def test_fit_overshoots_by_a_long_document_where_that_is_nearer():
    assert fit_counts(np.array([100_000]), np.array([1]), 99_000).tolist() == [1]
    assert fit_counts(np.array([100_000]), np.array([2]), 99_000).tolist() == [1]
    assert fit_counts(np.array([100_000]), np.array([20]), 990_000).tolist() == [10]
    assert fit_counts(np.array([70_000, 100_000]), np.array([1, 1]), 95_000).tolist() == [0, 1]
    assert fit_counts(np.array([3_000_000]), np.array([4]), 5_000_000).tolist() == [2]  # beyond the widest window


def test_fit_of_long_documents_is_the_nearest_subset_sum():
    rng = random.Random(2)
    for _ in range(25):
        lengths = sorted(rng.sample(range(41_000, 120_000), rng.randint(1, 5)) + rng.sample(range(1, 3_000), rng.randint(0, 2)))
        counts = [rng.randint(0, 2) for _ in lengths]
        total = sum(a * b for a, b in zip(lengths, counts))
        budget = rng.randint(0, min(total, 640_000))
        x = fit_counts(np.array(lengths), np.array(counts), budget)
        assert all(0 <= a <= b for a, b in zip(x, counts))
        reach = {0}
        for a, b in zip(lengths, counts):
            for _ in range(b):
                reach |= {r + a for r in reach}
        assert abs(sum(np.array(lengths) * x) - budget) == min(abs(r - budget) for r in reach)


def test_a_sole_long_document_stays_in_the_mix(spark):
    rows = [(1, "long ", "en", "a"), (2, "w", "en", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("text", F.when(F.col("source") == "a", F.repeat("text", 100_000)).otherwise(F.repeat(F.lit("w "), 40_000)))
    got = {r.source: r.taken for r in mix_sources(df, weights=(3, 4), total_share=1.0).collect()}
    assert got == {"a": 100_000, "b": 80_000}  # targets 60,000 and 80,000


def test_fit_of_large_budgets_keeps_the_mix_of_lengths():
    lengths = np.arange(1, 3000)
    counts = np.full(len(lengths), 100)
    budget = int((lengths * counts).sum() * 0.37)
    x = fit_counts(lengths, counts, budget)
    assert int((lengths * x).sum()) == budget and abs(x[:2000].mean() - 37) < 2


def test_targets_stop_at_twice_the_size_and_pass_on_the_excess():
    got = share_targets([("b", 100), ("a", 10), (None, 100)])
    assert got["a"] == 20 and abs(sum(got.values()) - 315) < 1e-9
    assert abs(got["b"] / got[None] - 1 / 2) < 1e-9 or got[None] == 200
    assert share_targets([]) == {} and share_targets([("a", 0)]) == {"a": 0.0}


def brute_targets(rows):
    """Targets by the wording of the contract: share by weight, stop the full ones, share the rest again."""
    size = defaultdict(int)
    for r in rows:
        size[r[3]] += len(words_of(r[1]))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    stopped = set()
    while True:
        left = 1.5 * sum(size.values()) - sum(2 * size[s] for s in stopped)
        whole = sum(weight[s] for s in order if s not in stopped)
        target = {s: 2.0 * size[s] if s in stopped else left * weight[s] / whole for s in order}
        above = {s for s in order if target[s] > 2 * size[s]}
        if not above:
            return size, target
        stopped |= above


def test_targets_match_the_wording():
    rng = random.Random(4)
    for _ in range(100):
        rows = [(i, "w " * rng.choice([0, 1, 5, 40, 900]), "", rng.choice(["a", "b", "c", "d", "é", "\U0001f600", "\uffee", None])) for i in range(rng.randint(1, 15))]
        size, want = brute_targets(rows)
        got = share_targets(list(size.items()))
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) <= 1e-9 * max(1, want[s]) for s in want)


def test_rows(spark):
    rows = awkward()
    df = frame(spark, rows)
    got = mix_sources(df).collect()
    size, target = brute_targets(rows)
    assert Counter((r.doc_id, r.source, r["size"], r.source_size) for r in got) == Counter((r[0], r[3], len(words_of(r[1])), size[r[3]]) for r in rows)
    taken = defaultdict(int)
    for r in got:
        assert abs(r.target - target[r.source]) < 1e-6 and 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    for s in size:
        assert abs(taken[s] - target[s]) <= (10_000 if any(r[0] == 903 and r[3] == s for r in rows) else 1)  # 903 has 20,000 words
    again = mix_sources(df.repartition(5)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_documents_are_repeated_as_taken(spark):
    rows = awkward()
    df = frame(spark, rows)
    words = defaultdict(int)
    for r in repeat_mixed(df).collect():
        assert tuple(r) in set(rows)
        words[r.source] += len(words_of(r.text))
    want = defaultdict(int)
    for r in mix_sources(df).collect():
        want[r.source] += r.taken
    assert {k: v for k, v in words.items() if v} == {k: v for k, v in want.items() if v}


def test_one_hot_length_and_empty(spark):
    rows = [(i, "same words here", "en", "s", 1) for i in range(400)] + [(1000 + i, "a b", "en", "t", 1) for i in range(3)]
    got = mix_sources(frame(spark, rows)).collect()
    size, target = brute_targets(rows)
    assert abs(sum(r.taken for r in got if r.source == "s") - target["s"]) <= 3
    assert mix_sources(frame(spark, [])).count() == 0
    assert repeat_mixed(frame(spark, [(1, None, None, None, None)])).count() == 1


def test_copies_of_a_length_differ_by_one_at_most(spark):
    """Row by row: each length's copies are spread evenly, and no row leaves the range."""
    rows = awkward()
    by = defaultdict(list)
    for r in mix_sources(frame(spark, rows)).collect():
        if r["size"]:
            assert r.taken % r["size"] == 0
            by[r.source, r["size"]].append(r.taken // r["size"])
    assert all(max(v) - min(v) <= 1 and max(v) <= 2 for v in by.values())


def test_equal_rows_without_ids_and_names_of_its_own(spark):
    rows = [(None, "a b c", "en", "s", 1)] * 500 + [(1, "a b", None, "t", 2), (1, "a b", "fr", "t", 2), (2, None, None, None, None)]
    df = frame(spark, rows)
    odd = df.withColumns({"_row_key": F.lit("x"), "_row_place": F.lit(1), "_copy": F.lit(2), "row": F.lit(3), "times": F.lit(4), "place": F.lit(5)})
    got, size = repeat_mixed(odd), brute_targets(rows)[1]
    assert got.columns == odd.columns
    words = defaultdict(int)
    for r in got.collect():
        assert tuple(r)[5:] == ("x", 1, 2, 3, 4, 5) and tuple(r)[:5] in set(rows)
        words[r.source] += len(words_of(r.text))
    assert abs(words["s"] - size["s"]) <= 3 and abs(words["t"] - size["t"]) <= 2 and sum(r.doc_id == 2 for r in got.collect()) == 1
    assert repeat_mixed(frame(spark, [])).count() == 0
