import math
import random
import zlib
from collections import Counter

import numpy as np

from marlstone.llm.quality_classifier import counted, features, fit_ftrl, keep_good, learning_rows, score, train

from .helpers import awkward, frame


def test_features_are_words_and_pairs_of_the_whole_text():
    x = features("The cat!! the 42 cat", 18)
    assert len(x) == 6 + 5 and x[0] == x[3] and x[1] == x[5]
    assert len(features(None, 18)) == len(features(" \n", 18)) == 0
    long = features("a b " * 50_000, 18)
    assert len(long) == 199_999


def test_held_out_rows_are_told_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    weights = train(docs, learning_rows(labels))
    got = {r.doc_id: r for r in score(docs, weights).collect()}
    held = [r for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    good, bad = [r for r in held if r.quality == 1], [r for r in held if r.quality == 0]
    assert np.mean([got[r.doc_id].predicted for r in good]) >= 0.97
    assert np.mean([1 - got[r.doc_id].predicted for r in bad]) >= 0.6
    assert np.mean([got[r.doc_id].score for r in good]) > np.mean([got[r.doc_id].score for r in bad])
    assert {r.doc_id for r in keep_good(docs, labels).collect()} == {i for i, r in got.items() if r.predicted}


def test_awkward_rows_and_no_labels(spark):
    docs = frame(spark, awkward())
    none = spark.createDataFrame([], "doc_id long, label int")
    got = score(docs, train(docs, none)).collect()
    assert len(got) == docs.count() and {r.score for r in got} == {0.5}
    odd = spark.createDataFrame([(None, 1), (1, None), (1, 1), (1, 0), (2, 0), (12345, 1)], "doc_id long, label int")
    assert all(0 <= r.score <= 1 for r in score(docs, train(docs, odd)).collect())
    assert score(frame(spark, []), train(docs, odd)).count() == 0


def test_training_is_repeatable(spark):
    docs = frame(spark, awkward())
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, label int")
    assert np.array_equal(train(docs, labels), train(docs.repartition(3), labels))


def plain_ftrl(rows, bits, epochs, alpha, beta, l1, l2):
    """Per-coordinate FTRL-proximal, one number at a time."""
    size = (1 << bits) + 1
    z, n = [0.0] * size, [0.0] * size

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for tokens, y in rows:
            x = {i: c / math.sqrt(max(1, len(tokens))) for i, c in Counter(tokens).items()} | {size - 1: 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - y) * v
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
                z[i] += g - sigma * w[i]
                n[i] += g * g
    return [weight(i) for i in range(size)]


def test_training_equals_a_plain_loop():
    rng = random.Random(8)
    rows = [([rng.randrange(64) for _ in range(rng.randint(0, 40))], rng.randint(0, 1)) for _ in range(60)]
    got = fit_ftrl([(counted(np.array(x, np.uint32)), y) for x, y in rows], 6, 2, 0.5, 1.0, 0.05, 0.1)
    assert np.allclose(got, plain_ftrl(rows, 6, 2, 0.5, 1.0, 0.05, 0.1), atol=1e-12)


def test_scores_equal_a_plain_sum(spark):
    docs = frame(spark, awkward())
    w = np.random.default_rng(1).normal(size=(1 << 10) + 1).astype("<f4")
    want = Counter()
    for r in awkward():
        x = features(r[1], 10)
        s = float(w[-1]) + (sum(float(w[i]) for i in x) / math.sqrt(len(x)) if len(x) else 0.0)
        want[(r[0], round(1 / (1 + math.exp(-max(-30, min(30, s)))), 9))] += 1
    assert Counter((r.doc_id, round(r.score, 9)) for r in score(docs, w).collect()) == want


def test_the_stage_keeps_ids_columns_and_awkward_rows(spark):
    rows = [(9007199254740993, "fine words here", "en", "a", 9007199254740993), (None, "no id", None, None, None), (5, None, "en", "a", 0), (5, "", "en", "a", 0), (5, "", "en", "a", 0)]
    docs = frame(spark, rows).withColumnRenamed("lang", "score").withColumnRenamed("source", "predicted")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    got = keep_good(docs, labels)
    assert got.columns == docs.columns and Counter(map(tuple, got.collect())) == Counter(rows)  # no text to learn from: all score 0.5
    assert sorted(r.doc_id or 0 for r in score(docs, train(docs, learning_rows(labels))).collect()) == [0, 5, 5, 5, 9007199254740993]
    assert keep_good(frame(spark, []), labels).count() == 0
