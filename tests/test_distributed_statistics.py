import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.operators import corpus, evaluation


def test_bootstrap_is_the_plain_loop_over_all_pairs_and_metrics(spark):
    rng = random.Random(9)
    rows = [(m, q, rng.choice([None, rng.random()]) if q > 35 else rng.random(), rng.random()) for q in range(40) for m in ("a", "b", "c") if (m, q) != ("c", 7)]
    df = spark.createDataFrame(rows, "mode string, query_id long, x double, y double").repartition(4)
    got = {(r.left, r.right, r.metric): r for r in evaluation.paired_bootstrap(df, ["x", "y"], draws=300, seed=5).collect()}
    assert set(got) == {(a, b, v) for a, b in (("a", "b"), ("a", "c"), ("b", "c")) for v in "xy"}
    by = {(m, q): {"x": x, "y": y} for m, q, x, y in rows}
    for (a, b, v), r in got.items():
        shared = [q for q in range(40) if (a, q) in by and (b, q) in by and by[a, q][v] is not None and by[b, q][v] is not None]
        d = [by[a, q][v] - by[b, q][v] for q in shared]
        weights = [evaluation.replicate_weights(q, 300, 5) for q in shared]
        means = [sum(w[k] * x for w, x in zip(weights, d)) / sum(w[k] for w in weights) for k in range(300)]
        assert (r.queries, r.difference) == (len(shared), pytest.approx(np.mean(d)))
        assert (r.low, r.high) == pytest.approx(tuple(np.percentile(means, [2.5, 97.5])))


def test_bootstrap_intervals_are_those_of_resampling_rows(spark):
    rng = np.random.default_rng(1)
    d = rng.normal(0.1, 1, 400)
    df = spark.createDataFrame([("a", i, float(x)) for i, x in enumerate(d)] + [("b", i, 0.0) for i in range(400)], "mode string, query_id long, x double")
    r = evaluation.paired_bootstrap(df, ["x"]).first()
    draws = rng.choice(d, (2000, 400)).mean(axis=1)
    assert (r.low, r.high) == pytest.approx(tuple(np.percentile(draws, [2.5, 97.5])), abs=0.02)
    alone = evaluation.paired_bootstrap(df.where("mode = 'a'").unionByName(df.where("mode = 'b'").withColumn("query_id", F.col("query_id") + 1000)), ["x"]).first()
    assert (alone.queries, alone.difference, alone.low) == (0, None, None)


@pytest.mark.parametrize("few,cells", [(50_000, 1024), (10, 4), (1, 64)])
def test_percentiles_are_exact_however_values_are_spread(spark, few, cells):
    rng = random.Random(few)
    groups = {
        "even": [rng.random() for _ in range(700)],
        "wide": [10.0 ** rng.uniform(-300, 300) * rng.choice([-1, 1]) for _ in range(300)],
        "same": [3.5] * 200,
        "mostly": [1.0] * 190 + [2.0, -5.0, 1e9],
        "one": [4.0],
        None: [1.0, 2.0],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("even", None), ("even", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    shares = [0.0, 0.5, 0.95, 1.0]
    got = {(r.g, r.share): r.percentile for r in evaluation.exact_percentiles(df, ["g"], "v", shares, few, cells).collect()}
    assert got == {(g, s): pytest.approx(float(np.percentile(vs, 100 * s)), rel=1e-9) for g, vs in groups.items() for s in shares}


def test_percentiles_of_a_whole_table_and_of_none(spark):
    df = spark.range(101).withColumn("v", F.col("id").cast("double"))
    assert [tuple(r) for r in evaluation.exact_percentiles(df, [], "v", [0.25]).collect()] == [(0.25, 25.0)]
    assert evaluation.exact_percentiles(df.where("id < 0"), [], "v", [0.25]).count() == 0


def test_repair_stops_at_the_first_good_attempt(spark):
    rows = [
        (1, 0, "PASS", 900, 100, 99.0), (1, 1, "REVIEW", 10, 10, 90.0), (1, 2, "PASS", 50, 50, 80.0), (1, 3, "PASS", 2000, 9000, 99.0),
        (2, 0, "FAILED", 0, 0, None), (2, 1, "PASS", 5, 5, 60.0), (2, 2, "PASS", 6, 5, None), (3, 0, "BLANK", None, None, None), (4, 1, "PASS", 1, 1, 70.0), (4, 2, "PASS", 9, 9, 99.0),
    ]
    a = spark.createDataFrame(rows, "page int, attempt int, status string, words int, chars int, confidence double")
    got = {r.page: (r.attempt, r.attempts_made) for r in corpus.repaired_pages(a, ["page"], 70.0).collect()}
    assert got == {1: (0, 2), 2: (2, 2), 3: (0, 0), 4: (1, 1)}


def test_attempt_plans_follow_the_page(spark):
    pages = spark.createDataFrame([(1, 0, True, "REVIEW"), (2, 9, False, "REVIEW"), (3, None, None, "FAILED")], "page int, arabic_character_count int, has_native_text boolean, status string")
    plan = corpus.attempt_plan(pages, ["page"], "fra+eng", "ara+fra", "ara+fra+eng").orderBy("page", "attempt").collect()
    by = {p: [(r.attempt, r.name, r.languages, r.rotation) for r in plan if r.page == p] for p in (1, 2, 3)}
    assert [x[1] for x in by[1]] == ["native_slide_text", "primary_psm3_auto", "primary_psm6_auto", "primary_psm6_threshold", "primary_psm11_sharpen"]
    assert by[2][0] == (1, "primary_psm3_auto", "ara+fra", 0) and by[2][-1] == (5, "mixed_psm6_auto", "ara+fra+eng", 0) and len(by[2]) == 5
    assert [x[3] for x in by[3]] == [0, 0, 0, 0, 0, 90, 270] and by[3][0][2] == "fra+eng"
    assert corpus.attempt_plan(pages, ["page"], "l", "a", "m", most=2).count() == 6
