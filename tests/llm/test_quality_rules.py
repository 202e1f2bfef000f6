import math
import re
from collections import defaultdict

from pyspark.sql import functions as F

from marlstone.llm import quality_rules as Q
from marlstone.llm.quality_rules import quality_rules, ratio_weights

from .helpers import awkward, frame, words_of


def base(text):
    w = words_of(text)
    seen = defaultdict(list)
    for i in range(len(w) - 4):
        seen[tuple(w[i : i + 5])].append(i)
    covered = {j for v in seen.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_base_measures_match_brute_force(spark):
    rows = awkward() + [(905, "a b c d e " * 9, "en", "s", 1), (906, "a a a a a a a a a a", "en", "s", 1), (907, "p q r s t u v w x y z p q r s t", "en", "s", 1)]
    got = quality_rules(frame(spark, rows), [0.0] * 8).collect()
    assert len(got) == len(rows)
    want = sorted([(r[0], *base(r[1])) for r in rows], key=str)
    assert sorted([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got], key=str) == want


def test_ratio_is_the_mean_log_ratio_of_all_grams(spark):
    docs = frame(spark, [(1, "good words here", "", "", 1), (2, "bad stuff", "", "", 1), (3, None, "", "", 1)])
    weights = ratio_weights(docs, spark.createDataFrame([(1,), (1,), (None,)], "doc_id long"), buckets=1 << 16)
    n, raw, good, prior = 1 << 16, 8, 5, 256
    p_raw = 2 / (n + raw)
    seen = math.log((1 + prior * p_raw) / (good + prior)) - math.log(p_raw)
    unseen = math.log(prior / (good + prior))
    got = {r.doc_id: r.ratio for r in quality_rules(docs, weights).collect()}
    assert math.isclose(got[1], seen, abs_tol=1e-9) and math.isclose(got[2], unseen, abs_tol=1e-9) and got[3] == 0.0


def test_threshold_is_deterministic_and_drops_symbol_junk(spark):
    clean = [(i, f"the cat and the dog saw word{i % 7} of the town in rain and sun", "", "", 1) for i in range(60)]
    junk = [(100 + i, "the*** cat$$$ and### the### dog%%% saw&&& one*** of%%% the$$$ town###", "", "", 1) for i in range(20)]
    docs = frame(spark, clean + junk)
    weights = ratio_weights(docs, spark.createDataFrame([(i,) for i in range(40)], "doc_id long"))
    got = [{r.doc_id: r.kept for r in quality_rules(docs, weights).collect()} for _ in range(2)]
    assert got[0] == got[1] and {k for k, v in got[0].items() if v} == set(range(60))


def test_empty_table(spark):
    docs = frame(spark, [])
    assert quality_rules(docs, ratio_weights(docs, docs.select("doc_id"))).count() == 0


def test_kept_and_ratio_match_brute_force_over_the_whole_table(spark):
    """Both multinomials counted by a plain loop over the same hashed buckets, with and without the broadcast."""
    rows, buckets, prior = awkward(), 1 << 8, 256.0
    docs = frame(spark, rows)
    trusted = {1, 2, 3, 5, 8, 13, 903}
    grams = {w: None for r in rows for w in words_of(r[1])} | {p: None for r in rows for p in zip(words_of(r[1]), words_of(r[1])[1:])}
    listed = spark.createDataFrame([(i, *(g if isinstance(g, tuple) else (g, None))) for i, g in enumerate(grams)], "i long, a string, b string")
    hashed = {r.i: (r.x if r.b is None else r.y) for r in listed.select("i", "b", F.pmod(F.xxhash64("a"), F.lit(buckets)).alias("x"), F.pmod(F.xxhash64("a", "b"), F.lit(buckets)).alias("y")).collect()}
    bucket = dict(zip(grams, (hashed[i] for i in range(len(grams))), strict=True))

    def of(text):
        w = words_of(text)
        return [bucket[x] for x in w] + [bucket[x] for x in zip(w, w[1:])]

    raw, good = [1] * buckets, [0] * buckets
    for r in rows:
        for b in of(r[1]):
            raw[b] += 1
            good[b] += r[0] in trusted
    p_raw = [x / sum(raw) for x in raw]
    weight = [math.log((g + prior * p) / (sum(good) + prior)) - math.log(p) for g, p in zip(good, p_raw, strict=True)]
    want = []
    for r in rows:
        x = of(r[1])
        ratio = sum(weight[b] for b in x) / len(x) if x else 0.0
        want.append((r[0], round(ratio, 9), not base(r[1])[-1] and ratio >= -0.08))
    most = Q.MOST_BROADCAST
    for limit in (most, 0):
        Q.MOST_BROADCAST = limit
        got = quality_rules(docs, ratio_weights(docs, spark.createDataFrame([(i,) for i in trusted], "doc_id long"), buckets, prior)).collect()
        assert sorted([(r.doc_id, round(r.ratio, 9), r.kept) for r in got], key=str) == sorted(want, key=str)
    Q.MOST_BROADCAST = most
    assert 0 < sum(w[2] for w in want) < len(want)
