import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm.language_id import WORD, Pieces, fit_pieces, identify, learning_rows, train, word_scores
from marlstone.llm.vocabularies import vocabulary

from .helpers import awkward, frame

V = vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return Pieces(V)


def test_forward_sums_all_segmentations(pieces):
    rng = np.random.default_rng(0)
    p = rng.random((pieces.none + 1, 2))
    p[pieces.none] = 0
    p /= p.sum(0)
    assert pieces.longest >= 15 and "additional" in pieces.of
    words = ["there", "abc", "ñandú", "x", "字ing", "whenever", "additionally"]
    for word, got in zip(words, word_scores(words, pieces, p), strict=True):
        total = np.zeros(2)
        for cuts in itertools.product([0, 1], repeat=len(word) - 1):
            parts, last = [], 0
            for i, c in enumerate(cuts, 1):
                if c:
                    parts.append(word[last:i])
                    last = i
            parts.append(word[last:])
            number = [pieces.of.get(x, pieces.other if len(x) == 1 else pieces.none) for x in parts]
            total += np.prod(p[number], axis=0)
        assert np.allclose(got, np.log(total))


def test_long_words_do_not_underflow(pieces):
    p = np.full((pieces.none + 1, 1), 1e-6)
    p[pieces.none] = 0
    assert math.isfinite(word_scores(["q" * 5000], pieces, p)[0, 0])


def test_expectation_maximisation_raises_the_likelihood(pieces):
    counts = {"the": 50, "other": 20, "then": 9, "bothering": 2}
    seen = list(counts)
    likelihood = [sum(counts[w] * s for w, s in zip(seen, word_scores(seen, pieces, fit_pieces(counts, pieces, rounds, 1e-4)[:, None])[:, 0], strict=True)) for rounds in (1, 2, 5)]
    assert likelihood[0] < likelihood[1] <= likelihood[2] + 1e-9


def test_words_of_any_length_teach(pieces):
    plain, short, long = (fit_pieces(c, pieces) for c in ({}, {"字母" * 3: 1}, {"字母" * 3000: 1}))
    of = [pieces.of.get(x, pieces.other) for x in "字母"]
    assert np.isfinite(long).all() and math.isclose(long.sum(), 1) and long[of].sum() > short[of].sum() > plain[of].sum()
    kept, anew = (fit_pieces({"there": 3, "whenever" * 9: 2, "x": 1}, pieces, letters_kept=n) for n in (1000, 5))
    assert np.array_equal(kept, anew)


def test_expected_counts_are_those_of_all_segmentations(pieces):
    words, start = {"therein": 3, "abc": 2}, 1 / (pieces.none + 1)
    want = np.full(pieces.none + 1, 0.05)
    for word, n in words.items():
        found = []
        for cuts in itertools.product([0, 1], repeat=len(word) - 1):
            ends = [i for i, c in enumerate(cuts, 1) if c] + [len(word)]
            parts = [word[a:b] for a, b in zip([0, *ends], ends)]
            number = [pieces.of.get(x, pieces.other if len(x) == 1 else pieces.none) for x in parts]
            if pieces.none not in number:
                found.append((start ** len(number), number))
        whole = sum(f for f, _ in found)
        for f, number in found:
            for i in number:
                want[i] += n * f / whole
    want[pieces.none] = 0
    assert np.allclose(fit_pieces(words, pieces, rounds=1), want / want.sum(), rtol=1e-9)


def test_held_out_accuracy_and_awkward_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = train(learning_rows(docs), V)
    found = {r.doc_id: r for r in identify(docs, model, V).collect()}
    held = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum(found[r.doc_id].lang_pred == r.lang for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())
    rows = awkward()
    got = identify(frame(spark, rows), model, V).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r.lang_pred for r in got}
    assert by[900] == by[901] == by[902] == "und" and by[903] in model


def test_nothing_learned_and_empty(spark):
    docs = frame(spark, [(1, "words", None, "", 1)])
    assert train(docs, V) == {}
    assert [(r.lang_pred, r.score) for r in identify(docs, {}, V).collect()] == [("und", 0.0)]
    assert identify(frame(spark, []), {}, V).count() == 0


def test_words_are_letters_with_their_marks():
    assert [WORD.findall(t) for t in ("½ ² Ⅷ ① 42 _ -", "one½two", "q\u0301a x_y", "हिन्दी", "日本1語", "\u0301 a")] == [[], ["one", "two"], ["q\u0301a", "x", "y"], ["हिन्दी"], ["日本", "語"], ["a"]]


def test_texts_without_a_letter_are_undetermined_and_ids_stay_exact(spark):
    docs = frame(spark, [(9007199254740993, "½ ²", "en", "", 1), (None, "the words of this text", "en", "", 1), (9007199254740995, "the words", "en", "", 1)] * 2)
    got = identify(docs, train(docs, V), V).collect()
    assert sorted((r.doc_id or 0, r.lang_pred) for r in got) == sorted([(9007199254740993, "und"), (0, "en"), (9007199254740995, "en")] * 2)


def test_at_most_so_many_documents_and_languages(spark):
    rows = [(i, f"w{'abcdefghij'[i % 10]}", "en" if i % 3 else "fr", "", 1) for i in range(400)]
    few = train(frame(spark, rows), V, max_docs=20)
    ids = {r.h: r.doc_id for r in frame(spark, rows).selectExpr("doc_id", "pmod(xxhash64(doc_id), 1L << 40) AS h").collect()}
    lang = {r[0]: r[2] for r in rows}
    first = {x: [i for _, i in sorted(ids.items()) if lang[i] == x][:20] for x in ("en", "fr")}
    again = train(frame(spark, [r for r in rows if r[0] in first[r[2]]]), V)
    assert all(np.array_equal(few[x], again[x]) for x in ("en", "fr"))


def test_more_languages_than_a_task_holds_are_taken_in_blocks(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice([f"{x}{y}" for y in ("ab", "cde", "fa")] + ["gh"]) for _ in range(12)), f"lang {x}", "", 1) for i, x in enumerate("klmnopq" * 6)]
    docs = frame(spark, [*rows, (99, None, "lang k", "", 1), (100, "12 .", None, "", 0), rows[0], (None, "kab", None, None, None), (101, "kab " * 5000, None, None, None)]).withColumn("total", F.lit("x"))
    whole, table = train(docs, V), train(docs, V, together=2)
    assert isinstance(whole, dict) and table.count() == len(whole) == 7

    def found(model, **options):
        return sorted((r.doc_id or 0, r.lang_pred, round(r.score, 9)) for r in identify(docs, model, V, **options).collect())

    assert found(table, together=2) == found(table, together=100) == found(whole)
    assert {(99, "und", 0.0), (100, "und", 0.0)} <= set(found(whole)) and len({x for _, x, _ in found(whole)}) > 5
    assert identify(docs.limit(0), table, V).count() == 0
