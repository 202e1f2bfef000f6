import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marlstone.llm import spelling
from tests.llm.helpers import awkward, frame


def counted(docs):
    count = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            count[run] += 1
    return count


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:p] + b[p + 1 :] == a for p in range(len(b)))


def brute(words, ratio=5):
    forms, counts = {}, {}
    for w, n in words.items():
        others = [x for x in words if near(w, x)]
        counts[w] = len(others)
        best = min(others, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= ratio * n else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, counts[w], words[forms[w]] if forms[w] else None))
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_awkward_tables_match_brute_force(spark):
    docs = awkward() * 3
    got = spelling.spelling_variants(frame(spark, docs).withColumns({"n": F.lit("x"), "word": F.lit(1), "ref": F.lit(2)}), least_length=3, least=2)
    want = brute({w: n for w, n in counted([(r[0], r[1]) for r in docs]).items() if len(w) >= 3 and n >= 2})
    assert len(want) > 100 and any(f for _, f, *_ in want)
    assert rows(got) == want


def test_noise_takes_the_code_point_that_the_hash_names(spark):
    docs = [(i, "Straße ÉCOLES écoles x÷y×z ÿÿÿÿÿÿ ĀĀcoles") for i in range(3000)] + [(None, "écoles écoles")]
    got = {r.word: r.n for r in spelling.count_words(frame(spark, [(i, t, None, None, None) for i, t in docs]), 1, 1).collect()}
    assert got == {w: n for w, n in counted(docs).items() if w}


@pytest.mark.parametrize("literal", [spelling.LITERAL, 4, 0])
def test_variants_match_brute_force_whatever_the_keys(spark, monkeypatch, literal):
    monkeypatch.setattr(spelling, "LITERAL", literal)
    rng = random.Random(5)
    words = {}
    for _ in range(300):
        words["".join(rng.choice("abé") for _ in range(rng.randint(1, 7)))] = rng.choice([5, 5, 6, 30, 200, 1500, 9000])
    got = spelling.variant_forms(spark.createDataFrame(list(words.items()), "word string, n long"))
    assert rows(got) == brute(words)


def test_long_chains_of_forms(spark):
    words = {"x" * (6 + i): 5 ** (i + 1) for i in range(12)}
    got = spelling.variant_forms(spark.createDataFrame(list(words.items()), "word string, n long"))
    assert {r.root for r in got.collect()} == {"x" * 17} and rows(got) == brute(words)


def test_very_long_words(spark):
    base = "ab" * 30_000
    words = {base: 500, base[:-1] + "c": 7, base[:100] + base[101:]: 9, base + "z": 8, "z" + base: 8, base[:70]: 5, base[:64]: 50, base[:65]: 6, base[:63]: 5}
    got = {r.word: (r.form, r.n_near) for r in spelling.variant_forms(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert all(got[w] == (base, 1) for w in (base[:-1] + "c", base[:100] + base[101:], base + "z", "z" + base))
    assert got[base] == (None, 4) and got[base[:70]] == (None, 0)
    assert got[base[:65]] == (base[:64], 1) and got[base[:63]] == (base[:64], 1)


def test_empty_tables(spark):
    assert spelling.spelling_variants(frame(spark, [])).count() == 0
    assert spelling.spelling_variants(frame(spark, [(1, None, None, None, None), (2, " 12 ", None, None, None)])).count() == 0
    with pytest.raises(ValueError):
        spelling.variant_forms(spark.createDataFrame([], "word string, n long"), ratio=1)
