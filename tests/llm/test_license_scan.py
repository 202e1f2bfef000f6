import random

import pytest

from marlstone.llm.license_scan import SHINGLE, TEMPLATES, bands_needed, least_jaccard, length_classes, license_scan, template_words

from .helpers import awkward, frame


def shingles(w):
    return [tuple(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)]


def brute(text):
    """Names and largest share over all windows and all templates, without retrieval."""
    w, best = template_words(text or ""), {}
    s = shingles(w)
    for c in length_classes(TEMPLATES):
        for start in range(0, len(s) + 1, c["step"]):
            held = set(s[start : start + c["window"] - SHINGLE + 1])
            for name in c["names"]:
                t = set(shingles(template_words(TEMPLATES[name])))
                best[name] = max(best.get(name, 0), len(t & held) / len(t))
    found = {n: v for n, v in best.items() if v >= 0.75}
    return ",".join(sorted(found)), len(found), max(found.values(), default=0.0)


def test_matches_brute_force(spark):
    rng = random.Random(9)
    filler = ["the", "software", "license", "under", "of", "granted", "qwe", "rty", "public"]
    rows = awkward()
    for i in range(150):
        parts = [" ".join(rng.choice(filler) for _ in range(rng.randint(0, 60)))]
        for _ in range(rng.randint(0, 3)):
            w = TEMPLATES[rng.choice(list(TEMPLATES))].split()
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(filler)
            parts += [" ".join(w), " ".join(rng.choice(filler) for _ in range(rng.randint(0, 60)))]
        rows.append((2000 + i, "\n".join(parts), "en", "s", 1))
    rows += [(3000 + i, t.upper(), "en", "s", 1) for i, t in enumerate(TEMPLATES.values())]
    got = license_scan(frame(spark, rows)).collect()
    want = sorted([(r[0], *brute(r[1])) for r in rows], key=str)
    assert sorted(map(tuple, got), key=str) == want
    assert sum(r.n_licenses for r in got) > 60


def test_bands_guarantee_retrieval():
    for c in length_classes(TEMPLATES):
        for n in c["names"]:
            words = len(template_words(TEMPLATES[n]))
            j = least_jaccard(words, c["window"], 0.75)
            assert all(1 - (1 - j**r) ** bands_needed(j, r, 0.999) >= 0.999 for r in (1, 2))
            assert c["window"] - c["step"] >= words


def test_the_bands_retrieve(spark):
    """With one band a template is found only by texts that hold its smallest shingle."""
    w = template_words(TEMPLATES["MPL-2.0"])
    rows = [(i, " ".join(w[:i] + ["zz"] + w[i + 1 :]), "", "", 1) for i in range(len(w))] + [(900, " ".join(w), "", "", 1)]
    docs = frame(spark, rows)
    least = [r.n_licenses for r in license_scan(docs, probability=1e-9).orderBy("doc_id").collect()]
    most = [r.n_licenses for r in license_scan(docs).orderBy("doc_id").collect()]
    assert least[-1] == most[-1] == 1 and sum(least) < sum(most) == sum(brute(r[1])[1] for r in rows)


def test_whole_licenses_in_long_texts(spark):
    filler = " ".join(f"word{i}" for i in range(3000))
    names = [n for n in TEMPLATES if len(template_words(TEMPLATES[n])) > 100]
    assert len(names) >= 6
    rows = [(i, f"{filler} {TEMPLATES[n]} {filler}", "", "", 1) for i, n in enumerate(names)]
    got = {r.doc_id: r.licenses.split(",") for r in license_scan(frame(spark, rows)).collect()}
    assert all(n in got[i] for i, n in enumerate(names))


def test_short_templates_are_refused_and_empty_table(spark):
    with pytest.raises(ValueError):
        license_scan(frame(spark, []), {"x": "too short"})
    assert license_scan(frame(spark, [])).count() == 0
