import random
from collections import Counter

import numpy as np

from marlstone.llm import jaccard_join as J

from .helpers import awkward, frame


def words_of(text):
    return bytes(text or "", "utf-8").lower().split()


def shingles(text):
    w = words_of(text)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is not None and rows[j][0] is not None and sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                    parent[find(i)] = find(j)
    best = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            best[find(i)] = min(best.get(find(i), r[0]), r[0])
    return Counter((r[0], len(sets[i]), None if r[0] is None else best[find(i)]) for i, r in enumerate(rows))


def got(spark, rows, **options):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_components(frame(spark, rows), **options).collect())


def near_copies(seed, groups=12, size=12):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(500)]
    passage = [rng.choice(vocabulary) for _ in range(50)]
    rows, n = [], 0
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 150))]
        if rng.random() < 0.6:
            base[5:5] = passage
        for _ in range(rng.randint(1, size)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                k = rng.randrange(len(w))
                w[k : k + 1] = rng.choice([[], ["new"], [w[k].upper()], [w[k], "more"]])
            rows.append((n, " ".join(w), "en", "s", 1))
            n += 1
    return rows


def test_components_match_brute_force(spark):
    rows = near_copies(1) + [(1000 + r[0] if r[0] is not None else None, *r[1:]) for r in awkward(20)]
    want = brute(rows)
    assert got(spark, rows) == want
    assert got(spark, rows, local=1, tile_rows=3, part_rows=2) == want  # nearly every shared shingle in parts
    rows = near_copies(2, groups=25, size=6)
    assert got(spark, rows, local=10_000) == brute(rows)


def test_signature_tree_loses_no_link():
    rng = random.Random(4)
    for round_ in range(20):
        sets = []
        for _ in range(30):
            base = np.array([rng.getrandbits(64) for _ in range(rng.randint(4, 60))], np.uint64)
            for _ in range(rng.randint(1, 4)):
                keep = np.array([rng.random() > 0.1 for _ in base])
                sets.append(np.unique(np.concatenate([base[keep], np.array([rng.getrandbits(64)], np.uint64)])))
        sets.sort(key=len)
        comp = np.array([rng.randrange(40) for _ in sets])
        bits = np.stack([J.signature(x, 6) for x in sets])
        found = set()
        for i, j in J.SignatureTree(bits, np.array([len(x) for x in sets]), comp).pairs(75):
            found |= set(zip(i.tolist(), j.tolist()))
        for j in range(len(sets)):
            for i in range(j):
                if comp[i] != comp[j] and J.linked(sets[i], sets[j], 75):
                    assert (i, j) in found
        assert all(comp[i] != comp[j] and i < j for i, j in found)
        assert len(found) < len(sets) * (len(sets) - 1) / 2


def test_search_loses_no_link_and_prunes():
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(50)]
    sets = [np.unique(np.array([x if rng.random() > 0.05 else rng.getrandbits(64) for x in base], np.uint64)) for _ in range(20)]
    sets += [np.unique(np.array([rng.getrandbits(64) for _ in range(rng.randint(4, 90))], np.uint64)) for _ in range(60)]
    sets.sort(key=len)
    tree = J.SignatureTree(np.stack([J.signature(x, 9) for x in sets]), np.array([len(x) for x in sets]), np.arange(len(sets)))
    for x in sets[::7]:
        found = set(tree.search(J.signature(x, 9), len(x), 75).tolist())
        assert {i for i, y in enumerate(sets) if J.linked(x, y, 75)} <= found
    assert len(found) < len(sets)


def test_the_trees_find_the_links(spark):
    nodes = spark.createDataFrame([(r[0], True, r[1]) for r in near_copies(7)], "node long, named boolean, text string")
    _, links = J.find_links(nodes)
    assert links.count() > 20


def test_runs_come_whole_whatever_the_batches():
    rows = J.pd.DataFrame({"k": [1, 1, 2, 2, 2, 2, 2, 3, 4, 4], "v": range(10)})
    for cut in (1, 2, 3, 10):
        out = []
        for b, starts in J._runs((rows.iloc[i : i + cut] for i in range(0, 10, cut)), ["k"]):
            out += [tuple(x) for x in np.split(b.v.to_numpy(), starts[1:])]
        assert out == [(0, 1), (2, 3, 4, 5, 6), (7,), (8, 9)]


def test_folding_keeps_the_set():
    x = np.array([random.Random(1).getrandbits(64) for _ in range(100)], np.uint64)
    assert np.array_equal(J.fold(J.signature(x, 9), 9, 7), J.signature(x, 7))


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    parent = {}

    def find(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    found = {r.node: r.component for r in J.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found.get(i, i) == find(i) for i in parent)


def test_one_of_each_group_stays(spark):
    rows = near_copies(5)
    keep = {k[2] for k in brute(rows)}
    assert {r.doc_id for r in J.keep_one_of_each(frame(spark, rows)).collect()} == keep


def test_rows_are_told_apart_by_text_not_by_id_alone(spark):
    a = "one two three four five six seven eight nine ten"
    rows = [(1, a, "en", "s", 1), (5, a + " eleven", "en", "s", 1), (5, "another text of its own that links with none", "en", "s", 1), (5, "another text of its own that links with none", "fr", "s", 1)]
    kept = J.keep_one_of_each(frame(spark, rows)).collect()
    assert sorted(r.text for r in kept) == sorted([a, rows[2][1]])
    same = [(7, a, "en", "s", 1), (7, a + " eleven", "en", "s", 1), (7, a, "en", "s", 1), (None, a, "en", "s", 1), (8, "", "", "", 1), (8, "", "", "", 1)]
    odd = frame(spark, same).withColumnsRenamed({"lang": "_gone", "source": "key", "n_chars": "row"})
    stage = J.keep_one_of_each(odd)
    kept = stage.collect()
    assert stage.columns == odd.columns
    assert sorted((r.doc_id or 0, len(r.text)) for r in kept)[0] == (0, len(a)) and sum(r.doc_id == 7 for r in kept) == 1 and sum(r.doc_id == 8 for r in kept) == 2


def test_many_rows_under_one_null_id(spark):
    a = "one two three four five six seven eight nine ten"
    rows = [(None, a, "en", "s", i) for i in range(50)] + [(3, a, "en", "s", 0), (4, a + " x", "en", "s", 0)]
    kept = J.keep_one_of_each(frame(spark, rows)).collect()
    assert sum(r.doc_id is None for r in kept) == 50 and [r.doc_id for r in kept if r.doc_id] == [3]


def test_empty(spark):
    assert J.jaccard_components(frame(spark, [])).count() == 0
    assert got(spark, [(1, None, "", "", 1), (2, "", "", "", 1), (3, "a", "", "", 1)]) == Counter({(1, 0, 1): 1, (2, 0, 2): 1, (3, 1, 3): 1})
