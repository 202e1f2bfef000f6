import hashlib
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from marlstone.llm import exact_dedup as exact_dedup_module
from marlstone.llm.exact_dedup import build_directory, build_index, drop_copies, exact_dedup

from .helpers import awkward, frame


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(r[0])
    out = []
    for text, ids in groups.items():
        ids = sorted(ids, key=lambda x: (x is None, x or 0))
        out += [(i, ids[0], len(ids), n == 0, hashlib.sha256(text.encode()).hexdigest()) for n, i in enumerate(ids)]
    return sorted(out, key=str)


def test_matches_brute_force_also_under_collisions(spark):
    rows = awkward()
    for options in ({}, {"hash_bits": 2, "capacity": 4, "step_bits": 4}, {"hash_bits": 10, "capacity": 1, "step_bits": 6}):
        got = sorted(map(tuple, exact_dedup(frame(spark, rows), **options).collect()), key=str)
        assert got == brute(rows)


def test_chains_hold_the_texts_of_one_hash(spark):
    _, index, _ = build_index(frame(spark, awkward()), hash_bits=1, capacity=4, step_bits=3)
    found = index.collect()
    assert {(r.depth, r.prefix) for r in found} <= {(d, p << d >> 1) for d in range(1, 9) for p in (0, 1)} and max(r.chain for r in found) > 10
    assert sum(r.group_size for r in found) == len(awkward())


def test_buckets_split_until_none_is_overfull(spark, monkeypatch):
    """Without a limit of depth: more rounds than one, and every hash in just one bucket."""
    rows = [(i, f"text {i}", None, None, None) for i in range(300)] * 2
    for capacity, step in ((7, 3), (2, 5)):
        monkeypatch.setattr(exact_dedup_module, "CELLS", 8)  # few prefixes at a time
        _, index, directory = build_index(frame(spark, rows), capacity=capacity, step_bits=step)
        found = index.collect()
        assert len(found) == 300 and max(directory.depths) > step and {r.group_size for r in found} == {2}
        held = Counter((r.depth, r.prefix) for r in found)
        assert max(held.values()) <= capacity and min(d for d, _ in held) >= 1
        assert all((r.h & (2**64 - 1)) >> (64 - r.depth) == r.prefix & (2**64 - 1) for r in found)


def test_the_owner_compares_bytes(spark):
    """With a hash of no use at all every text meets every other in one chain."""
    rows = [(i, f"text {i % 40}", None, None, None) for i in range(200)]
    _, index, _ = build_index(frame(spark, rows), hash_bits=0, capacity=3)
    found = index.collect()
    assert len({(r.depth, r.prefix) for r in found}) == 1 and sorted(r.chain for r in found) == list(range(40)) and {r.group_size for r in found} == {5}


def test_rows_change_where_the_owners_are_broken(spark, monkeypatch):
    """The row that stays and the size of a group come from the owners' chains, and from nowhere else."""
    rows = [(i, f"text {i % 7}", None, None, None) for i in range(40)]
    whole = exact_dedup_module.own_chains

    def broken(*args):
        return whole(*args).withColumns({"keep_id": F.col("keep_id") + 7, "group_size": F.col("group_size") + 1})

    monkeypatch.setattr(exact_dedup_module, "own_chains", broken)
    assert {(r.keep_id, r.kept) for r in exact_dedup(frame(spark, rows)).where("doc_id < 14").collect()} == {(k + 7, k_ == 1) for k in range(7) for k_ in (0, 1)}
    monkeypatch.setattr(exact_dedup_module, "own_chains", lambda *args: whole(*args).where("keep_id > 0"))
    assert exact_dedup(frame(spark, rows)).count() == 34


def test_large_groups_meet_their_link_where_they_are(spark, monkeypatch):
    rows = [(i // 2 if i < 90 else None, f"text {i % 3 if i % 2 else i}", None, None, None) for i in range(100)]
    monkeypatch.setattr(exact_dedup_module, "LARGE_GROUP", 5)
    for most in (1000, 1):
        monkeypatch.setattr(exact_dedup_module, "MOST_BROADCAST", most)
        assert sorted(map(tuple, exact_dedup(frame(spark, rows)).collect()), key=str) == brute(rows)


def test_directory_splits_only_overfull_buckets():
    depth, slots, buckets = build_directory({0: 5, 1: 5, 2: 1, 3: 1, 4: 1}, 3, 6)
    assert depth == 3 and slots == [0, 1, 2, 2, 3, 3, 3, 3] and buckets == [(3, 0), (3, 1), (2, 1), (1, 1)]
    assert build_directory({0: 99}, 3, 6)[0] == 3  # one cell that can't be split further
    assert build_directory({}, 3, 6) == (0, [0], [(0, 0)])


def test_empty_table_and_clashing_columns(spark):
    assert exact_dedup(frame(spark, [])).count() == 0
    rows = [(2, "x y", "h", "keep", 1), (1, "x  y", "h", "keep", 1)]
    df = frame(spark, rows).withColumnRenamed("lang", "h").withColumnRenamed("source", "keep_id")
    assert {(r.doc_id, r.kept) for r in exact_dedup(df).collect()} == {(1, True), (2, False)}
    assert [r.doc_id for r in drop_copies(df).collect()] == [1]


def test_drop_copies_keeps_one_whole_row(spark):
    rows = awkward()
    got = drop_copies(frame(spark, rows)).collect()
    assert len(got) == len({re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows})
    assert {tuple(r) for r in got} <= set(rows)


def test_drop_copies_with_names_of_its_own(spark):
    df = frame(spark, awkward()).withColumnsRenamed({"lang": "_sha", "source": "_place", "n_chars": "row"})
    got = drop_copies(df)
    assert got.columns == df.columns and got.count() == drop_copies(frame(spark, awkward())).count()
    assert {tuple(r) for r in got.collect()} <= set(awkward())
    assert drop_copies(frame(spark, [])).count() == 0
