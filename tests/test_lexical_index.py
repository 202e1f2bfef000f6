import math
import random
import unicodedata
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.functions.analysis import FoldedWords
from marlstone.operators import lexical_index
from marlstone.operators.contracts import EngineError, NotAuthorized
from marlstone.operators.lexical_index import Bm25Index, Scope, best_of_shard

SCHEMA = "id long, text string, source string, tags array<string>, year array<int>"


def plain_tokens(text):
    t = unicodedata.normalize("NFKC", text or "").casefold()
    t = "".join(c for c in t if not ("ؐ" <= c <= "ؚ" or "ً" <= c <= "ٟ" or c == "ٰ" or "ۖ" <= c <= "ۭ" or c == "ـ"))
    for a, b in zip("أإآٱىؤئ", "اااايوي"):
        t = t.replace(a, b)
    t = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    return [w for w in "".join(c if c.isalnum() else " " for c in t).split() if len(w) >= 2]


def brute(docs, queries, limit, may=lambda q, d: True, positive_only=False):
    held = {d[0]: Counter(plain_tokens(d[1])) for d in docs}
    n, mean = len(docs), sum(c.total() for c in held.values()) / len(docs)
    df = Counter(w for c in held.values() for w in c)
    out = []
    for q, text in queries:
        asked, scored = Counter(plain_tokens(text)), []
        for d in docs:
            if may(q, d):
                c = held[d[0]]
                s = sum(r * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * c.total() / mean)) for w, r in asked.items() if w in c)
                scored.append((-round(s, 6), d[0]))
        scored = [x for x in sorted(scored) if x[0] < 0 or not positive_only]
        out += [(q, i, -s, rank) for rank, (s, i) in enumerate(scored[:limit], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdéÉß") for _ in range(rng.randint(1, 4))) for _ in range(150)]
    rows = [(i, " ".join(words[min(int(rng.expovariate(0.05)), 149)] for _ in range(rng.randint(1, 80))), rng.choice(["a", "B", None]), rng.sample(["x", "Yé", "z", " "], rng.randint(0, 3)), rng.sample(range(1990, 2030), rng.randint(0, 2))) for i in range(300)]
    return rows + [(900, None, "a", None, None), (901, "", "b", [], []), (902, "Référence Étude de sécurité", "a", ["x"], [2001]), (903, "مُسْتَشْفَىٰ أحمد", "a", ["x"], [2001])]


@pytest.fixture(scope="module")
def index(spark, docs, tmp_path_factory):
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    return Bm25Index.build(df, f"file://{tmp_path_factory.mktemp('i')}/index", ["source", "tags", "year"], shard=70).verify()


@pytest.fixture(scope="module")
def asked(docs):
    return [(i, docs[i][1]) for i in range(12)] + [(50, "reference etude securite"), (51, "zzzz"), (52, None), (53, "مستشفي احمد")]


def rows(df):
    return sorted((r.query_id, r.id, round(r.score, 6), r["rank"]) for r in df.collect())


def queries(spark, asked):
    return spark.createDataFrame(asked, "id long, text string")


@pytest.mark.parametrize("limit,positive_only", [(1, True), (5, False), (400, False)])
def test_search_is_exact(spark, index, docs, asked, limit, positive_only):
    assert rows(index.top(queries(spark, asked), limit, positive_only=positive_only)) == brute(docs, asked, limit, positive_only=positive_only)


def test_one_analyser_serves_index_and_queries(spark, index, asked):
    best = {r.query_id: r.id for r in index.top(queries(spark, asked), 1, positive_only=True).collect()}
    assert best[50] == 902 and best[53] == 903 and 51 not in best
    analyse = FoldedWords()
    for text in ("Référence Étude", "Straße ﬁn ½ a b_c x", "مُسْتَشْفَىٰ", "İstanbul Ä", "¨x yy", None, "²³ 12"):
        assert analyse(text) == plain_tokens(text)


def test_every_query_has_its_own_filter_in_one_plan(spark, index, docs, asked):
    general = Scope.of(spark, {"source": ["A ", "b"]}, query_type="long")
    scope = general.also(Scope.of(spark, None, {0: {"tags": ["X", "yé"]}, 1: {("year", "at_most"): 2005, "tags": ["z"]}, 2: {("year", "at_least"): [2010]}, 3: {"tags": ["none"]}, 4: {"tags": [" ", ""]}}, "long"))

    def may(q, d):
        fold = [t.casefold().replace("é", "e") for t in d[3] or ()]
        ok = (d[2] or "").lower() in ("a", "b")
        if q == 0:
            ok &= bool({"x", "ye"} & set(fold))
        if q == 1:
            ok &= "z" in fold and any(y <= 2005 for y in d[4] or ())
        if q == 2:
            ok &= any(y >= 2010 for y in d[4] or ())
        return ok and q != 3

    assert rows(index.top(queries(spark, asked), 6, scope)) == brute(docs, asked, 6, may)
    with pytest.raises(EngineError):
        index.top(queries(spark, asked), 6, Scope.of(spark, {"nothing": ["a"]}))
    with pytest.raises(EngineError):
        Scope.of(spark, {("year", "like"): [1]})
    for none in ([], [" ", None]):
        with pytest.raises(NotAuthorized):
            Scope.security(spark, "source", none)


def test_allowed_ids_and_values_of_a_table(spark, index, docs, asked):
    even = spark.range(0, 300, 2)
    assert rows(index.top(queries(spark, asked), 5, allowed_ids=even)) == brute(docs, asked, 5, lambda q, d: d[0] < 300 and d[0] % 2 == 0)
    scope = Scope.of(spark, query_type="long").values("tags", spark.createDataFrame([("X",), (None,), ("z",)], "v string"))
    assert rows(index.top(queries(spark, asked), 5, scope)) == brute(docs, asked, 5, lambda q, d: bool({"x", "z"} & set(d[3] or ())))


def test_many_queries_go_in_blocks_and_by_shuffle(spark, index, docs, asked, monkeypatch):
    monkeypatch.setattr(lexical_index, "FEW_QUERIES", 3)
    monkeypatch.setattr(lexical_index, "QUERY_BLOCK", 4)
    monkeypatch.setattr(lexical_index, "MOST_PAIRS", 5)
    scope = Scope.of(spark, {"source": ["a"]}, {1: {"tags": "x"}}, "long")
    want = brute(docs, asked, 4, lambda q, d: d[2] == "a" and (q != 1 or "x" in (d[3] or ())))
    assert rows(index.top(queries(spark, asked), 4, scope)) == want


def test_bounds_leave_blocks_unread_and_lose_nothing():
    rng = np.random.default_rng(2)
    n = 6000
    lengths = rng.integers(5, 60, n).astype(float)
    norms = 1.2 * (0.25 + 0.75 * lengths / lengths.mean())

    def postings(places, idf):
        tfs = rng.integers(1, 4, len(places))
        starts = np.arange(0, len(places), lexical_index.BLOCK)
        return lexical_index.Postings(places, tfs, np.maximum.reduceat(tfs, starts), np.minimum.reduceat(lengths[places], starts), idf, 1.2, 0.75, lengths.mean())

    rare, common = postings(np.sort(rng.choice(400, 12, False)), 9.0), postings(np.arange(n), 0.01)
    middle = postings(np.sort(rng.choice(n, 900, False)), 1.0)
    for may in (None, rng.random(n) < 0.5):
        for lists in ([(rare, 1), (common, 2)], [(rare, 1), (middle, 1), (common, 3)], [(common, 1)], []):
            places, scores, blocks, read = best_of_shard(lists, norms, may, 5, False)
            total = np.zeros(n)
            for p, r in lists:
                total[p.places] += r * p.parts(norms)
            order = sorted((-round(s, 6), i) for i, s in enumerate(total) if may is None or may[i])[:5]
            assert [(-s, i) for s, i in zip(scores.tolist(), places.tolist())] == order
            assert read <= blocks and (len(lists) < 2 or read < blocks)


def test_a_search_opens_the_folders_of_its_terms_only(spark, index, docs):
    one = queries(spark, [(1, docs[3][1].split()[0] + " etude")])
    terms = set(plain_tokens(docs[3][1].split()[0] + " etude"))
    plan = index.top(one, 3)._jdf.queryExecution().executedPlan().toString()
    asked = {lexical_index._bucket(w, index.fact.buckets) for w in terms}
    assert "PushedFilters: [In(term" in plan or "EqualTo(term" in plan
    held = index.rows.where("kind = 'postings'").select("bucket").distinct().count()
    read = index._of_terms(index.rows.where("kind = 'postings'"), sorted(terms))
    assert {r.bucket for r in read.select("bucket").distinct().collect()} == asked and len(asked) < held
    assert len(read.inputFiles()) == len(index.rows.inputFiles()) or len(asked) < held
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert not [x for x in exchanges if "query_id" in x and " id#" in x]


def test_damage_is_found(spark, index, tmp_path):
    for damage in (lambda r: r.where("kind <> 'documents'"), lambda r: r.withColumn("cf", F.col("cf") + 1), lambda r: r.withColumn("tfs", F.slice("tfs", 1, 1)), lambda r: r.withColumn("top_tf", F.transform("top_tf", lambda x: x * 0))):
        broken = Bm25Index.load(spark, index.path)
        broken.rows = damage(broken.rows)
        with pytest.raises(EngineError):
            broken.verify()
    none = spark.createDataFrame([], "id long, text string")
    with pytest.raises(EngineError):
        Bm25Index.build(none, str(tmp_path / "a"))
    blank = spark.createDataFrame([(1, "?")], "id long, text string")
    assert Bm25Index.build(blank, str(tmp_path / "b")).top(blank, 3).count() == 1
    with pytest.raises(EngineError):
        Bm25Index.build(blank, str(tmp_path / "c"), refuse_empty=True)
    odd = Bm25Index.load(spark, index.path).facts.withColumn("analyser", F.lit("other"))
    odd.write.parquet(str(tmp_path / "d" / "facts"))
    with pytest.raises(EngineError):
        Bm25Index.load(spark, str(tmp_path / "d"))


def test_statistics_and_postings(index, docs):
    counts = {d[0]: Counter(plain_tokens(d[1])) for d in docs}
    got = {(r.term, r.id): (r.tf, r.length) for r in index.postings().collect()}
    assert got == {(w, i): (n, c.total()) for i, c in counts.items() for w, n in c.items()}
    df = Counter(w for c in counts.values() for w in c)
    assert {r.term: (r.df, round(r.idf, 9)) for r in index.statistics().collect()} == {w: (n, round(math.log(1 + (len(docs) - n + 0.5) / (n + 0.5)), 9)) for w, n in df.items()}


def test_text_ids(spark, tmp_path):
    df = spark.createDataFrame([("é2", "solar"), ("b", "solar"), ("a", "solar wind")], "id string, text string")
    got = Bm25Index.build(df, str(tmp_path / "s"), buckets=1).top(spark.createDataFrame([("Q", "Solar")], "id string, text string"), 3).orderBy("rank").collect()
    assert [r.id for r in got] == ["b", "é2", "a"]
