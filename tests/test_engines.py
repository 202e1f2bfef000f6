import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.operators import corpus, recommend, retrieval, search
from marlstone.operators.contracts import EngineError, NotAuthorized
from marlstone.operators.lexical_index import Scope


@pytest.fixture(scope="module")
def chunks(spark):
    rows = [(1, "d1", "solar power plant", "PUBLIC"), (2, "d1", "solar panels on roofs", "PUBLIC"), (3, "d2", "water treatment plant", "INTERNAL"), (4, "d3", "solar solar power plant secret", "CONFIDENTIAL")]
    df = spark.createDataFrame(rows, "id long, document_id string, text string, security_classification string")
    return search.encoded(df, "text", search.HashEncoder())


@pytest.fixture(scope="module")
def asked(spark):
    return search.encoded(spark.createDataFrame([("R1", "solar power plant"), ("R2", "water treatment")], "id string, text string"), "text", search.HashEncoder(), "query", "query_vector")


@pytest.mark.parametrize("mode", search.MODES)
def test_no_mode_returns_what_is_not_authorized(chunks, asked, mode):
    got = search.search_chunks(chunks, asked, ["public", "INTERNAL"], mode, 3).collect()
    assert 4 not in {r.id for r in got} and {r.id for r in got if r["rank"] == 1 and r.query_id == "R1"} == {1}
    with pytest.raises(NotAuthorized):
        search.search_chunks(chunks, asked, [], mode)
    assert search.search_chunks(chunks, asked, ["PUBLIC"], mode, scope=Scope.of(chunks.sparkSession, {"document_id": "d9"})).count() == 0
    with pytest.raises(EngineError):
        search.search_chunks(chunks, asked, ["PUBLIC"], "other")


def test_documents_carry_their_best_chunks(chunks, asked):
    got = {(r.query_id, r["rank"]): (r.document_id, r.evidence) for r in search.search_documents(chunks, asked, ["PUBLIC", "INTERNAL"]).collect()}
    assert got["R1", 1][0] == "d1" and got["R1", 1][1][0] == 1 and got["R2", 1][0] == "d2"


def test_match_only_uses_eligible_references(spark, chunks, asked):
    refs = spark.createDataFrame([("A", "d1"), ("B", "d1")], "reference_id string, document_id string")
    got = search.match(chunks, asked, refs, ["PUBLIC", "INTERNAL"], mode="bm25").collect()
    assert {r.reference_id for r in got} == {"A", "B"} and {r.chunk_id for r in got} == {1, 2}
    assert {r.term_coverage for r in got if r.requirement_id == "R1" and r.chunk_id == 1} == {1.0}


@pytest.mark.parametrize("mode", search.MODES)
def test_match_finds_evidence_behind_a_document_that_fills_the_first_ranks(spark, mode):
    rows = [(i, "hot", "solar power plant", "PUBLIC") for i in range(30)] + [(90, "cold", "solar power and other works", "PUBLIC")]
    chunks = search.encoded(spark.createDataFrame(rows, "id long, document_id string, text string, security_classification string"), "text", search.HashEncoder())
    asked = search.encoded(spark.createDataFrame([("R1", "solar power plant")], "id string, text string"), "text", search.HashEncoder(), "query", "query_vector")
    refs = spark.createDataFrame([("A", "hot"), ("B", "cold")], "reference_id string, document_id string")
    got = {(r.reference_id, r.chunk_id): r.retrieval_rank for r in search.match(chunks, asked, refs, ["PUBLIC"], mode=mode).collect()}
    assert len(got) == 4 and got["B", 90] == 31
    assert {r.reference_id for r in search.match(chunks, asked, refs, ["PUBLIC"], mode=mode, limit=30).collect()} == {"A"}


def test_match_takes_term_statistics_from_all_chunks(spark, chunks, asked):
    refs = spark.createDataFrame([("B", "d2")], "reference_id string, document_id string")
    got = {r.requirement_id: r.score for r in search.match(chunks, asked, refs, ["PUBLIC", "INTERNAL"], mode="bm25").collect()}
    whole = {r.query_id: r.score for r in search.search_chunks(chunks, asked, ["PUBLIC", "INTERNAL"], "bm25").where("id = 3").collect()}
    assert got == whole and got["R2"] > 0


def test_encoder_is_deterministic_and_unit():
    v = search.HashEncoder(16).encode(["a b", "", "a b"], "passage")
    assert np.allclose(np.linalg.norm(v, axis=1), 1) and np.array_equal(v[0], v[2])


def test_probe_selection_and_overlap(spark):
    d = spark.createDataFrame([(1, ["x"], ["y"]), (2, ["x"], ["y"]), (3, ["x"], [])], "id long, a array<string>, b array<string>")
    assert [(r.primary_id, r.relevant) for r in search.probes(d, ["a", "b"], templates=(("a", "b"),)).collect()] == [(2, [1, 2])]
    means = spark.createDataFrame([("a", 0.9, 0.5, 0.5), ("b", 0.9, 0.6, 0.1), ("c", 0.2, 0.9, 0.9)], "mode string, recall_at_10 double, ndcg_at_10 double, mrr double")
    assert search.select_system(means, 0.85).first().mode == "b"
    assert search.overlap(d.select("id"), d.where("id > 1").select("id"), "id").first().jaccard == pytest.approx(2 / 3)


def plain_probes(docs, most, seed):
    """The wording: a probe per document and template, at most 12 relevant, distinct primary documents first."""

    def fold(t):
        return t.lower()

    held = {i: {(f, fold(v)) for f, vs in facets.items() for v in vs} for i, facets in docs.items()}
    found = {}
    for i in sorted(docs):
        for names in search.PROBE_TEMPLATES:
            picked = [(f, docs[i][f][0]) for f in names if docs[i].get(f) and fold(docs[i][f][0]) not in search.EMPTY_ANSWERS]
            relevant = sorted(j for j in docs if all((f, fold(v)) in held[j] for f, v in picked))
            if len(picked) >= 2 and len(relevant) <= 12:
                text = "expérience et référence " + " ".join(v for _, v in picked)
                found[fold(text)] = (len(relevant), -len(picked), hashlib.sha256(f"{seed}|{text}".encode()).hexdigest(), text, relevant, i, picked[-1])
    rows, first, used = sorted(found.values()), [], set()
    for r in rows:
        if r[5] not in used:
            first.append(r)
            used.add(r[5])
    return [(r[3], r[4], r[5], r[6]) for r in (first + [r for r in rows if r not in first])[:most]]


def test_probes_match_the_plain_wording(spark):
    rng = random.Random(6)
    names = ("client", "offering", "sector", "service_nature", "country")
    docs = {i: {f: [rng.choice(["Oui", "A b", "Cé", "D", "e"]) + (str(rng.randrange(3)) if f == "client" else "") for _ in range(rng.randint(0, 2))] for f in names} for i in range(60)}
    df = spark.createDataFrame([(i, *[d[f] for f in names]) for i, d in docs.items()], "id long, " + ", ".join(f"{f} array<string>" for f in names))
    for most in (5, 40, 500):
        got = search.probes(df, list(names), most).orderBy("query_id").collect()
        assert len({r.query_id for r in got}) == len(got)
        assert [(r.query_text, r.relevant, r.primary_id, tuple(r.filter)) for r in got] == plain_probes(docs, most, "0")


def test_bootstrap_evaluation_checks_filters_and_counts_misses(spark, chunks, asked):
    probes = asked.withColumn("relevant", F.when(F.col("id") == "R1", F.array(F.lit("d1"))).otherwise(F.array(F.lit("d9"))))
    probes = probes.withColumn("filter", F.struct(F.lit("document_id").alias("facet"), F.when(F.col("id") == "R1", "D1").otherwise("d2").alias("value")))
    cited = chunks.withColumn("uri", F.when(F.col("id") != 3, F.lit("u")))
    metrics, hits, checks = search.evaluate_bootstrap(cited, probes, ["PUBLIC", "INTERNAL"], "filter", "uri")
    assert {r.mode: (r.queries, r.recall_at_10) for r in metrics.collect()} == dict.fromkeys(search.MODES, (2, 0.5))
    assert {r.id for r in hits.collect()} <= {"d1", "d2"} and checks.first().filter_correctness == 1.0
    assert checks.first().citation_coverage == pytest.approx(hits.where("best_id <> 3").count() / hits.count()) and 0 < checks.first().citation_coverage < 1
    nowhere = probes.withColumn("filter", F.struct(F.lit("document_id").alias("facet"), F.lit("d9").alias("value")))
    assert search.evaluate_bootstrap(cited, nowhere, ["PUBLIC", "INTERNAL"], "filter")[2].first().filter_correctness == 0.0


def test_pool_is_as_large_as_the_limit(spark):
    rows = [(i, f"d{i}", "solar", "PUBLIC") for i in range(150)]
    many = search.encoded(spark.createDataFrame(rows, "id long, document_id string, text string, security_classification string"), "text", search.HashEncoder())
    one = search.encoded(spark.createDataFrame([("R1", "solar")], "id string, text string"), "text", search.HashEncoder(), "query", "query_vector")
    assert search.search_chunks(many, one, ["PUBLIC"], "hybrid", limit=140).count() == 140


def test_hits_carry_both_scores_and_are_audited(spark, chunks, asked):
    scope = Scope.of(spark, None, {"R1": {"document_id": ["d1", "d3"]}})
    found = search.search_chunks(chunks, asked, ["PUBLIC", "INTERNAL"], scope=scope)
    rows = {(r.query_id, r.id): r for r in found.collect()}
    assert {i for q, i in rows if q == "R1"} == {1, 2} and all(r.dense_rank and r.lexical_rank and r.dense_score is not None for r in rows.values())
    assert rows["R1", 1].lexical_score > rows["R1", 2].lexical_score > 0
    assert {r.query_id: (r.scored, r.authorized, r.in_scope) for r in search.hit_audit(found, chunks, ["public", "internal"], scope).collect()} == {"R1": (2, 2, 2), "R2": (3, 3, 3)}
    wrong = spark.createDataFrame([("R1", 3), ("R1", 4), ("R1", 1)], "query_id string, id long")
    assert tuple(search.hit_audit(wrong, chunks, ["PUBLIC"], scope).first()) == ("R1", 3, 1, 2)
    lexical = search.search_chunks(chunks, asked, ["PUBLIC"], "bm25").first()
    assert lexical.dense_score is None and lexical.lexical_rank == lexical["rank"]


def test_accents_and_arabic_forms_are_folded_in_every_engine(spark):
    rows = [(1, "d1", "Référence Étude de sécurité", "PUBLIC"), (2, "d2", "مُسْتَشْفَىٰ أحمد", "PUBLIC"), (3, "d3", "other words", "PUBLIC")]
    chunks = search.encoded(spark.createDataFrame(rows, "id long, document_id string, text string, security_classification string"), "text", search.HashEncoder())
    asked = search.encoded(spark.createDataFrame([("A", "reference etude SECURITE"), ("B", "مستشفي احمد")], "id string, text string"), "text", search.HashEncoder(), "query", "query_vector")
    refs = spark.createDataFrame([("R1", "d1"), ("R2", "d2"), ("R3", "d3")], "reference_id string, document_id string")
    best = {r.query_id: (r.id, r.score > 0) for r in search.search_chunks(chunks, asked, ["PUBLIC"], "bm25", 1).collect()}
    assert best == {"A": (1, True), "B": (2, True)}
    got = {r.requirement_id: r for r in search.match(chunks, asked, refs, ["PUBLIC"], mode="bm25").where("retrieval_rank = 1").collect()}
    assert got["A"].reference_id == "R1" and got["A"].term_coverage == 1.0 and got["B"].reference_id == "R2"
    first = {(r.requirement_id, r.reference_id): r.relevance for r in recommend.requirement_evidence(chunks, asked, refs, ["PUBLIC"]).collect()}
    assert first == {("A", "R1"): 1.0, ("B", "R2"): 1.0}
    evidence, audit = search.match_contract(chunks, asked, refs.withColumns({"security_classification": F.lit("PUBLIC"), "base_shortlist_eligible": F.lit(True), "evidence_available": F.col("reference_id") != "R1"}), ["PUBLIC"], exclusions=[{"field": "evidence_available", "operator": "is_false"}], mode="bm25")
    assert {r.reference_id for r in evidence.collect()} == {"R2", "R3"} and audit.first().excluded_ids == ["R1"]


def test_scores_that_are_no_numbers_are_not_ranked(spark):
    odd = spark.createDataFrame([(1, 1, float("nan")), (1, 2, 0.5), (1, 3, float("inf")), (1, 4, None)], "query_id int, id int, score double")
    assert [(r.id, r["rank"]) for r in retrieval.top_ranked(odd, 5).collect()] == [(2, 1)]


def test_dossier_evidence_is_grounded_in_context_and_title(spark):
    rec = spark.createDataFrame([("A", "solar works plant", "solar roofs villages energy")], "reference_id string, title string, context string")
    ev = spark.createDataFrame([("A", 1, "solar works plant", 0.5, "u1"), ("A", 2, "solar roofs villages energy", 0.5, "u2"), ("A", 3, "energy villages", 0.4, "u3"), ("A", 4, "villages energy", 0.9, "u4"), ("A", 5, "energy villages", 0.4, "u0"), ("A", 2, "solar roofs villages energy", 0.1, "u2"), ("A", 6, "nothing here", 1.0, "u5")], "reference_id string, chunk_id int, text string, relevance double, uri string")
    got = search.dossier(rec, ev, F.col("text"), F.col("title"), F.col("context"), F.col("relevance"), F.col("uri")).orderBy("place").collect()
    assert [r.chunk_id for r in got] == [2, 1, 4, 5, 3] and not any(r.weak for r in got)
    assert got[1].grounding == pytest.approx(0.65 * 1 + 0.35 * 0.25) and got[2].grounding == pytest.approx(0.5)
    none = search.dossier(rec, ev.where("chunk_id = 6"), F.col("text"), F.col("title"), F.col("context")).collect()
    assert [(r.chunk_id, r.weak) for r in none] == [(6, True)]


def test_packets_are_blinded_and_records_whole(spark, chunks):
    ranked = spark.createDataFrame([("bm25", 1, "d1", 1, 2), ("dense", 1, "d1", 2, 1), ("dense", 1, "d2", 1, 3), ("dense", 1, "d9", 11, 3)], "mode string, query_id int, id string, rank int, best_id long")
    queries = spark.createDataFrame([(1, "solar?", "fr")], "query_id int, query_text string, query_language string")
    got = {r.id: r for r in search.judging_packet(ranked, chunks, queries, most_chars=5).collect()}
    assert set(got) == {"d1", "d2"} and got["d1"].excerpt == "solar" and got["d1"].best_id == 2 and got["d1"].query_language == "fr"
    assert not {"mode", "modes", "rank"} & set(got["d1"].asDict()) and {r.position for r in got.values()} == {1, 2}
    rec = spark.createDataFrame([("A", "solar plant works"), ("B", "other")], "reference_id string, title string")
    ev = spark.createDataFrame([("A", i, t) for i, t in enumerate(["solar plant", "water", "solar works plant", "plant"])], "reference_id string, chunk_id int, text string")
    cover = spark.createDataFrame([("A", "q2", "SHOULD", True), ("A", "q9", "MUST", True), ("B", "q1", "MUST", False)], "reference_id string, requirement_id string, classification string, covered boolean")
    made = {r.reference_id: r for r in search.dossier_records(rec, ev, cover, F.col("text"), F.col("title"), quota=2).collect()}
    assert [e.chunk_id for e in made["A"].evidence] == [2, 0] and made["A"].requirements == ["q9", "q2"]
    assert made["B"].evidence == [] and made["B"].requirements == []


def test_citations_are_checked_against_the_text(spark):
    sha = hashlib.sha256(b"t").hexdigest()
    chunks = spark.createDataFrame([(1, "t", sha, "u#page=1"), (2, "t", "broken", "")], "id long, text string, text_sha256 string, citation_uri string")
    r = search.citation_metrics(spark.createDataFrame([(1, 1.0), (2, 0.0)], "chunk_id long, term_coverage double"), chunks).first()
    assert (r.citation_rows, r.completeness, r.integrity, r.support) == (2, 0.5, 0.5, 0.5)


@pytest.mark.parametrize(("chars", "ocr", "conf", "blank", "want"), [(5, False, None, True, "BLANK"), (15, False, None, False, "FAILED"), (60, False, None, False, "REVIEW"), (500, True, 30.0, False, "FAILED"), (500, True, 60.0, False, "REVIEW"), (500, True, None, False, "FAILED"), (500, False, None, False, "PASS")])
def test_page_status(spark, chars, ocr, conf, blank, want):
    df = spark.createDataFrame([(chars, ocr, conf, blank)], "c int, o boolean, k double, b boolean")
    assert df.select(corpus.page_status(F.col("c"), F.col("o"), F.col("k"), F.col("b"))[0].alias("s")).first().s == want


def test_pages_to_chunks_keep_ids_and_drop_ineligible(spark):
    p = spark.createDataFrame([("d", 2, "h", "second page. " * 200, True, "Contrat.pdf"), ("d", 1, "h", "le contrat de la ville", True, "Contrat.pdf"), ("e", 1, "h", "gone", None, "x")], "document_id string, page int, source_sha256 string, text string, retrieval_eligible boolean, file_name string")
    pages = corpus.canonical_pages(p)
    doc = corpus.document_catalogue(pages).first()
    assert (doc.document_id, doc.pages, doc.language, doc.document_type) == ("d", 2, "fr", "CONTRACT")
    one, two = (sorted(r.chunk_id for r in corpus.chunk_table(pages.repartition(n)).collect()) for n in (1, 3))
    assert one == two and len(set(one)) == len(one) > 2


def test_ocr_words_and_attempts(spark):
    w = spark.createDataFrame([(1, 1, 1, 1, 2, "world", 80.0), (1, 1, 1, 1, 1, "hi", 50.0), (1, 1, 1, 2, 1, "x", -1.0)], "page long, block int, paragraph int, line int, word int, text string, confidence double")
    r = corpus.ocr_lines(w, ["page"]).first()
    assert r.text == "hi world\nx" and r.confidence == pytest.approx((50 * 2 + 80 * 5) / 7)
    a = spark.createDataFrame([(1, 1, "REVIEW", 900, 100, 90.0), (1, 2, "PASS", 10, 100, 80.0), (1, 3, "PASS", 10, 100, 80.0)], "page long, attempt int, status string, words int, chars int, confidence double")
    assert corpus.best_attempt(a, ["page"]).first().attempt == 2


def test_references_and_reviews(spark):
    links = spark.createDataFrame([("s", 1, "t1"), ("s", 2, "t9")], "sheet string, row_number long, target_file_id string")
    targets = spark.createDataFrame([("t1", "r1", "DOWNLOADED")], "target_file_id string, resolved_file_id string, snapshot_status string")
    master = spark.createDataFrame([(1, "Acme"), (2, "acme")], "row_number long, client string")
    have = spark.createDataFrame([("r1",)], "document_id string")
    refs = corpus.reference_catalogue(links, targets, master, have)
    got = {r.row_number: (r.canonical_document_id, r.snapshot_status, r.evidence_available) for r in refs.collect()}
    assert got == {1: ("r1", "DOWNLOADED", True), 2: ("t9", "UNKNOWN", False)}
    meta = corpus.reference_metadata(refs.withColumn("canonical_document_id", F.lit("d")), ["client"]).first()
    assert meta.client == ["Acme"] and meta.reference_rows == [1, 2]
    rows = spark.createDataFrame([("APPROVE", "a", None), ("edit", "b", "B"), ("REJECT", "c", None)], "decision string, text string, fix string")
    assert sorted(r.text for r in corpus.review_decisions(rows, "decision", "text", "fix").collect()) == ["B", "a"]
    with pytest.raises(EngineError):
        corpus.review_decisions(spark.createDataFrame([("PENDING", "a", "")], "decision string, text string, fix string"), "decision", "text", "fix")
