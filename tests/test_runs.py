import pytest
from pyspark.sql import functions as F

from marlstone.__main__ import main
from marlstone.functions.chunking import ChunkRules
from marlstone.operators import filters, search
from marlstone.operators.contracts import EngineError
from marlstone.plans import runs
from marlstone.sources import sinks

FIELDS = ["client", "offering", "sector", "service_nature", "country"]
WORDS = ["solar", "water", "roads", "audit", "grid", "bank", "cloud", "port", "rail", "school", "energy", "health"]


@pytest.fixture(scope="module")
def corpus_run(spark, tmp_path_factory):
    out = f"file://{tmp_path_factory.mktemp('run')}/corpus"
    rows = [(f"d{i}", p, f"Contrat {i}.pdf", "a" * 64, "INTERNAL", f"Page {p} of {WORDS[i]} works. " * 12 + f"The {WORDS[i]} project of {WORDS[(i + 1) % 12]}.", p != 3) for i in range(12) for p in (1, 2, 3)]
    pages = spark.createDataFrame(rows, "document_id string, page int, file_name string, source_sha256 string, security_classification string, text string, retrieval_eligible boolean")
    refs = spark.createDataFrame([(f"R{i}", i, f"d{i}", f"client {WORDS[i]}", f"offering {WORDS[i]}", "sector", f"{WORDS[i]} service", "Tunisie") for i in range(12)], "reference_id string, row_number int, canonical_document_id string, " + ", ".join(f"{f} string" for f in FIELDS))
    manifest = runs.run_corpus(spark, pages, refs, FIELDS, out, "https://store/{id}/view", ChunkRules(most=200, overlap=40, least=50, window=80))
    return out, manifest


def test_a_corpus_run_is_complete_and_any_change_is_found(spark, corpus_run, tmp_path):
    out, manifest = corpus_run
    assert manifest["facts"]["documents"] == 12 and manifest["tables"]["excluded_pages"]["rows"] == 12 and manifest["facts"]["pages"] == 24
    t = runs.pinned(spark, out, "corpus")
    assert {r.data_quality_status for r in t["documents"].collect()} == {"PARTIAL_PAGE_EXCLUSION"}
    assert t["pages"].first().citation_uri.startswith("https://store/d") and t["chunks"].where("document_type <> 'CONTRACT'").isEmpty()
    with pytest.raises(EngineError):
        runs.write_run(spark, out, "corpus", {}, {})  # complete runs are not written over
    with pytest.raises(EngineError):
        runs.verify_run(spark, out, "retrieval")
    with pytest.raises(EngineError):
        runs.pinned(spark, out, "corpus", "0" * 64)
    copy = f"file://{tmp_path}/copy"
    runs.write_run(spark, copy, "corpus", t, {})
    runs.verify_corpus(spark, copy)
    sinks.put_text(spark, f"{copy}/MANIFEST.json", "{}")
    with pytest.raises(EngineError):
        runs.verify_run(spark, copy)
    other = f"file://{tmp_path}/other"
    runs.write_run(spark, other, "corpus", t, {})
    t["chunks"].limit(3).write.mode("overwrite").parquet(f"{other}/chunks")
    with pytest.raises(EngineError):
        runs.verify_run(spark, other)
    with pytest.raises(EngineError):
        runs.write_run(spark, f"{other}x", "corpus", {"t": t["pages"].withColumn("text_raw", F.lit("x"))}, {})
    with pytest.raises(EngineError):
        runs.verify_run(spark, f"{other}none")


def test_retrieval_and_evaluation_runs(spark, corpus_run, tmp_path):
    out = f"file://{tmp_path}/retrieval"
    manifest = runs.run_retrieval(spark, corpus_run[0], out, search.HashEncoder(), ["INTERNAL"], FIELDS, most_probes=8)
    assert manifest["tables"]["probes"]["rows"] == 8 and manifest["tables"]["metrics"]["rows"] == 3
    runs.verify_retrieval(spark, out)
    queries = spark.createDataFrame([(1, "q")], "query_id int, text string")
    labels = spark.createDataFrame([(1, "a", 3), (1, "b", 0)], "query_id int, candidate_id string, relevance int")
    other = labels.withColumn("relevance", F.when(F.col("candidate_id") == "b", 1).otherwise(3))
    hits = spark.createDataFrame([("m", 1, "a", 1)], "mode string, query_id int, id string, rank int")
    first = runs.advance_evaluation(spark, f"{out}/e0", queries, None, None, None, hits, None)
    assert first["facts"]["state"] == "AWAITING_LABELS"
    frozen = first["facts"]["queries_hash"]
    open_ = runs.advance_evaluation(spark, f"{out}/e1", queries, labels, other, None, hits, frozen)
    assert open_["facts"]["state"] == "AWAITING_ADJUDICATION" and "metrics" not in open_["tables"]
    ruled = spark.createDataFrame([(1, "b", 0)], labels.schema)
    done = runs.advance_evaluation(spark, f"{out}/e2", queries, labels, other, ruled, hits, frozen)
    assert done["facts"]["state"] == "COMPLETE" and spark.read.parquet(f"{out}/e2/metrics").first().recall_at_10 == 1.0
    with pytest.raises(EngineError):
        runs.advance_evaluation(spark, f"{out}/e3", queries.withColumn("text", F.lit("other")), labels, other, ruled, hits, frozen)


def test_snapshot_extraction_and_repair_runs(spark, tmp_path):
    files = spark.createDataFrame([("f1", "a.pdf", "application/pdf", 10), ("f2", "b.exe", "application/x", 10), ("f3", "c.pdf", "application/pdf", 99)], "file_id string, path string, mime string, length long")
    got = runs.run_snapshot(spark, files, f"file://{tmp_path}/s", ["application/pdf"], 50)
    assert got["facts"]["statuses"] == {"DOWNLOADED": 1, "SKIPPED:mime": 1, "SKIPPED:size": 1}
    with pytest.raises(EngineError):
        runs.run_snapshot(spark, files.unionByName(files), f"file://{tmp_path}/s2", ["application/pdf"], 50)
    long = "many words are on this page and it has enough of them to be used as it is, surely so"
    pages = spark.createDataFrame([("d", 1, long, False), ("d", 2, "", False), ("d", 3, None, True)], "document_id string, page int, digital_text string, blank boolean")
    words = spark.createDataFrame([("d", 2, 1, 1, 1, i, "word", 30.0) for i in range(30)], "document_id string, page int, block int, paragraph int, line int, word int, text string, confidence double")
    out = f"file://{tmp_path}/x"
    assert runs.run_extraction(spark, pages, words, out)["facts"]["qa"] == {"PASS": 1, "FAILED": 1, "BLANK": 1}
    tries = spark.createDataFrame([("d", 2, 1, long, 20, 90, 60.0), ("d", 2, 2, long + " again", 21, 96, 90.0), ("d", 1, 1, "not asked", 99, 999, 99.0)], "document_id string, page int, attempt int, text string, words int, chars int, confidence double")
    assert runs.run_repair(spark, out, tries, f"{out}r")["facts"] == {"repaired": 1, "left": 0}
    fixed = {r.page: (r.text, r.retrieval_eligible) for r in spark.read.parquet(f"{out}r/pages").collect()}
    assert fixed[2] == (long + " again", True) and fixed[1][0] == long and fixed[3][1] is False


def test_opportunity_to_dossier_runs(spark, corpus_run, tmp_path):
    base = f"file://{tmp_path}"
    t = runs.pinned(spark, corpus_run[0], "corpus")
    segments = spark.createDataFrame([("1", "- The bidder must show solar references in Tunisie since 2019 as a project\n- water works should be shown\n- no supporting document\n")], "locator string, text string")
    values = spark.createDataFrame([("country", "Tunisie"), ("client", "client solar"), ("sector", "NA")], "field string, value string")
    markers = {"MUST": ["must"], "SHOULD": ["should"]}
    facts = runs.run_analysis(spark, segments, values, markers, f"{base}/a")["facts"]
    assert (facts["must"], facts["should"], facts["requirements"], facts["language"]) == (1, 1, 3, "en")
    a = runs.pinned(spark, f"{base}/a", "analysis")
    reqs = [{"requirement_id": r.requirement_id, "classification": r.classification, "text": r.unit_text} for r in a["requirements"].orderBy("unit").collect()]
    proposals = [r.asDict() for r in a["proposals"].collect()]
    assert {(p["field"], p["value"], p["behavior"]) for p in proposals} == {("country", "Tunisie", "HARD_CANDIDATE"), ("year_after", "2019", "HARD_CANDIDATE")}
    vocabulary = filters.ContractVocabulary({"country_code": {"Tunisie": "TN"}})
    controls = filters.compile_controls(reqs, proposals, ["No supporting document"], vocabulary)
    assert controls["hard_filters"] == {"country_code": "TN", "year_from": 2019} and len(controls["policy_requirements"]) == 1
    assert controls["exclusions"] == [{"field": "evidence_available", "operator": "is_false", "value": False}]

    chunks = search.encoded(t["chunks"].select(F.col("chunk_id").alias("id"), "document_id", "text", "security_classification", "document_type", "data_quality_status", "page_id"), "text", search.HashEncoder())
    n = F.regexp_replace("document_id", "d", "").cast("int")
    contract = t["documents"].select(F.concat(F.lit("R"), n.cast("string")).alias("reference_id"), "document_id", "security_classification", F.lit(True).alias("base_shortlist_eligible"), F.when(n < 8, "TN").otherwise("FR").alias("country_code"), F.lit(2018).alias("year_start"), F.when(n == 1, 2018).otherwise(2022).alias("year_end"), F.lit(0.5).alias("evidence_strength"), (n != 2).alias("evidence_available"), F.lit("sector").alias("sector_code"), n.cast("string").alias("duplicate_group_id"))
    runs.run_matching(spark, chunks, contract, controls, f"{base}/m", ["INTERNAL"], search.HashEncoder(), vocabulary, mode="bm25")
    m = runs.pinned(spark, f"{base}/m", "matching")
    assert {r.reference_id for r in m["evidence"].select("reference_id").distinct().collect()} <= {"R0", "R3", "R4", "R5", "R6", "R7"}
    assert m["scores"].where("final_rank = 1").first().reference_id == "R0" and m["audit"].first().excluded_ids == ["R2"]

    asked = spark.createDataFrame([(r["requirement_id"], r["classification"], r["text"]) for r in controls["requirements"]], "requirement_id string, classification string, text string")
    refs = contract.select("reference_id", "document_id", F.lit("2018-2022").alias("project_year"), "evidence_available", F.col("country_code").alias("country"), F.lit(None).cast("string").alias("client"))
    shown = chunks.join(t["pages"].select("page_id", "page", "citation_label", "citation_uri", "source_sha256"), "page_id")
    soft = {"soft_preferences": [("country", "tn")]}
    runs.run_recommendations(spark, shown, asked, refs, soft, f"{base}/r", ["INTERNAL"], {"OTHER": 0.5}, {"OTHER": 0.5}, 2024)
    r = runs.pinned(spark, f"{base}/r", "recommendations")
    assert r["shortlist"].where("final_rank = 1").first().reference_id == "R0" and r["gaps"].count() == 2
    with pytest.raises(EngineError):
        runs.run_recommendations(spark, shown.withColumn("citation_uri", F.lit("")), asked, refs, soft, f"{base}/r2", ["INTERNAL"], {"OTHER": 0.5}, {"OTHER": 0.5})

    candidates = contract.withColumns({"final_score": F.lit(1.0) - n / 100, "offering_code": F.lit("CYBERSECURITY"), "subregion": F.lit(""), "evidence_type": F.lit("ATTESTATION_SCAN"), "capability_tags": F.array(F.lit("X")), "engagement_tags": F.array(F.lit("X"))})
    rules = [{"code": "SEC", "level": "PORTFOLIO_COUNT", "minimum_count": 2, "required_capability": "SECURITY_PSSI_ISO27001"}, {"code": "SIGNED", "level": "PER_REFERENCE", "required_capability": "SIGNED_CLIENT_ATTESTATION"}]
    runs.run_portfolio(spark, candidates, m["coverage"], rules, [{"code": "S", "points": 5, "evaluation_route": "E"}], {"S": ["SEC"]}, [], f"{base}/p", 3)
    p = runs.pinned(spark, f"{base}/p", "portfolio")
    assert p["portfolio"].count() == 3 and {x.rule: x.met for x in p["rules"].collect()}["SEC"] and p["criteria"].first().evidence_status == "READY_FOR_HUMAN_SCORING"

    titled = r["shortlist"].select("reference_id", F.lit("solar works").alias("title"))
    facts = runs.run_dossiers(spark, titled, r["evidence"].select("reference_id", "chunk_id", "evidence_excerpt"), "title", "evidence_excerpt", f"{base}/d")["facts"]
    assert facts["rendering"] == "none" and spark.read.parquet(f"{base}/d/records").count() >= titled.count()
    with pytest.raises(EngineError):
        runs.run_dossiers(spark, titled.unionByName(spark.createDataFrame([("R99", "x")], "reference_id string, title string")), r["evidence"].select("reference_id", "chunk_id", "evidence_excerpt"), "title", "evidence_excerpt", f"{base}/d2")


def test_command_line(spark, corpus_run, tmp_path, capsys):
    assert main(["list"]) == 0 and "bm25_topk" in capsys.readouterr().out
    assert main(["query", "corpus_statistics", "/root/testdata/sf0.001", f"{tmp_path}/q"], spark) == 0
    assert spark.read.parquet(f"{tmp_path}/q").first().documents == 200
    assert main(["verify", corpus_run[0], "--kind", "corpus"], spark) == 0 and '"chunks"' in capsys.readouterr().out
    assert main(["report", corpus_run[0], f"{tmp_path}/r.md"], spark) == 0 and "# Run of corpus" in (tmp_path / "r.md").read_text()
    assert main(["verify", f"{corpus_run[0]}-none"], spark) == main(["query", "nonsense", "x", "y"], spark) == 1
