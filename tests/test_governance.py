import pytest
from pyspark.sql import functions as F

from marlstone.operators import governance as G
from marlstone.operators import reference_contract as R
from marlstone.operators.contracts import EngineError


def test_config_gates():
    assert G.EngineConfig().digest() == G.EngineConfig().digest()
    for bad in ({"external_models": True}, {"fusion_weights": (0.7, 0.7)}, {"authorization_before_scoring": False}, {"chunk_overlap": 900}):
        with pytest.raises(EngineError):
            G.EngineConfig(**bad)
    assert G.run_context(G.EngineConfig(), "r1")["run_id"] == "r1"


def test_queries_are_checked():
    assert G.checked_query(" a\x00b \n c ") == "a b c"
    for bad in ("", " \n", "x" * 4001, None):
        with pytest.raises(EngineError):
            G.checked_query(bad)


def test_policies(spark):
    df = spark.createDataFrame([("Projets/Archives confidentielles/x.pdf",), ("ok/archivesx.pdf",)], "p string")
    assert [r.x for r in df.select(G.excluded_path(F.col("p"), ["draft", "archives"]).alias("x")).collect()] == ["archives", None]
    items = spark.createDataFrame([("a", "b"), ("b", None), ("c", "zz")], "id string, target_id string")
    assert {r.id: r.resolved_id for r in G.dereferenced(items).collect()} == {"a": "b", "b": "b", "c": "c"}
    files = spark.createDataFrame([("Master Références.xlsx",), ("notes.txt",)], "name string")
    assert G.resolve_one(files, F.col("name"), "none", "references").first().name.startswith("Master")
    with pytest.raises(EngineError):
        G.resolve_one(files, F.col("name"), "none", "absent")


def test_packets_and_states(spark):
    p = spark.createDataFrame([("a", "2", ""), ("b", "x", ""), ("c", "7", ""), ("d", "0", " "), ("a", "1", "")], "id string, grade string, note string")
    assert sorted((r.id, r.issue) for r in G.packet_issues(p, "id", "grade", "note", 0, 2).collect()) == [("a", "REPEATED_KEY"), ("b", "MISSING_GRADE"), ("c", "GRADE_OUT_OF_RANGE"), ("d", "NOTE_REQUIRED")]
    assert [G.next_state(0, None, "h", 0, 3, 0), G.next_state(2, None, "h", 0, 3, 0), G.next_state(2, "h", "h", 6, 3, 0), G.next_state(2, "h", "h", 6, 3, 3)] == ["AWAITING_INTAKE", "AWAITING_LABELS", "AWAITING_ADJUDICATION", "COMPLETE"]
    with pytest.raises(EngineError):
        G.next_state(2, "h", "other", 0, 3, 0)


def test_retrieval_query_skips_what_does_not_fit(spark):
    df = spark.createDataFrame([("g", "CONTEXT", "1", "tail"), ("g", "MUST", "2", "b" * 30), ("g", "MUST", "1", "head")], "g string, classification string, locator string, text string")
    assert G.retrieval_query(df, "g", most=12).first().query_text == "head\ntail"


def test_reference_contract(spark):
    refs = spark.createDataFrame([("r1", "Société Générale", "Tunisie", "Énergie", "2019 - en cours", "d1", "Audit of grids"), ("r2", "société generale", "TUNISIE", "energie", "2015", "d1", "x"), ("r3", "#VALUE!", "Nowhere", "?", "", "d9", "")], "reference_id string, client string, country string, sector string, project_year string, document_id string, service string")
    docs = spark.createDataFrame([("d1", "CONTRACT", "a" * 64, True)], "document_id string, document_type string, source_sha256 string, retrieval_eligible boolean")
    countries = spark.createDataFrame([("tunisie", "TN")], "alias string, code string")
    sectors = spark.createDataFrame([("énergie", "ENERGY")], "alias string, code string")
    c = R.reference_contract(refs, docs, countries, sectors, {"AUDIT": ["audit"]}, {"CONTRACT": 0.8}, ["en cours"])
    got = {r.reference_id: r for r in c.collect()}
    assert (got["r1"].country_code, got["r1"].sector_code, got["r1"].year_start, got["r1"].year_end, got["r1"].capability_tags) == ("TN", "ENERGY", 2019, 2035, ["AUDIT"])
    assert got["r1"].duplicate_group_id == got["r2"].duplicate_group_id and got["r1"].duplicate_group_size == 2
    assert [got[k].base_shortlist_eligible for k in ("r1", "r2", "r3")] == [True, True, False]
    assert {r.issue for r in R.contract_issues(c).where("reference_id = 'r3'").collect()} == {"UNKNOWN_COUNTRY", "UNKNOWN_SECTOR", "UNKNOWN_YEARS", "SPREADSHEET_ERROR", "MISSING_EVIDENCE"}
    assert [r.reference_id for r in R.eligible_references(c, F.col("year_end") > 2020).collect()] == ["r1"]
    criteria = spark.createDataFrame([("A", "k1"), ("A", "k2"), ("B", "zz")], "criterion string, code string")
    rules = spark.createDataFrame([("k1", True), ("k2", False)], "code string, met boolean")
    assert {r.criterion: r.status for r in R.scoring_status(criteria, rules).collect()} == {"A": "EVIDENCE_PARTIAL", "B": "NO_RULE"}


def test_audited_cases(spark):
    shortlist = spark.createDataFrame([("r1", "Bank A", "DATA"), ("r2", "Bank A", "API"), ("r3", "B", "X")], "reference_id string, client string, role string")
    rows = [("C1", "MUST", "t1", "COVERED", "Bank A | B"), ("C2", "MUST", "t2", "GAP", "B"), ("C3", "SHOULD", "t3", " COVERED", "Bank A"), ("C4", "SHOULD", "t4", "COVERED", "B||")]
    coverage = spark.createDataFrame(rows, "code string, classification string, requirement_text string, audit_status string, supporting_clients string")
    got = {(r.reference_id, r.code) for r in R.audited_requirements(shortlist, coverage, {"C3": "API", "C4": "DATA"}).collect()}
    assert got == {("r1", "C1"), ("r2", "C1"), ("r2", "C3"), ("r3", "C1"), ("r3", "C4")}
    ruled = spark.createDataFrame([("SUPPORTED",), ("PARTIAL",), (" SUPPORTED",), ("UNSUPPORTED",)], "audit_status string")
    expected = {"must_total": 2, "must_covered": 1, "should_total": 2, "should_covered": 2, "total": 4, "SUPPORTED": 2, "PARTIAL": 1, "UNSUPPORTED": 1}
    assert R.audited_case(coverage, ruled, expected, ["C2"])["gaps"] == ["C2"]
    for bad, gaps in ((expected | {"total": 5}, ["C2"]), (expected, [])):
        with pytest.raises(EngineError):
            R.audited_case(coverage, ruled, bad, gaps)


def test_folders_packets_and_roots(spark):
    listing = spark.createDataFrame([(None, "root", "r", True), ("root", "f", "folder", True), ("f", "x", "a/b:c.pdf", False), ("f", "g", "deep", True), ("root", "y", "y.pdf", False)], "parent string, id string, name string, is_folder boolean")
    links = spark.createDataFrame([("f",), ("y",), ("x",), ("gone",)], "target_id string")
    got = {(r.file_id, r.name, r.via) for r in G.expanded_links(links, listing).collect()}
    assert got == {("x", "a/b:c.pdf", ""), ("y", "y.pdf", "")}
    assert listing.where("id = 'x'").select(G.downloadable_name(F.col("id"), F.col("name")).alias("n")).first().n == "x__b_c.pdf"
    items = listing.select("id", F.lit(None).cast("string").alias("target_id"), "is_folder")
    assert G.dereferenced(items, "root").count() == 5
    for bad in ("absent", "y"):
        with pytest.raises(EngineError):
            G.dereferenced(items, bad)
    sent = spark.createDataFrame([("a", "1", "n"), ("b", "2", "n")], "id string, grade string, note string")
    back = spark.createDataFrame([("a", "1", "n"), ("c", "2", "n"), ("", "1", "n")], sent.schema)
    assert {(r.id, r.issue) for r in G.packet_issues(back, "id", "grade", "note", 0, 3, sent).collect()} == {("", "MISSING_KEY"), ("b", "ROW_REMOVED"), ("c", "ROW_ADDED"), ("", "ROW_ADDED")}
    assert G.ProjectPaths("s3a://b/p/").indexes == "s3a://b/p/data/indexes"
