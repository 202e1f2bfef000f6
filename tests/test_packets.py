import pytest
from pyspark.sql import functions as F

from marlstone.operators import packets
from marlstone.operators.contracts import EngineError
from marlstone.operators.packets import IntakeBounds, Rule

B = IntakeBounds(count=4, least_characters=12, most_characters=40, languages=(("fr", 2), ("en", 1), ("ar", 0)), types=(("NEGATIVE", 1),))


def good(spark):
    rows = [(f"Une question numéro {i} bien posée", "fr" if i < 3 else "en", "NEGATIVE" if i == 1 else "standard") for i in range(1, 5)]
    filled = spark.createDataFrame([(i, *r) for i, r in enumerate(rows, 1)], "position int, query_text string, language string, query_type string")
    blank = packets.intake_packet(spark, B).drop("query_text", "language", "query_type")
    return blank.join(filled, "position").withColumns({"business_context": F.lit("a context long enough"), "origin": F.lit(" real_opportunity"), "not_derived_from_reference_corpus": F.lit("yes"), "approved_for_evaluation": F.lit("YES")})


def found(packet, rules=None, key="query_id"):
    return sorted((r.code, r.key, r.detail) for r in packets.issues(packet, key, rules or packets.intake_rules(B)).collect())


def codes(*args, **kw):
    return {(c, k) for c, k, _ in found(*args, **kw)}


def test_a_good_intake_has_no_issue_and_each_fault_its_own(spark):
    packet = good(spark).cache()
    assert found(packet) == []
    first = F.col("position") == 1

    def broken(**columns):
        return codes(packet.withColumns({c: F.when(first, v).otherwise(F.col(c)) for c, v in columns.items()}))

    me = "EXP-001"
    assert broken(query_text=F.lit(" court ")) == {("QUERY_SHORT", me)}
    assert broken(query_text=F.lit("x" * 41)) == {("QUERY_LONG", me)}
    assert broken(query_text=F.lit("UNE  question NUMERO 2 bien posee")) == {("QUERY_REPEATED", me), ("QUERY_REPEATED", "EXP-002")}
    assert broken(query_text=F.lit(None)) == {("QUERY_SHORT", me)}
    assert broken(business_context=F.lit("   short ")) == {("CONTEXT_SHORT", me)}
    assert broken(language=F.lit("de")) == {("LANGUAGE", me), ("LANGUAGE_MINIMUM", None)}
    assert broken(query_type=F.lit("ODD")) == {("QUERY_TYPE", me), ("QUERY_TYPE_MINIMUM", None)}
    assert broken(origin=F.lit("INVENTED")) == {("ORIGIN", me)}
    assert broken(not_derived_from_reference_corpus=F.lit("no")) == {("DERIVED", me)}
    assert broken(approved_for_evaluation=F.lit(None)) == {("NOT_APPROVED", me)}
    assert broken(mandatory_filters_json=F.lit("[1]")) == broken(mandatory_filters_json=F.lit("{broken")) == {("FILTERS_INVALID", me)}
    assert broken(mandatory_filters_json=F.lit('{"country": "x", "colour": "red"}')) == {("FILTER_UNKNOWN", me)}
    assert broken(mandatory_filters_json=F.lit("")) == broken(mandatory_filters_json=F.lit('{"year_before": 2001, "client": ["a"]}')) == set()
    assert broken(query_id=F.lit("EXP-009")) == {("QUERY_IDS", "EXP-009")}
    fewer = found(packet.where("position <> 4"))
    assert fewer == [("LANGUAGE_MINIMUM", None, "en: 1"), ("QUERY_COUNT", None, "exactly 4 queries")] or fewer == [("QUERY_COUNT", None, "exactly 4 queries")]
    assert ("QUERY_COUNT", None) in codes(packet.limit(0))


def test_governance_names_independent_people(spark):
    def sheet(names, confirmed="YES"):
        return spark.createDataFrame([(r, n, confirmed) for r, n in zip(packets.ROLES, names)], "role string, name string, confirmed string")

    rules = packets.governance_rules()
    assert found(sheet("abcde"), rules, "role") == []
    assert codes(sheet("abbde"), rules, "role") == {("LABELERS_SAME", None)}
    assert codes(sheet("abcbe"), rules, "role") == {("ADJUDICATOR_NOT_INDEPENDENT", None)}
    assert found(sheet(["a", " ", "c", "d", None]), rules, "role") == [("ROLE_UNNAMED", None, "labeler_1_name"), ("ROLE_UNNAMED", None, "supervisor_name")]
    assert len(found(sheet("abcde", "no"), rules, "role")) == 5
    assert len(found(sheet("abcde").limit(0), rules, "role")) == 10


def test_labels_and_adjudications(spark):
    rows = [("c1", "2", ""), ("c2", "0", ""), ("c3", "0", "TOPIC"), ("c4", "3", ""), ("c5", None, ""), ("c6", "0", "odd"), ("c7", "1.5", "")]
    labels = spark.createDataFrame(rows, "candidate_id string, relevance_0_1_2 string, failure_category string")
    rules = packets.grade_rules("relevance_0_1_2", "failure_category", categories=("TOPIC",))
    assert codes(labels, rules, "candidate_id") == {("NOTE_MISSING", "c2"), ("GRADE", "c4"), ("GRADE", "c5"), ("CATEGORY", "c6"), ("GRADE", "c7")}
    sent = spark.createDataFrame([(c, "q") for c in ("c1", "c2", "c3", "c9")], "candidate_id string, query_text string")
    back = spark.createDataFrame([("c1", "q"), ("c2", "other"), ("c3", "q"), ("c3", "q"), ("c8", "q")], "candidate_id string, query_text string")
    assert sorted((r.code, r.key) for r in packets.same_rows(back, sent, "candidate_id", ["query_text"]).collect()) == [("ROW_ADDED", "c8"), ("ROW_CHANGED", "c2"), ("ROW_REMOVED", "c9"), ("ROW_REPEATED", "c3")]
    pairs = spark.createDataFrame([(1, "c1", 2, 2, True), (1, "c2", 0, 1, False)], "query_id int, candidate_id string, relevance_1 int, relevance_2 int, agreement boolean")
    pool = spark.createDataFrame([(1, "c1", "text", "bm25", 1), (1, "c2", "more", "dense", 1)], "query_id int, candidate_id string, excerpt string, mode string, rank int")
    packet = packets.adjudication_packet(pairs, pool)
    assert not {"mode", "rank"} & set(packet.columns)
    assert codes(packet, packets.adjudication_rules(), "candidate_id") == {("GRADE", "c2"), ("RATIONALE_MISSING", "c2")}
    done = packet.withColumns({"adjudicated_relevance": F.lit("1"), "adjudication_notes": F.lit("because")})
    assert codes(done, packets.adjudication_rules(), "candidate_id") == set()
    audit = spark.createDataFrame([("u1", "1", ""), ("u2", "0", ""), ("u3", "2", "x")], "citation string, citation_correct_0_1 string, citation_issue_notes string")
    assert codes(audit, packets.citation_rules(), "citation") == {("NOTE_MISSING", "u2"), ("GRADE", "u3")}
    one, two = ([r.candidate_id for r in packets.label_packet(pool, n).collect()] for n in (1, 2))
    assert sorted(one) == sorted(two) == ["c1", "c2"] and "mode" not in packets.label_packet(pool, 1).columns
    assert "GRADE: 2, first c2" not in packets.validation_report("Labels", packets.issues(labels, "candidate_id", rules)) and "- GRADE: 3, first c4" in packets.validation_report("Labels", packets.issues(labels, "candidate_id", rules))
    assert packets.validation_report("Labels", packets.issues(done, "candidate_id", packets.adjudication_rules())) == "# Labels\n\n- No issues.\n"


def test_rules_are_checked(spark):
    with pytest.raises(EngineError):
        Rule("X", "column", "true")
    assert packets.issues(good(spark), "query_id", []).count() == 0
