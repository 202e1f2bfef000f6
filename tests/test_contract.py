"""Contract filters, controls, labels, sheets and writing places."""

import itertools
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.functions import text as T
from marlstone.functions import values as V
from marlstone.functions.chunking import BOUNDARIES, ChunkRules, chunk_spans
from marlstone.operators import contracts, evaluation, filters, recommend, requirements
from marlstone.operators.contracts import EngineError, NotAuthorized
from marlstone.sources import readers, sinks

VOCABULARY = filters.ContractVocabulary({"country_code": {"Côte d'Ivoire": "CI", "Tunisie": "TN"}, "sector_code": {"Énergie": "ENERGY"}})


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def contract(spark):
    rows = [
        ("r1", "PUBLIC", True, "CI", "Afrique de l’Ouest", "ENERGY", 2015, 2020, ["CLOUD"], True, 0.9),
        ("r2", "internal", True, "TN", "Afrique du Nord", "UNKNOWN", 2010, 2012, [], True, 0.4),
        ("r3", "CONFIDENTIAL", True, "CI", "x", "ENERGY", 2015, 2020, ["CLOUD"], True, 0.9),
        ("r4", "PUBLIC", False, "CI", None, "ENERGY", None, None, None, False, None),
    ]
    return spark.createDataFrame(rows, "reference_id string, security_classification string, base_shortlist_eligible boolean, country_code string, region string, sector_code string, year_start int, year_end int, capability_tags array<string>, evidence_available boolean, evidence_strength double")


@pytest.mark.parametrize("hard, want", [
    ({}, ["r1", "r2"]),
    ({"country_code": "cote d ivoire"}, ["r1"]),
    ({"country_code": ["Tunisie", "CI", ""]}, ["r1", "r2"]),
    ({"country_code": "Nowhere"}, []),
    ({"region": "AFRIQUE DE L'OUEST"}, ["r1"]),
    ({"sector_code": "energie", "capability_tags": ["cloud", "x"]}, ["r1"]),
    ({"year_from": 2012, "year_to": "2012"}, ["r2"]),
    ({"evidence_min_strength": 0.4, "evidence_available": 1}, ["r1", "r2"]),
    ({"capability_tags": [], "project_status": None}, ["r1", "r2"]),
])
def test_hard_filters(spark, hard, want):
    if "project_status" in hard:
        hard = hard | {"project_status": ""}
    got, audit = filters.filter_contract(contract(spark), ["public", "INTERNAL", " "], hard, [], VOCABULARY)
    assert sorted(r.reference_id for r in got.collect()) == want
    assert audit.first().unauthorized == 1 and audit.first().kept == len(want)


def test_exclusions_and_refusals(spark):
    rules = [{"field": "region", "operator": "contains", "value": "l'ouest"}, {"field": "evidence_strength", "operator": "lt", "value": "0.1"}]
    got, audit = filters.filter_contract(contract(spark), ["PUBLIC", "INTERNAL"], {}, rules, VOCABULARY)
    assert [r.reference_id for r in got.collect()] == ["r2"] and audit.first().excluded_ids == ["r1"]
    every, _ = filters.filter_contract(contract(spark), ["PUBLIC"], for_shortlist=False)
    assert sorted(r.reference_id for r in every.collect()) == ["r1", "r4"]
    with pytest.raises(NotAuthorized):
        filters.filter_contract(contract(spark), [" ", None])
    for bad in ({"hard": {"nonsense": 1}}, {"exclusions": [{"field": "region", "operator": "like", "value": 1}]}, {"exclusions": [{"field": "nonsense", "value": 1}]}):
        with pytest.raises(EngineError):
            filters.filter_contract(contract(spark), ["PUBLIC"], **bad)


def test_controls_fold_approved_proposals():
    rows = [("year_after", 2015, "HARD"), ("year_after", 2019, "HARD"), ("year_before", 2022, "HARD"), ("year_before", 2021, "HARD"), ("country", "Tunisie", "HARD"), ("country", "CI", "HARD"), ("country", "tunisie", "HARD"), ("client", "Société X", "EXCL"), ("sector", "Énergie", "SOFT"), ("offering", "z", "CTX")]
    kinds = {"HARD": "HARD_CANDIDATE", "EXCL": "EXCLUSION_CANDIDATE", "SOFT": "SOFT_PREFERENCE", "CTX": "CONTEXT_ONLY"}
    got = filters.compile_controls([{"text": "Un projet"}, {"text": "jamais sans  justificatif."}], [{"field": f, "value": v, "behavior": kinds[b]} for f, v, b in rows], ["sans justificatif"], VOCABULARY)
    assert got["hard_filters"] == {"year_from": 2019, "year_to": 2021, "country_code": ["TN", "CI"]}
    assert got["soft_preferences"] == [("sector_code", "ENERGY"), ("offering_code", "UNKNOWN")]
    assert got["exclusions"] == [{"field": "client_key", "operator": "eq", "value": "societe x"}, {"field": "evidence_available", "operator": "is_false", "value": False}]
    assert [r["kind"] for r in got["requirements"] + got["policy_requirements"]] == ["CONTENT", "ELIGIBILITY_POLICY"]


def test_years_are_proposed_as_the_text_words_them(spark):
    rows = [("q1", "MUST", "un projet réalisé depuis 2019"), ("q2", "SHOULD", "experience before 2015 or 2016"), ("q3", "CONTEXT", "project of 2011"), ("q4", "MUST", "delivered in 2018"), ("q5", "MUST", "référence après 2019")]
    reqs = spark.createDataFrame(rows, "requirement_id string, classification string, text string")
    got = {(r.field, r.value, r.behavior, r.requirement_id) for r in requirements.year_proposals(reqs).collect()}
    assert got == {("year_after", "2019", "HARD_CANDIDATE", "q1"), ("year_before", "2015", "SOFT_PREFERENCE", "q2"), ("year_before", "2016", "SOFT_PREFERENCE", "q2"), ("project_year", "2011", "CONTEXT_ONLY", "q3")}
    values = spark.createDataFrame([("project_year", "2019"), ("project_year", "2018"), ("client", "of"), ("nonsense", "project"), ("attestation_available", "Oui")], "field string, value string")
    both = requirements.all_proposals(reqs, values)
    assert {(r.field, r.value) for r in both.collect()} == {("year_after", "2019"), ("year_before", "2015"), ("year_before", "2016"), ("project_year", "2011"), ("project_year", "2018")}
    assert requirements.proposal_issues(both).isEmpty()
    bad = both.limit(1).withColumns({"confirmed": F.lit(True), "field": F.lit("Personal  Data"), "behavior": F.lit("X")})
    assert {r.issue for r in requirements.proposal_issues(bad).collect()} == {"UNSUPPORTED_FIELD", "FORBIDDEN_FIELD", "UNKNOWN_BEHAVIOR", "SILENTLY_CONFIRMED"}


def test_labels_are_paired_one_to_one(spark):
    a = spark.createDataFrame([(1, "x", 2), (1, "y", 0)], "query_id int, candidate_id string, relevance int")
    b = spark.createDataFrame([(1, "x", 2), (1, "y", 1)], a.schema)
    pairs = evaluation.labelled_pairs(a, b)
    ruled = spark.createDataFrame([(1, "y", 3)], a.schema)
    assert {(r.candidate_id, r.grade) for r in evaluation.final_grades(pairs, ruled).collect()} == {("x", 2), ("y", 3)}
    for one_, two in ((a, a.unionByName(a)), (a, b.limit(1))):
        with pytest.raises(EngineError):
            evaluation.labelled_pairs(one_, two)
    with pytest.raises(EngineError):
        evaluation.final_grades(pairs, ruled.limit(0))


def test_bootstrap_draws_do_not_depend_on_how_they_are_made(spark, monkeypatch):
    m = spark.createDataFrame([(x, q, float((q * (3 if x == "a" else 5)) % 7)) for q in range(9) for x in "ab"], "mode string, query_id int, v double")
    got = set()
    for tasks, together in ((1, 2000), (4, 2000), (3, 2)):
        monkeypatch.setattr(evaluation, "RESAMPLED_TOGETHER", together)
        r = evaluation.paired_bootstrap(m.repartition(tasks), ["v"], draws=250).first()
        got.add((r.queries, round(r.difference, 9), round(r.low, 9), round(r.high, 9)))
    assert len(got) == 1 and evaluation.paired_bootstrap(m, ["v"], draws=250, seed=1).first().low != pytest.approx(next(iter(got))[2], abs=1e-9)


def test_sheets_masters_and_configuration(spark, tmp_path, monkeypatch):
    cells = spark.createDataFrame([(2, ["a ", "1", "z"]), (3, [" ", "", None]), (4, ["b", None, ""])], "row_number int, cells array<string>")
    assert [tuple(r) for r in readers.sheet_rows(cells, ["Name", "", "Note"]).collect()] == [(2, "a", "z"), (4, "b", "")]
    with pytest.raises(EngineError):
        readers.sheet_rows(cells, ["Name", " ", "Note"], refuse_blank_headers=True)
    master = spark.createDataFrame([(1, "c", "x", "v")], "row_number int, `Nom du  Client` string, `Pays #1` string, `Project Value` string")
    assert readers.master_metadata(master, {"client": "nom du client", "country": "PAYS #1"}, ["project value"]).columns == ["row_number", "client", "country"]
    for fields in ({"x": "absent"}, {"v": "project value"}):
        with pytest.raises(EngineError):
            readers.master_metadata(master, fields, ["Project  value"])
    assert readers.matching_sheet(["A", "Réf "], "REF") == "Réf " and readers.matching_sheet(["only"], "x") == "only"
    with pytest.raises(EngineError):
        readers.matching_sheet(["a", "b"], "c")
    monkeypatch.setenv("MARL_X", "7")
    (tmp_path / "c.json").write_text('{"a": "${MARL_X}", "b": "${MARL_Y:-d}"}')
    assert readers.load_config(str(tmp_path / "c.json")) == {"a": "7", "b": "d"}
    (tmp_path / "big.txt").write_text("x" * 100)
    assert readers.read_segments(spark, str(tmp_path)).count() == 1
    with pytest.raises(EngineError):
        readers.read_segments(spark, str(tmp_path), most_bytes=10).count()


def test_vectors_resume_reports_and_places(spark, tmp_path):
    rows = spark.createDataFrame([(1, [0.6, 0.8]), (2, [1.0, 0.0])], "id long, embedding array<double>")
    path = str(tmp_path / "v")
    assert [sinks.write_vectors(rows, path, "m", 2), sinks.write_vectors(rows, path, "m", 2), sinks.write_vectors(rows, path, "other", 2)] == [2, 0, 2]
    for bad in (rows.withColumn("embedding", F.array(F.lit(2.0), F.lit(0.0))), rows.withColumn("embedding", F.array(F.lit(1.0)))):
        with pytest.raises(EngineError):
            sinks.write_vectors(bad, path, "m", 2)
    text = sinks.write_report(str(tmp_path / "r.md"), "Run", spark.createDataFrame([(1, "a")], "n int, s string"), {"T": spark.createDataFrame([("x|y", None)], "a string, b string")})
    long = sinks.write_report(str(tmp_path / "l.md"), "Run", spark.range(1), {"T": spark.range(7)}, most_rows=5)
    assert "2 more rows are not shown." in long and "not shown" not in text
    assert "- n: 1" in text and "| x\\|y |  |" in text
    shown = sinks.review_table(spark.createDataFrame([("=1+1", "keep")], "a string, hidden string"), ["a"]).first()
    assert shown.a == "'=1+1" and shown.reviewer_decision == "PENDING"
    assert contracts.safe_target(str(tmp_path / "x" / ".." / "y"), str(tmp_path)).endswith("/y")
    for bad, forbidden in ((str(tmp_path / ".." / "z"), []), (str(tmp_path / "raw" / "z"), [str(tmp_path / "raw")])):
        with pytest.raises(EngineError):
            contracts.safe_target(bad, str(tmp_path), forbidden)
    contracts.require_same_keys({"a": rows, "b": rows.select("id")}, "id")
    for other in (rows.where("id = 1"), rows.unionByName(rows)):
        with pytest.raises(EngineError):
            contracts.require_same_keys({"a": rows, "b": other}, "id")


def test_scalars(spark):
    assert one(spark, T.clean_scalar(F.lit(3.0), "double")) == "3" and one(spark, T.clean_scalar(F.lit(2.5), "double")) == "2.5"
    assert one(spark, T.clean_scalar(F.lit(True), "boolean")) == "true" and one(spark, T.clean_scalar(F.lit(None).cast("string"))) == ""
    assert one(spark, T.clean_scalar(F.lit(" a\r\n ﬁ  b "))) == "a fi b" and one(spark, T.clean_scalar(F.lit("2020-01-02").cast("date"), "date")) == "2020-01-02"
    assert one(spark, T.citation_uri(F.lit("d"), F.lit(2), "https://s/{id}/v")) == "https://s/d/v#page=2"
    assert tuple(one(spark, V.year_bounds(F.lit("de 2020 à 2018"), "?"))) == ("2020", "2018") and tuple(one(spark, V.year_bounds(F.lit(None).cast("string"), "?"))) == ("?", "?")
    assert one(spark, V.json_list(F.lit('["a", "", "a ", null]'))) == ["a", "a"] and one(spark, V.holds_all(F.array(F.lit("a"), F.lit("b")), ["b"])) is True and one(spark, V.holds_all(F.array(F.lit("a")), ["a", "b"])) is False
    masked = json.loads(one(spark, T.redact_json(F.lit('{"a": {"Token": 1, "x": [{"token": "s"}]}, "b": 2}'), ["TOKEN"])))
    assert masked == {"a": {"Token": "[REDACTED]", "x": [{"token": "[REDACTED]"}]}, "b": 2} and one(spark, T.redact_json(F.lit("no json"), ["a"])) is None
    assert one(spark, T.query_terms(F.lit("Les Études, de l'ÉNERGIE x_y a 日本 études"))) == ["etudes", "energie", "x y"]
    assert one(spark, T.grounding_score(F.lit("mission solaire avec audit"), F.lit("audit de mission"))) == 0.5
    assert one(spark, V.tags(F.lit("Étude d'ÉNERGIE"), {"E": ["energie"], "X": ["absent"]})) == ["E"]
    assert one(spark, V.latest_recency(F.lit("2004, 2014"), 2024)) == pytest.approx(0.5) and one(spark, V.latest_recency(F.lit("-"), 2024)) == 0.25


def test_first_recommendation_path(spark):
    chunks = spark.createDataFrame([(1, "d1", "solar solar plant", "PUBLIC"), (2, "d1", "solar plant", "PUBLIC"), (3, "d2", "water", "PUBLIC"), (4, "d3", "solar plant", "SECRET")], "id long, document_id string, text string, security_classification string")
    asked = spark.createDataFrame([("q1", "solar plant"), ("q2", "harbour")], "id string, text string")
    refs = spark.createDataFrame([("A", "d1"), ("B", "d1"), ("C", "d2"), ("D", "d3")], "reference_id string, document_id string")
    got = recommend.requirement_evidence(chunks, asked, refs, ["public"]).collect()
    assert {(r.reference_id, r.requirement_id, r.chunk_id, r.relevance) for r in got} == {("A", "q1", 1, 1.0), ("B", "q1", 1, 1.0)}
    rows = spark.createDataFrame([(f"R{i}", c, s) for i, (c, s) in enumerate([("X", 0.9), ("x", 0.8), ("X", 0.7), (None, 0.2), ("", 0.1)])], "reference_id string, client string, base_score double")
    order = [r.reference_id for r in recommend.diversified(rows, limit=4).orderBy("final_rank").collect()]
    assert order == ["R0", "R1", "R3", "R4"]
    assert recommend.incomplete_evidence(spark.createDataFrame([("a", ""), ("b", "u"), ("c", None)], "reference_id string, citation_uri string"), ("reference_id", "citation_uri")).count() == 2


def slow_chunks(text, rules):
    """The wording, letter by letter: the last boundary that starts in the window and ends by one past the reach."""
    spans, at = [], 0
    while at < len(text) and text.strip():
        reach = at + rules.most
        stop = len(text)
        if reach < len(text):
            low = max(at + rules.least, reach - rules.window)
            ends = [(s, -i, s + len(b)) for s in range(low, reach + 1) for i, b in enumerate(BOUNDARIES) if text.startswith(b, s) and s + len(b) <= reach + 1]
            stop = max(ends)[2] if ends else reach
        body = text[at:stop]
        if body.strip():
            lead = len(body) - len(body.lstrip())
            spans.append((at + lead, at + lead + len(body.strip())))
        if stop >= len(text):
            break
        low = max(stop - rules.overlap, at + 1)
        nexts = [[s + len(g) for s in range(low, stop + 1) if text.startswith(g, s) and s + len(g) <= min(stop + 1, len(text))] for g in ("\n\n", "\n", " ")]
        at = next((x[0] for x in nexts if x), low)
    if len(spans) > 1 and spans[-1][1] - spans[-1][0] < rules.least and spans[-1][1] - spans[-2][0] <= rules.most:
        spans[-2:] = [(spans[-2][0], spans[-1][1])]
    return spans


def test_chunks_match_the_wording_letter_by_letter():
    import random

    rng = random.Random(3)
    pieces = ["word", "x" * 40, " ", ". ", "! ", "? ", "؟ ", "; ", ": ", ", ", "\n", "\n\n", "\n\n\n", "é", "   "]
    for rules in (ChunkRules(most=60, overlap=15, least=20, window=25), ChunkRules(most=50, overlap=49, least=1, window=50), ChunkRules()):
        for _ in range(150):
            text = "".join(rng.choices(pieces, k=rng.randint(0, 150)))
            assert chunk_spans(text, rules) == slow_chunks(text, rules)


def test_kappa_and_metrics_by_plain_loops(spark):
    rows = [(a, b) for a, b in itertools.product(range(4), repeat=2) for _ in range((a * b + 1) % 3)]
    n, top = len(rows), 9.0
    o = sum((a - b) ** 2 / top for a, b in rows) / n
    e = sum((a - b) ** 2 / top for a, _ in rows for _, b in rows) / n / n
    got = evaluation.weighted_kappa(spark.createDataFrame(rows, "a int, b int"), "a", "b", 4).first()
    assert math.isclose(got.kappa, 1 - o / e)
