import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marlstone.operators import evaluation, filters, matching, relational, requirements, retrieval
from marlstone.operators.contracts import EngineError, NotAuthorized, forbid_columns, issue_rows, require_columns, require_unique, same_rows
from marlstone.operators.lexical_index import Bm25Index, Scope
from marlstone.plans import catalog
from marlstone.sources import readers, sinks
from marlstone.streaming.incremental import ingest


def docs(spark):
    return spark.createDataFrame([(1, "solar power plant power", "PUBLIC"), (2, "water plant", "INTERNAL"), (3, "solar solar solar", "RESTRICTED"), (4, "roads", "PUBLIC")], "id long, text string, cls string")


def test_bm25_equals_the_formula_and_never_ranks_the_unauthorized(spark, tmp_path):
    index = Bm25Index.build(docs(spark), str(tmp_path / "i"), ["cls"])
    asked = spark.createDataFrame([(7, "solar plant solar")], "id long, text string")
    allowed = Scope.security(spark, "cls", ["public", " Internal "], "long")
    got = {r.id: (r.score, r["rank"]) for r in index.top(asked, 3, allowed).collect()}
    mean = (4 + 2 + 3 + 1) / 4

    def part(qtf, tf, df, length):
        return qtf * math.log(1 + (4 - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))

    assert got[1] == (pytest.approx(part(2, 1, 2, 4) + part(1, 1, 2, 4), abs=1e-6), 1)
    assert got[2] == (pytest.approx(part(1, 1, 2, 2), abs=1e-6), 2)
    assert got[4] == (0.0, 3) and 3 not in got  # a document without a term fills up; a restricted one never shows
    assert {r.id for r in index.top(asked, 3, allowed, positive_only=True).collect()} == {1, 2}
    for none in ([], [" ", None]):
        with pytest.raises(NotAuthorized):
            retrieval.authorized(docs(spark), "cls", none)


def test_filter_reaches_the_scan(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = retrieval.authorized(d.select("doc_id", "source"), "source", ["src1"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan


def test_dense_top_is_exact_in_passes_blocks_groups_and_scopes(spark, monkeypatch):
    rng = random.Random(8)
    data = [(f"v{i:02}", [float(rng.randint(-2, 2)) for _ in range(3)], rng.choice("ab"), rng.sample(["X", "y", "2001"], 2)) for i in range(60)]
    v = spark.createDataFrame(data + [("none", None, "a", [])], "id string, embedding array<float>, kind string, tags array<string>").repartition(3)
    q = v.where("embedding IS NOT NULL").limit(20).select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vector")).cache()
    asked = {r.query_id: r.query_vector for r in q.collect()}

    def want(limit, may=lambda q, d: True, group=False):
        out = set()
        for name, x in asked.items():
            for g in "ab" if group else "*":
                rows = sorted((-sum(a * b for a, b in zip(x, d[1])), d[0]) for d in data if may(name, d) and g in (d[2], "*"))[:limit]
                out |= {(name, i, -s) for s, i in rows}
        return out

    def got(limit, **options):
        n = 2 * limit if "group" in options else limit
        rows = retrieval.dense_top(v, q, limit, **options)
        best = rows.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", *([options["group"]] if "group" in options else [])).orderBy(F.desc("score"), "id"))).where(F.col("rank") <= limit)
        assert rows.count() <= 3 * n * len(asked)
        return {(r.query_id, r.id, r.score) for r in best.collect()}

    first = sorted(asked)[0]
    scope = Scope.of(spark, {"kind": "A"}, {first: {"tags": ["Y"], ("tags", "at_least"): 2000}})
    monkeypatch.setattr(retrieval, "BLOCK_ROWS", 7)
    for most in (4096, 3):
        monkeypatch.setattr(retrieval, "MOST_QUERIES", most)
        assert got(4) == want(4) and got(100) == want(100)
        assert got(3, apart=True) == want(3, lambda q, d: q != d[0])
        assert got(2, group="kind") == want(2, group=True)
        assert got(3, scope=scope) == want(3, lambda q, d: d[2] == "a" and (q != first or "y" in d[3] or "2001" in d[3]))
    with pytest.raises(EngineError):
        retrieval.dense_top(v, q, 3, Scope.of(spark, {"other": "x"}))
    assert retrieval.dense_top(v, q.limit(0), 3).count() == 0


def test_fusion_and_roll_up(spark):
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "query_id long, id long, rank int")
    b = spark.createDataFrame([(1, 11, 1)], "query_id long, id long, rank int")
    got = {r.id: r.score for r in retrieval.reciprocal_rank_fusion([(a, 0.5), (b, 0.5)]).collect()}
    assert got == {10: pytest.approx(0.5 / 61), 11: pytest.approx(0.5 / 62 + 0.5 / 61)}
    c = spark.createDataFrame([(1, "d", i, s) for i, s in enumerate([0.1, 0.9, 0.9, 0.5])], "query_id long, document_id string, id long, score double")
    r = retrieval.roll_up(c, 5).first()
    assert (r.best_id, r.evidence, r.score) == (1, [1, 2, 3], 0.9)


def test_filters(spark):
    df = spark.createDataFrame([(1, "FR", ["a"], 2000), (2, "TN", ["b", "A"], None)], "id long, country string, tags array<string>, year int")
    kinds = {"country": "one", "tags": "many"}
    assert [r.id for r in df.where(filters.compile_filters(kinds, {"country": ["tn", ""], "tags": ["a"]})).collect()] == [2]
    assert df.where(filters.compile_filters(kinds, {"country": [" "]})).count() == 2
    with pytest.raises(EngineError):
        filters.compile_filters(kinds, {"other": ["x"]})
    with pytest.raises(EngineError):
        filters.exclusion("id", "like", 1)
    assert [r.id for r in df.where(filters.exclusion("year", "lt", 2010)).collect()] == [1]
    assert [r.id for r in df.where(filters.exclusion("country", "contains", "n")).collect()] == [2]
    kept, audit = filters.filter_with_audit(df, F.col("country") == "TN", F.lit(True), F.col("year") > 0, F.lit(False))
    assert kept.count() == 0 and audit.first().asDict() == {"rows": 2, "unauthorized": 1, "ineligible": 0, "filtered": 1, "excluded": 0, "kept": 0}
    assert {(r.facet, r.value): r.n for r in filters.facet_counts(df, ["country"], ["tags"]).collect()} == {("country", "FR"): 1, ("country", "TN"): 1, ("tags", "a"): 1, ("tags", "b"): 1, ("tags", "A"): 1}


def test_must_gate_duplicates_and_dense_coverage(spark):
    ev = spark.createDataFrame([("A", "R1", "c1", 1.0, 1.0), ("A", "R2", "c2", 1.0, 1.0), ("B", "R1", "c3", 1.0, 0.0), ("C", "R1", "c4", 0.9, 1.0), ("C", "R2", "c5", 0.9, 1.0)], "reference_id string, requirement_id string, chunk_id string, score double, term_coverage double")
    reqs = spark.createDataFrame([("R1", "MUST"), ("R2", "MUST"), ("R3", "CONTEXT")], "requirement_id string, classification string")
    grid = matching.coverage_grid(matching.rerank(ev), reqs)
    assert grid.count() == 9
    contract = spark.createDataFrame([(r, 1.0, None, 1.0, True, "dup" if r in "AC" else r) for r in "ABC"], "reference_id string, evidence_strength double, year_end int, soft_fit double, base_eligible boolean, duplicate_group_id string")
    got = {r.reference_id: (r.reasons, r.final_rank) for r in matching.score_matches(grid, contract).collect()}
    assert got == {"A": ("", 1), "B": ("MISSING_MUST:1/2", None), "C": ("DUPLICATE_GROUP_SUPPRESSED", None)}
    open_gate = {r.reference_id: r.reasons for r in matching.score_matches(grid, contract, must_gate=False).collect()}
    assert open_gate["B"] == ""


def portfolio_rows(spark):
    """reference_id, score, offering, sector, evidence type, years, capabilities."""
    rows = [
        ("a", 0.9, "OTHER", "BANKING", "CONTRACT", 2018, 2020, []),
        ("b", 0.5, "IT_STRATEGY_AMOA", "BANKING", "ATTESTATION_SCAN", 2015, 2022, ["CYBERSECURITY"]),
        ("c", 0.7, "CYBERSECURITY", "ENERGY", "ATTESTATION_ORIGINAL", None, 2022, []),
        ("d", 0.6, "OTHER", "ENERGY", "CONTRACT", 2010, 2011, ["IT_GOVERNANCE", "roadmap"]),
        ("e", 0.65, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "reference_id string, final_score double, offering_code string, sector_code string, evidence_type string, year_start int, year_end int, capability_tags array<string>")
    return df.withColumns({"engagement_tags": F.array().cast("array<string>"), "subregion": F.lit("Afrique de l’Ouest"), "evidence_available": F.lit(True)})


RULES = [
    {"code": "R-SEC", "level": "PORTFOLIO_COUNT", "minimum_count": 2, "required_capability": "SECURITY_PSSI_ISO27001"},
    {"code": "R-SDSI", "level": "PORTFOLIO_COUNT", "minimum_count": 1, "required_capability": "SDSI", "required_sector_or_region": "BANKING_FINANCE_INSURANCE", "signed_attestation_required": True},
    {"code": "R-ALL", "level": "PER_REFERENCE", "required_capability": "ANY"},
]


def plain_portfolio(rows, coverage, most, least):
    """The three phases with lists: rule deficits by 1 / number asked for, then requirements (MUST 2), then scores."""
    flags = {"b": {"R-SEC", "R-SDSI"}, "c": {"R-SEC"}}
    need, chosen = {"R-SEC": 2, "R-SDSI": 1}, []
    while len(chosen) < most:
        lacking = [r for r, n in need.items() if sum(r in flags.get(x, ()) for x in chosen) < n]
        options = [(-sum(1 / need[r] for r in lacking if r in flags.get(x, ())), -s, x) for x, s in rows.items() if x not in chosen]
        options = [o for o in options if o[0] < 0]
        if not options:
            break
        chosen.append(min(options)[2])
    got = {r for x in chosen for r in coverage.get(x, {})}
    while len(chosen) < most:
        options = [(-sum(w for r, w in coverage.get(x, {}).items() if r not in got), -s, x) for x, s in rows.items() if x not in chosen]
        options = [o for o in options if o[0] < 0]
        if not options:
            break
        chosen.append(min(options)[2])
        got |= set(coverage.get(chosen[-1], {}))
    rest = sorted((-s, x) for x, s in rows.items() if x not in chosen)
    return chosen + [x for _, x in rest[: max(0, max(least, most) - len(chosen))]]


def test_portfolio_in_three_phases(spark):
    annotated = matching.annotate_capabilities(portfolio_rows(spark))
    flags = {r.reference_id: r for r in annotated.collect()}
    assert flags["b"].is_sdsi and flags["b"].is_security and flags["c"].is_security and flags["d"].is_sdsi and not flags["e"].is_sdsi and flags["e"].is_west_or_north_africa
    covered = {"a": {"q1": 1.0, "q2": 2.0}, "d": {"q3": 1.0}, "b": {"q1": 1.0}}
    rows = [(x, r, "MUST" if w == 2 else "SHOULD", True) for x, held in covered.items() for r, w in held.items()] + [("e", "q4", "MUST", False)]
    coverage = spark.createDataFrame(rows, "reference_id string, requirement_id string, classification string, covered boolean")
    scores = {r.reference_id: r.final_score for r in annotated.collect()}
    for most, least in ((5, 0), (4, 0), (3, 0), (1, 0), (2, 4)):
        got = matching.select_portfolio(annotated, coverage, RULES, most, least).orderBy("portfolio_rank").collect()
        assert [r.reference_id for r in got] == plain_portfolio(scores, covered, most, least)
    reasons = {r.reference_id: r.selection_reason for r in matching.select_portfolio(annotated, coverage, RULES, 5).collect()}
    assert reasons == {"b": "PORTFOLIO_RULE:R-SDSI,R-SEC", "c": "PORTFOLIO_RULE:R-SEC", "a": "REQUIREMENT_COVERAGE:q2", "d": "REQUIREMENT_COVERAGE:q3", "e": "RANKED_PORTFOLIO_COMPLETION"}
    with pytest.raises(EngineError):
        matching.rule_condition({"required_capability": "NONE"})
    dated = annotated.where(matching.rule_condition({"required_capability": "ANY", "year_start_inclusive": 2020, "year_end_inclusive": 2016}))
    assert {r.reference_id for r in dated.collect()} == {"b"}


def test_criteria_show_evidence_and_never_award_points(spark):
    annotated = matching.annotate_capabilities(portfolio_rows(spark))
    named = {r["code"]: (matching.rule_condition(r), r.get("minimum_count")) for r in RULES}
    results = matching.evaluate_rules(annotated, named)
    assert {r.rule: (r.matching, r.met, r.ids) for r in results.collect()} == {"R-SEC": (2, True, ["b", "c"]), "R-SDSI": (1, True, ["b"]), "R-ALL": (5, True, list("abcde"))}
    coverage = spark.createDataFrame([("q1", 1, ["a"]), ("q2", 0, [])], "requirement_id string, supporting long, reference_ids array<string>")
    criteria = [{"code": "SCORE-GENERAL", "points": 10, "evaluation_route": "EVIDENCE"}, {"code": "S2", "points": 5, "evaluation_route": "EVIDENCE"}, {"code": "S3", "points": 5, "evaluation_route": "EVIDENCE"}, {"code": "S4", "points": 5, "evaluation_route": "INTERVIEW"}]
    got = {r.code: r for r in matching.scoring_criteria(criteria, results, coverage, {"S2": ["R-SEC", "R-SDSI"], "S3": ["R-NONE"]}, ["INTERVIEW"]).collect()}
    assert {c: (r.evidence_status, r.reference_ids) for c, r in got.items()} == {"SCORE-GENERAL": ("EVIDENCE_GAP", ["a"]), "S2": ("READY_FOR_HUMAN_SCORING", ["b", "c"]), "S3": ("EVIDENCE_GAP", []), "S4": ("OUTSIDE_REFERENCE_MATCHING_SCOPE", [])}
    assert all(r.points_awarded is None and r.human_scoring_required for r in got.values())


def test_metrics_by_hand(spark):
    ranks = spark.createDataFrame([("m", 1, x, i) for i, x in enumerate("xayb", 1)] + [("m", 2, "x", 1)], "mode string, query_id long, id string, rank int")
    grades = spark.createDataFrame([(1, "a", 1), (1, "b", 1), (2, "x", 0)], "query_id long, id string, grade int")
    got = {r.query_id: r for r in evaluation.ranking_metrics(ranks, grades).collect()}
    assert (got[1].recall_at_10, got[1].precision_at_5, got[1].mrr) == (1.0, 0.4, 0.5)
    assert got[1].ndcg_at_10 == pytest.approx((1 / math.log2(3) + 1 / math.log2(5)) / (1 + 1 / math.log2(3)))
    assert got[2].recall_at_10 is None and got[2].mrr is None and got[2].precision_at_5 == 0.0
    both = evaluation.ranking_metrics(ranks.where("query_id = 2"), grades)
    assert {r.query_id: (r.answerable, r.recall_at_10, r.mrr) for r in both.collect()} == {1: (True, 0.0, 0.0), 2: (False, None, None)}  # a query without a hit counts
    means = evaluation.system_means(evaluation.ranking_metrics(ranks, grades.unionByName(spark.createDataFrame([(3, "q", 2)], grades.schema)))).first()
    assert (means.queries, means.answerable, means.no_relevant, means.recall_at_10) == (3, 2, 1, 0.5)
    assert (means.precision_at_5, means.precision_at_5_all_queries) == (pytest.approx(0.2), pytest.approx(0.4 / 3))
    about = spark.createDataFrame([(1, "fr"), (2, "en")], "query_id long, language string")
    by = {r.language: r.recall_at_10 for r in evaluation.system_means(evaluation.with_attributes(evaluation.ranking_metrics(ranks, grades), about), ["mode", "language"]).collect()}
    assert by == {"fr": 1.0, "en": None}
    same = spark.createDataFrame([(0, 0), (1, 1), (2, 2)], "a int, b int")
    assert evaluation.weighted_kappa(same, "a", "b", 3).first().kappa == 1.0


def test_relational_blocks(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    new = spark.createDataFrame([(2, None)], "id long, v string")
    assert {r.id: (r.v, r.repaired) for r in relational.upsert(base, new, ["id"], ["v"]).collect()} == {1: ("a", False), 2: (None, True)}
    ranked = spark.createDataFrame([(i, "x" if i < 5 else "y", i) for i in range(1, 7)], "id long, client string, r int")
    assert [r.id for r in relational.diversify(ranked, "client", "r", 2, 5).orderBy("final_rank").collect()] == [1, 2, 5, 6, 3]
    h = [relational.logical_hash(df, ["id", "v"]).first() for df in (base, base.repartition(3).orderBy(F.desc("id")), base.union(base))]
    assert h[0] == h[1] != h[2]
    with pytest.raises(ValueError):
        relational.tree_paths(spark.createDataFrame([("r", "r", "loop")], "parent string, id string, name string"), "r", 3)


def test_contracts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "id long, v string")
    require_columns(df, ["id"])
    for broken in (lambda: require_columns(df, ["zz"]), lambda: forbid_columns(df, ["v"]), lambda: require_unique(df, ["id"])):
        with pytest.raises(EngineError):
            broken()
    assert same_rows(df, df.orderBy(F.desc("v"))) and not same_rows(df, df.limit(1))
    assert [(r.issue, r.severity) for r in issue_rows(df, "id", {"X": ("ERROR", F.col("v") == "b")}).collect()] == [("X", "ERROR")]


def test_requirements_are_masked_classified_and_first_seen(spark):
    s = spark.createDataFrame([("p1", "- The bidder must deliver a plant.\n* The bidder MUST deliver a plant\n2) Mail x.y@z.org should work well\nshort"), ("p2", "Some context for the works here")], "loc string, t string")
    got = requirements.requirements(s, "loc", "t", {"MUST": ["must"], "SHOULD": ["should"]}).orderBy("locator", "unit").collect()
    assert [(r.locator, r.classification, r.unit_text) for r in got] == [("p1", "MUST", "The bidder must deliver a plant."), ("p1", "SHOULD", "Mail [EMAIL] should work well"), ("p2", "CONTEXT", "Some context for the works here")]
    assert all(r.requirement_id.startswith("REQ-") and len(r.requirement_id) == 16 for r in got)


def test_every_document_gives_filter_values_and_every_term_statistics(spark, tmp_path):
    texts = [(0, "solar plant"), (1, "Water"), (2, "roads"), (3, "bridges water"), (9, "harbour")]
    spark.createDataFrame([(*t, "s", "en") for t in texts], "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, "Bridges, a harbour and water"), (8, "harbour without cranes or bridges")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(map(tuple, catalog.filter_proposals(spark, str(tmp_path)).collect()))
    assert got == [("word", w, b, i) for w in ("bridges", "harbour") for b, i in (("EXCLUSION_CANDIDATE", "8"), ("HARD_CANDIDATE", "7"))] + [("word", "water", "HARD_CANDIDATE", "7")]
    assert {r.term: (r.df, r.cf) for r in catalog.bm25_terms(spark, str(tmp_path)).collect()} == {"solar": (1, 1), "plant": (1, 1), "water": (2, 2), "roads": (1, 1), "bridges": (1, 1), "harbour": (1, 1)}


def test_filter_values_of_any_length_aliases_and_exclusions(spark):
    long = "Ministère de l'Économie, des Finances et de la Planification du Développement"
    said = [("q1", "MUST", f"(reference for {long}) or !!!"), ("q2", "MUST", "works in tunisia only"), ("q3", "SHOULD", "anywhere but without Libya"), ("q4", "CONTEXT", "in Côte d'Ivoire"), ("q5", "SHOULD", "tunisian financesx de la"), ("q6", "CONTEXT", "")]
    values = [("client", long), ("client", "Économie"), ("client", "nances"), ("client", "!!!"), ("country", "Tunisie"), ("country", "Libye"), ("country", "Côte d'Ivoire"), ("sector", "Tunisie")]
    reqs = spark.createDataFrame(said, "requirement_id string, classification string, folded string")
    got = requirements.filter_proposals(reqs, spark.createDataFrame(values, "field string, value string"))
    assert sorted(map(tuple, got.collect())) == sorted([("client", long, "HARD_CANDIDATE", "q1"), ("client", "Économie", "HARD_CANDIDATE", "q1"), ("country", "Tunisie", "HARD_CANDIDATE", "q2"), ("country", "Libye", "EXCLUSION_CANDIDATE", "q3"), ("country", "Côte d'Ivoire", "CONTEXT_ONLY", "q4")])
    assert requirements.filter_proposals(reqs, spark.createDataFrame([], "field string, value string")).count() == 0


def test_filter_proposals_agree_with_containment_of_every_value(spark):
    rng = random.Random(5)
    said = [(f"q{i:03}", " ".join(rng.choices("abcd", k=rng.randint(0, 14)))) for i in range(60)]
    values = sorted({" ".join(rng.choices("abcd", k=rng.choice((1, 2, 5, 6, 9)))) for _ in range(200)})
    want = {(v, min(q for q, t in said if f" {v} " in f" {t} ")) for v in values if any(f" {v} " in f" {t} " for _, t in said)}
    reqs = spark.createDataFrame(said, "requirement_id string, folded string").withColumn("classification", F.lit("MUST"))
    got = requirements.filter_proposals(reqs, spark.createDataFrame([(v,) for v in values], "value string").withColumn("field", F.lit("f")))
    assert {(r.value, r.requirement_id) for r in got.collect()} == want and max(len(v.split()) for v, _ in want) > 4


def test_sources_and_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "=x", ["a"]), (2, None, [])], "id long, v string, tags array<string>")
    sinks.write_csv(df, f"{tmp_path}/csv")
    got = {r.id: (r.v, r.tags) for r in readers.read_csv_strings(spark, f"{tmp_path}/csv").collect()}
    assert got == {"1": ("'=x", '["a"]'), "2": ("", "[]")}
    sinks.write_jsonl(df, f"{tmp_path}/jsonl")
    back = readers.read_jsonl(spark, f"{tmp_path}/jsonl", df.schema)
    assert same_rows(df, back.select(*df.columns))
    tables = {"t": df}
    sinks.manifest(tables, f"{tmp_path}/m.json", run="x")
    assert sinks.verify_manifest({"t": back.select(*df.columns)}, f"{tmp_path}/m.json") == []
    assert sinks.verify_manifest({"t": df.limit(1)}, f"{tmp_path}/m.json") == ["t"]
    assert [sinks.append_missing(df, f"{tmp_path}/p", ["id"]) for _ in range(2)] == [2, 0]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.md").write_text("héllo", encoding="utf-8")
    assert [tuple(r) for r in readers.read_segments(spark, f"{tmp_path}/in").collect()] == [("a.md", "héllo")]
    assert readers.inventory(spark, f"{tmp_path}/in").first().length == 6
    links = readers.hyperlinks(spark.createDataFrame([(1, '<a href="http://x.org/a">http://x.org/a </a>')], "id long, h string"), "id", "h")
    assert [tuple(r) for r in links.collect()] == [(1, "http://x.org/a", "attribute,text")]


def test_incremental_ingest_is_idempotent(spark, tmp_path):
    source = str(tmp_path / "src")
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string").write.parquet(source)
    for _ in range(2):
        ingest(spark, source, "id long, v string", f"{tmp_path}/out", f"{tmp_path}/cp", lambda d: d.withColumn("n", F.length("v")), ["id"]).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2
    spark.createDataFrame([(2, "b"), (3, "c")], "id long, v string").write.mode("append").parquet(source)
    ingest(spark, source, "id long, v string", f"{tmp_path}/out", f"{tmp_path}/cp", lambda d: d.withColumn("n", F.length("v")), ["id"]).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2, 3]
