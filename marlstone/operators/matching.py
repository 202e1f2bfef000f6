"""Matching of candidates to weighted requirements, and portfolio selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fold_key, folded
from ..functions.values import overlaps_years, recency
from .contracts import EngineError

# Fixed values
REQUIREMENT_WEIGHTS = {"MUST": 1.00, "SHOULD": 0.70, "PREFERRED": 0.40, "CONTEXT": 0.15}
COMPONENT_WEIGHTS = {"relevance": 0.60, "coverage": 0.20, "evidence_quality": 0.10, "recency": 0.05, "soft_fit": 0.05}
COVERAGE_THRESHOLD = 0.30


def weight_of(column):
    return F.element_at(F.create_map(*[F.lit(x) for kv in REQUIREMENT_WEIGHTS.items() for x in kv]), F.col(column))


def rerank(evidence: DataFrame, score_share: float = 0.8) -> DataFrame:
    """Adds ``rerank_score``: score over the largest of its requirement, and term coverage.

    The largest is the column ``top_score`` where there is one; else maxima are aggregated and
    joined, for a requirement may hold a large part of all evidence.
    """
    if "top_score" not in evidence.columns:
        evidence = evidence.join(evidence.groupBy("requirement_id").agg(F.max("score").alias("top_score")), "requirement_id")
    top = F.col("top_score")
    scaled = F.when(top > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("score") / top))).otherwise(0.0)
    return evidence.withColumn("rerank_score", score_share * scaled + (1 - score_share) * F.col("term_coverage")).drop("top_score")


def keep_evidence(evidence: DataFrame, limit: int = 3) -> DataFrame:
    """The ``limit`` best rows of each (reference, requirement)."""
    order = Window.partitionBy("reference_id", "requirement_id").orderBy(F.desc("rerank_score"), "chunk_id")
    return evidence.withColumn("evidence_rank", F.row_number().over(order)).where(F.col("evidence_rank") <= limit)


def coverage_grid(evidence: DataFrame, requirements: DataFrame, threshold: float = COVERAGE_THRESHOLD, most_requirements: int = 100_000) -> DataFrame:
    """A row for each (reference with evidence, requirement): relevance and covered.

    Requirements are a request: a short list, attached to every reference as one array. More than
    ``most_requirements`` are refused, for the list goes to every task.
    """
    best = evidence.groupBy("reference_id", "requirement_id").agg(F.max("rerank_score").alias("relevance"))
    if requirements.limit(most_requirements + 1).count() > most_requirements:
        raise EngineError(f"more than {most_requirements} requirements in one request")
    asked = requirements.agg(F.collect_list(F.struct("requirement_id", "classification")).alias("asked"))
    dense = best.select("reference_id").distinct().join(F.broadcast(asked)).select("reference_id", F.inline("asked"))
    grid = dense.join(best, ["reference_id", "requirement_id"], "left")
    return grid.select("reference_id", "requirement_id", "classification", F.coalesce("relevance", F.lit(0.0)).alias("relevance"), F.coalesce(F.col("relevance") >= threshold, F.lit(False)).alias("covered"))


def coverage_scores(grid: DataFrame) -> DataFrame:
    w = weight_of("classification")
    must = F.col("classification") == "MUST"
    return grid.groupBy("reference_id").agg(
        (F.sum(w * F.col("relevance")) / F.sum(w)).alias("weighted_relevance"),
        (F.sum(F.when(F.col("covered"), w).otherwise(0.0)) / F.sum(w)).alias("weighted_coverage"),
        F.count_if(must & F.col("covered")).alias("must_covered"),
        F.count_if(must).alias("must_total"),
    )


def score_matches(grid: DataFrame, contract: DataFrame, reference_year: int = 2026, must_gate: bool = True, limit: int = 10) -> DataFrame:
    """Every scored reference: final_score, eligible, reasons and, for those selected, final_rank.

    ``contract``: reference_id, evidence_strength, year_end, soft_fit, base_eligible,
    duplicate_group_id. Of each duplicate group only the best eligible reference stays.
    """
    s = coverage_scores(grid).join(contract, "reference_id")
    parts = {"relevance": F.col("weighted_relevance"), "coverage": F.col("weighted_coverage"), "evidence_quality": F.col("evidence_strength"), "recency": recency(F.col("year_end"), reference_year), "soft_fit": F.col("soft_fit")}
    total = sum((F.lit(COMPONENT_WEIGHTS[k]) * v for k, v in parts.items()), F.lit(0.0))
    missing = F.when(F.lit(must_gate) & (F.col("must_covered") < F.col("must_total")), F.format_string("MISSING_MUST:%d/%d", "must_covered", "must_total"))
    base = F.when(~F.col("base_eligible"), "BASE_ELIGIBILITY_FAILED")
    s = s.withColumn("final_score", F.bround(total, 8)).withColumn("reasons", F.concat_ws(";", missing, base))
    first = Window.partitionBy("duplicate_group_id", F.col("reasons") == "").orderBy(F.desc("final_score"), "reference_id")
    s = s.withColumn("reasons", F.when((F.col("reasons") == "") & (F.row_number().over(first) > 1), "DUPLICATE_GROUP_SUPPRESSED").otherwise(F.col("reasons")))
    s = s.withColumn("eligible", F.col("reasons") == "")
    best = s.where("eligible").orderBy(F.desc("final_score"), "reference_id").limit(limit)
    ranked = best.select("reference_id", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("final_score"), "reference_id")).alias("final_rank"))  # limit rows
    return s.join(F.broadcast(ranked), "reference_id", "left")


FOLDED_FIELDS = ("region", "subregion", "client_key")


def soft_fit(preferences: list[tuple[str, str]] | dict[str, str], columns: list[str]):
    """Share of the preferences on fields that the references have which a reference meets; 1 without any.

    Codes compare as they are, fields in ``FOLDED_FIELDS`` folded.
    """
    wanted = [(c, v) for c, v in (preferences.items() if isinstance(preferences, dict) else preferences) if c in columns]
    if not wanted:
        return F.lit(1.0)

    def met(c, v):
        hit = fold_key(F.col(c)) == folded(v) if c in FOLDED_FIELDS else F.col(c).cast("string") == str(v)
        return F.coalesce(hit, F.lit(False)).cast("int")

    return sum((met(c, v) for c, v in wanted), F.lit(0)) / len(wanted)


def requirement_gaps(grid: DataFrame) -> DataFrame:
    """(requirement_id, classification, supporting, reference_ids) over the references of the grid."""
    return grid.groupBy("requirement_id", "classification").agg(F.count_distinct(F.when(F.col("covered"), F.col("reference_id"))).alias("supporting"), F.array_sort(F.collect_set(F.when(F.col("covered"), F.col("reference_id")))).alias("reference_ids"))


# -- portfolios --------------------------------------------------------------------------------


def annotate_capabilities(references: DataFrame) -> DataFrame:
    """Adds what portfolio rules ask for, from offering_code, sector_code, subregion, evidence and tags.

    ``references``: offering_code, sector_code, subregion, evidence_available, evidence_type,
    capability_tags and engagement_tags (arrays). Nulls count as absent.
    """
    offering, has = F.upper("offering_code"), lambda column, tag: F.array_contains(F.transform(F.col(column), lambda t: F.upper(t)), tag)
    strategy = offering.isin("IT_STRATEGY", "IT_STRATEGY_AMOA") | (has("capability_tags", "IT_GOVERNANCE") & has("capability_tags", "ROADMAP"))
    flags = {
        "is_signed_attestation": F.col("evidence_available") & F.col("evidence_type").isin("ATTESTATION_ORIGINAL", "ATTESTATION_SCAN"),
        "is_sdsi": strategy,
        "is_bfsi": F.col("sector_code").isin("BANKING", "INSURANCE"),
        "is_pca": (offering == "BUSINESS_CONTINUITY") | has("capability_tags", "BUSINESS_CONTINUITY"),
        "is_security": (offering == "CYBERSECURITY") | has("capability_tags", "CYBERSECURITY"),
        "is_sdsi_implementation_amoa": (offering == "IT_STRATEGY_AMOA") | (strategy & has("engagement_tags", "AMOA") & has("engagement_tags", "IMPLEMENTATION")),
        "is_west_or_north_africa": fold_key(F.col("subregion")).isin(folded("Afrique de l'Ouest"), folded("Afrique du Nord")),
    }
    return references.withColumns({name: F.coalesce(flag, F.lit(False)) for name, flag in flags.items()})


#: What the capabilities and scopes of a rule stand for.
RULE_CAPABILITIES = {"SIGNED_CLIENT_ATTESTATION": "is_signed_attestation", "SDSI": "is_sdsi", "PCA_PCI_PRA": "is_pca", "SECURITY_PSSI_ISO27001": "is_security", "SDSI_IMPLEMENTATION_AMOA": "is_sdsi_implementation_amoa", "ANY": None}
RULE_SCOPES = {"BANKING_FINANCE_INSURANCE": "is_bfsi", "WEST_OR_NORTH_AFRICA": "is_west_or_north_africa"}


def rule_condition(rule: dict) -> Column:
    """The references that a rule counts: capability, scope, attestation and years; unknown names are refused."""
    capability, scope = rule["required_capability"], rule.get("required_sector_or_region")
    if capability not in RULE_CAPABILITIES or (scope and scope not in RULE_SCOPES):
        raise EngineError(f"unknown capability or scope in rule {rule.get('code')}")
    named = [RULE_CAPABILITIES[capability], RULE_SCOPES[scope] if scope else None, "is_signed_attestation" if rule.get("signed_attestation_required") else None]
    out = F.lit(True)
    for flag in filter(None, named):
        out = out & F.col(flag)
    bounds = rule.get("year_start_inclusive"), rule.get("year_end_inclusive")
    return out & overlaps_years(F.col("year_start"), F.col("year_end"), *bounds)


def evaluate_rules(candidates: DataFrame, rules: dict[str, tuple[object, int | None]]) -> DataFrame:
    """(rule, matching, total, met, ids): a rule counts candidates; without a number all must match, of at least one."""
    ids = F.col("reference_id") if "reference_id" in candidates.columns else F.lit(None).cast("string")
    counts = [c for i, (condition, _) in enumerate(rules.values()) for c in (F.count_if(condition).alias(f"n{i}"), F.sort_array(F.collect_list(F.when(condition, ids))).alias(f"ids{i}"))]
    one = candidates.agg(F.count("*").alias("total"), *counts)

    def met(i, least):
        return (F.col("total") > 0) & (F.col(f"n{i}") == F.col("total")) if least is None else F.col(f"n{i}") >= least

    rows = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"n{i}").alias("matching"), F.col("total"), met(i, least).alias("met"), F.col(f"ids{i}").alias("ids")) for i, (name, (_, least)) in enumerate(rules.items())])
    return one.select(F.inline(rows))


def select_portfolio(candidates: DataFrame, coverage: DataFrame, rules: list[dict], most: int, least: int = 0) -> DataFrame:
    """(reference_id, portfolio_rank, selection_reason) of at most ``most`` references, in three phases.

    While a counting rule lacks references, those that count for it are taken, weighed by 1 over the
    number that each lacking rule asks for. Then references that cover open requirements, a MUST
    weighing twice, and last the best scores up to ``max(least, most)``. Ties go to the higher score,
    then the smaller id. Each pick is one aggregate over the candidates; the driver holds picks.

    ``candidates``: reference_id, final_score and the columns of ``annotate_capabilities``.
    ``coverage``: reference_id, requirement_id, classification, covered.
    """
    counting = [r for r in rules if r["level"] == "PORTFOLIO_COUNT"]
    weight = F.when(F.upper("classification") == "MUST", 2.0).otherwise(1.0)
    asked = coverage.groupBy("requirement_id").agg(F.max(weight).alias("weight"))
    needs = coverage.where("covered").select("reference_id", "requirement_id").distinct().join(asked, "requirement_id")
    needs = needs.groupBy("reference_id").agg(F.sort_array(F.collect_list(F.struct("requirement_id", "weight"))).alias("needs"))
    flags = F.array_compact(F.array(*[F.when(rule_condition(r), F.lit(r["code"])) for r in counting])) if counting else F.array().cast("array<string>")
    table = candidates.withColumn("counts_for", flags).join(needs, "reference_id", "left")
    table = table.select("reference_id", F.col("final_score").cast("double").alias("final_score"), "counts_for", "needs").persist()
    every = {r.requirement_id for r in asked.select("requirement_id").collect()}  # one row a requirement of a request
    chosen: list[tuple[str, str]] = []
    covered: set = set()

    def best(gain: Column):
        open_rows = table.where(~F.col("reference_id").isin([c for c, _ in chosen])) if chosen else table
        return open_rows.withColumn("gain", gain).where("gain > 0").orderBy(F.desc("gain"), F.desc("final_score"), "reference_id").limit(1).first()

    def take(row, reason: str) -> None:
        chosen.append((row.reference_id, reason))
        covered.update(x.requirement_id for x in row.needs or [])

    held = dict.fromkeys((r["code"] for r in counting), 0)
    while len(chosen) < most:
        lacking = [r for r in counting if held[r["code"]] < int(r["minimum_count"])]
        terms = [F.when(F.array_contains("counts_for", r["code"]), 1.0 / max(1, int(r["minimum_count"]))).otherwise(0.0) for r in lacking]
        row = best(sum(terms, F.lit(0.0))) if lacking else None
        if row is None:
            break
        take(row, "PORTFOLIO_RULE:" + ",".join(sorted(r["code"] for r in lacking if r["code"] in row.counts_for)))
        for code in row.counts_for:
            held[code] += 1
    while len(chosen) < most and covered != every:
        fresh = F.filter("needs", lambda x: ~x["requirement_id"].isin(list(covered))) if covered else F.col("needs")
        before = set(covered)
        row = best(F.coalesce(F.aggregate(fresh, F.lit(0.0), lambda s, x: s + x["weight"]), F.lit(0.0)))
        if row is None:
            break
        take(row, "REQUIREMENT_COVERAGE:" + ",".join(sorted({x.requirement_id for x in row.needs} - before)))
    rest = max(0, max(least, most) - len(chosen))
    if rest:
        others = table.where(~F.col("reference_id").isin([c for c, _ in chosen])) if chosen else table
        chosen += [(r.reference_id, "RANKED_PORTFOLIO_COMPLETION") for r in others.orderBy(F.desc("final_score"), "reference_id").limit(rest).collect()]
    table.unpersist()
    rows = [(c, i, reason) for i, (c, reason) in enumerate(chosen, 1)]
    kind = candidates.schema["reference_id"].dataType.simpleString()
    return candidates.sparkSession.createDataFrame(rows, f"reference_id {kind}, portfolio_rank int, selection_reason string")


def scoring_criteria(criteria: list[dict], rules: DataFrame, coverage: DataFrame, rules_of: dict[str, list[str]], human_routes: list[str], general: str = "SCORE-GENERAL") -> DataFrame:
    """Evidence status of each criterion; points are shown, never awarded.

    ``criteria``: code, points, evaluation_route. ``rules``: of ``evaluate_rules``. ``coverage``:
    requirement_id, supporting, reference_ids. ``rules_of``: the rules that a criterion rests on.
    """
    spark = rules.sparkSession
    listed = spark.createDataFrame([(c["code"], int(c["points"]), c["evaluation_route"], rules_of.get(c["code"], []), c["code"] == general) for c in criteria], "code string, points_available int, evaluation_route string, needs array<string>, general boolean")
    each = listed.select("code", F.explode("needs").alias("rule")).join(rules.select("rule", "met", "ids"), "rule", "left")
    of_rules = each.groupBy("code").agg(F.every(F.coalesce("met", F.lit(False))).alias("all_met"), F.sort_array(F.array_distinct(F.flatten(F.collect_list(F.transform("ids", lambda x: x.cast("string")))))).alias("rule_ids"))
    whole = coverage.agg(F.every(F.col("supporting") > 0).alias("all_covered"), F.sort_array(F.array_distinct(F.flatten(F.collect_list(F.transform("reference_ids", lambda x: x.cast("string")))))).alias("covering"))
    j = listed.join(of_rules, "code", "left").join(F.broadcast(whole))
    outside = F.col("evaluation_route").isin(list(human_routes))
    gap = F.when(F.col("general"), ~F.coalesce("all_covered", F.lit(True))).otherwise(~F.coalesce("all_met", F.lit(True)))
    status = F.when(outside, "OUTSIDE_REFERENCE_MATCHING_SCOPE").when(gap, "EVIDENCE_GAP").otherwise("READY_FOR_HUMAN_SCORING")
    ids = F.when(outside, F.array().cast("array<string>")).when(F.col("general"), F.col("covering")).otherwise(F.coalesce("rule_ids", F.array().cast("array<string>")))
    return j.select("code", "points_available", "evaluation_route", status.alias("evidence_status"), F.size(ids).alias("supporting"), ids.alias("reference_ids"), F.lit(None).cast("int").alias("points_awarded"), F.lit(True).alias("human_scoring_required"))
