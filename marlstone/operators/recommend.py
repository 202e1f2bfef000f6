"""The first recommendation path: lexical evidence per requirement, one linear score, a soft cap per client."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import excerpt, fold_search
from ..functions.values import latest_recency
from .lexical_index import Bm25Index
from .matching import REQUIREMENT_WEIGHTS, weight_of
from .relational import diversify
from .search import passage_index, passages

# Fixed value: the columns that a citation must have.
CITATION_FIELDS = ("reference_id", "requirement_id", "document_id", "chunk_id", "chunk_text_sha256", "source_sha256", "page_number_1_based", "citation_label", "citation_uri", "evidence_excerpt")
COMPONENTS = {"relevance": 0.60, "coverage": 0.20, "evidence_quality": 0.10, "recency": 0.05, "soft_fit": 0.05}


def requirement_evidence(chunks: DataFrame, requirements: DataFrame, references: DataFrame, allowed: list[str], candidates: int = 100, least_score: float = 0.0, index: Bm25Index | None = None) -> DataFrame:
    """The best chunk of each (reference, requirement), for all requirements in one plan.

    ``chunks``: id, document_id, text, security_classification and what a citation shows.
    ``requirements``: id, text. ``references``: reference_id, document_id, those eligible. Only
    scores above ``least_score`` count; ``relevance`` is the score over the best of the requirement.
    """
    found = passages(index or passage_index(chunks), requirements, allowed, candidates, documents=references, positive_only=True).where(F.col("score") > least_score)
    top = F.greatest(F.max("score").over(Window.partitionBy("query_id")), F.lit(1e-9))  # over ``candidates`` rows, as they were ranked
    found = found.withColumn("relevance", F.least(F.lit(1.0), F.col("score") / top))
    rows = found.join(chunks.select("id", "document_id", F.sha2("text", 256).alias("chunk_text_sha256"), excerpt(F.col("text"), 700).alias("evidence_excerpt")), "id").join(references, "document_id")
    best = Window.partitionBy("reference_id", "query_id").orderBy(F.desc("score"), "id")
    rows = rows.withColumn("_n", F.row_number().over(best)).where("_n = 1")
    return rows.select("reference_id", F.col("query_id").alias("requirement_id"), "document_id", F.col("id").alias("chunk_id"), "chunk_text_sha256", F.trim("evidence_excerpt").alias("evidence_excerpt"), "score", "relevance", F.col("rank").alias("retrieval_rank"))


def soft_preference_score(preferences: list[tuple[str, str]]) -> Column:
    """Share of the preferences whose folded value occurs in the reference's folded column; 1 without any."""
    if not preferences:
        return F.lit(1.0)

    def met(column: str, value: str) -> Column:
        return F.coalesce(F.contains(fold_search(F.coalesce(F.col(column).cast("string"), F.lit(""))), fold_search(F.lit(value))), F.lit(False)).cast("int")

    return sum((met(c, v) for c, v in preferences), F.lit(0)) / len(preferences)


def strength_of(column: str, strengths: dict[str, float]) -> Column:
    """A factor by name; names that are not listed count as OTHER."""
    listed = F.create_map(*[F.lit(x) for kv in strengths.items() for x in kv])
    return F.coalesce(F.try_element_at(listed, F.col(column)), F.lit(float(strengths["OTHER"])))


def score_references(evidence: DataFrame, requirements: DataFrame, references: DataFrame, preferences: list[tuple[str, str]], type_strengths: dict[str, float], quality_strengths: dict[str, float], threshold: float = 0.30, reference_year: int = 2026, weights: dict[str, float] = COMPONENTS) -> tuple[DataFrame, DataFrame]:
    """(recommendations, coverage) of the references with evidence.

    ``evidence``: reference_id, requirement_id, relevance, document_type, data_quality_status.
    ``requirements``: requirement_id, classification. ``references``: reference_id, project_year,
    evidence_available and the columns that preferences name.
    """
    asked = requirements.agg(F.collect_list(F.struct("requirement_id", "classification")).alias("asked"))  # one row a request
    dense = evidence.select("reference_id").distinct().join(F.broadcast(asked)).select("reference_id", F.inline("asked"))
    best = evidence.groupBy("reference_id", "requirement_id").agg(F.max("relevance").alias("relevance"))
    grid = dense.join(best, ["reference_id", "requirement_id"], "left")
    covered = F.coalesce(F.col("relevance") >= threshold, F.lit(False))
    grid = grid.select("reference_id", "requirement_id", "classification", F.coalesce("relevance", F.lit(0.0)).alias("relevance"), covered.alias("covered"))
    w, must = weight_of("classification"), F.col("classification") == "MUST"
    scored = grid.groupBy("reference_id").agg(
        (F.sum(w * F.col("relevance")) / F.sum(w)).alias("weighted_relevance"),
        (F.sum(F.when(F.col("covered"), w).otherwise(0.0)) / F.sum(w)).alias("weighted_coverage"),
        F.count_if(must & F.col("covered")).alias("must_covered"),
        F.count_if(must).alias("must_total"),
    )
    quality = evidence.groupBy("reference_id").agg(F.max(strength_of("document_type", type_strengths) * strength_of("data_quality_status", quality_strengths)).alias("evidence_quality"))
    r = scored.join(quality, "reference_id").join(references, "reference_id")
    r = r.withColumns({"recency_score": latest_recency(F.col("project_year"), reference_year), "soft_preference_fit": soft_preference_score(preferences)})
    parts = {"relevance": "weighted_relevance", "coverage": "weighted_coverage", "evidence_quality": "evidence_quality", "recency": "recency_score", "soft_fit": "soft_preference_fit"}
    total = sum((F.lit(weights[k]) * F.col(c) for k, c in parts.items()), F.lit(0.0))
    short = F.when(F.col("must_covered") < F.col("must_total"), F.format_string("MUST coverage %d/%d", "must_covered", "must_total"))
    bare = F.when(~F.coalesce("evidence_available", F.lit(False)), "missing supporting evidence")
    return r.withColumns({"base_score": F.bround(total, 8), "warnings": F.concat_ws("; ", short, bare)}), grid


def diversified(recommendations: DataFrame, client: str = "client", per_client: int = 2, limit: int = 10) -> DataFrame:
    """The best ``limit`` recommendations, the third and later of a client only to fill up; no client is one of its own."""
    key = fold_search(F.coalesce(F.col(client), F.lit("")))
    keyed = recommendations.withColumn("_client", F.when(key == "", F.concat(F.lit("unknown:"), F.col("reference_id").cast("string"))).otherwise(key))
    keyed = keyed.withColumn("_order", F.struct((-F.col("base_score")).alias("s"), "reference_id"))
    return diversify(keyed, "_client", "_order", per_client, limit).drop("_client", "_order")


def gap_summary(requirements: DataFrame, evidence: DataFrame, threshold: float = 0.30) -> DataFrame:
    """A row for every requirement, also one without evidence: references_with_evidence, gap, status."""
    found = evidence.where(F.col("relevance") >= threshold).groupBy("requirement_id").agg(F.count_distinct("reference_id").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return requirements.join(found, "requirement_id", "left").select("requirement_id", "classification", n.alias("references_with_evidence"), (n == 0).alias("gap"), F.when(n == 0, "NO_RELIABLE_EVIDENCE_FOUND").otherwise("EVIDENCE_FOUND").alias("status"))


def incomplete_evidence(evidence: DataFrame, required: tuple[str, ...] = CITATION_FIELDS) -> DataFrame:
    """The evidence rows in which a citation field is null or blank."""
    blank = F.lit(False)
    for c in required:
        blank = blank | F.col(c).isNull() | (F.col(c).cast("string") == "")
    return evidence.where(blank)


def total_weight(requirements: DataFrame) -> DataFrame:
    """One row: the weight of all requirements, by class."""
    return requirements.agg(F.sum(weight_of("classification")).alias("total_weight"), *[F.count_if(F.col("classification") == c).alias(c.lower()) for c in REQUIREMENT_WEIGHTS])
