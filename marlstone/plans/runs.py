"""Whole runs: tables, a manifest with logical hashes, checksums and a success mark; and their verification.

A run is a folder of Parquet tables. ``MANIFEST.json`` holds rows and logical hash of every table
and the facts of the run, ``SHA256SUMS`` the checksums of its text files, and ``_SUCCESS.json``
that it came to its end. ``verify_run`` reads everything again. Paths may lie in any store that
Spark reads.
"""

from __future__ import annotations

import json
import platform
from datetime import UTC, datetime
from hashlib import sha256
from importlib import metadata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.chunking import ChunkRules
from ..functions.text import retrieval_text
from ..operators import corpus, evaluation, filters, matching, recommend, requirements, search
from ..operators.contracts import EngineError, forbid_columns, repeated_keys, require_same_keys
from ..operators.governance import EngineConfig, checked_query, next_state
from ..operators.lexical_index import Bm25Index
from ..operators.relational import logical_hash
from ..sources.sinks import exists, get_text, put_text

#: Columns that no published table may have.
FORBIDDEN = ("text_raw", "project_value", "team_member", "personal_data")


def utc_now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def run_id(config: EngineConfig, now: str | None = None) -> str:
    """Time and configuration of a run, as its name."""
    stamp = (now or utc_now()).replace("-", "").replace(":", "")
    return f"{stamp}_{config.digest()[:10]}"


def versions(names: tuple[str, ...] = ("pyspark", "pyarrow", "pandas", "numpy")) -> dict[str, str]:
    out = {"python": platform.python_version()}
    for n in names:
        try:
            out[n] = metadata.version(n)
        except metadata.PackageNotFoundError:
            out[n] = ""
    return out


def write_run(spark: SparkSession, out: str, kind: str, tables: dict[str, DataFrame], facts: dict, config: EngineConfig | None = None, texts: dict[str, str] | None = None) -> dict:
    """Writes a run; one that is already there and complete is refused. Returns its manifest."""
    if exists(spark, f"{out}/_SUCCESS.json"):
        raise EngineError(f"there is a complete run in {out}")
    config = config or EngineConfig()
    listed = {}
    for name, df in tables.items():
        forbid_columns(df, list(FORBIDDEN)).write.mode("overwrite").parquet(f"{out}/{name}")
        listed[name] = _hashed(spark, f"{out}/{name}")
    manifest = {"kind": kind, "created_utc": utc_now(), "versions": versions(), "config_sha256": config.digest(), "tables": listed, "facts": facts}
    files = {**(texts or {}), "MANIFEST.json": json.dumps(manifest, sort_keys=True, indent=1, ensure_ascii=False, default=str)}
    for name, text in files.items():
        put_text(spark, f"{out}/{name}", text)
    sums = "".join(f"{sha256(t.encode()).hexdigest()}  {n}\n" for n, t in sorted(files.items()))
    put_text(spark, f"{out}/SHA256SUMS", sums)
    put_text(spark, f"{out}/_SUCCESS.json", json.dumps({"manifest_sha256": sha256(files["MANIFEST.json"].encode()).hexdigest(), "sums_sha256": sha256(sums.encode()).hexdigest()}))
    return manifest


def _hashed(spark: SparkSession, path: str) -> dict:
    df = spark.read.parquet(path)
    r = logical_hash(df, sorted(df.columns)).first()
    return {"rows": int(r["rows"]), "logical_hash": r["logical_hash"], "columns": sorted(df.columns)}


def verify_run(spark: SparkSession, out: str, kind: str | None = None) -> dict:
    """The manifest of a complete and unchanged run; anything else is refused."""
    if not exists(spark, f"{out}/_SUCCESS.json"):
        raise EngineError(f"no complete run in {out}")
    success, sums = json.loads(get_text(spark, f"{out}/_SUCCESS.json")), get_text(spark, f"{out}/SHA256SUMS")
    if sha256(sums.encode()).hexdigest() != success["sums_sha256"]:
        raise EngineError("the checksums changed")
    for line in sums.splitlines():
        said, name = line.split("  ", 1)
        if sha256(get_text(spark, f"{out}/{name}").encode()).hexdigest() != said:
            raise EngineError(f"{name} changed")
    manifest = json.loads(get_text(spark, f"{out}/MANIFEST.json"))
    if kind and manifest["kind"] != kind:
        raise EngineError(f"a run of {manifest['kind']}, not of {kind}")
    changed = [n for n, said in manifest["tables"].items() if _hashed(spark, f"{out}/{n}") != said]
    if changed:
        raise EngineError(f"tables changed: {', '.join(changed)}")
    return manifest


def pinned(spark: SparkSession, out: str, kind: str, manifest_sha256: str | None = None) -> dict[str, DataFrame]:
    """The tables of an upstream run, verified, and held to the hash of its manifest if one is given."""
    manifest = verify_run(spark, out, kind)
    if manifest_sha256 and sha256(get_text(spark, f"{out}/MANIFEST.json").encode()).hexdigest() != manifest_sha256:
        raise EngineError("the upstream run is not the pinned one")
    return {n: spark.read.parquet(f"{out}/{n}") for n in manifest["tables"]}


def _refuse(bad: DataFrame, what: str) -> None:
    if not bad.isEmpty():
        raise EngineError(what)


# -- snapshot, extraction, repair --------------------------------------------------------------


def run_snapshot(spark: SparkSession, files: DataFrame, out: str, allowed: list[str], most_bytes: int, excluded: Column | None = None) -> dict:
    """A read-only inventory (file_id, path, mime, length, sha256) with what is routed where."""
    route = corpus.route_status(F.col("mime"), F.col("length"), allowed, most_bytes)
    table = files.withColumn("snapshot_status", F.when(F.coalesce(excluded, F.lit(False)), "SKIPPED:policy").otherwise(route) if excluded is not None else route)
    _refuse(repeated_keys(table, ["file_id"]), "a file is listed twice")
    counts = {r.snapshot_status: r.n for r in table.groupBy("snapshot_status").agg(F.count("*").alias("n")).collect()}
    return write_run(spark, out, "snapshot", {"files": table}, {"statuses": counts, "read_only": True})


def run_extraction(spark: SparkSession, pages: DataFrame, words: DataFrame, out: str) -> dict:
    """Pages (document_id, page, digital_text, blank) with their own text or that of recognised words, and a status."""
    read = corpus.ocr_lines(words, ["document_id", "page"]).withColumnsRenamed({"text": "ocr_text", "confidence": "ocr_confidence"})
    usable = corpus.usable_digital_text(F.coalesce("digital_text", F.lit("")))
    j = pages.join(read, ["document_id", "page"], "left").withColumn("ocr", ~usable)
    j = j.withColumn("text", F.when(F.col("ocr"), F.coalesce("ocr_text", F.lit(""))).otherwise(F.col("digital_text")))
    status, reason = corpus.page_status(F.length(F.trim("text")), F.col("ocr"), F.col("ocr_confidence"), F.coalesce("blank", F.lit(False)))
    j = j.withColumns({"qa_status": status, "qa_reason": reason}).drop("ocr_text", "digital_text")
    counts = {r.qa_status: r.n for r in j.groupBy("qa_status").agg(F.count("*").alias("n")).collect()}
    return write_run(spark, out, "extraction", {"pages": j, "review_queue": corpus.review_queue(j)}, {"qa": counts})


def run_repair(spark: SparkSession, extraction: str, attempts: DataFrame, out: str) -> dict:
    """The pages of an extraction, those of the review queue replaced by their best attempt where it is better.

    ``attempts``: document_id, page, attempt, text, words, chars, confidence.
    """
    up = pinned(spark, extraction, "extraction")
    status, reason = corpus.repair_status(F.col("chars"), F.col("words"), F.col("confidence"))
    tried = attempts.join(up["review_queue"].select("document_id", "page"), ["document_id", "page"], "left_semi").withColumns({"status": status, "reason": reason})
    best = corpus.best_attempt(tried, ["document_id", "page"]).select("document_id", "page", F.col("text").alias("_text"), F.col("status").alias("_status"), F.col("reason").alias("_reason"))
    better = F.col("_status").isNotNull() & ((F.col("_status") == "PASS") | ((F.col("_status") == "REVIEW") & (F.col("qa_status") == "FAILED")))
    j = up["pages"].join(best, ["document_id", "page"], "left").withColumn("repaired", F.coalesce(better, F.lit(False)))
    for c, new in (("text", "_text"), ("qa_status", "_status"), ("qa_reason", "_reason")):
        j = j.withColumn(c, F.when(F.col("repaired"), F.col(new)).otherwise(F.col(c)))
    j = j.drop("_text", "_status", "_reason").withColumn("retrieval_eligible", F.col("qa_status").isin("PASS", "REVIEW") & (F.col("text") != ""))
    return write_run(spark, out, "repair", {"pages": j}, {"repaired": j.where("repaired").count(), "left": corpus.review_queue(j).count()})


# -- corpus, retrieval, evaluation -------------------------------------------------------------


def run_corpus(spark: SparkSession, pages: DataFrame, references: DataFrame, fields: list[str], out: str, citation_base: str, rules: ChunkRules = ChunkRules(), config: EngineConfig | None = None) -> dict:
    """The canonical corpus of ``corpus.corpus_frames``; repeated chunk, page or document ids are refused."""
    tables = corpus.corpus_frames(pages, references, fields, citation_base, rules)
    manifest = write_run(spark, out, "corpus", tables, tables["statistics"].first().asDict(), config)
    verify_corpus(spark, out)
    return manifest


def verify_corpus(spark: SparkSession, out: str) -> dict:
    t = pinned(spark, out, "corpus")
    for name, key in (("pages", "page_id"), ("chunks", "chunk_id"), ("documents", "document_id")):
        _refuse(repeated_keys(t[name], [key]), f"{name} repeat a {key}")
    _refuse(t["chunks"].join(t["pages"], "page_id", "left_anti"), "a chunk has no page")
    held = t["chunks"].join(t["pages"].select("page_id", F.col("text").alias("page_text")), "page_id")
    _refuse(held.where(F.col("text") != F.substr("page_text", F.col("start") + 1, F.col("end") - F.col("start"))), "a chunk is not the text at its offsets")
    _refuse(t["chunks"].where(F.sha2("text", 256) != F.col("text_sha256")), "a chunk's hash is wrong")
    return verify_run(spark, out, "corpus")


def run_retrieval(spark: SparkSession, corpus_run: str, out: str, encoder: search.Encoder, allowed: list[str], facets: list[str], thresholds: dict[str, float] | None = None, most_probes: int = 50) -> dict:
    """Index, vectors, probes and their metrics in every mode over a corpus run; a metric below its gate is shown, not hidden.

    Index and vectors are made of the chunks' retrieval texts, kept with their hashes in
    ``passages``; every search reads that index. Probes are searched with and without their own filter.
    """
    up = pinned(spark, corpus_run, "corpus")
    values = {f: F.coalesce(F.from_json(f"{f}_values_json", "array<string>"), F.array().cast("array<string>")).alias(f) for f in facets}
    documents = up["documents"].select("document_id", *values.values())
    pages = up["pages"].select("page_id", "citation_uri")
    chunks = up["chunks"].select(F.col("chunk_id").alias("id"), "document_id", "page_id", "file_name", "text", "security_classification").join(documents, "document_id").join(pages, "page_id")
    passage = retrieval_text(F.col("file_name"), {f: F.col(f) for f in facets}, F.col("text"))
    chunks.select("id", "document_id", "security_classification", "citation_uri", *facets, passage.alias("text")).withColumn("retrieval_text_sha256", F.sha2("text", 256)).write.mode("overwrite").parquet(f"{out}/passages")
    passages = spark.read.parquet(f"{out}/passages")
    index = search.passage_index(passages, f"{out}/index", facets=tuple(facets)).verify()
    search.encoded(passages, "text", encoder).select("id", "embedding").write.mode("overwrite").parquet(f"{out}/vectors")
    vectors = passages.join(spark.read.parquet(f"{out}/vectors"), "id")
    require_same_keys({"chunks": passages, "vectors": vectors.select("id")}, "id")
    probed = up["documents"].where("retrieval_eligible").select(F.col("document_id").alias("id"), *values.values())
    search.probes(probed, facets, most_probes).write.mode("overwrite").parquet(f"{out}/probes-made")
    probes = spark.read.parquet(f"{out}/probes-made")
    asked = search.encoded(probes.select(F.col("query_id").alias("id"), F.col("query_text").alias("text"), "relevant", "filter"), "text", encoder, "query", "query_vector")
    metrics, hits, checks = search.evaluate_bootstrap(vectors, asked, allowed, filtered_by="filter", citation="citation_uri", index=index)
    passed = evaluation.gate(metrics.where("mode = 'hybrid'"), thresholds or {"recall_at_10": 0.85})
    facts = {"label_source": "BOOTSTRAP_METADATA_NOT_EXPERT", "production_quality_claim_allowed": False, "documents": index.fact.n, "analyser": index.fact.analyser, "gates": [r.asDict() for r in passed.collect()]} | checks.first().asDict()
    return write_run(spark, out, "retrieval", {"probes": probes, "metrics": metrics, "hits": hits}, facts)


def verify_retrieval(spark: SparkSession, out: str) -> dict:
    index = Bm25Index.load(spark, f"{out}/index").verify()
    passages = spark.read.parquet(f"{out}/passages")
    _refuse(passages.where(F.sha2("text", 256) != F.col("retrieval_text_sha256")), "a retrieval text is not what was indexed")
    require_same_keys({"passages": passages, "index": index.documents()}, "id")
    return verify_run(spark, out, "retrieval")


def advance_evaluation(spark: SparkSession, out: str, queries: DataFrame, first: DataFrame | None, second: DataFrame | None, adjudicated: DataFrame | None, hits: DataFrame, frozen: str | None) -> dict:
    """One step of a human-gated evaluation: labels are compared, and metrics come only from complete ones.

    ``frozen``: the logical hash of the queries when labelling began.
    """
    current = logical_hash(queries, sorted(queries.columns)).first()["logical_hash"]
    count = queries.count()
    labels = sum(df.count() for df in (first, second) if df is not None)
    pairs = evaluation.labelled_pairs(first, second) if first is not None and second is not None else None
    expected = first.count() if first is not None else max(1, count)
    agreed = pairs.where("agreement").count() if pairs is not None else 0
    state = next_state(count, frozen, current, labels, expected, agreed + (adjudicated.count() if adjudicated is not None else 0))
    tables, facts = {"queries": queries}, {"state": state, "queries_hash": current}
    if pairs is not None:
        tables["pairs"] = pairs
        facts["agreement"] = evaluation.weighted_kappa(pairs, "relevance_1", "relevance_2", 4).first().asDict()
    if state == "COMPLETE":
        grades = evaluation.final_grades(pairs, adjudicated if adjudicated is not None else pairs.limit(0).withColumnRenamed("relevance_1", "relevance")).withColumnRenamed("candidate_id", "id")
        tables["metrics"] = evaluation.system_means(evaluation.ranking_metrics(hits, grades))
    return write_run(spark, out, "evaluation", tables, facts)


# -- matching, opportunities, recommendations, portfolios --------------------------------------


def run_matching(spark: SparkSession, chunks: DataFrame, contract: DataFrame, controls: dict, out: str, allowed: list[str], encoder: search.Encoder, vocabulary: filters.ContractVocabulary | None = None, mode: str = "hybrid", reference_year: int = 2026, limit: int = 10) -> dict:
    """Evidence, coverage, scores and gaps for compiled controls (``filters.compile_controls``).

    ``chunks``: id, document_id, text, embedding, security_classification. ``contract``:
    reference_id, document_id and the fields of a reference contract.
    """
    eligible, audit = filters.filter_contract(contract, allowed, controls["hard_filters"], controls["exclusions"], vocabulary)
    rows = [(r["requirement_id"], r["classification"], checked_query(r["text"])) for r in controls["requirements"]]
    asked = search.encoded(spark.createDataFrame(rows, "id string, classification string, text string"), "text", encoder, "query", "query_vector")
    evidence = search.match(chunks, asked, eligible.select("reference_id", "document_id"), allowed, mode=mode)
    wanted = asked.select(F.col("id").alias("requirement_id"), "classification")
    grid = matching.coverage_grid(evidence, wanted)
    fit = matching.soft_fit(controls["soft_preferences"], contract.columns)
    facts = eligible.select("reference_id", "evidence_strength", "year_end", fit.alias("soft_fit"), F.col("base_shortlist_eligible").alias("base_eligible"), "duplicate_group_id")
    scores = matching.score_matches(grid, facts, reference_year, limit=limit)
    tables = {"evidence": evidence, "coverage": grid, "scores": scores, "gaps": matching.requirement_gaps(grid), "audit": audit}
    return write_run(spark, out, "matching", tables, {"authorization_applied_before_scoring": True, "requirements": len(rows)})


def run_analysis(spark: SparkSession, segments: DataFrame, values: DataFrame, markers: dict[str, list[str]], out: str) -> dict:
    """Requirements and proposals of an opportunity; a proposal that nobody could confirm is refused."""
    t = requirements.analyze(segments, values, markers)
    _refuse(requirements.proposal_issues(t["proposals"]), "a proposal breaks the rules")
    query = requirements.requirements(segments, "locator", "text", markers).select(F.lit(1).alias("g"), "classification", "locator", F.col("unit_text").alias("text"))
    from ..operators.governance import retrieval_query

    facts = t["facts"].first().asDict() | {"external_model_calls": 0}
    return write_run(spark, out, "analysis", {"requirements": t["requirements"], "proposals": t["proposals"], "retrieval_query": retrieval_query(query, "g")}, facts)


def run_recommendations(spark: SparkSession, chunks: DataFrame, asked: DataFrame, references: DataFrame, controls: dict, out: str, allowed: list[str], type_strengths: dict[str, float], quality_strengths: dict[str, float], reference_year: int = 2026) -> dict:
    """The lexical recommendation path. ``asked``: requirement_id, classification, text."""
    evidence = recommend.requirement_evidence(chunks, asked.select(F.col("requirement_id").alias("id"), "text"), references.select("reference_id", "document_id"), allowed)
    shown = chunks.select(F.col("id").alias("chunk_id"), "document_type", "data_quality_status", "source_sha256", F.col("page").alias("page_number_1_based"), "citation_label", "citation_uri")
    evidence = evidence.join(shown, "chunk_id")
    _refuse(recommend.incomplete_evidence(evidence), "evidence without a complete citation")
    wanted = asked.select("requirement_id", "classification")
    scored, grid = recommend.score_references(evidence, wanted, references, controls["soft_preferences"], type_strengths, quality_strengths, reference_year=reference_year)
    tables = {"evidence": evidence, "coverage": grid, "recommendations": scored, "shortlist": recommend.diversified(scored), "gaps": recommend.gap_summary(wanted, evidence)}
    return write_run(spark, out, "recommendations", tables, {"human_review_required": True})


def run_portfolio(spark: SparkSession, candidates: DataFrame, coverage: DataFrame, rules: list[dict], criteria: list[dict], rules_of: dict[str, list[str]], human_routes: list[str], out: str, most: int, least: int = 0) -> dict:
    """A portfolio, what it covers, which rules it meets, and evidence for criteria that people score."""
    annotated = matching.annotate_capabilities(candidates)
    picks = matching.select_portfolio(annotated, coverage, rules, most, least)
    chosen = annotated.join(F.broadcast(picks), "reference_id")  # most rows
    named = {r["code"]: (F.col("is_signed_attestation") if r["level"] == "PER_REFERENCE" else matching.rule_condition(r), None if r["level"] == "PER_REFERENCE" else int(r["minimum_count"])) for r in rules}
    results = matching.evaluate_rules(chosen, named)
    held = coverage.join(F.broadcast(picks.select("reference_id")), "reference_id", "left_semi").where("covered")
    asked = coverage.select("requirement_id", "classification").distinct()
    ids = held.groupBy("requirement_id").agg(F.array_sort(F.collect_set("reference_id")).alias("reference_ids"))
    covered = asked.join(ids, "requirement_id", "left").withColumn("supporting", F.coalesce(F.size("reference_ids"), F.lit(0)))
    table = matching.scoring_criteria(criteria, results, covered.select("requirement_id", "supporting", F.coalesce("reference_ids", F.array().cast("array<string>")).alias("reference_ids")), rules_of, human_routes)
    return write_run(spark, out, "portfolio", {"portfolio": chosen, "rules": results, "coverage": covered, "criteria": table}, {"points_awarded": None})


def run_dossiers(spark: SparkSession, recommended: DataFrame, evidence: DataFrame, title: str, text: str, out: str, quota: int = 3, context: list[str] | None = None, relevance: str | None = None, uri: str | None = None, least: float = 0.15) -> dict:
    """Dossier records: of each recommendation the best grounded evidence, ``quota`` rows at most, as JSON lines.

    ``context`` names what is known of a reference. A recommendation that has no evidence is refused.
    """
    known = F.concat_ws(" ", *context) if context else None
    rows = search.dossier(recommended, evidence, F.col(text), F.col(title), known, F.col(relevance) if relevance else None, F.col(uri) if uri else None, least).where(F.col("place") <= quota)
    _refuse(recommended.join(rows, "reference_id", "left_anti"), "a recommendation has no evidence")
    return write_run(spark, out, "dossiers", {"records": rows}, {"weak": rows.where("weak").count(), "rendering": "none"})
