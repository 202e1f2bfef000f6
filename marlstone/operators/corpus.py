"""Building the canonical corpus: pages, repairs, documents, chunks, references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.chunking import ChunkRules, chunks
from ..functions.text import citation_label, citation_uri, clean_redacted, document_type, page_language, text_metrics
from ..functions.values import first_seen, stable_id
from .contracts import forbid_columns, require_columns, require_unique


def page_status(chars: Column, ocr: Column, confidence: Column, blank: Column, fail=20, review=80, bad=45.0, doubtful=70.0) -> tuple[Column, Column]:
    """(PASS, REVIEW, FAILED or BLANK; reason) of a page."""
    c = F.coalesce(confidence, F.lit(0.0))
    rules = [
        (blank & (chars < 10), "BLANK", "visually_blank_page"),
        (chars < fail, "FAILED", "very_low_text_volume"),
        (chars < review, "REVIEW", "low_text_volume"),
        (ocr & (c < bad), "FAILED", "very_low_ocr_confidence"),
        (ocr & (c < doubtful), "REVIEW", "low_ocr_confidence"),
    ]
    status = reason = F.when(F.lit(False), "")
    for when, s, r in rules:
        status, reason = status.when(when, s), reason.when(when, r)
    return status.otherwise("PASS"), reason.otherwise("")


def repair_status(chars: Column, words: Column, confidence: Column, fail=20, good=80, good_words=10, bad=45.0, doubtful=70.0) -> tuple[Column, Column]:
    """(PASS, REVIEW or FAILED; reason) of a repaired page: words count, and confidence always does."""
    c = F.coalesce(confidence, F.lit(0.0))
    rules = [
        (chars < fail, "FAILED", "very_low_text_volume"),
        ((chars < good) | (words < good_words), "REVIEW", "low_text_volume"),
        (c < bad, "FAILED", "very_low_ocr_confidence"),
        (c < doubtful, "REVIEW", "low_ocr_confidence"),
    ]
    status = reason = F.when(F.lit(False), "")
    for when, s, r in rules:
        status, reason = status.when(when, s), reason.when(when, r)
    return status.otherwise("PASS"), reason.otherwise("")


def usable_digital_text(text: Column, least_chars: int = 80, least_words: int = 10) -> Column:
    """Whether a page's own text is enough, so that it needs no recognition."""
    m = text_metrics(text)
    return (m["character_count"] >= least_chars) & (m["word_count"] >= least_words)


def review_queue(pages: DataFrame, status: str = "qa_status") -> DataFrame:
    """The pages that a repair or a person must look at."""
    return pages.where(F.col(status).isin("REVIEW", "FAILED"))


def best_attempt(attempts: DataFrame, keys: list[str]) -> DataFrame:
    """The best repair attempt of each page: status, then words and chars up to a bound, confidence, earliest."""
    quality = F.try_element_at(F.create_map(*[F.lit(x) for kv in {"PASS": 3, "REVIEW": 2, "FAILED": 1, "BLANK": 0}.items() for x in kv]), F.col("status"))
    rank = F.struct(F.coalesce(quality, F.lit(0)), F.least(F.coalesce("words", F.lit(0)), F.lit(1000)), F.least(F.coalesce("chars", F.lit(0)), F.lit(5000)), F.round(F.coalesce("confidence", F.lit(0.0)), 4), -F.col("attempt"))
    value = F.struct(*[c for c in attempts.columns if c not in keys])
    return attempts.groupBy(*keys).agg(F.max_by(value, rank).alias("v")).select(*keys, "v.*")


def attempt_plan(pages: DataFrame, keys: list[str], latin: str, arabic: str, mixed: str, most: int = 8) -> DataFrame:
    """The ordered repair attempts of each page: keys, attempt, name, kind, languages, psm, variant, rotation.

    ``pages``: keys, arabic_character_count, has_native_text, status. Native text comes first
    where there is any; failed pages are tried rotated and in mixed languages, others in mixed ones
    only if they show Arabic. ``most`` attempts a page.
    """
    script = F.coalesce(F.col("arabic_character_count"), F.lit(0)) >= 8
    primary = F.when(script, F.lit(arabic)).otherwise(F.lit(latin))

    def spec(name: str, kind: str = "ocr", languages: Column | None = None, psm: int | None = None, variant: str | None = None, rotation: int = 0) -> Column:
        return F.struct(F.lit(name).alias("name"), F.lit(kind).alias("kind"), (F.lit("native") if languages is None else languages).alias("languages"), F.lit(psm).cast("int").alias("psm"), F.lit(variant).alias("variant"), F.lit(rotation).alias("rotation"))

    first = [spec(name, "ocr", primary, psm, variant) for name, psm, variant in PRIMARY_ATTEMPTS]
    both = spec("mixed_psm6_auto", "ocr", F.lit(mixed), 6, "autocontrast")
    turned = [spec(f"primary_psm6_rot{angle}", "ocr", primary, 6, "autocontrast", angle) for angle in (90, 270)]
    none = F.array().cast("array<struct<name:string,kind:string,languages:string,psm:int,variant:string,rotation:int>>")
    native = F.when(F.coalesce("has_native_text", F.lit(False)), F.array(spec("native_slide_text", "native", variant="native"))).otherwise(none)
    more = F.when(F.col("status").eqNullSafe("FAILED"), F.array(both, *turned)).when(script, F.array(both)).otherwise(none)
    plan = F.slice(F.concat(native, F.array(*first), more), 1, most)
    return pages.select(*keys, F.posexplode(plan).alias("at", "spec")).select(*keys, (F.col("at") + 1).alias("attempt"), "spec.*")


#: Name, page segmentation mode and image variant of the attempts that every page gets.
PRIMARY_ATTEMPTS = (("primary_psm3_auto", 3, "autocontrast"), ("primary_psm6_auto", 6, "autocontrast"), ("primary_psm6_threshold", 6, "threshold"), ("primary_psm11_sharpen", 11, "sharpen"))


def made_attempts(attempts: DataFrame, keys: list[str], enough: float) -> DataFrame:
    """The attempts of each page that are made: in order, up to the first repair that passes with confidence ``enough``.

    Attempt 0 is the page as it was; it never ends the repair. Later rows are left out whatever they hold.
    """
    good = (F.col("attempt") > 0) & (F.col("status") == "PASS") & (F.coalesce("confidence", F.lit(0.0)) >= enough)
    order = Window.partitionBy(*keys).orderBy("attempt").rowsBetween(Window.unboundedPreceding, -1)  # a page's few attempts
    ended = F.coalesce(F.max(good.cast("int")).over(order), F.lit(0))
    return attempts.withColumn("_ended", ended).where("_ended = 0").drop("_ended")


def repaired_pages(attempts: DataFrame, keys: list[str], enough: float = 70.0) -> DataFrame:
    """The selected attempt of each page among those made, with ``attempts_made``."""
    made = made_attempts(attempts, keys, enough)
    counted = made.groupBy(*keys).agg((F.count("*") - F.count_if(F.col("attempt") == 0)).alias("attempts_made"))
    return best_attempt(made, keys).join(counted, keys)


def ocr_lines(words: DataFrame, keys: list[str]) -> DataFrame:
    """Text and confidence of pages from recognised words (block, paragraph, line, word, text, confidence).

    Confidence is the mean weighted by length, of words with a confidence.
    """
    known = F.col("confidence") >= 0
    parts = words.where("trim(text) <> ''").groupBy(*keys, "block", "paragraph", "line").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("word", "text"))), lambda x: x["text"]), " ").alias("line_text"),
        F.sum(F.when(known, F.col("confidence") * F.length("text"))).alias("cw"),
        F.sum(F.when(known, F.length("text"))).alias("w"),
    )
    lines = F.transform(F.sort_array(F.collect_list(F.struct("block", "paragraph", "line", "line_text"))), lambda x: x["line_text"])
    return parts.groupBy(*keys).agg(F.array_join(lines, "\n").alias("text"), (F.sum("cw") / F.sum("w")).alias("confidence"))


def canonical_pages(pages: DataFrame, version: str = "v1") -> DataFrame:
    """Eligible pages with clean text, its hash, language and a stable page id."""
    require_columns(pages, ["document_id", "page", "source_sha256", "text", "retrieval_eligible"])
    clean = pages.where(F.col("retrieval_eligible").eqNullSafe(True)).withColumn("text", clean_redacted(F.col("text"))).where("text <> ''")
    clean = clean.withColumn("text_sha256", F.sha2("text", 256)).withColumn("language", page_language(F.col("text")))
    return clean.withColumn("page_id", stable_id(F.col("source_sha256"), F.col("page"), F.col("text_sha256"), F.lit(version)))


def document_catalogue(pages: DataFrame, file_name: str = "file_name") -> DataFrame:
    """One row per document: page counts, first values by page, type and full text hash."""
    require_unique(pages, ["document_id", "page"])
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page", "text"))), lambda x: x["text"]), "\n\n")
    rolled = pages.groupBy("document_id").agg(F.count("*").alias("pages"), F.min_by(file_name, "page").alias(file_name), F.min_by("language", "page").alias("language"), text.alias("full_text"))
    kind, basis = document_type(F.col(file_name), F.col("full_text"))
    return rolled.select("document_id", "pages", file_name, "language", kind.alias("document_type"), basis.alias("type_basis"), F.sha2("full_text", 256).alias("text_sha256"))


def chunk_table(pages: DataFrame, rules: ChunkRules = ChunkRules(), version: str = "v1") -> DataFrame:
    """Chunks of canonical pages with offsets, stable ids and the number of equal chunks."""
    each = pages.select("document_id", "page_id", F.posexplode(chunks(F.col("text"), rules)).alias("chunk_index", "c"))
    named = each.select("document_id", "page_id", "chunk_index", "c.start", "c.end", F.col("c.text").alias("text")).withColumn("text_sha256", F.sha2("text", 256))
    named = named.withColumn("chunk_id", stable_id(F.col("page_id"), F.col("start"), F.col("end"), F.col("text_sha256"), F.lit(version)))
    sizes = named.groupBy("text_sha256").agg(F.count("*").alias("duplicate_count"))
    return forbid_columns(named.join(sizes, "text_sha256"), ["text_raw"])


def reference_catalogue(links: DataFrame, targets: DataFrame, master: DataFrame, available: DataFrame) -> DataFrame:
    """Links joined to their targets and master rows; an unknown target is its own document."""
    t = targets.select("target_file_id", F.nullif("resolved_file_id", F.lit("")).alias("_resolved"), "snapshot_status")
    j = links.join(t, "target_file_id", "left").withColumn("canonical_document_id", F.coalesce("_resolved", "target_file_id")).withColumn("snapshot_status", F.coalesce("snapshot_status", F.lit("UNKNOWN")))
    have = available.select(F.col("document_id").alias("canonical_document_id"), F.lit(True).alias("_have")).distinct()
    j = j.join(have, "canonical_document_id", "left").withColumn("evidence_available", F.coalesce("_have", F.lit(False)))
    j = j.withColumn("reference_id", stable_id(F.col("sheet"), F.col("row_number"), F.col("target_file_id")))
    return j.join(master, "row_number", "left").drop("_resolved", "_have")


def reference_metadata(references: DataFrame, fields: list[str]) -> DataFrame:
    """Per document: first-seen distinct values of each field in row order, and sorted row numbers and ids."""
    def listed(f):
        rows = F.sort_array(F.collect_list(F.struct("row_number", "reference_id", F.col(f).alias("v"))))
        return first_seen(F.filter(F.transform(rows, lambda x: F.trim(x["v"])), lambda v: v.isNotNull() & (v != ""))).alias(f)

    return references.groupBy("canonical_document_id").agg(*[listed(f) for f in fields], F.array_sort(F.collect_set("row_number")).alias("reference_rows"), F.array_sort(F.collect_set("reference_id")).alias("reference_ids"))


def document_records(pages: DataFrame, canonical: DataFrame, metadata: DataFrame, fields: list[str]) -> DataFrame:
    """One row per document of all its pages: counts, quality, type, language, and reference metadata as JSON.

    ``pages``: document_id, page, file_name, source_sha256, security_classification,
    retrieval_eligible. ``canonical``: its eligible pages with clean text. ``metadata``: of
    ``reference_metadata``; documents without a reference have empty lists.
    """
    counts = pages.groupBy("document_id").agg(
        F.min_by("file_name", "page").alias("file_name"),
        F.min_by("source_sha256", "page").alias("source_sha256"),
        F.min_by("security_classification", "page").alias("security_classification"),
        F.count("*").alias("page_count"),
        F.count_if(F.col("retrieval_eligible").eqNullSafe(True)).alias("eligible_page_count"),
    )
    texts = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page", "text"))), lambda x: x["text"]), "\n\n")
    d = counts.join(canonical.groupBy("document_id").agg(texts.alias("_text")), "document_id", "left").withColumn("_text", F.coalesce("_text", F.lit("")))
    kind, basis = document_type(F.col("file_name"), F.col("_text"))
    quality = F.when(F.col("eligible_page_count") == 0, "NO_ELIGIBLE_PAGES").when(F.col("eligible_page_count") < F.col("page_count"), "PARTIAL_PAGE_EXCLUSION").otherwise("PASS")
    d = d.withColumns({"document_type": kind, "document_type_rule": basis, "document_language": page_language(F.col("_text")), "text_sha256": F.sha2("_text", 256), "excluded_page_count": F.col("page_count") - F.col("eligible_page_count"), "retrieval_eligible": F.col("eligible_page_count") > 0, "data_quality_status": quality, "evidence_available": F.lit(True)})
    m = metadata.select(F.col("canonical_document_id").alias("document_id"), *[F.col(f).alias(f"_m_{f}") for f in fields], "reference_rows", "reference_ids")
    d = d.drop("_text").join(m, "document_id", "left")
    listed = {f"{f}_values_json": F.coalesce(F.to_json(f"_m_{f}"), F.lit("[]")) for f in fields} | {"reference_rows_json": F.coalesce(F.to_json("reference_rows"), F.lit("[]")), "reference_ids_json": F.coalesce(F.to_json("reference_ids"), F.lit("[]"))}
    return d.withColumns(listed).drop(*[f"_m_{f}" for f in fields], "reference_rows", "reference_ids")


def with_document(rows: DataFrame, documents: DataFrame, columns: list[str]) -> DataFrame:
    """Pages or chunks with attributes of their document; a row without a document is left out."""
    return rows.join(documents.select("document_id", *columns), "document_id")


def cited(pages: DataFrame, base: str) -> DataFrame:
    """Adds citation_label and citation_uri of pages (document_id, page, file_name)."""
    return pages.withColumns({"citation_label": citation_label(F.col("file_name"), F.col("page")), "citation_uri": citation_uri(F.col("document_id"), F.col("page"), base)})


def corpus_frames(pages: DataFrame, references: DataFrame, fields: list[str], base: str, rules: ChunkRules = ChunkRules()) -> dict[str, DataFrame]:
    """The tables of a corpus: pages, excluded_pages, documents, chunks, references, filter_values, statistics.

    ``pages``: document_id, page, file_name, source_sha256, security_classification, text,
    retrieval_eligible. ``references``: reference_id, row_number, canonical_document_id and ``fields``.
    """
    from .filters import facet_counts

    clean = cited(canonical_pages(pages), base)
    metadata = reference_metadata(references, fields)
    documents = document_records(pages, clean, metadata, fields)
    chunked = with_document(chunk_table(clean, rules), documents, ["file_name", "security_classification", "document_type", "document_language", "data_quality_status"])
    linked = evidence_status(references, documents)
    per_document = references.groupBy("canonical_document_id").agg(*[F.array_compact(F.collect_set(F.nullif(F.trim(F.col(f)), F.lit("")))).alias(f) for f in fields])
    values = facet_counts(per_document, [], fields)
    sizes = chunked.agg(F.count("*").alias("chunks"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chunk_characters"), F.bround(F.avg(F.length("text")), 2).alias("mean_chunk_characters"), F.max(F.length("text")).alias("longest_chunk"), F.count_if(F.col("duplicate_count") > 1).alias("duplicate_chunks"))
    page_counts = clean.agg(F.count("*").alias("pages"), F.count_distinct("language").alias("languages"))
    document_counts = documents.agg(F.count("*").alias("documents"), F.count_if("retrieval_eligible").alias("eligible_documents"))
    statistics = sizes.join(F.broadcast(page_counts)).join(F.broadcast(document_counts))  # one row each
    return {"pages": clean, "excluded_pages": pages.where(~F.col("retrieval_eligible").eqNullSafe(True)), "documents": documents, "chunks": chunked, "references": linked, "filter_values": values, "statistics": statistics}


def evidence_status(references: DataFrame, documents: DataFrame) -> DataFrame:
    q = documents.select(F.col("document_id").alias("canonical_document_id"), F.col("data_quality_status"))
    return references.join(q, "canonical_document_id", "left").withColumn("data_quality_status", F.coalesce("data_quality_status", F.lit("MISSING_EVIDENCE")))


def route_status(mime: Column, size: Column, allowed: list[str], most: int) -> Column:
    return F.when(~mime.isin(allowed), "SKIPPED:mime").when(size > most, "SKIPPED:size").otherwise("DOWNLOADED")


def error_class(code: Column, message: Column) -> Column:
    return F.when(code == 403, "DENIED").when(code == 404, "MISSING").otherwise(F.concat(F.lit("ERROR:"), F.substring(message, 1, 180)))


def external_use(classification: Column, approved: Column, redacted: Column) -> Column:
    """Whether a text may leave for an external service: public, or approved and redacted below confidential."""
    return F.when(classification == "PUBLIC", True).when(classification == "CONFIDENTIAL", False).otherwise(F.coalesce(approved & redacted, F.lit(False)))


def review_decisions(rows: DataFrame, decision: str, text: str, correction: str) -> DataFrame:
    """Rows as reviewed: rejected ones go, edits replace the text; open or unknown decisions are refused."""
    from .contracts import EngineError

    d = F.upper(F.trim(F.col(decision)))
    bad = rows.where(~F.coalesce(d.isin("APPROVE", "EDIT", "REJECT"), F.lit(False)) | ((d == "EDIT") & (F.coalesce(F.trim(F.col(correction)), F.lit("")) == "")))
    if not bad.isEmpty():
        raise EngineError("a decision is pending, unknown, or an edit has no text")
    return rows.where(d != "REJECT").withColumn(text, F.when(d == "EDIT", F.col(correction)).otherwise(F.col(text)))
