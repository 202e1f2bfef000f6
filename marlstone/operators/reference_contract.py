"""Normalized references: codes, years, tags, evidence strength, duplicates, and what is wrong with them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fold_key, folded
from ..functions.values import tags, year_interval
from .contracts import EngineError, issue_rows, require_columns
from .evaluation import status_counts


#: Rows of a part of a sheet, within which display numbers are counted.
PART_ROWS = 100_000


@dataclass(frozen=True)
class Normalization:
    """Spellings, codes, taxonomies and strengths that references are normalized by; small dictionaries."""

    country_aliases: dict[str, str] = field(default_factory=dict)  # spelling to code
    countries: dict[str, dict[str, str]] = field(default_factory=dict)  # code to name, region, subregion
    sector_aliases: dict[str, str] = field(default_factory=dict)
    offering_aliases: dict[str, str] = field(default_factory=dict)
    evidence_types: dict[str, str] = field(default_factory=dict)
    evidence_strength: dict[str, float] = field(default_factory=lambda: {"OTHER": 0.0})
    capability_taxonomy: dict[str, list[str]] = field(default_factory=dict)
    technology_taxonomy: dict[str, list[str]] = field(default_factory=dict)
    engagement_taxonomy: dict[str, list[str]] = field(default_factory=dict)
    ongoing: tuple[str, ...] = ()
    first_year: int = 1990
    last_year: int = 2035
    security_classification: str = "INTERNAL"
    allowed_quality: tuple[str, ...] = ("PASS", "PARTIAL_PAGE_EXCLUSION")


def mapped(key: Column, names: dict, default) -> Column:
    """A value by name; ``default`` for names that are not listed."""
    if not names:
        return F.lit(default)
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), key), F.lit(default))


def build_contract(references: DataFrame, documents: DataFrame, by: Normalization) -> DataFrame:
    """One normalized row per reference, those of missing or unusable evidence too.

    ``references``: reference_id, reference_number, sheet, row_number, canonical_document_id, client,
    country, sector, offering, service_nature, project_year, attestation_available,
    evidence_available, document_retrieval_eligible, data_quality_status. ``documents``:
    document_id, file_name, source_sha256, document_type, document_language,
    security_classification, retrieval_eligible. References that rest on one document are one
    duplicate group; without a document those of one client, years, offering and service are.
    """
    blank = F.lit("")
    text = {c: F.coalesce(F.col(c).cast("string"), blank) for c in ("reference_id", "canonical_document_id", "client", "country", "sector", "offering", "service_nature", "project_year", "attestation_available", "data_quality_status")}
    d = documents.select(F.col("document_id").alias("_document"), "file_name", "source_sha256", "document_type", "document_language", "security_classification", F.col("retrieval_eligible").alias("_catalogued"))
    r = references.withColumns(text).join(d, F.col("canonical_document_id") == F.col("_document"), "left").withColumn("has_document", F.col("_document").isNotNull())
    r = placed = _in_parts(r, references)
    r = r.withColumns({c: F.coalesce(c, blank) for c in ("file_name", "source_sha256", "document_type", "document_language")} | {"security_classification": F.coalesce("security_classification", F.lit(by.security_classification))})

    def spelled(column: str, names: dict[str, str], default: str) -> Column:
        return mapped(fold_key(F.col(column)), {folded(k): v for k, v in names.items()}, default)

    r = r.withColumns({"country_code": spelled("country", by.country_aliases, ""), "sector_code": spelled("sector", by.sector_aliases, "UNKNOWN"), "offering_code": spelled("offering", by.offering_aliases, "UNKNOWN"), "evidence_type": spelled("attestation_available", by.evidence_types, "OTHER"), "client_key": fold_key(F.col("client"))})
    places = {f"{'country_' if k == 'name' else ''}{k}": mapped(F.col("country_code"), {c: m.get(k) or "" for c, m in by.countries.items()}, "") for k in ("name", "region", "subregion")}
    r = r.withColumns(places).withColumns(year_interval(F.col("project_year"), list(by.ongoing), by.first_year, by.last_year))
    said = F.concat_ws(" | ", "service_nature", "offering", "sector", "client")
    r = r.withColumns({"capability_tags": tags(said, by.capability_taxonomy), "technology_tags": tags(said, by.technology_taxonomy), "engagement_tags": tags(said, by.engagement_taxonomy)})
    r = r.withColumn("evidence_strength", mapped(F.col("evidence_type"), by.evidence_strength, float(by.evidence_strength["OTHER"])))
    years = [F.coalesce(F.col(c).cast("string"), blank) for c in ("year_start", "year_end")]
    alone = F.concat(F.lit("metadata:"), F.concat_ws("|", "client_key", *years, "offering_code", fold_key(F.col("service_nature"))))
    signature = F.when(F.col("canonical_document_id") != "", F.concat(F.lit("document:"), "canonical_document_id")).otherwise(alone)
    r = r.withColumn("duplicate_signature", signature).withColumn("duplicate_group_id", F.substring(F.sha2("duplicate_signature", 256), 1, 16))
    sizes = r.groupBy("duplicate_group_id").agg(F.count("*").cast("int").alias("duplicate_group_size"))
    r = r.join(sizes, "duplicate_group_id")
    checks = [F.col("reference_id") != "", F.col("evidence_available"), F.col("document_retrieval_eligible"), F.col("_catalogued"), F.col("data_quality_status").isin(list(by.allowed_quality)), F.col("source_sha256").rlike("^[0-9a-f]{64}$")]
    eligible = F.lit(True)
    for c in checks:
        eligible = eligible & F.coalesce(c, F.lit(False))
    r = r.withColumn("base_shortlist_eligible", eligible).drop("_document", "_catalogued")
    # display numbers run over all sheets: a row's place in its part of its sheet, after the rows of the parts before
    here = Window.partitionBy("sheet", "_part").orderBy("row_number", "reference_id")
    counts = placed.groupBy("sheet", "_part").agg(F.count("*").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(Window.partitionBy(F.lit(0)).orderBy("sheet", "_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a part
    starts = counts.select(F.col("sheet").alias("_sheet"), F.col("_part").alias("_of"), before.alias("_before"))
    r = r.withColumn("_place", F.row_number().over(here)).join(F.broadcast(starts), F.col("sheet").eqNullSafe(F.col("_sheet")) & F.col("_part").eqNullSafe(F.col("_of")))
    return r.withColumn("display_reference_id", F.format_string("REF-%04d", F.col("_before") + F.col("_place"))).drop("_place", "_sheet", "_before", "_part", "_of")


def _in_parts(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Adds ``_part``: rising with the row's number in its sheet, about ``PART_ROWS`` rows each where numbers lie evenly; null of a null number."""
    number = F.col("row_number").cast("double")
    spans = sizes.groupBy("sheet").agg(F.min(number).alias("_least"), F.max(number).alias("_most"), F.ceil(F.count("*") / PART_ROWS).alias("_parts")).withColumnRenamed("sheet", "_sheet")  # one row a sheet
    part = F.floor((number - F.col("_least")) * F.col("_parts") / (F.col("_most") - F.col("_least") + 1))
    return rows.join(F.broadcast(spans), F.col("sheet").eqNullSafe(F.col("_sheet"))).withColumn("_part", part).drop("_sheet", "_least", "_most", "_parts")


def data_quality_issues(contract: DataFrame) -> DataFrame:
    """(reference_id, issue, severity) of everything that keeps a reference from being relied on."""
    return issue_rows(contract, "reference_id", {
        "MISSING_REFERENCE_ID": ("BLOCKER", F.col("reference_id") == ""),
        "INVALID_SOURCE_REFERENCE_NUMBER": ("WARNING", F.coalesce(F.col("reference_number").startswith("#"), F.lit(False))),
        "UNMAPPED_COUNTRY": ("ERROR", (F.col("country") != "") & (F.col("country_code") == "")),
        "UNPARSEABLE_PROJECT_YEAR": ("ERROR", (F.col("project_year") != "") & F.col("year_start").isNull()),
        "MISSING_PROJECT_YEAR": ("WARNING", F.col("project_year") == ""),
        "MISSING_SUPPORTING_EVIDENCE": ("WARNING", ~F.coalesce("evidence_available", F.lit(False))),
        "MISSING_CANONICAL_DOCUMENT": ("ERROR", ~F.col("has_document")),
    })


def audited_requirements(shortlist: DataFrame, coverage: DataFrame, roles: dict[str, str] | None = None) -> DataFrame:
    """(reference_id, code, classification, requirement_text) of the covered requirements that name a reference's client.

    ``shortlist``: reference_id, client, role. ``coverage``: code, classification, requirement_text,
    audit_status, supporting_clients (names between bars). ``roles``: requirements that count only
    for references of a role, where a client has several.
    """
    named = coverage.where(F.trim("audit_status") == "COVERED").withColumn("client_name", F.explode(F.array_distinct(F.transform(F.split("supporting_clients", r"\|"), lambda c: F.trim(c)))))
    rows = shortlist.withColumn("client_name", F.trim("client")).join(named.where("client_name <> ''").select("client_name", "code", "classification", "requirement_text"), "client_name")
    several = shortlist.groupBy(F.trim("client").alias("client_name")).agg(F.count_distinct("role").alias("roles"))
    needed = mapped(F.col("code"), roles or {}, "")
    rows = rows.join(several, "client_name").where((needed == "") | (F.col("roles") == 1) | (F.trim("role") == needed))
    return rows.select("reference_id", "code", "classification", "requirement_text").distinct()


def audited_case(coverage: DataFrame, adjudication: DataFrame, expected: dict[str, int], gaps: list[str]) -> dict:
    """Counts of an audited case; any that differs from what was signed off is refused.

    ``expected``: must_total, must_covered, should_total, should_covered, total, SUPPORTED, PARTIAL,
    UNSUPPORTED. ``gaps``: the codes that are known to be open.
    """
    status, kind = F.trim("audit_status"), F.trim("classification")
    one = coverage.agg(*[F.count_if((kind == c) & (status.isin(*s) if s else F.lit(True))).alias(n) for n, c, s in (("must_total", "MUST", ()), ("must_covered", "MUST", ("COVERED",)), ("should_total", "SHOULD", ()), ("should_covered", "SHOULD", ("COVERED",)))], F.array_sort(F.collect_set(F.when(status == "GAP", F.col("code")))).alias("gaps")).first().asDict()
    found = one | status_counts(adjudication, "audit_status", ["SUPPORTED", "PARTIAL", "UNSUPPORTED"]).first().asDict()
    changed = sorted(k for k, v in expected.items() if found.get(k) != v)
    if changed or found["gaps"] != sorted(gaps):
        raise EngineError(f"the audited case changed: {', '.join(changed) or 'gaps'}")
    return found


def coded(df: DataFrame, column: str, aliases: DataFrame, name: str, unknown: str = "UNKNOWN") -> DataFrame:
    """Adds ``name``: the code whose folded alias equals the folded value. ``aliases``: alias, code."""
    keyed = aliases.select(fold_key(F.col("alias")).alias("_alias"), F.col("code").alias(name)).dropDuplicates(["_alias"])
    return df.withColumn("_key", fold_key(F.col(column))).join(keyed, F.col("_key") == F.col("_alias"), "left").withColumn(name, F.coalesce(name, F.lit(unknown))).drop("_key", "_alias")


def reference_contract(references: DataFrame, documents: DataFrame, countries: DataFrame, sectors: DataFrame, taxonomy: dict[str, list[str]], strengths: dict[str, float], ongoing: list[str]) -> DataFrame:
    """One normalized row per reference.

    ``references``: reference_id, client, country, sector, project_year, document_id, service.
    ``documents``: document_id, document_type, source_sha256, retrieval_eligible.
    """
    require_columns(references, ["reference_id", "client", "country", "sector", "project_year", "document_id", "service"])
    r = coded(coded(references, "country", countries, "country_code", ""), "sector", sectors, "sector_code")
    r = r.withColumns(year_interval(F.col("project_year"), ongoing)).withColumn("capability_tags", tags(F.col("service"), taxonomy)).withColumn("client_key", fold_key(F.col("client")))
    r = r.join(documents, "document_id", "left")
    strength = F.try_element_at(F.create_map(*[F.lit(x) for kv in strengths.items() for x in kv]), F.col("document_type"))
    r = r.withColumn("evidence_strength", F.coalesce(strength, F.lit(0.0)))
    r = r.withColumn("duplicate_group_id", F.substring(F.sha2(F.concat_ws("|", "client_key", "country_code", F.coalesce("document_id", "reference_id")), 256), 1, 16))
    r = r.withColumn("duplicate_group_size", F.count("*").over(Window.partitionBy("duplicate_group_id")))
    return r.withColumn("base_shortlist_eligible", base_eligible())


def base_eligible() -> Column:
    checks = [F.col("retrieval_eligible"), F.col("source_sha256").rlike("^[0-9a-f]{64}$"), F.col("client_key") != "", F.col("country_code") != "", F.col("sector_code") != "UNKNOWN", F.col("evidence_strength") > 0]
    out = F.lit(True)
    for c in checks:
        out = out & F.coalesce(c, F.lit(False))
    return out


def contract_issues(contract: DataFrame) -> DataFrame:
    return issue_rows(contract, "reference_id", {
        "UNKNOWN_COUNTRY": ("WARNING", F.col("country_code") == ""),
        "UNKNOWN_SECTOR": ("WARNING", F.col("sector_code") == "UNKNOWN"),
        "UNKNOWN_YEARS": ("INFO", F.col("project_status") == "UNKNOWN"),
        "SPREADSHEET_ERROR": ("ERROR", F.col("client").rlike(r"^#(?:VALUE|REF|N/A|NAME|DIV/0)")),
        "MISSING_EVIDENCE": ("ERROR", F.col("retrieval_eligible").isNull()),
    })


def eligible_references(contract: DataFrame, rule: Column) -> DataFrame:
    """Second gate on the reference's own values: a document that serves several references opens none of the others."""
    return contract.where(F.coalesce(rule, F.lit(False)) & F.col("base_shortlist_eligible")).select("reference_id")


def portfolio_coverage(grid: DataFrame, chosen: DataFrame) -> DataFrame:
    """(requirement_id, supporting, reference_ids) over the chosen references only."""
    rows = grid.join(chosen.select("reference_id"), "reference_id", "left_semi")
    hit = F.when(F.col("covered"), F.col("reference_id"))
    return rows.groupBy("requirement_id").agg(F.count_distinct(hit).alias("supporting"), F.array_sort(F.collect_set(hit)).alias("reference_ids"))


def scoring_status(criteria: DataFrame, rules: DataFrame) -> DataFrame:
    """Evidence status of each criterion from the rules it names; it never awards points."""
    j = criteria.join(rules, "code", "left")
    return j.groupBy("criterion").agg(F.when(F.count("met") == 0, "NO_RULE").when(F.every("met"), "EVIDENCE_COMPLETE").otherwise("EVIDENCE_PARTIAL").alias("status"))
