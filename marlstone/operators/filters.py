"""Predicates compiled from requests, audits of what they drop, and facet counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fold_key, folded
from ..functions.values import overlaps_years
from .contracts import EngineError, NotAuthorized

OPERATORS: dict[str, Callable[[Column, object], Column]] = {
    "eq": lambda c, v: c == v,
    "in": lambda c, v: c.isin(list(v)),
    "contains": lambda c, v: fold_key(c.cast("string")).contains(folded(v)),
    "lt": lambda c, v: c.try_cast("double") < float(v),
    "lte": lambda c, v: c.try_cast("double") <= float(v),
    "gt": lambda c, v: c.try_cast("double") > float(v),
    "gte": lambda c, v: c.try_cast("double") >= float(v),
    "is_true": lambda c, _: c.cast("boolean"),
    "is_false": lambda c, _: ~c.cast("boolean"),
}


def exclusion(field: str, operator: str, value=None) -> Column:
    if operator not in OPERATORS:
        raise EngineError(f"unknown operator {operator}")
    return F.coalesce(OPERATORS[operator](F.col(field), value), F.lit(False))


def any_of(column: str, values: list[str], many: bool = False) -> Column:
    """OR within a field: one of the values, by lower case; blank requests hold for every row."""
    wanted = sorted({v.strip().lower() for v in values if v and v.strip()})
    if not wanted:
        return F.lit(True)
    if many:
        return F.arrays_overlap(F.transform(F.col(column), lambda v: F.lower(v)), F.array(*map(F.lit, wanted)))
    return F.lower(F.col(column)).isin(wanted)


def compile_filters(fields: dict[str, str], request: dict[str, list[str]]) -> Column:
    """AND across fields. ``fields``: name to kind, 'one' or 'many'; unknown fields are refused."""
    out = F.lit(True)
    for name, values in request.items():
        if name not in fields:
            raise EngineError(f"unknown filter {name}")
        out = out & any_of(name, values, fields[name] == "many")
    return out


def filter_with_audit(df: DataFrame, allowed: Column, eligible: Column, hard: Column, excluded: Column, id_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows that pass authorization, eligibility, hard filters and exclusions, in this order, and one row of counts.

    With ``id_col`` the audit names what the exclusions took out, in ``excluded_ids``.
    """
    flags = df.withColumns({"_auth": F.coalesce(allowed, F.lit(False)), "_elig": F.coalesce(eligible, F.lit(False)), "_hard": F.coalesce(hard, F.lit(False)), "_excl": F.coalesce(excluded, F.lit(False))})
    passed = F.col("_auth") & F.col("_elig") & F.col("_hard") & ~F.col("_excl")
    dropped = F.col("_auth") & F.col("_elig") & F.col("_hard") & F.col("_excl")
    named = [F.array_sort(F.collect_set(F.when(dropped, F.col(id_col)))).alias("excluded_ids")] if id_col else []
    audit = flags.agg(
        F.count("*").alias("rows"),
        F.count_if(~F.col("_auth")).alias("unauthorized"),
        F.count_if(F.col("_auth") & ~F.col("_elig")).alias("ineligible"),
        F.count_if(F.col("_auth") & F.col("_elig") & ~F.col("_hard")).alias("filtered"),
        F.count_if(dropped).alias("excluded"),
        F.count_if(passed).alias("kept"),
        *named,
    )
    return flags.where(passed).drop("_auth", "_elig", "_hard", "_excl"), audit


# -- the reference contract --------------------------------------------------------------------

#: The fields that a reference can be filtered by, by how they compare.
TAG_FIELDS = ("technology_tags", "capability_tags", "engagement_tags")
CODE_FIELDS = ("country_code", "sector_code", "offering_code", "evidence_type", "project_status", "data_quality_status", "security_classification")
FOLDED_FIELDS = ("region", "subregion", "client_key")
OTHER_FIELDS = ("evidence_available", "evidence_min_strength", "year_from", "year_to")
CONTRACT_FIELDS = TAG_FIELDS + CODE_FIELDS + FOLDED_FIELDS + OTHER_FIELDS
#: Fixed value: the fields of proposals under their names in the contract.
CONTROL_FIELDS = {"country": "country_code", "sector": "sector_code", "offering": "offering_code", "client": "client_key", "year_after": "year_from", "year_before": "year_to", "attestation_available": "evidence_type"}


class ContractVocabulary:
    """Codes of countries, sectors and offerings, and the spellings that stand for them."""

    def __init__(self, aliases: dict[str, dict[str, str]] | None = None):
        """``aliases``: by field (country_code, sector_code, offering_code), spelling to code."""
        aliases = aliases or {}
        self.codes = {f: set(aliases.get(f, {}).values()) for f in ("country_code", "sector_code", "offering_code")}
        self.spelled = {f: {folded(a): c for a, c in aliases.get(f, {}).items()} for f in self.codes}

    def canonical(self, field: str, value):
        """A requested value as the contract holds it; an unknown country is blank, an unknown code UNKNOWN."""
        if field in self.codes:
            raw = str(value or "").upper()
            unknown = "" if field == "country_code" else "UNKNOWN"
            return raw if raw in self.codes[field] else self.spelled[field].get(folded(value), unknown)
        if field in FOLDED_FIELDS:
            return folded(value)
        return str(value or "").upper() if field in TAG_FIELDS + CODE_FIELDS else value


def contract_filter(field: str, requested, vocabulary: ContractVocabulary) -> Column:
    """References that meet one request: any of its values; an unknown field is refused."""
    if field == "year_from":
        return overlaps_years(F.col("year_start"), F.col("year_end"), int(requested), None)
    if field == "year_to":
        return overlaps_years(F.col("year_start"), F.col("year_end"), None, int(requested))
    if field == "evidence_available":
        return F.coalesce(F.col(field) == bool(requested), F.lit(False))
    if field == "evidence_min_strength":
        return F.coalesce(F.col("evidence_strength") >= float(requested), F.lit(False))
    if field not in CONTRACT_FIELDS:
        raise EngineError(f"unknown filter {field}")
    values = requested if isinstance(requested, list | tuple) else [requested]
    wanted = sorted({str(vocabulary.canonical(field, v)) for v in values if str("" if v is None else v).strip()})
    if field in TAG_FIELDS:
        held = F.transform(F.coalesce(F.col(field), F.array().cast("array<string>")), lambda t: F.upper(t))
        return F.arrays_overlap(held, F.array(*map(F.lit, wanted)).cast("array<string>")) if wanted else F.lit(False)
    compared = fold_key(F.col(field)) if field in FOLDED_FIELDS else F.col(field)
    return F.coalesce(compared.isin(wanted), F.lit(False))


def contract_exclusion(rule: dict, vocabulary: ContractVocabulary) -> Column:
    """References that an exclusion (field, operator, value) takes out."""
    operator = str(rule.get("operator") or "eq").lower()
    if operator in ("eq", "in"):
        return contract_filter(str(rule.get("field") or ""), rule.get("value"), vocabulary)
    return exclusion(rule["field"], operator, rule.get("value"))


def filter_contract(contract: DataFrame, allowed: list[str], hard: dict | None = None, exclusions: list[dict] | None = None, vocabulary: ContractVocabulary | None = None, for_shortlist: bool = True) -> tuple[DataFrame, DataFrame]:
    """(references, audit): authorized, eligible for a shortlist, through all hard filters and no exclusion.

    Without a class of authorization nothing is returned, but refused. Empty requests hold for all.
    """
    classes = sorted({str(c).upper() for c in allowed if str(c or "").strip()})
    if not classes:
        raise NotAuthorized("no authorization class given")
    vocabulary = vocabulary or ContractVocabulary()
    if unknown := sorted(set(hard or {}) - set(CONTRACT_FIELDS)):
        raise EngineError(f"unknown filters: {', '.join(unknown)}")
    met = F.lit(True)
    for field, requested in (hard or {}).items():
        if requested not in (None, "", []):
            met = met & contract_filter(field, requested, vocabulary)
    out = F.lit(False)
    for rule in exclusions or []:
        out = out | F.coalesce(contract_exclusion(rule, vocabulary), F.lit(False))
    eligible = F.col("base_shortlist_eligible").eqNullSafe(True) if for_shortlist else F.lit(True)
    return filter_with_audit(contract, F.upper("security_classification").isin(classes), eligible, met, out, "reference_id")


def folded_filters(proposals: list[dict]) -> dict:
    """One request of approved proposals: the latest start, the earliest end, else a value or a list of values."""
    out: dict = {}
    for p in proposals:
        field, value = p["field"], p["value"]
        if field not in out:
            out[field] = int(value) if field in ("year_from", "year_to", "year_after", "year_before") else value
        elif field in ("year_from", "year_after"):
            out[field] = max(out[field], int(value))
        elif field in ("year_to", "year_before"):
            out[field] = min(out[field], int(value))
        else:
            held = out[field] if isinstance(out[field], list) else [out[field]]
            if value not in held:
                out[field] = [*held, value]
    return out


def compile_controls(requirements: list[dict], proposals: list[dict], policy_patterns: list[str], vocabulary: ContractVocabulary | None = None) -> dict:
    """Approved requirements and proposals as requirements, hard filters, preferences and exclusions.

    Requirements whose text holds a policy pattern ask for evidence, not for content: they become
    an exclusion of references without evidence.
    """
    vocabulary = vocabulary or ContractVocabulary()
    content, policies = split_policies(requirements, policy_patterns)
    named = []
    for p in proposals:
        field = CONTROL_FIELDS.get(p["field"], p["field"])
        coded = field in ("country_code", "sector_code", "offering_code", "client_key")
        named.append({"field": field, "value": vocabulary.canonical(field, p["value"]) if coded else p["value"], "behavior": p["behavior"]})
    excluded = [{"field": p["field"], "operator": "eq", "value": p["value"]} for p in named if p["behavior"] == "EXCLUSION_CANDIDATE"]
    if policies:
        excluded.append({"field": "evidence_available", "operator": "is_false", "value": False})
    return {
        "requirements": content,
        "policy_requirements": policies,
        "hard_filters": folded_filters([p for p in named if p["behavior"] == "HARD_CANDIDATE"]),
        "soft_preferences": [(p["field"], p["value"]) for p in named if p["behavior"] in ("SOFT_PREFERENCE", "CONTEXT_ONLY")],
        "exclusions": excluded,
    }


def split_policies(requirements: list[dict], patterns: list[str]) -> tuple[list[dict], list[dict]]:
    """(content, policies) by whether the folded text holds a folded pattern."""
    found = [any(folded(p) in folded(r.get("text")) for p in patterns) for r in requirements]
    content = [r | {"kind": "CONTENT"} for r, policy in zip(requirements, found, strict=True) if not policy]
    return content, [r | {"kind": "ELIGIBILITY_POLICY", "policy": "SUPPORTING_EVIDENCE_REQUIRED"} for r, policy in zip(requirements, found, strict=True) if policy]


def is_policy(text: Column, patterns: list[str]) -> Column:
    """``split_policies`` as a condition on a table of requirements."""
    plain, out = fold_key(text), F.lit(False)
    for p in patterns:
        out = out | plain.contains(folded(p))
    return out


def facet_counts(df: DataFrame, one: list[str], many: list[str] = ()) -> DataFrame:
    """(facet, value, n) of scalar and array facets in one pass; blanks are left out."""
    pairs = [F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in one]
    each = F.array(*pairs) if pairs else F.array().cast("array<struct<facet:string,value:string>>")

    def named(facet: str) -> Column:
        values = F.coalesce(F.col(facet), F.array().cast("array<string>"))
        return F.transform(values, lambda v: F.struct(F.lit(facet).alias("facet"), v.alias("value")))

    each = F.concat(each, *map(named, many))
    out = df.select(F.explode(each).alias("f")).select("f.facet", "f.value").where("value IS NOT NULL AND trim(value) <> ''")
    return out.groupBy("facet", "value").agg(F.count("*").alias("n"))
