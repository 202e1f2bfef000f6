"""Requirements and filter proposals from free text."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import BRIEF_RULES, brief_language, fold_wide, redact, squeeze, whole_words
from ..functions.values import stable_id, years
from .contracts import issue_rows

# Fixed values
BULLET = r"^\s*(?:[-*•▪◦‣]+|\d+[.)]|[A-Za-z][.)])\s*"
SENTENCE_END = r"(?<=[.!?؟;؛])\s+"
EXCLUSION_MARKERS = ("exclure", "exclu", "hors", "sauf", "sans", "exclude", "excluding", "without", "باستثناء", "بدون")
YEAR_EXPERIENCE_MARKERS = ("expérience", "reference", "référence", "projet", "experience", "project", "خبرة", "مشروع")
YEAR_AFTER_MARKERS = ("depuis", "après", "after", "since", "منذ", "بعد")
YEAR_BEFORE_MARKERS = ("avant", "before", "قبل")
SUPPORTED_FIELDS = ("country", "business_unit", "client", "sector", "service_nature", "offering", "project_year", "attestation_available", "document_type", "data_quality_status")
HARD_FIELDS = (*SUPPORTED_FIELDS, "year_before", "year_after")
NEVER_FILTER_FIELDS = ("project value", "team member", "personal data")
EMPTY_VALUES = ("oui", "non", "true", "false", "n a", "na")
VALUE_ALIASES = {"country": {"Tunisia": "Tunisie", "Tunis": "Tunisie", "تونس": "Tunisie", "Libya": "Libye", "ليبيا": "Libye", "Côte d Ivoire": "Côte d'Ivoire", "Ivory Coast": "Côte d'Ivoire"}}


def units(segments: DataFrame, locator: str, text: str, least: int = 12, long_line: int = 280) -> DataFrame:
    """(locator, unit, unit_text): bullets stripped, long lines cut into sentences, personal data masked."""
    lines = segments.select(F.col(locator).alias("locator"), F.posexplode(F.split(F.regexp_replace(F.col(text), "\r", "\n"), "\n")).alias("line_no", "line"))
    lines = lines.withColumn("line", F.trim(F.regexp_replace("line", BULLET, ""))).where("line <> ''")
    parts = F.when(F.length("line") > long_line, F.split("line", SENTENCE_END)).otherwise(F.array("line"))
    each = lines.select("locator", "line_no", F.posexplode(parts).alias("part_no", "part"))
    clean = each.withColumn("unit_text", squeeze(redact(F.col("part"), BRIEF_RULES)[0])).withColumn("folded", fold_wide(F.col("unit_text")))
    kept = clean.where(F.length("folded") >= least)
    place = Window.partitionBy("locator").orderBy("line_no", "part_no")
    return kept.select("locator", F.row_number().over(place).alias("unit"), "unit_text", "folded")


def classified(unit_rows: DataFrame, markers: dict[str, list[str]]) -> DataFrame:
    """Adds ``classification``: the first of MUST, SHOULD, PREFERRED whose marker occurs, else CONTEXT."""
    kind = F.when(F.lit(False), "")
    for label in ("MUST", "SHOULD", "PREFERRED"):
        kind = kind.when(whole_words(F.col("folded"), markers.get(label, [])), label)
    return unit_rows.withColumn("classification", kind.otherwise("CONTEXT"))


def requirements(segments: DataFrame, locator: str, text: str, markers: dict[str, list[str]]) -> DataFrame:
    """Distinct requirements, the first by (locator, unit) of equal folded texts, with a stable id."""
    rows = classified(units(segments, locator, text), markers)
    first = Window.partitionBy("folded").orderBy("locator", "unit")
    rows = rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    return rows.withColumn("requirement_id", stable_id(F.col("locator"), F.col("unit"), F.col("folded"), prefix="REQ-", length=12))


def word_key(text: Column) -> Column:
    """Lower-case runs of letters and digits, one space between them; accents stay."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _behavior(classification: Column, hard: Column) -> Column:
    soft = classification.isin("SHOULD", "PREFERRED")
    return F.when((classification == "MUST") & hard, "HARD_CANDIDATE").when(soft, "SOFT_PREFERENCE").otherwise("CONTEXT_ONLY")


def filter_proposals(reqs: DataFrame, values: DataFrame, text: str = "folded", key: Callable[[Column], Column] = fold_wide, aliases: dict[str, dict[str, str]] = VALUE_ALIASES, exclusion_markers: Sequence[str] = EXCLUSION_MARKERS, least_chars: int = 1, hard_fields: Sequence[str] | None = None) -> DataFrame:
    """(field, value, behavior, requirement_id): facet values that occur on word boundaries in a requirement.

    Values of any number of words are found by an equi-join on word n-grams of just the lengths
    that the values have, so no requirement meets every value. Values shorter than ``least_chars``
    in their compared form propose nothing. ``aliases`` (by field: alias to value) propose the
    value that they stand for. A requirement with an exclusion marker (words in compared form)
    proposes exclusions. Only ``hard_fields`` (all, if None) give hard candidates. ``key`` is the
    form in which texts, values and aliases are compared. Of equal proposals the first requirement
    by id stays.
    """
    keyed = values.select("field", "value", key(F.col("value")).alias("gram")).where(F.length("gram") >= least_chars)
    listed = [(f, a, v) for f, names in aliases.items() for a, v in names.items()]
    if listed:
        also = values.sparkSession.createDataFrame(listed, "field string, alias string, stands_for string")
        also = also.select("field", key(F.col("alias")).alias("other"), key(F.col("stands_for")).alias("gram"))
        keyed = keyed.unionByName(keyed.join(F.broadcast(also), ["field", "gram"]).select("field", "value", F.col("other").alias("gram")))  # a fixed list
    keyed = keyed.where("gram <> ''").distinct()
    lengths = keyed.agg(F.collect_set(F.size(F.split("gram", " "))).alias("lengths"))  # one row
    asked = reqs.select("requirement_id", "classification", key(F.col(text)).alias("said"))
    excluded = whole_words(F.col("said"), list(exclusion_markers))
    words = asked.select("requirement_id", "classification", excluded.alias("excluded"), F.split("said", " ").alias("w")).join(F.broadcast(lengths))
    each = words.select("requirement_id", "classification", "excluded", "w", F.explode("lengths").alias("n")).where(F.col("n") <= F.size("w"))
    slices = F.transform(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1), lambda i: F.array_join(F.slice("w", i, F.col("n")), " "))
    grams = each.select("requirement_id", "classification", "excluded", F.explode(F.array_distinct(slices)).alias("gram"))
    hard = F.lit(True) if hard_fields is None else F.col("field").isin(list(hard_fields))
    behavior = F.when(F.col("excluded"), "EXCLUSION_CANDIDATE").otherwise(_behavior(F.col("classification"), hard))
    found = grams.join(keyed, "gram").withColumn("behavior", behavior)
    return found.groupBy("field", "value", "behavior").agg(F.min("requirement_id").alias("requirement_id"))


def year_proposals(reqs: DataFrame, text: str = "text", hard_fields: Sequence[str] = HARD_FIELDS) -> DataFrame:
    """(field, value, behavior, requirement_id): years that a requirement on experience names, as ranges where it says so."""
    said = fold_wide(F.col(text))

    def marked(markers: Sequence[str]) -> Column:
        return whole_words(F.col("said"), [_wide(m) for m in markers])

    asked = reqs.select("requirement_id", "classification", said.alias("said"), F.array_distinct(years(F.col(text))).alias("years"))
    asked = asked.where(marked(YEAR_EXPERIENCE_MARKERS))
    field = F.when(marked(YEAR_AFTER_MARKERS), "year_after").when(marked(YEAR_BEFORE_MARKERS), "year_before").otherwise("project_year")
    each = asked.select("requirement_id", "classification", field.alias("field"), F.explode("years").alias("value")).withColumn("value", F.col("value").cast("string"))
    each = each.withColumn("behavior", _behavior(F.col("classification"), F.col("field").isin(list(hard_fields))))
    return each.groupBy("field", "value", "behavior").agg(F.min("requirement_id").alias("requirement_id"))


def _wide(value: str) -> str:
    """``fold_wide`` of a marker on the driver."""
    plain = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", value).casefold())
    return " ".join(re.sub(r"[^\w؀-ۿ]+", " ", "".join(c for c in plain if not unicodedata.combining(c))).split())


def all_proposals(reqs: DataFrame, values: DataFrame, text: str = "text") -> DataFrame:
    """Proposals of values and years with ids, as a person confirms them: filter_id, field, value, behavior, requirement_id, status.

    A value of project_year is left out where its requirement gives a range of years instead.
    """
    kept = values.where(F.col("field").isin(*SUPPORTED_FIELDS) & ~fold_wide(F.col("value")).isin(*EMPTY_VALUES))
    ranged = reqs.select("requirement_id", fold_wide(F.col(text)).alias("said"), (F.size(years(F.col(text))) > 0).alias("dated"))
    markers = [_wide(m) for m in (*YEAR_AFTER_MARKERS, *YEAR_BEFORE_MARKERS)]
    ranged = ranged.where(F.col("dated") & whole_words(F.col("said"), markers) & whole_words(F.col("said"), [_wide(m) for m in YEAR_EXPERIENCE_MARKERS])).select("requirement_id")
    markers = [_wide(m) for m in EXCLUSION_MARKERS]

    def proposed(part: DataFrame, of: DataFrame) -> DataFrame:
        return filter_proposals(part, of, text=text, exclusion_markers=markers, least_chars=3, hard_fields=HARD_FIELDS)

    plain = proposed(reqs, kept.where("field <> 'project_year'")).unionByName(proposed(reqs.join(ranged, "requirement_id", "left_anti"), kept.where("field = 'project_year'")))
    both = plain.unionByName(year_proposals(reqs, text)).groupBy("field", "value", "behavior").agg(F.min("requirement_id").alias("requirement_id"))
    identity = stable_id(F.col("requirement_id"), F.col("field"), fold_wide(F.col("value")), F.col("behavior"), prefix="FLT-", length=12)
    return both.select(identity.alias("filter_id"), "field", "value", "behavior", "requirement_id", F.lit(True).alias("visible_to_user"), F.lit(True).alias("requires_human_confirmation"), F.lit(False).alias("confirmed"), F.lit("PROPOSED").alias("status"))


def proposal_issues(proposals: DataFrame) -> DataFrame:
    """(filter_id, issue, severity) of proposals that a person could not confirm, or that nobody may make."""
    allowed = F.col("field").isin(*SUPPORTED_FIELDS, "year_before", "year_after")
    return issue_rows(proposals, "filter_id", {
        "UNSUPPORTED_FIELD": ("ERROR", ~allowed),
        "FORBIDDEN_FIELD": ("ERROR", fold_wide(F.col("field")).isin(*NEVER_FILTER_FIELDS)),
        "UNKNOWN_BEHAVIOR": ("ERROR", ~F.col("behavior").isin("HARD_CANDIDATE", "SOFT_PREFERENCE", "CONTEXT_ONLY", "EXCLUSION_CANDIDATE")),
        "HIDDEN": ("ERROR", ~(F.col("visible_to_user") & F.col("requires_human_confirmation"))),
        "SILENTLY_CONFIRMED": ("ERROR", F.col("confirmed") | (F.col("status") != "PROPOSED")),
    })


def analyze(segments: DataFrame, values: DataFrame, markers: dict[str, list[str]]) -> dict[str, DataFrame]:
    """Requirements, proposals and one row of facts of an opportunity's segments (locator, text).

    Nothing is applied: proposals wait for a person.
    """
    reqs = requirements(segments, "locator", "text", markers)
    proposals = all_proposals(reqs.select("requirement_id", "classification", F.col("unit_text").alias("text")), values)
    counts = reqs.agg(F.count("*").alias("requirements"), *[F.count_if(F.col("classification") == c).alias(c.lower()) for c in ("MUST", "SHOULD", "PREFERRED", "CONTEXT")])
    texts = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("locator", "text"))), lambda x: x["text"]), " ")
    whole = segments.agg(texts.alias("whole")).select(F.concat(F.lit("OPP-"), F.substring(F.sha2("whole", 256), 1, 16)).alias("opportunity_id"), brief_language(F.col("whole")).alias("language"))
    facts = counts.join(F.broadcast(whole)).withColumns({"business_filters_auto_applied": F.lit(0), "human_review_required": F.lit(True), "status": F.lit("READY_FOR_HUMAN_REVIEW")})
    return {"requirements": reqs, "proposals": proposals, "facts": facts}
