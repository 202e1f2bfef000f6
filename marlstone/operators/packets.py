"""Review packets: the tables that people fill in, and the rules that a filled-in one must keep.

A rule is a row of data: a code, where it holds (a row, the table, or a key that may not repeat)
and an SQL condition or expression. A set of rules becomes one aggregate and one pass over the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.analysis import folded_form
from .contracts import EngineError
from .relational import blinded_order

#: What a rule's expression says: true for a bad row, true for a bad table, or what may not occur twice.
KINDS = ("row", "table", "unique", "folded")


@dataclass(frozen=True)
class Rule:
    """``expression`` is SQL over the packet's columns; of kind ``folded`` it is a text whose search form may not repeat."""

    code: str
    kind: str
    expression: str
    detail: str = ""

    def __post_init__(self):
        if self.kind not in KINDS:
            raise EngineError(f"unknown kind of rule {self.kind}")


def issues(packet: DataFrame, key: str, rules: list[Rule]) -> DataFrame:
    """(code, key, detail) of every rule that does not hold; a rule over the table has a null key.

    An expression that is null is not bad; rules say themselves what null means.
    """
    kind = "string"
    by = {k: [r for r in rules if r.kind == k] for k in KINDS}
    made: list[DataFrame] = []

    def named(r: Rule) -> list[Column]:
        return [F.lit(r.code).alias("code"), F.lit(r.detail).alias("detail")]

    if by["row"]:
        found = F.array_compact(F.array(*[F.when(F.expr(r.expression), F.struct(*named(r))) for r in by["row"]]))
        made.append(packet.select(F.col(key).cast(kind).alias("key"), F.inline(found)).select("code", "key", "detail"))
    if by["table"]:
        # the rows of the aggregate's array are as many as there are rules
        found = packet.agg(*[F.coalesce(F.expr(r.expression), F.lit(False)).alias(f"r{i}") for i, r in enumerate(by["table"])])
        listed = F.array_compact(F.array(*[F.when(F.col(f"r{i}"), F.struct(*named(r))) for i, r in enumerate(by["table"])]))
        made.append(found.select(F.inline(listed)).select("code", F.lit(None).cast(kind).alias("key"), "detail"))
    repeated = by["unique"] + by["folded"]
    if repeated:
        form = [F.struct(*named(r), (folded_form(F.expr(r.expression).cast("string")) if r.kind == "folded" else F.expr(r.expression).cast("string")).alias("value")) for r in repeated]
        each = packet.select(F.col(key).cast(kind).alias("key"), F.inline(F.array(*form))).where("value IS NOT NULL AND value <> ''")
        twice = each.groupBy("code", "value").agg(F.count("*").alias("n")).where("n > 1").drop("n")
        made.append(each.join(twice, ["code", "value"], "left_semi").select("code", "key", "detail"))
    out = made[0] if made else packet.limit(0).select(F.lit("").alias("code"), F.col(key).cast(kind).alias("key"), F.lit("").alias("detail"))
    for df in made[1:]:
        out = out.unionByName(df)
    return out


def same_rows(packet: DataFrame, sent: DataFrame, key: str, frozen: list[str]) -> DataFrame:
    """(code, key, detail): rows that came, went or came twice, and rows whose ``frozen`` columns are not as they were sent."""
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias(f"n_{name}"), F.min(F.hash(*frozen) if frozen else F.lit(0)).alias(f"h_{name}"))

    both = counted(packet, "here").join(counted(sent, "sent"), "key", "full")
    code = F.when(F.col("n_here").isNull(), "ROW_REMOVED").when(F.col("n_sent").isNull(), "ROW_ADDED").when(F.col("n_here") != F.col("n_sent"), "ROW_REPEATED").when(F.col("h_here") != F.col("h_sent"), "ROW_CHANGED")
    return both.select(code.alias("code"), "key", F.lit("").alias("detail")).where("code IS NOT NULL")


# -- what each packet must keep -------------------------------------------------------------------

#: The columns of an intake packet and the roles of its governance sheet.
INTAKE_COLUMNS = ("query_id", "query_text", "language", "business_context", "mandatory_filters_json", "query_type", "origin", "not_derived_from_reference_corpus", "approved_for_evaluation", "notes")
ROLES = ("evaluation_owner", "labeler_1_name", "labeler_2_name", "adjudicator_name", "supervisor_name")
#: Filters that a query may ask for.
QUERY_FILTERS = ("country", "business_unit", "client", "sector", "service_nature", "offering", "project_year", "attestation_available", "document_type", "data_quality_status", "year_before", "year_after")


@dataclass(frozen=True)
class IntakeBounds:
    count: int = 50
    least_characters: int = 20
    most_characters: int = 1800
    least_context: int = 10
    languages: tuple[tuple[str, int], ...] = (("fr", 1), ("en", 0), ("ar", 0))
    types: tuple[tuple[str, int], ...] = ()
    origins: tuple[str, ...] = ("REAL_OPPORTUNITY", "APPROVED_REALISTIC")
    prefix: str = "EXP-"


def _listed(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def intake_rules(b: IntakeBounds) -> list[Rule]:
    """The rules of an intake packet with the columns of ``INTAKE_COLUMNS`` and ``position`` (from 1)."""
    text = "regexp_replace(trim(coalesce(query_text, '')), '\\\\s+', ' ')"
    filters = "coalesce(nullif(trim(mandatory_filters_json), ''), '{}')"
    held = f"from_json({filters}, 'map<string,string>')"
    language, kind, origin = (f"{f}(trim(coalesce({c}, '')))" for f, c in (("lower", "language"), ("upper", "query_type"), ("upper", "origin")))
    return [
        Rule("QUERY_COUNT", "table", f"count(*) <> {b.count}", f"exactly {b.count} queries"),
        Rule("QUERY_IDS", "row", f"coalesce(query_id, '') <> concat('{b.prefix}', lpad(position, 3, '0'))", "ids stay in their order"),
        Rule("QUERY_SHORT", "row", f"length({text}) < {b.least_characters}"),
        Rule("QUERY_LONG", "row", f"length({text}) > {b.most_characters}"),
        Rule("QUERY_REPEATED", "folded", text),
        Rule("CONTEXT_SHORT", "row", f"length(trim(coalesce(business_context, ''))) < {b.least_context}"),
        Rule("LANGUAGE", "row", f"{language} NOT IN ({_listed(x for x, _ in b.languages)})"),
        *[Rule("LANGUAGE_MINIMUM", "table", f"count_if({language} = '{x}') < {n}", f"{x}: {n}") for x, n in b.languages],
        Rule("QUERY_TYPE", "row", f"{kind} NOT IN ({_listed(['STANDARD', *(x for x, _ in b.types)])})"),
        *[Rule("QUERY_TYPE_MINIMUM", "table", f"count_if({kind} = '{x}') < {n}", f"{x}: {n}") for x, n in b.types],
        Rule("ORIGIN", "row", f"{origin} NOT IN ({_listed(b.origins)})"),
        Rule("DERIVED", "row", "upper(coalesce(not_derived_from_reference_corpus, '')) <> 'YES'"),
        Rule("NOT_APPROVED", "row", "upper(coalesce(approved_for_evaluation, '')) <> 'YES'"),
        Rule("FILTERS_INVALID", "row", f"left({filters}, 1) <> '{{' OR {held} IS NULL"),
        Rule("FILTER_UNKNOWN", "row", f"exists(map_keys({held}), k -> k NOT IN ({_listed(QUERY_FILTERS)}))"),
    ]


def governance_rules() -> list[Rule]:
    """The rules of a governance sheet: role, name, confirmed. Every role is named and confirmed, and people are apart."""
    def name(role: str) -> str:
        return f"max(trim(name)) FILTER (WHERE trim(role) = '{role}')"

    first, second, judge = (name(r) for r in ROLES[1:4])
    each = [
        rule
        for r in ROLES
        for rule in (
            Rule("ROLE_UNNAMED", "table", f"count_if(trim(role) = '{r}' AND trim(coalesce(name, '')) <> '') = 0", r),
            Rule("ROLE_UNCONFIRMED", "table", f"count_if(trim(role) = '{r}' AND upper(trim(coalesce(confirmed, ''))) = 'YES') = 0", r),
        )
    ]
    return [*each, Rule("LABELERS_SAME", "table", f"{first} = {second}"), Rule("ADJUDICATOR_NOT_INDEPENDENT", "table", f"{judge} IN ({first}, {second})")]


def grade_rules(grade: str, note: str, grades: tuple[int, ...] = (0, 1, 2), note_for: int = 0, categories: tuple[str, ...] | None = None) -> list[Rule]:
    """Every row has one of ``grades``; rows of grade ``note_for`` say why, in one of ``categories`` where these are given."""
    value, said = f"try_cast(trim({grade}) AS double)", f"trim(coalesce({note}, ''))"
    rules = [Rule("GRADE", "row", f"coalesce({value} NOT IN ({', '.join(map(str, grades))}), true)"), Rule("NOTE_MISSING", "row", f"{value} = {note_for} AND {said} = ''")]
    if categories:
        rules.append(Rule("CATEGORY", "row", f"{said} <> '' AND {said} NOT IN ({_listed(categories)})"))
    return rules


def adjudication_rules(first: str = "labeler_1_relevance", second: str = "labeler_2_relevance", grade: str = "adjudicated_relevance", note: str = "adjudication_notes") -> list[Rule]:
    """Every row has a grade, and a disagreement has a rationale."""
    return [grade_rules(grade, note)[0], Rule("RATIONALE_MISSING", "row", f"NOT ({first} <=> {second}) AND trim(coalesce({note}, '')) = ''")]


def citation_rules() -> list[Rule]:
    return grade_rules("citation_correct_0_1", "citation_issue_notes", (0, 1))


# -- the packets themselves -----------------------------------------------------------------------


def intake_packet(spark, b: IntakeBounds = IntakeBounds()) -> DataFrame:
    """An empty intake packet: ``INTAKE_COLUMNS`` and position, a row for each query."""
    ids = spark.range(1, b.count + 1).select(F.col("id").cast("int").alias("position"))
    blank = {c: F.lit("") for c in INTAKE_COLUMNS[1:]} | {"query_id": F.concat(F.lit(b.prefix), F.lpad(F.col("position").cast("string"), 3, "0")), "mandatory_filters_json": F.lit("{}"), "not_derived_from_reference_corpus": F.lit("NO"), "approved_for_evaluation": F.lit("NO")}
    return ids.select("position", *[blank[c].alias(c) for c in INTAKE_COLUMNS])


def label_packet(pool: DataFrame, labeler: int, seed: str = "pool") -> DataFrame:
    """The pool (query_id, candidate_id, and what is shown) in the labeler's own blinded order, with columns to fill in."""
    shown = pool.drop("mode", "modes", "rank", "score", "position", "relevance", "notes")
    ordered = blinded_order(shown, "query_id", "candidate_id", f"{seed}|labeler-{labeler}")
    return ordered.withColumns({"relevance_0_1_2": F.lit(""), "failure_category": F.lit(""), "evidence_notes": F.lit("")})


def adjudication_packet(pairs: DataFrame, pool: DataFrame) -> DataFrame:
    """Both labelers' grades of every candidate beside what they saw; agreed grades are filled in, others are open.

    ``pairs``: query_id, candidate_id, relevance_1, relevance_2, agreement.
    """
    shown = pool.drop("mode", "modes", "rank", "score", "position", "relevance", "notes")
    agreed = F.when(F.col("agreement"), F.col("relevance_1").cast("string")).otherwise("")
    rows = pairs.select("query_id", "candidate_id", F.col("relevance_1").cast("string").alias("labeler_1_relevance"), F.col("relevance_2").cast("string").alias("labeler_2_relevance"), agreed.alias("adjudicated_relevance"), F.lit("").alias("adjudication_notes"))
    return rows.join(shown, ["query_id", "candidate_id"])


def _validated(name: str, found: DataFrame, most: int = 50) -> list[str]:
    rows = found.groupBy("code", "detail").agg(F.count("*").alias("n"), F.min("key").alias("first")).orderBy("code", "detail").limit(most + 1).collect()
    lines = [f"{r.code}{f' ({r.detail})' if r.detail else ''}: {r.n}" + (f", first {r.first}" if r.first else "") for r in rows[:most]]
    return [f"# {name}", "", *([f"- {x}" for x in lines] or ["- No issues."]), *(["- More kinds of issues are not shown."] if len(rows) > most else [])]


def validation_report(name: str, found: DataFrame) -> str:
    """The issues by code as Markdown."""
    return "\n".join(_validated(name, found)) + "\n"
