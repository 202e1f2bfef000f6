"""Expressions over years, arrays, JSON, hashes and vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import fold_key, folded

YEAR = r"\b((?:19|20)\d{2})\b"


def years(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(YEAR), F.lit(1)), lambda y: y.cast("int"))


def year_interval(text: Column, ongoing_tokens: list[str], first: int = 1990, last: int = 2035) -> dict[str, Column]:
    """year_start, year_end, ongoing, project_status of a free text; ongoing projects end in ``last``."""
    found = F.filter(years(text), lambda y: y.between(first, last))
    plain, ongoing = fold_key(text), F.lit(False)
    for t in ongoing_tokens:
        ongoing = ongoing | plain.contains(folded(t))
    return {
        "year_start": F.array_min(found),
        "year_end": F.when(ongoing, last).otherwise(F.array_max(found)),
        "ongoing": ongoing,
        "project_status": F.when(ongoing, "ONGOING").when(F.size(found) > 0, "COMPLETED").otherwise("UNKNOWN"),
    }


def year_bounds(text: Column, unknown: str) -> Column:
    """struct<first, last>: the first and last year of a text in its order, or a placeholder."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(YEAR), F.lit(1))
    return F.when(F.size(found) > 0, F.struct(F.get(found, 0).alias("first"), F.element_at(found, -1).alias("last"))).otherwise(F.struct(F.lit(unknown).alias("first"), F.lit(unknown).alias("last")))


def latest_recency(text: Column, reference_year: int) -> Column:
    """Recency of the latest year that a free text names."""
    return recency(F.array_max(years(text)), reference_year)


def recency(year_end: Column, reference_year: int) -> Column:
    age = reference_year - F.least(year_end, F.lit(reference_year))
    return F.when(year_end.isNull(), 0.25).otherwise(F.greatest(F.lit(0.0), 1 - age / 20.0))


def any_year(found: Column, after: int | None = None, before: int | None = None) -> Column:
    """Any year at or past a bound; inclusive, false without years."""
    out = F.lit(True)
    if after is not None:
        out = out & F.exists(found, lambda y: y >= after)
    if before is not None:
        out = out & F.exists(found, lambda y: y <= before)
    return out


def overlaps_years(start: Column, end: Column, year_from: int | None = None, year_to: int | None = None) -> Column:
    """Interval overlap; an unknown end or start fails the bound it is held against."""
    out = F.lit(True)
    if year_from is not None:
        out = out & F.coalesce(end >= year_from, F.lit(False))
    if year_to is not None:
        out = out & F.coalesce(start <= year_to, F.lit(False))
    return out


def first_seen(values: Column) -> Column:
    """Distinct by lower case, in order, first spelling kept."""
    keys = F.transform(values, lambda v: F.lower(v))
    return F.filter(values, lambda v, i: F.array_position(keys, F.lower(v)) == i + 1)


def json_values(text: Column) -> Column:
    """A JSON list of strings, or a bare value as a list of one; cleaned, distinct, no blanks."""
    listed = F.coalesce(F.from_json(text, "array<string>"), F.array(text))
    return first_seen(F.filter(F.transform(listed, lambda v: F.trim(F.regexp_replace(F.coalesce(v, F.lit("")), r"\s+", " "))), lambda v: v != ""))


def json_list(text: Column) -> Column:
    """The values of a JSON list as trimmed strings, blanks left out, repeats kept; a bare value is a list of one."""
    listed = F.coalesce(F.from_json(text, "array<string>"), F.array(text))
    return F.filter(F.transform(listed, lambda v: F.trim(F.coalesce(v, F.lit("")))), lambda v: v != "")


def holds_all(held: Column, needed: list[str]) -> Column:
    """Whether an array has all of some values."""
    return F.size(F.array_except(F.array(*map(F.lit, needed)), held)) == 0 if needed else F.lit(True)


def tags(text: Column, taxonomy: dict[str, list[str]]) -> Column:
    """Sorted tags with an alias anywhere in the text, both folded; the text is folded once."""
    rules = [(tag, [folded(a) for a in aliases]) for tag, aliases in sorted(taxonomy.items())]

    def held(plain: Column) -> Column:
        found = []
        for tag, aliases in rules:
            hit = F.lit(False)
            for a in aliases:
                hit = hit | plain.contains(a)
            found.append(F.when(hit, F.lit(tag)))
        return F.array_compact(F.array(*found))

    return F.get(F.transform(F.array(fold_key(text)), held), 0)


def truthy(value: Column) -> Column:
    return F.upper(F.trim(value)).isin("TRUE", "YES", "Y", "1")


def as_int(value: Column) -> Column:
    return F.coalesce(value.try_cast("double").cast("int"), F.lit(0))


def stable_id(*parts: Column, prefix: str = "", length: int = 64) -> Column:
    digest = F.substring(F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256), 1, length)
    return F.concat(F.lit(prefix), digest) if prefix else digest


def row_hash(*columns: str) -> Column:
    return F.sha2(F.to_json(F.struct(*sorted(columns))), 256)


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def is_unit(v: Column, tolerance: float = 2e-3) -> Column:
    return F.abs(F.sqrt(dot(v, v)) - 1) <= tolerance


def ink_ratio(histogram: Column, dark_below: int = 245) -> Column:
    total = F.aggregate(histogram, F.lit(0).cast("long"), lambda s, x: s + x)
    return F.aggregate(F.slice(histogram, 1, dark_below), F.lit(0).cast("long"), lambda s, x: s + x) / total
