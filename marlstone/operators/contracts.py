"""Runtime contracts of tables: what must and what must not be there."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class EngineError(RuntimeError):
    """A table or a request breaks a contract."""


class NotAuthorized(PermissionError):
    """No authorization class was given."""


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    if missing := sorted(set(columns) - set(df.columns)):
        raise EngineError(f"missing columns: {', '.join(missing)}")
    return df


def forbid_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    if found := sorted(set(columns) & set(df.columns)):
        raise EngineError(f"forbidden columns: {', '.join(found)}")
    return df


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    if not repeated_keys(df, keys).isEmpty():
        raise EngineError(f"rows repeat the key {', '.join(keys)}")
    return df


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def issue_rows(df: DataFrame, key: str, checks: dict[str, tuple[str, object]]) -> DataFrame:
    """(key, issue, severity) for each check whose condition holds; one pass over the table."""
    found = [F.when(condition, F.struct(F.lit(name).alias("issue"), F.lit(severity).alias("severity"))) for name, (severity, condition) in checks.items()]
    return df.select(key, F.explode(F.array_compact(F.array(*found))).alias("i")).select(key, "i.issue", "i.severity")


def same_keys(a: DataFrame, b: DataFrame, key: str) -> bool:
    """Whether two tables hold the same keys, each once in each: rows that belong together are joined, never counted off."""
    require_unique(a, [key])
    require_unique(b, [key])
    return a.join(b, key, "left_anti").isEmpty() and b.join(a, key, "left_anti").isEmpty()


def require_same_keys(tables: dict[str, DataFrame], key: str) -> None:
    """Refuses an index, vectors and chunks that do not cover the same rows."""
    (first_name, first), *others = tables.items()
    for name, table in others:
        if not same_keys(first, table, key):
            raise EngineError(f"{name} and {first_name} do not hold the same {key}")


def safe_target(path: str, root: str, forbidden: list[str] = ()) -> str:
    """The real path of a write target; one outside ``root`` or inside a forbidden folder is refused."""
    target, base = os.path.realpath(os.path.expanduser(path)), os.path.realpath(root)

    def within(folder: str) -> bool:
        return os.path.commonpath([target, os.path.realpath(folder)]) == os.path.realpath(folder)

    if not within(base) or any(within(f) for f in forbidden):
        raise EngineError(f"not a place to write to: {target}")
    return target
