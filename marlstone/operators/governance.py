"""Policies, configuration gates, run states and packet validation."""

from __future__ import annotations

import json
import platform
import sys
from dataclasses import asdict, dataclass, field
from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fold_key, safe_file_name, squeeze, whole_words
from .contracts import EngineError

#: Fixed value: classes from open to closed.
CLASSIFICATIONS = ("PUBLIC", "INTERNAL", "RESTRICTED", "CONFIDENTIAL")


@dataclass(frozen=True)
class EngineConfig:
    """Settings of a run; weakened security or weights that don't sum to 1 are refused."""

    fusion_weights: tuple[float, float] = (0.5, 0.5)
    rrf_k: int = 60
    component_weights: dict = field(default_factory=lambda: {"relevance": 0.6, "coverage": 0.2, "evidence_quality": 0.1, "recency": 0.05, "soft_fit": 0.05})
    authorization_before_scoring: bool = True
    external_models: bool = False
    raw_text_output: bool = False
    chunk_most: int = 900
    chunk_overlap: int = 120

    def __post_init__(self):
        if not self.authorization_before_scoring or self.external_models or self.raw_text_output:
            raise EngineError("security settings may not be weakened")
        for weights in (self.fusion_weights, tuple(self.component_weights.values())):
            if abs(sum(weights) - 1) > 1e-9 or min(weights) < 0:
                raise EngineError("weights must be positive and sum to 1")
        if self.chunk_most <= self.chunk_overlap or self.rrf_k <= 0:
            raise EngineError("chunks must be longer than their overlap, and k positive")

    def digest(self) -> str:
        return sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()


def run_context(config: EngineConfig, run_id: str) -> dict:
    return {"run_id": run_id, "python": sys.version.split()[0], "platform": platform.system(), "config_sha256": config.digest()}


def checked_query(text: str, most: int = 4000) -> str:
    """A query without control characters, squeezed; blank or overlong ones are refused."""
    clean = " ".join("".join(c if c.isprintable() else " " for c in text or "").split())
    if not clean or len(clean) > most:
        raise EngineError("the query is blank or too long")
    return clean


def excluded_path(path: Column, terms: list[str]) -> Column:
    """The first term that occurs as whole words in the path, or null."""
    folded = fold_key(path)
    reason = F.when(F.lit(False), "")
    for t in terms:
        reason = reason.when(whole_words(folded, [t.lower()]), t)
    return reason


def follows_link(header: Column, blocked: list[str]) -> Column:
    return ~fold_key(header, "#").isin([b.lower() for b in blocked])


def resolve_one(files: DataFrame, name: Column, exact: str, word: str) -> DataFrame:
    """The file of an exact folded name, else the only one whose name holds a word; anything else is refused."""
    folded = files.withColumn("_n", fold_key(name))
    for found in (folded.where(F.col("_n") == exact.lower()), folded.where(whole_words(F.col("_n"), [word.lower()]))):
        n = found.limit(2).count()
        if n == 1:
            return found.drop("_n")
        if n > 1:
            break
    raise EngineError("no file, or more than one, fits")


def downloadable_name(file_id: Column, name: Column) -> Column:
    """The name a file is kept under: its id, then its own name made safe."""
    return F.concat(file_id, F.lit("__"), safe_file_name(name))


def expanded_links(links: DataFrame, listing: DataFrame) -> DataFrame:
    """Linked files, and the files directly in linked folders, each once: file_id, name, via.

    ``links``: target_id. ``listing``: parent, id, name, is_folder.
    """
    at = listing.select(F.col("id").alias("_id"), "name", "is_folder")
    found = links.select("target_id").distinct().join(at, F.col("target_id") == F.col("_id"))
    files = found.where("NOT is_folder").select(F.col("target_id").alias("file_id"), "name", F.lit("").alias("via"))
    held = listing.where("NOT is_folder").select(F.col("parent").alias("_parent"), F.col("id").alias("file_id"), F.col("name").alias("_name"))
    inside = found.where("is_folder").join(held, F.col("target_id") == F.col("_parent")).select("file_id", F.col("_name").alias("name"), F.col("target_id").alias("via"))
    return files.unionByName(inside).groupBy("file_id").agg(F.min_by(F.struct("name", "via"), "via").alias("x")).select("file_id", "x.name", "x.via")


@dataclass(frozen=True)
class ProjectPaths:
    """The folders of a project, all below one root."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name not in ("snapshots", "extracted", "canonical", "indexes", "analyses", "exports"):
            raise AttributeError(name)
        return f"{self.root.rstrip('/')}/data/{name}"


def dereferenced(items: DataFrame, root: str | None = None) -> DataFrame:
    """Items (id, target_id) with shortcuts replaced by what they point to, if that is known.

    The ``root`` of a source must be among the items, and a folder if they have ``is_folder``.
    """
    if root is not None:
        found = items.where(F.col("id") == root)
        if found.isEmpty() or ("is_folder" in items.columns and found.where("is_folder").isEmpty()):
            raise EngineError("the root of the source is missing, or no folder")
    target = items.select(F.col("id").alias("_t"))
    return items.join(target, F.col("target_id") == F.col("_t"), "left").withColumn("resolved_id", F.coalesce("_t", "id")).drop("_t")


def packet_issues(packet: DataFrame, key: str, grade: str, note: str, least: int, most: int, frozen: DataFrame | None = None) -> DataFrame:
    """(key, issue): missing or out-of-range grades, missing notes for the lowest grade, missing and repeated keys.

    With ``frozen``, the packet as it was sent out, rows that came or went are issues, too.
    """
    g = F.col(grade).try_cast("int")
    rows = packet.select(key, F.explode(F.array_compact(F.array(
        F.when(g.isNull(), "MISSING_GRADE"),
        F.when(~g.between(least, most), "GRADE_OUT_OF_RANGE"),
        F.when((g == least) & (F.coalesce(F.trim(note), F.lit("")) == ""), "NOTE_REQUIRED"),
        F.when(F.coalesce(F.trim(F.col(key).cast("string")), F.lit("")) == "", "MISSING_KEY"),
    ))).alias("issue"))
    if frozen is not None:
        here, there = packet.select(key).distinct(), frozen.select(key).distinct()
        rows = rows.unionByName(there.join(here, key, "left_anti").select(key, F.lit("ROW_REMOVED").alias("issue"))).unionByName(here.join(there, key, "left_anti").select(key, F.lit("ROW_ADDED").alias("issue")))
    repeated = packet.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key, F.lit("REPEATED_KEY").alias("issue"))
    return rows.unionByName(repeated)


def next_state(queries: int, frozen: str | None, current: str, labels: int, expected: int, adjudicated: int) -> str:
    """State of a human-gated evaluation; it moves by one step, and a changed intake after freezing is refused."""
    if frozen is None:
        return "AWAITING_LABELS" if queries else "AWAITING_INTAKE"
    if frozen != current:
        raise EngineError("the intake changed after it was frozen")
    if labels < 2 * expected:
        return "AWAITING_LABELS"
    return "COMPLETE" if adjudicated >= expected else "AWAITING_ADJUDICATION"


def retrieval_query(requirements: DataFrame, group: str, most: int = 1800) -> DataFrame:
    """One query text per group: requirements by class, then locator, a line each; those that don't fit are skipped.

    Every line counts one character more than its text.
    """
    rank = F.element_at(F.create_map(*[F.lit(x) for kv in {"MUST": 0, "SHOULD": 1, "PREFERRED": 2, "CONTEXT": 3}.items() for x in kv]), F.col("classification"))
    rows = requirements.groupBy(group).agg(F.sort_array(F.collect_list(F.struct(rank.alias("r"), "locator", squeeze(F.col("text")).alias("t")))).alias("rows"))

    def add(text, x):
        longer = F.when(text == "", x["t"]).otherwise(F.concat_ws("\n", text, x["t"]))
        return F.when(F.length(longer) + 1 <= most, longer).otherwise(text)

    return rows.select(group, F.aggregate("rows", F.lit(""), add).alias("query_text"))
