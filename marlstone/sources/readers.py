"""Sources: tables with explicit contracts, file inventories, links in markup."""

from __future__ import annotations

import json
import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import fold_key, folded, urls
from ..operators.contracts import EngineError


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings; nothing becomes null."""
    return spark.read.csv(path, header=True, inferSchema=False, escape='"', multiLine=True, nullValue="\x00", emptyValue="").na.fill("")


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_json_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path, multiLine=True)


def read_segments(spark: SparkSession, path: str, most_bytes: int = 20_000_000) -> DataFrame:
    """(locator, text) of text and Markdown files, whole; a larger file is refused."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{txt,md}").load(path)
    if found := files.where(F.col("length") > most_bytes).select("path").limit(1).collect():
        raise EngineError(f"larger than {most_bytes} bytes: {found[0].path}")
    return files.select(F.element_at(F.split("path", "/"), -1).alias("locator"), F.decode("content", "UTF-8").alias("text"))


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modificationTime, sha256) of a tree of files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", "modificationTime", F.sha2("content", 256).alias("sha256"))


def hyperlinks(pages: DataFrame, key: str, markup: str) -> DataFrame:
    """(key, target, channels): distinct link targets with the places they were found in, comma-joined."""
    attribute = F.regexp_extract_all(markup, F.lit(r"""(?i)href\s*=\s*["']([^"']+)["']"""), F.lit(1))
    both = F.concat(
        F.transform(attribute, lambda u: F.struct(u.alias("target"), F.lit("attribute").alias("channel"))),
        F.transform(urls(F.col(markup)), lambda u: F.struct(u.alias("target"), F.lit("text").alias("channel"))),
    )
    found = pages.select(key, F.explode(both).alias("x")).select(key, "x.target", "x.channel")
    return found.groupBy(key, "target").agg(F.array_join(F.sort_array(F.collect_set("channel")), ",").alias("channels"))


def header_row(rows: DataFrame, expected: list[str], first: int = 20, least: int = 3) -> DataFrame:
    """The row among the first ``first`` that holds most expected headers, if it holds ``least``. ``rows``: row_number, cells."""
    hits = F.size(F.filter("cells", lambda c: F.lower(F.trim(c)).isin([e.lower() for e in expected])))
    scored = rows.where(F.col("row_number") <= first).withColumn("score", hits).where(F.col("score") >= least)
    return scored.orderBy(F.desc("score"), "row_number").limit(1)


def expand_env(text: str) -> str:
    """``${NAME:-default}`` replaced from the environment."""
    return re.sub(r"\$\{(\w+)(?::-([^}]*))?\}", lambda m: os.environ.get(m[1], m[2] or ""), text)


def sheet_rows(rows: DataFrame, header: list[str], refuse_blank_headers: bool = False) -> DataFrame:
    """Cells (row_number, cells) below a header row as named columns; rows that are blank throughout are dropped.

    Cells under a blank header are left out, or refused.
    """
    names = [(h or "").strip() for h in header]
    if refuse_blank_headers and not all(names):
        raise EngineError("a header is blank")
    cells = [F.trim(F.coalesce(F.get("cells", i), F.lit(""))) for i in range(len(names))]
    blank = F.lit(True)
    for c in cells:
        blank = blank & (c == "")
    return rows.where(~blank).select("row_number", *[c.alias(n) for c, n in zip(cells, names, strict=True) if n])


def master_metadata(table: DataFrame, fields: dict[str, str], forbidden: list[str] = ()) -> DataFrame:
    """Only the allowed columns of a master sheet, found by folded header: ``fields`` is output name to header.

    Of equal headers the first counts. A missing header and a forbidden one are refused.
    """
    at: dict[str, str] = {}
    for c in table.columns:
        at.setdefault(folded(c, "#"), c)
    wanted = {name: folded(h, "#") for name, h in fields.items()}
    if missing := sorted(n for n, h in wanted.items() if h not in at):
        raise EngineError(f"missing headers: {', '.join(missing)}")
    if set(wanted.values()) & {folded(h, "#") for h in forbidden}:
        raise EngineError("a forbidden header is among the allowed ones")
    return table.select(*(c for c in ("row_number",) if c in table.columns), *[F.col(f"`{at[h]}`").alias(n) for n, h in wanted.items()])


def matching_sheet(names: list[str], wanted: str) -> str:
    """The sheet of a folded title, or the only one there is."""
    found = [n for n in names if folded(n) == folded(wanted)] or (names if len(names) == 1 else [])
    if len(found) != 1:
        raise EngineError(f"no sheet, or more than one, is called {wanted}")
    return found[0]


def load_config(path: str) -> dict:
    """A YAML or JSON file with ``${NAME:-default}`` replaced; YAML needs its library, JSON nothing."""
    with open(path, encoding="utf-8") as f:
        text = expand_env(f.read())
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as missing:
        raise EngineError("YAML files need the yaml library; JSON files are read without it") from missing
    return yaml.safe_load(text) or {}


def children(listing: DataFrame, folder: str) -> DataFrame:
    """Direct children of a folder in an inventory table (parent, id, name), by folded name, then id."""
    return listing.where(F.col("parent") == folder).orderBy(fold_key(F.col("name")), "id")
