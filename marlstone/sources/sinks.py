"""Sinks: Parquet, JSON lines, spreadsheet-safe CSV, and run manifests with logical hashes."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType

from ..functions.text import safe_cell
from ..functions.values import is_unit
from ..operators.contracts import EngineError
from ..operators.relational import logical_hash


def write_parquet(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    (df.write.partitionBy(*partition_by) if partition_by else df.write).mode("overwrite").parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.select(*sorted(df.columns)).write.mode("overwrite").json(path)


def flat(df: DataFrame) -> DataFrame:
    """Columns in order of name, nested ones as JSON, strings safe for spreadsheets."""
    out = []
    for f in sorted(df.schema.fields, key=lambda f: f.name):
        c = F.col(f.name)
        if isinstance(f.dataType, ArrayType | MapType | StructType):
            c = F.to_json(c)
        elif isinstance(f.dataType, StringType):
            c = safe_cell(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str) -> None:
    flat(df).write.mode("overwrite").csv(path, header=True, escape='"')


def append_missing(df: DataFrame, path: str, keys: list[str], valid: Column | None = None) -> int:
    """Resume: append only the rows whose key the table does not hold yet. Returns how many.

    ``valid``: what a stored row must meet to count, such as its version, hash and status.
    """
    spark = df.sparkSession
    if exists(spark, path):
        done = spark.read.parquet(path)
        df = df.join((done if valid is None else done.where(valid)).select(*keys).distinct(), keys, "left_anti")
    df = df.persist()
    n = df.count()
    if n:
        df.write.mode("append").parquet(path)
    df.unpersist()
    return n


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in any store that Spark reads."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small text to any store, whole or not at all: a temporary name first, then a rename."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target, made = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.tmp")
    fs = target.getFileSystem(conf)
    stream = fs.create(made, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    fs.delete(target, False)
    if not fs.rename(made, target):
        raise EngineError(f"cannot write {path}")


def get_text(spark: SparkSession, path: str) -> str:
    """A small text from any store; names with an underscore first, which table readers skip, are read too."""
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    stream = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(found)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_vectors(df: DataFrame, path: str, model: str, dimensions: int, key: str = "id", vector: str = "embedding") -> int:
    """Stores unit vectors of one model, those of a key once; a vector of other size or length is refused."""
    good = (F.size(vector) == dimensions) & is_unit(F.col(vector))
    rows = df.select(key, F.col(vector).cast("array<float>").alias(vector), F.lit(model).alias("model"), F.coalesce(good, F.lit(False)).alias("_good"))
    if not rows.where("NOT _good").isEmpty():
        raise EngineError("a vector is of another size or length")
    return append_missing(rows.drop("_good"), path, [key], F.col("model") == model)


def write_report(path: str, title: str, facts: DataFrame, tables: dict[str, DataFrame], most_rows: int = 50) -> str:
    """A Markdown report of one row of facts and the first rows of tables; it says how many rows of each it leaves out."""

    def line(cells) -> str:
        return "| " + " | ".join(str("" if c is None else c).replace("|", "\\|").replace("\n", " ") for c in cells) + " |"

    one = facts.first()
    out = [f"# {title}", "", *[f"- {k}: {v}" for k, v in (one.asDict() if one else {}).items()]]
    for name, df in tables.items():
        shown = df.limit(most_rows + 1).collect()
        out += ["", f"## {name}", "", line(df.columns), line(["-"] * len(df.columns)), *[line(r) for r in shown[:most_rows]]]
        if len(shown) > most_rows:
            out += ["", f"{df.count() - most_rows} more rows are not shown."]
    text = "\n".join(out) + "\n"
    write_text_atomic(path, text)
    return text


def review_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows for a person to decide on: every decision pending, cells safe for spreadsheets."""
    return flat(df.select(*columns).withColumns({"reviewer_decision": F.lit("PENDING"), "reviewer_correction": F.lit(""), "reviewer_notes": F.lit("")}))


def write_text_atomic(path: str, text: str) -> None:
    with open(f"{path}.tmp", "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(f"{path}.tmp", path)


def manifest(tables: dict[str, DataFrame], path: str, **facts) -> dict:
    """Rows and logical hash of each table, as JSON beside them; equal for equal content."""
    out = dict(facts)
    for name, df in tables.items():
        r = logical_hash(df, sorted(df.columns)).first()
        out[name] = {"rows": int(r["rows"]), "logical_hash": r["logical_hash"]}
    write_text_atomic(path, json.dumps(out, sort_keys=True, indent=1))
    return out


def verify_manifest(tables: dict[str, DataFrame], path: str) -> list[str]:
    """Names of the tables whose content differs from the manifest."""
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    return [n for n, df in tables.items() if said.get(n, {}).get("logical_hash") != logical_hash(df, sorted(df.columns)).first()["logical_hash"]]
