"""Relational building blocks: merges, rollups, dedupe, caps, samples, trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upsert(base: DataFrame, repaired: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Base rows with ``columns`` overwritten where a repaired row has the key; ``repaired`` tells which."""
    fixed = repaired.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = base.join(fixed, keys, "left")
    out = joined.withColumns({c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns})
    return out.withColumn("repaired", F.coalesce("_hit", F.lit(False))).drop("_hit", *[f"_new_{c}" for c in columns])


def left_with_defaults(left: DataFrame, right: DataFrame, keys: list[str], defaults: dict[str, object]) -> DataFrame:
    return left.join(right, keys, "left").withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def keep_first(df: DataFrame, groups: list[str], order: list[Column], reason: str | None = None) -> DataFrame:
    """First row of each group; with ``reason`` the others stay, marked in ``suppressed``."""
    n = df.withColumn("_n", F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))
    if reason is None:
        return n.where("_n = 1").drop("_n")
    return n.withColumn("suppressed", F.when(F.col("_n") > 1, reason)).drop("_n")


def group_size(df: DataFrame, groups: list[str], name: str) -> DataFrame:
    return df.withColumn(name, F.count("*").over(Window.partitionBy(*groups)))


def diversify(df: DataFrame, group: str, rank: str, per_group: int, limit: int) -> DataFrame:
    """Soft cap: the first ``per_group`` of each group come first, the rest only fill up to ``limit``."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(rank))
    admitted = df.withColumn("_late", (place > per_group).cast("int")).orderBy("_late", rank).limit(limit)
    final = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_late", rank))  # limit rows
    return admitted.withColumn("final_rank", final).drop("_late")


def blinded_order(df: DataFrame, group: str, item: str, seed: str) -> DataFrame:
    """Adds ``blind_key`` and ``position``: an order of each group that tells nothing of the ranking."""
    key = F.sha2(F.concat_ws("|", F.lit(seed), F.col(group).cast("string"), F.col(item).cast("string")), 256)
    return df.withColumn("blind_key", key).withColumn("position", F.row_number().over(Window.partitionBy(group).orderBy("blind_key")))


def stratified_sample(df: DataFrame, stratum: str, item: str, per_stratum: int, size: int, seed: str) -> DataFrame:
    """``per_stratum`` rows of each stratum by hash, then others by hash up to ``size``."""
    keyed = df.withColumn("sample_key", F.sha2(F.concat_ws("|", F.lit(seed), F.col(item).cast("string")), 256))
    place = F.row_number().over(Window.partitionBy(stratum).orderBy("sample_key"))
    return keyed.withColumn("_late", (place > per_stratum).cast("int")).orderBy("_late", "sample_key").limit(size).drop("_late")


def ordered_text(df: DataFrame, keys: list[str], order: str, text: str, separator: str = "\n\n") -> DataFrame:
    """Texts of a group joined in order, with counts and the first row's values."""
    parts = F.transform(F.sort_array(F.collect_list(F.struct(order, text))), lambda x: x[text])
    return df.groupBy(*keys).agg(F.count("*").alias("parts"), F.array_join(parts, separator).alias("full_text"))


def tree_paths(edges: DataFrame, root, most_depth: int = 16) -> DataFrame:
    """(id, depth, path) of everything below ``root`` in an edge table (parent, id, name), level by level.

    A node deeper than ``most_depth`` is refused.
    """
    level = edges.where(F.col("parent") == F.lit(root)).select("id", F.lit(1).alias("depth"), F.col("name").alias("path"))
    out, depth = level, 1
    while not level.isEmpty():
        if depth > most_depth:
            raise ValueError("the tree is deeper than allowed")
        up = level.select(F.col("id").alias("parent"), F.col("depth").alias("_d"), F.col("path").alias("_p"))
        level = edges.join(up, "parent").select("id", (F.col("_d") + 1).alias("depth"), F.concat_ws("/", "_p", "name").alias("path"))
        out, depth = out.unionByName(level), depth + 1
    return out


def logical_hash(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: a hash of the rows that depends on neither order nor files.

    Rows are hashed, summed by hash prefix, and the 4,096 sums hashed in order.
    """
    row = df.select(F.sha2(F.to_json(F.struct(*columns)), 256).alias("h"))
    word = F.conv(F.substring("h", 4, 12), 16, 10).cast("decimal(20,0)")
    cells = row.groupBy(F.substring("h", 1, 3).alias("cell")).agg(F.sum(word).alias("s"), F.count("*").alias("n"))
    listed = F.sort_array(F.collect_list(F.concat_ws(":", "cell", F.col("s").cast("string"), F.col("n").cast("string"))))
    return cells.agg(F.sha2(F.array_join(listed, ","), 256).alias("logical_hash"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
