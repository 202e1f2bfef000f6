"""Quality rules: base measures of a text, and a hashed n-gram log-likelihood ratio.

Two multinomials over ``buckets`` hashed word n-grams (single words and adjacent pairs) are
counted over all documents: one of the trusted documents, one of the raw corpus. A document's
ratio is the mean over its n-grams of log p_trusted - log p_raw; below ``min_ratio`` it is
dropped. Everything is DataFrame expressions; the counts are combined inside each map task, so
one row per bucket and task is shuffled, and the driver holds two numbers per bucket. Texts are
not shuffled: the ids of trusted documents go to every task, up to a checked number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, text_or_empty, words

SYMBOLS = r"[#*$%&|<>]"
#: Up to so many trusted ids go to every task; beyond, texts are joined to them by a shuffle.
MOST_BROADCAST = 1_000_000


def _bucket(buckets: int, *parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(buckets))


def packed_ngrams(w: Column, buckets: int) -> Column:
    """For each word of an array, in one number: its bucket * (buckets + 1) + that of the pair it opens.

    The last word opens no pair; ``buckets`` stands for that.
    """

    def both(a: Column, i: Column) -> Column:
        after = F.get(w, i + 1)
        return _bucket(buckets, a) * (buckets + 1) + F.when(after.isNull(), buckets).otherwise(_bucket(buckets, a, after))

    return F.transform(w, both)


def ratio_weights(docs: DataFrame, trusted: DataFrame, buckets: int = 16384, prior: float = 256.0, id_col: str = "doc_id", text_col: str = "text") -> list[float]:
    """log p_trusted - log p_raw for each bucket.

    Raw counts are smoothed by one a bucket, trusted counts by ``prior`` n-grams spread as the
    raw corpus is, so that a small trusted set does not by itself lower every ratio.

    ``trusted``: its ``id_col`` names the trusted documents. All documents are counted.
    """
    ids = trusted.select(F.col(id_col).alias("_trusted_id")).where("_trusted_id IS NOT NULL").distinct()
    ids = materialise(ids, "quality-trusted")
    ids = F.broadcast(ids) if ids.count() <= MOST_BROADCAST else ids.hint("shuffle_hash")
    marked = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(ids, F.col("_id") == F.col("_trusted_id"), "left")
    marked = marked.select(F.col("_trusted_id").isNotNull().cast("int").alias("t"), words(F.col("_text")).alias("w"))
    packed = marked.select("t", F.explode(packed_ngrams(F.col("w"), buckets)).alias("x"))
    pair = F.pmod("x", F.lit(buckets + 1))
    grams = packed.select("t", F.explode(F.array(F.expr(f"x div {buckets + 1}"), pair)).alias("b")).where(F.col("b") < buckets)
    raw, target = [1] * buckets, [0] * buckets
    for r in grams.groupBy("b").agg(F.count("*").alias("n"), F.sum("t").alias("t")).collect():  # one row a bucket at most
        raw[r.b] += r.n
        target[r.b] += r.t
    raw_total, target_total = sum(raw), sum(target)
    return [math.log((t + prior * r / raw_total) / (target_total + prior)) - math.log(r / raw_total) for t, r in zip(target, raw, strict=True)]


def quality_rules(
    docs: DataFrame,
    weights: list[float],
    min_ratio: float = -0.08,
    min_words: int = 10,
    max_repeat_percent: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, the base measures, ratio, base_failed, kept.

    Null, empty and blank texts have no words: all measures 0, ratio 0, base_failed. Windows of
    five words are compared by a 64-bit hash. Repeated rows are each judged; ids are passed
    through, null ones too; extra columns are ignored.
    """
    table = F.split(F.lit(",".join(map(repr, [*weights, 0.0]))), ",").cast("array<double>")  # folded to one literal
    buckets = len(weights)
    d = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(F.col(text_col)).alias("text"))
    d = d.withColumn("w", words(F.col("text"))).withColumn("n_words", F.size("w").cast("long"))

    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.withColumn("lines", lines)
    windows = F.when(
        F.col("n_words") >= 5,
        F.transform(
            F.slice("w", F.lit(1), F.greatest(F.size("w") - 4, F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2), F.get("w", i + 3), F.get("w", i + 4)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    d = d.withColumn("windows", windows).withColumn("ngrams", packed_ngrams(F.col("w"), buckets))
    d = d.withColumn("repeats", F.size(F.array_distinct("windows")) < F.size("windows"))
    placed = F.when(F.col("repeats"), F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    d = d.withColumn("placed", placed)
    twice = F.filter(
        "placed",
        lambda x, i: F.coalesce(x["h"] == F.get("placed", i - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get("placed", i + 1)["h"], F.lit(False)),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.sequence(x["i"], x["i"] + 4)))))
    total = F.aggregate("ngrams", F.lit(0.0), lambda s, x: s + F.get(table, (x / (buckets + 1)).cast("int")) + F.get(table, F.pmod(x, F.lit(buckets + 1)).cast("int")))
    d = d.select(
        "doc_id",
        "n_words",
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("repeats"), covered).otherwise(0).cast("long").alias("n_repeat_words"),
        F.when(F.col("n_words") > 0, total / (2 * F.col("n_words") - 1)).otherwise(0.0).alias("ratio"),
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return d.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= min_ratio))
