"""Quality classifier: hashed word n-gram logistic regression trained with FTRL-proximal.

Features of a text: hashed lower-cased tokens (letter runs, digit runs, runs of one kind of
symbol) and adjacent pairs, each text's feature values 1 / sqrt(count of n-grams). Training
takes at most ``max_train`` labelled rows, those with the smallest hash of their id, and runs
in one task over their hashed features, so its memory has a fixed bound. Scoring is a sparse
dot product per text; the weight table (``2 ** bits`` floats) is broadcast.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import worker_cache

TOKEN = re.compile(r"[^\W\d_]+|\d+|([^\w\s]|_)\1*")
MULTIPLIER = np.uint32(2654435761)
#: All pairs of a token with itself are one and the same n-gram.
DOUBLED = np.uint32(0x5EED5EED)


def features(text: str | None, bits: int) -> np.ndarray:
    """Hashed feature numbers (uint32, repeats kept) of the tokens and token pairs of a whole text."""
    if not text:
        return np.empty(0, np.uint32)
    tokens = [m.group() for m in TOKEN.finditer(text.lower())]
    h = np.fromiter((zlib.crc32(t.encode("utf-8", "replace")) for t in tokens), np.uint32, len(tokens))
    pairs = ((h[:-1] * MULTIPLIER) ^ (h[1:] + np.uint32(0x9E3779B9))) * MULTIPLIER
    pairs[h[:-1] == h[1:]] = DOUBLED
    x = np.concatenate([h, pairs])
    return (x ^ (x >> np.uint32(15))) & np.uint32((1 << bits) - 1)


def counted(x: np.ndarray) -> np.ndarray:
    """(feature, count) of a text as two rows of uint32; at most 2 ** bits columns whatever its length."""
    idx, count = np.unique(x, return_counts=True)
    return np.stack([idx.astype(np.uint32), count.astype(np.uint32)])


def fit_ftrl(rows: list[tuple[np.ndarray, int]], bits: int, epochs: int = 3, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.05, l2: float = 0.1) -> np.ndarray:
    """Weights (2 ** bits, and the bias last) by FTRL-proximal, one labelled text (``counted``) at a time."""
    n_weights = (1 << bits) + 1
    z, n, w = np.zeros(n_weights), np.zeros(n_weights), np.zeros(n_weights)
    for _ in range(epochs):
        for x, y in rows:
            idx = np.append(x[0].astype(np.int64), n_weights - 1)
            value = np.append(x[1] / np.sqrt(max(1, int(x[1].sum(dtype=np.int64)))), 1.0)
            zi, ni = z[idx], n[idx]
            wi = np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))
            p = 1.0 / (1.0 + np.exp(-np.clip(wi @ value, -30, 30)))
            g = (p - y) * value
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[idx] += g - sigma * wi
            n[idx] += g * g
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))


def train(docs: DataFrame, labels: DataFrame, bits: int = 18, max_train: int = 8000, **ftrl) -> np.ndarray:
    """FTRL weights learned from ``labels`` (doc_id, label 0/1) and the texts of ``docs``.

    Null ids or labels are left out; of conflicting labels of one id the larger counts. With no
    labelled text at all the weights are zero, so every score is 0.5.
    """
    spark = docs.sparkSession
    labels = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen.withColumnRenamed("doc_id", "_id")), F.col("doc_id") == F.col("_id"))  # max_train rows at most

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker_cache("quality")
        for b in batches:
            yield pd.DataFrame({"doc_id": b.doc_id, "x": [counted(features(t, bits)).tobytes() for t in b.text], "label": b.label})

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(k=[zlib.crc32(b"order" + str(i).encode()) for i in rows.doc_id]).sort_values(["k", "doc_id", "x"])
        w = fit_ftrl([(np.frombuffer(x, np.uint32).reshape(2, -1), int(y)) for x, y in zip(rows.x, rows.label, strict=True)], bits, **ftrl)
        return pd.DataFrame({"w": [w.astype("<f4").tobytes()]})

    x = sample.mapInPandas(hashed, "doc_id long, x binary, label int")
    found = x.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(lambda rows: fit(rows), "w binary").collect()
    return np.frombuffer(bytes(found[0].w), "<f4") if found else np.zeros((1 << bits) + 1, "<f4")


def score(docs: DataFrame, weights: np.ndarray, threshold: float = 0.3) -> DataFrame:
    """doc_id, score (0 to 1), predicted (score >= threshold) of every row's whole text.

    Null and empty texts get the score of the bias alone. Repeated rows and null ids are passed
    through; extra columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(np.asarray(weights, "<f4"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value.astype(np.float64)
        for b in batches:
            p = 1.0 / (1.0 + np.exp(-np.clip(_sums(b.column(1), w), -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scored, "doc_id long, score double, predicted int")


def _sums(texts: pa.Array, w: np.ndarray) -> np.ndarray:
    """Bias and sparse dot product of each text; ``w`` holds the bias last."""
    bits, out = (len(w) - 1).bit_length() - 1, np.empty(len(texts))
    for i, t in enumerate(texts):
        x = features(t.as_py(), bits)
        out[i] = w[-1] + (w[x].sum() / np.sqrt(len(x)) if len(x) else 0.0)
    return out


def learning_rows(labels: DataFrame, label_col: str = "quality") -> DataFrame:
    """Labels of the rows outside the held-out fold: crc32(doc_id as text) mod 5 is not 0."""
    return labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0).select("doc_id", F.col(label_col).cast("int").alias("label"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents, with all their columns, that the classifier does not reject.

    Every row is judged by its whole text, repeated rows each; null and empty texts get the score
    of the bias alone. All columns, null ids included, pass through unchanged, whatever their
    names; an empty table gives an empty result.
    """
    weights = train(docs, learning_rows(labels))
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    text_at = docs.columns.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("quality")
        w = shared.value.astype(np.float64)
        cut = np.log(threshold / (1 - threshold))
        for b in batches:
            for begin in range(0, b.num_rows, 1000):  # small batches on the way out, too
                part = b.slice(begin, 1000)
                yield part.filter(pa.array(_sums(part.column(text_at), w) >= cut))

    return docs.mapInArrow(kept, docs.schema)
