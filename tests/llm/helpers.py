"""Small tables with the awkward cases that every operator must take."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


def awkward(n=60, seed=1):
    """Nulls, empty, blank and very long texts, ties, repeated rows, copies and near copies."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 120)))
        rows.append((i, text, rng.choice(["en", "fr", None]), rng.choice(["src0", "src1", None]), len(text)))
    for i in range(n, n + 20):
        base = rows[i % 5][1]
        ws = base.split()
        if i % 2 and len(ws) > 3:
            ws[rng.randrange(len(ws))] = "changed"
        rows.append((i, "  ".join(ws) + "\n", "en", "src0", 1))
    rows += [(900, None, None, None, None), (901, "", "en", "src0", 0), (902, " \t\n ", "en", None, 4), (None, "a null id here", "en", "src1", 1), (903, " ".join(rng.choice(vocabulary) for _ in range(20_000)), "fr", "src0", None)]
    rows += [rows[3], rows[3], (904, "ABC.\nABC.\nx\n\nABC. # <b>|&", "en", "src1", 9)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)
