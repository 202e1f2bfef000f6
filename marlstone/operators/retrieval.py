"""Dense and fused retrieval over batches of queries; lexical retrieval is in ``lexical_index``.

The authorization filter applies before a document can be ranked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.analysis import search_form
from .contracts import EngineError, NotAuthorized
from .lexical_index import Scope


def authorized(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Rows of an allowed class; an empty list is refused."""
    classes = sorted({c.strip().upper() for c in allowed if c and c.strip()})
    if not classes:
        raise NotAuthorized("no authorization class given")
    return df.where(F.upper(F.col(column)).isin(classes))


def top_ranked(scores: DataFrame, limit: int, group: str = "query_id", id_col: str = "id") -> DataFrame:
    """Adds ``rank`` (from 1) by falling score, then id; at most ``limit`` rows of each group.

    Scores that are null, NaN or infinite are dropped.
    """
    order = Window.partitionBy(group).orderBy(F.desc("score"), id_col)
    finite = scores.where(~F.isnan("score") & (F.abs("score") != float("inf")))
    return finite.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


# -- exact dense scoring ------------------------------------------------------------------------

#: Queries whose vectors go to every task at a time; more take as many passes over the vectors.
MOST_QUERIES = 4096
#: Vectors of a block of the matrix product, and its most scores.
BLOCK_ROWS, BLOCK_SCORES = 512, 1 << 18
#: Scores are rounded to so many digits, so that equal vectors tie whatever the order of their sums.
DIGITS = 12


class _Best:
    """The ``limit`` best ids of each key so far; scores below a key's bar are not kept."""

    def __init__(self, limit: int):
        self.limit, self.held, self.names = limit, 0, []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.bars = np.full(1, -np.inf)

    def bar(self, keys: int) -> np.ndarray:
        if len(self.bars) < keys:
            self.bars = np.append(self.bars, np.full(keys - len(self.bars), -np.inf))
        return self.bars

    def add(self, keys: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        self.parts.append((keys, ids, scores))
        self.held += len(keys)

    def crowded(self) -> bool:
        return self.held > max(100_000, 2 * self.limit * len(self.bars))

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.held:
            self.parts = []
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        keys, ids, scores = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((ids, -scores, keys))
        keys, ids, scores = keys[order], ids[order], scores[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        place = np.arange(len(keys)) - np.repeat(first, np.diff(first, append=len(keys)))
        full = place == self.limit - 1
        self.bar(int(keys.max()) + 1)[keys[full]] = scores[full]
        kept = place < self.limit
        self.parts, self.held = [(keys[kept], ids[kept], scores[kept])], int(kept.sum())
        return self.parts[0]


def _masks(requests: list[tuple], queries: dict, values: dict[str, list], rows: int) -> np.ndarray | None:
    """(rows, queries) of what each query may find; ``values``: facet to the values of each row."""
    may = None
    for facet in sorted({r[1] for r in requests}):
        mine = [r for r in requests if r[1] == facet]
        asking = np.zeros(len(queries), bool)
        equal: dict[str, list] = {}
        years = []
        for q, _, operator, value in mine:
            which = slice(None) if q is None else queries.get(q)
            if which is None:
                continue
            asking[which] = True
            if operator == "is":
                equal.setdefault(value, []).append(which)
            else:
                years.append((operator, int(value), which))
        met = np.repeat(~asking[None, :], rows, axis=0)
        for i, each in enumerate(values[facet]):
            for v in each or ():
                form = "" if v is None else search_form(str(v)).strip()
                for which in equal.get(form, ()):
                    met[i, which] = True
                if years and form.isdigit():
                    for operator, year, which in years:
                        if int(form) <= year if operator == "at_most" else int(form) >= year:
                            met[i, which] = True
        may = met if may is None else may & met
    return may


def dense_top(vectors: DataFrame, queries: DataFrame, limit: int, scope: Scope | None = None, group: str | None = None, apart: bool = False) -> DataFrame:
    """(query_id, [group], id, score): the best inner products of each query over all vectors, exactly.

    ``vectors``: id, embedding, and the columns that ``scope`` and ``group`` name. ``queries``:
    query_id, query_vector. A task multiplies blocks of its vectors with all queries and keeps
    ``limit`` rows a query (and value of ``group``), so at most that many leave it; the caller ranks
    them (``top_ranked``). ``apart``: a vector is not found by the query of its id. Null vectors
    are not found.
    """
    spark = vectors.sparkSession
    kind, id_kind = queries.schema["query_id"].dataType, vectors.schema["id"].dataType
    first = queries.select("query_id", "query_vector").limit(MOST_QUERIES + 1).collect()
    passes = 1 if len(first) <= MOST_QUERIES else -(-queries.count() // MOST_QUERIES)
    requests = [] if scope is None else [tuple(r) for r in scope.requests.distinct().collect()]  # no more than a few for each query
    facets = sorted({r[1] for r in requests})
    if missing := [f for f in facets if f not in vectors.columns]:
        raise EngineError(f"the vectors have no facet {', '.join(missing)}")
    spec = T.StructType().add("query_id", kind)
    if group:
        spec = spec.add(group, vectors.schema[group].dataType)
    spec = spec.add("id", id_kind).add("score", "double")
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in spec])

    def listed(name: str):
        c = F.col(name)
        return (c if isinstance(vectors.schema[name].dataType, T.ArrayType) else F.array(c)).cast("array<string>").alias(f"facet_{name}")

    rows = vectors.where("embedding IS NOT NULL").select("id", "embedding", (F.col(group) if group else F.lit(0)).alias("group"), *map(listed, facets))
    out = None
    for k in range(passes):
        part = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(passes)) == k)
        asked = first if passes == 1 else part.select("query_id", "query_vector").collect()  # MOST_QUERIES or about so
        if not asked:
            continue
        names = {r.query_id: i for i, r in enumerate(asked)}
        shared = spark.sparkContext.broadcast(([r.query_id for r in asked], np.array([r.query_vector for r in asked], np.float64), [r for r in requests if r[0] is None or r[0] in names], names))

        def multiply(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids_of, matrix, wanted, names = shared.value
            best, found, groups, values_of = _Best(limit), [], {}, []
            rows_each = max(1, min(BLOCK_ROWS, BLOCK_SCORES // len(ids_of)))
            for batch in batches:
                for begin in range(0, batch.num_rows, rows_each):
                    b = batch.slice(begin, rows_each)
                    x = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1)
                    scores = np.round(x @ matrix.T, DIGITS)
                    ids, mine = b.column(0).to_pylist(), b.column(2).to_pylist()
                    may = np.isfinite(scores)
                    if wanted:
                        may &= _masks(wanted, names, {f: b.column(3 + i).to_pylist() for i, f in enumerate(facets)}, b.num_rows)
                    if apart:
                        for i, doc in enumerate(ids):
                            if doc in names:
                                may[i, names[doc]] = False
                    for v in mine:
                        if v not in groups:
                            groups[v] = len(groups)
                            values_of.append(v)
                    code = np.array([groups[v] for v in mine], np.int64)
                    keys = code[:, None] * len(ids_of) + np.arange(len(ids_of))
                    row, q = np.nonzero(may & (scores >= best.bar(len(groups) * len(ids_of))[keys]))
                    best.add(keys[row, q], len(found) + row, scores[row, q])
                    found += ids
                    # places stand for ids; ties must go by id, so places are put into its order when they are settled
                    if best.crowded() or len(found) > 1_000_000:
                        found = _by_id(best, found)
            _by_id(best, found)
            keys, places, scores = best.settle()
            named = best.names
            for begin in range(0, len(keys), 50_000):
                cut = slice(begin, begin + 50_000)
                columns = {"query_id": [ids_of[i] for i in (keys[cut] % len(ids_of)).tolist()], "id": [named[i] for i in places[cut].tolist()], "score": scores[cut]}
                if group:
                    columns[group] = [values_of[i] for i in (keys[cut] // len(ids_of)).tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)

        made = rows.mapInArrow(multiply, spec)
        out = made if out is None else out.unionByName(made)
    return spark.createDataFrame([], spec) if out is None else out


def _by_id(best: _Best, found: list) -> list:
    """Renumbers what ``best`` holds in order of id, and settles it; the ids that are still held."""
    if best.held:
        keys, places, scores = (np.concatenate(x) for x in zip(*best.parts, strict=True))
        held = np.unique(places)
        order = sorted(held.tolist(), key=lambda i: (found[i] is None, found[i]))
        rank = np.empty(len(found), np.int64)
        rank[order] = np.arange(len(order))
        best.parts = [(keys, rank[places], scores)]
        best.names = [found[i] for i in order]
        best.settle()
        return list(best.names)
    best.parts, best.names = [], []
    return []


def reciprocal_rank_fusion(rankings: list[tuple[DataFrame, float]], k: int = 60) -> DataFrame:
    """(query_id, id, score): sum of weight / (k + rank) over the rankings that hold the id."""
    parts = None
    for ranking, weight in rankings:
        part = ranking.select("query_id", "id", (F.lit(weight) / (k + F.col("rank"))).alias("part"))
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("query_id", "id").agg(F.sum("part").alias("score"))


def roll_up(chunks: DataFrame, limit: int, evidence: int = 3) -> DataFrame:
    """Documents by their best chunk: query_id, document_id, score, best_id, evidence ids, rank.

    ``chunks``: query_id, document_id, id, score.
    """
    order = Window.partitionBy("query_id", "document_id").orderBy(F.desc("score"), "id")
    kept = chunks.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= evidence)
    docs = kept.groupBy("query_id", "document_id").agg(
        F.max("score").alias("score"),
        F.min_by("id", "_n").alias("best_id"),
        F.transform(F.sort_array(F.collect_list(F.struct("_n", "id"))), lambda x: x["id"]).alias("evidence"),
    )
    return top_ranked(docs, limit, id_col="document_id")
