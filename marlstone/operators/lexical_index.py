"""BM25 over a stored index of document shards, with score bounds, facets and reads that skip.

The map task that reads documents makes their shards (at most ``SHARD`` documents, numbered by
rising id within the shard), so no posting is ever shuffled alone. The stored rows are of three
kinds, in folders by kind and bucket:

- ``documents``: the ids and lengths of a shard.
- ``postings``: per (shard, term) the places and frequencies, in blocks of ``BLOCK`` postings with
  the largest frequency and the smallest length of each: bounds that hold whatever the corpus grows to.
- ``facets``: per (shard, facet, value) the places that have the value.

Terms and values lie in the bucket of their hash. A search asks for its buckets, so Spark never
opens the other folders, and for its terms, so that row groups are skipped.

Every index names its analyser. Documents and queries go in as texts and are analysed here, so an
index cannot meet queries that were made otherwise.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.analysis import ANALYSERS, FoldedWords, folded_form, search_form
from .contracts import EngineError, NotAuthorized

#: Documents and terms of a shard: it ends with the document that reaches either.
SHARD, SHARD_TERMS = 8192, 4_000_000
#: Postings of a block.
BLOCK = 128
#: Documents for each bucket of an index, and the most buckets.
BUCKET_DOCUMENTS, MOST_BUCKETS = 20_000, 256
#: Most documents of a task that reads them: a corpus is dealt over the cores, however few files or row groups hold it.
TASK_DOCUMENTS = 4 * SHARD
#: Up to so many queries are analysed on the driver and their terms pushed into the scan.
FEW_QUERIES = 1000
#: Queries that a shard is searched for at a time.
QUERY_BLOCK = 4096
#: (query, term) pairs up to this number go to every task; more are joined by a shuffle.
MOST_PAIRS = 1_000_000
#: Scores are rounded to so many digits, so that equal texts tie whatever the order of their sums.
DIGITS = 6


def _bucket(key: str, buckets: int) -> int:
    return zlib.crc32(key.encode()) % buckets


def _bucket_of(key: Column, buckets: int) -> Column:
    return (F.crc32(key.cast("binary")) % buckets).cast("int")


def _schema(id_type: T.DataType) -> T.StructType:
    ints = T.ArrayType(T.IntegerType())
    return (
        T.StructType().add("kind", "string").add("bucket", "integer").add("shard", "long").add("facet", "string").add("term", "string")
        .add("n", "integer").add("cf", "long").add("places", ints).add("tfs", ints).add("top_tf", ints).add("least_length", ints)
        .add("ids", T.ArrayType(id_type)).add("lengths", ints)
    )


def _local(spark: SparkSession, rows: list[tuple], spec: T.StructType) -> DataFrame:
    """A small table that plans hold themselves: reading it takes no job."""
    columns = list(zip(*rows, strict=True)) or [()] * len(spec)
    return spark.createDataFrame(pa.table([pa.array(list(c), to_arrow_type(f.dataType)) for c, f in zip(columns, spec, strict=True)], names=spec.names), spec)


class _Shard:
    """Documents of one shard while it is read."""

    def __init__(self, facets: list[str]):
        self.facets = facets
        self.ids: list = []
        self.tokens: list[np.ndarray] = []
        self.terms: defaultdict[str, int] = defaultdict()
        self.terms.default_factory = self.terms.__len__
        self.values: defaultdict[tuple[str, str], set[int]] = defaultdict(set)
        self.held = 0

    def add(self, doc_id, words: list[str], values: Iterable[list[str] | None]) -> None:
        for facet, each in zip(self.facets, values, strict=True):
            for v in each or ():
                if v is not None and (form := search_form(v).strip()):
                    self.values[facet, form].add(len(self.ids))
        self.ids.append(doc_id)
        self.tokens.append(np.fromiter(map(self.terms.__getitem__, words), np.int32, len(words)))
        self.held += len(words)

    def rows(self, number: int, buckets: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i]))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        lengths = np.array([len(self.tokens[i]) for i in order], np.int32)
        yield self._batch(schema, 1, number, kind="documents", bucket=[0], n=[len(order)], ids=pa.array([[self.ids[i] for i in order]], schema.field("ids").type), lengths=pa.array([lengths.tolist()], pa.list_(pa.int32())))
        if self.values:
            named = sorted(self.values)
            at = [sorted(place[i] for i in self.values[k]) for k in named]
            yield self._batch(schema, len(named), number, kind="facets", bucket=[_bucket(f"{f}={v}", buckets) for f, v in named], facet=[f for f, _ in named], term=[v for _, v in named], n=[len(x) for x in at], places=pa.array(at, pa.list_(pa.int32())))
        if not self.held:
            return
        keys, filled = np.empty(self.held, np.int64), 0
        for i, each in enumerate(self.tokens):
            keys[filled : filled + len(each)] = (each.astype(np.int64) << 32) | place[i]
            filled += len(each)
        self.tokens.clear()
        keys.sort()
        begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        tf, keys = np.diff(begins, append=len(keys)), keys[begins]
        term, at = keys >> 32, (keys & 0xFFFFFFFF).astype(np.int32)
        starts = np.flatnonzero(np.diff(term, prepend=-1))
        ends = np.append(starts, len(at))
        sizes = np.diff(ends)
        blocks = -(-sizes // BLOCK)
        block_ends = np.concatenate([[0], np.cumsum(blocks)])
        block_starts = np.repeat(starts, blocks) + BLOCK * (np.arange(block_ends[-1]) - np.repeat(block_ends[:-1], blocks))
        top, least = np.maximum.reduceat(tf, block_starts), np.minimum.reduceat(lengths[at], block_starts)
        cf = np.add.reduceat(tf, starts)
        names = list(self.terms)

        def lists(offsets: np.ndarray, values: np.ndarray, a: int, b: int) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array((offsets[a : b + 1] - offsets[a]).astype(np.int32)), pa.array(values[offsets[a] : offsets[b]].astype(np.int32)))

        for a in range(0, len(names), 20_000):
            b = min(a + 20_000, len(names))
            yield self._batch(
                schema, b - a, number, kind="postings", bucket=[_bucket(w, buckets) for w in names[a:b]], term=names[a:b], n=sizes[a:b], cf=cf[a:b],
                places=lists(ends, at, a, b), tfs=lists(ends, tf, a, b), top_tf=lists(block_ends, top, a, b), least_length=lists(block_ends, least, a, b),
            )

    @staticmethod
    def _batch(schema: pa.Schema, size: int, number: int, kind: str, **columns) -> pa.RecordBatch:
        columns |= {"kind": [kind] * size, "shard": [number] * size}
        made = [columns[f.name] if isinstance(columns.get(f.name), pa.Array) else pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema]
        return pa.RecordBatch.from_arrays(made, schema=schema)


# -- one shard of a search ------------------------------------------------------------------------


class Postings:
    """The list of one term in one shard, with the bounds of its blocks at the corpus's mean length."""

    def __init__(self, places: np.ndarray, tfs: np.ndarray, top_tf: np.ndarray, least_length: np.ndarray, idf: float, k1: float, b: float, mean: float):
        self.places, self.tfs, self.idf, self.k1 = places, tfs, idf, k1
        self.bounds = idf * top_tf * (k1 + 1) / (top_tf + k1 * (1 - b + b * least_length / mean))
        self.top = float(self.bounds.max())

    def parts(self, norms: np.ndarray, at: slice | np.ndarray = slice(None)) -> np.ndarray:
        tf = self.tfs[at].astype(np.float64)
        return self.idf * tf * (self.k1 + 1) / (tf + norms[self.places[at]])


def best_of_shard(lists: list[tuple[Postings, int]], norms: np.ndarray, may: np.ndarray | None, limit: int, positive_only: bool) -> tuple[np.ndarray, np.ndarray, int, int]:
    """(places, scores, blocks, blocks read) of the ``limit`` best documents of a shard for one query.

    ``lists``: postings and how often the query asks for the term. Terms go by falling bound. Once
    the bounds of those left could not lift an unseen document to the ``limit``-th score, only
    documents that may still reach it are looked up, and blocks without one are not read.
    """
    step = 10.0**-DIGITS
    lists = sorted(lists, key=lambda x: -x[0].top * x[1])
    left = np.append(np.cumsum([p.top * r for p, r in lists][::-1])[::-1], 0.0)
    blocks, read = sum(len(p.bounds) for p, _ in lists), 0
    total, floor, i = np.zeros(len(norms)), -1.0, 0
    while i < len(lists) and floor - step <= left[i]:
        p, repeats = lists[i]
        total[p.places] += repeats * p.parts(norms)
        read += len(p.bounds)
        i += 1
        if i < len(lists) and left[i] <= total.max() + step:  # else no document could be left out yet
            seen = total if may is None else total[may]
            if len(seen) >= limit:
                floor = max(floor, float(np.partition(seen, len(seen) - limit)[len(seen) - limit]))
    if i < len(lists):
        candidates = np.flatnonzero((total + left[i] >= floor - step) if may is None else may & (total + left[i] >= floor - step))
        for j in range(i, len(lists)):
            p, repeats = lists[j]
            reach = candidates[total[candidates] + left[j] >= floor - step]
            at = np.minimum(np.searchsorted(p.places, reach), len(p.places) - 1)
            read += len(np.unique(np.maximum(np.searchsorted(p.places[::BLOCK], reach, "right") - 1, 0)))
            hit = at[p.places[at] == reach]
            total[p.places[hit]] += repeats * p.parts(norms, hit)
            candidates = reach
            if len(candidates) >= limit:
                floor = max(floor, float(np.partition(total[candidates], len(candidates) - limit)[len(candidates) - limit]))
    else:
        candidates = np.arange(len(norms)) if may is None else np.flatnonzero(may)
    scores = np.round(total[candidates], DIGITS)
    if positive_only:
        candidates, scores = candidates[scores > 0], scores[scores > 0]
    if len(scores) > limit:
        bar = np.partition(scores, len(scores) - limit)[len(scores) - limit]
        candidates, scores = candidates[scores >= bar], scores[scores >= bar]
    order = np.lexsort((candidates, -scores))[:limit]
    return candidates[order], scores[order], blocks, read


def _allowed(masks: dict[str, np.ndarray], asked: Iterable[str], size: int) -> np.ndarray | None:
    may = None
    for facet in asked:
        mask = masks.get(facet)
        mask = np.zeros(size, bool) if mask is None else mask
        may = mask if may is None else may & mask
    return may


# -- scopes ---------------------------------------------------------------------------------------

#: A request's values as they are, or years up to and from one.
OPERATORS = ("is", "at_most", "at_least")


class Scope:
    """What queries may find: requests (query_id, facet, operator, value); a null query_id means every query.

    Values of one facet are alternatives; facets hold together. Blank values are no request.
    """

    def __init__(self, requests: DataFrame, facets: set[str] | None = None, general: set[str] | None = None, own: dict | None = None):
        self.requests = requests
        self.facets = facets
        self.general, self.own = general, own  # the facets asked for all queries and for each, where the driver knows them

    @classmethod
    def of(cls, spark: SparkSession, general: dict[str, list] | None = None, by_query: dict | None = None, query_type: str | T.DataType = "string") -> Scope:
        """From dictionaries: facet to values for every query, and query id to such a dictionary.

        ``year_at_most``-like keys are written as (facet, operator) tuples.
        """
        rows = []
        for query_id, wanted in [(None, general or {}), *(by_query or {}).items()]:
            for name, values in wanted.items():
                facet, operator = name if isinstance(name, tuple) else (name, "is")
                if operator not in OPERATORS:
                    raise EngineError(f"unknown filter operator {operator}")
                for v in values if isinstance(values, (list, tuple, set)) else [values]:
                    if v is not None and (form := search_form(str(v)).strip()):
                        rows.append((query_id, facet, operator, form))
        own: dict = {}
        for r in rows:
            if r[0] is not None:
                own.setdefault(r[0], set()).add(r[1])
        spec = T.StructType().add("query_id", {"bigint": "long", "int": "integer"}.get(query_type, query_type) if isinstance(query_type, str) else query_type).add("facet", "string").add("operator", "string").add("value", "string")
        return cls(_local(spark, rows, spec), {r[1] for r in rows}, {r[1] for r in rows if r[0] is None}, own)

    @classmethod
    def security(cls, spark: SparkSession, facet: str, allowed: list[str], query_type: str | T.DataType = "string") -> Scope:
        """Documents of an allowed class; an empty list is refused."""
        classes = sorted({c.strip() for c in allowed if c and c.strip()})
        if not classes:
            raise NotAuthorized("no authorization class given")
        return cls.of(spark, {facet: classes}, query_type=query_type)

    def also(self, other: Scope | None) -> Scope:
        if other is None:
            return self
        facets = None if self.facets is None or other.facets is None else self.facets | other.facets
        general = own = None
        if self.general is not None and other.general is not None:
            general = self.general | other.general
            own = {q: self.own.get(q, set()) | other.own.get(q, set()) for q in (*self.own, *other.own)}
        return Scope(self.requests.unionByName(other.requests), facets, general, own)

    def values(self, facet: str, values: DataFrame) -> Scope:
        """And documents that have one of ``values`` (one column): a table of any size."""
        kind = self.requests.schema["query_id"].dataType
        plain = values.select(F.col(values.columns[0]).cast("string").alias("v")).where("v IS NOT NULL").distinct()
        rows = plain.select(F.lit(None).cast(kind).alias("query_id"), F.lit(facet).alias("facet"), F.lit("is").alias("operator"), folded_form("v").alias("value"))
        return Scope(self.requests.unionByName(rows), None if self.facets is None else self.facets | {facet}, None if self.general is None else self.general | {facet}, self.own)


class _FewQueries:
    """Queries that the driver analysed: their ids, and the queries that ask for each term, how often."""

    def __init__(self, counts: dict):
        self.queries = list(counts)
        self.terms: dict[str, list[tuple]] = {}
        for q, words in counts.items():
            for w, n in words.items():
                self.terms.setdefault(w, []).append((q, n))


class Bm25Index:
    """A stored index; see the module. ``terms``: term, df, cf. ``facts``: one row of what scores rest on."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.facts = spark.read.parquet(f"{path}/facts")
        self.fact = self.facts.first()
        if self.fact.analyser not in ANALYSERS:
            raise EngineError(f"the index was made by an analyser that is not known: {self.fact.analyser}")
        self.schema = T.StructType.fromJson(json.loads(self.fact.schema))
        self.rows = spark.read.schema(self.schema).parquet(f"{path}/rows")
        self.terms = spark.read.schema("term string, df long, cf long, bucket int").parquet(f"{path}/terms")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Bm25Index:
        return cls(spark, path)

    @classmethod
    def build(cls, docs: DataFrame, path: str, facets: Iterable[str] = (), k1: float = 1.2, b: float = 0.75, refuse_empty: bool = False, shard: int = SHARD, shard_terms: int = SHARD_TERMS, buckets: int | None = None, analyser: str = FoldedWords.name) -> Bm25Index:
        """Writes the index of ``docs`` (id, text, columns ``facets`` of values or arrays of values) below ``path``.

        A corpus without documents is refused; with ``refuse_empty`` also a document without a term.
        Null texts have no terms, null and blank values are none. Rows that repeat an id are
        documents of their own.
        """
        spark, facets = docs.sparkSession, list(facets)
        count = docs.count()
        if buckets is None:
            buckets = min(MOST_BUCKETS, 1 << max(2, (count // BUCKET_DOCUMENTS).bit_length()))
        docs = docs.repartition(max(1, min(spark.sparkContext.defaultParallelism, count // 100), -(-count // TASK_DOCUMENTS)))
        id_type = docs.schema["id"].dataType
        schema = _schema(id_type)
        arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

        def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number, analyse = TaskContext.get().partitionId() << 32, ANALYSERS[analyser]()
            held = _Shard(facets)
            for batch in batches:
                for begin in range(0, batch.num_rows, 256):
                    ids, texts, *values = (c.to_pylist() for c in batch.slice(begin, 256).columns)
                    for row in zip(ids, texts, *values, strict=True):
                        held.add(row[0], analyse(row[1]), row[2:])
                        if len(held.ids) == shard or held.held >= shard_terms:
                            yield from held.rows(number, buckets, arrow)
                            number, held = number + 1, _Shard(facets)
            if held.ids:
                yield from held.rows(number, buckets, arrow)

        def listed(name: str) -> Column:
            c = F.col(name)
            return (c if isinstance(docs.schema[name].dataType, T.ArrayType) else F.array(c)).cast("array<string>").alias(f"facet_{name}")

        made = docs.select("id", F.col("text").cast("string"), *map(listed, facets)).mapInArrow(index, schema)
        spread = F.pmod(F.xxhash64("shard"), F.lit(8))  # a bucket's rows come from eight tasks, so a term of many shards is not one task's
        dealt = made.repartition("kind", "bucket", spread).sortWithinPartitions("kind", "bucket", "term", "shard")
        dealt.write.partitionBy("kind", "bucket").mode("overwrite").parquet(f"{path}/rows")
        rows = spark.read.schema(schema).parquet(f"{path}/rows")
        empty = F.aggregate("lengths", F.lit(0), lambda s, x: s + (x == 0).cast("int"))
        total = F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x)
        one = rows.where("kind = 'documents'").agg(F.sum("n").alias("n"), F.sum(total).alias("total"), F.sum(empty).alias("empty"), F.count("*").alias("shards"))
        constants = {"k1": F.lit(float(k1)), "b": F.lit(float(b)), "buckets": F.lit(buckets), "analyser": F.lit(analyser), "schema": F.lit(schema.json()), "facets": F.lit(",".join(facets))}
        facts = one.select(F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("empty", F.lit(0)).alias("empty"), "shards")
        facts.withColumn("mean", F.col("total") / F.greatest("n", F.lit(1))).withColumns(constants).write.mode("overwrite").parquet(f"{path}/facts")
        counted = rows.where("kind = 'postings'").groupBy("term").agg(F.sum("n").alias("df"), F.sum("cf").alias("cf"))
        counted.withColumn("bucket", _bucket_of(F.col("term"), buckets)).repartition("bucket").sortWithinPartitions("bucket", "term").write.partitionBy("bucket").mode("overwrite").parquet(f"{path}/terms")
        made_index = cls(spark, path)
        if not made_index.fact.n or (refuse_empty and made_index.fact.empty):
            raise EngineError("the corpus is empty or holds a document without a term")
        return made_index

    # -- what the index holds -----------------------------------------------------------------------

    def _idf(self, df: Column) -> Column:
        return F.log(1 + (self.fact.n - df + 0.5) / (df + 0.5))

    def statistics(self) -> DataFrame:
        """(term, df, cf, idf); idf = ln(1 + (N - df + 0.5) / (df + 0.5))."""
        return self.terms.select("term", "df", "cf", self._idf(F.col("df")).alias("idf"))

    def documents(self) -> DataFrame:
        """(shard, place, id, length)."""
        each = self.rows.where("kind = 'documents'").select("shard", F.posexplode(F.arrays_zip("ids", "lengths")).alias("place", "d"))
        return each.select("shard", "place", F.col("d.ids").alias("id"), F.col("d.lengths").alias("length"))

    def postings(self) -> DataFrame:
        """(term, id, tf, length) of every posting: for audits, not for search."""
        each = self.rows.where("kind = 'postings'").select("shard", "term", F.explode(F.arrays_zip("places", "tfs")).alias("p"))
        each = each.select("shard", "term", F.col("p.places").alias("place"), F.col("p.tfs").cast("long").alias("tf"))
        return each.join(self.documents(), ["shard", "place"]).select("term", "id", "tf", "length")

    def problems(self) -> DataFrame:
        """(check, rows) of every invariant that does not hold; empty for a sound index."""
        found = self.rows.where("kind = 'postings'")
        sizes = (F.size("places") == F.col("n")) & (F.size("tfs") == F.col("n")) & (F.size("top_tf") == F.ceil(F.col("n") / BLOCK)) & (F.size("least_length") == F.size("top_tf"))
        rising = F.size(F.array_distinct("places")) == F.col("n")
        sums = F.aggregate("tfs", F.lit(0).cast("long"), lambda s, x: s + x) == F.col("cf")
        bounds = F.array_max("tfs") == F.array_max("top_tf")
        of_rows = found.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(k) for k, c in {"LIST_SIZES": sizes, "PLACES": rising, "FREQUENCIES": sums, "BOUNDS": bounds}.items()])
        counted = found.groupBy("term").agg(F.sum("n").alias("_df"), F.sum("cf").alias("_cf"))
        terms = self.terms.join(counted, "term", "full")
        same = (F.col("df") == F.col("_df")) & (F.col("cf") == F.col("_cf"))
        of_terms = terms.agg(F.count_if(~F.coalesce(same, F.lit(False))).alias("TERM_COUNTS"), F.count_if(~F.coalesce(F.col("df").between(1, self.fact.n), F.lit(False))).alias("DOCUMENT_FREQUENCY"))
        held = self.documents().groupBy("shard").agg(F.sum("length").alias("length"), F.count("*").alias("docs"))
        posted = found.groupBy("shard").agg(F.sum("cf").alias("posted"))
        of_shards = held.join(posted, "shard", "full").agg(
            F.count_if(F.coalesce("length", F.lit(-1)) != F.coalesce("posted", F.lit(0))).alias("LENGTHS"), (F.coalesce(F.sum("docs"), F.lit(0)) != self.fact.n).cast("long").alias("DOCUMENTS")
        )
        names = ["LIST_SIZES", "PLACES", "FREQUENCIES", "BOUNDS", "TERM_COUNTS", "DOCUMENT_FREQUENCY", "LENGTHS", "DOCUMENTS"]
        one = of_rows.join(F.broadcast(of_terms)).join(F.broadcast(of_shards))
        return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("check"), F.col(k).alias("rows")) for k in names]))).where("rows > 0")

    def verify(self) -> Bm25Index:
        if bad := self.problems().collect():
            raise EngineError(f"the index is unsound: {', '.join(f'{r.check} {r.rows}' for r in bad)}")
        return self

    # -- search -------------------------------------------------------------------------------------

    def _asked(self, queries: DataFrame) -> tuple[DataFrame | _FewQueries, list[str] | None, int]:
        """(the queries' terms: few ones as they are, many as (query_id, term, qtf); the distinct terms where few; pairs)."""
        analyser, kind = self.fact.analyser, queries.schema["id"].dataType
        spec = T.StructType().add("query_id", kind).add("term", "string").add("qtf", "long")
        some = queries.select("id", "text").limit(FEW_QUERIES + 1).collect()
        if len(some) <= FEW_QUERIES:
            analyse, counts = ANALYSERS[analyser](), defaultdict(Counter)
            for r in some:
                counts[r.id].update(analyse(r.text))
            few = _FewQueries(counts)
            return few, sorted(few.terms), sum(map(len, counts.values()))

        def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            analyse = ANALYSERS[analyser]()
            for b in batches:
                for q, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    c = Counter(analyse(text))
                    yield pa.RecordBatch.from_arrays([pa.array([q] * len(c), b.column(0).type), pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], ["query_id", "term", "qtf"])

        each = queries.select("id", "text").mapInArrow(split, spec).groupBy("query_id", "term").agg(F.sum("qtf").alias("qtf"))
        return each, None, each.count()

    def _of_terms(self, table: DataFrame, terms: list[str] | None) -> DataFrame:
        """The rows of asked terms: only their buckets' folders are opened, only row groups that may hold them are read."""
        if terms is None:
            return table
        buckets = sorted({_bucket(w, self.fact.buckets) for w in terms})
        table = table.where(F.col("bucket").isin(buckets))
        return table.where(F.col("term").isin(terms)) if len(terms) <= 200 else table

    def _hits(self, queries: DataFrame, limit: int, scope: Scope | None, allowed_ids: DataFrame | None, positive_only: bool) -> DataFrame:
        """(query_id, id, score, blocks, blocks_read): each shard's best, and a row without id for its blocks."""
        if scope is not None and scope.facets is not None and (unknown := scope.facets - set(self.fact.facets.split(","))):
            raise EngineError(f"the index has no facet {', '.join(sorted(unknown))}")
        fact, kind = self.fact, queries.schema["id"].dataType
        asked, terms, pairs = self._asked(queries)
        few = pairs <= MOST_PAIRS
        statistics = self._of_terms(self.terms, terms).select("term", self._idf(F.col("df")).alias("idf"))
        n_queries = queries.count() if terms is None else 1
        blocks = max(1, -(-n_queries // QUERY_BLOCK))

        def block_of(q: str) -> Column:
            return F.pmod(F.xxhash64(F.col(q)), F.lit(blocks)).cast("int")

        pair_type = T.ArrayType(T.StructType().add("q", kind).add("r", "integer"))
        if terms is not None:
            wanted = _local(self.spark, [(w,) for w in terms], T.StructType().add("term", "string"))
            idf = {r.term: r.idf for r in statistics.join(F.broadcast(wanted), "term", "left_semi").collect()}  # a row for each asked term
            rows = [(w, 0, idf[w], [{"q": q, "r": n} for q, n in by]) for w, by in asked.terms.items() if w in idf]
            asking = _local(self.spark, rows, T.StructType().add("term", "string").add("block", "integer").add("idf", "double").add("asking", pair_type))
        else:
            pair = F.struct(F.col("query_id").alias("q"), F.col("qtf").cast("int").alias("r"))
            weighted = asked.join(F.broadcast(asked.select("term").distinct().join(statistics, "term")) if few else statistics, "term").withColumn("block", block_of("query_id"))
            asking = weighted.groupBy("term", "block", "idf").agg(F.collect_list(pair).alias("asking"))
        lists = self._of_terms(self.rows.where("kind = 'postings'"), terms).join(F.broadcast(asking) if few else asking, "term")
        columns = ["shard", "block", "facet", "places", "tfs", "top_tf", "least_length", "idf", "asking"]
        left = lists.select("shard", "block", F.lit(None).cast("string").alias("facet"), *columns[3:])
        everyone = queries.select(F.col("id").alias("q")).distinct().withColumn("block", block_of("q"))
        general = F.array().cast("array<string>")
        known = terms is not None and (scope is None or scope.own is not None)
        requests = scope.requests if scope is not None else None
        if scope is not None and not known:
            general = requests.where("query_id IS NULL").agg(F.array_sort(F.collect_set("facet")).alias("general"))
            own = requests.where("query_id IS NOT NULL").groupBy(F.col("query_id").alias("q")).agg(F.array_sort(F.collect_set("facet")).alias("facets"))
            everyone = everyone.join(own, "q", "left")
        if scope is not None:
            stored = self.rows.where("kind = 'facets'").select("shard", "facet", "term", "places")
            wanted = requests.withColumnsRenamed({"facet": "_facet", "value": "_value"})
            equal = stored.join(wanted.where("operator = 'is'"), (F.col("facet") == F.col("_facet")) & (F.col("term") == F.col("_value")))
            years = stored.join(F.broadcast(wanted.where("operator <> 'is'")), (F.col("facet") == F.col("_facet")) & F.when(F.col("operator") == "at_most", F.expr("try_cast(term AS int) <= try_cast(_value AS int)")).otherwise(F.expr("try_cast(term AS int) >= try_cast(_value AS int)")))
            met = equal.unionByName(years).withColumn("block", F.explode(F.when(F.col("query_id").isNull(), F.sequence(F.lit(0), F.lit(blocks - 1))).otherwise(F.array(block_of("query_id")))))
            met = met.groupBy("shard", "block", "facet", "term").agg(F.first("places").alias("places"), F.collect_list(F.struct(F.col("query_id").alias("q"), F.lit(0).alias("r"))).alias("asking"))
            nothing = F.lit(None).cast("array<int>")
            left = left.unionByName(met.select("shard", "block", "facet", "places", nothing.alias("tfs"), nothing.alias("top_tf"), nothing.alias("least_length"), F.lit(None).cast("double").alias("idf"), "asking"))
        if known:
            entry = T.ArrayType(T.StructType().add("q", kind).add("facets", T.ArrayType(T.StringType())))
            mine = [{"q": q, "facets": sorted(scope.own.get(q, ())) if scope else []} for q in asked.queries]
            spec = T.StructType().add("block", "integer").add("everyone", entry).add("general", T.ArrayType(T.StringType()))
            per_block = _local(self.spark, [(0, mine, sorted(scope.general) if scope else [])] if mine else [], spec)
        else:
            if "facets" not in everyone.columns:
                everyone = everyone.withColumn("facets", F.lit(None).cast("array<string>"))
            per_block = self._per_block(everyone, general)
        held = self.rows.where("kind = 'documents'").select("shard", "ids", "lengths")
        if allowed_ids is not None:
            inside = self.documents().join(allowed_ids.select("id").distinct(), "id", "left_semi").groupBy("shard").agg(F.collect_list("place").alias("allowed"))
            held = held.join(inside, "shard")  # a shard without an allowed document is not searched
        else:
            held = held.withColumn("allowed", F.lit(None).cast("array<int>"))
        right = held.join(F.broadcast(per_block)).select(F.col("shard").alias("of_shard"), F.col("block").alias("of_block"), "ids", "lengths", "allowed", "everyone", "general")
        spec = T.StructType().add("query_id", kind).add("id", self.schema["ids"].dataType.elementType).add("score", "double").add("blocks", "long").add("blocks_read", "long")
        arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in spec])
        k1, b, mean = fact.k1, fact.b, max(fact.mean, 1e-9)

        def search(found: pa.Table, documents: pa.Table) -> pa.Table:
            if not documents.num_rows:  # none of its documents is allowed
                return arrow.empty_table()
            return _search_shard(found, documents, arrow, k1, b, mean, limit, positive_only)

        return left.groupBy("shard", "block").cogroup(right.groupBy("of_shard", "of_block")).applyInArrow(search, spec)

    @staticmethod
    def _per_block(everyone: DataFrame, general: DataFrame | Column) -> DataFrame:
        listed = everyone.groupBy("block").agg(F.collect_list(F.struct("q", "facets")).alias("everyone"))  # QUERY_BLOCK queries or about so
        return listed.join(F.broadcast(general)) if isinstance(general, DataFrame) else listed.withColumn("general", general)

    def top(self, queries: DataFrame, limit: int, scope: Scope | None = None, allowed_ids: DataFrame | None = None, positive_only: bool = False) -> DataFrame:
        """The best documents of each query (id, text): query_id, id, score, rank.

        ``scope`` and ``allowed_ids`` (id) hold before ranking; statistics are those of all documents.
        A repeated term counts as often as it is repeated. As in exhaustive scoring, documents
        without a query term score 0 and fill up a short list in order of id, unless
        ``positive_only``. A shard gives ``limit`` rows a query.
        """
        hits = self._hits(queries, limit, scope, allowed_ids, positive_only).where("blocks IS NULL")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        return hits.select("query_id", "id", "score", F.row_number().over(order).alias("rank")).where(F.col("rank") <= limit)

    def block_audit(self, queries: DataFrame, limit: int, **options) -> DataFrame:
        """(query_id, blocks, blocks_read): posting blocks of each query's terms, and those that its search read."""
        hits = self._hits(queries, limit, options.get("scope"), options.get("allowed_ids"), options.get("positive_only", False)).where("blocks IS NOT NULL")
        return hits.groupBy("query_id").agg(F.sum("blocks").alias("blocks"), F.sum("blocks_read").alias("blocks_read"))


def _search_shard(found: pa.Table, documents: pa.Table, arrow: pa.Schema, k1: float, b: float, mean: float, limit: int, positive_only: bool) -> pa.Table:
    one = documents.slice(0, 1).to_pylist()[0]
    ids, lengths = one["ids"], np.array(one["lengths"], np.float64)
    norms = k1 * (1 - b + b * lengths / mean)
    size = len(ids)
    general: dict[str, np.ndarray] = {}
    own: dict = {}
    lists: dict = {}
    for batch in found.to_batches():
        plain = {c: batch.column(c).to_pylist() for c in ("facet", "idf", "asking")}
        arrays = {c: batch.column(c) for c in ("places", "tfs", "top_tf", "least_length")}
        for i in range(batch.num_rows):
            places = arrays["places"][i].values.to_numpy()
            facet, asking = plain["facet"][i], plain["asking"][i]
            if facet is not None:
                for x in asking:
                    masks = general if x["q"] is None else own.setdefault(x["q"], {})
                    masks.setdefault(facet, np.zeros(size, bool))[places] = True
                continue
            p = Postings(places, arrays["tfs"][i].values.to_numpy(), arrays["top_tf"][i].values.to_numpy(), arrays["least_length"][i].values.to_numpy(), plain["idf"][i], k1, b, mean)
            for x in asking:
                lists.setdefault(x["q"], []).append((p, x["r"]))
    shared = _allowed(general, one["general"] or (), size)
    if one["allowed"] is not None:
        inside = np.zeros(size, bool)
        inside[one["allowed"]] = True
        shared = inside if shared is None else shared & inside
    columns: dict[str, list] = {f.name: [] for f in arrow}
    for asked in one["everyone"]:
        q = asked["q"]
        mine = _allowed(own.get(q, {}), asked["facets"] or (), size)
        may = shared if mine is None else mine if shared is None else shared & mine
        if may is not None and not may.any():
            continue
        places, scores, blocks, read = best_of_shard(lists.get(q, []), norms, may, limit, positive_only)
        columns["query_id"] += [q] * (len(places) + 1)
        columns["id"] += [*(ids[p] for p in places.tolist()), None]
        columns["score"] += [*scores.tolist(), None]
        columns["blocks"] += [*[None] * len(places), blocks]
        columns["blocks_read"] += [*[None] * len(places), read]
    return pa.table({f.name: pa.array(columns[f.name], f.type) for f in arrow}, schema=arrow)
