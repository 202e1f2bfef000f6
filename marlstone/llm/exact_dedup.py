"""Exact dedup through an extendible-hash index on shared files.

Texts are equal when their bytes are equal after each run of white space became one space.

1. A light row (row number, doc_id, 64-bit hash, SHA-256) per document is written to the shared
   folder, and from these one entry per (hash, SHA-256), which buckets are filled with.
2. The directory starts with one bucket. While a bucket holds more entries than ``capacity`` it
   is split on its next hash bit, doubling the directory where needed. Entries are counted by
   ``step_bits`` bits at a time, and only below prefixes that are still overfull, so depth has
   no limit; a bucket whose entries all have one hash can't be split and stays a chain. The
   directory is kept as its buckets, (depth, prefix): slots that share a bucket are not repeated.
3. A text needs comparing only where its hash occurs more than once. Such texts are combined
   inside each map task first, so a text that a third of all rows repeat costs one row per task
   (and ``PARTS`` rows after that), and then go to the owner task of their bucket.
4. An owner walks the texts of each hash of its buckets in order, comparing bytes: every change
   begins the next link of the chain. It counts the rows of each link, finds its smallest doc_id and
   writes the index.
5. The light rows find bucket, hash and link in the index, which names the row that stays. Links
   of large groups are broadcast to their rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE, discard, keep_decided, key_bits, materialise, text_or_empty, with_may_hold

#: Rows that one text of one hash may send to its owner at most.
PARTS = 32
#: Buckets for each shuffle partition, and the most entries of a bucket, where no capacity is given.
BUCKETS_A_TASK, LARGEST_BUCKET = 8, 65_536
#: Counts of hash cells that the driver holds at a time.
CELLS = 1 << 20
#: Rows of a group from which on its link is broadcast to them.
LARGE_GROUP = 10_000
#: Directories of more buckets than this are joined by a shuffle instead of a broadcast.
MOST_BROADCAST = 1_000_000


def normalised_text(text):
    return F.regexp_replace(text_or_empty(text), SPACE + "+", " ")


def build_directory(cells: dict[int, int], max_depth: int, capacity: int) -> tuple[int, list[int], list[tuple[int, int]]]:
    """(global depth, bucket of each directory slot, (local depth, prefix) of each bucket).

    ``cells``: entries by the first ``max_depth`` bits of their hash.
    """
    below = [0] * (2**max_depth + 1)
    for cell in range(2**max_depth):
        below[cell + 1] = below[cell] + cells.get(cell, 0)

    def held(depth: int, prefix: int) -> int:
        width = 2 ** (max_depth - depth)
        return below[(prefix + 1) * width] - below[prefix * width]

    global_depth, slots, buckets = 0, [0], [(0, 0)]
    todo = [0]
    while todo:
        b = todo.pop()
        depth, prefix = buckets[b]
        if depth == max_depth or held(depth, prefix) <= capacity:
            continue
        if depth == global_depth:
            slots = [s for s in slots for _ in (0, 1)]
            global_depth += 1
        buckets[b] = (depth + 1, 2 * prefix)
        buckets.append((depth + 1, 2 * prefix + 1))
        new = len(buckets) - 1
        width = 2 ** (global_depth - depth - 1)
        for slot in range((2 * prefix + 1) * width, (2 * prefix + 2) * width):
            slots[slot] = new
        todo += [b, new]
    order = sorted(range(len(buckets)), key=lambda b: buckets[b][1] / 2 ** buckets[b][0])
    place = {b: i for i, b in enumerate(order)}
    return global_depth, [place[s] for s in slots], [buckets[b] for b in order]


def _prefix(h: str, depth):
    """The first ``depth`` bits of a hash; a shift by 64 bits would be a shift by none."""
    shifted = F.call_function("shiftrightunsigned", F.col(h), (64 - depth).cast("int"))
    return F.when(depth == 0, F.lit(0).cast("long")).otherwise(shifted)


def _as_table(spark: SparkSession, buckets: list[tuple[int, int]]) -> DataFrame:
    """(_d, _p) of the buckets, from one literal."""
    text = ",".join(f"{d}:{p - (1 << 64) if p >= 1 << 63 else p}" for d, p in buckets)
    each = spark.range(1).select(F.explode(F.split(F.lit(text), ",")).alias("x"))
    return each.select(F.split_part("x", F.lit(":"), F.lit(1)).cast("int").alias("_d"), F.split_part("x", F.lit(":"), F.lit(2)).cast("long").alias("_p"))


def grow_directory(entries: DataFrame, capacity: int, step_bits: int) -> list[tuple[int, int]]:
    """(depth, prefix) of all buckets; the driver holds two numbers a bucket, and ``CELLS`` counts at a time.

    Every round counts entries by the next bits of the prefixes still overfull: as many bits as
    even hashes need and two more, ``step_bits`` at most.
    """
    spark, done = entries.sparkSession, []
    grown, most, depth = [0], entries.count(), 0
    while grown:
        step = min(step_bits, 64 - depth, (most // capacity).bit_length() + 2)
        larger, most = [], 0
        for part in range(0, len(grown), max(1, CELLS >> step)):
            prefixes = grown[part : part + max(1, CELLS >> step)]
            rows = entries.select("h", _prefix("h", F.lit(depth)).alias("p"))
            if depth:
                known = _as_table(spark, [(depth, p) for p in prefixes]).hint("shuffle_hash")
                rows = rows.join(known, F.col("p") == F.col("_p"), "left_semi")
            cells = rows.groupBy("p", _prefix("h", F.lit(depth + step)).alias("cell")).agg(F.count("*").alias("n"), (F.min("h") < F.max("h")).alias("several"))
            found: dict[int, dict[int, tuple[int, bool]]] = {p: {} for p in prefixes}
            for r in cells.collect():  # CELLS rows at most
                found[r.p][r.cell & ((1 << step) - 1)] = (r.n, r.several)
            for p, counted in found.items():
                _, _, buckets = build_directory({c: n for c, (n, _) in counted.items()}, step, capacity)
                for d, q in buckets:
                    n, several = counted.get(q, (0, False)) if d == step else (0, False)
                    if n > capacity and several and depth + d < 64:
                        larger.append((p << d) | q)
                        most = max(most, n)
                    else:
                        done.append((depth + d, (p << d) | q))
        grown, depth = larger, depth + step
    return done


class Directory:
    """Finds the bucket of a hash: one equi-join on (depth, prefix) over the depths that occur."""

    def __init__(self, spark, buckets: list[tuple[int, int]]):
        self.depths = sorted({d for d, _ in buckets})
        table = _as_table(spark, buckets)
        if len(buckets) > 10_000:  # no long literal in every plan
            table = materialise(table, "dedup-directory")
        self.table = F.broadcast(table) if len(buckets) <= MOST_BROADCAST else table

    def find(self, df: DataFrame) -> DataFrame:
        """Adds ``depth`` and ``prefix`` of the bucket that holds ``h``."""
        tried = F.array(*[F.struct(F.lit(d).alias("depth"), _prefix("h", F.lit(d)).alias("prefix")) for d in self.depths])
        each = df.select("*", F.inline(tried))
        return each.join(self.table, (F.col("depth") == F.col("_d")) & (F.col("prefix") == F.col("_p"))).drop("_d", "_p")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int | None = None, step_bits: int = 12, hash_bits: int = 64) -> tuple[DataFrame, DataFrame, Directory]:
    """(rows, index, directory); the tables lie on shared files.

    rows: row_no, doc_id, h, text_sha256, one per document. index: depth and prefix of the bucket,
    h, chain, text_sha256, keep_id, keep_row, group_size, one per distinct text. ``capacity``:
    entries of a bucket; where None, as many as give each shuffle partition ``BUCKETS_A_TASK``
    buckets, at most ``LARGEST_BUCKET``. ``hash_bits`` below 64 makes collisions likely, for tests.
    """
    spark = docs.sparkSession
    text = docs.select(F.col(id_col).alias("doc_id"), normalised_text(F.col(text_col)).alias("norm"))
    h = F.xxhash64("norm")
    if hash_bits == 0:
        h = F.lit(0).cast("long")
    elif hash_bits < 64:
        h = F.shiftleft(F.shiftrightunsigned(h, 64 - hash_bits), 64 - hash_bits)
    rows = materialise(text.select(F.monotonically_increasing_id().alias("row_no"), "doc_id", h.alias("h"), F.sha2("norm", 256).alias("text_sha256")), "dedup-rows")
    one = F.min(F.struct("doc_id", "row_no")).alias("one")
    entries = materialise(rows.groupBy("h", "text_sha256").agg(F.count("*").alias("n"), one), "dedup-entries")
    if capacity is None:
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        capacity = min(LARGEST_BUCKET, max(1, entries.count() // (BUCKETS_A_TASK * tasks)))
    directory = Directory(spark, grow_directory(entries, capacity, step_bits))

    hashes = materialise(entries.groupBy("h").agg(F.sum("n").alias("n"), F.first("text_sha256").alias("text_sha256"), F.first("one").alias("one")), "dedup-hashes")
    asked = with_may_hold(text.select("doc_id", "norm", h.alias("h")), "h", key_bits(hashes.where("n > 1").select("h")), "maybe").where("maybe")
    chains = materialise(own_chains(asked, hashes, directory), "dedup-chains")
    # of rows that share text and smallest doc_id, one stays; keyed by doc_id, too, so a large group is spread
    named = chains.select(F.col("h").alias("_h"), F.col("text_sha256").alias("_sha"), "keep_id")
    mine = (F.col("h") == F.col("_h")) & (F.col("text_sha256") == F.col("_sha")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    least = rows.join(named, mine).groupBy("h", "text_sha256").agg(F.min("row_no").alias("keep_row"))
    repeated = chains.join(least, ["h", "text_sha256"])
    single = directory.find(hashes.where("n = 1").select("h", "text_sha256", F.col("one.doc_id").alias("keep_id"), F.col("one.row_no").alias("keep_row")))
    columns = ["depth", "prefix", "h", "chain", "text_sha256", "keep_id", "keep_row", "group_size"]
    single = single.withColumns({"chain": F.lit(0).cast("long"), "group_size": F.lit(1).cast("long")})  # no chain to walk
    index = materialise(single.select(columns).unionByName(repeated.select(columns)), "dedup-index")
    discard(entries, hashes, chains)
    return rows, index, directory


def own_chains(asked: DataFrame, hashes: DataFrame, directory: Directory) -> DataFrame:
    """(depth, prefix, h, chain, text_sha256, keep_id, group_size) of the texts (doc_id, norm, h) whose hash is repeated.

    An owner holds whole buckets. It walks the texts of a hash in order and compares bytes; each
    link of the chain gathers its rows and the smallest doc_id, and so names the one that stays.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("first")
    part = F.pmod(F.spark_partition_id(), F.lit(PARTS))
    combined = asked.select("doc_id", "h", "norm", part.alias("part")).groupBy("h", "part", "norm").agg(F.count("*").alias("n"), first)
    wanted = hashes.where("n > 1").select(F.col("h").alias("_h"))
    combined = combined.join(wanted, F.col("h") == F.col("_h"), "left_semi")  # what the bitmap let through by chance goes
    owned = directory.find(combined.select("h", "norm", "n", "first")).repartition("depth", "prefix")
    walk = Window.partitionBy("depth", "prefix", "h").orderBy("norm")
    differs = F.coalesce(F.lag("norm").over(walk) != F.col("norm"), F.lit(True))
    linked = owned.withColumn("differs", differs.cast("int"))
    linked = linked.withColumn("chain", F.sum("differs").over(walk.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    links = linked.groupBy("depth", "prefix", "h", "chain").agg(F.first(F.sha2("norm", 256)).alias("text_sha256"), F.sum("n").alias("group_size"), F.min("first").alias("first"))
    return links.select("depth", "prefix", "h", "chain", "text_sha256", F.col("first.doc_id").alias("keep_id"), "group_size")


def _looked_up(docs: DataFrame, **options) -> DataFrame:
    rows, index, directory = build_index(docs, **options)
    answers = ["keep_id", "group_size", "keep_row"]
    large = index.where(F.col("group_size") >= LARGE_GROUP)
    if 0 < large.count() <= MOST_BROADCAST:
        # the rows of a large group meet its link where they are
        known = large.select(F.col("h").alias("_h"), F.col("text_sha256").alias("_sha"), *answers)
        marked = rows.join(F.broadcast(known), (F.col("h") == F.col("_h")) & (F.col("text_sha256") == F.col("_sha")), "left").drop("_h", "_sha")
        hot = marked.where("group_size IS NOT NULL")
        rows, index = marked.where("group_size IS NULL").drop(*answers), index.where(F.col("group_size") < LARGE_GROUP)
    else:
        hot = None
    found = directory.find(rows).join(index, ["depth", "prefix", "h", "text_sha256"]).select("row_no", "doc_id", "text_sha256", *answers)
    found = found if hot is None else found.unionByName(hot.select(found.columns))
    return found.select("doc_id", "keep_id", "group_size", (F.col("row_no") == F.col("keep_row")).alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame, **options) -> DataFrame:
    """One row per document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256.

    The row with the smallest doc_id of each group of equal texts stays. Null text is empty
    text and takes part like any other. A null doc_id comes after all others; where rows of a
    group share the smallest doc_id, exactly one of them is kept. Extra columns are ignored;
    an empty table gives an empty result.
    """
    return _looked_up(docs, **options)


def drop_copies(docs: DataFrame, **options) -> DataFrame:
    """The documents, with all their columns, that ``exact_dedup`` keeps: one row of each group.

    Null text is empty text; of several such rows one stays. Where a null doc_id is the only id
    of a group, one of its rows stays. Of rows that repeat a kept doc_id with an equal text one
    stays, the first by a hash of its columns. Extra columns are kept, whatever their names; an
    empty table gives an empty result.
    """
    found = _looked_up(docs, **options)
    decided = found.where("group_size > 1").groupBy("doc_id", F.col("text_sha256").alias("key")).agg(F.max("kept").alias("stays"), F.count("*").alias("n"))
    decided = materialise(decided.where("n > 1 OR NOT stays").select("doc_id", "key", "stays"), "dedup-decided")
    return keep_decided(docs, decided, lambda text: F.sha2(normalised_text(text), 256))
