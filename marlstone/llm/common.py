"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: White space of the word contract, as a Java/Python character class.
SPACE = r"[\x20\x09-\x0D]"
#: The same six characters, for trim().
SPACE_CHARS = " \t\n\x0b\x0c\r"

_own_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where a local session names none (tests) a temporary folder is made; on a cluster a
    missing setting is an error, for executors don't see each other's disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        key = spark.sparkContext.applicationId
        if key not in _own_folder:
            made = tempfile.mkdtemp(prefix="marlstone-")
            atexit.register(shutil.rmtree, made, ignore_errors=True)
            _own_folder[key] = f"file://{made}"
        base = _own_folder[key]
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/marlstone-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage ends at the files."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(found, True)


def discard(*tables: DataFrame) -> None:
    """Delete the files behind tables made by ``materialise`` that nothing reads any more."""
    for df in tables:
        if files := df.inputFiles():
            _delete(df.sparkSession, files[0].rsplit("/", 1)[0])


def release(spark: SparkSession) -> None:
    """Delete all scratch tables of this application; results that still read them are lost."""
    _delete(spark, f"{shared_folder(spark)}/marlstone-{spark.sparkContext.applicationId}")


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """The maximal runs of non-space characters of a text, in order; none for null or blank text."""
    trimmed = F.btrim(text_or_empty(text), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))


def salted_rank(rows: DataFrame, keys: list[str], order_hash: str, ties: list[str], slot_bits: int = 10) -> DataFrame:
    """Adds ``rank`` (long, from 0): place of the row within its key by (``order_hash``, ``ties``).

    No task ever holds a whole key: rows are dealt by (key, high bits of the hash), numbered
    there, and shifted by the count of the key's lower slots. A key gives at most
    ``2 ** slot_bits`` slots to the prefix sum.
    """
    slotted = rows.withColumn("_slot", F.shiftrightunsigned(F.col(order_hash), 64 - slot_bits).cast("int"))
    counts = slotted.groupBy(*keys, "_slot").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    here = Window.partitionBy(*keys, "_slot").orderBy(order_hash, *ties)
    numbered = slotted.withColumn("_rn", F.row_number().over(here))
    starts = starts.withColumnsRenamed({k: f"_r_{k}" for k in [*keys, "_slot"]})
    joined = numbered.join(starts, _null_safe([*keys, "_slot"]))
    return joined.withColumn("rank", F.col("_start") + F.col("_rn") - 1).drop("_slot", "_start", "_rn", *[f"_r_{k}" for k in [*keys, "_slot"]])


def _null_safe(keys: list[str]) -> Column:
    condition = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        condition = c if condition is None else condition & c
    return condition


# -- rows by key -------------------------------------------------------------------------------

#: Log2 of the bits in a table of hashed keys: 2 ** 18 rows of 64 bits at most.
FILTER_BITS = 24


def key_bits(keys: DataFrame) -> DataFrame:
    """(word, bits) of the hashes in the first column: a bitmap of fixed size, combined in the tasks."""
    slot = F.pmod(F.col(keys.columns[0]), F.lit(1 << FILTER_BITS))
    bits = keys.select(F.shiftright(slot, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
    return bits.groupBy("word").agg(F.bit_or("bit").alias("bits"))


def with_may_hold(df: DataFrame, key: str, bits: DataFrame, name: str) -> DataFrame:
    """Adds ``name``: false where the hash ``key`` is surely not among those of ``key_bits``; no shuffle.

    Only 2 ** FILTER_BITS / 64 rows are broadcast whatever the number of keys. With more keys than
    bits nearly all rows pass, so an exact join must follow.
    """
    slot = F.pmod(F.col(key), F.lit(1 << FILTER_BITS))
    table = bits.withColumnsRenamed({"word": "_word", "bits": "_bits"})
    joined = df.join(F.broadcast(table), F.shiftright(slot, 6) == F.col("_word"), "left")
    bit = F.call_function("shiftrightunsigned", F.col("_bits"), slot.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1))
    return joined.withColumn(name, F.coalesce(bit == 1, F.lit(False))).drop("_word", "_bits")


def keep_decided(docs: DataFrame, decided: DataFrame, key: Callable[[Column], Column], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, but for those that ``decided`` takes out.

    ``decided``: doc_id, key, stays; one row per (doc_id, key) some of whose rows go. Where
    ``stays`` is true one of its rows remains, else none. ``key`` makes the key of a text. Rows
    whose id is not in ``decided`` stay where they are; only the others are shuffled. Columns
    travel in one struct, so that no name can clash.
    """
    carried = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    carried = carried.withColumn("id_hash", F.xxhash64(F.col("row").getField(id_col)))
    flagged = with_may_hold(carried, "id_hash", key_bits(decided.select(F.xxhash64("doc_id").alias("k"))), "maybe").drop("id_hash")
    sure = flagged.where(~F.col("maybe")).select("row.*")
    maybe = flagged.where("maybe").select("row", F.col("row").getField(id_col).alias("_id"), key(F.col("row").getField(text_col)).alias("_key"))
    known = decided.select("doc_id", "key", "stays")
    joined = maybe.join(known, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("key")), "left")
    others = joined.where("stays IS NULL").select("row.*")
    place = Window.partitionBy("_id", "_key").orderBy(F.xxhash64(F.to_json("row")))
    first = joined.where("stays").withColumn("_place", F.row_number().over(place)).where("_place = 1").select("row.*")
    return sure.unionByName(others).unionByName(first)


#: What Python workers remember from task to task, by operator.
_worker_caches: dict[str, dict] = {}


def worker_cache(operator: str) -> dict:
    """A dictionary that lives as long as the Python worker, or until another operator runs in it."""
    for other in _worker_caches:
        if other != operator:
            _worker_caches[other].clear()
    return _worker_caches.setdefault(operator, {})
