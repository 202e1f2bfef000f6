"""Grouping of spelling variants without pairs.

Two words are near if they differ by exactly one inserted, deleted or replaced code point.

- Replaced: a word of length l stands in l wildcard groups (position, prefix, suffix). All members
  of a group are near each other, and two words share at most one.
- Inserted, deleted: a word's deletions meet the word that they spell, if the vocabulary has it.

A group gives each member its size and its best member, or the second best to the best itself, so
rows stay in proportion to the letters of the vocabulary; no pair is made. Groups are as large as
an alphabet allows, whatever the corpus. Forms are followed to their roots by doubling steps.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialise

#: Every hash that this divides loses a code point.
NOISE = 199
#: Keys of more code points are hashed, so that a word's keys take space in proportion to its length.
LITERAL = 64
#: Distinct words that a task counts before it passes them on.
COUNTED = 400_000
#: A-Z become a-z; what is no letter of A-Z, a-z, U+00C0-U+00FF separates words.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
#: Two polynomial hashes modulo a Mersenne prime.
_PRIME, _BASES = (1 << 61) - 1, (1_000_003_333_777, 777_333_000_911_113)


def runs_of(text: str | None) -> list[bytes]:
    """The lower-cased runs of letters of a text, in Latin-1."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split() if text else []


def with_noise(doc_id: int | None, run: bytes) -> bytes:
    """The run, or without the code point that the hash of document and run names."""
    return _noisy(zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()), run)


def _noisy(prefix: int, run: bytes) -> bytes:
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
    if h % NOISE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, least_length: int = 6, least: int = 5) -> DataFrame:
    """(word, n) of all whole texts (doc_id, text), with the noise of ``with_noise``.

    A null doc_id is written as nothing. Tasks count before the shuffle, so a word that a third of
    all rows hold costs a few rows a task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for b in batches:
            for begin in range(0, b.num_rows, 256):
                part = b.slice(begin, 256)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    found: dict[bytes, int] = {}
                    for run, n in Counter(runs_of(text)).items():
                        if len(run) >= least_length:
                            word = _noisy(prefix, run)
                            if len(word) >= least_length:
                                found[word] = found.get(word, 0) + n
                    held.update(found)
                    if len(held) >= COUNTED:
                        yield out()
                        held.clear()
        yield out()

    each = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def hashed_keys(word: str, literal: int) -> tuple[list[str], list[str], str]:
    """(wildcard keys, deletion keys, own key) of a word, in time and space in proportion to its length.

    Deletions of ``literal`` code points are keys themselves.
    """
    n, codes = len(word), [ord(c) + 1 for c in word]
    wild, gone, own = [], [], []
    for base in _BASES:
        ahead, power = [0], [1]
        for c in codes:
            ahead.append((ahead[-1] * base + c) % _PRIME)
            power.append(power[-1] * base % _PRIME)
        behind = [(ahead[n] - ahead[p + 1] * power[n - p - 1]) % _PRIME for p in range(n)]
        wild.append([f"{ahead[p]:x}.{behind[p]:x}" for p in range(n)])
        gone.append([f"{(ahead[p] * power[n - p - 1] + behind[p]) % _PRIME:x}" for p in range(n)])
        own.append(f"{ahead[n]:x}")
    firsts = [p for p in range(n) if p == 0 or word[p] != word[p - 1]]
    deleted = [word[:p] + word[p + 1 :] for p in firsts] if n - 1 <= literal else [f"{n - 1}:{gone[0][p]}.{gone[1][p]}" for p in firsts]
    return [f"{n}:{p}*{wild[0][p]}.{wild[1][p]}" for p in range(n)], deleted, f"{n}:{own[0]}.{own[1]}"


def _keys(words: DataFrame) -> DataFrame:
    """(key, ref, n, role) of words (ref, word, n): role 0 under the word itself, 1 under its wildcards and deletions.

    Wildcard keys hold an asterisk.
    """
    literal = LITERAL
    short = words.where(F.length("word") <= literal)
    at = F.sequence(F.lit(1), F.length("word"))

    def without(p, mark: str):
        return F.concat(F.substring("word", 1, p - 1), F.lit(mark), F.substring(F.col("word"), p + 1, F.length("word")))

    firsts = F.filter(at, lambda p: (p == 1) | (F.substring("word", p, 1) != F.substring("word", p - 1, 1)))  # a run of one letter loses the same whichever goes
    members = F.concat(F.transform(at, lambda p: without(p, "*")), F.transform(firsts, lambda p: without(p, "")))
    own = short.select(F.col("word").alias("key"), "ref", "n", F.lit(0).alias("role"))
    plain = short.select(F.explode(members).alias("key"), "ref", "n", F.lit(1).alias("role"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ref, word, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                wild, gone, own = hashed_keys(word, literal)
                keys = [own, *wild, *gone]
                for begin in range(0, len(keys), 50_000):
                    part = keys[begin : begin + 50_000]
                    roles = [int(begin + i > 0) for i in range(len(part))]
                    yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([ref] * len(part), pa.int64()), pa.array([n] * len(part), pa.int64()), pa.array(roles, pa.int32())], ["key", "ref", "n", "role"])

    long = words.where(F.length("word") > literal).select("ref", "word", "n").mapInArrow(hashed, "key string, ref long, n long, role int")
    return own.unionByName(plain).unionByName(long)


def near_words(words: DataFrame) -> DataFrame:
    """(ref, n_near, best_n, best) of words (ref, word, n) that have a near word; refs rise with the words."""
    order = Window.partitionBy("key").orderBy("role", F.desc("n"), "ref")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    one = F.struct("role", "n", "ref")
    grouped = _keys(words).select(
        "key", "ref", "role",
        F.row_number().over(order).alias("place"), F.count("*").over(whole).alias("size"),
        F.first(one).over(whole).alias("first"), F.nth_value(one, 2).over(whole).alias("second"),
    )
    wild = F.contains(F.col("key"), F.lit("*"))
    meets = grouped.where((F.col("size") > 1) & (wild | (F.col("first.role") == 0)))
    best = F.when(F.col("place") == 1, F.col("second")).otherwise(F.col("first"))
    seen = F.when(wild | (F.col("role") == 0), F.col("size") - 1).otherwise(1)
    each = meets.select("ref", seen.alias("seen"), best["n"].alias("n"), best["ref"].alias("other"))
    found = each.groupBy("ref").agg(F.sum("seen").alias("n_near"), F.max("n").alias("best_n"), F.min(F.struct((-F.col("n")).alias("m"), "other")).alias("b"))
    return found.select("ref", "n_near", "best_n", F.col("b.other").alias("best"))


def roots(links: DataFrame, steps: int) -> DataFrame:
    """(ref, root) of links (ref, form): the last word that forms lead to, at most 2 ** ``steps`` links on."""
    hop = materialise(links.select("ref", F.col("form").alias("root")), "spelling-hops")
    for _ in range(steps):
        on = hop.select(F.col("ref").alias("at"), F.col("root").alias("further"))
        further = materialise(hop.join(on, F.col("root") == F.col("at"), "left").select("ref", F.coalesce("further", "root").alias("root")), "spelling-hops")
        discard(hop)
        hop = further
    return hop


def variant_forms(words: DataFrame, ratio: int = 5) -> DataFrame:
    """Of words (word, n): word, form, root, n, n_near, form_n.

    ``form``: of the near words the one of largest n, the smallest in code-point order among equals,
    if its n is at least ``ratio`` times the word's; else null, as ``form_n``. ``root``: from the
    word along forms to the last one. Words of more than ``LITERAL`` code points are compared by
    122-bit hashes. ``ratio`` is 2 at least, so that forms lead somewhere. No words give no rows.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 at least")
    numbered = materialise(words.select("word", "n").orderBy("word").withColumn("ref", F.monotonically_increasing_id()), "spelling-words")
    near = materialise(near_words(numbered), "spelling-near")
    most = numbered.agg(F.max("n")).first()[0] or 1
    depth = 0
    while ratio**depth <= most:  # n grows by ``ratio`` with every form
        depth += 1
    held = numbered.join(near, "ref", "left").withColumn("form_ref", F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best")))
    links = held.where("form_ref IS NOT NULL").select("ref", F.col("form_ref").alias("form"))
    ends = roots(links, max(0, (depth - 1).bit_length()))
    names = numbered.select(F.col("ref").alias("r"), F.col("word").alias("name"))
    out = held.join(ends, "ref", "left").withColumn("root_ref", F.coalesce("root", "ref")).drop("root")
    out = out.join(names.withColumnsRenamed({"r": "fr", "name": "form"}), F.col("form_ref") == F.col("fr"), "left")
    out = out.join(names.withColumnsRenamed({"r": "rr", "name": "root"}), F.col("root_ref") == F.col("rr"))
    form_n = F.when(F.col("form_ref").isNotNull(), F.col("best_n"))
    return out.select("word", "form", "root", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), form_n.alias("form_n"))


def spelling_variants(docs: DataFrame, ratio: int = 5, least_length: int = 6, least: int = 5) -> DataFrame:
    """``variant_forms`` of the words of all whole texts: word, form, root, n, n_near, form_n.

    Null texts have no words, a null doc_id counts as an empty one. Repeated rows count again, extra
    columns are ignored, an empty table gives an empty result.
    """
    return variant_forms(count_words(docs, least_length, least), ratio)
