"""Best-fit packing of token sequences.

All pieces are packed best-fit decreasing, over all documents at once. Pieces of equal length are interchangeable, so the
packing is planned over counts by length: for each length, longest first, a segment tree over
the remaining capacities finds the tightest open bins in logarithmic time. Bins are held as
intervals of sequence numbers with equal remaining capacity, so the planner's memory depends on
the number of lengths (at most ``capacity``), not on the number of documents. The plan gives
each (length, rank) its sequence and offset; ranks are numbered without gathering a length in
one task.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, salted_rank, worker_cache

#: Words that are one run of letters to the tokenizer, before and after its normalisation.
LETTERS = "[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+"
PLAIN = re.compile(LETTERS)
#: A run of letters, then a run of marks: two tokens of their own.
MARKED = re.compile(f"({LETTERS})([!-/:-@\\[-`{{-~]+)")


class WordEncoder:
    """Token ids, as little-endian unsigned 32-bit bytes, of whole texts.

    The tokenizer never joins across white space, so a text's ids are those of its words in
    order. Words are remembered, at most ``2 * remembered`` of them; those unknown are encoded
    together. ASCII letters are lower-cased first, as the tokenizer itself does.
    """

    def __init__(self, vocabulary_file: str, remembered: int = 350_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(vocabulary_file)
        self.tokenizer.encode_special_tokens = True
        # for runs of letters nothing is left to normalise and only white space to split at
        self.plain_tokenizer = Tokenizer.from_file(vocabulary_file)
        self.plain_tokenizer.encode_special_tokens = True
        self.plain_tokenizer.normalizer = normalizers.Sequence([])
        self.plain_tokenizer.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.most = remembered
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _encode_words(self, words: list[str]) -> None:
        """Runs of letters end in one end-of-word token each, so they can be encoded as one text."""
        plain = [w for w in words if PLAIN.fullmatch(w)]
        rest = [w for w in words if not PLAIN.fullmatch(w)]
        for begin in range(0, len(plain), 1000):
            part = plain[begin : begin + 1000]
            ids = np.array(self.plain_tokenizer.encode_batch_fast([" ".join(part).lower()], add_special_tokens=False)[0].ids, "<u4")
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            assert len(cuts) == len(part)
            raw = ids.tobytes()
            self.young.update((w.encode(), raw[a:b]) for w, a, b in zip(part, [0, *cuts], cuts))
        for begin in range(0, len(rest), 1000):
            part = rest[begin : begin + 1000]
            for w, got in zip(part, self.tokenizer.encode_batch(part, add_special_tokens=False), strict=True):
                self.young[w.encode()] = np.array(got.ids, "<u4").tobytes()

    def __call__(self, texts) -> list[bytes]:
        split = [t.encode("utf-8", "replace").lower().split() if isinstance(t, str) else [] for t in texts]
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        found = [list(map(young.get, ws)) for ws in split]  # one look-up a word
        holes = [(got, ws, [i for i, x in enumerate(got) if x is None]) for got, ws in zip(found, split, strict=True) if None in got]
        todo, joined = set(), []
        for w in {ws[i] for _, ws, at in holes for i in at}:
            if w in old:
                young[w] = old[w]
                continue
            s = w.decode()
            m = MARKED.fullmatch(s)
            if not m:
                todo.add(s)
                continue
            parts = m[1].encode(), m[2].encode()
            joined.append((w, *parts))
            for x, part in zip(parts, m.groups(), strict=True):
                if x in old:
                    young[x] = old[x]
                elif x not in young:
                    todo.add(part)
        self._encode_words(sorted(todo))
        for w, word, marks in joined:
            young[w] = young[word] + young[marks]
        for got, ws, at in holes:
            for i in at:
                got[i] = young[ws[i]]
        return list(map(b"".join, found))


def worker_encoder(vocabulary_file: str) -> WordEncoder:
    """One encoder for each Python worker: the tasks it runs share the words it remembers."""
    encoders = worker_cache("packing")
    if vocabulary_file not in encoders:
        encoders[vocabulary_file] = WordEncoder(vocabulary_file)
    return encoders[vocabulary_file]


def tokenize_pieces(docs: DataFrame, vocabulary_file: str, capacity: int = 4096, end_id: int = 1, keep_ids: bool = False) -> DataFrame:
    """Pieces of every whole text: doc_id, row_no (of the document), piece, start, length, ids_crc32 (and ids).

    Null text is empty text: its only token is ``end_id``. Only texts of more than ``capacity``
    tokens are cut.
    """
    end = np.array([end_id], "<u4").tobytes()
    fields = "doc_id long, row_no long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64()] + ([pa.binary()] if keep_ids else [])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_encoder(vocabulary_file)
        for b in batches:
            for begin in range(0, b.num_rows, 50):
                part = b.slice(begin, 50)
                rows, source = [], []
                for at_row, ids in enumerate(encode(part.column(2).to_pylist())):
                    ids += end
                    for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                        x = ids[at : at + 4 * capacity]
                        source.append(at_row)
                        rows.append((n, at // 4, len(x) // 4, zlib.crc32(x), *([x] if keep_ids else [])))
                made = [pa.array(column, t) for column, t in zip(zip(*rows), types, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(source)), part.column(1).take(pa.array(source)), *made], [f.split()[0] for f in fields.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("row_no"), "text").mapInArrow(cut, fields)


class TightestBin:
    """Segment tree over remaining capacities 0..capacity: the smallest one that is open and at least so large."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.size)

    def set(self, remaining: int, is_open: bool) -> None:
        i = remaining + self.size
        self.open[i] = is_open
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def at_least(self, need: int) -> int | None:
        i = need + self.size
        if self.open[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.open[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def plan_best_fit(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """(length, first rank, first sequence, offset) of each run of equal pieces, and the number of sequences.

    The pieces of a length are numbered from 0; a run lasts to the next one of its length.
    """
    tree, bins, plan, sequences = TightestBin(capacity), {}, [], 0

    def keep(r: int, first: int, n: int) -> None:
        if n and r:
            bins.setdefault(r, []).append((first, n))
            tree.set(r, True)

    for length in sorted((n for n in counts if counts[n] > 0), reverse=True):
        left, rank = counts[length], 0
        while left:
            r = tree.at_least(length)
            if r is None:
                r, first, held = capacity, sequences, -(-left // (capacity // length))
                sequences += held
            else:
                first, held = bins[r].pop()
                if not bins[r]:
                    tree.set(r, False)
            # a bin that took a piece is the tightest until no further one of this length fits
            each = r // length
            full = min(held, left // each)
            rest = left - full * each if full < held else 0
            for layer in range(each if full else 0):
                plan.append((length, rank, first, capacity - r + layer * length))
                rank += full
            for layer in range(rest):
                plan.append((length, rank, first + full, capacity - r + layer * length))
                rank += 1
            left -= full * each + rest
            keep(r - each * length, first, full)
            keep(r - rest * length, first + full, 1 if rest else 0)
            keep(r, first + full + (1 if rest else 0), held - full - (1 if rest else 0))
    return plan, sequences


def place(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """Adds sequence_id and offset to rows of row_no, piece, length (at most ``capacity``).

    (row_no, piece) tells pieces apart, also those of repeated rows; it must be stored, not made anew.
    """
    spark = pieces.sparkSession
    keyed = pieces.withColumn("_h", F.xxhash64("row_no", "piece"))
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # ``capacity`` rows at most
    plan, _ = plan_best_fit(counts, capacity)
    plan = sorted(plan)
    shift = max([1, *counts.values()]).bit_length()
    keys = np.array([(n << shift) + rank for n, rank, _, _ in plan], np.int64)
    ranks = np.array([p[1] for p in plan], np.int64)
    firsts = np.array([p[2] for p in plan], np.int64)
    offsets = np.array([p[3] for p in plan], np.int64)
    shared = spark.sparkContext.broadcast((keys, ranks, firsts, offsets))
    ranked = salted_rank(keyed, ["length"], "_h", ["row_no", "piece"]).drop("_h")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank") + ", sequence_id long, offset long"

    columns = [c for c in ranked.columns if c != "rank"]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ranks, firsts, offsets = shared.value
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            at = np.searchsorted(keys, (length << shift) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), pa.array(firsts[at] + rank - ranks[at]), pa.array(offsets[at])], [*columns, "sequence_id", "offset"])

    return ranked.mapInArrow(look_up, schema)


def pack(docs: DataFrame, vocabulary_file: str, capacity: int = 4096, end_id: int = 1, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    The strings of the vocabulary's special tokens are ordinary text in a document. Every whole text is tokenized; ``offset`` runs gapless from 0 in each sequence. Null texts
    are empty texts. Repeated rows and null ids are packed like any others, extra columns are
    ignored, an empty table gives an empty result.
    """
    pieces = materialise(tokenize_pieces(docs, vocabulary_file, capacity, end_id, keep_ids), "packing-pieces")
    return place(pieces, capacity).drop("row_no")
