"""Language identification by segmentation-marginalised unigrams.

The pieces of a fixed public vocabulary are the alphabet. For each language expectation
maximisation learns a probability per piece. A word's probability is the sum over all its
segmentations into pieces, by the forward algorithm; a text's is the product over its words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: A word: letters (category L) with the marks (M) on them. Fractions, roman numerals and the like are no letters.
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: Pieces up to so many letters are looked up at every place; longer ones only where their first letters occur.
SHORT = 5


class Pieces:
    """Letter pieces of a sentencepiece vocabulary by number; ``longest``: letters of the longest.

    The last two numbers are "any other single letter" and "no piece".
    """

    def __init__(self, vocabulary_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_file)
        texts = (model.id_to_piece(i).replace("\u2581", "").lower() for i in range(model.get_piece_size()))
        self.of = {p: i for i, p in enumerate(sorted({t for t in texts if t.isalpha()}))}
        self.longest = max(map(len, self.of), default=1)
        self.stems = {p[:SHORT] for p in self.of if len(p) > SHORT}
        self.other = len(self.of)
        self.none = self.other + 1

    def numbers(self, words: list[str]) -> np.ndarray:
        """(words, length, longest): the piece that ends at a letter and has so many letters more than one; all of one length."""
        n, get, none, longest = len(words[0]), self.of.get, self.none, self.longest
        cuts = [(j - k, j) for j in range(1, n + 1) for k in range(1, min(SHORT, longest, j) + 1)]
        found = np.fromiter([get(w[a:b], none) for w in words for a, b in cuts], np.int32, len(words) * len(cuts))
        out = np.full((len(words), n, longest), none, np.int32)
        out[:, [b - 1 for _, b in cuts], [b - a - 1 for a, b in cuts]] = found.reshape(len(words), -1)
        starts, stems = range(n - SHORT), self.stems
        for i, w in enumerate(words):
            for a in starts:
                if w[a : a + SHORT] in stems:
                    for b in range(a + SHORT + 1, min(n, a + longest) + 1):
                        out[i, b - 1, b - a - 1] = get(w[a:b], none)
        single = out[:, :, 0]
        single[single == none] = self.other
        return out


def _by_length(words: list[str], at_once: int = 2000) -> Iterator[tuple[list[int], list[str]]]:
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    begin = 0
    while begin < len(order):
        n, end = len(words[order[begin]]), begin
        most = max(1, at_once * 12 // n)
        while end < len(order) and end - begin < most and len(words[order[end]]) == n:
            end += 1
        yield order[begin:end], [words[i] for i in order[begin:end]]
        begin = end


def word_scores(words: list[str], pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """log P(word) for each word and language; ``p``: (pieces + 2, languages).

    The forward sums are rescaled every eight letters, so words of any length keep full precision.
    """
    out = np.empty((len(words), p.shape[1]))
    for where, same in _by_length(words):
        x = pieces.numbers(same)
        ends = (x != pieces.none).any(0)  # where any of the words has a piece
        sums = [np.ones((len(same), p.shape[1]))]  # forward sums of the last letters, the newest last
        log = np.zeros((len(same), p.shape[1]))
        for j in range(x.shape[1]):
            sums.append(sum(sums[-1 - k] * p[x[:, j, k]] for k in np.flatnonzero(ends[j, : j + 1])))
            if j % 8 == 7 or j == x.shape[1] - 1:
                now = sums[-1]
                log += np.log(now)
                sums = [s / now for s in sums[-pieces.longest :]]
        out[where] = log
    return out


def fit_pieces(counts: dict[str, int], pieces: Pieces, rounds: int = 4, smoothing: float = 0.05, letters_kept: int = 2_000_000) -> np.ndarray:
    """Piece probabilities of one language from word counts, by expectation maximisation.

    Words of any length teach: forward sums are rescaled at every letter. The piece numbers of
    about ``letters_kept`` letters are kept between rounds; those of further words are made anew.
    """
    words, longest = list(counts), pieces.longest
    p = np.full(pieces.none + 1, 1.0 / (pieces.none + 1))
    p[pieces.none] = 0.0
    batches, held = [], 0
    for _, same in _by_length(words):
        held += len(same) * len(same[0])
        batches.append((same, pieces.numbers(same) if held <= letters_kept else None, np.array([counts[w] for w in same], float)))
    for _ in range(rounds):
        expected = np.full(pieces.none + 1, smoothing)
        for same, x, n in batches:
            if x is None:
                x = pieces.numbers(same)
            q = p[x]
            m, length, _ = x.shape
            before = np.empty((m, length, longest))  # forward sums where a piece starts, over that of the letter before
            now = np.empty((m, length, 1))  # forward sum of a letter over that of the letter before
            window = np.zeros((m, longest))
            window[:, 0] = 1.0
            for j in range(length):
                before[:, j] = window
                now[:, j, 0] = (window * q[:, j]).sum(1)
                window[:, 1:] = window[:, :-1] / now[:, j]
                window[:, 0] = 1.0
            share = before * q / now  # of the segmentations up to a letter, by their last piece
            cut = np.zeros((m, length + 1))  # probability that a piece ends there
            cut[:, length] = 1.0
            for j in range(length - 1, -1, -1):
                share[:, j] *= cut[:, j + 1 : j + 2]
                k = min(longest, j + 1)
                cut[:, j - k + 1 : j + 1] += share[:, j, :k][:, ::-1]
            expected += np.bincount(x.ravel(), (share * n[:, None, None]).ravel(), minlength=len(p))
        expected[pieces.none] = 0.0
        p = expected / expected.sum()
    return p


def train(docs: DataFrame, vocabulary_file: str, max_docs: int = 1500, together: int = 1000) -> dict[str, np.ndarray] | DataFrame:
    """Piece probabilities by language, from the texts and non-null ``lang`` of ``docs``.

    Of each language at most ``max_docs`` documents are read: those of the smallest hash of
    their id, whatever the size of the table. A hash threshold from the languages' counts leaves
    about twice as many before they are ranked. Up to ``together`` languages come back as a
    dictionary, which every task can hold; more as a stored table (lang, p), which ``identify``
    takes in blocks.
    """
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text", "lang")
    counts = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    few = counts.limit(together + 1).count() <= together
    bits = 40
    limits = counts.select(F.col("lang").alias("_lang"), F.expr(f"least({1 << bits}L, {2 * max_docs << bits}L div n)").alias("_limit"))
    hashed = labelled.select("doc_id", "lang", F.xxhash64("doc_id").alias("h")).join(F.broadcast(limits) if few else limits, F.col("lang") == F.col("_lang"))
    hashed = hashed.where(F.pmod("h", F.lit(1 << bits)) < F.col("_limit"))
    place = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << bits)), "doc_id")
    chosen = hashed.select("doc_id", "lang", "h").distinct().withColumn("_n", F.row_number().over(place)).where(F.col("_n") <= max_docs)
    chosen = chosen.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"))
    sample = labelled.join(F.broadcast(chosen) if few else chosen, (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")))  # max_docs a language at most

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: dict[str, Counter] = {}
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found.setdefault(lang, Counter()).update(WORD.findall(text.lower()))
            for lang, n in found.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["lang", "word", "n"])

    def fitted(rows: pd.DataFrame) -> pd.DataFrame:
        p = fit_pieces(dict(zip(rows.word, rows.n, strict=True)), Pieces(vocabulary_file))
        return pd.DataFrame({"lang": rows.lang.iloc[:1], "p": [p.astype("<f8").tobytes()]})

    counts = sample.select("text", "lang").mapInArrow(counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    found = counts.groupBy("lang").applyInPandas(lambda rows: fitted(rows), "lang string, p binary")
    return _as_models(found) if few else materialise(found, "language-models")


def _as_models(rows: DataFrame) -> dict[str, np.ndarray]:
    """Models of a table (lang, p) of few languages, in order of their names."""
    return {r.lang: np.frombuffer(bytes(r.p), "<f8") for r in sorted(rows.collect(), key=lambda r: r.lang)}


def learning_rows(docs: DataFrame) -> DataFrame:
    """The rows outside the held-out fold: crc32(doc_id as text) mod 4 is not 2."""
    return docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)


class Scorer:
    """Scores texts; remembers the scores of at most ``remembered`` words."""

    def __init__(self, model: dict[str, np.ndarray], vocabulary_file: str, remembered: int = 300_000):
        self.langs, self.pieces, self.most = list(model), Pieces(vocabulary_file), remembered
        self.p = np.stack(list(model.values()), 1) if model else np.zeros((0, 0))
        self.place: dict[str, int] = {}
        self.table = np.empty((0, len(self.langs)))

    def totals(self, texts) -> Iterator[np.ndarray | None]:
        """The log probability of each text in every language; None without a letter or a language."""
        found = [WORD.findall(t.lower()) if isinstance(t, str) else [] for t in texts]
        if len(self.place) > self.most:
            self.place, self.table = {}, self.table[:0]
        new = list({w for ws in found for w in ws if w not in self.place})
        if new and self.langs:
            start = len(self.place)
            self.table = np.concatenate([self.table, word_scores(new, self.pieces, self.p)])
            self.place.update(zip(new, range(start, start + len(new)), strict=True))
        for ws in found:
            if ws and self.langs:
                yield self.table[np.fromiter(map(self.place.__getitem__, ws), np.int64, len(ws))].sum(0)
            else:
                yield None

    def __call__(self, texts) -> list[tuple[str, float]]:
        out = []
        for total in self.totals(texts):
            if total is None:
                out.append(("und", 0.0))
                continue
            best = int(total.argmax())
            out.append((self.langs[best], float(1.0 / np.exp(total - total[best]).sum())))
        return out


def identify(docs: DataFrame, model: dict[str, np.ndarray] | DataFrame, vocabulary_file: str, together: int = 250) -> DataFrame:
    """doc_id, lang_pred and score (the posterior under equal priors) of every whole text.

    Null texts and texts without a letter are ``und`` with score 0, and so is every text where
    no language was learned; equal scores go to the first language by name. Repeated rows and
    null ids are passed through, extra columns are ignored, an empty table gives an empty result.
    A ``model`` that is a table is taken in blocks of about ``together`` languages, one pass each.
    """
    if isinstance(model, DataFrame):
        return _in_blocks(docs, model, vocabulary_file, together)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value, vocabulary_file)
        for b in batches:
            for begin in range(0, b.num_rows, 500):
                part = b.slice(begin, 500)
                got = scorer(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scored, "doc_id long, lang_pred string, score double")


def _in_blocks(docs: DataFrame, models: DataFrame, vocabulary_file: str, together: int) -> DataFrame:
    """``identify`` with more languages than a task can hold.

    Each block gives a text its best language and the log of its summed probabilities; these join
    by row to the best of all and its posterior.
    """
    blocks = max(1, -(-models.count() // together))
    rows = materialise(docs.select(F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("long"), "text"), "language-rows")
    spec = "row_no long, doc_id long, lang string, total double, mass double"
    out = None
    for k in range(blocks):
        part = _as_models(models.where(F.pmod(F.xxhash64("lang"), F.lit(blocks)) == k))  # ``together`` or about so
        shared = docs.sparkSession.sparkContext.broadcast(part)

        def scored(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            scorer = Scorer(shared.value, vocabulary_file, 20_000)
            for b in batches:
                for begin in range(0, b.num_rows, 500):
                    some = b.slice(begin, 500)
                    got = []
                    for total in scorer.totals(some.column(2).to_pylist()):
                        best = None if total is None else int(total.argmax())
                        got.append((None, None, None) if total is None else (scorer.langs[best], float(total[best]), float(total[best] + np.log(np.exp(total - total[best]).sum()))))
                    columns = [pa.array([g[i] for g in got], t) for i, t in enumerate((pa.string(), pa.float64(), pa.float64()))]
                    yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), *columns], ["row_no", "doc_id", "lang", "total", "mass"])

        found = rows.mapInArrow(scored, spec)
        out = found if out is None else out.unionByName(found)
    best = F.min(F.when(F.col("lang").isNotNull(), F.struct((-F.col("total")).alias("t"), "lang"))).alias("best")
    each = out.groupBy("row_no").agg(F.first("doc_id").alias("doc_id"), best, F.collect_list("mass").alias("masses"))  # a number for each block
    share = F.try_divide(F.lit(1.0), F.aggregate("masses", F.lit(0.0), lambda s, x: s + F.exp(x + F.col("best.t"))))
    return each.select("doc_id", F.coalesce("best.lang", F.lit("und")).alias("lang_pred"), F.coalesce(share, F.lit(0.0)).alias("score"))
