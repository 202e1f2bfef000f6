import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marlstone.llm import registry, token_files
from marlstone.llm.vocabularies import vocabulary
from tests.llm.helpers import awkward, frame
from tests.test_catalog import SF

FILE = vocabulary("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(FILE)


def ids_of(text):
    return np.array(TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0], "<u4").tobytes()


def brute(docs):
    """(doc_id, start, n_tokens, crc32) of (doc_id, text) in order."""
    out, start = [], 0
    for doc_id, text in docs:
        raw = ids_of(text)
        out.append((doc_id, start, len(raw) // 4, zlib.crc32(raw)))
        start += len(raw) // 4
    return out


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])


PIECES = st.sampled_from(["word", "Éa", "the", " ", "  ", "\n", "\n\n", "\t", ",", "'s", "don't", "²", "12", "a_b", "<|endoftext|>", "\0", " ", " ", "\x1c", "é", "日本", "🙂", ".\n", "x,", "\r\n"])


@settings(max_examples=1500, deadline=None)
@given(st.lists(PIECES, max_size=12))
def test_words_give_the_ids_of_the_whole_text(parts):
    text = "".join(parts)
    encode = token_files.ByteEncoder.__new__(token_files.ByteEncoder)
    encode.__dict__.update(ENCODER.__dict__)
    assert encode(text) + b"\0\0\0\0" == ids_of(text)


ENCODER = token_files.ByteEncoder(FILE, remembered=20)


@pytest.mark.parametrize("n,alphabet", [(0, 1), (1, 1), (2, 1), (999, 1), (5000, 3), (60_000, 40), (200_000, 70_000)])
@pytest.mark.parametrize("least", [2, 16])
def test_grammars_expand_to_what_was_packed(n, alphabet, least):
    rng = np.random.default_rng(n + alphabet)
    ids = (rng.zipf(1.4, n) % alphabet).astype("<u4") * 3
    packed = token_files.compress(ids, least)
    assert token_files.expand(packed).tolist() == ids.tolist()
    assert len(packed["symbols"]) < 0.9 * n or n < 999 or alphabet > 1000
    for begin, end in [(0, min(5, n)), (n // 2, n // 2), (n // 3, 2 * n // 3), (max(0, n - 7), n)]:
        assert token_files.expand_range(packed, begin, end).tolist() == ids[begin:end].tolist()
    lengths = [1] * len(packed["terminals"])
    for left, right in packed["rules"].tolist():
        lengths.append(lengths[left] + lengths[right])
    assert lengths[len(packed["terminals"]) :] == packed["lengths"].tolist()


def test_no_pair_above_the_threshold_is_left():
    rng = random.Random(1)
    ids = np.array([rng.choice([1, 2, 3, 4]) for _ in range(3000)], "<u4")
    seq, rules = token_files.replace_pairs(ids, 5, 3, 1000)
    held = {tuple(r) for r in rules.tolist()}
    left = [p for p in zip(seq.tolist(), seq.tolist()[1:]) if p in held]
    assert held and not [p for p in left if p[0] != p[1]]  # aaa leaves an a


def test_awkward_tables_match_the_tokenizer(spark):
    docs = awkward() + [(1000, "lines\nand  blanks \n", None, None, None), (1001, "<|endoftext|> here", None, None, None)]
    df = frame(spark, docs).repartition(3).withColumns({"part": F.lit(1), "ids": F.lit("x"), "first": F.lit(None)})
    got = rows(token_files.token_files(df, FILE, shard_ids=300, least=2))
    order = sorted((r for r in docs), key=lambda r: (r[0] is None, r[0] or 0))
    assert got == brute([(r[0], r[1]) for r in order])


def test_rows_of_one_id_are_documents_of_their_own(spark):
    docs = [(7, t, None, None, None) for t in ("b b", "a", "b b", None, "")] + [(3, "first", None, None, None)]
    got = rows(token_files.token_files(frame(spark, docs), FILE))
    assert [r[0] for r in got] == [3] + [7] * 5
    assert sorted(r[2:] for r in got) == sorted(r[2:] for r in brute([(d[0], d[1]) for d in docs]))
    assert [r[1] for r in got] == [sum(x[2] for x in got[:i]) for i in range(6)]


def test_documents_are_fetched_by_their_ranges(spark, tmp_path):
    docs = awkward()
    path = f"file://{tmp_path}/ids"
    token_files.write_ids(frame(spark, docs), FILE, path, shard_ids=200, least=2)
    got = {r.doc_id: np.array(r.ids, "<u4").tobytes() for r in token_files.fetch(spark, path, [0, 17, 903, 5000]).collect()}
    assert got == {i: ids_of(next(d[1] for d in docs if d[0] == i)) for i in (0, 17, 903)}
    kept = token_files.read_ids(spark, path, keep_ids=True).where("doc_id = 17").first()
    assert bytes(kept.ids) == got[17]
    assert spark.read.parquet(path).count() > 20


def test_empty_tables(spark):
    assert token_files.token_files(frame(spark, []), FILE).count() == 0


def test_the_query_matches_the_tokenizer(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    assert rows(registry.op12_token_files(spark, SF)) == brute(docs)


def plain_repair(seq, symbols, least):
    seq, rules = list(seq), []
    while True:
        counts, last = {}, {}
        for i, p in enumerate(zip(seq, seq[1:])):
            if p[0] == p[1] and last.get(p) == i - 1:  # overlaps the one before
                last[p] = None
            else:
                counts[p], last[p] = counts.get(p, 0) + 1, i
        best = min(((-n, p) for p, n in counts.items() if n >= least), default=None)
        if best is None:
            return seq, rules
        out, i = [], 0
        while i < len(seq):
            hit = tuple(seq[i : i + 2]) == best[1]
            out.append(symbols + len(rules) if hit else seq[i])
            i += 2 if hit else 1
        seq = out
        rules.append(best[1])


@pytest.mark.parametrize("alphabet", [1, 2, 3, 6])
def test_the_most_frequent_pair_is_replaced_first(alphabet):
    rng = np.random.default_rng(alphabet)
    for n in (2, 3, 7, 40, 150):
        for least in (2, 3):
            ids = rng.integers(0, alphabet, n).astype(np.uint32)
            seq, rules = token_files.replace_pairs(ids, alphabet, least, 1000)
            assert (seq.tolist(), list(map(tuple, rules.tolist()))) == plain_repair(ids.tolist(), alphabet, least)


@pytest.mark.parametrize("symbols", [8, 100_000])
def test_rounds_replace_the_pairs_that_one_at_a_time_would(symbols, monkeypatch):
    rng = np.random.default_rng(symbols)
    for width in (1, 2, 5, 50):
        monkeypatch.setattr(token_files, "_ROUND", (width, 64))
        for n in (5, 60, 200):
            base = rng.integers(0, 8, n // 3 + 1)
            for ids in (np.tile(base, 3), rng.zipf(1.5, n) % 8, np.repeat(base, rng.integers(1, 6, len(base)))):
                seq, rules = token_files.replace_pairs(ids.astype(np.uint32), symbols, 2, 1000)
                assert (seq.tolist(), list(map(tuple, rules.tolist()))) == plain_repair(ids.tolist(), symbols, 2)


def test_a_shard_is_replaced_in_few_rounds(monkeypatch):
    rounds, ordered = [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: rounds.append(1) or ordered(keys))
    _, rules = token_files.replace_pairs((np.random.default_rng(1).zipf(1.2, 200_000) % 3000).astype(np.uint32), 3000, 16, 60_000)
    assert len(rules) > 300 and 0 < len(rounds) < len(rules) / 5


def test_texts_encoded_together_keep_their_own_ids():
    texts = [r[1] for r in awkward()] + ["\0", "one\n two", "end, of$$$ line.\n\nnext", " ", "<|endoftext|>", "é$ 日本, don't", None, "x" * 300 + ", ab"]
    encode = token_files.ByteEncoder(FILE, remembered=20)
    for some in (texts, texts[::-1], [None], []):
        assert [ids + b"\0\0\0\0" for ids in encode.several(some)] == [ids_of(t) for t in some]
    encode.apart = None  # a vocabulary that merges across byte 0
    encode.young, encode.old = {"\n": encode.young["\n"]}, {}
    assert encode.several(texts[:50]) == [ids_of(t)[:-4] for t in texts[:50]]


def test_new_words_are_few_calls_of_the_model(monkeypatch):
    encode, calls = token_files.ByteEncoder(FILE), []
    monkeypatch.setattr(encode, "_run", lambda run: calls.append(run))
    text = " ".join(f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("mist", "lond", "rash"))
    assert encode.several([text])[0] + b"\0\0\0\0" == ids_of(text) and not calls


def test_batches_are_cut_by_the_bytes_of_their_texts(monkeypatch):
    monkeypatch.setattr(token_files, "TEXT_BYTES", 10)
    texts = ["a" * 4, None, "b" * 6, "c", "", "d" * 30, "e"]
    batch = pa.RecordBatch.from_pydict({"id": list(range(7)), "text": texts})
    assert [p.column(1).to_pylist() for p in token_files._portions(batch)] == [texts[:3], texts[3:5], texts[5:6], texts[6:]]
