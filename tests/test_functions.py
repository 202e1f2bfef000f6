import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marlstone.functions import text as T
from marlstone.functions import values as V
from marlstone.functions.chunking import ChunkRules, chunk_lists, chunk_spans


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("text", "want"),
    [("Été à l'œuvre — ÉCOLE n°5", "ete a l uvre ecole n 5"), ("  ", ""), (None, ""), ("Straße", "strasse")],
)
def test_fold_key(spark, text, want):
    assert one(spark, T.fold_key(F.col("t").cast("string")), t=text) == want


def test_folding_for_search_joins_arabic_variants(spark):
    assert one(spark, T.tokens(F.col("t")), t="أحمد إلى مدرسةً L'École a") == ["احمد", "الي", "مدرسة", "ecole"]


def test_normalizing_and_cleaning(spark):
    assert one(spark, T.normalize_extracted(F.col("t")), t="a \t b\r\n\n\n\nc\x07 ") == "a b\n\nc"
    assert one(spark, T.clean_redacted(F.col("t")), t="agree-\nment\n***\n[EMAIL] ok") == "agreement\n[EMAIL] ok"


def test_redaction_counts_on_the_progressively_masked_text(spark):
    masked, n = T.redact(F.col("t"), T.PAGE_RULES)
    text = "mail a.b@c.org, pay 1 200 EUR, call +216 71 123 456"
    assert one(spark, masked, t=text) == "mail [EMAIL], pay [MONETARY_AMOUNT], call [PHONE_LIKE]"
    assert one(spark, T.counts_map(n), t=text) == {"EMAIL": 1, "MONETARY_AMOUNT": 1, "PHONE_LIKE": 1}
    assert one(spark, T.counts_map(n), t="nothing") == {}


@pytest.mark.parametrize(("text", "want"), [("le contrat de la ville est pour les eaux", "fr"), ("the terms of the contract are for our use", "en"), ("عقد الخدمة بين الطرفين", "ar"), ("le contrat عقد الخدمة", "fr-ar"), ("123 456", "und")])
def test_page_language(spark, text, want):
    assert one(spark, T.page_language(F.col("t")), t=text) == want


@pytest.mark.parametrize(("text", "want"), [("Le projet doit finir", "fr"), ("the project must end", "en"), ("xyz abc", "mixed"), ("", "unknown"), ("عقد الخدمة بين الطرفين", "ar")])
def test_brief_language(spark, text, want):
    assert one(spark, T.brief_language(F.col("t")), t=text) == want


def test_document_types_take_the_first_rule(spark):
    kind, basis = T.document_type(F.col("n"), F.col("t"))
    assert one(spark, kind, n="Contrat.pdf", t="une attestation") == "ATTESTATION"
    assert one(spark, basis, n="x.pdf", t="le Contrat signé") == "keyword:contrat"
    assert one(spark, kind, n="x", t="rien") == "OTHER_EVIDENCE"


@pytest.mark.parametrize(("value", "want"), [(' =SUM(1)', "' =SUM(1)"), ("-1", "'-1"), ("@x", "'@x"), ("plain", "plain"), ("a\x07b", "ab")])
def test_safe_cells(spark, value, want):
    assert one(spark, T.safe_cell(F.col("t")), t=value) == want


def test_names_ids_and_urls(spark):
    assert one(spark, T.safe_file_name(F.col("t")), t="dir/a:b?  c .") == "a_b_ c"
    key = "abcdefghij_klmnopqrst-1"
    assert one(spark, T.file_id(F.col("t")), t=f"https://x.org/d/{key}/view") == key == one(spark, T.file_id(F.col("t")), t=key)
    assert one(spark, T.file_id(F.col("t")), t="short") is None
    assert one(spark, T.urls(F.col("t")), t="see http://a.org/x) and 'https://b.org'") == ["http://a.org/x", "https://b.org"]


@pytest.mark.parametrize(("text", "want"), [("2015 - 2018", (2015, 2018, "COMPLETED")), ("2019 to present", (2019, 2035, "ONGOING")), ("n/a", (None, None, "UNKNOWN")), ("1950, 2040, 2001", (2001, 2001, "COMPLETED"))])
def test_year_intervals(spark, text, want):
    got = V.year_interval(F.col("t"), ["present", "ongoing"])
    assert tuple(one(spark, got[k], t=text) for k in ("year_start", "year_end", "project_status")) == want


def test_year_bounds_and_recency(spark):
    ys = V.years(F.col("t"))
    assert one(spark, V.any_year(ys, after=2010, before=2010), t="2010") and not one(spark, V.any_year(ys, after=2010), t="none")
    assert [one(spark, V.recency(F.lit(y).cast("int"), 2026)) for y in (2021, None, 2030)] == [0.75, 0.25, 1.0]
    assert not one(spark, V.overlaps_years(F.lit(None).cast("int"), F.lit(2020), year_to=2021))


def test_arrays_json_and_tags(spark):
    assert one(spark, V.first_seen(F.array(*map(F.lit, ["b", "A", "B", "a", "c"])))) == ["b", "A", "c"]
    assert one(spark, V.json_values(F.col("t")), t='["x  y", "", "X y", "z"]') == ["x y", "z"]
    assert one(spark, V.json_values(F.col("t")), t=" plain ") == ["plain"]
    assert one(spark, V.tags(F.col("t"), {"b": ["beta"], "a": ["Alpha", "alp"]}), t="ALPhabet beta") == ["a", "b"]
    assert one(spark, V.truthy(F.col("t")), t=" yes ") and one(spark, V.as_int(F.col("t")), t="3.0") == 3 and one(spark, V.as_int(F.col("t")), t="") == 0
    assert one(spark, V.is_unit(F.array(F.lit(0.6), F.lit(0.8))))


def test_chunks_are_bounded_reproduce_the_text_and_overlap():
    rng = random.Random(1)
    rules = ChunkRules(most=120, overlap=25, least=30, window=40)
    for _ in range(200):
        text = "".join(rng.choice(["word", " ", ". ", "\n", "\n\n", ", ", "x" * 50, "؟ "]) for _ in range(rng.randint(0, 120)))
        spans = chunk_spans(text, rules)
        assert all(0 < b - a <= rules.most and text[a:b] == text[a:b].strip() for a, b in spans)
        covered = {i for a, b in spans for i in range(a, b)}
        assert all(i in covered or text[i].isspace() for i in range(len(text)))
        assert all(x[0] < y[0] for x, y in zip(spans, spans[1:]))
    with pytest.raises(ValueError):
        ChunkRules(most=10, overlap=20)


def test_coverage_and_grounding(spark):
    q, e = F.array(F.lit("a1"), F.lit("b1"), F.lit("a1")), F.array(F.lit("b1"))
    assert one(spark, T.term_coverage(q, e)) == 0.5
    assert one(spark, T.grounding_score(F.lit("Solar power plant"), F.lit("a solar farm"))) == pytest.approx(1 / 3)
    lines = T.labelled_lines({"Sector": F.array(F.lit("water"), F.lit("")), "None": F.array().cast("array<string>")}, F.lit("Document: d"), F.lit("body"))
    assert one(spark, lines) == "Document: d\nSector: water\nbody"
    facets = {"sector": F.array(F.lit("a" * 130), F.lit("b" * 90), F.lit("c"), F.lit("d")), "client": F.array(F.lit("x"), F.lit("y"))}
    assert one(spark, T.retrieval_text(F.lit("f.pdf"), facets, F.lit(" body \n"))) == f"Document: f.pdf\nClient: x | y\nSecteur: {'a' * 120} | {'b' * 68}\nbody"
    with pytest.raises(Exception, match="too long"):
        one(spark, T.retrieval_text(F.lit("f"), {}, F.lit("x" * 1700)))


def test_folding_takes_a_few_texts_at_a_time(spark, monkeypatch):
    texts = ["Été", None, "ﬁn", "", "ÀB", "x"] * 3
    monkeypatch.setattr(T, "FOLDED_TOGETHER", 4)
    got = T.strip_marks.func(pa.array(texts, pa.string()))
    assert got.to_pylist() == [None if t is None else {"Été": "ete", "ﬁn": "fin", "ÀB": "ab"}.get(t, t) for t in texts]
    assert T.nfkc.func(pa.array([], pa.string())).to_pylist() == []


@pytest.mark.parametrize("made", [lambda t: T.term_lists(t, frozenset()), lambda t: chunk_lists(t, ChunkRules(40, 5, 10, 20))])
def test_python_memory_of_a_batch_does_not_grow_with_its_rows(made):
    def peak(rows):
        texts = pa.array([" ".join(f"w{i}x{j}" for j in range(60)) for i in range(rows)], pa.string())
        tracemalloc.start()
        out = made(texts)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(out) == rows and len(out[rows - 1]) >= 10
        return most

    assert peak(5000) < 1.5 * peak(1000)  # all words and lists of a batch were Python objects


def test_texts_of_ascii_fold_as_others_do():
    texts = ["ABC [z]", None, "", "a\x00\x1f~"]
    for some in (texts, [*texts, "É"]):
        assert T.strip_marks.func(pa.array(some, pa.string())).to_pylist()[:4] == ["abc [z]", None, "", "a\x00\x1f~"]
        assert T.nfkc.func(pa.array(some, pa.string())).to_pylist()[:4] == texts
