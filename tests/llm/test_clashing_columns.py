"""Every operator takes documents with extra columns named like its own."""

import pytest
from pyspark.sql import functions as F

from marlstone.llm import language_id, packing, quality_classifier
from marlstone.llm.chat_format import best_paths, chain_replies, format_paths, read_back
from marlstone.llm.common import discard, materialise, shared_folder
from marlstone.llm.exact_dedup import drop_copies, exact_dedup
from marlstone.llm.jaccard_join import jaccard_components, keep_one_of_each
from marlstone.llm.license_scan import license_scan
from marlstone.llm.quality_rules import quality_rules, ratio_weights
from marlstone.llm.secret_scan import secret_scan
from marlstone.llm.source_mix import mix_sources, repeat_mixed
from marlstone.llm.vocabularies import vocabulary

from .helpers import frame

NAMES = ["score", "rank", "size", "kept", "keep_id", "component_id", "node", "token", "h", "key", "n", "w", "label", "piece", "length", "offset", "taken", "target", "row_no", "spans", "ngrams", "windows", "licenses", "predicted", "group_size", "norm", "s", "source_size", "_sha", "_place", "_row_key", "_row_place", "_copy", "_gone", "_id", "_key", "_word", "_bits", "row", "stays", "maybe", "times", "id_hash", "id", "place", "t_id"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "one two three four five six seven", "en", "a", 1), (2, "one two three  four five six seven", "en", "b", 1), (3, None, None, None, None), (4, "Released under the MIT License.", "fr", "a", 1)]
    return frame(spark, rows).withColumns({n: F.lit("x") for n in NAMES})


def test_scans(spark, docs):
    assert secret_scan(docs).count() == license_scan(docs).count() == 4
    assert quality_rules(docs, ratio_weights(docs, docs.select("doc_id"))).count() == 4
    assert exact_dedup(docs).where("kept").count() == 3
    assert {r.doc_id: r.component_id for r in jaccard_components(docs).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}


def test_models_mix_and_packing(spark, docs):
    v = vocabulary("piece_bpe_32k.model")
    assert language_id.identify(docs, language_id.train(docs, v), v).count() == 4
    labels = spark.createDataFrame([(1, 1), (4, 0)], "doc_id long, label int")
    assert quality_classifier.score(docs, quality_classifier.train(docs, labels)).count() == 4
    assert packing.pack(docs, vocabulary("word_bpe_49k.json")).count() == 4
    assert mix_sources(docs).count() == 4


def test_stages_keep_all_columns(spark, docs):
    quality = spark.createDataFrame([(1, 1), (4, 1)], "doc_id long, quality int")
    for out in (drop_copies(docs), keep_one_of_each(docs), repeat_mixed(docs), quality_classifier.keep_good(docs, quality)):
        assert out.columns == docs.columns and 0 < out.count() <= 8
        assert {r[n] for r in out.collect() for n in NAMES} == {"x"}


def test_chat(spark):
    turns = spark.createDataFrame([(1, 1, "user", "a"), (1, 2, "assistant", "b")], "conv_id long, turn long, role string, text string")
    odd = turns.withColumns({n: F.lit("x") for n in ("msg_id", "parent_id", "score", "branch", "depth", "place", "n", "start", "_c", "_t", "_m", "up")})
    back = read_back(format_paths(best_paths(chain_replies(odd)))).collect()
    assert [(t.role, t.text) for t in back[0].turns] == [("user", "a"), ("assistant", "b")] and back[0].loss_text == "b"


def test_scratch_tables_lie_in_the_shared_folder_and_go(spark):
    kept = materialise(spark.range(3), "t")
    gone = materialise(spark.range(3), "t")
    discard(gone)
    folder = kept.inputFiles()[0].rsplit("/", 2)[0]
    assert shared_folder(spark).removeprefix("file://") in folder and kept.count() == 3
    with pytest.raises(Exception):
        gone.count()

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master, applicationId = "spark://host:7077", "a"

    with pytest.raises(ValueError):
        shared_folder(Cluster())
