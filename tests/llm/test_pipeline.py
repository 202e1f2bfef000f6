import re

import corpus_pipeline as P
from marlstone.llm import quality_classifier as Q
from tests.llm.test_jaccard_join import brute
from tests.llm.test_packing import best_fit_decreasing, checked

SF = "/root/testdata/sf0.001"


def test_each_stage_does_its_work_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in P.STAGES:
        before = docs.collect()
        docs = stage(spark, docs, SF)
        seen[name] = (before, docs.collect())
        if name != "best_fit_packing":
            assert docs.columns == columns
            docs = spark.createDataFrame(seen[name][1], docs.schema)

    before, after = seen["quality_classifier"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    weights = Q.train(spark.createDataFrame(before), Q.learning_rows(labels))
    good = {r.doc_id for r in Q.score(spark.createDataFrame(before), weights).collect() if r.predicted}
    assert {r.doc_id for r in after} == good and 0 < len(after) < len(before)

    before, after = seen["exact_dedup"]
    first = {}
    for r in sorted(before, key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(first.values())

    before, after = seen["jaccard_join"]
    assert {r.doc_id for r in after} == {k[2] for k in brute([tuple(r) for r in before])}

    before, after = seen["source_mix"]
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}

    before, after = seen["best_fit_packing"]
    assert len({r.doc_id for r in after}) == len({r.doc_id for r in before})
    assert checked(after, 4096) == len(best_fit_decreasing([r.length for r in after], 4096))


def test_run_gives_the_same_rows_twice(spark):
    one, two = (sorted((r.doc_id, r.piece, r.ids_crc32) for r in P.run(spark, SF).collect()) for _ in range(2))
    assert one == two
