"""Work that must grow no faster than its input: rows that the nodes of all plans put out, counted by Spark."""

from pyspark.sql import functions as F

from marlstone.operators import evaluation, lexical_index, reference_contract, retrieval, search
from marlstone.operators.lexical_index import Bm25Index
from marlstone.plans import catalog


def rows_made(spark, run) -> int:
    """Output rows of all plan nodes of the queries that ``run`` starts."""
    inner = spark.sparkContext._jsc.sc()
    store = spark._jsparkSession.sharedState().statusStore()

    def ids() -> list[int]:
        inner.listenerBus().waitUntilEmpty()
        found = store.executionsList()
        return [found.apply(i).executionId() for i in range(found.size())]

    before = set(ids())
    run()
    total = 0
    for e in set(ids()) - before:
        values, nodes = store.executionMetrics(e), store.planGraph(e).allNodes()
        for i in range(nodes.size()):
            metrics = nodes.apply(i).metrics()
            for m in (metrics.apply(j) for j in range(metrics.size())):
                if m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                    total += int(values.apply(m.accumulatorId()).replace(",", ""))
    return total


def test_probes_do_not_join_common_terms_with_their_documents(spark):
    ids = spark.range(3000)  # every pair of values once; each value in 50 or 60 documents
    d = ids.select("id", F.array((F.col("id") % 60).cast("string")).alias("a"), F.array((F.floor(F.col("id") / 60)).cast("string")).alias("b"))
    found = []
    rows = rows_made(spark, lambda: found.extend(search.probes(d, ["a", "b"], 20, (("a", "b"),)).collect()))
    assert len(found) == 20 and all(r.relevant == [r.primary_id] for r in found)
    assert 20_000 < rows < 300_000  # 3,000 probes of two terms have 330,000 documents between them


def test_class_grades_give_the_metrics_of_their_pairs(spark):
    items = spark.createDataFrame([(i, None if i % 7 == 0 else i % 3 if i < 30 else i) for i in range(40)], "id long, class int")
    queries = items.where("id % 4 = 0").withColumnRenamed("id", "query_id")
    pairs = queries.join(items, "class").where("id <> query_id").select("query_id", "id", F.lit(1).alias("grade"))
    rankings = spark.createDataFrame([(m, q, (q * 7 + r * (3 if m == "a" else 5)) % 40, r) for m in "ab" for q in range(0, 40, 4) for r in range(1, 21)], "mode string, query_id long, id long, rank int")
    by_class, by_pair = (sorted(map(repr, evaluation.ranking_metrics(rankings, g).withColumn("ndcg_at_10", F.round("ndcg_at_10", 12)).collect())) for g in (evaluation.SameClass(items, queries), pairs))
    assert by_class == by_pair and len(by_pair) == 20


def test_rankings_and_grades_by_label_are_not_all_pairs(spark, tmp_path):
    spark.range(4000).select(F.col("id").alias("vec_id"), F.lit(1).alias("label")).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = []
    rows = rows_made(spark, lambda: got.extend(catalog._by_label(spark, tmp_path, 3).where("query_id = 0").collect()))
    assert [(r.id, r["rank"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1), (2, 2), (3, 3)]
    ranked = catalog._by_label(spark, tmp_path, 3)
    rows += rows_made(spark, lambda: evaluation.ranking_metrics(ranked.withColumn("mode", F.lit("label")), catalog._grades(spark, tmp_path)).collect())
    assert rows < 200_000  # 200 queries of one label have 800,000 relevant vectors


def test_blocks_of_the_dense_product_shrink_with_the_queries(spark, monkeypatch):
    rows = [(i, [float(i * 7 % 11), float(i * 5 % 13)], i % 3) for i in range(60)]
    v = spark.createDataFrame(rows, "id long, embedding array<float>, g int")
    asked = v.where("id % 4 = 0").select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vector"))
    plain = sorted(map(repr, retrieval.top_ranked(retrieval.dense_top(v, asked, 3), 3).collect()))
    for most in (1, 40):  # less than a vector with all queries, and two vectors
        monkeypatch.setattr(retrieval, "BLOCK_SCORES", most)
        assert sorted(map(repr, retrieval.top_ranked(retrieval.dense_top(v, asked, 3), 3).collect())) == plain


def test_a_large_corpus_of_one_file_is_indexed_by_many_tasks(spark, tmp_path):
    docs = spark.range(0, 200_001, 1, 1).select("id", F.concat(F.lit("word"), F.col("id") % 7).alias("text"))  # one partition, as of one row group
    index = Bm25Index.build(docs, f"file://{tmp_path}/index")
    tasks = index.rows.where("kind = 'documents'").groupBy(F.shiftright("shard", 32)).agg(F.sum("n").alias("n")).collect()
    assert len(tasks) > 1 and max(r.n for r in tasks) <= lexical_index.TASK_DOCUMENTS + len(tasks)
    assert index.terms.agg(F.sum("df")).first()[0] == 200_001


def test_display_numbers_are_counted_in_parts_of_a_sheet(spark, monkeypatch):
    monkeypatch.setattr(reference_contract, "PART_ROWS", 4)
    rows = [(f"r{i:02}", "s" if i % 3 else None, i // 2 if i % 5 else None, f"d{i % 4}") for i in range(40)] + [("z", "t", 10**12, "d1")]
    others = {c: F.lit("x") for c in ("reference_number", "client", "country", "sector", "offering", "service_nature", "project_year", "attestation_available", "data_quality_status")}
    refs = spark.createDataFrame(rows, "reference_id string, sheet string, row_number long, canonical_document_id string").withColumns(others | {"evidence_available": F.lit(True), "document_retrieval_eligible": F.lit(True)})
    docs = spark.createDataFrame([("d1", "f", "h", "t", "fr", "PUBLIC", True)], "document_id string, file_name string, source_sha256 string, document_type string, document_language string, security_classification string, retrieval_eligible boolean")
    contract = reference_contract.build_contract(refs, docs, reference_contract.Normalization())
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", r[2] is not None, r[2] or 0, r[0]))
    assert {r.reference_id: r.display_reference_id for r in contract.collect()} == {r[0]: f"REF-{n:04d}" for n, r in enumerate(order, 1)}
    parts = reference_contract._in_parts(refs, refs).groupBy("sheet", "_part").count().collect()
    assert max(r["count"] for r in parts) <= 10 and len(parts) > 6  # a sheet was one part
