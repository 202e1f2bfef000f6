"""Registry of named queries and, where SQL can express them, their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import values as V
from ..functions.analysis import folded_form
from ..functions.chunking import ChunkRules, chunks
from ..operators import corpus, evaluation, filters, matching, packets, recommend, reference_contract, relational, requirements, retrieval, search
from ..operators.contracts import issue_rows
from ..operators.lexical_index import Bm25Index, Scope
from ..operators.packets import Rule
from ..sources.readers import hyperlinks
from ..sources.scratch import fingerprint, scratch

QUERIES: dict = {}
ORACLES: dict = {}

WORDS = r"'[\p{L}\p{N}]+'"
ALLOWED = ["src0", "src1", "src2", "src3", "src4", "src5"]
ALLOWED_SQL = ", ".join(f"'{s}'" for s in ALLOWED)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(oracle: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


# -- text --------------------------------------------------------------------------------------


@query(r"""SELECT doc_id, length(text) AS character_count, len(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS word_count,
    len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '\S'))) AS line_count,
    len(regexp_extract_all(text, '\p{Latin}')) AS latin_character_count, len(regexp_extract_all(text, '\p{Arabic}')) AS arabic_character_count FROM documents""")
def text_metrics(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", *[c.alias(n) for n, c in T.text_metrics(F.col("text")).items()])


@query(r"""SELECT doc_id, len(regexp_extract_all(text, '(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b')) AS emails,
    sha256(regexp_replace(text, '(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b', '[EMAIL]', 'g')) AS masked_sha256 FROM documents""")
def redact_emails(spark, sf):
    masked, n = T.redact(F.col("text"), (("EMAIL", T.EMAIL),))
    return table(spark, sf, "documents").select("doc_id", n["EMAIL"].alias("emails"), F.sha2(masked, 256).alias("masked_sha256"))


@query()
def redact_pages(spark, sf):
    masked, n = T.redact(F.col("text"), T.PAGE_RULES)
    d = table(spark, sf, "documents").select("doc_id", masked.alias("masked"), *[c.alias(k) for k, c in n.items()])
    return d.select("doc_id", F.to_json(T.counts_map({k: F.col(k) for k in n})).alias("redaction_counts"), F.sha2("masked", 256).alias("masked_sha256"))


@query()
def clean_pages(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", T.clean_redacted(F.col("text")).alias("clean"))
    return d.select("doc_id", F.length("clean").alias("clean_chars"), F.sha2("clean", 256).alias("clean_sha256"))


FR = ", ".join(f"'{w}'" for w in T.FRENCH_WORDS)
EN = ", ".join(f"'{w}'" for w in T.ENGLISH_WORDS)


@query(rf"""WITH w AS (SELECT doc_id, len(regexp_extract_all(text, '\p{{Arabic}}')) AS ar, len(regexp_extract_all(text, '\p{{Latin}}')) AS la,
      len(list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+'), lambda x: x IN ({FR}))) AS fr,
      len(list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+'), lambda x: x IN ({EN}))) AS en FROM documents),
    s AS (SELECT doc_id, CASE WHEN fr >= en THEN 'fr' ELSE 'en' END AS l, ar / greatest(ar + la, 1) AS a, la / greatest(ar + la, 1) AS b FROM w)
    SELECT doc_id, CASE WHEN a >= 0.18 AND b >= 0.18 THEN l || '-ar' WHEN a >= 0.55 THEN 'ar' WHEN b >= 0.40 THEN l ELSE 'und' END AS page_language FROM s""")
def page_language(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.page_language(F.col("text")).alias("page_language"))


@query("""SELECT doc_id, CASE WHEN h LIKE '%attestation%' OR h LIKE '%certificate%' OR h LIKE '%certificat%' OR h LIKE '%lettre de référence%' OR h LIKE '%شهادة%' OR h LIKE '%إفادة%' THEN 'ATTESTATION'
      WHEN h LIKE '%procès-verbal%' OR h LIKE '%proces-verbal%' OR h LIKE '%p.v.%' OR h LIKE '% pv %' OR h LIKE '%minutes of%' OR h LIKE '%محضر%' THEN 'MINUTES'
      WHEN h LIKE '%cahier des charges%' OR h LIKE '%terms of reference%' OR h LIKE '% cdc %' OR h LIKE '%spécification%' THEN 'SPECIFICATION'
      WHEN h LIKE '%contrat%' OR h LIKE '%contract%' OR h LIKE '%avenant%' OR h LIKE '%convention%' OR h LIKE '%marché%' OR h LIKE '%marche%' OR h LIKE '%accord%' OR h LIKE '%عقد%' OR h LIKE '%اتفاقية%' THEN 'CONTRACT'
      ELSE 'OTHER_EVIDENCE' END AS document_type FROM (SELECT doc_id, ' ' || lower(source) || ' ' || lower(text[1:6000]) || ' ' AS h FROM documents)""")
def document_types(spark, sf):
    kind, _ = T.document_type(F.col("source"), F.col("text"))
    return table(spark, sf, "documents").select("doc_id", kind.alias("document_type"))


@query(r"""SELECT user_id, sum(case when y = 2024 then 1 else 0 end)::BIGINT AS y2024, count(*) AS n FROM (SELECT user_id, year(ts) AS y FROM events) GROUP BY user_id""")
def year_facets(spark, sf):
    e = table(spark, sf, "events").select("user_id", V.years(F.date_format("ts", "yyyy-MM-dd")).alias("ys"))
    return e.groupBy("user_id").agg(F.count_if(V.any_year(F.col("ys"), 2024, 2024)).alias("y2024"), F.count("*").alias("n"))


@query()
def text_chunks(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.posexplode(chunks(F.col("text"), ChunkRules())).alias("chunk_index", "c"))
    return d.select("doc_id", "chunk_index", "c.start", "c.end", F.sha2("c.text", 256).alias("chunk_sha256"), V.stable_id(F.col("doc_id"), F.col("c.start"), F.col("c.end"), F.sha2("c.text", 256)).alias("chunk_id"))


@query(r"""WITH f AS (SELECT doc_id, list_filter(regexp_extract_all(strip_accents(replace(lower(text), 'ß', 'ss')), '[\p{L}\p{N}]+'), lambda x: length(x) >= 2) AS t FROM documents)
    SELECT doc_id, len(t) AS tokens, len(list_distinct(t)) AS distinct_tokens FROM f""")
def search_tokens(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", T.tokens(F.col("text")).alias("t"))
    return d.select("doc_id", F.size("t").alias("tokens"), F.size(F.array_distinct("t")).alias("distinct_tokens"))


@query(r"""SELECT page_id, target, string_agg(DISTINCT channel, ',' ORDER BY channel) AS channels FROM (
      SELECT page_id, unnest(regexp_extract_all(html, '(?i)href\s*=\s*["'']([^"'']+)["'']', 1)) AS target, 'attribute' AS channel FROM pages
      UNION ALL SELECT page_id, unnest(regexp_extract_all(html, 'https?://[^\s"'')]+')), 'text' FROM pages) GROUP BY page_id, target""")
def url_links(spark, sf):
    return hyperlinks(table(spark, sf, "pages"), "page_id", "html")


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '["' || event_type || '"]' AS types FROM events""")
def json_props(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", F.from_json("props", "k long")["k"].alias("k"), F.to_json(V.json_values(F.col("event_type"))).alias("types"))


@query(r"""SELECT p_partkey, CASE WHEN regexp_matches(ltrim('=' || p_name), '^[=+@-]') THEN '''=' || p_name ELSE p_name END AS cell,
    CASE WHEN regexp_matches(ltrim(p_name), '^[=+@-]') THEN '''' || p_name ELSE p_name END AS plain FROM part""")
def safe_cells(spark, sf):
    return table(spark, sf, "part").select("p_partkey", T.safe_cell(F.concat(F.lit("="), "p_name")).alias("cell"), T.safe_cell(F.col("p_name")).alias("plain"))


# -- corpus ------------------------------------------------------------------------------------


@query("SELECT doc_id, sha256(text) AS text_sha256, count(*) OVER (PARTITION BY sha256(text)) AS duplicate_count FROM documents")
def exact_duplicates(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("text_sha256"))
    return d.join(d.groupBy("text_sha256").agg(F.count("*").alias("duplicate_count")), "text_sha256")  # counts combine before the shuffle


@query("""WITH p AS (SELECT doc_id, length(trim(text)) AS c, doc_id % 3 = 0 AS ocr, (doc_id % 100)::DOUBLE AS conf, doc_id % 50 = 0 AS blank FROM documents),
    s AS (SELECT CASE WHEN blank AND c < 10 THEN 'BLANK:visually_blank_page' WHEN c < 20 THEN 'FAILED:very_low_text_volume' WHEN c < 80 THEN 'REVIEW:low_text_volume'
      WHEN ocr AND conf < 45 THEN 'FAILED:very_low_ocr_confidence' WHEN ocr AND conf < 70 THEN 'REVIEW:low_ocr_confidence' ELSE 'PASS:' END AS status FROM p) SELECT status, count(*) AS n FROM s GROUP BY status""")
def quality_states(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.length(F.trim("text")).alias("c"))
    status, reason = corpus.page_status(F.col("c"), F.col("doc_id") % 3 == 0, (F.col("doc_id") % 100).cast("double"), F.col("doc_id") % 50 == 0)
    return d.groupBy(F.concat_ws(":", status, reason).alias("status")).agg(F.count("*").alias("n"))


@query("""SELECT count(*) AS documents, sum(length(text))::BIGINT AS characters, round(avg(length(text)), 2) AS mean_characters, max(length(text)) AS max_characters,
    count(DISTINCT source) AS sources, count(DISTINCT lang) AS languages, count(DISTINCT text) AS distinct_texts FROM documents""")
def corpus_statistics(spark, sf):
    d = table(spark, sf, "documents").select("source", "lang", F.length("text").alias("c"), F.sha2("text", 256).alias("h"))
    return d.agg(F.count("*").alias("documents"), F.sum("c").alias("characters"), F.round(F.avg("c"), 2).alias("mean_characters"), F.max("c").alias("max_characters"), F.count_distinct("source").alias("sources"), F.count_distinct("lang").alias("languages"), F.count_distinct("h").alias("distinct_texts"))


@query("SELECT conv_id, count(*) AS parts, sha256(string_agg(text, chr(10) || chr(10) ORDER BY turn)) AS full_sha256 FROM conversations GROUP BY conv_id")
def document_rollup(spark, sf):
    r = relational.ordered_text(table(spark, sf, "conversations"), ["conv_id"], "turn", "text")
    return r.select("conv_id", "parts", F.sha2("full_text", 256).alias("full_sha256"))


@query("SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -1) AS toxic, l.doc_id IS NOT NULL AS evidence_available FROM documents d LEFT JOIN labels l USING (doc_id)")
def missing_evidence(spark, sf):
    right = table(spark, sf, "labels").withColumn("evidence_available", F.lit(True))
    return relational.left_with_defaults(table(spark, sf, "documents").select("doc_id"), right, ["doc_id"], {"quality": -1, "toxic": -1, "evidence_available": False})


@query("""SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN 'REVIEWED' ELSE d.source END AS source, l.doc_id IS NOT NULL AS repaired FROM documents d LEFT JOIN (SELECT doc_id FROM labels WHERE quality = 0) l USING (doc_id)""")
def curated_upsert(spark, sf):
    fixed = table(spark, sf, "labels").where("quality = 0").select("doc_id", F.lit("REVIEWED").alias("source"))
    return relational.upsert(table(spark, sf, "documents").select("doc_id", "source"), fixed, ["doc_id"], ["source"])


@query("SELECT doc_id, 'DOC-' || sha256(doc_id::VARCHAR || '|' || source || '|' || n_chars::VARCHAR)[1:16] AS stable_id FROM documents")
def stable_ids(spark, sf):
    return table(spark, sf, "documents").select("doc_id", V.stable_id(F.col("doc_id"), F.col("source"), F.col("n_chars"), prefix="DOC-", length=16).alias("stable_id"))


# -- retrieval ---------------------------------------------------------------------------------

FORM_SQL = "translate(regexp_replace(strip_accents(replace(lower(coalesce({x}, '')), 'ß', 'ss')), '[ؐ-ًؚ-ٰٟۖ-ۭـ]', '', 'g'), 'أإآٱىؤئ', 'اااايوي')"
TOKENS_SQL = f"list_filter(regexp_extract_all({FORM_SQL.format(x='text')}, {WORDS}), lambda x: length(x) >= 2)"
BM25_SQL = rf"""
    d AS (SELECT doc_id, source, {TOKENS_SQL} AS t FROM documents), n AS (SELECT count(*) AS n, avg(len(t)) AS m FROM d),
    p AS (SELECT doc_id, source, dl, term, count(*) AS tf FROM (SELECT doc_id, source, len(t) AS dl, unnest(t) AS term FROM d) GROUP BY ALL),
    s AS (SELECT term, count(*) AS df FROM p GROUP BY term),
    q AS (SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id, unnest({TOKENS_SQL}) AS term FROM benchmark) GROUP BY ALL),
    r AS (SELECT item_id, doc_id, source, round(sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / m))), 6) AS score FROM p JOIN s USING (term) JOIN q USING (term), n GROUP BY ALL)"""


_indexes: dict[tuple, str] = {}


def bm25_index(spark, sf):
    """The stored index of the documents: built once for an application and the files as they are, then read."""
    d = table(spark, sf, "documents")
    key = (spark.sparkContext.applicationId, sf, fingerprint(d))
    if key not in _indexes:
        path = scratch(spark, "bm25")
        docs = _chunks(spark, sf, "source", "lang")
        Bm25Index.build(docs, path, ["security_classification", "document_id", "source", "lang"])
        _indexes[key] = path
    return Bm25Index.load(spark, _indexes[key])


@query(rf"""WITH d AS (SELECT doc_id, {TOKENS_SQL} AS t FROM documents), p AS (SELECT doc_id, unnest(t) AS term FROM d), n AS (SELECT count(*) AS n FROM d)
    SELECT term, count(DISTINCT doc_id) AS df, count(*) AS cf, round(ln(1 + (any_value(n) - count(DISTINCT doc_id) + 0.5) / (count(DISTINCT doc_id) + 0.5)), 8) AS idf FROM p, n GROUP BY term""")
def bm25_terms(spark, sf):
    return bm25_index(spark, sf).statistics().withColumn("idf", F.round("idf", 8))


@query(rf"""WITH d AS (SELECT doc_id, {TOKENS_SQL} AS t FROM documents), p AS (SELECT doc_id, len(t) AS length, unnest(t) AS term FROM d)
    SELECT term, doc_id AS id, count(*) AS tf, any_value(length)::INTEGER AS length FROM p GROUP BY term, doc_id""")
def bm25_postings(spark, sf):
    return bm25_index(spark, sf).postings()


@query("SELECT 'NONE' AS check, 0::BIGINT AS rows WHERE false")
def bm25_problems(spark, sf):
    """Invariants of the stored index that do not hold: none."""
    return bm25_index(spark, sf).problems()


def _lexical(spark, sf, limit, positive_only=False, classes=ALLOWED):
    asked = table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text")
    return bm25_index(spark, sf).top(asked, limit, Scope.security(spark, "source", classes, "bigint"), positive_only=positive_only)


@query(f"""WITH {BM25_SQL}, a AS (SELECT b.item_id, d.doc_id, round(coalesce(r.score, 0), 6) AS score, row_number() OVER (PARTITION BY b.item_id ORDER BY coalesce(r.score, 0) DESC, d.doc_id) AS rank
      FROM benchmark b CROSS JOIN documents d LEFT JOIN r ON r.item_id = b.item_id AND r.doc_id = d.doc_id WHERE d.source IN ({ALLOWED_SQL}))
    SELECT item_id, doc_id, score, rank FROM a WHERE rank <= 10""")
def bm25_topk(spark, sf):
    return _lexical(spark, sf, 10).select(F.col("query_id").alias("item_id"), F.col("id").alias("doc_id"), F.round("score", 6).alias("score"), "rank")


@query(f"""WITH {BM25_SQL}, a AS (SELECT item_id, doc_id, round(score, 6) AS score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE source IN ('src0'))
    SELECT item_id, doc_id, score, rank FROM a WHERE rank <= 5""")
def auth_filter_topk(spark, sf):
    return _lexical(spark, sf, 5, True, ["SRC0", " "]).select(F.col("query_id").alias("item_id"), F.col("id").alias("doc_id"), F.round("score", 6).alias("score"), "rank")


def _dense(spark, sf, limit):
    e = table(spark, sf, "embeddings")
    asked = e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))  # the stated query set
    return retrieval.top_ranked(retrieval.dense_top(e.select(F.col("vec_id").alias("id"), "embedding"), asked, limit, apart=True), limit)


DENSE_SQL = """x AS (SELECT q.vec_id AS query_id, v.vec_id AS id, v.label, list_inner_product(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) AS s
      FROM embeddings q JOIN embeddings v ON q.vec_id % 20 = 0 AND v.vec_id <> q.vec_id)"""


@query(f"WITH {DENSE_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM x) SELECT query_id, id, round(s, 6) AS score, rank FROM r WHERE rank <= 10")
def dense_topk(spark, sf):
    return _dense(spark, sf, 10).withColumn("score", F.round("score", 6))


def _by_label(spark, sf, limit):
    """A second ranking of the query set: vectors of the query's label first, by id."""
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "label")
    q = e.where("id % 20 = 0").select(F.col("id").alias("query_id"), "label")
    first = e.where("label IS NOT NULL").withColumn("place", F.row_number().over(Window.partitionBy("label").orderBy("id"))).where(F.col("place") <= limit + 1)  # one of them may be the query
    same = first.select("id", "label").join(q, "label").where("id <> query_id")
    return retrieval.top_ranked(same.select("query_id", "id", F.lit(1.0).alias("score")), limit)


@query(f"""WITH {DENSE_SQL}, a AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM x),
    b AS (SELECT q.vec_id AS query_id, v.vec_id AS id, row_number() OVER (PARTITION BY q.vec_id ORDER BY v.vec_id) AS rank FROM embeddings q JOIN embeddings v ON q.label = v.label AND q.vec_id % 20 = 0 AND v.vec_id <> q.vec_id),
    f AS (SELECT query_id, id, sum(0.5 / (60 + rank)) AS score FROM (SELECT * FROM a WHERE rank <= 100 UNION ALL SELECT * FROM b WHERE rank <= 100) GROUP BY ALL),
    r AS (SELECT query_id, id, round(score, 9) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank FROM f) SELECT * FROM r WHERE rank <= 10""")
def hybrid_rrf(spark, sf):
    fused = retrieval.reciprocal_rank_fusion([(_dense(spark, sf, 100), 0.5), (_by_label(spark, sf, 100), 0.5)])
    return retrieval.top_ranked(fused.withColumn("score", F.round("score", 9)), 10)


@query(f"""WITH {DENSE_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id, label ORDER BY s DESC, id) AS n FROM x),
    g AS (SELECT query_id, label, max(s) AS score, min(id) FILTER (n = 1) AS best_id, string_agg(id::VARCHAR, ',' ORDER BY n) FILTER (n <= 3) AS evidence FROM r GROUP BY ALL),
    k AS (SELECT query_id, label AS document_id, round(score, 6) AS score, best_id, evidence, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, label) AS rank FROM g) SELECT * FROM k WHERE rank <= 5""")
def rollup_topk(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("document_id"), "embedding")
    asked = e.where("id % 20 = 0").select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vector"))
    scores = retrieval.dense_top(e, asked, 3, group="document_id", apart=True)
    return retrieval.roll_up(scores, 5).select("query_id", "document_id", F.round("score", 6).alias("score"), "best_id", F.array_join(F.transform("evidence", lambda x: x.cast("string")), ",").alias("evidence"), "rank")


# -- filters and facets ------------------------------------------------------------------------


def _orders(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    return o.join(c, o.o_custkey == c.c_custkey)


@query("SELECT o_orderkey, o_custkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey WHERE lower(c_mktsegment) IN ('building', 'machinery') AND lower(o_orderstatus) = 'f'")
def hard_filters(spark, sf):
    wanted = filters.compile_filters({"c_mktsegment": "one", "o_orderstatus": "one"}, {"c_mktsegment": ["Building ", "machinery", ""], "o_orderstatus": ["F"]})
    return _orders(spark, sf).where(wanted).select("o_orderkey", "o_custkey", "c_mktsegment")


@query("""SELECT o_custkey, min(year(o_orderdate)) AS year_start, max(year(o_orderdate)) AS year_end FROM orders GROUP BY o_custkey HAVING max(year(o_orderdate)) >= 1996 AND min(year(o_orderdate)) <= 1997""")
def year_overlap(spark, sf):
    spans = table(spark, sf, "orders").groupBy("o_custkey").agg(F.min(F.year("o_orderdate")).cast("long").alias("year_start"), F.max(F.year("o_orderdate")).cast("long").alias("year_end"))
    return spans.where(V.overlaps_years(F.col("year_start"), F.col("year_end"), 1996, 1997))


@query("""WITH f AS (SELECT o_orderstatus IN ('F', 'O') AS a, o_totalprice >= 1000 AS e, c_mktsegment <> 'AUTOMOBILE' AS h, o_totalprice > 200000 AS x FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT count(*) AS rows, count(*) FILTER (NOT a) AS unauthorized, count(*) FILTER (a AND NOT e) AS ineligible, count(*) FILTER (a AND e AND NOT h) AS filtered, count(*) FILTER (a AND e AND h AND x) AS excluded, count(*) FILTER (a AND e AND h AND NOT x) AS kept FROM f""")
def exclusion_audit(spark, sf):
    _, audit = filters.filter_with_audit(_orders(spark, sf), F.col("o_orderstatus").isin("F", "O"), F.col("o_totalprice") >= 1000, ~filters.exclusion("c_mktsegment", "eq", "AUTOMOBILE"), filters.exclusion("o_totalprice", "gt", 200000))
    return audit


@query("""WITH j AS (SELECT o_orderstatus, c_mktsegment, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
    SELECT 'o_orderstatus' AS facet, o_orderstatus AS value, count(*) AS n FROM j GROUP BY ALL UNION ALL SELECT 'c_mktsegment', c_mktsegment, count(*) FROM j GROUP BY ALL
    UNION ALL SELECT 'n_name', n_name, count(*) FROM j GROUP BY ALL UNION ALL SELECT 'r_name', r_name, count(*) FROM j GROUP BY ALL""")
def facets(spark, sf):
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    j = _orders(spark, sf).join(n, F.col("c_nationkey") == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return filters.facet_counts(j, ["o_orderstatus", "c_mktsegment", "n_name", "r_name"])


@query("""SELECT c_custkey, coalesce(n_name, '') AS country_name, coalesce(r_name, '') AS region FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def canonical_country(spark, sf):
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    codes = n.join(r, n.n_regionkey == r.r_regionkey, "left").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country_name"), F.col("r_name").alias("region"))
    return relational.left_with_defaults(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), codes, ["c_nationkey"], {"country_name": "", "region": ""}).drop("c_nationkey")


@query("""SELECT p_partkey, concat_ws(',', CASE WHEN lower(p_type) LIKE '%brass%' OR lower(p_type) LIKE '%copper%' THEN 'alloy' END, CASE WHEN lower(p_type) LIKE '%plated%' THEN 'finish' END, CASE WHEN lower(p_type) LIKE '%small%' OR lower(p_type) LIKE '%economy%' THEN 'low_end' END) AS tags FROM part""")
def tag_detection(spark, sf):
    found = V.tags(F.col("p_type"), {"alloy": ["brass", "copper"], "finish": ["PLATED"], "low_end": ["small", "economy"]})
    return table(spark, sf, "part").select("p_partkey", F.array_join(found, ",").alias("tags"))


@query("""SELECT p_partkey, 'LOW_PRICE' AS issue, 'WARNING' AS severity FROM part WHERE p_retailprice < 1000 UNION ALL SELECT p_partkey, 'ODD_SIZE', 'ERROR' FROM part WHERE p_size % 7 = 0 UNION ALL SELECT p_partkey, 'NO_NAME', 'ERROR' FROM part WHERE p_name IS NULL OR p_name = ''""")
def data_quality_issues(spark, sf):
    checks = {"LOW_PRICE": ("WARNING", F.col("p_retailprice") < 1000), "ODD_SIZE": ("ERROR", F.col("p_size") % 7 == 0), "NO_NAME": ("ERROR", F.coalesce(F.col("p_name"), F.lit("")) == "")}
    return issue_rows(table(spark, sf, "part"), "p_partkey", checks)


# -- matching ----------------------------------------------------------------------------------

CLASSES = {"1-URGENT": "MUST", "2-HIGH": "MUST", "3-MEDIUM": "SHOULD", "4-NOT SPECIFIED": "PREFERRED", "5-LOW": "CONTEXT"}


def _evidence(spark, sf):
    """Orders stand in for evidence: the customer is the reference, the priority the requirement."""
    o = table(spark, sf, "orders")
    return o.select(F.col("o_custkey").alias("reference_id"), F.col("o_orderpriority").alias("requirement_id"), F.col("o_orderkey").alias("chunk_id"), F.col("o_totalprice").alias("score"), F.lit(0.5).alias("term_coverage"))


def _requirements(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderpriority").alias("requirement_id")).distinct().select("requirement_id", F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in CLASSES.items() for x in kv]), F.col("requirement_id")), F.lit("CONTEXT")).alias("classification"))


CASES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CLASSES.items())
GRID_SQL = f"""e AS (SELECT o_custkey AS reference_id, o_orderpriority AS requirement_id, o_orderkey AS chunk_id, 0.8 * least(1.0, greatest(0.0, o_totalprice / max(o_totalprice) OVER (PARTITION BY o_orderpriority))) + 0.2 * 0.5 AS rr FROM orders),
    req AS (SELECT DISTINCT o_orderpriority AS requirement_id, CASE o_orderpriority {CASES} ELSE 'CONTEXT' END AS classification FROM orders),
    b AS (SELECT reference_id, requirement_id, max(rr) AS relevance FROM e GROUP BY ALL),
    g AS (SELECT r.reference_id, q.requirement_id, q.classification, coalesce(b.relevance, 0) AS relevance, coalesce(b.relevance >= 0.3, false) AS covered FROM (SELECT DISTINCT reference_id FROM b) r CROSS JOIN req q LEFT JOIN b ON b.reference_id = r.reference_id AND b.requirement_id = q.requirement_id)"""


def _grid(spark, sf):
    return matching.coverage_grid(matching.rerank(_evidence(spark, sf)), _requirements(spark, sf))


@query(f"WITH {GRID_SQL} SELECT reference_id, requirement_id, classification, round(relevance, 6) AS relevance, covered FROM g")
def coverage_grid(spark, sf):
    return _grid(spark, sf).withColumn("relevance", F.round("relevance", 6))


@query(f"WITH {GRID_SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY reference_id, requirement_id ORDER BY rr DESC, chunk_id) AS evidence_rank FROM e) SELECT reference_id, requirement_id, chunk_id, round(rr, 6) AS rerank_score, evidence_rank FROM k WHERE evidence_rank <= 3")
def evidence_topk(spark, sf):
    return matching.keep_evidence(matching.rerank(_evidence(spark, sf))).select("reference_id", "requirement_id", "chunk_id", F.round("rerank_score", 6).alias("rerank_score"), "evidence_rank")


SCORE_SQL = f"""{GRID_SQL}, w AS (SELECT *, CASE classification WHEN 'MUST' THEN 1.0 WHEN 'SHOULD' THEN 0.7 WHEN 'PREFERRED' THEN 0.4 ELSE 0.15 END::DOUBLE AS wt FROM g),
    c AS (SELECT reference_id, sum(wt * relevance) / sum(wt) AS wr, sum(CASE WHEN covered THEN wt ELSE 0 END) / sum(wt) AS wc, count(*) FILTER (classification = 'MUST' AND covered) AS mc, count(*) FILTER (classification = 'MUST') AS mt FROM w GROUP BY ALL),
    y AS (SELECT o_custkey, max(year(o_orderdate)) AS year_end FROM orders GROUP BY ALL),
    s AS (SELECT reference_id, round(0.6 * wr + 0.2 * wc + 0.1 * 0.8 + 0.05 * greatest(0.0, 1 - (1998 - least(year_end, 1998)) / 20.0) + 0.05 * (CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END), 8) AS final_score, mc, mt, c_acctbal > 0 AS ok, c_nationkey AS dup
      FROM c JOIN customer ON c_custkey = reference_id JOIN y ON o_custkey = reference_id),
    t AS (SELECT *, concat_ws(';', CASE WHEN mc < mt THEN 'MISSING_MUST:' || mc || '/' || mt END, CASE WHEN NOT ok THEN 'BASE_ELIGIBILITY_FAILED' END) AS r FROM s),
    u AS (SELECT *, CASE WHEN r = '' AND row_number() OVER (PARTITION BY dup, r = '' ORDER BY final_score DESC, reference_id) > 1 THEN 'DUPLICATE_GROUP_SUPPRESSED' ELSE r END AS reasons FROM t),
    z AS (SELECT *, CASE WHEN reasons = '' THEN row_number() OVER (PARTITION BY reasons = '' ORDER BY final_score DESC, reference_id) END AS rk FROM u)"""


@query(f"WITH {SCORE_SQL} SELECT reference_id, round(final_score, 6) AS final_score, reasons, CASE WHEN rk <= 10 THEN rk END AS final_rank FROM z")
def weighted_score_mustgate(spark, sf):
    ends = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("reference_id")).agg(F.max(F.year("o_orderdate")).alias("year_end"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("reference_id"), F.lit(0.8).alias("evidence_strength"), matching.soft_fit({"c_mktsegment": "BUILDING", "no_such_field": "x"}, ["c_mktsegment"]).alias("soft_fit"), (F.col("c_acctbal") > 0).alias("base_eligible"), F.col("c_nationkey").alias("duplicate_group_id"))
    scored = matching.score_matches(_grid(spark, sf), c.join(ends, "reference_id"), reference_year=1998)
    return scored.select("reference_id", F.round("final_score", 6).alias("final_score"), "reasons", F.col("final_rank").cast("long").alias("final_rank"))


@query(f"WITH {GRID_SQL} SELECT requirement_id, classification, count(DISTINCT reference_id) FILTER (covered) AS supporting FROM g GROUP BY ALL")
def requirement_gaps(spark, sf):
    return matching.requirement_gaps(_grid(spark, sf)).drop("reference_ids")


@query("SELECT p_partkey, p_brand, CASE WHEN row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) > 1 THEN 'DUPLICATE_GROUP_SUPPRESSED' END AS suppressed FROM part")
def duplicate_suppression(spark, sf):
    return relational.keep_first(table(spark, sf, "part"), ["p_brand"], [F.desc("p_retailprice"), F.col("p_partkey")], "DUPLICATE_GROUP_SUPPRESSED").select("p_partkey", "p_brand", "suppressed")


@query("""WITH b AS (SELECT c_custkey, c_nationkey, c_acctbal, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) > 2 AS late FROM customer)
    SELECT c_custkey, c_nationkey, row_number() OVER (ORDER BY late, c_acctbal DESC, c_custkey) AS final_rank FROM b QUALIFY final_rank <= 60""")
def diversify(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", F.struct((-F.col("c_acctbal")).alias("s"), "c_custkey").alias("r"))
    return relational.diversify(c, "c_nationkey", "r", 2, 60).select("c_custkey", "c_nationkey", F.col("final_rank").cast("long").alias("final_rank"))


@query("""WITH s AS (SELECT count(*) AS total, count(*) FILTER (s_acctbal > 5000) AS a, count(*) FILTER (s_nationkey < 10) AS b, count(*) FILTER (s_acctbal > -1000) AS c FROM supplier)
    SELECT 'rich' AS rule, a AS matching, total, a >= 5 AS met FROM s UNION ALL SELECT 'near', b, total, b >= 1000000 FROM s UNION ALL SELECT 'all_solvent', c, total, c >= total FROM s""")
def portfolio_rules(spark, sf):
    return matching.evaluate_rules(table(spark, sf, "supplier"), {"rich": (F.col("s_acctbal") > 5000, 5), "near": (F.col("s_nationkey") < 10, 1_000_000), "all_solvent": (F.col("s_acctbal") > -1000, None)}).drop("ids")


# -- evaluation --------------------------------------------------------------------------------


def _rankings(spark, sf):
    return _dense(spark, sf, 20).select(F.lit("dense").alias("mode"), "query_id", "id", "rank").unionByName(_by_label(spark, sf, 20).select(F.lit("label").alias("mode"), "query_id", "id", "rank"))


def _grades(spark, sf):
    """Every other vector of a query's label is relevant to it."""
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("class"))
    return evaluation.SameClass(e, e.where("id % 20 = 0").withColumnRenamed("id", "query_id"))


METRICS_SQL = f"""{DENSE_SQL}, a AS (SELECT 'dense' AS mode, query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM x),
    b AS (SELECT 'label' AS mode, q.vec_id AS query_id, v.vec_id AS id, row_number() OVER (PARTITION BY q.vec_id ORDER BY v.vec_id) AS rank FROM embeddings q JOIN embeddings v ON q.label = v.label AND q.vec_id % 20 = 0 AND v.vec_id <> q.vec_id),
    k AS (SELECT * FROM (SELECT * FROM a UNION ALL SELECT * FROM b) WHERE rank <= 20),
    l AS (SELECT q.vec_id AS query_id, v.vec_id AS id FROM embeddings q JOIN embeddings v ON q.label = v.label AND q.vec_id % 20 = 0 AND v.vec_id <> q.vec_id), n AS (SELECT query_id, count(*) AS rel FROM l GROUP BY ALL),
    f AS (SELECT k.mode, k.query_id, count(*) FILTER (l.id IS NOT NULL AND rank <= 10) AS h10, count(*) FILTER (l.id IS NOT NULL AND rank <= 5) AS h5, min(rank) FILTER (l.id IS NOT NULL) AS fst, coalesce(sum(1 / log2(rank + 1)) FILTER (l.id IS NOT NULL AND rank <= 10), 0) AS dcg FROM k LEFT JOIN l ON l.query_id = k.query_id AND l.id = k.id GROUP BY ALL),
    m AS (SELECT mode, f.query_id, coalesce(rel, 0) > 0 AS answerable, h10 / rel AS recall_at_10, CASE WHEN rel > 0 THEN h5 / 5.0 ELSE 0 END AS precision_at_5, CASE WHEN rel > 0 THEN coalesce(1.0 / fst, 0) END AS mrr,
      dcg / list_sum(list_transform(range(1, least(rel, 10) + 1), lambda i: 1 / log2(i + 1))) AS ndcg_at_10 FROM f LEFT JOIN n USING (query_id))"""


@query(f"WITH {METRICS_SQL} SELECT mode, query_id, answerable, round(recall_at_10, 6) AS recall_at_10, round(precision_at_5, 6)::DOUBLE AS precision_at_5, round(mrr, 6)::DOUBLE AS mrr, round(ndcg_at_10, 6) AS ndcg_at_10 FROM m")
def ranking_metrics(spark, sf):
    m = evaluation.ranking_metrics(_rankings(spark, sf), _grades(spark, sf))
    return m.withColumns({c: F.round(c, 6) for c in ("recall_at_10", "precision_at_5", "mrr", "ndcg_at_10")})


MEANS_SQL = """count(*) AS queries, count(*) FILTER (answerable) AS answerable, count(*) FILTER (NOT answerable) AS no_relevant, round(avg(recall_at_10), 6) AS recall_at_10, round(avg(precision_at_5) FILTER (answerable), 6)::DOUBLE AS precision_at_5, round(avg(precision_at_5), 6)::DOUBLE AS precision_at_5_all_queries, round(avg(mrr), 6)::DOUBLE AS mrr, round(avg(ndcg_at_10), 6) AS ndcg_at_10"""


@query(f"WITH {METRICS_SQL} SELECT mode, {MEANS_SQL} FROM m GROUP BY mode")
def system_means(spark, sf):
    m = evaluation.system_means(evaluation.ranking_metrics(_rankings(spark, sf), _grades(spark, sf)))
    return m.withColumns({c: F.round(c, 6) for c in MEANS})


MEANS = ("recall_at_10", "precision_at_5", "precision_at_5_all_queries", "mrr", "ndcg_at_10")


@query(f"WITH {METRICS_SQL} SELECT mode, lang, {MEANS_SQL} FROM m LEFT JOIN documents ON doc_id = query_id GROUP BY mode, lang")
def subgroup_means(spark, sf):
    """Metrics by the language of the queried document, a missing one its own group."""
    m = evaluation.ranking_metrics(_rankings(spark, sf), _grades(spark, sf))
    attributes = table(spark, sf, "documents").select(F.col("doc_id").alias("query_id"), "lang")
    return evaluation.system_means(evaluation.with_attributes(m, attributes), ["mode", "lang"]).withColumns({c: F.round(c, 6) for c in MEANS})


@query(f"WITH {METRICS_SQL} SELECT query_id, max(recall_at_10) FILTER (mode = 'dense') AS dense, max(recall_at_10) FILTER (mode = 'label') AS label FROM (SELECT mode, query_id, round(recall_at_10, 6) AS recall_at_10 FROM m) GROUP BY query_id")
def system_pivot(spark, sf):
    m = evaluation.ranking_metrics(_rankings(spark, sf), _grades(spark, sf))
    return m.groupBy("query_id").pivot("mode", ["dense", "label"]).agg(F.first(F.round("recall_at_10", 6)))


@query()
def bootstrap_interval(spark, sf):
    metrics = evaluation.ranking_metrics(_rankings(spark, sf), _grades(spark, sf))
    found = evaluation.paired_bootstrap(metrics, ["recall_at_10", "precision_at_5", "mrr", "ndcg_at_10"])
    return found.withColumns({c: F.round(c, 6) for c in ("difference", "low", "high")})


@query("""SELECT lang, source, count(*) AS n, round(avg(quality), 6) AS quality, sum(toxic)::BIGINT AS toxic FROM documents JOIN labels USING (doc_id) GROUP BY GROUPING SETS ((lang), (source))""")
def subgroup_metrics(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "source").join(table(spark, sf, "labels"), "doc_id")
    return d.groupingSets([["lang"], ["source"]], "lang", "source").agg(F.count("*").alias("n"), F.round(F.avg("quality"), 6).alias("quality"), F.sum("toxic").alias("toxic"))


@query("""WITH t AS (SELECT count(*)::DOUBLE AS t, count(*) FILTER (quality = toxic) AS s, sum((quality - toxic) ** 2) AS o FROM labels), a AS (SELECT quality AS g, count(*)::DOUBLE AS n FROM labels GROUP BY ALL), b AS (SELECT toxic AS g, count(*)::DOUBLE AS n FROM labels GROUP BY ALL),
    e AS (SELECT sum((a.g - b.g) ** 2 * a.n * b.n) AS e FROM a, b) SELECT round(1 - (o / t) / (e / t / t), 6) AS kappa, round(s / t, 6) AS agreement, t::BIGINT AS pairs FROM t, e""")
def weighted_kappa(spark, sf):
    k = evaluation.weighted_kappa(table(spark, sf, "labels"), "quality", "toxic", 2)
    return k.select(F.round("kappa", 6).alias("kappa"), F.round("agreement", 6).alias("agreement"), "pairs")


@query("SELECT lang, doc_id, sha256('seed-1|' || lang || '|' || doc_id::VARCHAR) AS blind_key, row_number() OVER (PARTITION BY lang ORDER BY sha256('seed-1|' || lang || '|' || doc_id::VARCHAR)) AS position FROM documents")
def blinded_order(spark, sf):
    return relational.blinded_order(table(spark, sf, "documents").select("lang", "doc_id"), "lang", "doc_id", "seed-1").withColumn("position", F.col("position").cast("long"))


@query("""WITH k AS (SELECT doc_id, lang, sha256('audit|' || doc_id::VARCHAR) AS sample_key FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY sample_key) > 5 AS late FROM k)
    SELECT doc_id, lang, sample_key FROM r ORDER BY late, sample_key LIMIT 30""")
def stratified_sample(spark, sf):
    return relational.stratified_sample(table(spark, sf, "documents").select("doc_id", "lang"), "lang", "doc_id", 5, 30, "audit")


@query("SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY event_type")
def latency_percentiles(spark, sf):
    p = evaluation.exact_percentiles(table(spark, sf, "events"), ["event_type"], "value", [0.5, 0.95])
    return p.groupBy("event_type").pivot("share", [0.5, 0.95]).agg(F.first(F.round("percentile", 6))).toDF("event_type", "p50", "p95")


@query("SELECT avg(quality) AS value, 0.5::DOUBLE AS threshold, avg(quality) >= 0.5 AS passed, 'quality' AS metric FROM labels UNION ALL SELECT avg(1 - toxic), 0.95, avg(1 - toxic) >= 0.95, 'clean' FROM labels")
def quality_gate(spark, sf):
    one = table(spark, sf, "labels").agg(F.avg("quality").alias("quality"), F.avg(1 - F.col("toxic")).alias("clean"))
    return evaluation.gate(one, {"quality": 0.5, "clean": 0.95})


# -- requests ----------------------------------------------------------------------------------

MARKERS = {"MUST": ["the", "doit"], "SHOULD": ["and", "der"], "PREFERRED": ["of", "que"]}


@query()
def requirement_units(spark, sf):
    r = requirements.requirements(table(spark, sf, "conversations").select(F.concat_ws(":", "conv_id", "turn").alias("locator"), "text"), "locator", "text", MARKERS)
    return r.select("requirement_id", "locator", "unit", "classification", F.length("unit_text").alias("chars"))


@query(r"""WITH w AS (SELECT DISTINCT item_id::VARCHAR AS id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS value FROM benchmark), x AS (SELECT id FROM w WHERE value IN ('exclure', 'exclu', 'hors', 'sauf', 'sans', 'exclude', 'excluding', 'without', 'باستثناء', 'بدون')),
    v AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS value FROM documents)
    SELECT 'word' AS field, value, CASE WHEN id IN (SELECT id FROM x) THEN 'EXCLUSION_CANDIDATE' ELSE 'HARD_CANDIDATE' END AS behavior, min(id) AS requirement_id FROM w JOIN v USING (value) GROUP BY ALL""")
def filter_proposals(spark, sf):
    """Every word of every document as a facet value."""
    reqs = table(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("requirement_id"), F.lit("MUST").alias("classification"), F.col("text").alias("folded"))
    listed = table(spark, sf, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))).alias("value"))
    return requirements.filter_proposals(reqs, listed.select(F.lit("word").alias("field"), "value").distinct(), key=requirements.word_key)


@query("""WITH RECURSIVE e AS (SELECT 'root' AS parent, 'r' || r_regionkey AS id, r_name AS name FROM region UNION ALL SELECT 'r' || n_regionkey, 'n' || n_nationkey, n_name FROM nation UNION ALL SELECT 'n' || s_nationkey, 's' || s_suppkey, s_name FROM supplier),
    t AS (SELECT id, 1 AS depth, name AS path FROM e WHERE parent = 'root' UNION ALL SELECT e.id, t.depth + 1, t.path || '/' || e.name FROM e JOIN t ON e.parent = t.id) SELECT id, depth, path FROM t""")
def tree_inventory(spark, sf):
    r, n, s = (table(spark, sf, t) for t in ("region", "nation", "supplier"))

    def edge(df, parent, prefix, key, name):
        return df.select(parent.alias("parent"), F.concat(F.lit(prefix), F.col(key).cast("string")).alias("id"), F.col(name).alias("name"))

    edges = edge(r, F.lit("root"), "r", "r_regionkey", "r_name").unionByName(edge(n, F.concat(F.lit("r"), F.col("n_regionkey").cast("string")), "n", "n_nationkey", "n_name")).unionByName(edge(s, F.concat(F.lit("n"), F.col("s_nationkey").cast("string")), "s", "s_suppkey", "s_name"))
    return relational.tree_paths(edges, "root")


@query("""SELECT 'both' AS part, count(*) AS n FROM (SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders) UNION ALL SELECT 'only_left', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)""")
def id_set_ops(spark, sf):
    a, b = table(spark, sf, "customer").select(F.col("c_custkey").alias("id")), table(spark, sf, "orders").select(F.col("o_custkey").alias("id"))
    return a.intersect(b).agg(F.lit("both").alias("part"), F.count("*").alias("n")).unionByName(a.subtract(b).agg(F.lit("only_left").alias("part"), F.count("*").alias("n")))


@query()
def table_hash(spark, sf):
    return relational.logical_hash(table(spark, sf, "documents"), ["doc_id", "text", "lang", "source"])


# -- engines -----------------------------------------------------------------------------------


def _chunks(spark, sf, *columns):
    """Documents as chunks of their source; German ones are restricted."""
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("document_id"), "text", F.when(F.col("lang") == "de", "RESTRICTED").otherwise("PUBLIC").alias("security_classification"), *columns)


def _vector_chunks(spark, sf):
    """The chunks that have a vector in ``embeddings``."""
    v = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return _chunks(spark, sf).join(v, "id")


def vector_index(spark, sf):
    """The stored index of the chunks that have a vector."""
    key = (spark.sparkContext.applicationId, sf, fingerprint(table(spark, sf, "documents")), fingerprint(table(spark, sf, "embeddings")))
    if key not in _indexes:
        _indexes[key] = search.passage_index(_vector_chunks(spark, sf)).path
    return Bm25Index.load(spark, _indexes[key])


def _asked(spark, sf):
    b = table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text")
    return b.join(table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("query_vector")), "id")


HYBRID_SQL = rf"""j AS (SELECT doc_id AS id, source, lang, text, embedding FROM documents JOIN embeddings ON vec_id = doc_id),
    b AS (SELECT item_id, text, embedding FROM benchmark JOIN embeddings ON vec_id = item_id),
    d AS (SELECT id, {TOKENS_SQL} AS t FROM j), n AS (SELECT count(*) AS n, avg(len(t)) AS m FROM d),
    p AS (SELECT id, dl, term, count(*) AS tf FROM (SELECT id, len(t) AS dl, unnest(t) AS term FROM d) GROUP BY ALL), s AS (SELECT term, count(*) AS df FROM p GROUP BY term),
    q AS (SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id, unnest({TOKENS_SQL}) AS term FROM b) GROUP BY ALL),
    r AS (SELECT item_id, id, round(sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / m))), 6) AS score FROM p JOIN s USING (term) JOIN q USING (term), n GROUP BY ALL),
    ok AS (SELECT id, source, embedding FROM j WHERE lang IS DISTINCT FROM 'de'),
    lex AS (SELECT b.item_id, ok.id, row_number() OVER (PARTITION BY b.item_id ORDER BY coalesce(score, 0) DESC, ok.id) AS rank FROM b CROSS JOIN ok LEFT JOIN r ON r.item_id = b.item_id AND r.id = ok.id),
    den AS (SELECT b.item_id, ok.id, row_number() OVER (PARTITION BY b.item_id ORDER BY list_inner_product(ok.embedding::DOUBLE[], b.embedding::DOUBLE[]) DESC, ok.id) AS rank FROM b CROSS JOIN ok),
    f AS (SELECT item_id, id, sum(0.5 / (60 + rank)) AS score FROM (SELECT * FROM lex WHERE rank <= 100 UNION ALL SELECT * FROM den WHERE rank <= 100) GROUP BY ALL),
    h AS (SELECT item_id, id, source, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, id) AS rank FROM f JOIN ok USING (id))"""


FILTERED_SQL = f"""own AS (SELECT b.item_id, d.source, d.lang FROM benchmark b JOIN documents d ON d.doc_id = b.item_id),
    ok AS (SELECT own.item_id, d.doc_id, own.source IS NOT NULL AND d.source = own.source AND (own.lang IS NULL OR own.item_id % 2 = 0 OR d.lang = own.lang) AS may FROM own JOIN documents d ON d.lang IS DISTINCT FROM 'de'),
    k AS (SELECT ok.item_id, ok.doc_id, round(coalesce(r.score, 0), 6) AS score, row_number() OVER (PARTITION BY ok.item_id ORDER BY coalesce(r.score, 0) DESC, ok.doc_id) AS rank FROM ok LEFT JOIN r ON r.item_id = ok.item_id AND r.doc_id = ok.doc_id WHERE may)"""


def _own_filters(spark, sf):
    """Each item asks for the source of the document of its id, and odd ones for its language, too."""
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("query_id"), "source", "lang")
    own = d.join(table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id")), "query_id")
    wanted = F.array(F.struct(F.lit("source").alias("facet"), F.col("source").alias("value")), F.struct(F.lit("lang").alias("facet"), F.when(F.col("query_id") % 2 == 1, F.col("lang")).alias("value")))
    each = own.select("query_id", F.inline(wanted)).where("value IS NOT NULL").select("query_id", "facet", F.lit("is").alias("operator"), folded_form("value").alias("value"))
    return Scope(each, {"source", "lang"})


@query(f"WITH {BM25_SQL}, {FILTERED_SQL} SELECT item_id, doc_id, score, rank FROM k WHERE rank <= 10")
def filtered_search(spark, sf):
    """Every item under its own hard filters, in one plan."""
    asked = table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text")
    asked = asked.join(table(spark, sf, "documents").where("source IS NOT NULL").select(F.col("doc_id").alias("id")), "id")
    scope = Scope.security(spark, "security_classification", ["public"], "bigint").also(_own_filters(spark, sf))
    return bm25_index(spark, sf).top(asked, 10, scope).select(F.col("query_id").alias("item_id"), F.col("id").alias("doc_id"), "score", "rank")


@query(f"WITH {BM25_SQL}, {FILTERED_SQL} SELECT item_id AS query_id, count(*) FILTER (rank <= 10) AS scored, count(*) FILTER (rank <= 10) AS authorized, count(*) FILTER (rank <= 10) AS in_scope FROM k GROUP BY item_id")
def filtered_audit(spark, sf):
    """What ``filtered_search`` returned, looked up again in the documents."""
    hits = filtered_search(spark, sf).select(F.col("item_id").alias("query_id"), F.col("doc_id").alias("id"))
    chunks = _chunks(spark, sf, "source", "lang")
    return search.hit_audit(hits, chunks, ["PUBLIC"], _own_filters(spark, sf))


@query("""WITH h AS (SELECT p_partkey, p_type, 'Document: ' || p_name || chr(10) || 'Client: ' || p_brand || chr(10) || 'Secteur: ' || array_to_string(list_slice(list_filter(string_split(p_type, ' '), lambda x: x <> ''), 1, 3), ' | ') || chr(10) || 'Année: ' || p_size::VARCHAR AS head FROM part)
    SELECT p_partkey, sha256(trim(rtrim(head[1:700]) || chr(10) || trim(p_type))) AS retrieval_text_sha256 FROM h""")
def retrieval_texts(spark, sf):
    """Parts stand in for chunks: their name is the document, brand, type and size the facets."""
    p = table(spark, sf, "part")
    text = T.retrieval_text(F.col("p_name"), {"client": F.array("p_brand"), "sector": F.split("p_type", " "), "project_year": F.array(F.col("p_size").cast("string"))}, F.col("p_type"))
    return p.select("p_partkey", F.sha2(text, 256).alias("retrieval_text_sha256"))


@query(f"WITH {HYBRID_SQL} SELECT item_id AS query_id, id, round(score, 9) AS score, rank FROM h WHERE rank <= 10")
def hybrid_chunks(spark, sf):
    found = search.search_chunks(_vector_chunks(spark, sf), _asked(spark, sf), ["PUBLIC"], index=vector_index(spark, sf))
    return found.select("query_id", "id", F.round("score", 9).alias("score"), "rank")


@query(f"""WITH {HYBRID_SQL}, g AS (SELECT item_id, source, max(score) AS score, arg_min(id, rank) AS best_id FROM h WHERE rank <= 100 GROUP BY ALL),
    k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, source) AS rank FROM g)
    SELECT item_id AS query_id, source AS document_id, round(score, 9) AS score, best_id, rank FROM k WHERE rank <= 5""")
def hybrid_documents(spark, sf):
    r = search.search_documents(_vector_chunks(spark, sf), _asked(spark, sf), ["PUBLIC"], limit=5, index=vector_index(spark, sf))
    return r.select("query_id", "document_id", F.round("score", 9).alias("score"), "best_id", "rank")


STOP = ", ".join(f"'{w}'" for w in T.QUERY_STOP_WORDS)
TERMS_SQL = rf"list_distinct(list_filter(list_transform(regexp_extract_all(coalesce(text, ''), '[\p{{L}}\p{{N}}_À-ÿ]+'), lambda w: trim(regexp_replace(strip_accents(replace(lower(w), 'ß', 'ss')), '[^a-z0-9]+', ' ', 'g'))), lambda w: length(w) >= 2 AND w NOT IN ({STOP})))"


@query(f"""WITH {BM25_SQL}, ok AS (SELECT doc_id, source, text FROM documents WHERE lang IS DISTINCT FROM 'de' AND source IS NOT NULL),
    c AS (SELECT b.item_id, ok.doc_id, ok.source, coalesce(r.score, 0) AS score, row_number() OVER (PARTITION BY b.item_id ORDER BY coalesce(r.score, 0) DESC, ok.doc_id) AS rank FROM benchmark b CROSS JOIN ok LEFT JOIN r ON r.item_id = b.item_id AND r.doc_id = ok.doc_id),
    want AS (SELECT item_id, {TERMS_SQL} AS w FROM benchmark), have AS (SELECT doc_id, {TERMS_SQL} AS h FROM ok),
    e AS (SELECT item_id, doc_id, source, score, rank, CASE WHEN len(w) > 0 THEN len(list_intersect(w, h)) / len(w) ELSE 0 END AS cov, max(score) OVER (PARTITION BY item_id) AS top FROM c JOIN want USING (item_id) JOIN have USING (doc_id) WHERE rank <= 100),
    x AS (SELECT *, 0.8::DOUBLE * CASE WHEN top > 0 THEN least(1.0, greatest(0.0, score / top)) ELSE 0 END + 0.2::DOUBLE * cov AS rr FROM e),
    k AS (SELECT *, row_number() OVER (PARTITION BY source, item_id ORDER BY rr DESC, doc_id) AS n FROM x)
    SELECT 'REF-' || source AS reference_id, item_id AS requirement_id, doc_id AS chunk_id, score, rank AS retrieval_rank, round(cov, 6) AS term_coverage, round(rr, 6) AS rerank_score, n AS evidence_rank FROM k WHERE n <= 3""")
def matched_evidence(spark, sf):
    refs = table(spark, sf, "documents").select("source").where("source IS NOT NULL").distinct().select(F.concat(F.lit("REF-"), "source").alias("reference_id"), F.col("source").alias("document_id"))
    asked = table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text")
    found = search.match(_chunks(spark, sf), asked, refs, ["PUBLIC"], mode="bm25", index=bm25_index(spark, sf))
    found = found.drop("lexical_score", "lexical_rank", "dense_score", "dense_rank")
    return found.withColumn("rerank_score", F.round("rerank_score", 6)).withColumn("term_coverage", F.round("term_coverage", 6))


# -- contract, recommendations, labels, records ------------------------------------------------


def _contract(spark, sf):
    """Customers stand in for references: their nation, region, segment, order years and statuses."""
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min(F.year("o_orderdate")).alias("year_start"), F.max(F.year("o_orderdate")).alias("year_end"), F.array_sort(F.collect_set("o_orderstatus")).alias("capability_tags"))
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    c = table(spark, sf, "customer").join(n, F.col("c_nationkey") == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).join(o, "c_custkey", "left")
    return c.select(
        F.col("c_custkey").alias("reference_id"), F.when(F.col("c_custkey") % 5 == 0, "CONFIDENTIAL").otherwise("INTERNAL").alias("security_classification"), (F.col("c_acctbal") > 0).alias("base_shortlist_eligible"),
        F.col("n_name").alias("country_code"), F.col("r_name").alias("region"), F.col("c_mktsegment").alias("sector_code"), "year_start", "year_end", "capability_tags", (F.col("c_acctbal") / 10000.0).alias("evidence_strength"), F.col("year_end").isNotNull().alias("evidence_available"),
    )


def _filtered(spark, sf):
    vocabulary = filters.ContractVocabulary({"sector_code": {"Bâtiment": "BUILDING", "machines": "MACHINERY", "cars": "AUTOMOBILE"}})
    hard = {"region": ["asia ", "Éurope", "AMERICA"], "sector_code": ["batiment", "Machines", "AUTOMOBILE"], "capability_tags": ["f"], "year_from": "1997", "year_to": 1995, "evidence_min_strength": 0.1, "offering_code": ""}
    drop = [{"field": "country_code", "operator": "contains", "value": "Ind"}, {"field": "evidence_strength", "operator": "gt", "value": "0.95"}, {"field": "evidence_available", "operator": "is_false"}]
    return filters.filter_contract(_contract(spark, sf), [" ", "internal", "Public"], hard, drop, vocabulary)


FLAGS_SQL = """o AS (SELECT o_custkey, min(year(o_orderdate)) AS ys, max(year(o_orderdate)) AS ye, list(DISTINCT o_orderstatus) AS tags FROM orders GROUP BY ALL),
    k AS (SELECT c_custkey, c_custkey % 5 <> 0 AS a, c_acctbal > 0 AS e, r_name IN ('ASIA', 'EUROPE', 'AMERICA') AND c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') AND coalesce(list_contains(tags, 'F') AND ye >= 1997 AND ys <= 1995, false) AND c_acctbal / 10000.0 >= 0.1 AS h,
      lower(n_name) LIKE '%ind%' OR c_acctbal / 10000.0 > 0.95 OR ye IS NULL AS x FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN o ON o_custkey = c_custkey)"""


@query(f"WITH {FLAGS_SQL} SELECT c_custkey AS reference_id FROM k WHERE a AND e AND h AND NOT x")
def contract_filter(spark, sf):
    return _filtered(spark, sf)[0].select("reference_id")


@query(f"""WITH {FLAGS_SQL} SELECT count(*) AS rows, count(*) FILTER (NOT a) AS unauthorized, count(*) FILTER (a AND NOT e) AS ineligible, count(*) FILTER (a AND e AND NOT h) AS filtered, count(*) FILTER (a AND e AND h AND x) AS excluded,
    count(*) FILTER (a AND e AND h AND NOT x) AS kept, coalesce(string_agg(c_custkey::VARCHAR, ',' ORDER BY c_custkey) FILTER (a AND e AND h AND x), '') AS excluded_ids FROM k""")
def contract_audit(spark, sf):
    return _filtered(spark, sf)[1].withColumn("excluded_ids", F.array_join(F.transform("excluded_ids", lambda x: x.cast("string")), ","))


TYPES, QUALITIES = {"F": 0.9, "O": 0.7, "OTHER": 0.4}, {"1": 1.0, "2": 0.8, "OTHER": 0.5}


def _v1(spark, sf):
    o = table(spark, sf, "orders")
    top = F.max("o_totalprice").over(Window.partitionBy("o_orderpriority"))
    ev = o.select(F.col("o_custkey").alias("reference_id"), F.col("o_orderpriority").alias("requirement_id"), (F.col("o_totalprice") / top).alias("relevance"), F.col("o_orderstatus").alias("document_type"), F.substring("o_orderpriority", 1, 1).alias("data_quality_status"))
    spans = o.groupBy(F.col("o_custkey").alias("reference_id")).agg(F.concat(F.lit("de "), F.min(F.year("o_orderdate")), F.lit(" à "), F.max(F.year("o_orderdate"))).alias("project_year"))
    refs = table(spark, sf, "customer").select(F.col("c_custkey").alias("reference_id"), F.col("c_mktsegment").alias("sector"), (F.col("c_acctbal") > 0).alias("evidence_available")).join(spans, "reference_id")
    return ev, recommend.score_references(ev, _requirements(spark, sf), refs, [("sector", "Build")], TYPES, QUALITIES, 0.5, 1998)


V1_SQL = f"""e AS (SELECT o_custkey AS ref, o_orderpriority AS q, o_totalprice / max(o_totalprice) OVER (PARTITION BY o_orderpriority) AS rel,
      CASE o_orderstatus WHEN 'F' THEN 0.9 WHEN 'O' THEN 0.7 ELSE 0.4 END::DOUBLE * CASE o_orderpriority[1] WHEN '1' THEN 1.0 WHEN '2' THEN 0.8 ELSE 0.5 END::DOUBLE AS strength FROM orders),
    req AS (SELECT DISTINCT o_orderpriority AS q, CASE o_orderpriority {CASES} ELSE 'CONTEXT' END AS cls FROM orders),
    g AS (SELECT r.ref, req.q, cls, coalesce(max(rel), 0) AS rel FROM (SELECT DISTINCT ref FROM e) r CROSS JOIN req LEFT JOIN e ON e.ref = r.ref AND e.q = req.q GROUP BY ALL),
    w AS (SELECT *, rel >= 0.5 AS cov, CASE cls WHEN 'MUST' THEN 1.0 WHEN 'SHOULD' THEN 0.7 WHEN 'PREFERRED' THEN 0.4 ELSE 0.15 END::DOUBLE AS wt FROM g),
    c AS (SELECT ref, sum(wt * rel) / sum(wt) AS wr, sum(CASE WHEN cov THEN wt ELSE 0 END) / sum(wt) AS wc, count(*) FILTER (cls = 'MUST' AND cov) AS mc, count(*) FILTER (cls = 'MUST') AS mt FROM w GROUP BY ref),
    s AS (SELECT ref, max(strength) AS eq FROM e GROUP BY ref), y AS (SELECT o_custkey, max(year(o_orderdate)) AS ye FROM orders GROUP BY ALL)"""


@query(f"""WITH {V1_SQL} SELECT ref AS reference_id, round(round(0.6 * wr + 0.2 * wc + 0.1 * eq + 0.05 * greatest(0.0, 1 - (1998 - least(ye, 1998)) / 20.0) + 0.05 * (CASE WHEN lower(c_mktsegment) LIKE '%build%' THEN 1 ELSE 0 END), 8), 6) AS base_score, mc AS must_covered, mt AS must_total,
    concat_ws('; ', CASE WHEN mc < mt THEN 'MUST coverage ' || mc || '/' || mt END, CASE WHEN c_acctbal <= 0 THEN 'missing supporting evidence' END) AS warnings FROM c JOIN s USING (ref) JOIN y ON o_custkey = ref JOIN customer ON c_custkey = ref""")
def recommendation_scores(spark, sf):
    return _v1(spark, sf)[1][0].select("reference_id", F.round("base_score", 6).alias("base_score"), "must_covered", "must_total", "warnings")


@query(f"WITH {V1_SQL}, m AS (SELECT q, count(DISTINCT ref) AS n FROM e WHERE rel >= 0.9 GROUP BY q) SELECT req.q AS requirement_id, cls AS classification, coalesce(n, 0) AS references_with_evidence, coalesce(n, 0) = 0 AS gap, CASE WHEN coalesce(n, 0) = 0 THEN 'NO_RELIABLE_EVIDENCE_FOUND' ELSE 'EVIDENCE_FOUND' END AS status FROM req LEFT JOIN m ON m.q = req.q")
def gap_summary(spark, sf):
    return recommend.gap_summary(_requirements(spark, sf), _v1(spark, sf)[0], 0.9)


@query(f"""WITH {GRID_SQL}, c AS (SELECT * FROM g WHERE covered AND reference_id % 10 = 0)
    SELECT q.requirement_id, count(DISTINCT c.reference_id) AS supporting, coalesce(string_agg(DISTINCT c.reference_id::VARCHAR, ','  ORDER BY c.reference_id::VARCHAR), '') AS reference_ids FROM (SELECT DISTINCT requirement_id FROM g WHERE reference_id % 10 = 0) q LEFT JOIN c USING (requirement_id) GROUP BY ALL""")
def portfolio_coverage(spark, sf):
    chosen = table(spark, sf, "customer").where("c_custkey % 10 = 0").select(F.col("c_custkey").alias("reference_id"))  # the portfolio
    found = reference_contract.portfolio_coverage(_grid(spark, sf), chosen)
    return found.select("requirement_id", "supporting", F.array_join(F.array_sort(F.transform("reference_ids", lambda x: x.cast("string"))), ",").alias("reference_ids"))


BY = dict(country_aliases={"France ": "FR", "GERMANY": "DE", "Allemagne": "DE", "chine": "CN", "CHINA": "CN"}, countries={"FR": {"name": "France", "region": "Europe", "subregion": "West"}, "DE": {"name": "Allemagne", "region": "Europe"}, "CN": {"region": "Asia"}}, sector_aliases={"Building": "CONSTRUCTION", "machinery": "INDUSTRY"}, evidence_types={"1-URGENT": "ATTESTATION_ORIGINAL", "2-High": "CONTRACT"}, evidence_strength={"ATTESTATION_ORIGINAL": 1.0, "CONTRACT": 0.7, "OTHER": 0.2}, capability_taxonomy={"BUILD": ["building", "bâtiment"], "CAR": ["automob"]}, ongoing=("en cours",))


def _normalized(spark, sf):
    """Orders stand in for references, customers for their documents; those of rich ones are missing."""
    n = table(spark, sf, "nation")
    c = table(spark, sf, "customer").join(n, F.col("c_nationkey") == n.n_nationkey)
    o = table(spark, sf, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
    year = F.year("o_orderdate")
    refs = o.select(
        F.col("o_orderkey").cast("string").alias("reference_id"), F.when(F.col("o_orderkey") % 11 == 0, "#REF!").otherwise("n").alias("reference_number"), F.concat(F.lit("S"), F.col("o_custkey") % 3).alias("sheet"), F.col("o_orderkey").alias("row_number"),
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey").cast("string")).alias("canonical_document_id"), F.col("c_name").alias("client"), F.col("n_name").alias("country"), F.col("c_mktsegment").alias("sector"), F.lit("x").alias("offering"), F.lit("Étude").alias("service_nature"),
        F.when(F.col("o_orderkey") % 13 == 0, "").when(F.col("o_orderkey") % 5 == 0, F.concat(year, F.lit(" - En  COURS"))).otherwise(F.concat(year, F.lit("/"), year + 1)).alias("project_year"), F.col("o_orderpriority").alias("attestation_available"), (F.col("o_orderstatus") != "P").alias("evidence_available"), F.lit(True).alias("document_retrieval_eligible"), F.lit("PASS").alias("data_quality_status"),
    )
    docs = table(spark, sf, "customer").where("c_acctbal < 9000").select(F.col("c_custkey").cast("string").alias("document_id"), F.lit("f").alias("file_name"), F.sha2("c_name", 256).alias("source_sha256"), F.lit("CONTRACT").alias("document_type"), F.lit("fr").alias("document_language"), F.lit("PUBLIC").alias("security_classification"), (F.col("c_acctbal") > 0).alias("retrieval_eligible"))
    return reference_contract.build_contract(refs, docs, reference_contract.Normalization(**BY))


CONTRACT_SQL = """r AS (SELECT *, year(o_orderdate) AS y, o_orderkey % 7 <> 0 AS doc, o_orderkey % 13 = 0 AS undated, o_orderkey % 5 = 0 AS going, doc AND c_acctbal < 9000 AS has FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
    k AS (SELECT o_orderkey::VARCHAR AS reference_id, CASE n_name WHEN 'FRANCE' THEN 'FR' WHEN 'GERMANY' THEN 'DE' WHEN 'CHINA' THEN 'CN' ELSE '' END AS country_code, CASE WHEN n_name IN ('FRANCE', 'GERMANY') THEN 'Europe' WHEN n_name = 'CHINA' THEN 'Asia' ELSE '' END AS region,
      CASE c_mktsegment WHEN 'BUILDING' THEN 'CONSTRUCTION' WHEN 'MACHINERY' THEN 'INDUSTRY' ELSE 'UNKNOWN' END AS sector_code, CASE WHEN NOT undated THEN y END AS year_start, CASE WHEN undated THEN NULL WHEN going THEN 2035 ELSE y + 1 END AS year_end, CASE WHEN undated THEN 'UNKNOWN' WHEN going THEN 'ONGOING' ELSE 'COMPLETED' END AS project_status,
      CASE o_orderpriority WHEN '1-URGENT' THEN 1.0 WHEN '2-HIGH' THEN 0.7 ELSE 0.2 END::DOUBLE AS evidence_strength, CASE c_mktsegment WHEN 'BUILDING' THEN 'BUILD' WHEN 'AUTOMOBILE' THEN 'CAR' ELSE '' END AS capabilities,
      count(*) OVER (PARTITION BY CASE WHEN doc THEN 'd' || o_custkey ELSE concat_ws('|', c_name, CASE WHEN NOT undated THEN y END, CASE WHEN undated THEN '' WHEN going THEN '2035' ELSE (y + 1)::VARCHAR END) END)::INTEGER AS duplicate_group_size,
      coalesce(has AND o_orderstatus <> 'P' AND c_acctbal > 0, false) AS base_shortlist_eligible, 'REF-' || lpad(n::VARCHAR, greatest(4, length(n::VARCHAR))::INTEGER, '0') AS display_reference_id, has, undated, o_orderstatus, o_orderkey FROM (SELECT *, row_number() OVER (ORDER BY o_custkey % 3, o_orderkey) AS n FROM r))"""


@query(f"WITH {CONTRACT_SQL} SELECT * EXCLUDE (has, undated, o_orderstatus, o_orderkey) FROM k")
def normalized_references(spark, sf):
    c = _normalized(spark, sf)
    return c.select("reference_id", "country_code", "region", "sector_code", F.col("year_start").cast("long").alias("year_start"), F.col("year_end").cast("long").alias("year_end"), "project_status", "evidence_strength", F.array_join("capability_tags", ",").alias("capabilities"), "duplicate_group_size", "base_shortlist_eligible", "display_reference_id")


@query(f"""WITH {CONTRACT_SQL} SELECT issue, severity, count(*) AS n FROM (SELECT unnest([CASE WHEN o_orderkey % 11 = 0 THEN 'INVALID_SOURCE_REFERENCE_NUMBER' END, CASE WHEN country_code = '' THEN 'UNMAPPED_COUNTRY' END, CASE WHEN undated THEN 'MISSING_PROJECT_YEAR' END, CASE WHEN o_orderstatus = 'P' THEN 'MISSING_SUPPORTING_EVIDENCE' END, CASE WHEN NOT has THEN 'MISSING_CANONICAL_DOCUMENT' END]) AS issue,
      CASE WHEN issue IN ('UNMAPPED_COUNTRY', 'MISSING_CANONICAL_DOCUMENT') THEN 'ERROR' ELSE 'WARNING' END AS severity FROM k) WHERE issue IS NOT NULL GROUP BY ALL""")
def reference_issues(spark, sf):
    return reference_contract.data_quality_issues(_normalized(spark, sf)).groupBy("issue", "severity").agg(F.count("*").alias("n"))


@query("SELECT doc_id AS candidate_id, quality::INTEGER AS relevance_1, toxic::INTEGER AS relevance_2, quality = toxic AS agreement FROM labels")
def labelled_pairs(spark, sf):
    rows = table(spark, sf, "labels").withColumn("query_id", F.lit(1)).withColumnRenamed("doc_id", "candidate_id")
    pairs = evaluation.labelled_pairs(rows.withColumn("relevance", F.col("quality").cast("int")), rows.withColumn("relevance", F.col("toxic").cast("int")))
    return pairs.drop("query_id")


@query("SELECT count(*) AS total, count(*) FILTER (quality = 1) AS \"1\", count(*) FILTER (quality = 0) AS \"0\" FROM labels")
def adjudication_counts(spark, sf):
    return evaluation.status_counts(table(spark, sf, "labels").withColumn("status", F.col("quality").cast("string")), "status", ["1", "0"])


@query(r"""SELECT doc_id, source || ' — page ' || (doc_id % 7 + 1) AS label, 'https://store/' || doc_id || '/view#page=' || (doc_id % 7 + 1) AS uri, concat_ws(' | ', 'Lang: ' || lang, 'Source: ' || source) AS line,
    CASE WHEN n_chars % 2 = 0 THEN (n_chars // 2)::VARCHAR ELSE (n_chars // 2)::VARCHAR || '.5' END AS half FROM documents""")
def citation_lines(spark, sf):
    page = F.col("doc_id") % 7 + 1
    facets = {"Lang": F.array_compact(F.array("lang")), "Source": F.array_compact(F.array("source"))}
    return table(spark, sf, "documents").select("doc_id", T.citation_label(F.col("source"), page).alias("label"), T.citation_uri(F.col("doc_id"), page, "https://store/{id}/view").alias("uri"), T.metadata_line(facets).alias("line"), T.clean_scalar(F.col("n_chars") / 2, "double").alias("half"))


@query("SELECT o_custkey, min(year(o_orderdate))::VARCHAR AS first, max(year(o_orderdate))::VARCHAR AS last FROM orders GROUP BY ALL")
def project_years(spark, sf):
    spans = table(spark, sf, "orders").groupBy("o_custkey").agg(F.concat(F.min("o_orderdate").cast("string"), F.lit(" puis "), F.max("o_orderdate").cast("string")).alias("t"))
    return spans.select("o_custkey", V.year_bounds(F.col("t"), "?").alias("y")).select("o_custkey", "y.first", "y.last")


@query(r"""WITH m AS (SELECT doc_id, length(text) AS c, len(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS w, (doc_id % 100)::DOUBLE AS conf FROM documents)
    SELECT doc_id, CASE WHEN c < 20 THEN 'FAILED:very_low_text_volume' WHEN c < 80 OR w < 10 THEN 'REVIEW:low_text_volume' WHEN conf < 45 THEN 'FAILED:very_low_ocr_confidence' WHEN conf < 70 THEN 'REVIEW:low_ocr_confidence' ELSE 'PASS:' END AS status, c >= 80 AND w >= 10 AS usable FROM m""")
def repair_states(spark, sf):
    m = T.text_metrics(F.col("text"))
    status, reason = corpus.repair_status(m["character_count"], m["word_count"], (F.col("doc_id") % 100).cast("double"))
    return table(spark, sf, "documents").select("doc_id", F.concat_ws(":", status, reason).alias("status"), corpus.usable_digital_text(F.col("text")).alias("usable"))


@query("""SELECT conv_id AS document_id, count(*) AS page_count, count(*) FILTER (length(text) >= 40) AS eligible_page_count, count(*) FILTER (length(text) >= 40) > 0 AS retrieval_eligible,
    CASE WHEN count(*) FILTER (length(text) >= 40) = 0 THEN 'NO_ELIGIBLE_PAGES' WHEN count(*) FILTER (length(text) < 40) > 0 THEN 'PARTIAL_PAGE_EXCLUSION' ELSE 'PASS' END AS data_quality_status, '["' || arg_min(role, turn) || '"]' AS client_values_json FROM conversations GROUP BY conv_id""")
def corpus_documents(spark, sf):
    p = _pages(spark, sf).withColumns({"retrieval_eligible": F.length("text") >= 40, "security_classification": F.lit("PUBLIC")})
    first = p.groupBy("document_id").agg(F.min_by("file_name", "page").alias("client"), F.min("page").alias("row_number"))
    refs = first.select(F.col("document_id").alias("canonical_document_id"), "row_number", F.col("document_id").cast("string").alias("reference_id"), "client")
    d = corpus.document_records(p, corpus.canonical_pages(p), corpus.reference_metadata(refs, ["client"]), ["client"])
    return d.select("document_id", "page_count", "eligible_page_count", "retrieval_eligible", "data_quality_status", "client_values_json")


@query()
def bootstrap_probes(spark, sf):
    p = table(spark, sf, "part")
    d = p.select(F.col("p_partkey").alias("id"), F.array("p_brand").alias("client"), F.array("p_type").alias("offering"), F.array(F.col("p_size").cast("string")).alias("sector"), F.array("p_name").alias("service_nature"), F.array("p_brand").alias("country"))
    found = search.probes(d, ["client", "offering", "sector", "service_nature", "country"])
    return found.select("query_id", "query_text", F.array_join(F.transform("relevant", lambda x: x.cast("string")), ",").alias("relevant"), "primary_id", "specificity", "relevant_count")


@query()
def portfolio_selection(spark, sf):
    c = _contract(spark, sf).withColumns({"offering_code": F.when(F.col("sector_code") == "BUILDING", "CYBERSECURITY").otherwise("OTHER"), "engagement_tags": F.array().cast("array<string>"), "subregion": F.col("region"), "evidence_type": F.lit("ATTESTATION_SCAN"), "final_score": F.col("evidence_strength")})
    rules = [{"code": "SEC", "level": "PORTFOLIO_COUNT", "minimum_count": 2, "required_capability": "SECURITY_PSSI_ISO27001", "signed_attestation_required": True, "year_start_inclusive": 1996}]
    return matching.select_portfolio(matching.annotate_capabilities(c), _grid(spark, sf), rules, 8)


@query(f"""WITH {DENSE_SQL}, a AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM x),
    b AS (SELECT q.vec_id AS query_id, v.vec_id AS id, row_number() OVER (PARTITION BY q.vec_id ORDER BY v.vec_id) AS rank FROM embeddings q JOIN embeddings v ON q.label = v.label AND q.vec_id % 20 = 0 AND v.vec_id <> q.vec_id),
    w AS (SELECT unnest([0.25, 0.5, 0.75])::DOUBLE AS weight), f AS (SELECT weight, query_id, id, round(sum(p), 12) AS score FROM (SELECT weight, query_id, id, weight / (60 + rank) AS p FROM a, w WHERE rank <= 20 UNION ALL SELECT weight, query_id, id, (1 - weight) / (60 + rank) FROM b, w WHERE rank <= 20) GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY weight, query_id ORDER BY score DESC, id) AS rank FROM f), l AS (SELECT q.vec_id AS query_id, v.vec_id AS id FROM embeddings q JOIN embeddings v ON q.label = v.label AND q.vec_id % 20 = 0 AND v.vec_id <> q.vec_id), n AS (SELECT query_id, count(*) AS rel FROM l GROUP BY ALL),
    h AS (SELECT weight, r.query_id, count(*) FILTER (l.id IS NOT NULL AND rank <= 10) AS h10 FROM r LEFT JOIN l ON l.query_id = r.query_id AND l.id = r.id GROUP BY ALL)
    SELECT weight, count(*) AS queries, round(avg(h10 / rel), 6) AS recall_at_10 FROM h JOIN n USING (query_id) GROUP BY weight""")
def fusion_sweep(spark, sf):
    m = search.fusion_sweep(_by_label(spark, sf, 20).select("query_id", "id", "rank"), _dense(spark, sf, 20).select("query_id", "id", "rank"), _grades(spark, sf), [0.25, 0.5, 0.75])
    flipped = m.withColumn("weight", 1 - F.col("weight"))  # the weight of the first ranking in the oracle
    return flipped.select("weight", "queries", F.round("recall_at_10", 6).alias("recall_at_10"))


@query(f"""WITH {METRICS_SQL} SELECT query_id, id, 'CAND-' || sha256('pool|' || query_id || '|' || id)[1:16] AS candidate_id, string_agg(DISTINCT mode, ',' ORDER BY mode) AS modes FROM k WHERE rank <= 10 GROUP BY query_id, id""")
def candidate_pool(spark, sf):
    p = search.candidate_pool(_rankings(spark, sf))
    return p.select("query_id", "id", "candidate_id", F.array_join("modes", ",").alias("modes"))


@query("""WITH a AS (SELECT DISTINCT c_custkey AS id, 1 AS a FROM customer), b AS (SELECT DISTINCT o_custkey AS id, 1 AS b FROM orders), j AS (SELECT a, b FROM a FULL JOIN b USING (id))
    SELECT count(a) AS left, count(b) AS right, count(*) FILTER (a = 1 AND b = 1) AS shared, count(*) AS "union", round(count(*) FILTER (a = 1 AND b = 1) / count(*), 6) AS jaccard FROM j""")
def id_overlap(spark, sf):
    a, b = table(spark, sf, "customer").select(F.col("c_custkey").alias("id")), table(spark, sf, "orders").select(F.col("o_custkey").alias("id"))
    return search.overlap(a, b, "id").withColumn("jaccard", F.round("jaccard", 6))


def _pages(spark, sf):
    c = table(spark, sf, "conversations")
    return c.select(F.col("conv_id").alias("document_id"), F.col("turn").alias("page"), F.sha2(F.col("conv_id").cast("string"), 256).alias("source_sha256"), "text", (F.length("text") >= 20).alias("retrieval_eligible"), F.col("role").alias("file_name"))


@query()
def canonical_documents(spark, sf):
    return corpus.document_catalogue(corpus.canonical_pages(_pages(spark, sf)))


@query()
def canonical_chunks(spark, sf):
    return corpus.chunk_table(corpus.canonical_pages(_pages(spark, sf))).drop("text")


def _attempts(spark, sf):
    """Events stand in for repair attempts of their user's page, in order; the first is the page as it was."""
    e = table(spark, sf, "events")
    status = F.when(F.col("event_type") == "purchase", "PASS").when(F.col("event_type") == "click", "REVIEW").otherwise("FAILED")
    order = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    return e.select("user_id", order.alias("attempt"), status.alias("status"), (F.col("event_id") % 1700).alias("words"), (F.col("event_id") % 6007).alias("chars"), F.round(F.pmod("value", F.lit(100.0)), 2).alias("confidence"))


ATTEMPTS_SQL = """a AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS attempt, CASE event_type WHEN 'purchase' THEN 'PASS' WHEN 'click' THEN 'REVIEW' ELSE 'FAILED' END AS status, event_id % 1700 AS words, event_id % 6007 AS chars, round(value % 100.0, 2) AS confidence FROM events)"""
RANK_SQL = "(CASE status WHEN 'PASS' THEN 3 WHEN 'REVIEW' THEN 2 ELSE 1 END, least(words, 1000), least(chars, 5000), round(confidence, 4), -attempt)"


@query(f"WITH {ATTEMPTS_SQL} SELECT user_id, arg_max(attempt, {RANK_SQL}) AS attempt FROM a GROUP BY user_id")
def best_repair(spark, sf):
    return corpus.best_attempt(_attempts(spark, sf), ["user_id"]).select("user_id", "attempt")


@query(f"""WITH RECURSIVE {ATTEMPTS_SQL}, r AS (SELECT * FROM a WHERE attempt = 0 UNION ALL SELECT a.* FROM r JOIN a ON a.user_id = r.user_id AND a.attempt = r.attempt + 1 WHERE NOT (r.attempt > 0 AND r.status = 'PASS' AND r.confidence >= 60))
    SELECT user_id, arg_max(attempt, {RANK_SQL}) AS attempt, count(*) - 1 AS attempts_made FROM r GROUP BY user_id""")
def repair_selection(spark, sf):
    """Attempts in order up to the first good one; the best of those."""
    return corpus.repaired_pages(_attempts(spark, sf), ["user_id"], 60.0).select("user_id", "attempt", "attempts_made")


@query("""SELECT o_custkey AS canonical_document_id, string_agg(v, ',' ORDER BY r) AS status, max(n) AS rows FROM (SELECT o_custkey, o_orderstatus AS v, min(o_orderkey) AS r, any_value(n) AS n FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) GROUP BY ALL) GROUP BY o_custkey""")
def reference_metadata(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("canonical_document_id"), F.col("o_orderkey").alias("row_number"), F.col("o_orderkey").cast("string").alias("reference_id"), F.col("o_orderstatus").alias("status"))
    m = corpus.reference_metadata(o, ["status"])
    return m.select("canonical_document_id", F.array_join("status", ",").alias("status"), F.size("reference_rows").cast("long").alias("rows"))


PACKET_RULES = [
    Rule("SHORT", "row", "length(text) < 60"),
    Rule("LANGUAGE", "row", "coalesce(lang, '') NOT IN ('en', 'fr', 'es')", "en, fr or es"),
    Rule("COUNT", "table", "count(*) <> 50", "exactly 50"),
    Rule("MINIMUM", "table", "count_if(lang = 'fr') < 5", "fr: 5"),
    Rule("MINIMUM", "table", "count_if(lang = 'xx') < 5", "xx: 5"),
    Rule("REPEATED", "folded", "text"),
    Rule("SOURCE_TAKEN", "unique", "concat(source, '|', n_chars)"),
]


@query(f"""WITH f AS (SELECT doc_id, trim({FORM_SQL.format(x='text')}) AS f, source || '|' || n_chars AS s FROM documents)
    SELECT 'SHORT' AS code, doc_id::VARCHAR AS key, '' AS detail FROM documents WHERE length(text) < 60 UNION ALL SELECT 'LANGUAGE', doc_id::VARCHAR, 'en, fr or es' FROM documents WHERE coalesce(lang, '') NOT IN ('en', 'fr', 'es')
    UNION ALL SELECT 'COUNT', NULL, 'exactly 50' FROM documents HAVING count(*) <> 50 UNION ALL SELECT 'MINIMUM', NULL, 'fr: 5' FROM documents HAVING count(*) FILTER (lang = 'fr') < 5 UNION ALL SELECT 'MINIMUM', NULL, 'xx: 5' FROM documents HAVING count(*) FILTER (lang = 'xx') < 5
    UNION ALL SELECT 'REPEATED', doc_id::VARCHAR, '' FROM f WHERE f <> '' AND f IN (SELECT f FROM f GROUP BY f HAVING count(*) > 1) UNION ALL SELECT 'SOURCE_TAKEN', doc_id::VARCHAR, '' FROM f WHERE s IN (SELECT s FROM f GROUP BY s HAVING count(*) > 1)""")
def packet_rules(spark, sf):
    """Documents stand in for the rows of a review packet."""
    return packets.issues(table(spark, sf, "documents"), "doc_id", PACKET_RULES)


@query("SELECT page_id, CASE WHEN length(html) > 5000 THEN 'SKIPPED:size' ELSE 'DOWNLOADED' END AS status FROM pages")
def route_status(spark, sf):
    return table(spark, sf, "pages").select("page_id", corpus.route_status(F.lit("text/html"), F.length("html"), ["text/html"], 5000).alias("status"))
