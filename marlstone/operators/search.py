"""Search and matching engines composed of the retrieval operators, over batches of queries."""

from __future__ import annotations

import hashlib
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.analysis import fold_array, folded_form
from ..functions.text import excerpt, fold_search, query_terms, term_coverage
from ..sources.scratch import scratch
from . import evaluation, filters, matching, retrieval
from .contracts import EngineError
from .lexical_index import Bm25Index, Scope

MODES = ("bm25", "dense", "hybrid")


class Encoder(Protocol):
    """Turns texts into unit vectors; prefixes tell passages from queries."""

    dimensions: int

    def encode(self, texts: list[str], kind: str) -> np.ndarray: ...


class HashEncoder:
    """Signed feature hashing of words: deterministic and without a model, for tests and offline use."""

    def __init__(self, dimensions: int = 64):
        self.dimensions = dimensions

    def encode(self, texts: list[str], kind: str) -> np.ndarray:
        out = np.zeros((len(texts), self.dimensions))
        for i, t in enumerate(texts):
            for w in (t or "").lower().split():
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                out[i, h % self.dimensions] += 1 if h >> 63 else -1
            out[i, 0] += 1e-6
        return (out / np.linalg.norm(out, axis=1, keepdims=True)).astype(np.float32)


def encoded(df: DataFrame, text: str, encoder: Encoder, kind: str = "passage", name: str = "embedding") -> DataFrame:
    @F.pandas_udf("array<float>")
    def encode(texts: pd.Series) -> pd.Series:
        return pd.Series(list(encoder.encode(texts.fillna("").tolist(), kind)))

    return df.withColumn(name, encode(F.col(text)))


def passage_index(chunks: DataFrame, path: str | None = None, text: str = "text", facets: tuple[str, ...] = (), **bm25) -> Bm25Index:
    """A stored index of chunks (id, ``text``, document_id, security_classification and ``facets``) that ``search_chunks`` can read.

    ``text`` names what is searched: the retrieval text, where the chunks have one.
    """
    named = list(dict.fromkeys(["security_classification", "document_id", *facets]))
    docs = chunks.select("id", F.col(text).alias("text"), *named)
    return Bm25Index.build(docs, path or scratch(chunks.sparkSession, "passages"), named, **bm25)


def passages(index: Bm25Index, queries: DataFrame, allowed: list[str], limit: int, scope: Scope | None = None, documents: DataFrame | None = None, positive_only: bool = False) -> DataFrame:
    """The lexical side of ``search_chunks``: query_id, id, score, rank."""
    kind = queries.schema["id"].dataType
    within = Scope.security(queries.sparkSession, "security_classification", allowed, kind).also(scope)
    if documents is not None:
        within = within.values("document_id", documents.select("document_id"))
    return index.top(queries.select("id", "text"), limit, within, positive_only=positive_only)


def search_chunks(chunks: DataFrame, queries: DataFrame, allowed: list[str], mode: str = "hybrid", limit: int = 10, scope: Scope | None = None, pool: int = 100, weights: tuple[float, float] = (0.5, 0.5), k: int = 60, documents: DataFrame | None = None, index: Bm25Index | None = None) -> DataFrame:
    """(query_id, id, score, rank, lexical_score, lexical_rank, dense_score, dense_rank) over ``chunks``: id, document_id, embedding, security_classification.

    ``queries``: id, text, query_vector. Authorization, ``scope`` (what each query may find, or
    all) and ``documents`` (document_id: those that may be found) hold before ranking; term
    statistics are those of all chunks. ``index``: the stored one of all chunks (``passage_index``
    with the facets that the scope names); without it, one is made of their ``text``. In hybrid
    mode each retriever gives max(``pool``, ``limit``) chunks, whose scores and ranks come along.
    ``limit`` 0 means the default of 10.
    """
    if mode not in MODES:
        raise EngineError(f"unknown mode {mode}")
    limit = limit or 10
    pool = max(pool, limit) if mode == "hybrid" else limit
    may = retrieval.authorized(chunks, "security_classification", allowed)
    lexical = dense = None
    if mode != "dense":
        if index is None:
            index = passage_index(chunks, facets=tuple(sorted((scope.facets or set()) - {"document_id", "security_classification"})) if scope else ())
        lexical = passages(index, queries, allowed, pool, scope, documents)
    if mode != "bm25":
        if documents is not None:
            may = may.join(documents.select("document_id").distinct(), "document_id", "left_semi")
        asked = queries.select(F.col("id").alias("query_id"), "query_vector")
        dense = retrieval.top_ranked(retrieval.dense_top(may, asked, pool, scope), pool)
    none = F.lit(None)
    empty = {"lexical_score": none.cast("double"), "lexical_rank": none.cast("int"), "dense_score": none.cast("double"), "dense_rank": none.cast("int")}
    parts = []
    for name, found in (("lexical", lexical), ("dense", dense)):
        if found is not None:
            own = empty | {f"{name}_score": F.col("score"), f"{name}_rank": F.col("rank")}
            parts.append(found.select("query_id", "id", *[c.alias(n) for n, c in own.items()]))
    if mode != "hybrid":
        (one,) = parts
        side = "lexical" if mode == "bm25" else "dense"
        return one.select("query_id", "id", F.col(f"{side}_score").alias("score"), F.col(f"{side}_rank").alias("rank"), *empty)
    both = parts[0].unionByName(parts[1]).groupBy("query_id", "id").agg(*[F.max(c).alias(c) for c in empty])
    share = [F.coalesce(F.lit(w) / (k + F.col(c)), F.lit(0.0)) for w, c in zip(weights, ("lexical_rank", "dense_rank"), strict=True)]
    return retrieval.top_ranked(both.withColumn("score", share[0] + share[1]), limit).select("query_id", "id", "score", "rank", *empty)


def hit_audit(hits: DataFrame, chunks: DataFrame, allowed: list[str], scope: Scope | None = None) -> DataFrame:
    """(query_id, scored, authorized, in_scope) of every query that came back: chunks, those of an allowed class, and those that its requests let through.

    Classes and values are looked up in ``chunks`` again, not taken from the search.
    """
    facets = sorted(set(scope.facets or ())) if scope else []
    held = hits.select("query_id", "id").join(chunks.select("id", "security_classification", *[F.col(f).alias(f"_{f}") for f in facets]), "id", "left")
    classes = sorted({c.strip().upper() for c in allowed if c and c.strip()})
    met = F.lit(True)
    if scope:
        wanted = scope.requests.groupBy("query_id", "facet").agg(F.collect_set(F.struct("operator", "value")).alias("wanted"))  # a request's values
        for f in facets:
            mine = wanted.where(F.col("facet") == f)
            general = mine.where("query_id IS NULL").select(F.col("wanted").alias(f"_all_{f}"))
            own = mine.where("query_id IS NOT NULL").select("query_id", F.col("wanted").alias(f"_own_{f}"))
            held = held.join(own, "query_id", "left").join(F.broadcast(general), how="left")
            column = F.col(f"_{f}") if isinstance(chunks.schema[f].dataType, T.ArrayType) else F.array(f"_{f}")
            forms = F.transform(column.cast("array<string>"), lambda v: F.coalesce(v, F.lit("")))
            held = held.withColumn(f"_{f}", fold_array(forms))
            for kind in ("all", "own"):
                met = met & meets(f"_{f}", f"_{kind}_{f}")
    return held.groupBy("query_id").agg(
        F.count("*").alias("scored"), F.count_if(F.coalesce(F.upper("security_classification").isin(classes), F.lit(False))).alias("authorized"), F.count_if(F.coalesce(met, F.lit(False))).alias("in_scope")
    )


def meets(values: str, wanted: str) -> Column:
    """Whether one of the folded ``values`` meets one of the requests ``wanted``; true without requests."""
    is_ = F.exists(wanted, lambda w: (w["operator"] == "is") & F.array_contains(F.col(values), w["value"]))
    number = lambda v: F.when(v.rlike("^[0-9]{1,9}$"), v).cast("int")
    low = F.exists(wanted, lambda w: (w["operator"] == "at_most") & F.exists(values, lambda v: number(v) <= number(w["value"])))
    high = F.exists(wanted, lambda w: (w["operator"] == "at_least") & F.exists(values, lambda v: number(v) >= number(w["value"])))
    return F.col(wanted).isNull() | F.coalesce(is_, F.lit(False)) | F.coalesce(low, F.lit(False)) | F.coalesce(high, F.lit(False))


def search_documents(chunks: DataFrame, queries: DataFrame, allowed: list[str], limit: int = 10, **options) -> DataFrame:
    """Documents by their best chunk, out of a pool of max(100, 5 x limit) chunks, with three evidence chunks."""
    found = search_chunks(chunks, queries, allowed, limit=max(100, 5 * limit), **options)
    return retrieval.roll_up(found.join(chunks.select("id", "document_id"), "id"), limit)


def match(chunks: DataFrame, requirements: DataFrame, references: DataFrame, allowed: list[str], score_share: float = 0.8, limit: int = 100, **options) -> DataFrame:
    """Evidence rows of all requirements in one plan: reference_id, requirement_id, chunk_id, scores, ranks.

    ``requirements``: id, text, query_vector. ``references``: reference_id, document_id, those
    eligible. Of each requirement the ``limit`` best chunks of their documents are candidates.
    These fan out to the references of their document, are reranked by scaled score and term
    coverage, and three stay for each (reference, requirement), with the score and rank that each
    retriever gave. Term coverage compares folded words without stop words; only texts of
    candidates are folded.
    """
    found = search_chunks(chunks, requirements, allowed, limit=limit, documents=references, **options)
    found = found.withColumn("top_score", F.max("score").over(Window.partitionBy("query_id")))  # over ``limit`` rows, as they were ranked
    texts = chunks.select("id", "document_id", "text").join(found.select("id").distinct(), "id", "left_semi")
    texts = texts.select("id", "document_id", query_terms(F.col("text")).alias("have"))
    asked = requirements.select(F.col("id").alias("query_id"), query_terms(F.col("text")).alias("want"))
    rows = found.join(texts, "id").join(asked, "query_id")
    rows = rows.withColumn("term_coverage", term_coverage(F.col("want"), F.col("have"))).drop("want", "have").join(references, "document_id")
    ev = rows.select("reference_id", F.col("query_id").alias("requirement_id"), F.col("id").alias("chunk_id"), "score", F.col("rank").alias("retrieval_rank"), "term_coverage", "top_score", "lexical_score", "lexical_rank", "dense_score", "dense_rank")
    return matching.keep_evidence(matching.rerank(ev, score_share))


def match_contract(chunks: DataFrame, requirements: DataFrame, contract: DataFrame, allowed: list[str], hard: dict | None = None, exclusions: list[dict] | None = None, vocabulary: filters.ContractVocabulary | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """(evidence, audit): ``match`` over the references that pass the contract's own filters first.

    ``contract``: reference_id, document_id and the fields of a reference contract.
    """
    eligible, audit = filters.filter_contract(contract, allowed, hard or {}, exclusions or [], vocabulary)
    return match(chunks, requirements, eligible.select("reference_id", "document_id"), allowed, **options), audit


def fusion_sweep(lexical: DataFrame, dense: DataFrame, grades: DataFrame | evaluation.SameClass, weights: list[float], k: int = 60) -> DataFrame:
    """Mean metrics of the fused ranking for each lexical weight; both rankings are read once."""
    both = lexical.select("query_id", "id", F.lit(True).alias("lex"), "rank").unionByName(dense.select("query_id", "id", F.lit(False).alias("lex"), "rank"))
    each = both.withColumn("weight", F.explode(F.array(*[F.lit(float(w)) for w in weights])))
    score = F.round(F.sum(F.when(F.col("lex"), F.col("weight")).otherwise(1 - F.col("weight")) / (k + F.col("rank"))), 12)
    fused = each.groupBy("weight", "query_id", "id").agg(score.alias("score"))
    ranked = fused.withColumn("rank", F.row_number().over(Window.partitionBy("weight", "query_id").orderBy(F.desc("score"), "id")))
    return evaluation.system_means(evaluation.ranking_metrics(ranked, grades, ["weight", "query_id"]), "weight")


def candidate_pool(rankings: DataFrame, depth: int = 10, seed: str = "pool") -> DataFrame:
    """Distinct (query_id, id) of the top ``depth`` of every mode, with a blinded id and order."""
    pooled = rankings.where(F.col("rank") <= depth).groupBy("query_id", "id").agg(F.array_sort(F.collect_set("mode")).alias("modes"))
    key = F.sha2(F.concat_ws("|", F.lit(seed), F.col("query_id").cast("string"), F.col("id").cast("string")), 256)
    named = pooled.withColumn("candidate_id", F.concat(F.lit("CAND-"), F.substring(key, 1, 16)))
    return named.withColumn("position", F.row_number().over(Window.partitionBy("query_id").orderBy(key)))


def judging_packet(rankings: DataFrame, chunks: DataFrame, queries: DataFrame, depth: int = 10, seed: str = "pool", most_chars: int = 1200) -> DataFrame:
    """The candidate pool as labelers see it: the best chunk of each candidate and what the query asks, in a blinded order.

    ``rankings``: mode, query_id, id (document), rank, score, best_id. ``chunks``: id, text. ``queries``:
    query_id and its attributes. Neither mode nor rank is shown.
    """
    best = rankings.groupBy("query_id", "id").agg(F.min_by("best_id", F.struct("rank", "mode")).alias("best_id"))
    pool = candidate_pool(rankings, depth, seed).select("query_id", "id", "candidate_id", "position").join(best, ["query_id", "id"])
    texts = chunks.select(F.col("id").alias("best_id"), excerpt(F.col("text"), most_chars).alias("excerpt"))
    return pool.join(texts, "best_id").join(queries, "query_id").withColumns({"relevance": F.lit(None).cast("int"), "notes": F.lit("")})


def select_system(means: DataFrame, least_recall: float) -> DataFrame:
    """The best system at or above a recall, by nDCG, MRR, then name; one row or none."""
    return means.where(F.col("recall_at_10") >= least_recall).orderBy(F.desc("ndcg_at_10"), F.desc("mrr"), "mode").limit(1)


#: Fixed value: the facets that a probe names, the most specific first.
PROBE_TEMPLATES = (("client", "offering", "sector"), ("client", "service_nature", "country"), ("offering", "sector", "country"), ("client", "country"), ("service_nature", "country"))
#: Fixed value: facet values that say nothing.
EMPTY_ANSWERS = ("oui", "non", "na", "n a")


def probes(documents: DataFrame, facets: list[str], most: int = 50, templates: tuple[tuple[str, ...], ...] = PROBE_TEMPLATES, most_relevant: int = 12, prefix: str = "expérience et référence ", seed: str = "0") -> DataFrame:
    """Evaluation probes: query_id, query_text, terms, relevant (document ids), filter, primary_id, specificity.

    ``documents``: id and the array columns ``facets``. Each document proposes, for each template,
    the first value of its facets; proposals of at least two values count whose values all occur
    together in 1 to ``most_relevant`` documents. Of proposals with one and the same text the last
    document by id counts. Probes with few relevant documents and many facets come first, then by
    a seeded hash; each document gives one before any gives a second.
    """
    values = {f: F.coalesce(F.col(f), F.array().cast("array<string>")) for f in facets}

    def named(f: str) -> Column:
        return F.transform(values[f], lambda v: F.struct(F.lit(f).alias("facet"), v.alias("value")))

    pairs = F.flatten(F.array(*map(named, facets)))
    each = documents.select("id", F.explode(pairs).alias("p")).select("id", "p.facet", fold_search(F.col("p.value")).alias("term")).distinct()

    def proposal(names: tuple[str, ...]) -> Column:
        firsts = [F.when(F.size(values[f]) > 0, F.struct(F.lit(f).alias("facet"), F.trim(F.substring(F.get(values[f], 0), 1, 160)).alias("value"))) for f in names if f in facets]
        return F.array_compact(F.array(*firsts)) if firsts else F.array().cast("array<struct<facet:string,value:string>>")

    proposed = documents.select(F.col("id").alias("primary_id"), F.posexplode(F.array(*map(proposal, templates))).alias("template", "picked"))
    proposed = proposed.groupBy("template", "picked").agg(F.max("primary_id").alias("primary_id")).withColumn("proposal", F.struct("template", "picked"))  # the same values give the same text
    flat = proposed.select("primary_id", "proposal", F.posexplode("picked").alias("place", "x")).select("primary_id", "proposal", "place", "x.facet", "x.value").withColumn("term", fold_search(F.col("value")))
    flat = flat.where(~F.trim("term").isin(*EMPTY_ANSWERS))
    parts = F.sort_array(F.collect_list(F.struct("place", "facet", "value", "term")))
    rows = flat.groupBy("primary_id", "proposal").agg(parts.alias("parts")).where(F.size("parts") >= 2).withColumn("template", F.col("proposal.template"))
    text = F.concat(F.lit(prefix), F.array_join(F.transform("parts", lambda p: p["value"]), " "))
    last = F.element_at("parts", -1)
    rows = rows.select("primary_id", "template", "parts", text.alias("query_text"), F.struct(last["facet"].alias("facet"), last["value"].alias("value")).alias("filter"))
    rows = rows.withColumn("query_key", fold_search(F.col("query_text")))
    latest = F.max_by(F.struct("primary_id", "parts", "query_text", "filter"), F.struct("primary_id", "template", "query_text"))
    asked = rows.groupBy("query_key").agg(latest.alias("r")).select("query_key", "r.*")
    asked = asked.withColumn("wants", F.array_sort(F.array_distinct(F.transform("parts", lambda p: F.struct(p["facet"].alias("facet"), p["term"].alias("term"))))))
    # each document makes the combinations of its own terms that have the facets of a probe, so what a term's documents share with a term's probes is never made
    terms = asked.select(F.inline("wants")).distinct()
    held = each.join(terms, ["facet", "term"], "left_semi").groupBy("id").agg(F.collect_set(F.struct("facet", "term")).alias("terms"))  # a document's own values
    shapes = asked.select(F.transform("wants", lambda w: w["facet"]).alias("shape")).distinct()  # no more than the parts of the templates
    made = held.join(F.broadcast(shapes)).withColumn("wants", F.array().cast(asked.schema["wants"].dataType))
    for i in range(max(map(len, templates), default=0)):
        mine = F.transform(F.filter("terms", lambda t: t["facet"] == F.get("shape", i)), lambda t: F.concat("wants", F.array(t)))  # noqa: B023
        made = made.withColumn("wants", F.explode(F.when(F.size("shape") > i, mine).otherwise(F.array("wants"))))
    counted = made.groupBy("wants").agg(F.count("*").alias("relevant_count")).where(F.col("relevant_count") <= most_relevant)
    few = counted.join(asked.select("wants").distinct(), "wants")
    relevant = made.join(few, "wants").groupBy("wants", "relevant_count").agg(F.sort_array(F.collect_list("id")).alias("relevant"))  # most_relevant ids
    scored = asked.join(relevant, "wants").withColumns({"specificity": F.size("parts"), "order_hash": F.sha2(F.concat(F.lit(f"{seed}|"), "query_text"), 256)})
    order = [F.col("relevant_count"), F.desc("specificity"), F.col("order_hash")]
    place = F.row_number().over(Window.partitionBy("primary_id").orderBy(*order))
    best = scored.withColumn("again", (place > 1).cast("int")).orderBy("again", *order).limit(most)
    query_id = F.concat(F.lit("BOOT-"), F.lpad(F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("again", *order)).cast("string"), 3, "0"), F.lit("-"), F.substring(F.sha2("query_text", 256), 1, 8))
    return best.select(query_id.alias("query_id"), "query_text", F.transform("parts", lambda p: p["value"]).alias("terms"), "relevant", "filter", "primary_id", "specificity", "relevant_count")  # most rows


def evaluate_bootstrap(chunks: DataFrame, asked: DataFrame, allowed: list[str], filtered_by: str | None = None, citation: str | None = None, index: Bm25Index | None = None, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(metrics by mode, hits, checks) of probes over document search in every mode.

    ``asked``: id, text, query_vector, relevant (document ids), and where ``filtered_by`` names it
    a struct of facet and value: each probe's own filter. ``hits``: mode, query_id, id, rank, score,
    best_id, cited (its best chunk has a ``citation``). ``checks``: one row of filter_correctness, the
    share of probes whose own filter gives chunks and only such that pass it, and citation_coverage.
    All probes are searched in one plan per mode, and one more with their filters.
    """
    spark = asked.sparkSession
    if index is None:
        facets = [r[0] for r in asked.select(F.col(filtered_by)["facet"]).distinct().collect()] if filtered_by else []  # the facets that probes know
        index = passage_index(chunks, facets=tuple(sorted(f for f in facets if f)))
    hits = None
    for mode in MODES:
        found = search_documents(chunks, asked, allowed, mode=mode, index=index, **options)
        part = found.select(F.lit(mode).alias("mode"), "query_id", F.col("document_id").alias("id"), "rank", "score", "best_id")
        hits = part if hits is None else hits.unionByName(part)
    uri = F.coalesce(F.col(citation), F.lit("")) != "" if citation else F.lit(None).cast("boolean")
    hits = hits.join(chunks.select(F.col("id").alias("best_id"), uri.alias("cited")), "best_id", "left").select("mode", "query_id", "id", "rank", "score", "best_id", "cited")
    grades = asked.select(F.col("id").alias("query_id"), F.explode("relevant").alias("id"), F.lit(1).alias("grade"))
    every = asked.select(F.col("id").alias("query_id"), F.explode(F.array(*map(F.lit, MODES))).alias("mode"))
    metrics = evaluation.system_means(evaluation.ranking_metrics(hits, grades, asked=every))
    checks = spark.range(1).select(F.lit(None).cast("double").alias("filter_correctness"))
    if filtered_by:
        own = asked.select(F.col("id").alias("query_id"), F.col(filtered_by)["facet"].alias("facet"), F.lit("is").alias("operator"), folded_form(F.col(filtered_by)["value"]).alias("value")).where("value <> ''")
        known = {r[0] for r in own.select("facet").distinct().collect()}
        scope = Scope(own, known)
        found = search_chunks(chunks, asked, allowed, index=index, scope=scope, **options)
        audit = asked.select(F.col("id").alias("query_id")).join(hit_audit(found, chunks, allowed, scope), "query_id", "left")
        right = F.coalesce((F.col("scored") > 0) & (F.col("scored") == F.col("authorized")) & (F.col("scored") == F.col("in_scope")), F.lit(False))
        checks = audit.agg(F.avg(right.cast("int")).alias("filter_correctness"))
    covered = hits.agg(F.avg(F.col("cited").cast("int")).alias("citation_coverage"))
    return metrics, hits, checks.join(F.broadcast(covered))


def citation_metrics(evidence: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row: completeness (fields present), integrity (hash of the text agrees) and mean term coverage."""
    held = evidence.join(chunks.select(F.col("id").alias("chunk_id"), "text", "text_sha256", "citation_uri"), "chunk_id", "left")
    complete = F.col("citation_uri").isNotNull() & (F.col("citation_uri") != "")
    return held.agg(F.count("*").alias("citation_rows"), F.avg(complete.cast("int")).alias("completeness"), F.avg(F.coalesce(F.sha2("text", 256) == F.col("text_sha256"), F.lit(False)).cast("int")).alias("integrity"), F.avg("term_coverage").alias("support"))


def overlap(a: DataFrame, b: DataFrame, item: str) -> DataFrame:
    """One row: sizes, shared items and Jaccard similarity of two id sets."""
    x = a.select(item).distinct().withColumn("a", F.lit(1))
    y = b.select(item).distinct().withColumn("b", F.lit(1))
    both = x.join(y, item, "full")
    return both.agg(F.count("a").alias("left"), F.count("b").alias("right"), F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("shared"), F.count("*").alias("union")).withColumn("jaccard", F.col("shared") / F.col("union"))


def dossier_records(recommended: DataFrame, evidence: DataFrame, coverage: DataFrame, text: Column, title: Column, quota: int = 3, least: float = 0.15, **grounding) -> DataFrame:
    """One record of each recommendation: its columns, its best grounded evidence and the requirements it covers.

    ``coverage``: reference_id, requirement_id, classification, covered. A recommendation without
    evidence has an empty list.
    """
    rows = dossier(recommended, evidence, text, title, least=least, **grounding).where(F.col("place") <= quota)
    shown = rows.groupBy("reference_id").agg(F.sort_array(F.collect_list(F.struct("place", "chunk_id", "grounding", "weak"))).alias("evidence"))
    met = coverage.where("covered").groupBy("reference_id").agg(F.sort_array(F.collect_set(F.struct((F.col("classification") != "MUST").alias("optional"), "requirement_id"))).alias("requirements"))
    out = recommended.join(shown, "reference_id", "left").join(met, "reference_id", "left")
    return out.withColumns({"evidence": F.coalesce("evidence", F.array().cast(shown.schema["evidence"].dataType)), "requirements": F.coalesce(F.transform("requirements", lambda r: r["requirement_id"]), F.array().cast("array<string>"))})


def dossier(recommended: DataFrame, evidence: DataFrame, text: Column, title: Column, context: Column | None = None, relevance: Column | None = None, uri: Column | None = None, least: float = 0.15) -> DataFrame:
    """Evidence of each recommendation that is grounded in it; the best one, flagged, where none is.

    Grounding is the larger of the excerpt's overlap with ``context`` (what is known of the
    reference; the title where there is none) and 0.65 of its overlap with the title plus 0.35 of
    that. Equal ones go by falling ``relevance``, then ``uri``, then chunk id; a chunk cited twice under one
    uri counts once.
    """
    from ..functions.text import grounding_score

    rows = recommended.join(evidence, "reference_id")
    known = grounding_score(title if context is None else context, text)
    rows = rows.withColumns({"_known": known, "_titled": grounding_score(title, text), "_relevance": F.lit(0.0) if relevance is None else relevance, "_uri": F.lit("") if uri is None else uri})
    rows = rows.withColumn("grounding", F.greatest("_known", F.lit(0.65) * F.col("_titled") + F.lit(0.35) * F.col("_known")))
    order = [F.desc("grounding"), F.desc("_relevance"), F.col("_uri"), F.col("chunk_id")]
    once = Window.partitionBy("reference_id", "chunk_id", "_uri").orderBy(*order)
    rows = rows.withColumn("_again", F.row_number().over(once)).where("_again = 1")
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("reference_id").orderBy(*order)))
    kept = rows.where((F.col("grounding") >= least) | (F.col("place") == 1))
    return kept.withColumn("weak", F.col("grounding") < least).drop("_known", "_titled", "_relevance", "_uri", "_again")
