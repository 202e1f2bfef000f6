"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of ``documents``, and
any others that the table has. Empty tables go through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marlstone.llm.common import discard, materialise
from marlstone.llm.exact_dedup import drop_copies
from marlstone.llm.jaccard_join import keep_one_of_each
from marlstone.llm.packing import pack
from marlstone.llm.quality_classifier import keep_good
from marlstone.llm.source_mix import repeat_mixed
from marlstone.llm.vocabularies import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Repeated rows are each judged; null and empty texts get the score of the bias alone. Ids, null
    ones too, and all columns pass through unchanged.
    """
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays.

    Null is empty text; a null doc_id comes after all others; of rows that repeat a doc_id and a
    text one stays.
    """
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked texts the document with the smallest doc_id stays.

    Texts without a word and rows with a null doc_id all stay; rows of one doc_id are told apart by
    their texts.
    """
    return keep_one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it: not at all, once or twice.

    Texts without a word stay once; null sources are a source of their own; repeated rows are
    documents of their own.
    """
    return repeat_mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text is empty text, of one token; repeated rows and null ids are packed like any others.
    """
    return pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality),
    ("exact_dedup", copies),
    ("jaccard_join", near_copies),
    ("source_mix", mix),
    ("best_fit_packing", packed),
]
#: A learned classifier and a tokenizer decide about rows: SQL can't express run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stored = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if stored is not None:
            discard(stored)  # the input of the stage that has just been stored
        stored = docs
    return STAGES[-1][1](spark, docs, sf_dir)
