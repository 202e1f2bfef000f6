"""Incremental ingest with Structured Streaming: an extension to the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.sinks import append_missing


def ingest(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], keys: list[str]) -> StreamingQuery:
    """Each micro-batch of new files runs through the batch ``transform`` and appends rows not yet there.

    Appending is idempotent on ``keys``, so a batch that is replayed after a failure adds nothing.
    """
    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(lambda df, _: append_missing(transform(df), target, keys) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
