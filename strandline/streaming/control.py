"""Starting, waiting for and stopping queries."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def with_trigger(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """``None`` handles all data there is and ends; otherwise a batch per interval ("0 seconds": at once)."""
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait until a continuous query has taken in everything that has arrived so far."""
    query.processAllAvailable()
    return query


def stop_all(spark: SparkSession) -> int:
    """Stop every active query of the session; returns how many."""
    active = spark.streams.active
    for query in active:
        query.stop()
    for query in active:
        query.awaitTermination()
    return len(active)
