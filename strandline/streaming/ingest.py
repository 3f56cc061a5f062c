"""Incremental loads that replace a table or merge into it by key."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from strandline.operators.changelog import (  # noqa: F401  (clauses for callers that merge by themselves)
    GONE,
    first_per_key,
    live,
    marked,
    when_matched_update,
    when_not_matched_insert,
)
from strandline.operators.versioned import VersionedTable
from strandline.sources import read_hinted
from strandline.streaming.control import with_trigger
from strandline.streaming.medallion import raw_files
from strandline.streaming.publish import republish


def newest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the highest ``order`` for each key, reduced before the shuffle."""
    return first_per_key(rows, keys, order)


def newest_arrival(spark: SparkSession, landing: str) -> str | None:
    """The folder or file directly under ``landing`` with the highest leading number, then name; by a listing."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing).select("path")
    folder = re.sub(r"^[a-z0-9+.-]+:", "", landing).strip("/")  # listings have a scheme, whatever was given
    name = F.regexp_extract("path", rf"/{re.escape(folder)}/([^/]+)", 1)
    number = F.regexp_extract(name, r"^(\d+)", 1).try_cast("bigint")
    newest = listing.agg(F.max(F.struct(number.alias("number"), name.alias("name")))).first()[0]
    return newest and newest.name


def load_replacing(
    spark: SparkSession,
    landing: str,
    columns: Sequence[str],
    hints: dict[str, str],
    table: str,
    path: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Whenever files arrive, ``table`` becomes the newest arrival, whole.

    An arrival is a folder (or a file) of JSON lines directly under ``landing``, in the order of the
    numbers that the names begin with. The stream only tells that something is new; the rows come
    from the arrival itself. So batches may be limited, several arrivals may wait at once, and files
    that are added to an arrival later, or to an older one, never leave part of it or the older one in the table.
    """

    def replace(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        arrival = newest_arrival(session, landing)
        if arrival:
            republish(read_hinted(session, f"{landing.rstrip('/')}/{arrival}", columns, hints), table, path)

    writer = (
        raw_files(spark, landing, columns, hints)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(replace)
    )
    return with_trigger(writer, every).start()


def load_merging(
    stream: DataFrame,
    table: VersionedTable,
    order: Sequence[str],
    checkpoint: str,
    name: str,
    every: str | None = None,
    fold_share: float = 0.5,
    deletes: Column | str | None = None,
) -> StreamingQuery:
    """Upsert each micro-batch by the table's keys; a row replaces one that is not newer.

    ``name`` identifies the stream: a batch that was committed under it is not applied
    again. Once the changes since the base take up ``fold_share`` of its bytes, the table gets a
    new base, so reads stay cheap and rewriting costs no more than in proportion to the changes.

    Rows that meet ``deletes`` delete their key. Their tombstones stay in the table, which needs a boolean
    column ``_gone`` (``with_tombstones``), so an older row that arrives later does not bring its key
    back, whichever batch it comes in. Read such a table through ``live``; ``forget`` drops old tombstones.

    A batch is parsed once: the newest row of each key is written down, and the merge reads these. Rows with
    a NULL in a key, such as one that did not fit its type, cannot be merged: they are set apart, each of
    them, and do not stop the load (``rejected_rows``).
    """
    keys = table.snapshot().keys

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        staged = f"{table.path}/staged/slot={batch_id % 2}"
        keyless = reduce(Column.__or__, (F.col(k).isNull() for k in keys))
        feed = batch if deletes is None else marked(batch, deletes, keys, order)
        # A row without a key is a group of its own, so one pass over the batch serves both kinds.
        told = feed.withColumns({_KEYLESS: keyless, _LONE: F.when(keyless, F.monotonically_increasing_id())})
        newest = first_per_key(told, [*keys, _LONE], order).drop(_LONE)
        met = Observation()
        newest.observe(met, F.count_if(_KEYLESS).alias("keyless")).write.mode("overwrite").partitionBy(_KEYLESS).parquet(staged)
        both = spark.read.schema(newest.schema).parquet(staged)
        if met.get["keyless"]:
            bad = both.where(_KEYLESS).drop(_KEYLESS, GONE)
            bad.write.mode("overwrite").parquet(f"{_rejected(table, name)}/batch={batch_id}")
        target = VersionedTable(spark, table.path)
        target.overtake(both.where(f"NOT {_KEYLESS}").drop(_KEYLESS), order, stream=name, batch=batch_id)
        target.fold_if_changed(fold_share)

    writer = (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(apply)
    )
    return with_trigger(writer, every).start()


_KEYLESS, _LONE = "_keyless", "_lone"


def with_tombstones(rows: DataFrame) -> DataFrame:
    """Rows for the first load of a table whose merge load deletes."""
    return rows.withColumn(GONE, F.lit(False))


def forget(table: VersionedTable, old: Column | str) -> int:
    """Drop the tombstones that meet a condition, such as a time before which nothing is expected any more.

    A row older than a forgotten tombstone would bring its key back, so the condition should be as
    wide as the latest arrival is late.
    """
    return table.delete(F.col(GONE) & (F.expr(old) if isinstance(old, str) else old))


def _rejected(table: VersionedTable, name: str) -> str:
    return f"{table.path}/rejected/stream={quote(name, safe='')}"


def rejected_rows(table: VersionedTable, name: str, schema: StructType) -> DataFrame:
    """Rows that ``load_merging`` set apart under this name, with their batch."""
    folder = _rejected(table, name)
    kind = StructType([*schema.fields, StructField("batch", LongType())])
    try:
        return table.spark.read.schema(kind).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return table.spark.createDataFrame([], kind)
