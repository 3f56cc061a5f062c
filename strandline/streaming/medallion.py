"""Raw files to bronze, bronze with a lookup to silver, silver to daily means in gold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType, StructType, _parse_datatype_string

from strandline.functions import apply_hints, day_of, epoch_to_timestamp
from strandline.operators.changelog import when_matched_update, when_not_matched_insert
from strandline.operators.versioned import VersionedTable
from strandline.session import settings
from strandline.sources import hinted_schema
from strandline.streaming.control import with_trigger
from strandline.streaming.publish import complete_publisher

# One micro-batch takes in at most this much, so that a lost batch is cheap to repeat.
BATCH_BYTES = 1 << 40

# Spark forgets files after a week by default, and with them passes over late ones.
FOREVER = "36500d"

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def raw_files(
    spark: SparkSession,
    landing: str,
    columns: Sequence[str],
    hints: dict[str, str],
    fmt: str = "json",
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = BATCH_BYTES,
    rest: str | None = None,
    typed: bool = False,
) -> DataFrame:
    """New files of a landing folder as a stream; columns are strings unless hinted.

    Without either limit a run-once query takes in all that has arrived as one batch. Files are known
    by name, for good: one is taken in once, and whenever it arrives, whatever time it bears.
    With ``rest`` (JSON only) a column of that name holds each record's other fields as JSON text, or with
    ``typed`` as a VARIANT, whose values keep their types (``found_fields``, ``with_fields``).
    """
    reader = (
        spark.readStream.format("text" if rest else fmt)
        .option("recursiveFileLookup", True)
        .option("maxFileAge", FOREVER)
    )
    if not rest:
        reader = reader.schema(hinted_schema(columns))
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    elif bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    stream = reader.load(landing).select("*", F.col("_metadata.file_path").alias("source_file"))
    if rest:
        if fmt != "json":
            raise ValueError("only JSON records can have fields that are not listed")
        stream = with_rest(stream, columns, rest, typed)
    return apply_hints(stream, hints)


def with_rest(lines: DataFrame, columns: Sequence[str], rest: str, typed: bool = False) -> DataFrame:
    """Records of JSON lines (``value``): the listed fields as text, all others as one JSON object or VARIANT."""
    listed = F.from_json("value", hinted_schema(columns))
    fields = F.from_json("value", "map<string,variant>" if typed else "map<string,string>")
    others = F.map_filter(fields, lambda name, _: ~name.isin(*columns))
    whole = F.to_variant_object(others) if typed else F.to_json(others)
    parsed = lines.where(F.trim("value") != "").select(
        listed.alias("_listed"), F.when(F.size(others) > 0, whole).alias(rest), "source_file"
    )
    return parsed.select("_listed.*", rest, "source_file")


def found_fields(rows: DataFrame, rest: str) -> dict[str, str]:
    """The fields met in a VARIANT column, each with the type that holds all its values; one pass, reduced in each task."""
    found = rows.agg(F.schema_of_variant_agg(rest)).first()[0]
    kind = _type_of(found)
    return {f.name: f.dataType.simpleString() for f in kind.fields} if isinstance(kind, StructType) else {}


def _type_of(found: str | None) -> DataType | None:
    """The Spark type of a variant's schema, whose objects are called OBJECT there; VOID where nothing was found."""
    if found is None or found == "VOID":
        return None
    return _parse_datatype_string(found.replace("OBJECT<", "STRUCT<"))


def with_fields(rows: DataFrame, rest: str, fields: dict[str, str]) -> DataFrame:
    """The rows with columns of their own for fields of a VARIANT; a value that does not fit the type becomes NULL.

    A name may hold single or double quotes, not both.
    """
    quotes = {name: '"' if "'" in name else "'" for name in fields}
    return rows.withColumns(
        {name: F.try_variant_get(rest, f"$[{quotes[name]}{name}{quotes[name]}]", kind) for name, kind in fields.items()}
    )


def table_stream(spark: SparkSession, table: str, bytes_per_batch: int | None = BATCH_BYTES) -> DataFrame:
    """New rows of an append-only table as a stream."""
    reader = spark.readStream
    if bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.table(table)


def bronze(raw: DataFrame) -> DataFrame:
    """Raw rows with their arrival time and file."""
    data = [c for c in raw.columns if c != "source_file"]
    return raw.select(*data, F.current_timestamp().alias("receipt_time"), "source_file")


def silver(readings: DataFrame, lookup: DataFrame) -> DataFrame:
    """Readings above zero with the name from the lookup and the time parsed.

    ``mrn`` is text on both sides. ``heartrate`` may be text: what is no number is dropped.
    """
    rate = F.col("heartrate").try_cast("double")
    names = lookup.select("mrn", "name")
    return (
        readings.where(rate > 0)
        .join(names, "mrn")
        .select(
            "device_id",
            "mrn",
            "name",
            epoch_to_timestamp("time").alias("time"),
            rate.alias("heartrate"),
        )
    )


def gold(enriched: DataFrame) -> DataFrame:
    """Mean per entity and day. Rows without a time form a group of their own."""
    return enriched.groupBy("mrn", "name", day_of("time").alias("date")).agg(
        F.avg("heartrate").alias("avg_heartrate")
    )


def append_to_table(
    stream: DataFrame, table: str, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append a stream to a parquet table whose files lie at ``path``."""
    writer = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return with_trigger(writer, every).toTable(table)


def rewrite_table(
    aggregate: DataFrame,
    table: str,
    path: str,
    checkpoint: str,
    every: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Keep ``table`` equal to a streaming aggregate.

    It is rewritten with every batch and cannot itself be read as a stream. State is kept in RocksDB,
    so it may outgrow the executors' memory. ``state_partitions`` is how many parts it is kept in;
    it counts at the first start and holds for the checkpoint's life, so size it for the table's.
    """
    spark = aggregate.sparkSession
    writer = (
        aggregate.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(complete_publisher(table, path))
    )
    state = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if state_partitions:
        state["spark.sql.shuffle.partitions"] = str(state_partitions)
    with settings(spark, state):
        return with_trigger(writer, every).start()


DAYS = "group string, mrn string, name string, date timestamp, total double, n bigint"


def daily_table(spark: SparkSession, path: str) -> VersionedTable:
    """The table of daily sums at ``path``, made if absent."""
    table = VersionedTable(spark, path)
    try:
        table.snapshot()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return VersionedTable.create(spark, path, spark.createDataFrame([], DAYS), ["group"])
    return table


def daily_sums(enriched: DataFrame) -> DataFrame:
    """What ``gold`` is the quotient of: sums and counts, which can be added to, per entity and day.

    The group's own key is text, as any of its parts may be NULL and a table's key may not.
    """
    sums = enriched.groupBy("mrn", "name", day_of("time").alias("date"))
    sums = sums.agg(F.sum("heartrate").alias("total"), F.count("heartrate").alias("n"))
    return sums.withColumn("group", F.to_json(F.struct("mrn", "name", F.unix_micros("date").alias("date"))))


def daily_means(table: VersionedTable) -> DataFrame:
    """``gold`` of everything that was added to the table."""
    return table.read().select("mrn", "name", "date", (F.col("total") / F.col("n")).alias("avg_heartrate"))


def add_days(
    enriched: DataFrame, table: VersionedTable, checkpoint: str, name: str, every: str | None = None, fold_share: float = 0.5
) -> StreamingQuery:
    """Add each batch to the days that it touches; all others are neither kept as state nor written again.

    ``enriched`` are rows as ``silver`` gives them. A batch is reduced to its own sums, which are merged under
    the stream's ``name`` and the batch's number, so one that is repeated is not added twice. Rows may come in for
    any day at any time, since the stream itself remembers nothing.
    """
    more = {c: f"coalesce(t.{c}, 0) + coalesce(s.{c}, 0)" for c in ("total", "n")}
    clauses = [when_matched_update(values=more), when_not_matched_insert()]

    def add(batch: DataFrame, batch_id: int) -> None:
        target = VersionedTable(batch.sparkSession, table.path)
        staged = f"{table.path}/staged/slot={batch_id % 2}"
        sums = daily_sums(batch)
        sums.write.mode("overwrite").parquet(staged)
        sums = batch.sparkSession.read.schema(sums.schema).parquet(staged)
        target.merge(sums, clauses, stream=name, batch=batch_id, check_keys=False)
        target.fold_if_changed(fold_share)

    writer = enriched.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(add)
    return with_trigger(writer, every).start()


def run_once(
    spark: SparkSession,
    landing: str,
    columns: Sequence[str],
    hints: dict[str, str],
    lookup: DataFrame,
    tables: dict[str, str],
    folder: str,
    state_partitions: int | None = None,
    complete: bool = False,
) -> None:
    """One incremental run through all three steps. A rerun takes up only what is new.

    The last step adds to the days that changed; with ``complete`` it keeps all days as state and rewrites the
    result. In either case the gold table's name shows the means, in the first one for this session
    (``daily_means`` of the table under ``folder/days`` elsewhere).
    """
    incoming = bronze(raw_files(spark, landing, columns, hints))
    append_to_table(
        incoming, tables["bronze"], f"{folder}/bronze", f"{folder}/_checkpoints/bronze"
    ).awaitTermination()
    enriched = silver(table_stream(spark, tables["bronze"]), lookup)
    append_to_table(
        enriched, tables["silver"], f"{folder}/silver", f"{folder}/_checkpoints/silver"
    ).awaitTermination()
    if not complete:
        days = daily_table(spark, f"{folder}/days")
        add_days(table_stream(spark, tables["silver"]), days, f"{folder}/_checkpoints/days", "days").awaitTermination()
        daily_means(days).createOrReplaceTempView(tables["gold"])
        return
    # one batch for all that is new, as each batch rewrites the result
    daily = gold(table_stream(spark, tables["silver"], bytes_per_batch=None))
    rewrite_table(
        daily, tables["gold"], f"{folder}/gold", f"{folder}/_checkpoints/gold", state_partitions=state_partitions
    ).awaitTermination()
