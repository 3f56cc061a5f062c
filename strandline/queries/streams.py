"""Streams over the events table, delivered as JSON files. Each runs to its end and returns the sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline import sources
from strandline.functions import epoch_to_timestamp
from strandline.operators.versioned import VersionedTable
from strandline.session import new_folder, new_table_name
from strandline.streaming import ingest, medallion
from strandline.streaming.control import drain
from strandline.streaming.replay import ArrivalReplay
from strandline.tables import read_table

READING_COLUMNS = ["device_id", "mrn", "time", "heartrate"]
READING_HINTS = {"time": "double"}
EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
EVENT_HINTS = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "value": "double"}


def _readings(spark: SparkSession, folder: str) -> DataFrame:
    """Events in the shape of device recordings; some have no usable time, some no positive rate."""
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000
    time = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(seconds.cast("string"))
    return read_table(spark, folder, "events").select(
        F.col("event_type").alias("device_id"),
        F.col("user_id").alias("mrn"),
        time.alias("time"),
        (F.col("value") - 20).alias("heartrate"),
        "event_id",
        "props",
    )


def _lookup(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "patients")
    customer = read_table(spark, folder, "customer")
    customer.select(F.col("c_custkey").alias("mrn"), F.col("c_name").alias("name")).write.option(
        "header", True
    ).csv(path)
    return sources.read_csv(spark, path, schema="mrn STRING, name STRING")


def _landed(spark: SparkSession, folder: str) -> str:
    landing = new_folder(spark, "landing")
    _readings(spark, folder).write.json(landing)
    return landing


def _bronze_table(spark: SparkSession, landing: str) -> str:
    table, work = new_table_name("bronze"), new_folder(spark, "bronze")
    rows = medallion.bronze(medallion.raw_files(spark, landing, READING_COLUMNS, READING_HINTS, rest="others", typed=True))
    medallion.append_to_table(rows, table, f"{work}/data", f"{work}/checkpoint").awaitTermination()
    return table


def bronze(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.table(_bronze_table(spark, _landed(spark, folder)))
    # fields that the load does not name are kept, and get the types that their values have
    rows = medallion.with_fields(rows, "others", medallion.found_fields(rows, "others"))
    return rows.where(F.col("receipt_time").isNotNull() & F.col("source_file").isNotNull()).select(
        "device_id",
        "mrn",
        F.date_format(epoch_to_timestamp("time"), "yyyy-MM-dd HH:mm:ss").alias("read_at"),
        F.col("heartrate").try_cast("double").alias("heartrate"),
        "event_id",
        "props",
    )


def _event_columns(rows: DataFrame) -> DataFrame:
    ts = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts")
    return rows.select("event_id", ts, "user_id", "event_type", "value", "props")


def _period() -> Column:
    """Ten-day periods, numbered from the first event day of the year."""
    return F.floor(F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) / 10) + 1


def _replay(spark: SparkSession, folder: str) -> ArrivalReplay:
    events = read_table(spark, folder, "events").select(*EVENT_COLUMNS)
    return ArrivalReplay.stage(events, _period(), new_folder(spark, "staged"), new_folder(spark, "landing"))


def incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The same load run after the first arrival and after all others; each row with its arrival."""
    replay = _replay(spark, folder)
    table, work = new_table_name("incremental"), new_folder(spark, "incremental")

    def load() -> None:
        raw = medallion.raw_files(spark, replay.landing, EVENT_COLUMNS, EVENT_HINTS)
        medallion.append_to_table(
            medallion.bronze(raw), table, f"{work}/data", f"{work}/checkpoint"
        ).awaitTermination()

    replay.deliver()
    load()
    replay.deliver_all()
    load()
    arrival = F.regexp_extract("source_file", r"/(\d+)\.json/[^/]*$", 1).cast("int")
    rows = spark.table(table).withColumn("arrival", arrival)
    ts = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts")
    return rows.select("event_id", ts, "user_id", "event_type", "value", "props", "arrival")


def _steps(spark: SparkSession, folder: str, complete: bool = False) -> dict[str, str]:
    tables = {step: new_table_name(step) for step in ("bronze", "silver", "gold")}
    medallion.run_once(
        spark, _landed(spark, folder), READING_COLUMNS, READING_HINTS, _lookup(spark, folder), tables,
        new_folder(spark, "steps"), complete=complete,
    )
    return tables


def _silver_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "device_id", "mrn", "name", F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("read_at"), "heartrate"
    )


def silver(spark: SparkSession, folder: str) -> DataFrame:
    bronze_table = _bronze_table(spark, _landed(spark, folder))
    table, work = new_table_name("silver"), new_folder(spark, "silver")
    rows = medallion.silver(medallion.table_stream(spark, bronze_table), _lookup(spark, folder))
    medallion.append_to_table(rows, table, f"{work}/data", f"{work}/checkpoint").awaitTermination()
    return _silver_columns(spark.table(table))


def silver_continuous(spark: SparkSession, folder: str) -> DataFrame:
    """The same step with batches as fast as they come, stopped when all rows are through."""
    bronze_table = _bronze_table(spark, _landed(spark, folder))
    table, work = new_table_name("silver"), new_folder(spark, "silver")
    rows = medallion.silver(medallion.table_stream(spark, bronze_table), _lookup(spark, folder))
    query = medallion.append_to_table(rows, table, f"{work}/data", f"{work}/checkpoint", every="0 seconds")
    try:
        drain(query)
    finally:
        query.stop()
    return _silver_columns(spark.table(table))


def gold(spark: SparkSession, folder: str) -> DataFrame:
    daily = spark.table(_steps(spark, folder)["gold"])
    return daily.select(
        "mrn", "name", F.col("date").cast("date").alias("day"), F.round("avg_heartrate", 6).alias("avg_heartrate")
    )


def gold_range(spark: SparkSession, folder: str) -> DataFrame:
    """A plain read of means published as a whole, limited to a span of days given as text."""
    daily = spark.table(_steps(spark, folder, complete=True)["gold"])
    return daily.where(F.col("date").between("2024-01-10", "2024-01-20")).select(
        "mrn", F.col("date").cast("date").alias("day"), F.round("avg_heartrate", 6).alias("avg_heartrate")
    )


def replaced(spark: SparkSession, folder: str) -> DataFrame:
    """One run after the first arrival, one with all others waiting: the newest arrival is left, whole."""
    replay = _replay(spark, folder)
    table, work = new_table_name("replaced"), new_folder(spark, "replaced")

    def load() -> None:
        ingest.load_replacing(
            spark, replay.landing, EVENT_COLUMNS, EVENT_HINTS, table, f"{work}/data", f"{work}/checkpoint"
        ).awaitTermination()

    replay.deliver()
    load()
    replay.deliver_all()
    load()
    return _event_columns(spark.table(table))


def merged(spark: SparkSession, folder: str) -> DataFrame:
    """Newest event of each user, merged arrival by arrival."""
    replay = _replay(spark, folder)
    work = new_folder(spark, "merged")
    columns = ["user_id", "event_id", "ts", "event_type", "value", "props"]
    empty = read_table(spark, folder, "events").select(*columns).where(F.lit(False))
    target = VersionedTable.create(spark, f"{work}/data", empty, ["user_id"])
    while replay.deliver() is not None:
        raw = medallion.raw_files(spark, replay.landing, EVENT_COLUMNS, EVENT_HINTS).select(*columns)
        ingest.load_merging(
            raw, target, ["ts", "event_id"], f"{work}/checkpoint", "events-by-user"
        ).awaitTermination()
    return _event_columns(target.read())


def merged_with_deletes(spark: SparkSession, folder: str) -> DataFrame:
    """Newest event of each user, where errors delete the user; a third of all events arrives last, whatever its time."""
    columns = ["user_id", "event_id", "ts", "event_type", "value", "props"]
    events = read_table(spark, folder, "events").select(*columns)
    late = F.when(F.col("event_id") % 3 == 0, F.lit(3)).otherwise(F.least(_period(), F.lit(2)))
    replay = ArrivalReplay.stage(events, late, new_folder(spark, "staged"), new_folder(spark, "landing"))
    work = new_folder(spark, "merged")
    empty = ingest.with_tombstones(events.where(F.lit(False)))
    target = VersionedTable.create(spark, f"{work}/data", empty, ["user_id"])
    while replay.deliver() is not None:
        raw = medallion.raw_files(spark, replay.landing, EVENT_COLUMNS, EVENT_HINTS).select(*columns)
        ingest.load_merging(
            raw, target, ["ts", "event_id"], f"{work}/checkpoint", "events-by-user", deletes="event_type = 'error'"
        ).awaitTermination()
    return _event_columns(ingest.live(target.read()))


def replayed(spark: SparkSession, folder: str) -> DataFrame:
    """All periods delivered at once, then streamed a file at a time."""
    replay = _replay(spark, folder)
    replay.deliver_all()
    table, work = new_table_name("replayed"), new_folder(spark, "replayed")
    raw = medallion.raw_files(spark, replay.landing, EVENT_COLUMNS, EVENT_HINTS, files_per_batch=1)
    rows = raw.drop("source_file")
    medallion.append_to_table(rows, table, f"{work}/data", f"{work}/checkpoint").awaitTermination()
    return _event_columns(spark.table(table))


QUERIES = {
    "str_bronze": bronze,
    "str_incremental": incremental,
    "str_silver": silver,
    "str_silver_continuous": silver_continuous,
    "str_gold": gold,
    "str_gold_range": gold_range,
    "ing_replace": replaced,
    "ing_merge": merged,
    "ing_merge_deletes": merged_with_deletes,
    "ing_replay": replayed,
}

_SILVER = """
    SELECT event_type AS device_id, CAST(user_id AS VARCHAR) AS mrn, c_name AS name,
           CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS read_at,
           value - 20 AS heartrate
    FROM events JOIN customer ON c_custkey = user_id WHERE value - 20 > 0"""

_EVENT = "event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props"

_PERIOD = "(CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 10.0) AS INTEGER) + 1)"

ORACLES = {
    "str_bronze": """
        SELECT event_type AS device_id, CAST(user_id AS VARCHAR) AS mrn,
               CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS read_at,
               value - 20 AS heartrate, event_id, props FROM events""",
    "str_incremental": f"SELECT {_EVENT}, {_PERIOD} AS arrival FROM events",
    "str_silver": _SILVER,
    "str_silver_continuous": _SILVER,
    "str_gold": f"""
        SELECT mrn, name, CAST(read_at AS DATE) AS day, round(AVG(heartrate), 6) AS avg_heartrate
        FROM ({_SILVER}) AS s GROUP BY mrn, name, CAST(read_at AS DATE)""",
    "str_gold_range": f"""
        SELECT mrn, CAST(read_at AS DATE) AS day, round(AVG(heartrate), 6) AS avg_heartrate
        FROM ({_SILVER}) AS s GROUP BY mrn, name, CAST(read_at AS DATE)
        HAVING CAST(read_at AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""",
    "ing_replace": f"""
        SELECT {_EVENT} FROM events
        WHERE {_PERIOD} = (SELECT MAX({_PERIOD}) FROM events)""",
    "ing_merge": f"""
        SELECT {_EVENT} FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place
          FROM events) AS e WHERE place = 1""",
    "ing_merge_deletes": f"""
        SELECT {_EVENT} FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place
          FROM events) AS e WHERE place = 1 AND event_type <> 'error'""",
    "ing_replay": f"SELECT {_EVENT} FROM events",
}
