from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators.layout import partition_columns
from strandline.sources.tables import sql_literal, value_rows


# For writers of text formats, which otherwise cut times to milliseconds.
WHOLE_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def reset_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Drop a database with all its tables and start an empty one."""
    spark.sql("DROP DATABASE IF EXISTS IDENTIFIER(:name) CASCADE", args={"name": name})
    at = f" LOCATION {sql_literal(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IDENTIFIER(:name){at}", args={"name": name})


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})


def create_table(spark: SparkSession, name: str, columns: str, path: str | None = None) -> None:
    """A typed parquet table, if absent. ``columns`` is a schema; ``path`` puts its files in the shared folder."""
    if not spark.catalog.tableExists(name):
        schema = spark.createDataFrame([], columns).schema
        spark.catalog.createTable(name, path, source="parquet", schema=schema)


def insert_values(spark: SparkSession, name: str, rows: Sequence[Sequence[object]]) -> None:
    """Insert literal rows; the values are parameters."""
    text, args = value_rows(rows)
    spark.sql(f"INSERT INTO IDENTIFIER(:name) VALUES {text}", args={"name": name, **args})


class UnknownColumns(ValueError):
    """The rows have columns that the table lacks."""


def append_rows(df: DataFrame, name: str) -> None:
    """Append by column name. Columns that the table lacks are refused, not dropped."""
    columns = df.sparkSession.table(name).columns
    unknown = [c for c in df.columns if c.lower() not in {k.lower() for k in columns}]
    if unknown:
        raise UnknownColumns(f"{name} has no columns {unknown}")
    df.select(*columns).write.mode("append").format("parquet").insertInto(name)


def append_audit_row(spark: SparkSession, name: str, task: str) -> None:
    """One row saying that ``task`` ran now. The text is a parameter, never part of the SQL."""
    spark.sql(
        "INSERT INTO IDENTIFIER(:name) SELECT concat('From ', :task), current_timestamp()",
        args={"name": name, "task": task},
    )


def with_load_time(df: DataFrame, column: str = "updated") -> DataFrame:
    return df.select("*", F.current_timestamp().alias(column))


def replace_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Create or replace a table from a query."""
    df.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def append_null_rows(df: DataFrame, n: int) -> DataFrame:
    """The frame plus ``n`` rows in which every column is NULL."""
    empty = df.sparkSession.range(n).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )
    return df.unionByName(empty)


def copy_dataset(spark: SparkSession, source: str, target: str, fmt: str = "parquet", **options: str) -> int:
    """Copy a dataset and count the copy. One whose folders are named after columns keeps them."""
    rows = spark.read.format(fmt).options(**options).load(source)
    partitions = partition_columns(spark, source) if fmt == "parquet" else []
    writer = (rows.hint("rebalance", *partitions) if partitions else rows).write.format(fmt).options(**options)
    (writer.partitionBy(*partitions) if partitions else writer).save(target)
    return spark.read.format(fmt).options(**options).load(target).count()
