"""External databases. Reads and writes are split over several connections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    partitions: int = 16,
    lower: object | None = None,
    upper: object | None = None,
    fetch_size: int = 10_000,
    **options: str,
) -> DataFrame:
    """A database table read in ``partitions`` ranges of ``column``.

    The bounds only set the width of the ranges; rows outside them are still read.
    Where they are not given, the database is asked for the column's minimum and maximum.
    """
    reader = spark.read.format("jdbc").options(url=url, **options)
    if lower is None or upper is None:
        bounds = (
            reader.option("query", f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}")
            .load()
            .first()
        )
        lower = bounds[0] if lower is None else lower
        upper = bounds[1] if upper is None else upper
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize=fetch_size, **options)
    if lower is None or upper is None:  # empty table, nothing to split
        return reader.load()
    return reader.options(
        partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=partitions
    ).load()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    partitions: int = 16,
    mode: str = "overwrite",
    batch_size: int = 10_000,
    **options: str,
) -> None:
    """Write a table with at most ``partitions`` connections at a time."""
    (
        df.write.format("jdbc")
        .options(url=url, dbtable=table, numPartitions=partitions, batchsize=batch_size, **options)
        .mode(mode)
        .save()
    )
