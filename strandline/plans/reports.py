"""Aggregate reports.

Where a join only supplies the grouping column, the large table is aggregated by its
foreign key first. The join then meets one row per key, whatever share of the rows a key
has, and needs no shuffle beyond that of the aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import Total, cents


def mean_by_key(df: DataFrame, key: str, amount: str, name: str) -> DataFrame:
    """Mean amount per key, sorted by key."""
    total = Total("sum")
    sums = df.groupBy(key).agg(*total.start(amount, cents(amount)), F.count(amount).alias("_count"))
    return sums.select(key, F.try_divide(total.value(), F.col("_count")).alias(name)).orderBy(key)


def sum_by_dimension(
    facts: DataFrame, foreign_key: str, amount: str, dimension: DataFrame, key: str, group: str, name: str
) -> DataFrame:
    total = Total("sum")
    per_key = facts.groupBy(foreign_key).agg(*total.start(amount, cents(amount)))
    joined = per_key.join(dimension.select(key, group), F.col(foreign_key) == F.col(key))
    return joined.groupBy(group).agg(*total.again()).select(group, total.value().alias(name))


def count_and_sum_by_dimension(
    facts: DataFrame,
    foreign_key: str,
    amount: str,
    dimension: DataFrame,
    key: str,
    group: str,
    count_name: str,
    sum_name: str,
) -> DataFrame:
    """``COUNT(foreign_key)`` and ``SUM(amount)`` per group of the joined dimension."""
    total = Total("sum")
    per_key = facts.groupBy(foreign_key).agg(F.count(foreign_key).alias("_count"), *total.start(amount, cents(amount)))
    joined = per_key.join(dimension.select(key, group), F.col(foreign_key) == F.col(key))
    sums = joined.groupBy(group).agg(F.sum("_count").alias(count_name), *total.again())
    return sums.select(group, count_name, total.value().alias(sum_name))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows, from parquet footers."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionAll(one)
    return out


def select_where(
    spark: SparkSession, query: str, defaults: dict[str, object] | None = None, **parameters: object
) -> DataFrame:
    """SQL with named parameters (``:year``); values never become part of the text."""
    return spark.sql(query, args={**(defaults or {}), **parameters})


def table_by_name(spark: SparkSession, name: str) -> DataFrame:
    """A table whose name is a parameter."""
    return spark.sql("SELECT * FROM IDENTIFIER(:name)", args={"name": name})


def with_computed(df: DataFrame, **columns: Column) -> DataFrame:
    """``SELECT *, expression AS name``."""
    return df.select("*", *[c.alias(n) for n, c in columns.items()])
