"""Helpers the operators share: words, intermediate tables, joins that stand a hot key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.session import new_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# The bytes 0-2F, 3A-60 and 7B-7F part words; letters, digits and everything outside ASCII make them.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# A table is broadcast only after a count has shown that it has no more rows than this.
BROADCAST_ROWS = 200_000
# A key is hot from this share of the rows on; there can be no more than 1024 such keys.
HOT_SHARE = 1 / 1024


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column, separator: str) -> Column:
    """The parts between separators, without empty ones; NULL text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), separator), lambda w: w != "")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and go on from there, which cuts the lineage."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checked_broadcast(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Mark a settled table for broadcast if it is small, else leave the join to a shuffle."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def all_equal(left: DataFrame, right: DataFrame, keys: dict[str, str]) -> Column:
    """NULL-safe equality of left columns (keys) with right columns (values)."""
    return reduce(lambda a, b: a & b, (left[a].eqNullSafe(right[b]) for a, b in keys.items()))


def join_unique(left: DataFrame, right: DataFrame, keys: dict[str, str], rows: str, total: int) -> DataFrame:
    """Inner join with a settled table of unique keys, where a left key may hold most of the rows.

    ``right[rows]`` says how many left rows have the key and ``total`` how many there are at all.
    Hot keys, at most 1 / HOT_SHARE by their definition, are joined by broadcast, so their rows
    stay where they are; the others are shuffled.
    """
    is_hot = F.col(rows) >= max(2.0, total * HOT_SHARE)
    hot, rest = right.filter(is_hot), right.filter(~is_hot)
    if total * HOT_SHARE <= 2 and right.count() <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), all_equal(left, right, keys))
    cold = left.join(F.broadcast(hot), all_equal(left, hot, keys), "left_anti")
    return left.join(F.broadcast(hot), all_equal(left, hot, keys)).unionByName(cold.join(rest, all_equal(cold, rest, keys)))


def keep_rows(docs: DataFrame, keys: DataFrame, *, drop: bool = False) -> DataFrame:
    """Rows whose (doc_id, text) is among ``keys`` (doc_id, text_hash), or not among them with ``drop``.

    ``keys`` is settled. All columns of ``docs`` stay, whatever their names.
    """
    wanted = checked_broadcast(keys.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct(), keys.count())
    same = docs["doc_id"].eqNullSafe(wanted["__id"]) & (text_hash(docs["text"]) == wanted["__hash"])
    return docs.join(wanted, same, "left_anti" if drop else "left_semi")


def text_hash(text: Column) -> Column:
    """Tells the texts of one doc_id apart; NULL differs from empty."""
    return F.when(text.isNull(), F.lit(0)).otherwise(F.xxhash64(text, F.octet_length(text)))


def read_documents(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
