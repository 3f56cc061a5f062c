"""File layout over the lineitem table."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators import layout
from strandline.operators.versioned import VersionedTable
from strandline.session import new_folder
from strandline.tables import dataset_bytes, read_table


def _lineitem_path(folder: str) -> str:
    return f"{folder.rstrip('/')}/lineitem.parquet"


def _shares(spark: SparkSession, folder: str, size: int) -> int:
    """How many times ``size`` the table has; numbers of files go with it, so files and tasks don't grow."""
    return max(1, math.ceil(dataset_bytes(spark, _lineitem_path(folder)) / size))


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


def compacted(spark: SparkSession, folder: str) -> DataFrame:
    return _dated(layout.compact(spark, _lineitem_path(folder), new_folder(spark, "lineitem-compact")))


def clustered(spark: SparkSession, folder: str) -> DataFrame:
    target = new_folder(spark, "lineitem-cluster")
    return _dated(layout.cluster(spark, _lineitem_path(folder), target, ["l_partkey", "l_orderkey"]))


def file_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and ranges from the footers; files and bytes from a listing, against those that rows are read from."""
    path = _lineitem_path(folder)
    files = layout.list_files(spark, path).agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes")).first()
    ranges = layout.dataset_ranges(spark, path, ["l_orderkey", "l_partkey", "l_quantity"])
    all_bytes = F.lit(files.bytes == dataset_bytes(spark, path))
    return ranges.select("*", all_bytes.alias("all_bytes"), F.lit(files.files > 0).alias("any_files"))


def compacted_small(spark: SparkSession, folder: str) -> DataFrame:
    """Many small files beside a full one: only the small ones are written anew, in fewer files.

    The full file holds three quarters of a share of the table; each further share adds eight small ones. A share
    is a quarter of the wanted size, as one task writes the full file from rows that take several times its bytes.
    """
    line, source = read_table(spark, folder, "lineitem"), new_folder(spark, "lineitem-mixed")
    shares = _shares(spark, folder, layout.TARGET_BYTES // 4)
    late = F.col("l_orderkey") % 4 == 0
    first = F.pmod(F.xxhash64(*line.columns), F.lit(shares)) == 0
    line.where(~late & first).repartition(1).write.parquet(source)
    line.where(late | (~late & ~first)).repartition(16 + 8 * shares).write.mode("append").parquet(source)
    before = layout.list_files(spark, source)
    size = before.agg(F.max("bytes")).first()[0]
    after = layout.compact_small(spark, before, new_folder(spark, "lineitem-packed"), target_bytes=size)
    stayed = before.join(after, ["path"], "left_semi").count()
    rows = _dated(layout.read_files(spark, after))
    few = after.count() < 6 * shares
    return rows.select("*", F.lit(stayed).cast("bigint").alias("files_left"), F.lit(few).alias("few_files"))


def reclustered(spark: SparkSession, folder: str) -> DataFrame:
    """Files sorted by order, and others, one for each share of the table, that fall into the lower part of them: the
    upper ones stay where they are."""
    line, source = read_table(spark, folder, "lineitem"), new_folder(spark, "lineitem-sorted")
    shares = _shares(spark, folder, layout.TARGET_BYTES)
    low = line.agg(F.percentile_approx("l_orderkey", 0.3)).first()[0]
    late = (F.col("l_orderkey") <= low) & (F.col("l_linenumber") == 1)
    line.where(~late).repartitionByRange(10 * shares, "l_orderkey").sortWithinPartitions("l_orderkey").write.parquet(source)
    line.where(late).repartition(shares).write.mode("append").parquet(source)
    before = layout.list_files(spark, source)
    target = new_folder(spark, "lineitem-reclustered")
    after = layout.recluster(spark, before, target, "l_orderkey", most_depth=1, files=4 * shares)
    stayed = before.join(after, ["path"], "left_semi").count()
    left = layout.file_stats(layout.read_files(spark, after), ["l_orderkey"]).select("file", "min_l_orderkey", "max_l_orderkey")
    crowded = layout.crowded([tuple(r) for r in left.collect()], 2)
    rows = _dated(layout.read_files(spark, after))
    upper = 5 * shares <= stayed < 8 * shares
    return rows.select("*", F.lit(upper).alias("upper_stayed"), F.lit(not crowded).alias("sorted"))


def keyed(spark: SparkSession, folder: str) -> DataFrame:
    """A keyed table is changed, compacted, clustered by two columns and changed again."""
    customer = read_table(spark, folder, "customer")
    table = VersionedTable.create(spark, new_folder(spark, "customer-layout"), customer, ["c_custkey"])
    table.update("c_name LIKE '%5'", {"c_acctbal": "c_acctbal + 1"})
    table.delete("c_acctbal > 9000")
    table.compact()
    table.compact(cluster_by=["c_nationkey", "c_acctbal"])
    table.update("c_mktsegment = 'BUILDING'", {"c_name": "'b'"})
    opened = table.details().select(F.col("version").alias("at_version"), "keys", (F.col("files") > 0).alias("has_files"))
    return table.read().crossJoin(opened)


QUERIES = {"lay_compact": compacted, "lay_cluster": clustered, "lay_file_stats": file_ranges, "lay_keyed": keyed,
           "lay_compact_small": compacted_small, "lay_recluster": reclustered}

_LINEITEM = """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
           l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem"""

ORACLES = {
    "lay_compact": _LINEITEM,
    "lay_cluster": _LINEITEM,
    "lay_compact_small": f"SELECT *, CAST(1 AS BIGINT) AS files_left, true AS few_files FROM ({_LINEITEM})",
    "lay_recluster": f"SELECT *, true AS upper_stayed, true AS sorted FROM ({_LINEITEM})",
    "lay_file_stats": """
        SELECT COUNT(*) AS rows, MIN(l_orderkey) AS min_l_orderkey, MAX(l_orderkey) AS max_l_orderkey,
               MIN(l_partkey) AS min_l_partkey, MAX(l_partkey) AS max_l_partkey,
               MIN(l_quantity) AS min_l_quantity, MAX(l_quantity) AS max_l_quantity,
               true AS all_bytes, true AS any_files FROM lineitem""",
    "lay_keyed": """
        WITH t AS (SELECT * REPLACE (CASE WHEN c_name LIKE '%5' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal)
                   FROM customer)
        SELECT * REPLACE (CASE WHEN c_mktsegment = 'BUILDING' THEN 'b' ELSE c_name END AS c_name),
               CAST(4 AS BIGINT) AS at_version, 'c_custkey' AS keys, true AS has_files
        FROM t WHERE NOT coalesce(c_acctbal > 9000, false)""",
}
