"""Profit by nation and year over six tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions import Total, cents


def product_profit(
    part: DataFrame,
    supplier: DataFrame,
    lineitem: DataFrame,
    partsupp: DataFrame,
    orders: DataFrame,
    nation: DataFrame,
    name_like: str,
) -> DataFrame:
    """Sum of price less discount less supply cost, for parts whose name matches.

    What is known per (part, supplier) is joined first, and the large table is cut down
    to the wanted parts before its other columns meet anything: at the scan where the parts
    fit a broadcast, in one shuffle where they do not. What is left is joined once on the
    pair and once with the orders. Nations stay numbers until the sums are made. Broadcasts
    are chosen by size, hot keys split by Spark.
    """
    wanted = part.where(F.col("p_name").like(name_like)).select("p_partkey")
    supplied = (
        partsupp.join(wanted, F.col("ps_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("ps_suppkey") == F.col("s_suppkey"))
        .select("ps_partkey", "ps_suppkey", "ps_supplycost", "s_nationkey")
    )
    wanted_lines = lineitem.join(wanted, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    lines = wanted_lines.join(
        supplied,
        (F.col("l_partkey") == F.col("ps_partkey")) & (F.col("l_suppkey") == F.col("ps_suppkey")),
    ).select(
        "l_orderkey",
        "s_nationkey",
        (
            F.col("l_extendedprice") * (1 - F.col("l_discount")) - F.col("ps_supplycost") * F.col("l_quantity")
        ).alias("amount"),
        (
            cents("l_extendedprice") * (100 - cents("l_discount")) - cents("ps_supplycost") * cents("l_quantity")
        ).alias("whole"),  # in ten-thousandths
    )
    dated = orders.select("o_orderkey", F.year("o_orderdate").alias("o_year"))
    total = Total("profit")
    per_number = (
        lines.join(dated, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("s_nationkey", "o_year")
        .agg(*total.start("amount", F.col("whole")))
    )
    return (
        per_number.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("nation"), "o_year")
        .agg(*total.again())
        .select("nation", "o_year", total.value(10_000).alias("sum_profit"))
        .orderBy("nation", F.col("o_year").asc())
    )


def _hundredths(column: str) -> str:
    return (
        f"CASE WHEN abs({column}) < 9e13 AND rint({column} * 100) / 100 = {column} "
        f"THEN bigint(rint({column} * 100)) END"
    )


# The plan above as SQL text over views of the table names: what each part costs and which nation it
# comes from, what was earned with it per order, sums per nation number and year, names at the end.
PRODUCT_PROFIT_SQL = f"""
WITH chosen AS (SELECT p_partkey FROM part WHERE p_name LIKE :name_like),
offers AS (
  SELECT ps_partkey, ps_suppkey, s_nationkey, ps_supplycost, {_hundredths("ps_supplycost")} AS cost
  FROM partsupp
  LEFT SEMI JOIN chosen ON ps_partkey = p_partkey
  JOIN supplier ON s_suppkey = ps_suppkey),
sold AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice * (1 - l_discount) AS earned, l_quantity,
         {_hundredths("l_extendedprice")} AS price, {_hundredths("l_discount")} AS discount,
         {_hundredths("l_quantity")} AS quantity
  FROM lineitem LEFT SEMI JOIN chosen ON l_partkey = p_partkey),
gains AS (
  SELECT l_orderkey, s_nationkey, earned - ps_supplycost * l_quantity AS gain,
         price * (100 - discount) - cost * quantity AS whole
  FROM sold JOIN offers ON l_partkey = ps_partkey AND l_suppkey = ps_suppkey),
by_number AS (
  SELECT s_nationkey, year(o_orderdate) AS o_year, sum(gain) AS plain,
         sum(CAST(whole AS DECIMAL(20,0))) AS whole, count_if(gain IS NOT NULL AND whole IS NULL) AS odd
  FROM gains JOIN orders ON o_orderkey = l_orderkey
  GROUP BY s_nationkey, year(o_orderdate))
SELECT n_name AS nation, o_year,
       CASE WHEN sum(odd) = 0 THEN CAST(sum(whole) AS DOUBLE) / 10000 ELSE sum(plain) END AS sum_profit
FROM by_number JOIN nation ON n_nationkey = s_nationkey
GROUP BY n_name, o_year
ORDER BY nation, o_year
"""


def derived_partsupp(lineitem: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """Part and supplier pairs that were sold, with a cost computed from the keys.

    ``parts`` (a frame with ``p_partkey``) limits the pairs. Repeated pairs are dropped before
    any shuffle, so a part with a large share of the lines does not gather in one task; where
    the parts fit a broadcast, Spark moves the limit down to the scan by itself.
    """
    pairs = lineitem.select(
        F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey")
    ).distinct()
    if parts is not None:
        pairs = pairs.join(parts, F.col("ps_partkey") == F.col("p_partkey"), "left_semi")
    cost = (500 + (7 * F.col("ps_partkey") + 13 * F.col("ps_suppkey")) % 1000) / 10
    return pairs.withColumn("ps_supplycost", cost)
