"""Projections, filters, joins, aggregates, scalar functions, parameters and models."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import clean_identifier, day_of, epoch_to_timestamp, local_part, two_digits
from strandline.plans import reports, star
from strandline.plans.models import Model, check_models, run_models
from strandline.session import new_table_name
from strandline.sources import inline_rows
from strandline.tables import TABLES, read_table, register_views

PART_NAME = "%red%"


def product_profit(spark: SparkSession, folder: str) -> DataFrame:
    part, supplier, lineitem, orders, nation = (
        read_table(spark, folder, t) for t in ("part", "supplier", "lineitem", "orders", "nation")
    )
    wanted = part.where(F.col("p_name").like(PART_NAME)).select("p_partkey")
    partsupp = star.derived_partsupp(lineitem, wanted)
    return star.product_profit(part, supplier, lineitem, partsupp, orders, nation, PART_NAME)


def product_profit_sql(spark: SparkSession, folder: str) -> DataFrame:
    register_views(spark, folder, ["part", "supplier", "lineitem", "orders", "nation"])
    wanted = spark.table("part").where(F.col("p_name").like(PART_NAME)).select("p_partkey")
    star.derived_partsupp(spark.table("lineitem"), wanted).createOrReplaceTempView("partsupp")
    return reports.select_where(spark, star.PRODUCT_PROFIT_SQL, name_like=PART_NAME)


def avg_by_key(spark: SparkSession, folder: str) -> DataFrame:
    return reports.mean_by_key(read_table(spark, folder, "part"), "p_brand", "p_retailprice", "avg_price")


def sum_by_key(spark: SparkSession, folder: str) -> DataFrame:
    return reports.sum_by_dimension(
        read_table(spark, folder, "lineitem"), "l_partkey", "l_extendedprice",
        read_table(spark, folder, "part"), "p_partkey", "p_type", "total_sales",
    )


def revenue_by_segment(spark: SparkSession, folder: str) -> DataFrame:
    return reports.count_and_sum_by_dimension(
        read_table(spark, folder, "orders"), "o_custkey", "o_totalprice",
        read_table(spark, folder, "customer"), "c_custkey", "c_mktsegment",
        "cust_count", "sales_revenue",
    )


def count_star(spark: SparkSession, folder: str) -> DataFrame:
    return reports.table_counts({t: read_table(spark, folder, t) for t in TABLES})


def select_columns(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select("p_brand", "p_retailprice")


def star_plus(spark: SparkSession, folder: str) -> DataFrame:
    return reports.with_computed(
        read_table(spark, folder, "customer"), c_next=F.col("c_acctbal") + 1, c_label=F.lower("c_mktsegment")
    )


def greater_than(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "customer").where(F.col("c_acctbal") > 0).select("c_custkey", "c_acctbal")


def greater_than_text(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "customer").filter("c_acctbal > 0").select("c_custkey", "c_acctbal")


def like_prefix(spark: SparkSession, folder: str) -> DataFrame:
    name = F.col("p_name")
    return (
        read_table(spark, folder, "part")
        .where(name.like("s%") | name.like(PART_NAME))
        .select("p_partkey", "p_name")
    )


def between_dates(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    return orders.where(F.col("o_orderdate").between("1997-01-17", "1997-01-31")).select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("o_date")
    )


def in_list_chain(spark: SparkSession, folder: str) -> DataFrame:
    """A declared source and a chain of queries over it: the richest customers of some segments."""

    def chain(source: DataFrame) -> DataFrame:
        return source.sparkSession.sql(
            """
            WITH in_credit AS (SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal FROM {source} WHERE c_acctbal > 0),
                 served AS (SELECT * FROM in_credit WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')),
                 most AS (SELECT c_nationkey, c_mktsegment, max(c_acctbal) AS top_balance, count(*) AS customers
                          FROM served GROUP BY c_nationkey, c_mktsegment)
            SELECT c_custkey, s.c_nationkey, s.c_mktsegment, c_acctbal, customers
            FROM served s JOIN most m ON s.c_nationkey = m.c_nationkey AND s.c_mktsegment = m.c_mktsegment
              AND c_acctbal = top_balance
            """,
            source=source,
        )

    model = Model("segment_customers", ["sample.customer"], chain)
    sources = {"sample.customer": read_table(spark, folder, "customer")}
    return run_models(spark, [model], sources)["segment_customers"]


def union_all(spark: SparkSession, folder: str) -> DataFrame:
    keys = read_table(spark, folder, "customer").select(F.col("c_custkey").alias("id"))
    return keys.unionAll(spark.sql("SELECT NULL AS id"))


def inline_join(spark: SparkSession, folder: str) -> DataFrame:
    """Inline rows with an untyped NULL and decimals, joined to a table."""
    feed = inline_rows(
        spark,
        "nation_feed",
        ["id", "label", "amount", "kind"],
        [
            (2, "two", Decimal("15.2"), "update"),
            (3, "", None, "delete"),
            (7, "seven", Decimal("7.7"), "insert"),
            (111, "none", Decimal("8.8"), "update"),
        ],
    )
    customer = read_table(spark, folder, "customer")
    return customer.join(feed, F.col("c_nationkey") == F.col("id")).select(
        "c_custkey", "c_nationkey", "label", F.col("amount").cast("double").alias("amount"), "kind"
    )


def dates(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").alias("o_year"),
        day_of("o_orderdate").cast("date").alias("o_day"),
    )


def epoch(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000
    return events.select(
        "event_id",
        F.date_format(epoch_to_timestamp(seconds), "yyyy-MM-dd HH:mm:ss").alias("at_second"),
    )


def strings(spark: SparkSession, folder: str) -> DataFrame:
    address = F.concat(F.lower("c_mktsegment"), F.lit("."), F.col("c_custkey"), F.lit("@example.com"))
    return read_table(spark, folder, "customer").select(
        "c_custkey",
        clean_identifier("c_name").alias("clean_name"),
        local_part(address).alias("account"),
        two_digits("c_nationkey").alias("nation_code"),
        F.lower("c_mktsegment").alias("segment"),
    )


def named_parameter(spark: SparkSession, folder: str) -> DataFrame:
    register_views(spark, folder, ["orders"])
    return reports.select_where(
        spark,
        "SELECT :year AS year_text, o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = int(:year)",
        defaults={"year": "2014"},
        year="1996",
    )


def table_parameter(spark: SparkSession, folder: str) -> DataFrame:
    register_views(spark, folder, ["supplier"])
    return reports.table_by_name(spark, "supplier")


def _model_pair(spark: SparkSession, folder: str) -> tuple[list[Model], dict[str, DataFrame]]:
    """A table model with a NULL key, and a view model that reads it with an equality filter."""

    def first(customer: DataFrame) -> DataFrame:
        return customer.select("c_custkey", "c_nationkey").unionAll(
            customer.sparkSession.sql("SELECT NULL AS c_custkey, 1 AS c_nationkey")
        )

    def second(rows: DataFrame) -> DataFrame:
        return rows.where((F.col("c_nationkey") == 1) & F.col("c_custkey").isNotNull())

    table = new_table_name("customer_keys")
    declared = {"unique": ["c_custkey"], "not_null": ["c_custkey"]}
    models = [
        Model("nation_one_customers", [table], second, **declared),
        Model(table, ["sample.customer"], first, kind="table", **declared),
    ]
    return models, run_models(spark, models, {"sample.customer": read_table(spark, folder, "customer")})


def model_chain(spark: SparkSession, folder: str) -> DataFrame:
    return _model_pair(spark, folder)[1]["nation_one_customers"]


def model_checks(spark: SparkSession, folder: str) -> DataFrame:
    """The checks declared on both models; the NULL key of the first must be reported."""
    models, built = _model_pair(spark, folder)
    return check_models(models, built).withColumn(
        "table_name", F.regexp_replace("table_name", "_[0-9a-f]{32}$", "")
    )


QUERIES = {
    "qry_product_profit": product_profit,
    "qry_product_profit_sql": product_profit_sql,
    "agg_avg_by_key": avg_by_key,
    "agg_sum_by_key": sum_by_key,
    "jon_revenue_by_segment": revenue_by_segment,
    "agg_count_star": count_star,
    "prj_select": select_columns,
    "prj_star_plus": star_plus,
    "flt_gt": greater_than,
    "flt_gt_text": greater_than_text,
    "flt_like": like_prefix,
    "flt_between": between_dates,
    "flt_in_cte": in_list_chain,
    "set_union_all": union_all,
    "src_values": inline_join,
    "fn_dates": dates,
    "fn_epoch": epoch,
    "fn_strings": strings,
    "par_named": named_parameter,
    "par_identifier": table_parameter,
    "mdl_chain": model_chain,
    "mdl_checks": model_checks,
}

_PROFIT = """
WITH red_parts AS (SELECT p_partkey FROM part WHERE p_name LIKE '%red%'),
costs AS (
  SELECT DISTINCT l_partkey, l_suppkey,
         CAST((500 + (7 * l_partkey + 13 * l_suppkey) % 1000) / 10 AS DECIMAL(12,2)) AS unit_cost
  FROM lineitem),
margins AS (
  SELECT n_name, year(o_orderdate) AS order_year,
         CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(12,2)))
           - unit_cost * CAST(l_quantity AS DECIMAL(12,2)) AS margin
  FROM lineitem
  JOIN red_parts ON p_partkey = l_partkey
  JOIN costs USING (l_partkey, l_suppkey)
  JOIN orders ON o_orderkey = l_orderkey
  JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation ON n_nationkey = s_nationkey)
SELECT n_name AS nation, CAST(order_year AS INTEGER) AS o_year, CAST(SUM(margin) AS DOUBLE) AS sum_profit
FROM margins GROUP BY n_name, order_year
"""

ORACLES = {
    "qry_product_profit": _PROFIT,
    "qry_product_profit_sql": _PROFIT,
    "agg_avg_by_key": """
        SELECT p_brand, CAST(SUM(CAST(p_retailprice AS DECIMAL(12,2))) AS DOUBLE) / COUNT(p_retailprice) AS avg_price
        FROM part GROUP BY p_brand ORDER BY p_brand""",
    "agg_sum_by_key": """
        SELECT p_type, CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS total_sales
        FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_type""",
    "jon_revenue_by_segment": """
        SELECT c_mktsegment, CAST(COUNT(o_custkey) AS BIGINT) AS cust_count,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS sales_revenue
        FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY c_mktsegment""",
    "agg_count_star": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in TABLES
    ),
    "prj_select": "SELECT p_brand, p_retailprice FROM part",
    "prj_star_plus": "SELECT *, c_acctbal + 1 AS c_next, lower(c_mktsegment) AS c_label FROM customer",
    "flt_gt": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0",
    "flt_gt_text": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0",
    "flt_like": "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 's%' OR p_name LIKE '%red%'",
    "flt_between": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_date FROM orders
        WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-17' AND TIMESTAMP '1997-01-31'""",
    "flt_in_cte": """
        SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal, customers FROM (
          SELECT *, rank() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_acctbal DESC) AS place,
                 count(*) OVER (PARTITION BY c_nationkey, c_mktsegment) AS customers
          FROM customer WHERE c_acctbal > 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY')) AS c
        WHERE place = 1""",
    "set_union_all": "SELECT c_custkey AS id FROM customer UNION ALL SELECT NULL AS id",
    "src_values": """
        SELECT c_custkey, c_nationkey, label, CAST(amount AS DOUBLE) AS amount, kind
        FROM customer JOIN (VALUES (2, 'two', 15.2, 'update'), (3, '', NULL, 'delete'), (7, 'seven', 7.7, 'insert'),
                                 (111, 'none', 8.8, 'update')) AS feed(id, label, amount, kind)
        ON c_nationkey = id""",
    "fn_dates": """
        SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS o_year,
               CAST(date_trunc('day', o_orderdate) AS DATE) AS o_day FROM orders""",
    "fn_epoch": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at_second FROM events",
    "fn_strings": """
        SELECT c_custkey, regexp_replace(c_name, '[^a-zA-Z0-9]', '_', 'g') AS clean_name,
               replace(split_part(lower(c_mktsegment) || '.' || c_custkey || '@example.com', '@', 1), '.', '_')
                 AS account,
               CASE WHEN length(CAST(c_nationkey AS VARCHAR)) >= 2 THEN CAST(c_nationkey AS VARCHAR)
                    ELSE lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END AS nation_code,
               lower(c_mktsegment) AS segment
        FROM customer""",
    "par_named": """
        SELECT '1996' AS year_text, o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1996""",
    "par_identifier": "SELECT * FROM supplier",
    "mdl_chain": """
        WITH first_model AS (
          SELECT c_custkey, c_nationkey FROM customer UNION ALL SELECT NULL, 1)
        SELECT * FROM first_model WHERE c_nationkey = 1 AND c_custkey IS NOT NULL""",
    "mdl_checks": """
        WITH first_model AS (
          SELECT c_custkey, c_nationkey FROM customer UNION ALL SELECT NULL, 1),
        second_model AS (SELECT * FROM first_model WHERE c_nationkey = 1 AND c_custkey IS NOT NULL)
        SELECT 'customer_keys' AS table_name, 'c_custkey' AS column_name, 'not_null' AS check_name,
               COUNT(*) AS failures FROM first_model WHERE c_custkey IS NULL
        UNION ALL SELECT 'nation_one_customers', 'c_custkey', 'not_null', COUNT(*)
        FROM second_model WHERE c_custkey IS NULL
        UNION ALL SELECT 'customer_keys', 'c_custkey', 'unique', COUNT(*) FROM (
          SELECT c_custkey FROM first_model WHERE c_custkey IS NOT NULL GROUP BY c_custkey HAVING COUNT(*) > 1) AS d
        UNION ALL SELECT 'nation_one_customers', 'c_custkey', 'unique', COUNT(*) FROM (
          SELECT c_custkey FROM second_model GROUP BY c_custkey HAVING COUNT(*) > 1) AS d""",
}
