"""Sources and sinks: the given tables are written in each form and read back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline import sinks, sources
from strandline.operators import checks
from strandline.session import new_folder, new_table_name
from strandline.tables import read_table

PART_FIELDS = {
    "p_partkey": "bigint", "p_brand": "string", "p_name": "string", "p_type": "string", "p_size": "int",
    "p_retailprice": "double",
}


def _part(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part")


def _write_csv(df: DataFrame, label: str, sep: str = ",") -> str:
    path = new_folder(df.sparkSession, label)
    df.write.option("header", True).option("sep", sep).csv(path)
    return path


def csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    return sources.read_csv(spark, _write_csv(_part(spark, folder), "part-csv"), infer=True).select(
        F.col("p_partkey").cast("bigint").alias("p_partkey"),
        "p_name", "p_brand", "p_type", "p_size", "p_retailprice",
    )


def csv_strings(spark: SparkSession, folder: str) -> DataFrame:
    """All text; the price is cast back, as systems print doubles differently."""
    rows = sources.read_csv(spark, _write_csv(_part(spark, folder), "part-text"))
    return rows.withColumn("p_retailprice", F.col("p_retailprice").cast("double"))


def csv_table(spark: SparkSession, folder: str) -> DataFrame:
    rows = sources.csv_table(spark, new_table_name("part_csv"), _write_csv(_part(spark, folder), "part-table"))
    return rows.withColumn("p_retailprice", F.col("p_retailprice").cast("double"))


def csv_schema(spark: SparkSession, folder: str) -> DataFrame:
    lookup = read_table(spark, folder, "customer").withColumnsRenamed({"c_custkey": "mrn", "c_name": "name"})
    schema = "mrn STRING, name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    return sources.read_csv(spark, _write_csv(lookup, "patients"), schema=schema)


def delimited(spark: SparkSession, folder: str) -> DataFrame:
    path = _write_csv(_part(spark, folder), "part-delimited", sep="\x01")
    return sources.read_delimited(
        spark, path,
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    )


def fixed_width(spark: SparkSession, folder: str) -> DataFrame:
    """Written right-aligned in columns as wide as their longest value."""
    path = new_folder(spark, "part-fixed")
    part = _part(spark, folder)
    longest = part.agg(*[F.max(F.length(F.col(c).cast("string"))).alias(c) for c in PART_FIELDS]).first()
    layout = [(c, longest[c] or 1, kind) for c, kind in PART_FIELDS.items()]
    line = F.concat(*[F.lpad(F.col(c).cast("string"), width, " ") for c, width, _ in layout])
    part.select(line.alias("value")).write.text(path)
    return sources.read_fixed_width(spark, path, layout)


def json_path(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "customer-json")
    read_table(spark, folder, "customer").write.json(path)
    return sources.read_by_path(spark, "json", path).select(
        "c_custkey", "c_name", F.col("c_nationkey").cast("int").alias("c_nationkey"), "c_acctbal", "c_mktsegment"
    )


def schema_hints(spark: SparkSession, folder: str) -> DataFrame:
    """All columns text but the hinted one; what does not fit the hint becomes NULL."""
    path = new_folder(spark, "readings-json")
    reading = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    read_table(spark, folder, "events").select(
        "event_id", "ts", F.col("user_id").alias("mrn"), "event_type", reading.alias("value"), "props"
    ).write.options(**sinks.WHOLE_TIMES).json(path)
    columns = ["event_id", "ts", "mrn", "event_type", "value", "props"]
    rows = sources.read_hinted(spark, path, columns, {"value": "double"})
    return rows.withColumn("ts", F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def external_table(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "supplier-external")
    read_table(spark, folder, "supplier").write.parquet(path)
    return sources.external_table(spark, new_table_name("supplier_external"), path)


def parquet_path(spark: SparkSession, folder: str) -> DataFrame:
    orders = sources.read_by_path(spark, "parquet", f"{folder.rstrip('/')}/orders.parquet")
    return orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority",
    )


def append(spark: SparkSession, folder: str) -> DataFrame:
    """A typed table filled by two inserts from queries and one of literals, counted per task."""
    table = new_table_name("task_log")
    sinks.create_table(spark, table, "task STRING, run_time TIMESTAMP", new_folder(spark, "task-log"))
    orders = read_table(spark, folder, "orders")
    first = orders.select(F.col("o_orderpriority").alias("task"), F.current_timestamp().alias("run_time"))
    second = orders.select(F.col("o_orderstatus").alias("task"), F.current_timestamp().alias("run_time"))
    sinks.append_rows(first, table)
    sinks.append_rows(second, table)
    now = datetime.now()
    sinks.insert_values(spark, table, [("literal", now), (None, now)])
    sinks.append_audit_row(spark, table, "Task #2")
    return spark.table(table).groupBy("task").agg(F.count(F.lit(1)).alias("n"))


def create_as(spark: SparkSession, folder: str) -> DataFrame:
    table = sinks.replace_table(
        sinks.with_load_time(read_table(spark, folder, "customer")),
        new_table_name("customer_loaded"),
        new_folder(spark, "customer-loaded"),
    )
    return table.where(F.col("updated").isNotNull()).drop("updated")


def copy(spark: SparkSession, folder: str) -> DataFrame:
    target = new_folder(spark, "lineitem-copy")
    sinks.copy_dataset(spark, f"{folder.rstrip('/')}/lineitem.parquet", target)
    return spark.read.parquet(target).withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


def copy_diff(spark: SparkSession, folder: str) -> DataFrame:
    """A right copy has no differences; one with rows changed, lost and doubled in one stretch of orders has just these."""
    source = read_table(spark, folder, "lineitem")
    target, spoilt = new_folder(spark, "lineitem-copy"), new_folder(spark, "lineitem-spoilt")
    sinks.copy_dataset(spark, f"{folder.rstrip('/')}/lineitem.parquet", target)
    right = spark.read.parquet(target)
    stretch = F.col("l_orderkey").between(100, 300)
    changed = F.when(stretch & (F.col("l_orderkey") % 7 == 0), F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    rows = right.where(~(stretch & (F.col("l_orderkey") % 11 == 0))).withColumn("l_quantity", changed)
    rows.unionAll(rows.where(stretch & (F.col("l_orderkey") % 13 == 0))).write.parquet(spoilt)
    found = sinks.differences(source, spark.read.parquet(spoilt), "l_orderkey")
    none = sinks.differences(source, right, "l_orderkey").select(F.lit("right").alias("of"), "*")
    both = none.unionAll(found.select(F.lit("spoilt").alias("of"), "*"))
    return both.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


def all_null_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Three dirty rows added to a table: how many there are, and what is left without them."""
    dirty = sinks.append_null_rows(read_table(spark, folder, "customer"), 3)
    total = dirty.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("c_custkey").isNull()).alias("null_keys")
    ).select(F.lit("with").alias("null_rows"), "row_count", "null_keys")
    clean = checks.drop_all_null_rows(dirty).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("c_custkey").isNull()).alias("null_keys")
    ).select(F.lit("without").alias("null_rows"), "row_count", "null_keys")
    only = checks.all_null_rows(dirty).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("c_custkey").isNull()).alias("null_keys")
    ).select(F.lit("only").alias("null_rows"), "row_count", "null_keys")
    return total.unionAll(clean).unionAll(only)


QUERIES = {
    "src_csv_inferred": csv_inferred,
    "src_csv_strings": csv_strings,
    "src_csv_table": csv_table,
    "src_csv_schema": csv_schema,
    "src_delimited": delimited,
    "src_fixed_width": fixed_width,
    "src_json_path": json_path,
    "src_schema_hints": schema_hints,
    "src_external_table": external_table,
    "src_parquet": parquet_path,
    "snk_append": append,
    "snk_ctas": create_as,
    "snk_copy": copy,
    "snk_copy_diff": copy_diff,
    "dq_all_null_rows": all_null_rows,
}

_LINE = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate"
)

ORACLES = {
    "src_csv_inferred": "SELECT * FROM part",
    "src_csv_strings": """
        SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size,
               p_retailprice FROM part""",
    "src_csv_table": """
        SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size,
               p_retailprice FROM part""",
    "src_csv_schema": """
        SELECT CAST(c_custkey AS VARCHAR) AS mrn, c_name AS name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
    "src_delimited": "SELECT * FROM part",
    "src_fixed_width": "SELECT * FROM part",
    "src_json_path": "SELECT * FROM customer",
    "src_schema_hints": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
               CAST(user_id AS VARCHAR) AS mrn, event_type, props,
               TRY_CAST(CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS value
        FROM events""",
    "src_external_table": "SELECT * FROM supplier",
    "src_parquet": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
               o_orderpriority FROM orders""",
    "snk_append": """
        SELECT task, COUNT(*) AS n FROM (
          SELECT o_orderpriority AS task FROM orders UNION ALL SELECT o_orderstatus FROM orders
          UNION ALL SELECT 'literal' UNION ALL SELECT NULL UNION ALL SELECT 'From Task #2') AS log
        GROUP BY task""",
    "snk_ctas": "SELECT * FROM customer",
    "snk_copy": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
               l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem""",
    "snk_copy_diff": f"""
        WITH s AS (SELECT {_LINE}, l_orderkey BETWEEN 100 AND 300 AS stretch FROM lineitem),
        k AS (SELECT * REPLACE (CASE WHEN stretch AND l_orderkey % 7 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity)
              FROM s WHERE NOT (stretch AND l_orderkey % 11 = 0)),
        b AS (SELECT *, 1 AS i, 0 AS o FROM s UNION ALL SELECT *, 0, 1 FROM k
              UNION ALL SELECT *, 0, 1 FROM k WHERE stretch AND l_orderkey % 13 = 0)
        SELECT 'spoilt' AS of, {_LINE}, CAST(SUM(i) AS BIGINT) AS n_source, CAST(SUM(o) AS BIGINT) AS n_copy
        FROM b GROUP BY ALL HAVING SUM(i) <> SUM(o)""",
    "dq_all_null_rows": """
        SELECT 'with' AS null_rows, COUNT(*) + 3 AS row_count, CAST(3 AS BIGINT) AS null_keys FROM customer
        UNION ALL SELECT 'without', COUNT(*), CAST(0 AS BIGINT) FROM customer
        UNION ALL SELECT 'only', CAST(3 AS BIGINT), CAST(3 AS BIGINT)""",
}
