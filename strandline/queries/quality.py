"""Data checks on the customer and events tables, with faults put in by condition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import day_of
from strandline.operators import checks, uniqueness
from strandline.session import new_folder
from strandline.tables import read_table


def _faulty(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of one segment twice, keys of another missing."""
    customer = read_table(spark, folder, "customer")
    key = F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_custkey")).alias("c_custkey")
    rows = customer.select(key, "c_name", "c_mktsegment")
    return rows.unionAll(rows.where("c_mktsegment = 'BUILDING'"))


def unique(spark: SparkSession, folder: str) -> DataFrame:
    return checks.not_unique(_faulty(spark, folder), "c_custkey")


def not_null(spark: SparkSession, folder: str) -> DataFrame:
    return checks.is_null(_faulty(spark, folder), "c_custkey")


def summary(spark: SparkSession, folder: str) -> DataFrame:
    return checks.failures(
        _faulty(spark, folder), "customer", unique=["c_custkey", "c_name"], not_null=["c_custkey", "c_name"]
    )


def profile(spark: SparkSession, folder: str) -> DataFrame:
    """With the sketch of distinct values; 5 % of standard error are its nature, so 20 % off is a failure."""
    customer = read_table(spark, folder, "customer")
    out = checks.profile(customer)
    exact = customer.agg(*[F.count_distinct(c).alias(c) for c in customer.columns])
    exact = exact.unpivot([], [F.col(c) for c in customer.columns], "column_name", "values")
    near = F.abs(F.col("approx_distinct") - F.col("values")) <= 0.2 * F.col("values")
    return out.join(exact, "column_name").select(
        *(c for c in out.columns if c not in ("mean", "approx_distinct")),
        F.round("mean", 6).alias("mean"), "values", near.alias("near"),
    )


def daily_profile(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    columns = ["event_id", "user_id", "event_type", "value", "props"]
    day = day_of("ts").cast("date")
    out = checks.profile(events, columns, by=day)
    exact = events.groupBy(day.alias("grp")).agg(*[F.count_distinct(c).alias(c) for c in columns])
    exact = exact.unpivot("grp", [F.col(c) for c in columns], "column_name", "values")
    near = F.abs(F.col("approx_distinct") - F.col("values")) <= 0.2 * F.col("values")
    out = out.join(exact, ["grp", "column_name"]).withColumn("near", near)
    return out.withColumn("mean", F.round("mean", 6)).drop("approx_distinct")


DRIFT_COLUMNS = ["event_type", "user_id", "value"]
DRIFT_LIMITS = {"value": [5, 20, 50, 100, 200], "user_id": [3, 10, 40, 100, 1000]}


def _exact_drift(events: DataFrame, column: str) -> DataFrame:
    """What ``drift`` estimates, counted: distinct values, those shared with the day before, and the largest shift."""
    limits = DRIFT_LIMITS.get(column, [])
    shares = [F.avg((F.col(column) <= x).cast("int")).alias(f"s{i}") for i, x in enumerate(limits)]
    daily = events.groupBy("day").agg(F.count_distinct(column).alias("distinct_values"), *shares)
    values = events.select("day", F.col(column).alias("v")).where("v IS NOT NULL").distinct()
    later = values.select(F.date_add("day", 1).alias("day"), "v")
    common = values.join(later, ["day", "v"]).groupBy("day").agg(F.count(F.lit(1)).alias("common"))
    old = daily.select(
        F.date_add("day", 1).alias("day"), F.col("distinct_values").alias("old"), *(F.col(f"s{i}").alias(f"o{i}") for i in range(len(limits)))
    )
    both = daily.join(old, "day", "left").join(common, "day", "left")
    moved = F.greatest(*(F.abs(F.col(f"s{i}") - F.col(f"o{i}")) for i in range(len(limits)))) if limits else F.lit(None).cast("double")
    shared = F.coalesce("common", F.lit(0)) / (F.col("distinct_values") + F.col("old") - F.coalesce("common", F.lit(0)))
    return both.select("day", F.lit(column).alias("column_name"), "distinct_values", shared.alias("shared"), moved.alias("moved"))


def drift(spark: SparkSession, folder: str) -> DataFrame:
    """Days compared by sketches of two loads that are kept and merged; exact figures beside what the sketches say.

    Distinct values and shared ones are right to 5 %, distances to 0.03.
    """
    events = read_table(spark, folder, "events").withColumn("day", day_of("ts").cast("date"))
    kept = new_folder(spark, "sketches")
    for load in (0, 1):
        part = events.where(F.pmod("event_id", F.lit(2)) == load)
        checks.sketches(part, DRIFT_COLUMNS, F.col("day")).write.mode("append").parquet(kept)
    out = checks.drift(checks.merged_sketches(spark.read.parquet(kept)), DRIFT_LIMITS)
    exact = None
    for c in DRIFT_COLUMNS:
        one = _exact_drift(events, c)
        exact = one if exact is None else exact.unionByName(one)
    found = out.withColumnRenamed("grp", "day").join(exact, ["day", "column_name"])

    def close(a: str, b: str, slack: Column) -> Column:
        return F.coalesce(F.abs(F.col(a) - F.col(b)) <= slack, F.col(a).isNull() & F.col(b).isNull())

    return found.select(
        "day", "column_name", "rows", "nulls", "distinct_values", F.round("shared", 6).alias("shared"), F.round("moved", 6).alias("moved"),
        close("approx_distinct", "distinct_values", 0.05 * F.col("distinct_values")).alias("near_distinct"),
        close("overlap", "shared", F.lit(0.05)).alias("near_shared"),
        close("distance", "moved", F.lit(0.03)).alias("near_moved"),
    )


def unique_new(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads of orders, checked as they come: customers that ordered twice in all, as the second load tells."""
    orders = read_table(spark, folder, "orders")
    register = uniqueness.open_register(spark, new_folder(spark, "register"))
    second = F.pmod("o_orderkey", F.lit(3)) == 0
    uniqueness.register_keys(register, orders.where(~second), ["o_custkey"], "orders", 0)
    return uniqueness.register_keys(register, orders.where(second), ["o_custkey"], "orders", 1)


QUERIES = {
    "dq_unique": unique,
    "dq_not_null": not_null,
    "dq_checks": summary,
    "dq_profile": profile,
    "dq_profile_daily": daily_profile,
    "dq_drift": drift,
    "dq_unique_new": unique_new,
}

_FAULTY = """
  WITH single AS (
    SELECT CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_custkey END AS c_custkey, c_name, c_mktsegment FROM customer),
  faulty AS (SELECT * FROM single UNION ALL SELECT * FROM single WHERE c_mktsegment = 'BUILDING')"""


def _duplicates(column: str) -> str:
    return f"(SELECT {column} FROM faulty WHERE {column} IS NOT NULL GROUP BY {column} HAVING COUNT(*) > 1)"


def _profile(table: str, column: str, kind: str, by: str = "", distinct: bool = False) -> str:
    """``kind``: whole numbers, other numbers or text."""
    number, whole = kind != "text", kind == "whole"

    def given(expression: str, type_: str, holds: bool) -> str:
        return f"CAST({expression} AS {type_})" if holds else f"CAST(NULL AS {type_})"

    extra = f", COUNT(DISTINCT {column}) AS values, true AS near" if distinct else ""
    return f"""SELECT {f"{by} AS grp, " if by else ""}'{column}' AS column_name, COUNT(*) AS rows,
        COUNT(*) - COUNT({column}) AS nulls,
        {given(f"MIN({column})", "DOUBLE", number)} AS min_number, {given(f"MAX({column})", "DOUBLE", number)} AS max_number,
        {given(f"MIN({column})", "DECIMAL(38,10)", whole)} AS min_exact,
        {given(f"MAX({column})", "DECIMAL(38,10)", whole)} AS max_exact,
        {given(f"round(AVG({column}), 6)", "DOUBLE", number)} AS mean,
        {given(f"MIN({column})", "VARCHAR", not number)} AS min_text,
        {given(f"MAX({column})", "VARCHAR", not number)} AS max_text{extra}
        FROM {table}{f" GROUP BY {by}" if by else ""}"""


def _drift(column: str) -> str:
    limits = DRIFT_LIMITS.get(column, [])
    shares = "".join(f", AVG(CASE WHEN {column} <= {x} THEN 1.0 WHEN {column} > {x} THEN 0.0 END) AS s{i}" for i, x in enumerate(limits))
    moved = f"greatest({', '.join(f'abs(d.s{i} - o.s{i})' for i in range(len(limits)))})" if limits else "CAST(NULL AS DOUBLE)"
    shared = "coalesce(n, 0) / (d.distinct_values + o.distinct_values - coalesce(n, 0))"
    return f"""SELECT * FROM (
        WITH e AS (SELECT CAST(ts AS DATE) AS day, {column} FROM events),
        d AS (SELECT day, COUNT(*) AS rows, COUNT(*) - COUNT({column}) AS nulls, COUNT(DISTINCT {column}) AS distinct_values{shares}
              FROM e GROUP BY day),
        c AS (SELECT day, COUNT(*) AS n FROM (SELECT DISTINCT a.day, a.{column} FROM e a JOIN e b
              ON a.day = b.day + 1 AND a.{column} = b.{column}) GROUP BY day)
        SELECT d.day, '{column}' AS column_name, d.rows, d.nulls, d.distinct_values, CASE WHEN o.day IS NOT NULL THEN round({shared}, 6) END AS shared,
               CASE WHEN o.day IS NOT NULL THEN round({moved}, 6) END AS moved, true AS near_distinct, true AS near_shared, true AS near_moved
        FROM d LEFT JOIN d o ON d.day = o.day + 1 LEFT JOIN c ON d.day = c.day)"""


_CUSTOMER = {"c_custkey": "whole", "c_name": "text", "c_nationkey": "whole", "c_acctbal": "number", "c_mktsegment": "text"}
_EVENTS = {"event_id": "whole", "user_id": "whole", "event_type": "text", "value": "number", "props": "text"}

ORACLES = {
    "dq_unique": f"{_FAULTY} SELECT c_custkey, COUNT(*) AS n FROM faulty WHERE c_custkey IS NOT NULL "
    "GROUP BY c_custkey HAVING COUNT(*) > 1",
    "dq_not_null": f"{_FAULTY} SELECT * FROM faulty WHERE c_custkey IS NULL",
    "dq_checks": f"""{_FAULTY}
        SELECT 'customer' AS table_name, 'c_custkey' AS column_name, 'unique' AS check_name, COUNT(*) AS failures
        FROM {_duplicates("c_custkey")} AS d
        UNION ALL SELECT 'customer', 'c_name', 'unique', COUNT(*) FROM {_duplicates("c_name")} AS d
        UNION ALL SELECT 'customer', 'c_custkey', 'not_null', COUNT(*) FROM faulty WHERE c_custkey IS NULL
        UNION ALL SELECT 'customer', 'c_name', 'not_null', COUNT(*) FROM faulty WHERE c_name IS NULL""",
    "dq_profile": " UNION ALL ".join(_profile("customer", c, k, distinct=True) for c, k in _CUSTOMER.items()),
    "dq_profile_daily": " UNION ALL ".join(_profile("events", c, k, by="CAST(ts AS DATE)", distinct=True) for c, k in _EVENTS.items()),
    "dq_drift": " UNION ALL ".join(_drift(c) for c in DRIFT_COLUMNS),
    "dq_unique_new": """
        SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey
        HAVING COUNT(*) > 1 AND COUNT(*) FILTER (o_orderkey % 3 = 0) > 0""",
}
