"""Row changes and versions on the customer table, with fixed commit times."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators.changelog import (
    when_matched_delete,
    when_matched_update,
    when_not_matched_insert,
)
from strandline.operators.versioned import KeyViolation, SchemaMismatch, VersionedTable
from strandline.session import new_folder
from strandline.tables import read_table

CLAUSES = [
    when_matched_update("s.type = 'update'"),
    when_matched_delete("s.type = 'delete'"),
    when_not_matched_insert("s.type = 'insert'"),
]


def _day(n: int) -> datetime:
    return datetime(2024, 1, n)


def _customer(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_nationkey")


def _feed(customer: DataFrame) -> DataFrame:
    """A change feed over all customers: updates and deletes of their keys, and rows under new keys."""
    segment = F.col("c_mktsegment")
    kind = (
        F.when(segment.isin("BUILDING", "AUTOMOBILE"), "update")
        .when((segment == "HOUSEHOLD") & (F.col("c_acctbal") < 0), "delete")
        .when(segment == "FURNITURE", "insert")
    )
    new_key = segment.isin("FURNITURE", "AUTOMOBILE")
    return customer.select(
        F.when(new_key, -F.col("c_custkey") - 1).otherwise(F.col("c_custkey")).alias("c_custkey"),
        "c_name",
        (F.col("c_acctbal") * 2).alias("c_acctbal"),
        "c_mktsegment",
        "c_nationkey",
        kind.alias("type"),
    )


def _new_table(spark: SparkSession, rows: DataFrame) -> VersionedTable:
    return VersionedTable.create(spark, new_folder(spark, "customer-versions"), rows, ["c_custkey"], _day(1))


def _script(spark: SparkSession, folder: str) -> VersionedTable:
    """Versions 0 to 4: load, insert, update, delete, merge; one per day."""
    customer = _customer(spark, folder)
    late = F.col("c_mktsegment") == "MACHINERY"
    table = _new_table(spark, customer.where(~late))
    table.insert(customer.where(late), at=_day(2))
    table.update("c_name LIKE '%5'", {"c_acctbal": "c_acctbal + 1"}, at=_day(3))
    table.delete("c_acctbal > 9000", at=_day(4))
    table.merge(_feed(customer), CLAUSES, at=_day(5))
    return table


def update(spark: SparkSession, folder: str) -> DataFrame:
    table = _new_table(spark, _customer(spark, folder))
    table.update(F.col("c_name").like("%5"), {"c_acctbal": F.col("c_acctbal") + 1}, at=_day(2))
    return table.read()


def delete(spark: SparkSession, folder: str) -> DataFrame:
    table = _new_table(spark, _customer(spark, folder))
    table.delete("c_acctbal > 9000", at=_day(2))
    return table.read()


def merge(spark: SparkSession, folder: str) -> DataFrame:
    customer = _customer(spark, folder)
    table = _new_table(spark, customer)
    table.merge(_feed(customer), CLAUSES, at=_day(2))
    return table.read()


def evolve(spark: SparkSession, folder: str) -> DataFrame:
    customer = _customer(spark, folder)
    table = _new_table(spark, customer)
    fresh = customer.where("c_mktsegment = 'FURNITURE'").select(
        (-F.col("c_custkey") - 1).alias("c_custkey"), "c_name", "c_acctbal", "c_mktsegment", "c_nationkey",
        F.lit("XYZ").alias("col4"),
    )
    table.insert(fresh, evolve=True, at=_day(2))
    return table.read()


def enforce(spark: SparkSession, folder: str) -> DataFrame:
    """Writes that must be refused, each with the error it met, beside what the table holds after them."""
    customer = _customer(spark, folder)
    table = _new_table(spark, customer.where("c_mktsegment <> 'FURNITURE'"))
    fresh = customer.where("c_mktsegment = 'FURNITURE'")
    attempts = {
        "unknown column": fresh.withColumn("col4", F.lit("XYZ")),
        "wrong type": fresh.withColumn("c_acctbal", F.lit("much")),
        "missing key": fresh.drop("c_custkey"),
        "null key": fresh.withColumn("c_custkey", F.lit(None).cast("bigint")),
        "key twice": fresh.unionAll(fresh),
        "key in the table": customer,
    }
    errors = []
    for name, rows in attempts.items():
        try:
            table.insert(rows, at=_day(2))
            errors.append((name, "none"))
        except (SchemaMismatch, KeyViolation) as e:
            errors.append((name, type(e).__name__))
    refused = spark.createDataFrame(errors, "attempt string, error string")
    state = table.read().agg(F.count(F.lit(1)).alias("rows"), F.sum("c_custkey").alias("keys"))
    return refused.crossJoin(state.withColumn("version", F.lit(table.snapshot().head).cast("bigint")))


def merge_evolve(spark: SparkSession, folder: str) -> DataFrame:
    """A feed with a column that the table lacks: it is added, the feed's control column is not."""
    customer = _customer(spark, folder)
    table = _new_table(spark, customer)
    feed = _feed(customer).withColumn("rank", F.pmod("c_custkey", F.lit(7)))
    table.merge(feed, CLAUSES, at=_day(2), evolve=True, control=["type"])
    return table.read()


def as_of(spark: SparkSession, folder: str) -> DataFrame:
    return _script(spark, folder).read(version=3)


def as_of_time(spark: SparkSession, folder: str) -> DataFrame:
    return _script(spark, folder).read(as_of=datetime(2024, 1, 4, 12))


def history(spark: SparkSession, folder: str) -> DataFrame:
    return _script(spark, folder).history().withColumn("committed", F.col("committed").cast("date"))


def commit_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _script(spark, folder).commit_rows(4)


def restore(spark: SparkSession, folder: str) -> DataFrame:
    table = _script(spark, folder)
    table.restore(3, at=_day(6))
    return table.read()


def retain(spark: SparkSession, folder: str) -> DataFrame:
    """Versions before the third are folded into a base; the newest state must not change."""
    table = _script(spark, folder)
    table.retain(keep=timedelta(days=1), now=datetime(2024, 1, 5, 12), allow_short=True)
    return table.read()


def clone(spark: SparkSession, folder: str) -> DataFrame:
    """A clone of version 3 is changed; its rows and those of the untouched source."""
    table = _script(spark, folder)
    copy = table.clone(new_folder(spark, "customer-clone"), version=3, at=_day(6))
    copy.delete("c_mktsegment = 'BUILDING'", at=_day(7))
    return copy.read().select(F.lit("clone").alias("origin"), "*").unionAll(
        table.read().select(F.lit("source").alias("origin"), "*")
    )


QUERIES = {
    "dml_update": update,
    "dml_delete": delete,
    "dml_merge": merge,
    "dml_evolve": evolve,
    "dml_enforce": enforce,
    "dml_merge_evolve": merge_evolve,
    "ver_as_of": as_of,
    "ver_as_of_ts": as_of_time,
    "ver_history": history,
    "ver_commit_rows": commit_rows,
    "ver_restore": restore,
    "ver_retain": retain,
    "ver_clone": clone,
}

_V2 = """
  SELECT c_custkey, c_name, CASE WHEN c_name LIKE '%5' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
         c_mktsegment, c_nationkey FROM customer"""
_V3 = f"SELECT * FROM ({_V2}) AS v2 WHERE NOT coalesce(c_acctbal > 9000, false)"


def _after_merge(state: str) -> str:
    return f"""
  SELECT t.c_custkey, t.c_name,
         CASE WHEN s.c_mktsegment = 'BUILDING' THEN s.c_acctbal * 2 ELSE t.c_acctbal END AS c_acctbal, t.c_mktsegment,
         t.c_nationkey
  FROM ({state}) AS t JOIN customer AS s ON s.c_custkey = t.c_custkey
  WHERE NOT (s.c_mktsegment = 'HOUSEHOLD' AND s.c_acctbal < 0)
  UNION ALL
  SELECT -c_custkey - 1, c_name, c_acctbal * 2, c_mktsegment, c_nationkey
  FROM customer WHERE c_mktsegment = 'FURNITURE'"""


ORACLES = {
    "dml_update": _V2,
    "dml_delete": """
        SELECT * FROM customer WHERE NOT coalesce(c_acctbal > 9000, false)""",
    "dml_merge": _after_merge("SELECT * FROM customer"),
    "dml_evolve": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(NULL AS VARCHAR) AS col4 FROM customer
        UNION ALL SELECT -c_custkey - 1, c_name, c_nationkey, c_acctbal, c_mktsegment, 'XYZ' FROM customer
        WHERE c_mktsegment = 'FURNITURE'""",
    "dml_enforce": """
        SELECT attempt, error, rows, keys, CAST(0 AS BIGINT) AS version
        FROM (VALUES ('unknown column', 'SchemaMismatch'), ('wrong type', 'SchemaMismatch'),
                     ('missing key', 'SchemaMismatch'), ('null key', 'KeyViolation'), ('key twice', 'KeyViolation'),
                     ('key in the table', 'KeyViolation')) AS a(attempt, error),
             (SELECT COUNT(*) AS rows, CAST(SUM(c_custkey) AS BIGINT) AS keys
              FROM customer WHERE c_mktsegment <> 'FURNITURE') AS state""",
    "dml_merge_evolve": """
        SELECT t.c_custkey, t.c_name, t.c_mktsegment, t.c_nationkey,
               CASE WHEN t.c_mktsegment = 'BUILDING' THEN t.c_acctbal * 2 ELSE t.c_acctbal END AS c_acctbal,
               CASE WHEN t.c_mktsegment = 'BUILDING' THEN t.c_custkey % 7 END AS rank
        FROM customer AS t WHERE NOT (t.c_mktsegment = 'HOUSEHOLD' AND t.c_acctbal < 0)
        UNION ALL
        SELECT -c_custkey - 1, c_name, c_mktsegment, c_nationkey, c_acctbal * 2, ((-c_custkey - 1) % 7 + 7) % 7
        FROM customer WHERE c_mktsegment = 'FURNITURE'""",
    "ver_as_of": _V3,
    "ver_as_of_ts": _V3,
    "ver_history": f"""
        WITH v3 AS ({_V3}), m AS (
          SELECT s.c_mktsegment AS segment, s.c_acctbal AS feed_bal, t.c_custkey IS NOT NULL AS present
          FROM customer AS s LEFT JOIN v3 AS t ON s.c_custkey = t.c_custkey)
        SELECT CAST(0 AS BIGINT) AS _version, 'CREATE' AS operation, DATE '2024-01-01' AS committed,
               (SELECT COUNT(*) FROM customer WHERE c_mktsegment <> 'MACHINERY') AS inserted,
               CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS deleted
        UNION ALL SELECT 1, 'INSERT', DATE '2024-01-02',
               (SELECT COUNT(*) FROM customer WHERE c_mktsegment = 'MACHINERY'), 0, 0
        UNION ALL SELECT 2, 'UPDATE', DATE '2024-01-03', 0, (SELECT COUNT(*) FROM customer WHERE c_name LIKE '%5'), 0
        UNION ALL SELECT 3, 'DELETE', DATE '2024-01-04', 0, 0,
               (SELECT COUNT(*) FROM customer) - (SELECT COUNT(*) FROM v3)
        UNION ALL SELECT 4, 'MERGE', DATE '2024-01-05',
               (SELECT COUNT(*) FROM customer WHERE c_mktsegment = 'FURNITURE'),
               (SELECT COUNT(*) FROM m WHERE segment = 'BUILDING' AND present),
               (SELECT COUNT(*) FROM m WHERE segment = 'HOUSEHOLD' AND feed_bal < 0 AND present)""",
    "ver_commit_rows": f"""
        WITH v3 AS ({_V3})
        SELECT s.c_custkey, s.c_name, s.c_acctbal * 2 AS c_acctbal, s.c_mktsegment, s.c_nationkey, 'U' AS _op
        FROM customer AS s JOIN v3 AS t ON s.c_custkey = t.c_custkey WHERE s.c_mktsegment = 'BUILDING'
        UNION ALL SELECT s.c_custkey, NULL, NULL, NULL, NULL, 'D'
        FROM customer AS s JOIN v3 AS t ON s.c_custkey = t.c_custkey
        WHERE s.c_mktsegment = 'HOUSEHOLD' AND s.c_acctbal < 0
        UNION ALL SELECT -c_custkey - 1, c_name, c_acctbal * 2, c_mktsegment, c_nationkey, 'I'
        FROM customer WHERE c_mktsegment = 'FURNITURE'""",
    "ver_restore": _V3,
    "ver_retain": _after_merge(_V3),
    "ver_clone": f"""
        SELECT 'clone' AS origin, v3.* FROM ({_V3}) AS v3 WHERE NOT coalesce(c_mktsegment = 'BUILDING', false)
        UNION ALL SELECT 'source' AS origin, v4.* FROM ({_after_merge(_V3)}) AS v4""",
}
