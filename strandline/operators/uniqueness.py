"""Uniqueness of a table that grows: only what is new is read, against a register of the keys met so far."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators.changelog import when_matched_update, when_not_matched_insert
from strandline.operators.versioned import VersionedTable

REGISTER = "digest binary, n bigint"


def key_digest(*columns: Column | str) -> Column:
    """32 bytes that tell values apart, and a text from the same text split otherwise over columns."""
    return F.unhex(F.sha2(F.to_json(F.struct(*columns)), 256))


def open_register(spark: SparkSession, path: str) -> VersionedTable:
    """The register at ``path``, made if absent: how often each key was met, by its digest."""
    table = VersionedTable(spark, path)
    try:
        table.snapshot()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return VersionedTable.create(spark, path, spark.createDataFrame([], REGISTER), ["digest"])
    return table


def register_keys(
    register: VersionedTable, rows: DataFrame, columns: list[str], name: str, batch: int, fold_share: float = 0.5
) -> DataFrame:
    """Take new rows into the register; returns their keys that are not unique, with their count over all batches.

    Each key is reduced to a digest and a count before anything is shuffled to meet the register, whose base lies in
    buckets once it is large and is then read without a shuffle; the table's older rows are never read. Rows with a NULL in
    a key column are left out, as by ``not_unique``. A batch is known by ``name`` and number; one that is repeated is
    not counted twice and gives the same answer, as long as no later one was taken in.
    """
    spark = register.spark
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull()
    counts = rows.where(whole).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("digest", key_digest(*columns))
    staged = f"{register.path}/staged/slot={batch % 2}"
    counts.write.mode("overwrite").parquet(staged)
    counts = spark.read.schema(counts.schema).parquet(staged)
    clauses = [when_matched_update(values={"n": "t.n + s.n"}), when_not_matched_insert()]
    register.merge(counts.select("digest", "n"), clauses, stream=name, batch=batch, check_keys=False)
    register.fold_if_changed(fold_share)
    known = register.read(only=counts).where("n > 1")
    return counts.drop("n").join(known, "digest").select(*columns, "n")
