"""Replacing a whole result from a micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strandline.sources.tables import quoted


def publish(df: DataFrame, name: str, slot: str) -> None:
    """Write a new copy, then point ``name`` at it: readers see the old rows or the new ones.

    ``name`` is a catalog view over the files. Unlike a table whose location is altered, no
    session keeps an old file list for it.
    """
    df.write.mode("overwrite").parquet(slot)
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {quoted(name)} AS SELECT * FROM parquet.{quoted(slot, False)}")


def live_folder(spark: SparkSession, name: str) -> str | None:
    """The folder that a published name shows now."""
    if not spark.catalog.tableExists(name):
        return None
    details = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:name)", args={"name": name})
    text = details.where("col_name = 'View Text'").select("data_type").first()
    return text and text[0].partition("`")[2].rpartition("`")[0].replace("``", "`")


def republish(df: DataFrame, name: str, path: str) -> None:
    """Replace what ``name`` shows, writing to the one of two folders that it does not show now.

    Which folder that is follows from the name itself and not from a batch number, so a batch that
    is repeated, or breaks off, after the switch does not touch what readers look at.
    """
    slots = [f"{path}/slot=0", f"{path}/slot=1"]
    publish(df, name, slots[1] if live_folder(df.sparkSession, name) == slots[0] else slots[0])


def complete_publisher(name: str, path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that replaces what ``name`` shows with each batch."""

    def replace(batch: DataFrame, batch_id: int) -> None:
        republish(batch, name, path)

    return replace
