"""The given tables, and how large they are."""

from __future__ import annotations

import contextlib
import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.session import settings

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, folder: str, names: list[str] | None = None) -> None:
    for name in names or TABLES:
        read_table(spark, folder, name).createOrReplaceTempView(name)


def dataset_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size from a listing; the ``content`` column is not selected, so no file is opened."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return listing.agg(F.sum("length")).first()[0] or 0


# A shuffle partition should hold about this much of the data read.
PARTITION_BYTES = 128 * 1024 * 1024
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def plan_bytes(df: DataFrame) -> int:
    """How much the plan reads, by the sizes Spark knows of its files and local rows; other inputs count as none."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    return sum(n for n in sizes if n < 1 << 62)  # an input of unknown size gives the largest number


def partitions_for(spark: SparkSession, read_bytes: int) -> int:
    """How many partitions shuffles should start with for so much data; never less than is configured.

    AQE can merge partitions that turn out small, but not add any.
    """
    configured = spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")
    return max(math.ceil(read_bytes / PARTITION_BYTES), int(configured))


@contextlib.contextmanager
def sized_shuffles(df: DataFrame) -> Iterator[int]:
    """Inside the block, actions on ``df`` start their shuffles with enough partitions for what it reads.

    The setting is put back at the end, so the block has to enclose the action.
    """
    spark = df.sparkSession
    count = partitions_for(spark, plan_bytes(df))
    with settings(spark, {INITIAL_PARTITIONS: str(count)}):
        yield count
