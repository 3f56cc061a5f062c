"""File layout: file statistics, compaction and clustering. Sources are left as they are."""

from __future__ import annotations

import math
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.session import settings
from strandline.tables import dataset_bytes, sized_shuffles

TARGET_BYTES = 128 * 1024 * 1024


def file_stats(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """One row per data file: bytes, rows, and the range of each given column.

    ``df`` must come straight from files. A task reads whole files or splits of one, so
    almost everything is aggregated before the shuffle.
    """
    ranges = []
    for c in columns:
        ranges += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return (
        df.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        .groupBy("file")
        .agg(F.max("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"), *ranges)
    )


def folded_stats(stats: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """File statistics folded to one row for the dataset."""
    ranges = []
    for c in columns:
        ranges += [F.min(f"min_{c}").alias(f"min_{c}"), F.max(f"max_{c}").alias(f"max_{c}")]
    return stats.agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), *ranges
    )


def partition_columns(spark: SparkSession, source: str) -> list[str]:
    """The columns a dataset's folders are named after, outermost first; from the path of one file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    first = files.where(F.col("path").endswith(".parquet")).select("path").first()
    known = spark.read.parquet(source).columns
    folders = [] if first is None else first.path.split("/")[:-1]
    names = [unquote(f.partition("=")[0]) for f in folders if "=" in f]
    return [n for n in names if n in known]


def write_like(rows: DataFrame, target: str, partitions: Sequence[str]) -> None:
    """Write rows under the given partition columns, each partition in files of the size Spark aims for."""
    if not partitions:
        rows.write.parquet(target)
        return
    gathered = rows.hint("rebalance", *partitions)  # splits large partitions, which a plain shuffle would not
    gathered.write.partitionBy(*partitions).parquet(target)


def compact(spark: SparkSession, source: str, target: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Rewrite a dataset into files of about ``target_bytes``; a partitioned one stays partitioned.

    Without partition columns there is no shuffle: the scan itself packs small files into read tasks
    of the wanted size, and each task writes one file. With them, rows are gathered by partition.
    """
    partitions = partition_columns(spark, source)
    packing = {
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
    }
    with settings(spark, packing):
        rows = spark.read.parquet(source)
        with sized_shuffles(rows):
            write_like(rows, target, partitions)
    return spark.read.schema(rows.schema).parquet(target)


def interleave(buckets: Sequence[Column], bits: int) -> Column:
    """The bits of all bucket numbers, taken in turn."""
    out = F.lit(0).cast("bigint")
    width = len(buckets)
    for i, bucket in enumerate(buckets):
        for bit in range(bits):
            one = F.shiftright(bucket, bit).bitwiseAND(F.lit(1)).cast("bigint")
            out = out.bitwiseOR(F.shiftleft(one, bit * width + (width - 1 - i)))
    return out


# Cell limits come from a sample of about this many rows; they only decide how even the files are.
SAMPLE_ROWS = 100_000
MOST_BITS = 12


def cell_limits(df: DataFrame, columns: Sequence[str], bits: int) -> dict[str, list]:
    """For each column ``2**bits - 1`` values that cut a sample into equal shares, in the column's own order."""
    for c in columns:
        kind = df.schema[c].dataType
        if not isinstance(kind, (T.StringType, T.TimestampType, T.TimestampNTZType, T.DateType, T.NumericType)):
            raise TypeError(f"cannot cluster on {c}: {kind.simpleString()}")
    rows = df.select(*columns)
    share = min(1.0, SAMPLE_ROWS / max(rows.count(), 1))
    sample = (rows if share == 1.0 else rows.sample(share, seed=11)).limit(2 * SAMPLE_ROWS).collect()
    cells = 2**bits
    out = {}
    for c in columns:
        values = [r[c] for r in sample if r[c] is not None and r[c] == r[c]]  # NaN, the largest, needs no limit
        text = isinstance(df.schema[c].dataType, T.StringType)
        values.sort(key=(lambda v: v.encode()) if text else None)  # text is ordered by its bytes
        out[c] = [values[len(values) * i // cells] for i in range(1, cells)] if values else []
    return out


def cell(df: DataFrame, column: str, limits: Sequence, bits: int) -> Column:
    """How many limits a value has reached: a binary search, one step per bit. NULL is in the first cell."""
    kind = df.schema[column].dataType
    bounds = F.array(*(F.lit(v).cast(kind) for v in limits))
    value = F.col(column)

    def step(low: Column, jump: Column) -> Column:
        return F.when(value >= F.get(bounds, low + jump - 1), low + jump).otherwise(low)

    jumps = F.array(*(F.lit(1 << k) for k in reversed(range(bits))))
    return F.aggregate(jumps, F.lit(0), step)


def with_clustering_order(df: DataFrame, columns: Sequence[str], bits: int, name: str = "_order") -> DataFrame:
    """The frame plus a sort key that keeps rows near each other in all columns close together."""
    if bits * len(columns) > 62:
        raise ValueError("too many bits for one sort key")
    limits = {c: v for c, v in cell_limits(df, columns, bits).items() if v}  # a column without values orders nothing
    if not limits:
        return df.withColumn(name, F.lit(0).cast("bigint"))
    cells = {f"_cell{i}": cell(df, c, v, bits) for i, (c, v) in enumerate(limits.items())}
    placed = df.withColumns(cells)
    return placed.withColumn(name, interleave([F.col(c) for c in cells], bits)).drop(*cells)


def cluster(
    spark: SparkSession,
    source: str,
    target: str,
    columns: Sequence[str],
    target_bytes: int = TARGET_BYTES,
    files: int | None = None,
    bits: int | None = None,
) -> DataFrame:
    """Rewrite a dataset so that filters on any of the columns touch few files.

    One column is simply sorted by. Several are cut into cells, ``bits`` halvings of each column, as
    many as the files need, and sorted by the interleaved cell numbers and by the values inside a cell.
    The range shuffle has a last, random column: a value shared by a large part of the rows is spread
    over as many files as it needs. A partitioned dataset stays partitioned: its files are dealt out
    among the partitions and sorted inside each.
    """
    partitions = partition_columns(spark, source)
    rows = spark.read.parquet(source)
    n = files or max(1, math.ceil(dataset_bytes(spark, source) / target_bytes))
    ordered = rows.withColumn("_spread", F.rand(7))
    order = [*partitions]
    if len(columns) > 1:
        halvings = bits or min(MOST_BITS, max(1, math.ceil(math.log2(n))))
        ordered = with_clustering_order(rows, columns, halvings).withColumn("_spread", F.rand(7))
        order.append("_order")
    order += [c for c in columns if c not in partitions]
    writer = (
        ordered.repartitionByRange(n, *order, "_spread").sortWithinPartitions(*order).drop("_order", "_spread").write
    )
    (writer.partitionBy(*partitions) if partitions else writer).parquet(target)
    return spark.read.schema(rows.schema).parquet(target)


# -- layout of part of a dataset: files that are as they should be stay where they are ------------------------


def list_files(spark: SparkSession, source: str) -> DataFrame:
    """The data files of a dataset: path, bytes, the root that partition folders count from, and the URI rows know them by."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    found = found.select("path", F.col("length").alias("bytes"), F.lit(source).alias("root"), F.col("_metadata.file_path").alias("uri"))
    return found.where(F.col("path").endswith(".parquet"))


def read_files(spark: SparkSession, listing: DataFrame) -> DataFrame:
    """The rows of the listed files; names of files reach the driver, as with any listing that Spark makes.

    Without partition folders all files make one scan, which packs small ones together wherever they lie.
    """
    roots: dict[str, list[str]] = {}
    for row in listing.select("root", "path").orderBy("root", "path").toLocalIterator():
        roots.setdefault(row.root, []).append(row.path)
    if not any(partition_columns(spark, root) for root in roots):
        roots = {"": [p for paths in roots.values() for p in paths]} if roots else {}
    out = None
    for root, paths in roots.items():
        reader = spark.read.option("basePath", root) if root else spark.read
        rows = reader.parquet(*paths)
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        raise ValueError("no files are listed")
    return out


def save_list(listing: DataFrame, folder: str) -> DataFrame:
    """Write a listing down and go on from there."""
    listing.coalesce(1).write.parquet(f"{folder}/files")
    return open_list(listing.sparkSession, folder)


def open_list(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("path string, bytes bigint, root string, uri string").parquet(f"{folder}/files")


def _listed_partitions(spark: SparkSession, listing: DataFrame) -> list[str]:
    roots = [r.root for r in listing.select("root").distinct().collect()]
    return max((partition_columns(spark, r) for r in roots), key=len, default=[])


def compact_small(
    spark: SparkSession, listing: DataFrame, target: str, target_bytes: int = TARGET_BYTES, full: float = 0.75
) -> DataFrame:
    """Rewrite files of less than ``full`` of the wanted size into files of that size; returns the new listing.

    Full files stay where they are and are not opened, so the cost grows with what has come in since the last time
    and not with the dataset. Small files are packed by the scan, largest first, without a shuffle; those of a
    partitioned dataset by partition. A single small file (per dataset) is left alone: rewriting it gains nothing.
    The new files go to ``target/data``, the listing to ``target/files``; nothing is deleted.
    """
    small = listing.where(F.col("bytes") < int(full * target_bytes))
    if small.count() < 2:
        return save_list(listing, target)
    packing = {
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
    }
    partitions = _listed_partitions(spark, listing)
    with settings(spark, packing):
        rows = read_files(spark, small)
        with sized_shuffles(rows):
            write_like(rows, f"{target}/data", partitions)
    stay = listing.join(small.select("uri"), "uri", "left_anti").select(*listing.columns)
    return save_list(stay.unionByName(list_files(spark, f"{target}/data")), target)


def crowded(ranges: list[tuple], most_depth: int) -> list:
    """Which of (name, low, high) overlap so that more than ``most_depth`` cover one point. A sweep over the ends.

    Ranges of a single value can't become narrower and neither count nor are named; nor do empty ones (NULL).
    """
    wide = [r for r in ranges if r[1] is not None and r[1] != r[2]]
    points = sorted({x for _, low, high in wide for x in (low, high)})
    place = {x: i for i, x in enumerate(points)}
    change = [0] * (len(points) + 1)
    for _, low, high in wide:
        change[place[low]] += 1
        change[place[high] + 1] -= 1
    depth, deep = 0, [0]  # deep[i]: how many of the first i points lie too deep
    for i in range(len(points)):
        depth += change[i]
        deep.append(deep[-1] + (depth > most_depth))
    return [name for name, low, high in wide if deep[place[high] + 1] > deep[place[low]]]


def recluster(
    spark: SparkSession,
    listing: DataFrame,
    target: str,
    column: str,
    target_bytes: int = TARGET_BYTES,
    most_depth: int = 2,
    files: int | None = None,
) -> DataFrame:
    """Sort by ``column`` only the files whose ranges overlap too deeply; returns the new listing.

    Each file's range is read from the column alone; the ranges, a row per file, are swept on the driver. What is
    sorted already, or was by an earlier call, stays where it is. A value that fills whole files is spread over as
    many as it needs. Where new data falls everywhere, everything overlaps and all of it is rewritten.
    """
    stats = file_stats(read_files(spark, listing).select(column, "_metadata"), [column])
    ranges = [(r.file, r[f"min_{column}"], r[f"max_{column}"]) for r in stats.drop("bytes", "rows").collect()]
    deep = crowded(ranges, most_depth)
    if not deep:
        return save_list(listing, target)
    mark = spark.createDataFrame([(u,) for u in deep], "uri string")
    moved = listing.join(mark, "uri", "left_semi").select(*listing.columns)
    rows = read_files(spark, moved)
    partitions = _listed_partitions(spark, listing)
    n = files or max(1, math.ceil(moved.agg(F.sum("bytes")).first()[0] / target_bytes))
    order = [*partitions, column]
    ordered = rows.withColumn("_spread", F.rand(7)).repartitionByRange(n, *order, "_spread")
    writer = ordered.sortWithinPartitions(*order).drop("_spread").write
    (writer.partitionBy(*partitions) if partitions else writer).parquet(f"{target}/data")
    stay = listing.join(mark, "uri", "left_anti").select(*listing.columns)
    return save_list(stay.unionByName(list_files(spark, f"{target}/data")), target)


# Readers of this kind can answer counts and ranges from the footers of the files.
FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def dataset_ranges(spark: SparkSession, source: str, columns: Sequence[str] = ()) -> DataFrame:
    """One row for a dataset: rows, and the range of each given column, from the footers of its files.

    No row is read for numbers, booleans and dates; for other kinds, whose footers may hold cut-off values, Spark
    scans the columns. The frame keeps its way of reading, whatever the session is set to afterwards.
    """
    ranges = []
    for c in columns:
        ranges += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    with settings(spark, FOOTERS):
        rows = spark.read.parquet(source)
        out = rows.agg(F.count(F.lit(1)).alias("rows"), *ranges)
        out._jdf.queryExecution().optimizedPlan()  # decided here and now
    return out
