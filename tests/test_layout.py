from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandline import sinks
from strandline.operators import layout
from strandline.operators.versioned import VersionedTable
from strandline.queries import layout as queries


def multiset(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def small_files(spark, folder):
    rows = spark.range(6000).select(
        ((F.col("id") * 7919) % 6000).alias("a"),
        ((F.col("id") * 104729) % 6000).alias("b"),
        F.concat(F.lit("n"), F.col("id")).alias("name"),
    )
    rows.repartition(60).write.parquet(f"{folder}/small")
    return f"{folder}/small"


def test_compaction_keeps_rows_and_packs_files(spark, folder, small_files):
    before = spark.read.parquet(small_files)
    total = layout.dataset_bytes(spark, small_files)
    after = layout.compact(spark, small_files, f"{folder}/packed", target_bytes=total // 2 + 4096)
    files = layout.file_stats(after).collect()
    assert layout.file_stats(before).count() == 60
    assert len(files) == 2 and sum(f.rows for f in files) == 6000
    assert multiset(after) == multiset(before)


def test_compaction_puts_settings_back(spark, folder, small_files):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    layout.compact(spark, small_files, f"{folder}/packed")
    assert spark.conf.get(key) == before
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def touched(df, column, value):
    stats = layout.file_stats(df, [column])
    return stats.where(F.lit(value).between(F.col(f"min_{column}"), F.col(f"max_{column}"))).count()


def test_clustering_lets_filters_on_both_columns_skip_files(spark, folder, small_files):
    before = spark.read.parquet(small_files)
    after = layout.cluster(spark, small_files, f"{folder}/clustered", ["a", "b"], files=16)
    assert multiset(after) == multiset(before)
    assert layout.file_stats(after).count() == 16
    for column in ("a", "b"):
        assert touched(before, column, 1234) > 50
        assert touched(after, column, 1234) <= 8


def test_a_value_in_a_third_of_the_rows_is_spread_over_files(spark, folder):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("a"))
    rows.write.parquet(f"{folder}/hot")
    after = layout.cluster(spark, f"{folder}/hot", f"{folder}/clustered", ["a"], files=12)
    assert multiset(after) == multiset(rows)
    assert max(r.rows for r in layout.file_stats(after).collect()) < 1500


def test_clustering_on_text_times_and_nulls(spark, folder):
    rows = spark.range(2000).select(
        F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("s"),
        F.when(F.col("id") % 5 > 0, F.timestamp_seconds(F.col("id") * 86400)).alias("t"),
        F.lit(None).cast("double").alias("nothing"),
    ).withColumns({"n": F.col("t").cast("timestamp_ntz"), "d": F.col("t").cast("date")})
    rows.write.parquet(f"{folder}/mixed")
    after = layout.cluster(spark, f"{folder}/mixed", f"{folder}/by", ["s", "t", "n", "d", "nothing"], files=8, bits=4)
    assert multiset(after) == multiset(rows)
    assert touched(after, "s", "k0500") <= 4
    with pytest.raises(TypeError):
        layout.with_clustering_order(rows.withColumn("flag", F.lit(True)), ["flag"], 4)


def test_one_text_column_is_clustered_by_its_whole_text(spark, folder):
    rows = spark.range(8000).select(
        F.concat(F.lit("Customer#"), F.lpad(((F.col("id") * 7919) % 8000).cast("string"), 9, "0")).alias("name"), "id"
    )
    rows.repartition(8).write.parquet(f"{folder}/names")
    after = layout.cluster(spark, f"{folder}/names", f"{folder}/by", ["name"], files=16)
    assert multiset(after) == multiset(rows) and layout.file_stats(after).count() == 16
    assert max(touched(after, "name", f"Customer#{n:09}") for n in (0, 17, 4000, 7999)) <= 2
    both = layout.cluster(spark, f"{folder}/names", f"{folder}/both", ["name", "id"], files=16)
    assert max(touched(both, "name", f"Customer#{n:09}") for n in (17, 4000)) <= 8


def test_many_files_are_told_apart(spark, folder):
    spark.range(20_000).select(((F.col("id") * 7919) % 20_000).alias("a")).write.parquet(f"{folder}/n")
    after = layout.cluster(spark, f"{folder}/n", f"{folder}/by", ["a"], files=256)
    assert layout.file_stats(after).count() > 200
    assert max(touched(after, "a", n) for n in (0, 1234, 9999, 19_999)) <= 2


def test_partitioned_datasets_stay_partitioned(spark, folder):
    rows = spark.range(3000).select("id", (F.col("id") % 7).alias("v"), F.concat(F.lit("p "), F.col("id") % 3).alias("p"))
    rows.repartition(9).write.partitionBy("p").parquet(f"{folder}/parts")
    assert layout.partition_columns(spark, f"{folder}/parts") == ["p"]
    packed = layout.compact(spark, f"{folder}/parts", f"{folder}/packed")
    by = layout.cluster(spark, f"{folder}/parts", f"{folder}/by", ["id"], files=6)
    sinks.copy_dataset(spark, f"{folder}/parts", f"{folder}/copy")
    copied = spark.read.parquet(f"{folder}/copy")
    for df, name in ((packed, "packed"), (by, "by"), (copied, "copy")):
        assert multiset(df.select("id", "v", "p")) == multiset(rows)
        assert layout.partition_columns(spark, f"{folder}/{name}") == ["p"]
    assert layout.file_stats(packed).count() == 3
    assert touched(by.where("p = 'p 1'"), "id", 1000) <= 2


def test_keyed_tables_are_compacted_and_clustered(spark, folder):
    rows = spark.range(4000).select("id", ((F.col("id") * 7919) % 4000).alias("a"), F.lit("x").alias("s"))
    table = VersionedTable.create(spark, folder, rows.repartition(20), ["id"])
    table.update("id % 10 = 0", {"s": "'y'"})
    before = multiset(table.read())
    assert table.details().first().files > 20
    table.compact()
    found = table.details().first()
    assert (found.files, found.version, found.keys) == (1, 1, "id") and found.bytes > 0 and "a:bigint" in found.columns
    table.compact(target_bytes=found.bytes // 8, cluster_by=["a"])
    assert table.details().first().files >= 8 and touched(table.read(), "a", 1234) <= 2
    assert multiset(table.read()) == before == multiset(table.read(version=1))
    assert multiset(table.read(version=0)) == multiset(rows)
    table.delete("id = 1")
    assert table.read().count() == 3999


def test_only_small_files_are_packed(spark, folder):
    spark.range(100_000).coalesce(1).write.parquet(f"{folder}/d")
    for i in range(9):
        spark.range(100_000 + i * 100, 100_100 + i * 100).coalesce(1).write.mode("append").parquet(f"{folder}/d")
    before = layout.list_files(spark, f"{folder}/d")
    full = before.orderBy(F.desc("bytes")).first()
    after = layout.compact_small(spark, before, f"{folder}/1", target_bytes=full.bytes)
    assert after.count() == 2 and full.path in {r.path for r in after.collect()}
    assert multiset(layout.read_files(spark, after)) == multiset(spark.range(100_900))
    assert layout.open_list(spark, f"{folder}/1").count() == 2
    # one small file alone stays; with a further one it is packed again, and the full one still stays
    again = layout.compact_small(spark, after, f"{folder}/2", target_bytes=full.bytes)
    assert multiset(again.drop("root")) == multiset(after.drop("root"))
    spark.range(100_900, 101_000).coalesce(1).write.parquet(f"{folder}/new")
    more = again.unionByName(layout.list_files(spark, f"{folder}/new"))
    third = layout.compact_small(spark, more, f"{folder}/3", target_bytes=full.bytes)
    assert third.count() == 2 and full.path in {r.path for r in third.collect()}
    assert multiset(layout.read_files(spark, third)) == multiset(spark.range(101_000))


def test_small_files_are_packed_by_partition(spark, folder):
    rows = spark.range(3000).select("id", (F.col("id") % 3).alias("p"))
    rows.repartition(8).write.partitionBy("p").parquet(f"{folder}/my parts")
    after = layout.compact_small(spark, layout.list_files(spark, f"{folder}/my parts"), f"{folder}/packed")
    assert after.count() == 3 and multiset(layout.read_files(spark, after).select("id", "p")) == multiset(rows)


def test_crowded_ranges():
    ranges = [("a", 0, 10), ("b", 5, 15), ("c", 15, 20), ("d", 7, 8), ("e", 30, 40), ("same", 6, 6), ("empty", None, None)]
    assert layout.crowded(ranges, 2) == ["a", "b", "d"]
    assert layout.crowded(ranges, 1) == ["a", "b", "c", "d"]
    assert layout.crowded(ranges, 3) == [] == layout.crowded([], 0)
    assert set(layout.crowded([("x", "a", "m"), ("y", "k", "z"), ("z", "zz", "zzz")], 1)) == {"x", "y"}


def test_only_files_that_overlap_are_sorted_again(spark, folder):
    def add(low, high, step=1, files=1):
        spark.range(low, high, step).repartitionByRange(files, "id").sortWithinPartitions("id").write.mode("append").parquet(f"{folder}/d")

    add(0, 8000, 1, 8)
    add(100, 900, 5)
    add(50, 1500, 7)
    before = layout.list_files(spark, f"{folder}/d")
    after = layout.recluster(spark, before, f"{folder}/1", "id", files=2)
    stayed = before.join(after, ["path"], "left_semi")
    assert stayed.count() == 7  # of the eight sorted ones, all that two late files do not both reach
    rows = layout.read_files(spark, after)
    assert multiset(rows) == multiset(spark.read.parquet(f"{folder}/d")) and touched(rows, "id", 700) <= 2
    again = layout.recluster(spark, after, f"{folder}/2", "id", files=2)
    assert multiset(again.select("path")) == multiset(after.select("path"))


def test_a_value_that_fills_files_is_not_sorted_again(spark, folder):
    rows = spark.range(4000).select(F.when(F.col("id") < 3000, 7).otherwise(F.col("id")).alias("v"), "id")
    rows.repartition(6).write.parquet(f"{folder}/d")
    after = layout.recluster(spark, layout.list_files(spark, f"{folder}/d"), f"{folder}/1", "v", files=6)
    again = layout.recluster(spark, after, f"{folder}/2", "v", files=6)
    assert multiset(again.select("path")) == multiset(after.select("path"))
    assert multiset(layout.read_files(spark, again)) == multiset(rows)


def test_ranges_come_from_footers(spark, folder, small_files):
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    found = layout.dataset_ranges(spark, small_files, ["a", "b"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(a), MAX(a), MIN(b), MAX(b)]" in plan or "PushedAggregation: [COUNT(*)" in plan
    assert tuple(found.first()) == (6000, 0, 5999, 0, 5999)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    text = layout.dataset_ranges(spark, small_files, ["name"])  # scanned
    assert tuple(text.first()) == (6000, "n0", "n999")


def test_interleaved_bits(spark):
    df = spark.createDataFrame([(5, 3)], "x int, y int")  # 101 and 011
    assert df.select(layout.interleave([F.col("x"), F.col("y")], 3)).first()[0] == 0b100111


def test_statistics_of_the_whole_dataset(spark, small_files):
    df = spark.read.parquet(small_files)
    row = layout.folded_stats(layout.file_stats(df, ["a"]), ["a"]).first()
    assert (row.files, row.rows, row.min_a, row.max_a) == (60, 6000, 0, 5999)
    assert row.bytes == layout.dataset_bytes(spark, small_files)


@pytest.fixture
def lineitem(spark, folder, monkeypatch):
    """A table of about three times the size of a file, and a way to the folders a query makes."""
    columns = "l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus".split()
    rows = spark.range(40_000).select(
        (F.col("id") / 4).cast("long").alias("l_orderkey"),
        (F.col("id") % 4 + 1).cast("int").alias("l_linenumber"),
        *(F.xxhash64("id", F.lit(c)).alias(c) for c in columns),
        F.lit("1995-01-01").alias("l_shipdate"),
    )
    rows.repartition(8).write.parquet(f"{folder}/lineitem.parquet")
    made = {}
    monkeypatch.setattr(queries, "new_folder", lambda spark, label: made.setdefault(label, f"{folder}/{label}"))
    monkeypatch.setattr(layout, "TARGET_BYTES", layout.dataset_bytes(spark, f"{folder}/lineitem.parquet") // 3 + 1)
    return folder, made


def test_a_large_table_has_one_full_file_of_bounded_size(spark, lineitem, monkeypatch):
    folder, made = lineitem
    monkeypatch.setattr(layout, "TARGET_BYTES", 4 * layout.TARGET_BYTES)
    out = queries.compacted_small(spark, folder)
    written = layout.file_stats(spark.read.parquet(made["lineitem-mixed"])).collect()
    packed = layout.file_stats(spark.read.parquet(made["lineitem-packed"] + "/data")).collect()
    assert len(written) == 1 + 16 + 8 * 3
    assert max(f.rows for f in written) < 40_000 / 3 and max(f.rows for f in packed) < 40_000 / 3
    assert out.select("files_left", "few_files").distinct().collect() == [(1, True)]
    assert multiset(out.drop("files_left", "few_files", "l_shipdate")) == multiset(
        spark.read.parquet(f"{folder}/lineitem.parquet").select(*out.drop("files_left", "few_files", "l_shipdate").columns)
    )


def test_a_large_table_is_sorted_in_files_of_bounded_size(spark, lineitem):
    folder, made = lineitem
    out = queries.reclustered(spark, folder)
    written = layout.file_stats(spark.read.parquet(made["lineitem-sorted"])).collect()
    anew = layout.file_stats(spark.read.parquet(made["lineitem-reclustered"] + "/data")).collect()
    assert len(written) == 3 * 11 and len(anew) == 3 * 4
    assert max(f.rows for f in written + anew) < 2 * 40_000 / (3 * 10)
    assert out.select("upper_stayed", "sorted").distinct().collect() == [(True, True)]
    assert multiset(out.drop("upper_stayed", "sorted", "l_shipdate")) == multiset(
        spark.read.parquet(f"{folder}/lineitem.parquet").select(*out.drop("upper_stayed", "sorted", "l_shipdate").columns)
    )
