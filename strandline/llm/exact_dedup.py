"""Exact duplicates by a tree of merges over sorted digest runs.

Every input partition makes one run: its digests in order, each with the row that would stay and a
count. Merging goes up a binomial tree; one exchange brings together the runs whose numbers differ in
the lowest ``bits`` bits only, and a multiway merge of the sorted runs keeps one row per digest.
A key is never larger than the number of runs it meets in an exchange, whatever its group's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.shared import join_unique, settle

BLANKS = " \t\n\x0b\x0c\r"
# Digests count as equal only if a second hash and the length of what they stand for are equal too.
IDENTITY = ["sha", "check", "bytes"]


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def digest_runs(docs: DataFrame) -> DataFrame:
    """One narrow row per document with its digest, its rank in its group and its run."""
    text = normalised(F.col("text"))
    return docs.select("doc_id", "text").select(
        "doc_id",
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha"),
        F.xxhash64(text).alias("check"),
        F.octet_length(text).alias("bytes"),
        F.length(F.coalesce("text", F.lit(""))).alias("chars"),
        F.monotonically_increasing_id().alias("tie"),
        F.spark_partition_id().alias("run"),
    )


def merge_runs(runs: DataFrame) -> DataFrame:
    """Multiway merge of the runs that have one number: equal digests leave their smallest row."""
    return (
        runs.sortWithinPartitions("run", *IDENTITY)
        .groupBy("run", *IDENTITY)
        .agg(F.min("first").alias("first"), F.sum("rows").alias("rows"))
    )


def find_duplicates(docs: DataFrame, bits: int = 4) -> DataFrame:
    """Group documents (doc_id, text) whose texts are equal without blanks.

    One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``. Of a group the row with
    the most code points stays, then the smallest doc_id (a NULL id comes last); of rows that are equal
    in both, exactly one. NULL text counts as empty, so empty and blank texts form one group. Further
    columns are not looked at. An empty table gives no rows.
    """
    rows = settle(digest_runs(docs), "digests")
    first = F.struct(-F.col("chars"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("tie"))
    runs = merge_runs(rows.select("run", *IDENTITY, first.alias("first"), F.lit(1).cast("long").alias("rows")))
    total, last = rows.agg(F.count("*"), F.max("run")).first()
    last = last or 0
    while last:
        runs, last = merge_runs(runs.withColumn("run", F.shiftright("run", bits))), last >> bits
    groups = settle(
        runs.select(
            *(F.col(c).alias(f"group_{c}") for c in IDENTITY),
            F.col("first.doc_id").alias("keep_id"),
            F.col("first.tie").alias("keep_tie"),
            F.col("rows").alias("group_size"),
        ),
        "groups",
    )
    alone = F.col("group_size") == 1
    placed = join_unique(rows, groups, {c: f"group_{c}" for c in IDENTITY}, "group_size", total)
    return placed.select(
        "doc_id",
        "keep_id",
        "group_size",
        (alone | (F.col("tie") == F.col("keep_tie"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
