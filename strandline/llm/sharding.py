"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Row numbers follow (doc_id, text checksum, size), so they depend on the rows alone. The permutation
works on the smallest grid of a x b cells that holds all numbers: rounds add a keyed hash of one
coordinate to the other, modulo a or b in turn. A number that falls outside walks on through the
permutation until it is inside. Shard and slot are remainder and quotient of the permuted number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.shared import settle

ROUNDS = 6
ROW_OVERHEAD = 16
_LOCAL = (1 << 33) - 1
ROWS_PER_RANGE = 1 << 20


def grid(rows: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(rows - 1, 0)) + 1)
    return a, max(1, -(-rows // a))


def permute(number: Column, rows: int, seed: int) -> Column:
    """A bijection of 0 .. rows - 1.

    Fewer than ``a`` cells lie outside, and no walk meets one of them twice, so it ends within that
    many steps. With more than 64 cells outside, a walk longer than 64 steps has a chance below
    a ** -64; it would stop the job with an error, not give a wrong place.
    """
    a, b = grid(rows)
    keys = F.array(*(F.lit(seed * ROUNDS + r).cast("long") for r in range(ROUNDS)))
    even = F.array(*(F.lit(r % 2 == 0) for r in range(ROUNDS)))

    def once(x: Column) -> Column:
        start = F.struct(F.floor(x / b).cast("long").alias("l"), F.pmod(x, F.lit(b)).alias("r"), F.lit(0).alias("i"))

        def turn(s: Column, key: Column) -> Column:
            left = F.pmod(s["l"] + F.pmod(F.xxhash64(s["r"], key), F.lit(a)), F.lit(a))
            right = F.pmod(s["r"] + F.pmod(F.xxhash64(s["l"], key), F.lit(b)), F.lit(b))
            flip = F.get(even, s["i"])
            return F.struct(
                F.when(flip, left).otherwise(s["l"]).cast("long").alias("l"),
                F.when(flip, s["r"]).otherwise(right).cast("long").alias("r"),
                (s["i"] + 1).alias("i"),
            )

        start = F.struct(F.expr("0L").alias("l"), F.expr("0L").alias("r"), F.lit(0).alias("i")) if rows == 0 else start
        return F.aggregate(keys, start, turn, lambda s: s["l"] * b + s["r"])

    steps = F.sequence(F.lit(1), F.lit(min(a * b - rows, 64) + 1))
    walked = F.aggregate(steps, once(number), lambda x, _: F.when(x < rows, x).otherwise(once(x)))
    return F.when(walked < rows, walked).otherwise(F.raise_error(F.lit("a walk did not end")).cast("long"))


def numbered(rows: DataFrame, order: list[str], ranges: int) -> tuple[DataFrame, int]:
    """Add ``number``, the row's place in the order, without bringing all rows together.

    A range exchange sorts; its outcome is written once, with each row's partition and place in it, so
    that repeated tasks can't change it. The scan's own row id parts equal rows, so a value in many
    rows is spread over ranges as well.
    """
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(ranges, *order, "tie").sortWithinPartitions(*order, "tie").drop("tie")
    stored = settle(ranged.withColumn("at", F.monotonically_increasing_id()), "ranges")
    stored = stored.withColumn("range", F.shiftright("at", 33))
    sizes = stored.groupBy("range").agg(F.count("*").alias("n"))
    before = sizes.select(
        F.col("range").alias("of"),
        F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
    )
    placed = stored.join(F.broadcast(before), F.col("range") == F.col("of"))  # as many rows as ranges
    number = F.col("before") + F.col("at").bitwiseAND(F.lit(_LOCAL))
    return placed.withColumn("number", number).drop("at", "range", "of", "before"), stored.count()


def shard(docs: DataFrame, shards: int = 40, seed: int = 20_240_601) -> DataFrame:
    """Deal documents (doc_id, text) to shards of equal row counts, in a reproducible random order.

    One row per input row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``. Counts of shards
    differ by one at most (law ``rows``); slots have no gaps from 0. The same rows always get the same
    places, however they are stored; rows equal in doc_id and text are interchangeable. NULL ids come
    first in the numbering, NULL text has size 16 and checksum 0, an empty table gives no rows, and
    further columns are not looked at. ``grown_shard`` is NULL: under this law a further shard moves
    rows between all shards.
    """
    narrow = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_OVERHEAD).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-docs.select("doc_id").count() // ROWS_PER_RANGE))
    rows, total = numbered(narrow, ["doc_id", "text_crc32", "size"], ranges)
    place = permute(F.col("number"), total, seed)
    return rows.withColumn("place", place).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("place") / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
