"""Mixing sources by temperature: weights are token shares to a power found by bisection.

A power of 1 keeps the shares, 0 makes all sources equal. The weights become budgets in tokens; a
source whose budget is e times its tokens is taken floor(e) times whole, and once more as far as the
rest of the budget goes, in a random order of blocks and of documents inside a block. That order is a
hash, so "as far as" is one boundary per source: a block, and a place inside it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.shared import join_unique, settle, words

BLANK = r"[\x20\x09-\x0D]+"
BLOCK_ROWS = 1024
MOST_BLOCKS = 1 << 16  # per source; larger sources get larger blocks
EXPONENTS_AT_ONCE = 31  # as many halvings as one job makes: 5


def token_count(text: Column) -> Column:
    return F.size(words(text, BLANK)).cast("long")


def _curve(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """(entropy of the weights in nats, largest repetition if every row is used) for each exponent."""
    log_share = F.log(F.col("tokens") / F.col("all_tokens"))
    sums = []
    for i, a in enumerate(exponents):
        powered = F.exp(a * log_share)
        sums += [F.sum(powered).alias(f"z{i}"), F.sum(powered * log_share).alias(f"s{i}")]
        sums += [F.max(F.exp((a - 1) * log_share)).alias(f"most{i}"), F.min(F.exp((a - 1) * log_share)).alias(f"least{i}")]
    row = shares.agg(*sums).first()
    out = []
    for i, a in enumerate(exponents):
        entropy = math.log(row[f"z{i}"]) - a * row[f"s{i}"] / row[f"z{i}"]
        out.append((entropy, row[f"most{i}"] / row[f"least{i}"]))
    return out


def find_exponent(shares: DataFrame, *, entropy: float | None = None, repetition: float | None = None) -> float:
    """The largest exponent in [0, 1] whose entropy reaches the target, or the smallest within the limit.

    Both curves are monotone in the exponent. Each job halves the interval five times over.
    """
    low, high = 0.0, 1.0

    def flat_enough(point: tuple[float, float]) -> bool:
        return point[0] >= entropy if entropy is not None else point[1] > repetition

    (at_0, at_1) = _curve(shares, [0.0, 1.0])
    if flat_enough(at_1):
        return 1.0
    if not flat_enough(at_0):
        return 0.0
    while high - low > 1e-9:
        step = (high - low) / (EXPONENTS_AT_ONCE + 1)
        inner = [low + step * (i + 1) for i in range(EXPONENTS_AT_ONCE)]
        flat = sum(flat_enough(p) for p in _curve(shares, inner))
        low, high = low + step * flat, low + step * (flat + 1)
    return low if entropy is not None else high


def mix(
    docs: DataFrame,
    *,
    entropy_share: float | None = None,
    repetition: float | None = 2.0,
    budget: int | None = None,
    seed: int = 7,
) -> DataFrame:
    """Copies per document: all columns of ``docs`` and ``__tokens, __weight, __epochs, __copies``.

    The exponent follows from ``entropy_share`` (entropy to reach, as a share of that of equal weights)
    or else ``repetition`` (most repetitions of a source). ``budget`` is in tokens; left out, it is the
    smallest that uses every document at least once. A NULL source is a source of its own. Texts
    without tokens cost nothing and are taken as often as their place in the order says. Rows equal in
    doc_id and text are taken together. An empty table gives no rows.
    """
    at = docs.withColumns(
        {
            "__tokens": token_count(F.col("text")),
            "__order": F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")),
        }
    )
    narrow = settle(at.select(F.col("source").alias("__from"), "__tokens", "__order"), "mixing")
    sources = narrow.groupBy("__from").agg(F.sum("__tokens").alias("tokens"), F.count("*").alias("rows"))
    sources = settle(sources, "sources")
    all_rows, all_tokens, known = sources.agg(F.sum("rows"), F.sum("tokens"), F.count_if(F.col("tokens") > 0)).first()
    all_rows, all_tokens = all_rows or 0, all_tokens or 0
    shares = sources.filter("tokens > 0").withColumn("all_tokens", F.lit(float(all_tokens)))
    target = None if entropy_share is None else entropy_share * math.log(max(known or 1, 1))
    exponent = find_exponent(shares, entropy=target, repetition=repetition) if known else 1.0

    share = F.col("tokens") / F.lit(float(all_tokens or 1))
    raw = F.when(F.col("tokens") > 0, F.pow(share, F.lit(exponent))).otherwise(0.0)
    total, slowest = sources.agg(F.sum(raw), F.max(F.when(F.col("tokens") > 0, F.col("tokens") / raw))).first()
    wanted = float(budget) if budget is not None else (slowest or 0.0) * (total or 0.0)
    plan = sources.withColumn("__weight", raw / F.lit(total or 1.0)).withColumn(
        "__epochs",
        F.when(F.col("tokens") > 0, F.round(F.col("__weight") * wanted / F.col("tokens"), 9)).otherwise(1.0),
    )
    plan = plan.select(
        F.col("__from").alias("__source"), "tokens", "rows", "__weight", "__epochs",
        F.least(F.ceil(F.col("rows") / BLOCK_ROWS), F.lit(MOST_BLOCKS)).alias("blocks"),
        ((F.col("__epochs") - F.floor("__epochs")) * F.col("tokens")).alias("rest"),
    )
    plan = settle(plan, "plan")

    def block_of(order: str, blocks: str) -> Column:
        """The block's place in the permutation: a hash of its number."""
        return F.xxhash64(F.lit(seed + 1), F.col("__source"), F.pmod(F.col(order), F.col(blocks)))

    placed = join_unique(narrow, plan, {"__from": "__source"}, "rows", all_rows)
    placed = placed.withColumn("block", block_of("__order", "blocks"))
    blocks = placed.groupBy("__source", "block", "rest").agg(F.sum("__tokens").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("__source").orderBy("block"))
    edges = settle(
        blocks.withColumn("upto", upto)
        .filter(F.col("upto") > F.col("rest"))
        .groupBy("__source")
        .agg(F.min(F.struct("block", (F.col("upto") - F.col("n")).alias("taken"))).alias("edge")),
        "edges",
    ).select(F.col("__source").alias("__edge_source"), F.col("edge.block").alias("__edge"), F.col("edge.taken").alias("taken"))
    inside = placed.join(
        edges, placed["__source"].eqNullSafe(edges["__edge_source"]) & (placed["block"] == edges["__edge"])
    )
    inside = inside.groupBy("__source", "__edge", "rest", "taken", "__order").agg(F.sum("__tokens").alias("n"))
    within = F.col("taken") + F.sum("n").over(Window.partitionBy("__source").orderBy("__order"))
    last = (
        inside.withColumn("upto", within)
        .groupBy("__source", "__edge")
        .agg(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("__order"))).alias("__until"))
        .withColumnRenamed("__source", "__last_source")
    )
    cut = edges.join(last.drop("__edge"), F.col("__edge_source").eqNullSafe(F.col("__last_source")), "left")
    plan = settle(
        plan.join(cut, F.col("__source").eqNullSafe(F.col("__edge_source")), "left").select(
            "__source", F.col("blocks").alias("__blocks"), F.col("rows").alias("__rows"), "__weight", "__epochs", "__edge", "__until"
        ),
        "cuts",
    )
    full = join_unique(at, plan, {"source": "__source"}, "__rows", all_rows)
    block = block_of("__order", "__blocks")
    more = (block < F.col("__edge")) | ((block == F.col("__edge")) & (F.col("__order") <= F.col("__until")))
    # A whole number of epochs has no rest and so no further copy.
    extra = (F.col("__epochs") > F.floor("__epochs")) & F.coalesce(more, F.col("__edge").isNull())
    copies = (F.floor("__epochs") + F.when(extra, 1).otherwise(0)).cast("long")
    return full.withColumn("__copies", copies).drop("__source", "__order", "__blocks", "__rows", "__edge", "__until")


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """One row per copy, with the given columns."""
    keep = mixed.filter("__copies > 0")
    return keep.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*columns)
