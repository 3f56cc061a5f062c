"""Benchmark items inside documents: size-partitioned MinHash containment search.

The sketch of an item is its smallest shingle hashes, the bottom of one MinHash permutation. Items are
partitioned by size, and the partition's upper bound u fixes the sketch size k = floor((1 - t) u) + m.
Of an item with q shingles a document of containment t or more misses at most floor((1 - t) q), so it
holds at least m of the k; a document that holds fewer, or has fewer shingles than the item needs, is
out. No containing document can be lost that way, however long it is. What is left is verified with
the shingles themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.shared import NO_WORD, checked_broadcast, settle, text_hash, words

WORDS = 5
PER_CENT = 80  # containment from which a document counts as contaminated
REQUIRED = 2  # m: sketch values that a containing document holds for certain (fewer for tiny items)


def normal_words(text: Column) -> Column:
    return words(F.lower(text), NO_WORD)


def with_shingles(texts: DataFrame, *, hashed: bool, short: Sequence[int] | None = None) -> DataFrame:
    """Replace ``text`` by ``shingles``, the distinct runs of five words, as text or as hashes.

    An item of fewer words is one shingle, an empty one has none. A document has the runs of each length in ``short``
    besides, so that such items are found wherever they stand in it. Words and their hashes are columns of their
    own first: inside the function over positions they would be made again for each position.
    """
    others = [c for c in texts.columns if c != "text"]
    texts = texts.select(*others, normal_words(F.col("text")).alias("words"))
    if hashed:
        texts = texts.withColumn("words", F.transform("words", lambda w: F.xxhash64(w)))
    none = F.array().cast(f"array<{'bigint' if hashed else 'string'}>")

    def runs(length: int) -> Column:
        starts = F.sequence(F.lit(0), F.size("words") - length)
        if hashed:
            found = F.transform(starts, lambda i: F.xxhash64(*(F.get("words", i + j) for j in range(length))))
        else:
            found = F.transform(starts, lambda i: F.concat_ws(" ", F.slice("words", i + 1, length)))
        return F.when(F.size("words") >= length, found).otherwise(none)

    if short is None:
        found = none
        for n in range(1, WORDS + 1):
            found = F.when(F.size("words") >= n, runs(n)).otherwise(found)
    else:
        found = F.concat(runs(WORDS), *(runs(n) for n in short))
    return texts.select(*others, F.array_distinct(found).alias("shingles"))


def _missing(n: Column) -> Column:
    """How many of n shingles may be absent; whole numbers, so that no rounding decides."""
    return n - _present(n)


def _present(n: Column) -> Column:
    return F.ceil(n * PER_CENT / 100.0 - 1e-9).cast("int")


def sketches(items: DataFrame) -> DataFrame:
    """``item_id, q, needed, hash``: the bottom of each item, as long as its size partition asks."""
    hashed = settle(with_shingles(items, hashed=True).select("item_id", F.sort_array("shingles").alias("hashes")), "items-hashed")
    sized = hashed.select("item_id", "hashes", F.size("hashes").alias("q")).filter("q > 0")
    upper = F.pow(F.lit(2), F.floor(F.log2("q")) + 1).cast("int") - 1
    sized = sized.withColumn("k", F.least(F.col("q"), _missing(upper) + REQUIRED))
    needed = F.greatest(F.lit(1), F.col("k") - _missing(F.col("q")))
    return sized.select(
        "item_id", "q", needed.alias("needed"), F.explode(F.slice("hashes", F.lit(1), F.col("k"))).alias("hash")
    )


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Items (item_id, text) of which a document (doc_id, text) holds at least 80 % of the shingles.

    One row per document and item: ``doc_id, text_hash, item_id, n_shingles`` (of the item)``, n_common,
    containment``. Words are runs of letters and digits in lower case; shingles are five words. An item of
    fewer words is one shingle, and held by every document in which its words stand in a row. Texts without words, and
    NULL, hold nothing and are held by nothing. Rows equal in doc_id and text count once, as do items equal in id and text; further columns
    are not looked at; either table may be empty.
    """
    docs = docs.select("doc_id", "text").withColumn("text_hash", text_hash(F.col("text")))
    items = settle(items.select("item_id", "text").filter(F.col("text").isNotNull()).distinct(), "items")
    sketch = settle(sketches(items), "item-sketches")
    lengths = items.select(F.size(normal_words(F.col("text"))).alias("n")).filter(F.col("n").between(1, WORDS - 1))
    short = sorted(r.n for r in lengths.distinct().collect())  # four at most, none where all items are longer
    hashed = with_shingles(docs, hashed=True, short=short)
    hashed = hashed.select("doc_id", "text_hash", F.size("shingles").alias("size"), F.explode_outer("shingles").alias("hash"))
    met = hashed.join(checked_broadcast(sketch), "hash").filter(F.col("size") >= _present(F.col("q")))
    # Each (document, item) meets at most k sketch values, and they are added up before the exchange.
    held = met.groupBy("doc_id", "text_hash", "item_id", "needed").agg(F.count_distinct("hash").alias("held"))
    candidates = settle(held.filter(F.col("held") >= F.col("needed")).select("doc_id", "text_hash", "item_id"), "candidates")

    wanted = settle(candidates.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("h")).distinct(), "suspects")
    suspects = docs.join(
        checked_broadcast(wanted), docs["doc_id"].eqNullSafe(wanted["id"]) & (docs["text_hash"] == wanted["h"]), "left_semi"
    )
    in_docs = with_shingles(suspects, hashed=False, short=short).select(
        F.col("doc_id").alias("id"), F.col("text_hash").alias("h"), F.explode_outer("shingles").alias("shingle")
    )
    item_shingles = with_shingles(items, hashed=False).select(
        "item_id", F.size("shingles").alias("n_shingles"), F.explode_outer("shingles").alias("shingle")
    )
    item_shingles = settle(item_shingles, "item-shingles")
    shared = in_docs.join(checked_broadcast(item_shingles), "shingle")
    pairs = shared.join(
        candidates,
        shared["id"].eqNullSafe(candidates["doc_id"])
        & (shared["h"] == candidates["text_hash"])
        & shared["item_id"].eqNullSafe(candidates["item_id"]),
        "left_semi",
    )
    counted = pairs.groupBy(F.col("id").alias("doc_id"), F.col("h").alias("text_hash"), "item_id", "n_shingles")
    verified = counted.agg(F.count_distinct("shingle").cast("int").alias("n_common"))
    verified = verified.filter(F.col("n_common") >= _present(F.col("n_shingles")))
    return verified.withColumn("containment", F.col("n_common") / F.col("n_shingles"))
