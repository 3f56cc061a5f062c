"""Phrase collocations from a suffix tree that is cut off at a few words and built in independent groups.

1. Words are counted per language. Only phrases of frequent words can be frequent themselves, so every other word
   ends a suffix. Frequent words are known to the scanning tasks by a bitmap of fixed size over a hash; a word let
   through by chance costs time and changes nothing, because its count is still its own.
2. Vertical partitioning: prefixes of one word are hashed into SLOTS, whose occurrences are known from step 1.
   Slots are packed into groups of at most BUDGET occurrences. A slot above that is extended: its suffixes are told
   apart by two words, in as many parts as it has budgets.
3. A scan cuts every suffix off after the longest phrase and sends it to the group of its prefix, counted within
   portions of the scan. Parts that are still over the budget, by one very common pair of words, are cut up.
4. Each group sorts its suffixes, which gives its subtree: a node is a run of equal first words, its count is the
   sum of its leaves. Nodes that more than one group holds a share of are added up afterwards.
5. Counts of the parts of a phrase are nodes as well, so scores come from joins of nodes.

No task holds more than a portion of the scan (PORTION words and one text) or a group (about BUDGET suffixes); the
driver holds SLOTS sums and the bitmap, whatever the size of the input. Products are exact in 38 digits, enough for
counts to 10^15.

NULL and empty texts have no words, a NULL language is ``und``. Repeated rows count each time. Other columns are not
looked at. An empty table gives an empty one.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.shared import settle

SLOT_BITS, MAP_BITS = 16, 25
SLOTS = 1 << SLOT_BITS
PORTION = 1 << 20  # words of a scan counted at once
BUDGET = 1 << 20  # suffixes of a group
SHARES = 32  # of a language, ranked by themselves before all are
NO_LANGUAGE = "und"
# A-Z become lower case, what ends a piece a comma, a tab a blank.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else 44 if c in b".,;:!?" or 10 <= c <= 13 else 32 if c == 9 else c for c in range(256))
_END = b","


def tokens(body: bytes) -> list[bytes]:
    """The words in order; a comma stands for the end of a piece."""
    parts = body.translate(_TABLE).replace(_END, b" , ").split(b" ")
    return [p for p in parts if p]


def hash_of(language: str, word: bytes) -> int:
    return zlib.crc32(language.encode() + b"\n" + word)


class Portions:
    """Gathers a task's words by language, as numbers of the words met; 0 ends a piece."""

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, dict[bytes, int]] = defaultdict(lambda: {_END: 0})
        self.held: dict[str, list[np.ndarray]] = defaultdict(list)
        self.size = 0

    def read(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
        """(language, words by number, numbers in a row) for each portion; a very long text goes through in cuts."""
        for batch in batches:
            for language, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                found = tokens(text.as_buffer().to_pybytes()) if text.is_valid else []
                number = self.number[language]
                for word in set(found).difference(number):
                    number[word] = len(number)
                self.held[language].append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
                self.held[language].append(np.zeros(1, np.int32))
                self.size += len(found) + 1
                if self.size >= PORTION:
                    yield from self.flush()
        yield from self.flush()

    def flush(self) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
        for language, parts in self.held.items():
            yield language, list(self.number[language]), np.concatenate(parts)
        self.forget()


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for language, words, numbers in Portions().read(batches):
        counts = np.bincount(numbers, minlength=len(words))[1:]
        met = [w.decode() for w in words[1:]]
        slots = [hash_of(language, w) for w in words[1:]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([language] * len(met), pa.string()), pa.array(met, pa.string()), pa.array(slots, pa.int64()), pa.array(counts, pa.int64())],
            ["lang", "word", "hash", "f"],
        )


class Groups:
    """Which group a prefix belongs to: the slots in groups, and the parts of each group."""

    def __init__(self, sums: np.ndarray):
        self.parts = np.maximum(1, -(-sums // BUDGET))
        self.group = np.empty(SLOTS, np.int64)
        held, number = 0, 0
        for slot in np.argsort(-sums, kind="stable"):
            if held and held + sums[slot] > BUDGET:
                held, number = 0, number + 1
            self.group[slot] = number
            held += int(sums[slot])


def distinct_rows(columns: list[np.ndarray], span: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of one of each different row, how many rows are equal to it)."""
    key, room = columns[0].astype(np.int64), span
    for c in columns[1:]:
        if room >= (1 << 62) // span:
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
            room = int(key.max(initial=0)) + 1
        key, room = key * span + c, room * span
    _, at, counts = np.unique(key, return_index=True, return_counts=True)
    return at, counts


def send_suffixes(frequent: np.ndarray, groups: Groups, depth: int):
    """A function for mapInArrow: one row per portion, language, group and part, with its suffixes and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for language, words, numbers in Portions().read(batches):
            hashes = np.array([0, *(hash_of(language, w) for w in words[1:])], np.int64)
            known = (frequent[(hashes % (1 << MAP_BITS)) >> 3] >> (hashes & 7).astype(np.uint8)) & 1 == 1
            known[0] = False
            numbers = np.concatenate([np.where(known[numbers], numbers, 0), np.zeros(depth, np.int32)])
            starts = np.flatnonzero(numbers[: len(numbers) - depth])
            columns = [numbers[starts]]
            for d in range(1, depth):
                columns.append(np.where(columns[-1] > 0, numbers[starts + d], 0))
            at, counts = distinct_rows(columns, len(words))
            suffixes = np.stack([c[at] for c in columns], axis=1)
            slot = hashes[suffixes[:, 0]] >> (32 - SLOT_BITS)
            parts, group = groups.parts[slot], groups.group[slot]
            second = hashes[suffixes[:, 1]] if depth > 1 else 0
            part = np.where(parts > 1, (hashes[suffixes[:, 0]] * 31 + second * 2654435761) % (2**31 - 1) % parts, 0)
            order = np.lexsort((part, group))
            ends = np.flatnonzero((np.diff(group[order]) != 0) | (np.diff(part[order]) != 0)) + 1
            out: dict[str, list] = {c: [] for c in ("grp", "part", "parts", "entries", "words", "suffixes", "counts")}
            for rows in np.split(order, ends):
                if not len(rows):
                    continue
                local, inverse = np.unique(suffixes[rows], return_inverse=True)
                inverse = inverse.reshape(-1, depth)
                if local[0]:  # 0 stays the number of no word
                    local, inverse = np.concatenate([[0], local]), inverse + 1
                out["grp"].append(int(group[rows[0]]))
                out["part"].append(int(part[rows[0]]))
                out["parts"].append(int(parts[rows[0]]))
                out["entries"].append(len(rows))
                out["words"].append(b"\n".join(words[i] for i in local[1:]))
                out["suffixes"].append(inverse.astype(np.uint16 if len(local) < 1 << 16 else np.int32).tobytes())
                out["counts"].append(counts[rows].astype(np.int32).tobytes())
            kinds = [pa.int64()] * 4 + [pa.binary()] * 3
            arrays = [pa.array(v, t) for v, t in zip(out.values(), kinds)]
            yield pa.RecordBatch.from_arrays([pa.array([language] * len(arrays[0]), pa.string()), *arrays], ["lang", *out])

    return run


def subtree(depth: int, least: int):
    """A function for applyInArrow: the nodes of one group, with those below ``least`` left out where they are whole."""

    def run(table: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {b"": 0}
        rows, weights = [], []
        for words, suffixes, counts, entries in zip(*(table[c].to_pylist() for c in ("words", "suffixes", "counts", "entries"))):
            place = np.array([0, *(number.setdefault(w, len(number)) for w in words.split(b"\n"))])
            width = np.uint16 if len(suffixes) == 2 * entries * depth else np.int32
            rows.append(place[np.frombuffer(suffixes, width)].reshape(-1, depth))
            weights.append(np.frombuffer(counts, np.int32).astype(np.int64))
        suffixes, weight = np.concatenate(rows), np.concatenate(weights)
        order = np.lexsort(suffixes.T[::-1])
        suffixes, weight = suffixes[order], weight[order]
        new = np.zeros(len(order), bool)
        new[:1] = True
        names = list(number)
        # With parts, a prefix of one word has a share in each; cut up, so has every node.
        whole_from = 1 if table["parts"][0].as_py() == 1 else 2 if table["cuts"][0].as_py() == 1 else depth + 1
        phrases, sizes, totals = [], [], []
        for d in range(depth):
            new[1:] |= suffixes[1:, d] != suffixes[:-1, d]
            starts = np.flatnonzero(new)
            sums = np.add.reduceat(weight, starts)
            keep = suffixes[starts, d] > 0
            if d + 1 >= whole_from:
                keep &= sums >= least
            for start in starts[keep]:
                phrases.append(b" ".join(names[i] for i in suffixes[start, : d + 1]).decode())
            sizes.append(np.full(keep.sum(), d + 1))
            totals.append(sums[keep])
        langs = pa.array([table["lang"][0].as_py()] * len(phrases), pa.string())
        return pa.table({"lang": langs, "phrase": pa.array(phrases, pa.string()), "size": pa.array(np.concatenate(sizes), pa.int32()), "f": pa.array(np.concatenate(totals), pa.int64())})

    return run


def count_phrases(docs: DataFrame, words: int, least: int) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, size, f) of all phrases that occur ``least`` times or more, (lang, n) of all words)."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), "text")
    counted = texts.mapInArrow(count_words, "lang string, word string, hash long, f long")
    counted = settle(counted.groupBy("lang", "word").agg(F.first("hash").alias("hash"), F.sum("f").alias("f")), "words")
    totals = counted.groupBy("lang").agg(F.sum("f").alias("n"))

    often = counted.filter(F.col("f") >= least)
    slot = F.shiftright("hash", 32 - SLOT_BITS)
    sums = np.zeros(SLOTS, np.int64)
    for row in often.groupBy(slot.alias("slot")).agg(F.sum("f").alias("f")).collect():  # SLOTS rows at most
        sums[row.slot] = row.f
    bit = F.col("hash") % (1 << MAP_BITS)
    chunk = 1 << 15  # bits of one row of the map
    frequent = np.zeros(1 << (MAP_BITS - 3), np.uint8)
    bits = often.select(F.floor(bit / chunk).alias("at"), (bit % chunk).alias("bit"))
    for row in bits.groupBy("at").agg(F.expr("bitmap_construct_agg(bit)").alias("map")).collect():  # a map of fixed size in all
        start = row["at"] * chunk // 8
        frequent[start : start + chunk // 8] = np.frombuffer(row["map"], np.uint8)
    known = spark.sparkContext.broadcast((frequent, Groups(sums)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from send_suffixes(*known.value, words)(batches)

    schema = "lang string, grp long, part long, parts long, entries long, words binary, suffixes binary, counts binary"
    sent = settle(texts.mapInArrow(scan, schema), "suffixes")
    keys = ["lang", "grp", "part"]
    over = sent.filter("parts > 1").groupBy(*keys).agg(F.ceil(F.sum("entries") / (2 * BUDGET)).alias("cuts")).filter("cuts > 1")
    cut = sent.join(over, keys, "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    cut = cut.withColumn("cut", F.pmod(F.xxhash64("words", "suffixes"), F.col("cuts")))
    nodes = cut.groupBy(*keys, "cut").applyInArrow(subtree(words, least), "lang string, phrase string, size int, f long")
    nodes = nodes.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    return settle(nodes, "phrases"), totals


def collocations(docs: DataFrame, words: int = 3, least: int = 10, inside: int = 50, top: int = 2000) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    A phrase of 2 to ``words`` words that occurs a times is cut where floor(10^6 a a / (l r)) is least, l and r being
    the counts of both parts. It is dropped if a longer one that holds it has ``inside`` per cent of its occurrences.
    """
    nodes, totals = count_phrases(docs, words, least)
    candidates = nodes.filter("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    def joined(first, count):
        return F.array_join(F.slice("w", first, count), " ")

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("head"), joined(F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"))
    heads = nodes.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = nodes.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    score = F.expr("cast(1000000 * cast(a AS decimal(16,0)) * cast(a AS decimal(16,0)) div (cast(l AS decimal(16,0)) * cast(r AS decimal(16,0))) AS long)")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    longer = candidates.filter("size > 2").select(
        "lang", "w", "size", F.col("a").alias("longer"), F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("n")
    )
    held = longer.select("lang", "longer", "w", "n", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("n") + 1)).alias("at"))
    held = held.select("lang", joined(F.col("at"), F.col("n")).alias("phrase"), "longer").groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = best.join(held, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a")))

    # A language may hold most of the phrases: what is first in none of its shares is not brought together.
    best_first = [F.desc("cut.score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    in_share = Window.partitionBy("lang", "share").orderBy(*best_first)
    first = kept.withColumn("share", share).withColumn("rank", F.row_number().over(in_share)).filter(F.col("rank") <= top)
    order = Window.partitionBy("lang").orderBy(*best_first)
    ranked = first.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
