"""Near duplicates by bottom-k sketches from one hash function.

1. A document's distinct shingle hashes are its set; equal sets make one class. The 32 smallest hashes
   are the sketch.
2. Inverted lists: of two sets with Jaccard similarity s, each of the smallest values of their union is
   in both with chance s, so both lists of twelve smallest values share one but for a chance of about
   (1 - s)^12. Values in more than HOT sketches (lines that many texts share) are passed over, and a text
   takes its twelve smallest other values instead; texts made largely of such values go by all of their
   smallest twelve, in lists cut by set size and dealt in pairs of blocks.
3. Within a list the sketch of the union, made of two sketches, estimates the similarity. Pairs far
   below the threshold are out; of the others a spanning forest goes on, not all pairs.
4. The forest's components are brought together with their full sets, and exact Jaccard similarity
   decides, in order of the estimates and until what is left is known to be linked or not.

Rows stay in proportion to the documents, but for lists of a very common value and components of more than
``BLOCK_SHINGLES``: these are dealt in pairs of blocks, so what is exchanged for them grows with their square.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import filterfalse
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.components import components
from strandline.llm.shared import checked_broadcast, join_unique, keep_rows, settle, text_hash

SKETCH, SHORT, LISTS = 32, 24, 12
HOT = 256  # sketches with a value from which its list is not taken as it is
SLACK = 0.42  # an estimate from 32 values is this far below 0.8 twice in ten million, below 0.85 once in a hundred
BLOCK = 512  # entries of a list, or sets of a component, compared with each other at once
BLOCK_SHINGLES = 4_000_000  # of a component in one task; larger ones are dealt in pairs of blocks
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


class Rule(NamedTuple):
    words: int = 5
    per_cent: int = 80

    def linked(self, a: int, b: int, common: int) -> bool:
        return 100 * common >= self.per_cent * (a + b - common)


class Hasher:
    """Sets of shingle hashes; remembers the hashes of words."""

    def __init__(self, width: int):
        self.width, self.known = width, {}

    def shingles(self, body: bytes) -> np.ndarray:
        """Sorted distinct hashes of all runs of ``width`` words; of a shorter text one, of an empty one none."""
        tokens = body.lower().split()  # of bytes: A-Z only, and ASCII blanks only
        if not tokens:
            return np.empty(0, np.uint64)
        if len(self.known) > 400_000:
            self.known.clear()
        known = self.known
        for w in filterfalse(known.__contains__, set(tokens)):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
        width = min(self.width, len(h))
        n = len(h) - width + 1
        out = h[:n] + np.uint64(width)
        for j in range(1, width):
            out = (out ^ (out >> np.uint64(29))) * _MIX[0] + h[j : j + n]
        out = (out ^ (out >> np.uint64(30))) * _MIX[1]
        out = (out ^ (out >> np.uint64(27))) * _MIX[2]
        return np.unique(out ^ (out >> np.uint64(31)))


def _bytes(column: pa.Array) -> Iterator[bytes]:
    for x in column:
        yield x.as_buffer().to_pybytes() if x.is_valid else b""


def sketch_documents(rule: Rule):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(rule.words)
        for batch in batches:
            size, digest, sketches = [], [], []
            for body in _bytes(batch.column("body")):
                s = hasher.shingles(body)
                size.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sketches.append(s[:SKETCH].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), pa.array(sketches, pa.binary())],
                names=["doc_id", "text_hash", "n", "digest", "sketch"],
            )

    return sketch


def short_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, rank, value) of the smallest values of each sketch."""
    for batch in batches:
        ids, rank, value = [], [], []
        for c, s in zip(batch.column("class").to_pylist(), _bytes(batch.column("sketch"))):
            v = np.frombuffer(s, np.int64)[:SHORT]
            ids.append(np.full(len(v), c, np.int64))
            rank.append(np.arange(len(v), dtype=np.int32))
            value.append(v)
        join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else np.empty(0, kind))
        yield pa.RecordBatch.from_arrays(
            [join(ids, np.int64), join(rank, np.int32), join(value, np.int64)], names=["class", "rank", "value"]
        )


def overlaps(sketches: list[np.ndarray]) -> np.ndarray:
    """How many values each two sketches share."""
    k = len(sketches)
    lengths = [len(s) for s in sketches]
    owner = np.repeat(np.arange(k), lengths)
    _, value, count = np.unique(np.concatenate(sketches), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count > 1)
    number = np.full(len(count), -1)
    number[shared] = np.arange(len(shared))
    value = number[value]
    owner, value = owner[value >= 0], value[value >= 0]
    out = np.zeros((k, k), np.float32)
    for low in range(0, len(shared), 2048):
        here = (value >= low) & (value < low + 2048)
        held = np.zeros((k, min(2048, len(shared) - low)), np.float32)
        held[owner[here], value[here] - low] = 1
        out += held @ held.T
    return out


def estimates(sketches: list[np.ndarray], sizes: np.ndarray, most: int) -> np.ndarray:
    """Similarity of each two sets, from the part of their union that both sketches cover."""
    common = overlaps(sketches)
    end = np.array([np.iinfo(np.uint64).max if n <= most else s[-1] for s, n in zip(sketches, sizes)], np.uint64)
    covered = np.array([np.searchsorted(s, np.minimum(end, e), side="right") for s, e in zip(sketches, end)], np.float32)
    union = covered + covered.T - common
    return common / np.maximum(union, 1)


def forest(close: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix the first row that it is linked to, directly or not."""
    root = np.arange(len(close))
    close = close | np.eye(len(close), dtype=bool)
    while True:
        new = np.where(close, root[None, :], len(root)).min(axis=1)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of a stream that is sorted by the keys, each as a table."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        if not table.num_rows:
            continue
        change = np.zeros(table.num_rows - 1, bool)
        for k in keys:
            v = table.column(k).to_numpy()
            change |= v[1:] != v[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
        for a, b in zip(cuts, cuts[1:]):
            yield table.slice(a, b - a)
        rest = table.slice(cuts[-1]).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest


def link_lists(rule: Rule):
    """Candidate links of each list: a spanning forest of the pairs that may reach the threshold.

    A dealt list comes in many groups. Links between entries of one size class and block are given by the
    group that has these alone on its diagonal; the others only give what joins such entries to others.
    """

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for group in grouped(batches, ["value", "part", "pair"]):
            if group.num_rows < 2:
                continue
            ids, sizes = (group.column(c).to_numpy() for c in ("class", "n"))
            sketches = [np.frombuffer(s, np.uint64) for s in _bytes(group.column("sketch").combine_chunks())]
            if len(ids) == 2:
                least, most = int(sizes.min()), int(sizes.max())
                if 100 * least < rule.per_cent * most:
                    continue
            close = estimates(sketches, sizes, SKETCH) >= rule.per_cent / 100 - SLACK
            close &= 100 * np.minimum.outer(sizes, sizes) >= rule.per_cent * np.maximum.outer(sizes, sizes)
            side, visits = (group.column(c).to_numpy() for c in ("side", "visits"))
            home = 2 * side + visits
            inner = forest(close & (home[:, None] == home[None, :]))
            place = np.arange(len(inner))
            if (side == side[0]).all():
                away = (inner != place) & (visits == 0)
                a += ids[away].tolist()
                b += ids[inner[away]].tolist()
            outer = forest(close)
            away = (inner == place) & (outer != place)
            a += ids[away].tolist()
            b += ids[outer[away]].tolist()
            if len(a) > 50_000:
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
                a, b = [], []
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return link


def full_sets(rule: Rule):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(rule.words)
        for batch in batches:
            found = [hasher.shingles(body).tobytes() for body in _bytes(batch.column("body"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("class", "root", "n", "of")] + [pa.array(found, pa.binary())],
                names=["class", "root", "n", "of", "set"],
            )

    return sets


def verify_groups(rule: Rule):
    """Links of each group of sets that hold exactly; links that follow from others are left out."""
    wide = 4 * SKETCH
    floor = rule.per_cent / 100 - 0.2  # about six deviations of an estimate from 128 values

    def exact(group: pa.Table) -> Iterator[tuple[int, int]]:
        ids, sizes = (group.column(c).to_numpy() for c in ("class", "n"))
        order = np.argsort(sizes, kind="stable")
        column = group.column("set").combine_chunks()
        sets = [np.frombuffer(column[int(i)].as_buffer(), np.uint64) for i in order]
        ids, sizes = ids[order], sizes[order]
        root = list(range(len(ids)))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        starts = range(0, len(ids), BLOCK)
        for i in starts:
            for j in (s for s in starts if s >= i):
                if 100 * int(sizes[min(i + BLOCK, len(ids)) - 1]) < rule.per_cent * int(sizes[j]):
                    break  # sorted by size: no set of this block is large enough for those of later ones
                at = np.arange(i, min(i + BLOCK, len(ids)))
                if j > i:
                    at = np.concatenate([at, np.arange(j, min(j + BLOCK, len(ids)))])
                s = estimates([sets[x][:wide] for x in at], sizes[at], wide)
                pairs = np.argwhere(np.triu(s >= floor, 1))
                if j > i:
                    pairs = pairs[(pairs[:, 0] < BLOCK) & (pairs[:, 1] >= BLOCK)]
                for p, q in pairs[np.argsort(-s[pairs[:, 0], pairs[:, 1]], kind="stable")].tolist():
                    x, y = int(at[p]), int(at[q])
                    rx, ry = find(x), find(y)
                    if rx == ry or 100 * int(sizes[x]) < rule.per_cent * int(sizes[y]):
                        continue
                    common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                    if rule.linked(int(sizes[x]), int(sizes[y]), common):
                        root[max(rx, ry)] = min(rx, ry)
                        yield int(ids[x]), int(ids[y])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["root", "pair"]):
            links = list(exact(group))
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())}
            )

    return verify


def _dealt(rows: DataFrame, blocks: str, by: str) -> DataFrame:
    """Deal a group into blocks and give every row to all pairs of blocks that have its own (``pair``)."""
    mine = F.pmod(F.xxhash64(F.lit(5), by), F.col(blocks))
    others = F.when(F.col(blocks) <= 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.sequence(F.lit(0).cast("long"), F.col(blocks).cast("long") - 1)
    )
    rows = rows.withColumn("side", mine.cast("long")).withColumn("other", F.explode(others))
    pair = F.least("side", "other") * F.lit(1 << 31) + F.greatest("side", "other")
    return rows.withColumn("pair", pair).drop("other")


def _streamed(rows: DataFrame, keys: list[str], function, schema: str) -> DataFrame:
    """Run a function over rows that come sorted by the keys, all rows of a key in one task."""
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(function, schema)


def candidate_links(classes: DataFrame, rule: Rule) -> DataFrame:
    values = settle(classes.select("class", "sketch").mapInArrow(short_values, "class long, rank int, value long"), "values")
    lists = values.groupBy(F.col("value").alias("of")).agg(F.count("*").alias("members")).filter("members > 1")
    met = values.join(lists, F.col("value") == F.col("of")).select("class", "rank", "value", "members")
    ranked = met.groupBy("class").agg(F.collect_list(F.struct("rank", "value", "members")).alias("met"))  # at most SHORT
    ranked = ranked.withColumn("hot", F.transform(F.filter("met", lambda m: m["members"] > HOT), lambda m: m["rank"]))
    ranked = ranked.select("class", "hot", F.explode("met").alias("m")).select("class", "hot", "m.*")
    ranked = settle(ranked, "ranked")

    entries = ranked.join(classes.select(F.col("class").alias("c"), "n", "sketch"), F.col("class") == F.col("c"))
    largely_hot = 5 * F.size("hot") >= F.least("n", F.lit(SHORT))
    among_cold = F.col("rank") - F.size(F.filter("hot", lambda r: r < F.col("rank")))
    is_hot = F.col("members") > HOT
    entries = entries.filter(F.when(is_hot, largely_hot & (F.col("rank") < LISTS)).otherwise(among_cold < LISTS))
    # Lists of hot values are cut by size: a set meets those of its own size class and of the one above.
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / rule.per_cent))).cast("int")
    parts = F.when(is_hot, F.array(size_class, size_class + 1)).otherwise(F.array(F.lit(-1)))
    entries = entries.select("*", F.posexplode(parts).alias("visits", "part"))
    blocks = F.when(is_hot, F.ceil(F.col("members") / BLOCK)).otherwise(F.lit(1))
    entries = _dealt(entries.withColumn("blocks", blocks), "blocks", "class")
    entries = entries.select("value", "part", "pair", "side", F.col("visits").cast("long").alias("visits"), "class", "n", "sketch")
    return _streamed(entries, ["value", "part", "pair"], link_lists(rule), "a long, b long")


def near_duplicates(docs: DataFrame, rule: Rule) -> DataFrame:
    """Components of documents (doc_id, text) linked by Jaccard similarity of their word shingles.

    One row per document: ``doc_id, text_hash, n_shingles, component, component_id, kept``.
    ``component_id`` is the smallest doc_id reachable over links; ``component`` is a number that tells
    components apart where doc_ids repeat, NULL where there is nothing to link. Words stand between ASCII blanks, A-Z in lower case; a text of
    fewer words than a shingle is one shingle; without words, or NULL, it has none and is linked with
    nothing. Equal texts are linked. Rows may repeat; a NULL doc_id counts only where its component has
    no other. Further columns are not looked at; an empty table gives no rows.
    """
    kind = dict(docs.dtypes)["doc_id"]
    bodies = docs.select("doc_id", "text").select("doc_id", text_hash(F.col("text")).alias("text_hash"), F.col("text").cast("binary").alias("body"))
    sketched = bodies.mapInArrow(sketch_documents(rule), f"doc_id {kind}, text_hash long, n long, digest binary, sketch binary")
    sketched = settle(sketched, "sketches")
    filled = sketched.filter(F.col("digest").isNotNull())
    classes = filled.groupBy("digest").agg(
        F.min("doc_id").alias("least"),
        F.first(F.struct("doc_id", "text_hash")).alias("of"),
        F.first("n").alias("n"),
        F.first("sketch").alias("sketch"),
        F.count("*").alias("rows"),
    )
    classes = settle(classes.withColumn("class", F.monotonically_increasing_id()), "classes")

    candidates = settle(components(candidate_links(classes, rule)), "candidates")
    members = candidates.join(classes.select("class", "n", "of"), F.col("node") == F.col("class"))
    total = members.groupBy(F.col("root").alias("r")).agg(F.sum("n").alias("shingles"), F.count("*").alias("sets"))
    members = members.join(total, F.col("root") == F.col("r")).select(
        "class", "root", "n", F.col("of.doc_id").alias("id"), F.col("of.text_hash").alias("h"),
        F.ceil(F.col("shingles") / BLOCK_SHINGLES).alias("of"),
    )
    members = settle(members, "members")
    same = bodies["doc_id"].eqNullSafe(members["id"]) & (bodies["text_hash"] == members["h"])
    texts = bodies.join(checked_broadcast(members), same).select("class", "root", "n", "of", "body")
    texts = texts.mapInArrow(full_sets(rule), "class long, root long, n long, of long, set binary")
    dealt = _dealt(texts, "of", "class").select("root", "pair", "class", "n", "set")
    # Rows equal in id and text come along more than once; a set linked with itself changes nothing.
    links = settle(_streamed(dealt, ["root", "pair"], verify_groups(rule), "a long, b long"), "links")

    roots = components(links)
    placed = classes.select("class", "digest", "least", "rows").join(roots, F.col("class") == F.col("node"), "left")
    placed = placed.withColumn("root", F.coalesce("root", "class"))
    least = placed.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("component_id"))
    placed = placed.join(least, F.col("root") == F.col("r")).select(
        F.col("digest").alias("d"), "rows", F.col("root").alias("component"), "component_id"
    )
    placed = settle(placed, "placed")
    linked = join_unique(filled, placed, {"digest": "d"}, "rows", filled.count())
    alone = sketched.filter(F.col("digest").isNull())
    alone = alone.withColumns({"component": F.lit(None).cast("long"), "component_id": F.col("doc_id")})
    columns = ["doc_id", "text_hash", F.col("n").alias("n_shingles"), "component", "component_id"]
    out = linked.select(*columns).unionByName(alone.select(*columns))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, rule: Rule) -> DataFrame:
    """Rows of ``docs``, all columns, of which one stays of each component: the smallest doc_id.

    Texts without words are linked with nothing and all stay. Of rows equal in doc_id and text one stays.
    """
    found = settle(near_duplicates(docs, rule), "near-duplicates").filter(F.col("component").isNotNull())
    # The rows of a component that could stay are equal in doc_id; the smallest hash decides between texts.
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    stays = found.groupBy(F.col("component").alias("c")).agg(F.min(first).alias("first"), F.count("*").alias("rows"))
    stays = settle(stays.filter("rows > 1"), "stays")
    linked = settle(join_unique(found, stays, {"component": "c"}, "rows", found.count()), "linked")
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    go = settle(linked.filter(~same).select("doc_id", "text_hash"), "go")
    out = keep_rows(docs, go, drop=True)
    repeats = linked.filter(same).groupBy("doc_id", "text_hash").agg(F.count("*").alias("times")).filter("times > 1")
    repeats = settle(repeats.select("doc_id", "text_hash"), "repeated-rows")
    if repeats.isEmpty():
        return out
    return keep_rows(out, repeats, drop=True).unionByName(keep_rows(out, repeats).dropDuplicates(["doc_id", "text"]))
