"""Removal of long repeated byte strings with suffix arrays.

1. Anchors. The smallest hash among the 128-byte grams of a 400-byte string is the string's anchor, so
   equal strings have the same gram as their anchor, at the same distance. Every 400-byte string of a
   text belongs to one anchor, and about one in 137 bytes is one. Only strings with an anchor that
   occurs elsewhere can occur elsewhere.
2. Contexts, the bytes of all strings of one anchor. Where all contexts of a gram are equal, all their
   strings repeat and nothing more is needed. Else one copy of each distinct context goes on.
3. Shards. Contexts of one gram meet in a shard of whole grams, as many as fit, whose suffix array
   (Larsson-Sadakane) and common prefixes (Kasai) put equal strings side by side.
4. A gram with many different contexts is dealt to several shards. Those pass on the sorted hashes of
   their strings, cut by range; each range finds those of every shard in the others by binary search.
5. The repeated strings of a document are united and cut out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.near_dedup import grouped
from strandline.llm.shared import checked_broadcast, join_unique, settle, text_hash
from strandline.llm.suffixes import Suffixes
from strandline.session import settings

LENGTH, GRAM = 400, 128
REACH = LENGTH - GRAM + 1  # grams in a string
BUFFER = 1 << 18  # bytes handled at once; longer texts go in pieces
SHARD_BYTES = 1 << 19  # a suffix array takes some 100 bytes of memory for each
TASK_BYTES = 1 << 21  # of contexts, for each task that searches shards
MANY = 1024  # different contexts of one gram from which it is dealt to several shards
# Texts and contexts reach the tasks in batches of about so many bytes.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 22)}
_PLACE = np.uint64((1 << 24) - 1)
_ODD = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of substrings from running sums of random byte values times powers of an odd number."""

    def __init__(self, number: int):
        self.values = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD[number]))
        self.base = _ODD[1 - number]
        self.powers = self.inverse = np.ones(1, np.uint64)

    def over(self, symbols: np.ndarray) -> Rolling:
        n = len(symbols)
        if len(self.powers) <= n:
            self.powers, self.inverse = np.ones(n + 1, np.uint64), np.ones(n + 1, np.uint64)
            np.cumprod(np.full(n, self.base, np.uint64), out=self.powers[1:])
            np.cumprod(np.full(n, pow(self.base, -1, 1 << 64), np.uint64), out=self.inverse[1:])
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[symbols] * self.powers[:n], out=self.sums[1:])
        return self

    def all(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        return _mix((self.sums[width:] - self.sums[:-width]) * self.inverse[:n])

    def parts(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[first]) * self.inverse[first] + (end - first).astype(np.uint64))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours: running minima of blocks, from both sides."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    rows = padded.reshape(-1, width)
    forward = np.minimum.accumulate(rows, axis=1).ravel()
    backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def _pieces(bodies: Iterator[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Buffers of (document, offset, bytes); pieces of one text overlap so that no string is missed."""
    docs, offsets, parts, size = [], [], [], 0
    for i, body in enumerate(bodies):
        for at in range(0, max(len(body) - LENGTH + 1, 0), BUFFER):
            part = body[at : at + BUFFER + LENGTH - 1]
            if size and size + len(part) > BUFFER:
                yield docs, offsets, parts
                docs, offsets, parts, size = [], [], [], 0
            docs.append(i)
            offsets.append(at)
            parts.append(part)
            size += len(part)
    if parts:
        yield docs, offsets, parts


def anchors(bodies: Iterator[bytes], rolling: tuple[Rolling, Rolling]) -> Iterator[tuple[np.ndarray, ...]]:
    """(document, first and last string's start, gram hash, context hash) of every anchor."""
    for docs, offsets, parts in _pieces(bodies):
        symbols = np.frombuffer(b"".join(parts), np.uint8)
        lengths = np.array([len(p) for p in parts])
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        grams = rolling[0].over(symbols).all(GRAM)
        keyed = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        owner = (sliding_min(keyed, REACH) & _PLACE).astype(np.int64)
        inside = np.zeros(len(symbols) + 1, np.int32)
        inside[starts] += 1
        inside[starts + lengths - LENGTH + 1] -= 1
        at = np.flatnonzero(np.cumsum(inside)[: len(owner)])
        new = np.ones(len(at), bool)
        new[1:] = (owner[at[1:]] != owner[at[:-1]]) | (at[1:] != at[:-1] + 1)
        first = at[new]
        last = at[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(at) - 1]])]
        piece = np.searchsorted(starts, first, side="right") - 1
        context = rolling[1].over(symbols).parts(first, last + LENGTH)
        shift = np.array(offsets)[piece] - starts[piece]
        yield np.array(docs)[piece], first + shift, last + shift, grams[owner[first]], context


def _bytes(column: pa.Array) -> Iterator[bytes]:
    for x in column:
        yield x.as_buffer().to_pybytes() if x.is_valid else b""


def find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rolling = (Rolling(0), Rolling(1))
    for batch in batches:
        for doc, first, last, gram, context in anchors(_bytes(batch.column("body")), rolling):
            doc = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(doc),
                    batch.column("text_hash").take(doc),
                    pa.array(first, pa.int64()),
                    pa.array(last, pa.int64()),
                    pa.array(gram.view(np.int64)),
                    pa.array(context.view(np.int64)),
                ],
                names=["doc_id", "text_hash", "first", "last", "gram", "context"],
            )


def cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted contexts of each document."""
    for batch in batches:
        for body, wanted in zip(_bytes(batch.column("body")), batch.column("wanted").to_pylist()):
            yield pa.RecordBatch.from_pydict(
                {
                    "gram": pa.array([w["gram"] for w in wanted], pa.int64()),
                    "context": pa.array([w["context"] for w in wanted], pa.int64()),
                    "copies": pa.array([w["copies"] for w in wanted], pa.int64()),
                    "contexts": pa.array([w["contexts"] for w in wanted], pa.int64()),
                    "bytes": pa.array([body[w["first"] : w["last"] + LENGTH] for w in wanted], pa.binary()),
                }
            )


def _runs(dup: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], dup.astype(np.int8), [0]])))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(edge[::2], edge[1::2])]


_RUNS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
RUNS = "array<struct<first:bigint,last:bigint>>"


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Grams, or the parts of dealt ones, of a sorted stream; several in a shard as long as they fit."""
    waiting, size = [], 0
    for group in grouped(batches, ["gram", "salt"]):
        more = group.column("bytes").nbytes
        if waiting and size + more > SHARD_BYTES:
            yield pa.concat_tables(waiting)
            waiting, size = [], 0
        waiting.append(group)
        size += more
    if waiting:
        yield pa.concat_tables(waiting)


def search_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated strings of a shard's contexts; of dealt grams also the hashes of those found once only.

    Rows with ``runs`` are results (offsets of the strings' starts in the context). Rows with ``keys``
    are what dealt grams pass on: for one range of hashes, the sorted hashes of this shard's strings.
    """
    rolling = (Rolling(0), Rolling(1))
    for group in shards(batches):
        texts = list(_bytes(group.column("bytes").combine_chunks()))
        gram, context, copies, parts = (group.column(c).to_numpy() for c in ("gram", "context", "copies", "parts"))
        found = Suffixes(texts)
        strings = np.maximum(found.lengths - LENGTH + 1, 0)
        owner = np.repeat(np.arange(len(texts)), strings)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(strings) - strings, strings)
        weight = np.zeros(found.size, np.int64)  # of suffixes that are strings: two if the context has copies
        weight[found.starts[owner] + place] = np.minimum(copies[owner], 2)
        label = np.empty(found.size, np.int64)
        label[found.sa] = np.cumsum(found.lcp < LENGTH) - 1
        total = np.bincount(label, weights=weight, minlength=1)
        at = found.starts[owner] + place
        again = total[label[at]] >= 2
        ends = np.cumsum(strings)
        runs = [_runs(again[e - s : e]) for s, e in zip(strings, ends)]
        names = ["gram", "context", "runs", "part", "keys", "others", "refs"]
        keep = np.array([bool(r) for r in runs])
        size = int(keep.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram[keep]), pa.array(context[keep]), pa.array([r for r in runs if r], _RUNS)]
            + [pa.nulls(size, k) for k in (pa.int64(), pa.binary(), pa.binary(), pa.binary())],
            names=names,
        )
        if parts.max(initial=1) > 1:
            symbols = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
            hashes = [r.over(symbols).parts(at, at + LENGTH) for r in rolling]
            for g in np.unique(gram[parts > 1]):
                own = np.flatnonzero(gram[owner] == g)
                _, one = np.unique(label[at[own]], return_index=True)  # one string of each distinct kind
                own = own[one]
                own = own[np.argsort(hashes[0][own], kind="stable")]
                n = int(parts[gram == g][0])
                part = (hashes[0][own] >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)
                cuts = np.searchsorted(part, np.arange(n + 1, dtype=np.uint64))
                for p in np.flatnonzero(np.diff(cuts)):
                    mine = own[cuts[p] : cuts[p + 1]]
                    # Where a string is known to repeat, nothing needs to come back.
                    refs = np.where(again[mine], -1, mine)
                    ids = np.stack([np.where(refs < 0, 0, context[owner[mine]]), np.where(refs < 0, -1, place[mine])], 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([g], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, _RUNS), pa.array([int(p)], pa.int64())]
                        + [pa.array([x.tobytes()], pa.binary()) for x in (hashes[0][mine], hashes[1][mine], ids.astype(np.int64))],
                        names=names,
                    )


def merge_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings of one gram and range that other shards have too, looked up by binary search."""
    for group in grouped(batches, ["gram", "part"]):
        keys, others, refs = (
            [np.frombuffer(x, kind) for x in _bytes(group.column(c).combine_chunks())]
            for c, kind in (("keys", np.uint64), ("others", np.uint64), ("refs", np.int64))
        )
        run = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        all_keys = np.concatenate(keys)
        order = np.argsort(all_keys, kind="stable")  # merges the sorted runs
        merged = all_keys[order]
        known = np.concatenate(others)[order]
        context, place = [], []
        for i, mine in enumerate(keys):
            low, high = np.searchsorted(merged, mine, side="left"), np.searchsorted(merged, mine, side="right")
            met = np.zeros(len(mine), bool)
            for j in np.flatnonzero(high - low > 1):
                there = slice(low[j], high[j])
                met[j] = bool(((known[there] == others[i][j]) & (run[order[there]] != i)).any())
            back = refs[i].reshape(-1, 2)[met]
            back = back[back[:, 1] >= 0]
            context.append(back[:, 0])
            place.append(back[:, 1])
        context, place = np.concatenate(context), np.concatenate(place)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(context), group.column("gram")[0].as_py(), np.int64)),
                pa.array(context),
                pa.array([[{"first": int(p), "last": int(p)}] for p in place], _RUNS),
            ],
            names=["gram", "context", "runs"],
        )


def cut_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the united intervals out of each text."""
    for batch in batches:
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for body, cuts in zip(_bytes(batch.column("body")), batch.column("cuts")):
            n_bytes.append(len(body))
            if cuts.is_valid and len(cuts.values):
                first, end = (cuts.values.field(i).to_numpy() for i in (0, 1))
                order = np.argsort(first, kind="stable")
                first, end = first[order], np.maximum.accumulate(end[order])
                new = np.concatenate([[True], first[1:] > end[:-1]])
                first, end = first[new], end[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(end) - 1]])]
                n_removed.append(int((end - first).sum()))
                n_spans.append(len(first))
                body = b"".join(body[a:b] for a, b in zip([0, *end.tolist()], [*first.tolist(), len(body)]))
            else:
                n_removed.append(0)
                n_spans.append(0)
            kept.append(body)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id")] + [pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)] + [pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def repeated_strings(bodies: DataFrame) -> DataFrame:
    """(doc_id, text_hash, first, end) of bytes to remove; intervals may overlap."""
    kind = dict(bodies.dtypes)["doc_id"]
    found = bodies.mapInArrow(
        find_anchors, f"doc_id {kind}, text_hash long, first long, last long, gram long, context long"
    )
    with settings(bodies.sparkSession, BATCHES):
        found = settle(found, "anchors")
    grams = found.groupBy(F.col("gram").alias("g")).agg(
        F.count("*").alias("copies"), F.min("context").alias("low"), F.max("context").alias("high")
    )
    grams = settle(grams.filter("copies > 1").select("g", "copies", (F.col("low") != F.col("high")).alias("mixed")), "grams")
    total = found.count()
    again = settle(join_unique(found, grams, {"gram": "g"}, "copies", total).drop("g", "copies"), "repeated-anchors")
    whole = again.filter(~F.col("mixed"))

    mixed = again.filter("mixed")
    kinds = mixed.groupBy("gram", "context").agg(
        F.count("*").alias("copies"), F.min(F.struct("doc_id", "text_hash", "first", "last")).alias("at")
    )
    kinds = settle(kinds, "contexts")
    many = kinds.groupBy(F.col("gram").alias("g")).agg(F.count("*").alias("contexts"), F.sum("copies").alias("rows"))
    many = settle(many, "mixed-grams")
    placed = join_unique(kinds, many, {"gram": "g"}, "contexts", kinds.count()).drop("g")
    wanted = placed.groupBy(F.col("at.doc_id").alias("id"), F.col("at.text_hash").alias("h")).agg(
        F.collect_list(F.struct("gram", "context", "copies", "contexts", "at.first", "at.last")).alias("wanted")
    )  # a document's own contexts, no more than its text has room for
    wanted = settle(wanted, "wanted")
    few = checked_broadcast(wanted.select(F.col("id").alias("i"), F.col("h").alias("k")), wanted.count())
    suspects = bodies.join(few, bodies["doc_id"].eqNullSafe(few["i"]) & (bodies["text_hash"] == few["k"]), "left_semi")
    suspects = suspects.join(wanted, suspects["doc_id"].eqNullSafe(wanted["id"]) & (suspects["text_hash"] == wanted["h"]))
    contexts = suspects.select("body", "wanted").mapInArrow(
        cut_contexts, "gram long, context long, copies long, contexts long, bytes binary"
    )
    size = placed.agg(F.sum(F.col("at.last") - F.col("at.first") + LENGTH + 1)).first()[0] or 0
    tasks = min(-(-size // TASK_BYTES) or 1, 100_000)
    parts = F.ceil(F.col("contexts") / MANY)
    salt = F.when(parts > 1, F.pmod(F.xxhash64("context"), parts)).otherwise(F.lit(0))
    dealt = contexts.withColumns({"parts": parts, "salt": salt})
    dealt = dealt.repartition(tasks, "gram", "salt").sortWithinPartitions("gram", "salt")
    searched = dealt.mapInArrow(
        search_shards, f"gram long, context long, runs {RUNS}, part long, keys binary, others binary, refs binary"
    )
    with settings(bodies.sparkSession, BATCHES):
        searched = settle(searched, "searched")
    passed = searched.filter(F.col("keys").isNotNull()).select("gram", "part", "keys", "others", "refs")
    passed = passed.repartition("gram", "part").sortWithinPartitions("gram", "part")
    merged = passed.mapInArrow(merge_shards, f"gram long, context long, runs {RUNS}")
    runs = searched.filter(F.col("runs").isNotNull()).select("gram", "context", "runs").unionByName(merged)
    runs = runs.groupBy(F.col("gram").alias("g"), F.col("context").alias("c")).agg(F.flatten(F.collect_list("runs")).alias("runs"))
    # A context's own runs, at most one for each of its strings. Its copies may be many: they are counted.
    counted = kinds.select("gram", "context", "copies")
    runs = runs.join(counted, (F.col("g") == F.col("gram")) & (F.col("c") == F.col("context"))).select("g", "c", "runs", "copies")
    runs = settle(runs, "runs")
    partly = join_unique(mixed, runs, {"gram": "g", "context": "c"}, "copies", total)
    partly = partly.select("doc_id", "text_hash", "first", F.explode("runs").alias("r")).select(
        "doc_id", "text_hash", (F.col("first") + F.col("r.first")).alias("first"), (F.col("first") + F.col("r.last") + LENGTH).alias("end")
    )
    return whole.select("doc_id", "text_hash", "first", (F.col("last") + LENGTH).alias("end")).unionByName(partly)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Remove every byte of documents (doc_id, text) in a 400-byte string that starts elsewhere as well.

    One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept`` (binary, what remains). Texts are
    UTF-8 bytes, NULL is empty; strings do not cross documents, and "elsewhere" includes the same one.
    Documents repeated with id and text are documents of their own. Equality is that of a gram's and a
    context's 64-bit hash together, or of the bytes themselves. An empty table gives no rows; further
    columns are not looked at.
    """
    bodies = docs.select("doc_id", "text").select("doc_id", text_hash(F.col("text")).alias("text_hash"), F.col("text").cast("binary").alias("body"))
    cuts = repeated_strings(bodies).distinct()  # rows equal in id and text have the same intervals
    cuts = cuts.groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("h")).agg(F.collect_list(F.struct("first", "end")).alias("cuts"))
    cuts = settle(cuts, "cuts")  # a document's own intervals
    joined = bodies.join(cuts, bodies["doc_id"].eqNullSafe(cuts["id"]) & (bodies["text_hash"] == cuts["h"]), "left")
    kind = dict(docs.dtypes)["doc_id"]
    return joined.select("doc_id", "body", "cuts").mapInArrow(
        cut_repeats, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def digest(removed: DataFrame) -> DataFrame:
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
