"""Byte-level BPE by ranks, in DuckDB inside each task.

A text is cut into pieces by the tokenizer's pattern. Each different piece of a task is encoded once: its bytes
are rows (word, pos, id), which a recursive query joins with the table of merges and contracts at the word's
leftmost pair of minimum rank, until no pair is left. Any two tokens whose bytes make a third one are a pair, as
ranks say, not only those that a training once merged. Decoding looks ids up in the vocabulary and
joins their bytes.

Memory in a task is bounded: pieces, words and ids go through in portions (``PORTION``), a very long text or piece
included, and the memory of encoded words starts anew once it holds ``WORDS``. The vocabulary and its merges, whose
size does not depend on the corpus, are made by the driver and broadcast.

NULL and empty texts have no ids and decode to no bytes. Repeated rows and further columns stay as they are; the
columns added begin with ``__``. An empty table gives an empty one.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
import unicodedata
from collections.abc import Iterator
from itertools import islice

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructType

PORTION = 1_000_000  # rows in a query, pieces at a time
WORDS = 400_000  # encoded words a task remembers
LONG = 64  # bytes; longer words are contracted at many places in a step
MEMORY = "400MB"

# Where Unicode 16.0 added letters and numbers, first and last code points.
ADDED = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D8F), (0x10EC2, 0x10EC4), (0x11380, 0x113E2),
    (0x116D0, 0x116E3), (0x11BC0, 0x11BF9), (0x13460, 0x143FA), (0x16100, 0x16139), (0x16D40, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5FA),
]

SHORT_WORDS = f"""
    WITH RECURSIVE t(word, pos, id, after, open) AS (
        SELECT word, pos, id, lead(id) OVER (PARTITION BY word ORDER BY pos), true FROM start
        UNION ALL
        (WITH best AS (
            SELECT word, min(made::BIGINT * {LONG} + pos) AS least FROM t JOIN merges ON id = l AND after = r WHERE open GROUP BY word
        ), taken AS (
            SELECT word, least % {LONG} AS place, (least // {LONG})::INT AS made FROM best
        ), left_over AS (
            SELECT t.word, CASE WHEN pos > place THEN pos - 1 ELSE pos END AS pos, CASE WHEN pos = place THEN made ELSE id END AS id,
                   place IS NOT NULL AS open
            FROM t LEFT JOIN taken ON t.word = taken.word WHERE t.open AND (place IS NULL OR pos <> place + 1)
        )
        SELECT word, pos, id, lead(id) OVER (PARTITION BY word ORDER BY pos), open FROM left_over)
    )
    SELECT word, pos, id FROM t WHERE NOT open ORDER BY word, pos
"""

# A step contracts the occurrences of the minimum rank from the left, up to the first after which a lower rank
# appears (early); so the order is that of single contractions. Places taken away stay as rows with id -1.
LONG_WORDS = """
    WITH RECURSIVE t(word, pos, id, open) USING KEY (word, pos) AS (
        SELECT word, pos, id, true FROM start
        UNION
        (WITH pairs AS (
            SELECT word, pos, id, row_number() OVER w AS i, lag(id) OVER w AS before, lead(id) OVER w AS after, lead(id, 2) OVER w AS beyond
            FROM recurring.t WHERE open WINDOW w AS (PARTITION BY word ORDER BY pos)
        ), ranked AS (
            SELECT pairs.*, made, min(made) OVER (PARTITION BY word) AS low FROM pairs LEFT JOIN merges ON id = l AND after = r
        ), hits AS (
            SELECT *, coalesce(made = low, false) AS hit FROM ranked
        ), runs AS (
            SELECT *, i - row_number() OVER (PARTITION BY word, hit ORDER BY pos) AS run FROM hits
        ), choice AS (
            SELECT *, hit AND row_number() OVER (PARTITION BY word, hit, run ORDER BY pos) % 2 = 1 AS chosen FROM runs
        ), sides AS (
            SELECT *, CASE WHEN lag(chosen, 2) OVER (PARTITION BY word ORDER BY pos) THEN low ELSE before END AS ahead FROM choice
        ), lower AS (
            SELECT sides.*, chosen AND least(x.made, y.made) < low AS early
            FROM sides LEFT JOIN merges x ON chosen AND ahead = x.l AND low = x.r LEFT JOIN merges y ON chosen AND low = y.l AND beyond = y.r
        ), taken AS (
            SELECT *, chosen AND i <= coalesce(min(CASE WHEN early THEN i END) OVER (PARTITION BY word), i) AS take FROM lower
        ), gone AS (
            SELECT *, coalesce(lag(take) OVER (PARTITION BY word ORDER BY pos), false) AS away FROM taken
        )
        SELECT word, pos, CASE WHEN away THEN -1 WHEN take THEN low ELSE id END, low IS NOT NULL AND NOT away FROM gone)
    )
    SELECT word, pos, id FROM t WHERE id >= 0 ORDER BY word, pos
"""

def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from lines of base64 and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def later_letters() -> str:
    """A class of the letters and numbers that came after Unicode 16.0, which the pattern's classes leave out."""
    found: list[list[int]] = []
    known = regex.compile(r"[\p{L}\p{N}]")
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c)) == "Cn" and known.match(chr(c)) and not any(a <= c <= b for a, b in ADDED):
            if found and found[-1][1] == c - 1:
                found[-1][1] = c
            else:
                found.append([c, c])
    return "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in found) + "]" if found else r"(?!)"


# Where such code points may be, found much faster.
_HIGH = re.compile("[\u0500-\U0010ffff]")


def merges_of(ranks: dict[bytes, int]) -> pa.Table:
    """(l, r, made): every two tokens whose bytes make a third one."""
    found = [
        (a, b, made)
        for token, made in ranks.items()
        for cut in range(1, len(token))
        if (a := ranks.get(token[:cut])) is not None and (b := ranks.get(token[cut:])) is not None
    ]
    return pa.table([pa.array(c, pa.int32()) for c in zip(*found)], ["l", "r", "made"])


class Cutter:
    """Pieces of texts by a pattern whose classes are those of Unicode 16.0."""

    def __init__(self, pattern: str, later: str):
        self.pattern, self.later = regex.compile(pattern), regex.compile(later)

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pieces in order, in lists of PORTION at most."""
        if not _HIGH.search(text) or not self.later.search(text):
            if len(text) <= PORTION:
                yield self.pattern.findall(text)
                return
            masked = text
        else:
            masked = self.later.sub("\ue000", text)  # neither letter nor number nor space, and as long
        found = self.pattern.finditer(masked)
        while portion := [text[m.start() : m.end()] for m in islice(found, PORTION)]:
            yield portion


class Encoder:
    """Encodes pieces; one for each task."""

    def __init__(self, ranks: dict[bytes, int], merges: pa.Table | None = None):
        self.ranks = ranks
        self.bytes = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        table = merges_of(ranks) if merges is None else merges
        self.duck = _duck()
        self.duck.register("table_of_merges", table)
        self.duck.execute("CREATE TABLE merges AS SELECT * FROM table_of_merges")
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _contract(self, words: list[bytes], query: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, how many each has)."""
        ids, counts, at = [], [], 0
        while at < len(words):
            end, rows = at, 0
            while end < len(words) and (end == at or rows + len(words[end]) <= PORTION):
                rows += len(words[end])
                end += 1
            sizes = np.array([len(w) for w in words[at:end]])
            word = np.repeat(np.arange(end - at, dtype=np.int32), sizes)
            pos = np.arange(rows, dtype=np.int32) - np.repeat((np.cumsum(sizes) - sizes).astype(np.int32), sizes)
            self.duck.register("start", pa.table({"word": word, "pos": pos, "id": self.bytes[np.frombuffer(b"".join(words[at:end]), np.uint8)]}))
            out = self.duck.sql(query).to_arrow_table()
            ids.append(out["id"].to_numpy())
            counts.append(np.bincount(out["word"].to_numpy(), minlength=end - at))
            at = end
        return (np.concatenate(ids), np.concatenate(counts)) if ids else (np.zeros(0, np.int32), np.zeros(0, np.int64))

    def _learn(self, new: list[str]) -> None:
        whole, short, long = [], [], []
        for word in new:
            body = word.encode()
            (whole if body in self.ranks else short if len(body) <= LONG else long).append((word, body))
        parts = [(np.array([self.ranks[b] for _, b in whole], np.int32), np.ones(len(whole), np.int64))]
        parts += [self._contract([b for _, b in short], SHORT_WORDS), self._contract([b for _, b in long], LONG_WORDS)]
        for word, _ in whole + short + long:
            self.place[word] = len(self.place)
        self.ids = np.concatenate([self.ids, *(ids for ids, _ in parts)])
        counts = np.concatenate([c for _, c in parts])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in a row, how many each has)."""
        different = set(pieces)
        if len(self.place) + len(different) > WORDS:
            self._forget()
        if new := sorted(different.difference(self.place)):
            self._learn(new)
        at = np.fromiter(map(self.place.__getitem__, pieces), np.int64, len(pieces))
        counts = self.ends[at + 1] - self.ends[at]
        before = np.cumsum(counts) - counts
        return self.ids[np.repeat(self.ends[at] - before, counts) + np.arange(counts.sum())], counts


def _duck() -> duckdb.DuckDBPyConnection:
    return duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})


def _ids_of(texts: list[str | None], cutter: Cutter, encoder: Encoder) -> list[np.ndarray]:
    """One array per text; small texts are encoded together."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    waiting: list[tuple[int, int]] = []
    pieces: list[str] = []

    def flush() -> None:
        ids, counts = encoder.encode(pieces)
        ends = np.concatenate([[0], np.cumsum(counts)])
        at = 0
        for text, n in waiting:
            out[text].append(ids[ends[at] : ends[at + n]])
            at += n
        waiting.clear()
        pieces.clear()

    for i, text in enumerate(texts):
        for portion in cutter.pieces(text or ""):
            waiting.append((i, len(portion)))
            pieces.extend(portion)
            if len(pieces) >= PORTION:
                flush()
    flush()
    return [np.concatenate(parts) if parts else np.zeros(0, np.int32) for parts in out]


def _portions(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Slices of about PORTION by the rows' sizes; a larger row stands alone."""
    at, held = 0, 0
    for i, size in enumerate(sizes):
        if i > at and held + size > PORTION:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += size
    if batch.num_rows > at:
        yield batch.slice(at)


def _shared(df: DataFrame, value: object) -> Broadcast:
    return df.sparkSession.sparkContext.broadcast(value)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """All rows and columns, with ``__ids`` array<int> of the whole text, without special tokens."""
    known, later = read_ranks(path), later_letters()
    shared = _shared(df, (known, merges_of(known)))  # once; in every task it would cost as much as megabytes of text
    schema = StructType([*df.schema]).add("__ids", ArrayType(IntegerType()), False)
    column = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, encoder = Cutter(pattern, later), Encoder(*shared.value)
        for batch in batches:
            sizes = np.array([len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(column)])
            for part in _portions(batch, sizes):
                ids = _ids_of(part.column(column).to_pylist(), cutter, encoder)
                ends = np.cumsum([0, *(len(x) for x in ids)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, "__ids"])

    return df.mapInArrow(run, schema)


class Decoder:
    """Bytes of lists of ids; one for each task."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {rank: token for token, rank in ranks.items()}

    def decode(self, lists: list[np.ndarray]) -> list[bytes]:
        def joined(ids: np.ndarray) -> bytes:
            return b"".join(filter(None, map(self.tokens.get, ids.tolist())))  # no token, no bytes

        return [b"".join([joined(x[at : at + PORTION]) for at in range(0, len(x), PORTION)]) for x in lists]


def decode(df: DataFrame, path: str, ids: str = "__ids") -> DataFrame:
    """All rows and columns, with ``__decoded``, the bytes that the ids stand for, and ``__ids_sha256`` of the ids
    as little-endian unsigned 32-bit integers. NULL lists count as empty; an id that is no token has no bytes."""
    ranks = _shared(df, read_ranks(path))
    schema = StructType([*df.schema]).add("__decoded", BinaryType(), False).add("__ids_sha256", StringType(), False)
    column = df.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(ranks.value)
        for batch in batches:
            sizes = np.array([len(x) if x.is_valid else 0 for x in batch.column(column)])
            for part in _portions(batch, sizes):
                values = part.column(column)
                lists = [x.values.to_numpy() if x.is_valid else np.zeros(0, np.int32) for x in values]
                digests = [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in lists]
                added = [pa.array(decoder.decode(lists), pa.binary()), pa.array(digests, pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], [*part.schema.names, "__decoded", "__ids_sha256"])

    return df.mapInArrow(run, schema)


def digest(df: DataFrame) -> DataFrame:
    return df.select(
        "doc_id",
        F.size("__ids").cast("long").alias("n_tokens"),
        F.col("__ids_sha256").alias("ids_sha256"),
        F.sha2("__decoded", 256).alias("decoded_sha256"),
    )
