"""License notices: an exact set-similarity join of text blocks with templates.

A block matches a template if it holds at least 80 % of the template's distinct words. Tokens are put in
one global order, rarest in the corpus first. A matching block holds a token of the template's prefix,
the first |T| - needed + 1 tokens (prefix filter); it has at least ``needed`` template tokens (length
filter); and from the first token met, enough tokens are left on both sides (positional filter). What
passes is counted out. The filters lose nothing, so every block over the threshold is found.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases that are counted wherever their words stand in a row.
PHRASES = {
    b"under the mit license": "mit",
    b"apache license version 2": "apache-2",
    b"cc by nc": "cc-by-nc",
}
# Notices by which works are licensed, as their publishers word them.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "released under the mit license"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl-3", "the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
THRESHOLD = 80  # per cent
BLOCK, STEP = 64, 32  # words; a longer line is cut into overlapping blocks, wider than any template

# Upper case goes to lower case; what parts words becomes a blank, line feeds stay.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else 10 if c == 10 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def _cut(words: list[bytes], first: int) -> Iterator[tuple[int, list[bytes]]]:
    for at in range(0, max(len(words) - STEP, 1), STEP):
        if words:
            yield first + at, words[at : at + BLOCK]


def blocks_of(body: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """(first word's number, words) of each line, long lines in overlapping blocks."""
    first = 0
    for line in body.translate(_TABLE).split(b"\n"):
        line_words = line.split()
        yield from _cut(line_words, first)
        first += len(line_words)


def windows_of(body: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """The same of all words in a row, line ends counting as blanks; none if one line holds all words."""
    text = body.translate(_TABLE).strip()
    if b"\n" in text:
        yield from _cut(text.split(), 0)


def _bodies(column: pa.Array) -> Iterator[bytes]:
    for x in column:
        yield x.as_buffer().to_pybytes() if x.is_valid else b""


def _vocabulary() -> frozenset[bytes]:
    return frozenset(w.encode() for _, t in TEMPLATES for w in t.split())


def count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many blocks each template token occurs; one row per token and task."""
    vocabulary, found = _vocabulary(), Counter()
    for batch in batches:
        for body in _bodies(batch.column("body")):
            for _, block in blocks_of(body):
                found.update(vocabulary.intersection(block))
    yield pa.RecordBatch.from_pydict(
        {"token": pa.array([k.decode() for k in found], pa.string()), "blocks": pa.array(list(found.values()), pa.int64())}
    )


class Join:
    """The templates, prepared for one global token order."""

    def __init__(self, frequency: dict[str, int]):
        order = sorted(_vocabulary(), key=lambda w: (frequency.get(w.decode(), 0), w))
        self.place = {w: i for i, w in enumerate(order)}
        self.vocabulary = frozenset(order)
        self.templates, self.prefixes = [], {}
        for number, (label, text) in enumerate(TEMPLATES):
            tokens = sorted(self.place[w.encode()] for w in set(text.split()))
            needed = -(-len(tokens) * THRESHOLD // 100)
            self.templates.append((label, frozenset(tokens), len(tokens), needed))
            for i in range(len(tokens) - needed + 1):
                self.prefixes.setdefault(tokens[i], []).append((number, i))

    def matches(self, block: list[bytes]) -> Iterator[tuple[str, float]]:
        held = sorted(self.place[w] for w in self.vocabulary.intersection(block))
        tried = set()
        for j, token in enumerate(held):
            for number, i in self.prefixes.get(token, ()):
                if number in tried:
                    continue
                tried.add(number)
                label, tokens, size, needed = self.templates[number]
                if len(held) < needed or 1 + min(size - i - 1, len(held) - j - 1) < needed:
                    continue
                common = len(tokens.intersection(held))
                if common >= needed:
                    yield label, common / size

    def found(self, first: int, block: list[bytes]) -> list[dict]:
        last = first + len(block) - 1
        return [
            {"label": label, "first_word": first, "last_word": last, "containment": share} for label, share in self.matches(block)
        ]

    def scan(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, base, found, wrapped = [], [], [], []
            for body in _bodies(batch.column("body")):
                total, matched = 0, []
                for first, block in blocks_of(body):
                    total = max(total, first + len(block))
                    matched += self.found(first, block)
                n_words.append(total)
                base.append(places_of(body))
                found.append(matched)
                wrapped.append([x for first, block in windows_of(body) for x in self.found(first, block)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(base, _PLACES),
                    pa.array(found, _FOUND),
                    pa.array(wrapped, _FOUND),
                ],
                names=["doc_id", "n_words", "base", "matches", "wrapped"],
            )


_PLACES = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
_FOUND = pa.list_(
    pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("containment", pa.float64())])
)


def places_of(body: bytes) -> list[dict]:
    """Where the words of a phrase stand in a row, line ends counting as blanks."""
    low = body.lower()
    if not (b"license" in low or b"cc" in low):
        return []
    joined = b" " + b" ".join(low.translate(_TABLE).split()) + b" "
    out = []
    for phrase, label in PHRASES.items():
        at = joined.find(b" " + phrase + b" ")
        word, counted = 0, 0
        while at >= 0:
            word, counted = word + joined.count(b" ", counted, at), at
            out.append({"label": label, "word": word})
            at = joined.find(b" " + phrase + b" ", at + 1)
    return out


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, base, matches, wrapped`` for documents (doc_id, text), row for row.

    ``base``: places of the phrases (label, word from 0). ``matches``: all blocks that hold at least 80 %
    of a template (label, first and last word of the block, containment). Blocks are lines; a line of
    more than 64 words is cut into blocks of 64 that overlap by 32. ``wrapped``: the same for blocks of 64
    words over the whole text, line ends counting as blanks, so that a notice broken into lines is found;
    empty where one line holds all words, as its blocks are in ``matches``. Words are runs of letters and
    digits (and anything outside ASCII), A-Z in lower case. NULL and empty texts have no words and no
    matches; an empty table gives no rows; further columns are not looked at.
    """
    bodies = docs.select("doc_id", F.col("text").cast("binary").alias("body"))
    counts = bodies.mapInArrow(count_tokens, "token string, blocks long").groupBy("token").agg(F.sum("blocks").alias("blocks"))
    join = Join({r.token: r.blocks for r in counts.collect()})  # a row for each token of the templates at most
    kind = dict(docs.dtypes)["doc_id"]
    return bodies.mapInArrow(
        join.scan,
        f"doc_id {kind}, n_words long, base array<struct<label:string,word:long>>, "
        + ", ".join(f"{c} array<struct<label:string,first_word:long,last_word:long,containment:double>>" for c in ("matches", "wrapped")),
    )


def digest(scanned: DataFrame) -> DataFrame:
    def labels(*arrays: str) -> Column:
        found = F.concat(*(F.transform(a, lambda x: x["label"]) for a in arrays))
        return F.concat_ws(",", F.array_sort(F.array_distinct(found)))

    starts = F.transform("base", lambda x: x["word"])
    best = F.coalesce(F.array_max(F.transform(F.concat("matches", "wrapped"), lambda x: x["containment"])), F.lit(0.0))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels("base").alias("base_labels"),
        labels("base", "matches", "wrapped").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(best).alias("score"),
    )
