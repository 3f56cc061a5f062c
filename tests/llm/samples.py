"""Small tables for the operators' tests."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# NULLs anywhere, empty and blank texts, ties, repeated rows.
AWKWARD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (None, "one two three four five six"), (None, None),
    (5, "one two three four five six"), (5, "other words under the same number here"), (6, "ONE two  three\tfour five six"),
]


def table(spark, rows, clash: bool = True):
    """A documents table; with ``clash`` further columns with names that operators use themselves."""
    rows = [(i, t, "en", None if i is None or i % 5 == 0 else f"src{i % 3}", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    names = ["size", "run", "tie", "rows", "hash", "text_hash", "class", "root", "value", "tokens", "block", "spans", "score", "id", "h"]
    return df.selectExpr("*", *(f"'x' AS `{n}`" for n in names)) if clash else df


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def edited(rng: random.Random, text: str, changes: int) -> str:
    out = text.split(" ")
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


def near_copies(rng: random.Random) -> list[tuple[int, str]]:
    """Groups of copies from two to many, near and exact, among texts of their own; one line in all of many texts."""
    texts = [prose(rng, rng.randrange(3, 120)) for _ in range(60)]
    base = prose(rng, 80)
    texts += [edited(rng, base, rng.randrange(0, 6)) for _ in range(60)] + [base] * 10
    for size in (2, 3, 5):
        one = prose(rng, 60)
        texts += [edited(rng, one, i) for i in range(size)]
    line = prose(rng, 12)
    texts += [line + " " + prose(rng, rng.randrange(1, 40)) for _ in range(40)]
    rng.shuffle(texts)
    return list(enumerate(texts, 100))
