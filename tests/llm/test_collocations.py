"""Collocations against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandline.llm import collocations as co
from tests.llm.samples import AWKWARD, table

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, words=3, least=10, inside=50, top=2000):
    counts, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        of_lang = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for size in range(1, words + 1):
                of_lang.update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, f in counts.items():
        phrases = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in phrases.items():
            score, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            held = any(
                100 * b >= inside * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in phrases.items()
                if len(q) > len(p)
            )
            if not held:
                kept.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1)]
    return out


def texts(rng, n):
    stock = ["New York", "new  york\tcity", "in spite of", "a b a b a", "São Paulo", "x,y", "the the the", "word\x1cpart nbsp\xa0here", "ein? Satz!"]
    rows = []
    for _ in range(n):
        parts = [rng.choice(stock) if rng.random() < 0.4 else f"w{int(rng.paretovariate(0.7))}" for _ in range(rng.randrange(40))]
        rows.append((rng.choice(["en", "en", "de", None, "und"]), "".join(p + rng.choice([" ", " ", " ", ", ", "\n", ". "]) for p in parts)))
    return rows


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "x", 1) for r in rows], "lang string, text string, phrase string, hash string, f long").repartition(3)
    return Counter(tuple(r) for r in co.collocations(df, **options).collect())


@pytest.mark.parametrize("portion,budget", [(co.PORTION, co.BUDGET), (300, 200)])
def test_equals_brute_force(spark, monkeypatch, portion, budget):
    monkeypatch.setattr(co, "PORTION", portion)
    monkeypatch.setattr(co, "BUDGET", budget)
    rows = texts(random.Random(4), 500) + [(None, None), ("en", ""), ("fr", " \t,.")]
    rows += [("en", "same line again and again") for _ in range(700)]  # over the budget, pair and all
    assert run(spark, rows) == Counter(brute(rows))
    assert run(spark, rows, words=4, least=5, inside=80, top=30) == Counter(brute(rows, 4, 5, 80, 30))


def test_a_crowded_bitmap_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(co, "hash_of", lambda language, word: len(word))  # words of a length share all hashes
    rows = texts(random.Random(6), 200)
    assert run(spark, rows) == Counter(brute(rows))


def test_products_are_exact(spark):
    big = 10**15
    row = spark.sql(f"SELECT {big - 1}L AS a, {big}L AS l, {big - 3}L AS r").select(
        F.expr("cast(1000000 * cast(a AS decimal(16,0)) * cast(a AS decimal(16,0)) div (cast(l AS decimal(16,0)) * cast(r AS decimal(16,0))) AS long)")
    )
    assert row.first()[0] == 10**6 * (big - 1) ** 2 // (big * (big - 3))


def test_very_long_text_and_empty_table(spark):
    rng = random.Random(8)
    rows = [("en", " ".join(f"w{rng.randrange(30)}" for _ in range(200_000)))]
    assert run(spark, rows) == Counter(brute(rows))
    assert co.collocations(table(spark, AWKWARD).limit(0)).count() == 0
    assert co.collocations(table(spark, AWKWARD)).count() == 0
