"""Hard negatives against brute force in whole numbers."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, row string, size string, angles string"


def brute(rows, every=100, positives=5, negatives=10):
    kept = []
    for i, v, label in rows:
        v = None if v is None else [None if x is None else float(np.float32(x)) for x in v]
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(256 * x) for x in v], label))
    by_id = lambda p: (-p[0], p[1] is None, p[1] or 0)
    out = []
    for n, (i, v, label) in enumerate(kept):
        if i is None or i % every:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, m, k) for k, (j, w, m) in enumerate(kept) if len(w) == len(v)]
        for p, j, _, _ in sorted([s for s in scored if s[2] == label and s[3] != n], key=by_id)[:positives]:
            fits = [s for s in scored if s[2] != label and 30 * p <= 100 * s[0] <= 90 * p]
            out += [(i, j, r, s[1], p, s[0]) for r, s in enumerate(sorted(fits, key=by_id)[:negatives], 1)]
    return out


def sample(rng, n, size=8, labels=4):
    centres = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(labels * 2)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        rows.append((i, [x + rng.gauss(0, rng.choice([0.05, 0.5])) for x in c], rng.randrange(labels)))
    return rows


def run(spark, rows, every=100):
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA).repartition(3)
    out = hn.hard_negatives(df, F.col("id") % every == 0)
    return Counter(tuple(r) for r in out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("rows_of_part,block", [(hn.ROWS, hn.BLOCK), (60, 4)])
def test_equals_brute_force(spark, monkeypatch, rows_of_part, block):
    monkeypatch.setattr(hn, "ROWS", rows_of_part)
    monkeypatch.setattr(hn, "BLOCK", block)
    rng = random.Random(3)
    rows = sample(rng, 400)
    rows += [(i, rows[5][1], 1) for i in range(500, 560)]  # one very common vector
    rows += [(700, rows[7][1], 2)] * 3 + [(None, rows[7][1], 2)] * 2  # repeated rows, no id
    rows += [(800, [0.0] * 8, 1), (801, [-x for x in rows[0][1]], 0), (802, None, 1), (803, rows[3][1], None)]
    rows += [(900, [1.0, None] + [0.0] * 6, 1), (901, [math.nan] * 8, 1), (902, [math.inf] * 8, 0)]
    rows += [(1000, [0.5, 0.25], 1), (1001, [0.5, 0.2], 1), (1002, [0.3, 0.1], 2), (1100, [], 1), (1101, [], 1)]
    assert run(spark, rows, 20) == Counter(brute(rows, 20))


def test_large_components_are_exact(spark):
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-1, 1) * 2.0 ** rng.choice([10, 22]) for _ in range(4)], i % 2) for i in range(60)]
    assert run(spark, rows, 10) == Counter(brute(rows, 10))


def test_empty_and_lonely(spark):
    assert run(spark, []) == Counter()
    assert run(spark, [(0, [1.0], 1)]) == Counter()
    assert run(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == Counter()


def test_bounds_hold_and_leave_rows_out():
    rng = np.random.default_rng(1)
    q = np.floor(rng.normal(0, 100, (500, 16)) + 300 * rng.integers(0, 2, (500, 1)) * np.eye(16)[rng.integers(0, 16, 500)])
    refs = hn.directions(q[:10].tolist(), 16)
    norm = np.linalg.norm(q, axis=1)
    angles = np.arccos(np.clip(q @ refs.T / norm[:, None], -1, 1)).astype(np.float32).astype(float)

    class Rows:
        pass

    part = Rows()
    part.angles, part.norm = angles, norm
    out = 0
    for i in range(500):
        low, high = hn.row_bounds(part, np.arange(500), angles[i], norm[i])
        scores = q @ q[i]
        assert (low <= scores).all() and (scores <= high).all()
        out += (high < np.sort(scores)[-5]).sum()
    assert out > 0
