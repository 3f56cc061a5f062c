"""Near duplicates, repeated strings, and the structures they stand on, against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from strandline.llm import near_dedup, repeats
from strandline.llm.components import components
from strandline.llm.near_dedup import Rule, near_duplicates, one_of_each
from strandline.llm.suffixes import Suffixes
from tests.llm.samples import AWKWARD, near_copies, prose, table


def shingle_set(text, width):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def brute_components(rows, rule, groups=False):
    sets = [shingle_set(t, rule.words) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and rule.linked(len(sets[i]), len(sets[j]), len(sets[i] & sets[j])):
                root[max(find(i), find(j))] = min(find(i), find(j))
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(rows[i][0])
    if groups:
        return sum(bool(sets[r]) for r in members)
    least = {r: min((m for m in ids if m is not None), default=None) for r, ids in members.items()}
    return [(rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))]


@pytest.mark.parametrize("rule", [Rule(3, 85), Rule(5, 80)])
@pytest.mark.parametrize("tight", [False, True])
def test_near_duplicates_by_brute_force(spark, monkeypatch, rule, tight):
    if tight:  # every list is hot, dealt in blocks, and components are dealt as well
        monkeypatch.setattr(near_dedup, "HOT", 4)
        monkeypatch.setattr(near_dedup, "BLOCK", 8)
        monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 500)
    rows = AWKWARD + near_copies(random.Random(4)) + [(9000, prose(random.Random(5), 50_000, 10**6))]
    got = near_duplicates(table(spark, rows), rule).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(brute_components(rows, rule))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_one_document_of_each_group_stays(spark):
    rule = Rule(5, 80)
    rows = AWKWARD + near_copies(random.Random(6))
    kept = one_of_each(table(spark, rows), rule).collect()
    filled = [r for r in kept if (r.text or "").split()]
    assert len(kept) - len(filled) == sum(not (t or "").split() for _, t in rows)
    assert len(filled) == brute_components(rows, rule, groups=True)
    least = {c for _, n, c in brute_components(rows, rule) if n}
    assert {r.doc_id for r in filled} == least  # one text of number 5 is linked to others, one is alone


def test_near_duplicates_of_nothing(spark):
    assert near_duplicates(table(spark, []), Rule()).count() == 0
    assert near_duplicates(table(spark, [(1, "a b c d e f")]), Rule()).collect()[0].kept


def test_components_of_random_edges(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def test_suffixes_and_common_prefixes():
    rng = random.Random(8)
    for _ in range(60):
        alphabet = rng.choice([b"a", b"ab", b"abc\x00\xc3"])
        texts = [bytes(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(rng.randrange(1, 6))]
        texts += rng.choices(texts, k=2)
        s = Suffixes(texts)
        suffix = {int(b) + j: [*t[j:], 1000 + i] for i, (b, t) in enumerate(zip(s.starts, texts)) for j in range(len(t) + 1)}
        listed = [suffix[int(p)] for p in s.sa]

        def common(a, b):
            return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

        assert [common(a, b) for a, b in zip(listed, listed[1:])] == s.lcp[1:].tolist()
        for n in (1, 8, 9, 20):
            places = {}
            for i, x in enumerate(listed):
                if len(x) > n:
                    places.setdefault(tuple(x[:n]), []).append(i)
            assert all(v == list(range(v[0], v[0] + len(v))) for v in places.values())
    assert Suffixes([]).size == 0


def brute_removal(rows, length=400):
    seen = Counter()
    bodies = [(i, (t or "").encode()) for i, t in rows]
    for _, b in bodies:
        seen.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = Counter()
    for d, b in bodies:
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone)[: len(b)] > 0
        edges = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        out[(d, len(b), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest())] += 1
    return out


@pytest.mark.parametrize("many", [2048, 2])
def test_repeats_by_brute_force(spark, monkeypatch, many):
    monkeypatch.setattr(repeats, "MANY", many)
    monkeypatch.setattr(repeats, "BUFFER", 20_000)  # long texts go in pieces
    rng = random.Random(9)
    passage = prose(rng, 200, 10**6)
    rows = AWKWARD + [(10 + i, prose(rng, rng.randrange(5, 150), 10**6)) for i in range(30)]
    for i in range(40):  # a common passage, or a part of it, among words of their own
        a, b = rng.randrange(0, 400), rng.randrange(700, len(passage))
        rows.append((100 + i, prose(rng, rng.randrange(0, 60), 10**6) + passage[a:b] + prose(rng, rng.randrange(0, 60), 10**6)))
    rows += [(300, "ab" * 700), (301, "x" * 399), (302, "y" * 400), (303, "z" * 401), (304, prose(rng, 300, 10**6) * 2)]
    rows += [(400 + i, passage[100:900]) for i in range(20)] + [(500, "é" * 30 + passage), (501, prose(rng, 9000, 10**6) + passage)]
    rows += [(600, rows[12][1]), (600, rows[12][1]), (601, prose(rng, 100, 10**6)), (601, rows[15][1] * 2)]
    got = Counter(map(tuple, repeats.digest(repeats.remove_repeats(table(spark, rows))).collect()))
    assert got == brute_removal(rows)


def test_shards_of_a_task_are_bounded(monkeypatch):
    rng = random.Random(10)
    rows = []
    for gram in range(60):  # some dealt, each part of those by itself
        text = prose(rng, 90, 10**6).encode()
        dealt = gram % 20 == 0
        for k in range(40 if dealt else rng.randrange(2, 9)):
            rows.append((gram, k % 4 if dealt else 0, 100 * gram + k, 1, 4 if dealt else 1, text[:500] + b" %d" % k))
    rows.sort(key=lambda r: r[:2])
    columns = dict(zip(("gram", "salt", "context", "copies", "parts", "bytes"), zip(*rows)))
    batch = pa.RecordBatch.from_pydict(columns).append_column("shard", pa.array([0] * len(rows)))
    sizes = []
    monkeypatch.setattr(repeats, "Suffixes", lambda texts: sizes.append(sum(map(len, texts))) or Suffixes(texts))
    monkeypatch.setattr(repeats, "SHARD_BYTES", 8000)
    out = pa.Table.from_batches(repeats.search_shards(iter([batch.slice(0, 50), batch.slice(50)])))
    assert sum(sizes) == sum(len(r[-1]) for r in rows)
    assert 4000 < max(sizes) <= 8000
    found = {(r["gram"], r["context"]) for r in out.select(["gram", "context", "runs"]).to_pylist() if r["runs"]}
    assert found == {(r[0], r[2]) for r in rows}


def test_repeats_of_nothing(spark):
    assert repeats.remove_repeats(table(spark, [])).count() == 0
