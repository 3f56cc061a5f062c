"""License scans, mixing, toxicity, language model and the whole pipeline."""

from __future__ import annotations

import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash

import compare
import corpus_pipeline
from pyspark.sql import functions as F
from strandline.llm import language_model, licenses, mixing, recurrent, toxicity
from strandline.llm.language_model import score_documents
from strandline.llm.mixing import mix, repeated
from strandline.llm.queries import ORACLES, QUERIES
from strandline.llm.recurrent import Shape, Trainer, initial, log_probabilities, streams
from tests.llm.samples import AWKWARD, edited, prose, table


def words_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]


def license_rows():
    rng = random.Random(1)
    rows = AWKWARD + [
        (20, "Under the MIT\nLicense, under the mit licenses, under THE mit-license"),
        (21, "Apache License, Version 2.0 / CC BY-NC 4.0 cc by nc"),
        (22, "É the Gnu General Public License, version 3. ünder the mit license"),
    ]
    for i in range(200):
        notice = edited(rng, rng.choice(licenses.TEMPLATES)[1].upper(), rng.randrange(4))
        rows.append((100 + i, "\n".join(prose(rng, rng.randrange(100)) + " " + x for x in (notice, "", prose(rng, 3)))))
    return rows + [(900, prose(rng, 40_000) + " licensed under cc by nc 4 0 " + prose(rng, 10))]


def test_licenses_by_brute_force(spark):
    rows = license_rows()
    scanned = licenses.scan_licenses(table(spark, rows))
    got = Counter()
    for r in scanned.collect():
        found = frozenset((m.label, m.first_word, m.last_word) for m in r.matches)
        got[(r.doc_id, r.n_words, tuple(sorted((b.label, b.word) for b in r.base)), found)] += 1
    expected = Counter()
    for i, text in rows:
        all_words = words_of(text)
        base = []
        for phrase, label in licenses.PHRASES.items():
            p = phrase.decode().split()
            base += [(label, k) for k in range(len(all_words)) if all_words[k : k + len(p)] == p]
        found, first = set(), 0
        for line in (text or "").split("\n"):
            w = words_of(line)
            for at in range(0, max(len(w) - licenses.STEP, 1), licenses.STEP):
                block = w[at : at + licenses.BLOCK]
                for label, t in licenses.TEMPLATES:
                    t = set(t.split())
                    if block and 100 * len(t & set(block)) >= licenses.THRESHOLD * len(t):
                        found.add((label, first + at, first + at + len(block) - 1))
            first += len(w)
        expected[(i, len(all_words), tuple(sorted(base)), frozenset(found))] += 1
    assert got == expected
    digest = {r.doc_id: r for r in licenses.digest(scanned).collect()}
    assert (digest[20].n_base, digest[20].base_labels, digest[20].score) == (2, "mit", 1.0)
    assert digest[21].labels == "apache-2,cc-by-nc" and digest[1].first_word is None


def test_licenses_broken_into_lines(spark):
    rng = random.Random(11)
    rows, expected = [], {}
    for i, (label, notice) in enumerate(licenses.TEMPLATES):
        w = notice.split()
        for k, (width, prefix) in enumerate([(1, ""), (2, " * "), (3, "# "), (len(w) // 2, "// "), (10, "")]):
            lines = [prefix + " ".join(w[at : at + width]) for at in range(0, len(w), width)]
            before, after = prose(rng, rng.randrange(90)), prose(rng, rng.randrange(90))
            rows.append((100 * i + k, "\n".join([before, *lines, after])))
            expected[100 * i + k] = label
    scanned = licenses.scan_licenses(table(spark, rows))
    digest = {r.doc_id: r for r in licenses.digest(scanned).collect()}
    assert all(label in digest[i].labels.split(",") and digest[i].score == 1.0 for i, label in expected.items())
    texts = dict(rows)
    for r in scanned.collect():
        w, found = words_of(texts[r.doc_id]), set()
        for at in range(0, max(len(w) - licenses.STEP, 1), licenses.STEP):
            block = w[at : at + licenses.BLOCK]
            for label, t in licenses.TEMPLATES:
                if 100 * len(set(t.split()) & set(block)) >= licenses.THRESHOLD * len(set(t.split())):
                    found.add((label, at, at + len(block) - 1))
        assert {(m.label, m.first_word, m.last_word) for m in r.wrapped} == found
    one = licenses.scan_licenses(table(spark, [(1, "\n " + licenses.TEMPLATES[0][1] + "\n\n")])).first()
    assert len(one.matches) == 1 and not one.wrapped


def test_licenses_of_nothing(spark):
    assert licenses.digest(licenses.scan_licenses(table(spark, []))).count() == 0


def sources(spark, sizes):
    rng = random.Random(2)
    rows = [(s * 10_000 + i, prose(rng, rng.randrange(1, 40)), "en", f"s{s}", 1) for s, n in enumerate(sizes) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def totals(mixed):
    by = {}
    for r in mixed.collect():
        t = by.setdefault(r.source, [0, 0, r["__weight"], r["__epochs"], set()])
        t[0] += r["__tokens"]
        t[1] += r["__tokens"] * r["__copies"]
        t[4].add(r["__copies"])
    return by


def test_mixing_meets_a_repetition_limit(spark):
    by = totals(mix(sources(spark, [900, 300, 80, 20]), repetition=2.0))
    epochs = {s: t[3] for s, t in by.items()}
    assert min(epochs.values()) == 1.0 and max(epochs.values()) == pytest.approx(2.0, abs=1e-6)
    # Weights are shares to one power.
    all_tokens = sum(t[0] for t in by.values())
    slopes = [math.log(by[s][2] / by["s0"][2]) / math.log(by[s][0] / by["s0"][0]) for s in ("s1", "s2", "s3")]
    assert slopes == pytest.approx([slopes[0]] * 3) and 0 < slopes[0] < 1 and all_tokens
    for t in by.values():
        assert t[4] <= {math.floor(t[3]), math.ceil(t[3])}
        assert 0 <= t[0] * t[3] - t[1] <= 40  # no more than the budget, and less by one text at most


def test_mixing_meets_an_entropy_and_a_budget(spark):
    docs = sources(spark, [900, 300, 80, 20])
    by = totals(mix(docs, entropy_share=0.9, budget=9000))
    entropy = -sum(t[2] * math.log(t[2]) for t in by.values())
    assert entropy == pytest.approx(0.9 * math.log(4), abs=1e-6)
    assert sum(t[2] for t in by.values()) == pytest.approx(1)
    assert 9000 - 4 * 40 <= sum(t[1] for t in by.values()) <= 9000
    again = {(r.doc_id, r["__copies"]) for r in mix(docs.repartition(9), entropy_share=0.9, budget=9000).collect()}
    assert again == {(r.doc_id, r["__copies"]) for r in mix(docs, entropy_share=0.9, budget=9000).collect()}
    # Equal weights already reach any entropy; equal sources need no change.
    assert {t[3] for t in totals(mix(sources(spark, [50]), entropy_share=1.0)).values()} == {1.0}


def test_mixing_selects_what_a_plain_selection_does(spark, monkeypatch):
    """Whole epochs, and the rest of each budget along blocks in their order and documents in theirs."""
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 16)
    docs = sources(spark, [500, 200, 60, 9, 1])
    out = {r.doc_id: r for r in mix(docs, repetition=3.0, seed=5).collect()}
    hashed = docs.select("doc_id", "source", F.xxhash64(F.lit(5), "doc_id", "text").alias("order")).collect()
    sizes = Counter(r.source for r in hashed)
    blocks = {s: -(-n // 16) for s, n in sizes.items()}
    numbers = spark.createDataFrame([(s, n) for s, k in blocks.items() for n in range(k)], "s string, n long")
    place = {(r.s, r.n): r.h for r in numbers.select("s", "n", F.xxhash64(F.lit(6), "s", "n").alias("h")).collect()}
    tokens = {s: sum(out[r.doc_id]["__tokens"] for r in hashed if r.source == s) for s in sizes}
    share = {s: t / sum(tokens.values()) for s, t in tokens.items()}
    power = math.log(out[0]["__weight"] / out[10_000]["__weight"]) / math.log(share["s0"] / share["s1"])
    raw = {s: x**power for s, x in share.items()}
    assert max(tokens[s] / raw[s] for s in raw) / min(tokens[s] / raw[s] for s in raw) == pytest.approx(3.0, abs=1e-5)
    copies = {}
    for s in sizes:
        epochs = out[next(r.doc_id for r in hashed if r.source == s)]["__epochs"]
        left = (epochs - math.floor(epochs)) * tokens[s]
        rows = sorted((place[s, r.order % blocks[s]], r.order, r.doc_id) for r in hashed if r.source == s)
        open_ = epochs > math.floor(epochs)
        for _, _, i in rows:
            left -= out[i]["__tokens"]
            open_ = open_ and left >= 0
            copies[i] = math.floor(epochs) + open_
    assert copies == {i: r["__copies"] for i, r in out.items()}


def test_mixing_awkward_rows(spark):
    docs = table(spark, AWKWARD)
    out = mix(docs, repetition=2.0)
    rows = repeated(out, docs.columns)
    assert rows.columns == docs.columns
    assert {r.doc_id for r in rows.collect()} == {i for i, _ in AWKWARD} and out.count() == len(AWKWARD)
    assert mix(table(spark, []), repetition=2.0).count() == 0
    assert mix(table(spark, [(1, ""), (2, None)]), repetition=2.0).count() == 2


def test_segments_by_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randrange(1, 40)
        gains = [(i, rng.choice([0.15, 0.5, 2.0, -0.4])) for i in range(n) if rng.random() < 0.5]
        score = [-toxicity.LOSS] * n
        for i, g in gains:
            score[i] = g
        expected = set()

        def split(a, b):
            """The best segment, then those left and right of it."""
            best = max(((sum(score[i:j]), i - j, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
            if best and best[0] > 1e-9:
                best = max((x for x in ((round(sum(score[i:j]), 9), i - j, i, j) for i in range(a, b) for j in range(i + 1, b + 1)) if abs(x[0] - best[0]) < 1e-8), key=lambda x: (x[1]))
                expected.add((best[2], best[3] - 1))
                split(a, best[2])
                split(best[3], b)

        split(0, n)
        found = {(s.first, s.last) for s in toxicity.segments(gains, n)}
        assert sum(score[a] for x in found for a in range(x[0], x[1] + 1)) == pytest.approx(sum(score[a] for x in expected for a in range(x[0], x[1] + 1)))
        assert max((sum(score[a : b + 1]) for a, b in found), default=0) == pytest.approx(max((sum(score[a : b + 1]) for a, b in expected), default=0))


def toxic_corpus(rng, n=1500):
    bad = ["vile", "scum", "snarl", "vilest", "snarling", "snarled"]
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.15
        text = prose(rng, rng.randrange(20, 120)).split()
        for _ in range(rng.randrange(2, 7) if toxic else rng.random() < 0.03):
            text.insert(rng.randrange(len(text)), rng.choice(bad))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_documents(spark):
    rows, labels = toxic_corpus(random.Random(4))
    marks = spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None), (10**6, 0, 1)], "doc_id long, quality int, toxic int")
    scored = toxicity.score_toxicity(table(spark, rows + [(i, t) for i, t in AWKWARD if i is None or i > 5]), marks)
    truth = {i: t for i, _, t in labels}
    out = [r for r in toxicity.digest(scored).collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in out)
    toxic = [r.score for r in out if truth[r.doc_id]]
    clean = [r.score for r in out if not truth[r.doc_id]]
    assert np.mean([a > b for a in toxic for b in clean]) > 0.97
    assert sum(r.predicted != truth[r.doc_id] for r in out) < 0.05 * len(out)
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in out)


def test_toxicity_keeps_certain_features_only(spark):
    rows, labels = toxic_corpus(random.Random(4), 900)
    docs, marks = table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    whole = toxicity.fit(docs, marks)
    assert 0 < len(whole[0]) < 40 and toxicity.fit(docs.repartition(5), marks) == whole


def test_segments_of_a_very_long_text():
    """Spaced hits stay apart, and each is passed once."""
    gains = [(i * 40, 1.0 + i % 3) for i in range(100_000)]
    start = time.perf_counter()
    found = toxicity.segments(gains, 4_000_000)
    assert time.perf_counter() - start < 4 and len(found) == 100_000
    assert [s.first for s in found] == [p for p, _ in gains]
    rising = [(i, 0.5) for i in range(100_000)]
    assert toxicity.segments(rising, 100_000)[0].last == 99_999


def test_toxicity_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.digest(toxicity.score_toxicity(table(spark, AWKWARD), none)).filter("predicted = 1").count() == 0
    one_kind = spark.createDataFrame([(i, 1, 0) for i in range(9)], "doc_id long, quality int, toxic int")
    assert toxicity.digest(toxicity.score_toxicity(table(spark, AWKWARD), one_kind)).filter("predicted = 1").count() == 0
    assert toxicity.score_toxicity(table(spark, []), one_kind).count() == 0


def test_gradient_of_the_network(monkeypatch):
    monkeypatch.setattr(recurrent, "STREAMS", 2)
    rng = np.random.default_rng(5)
    shape = Shape(2, 3, 3)
    flat = initial(shape, np.ones(shape.inputs)) + rng.normal(0, 0.3, shape.size)
    texts = [rng.integers(0, 9, n) for n in (5, 9, 4, 12)]
    given, target, text, first = next(streams(texts, [8] * len(texts)))
    trainer = Trainer(shape, flat, 0.01)
    trainer.flat = flat
    gradient, _ = trainer._window(given[:16], target[:16], text[:16] >= 0, first[:16], np.zeros((2, recurrent.HIDDEN)))
    assert (text[16:] < 0).all()

    def loss(f):
        return -log_probabilities(shape, f, texts, 8).sum() / sum(map(len, texts))

    for i in rng.choice(shape.size, 60, replace=False):
        step = np.zeros(shape.size)
        step[i] = 1e-4
        slope = (loss(flat + step) - loss(flat - step)) / 2e-4
        assert abs(slope - gradient[i]) < 2e-3 * max(0.05, abs(slope))


def test_network_gives_a_distribution_and_carries_its_state():
    rng = np.random.default_rng(6)
    shape = Shape(2, 3, 3)
    flat = initial(shape, np.arange(shape.inputs)) + rng.normal(0, 0.5, shape.size).astype(np.float32)
    begin = rng.integers(0, 9, 50)
    before = log_probabilities(shape, flat, [begin], 8)[0]
    after = log_probabilities(shape, flat, [np.append(begin, k) for k in range(shape.inputs)], 8)
    assert np.exp(after - before).sum() == pytest.approx(1, abs=1e-4)
    # A text's score does not depend on what is scored beside it.
    many = [rng.integers(0, 9, n) for n in (1, 3, 40, 17, 200, 16)] + [begin]
    assert log_probabilities(shape, flat, many, 8)[-1] == pytest.approx(before, rel=1e-5)


def lm_rows():
    rng = random.Random(7)
    rows = AWKWARD[:]
    for i in range(600):  # two kinds of text, so that what came before tells what comes next
        kind = "ab"[i % 2]
        rows.append((100 + i, " ".join(f"{kind}{int(rng.paretovariate(0.6)) % 3000}" for _ in range(rng.randrange(60)))))
    return rows + [(5000, prose(rng, 30_000, 50))]


def test_language_model(spark):
    rows = lm_rows()
    out = score_documents(table(spark, rows)).collect()
    assert len(out) == len(rows)

    def tokens(text):
        return [*(text or "").encode().lower().split(), None]

    def held(i):
        return i is not None and zlib.crc32(str(i).encode()) % 7 == 2

    counts = Counter(t for i, x in rows if not held(i) for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    expected = Counter()
    for i, x in rows:
        score = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens(x))
        expected[(i, held(i), len(tokens(x)), sum(counts[t] > 0 for t in tokens(x)), n, round(score, 4))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in out) == expected
    unseen = [r for r in out if r.held_out]
    assert sum(r.score for r in unseen) > 0.93 * sum(r.base_score for r in unseen)  # log-probabilities are negative
    assert all(r.score < 0 for r in out)


def test_language_model_chunks_keep_places_and_words_together(monkeypatch):
    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 3)

    monkeypatch.setattr(language_model, "TaskContext", Task)
    monkeypatch.setattr(language_model, "CHUNK", 40)
    rng = random.Random(13)
    texts = [None, "", "A a\tb"] + [" ".join(rng.choice("abcdefghij") * 3 for _ in range(rng.randrange(30))) for _ in range(60)]
    held = [rng.random() < 0.3 for _ in texts]
    batches = [
        pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array(range(at, min(at + 7, len(texts))), pa.int64()),
                "held_out": pa.array(held[at : at + 7]),
                "body": pa.array([t if t is None else t.encode() for t in texts[at : at + 7]], pa.binary()),
            }
        )
        for at in range(0, len(texts), 7)
    ]
    rows = pa.Table.from_batches(list(language_model.chunked(iter(batches))))
    packed = rows.filter(pc.is_valid(rows["words"])).select(["chunk", "words"])
    words = pa.Table.from_batches(list(language_model.words_of(iter(packed.to_batches())))).to_pylist()
    at = {(r["chunk"], r["place"]): r["word"] for r in words}
    assert len(at) == len(words) and len(packed) == len(set(packed["chunk"].to_pylist())) > 10
    docs = [r for r in rows.to_pylist() if r["words"] is None]
    assert [r["doc_id"] for r in docs] == list(range(len(texts))) and {r["chunk"] >> 33 for r in docs} == {3}
    counts, signed = Counter(), lambda w: int(np.uint64(xxhash.xxh3_64_intdigest(w)).astype(np.int64))
    for r, text in zip(docs, texts):
        expected = [signed(w) for w in (text or "").lower().encode().split()] + [signed(b"")]
        assert [at[r["chunk"], p] for p in np.frombuffer(r["places"], np.int32).tolist()] == expected
        for w in expected:
            counts[r["chunk"], w] += not r["held_out"]
    assert {(r["chunk"], r["word"]): r["n"] for r in words} == counts


def test_language_model_chunks_take_little_room_and_words_are_added_up_over_them(monkeypatch):
    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 3)

    monkeypatch.setattr(language_model, "TaskContext", Task)
    monkeypatch.setattr(language_model, "CHUNK", 1 << 19)
    texts = ["", " ".join(f"w{i}" for i in range(70_000)) + " w69999 w0 End", "W0 w1\tw0 " * 60_000, None, "w5 never\x0bseen"]
    held = [False] * 4 + [True]
    batch = pa.RecordBatch.from_pydict(
        {"doc_id": pa.array(range(5), pa.int64()), "held_out": held, "body": pa.array([x if x is None else x.encode() for x in texts], pa.binary())}
    )
    rows = list(language_model.halved(iter([batch])))
    docs = [r for b in rows for r in b.to_pylist() if r["words"] is None]
    own = [b.select(["chunk", "words"]) for b in rows if b.column("words")[0].is_valid]
    assert [r["doc_id"] for r in docs] == list(range(5)) and len({r["chunk"] for r in docs}) == len(own) == 2
    # Most places have no upper half, and a word's entry is no longer than its hash, its count and its ending.
    assert sum(len(r["low"]) for r in docs) == 2 * sum(len((t or "").split()) + 1 for t in texts)
    assert all(len(b.column("words")[0].as_py()) == 17 * len(list(language_model.words_of(iter([b])))[0]) for b in own)

    buckets, totals, every = 5, {}, Counter()
    pieces = pa.Table.from_batches(list(language_model.deal(buckets)(iter(own))))
    for bucket in set(pieces["bucket"].to_pylist()):
        for r in language_model.add_up(pieces.filter(pc.equal(pieces["bucket"], bucket))).to_pylist():
            if r["chunk"] == -1:
                every.update({w["word"]: w["n"] for w in pa.Table.from_batches(list(language_model.words_of(iter([pa.RecordBatch.from_pylist([r])])))).to_pylist()})
            else:
                totals[r["chunk"], bucket] = np.frombuffer(r["counts"], np.int64)
    signed = lambda w: int(np.uint64(xxhash.xxh3_64_intdigest(w)).astype(np.int64))
    tokens = [[signed(w) for w in (t or "").lower().encode().split()] + [signed(b"")] for t in texts]
    expected = Counter(w for of, out in zip(tokens, held) for w in of if not out)
    assert +every == expected and every.keys() == {w for of in tokens for w in of}
    for b in own:
        chunk, table = b.column("chunk")[0].as_py(), language_model.unpacked(b.column("words")[0].as_py())
        count = np.empty(len(table), np.int64)
        count[language_model.dealt(table["word"], buckets)[0]] = np.concatenate([totals[k] for k in sorted(totals) if k[0] == chunk])
        assert count.tolist() == [expected[w] for w in table["word"].tolist()]
        for r, of in zip(docs, tokens):
            if r["chunk"] == chunk:
                at = np.frombuffer(r["low"], "<u2") + (np.frombuffer(r["high"], "<u2").astype(np.int64) << 16)
                assert table["word"][at].tolist() == of


def test_language_model_without_rows_or_training(spark):
    assert score_documents(table(spark, [])).count() == 0
    held = [(i, "some words") for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    out = score_documents(table(spark, held)).collect()
    assert len(out) == len(held) and all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in out)


@pytest.mark.parametrize("words", [100, 2000, 70_000])
def test_language_model_learns_more_words_from_more_text(spark, words):
    """As many as occur sqrt(tokens) / 16 times; the others have the number of their class."""
    n = 2 * math.ceil(math.sqrt(words * 400) / 16) + 100
    rows = [(i, n, i % 8) for i in range(words)] + [(-1 - i, 2, i % 8) for i in range(50)] + [(10**9, 7, -1)]
    counts = spark.createDataFrame(rows, "word long, c long, ending int")
    v = language_model.vocabulary(counts)
    frequent = words if words > 512 else words + 50
    assert len(v.frequent) == frequent and v.weight.sum() == sum(c for _, c, _ in rows)
    assert frequent <= v.shape.frequent and max(v.shape.classes, v.shape.width) <= 2 * max(16, math.isqrt(frequent))
    numbers = v.numbers(*np.array(rows).T)
    assert len(set(numbers[:words])) == words and (numbers.astype(v.shape.kind) == numbers).all()
    assert (numbers[:words] < v.shape.frequent).all() and numbers[-1] == v.shape.inputs - 1


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, data, name):
    assert compare.difference(QUERIES[name](spark, data), compare.oracle(data), ORACLES[name]) is None


def test_pipeline(spark, tmp_path):
    rng = random.Random(8)
    rows, labels = toxic_corpus(rng, 900)
    items = [(i, prose(rng, 30, 10**6)) for i in range(20)]
    leaked = [(2000 + i, prose(rng, 30, 10**6) + " " + items[i][1]) for i in range(20)]
    base = prose(rng, 200, 10**6)
    copies = [(3000 + i, edited(rng, base, 2) if i % 2 else base) for i in range(50)]
    clean = [(4000 + i, prose(rng, 60, 10**6)) for i in range(40)]
    docs = table(spark, rows + leaked + copies + clean + AWKWARD, clash=False)
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]

    step = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, step, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        assert name == "sharding" or out.columns == docs.columns
        step = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append({r.doc_id for r in step.select("doc_id").collect()})
    toxic = {i for i, _, t in labels if t}
    fine = {i for i, _, t in labels if not t} | {i for i, _ in clean}
    assert len(toxic & seen[0]) < 0.1 * len(toxic) and len(fine - seen[0]) < 0.02 * len(fine)
    assert len(seen[1] & {i for i, _ in copies}) == 1 and {i for i, _ in clean} <= seen[1]
    assert not seen[2] & {i for i, _ in leaked} and {i for i, _ in clean} <= seen[2]
    assert seen[3] == seen[2] and seen[4] == seen[3]
    assert Counter(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == Counter(map(tuple, step.collect()))
