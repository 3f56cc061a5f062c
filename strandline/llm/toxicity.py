"""Toxic passages: maximum-scoring segments of token log-odds, calibrated by extreme values.

Log-odds come from labelled documents, with an informative Dirichlet prior: a token's counts in toxic
and clean documents are smoothed towards its share of all tokens. A token without support of its own
takes the log-odds of its longest supported beginning. Tokens far enough from their prior score their
log-odds, all others a small loss, and a linear scan finds every maximal segment. What the best
segment of n tokens scores in clean documents follows an extreme-value law, p = 1 - exp(-K n e^(-L s));
a logistic curve over log p and the number of significant segments gives the score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import filterfalse
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.shared import settle

MOST_LABELLED = 30_000  # labelled documents the model is fitted on; those of the smallest hashes
STARTS = (4, 5, 6)  # lengths of the beginnings that stand in for rare tokens, in bytes
SUPPORT, CERTAIN = 5, 4.0  # documents, and deviations from the prior, that make a feature count
PRIOR, LEAST = 500.0, 0.5  # weight of the prior, in tokens, and what any feature has of it at least
LOSS = 0.1  # of a token without log-odds
LEAST_GAIN, MOST_GAIN = 1.0, 6.0  # log-odds from which a token counts, and most that it can add
LEAST_LENGTH = 50  # shorter texts are judged as if they had so many tokens
COUNTS = ("clean_0", "toxic_0", "clean_1", "toxic_1")  # by half of the sample
SIGNIFICANT = 0.05  # of segments, as p
REJECTED = 0.7  # score from which a document is predicted toxic

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def tokens_of(body: bytes) -> list[bytes]:
    return body.translate(_TABLE).split()


def features_of(token: bytes) -> list[bytes]:
    """The token and its beginnings, the most telling first."""
    return [b"=" + token] + [token[:n] for n in reversed(STARTS) if len(token) >= n]


def count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents have a feature, by half of the sample and label; a row per feature and task.

    Once per document: what one text repeats says no more about its label.
    """
    counts: dict[str, Counter] = {name: Counter() for name in COUNTS}
    for batch in batches:
        for body, toxic, half in zip(*(batch.column(c).to_pylist() for c in ("body", "toxic", "half"))):
            tokens, own = set(tokens_of(body or b"")), counts[COUNTS[2 * half + toxic]]
            own.update({f for token in tokens for f in features_of(token)})
            own[b""] += len(tokens)
    names = list(set().union(*counts.values()))
    yield pa.RecordBatch.from_pydict(
        {"feature": pa.array(names, pa.binary())} | {k: pa.array([c[f] for f in names], pa.int64()) for k, c in counts.items()}
    )


class Segment(NamedTuple):
    first: int
    last: int
    score: float


def segments(gains: list[tuple[int, float]], n: int) -> list[Segment]:
    """All maximal scoring segments, in linear time.

    ``gains`` has (position, log-odds) of the tokens that count; every other token costs LOSS. A stack
    holds candidates with the running totals before and after them; a new one joins the last candidate
    that began lower, if it ends higher. Each candidate knows the last one that began lower than itself, so those
    between are never passed again.
    """
    stack: list[list[float]] = []  # first, last, total before, total after, the last that began lower
    total, at = 0.0, 0
    for place, gain in gains:
        total -= LOSS * (place - at)
        before, total, at = total, total + gain, place + 1
        if gain <= 0:
            continue
        first, low = place, before
        while True:
            lower = len(stack) - 1
            while lower >= 0 and stack[lower][2] >= low:
                lower = stack[lower][4]
            if lower < 0 or stack[lower][3] >= total:
                stack.append([first, place, low, total, lower])
                break
            first, _, low, *_ = stack[lower]
            del stack[lower:]
    return [Segment(a, b, after - before) for a, b, before, after, _ in stack]


class Model(NamedTuple):
    odds: dict[bytes, float]
    extreme: tuple[float, float] = (1.0, 0.0)  # L and log K
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def gains(self, tokens: list[bytes], known: dict[bytes, float]) -> list[tuple[int, float]]:
        """Positions and log-odds of the tokens that have any; ``known`` remembers tokens."""
        odds = self.odds
        for token in filterfalse(known.__contains__, set(tokens)):  # not a set difference, which would go through all of known
            known[token] = next((odds[f] for f in features_of(token) if f in odds), 0.0)
        return [(i, g) for i, t in enumerate(tokens) if (g := known[t])]

    def log_p(self, score: float, n: int) -> float:
        """log of the chance that clean text of n tokens has a segment of this score."""
        if score <= 0:
            return 0.0
        expected = min(math.exp(min(self.extreme[1] + math.log(max(n, LEAST_LENGTH)) - self.extreme[0] * score, 50.0)), 1e20)
        return math.log(max(-math.expm1(-expected), 1e-300))

    def best(self, body: bytes, known: dict[bytes, float]) -> tuple[float, int]:
        """Score of the best segment, and how many tokens there are."""
        tokens = tokens_of(body)
        return max((s.score for s in segments(self.gains(tokens, known), len(tokens))), default=0.0), len(tokens)

    def read(self, body: bytes, known: dict[bytes, float]) -> tuple[list[tuple[Segment, float]], tuple[float, float]]:
        tokens = tokens_of(body)
        found = [(s, self.log_p(s.score, len(tokens))) for s in segments(self.gains(tokens, known), len(tokens))]
        significant = [x for x in found if x[1] <= math.log(SIGNIFICANT)]
        best = min((p for _, p in found), default=0.0)
        return significant, (math.log1p(-best), math.log1p(len(significant)))

    def probability(self, x: tuple[float, float]) -> float:
        a, b, c = self.curve
        return 1 / (1 + math.exp(-max(min(a + b * x[0] + c * x[1], 35.0), -35.0)))


def log_odds(rows: list[tuple[bytes, int, int]]) -> dict[bytes, float]:
    """Log-odds of the features (feature, clean, toxic) that are far enough from their prior."""
    n0, n1 = next(((c, t) for f, c, t in rows if f == b""), (0, 0))
    out = {}
    for feature, clean, toxic in rows:
        if feature and clean + toxic >= SUPPORT:
            prior = LEAST + PRIOR * (clean + toxic) / max(n0 + n1, 1)
            rest1, rest0 = max(n1 + PRIOR - toxic - prior, 1.0), max(n0 + PRIOR - clean - prior, 1.0)
            value = math.log((toxic + prior) / rest1) - math.log((clean + prior) / rest0)
            if value >= CERTAIN * math.sqrt(1 / (toxic + prior) + 1 / (clean + prior)) and value >= LEAST_GAIN:
                out[feature] = min(value, MOST_GAIN)
    return out


def may_count(clean: Column, toxic: Column, n0: int, n1: int) -> Column:
    """The test of ``log_odds`` on columns; a little wider, so that rounding drops nothing."""
    seen = clean + toxic
    prior = LEAST + PRIOR * seen / max(n0 + n1, 1)
    rest1, rest0 = (F.greatest(n + PRIOR - x - prior, F.lit(1.0)) for n, x in ((n1, toxic), (n0, clean)))
    value = F.log((toxic + prior) / rest1) - F.log((clean + prior) / rest0)
    deviations = CERTAIN * F.sqrt(1 / (toxic + prior) + 1 / (clean + prior))
    return (seen >= SUPPORT) & (value >= deviations - 1e-9) & (value >= LEAST_GAIN - 1e-9)


def fit_extreme(best: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """L and log K by moments of the best segments' scores, less what their length explains."""
    some = best > 0
    if some.sum() < 20:
        return 1.0, 0.0
    spread = max(float(best[some].std()), 0.5)
    rate = math.pi / (spread * math.sqrt(6))
    shifted = best[some] - np.log(np.maximum(n[some], LEAST_LENGTH)) / rate
    return rate, rate * float(shifted.mean()) - 0.5772156649


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps, with a little ridge so that separable data has a solution."""
    if len(y) == 0 or y.min() == y.max():
        return (-5.0, 1.0, 0.5)
    design = np.column_stack([np.ones(len(y)), x])
    w = np.zeros(design.shape[1])
    ridge = np.diag([1e-6, 0.01, 0.01])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -35, 35)))
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + ridge, design.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def in_training(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on at most MOST_LABELLED labelled documents whose remainder is not 1.

    The log-odds come from all of them. The extreme-value law and the curve come from scores that each
    half gets with the log-odds of the other, so that nothing is measured on what it was made from.
    Documents labelled more than once count as toxic if any label says so.
    """
    usable = labels.select("doc_id", "toxic").filter(F.col("toxic").isin(0, 1) & in_training(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    # The smallest hashes; cut by the share that is wanted, not by a sort of all labels.
    share = min(1.0, 0.97 * MOST_LABELLED / max(usable.count(), 1))
    mark = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = usable.withColumn("mark", mark).filter(F.col("mark") < share)
    chosen = F.broadcast(chosen.limit(MOST_LABELLED).withColumnRenamed("doc_id", "id"))
    half = F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(2)).cast("int")
    sample = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("id"))
    sample = settle(sample.select(F.col("text").cast("binary").alias("body"), "toxic", half.alias("half")), "labelled")

    counted = sample.mapInArrow(count_features, "feature binary, " + ", ".join(f"{c} long" for c in COUNTS))
    counted = counted.groupBy("feature").agg(*(F.sum(c).alias(c) for c in COUNTS))
    toxic = F.col("toxic_0") + F.col("toxic_1")
    # Only features that lean to toxic can score, and of them those that are certain in a half or in both.
    counted = counted.filter((toxic > 0) & (toxic + F.col("clean_0") + F.col("clean_1") >= SUPPORT))
    counted = settle(counted, "features")
    every = F.col("feature") == F.lit(b"")
    n = counted.filter(every).first() or dict.fromkeys(COUNTS, 0)
    certain = may_count(F.col("clean_0") + F.col("clean_1"), toxic, n["clean_0"] + n["clean_1"], n["toxic_0"] + n["toxic_1"])
    for h in (0, 1):
        certain |= may_count(F.col(f"clean_{h}"), F.col(f"toxic_{h}"), n[f"clean_{h}"], n[f"toxic_{h}"])
    rows = counted.filter(every | certain).collect()  # of the words of MOST_LABELLED documents, the few that are certain
    halves = [Model(log_odds([(bytes(r.feature), r[f"clean_{h}"], r[f"toxic_{h}"]) for r in rows])) for h in (0, 1)]
    model = Model(log_odds([(bytes(r.feature), r.clean_0 + r.clean_1, r.toxic_0 + r.toxic_1) for r in rows]))

    best, n, toxic = _measured(sample, halves, lambda m, body, known: m.best(body, known))
    extreme = fit_extreme(best[toxic == 0], n[toxic == 0])
    halves = [m._replace(extreme=extreme) for m in halves]
    a, b, toxic = _measured(sample, halves, lambda m, body, known: m.read(body, known)[1])
    return model._replace(extreme=extreme, curve=fit_curve(np.column_stack([a, b]), toxic))


def _measured(sample: DataFrame, halves: list[Model], two: Callable) -> tuple[np.ndarray, ...]:
    """Two numbers and the label for each document of the sample, by the model of the half it is not in.

    Sorted, so that what is fitted to them does not depend on the order of rows.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple[dict, dict] = ({}, {})
        for batch in batches:
            pairs = zip(batch.column("body").to_pylist(), batch.column("half").to_pylist())
            x = [two(halves[1 - half], body or b"", known[1 - half]) for body, half in pairs]
            yield pa.RecordBatch.from_arrays(
                [pa.array([float(v[i]) for v in x], pa.float64()) for i in (0, 1)] + [batch.column("toxic")], names=["a", "b", "toxic"]
            )

    found = sample.mapInArrow(measure, "a double, b double, toxic int").toArrow()
    columns = [found.column(c).to_numpy().astype(float) for c in ("a", "b", "toxic")]
    order = np.lexsort(columns)
    return tuple(c[order] for c in columns)


def scorer(model: Model) -> Callable[[Column], Column]:
    """A column function: text (as binary) to its score and significant passages."""

    @F.arrow_udf("struct<score:double,passages:array<struct<first_word:int,last_word:int,log_odds:double,log_p:double>>>")
    def score(bodies: pa.Array) -> pa.Array:
        known: dict[bytes, float] = {}
        out = []
        for body in bodies:
            found, x = model.read(body.as_buffer().to_pybytes() if body.is_valid else b"", known)
            if len(known) > 500_000:
                known.clear()
            out.append(
                {
                    "score": model.probability(x),
                    "passages": [
                        {"first_word": s.first, "last_word": s.last, "log_odds": s.score, "log_p": p} for s, p in found
                    ],
                }
            )
        passage = pa.struct(
            [("first_word", pa.int32()), ("last_word", pa.int32()), ("log_odds", pa.float64()), ("log_p", pa.float64())]
        )
        return pa.array(out, pa.struct([("score", pa.float64()), ("passages", pa.list_(passage))]))

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All columns of documents (doc_id, text) and ``__toxicity``: score and significant passages.

    Fits on ``labels`` (doc_id, toxic) and the documents they name. Every row is scored by its whole
    text; NULL and empty texts have no passage and get the score of text without any. Without labels, or
    with labels of one kind, the score is that of a fixed curve without log-odds, and no document is
    rejected. Tables may be empty. Word numbers count runs of letters and digits from 0.
    """
    model = fit(docs, labels)
    return docs.withColumn("__toxicity", scorer(model)(F.col("text").cast("binary")))


def digest(scored: DataFrame) -> DataFrame:
    score = F.col("__toxicity.score")
    return scored.select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False)).alias("held_out"),
        score.alias("score"),
        (score >= REJECTED).cast("int").alias("predicted"),
        F.size("__toxicity.passages").alias("n_passages"),
    )
