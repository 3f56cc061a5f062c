"""Copies proved by digests, keys counted as they come, sketches kept over time."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from strandline.operators import checks, uniqueness, versioned
from strandline.sinks import proof


def multiset(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def small_ranges(monkeypatch):
    monkeypatch.setattr(proof, "SMALL_ROWS", 40)
    monkeypatch.setattr(proof, "FANOUT", 4)


def spoilt(rows, rng):
    out = [r for r in rows if rng.random() > 0.002]
    out += [r for r in rows if rng.random() < 0.002]
    return [(k, v + 1) if rng.random() < 0.002 else (k, v) for k, v in out]


@pytest.mark.parametrize("key,kind", [("k", "int"), ("k", "string"), ("k", "timestamp"), ("k", "timestamp_ntz"), ("k", "double")])
def test_differences_are_found_exactly(spark, small_ranges, key, kind):
    rng = random.Random(kind)
    rows = [(i // 2 if i % 50 else None, i) for i in range(2000)] + [(77, 5)] * 90
    other = spoilt(rows, rng)
    frames = []
    for values in (rows, other):
        df = spark.createDataFrame(values, "k int, v int").repartition(3)
        cast = F.timestamp_seconds(F.col("k") * 3600).cast(kind) if kind.startswith("timestamp") else F.col("k").cast(kind)
        frames.append(df.select(cast.alias("k"), "v"))
    names = {str(x): x for x, in frames[0].select("k").distinct().collect()}
    got = {(str(r.k), r.v): (r.n_source, r.n_copy) for r in proof.differences(*frames, "k").collect()}
    here, there = (Counter((str(r.k), r.v) for r in f.collect()) for f in frames)
    assert got == {r: (here[r], there[r]) for r in here.keys() | there.keys() if here[r] != there[r]} and got and names


def test_a_right_copy_costs_one_look(spark, small_ranges, monkeypatch):
    looks = []
    plain = proof._digests
    monkeypatch.setattr(proof, "_digests", lambda *a: looks.append(len(a[2])) or plain(*a))
    rows = spark.range(5000).select("id", (F.col("id") % 7).alias("v"))
    assert proof.differing_ranges(rows, rows.repartition(5), "id") == [] and looks == [1, 1]
    looks.clear()
    one = rows.withColumn("v", F.when(F.col("id") == 3210, 99).otherwise(F.col("v")))
    assert as_set(proof.differences(rows, one, "id")) == {(3210, 3210 % 7, 1, 0), (3210, 99, 0, 1)}
    assert len(looks) > 4 and max(looks) == 4  # one path down the tree
    low, high = proof.differing_ranges(rows, one, "id")[0]
    assert low <= 3210 < high and high - low < 60
    assert proof.differences(rows.limit(0), rows.limit(0), "id").isEmpty()
    assert proof.differences(rows, rows.limit(0), "id").count() == 5000
    assert proof.differences(rows.limit(0), rows, "id").count() == 5000
    with pytest.raises(ValueError):
        proof.differences(rows, rows.drop("v"), "id")
    with pytest.raises(ValueError):
        proof.differences(rows, rows.withColumn("v", F.col("v").cast("string")), "id")


def test_pairs_of_equal_rows_do_not_cancel(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "y"), (3, "z"), (3, "z")], "k int, v string")
    assert as_set(proof.differences(a, b, "k")) == {(1, "x", 2, 0), (3, "z", 0, 2)}


@pytest.mark.parametrize("buckets", [False, True])
def test_keys_are_counted_as_they_come(spark, folder, monkeypatch, buckets):
    if buckets:
        monkeypatch.setattr(versioned, "BUCKET_BYTES", 10)
        monkeypatch.setattr(versioned, "plan_bytes", lambda df: 35)
    schema = "a string, b int, rest string"
    first = spark.createDataFrame([("x", 1, "p"), ("x", 2, "p"), ("y", 1, "p"), (None, 1, "p"), (None, 1, "p"), ("", 5, "p")], schema)
    second = spark.createDataFrame([("x", 2, "q"), ("z", 1, "q"), ("z", 1, "q"), (None, 1, "q")], schema)
    register = uniqueness.open_register(spark, f"{folder}/r")
    assert as_set(uniqueness.register_keys(register, first, ["a", "b"], "t", 0)) == set()
    for _ in range(2):  # a repeated batch is not counted twice
        assert as_set(uniqueness.register_keys(register, second, ["a", "b"], "t", 1)) == {("x", 2, 2), ("z", 1, 2)}
    again = uniqueness.open_register(spark, f"{folder}/r")
    third = spark.createDataFrame([("x", 2, "r"), ("", 5, "r"), ("w", 1, "r")], schema)
    assert as_set(uniqueness.register_keys(again, third, ["a", "b"], "t", 2, fold_share=0)) == {("x", 2, 3), ("", 5, 2)}
    everything = first.unionAll(second).unionAll(third).where("a IS NOT NULL").groupBy("a", "b").count().where("count > 1")
    assert as_set(everything) == {("x", 2, 3), ("", 5, 2), ("z", 1, 2)}
    assert uniqueness.register_keys(again, first.limit(0), ["a", "b"], "t", 3).isEmpty()


def test_sketches_merge_and_drift(spark):
    rng = random.Random(2)
    rows = [(1, rng.gauss(0, 1), f"v{i % 300}") for i in range(6000)] + [(2, rng.gauss(0, 1), f"v{i % 300 + 100}") for i in range(6000)]
    rows += [(3, rng.gauss(1, 1) if i % 4 else None, "") for i in range(6000)] + [(4, None, None)] * 10 + [(5, 1.0, "v1")]
    df = spark.createDataFrame(rows, "day int, x double, s string")
    parts = [checks.sketches(df.where(F.hash("x", "s") % 2 == i), ["x", "s"], F.col("day")) for i in (0, 1, -1)]
    kept = checks.merged_sketches(parts[0].unionAll(parts[1]).unionAll(parts[2]))
    got = {(r.grp, r.column_name): r for r in checks.drift(kept).collect()}
    assert len(got) == 10 and all(got[1, c].grp_before is None and got[1, c].overlap is None for c in "xs")
    assert got[2, "x"].distance < 0.06 and got[3, "x"].distance == pytest.approx(0.383, abs=0.05)
    assert got[3, "x"].null_shift == pytest.approx(0.25) and got[4, "x"].distance is None and got[5, "x"].distance is None
    assert got[2, "s"].overlap == pytest.approx(0.5) and got[3, "s"].overlap == 0 and got[3, "s"].approx_distinct == 1
    assert got[4, "s"].approx_distinct == 0 and got[5, "s"].rows == 1 and got[2, "s"].distance is None
    limited = {r.grp: r.distance for r in checks.drift(kept, {"x": [1.0]}).where("column_name = 'x'").collect()}
    assert limited[3] == pytest.approx(0.841 - 0.5, abs=0.04)
    told = {(r.grp, r.column_name): r for r in checks.sketched_profile(kept).collect()}
    assert told[1, "x"].quantiles[1] == pytest.approx(0, abs=0.1) and told[4, "x"].quantiles is None and told[1, "s"].approx_distinct == 300
    weeks = checks.merged_sketches(kept, F.when(F.col("grp") < 3, 1).otherwise(2))
    wide = {(r.grp, r.column_name): r for r in checks.sketched_profile(weeks).collect()}
    assert wide[1, "s"].rows == 12_000 and wide[1, "s"].approx_distinct == 400 and wide[2, "x"].nulls == 1510
