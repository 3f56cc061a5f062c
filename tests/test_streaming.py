from __future__ import annotations

import json
import os
import time
from pathlib import Path

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from strandline.operators.versioned import VersionedTable
from strandline.session import new_table_name
from strandline.streaming import control, ingest, medallion
from strandline.streaming.publish import complete_publisher, live_folder
from strandline.streaming.replay import ArrivalReplay

COLUMNS = ["device_id", "mrn", "time", "heartrate"]
HINTS = {"time": "double"}
DAY = 86400


def land(folder, name, *records):
    path = Path(folder) / "landing" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(dict(zip(COLUMNS, r))) for r in records) + "\n")


def names():
    return {s: new_table_name(s) for s in ("bronze", "silver", "gold")}


@pytest.fixture
def lookup(spark):
    return spark.createDataFrame([("1", "Ann"), ("2", "Bob")], "mrn string, name string")


def test_three_steps_and_incremental_rerun(spark, folder, lookup):
    tables = names()

    def run():
        medallion.run_once(spark, f"{folder}/landing", COLUMNS, HINTS, lookup, tables, f"{folder}/work")

    land(
        folder, "01.json",
        (5, 1, 10.9, 60.0), (5, 1, 20, 80), (5, 2, DAY + 1, 50.5), (5, 2, "broken", 70),
        (5, 1, 30, 0), (5, 1, 30, -4), (5, 1, 30, "none"), (5, 9, 30, 90), (5, 2, "NaN", 30), (5, 2, 1e300, 20),
    )
    run()
    assert spark.table(tables["bronze"]).count() == 10
    bronze = spark.table(tables["bronze"]).where("heartrate = '60.0'").first()
    assert bronze.mrn == "1" and bronze.time == 10.9 and bronze.receipt_time and bronze.source_file.endswith("01.json")
    silver = spark.table(tables["silver"])
    assert silver.columns == ["device_id", "mrn", "name", "time", "heartrate"]
    assert silver.count() == 6
    assert silver.where("heartrate = 60").select(F.unix_micros("time")).first()[0] == 10_000_000
    days = {(r.mrn, r.name, r.date and r.date.day): r.avg_heartrate for r in spark.table(tables["gold"]).collect()}
    assert days == {("1", "Ann", 1): 70.0, ("2", "Bob", 2): 50.5, ("2", "Bob", None): 40.0}

    land(folder, "02.json", (5, 1, 40, 100))
    run()
    assert spark.table(tables["bronze"]).count() == 11  # the first file was not taken up again
    assert spark.table(tables["silver"]).count() == 7
    assert spark.table(tables["gold"]).where("mrn = '1'").first().avg_heartrate == 80.0
    run()  # nothing new
    assert spark.table(tables["bronze"]).count() == 11
    assert spark.table(tables["gold"]).count() == 3


def test_a_batch_of_one_day_writes_only_that_day(spark, folder, lookup):
    tables, work = names(), f"{folder}/work"

    def run(name, *records):
        land(folder, name, *records)
        medallion.run_once(spark, f"{folder}/landing", COLUMNS, HINTS, lookup, tables, work)
        return {(r.mrn, r.date and r.date.day): r.avg_heartrate for r in spark.table(tables["gold"]).collect()}

    every_day = [(5, 1 + i % 2, i * DAY + 5, 60 + i) for i in range(20)]
    first = run("01.json", *every_day, (5, 2, "broken", 50))
    assert len(first) == 21
    second = run("02.json", (5, 1, 2 * DAY + 9, 100), (5, 1, 2 * DAY + 10, 110))  # an earlier day, late
    days = medallion.daily_table(spark, f"{work}/days")
    assert days.snapshot().head == 2
    assert as_set(days.commit_rows(2), "mrn", "total", "n", "_op") == {("1", 62.0 + 210, 3, "U")}
    assert second == {**first, ("1", 3): 272 / 3}
    third = run("03.json", (5, 2, "broken", 70), (5, 2, 40 * DAY, 80))
    assert as_set(days.commit_rows(3), "mrn", "total", "n", "_op") == {("2", 120.0, 2, "U"), ("2", 80.0, 1, "I")}
    assert third == {**second, ("2", None): 60.0, ("2", 10): 80.0}
    assert not list(Path(f"{work}/_checkpoints/days").glob("state/*"))  # no state beside the table


def test_a_repeated_batch_is_not_added_twice(spark, folder):
    rows = spark.createDataFrame([("1", "Ann", 5, 60.0), ("1", "Ann", 6, 80.0), (None, None, None, None)], "mrn string, name string, s int, heartrate double")
    rows = rows.select("mrn", "name", F.timestamp_seconds("s").alias("time"), "heartrate")
    days = medallion.daily_table(spark, f"{folder}/days")
    clauses = [ingest.when_matched_update(values={"total": "t.total + s.total", "n": "t.n + s.n"}), ingest.when_not_matched_insert()]
    for batch in (0, 0, 1):
        days.merge(medallion.daily_sums(rows), clauses, stream="days", batch=batch, check_keys=False)
    assert as_set(days.read(), "mrn", "total", "n") == {("1", 280.0, 4), (None, None, 0)}


def test_stream_equals_batch(spark, folder, lookup):
    land(folder, "01.json", *[(i % 3, i % 4, i * 5000 + 0.5, i % 7 - 1) for i in range(300)])
    tables = names()
    medallion.run_once(spark, f"{folder}/landing", COLUMNS, HINTS, lookup, tables, f"{folder}/work")
    from strandline.sources import read_hinted

    batch = medallion.silver(read_hinted(spark, f"{folder}/landing", COLUMNS, HINTS), lookup)
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, spark.table(tables["silver"]).collect()))
    daily = medallion.gold(batch).select(*spark.table(tables["gold"]).columns)
    key = lambda r: (r.mrn, r.date)
    for a, b in zip(sorted(daily.collect(), key=key), sorted(spark.table(tables["gold"]).collect(), key=key)):
        assert key(a) == key(b) and a.avg_heartrate == pytest.approx(b.avg_heartrate)


def test_continuous_query_is_drained_and_stopped(spark, folder):
    land(folder, "01.json", (1, 1, 1, 1))
    table = new_table_name("bronze")
    raw = medallion.bronze(medallion.raw_files(spark, f"{folder}/landing", COLUMNS, HINTS))
    query = medallion.append_to_table(raw, table, f"{folder}/b", f"{folder}/c", every="0 seconds")
    control.drain(query)
    land(folder, "02.json", (2, 2, 2, 2))
    control.drain(query)
    assert control.stop_all(spark) == 1
    assert as_set(spark.table(table), "device_id") == {("1",), ("2",)}
    assert not spark.streams.active


def test_publisher_never_writes_where_the_table_points(spark, folder):
    table = new_table_name("published")
    publish = complete_publisher(table, folder)
    publish(spark.range(3).toDF("id"), 0)
    publish(spark.range(5).toDF("id"), 1)
    publish(spark.table(table).where("id > 2"), 2)  # reads the old copy while writing the new one
    assert as_set(spark.table(table)) == {(3,), (4,)}
    publish(spark.range(1).toDF("id"), 2)  # a repeated batch
    assert as_set(spark.table(table)) == {(0,)}
    broken = spark.range(8, 0, -1).select(F.when(F.col("id") > 1, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id"))
    with pytest.raises(Exception, match="lost"):  # a batch repeated after the switch, which breaks off
        publish(broken, 2)
    assert as_set(spark.table(table)) == {(0,)}
    assert live_folder(spark, table).startswith(folder)


def test_the_newest_arrival_replaces_the_table_whole(spark, folder, monkeypatch):
    """Several arrivals wait, each larger than a batch may be; later files of an arrival count as well."""
    monkeypatch.setattr(medallion, "BATCH_BYTES", 1)
    monkeypatch.setattr(medallion.raw_files, "__defaults__", tuple(1 if d == 1 << 40 else d for d in medallion.raw_files.__defaults__))
    table = new_table_name("newest")

    def run():
        query = ingest.load_replacing(spark, f"{folder}/landing", COLUMNS, HINTS, table, f"{folder}/r", f"{folder}/c")
        query.awaitTermination()
        return len(query.recentProgress), as_set(spark.table(table), "device_id")

    for part in range(3):
        land(folder, f"9.json/{part}.json", (part, 1, 1, 1))
        land(folder, f"10.json/{part}.json", (10 + part, 1, 1, 1))
    batches, rows = run()
    assert batches >= 6 and rows == {("10",), ("11",), ("12",)}
    land(folder, "10.json/3.json", (13, 1, 1, 1))
    land(folder, "9.json/3.json", (99, 1, 1, 1))
    assert run()[1] == {("10",), ("11",), ("12",), ("13",)}
    land(folder, "11.json", (20, 1, 1, 1))
    assert run()[1] == {("20",)}


def test_old_files_are_taken_in(spark, folder):
    table = new_table_name("late")

    def run():
        raw = medallion.raw_files(spark, f"{folder}/landing", COLUMNS, HINTS)
        medallion.append_to_table(raw, table, f"{folder}/b", f"{folder}/c").awaitTermination()
        return as_set(spark.table(table), "device_id")

    land(folder, "01.json", (1, 1, 1, 1))
    assert run() == {("1",)}
    land(folder, "00.json", (2, 1, 1, 1))
    old = time.time() - 400 * DAY
    os.utime(Path(folder) / "landing/00.json", (old, old))
    assert run() == {("1",), ("2",)}


def test_fields_that_are_not_listed_are_kept(spark, folder):
    path = Path(folder) / "landing" / "x.json"
    path.parent.mkdir(parents=True)
    path.write_text('{"mrn": 1, "time": 2.5, "unit": "bpm", "more": {"a": [1]}}\n\n{"mrn": 2}\n')
    table = new_table_name("whole")
    raw = medallion.raw_files(spark, f"{folder}/landing", ["mrn", "time"], HINTS, rest="others")
    medallion.append_to_table(medallion.bronze(raw), table, f"{folder}/b", f"{folder}/c").awaitTermination()
    rows = {r.mrn: (r.time, r.others and json.loads(r.others)) for r in spark.table(table).collect()}
    assert rows == {"1": (2.5, {"unit": "bpm", "more": '{"a":[1]}'}), "2": (None, None)}


def test_fields_that_are_not_listed_get_types(spark, folder):
    path = Path(folder) / "landing" / "x.json"
    path.parent.mkdir(parents=True)
    lines = ['{"mrn": 1, "count": 2, "unit": "bpm", "more": {"a": [1]}, "odd \'name": true}', "", '{"mrn": 2, "count": 2.5, "unit": 7}', '{"mrn": 3}']
    path.write_text("\n".join(lines) + "\n")
    table = new_table_name("typed")
    raw = medallion.raw_files(spark, f"{folder}/landing", ["mrn"], {}, rest="others", typed=True)
    medallion.append_to_table(medallion.bronze(raw), table, f"{folder}/b", f"{folder}/c").awaitTermination()
    rows = spark.table(table)
    fields = medallion.found_fields(rows, "others")
    assert fields["count"].startswith("decimal(") and fields["unit"] == "variant"  # whole and broken numbers, numbers and text
    assert (fields["more"], fields["odd 'name"], len(fields)) == ("struct<a:array<bigint>>", "boolean", 4)
    got = medallion.with_fields(rows, "others", fields)
    found = {r.mrn: (r["count"] and float(r["count"]), r.more and r.more.a, r["odd 'name"]) for r in got.collect()}
    assert found == {"1": (2.0, [1], True), "2": (2.5, None, None), "3": (None, None, None)}
    assert as_set(medallion.with_fields(rows, "others", {"unit": "string"}), "mrn", "unit") == {("1", "bpm"), ("2", "7"), ("3", None)}
    assert medallion.found_fields(rows.where("mrn = '3'"), "others") == {}


def test_rows_without_a_key_are_set_apart(spark, folder):
    schema = "k int, ts int, v string"
    target = VersionedTable.create(spark, f"{folder}/t", spark.createDataFrame([], schema), ["k"])
    landing = Path(folder) / "landing"
    landing.mkdir(parents=True)

    def run(name, text):
        (landing / name).write_text(text)
        raw = medallion.raw_files(spark, str(landing), ["k", "ts", "v"], {"k": "int", "ts": "int"}).drop("source_file")
        ingest.load_merging(raw, target, ["ts"], f"{folder}/c", "a/b").awaitTermination()
        return as_set(target.read())

    assert run("1.json", '{"k": 1, "ts": 1, "v": "a"}\n{"k": "one", "ts": 1, "v": "bad"}\n') == {(1, 1, "a")}
    assert run("2.json", '{"k": 1, "ts": 2, "v": "b"}\n') == {(1, 2, "b")}
    assert run("3.json", '{"ts": 3, "v": "worse"}\n') == {(1, 2, "b")}
    bad = ingest.rejected_rows(target, "a/b", target.read().schema)
    assert as_set(bad) == {(None, 1, "bad", 0), (None, 3, "worse", 2)}
    assert ingest.rejected_rows(target, "other", target.read().schema).count() == 0


def test_deletes_stand_against_rows_that_arrive_late(spark, folder):
    schema = "k int, ts int, v string, kind string"
    target = VersionedTable.create(spark, f"{folder}/t", ingest.with_tombstones(spark.createDataFrame([], schema)), ["k"])
    landing = Path(folder) / "landing"
    landing.mkdir(parents=True)

    def run(name, *rows, fold=0.5):
        (landing / name).write_text("".join(json.dumps(dict(zip(["k", "ts", "v", "kind"], r))) + "\n" for r in rows))
        raw = medallion.raw_files(spark, str(landing), ["k", "ts", "v", "kind"], {"k": "int", "ts": "int"}).drop("source_file")
        load = ingest.load_merging(raw, target, ["ts"], f"{folder}/c", "s", fold_share=fold, deletes="kind = 'gone'")
        load.awaitTermination()
        return as_set(ingest.live(target.read()), "k", "ts", "v")

    assert run("1.json", (1, 5, "a", "row"), (2, 5, "b", "row"), (3, 9, "c", None)) == {(1, 5, "a"), (2, 5, "b"), (3, 9, "c")}
    # a delete, one that is itself too old, one of a key not seen yet, one overtaken in its own batch, one without a key
    rows = (1, 7, "x", "gone"), (3, 8, "x", "gone"), (4, 6, "x", "gone"), (2, 6, "x", "gone"), (2, 7, "new", "row"), (None, 1, "x", "gone")
    assert run("2.json", *rows, fold=0) == {(2, 7, "new"), (3, 9, "c")}
    assert target.snapshot().base == 2  # the tombstones have gone through a fold
    assert as_set(target.read().where("_gone"), "k", "ts", "v", "kind") == {(1, 7, None, None), (4, 6, None, None)}
    assert run("3.json", (1, 6, "late", "row"), (4, 1, "late", "row"), (4, 5, "late", "row")) == {(2, 7, "new"), (3, 9, "c")}
    assert run("4.json", (1, 8, "back", "row")) == {(1, 8, "back"), (2, 7, "new"), (3, 9, "c")}
    assert ingest.rejected_rows(target, "s", spark.createDataFrame([], schema).schema).count() == 1
    assert ingest.forget(target, "ts < 7") and target.read().where("_gone").isEmpty()
    assert run("5.json", (4, 2, "too late", "row")) == {(1, 8, "back"), (2, 7, "new"), (3, 9, "c"), (4, 2, "too late")}


def test_a_batch_is_parsed_once(spark, folder):
    """Each record is looked at by one pass, however many keys miss; columns a feed lacks stay as they are."""
    start = spark.createDataFrame([(1, 5, "a", 1.5), (2, 5, "b", 2.5)], "k int, ts int, v string, w double")
    target = VersionedTable.create(spark, f"{folder}/t", start, ["k"])
    seen = spark.sparkContext.accumulator(0)
    landing = Path(folder) / "landing"
    landing.mkdir(parents=True)
    (landing / "1.json").write_text('{"k": 1, "ts": 6, "v": "n"}\n{"k": 2, "ts": 4, "v": "old"}\n{"k": 3, "ts": 1, "v": "new"}\n{"ts": 1}\n')

    @F.udf("string")
    def counted(v):
        seen.add(1)
        return v

    raw = medallion.raw_files(spark, str(landing), ["k", "ts", "v"], {"k": "int", "ts": "int"}).drop("source_file")
    raw = raw.withColumn("v", counted("v"))
    ingest.load_merging(raw, target, ["ts"], f"{folder}/c", "s").awaitTermination()
    assert seen.value == 4
    assert as_set(target.read()) == {(1, 6, "n", 1.5), (2, 5, "b", 2.5), (3, 1, "new", None)}


def test_state_partitions_hold_from_the_first_start(spark, folder):
    rows = spark.range(40).selectExpr("string(id) AS mrn", "'n' AS name", "timestamp_seconds(id) AS time", "double(id) AS heartrate")
    table, gold = new_table_name("rows"), new_table_name("gold")
    rows.write.option("path", f"{folder}/t").saveAsTable(table)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    daily = medallion.gold(medallion.table_stream(spark, table))
    medallion.rewrite_table(daily, gold, f"{folder}/g", f"{folder}/c", state_partitions=3).awaitTermination()
    assert {p.name for p in (Path(folder) / "c/state/0").iterdir() if p.name.isdigit()} == {"0", "1", "2"}
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_a_repeated_micro_batch_changes_nothing(spark, folder):
    schema = "k int, ts int, v string"
    table = VersionedTable.create(spark, folder, spark.createDataFrame([], schema), ["k"])
    first = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (2, 1, "c"), (1, 6, "d")], schema)
    newest = ingest.newest_per_key(first, ["k"], ["ts"])
    clauses = [ingest.when_matched_update("struct(s.ts) >= struct(t.ts)"), ingest.when_not_matched_insert()]
    assert table.merge(newest, clauses, stream="s", batch=0) == 1
    assert table.merge(newest, clauses, stream="s", batch=0) == 1
    assert table.merge(newest, clauses, stream="other", batch=0) == 2
    late = spark.createDataFrame([(1, 2, "late"), (2, 9, "new"), (3, 0, "x")], schema)
    assert table.merge(late, clauses, stream="s", batch=1) == 3
    assert as_set(table.read()) == {(1, 7, "b"), (2, 9, "new"), (3, 0, "x")}


def test_merge_and_replace_loads(spark, folder):
    schema = "k int, ts int, v string"
    periods = [[(1, 1, "a"), (2, 1, "b")], [(1, 3, "c"), (1, 2, "d")], [(2, 0, "old"), (3, 5, "e")]]
    rows = spark.createDataFrame([(*r, i) for i, p in enumerate(periods, 1) for r in p], schema + ", p int")
    replay = ArrivalReplay.stage(rows, F.col("p"), f"{folder}/staged", f"{folder}/landing")
    target = VersionedTable.create(spark, f"{folder}/t", spark.createDataFrame([], schema), ["k"])
    name, kinds = new_table_name("last"), {"k": "int", "ts": "int"}
    delivered = 0
    while replay.deliver() is not None:
        delivered += 1
        raw = medallion.raw_files(spark, replay.landing, ["k", "ts", "v"], kinds, bytes_per_batch=None)
        raw = raw.drop("source_file")
        ingest.load_merging(raw, target, ["ts"], f"{folder}/cm", "s", fold_share=1e9 if delivered > 2 else 0).awaitTermination()
        ingest.load_replacing(spark, replay.landing, ["k", "ts", "v"], kinds, name, f"{folder}/r", f"{folder}/cr").awaitTermination()
        assert as_set(spark.table(name)) == set(periods[delivered - 1])
    assert delivered == 3 and replay.deliver() is None
    assert as_set(target.read()) == {(1, 3, "c"), (2, 1, "b"), (3, 5, "e")}
    assert target.snapshot().base == 2


def test_replay_delivers_in_order(spark, folder):
    rows = spark.range(30).select("id", (F.col("id") % 3 + 1).alias("p"))
    replay = ArrivalReplay.stage(rows, F.col("p"), f"{folder}/staged", f"{folder}/landing")
    assert replay.next_number() == 1 and replay.last_number() == 3
    assert replay.deliver() == 1
    assert as_set(spark.read.json(f"{folder}/landing/01.json"), "id") == {(i,) for i in range(0, 30, 3)}
    assert replay.deliver_all() == 2
    everything = spark.read.option("recursiveFileLookup", True).json(f"{folder}/landing")
    assert sorted(r.id for r in everything.collect()) == list(range(30))


def test_limited_batches_give_the_same_result(spark, folder, lookup):
    table = new_table_name("readings")
    rows = spark.range(0, 60, 1, 6).selectExpr(
        "'d' AS device_id", "string(id % 3) AS mrn", "double(id) * 40000 AS time", "string(id) AS heartrate"
    )
    rows.write.option("path", f"{folder}/t").saveAsTable(table)
    results, batches = [], []
    for limit in (1, None):
        silver, gold = new_table_name("silver"), new_table_name("gold")
        work = f"{folder}/{limit}"
        enriched = medallion.silver(medallion.table_stream(spark, table, limit), lookup)
        query = medallion.append_to_table(enriched, silver, f"{work}/s", f"{work}/cs")
        query.awaitTermination()
        batches.append(len(query.recentProgress))
        daily = medallion.gold(medallion.table_stream(spark, silver, limit))
        medallion.rewrite_table(daily, gold, f"{work}/g", f"{work}/cg").awaitTermination()
        results.append({(r.mrn, r.date): round(r.avg_heartrate, 9) for r in spark.table(gold).collect()})
    assert batches[0] >= 6 > batches[1]
    assert results[0] == results[1] and len(results[0]) > 10
