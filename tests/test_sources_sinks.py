from __future__ import annotations

from pathlib import Path

import pytest
from conftest import as_set
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from strandline import session, sinks, sources, tables
from strandline.session import new_table_name


def write_file(folder: str, name: str, text: str) -> str:
    path = Path(folder.removeprefix("file:")) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_control_character_file(spark, folder):
    path = write_file(folder, "d.csv", "col1\x01col2\x01col3\n1\x012\x013\naaa\x01bbb\x01ccc\n")
    df = sources.read_delimited(spark, path)
    assert df.columns == ["col1", "col2", "col3"]
    assert as_set(df) == {("1", "2", "3"), ("aaa", "bbb", "ccc")}


def test_fixed_width_file(spark, folder):
    lines = ["    1 123121234 joe", "    2 234234234jill", "    3 345345345jane", "    4abcde12345jack"]
    path = write_file(folder, "f.txt", "\n".join(lines))
    layout = [("id", 5, "int"), ("code", 10, "string"), ("name", 4, "string")]
    assert as_set(sources.read_fixed_width(spark, path, layout)) == {
        (1, "123121234", "joe"), (2, "234234234", "jill"), (3, "345345345", "jane"), (4, "abcde12345", "jack")
    }
    layout[1] = ("code", 10, "bigint")
    assert (4, None, "jack") in as_set(sources.read_fixed_width(spark, path, layout))


def test_csv_with_and_without_inference(spark, folder):
    path = write_file(folder, "c.csv", "color,price\nE,326\nI,335.5\n")
    assert dict(sources.read_csv(spark, path).dtypes) == {"color": "string", "price": "string"}
    assert dict(sources.read_csv(spark, path, infer=True).dtypes)["price"] == "double"
    assert as_set(sources.read_csv(spark, "file:" + path, schema="color string, price double")) == {
        ("E", 326.0), ("I", 335.5)
    }
    table = sources.csv_table(spark, new_table_name("c"), path, infer=True)
    assert dict(table.dtypes)["price"] == "double"


def test_hints_turn_bad_values_into_null(spark, folder):
    path = write_file(folder, "r.json", '{"mrn": 7, "time": 1.5}\n{"mrn": "x", "time": "soon"}\n')
    df = sources.read_hinted(spark, path, ["mrn", "time", "absent"], {"time": "double"})
    assert as_set(df) == {("7", 1.5, None), ("x", None, None)}
    assert as_set(sources.read_by_path(spark, "json", path), "mrn") == {("7",), ("x",)}
    assert sources.count_rows(spark, "json", path) == 2


def test_inline_rows(spark):
    df = sources.inline_rows(spark, "u", ["id", "value"], [(1, 15.2), (2, None)])
    text = "x'), (9, 'y"
    assert as_set(sources.inline_rows(spark, "u", ["id", "a `b"], [(1, text)])) == {(1, text)}
    df = sources.inline_rows(spark, "u", ["id", "value"], [(1, 15.2), (2, None)])
    assert [(r.id, None if r.value is None else float(r.value)) for r in df.orderBy("id").collect()] == [
        (1, 15.2), (2, None)
    ]


def test_typed_table_appends_and_arity_error(spark, folder):
    name = new_table_name("students")
    sinks.create_table(spark, name, "id INT, name STRING", folder)
    sinks.create_table(spark, name, "id INT, name STRING", folder)  # already there
    sinks.insert_values(spark, name, [(1, "Yve"), (2, None)])
    sinks.append_rows(spark.createDataFrame([("Ted", 4)], "name string, id int"), name)  # by name
    assert as_set(spark.table(name)) == {(1, "Yve"), (2, None), (4, "Ted")}
    with pytest.raises(AnalysisException):
        sinks.insert_values(spark, name, [(11, "Tom", 4.0)])
    assert spark.table(name).count() == 3
    sinks.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_audit_row_text_is_data(spark, folder):
    name = new_table_name("audit")
    sinks.create_table(spark, name, "task STRING, run_time TIMESTAMP", folder)
    sinks.append_audit_row(spark, name, "Task '2'); DROP TABLE x")
    row = spark.table(name).first()
    assert row.task == "From Task '2'); DROP TABLE x" and row.run_time is not None


def test_replace_copy_and_database(spark, folder):
    database = new_table_name("db")
    sinks.reset_database(spark, database, f"{folder}/db")
    name = f"{database}.loaded"
    rows = spark.range(10).toDF("id")
    sinks.replace_table(sinks.with_load_time(rows), name, f"{folder}/loaded")
    loaded = sinks.replace_table(sinks.with_load_time(rows.where("id < 4")), name, f"{folder}/loaded")
    assert loaded.count() == 4 and loaded.where("updated IS NULL").count() == 0
    assert sinks.copy_dataset(spark, f"{folder}/loaded", f"{folder}/copy") == 4
    external = sources.external_table(spark, new_table_name("ext"), f"{folder}/copy")
    assert as_set(external, "id") == {(0,), (1,), (2,), (3,)}
    details = {r.col_name: r.data_type for r in sources.describe_table(spark, f"{name}").collect()}
    assert details["id"] == "bigint" and details["Location"].endswith("/loaded")
    sinks.reset_database(spark, database, f"{folder}/db2")
    assert not spark.catalog.tableExists(name)


def test_shared_folder_comes_from_the_session(spark):
    assert session.new_folder(spark, "x").startswith(session.shared_root(spark))
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert session.shared_root(spark) == configured.rstrip("/")


class RecordingReader:
    """Stands in for a database: keeps the options, answers the bounds query."""

    def __init__(self, log, bounds):
        self.log, self.bounds, self.set = log, bounds, {}

    def format(self, name):
        assert name == "jdbc"
        return RecordingReader(self.log, self.bounds)

    def option(self, key, value):
        return self.options(**{key: value})

    def options(self, **kw):
        self.set.update(kw)
        return self

    def load(self):
        self.log.append(self.set)
        return self

    def first(self):
        return self.bounds


@pytest.mark.parametrize("bounds,split", [((1, 900), True), ((None, None), False)])
def test_database_reads_are_split_by_range(bounds, split):
    log = []
    fake = type("FakeSession", (), {"read": RecordingReader(log, bounds)})()
    sources.read_jdbc(fake, "jdbc:x", "users", "id", partitions=8, user="u")
    assert "MIN(id)" in log[0]["query"]
    assert log[1]["dbtable"] == "users" and log[1]["user"] == "u"
    assert ("partitionColumn" in log[1]) == split
    if split:
        assert (log[1]["lowerBound"], log[1]["upperBound"], log[1]["numPartitions"]) == (1, 900, 8)


def test_all_null_rows_are_added(spark):
    df = sinks.append_null_rows(spark.createDataFrame([(1, "a")], "i int, s string"), 3)
    assert df.count() == 4 and df.where(F.col("i").isNull() & F.col("s").isNull()).count() == 3


def test_appending_refuses_columns_the_table_lacks(spark, folder):
    name = new_table_name("narrow")
    sinks.create_table(spark, name, "id INT, s STRING", folder)
    sinks.append_rows(spark.createDataFrame([("a", 1)], "s string, id int"), name)
    with pytest.raises(sinks.UnknownColumns, match="extra"):
        sinks.append_rows(spark.createDataFrame([(2, "b", 3)], "id int, s string, extra int"), name)
    assert as_set(spark.table(name)) == {(1, "a")}


def test_shuffles_are_sized_by_what_a_plan_reads(spark, folder, monkeypatch):
    spark.range(20000).write.parquet(f"{folder}/large")
    spark.range(10).write.parquet(f"{folder}/small")
    large, small = (spark.read.parquet(f"{folder}/{n}") for n in ("large", "small"))
    total = tables.dataset_bytes(spark, f"{folder}/large")
    assert total > tables.plan_bytes(small) > 0 and tables.plan_bytes(large) == pytest.approx(total, rel=0.01)
    assert tables.plan_bytes(large.join(small, "id")) == tables.plan_bytes(large) + tables.plan_bytes(small)
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(tables, "PARTITION_BYTES", total / 500_000)
    with tables.sized_shuffles(large) as count:
        assert count == pytest.approx(500_000, rel=0.01)  # no limit
        assert spark.conf.get(tables.INITIAL_PARTITIONS) == str(count)
    assert spark.conf.get(tables.INITIAL_PARTITIONS, None) is None
    monkeypatch.setattr(tables, "PARTITION_BYTES", total)
    with tables.sized_shuffles(small) as count:
        assert count == configured
    with pytest.raises(KeyError), tables.sized_shuffles(large):
        raise KeyError
    assert spark.conf.get(tables.INITIAL_PARTITIONS, None) is None
