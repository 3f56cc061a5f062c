from __future__ import annotations

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from strandline.functions import (
    Total,
    cents,
    clean_identifier,
    epoch_to_timestamp,
    local_part,
    next_file_number,
    two_digits,
    user_identifier,
)
from strandline.operators import checks
from strandline.plans import reports
from strandline.plans.models import Model, check_models, run_models
from strandline.queries import QUERIES
from strandline.session import new_table_name, settings


def one(spark, expression):
    return spark.range(1).select(expression).first()[0]


def test_text_functions(spark):
    assert one(spark, clean_identifier(F.lit("a.b@c-d 1"))) == "a_b_c_d_1"
    assert one(spark, local_part(F.lit("jo.an.x@example.com"))) == "jo_an_x"
    assert [one(spark, two_digits(F.lit(n))) for n in (0, 7, 12, 123)] == ["00", "07", "12", "123"]
    assert "@" not in one(spark, user_identifier())


def test_next_file_number(spark):
    df = spark.createDataFrame([("01.json",), ("11.json",), ("9.json",), ("notes",)], "name string")
    assert df.agg(next_file_number("name")).first()[0] == 12
    assert df.where("false").agg(next_file_number("name")).first()[0] == 1


def test_epoch(spark):
    for value, expected in [(0.0, 0), (1.99, 1), (1.7e9, 1_700_000_000), (float("nan"), None), (1e300, None),
                            (float("-inf"), None)]:
        got = one(spark, F.unix_seconds(epoch_to_timestamp(F.lit(value))))
        assert got == expected


def sums(df, by_step=False):
    total = Total("x")
    if not by_step:
        return df.agg(*total.start("x", cents("x"))).select(total.value()).first()[0]
    return df.groupBy("k").agg(*total.start("x", cents("x"))).agg(*total.again()).select(total.value()).first()[0]


def test_amounts_are_added_exactly_and_never_rounded(spark):
    money = spark.createDataFrame([(1, 0.1), (2, 0.2), (1, None), (2, 1e9 + 0.07)], "k int, x double")
    assert sums(money) == sums(money, True) == 1000000000.37
    assert reports.mean_by_key(money.withColumn("k", F.lit(1)), "k", "x", "m").first().m == 1000000000.37 / 3
    fine = spark.createDataFrame([(1, 0.004), (2, 0.004), (2, 0.004)], "k int, x double")
    assert sums(fine) == sums(fine, True) == pytest.approx(0.012, rel=1e-12)
    assert reports.mean_by_key(fine, "k", "x", "m").collect()[1].m == pytest.approx(0.004)
    for odd in (float("nan"), float("inf")):
        df = spark.createDataFrame([(1, 0.5), (2, odd)], "k int, x double")
        assert str(sums(df)) == str(sums(df, True)) == str(odd)
    assert sums(spark.createDataFrame([(1, 8e13), (1, 8e13), (1, 1e14)], "k int, x double")) == 2.6e14
    assert sums(spark.createDataFrame([(1, None)], "k int, x double")) is None
    assert sums(spark.createDataFrame([(i, 9e12) for i in range(20_000)], "k int, x double"), True) == 1.8e17


def test_totals_beyond_the_halves_are_plain_sums(spark):
    total = Total("x")
    df = spark.range(0, 4_000_000, 1, 4).select((F.col("id") % 3).alias("k"), F.lit(1.0).alias("x"), F.lit(2**63 - 1).alias("whole"))
    first = df.groupBy("k").agg(*total.start("x", F.col("whole")))
    assert {r[0] for r in first.select(total.value()).collect()} == {1333333.0, 1333334.0}
    assert first.agg(*total.again()).select(total.value()).first()[0] == 4_000_000.0


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, None), (None, None), (2, None)], "id int, s string")
    assert as_set(checks.not_unique(df, "id")) == {(1, 2)}
    assert checks.is_null(df, "id").count() == 2
    assert checks.all_null_rows(df).count() == 2 and checks.drop_all_null_rows(df).count() == 3
    got = as_set(checks.failures(df, "t", unique=["id", "s"], not_null=["id", "s"]))
    assert got == {("t", "id", "unique", 1), ("t", "s", "unique", 0), ("t", "id", "not_null", 2),
                   ("t", "s", "not_null", 3)}


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (3, "b"), (None, "b")], "id int, s string")
    rows = {r.column_name: r for r in checks.profile(df).collect()}
    assert (rows["id"].rows, rows["id"].nulls, rows["id"].min_number, rows["id"].max_number, rows["id"].mean,
            rows["id"].approx_distinct) == (3, 1, 1.0, 3.0, 2.0, 2)
    assert (rows["s"].min_text, rows["s"].max_text, rows["s"].mean) == ("a", "b", None)
    big = spark.createDataFrame([(9007199254740993,), (-1,)], "n long")
    row = checks.profile(big).first()
    assert (int(row.max_exact), int(row.min_exact), row.max_number) == (9007199254740993, -1, 9007199254740992.0)
    grouped = checks.profile(df, ["id"], by=F.col("s"), distinct=False)
    assert as_set(grouped, "grp", "rows", "nulls") == {("a", 1, 0), ("b", 2, 1)}


def test_models_run_in_order_and_are_checked(spark):
    first, second = new_table_name("first"), new_table_name("second")
    models = [
        Model(second, [first], lambda m: m.where("id = 1"), unique=["id"], not_null=["id"]),
        Model(first, [], lambda: spark.sql("SELECT 1 AS id UNION ALL SELECT NULL AS id"), kind="table",
              unique=["id"], not_null=["id"]),
    ]
    built = run_models(spark, models)
    assert as_set(built[first]) == {(1,), (None,)} and as_set(built[second]) == {(1,)}
    assert {t.name for t in spark.catalog.listTables() if t.name in (first, second) and not t.isTemporary} == {first}
    failed = as_set(check_models(models, built).where("failures > 0"))
    assert failed == {(first, "id", "not_null", 1)}
    with pytest.raises(KeyError):
        run_models(spark, [Model("m", ["nowhere"], lambda m: m)])


def test_parameters_are_values(spark):
    spark.range(3).createOrReplaceTempView("numbers_here")
    text = "x' OR '1'='1"
    assert reports.select_where(spark, "SELECT id FROM numbers_here WHERE string(id) = :v", v=text).count() == 0
    assert reports.table_by_name(spark, "numbers_here").count() == 3
    query = "SELECT :year AS y"
    assert reports.select_where(spark, query, {"year": "2014"}).first().y == "2014"
    assert reports.select_where(spark, query, {"year": "2014"}, year="2015").first().y == "2015"


def test_a_declared_source_may_be_a_path(spark, data):
    model = Model(new_table_name("m"), ["sample.nation"], lambda n: n.where("n_nationkey < 3"))
    built = run_models(spark, [model], {"sample.nation": f"{data}/nation.parquet"})
    assert built[model.name].count() == 3


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["qry_product_profit", "qry_product_profit_sql"])
def test_profit_plan(spark, data, name):
    plan = physical(QUERIES[name](spark, data))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "StringContains(p_name,red)" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan
    # the wanted parts cut both scans of the lines before their first shuffle
    assert plan.count("LeftSemi, BuildRight") >= 2


@pytest.mark.parametrize("name", ["qry_product_profit", "qry_product_profit_sql"])
def test_profit_without_broadcasts(spark, data, name):
    expected = [tuple(r) for r in QUERIES["qry_product_profit"](spark, data).collect()]
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    with settings(spark, off):
        df = QUERIES[name](spark, data)
        assert "Broadcast" not in physical(df)
        assert [tuple(r) for r in df.collect()] == expected


@pytest.mark.parametrize("name,key", [("jon_revenue_by_segment", "o_custkey"), ("agg_sum_by_key", "l_partkey")])
def test_facts_are_aggregated_before_they_are_shuffled(spark, data, name, key):
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    with settings(spark, off):
        plan = physical(QUERIES[name](spark, data))
    assert f"Exchange hashpartitioning({key}" in plan
    below = plan[plan.index(f"Exchange hashpartitioning({key}"):]
    assert below.index("HashAggregate") < below.index("FileScan")
    assert plan.count(f"hashpartitioning({key}") == 1  # the join reuses the aggregate's shuffle


@pytest.mark.parametrize(
    "name,filters",
    [
        ("flt_between", "GreaterThanOrEqual(o_orderdate,1997-01-17T00:00)"),
        ("flt_gt", "GreaterThan(c_acctbal,0.0)"),
        ("flt_in_cte", "In(c_mktsegment, [BUILDING,MACHINERY])"),
        ("qry_product_profit_sql", "StringContains(p_name,red)"),
        ("flt_like", "StringContains(p_name,red)"),
    ],
)
def test_filters_reach_the_scan(spark, data, name, filters):
    assert filters in physical(QUERIES[name](spark, data))


def test_a_hot_key_is_split_not_gathered(spark):
    """A third of the readings belong to one entity; without broadcasts AQE must split it."""
    from strandline.streaming.medallion import silver

    n = 90_000
    readings = spark.range(0, n, 1, 8).select(
        F.lit("d").alias("device_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).cast("string").alias("mrn"),
        F.col("id").cast("double").alias("time"),
        F.abs(F.xxhash64("id")).cast("string").alias("heartrate"),
    )
    lookup = spark.range(n).select(F.col("id").cast("string").alias("mrn"), F.lit("n").alias("name"))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    with settings(spark, small):
        joined = silver(readings, lookup).select("mrn", "heartrate")
        rows = joined.collect()
        assert len(rows) == n and sum(r.mrn == "7" for r in rows) == n // 3 + 1
        assert "SortMergeJoin(skew=true)" in physical(joined)
