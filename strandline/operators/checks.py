"""Data checks. Each returns the offending rows, so an empty frame means the check passed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def not_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count. NULLs are left to ``is_null``."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def is_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def _all_null(df: DataFrame) -> Column:
    empty = F.lit(True)
    for c in df.columns:
        empty = empty & F.col(c).isNull()
    return empty


def all_null_rows(df: DataFrame) -> DataFrame:
    return df.where(_all_null(df))


def drop_all_null_rows(df: DataFrame) -> DataFrame:
    return df.na.drop(how="all")


def failures(
    df: DataFrame, table: str, unique: Sequence[str] = (), not_null: Sequence[str] = ()
) -> DataFrame:
    """One row per declared check with the number of failures; 0 means passed."""
    results = []
    for c in unique:
        results.append(
            not_unique(df, c).agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
                F.lit("unique").alias("check_name"), "failures",
            )
        )
    if not_null:  # all of them in one pass
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(not_null)])
        entries = [
            F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("failures"))
            for i, c in enumerate(not_null)
        ]
        results.append(
            counts.select(F.explode(F.array(*entries)).alias("e")).select(
                F.lit(table).alias("table_name"), F.col("e.column_name"),
                F.lit("not_null").alias("check_name"), F.col("e.failures"),
            )
        )
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    by: Column | None = None,
    distinct: bool = True,
) -> DataFrame:
    """Count, NULLs, range, mean and approximate distinct values of each column, in one pass.

    ``by`` (such as a day) gives one profile per group. Ranges of numbers are given as numbers, those of
    integers and decimals exactly (``decimal(38, 10)``, NULL where a double is no such number) beside the
    double; everything else as text. ``distinct=False`` leaves the sketch out.
    """
    columns = list(columns or df.columns)
    measures = [F.count(F.lit(1)).alias("rows")]
    entries = []
    for i, c in enumerate(columns):
        numeric = isinstance(df.schema[c].dataType, T.NumericType)
        col = F.col(c)
        low, high = F.min(col), F.max(col)
        measures += [F.count_if(col.isNull()).alias(f"null{i}"), low.alias(f"low{i}"), high.alias(f"high{i}")]
        if numeric:
            measures.append(F.avg(col).alias(f"mean{i}"))
        if distinct:
            measures.append(F.approx_count_distinct(col).alias(f"distinct{i}"))

        def as_number(name: str, numeric: bool = numeric) -> Column:
            return F.col(name).cast("double") if numeric else F.lit(None).cast("double")

        def as_exact(name: str, kind: T.DataType = df.schema[c].dataType) -> Column:
            whole = isinstance(kind, (T.IntegralType, T.DecimalType))
            return F.col(name).cast("decimal(38,10)") if whole else F.lit(None).cast("decimal(38,10)")

        def as_text(name: str, numeric: bool = numeric) -> Column:
            return F.lit(None).cast("string") if numeric else F.col(name).cast("string")

        fields = [
            F.lit(c).alias("column_name"),
            F.col("rows"),
            F.col(f"null{i}").alias("nulls"),
            as_number(f"low{i}").alias("min_number"),
            as_number(f"high{i}").alias("max_number"),
            as_exact(f"low{i}").alias("min_exact"),
            as_exact(f"high{i}").alias("max_exact"),
            (F.col(f"mean{i}").cast("double") if numeric else F.lit(None).cast("double")).alias("mean"),
            as_text(f"low{i}").alias("min_text"),
            as_text(f"high{i}").alias("max_text"),
        ]
        if distinct:
            fields.append(F.col(f"distinct{i}").alias("approx_distinct"))
        entries.append(F.struct(*fields))
    grouped = df.agg(*measures) if by is None else df.groupBy(by.alias("grp")).agg(*measures)
    head = [] if by is None else ["grp"]
    return grouped.select(*head, F.explode(F.array(*entries)).alias("e")).select(*head, "e.*")


# -- profiles over time: sketches kept per group, merged and compared without the rows -------------------------

# Of values 2^12 are kept: counts are exact up to there and 1.6 % off (one standard error) beyond.
THETA_BITS = 12
# Places of numbers in order are right to about 1.3 % of the rows.
KLL_SIZE = 200
# Distributions are compared at so many places of each.
PLACES = 16


def _told_apart(df: DataFrame, c: str) -> Column:
    """A form of a column's values that sketches take; empty texts count as values."""
    kind = df.schema[c].dataType
    if isinstance(kind, (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)):
        return F.col(c)
    return F.concat(F.lit("="), F.col(c).cast("string"))


def sketches(df: DataFrame, columns: Sequence[str], by: Column) -> DataFrame:
    """Per group (such as a day) and column: rows, NULLs, a sketch of the values, and one of the order of numbers.

    One pass, reduced in each task. The result is small and is kept instead of the rows: what comes in later for the
    same group is sketched by itself and merged (``merged_sketches``).
    """
    measures = [F.count(F.lit(1)).alias("rows")]
    entries = []
    for i, c in enumerate(columns):
        numeric = isinstance(df.schema[c].dataType, T.NumericType)
        measures.append(F.count_if(F.col(c).isNull()).alias(f"null{i}"))
        measures.append(F.theta_sketch_agg(_told_apart(df, c), THETA_BITS).alias(f"values{i}"))
        if numeric:
            measures.append(F.kll_sketch_agg_double(F.col(c).cast("double"), KLL_SIZE).alias(f"numbers{i}"))
        numbers = F.col(f"numbers{i}") if numeric else F.lit(None).cast("binary")
        entries.append(
            F.struct(
                F.lit(c).alias("column_name"), "rows", F.col(f"null{i}").alias("nulls"),
                F.col(f"values{i}").alias("values"), numbers.alias("numbers"),
            )
        )
    grouped = df.groupBy(by.alias("grp")).agg(*measures)
    return grouped.select("grp", F.explode(F.array(*entries)).alias("e")).select("grp", "e.*")


def merged_sketches(kept: DataFrame, by: Column | None = None) -> DataFrame:
    """Sketches of the same group put together; ``by`` makes wider groups of them, such as weeks of days."""
    grouped = kept.groupBy((F.col("grp") if by is None else by).alias("grp"), "column_name")
    return grouped.agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.theta_union_agg("values", THETA_BITS).alias("values"),
        F.kll_merge_agg_double("numbers", KLL_SIZE).alias("numbers"),
    )


def _has_numbers(sketch: Column) -> Column:
    return sketch.isNotNull() & (F.kll_sketch_get_n_double(sketch) > 0)


def sketched_profile(kept: DataFrame, fractions: Sequence[float] = (0.05, 0.5, 0.95)) -> DataFrame:
    """What the sketches say of each group: rows, NULLs, distinct values, and numbers at fractions of the order."""
    wanted = F.array(*(F.lit(float(f)) for f in fractions))
    quantiles = F.when(_has_numbers(F.col("numbers")), F.kll_sketch_get_quantile_double("numbers", wanted))
    return kept.select(
        "grp", "column_name", "rows", "nulls", F.theta_sketch_estimate("values").alias("approx_distinct"), quantiles.alias("quantiles")
    )


def drift(kept: DataFrame, limits: dict[str, Sequence[float]] | None = None) -> DataFrame:
    """Each group beside the one before it: how far a column has moved.

    ``null_shift`` is the change of the share of NULLs. ``overlap`` is the share of values, of those in either group, that
    are in both. ``distance`` is the largest difference between the shares of numbers up to a place (Kolmogorov and
    Smirnov's), taken at the ``limits`` given for a column, otherwise at places that part all groups' numbers evenly.
    A group's first of a column has nothing before it: NULL throughout.
    """
    if limits is None:
        fractions = [i / PLACES for i in range(1, PLACES)]
        whole = sketched_profile(merged_sketches(kept, F.lit(0)), fractions).where("quantiles IS NOT NULL")
        limits = {r.column_name: r.quantiles for r in whole.collect()}  # a row per column
    order = Window.partitionBy("column_name").orderBy("grp")
    names = ["grp", "rows", "nulls", "values", "numbers"]
    pairs = kept.withColumns({f"_{c}": F.lag(c).over(order) for c in names})
    now, before = F.col("numbers"), F.col("_numbers")
    both = _has_numbers(now) & _has_numbers(before)
    moved = F.lit(None).cast("double")
    for c, places in limits.items():
        at = F.array(*(F.lit(float(x)) for x in places))
        shares = [F.kll_sketch_get_rank_double(s, at) for s in (now, before)]
        most = F.array_max(F.zip_with(*shares, lambda a, b: F.abs(a - b)))
        moved = F.when((F.col("column_name") == c) & both, most).otherwise(moved)
    present = F.col("_grp").isNotNull()
    common = F.theta_sketch_estimate(F.theta_intersection("values", "_values"))
    either = F.theta_sketch_estimate(F.theta_union("values", "_values", F.lit(THETA_BITS)))
    return pairs.select(
        "grp",
        F.col("_grp").alias("grp_before"),
        "column_name",
        "rows",
        "nulls",
        F.theta_sketch_estimate("values").alias("approx_distinct"),
        F.when(present, F.col("nulls") / F.col("rows") - F.col("_nulls") / F.col("_rows")).alias("null_shift"),
        F.when(present, F.try_divide(common, either)).alias("overlap"),
        moved.alias("distance"),
    )
