from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def sql_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(name: str, dotted: bool = True) -> str:
    """A name in backticks, part by part unless it is one part with dots in it."""
    parts = name.split(".") if dotted else [name]
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def csv_table(spark: SparkSession, name: str, path: str, infer: bool = False) -> DataFrame:
    """Register CSV files with a header as a table; nothing is copied."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) USING csv "
        f"OPTIONS (path {sql_literal(path)}, header 'true', inferSchema '{str(infer).lower()}')",
        args={"name": name},
    )
    return spark.table(name)


def external_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Register existing files as a table at their location."""
    if not fmt.isidentifier():
        raise ValueError(f"not a format: {fmt}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) USING {fmt} LOCATION {sql_literal(path)}",
        args={"name": name},
    )
    return spark.table(name)


def value_rows(rows: Sequence[Sequence[object]]) -> tuple[str, dict[str, object]]:
    """``(:v0, :v1), (:v2, :v3)`` and the values: they are parameters, never part of the text."""
    names = iter(f"v{i}" for i in range(sum(map(len, rows))))
    args: dict[str, object] = {}
    lines = []
    for row in rows:
        marks = []
        for value in row:
            name = next(names)
            args[name] = value
            marks.append(f":{name}")
        lines.append(f"({', '.join(marks)})")
    return ", ".join(lines), args


def inline_rows(spark: SparkSession, view: str, columns: Sequence[str], rows: Sequence[Sequence[object]]) -> DataFrame:
    """A temp view over literal rows; None is NULL."""
    text, args = value_rows(rows)
    names = ", ".join(quoted(c, dotted=False) for c in columns)
    df = spark.sql(f"SELECT * FROM VALUES {text} AS given({names})", args=args)
    df.createOrReplaceTempView(view)
    return df


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """Columns, location and other details of a table."""
    return spark.sql("DESCRIBE EXTENDED IDENTIFIER(:name)", args={"name": name})
