from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions import apply_hints
from strandline.sources.tables import quoted


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType | None = None,
    infer: bool = False,
    header: bool = True,
) -> DataFrame:
    """CSV with a header.

    Without ``schema`` and ``infer`` every column is a string. Inference reads all
    the data once more, so pass a schema where the types are known.
    """
    reader = spark.read.option("header", header)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_delimited(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None, sep: str = "\x01"
) -> DataFrame:
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_fixed_width(
    spark: SparkSession, path: str, layout: Sequence[tuple[str, int, str]]
) -> DataFrame:
    """Text records without separators. ``layout`` lists (name, width, type) from left to right.

    Values are trimmed; one that does not fit its type becomes NULL.
    """
    fields = []
    start = 1
    for name, width, kind in layout:
        fields.append(F.trim(F.substring("value", start, width)).try_cast(kind).alias(name))
        start += width
    return spark.read.text(path).select(*fields)


def hinted_schema(columns: Sequence[str]) -> T.StructType:
    """Every column a string: the raw form that type hints are applied to."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_hinted(
    spark: SparkSession, path: str, columns: Sequence[str], hints: dict[str, str], fmt: str = "json"
) -> DataFrame:
    return apply_hints(spark.read.format(fmt).schema(hinted_schema(columns)).load(path), hints)


def read_by_path(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    """``SELECT * FROM format.`path```: files addressed as a table."""
    return spark.sql(f"SELECT * FROM {fmt}.{quoted(path, dotted=False)}")


def count_rows(spark: SparkSession, fmt: str, path: str) -> int:
    return spark.read.format(fmt).load(path).count()
