"""The operators run on the given tables, each with an equivalent SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strandline.queries import basics, files, layout, quality, streams, versions

_MODULES = (basics, files, versions, layout, streams, quality)

Query = Callable[[SparkSession, str], DataFrame]


QUERIES: dict[str, Query] = {name: run for module in _MODULES for name, run in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
