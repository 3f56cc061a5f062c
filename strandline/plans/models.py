"""Named queries that read declared sources and each other."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from strandline.operators import checks
from strandline.session import new_folder
from strandline.sinks import replace_table


@dataclass(frozen=True)
class Model:
    """A query over its ``reads``, by name: ``build`` gets one frame for each.

    ``kind`` is "view" or "table"; without it the default of the run applies.
    """

    name: str
    reads: Sequence[str]
    build: Callable[..., DataFrame]
    kind: str | None = None
    unique: Sequence[str] = field(default=())
    not_null: Sequence[str] = field(default=())


def run_models(
    spark: SparkSession,
    models: Sequence[Model],
    sources: Mapping[str, DataFrame | str] | None = None,
    default_kind: str = "view",
) -> dict[str, DataFrame]:
    """Build every model after those it reads. Returns the frames by model name.

    A declared source is a frame or the path of a parquet dataset.
    """
    sources = {
        name: spark.read.parquet(s) if isinstance(s, str) else s for name, s in (sources or {}).items()
    }
    by_name = {m.name: m for m in models}
    unknown = {r for m in models for r in m.reads} - by_name.keys() - sources.keys()
    if unknown:
        raise KeyError(f"neither a model nor a source: {sorted(unknown)}")
    order = TopologicalSorter({m.name: [r for r in m.reads if r in by_name] for m in models})
    built: dict[str, DataFrame] = {}
    for name in order.static_order():
        model = by_name[name]
        df = model.build(*[built[r] if r in built else sources[r] for r in model.reads])
        kind = model.kind or default_kind
        if kind == "table":
            df = replace_table(df, name, new_folder(spark, name))
        elif kind == "view":
            df.createOrReplaceTempView(name)
            df = spark.table(name)
        else:
            raise ValueError(f"{name}: unknown kind {kind}")
        built[name] = df
    return built


def check_models(models: Sequence[Model], built: Mapping[str, DataFrame]) -> DataFrame:
    """Failures of the checks declared on the models, one row per check."""
    out = None
    for m in models:
        if m.unique or m.not_null:
            one = checks.failures(built[m.name], m.name, m.unique, m.not_null)
            out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no model declares a check")
    return out
