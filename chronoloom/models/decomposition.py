"""Forecasts of a decomposition: a model for each component, put together.

A component is a column of the decomposition with a forecast of its own; means
and variances add up, and a transformation is undone at the end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from chronoloom.functions.transforms import Transform
from chronoloom.models.simple import fit_simple, forecast_simple
from chronoloom.models.smoothing import Ets, fit_ets, forecast_ets
from chronoloom.operators.blocks import cut_lineage
from chronoloom.operators.forecast import back_transform
from chronoloom.series import SeriesSpec

#: Makes (keys, t, h, mean, sigma) for a column of a decomposition.
Component = Callable[[DataFrame, SeriesSpec, str, int], DataFrame]


def seasonal(period: int) -> Component:
    """The last cycle again."""
    def run(df: DataFrame, spec: SeriesSpec, column: str, h: int) -> DataFrame:
        own = spec.with_(period=period)
        return forecast_simple(fit_simple(df, own, column, {"season": "snaive"}), own, h)
    return run


def plain(kind: str) -> Component:
    """mean, naive or drift."""
    def run(df: DataFrame, spec: SeriesSpec, column: str, h: int) -> DataFrame:
        return forecast_simple(fit_simple(df, spec, column, {kind: kind}), spec, h)
    return run


def smoothing(*specs: Ets) -> Component:
    """Non-seasonal smoothing, the best of ``specs`` by AICc."""
    def run(df: DataFrame, spec: SeriesSpec, column: str, h: int) -> DataFrame:
        return forecast_ets(fit_ets(df, spec, column, list(specs), m=1), spec, h)
    return run


def decomposition_forecast(dcmp: DataFrame, spec: SeriesSpec, h: int, components: dict[str, Component], model: str = "decomposition",
                           season_sigma: bool = False, transform: Transform | None = None, levels=(80, 95)) -> DataFrame:
    """(keys, model, index, t, h, mean, sigma) from a component for each named column.

    ``season_sigma``: seasonal columns (those of ``seasonal``) add their variance, too;
    otherwise they are taken as known.  With ``transform`` (the one the series went through before it
    was decomposed) the median, mean and intervals come back on the scale of the data.
    """
    dcmp = cut_lineage(dcmp)
    out = None
    for column, component in components.items():
        fc = component(dcmp, spec, column, h)
        known = not season_sigma and component.__qualname__.startswith("seasonal.")
        part = fc.select(*spec.by, spec.t, F.col("h").cast("int").alias("h"), "mean", (F.lit(0.0) if known else F.col("sigma") * F.col("sigma")).alias("_v"))
        out = part if out is None else out.unionByName(part)
    total = out.groupBy(*spec.by, spec.t, "h").agg(F.sum("mean").alias("mean"), F.sqrt(F.sum("_v")).alias("sigma"), F.count(F.lit(1)).alias("_n"))
    total = total.where(F.col("_n") == len(components)).select(
        *spec.by, F.lit(model).alias("model"), spec.index_expr(F.col(spec.t)).alias(spec.index), spec.t, "h", "mean", "sigma")
    return back_transform(total, transform, levels) if transform else total
