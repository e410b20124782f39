"""Coherent forecasts for a hierarchy.

Frames hold one row per node and step: structure keys, ``is_agg_*`` flags, the
columns of ``by`` (model, period), ``mean`` and optionally ``sigma``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chronoloom.operators import mint
from chronoloom.operators.hierarchy import Structure, aggregate_key, at_level, flags, structure_keys


def bottom_up(fc: DataFrame, structure: Structure, by: list[str]) -> DataFrame:
    """Sum the leaf forecasts at every level."""
    keys = structure_keys(structure)
    leaves = at_level(fc, structure, keys).drop(*flags(structure))
    aggs = [F.sum("mean").alias("mean")]
    if "sigma" in fc.columns:
        aggs.append(F.sqrt(F.sum(F.col("sigma") * F.col("sigma"))).alias("sigma"))
    return aggregate_key(leaves, structure, by, aggs)


def historical_shares(actual: DataFrame, structure: Structure, t: str, method: str, y: str = "y") -> DataFrame:
    """Share of each leaf in the total: mean of ratios or ratio of means.

    Periods in which a leaf has no row count as zero.
    """
    keys = structure_keys(structure)
    leaves = at_level(actual, structure, keys)
    total = at_level(actual, structure, []).select(t, F.col(y).alias("_total"))
    if method == "proportion_averages":
        part = leaves.groupBy(*keys).agg(F.sum(y).alias("_part"))
        whole = total.agg(F.nullif(F.sum("_total"), F.lit(0.0)).alias("_total"))
        return part.select(*keys, (F.col("_part") / whole.scalar()).alias("share"))
    if method != "average_proportions":
        raise ValueError(method)
    periods = total.where("_total <> 0").agg(F.count("*").alias("_periods"))
    ratio = leaves.join(total, t).groupBy(*keys).agg(
        F.sum(F.col(y) / F.nullif("_total", F.lit(0.0))).alias("_sum"))
    return ratio.select(*keys, (F.col("_sum") / periods.scalar()).alias("share"))


def top_down(fc: DataFrame, structure: Structure, by: list[str], actual: DataFrame | None = None,
             t: str = "t", method: str = "forecast_proportions", y: str = "y") -> DataFrame:
    """Split the total by historical shares or by forecast proportions."""
    if method == "forecast_proportions":
        return middle_out(fc, structure, by, split=0)
    shares = historical_shares(actual, structure, t, method, y)
    keys = structure_keys(structure)
    total = at_level(fc, structure, []).select(*by, F.col("mean").alias("_total"))
    leaves = at_level(fc, structure, keys).select(*keys, *by).join(total, by).join(shares, keys)
    leaves = leaves.withColumn("mean", F.col("_total") * F.col("share"))
    return aggregate_key(leaves, structure, by, [F.sum("mean").alias("mean")])


def middle_out(fc: DataFrame, structure: Structure, by: list[str], split: int = 1) -> DataFrame:
    """Keep the forecasts of level ``split``; sum them above, and pass them
    down by the children's forecast proportions below (nested only)."""
    if len(structure) != 1:
        raise ValueError("forecast proportions need one nested factor")
    keys = structure[0]
    current = at_level(fc, structure, keys[:split]).select(*keys[:split], *by, F.col("mean").alias("_top"))
    for depth in range(split + 1, len(keys) + 1):
        child = at_level(fc, structure, keys[:depth]).select(*keys[:depth], *by, "mean")
        parent = [*keys[:depth - 1], *by]
        siblings = child.groupBy(*parent).agg(F.sum("mean").alias("_sum"))
        current = (child.join(siblings, parent).join(current, parent)
                        .select(*keys[:depth], *by, (F.col("_top") * F.col("mean") / F.nullif("_sum", F.lit(0.0))).alias("_top")))
    leaves = current.withColumnRenamed("_top", "mean")
    return aggregate_key(leaves, structure, by, [F.sum("mean").alias("mean")])


def min_trace(fc: DataFrame, structure: Structure, by: list[str], method: str = "ols",
              resid: DataFrame | None = None, t: str = "t") -> DataFrame:
    """Trace-minimising reconciliation: least squares (``ols``) or with the
    shrunk covariance of one-step residuals (``mint_shrink``).

    One way for hierarchies of any size (``operators.mint``): no node table on
    the driver, no matrix of nodes by nodes, sigmas exact.
    """
    if method not in ("ols", "mint_shrink"):
        raise ValueError(method)
    if method == "mint_shrink" and resid is None:
        raise ValueError("mint_shrink needs residuals")
    return mint.min_trace(fc, structure, by, resid if method == "mint_shrink" else None, t)


def min_trace_cg(fc: DataFrame, structure: Structure, by: list[str]) -> DataFrame:
    """Least squares for the means alone."""
    return min_trace(fc.drop("sigma"), structure, by)


def reconcile(fc: DataFrame, methods: dict[str, DataFrame], by_model: str = "model") -> DataFrame:
    """Base forecasts with the reconciled ones beside them as extra models."""
    out = fc
    for name, frame in methods.items():
        out = out.unionByName(frame.withColumn(by_model, F.lit(name)), allowMissingColumns=True)
    return out
