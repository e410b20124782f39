"""Scores of forecasts: point, quantile, interval and distribution."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from chronoloom.functions.special import normal_cdf, normal_pdf, z_value
from chronoloom.operators.blocks import lag_columns, windowed
from chronoloom.series import SeriesSpec

POINT = ("me", "rmse", "mae", "mpe", "mape", "mase", "rmsse", "acf1")


def training_scale(train: DataFrame, spec: SeriesSpec, y: str) -> DataFrame:
    """Mean absolute and mean square seasonal-naive error per training series."""
    m = int(round(spec.m))
    lagged = lag_columns(train.select(*spec.by, spec.t, y), spec, {"_lm": (y, m)})
    d = F.col(y) - F.col("_lm")
    return lagged.groupBy(*spec.by).agg(F.avg(F.abs(d)).alias("scale_abs"), F.avg(d * d).alias("scale_sq"))


def _safe(num: Column, den: Column) -> Column:
    return num / F.when(den != 0, den)


def measures(error: Column, actual: Column) -> dict[str, Column]:
    pct = 100.0 * _safe(error, actual)
    return {
        "me": F.avg(error), "rmse": F.sqrt(F.avg(error * error)), "mae": F.avg(F.abs(error)),
        "mpe": F.avg(pct), "mape": F.avg(F.abs(pct)),
        "mase": F.avg(F.abs(_safe(error, F.col("scale_abs")))),
        "rmsse": F.sqrt(F.avg(_safe(error * error, F.col("scale_sq")))),
    }


def score_points(errors: DataFrame, spec: SeriesSpec, by: list[str], series_by: list[str],
                 y: str = "y", names=POINT) -> DataFrame:
    """Point measures of a frame with ``error``, the actual ``y``, the scales
    and the period ``t``; ``series_by`` names what makes one error series."""
    named = measures(F.col("error"), F.col(y))
    if "acf1" not in names:
        return errors.groupBy(*by).agg(*[named[n].alias(n) for n in names])
    center = errors.groupBy(*series_by).agg(F.avg("error").alias("_c"))
    dev = errors.join(center, series_by).withColumn("_d", F.col("error") - F.col("_c"))
    dev = windowed(dev, spec, {
        "_p": lambda w: F.lag("_d").over(w), "_pt": lambda w: F.lag(spec.t).over(w)}, before=1, by=series_by)
    pair = F.when(F.col("_pt") == F.col(spec.t) - 1, F.col("_d") * F.col("_p"))
    named["acf1"] = _safe(F.sum(F.coalesce(pair, F.lit(0.0))), F.sum(F.col("_d") * F.col("_d")))
    return dev.groupBy(*by).agg(*[named[n].alias(n) for n in names])


def accuracy(fc: DataFrame, actual: DataFrame, train: DataFrame, spec: SeriesSpec, y: str = "y",
             by: list[str] | None = None, names=POINT) -> DataFrame:
    """Score forecasts (keys, model, t, mean) against the actual rows."""
    series_by = [*spec.by, "model"]
    by = series_by if by is None else by
    joined = fc.join(actual.select(*spec.by, spec.t, y), [*spec.by, spec.t])
    joined = joined.withColumn("error", F.col(y) - F.col("mean")).where(F.col("error").isNotNull())
    joined = joined.join(training_scale(train, spec, y), spec.by)
    return score_points(joined, spec, by, series_by, y, names)


def training_accuracy(aug: DataFrame, train: DataFrame, spec: SeriesSpec, y: str = "y",
                      by: list[str] | None = None, names=POINT) -> DataFrame:
    series_by = [*spec.by, "model"]
    rows = aug.withColumn("error", F.col("resid")).where(F.col("error").isNotNull())
    rows = rows.join(training_scale(train, spec, y), spec.by)
    return score_points(rows, spec, by or series_by, series_by, y, names)


def quantile_score(y: Column, q: Column, p: float) -> Column:
    return F.when(y < q, 2.0 * (1.0 - p) * (q - y)).otherwise(2.0 * p * (y - q))


def winkler_score(y: Column, lo: Column, hi: Column, level: float) -> Column:
    alpha = 1.0 - level / 100.0
    miss = F.when(y < lo, lo - y).when(y > hi, y - hi).otherwise(0.0)
    return hi - lo + (2.0 / alpha) * miss


def normal_quantile(mean: Column, sigma: Column, p: float) -> Column:
    return mean + z_value(p) * sigma


def crps_normal(y: Column, mean: Column, sigma: Column) -> Column:
    z = (y - mean) / F.when(sigma > 0, sigma)
    closed = sigma * (z * (2.0 * normal_cdf(z) - 1.0) + 2.0 * normal_pdf(z) - 1.0 / math.sqrt(math.pi))
    return F.when(sigma > 0, closed).otherwise(F.abs(y - mean))


def crps_sample(paths: DataFrame, by: list[str], y: str, sim: str = "sim") -> DataFrame:
    """E|X - y| - E|X - X'| / 2 from the sorted replicates of each group.

    With the values in order the pair term is a weighted sum, so no pairs are
    built.  A group holds one value per replicate.
    """
    from pyspark.sql import Window
    w = Window.partitionBy(*by).orderBy(sim)
    ranked = paths.withColumn("_i", F.row_number().over(w))
    n = F.count("*")
    spread = F.sum(F.col(sim) * F.col("_i")) * 2.0 - F.sum(sim) * (n + 1)
    return ranked.groupBy(*by).agg((F.avg(F.abs(F.col(sim) - F.col(y))) - spread / (n * n)).alias("crps"))


def skill(scores: DataFrame, by: list[str], baseline: str, score: str) -> DataFrame:
    """1 - score / score of the baseline model."""
    base = scores.where(F.col("model") == baseline).groupBy(*by).agg(F.max(score).alias("_base"))
    if by:
        return scores.join(base, by).withColumn("skill", 1.0 - _safe(F.col(score), F.col("_base"))).drop("_base")
    return scores.withColumn("skill", 1.0 - _safe(F.col(score), base.scalar()))
