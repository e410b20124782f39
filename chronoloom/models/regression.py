"""Linear regression per series, with static or autoregressive errors."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from chronoloom.models.arma_errors import arimax, error_kinds, forecast_arimax  # noqa: F401
from chronoloom.operators.linalg import gram, solve
from chronoloom.series import SeriesSpec

TREND = "trend"


def with_trend(df: DataFrame, spec: SeriesSpec, history: DataFrame | None = None) -> DataFrame:
    """Add ``trend`` = 1, 2, ... counted from the first period of the history."""
    first = (history if history is not None else df).groupBy(*spec.by).agg(F.min(spec.t).alias("_t0"))
    return df.join(first, spec.by).withColumn(TREND, (F.col(spec.t) - F.col("_t0") + 1).cast("double")).drop("_t0")


def season_dummies(spec: SeriesSpec, m: int | None = None) -> dict[str, Column]:
    """Indicators of seasons 2..m; the first season is the base."""
    m = m or int(round(spec.m))
    return {f"season{j + 1}": (F.pmod(F.col(spec.t), F.lit(m)) == j).cast("double") for j in range(1, m)}


def fourier_terms(k: int, period: float, t: str = TREND) -> dict[str, Column]:
    """sin / cos pairs 1..k; the sine that is always zero is left out."""
    out = {}
    for i in range(1, k + 1):
        angle = F.col(t) * (2.0 * math.pi * i / period)
        out[f"C{i}_{period:g}"] = F.cos(angle)
        if abs(2 * i - period) > 1e-9:
            out[f"S{i}_{period:g}"] = F.sin(angle)
    return out


def knots(at: list[float], t: str = TREND) -> dict[str, Column]:
    """Hinges max(0, trend - knot)."""
    return {f"knot{k:g}": F.greatest(F.col(t) - float(k), F.lit(0.0)) for k in at}


def tslm(df: DataFrame, spec: SeriesSpec, y: str | Column, terms: dict[str, Column], model: str = "tslm") -> DataFrame:
    """Least squares of ``y`` on an intercept and ``terms`` for every key.

    Only cross products leave the tasks; the rows are read once.
    """
    target = F.col(y) if isinstance(y, str) else y
    cols = df.select(*spec.by, F.lit(1.0).alias("intercept"), *[c.cast("double").alias(n) for n, c in terms.items()],
                     target.cast("double").alias("_y"))
    fit = solve(gram(cols, spec.by, ["intercept", *terms], "_y"))
    names = F.array(*[F.lit(n) for n in ("intercept", *terms)])
    return fit.withColumns({"model": F.lit(model), "terms": names})


def t_tail(stat: pd.Series, dof: pd.Series) -> pd.Series:
    """Two-sided Student-t tail by Gauss-Legendre on the angle form."""
    nodes, weights = np.polynomial.legendre.leggauss(64)
    nu = np.maximum(dof.to_numpy(float), 1.0)[:, None]
    a = np.arctan(np.abs(stat.to_numpy(float))[:, None] / np.sqrt(nu))

    def area(lo, hi):
        x = (hi - lo) / 2 * nodes + (hi + lo) / 2
        return ((hi - lo) / 2 * weights * np.cos(x) ** (nu - 1)).sum(axis=1)

    return pd.Series(area(a, np.pi / 2) / area(np.zeros_like(a), np.pi / 2))


def tidy(fit: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, model, term, estimate, std_error, statistic, p_value)."""
    cells = fit.select(*keys, "model", F.col("n"), F.size("terms").alias("_k"),
                       F.explode(F.arrays_zip("terms", "beta", "se")).alias("_c"))
    stat = F.col("_c.beta") / F.nullif(F.col("_c.se"), F.lit(0.0))
    out = cells.select(*keys, "model", F.col("_c.terms").alias("term"), F.col("_c.beta").alias("estimate"),
                       F.col("_c.se").alias("std_error"), stat.alias("statistic"), (F.col("n") - F.col("_k")).alias("_dof"))
    return out.withColumn("p_value", pandas_udf(t_tail, "double")("statistic", "_dof")).drop("_dof")


def _row_vector(terms: dict[str, Column]) -> Column:
    return F.array(F.lit(1.0), *[c.cast("double") for c in terms.values()])


_DOT = "aggregate(zip_with(_x, beta, (a, b) -> a * b), 0.0D, (s, v) -> s + v)"
_LEVER = ("aggregate(sequence(0, size(_x) - 1), 0.0D, (s, i) -> s + _x[i] * aggregate(sequence(0, size(_x) - 1), 0.0D, "
          "(u, j) -> u + xtx_inv[i * size(_x) + j] * _x[j]))")


def augment(df: DataFrame, spec: SeriesSpec, y: str, terms: dict[str, Column], fit: DataFrame) -> DataFrame:
    """Rows with fitted value, residual and leverage."""
    base = df.withColumn("_x", _row_vector(terms)).join(fit.select(*spec.by, "model", "beta", "xtx_inv"), spec.by)
    base = base.withColumns({"fitted": F.expr(_DOT), "leverage": F.expr(_LEVER)})
    return base.withColumn("resid", F.col(y) - F.col("fitted")).drop("_x", "beta", "xtx_inv")


def glance(fit: DataFrame, aug: DataFrame, keys: list[str]) -> DataFrame:
    """Fit statistics, with leave-one-out CV from the leverages."""
    e = F.col("resid") / (1.0 - F.col("leverage"))
    cv = aug.groupBy(*keys, "model").agg(F.avg(e * e).alias("cv"))
    return fit.select(*keys, "model", "n", "r2", "adj_r2", "sigma2", "loglik", "aic", "aicc", "bic").join(cv, [*keys, "model"])


def forecast_tslm(future: DataFrame, spec: SeriesSpec, terms: dict[str, Column], fit: DataFrame, extra=()) -> DataFrame:
    """Mean and standard deviation for rows that carry the predictors."""
    base = future.withColumn("_x", _row_vector(terms)).join(fit.select(*spec.by, "model", "beta", "xtx_inv", "sigma2"), spec.by)
    sd = F.sqrt(F.col("sigma2") * (1.0 + F.expr(_LEVER)))
    return base.select(*spec.by, *extra, "model", spec.index, spec.t, F.expr(_DOT).alias("mean"), sd.alias("sigma"))
