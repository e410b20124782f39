"""Benchmark models: mean, naive, seasonal naive, drift.

All of them come out of the same two aggregations, whatever the number of
models asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chronoloom.functions.calendar import horizon
from chronoloom.operators.blocks import lag_columns
from chronoloom.series import SeriesSpec, require_gapless

KINDS = ("mean", "naive", "snaive", "drift")


def season_state(df: DataFrame, spec: SeriesSpec, y: str, m: int) -> DataFrame:
    """Latest value of each season position as an array of length m."""
    last = (df.where(F.col(y).isNotNull())
              .groupBy(*spec.by, F.pmod(F.col(spec.t), F.lit(m)).alias("_p"))
              .agg(F.max_by(y, spec.t).alias("_v")))
    return last.groupBy(*spec.by).agg(F.map_from_entries(F.collect_list(F.struct("_p", "_v"))).alias("season"))


def fit_simple(df: DataFrame, spec: SeriesSpec, y: str, models: dict[str, str]) -> DataFrame:
    """Long model table: one row per (key, model).

    ``models`` maps a model name to a kind in ``KINDS``.  ``params`` carries
    level and slope, ``season`` the latest value per season position.
    """
    require_gapless(spec, "a benchmark model")
    kinds = set(models.values())
    m = int(round(spec.m))
    lags = {"_l1": (y, 1)}
    if "snaive" in kinds:
        lags["_lm"] = (y, m)
    base = lag_columns(df.select(*spec.by, spec.t, y), spec, lags)
    d1 = F.col(y) - F.col("_l1")
    aggs = [F.count(y).alias("_n"), F.avg(y).alias("_mean"), F.var_samp(y).alias("_var"),
            F.max(spec.t).alias("t_last"),
            F.max_by(y, F.when(F.col(y).isNotNull(), F.col(spec.t))).alias("_last"),
            F.min_by(y, F.when(F.col(y).isNotNull(), F.col(spec.t))).alias("_first"),
            F.min(F.when(F.col(y).isNotNull(), F.col(spec.t))).alias("_tf"),
            F.max(F.when(F.col(y).isNotNull(), F.col(spec.t))).alias("_tl"),
            F.avg(d1 * d1).alias("_s1"), F.var_samp(d1).alias("_sd")]
    if "snaive" in kinds:
        dm = F.col(y) - F.col("_lm")
        aggs.append(F.avg(dm * dm).alias("_sm"))
    fit = base.groupBy(*spec.by).agg(*aggs)
    if "snaive" in kinds:
        fit = fit.join(season_state(df, spec, y, m), spec.by, "left")
    else:
        fit = fit.withColumn("season", F.lit(None).cast("map<bigint,double>"))
    slope = (F.col("_last") - F.col("_first")) / F.when(F.col("_tl") > F.col("_tf"), F.col("_tl") - F.col("_tf"))
    none = F.lit(None).cast("double")
    rows = {
        "mean": (F.col("_mean"), F.lit(0.0), F.col("_var")),
        "naive": (F.col("_last"), F.lit(0.0), F.col("_s1")),
        "snaive": (none, F.lit(0.0), F.col("_sm") if "snaive" in kinds else none),
        "drift": (F.col("_last"), slope, F.col("_sd")),
    }
    cells = F.array(*[F.struct(
        F.lit(name).alias("model"), F.lit(kind).alias("kind"), rows[kind][0].alias("level"),
        rows[kind][1].alias("slope"), rows[kind][2].alias("sigma2")) for name, kind in models.items()])
    out = fit.withColumn("_m", F.explode(cells))
    return out.select(*spec.by, "_m.*", F.col("_n").alias("n"), "t_last", "season")


def point_and_sigma(h: Column, m: int) -> tuple[Column, Column]:
    """Forecast mean and standard deviation at step ``h`` from a model row."""
    t = F.col("t_last") + h
    kind = F.col("kind")
    mean = (F.when(kind == "snaive", F.element_at("season", F.pmod(t, F.lit(m)).cast("long")))
             .when(kind == "drift", F.col("level") + h * F.col("slope"))
             .otherwise(F.col("level")))
    grow = (F.when(kind == "mean", 1.0 + 1.0 / F.col("n"))
             .when(kind == "naive", h.cast("double"))
             .when(kind == "snaive", (F.floor((h - 1) / m) + 1).cast("double"))
             .otherwise(h * (1.0 + h / (F.col("n") - 1))))
    return mean, F.sqrt(F.col("sigma2") * grow)


def forecast_simple(fit: DataFrame, spec: SeriesSpec, h: int | str | None = None) -> DataFrame:
    """Forecast table (keys, model, index, t, h, mean, sigma): no shuffle.  ``h``: steps, "3 years", or None for two seasons."""
    h = horizon(h, spec.unit, spec.period)
    out = fit.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(h))))
    mean, sigma = point_and_sigma(F.col("h"), int(round(spec.m)))
    t = (F.col("t_last") + F.col("h")).cast("long")
    return out.select(*spec.by, "model", spec.index_expr(t).alias(spec.index), t.alias(spec.t), "h",
                      mean.alias("mean"), sigma.alias("sigma"))


def augment_simple(df: DataFrame, spec: SeriesSpec, y: str, models: dict[str, str]) -> DataFrame:
    """Rows with fitted value and residual for every model (long)."""
    m = int(round(spec.m))
    lags = {"_l1": (y, 1)}
    if "snaive" in models.values():
        lags["_lm"] = (y, m)
    base = lag_columns(df, spec, lags)
    if {"mean", "drift"} & set(models.values()):
        ends = df.groupBy(*spec.by).agg(
            F.avg(y).alias("_mean"),
            ((F.max_by(y, spec.t) - F.min_by(y, spec.t)) / F.nullif(F.max(spec.t) - F.min(spec.t), F.lit(0))).alias("_b"))
        base = base.join(ends, spec.by)
    fitted = {"mean": lambda: F.col("_mean"), "naive": lambda: F.col("_l1"),
              "snaive": lambda: F.col("_lm"), "drift": lambda: F.col("_l1") + F.col("_b")}
    cells = F.array(*[F.struct(F.lit(name).alias("model"), fitted[kind]().alias("fitted"))
                      for name, kind in models.items()])
    return (base.withColumn("_m", F.explode(cells))
                .select(*spec.by, "_m.model", spec.index, spec.t, y, F.col("_m.fitted").alias("fitted"),
                        (F.col(y) - F.col("_m.fitted")).alias("resid")))
