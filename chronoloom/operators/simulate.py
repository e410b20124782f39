"""Future paths and resampled histories, one row per (series, replicate, step).

Every draw is a hash of (seed, key, replicate, step), so results do not depend
on partitioning.  Drawn values are fetched by an equi-join on their position.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.functions import pandas_udf

from chronoloom.functions.draws import index_draw, normal
from chronoloom.operators.blocks import BLOCK, row_numbers
from chronoloom.series import SeriesSpec


def _cells(fit: DataFrame, times: int, h: int | None = None) -> DataFrame:
    out = fit.withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(times))))
    return out.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(h)))) if h else out


def residual_pool(resid: DataFrame, spec: SeriesSpec, col: str = "resid") -> DataFrame:
    """Centred residuals numbered 0..n-1 per key."""
    rows = resid.where(F.col(col).isNotNull()).select(*spec.by, spec.t, col)
    rows = row_numbers(rows, spec.by, F.col(spec.t), F.floor(F.col(spec.t) / BLOCK), "_rn")
    mean = rows.groupBy(*spec.by).agg(F.avg(col).alias("_mean"))
    return rows.join(mean, spec.by).select(*spec.by, (F.col("_rn") - 1).alias("pos"), (F.col(col) - F.col("_mean")).alias("innov"))


def simulate_walk(fit: DataFrame, spec: SeriesSpec, times: int, h: int, seed: int, pool: DataFrame | None = None) -> DataFrame:
    """Paths of random-walk type models (level, slope, sigma2, t_last).

    With ``pool`` the innovations are drawn from the residuals, else normal.
    """
    cells = _cells(fit.select(*spec.by, "model", "level", "slope", "sigma2", "t_last"), times, h)
    who = [F.col(k) for k in spec.keys]
    if pool is None:
        cells = cells.withColumn("innov", F.sqrt("sigma2") * normal(seed, *who, F.col("rep"), F.col("h")))
    else:
        size = pool.groupBy(*spec.by).agg(F.count("*").alias("_n"))
        cells = cells.join(size, spec.by).withColumn("pos", index_draw(seed, F.col("_n"), *who, F.col("rep"), F.col("h")))
        cells = cells.join(pool, [*spec.by, "pos"])
    w = Window.partitionBy(*spec.by, "model", "rep").orderBy("h")  # at most h rows
    t = (F.col("t_last") + F.col("h")).cast("long")
    return cells.withColumn("_cum", F.sum("innov").over(w)).select(
        *spec.by, "model", "rep", spec.index_expr(t).alias(spec.index), t.alias(spec.t), "h",
        (F.col("level") + F.col("h") * F.col("slope") + F.col("_cum")).alias("sim"))


def simulate_ets(fit: DataFrame, spec: SeriesSpec, times: int, h: int, seed: int) -> DataFrame:
    """Paths of fitted smoothing models, errors normal on the model's scale."""
    def paths(model: pd.Series, params: pd.Series, state: pd.Series, s2: pd.Series, draws: pd.Series) -> pd.Series:
        rows = []
        for name, p, st, v, z in zip(model, params, state, s2, draws):
            err, _, sea = name[4:-1].split(",")
            a, b_, g, phi = p
            lvl, b, s = st[0], st[1], np.array(st[4:], float)
            out = np.empty(len(z))
            for i, zi in enumerate(z):
                j = i % len(s)
                base = lvl + phi * b
                mu = base * s[j] if sea == "M" else base + s[j]
                e = zi * np.sqrt(v) * (mu if err == "M" else 1.0)
                out[i] = mu + e
                lvl, b = base + a * (e / s[j] if sea == "M" else e), phi * b + b_ * (e / s[j] if sea == "M" else e)
                if sea != "N":
                    s[j] += g * (e / base if sea == "M" else e)
            rows.append(out)
        return pd.Series(rows)

    who = [F.col(k) for k in spec.keys]
    cells = _cells(fit.select(*spec.by, "model", "params", "state", "sigma2", "t_last"), times)
    cells = cells.withColumn("_z", F.transform(F.sequence(F.lit(1), F.lit(h)), lambda i: normal(seed, *who, F.col("rep"), i)))
    cells = cells.withColumn("_s", pandas_udf(paths, "array<double>")("model", "params", "state", "sigma2", "_z"))
    out = cells.select(*spec.by, "model", "rep", "t_last", F.posexplode("_s").alias("_i", "sim"))
    t = (F.col("t_last") + F.col("_i") + 1).cast("long")
    return out.select(*spec.by, "model", "rep", spec.index_expr(t).alias(spec.index), t.alias(spec.t), (F.col("_i") + 1).alias("h"), "sim")


def block_bootstrap(dcmp: DataFrame, spec: SeriesSpec, times: int, seed: int, block: int = 8) -> DataFrame:
    """Trend + season + remainders resampled in moving blocks.

    Position i of replicate r reads the remainder at ``start_j + offset``; the
    block starts are hashes of (r, j), so only one equi-join is needed.
    """
    rows = row_numbers(dcmp, spec.by, F.col(spec.t), F.floor(F.col(spec.t) / BLOCK), "_i")
    size = dcmp.groupBy(*spec.by).agg(F.count("*").alias("_n"))
    who = [F.col(k) for k in spec.keys]
    base = _cells(rows.join(size, spec.by), times)
    cut = index_draw(seed, F.lit(block), *who, F.lit("cut"), F.col("rep"))
    base = base.withColumn("_pos", F.col("_i") - 1 + cut)
    start = index_draw(seed, F.greatest(F.col("_n") - block + 1, F.lit(1)), *who, F.col("rep"), F.floor(F.col("_pos") / block))
    base = base.withColumn("_src", F.least(start + F.pmod(F.col("_pos"), F.lit(block)), F.col("_n") - 1) + 1)
    pool = rows.select(*spec.by, F.col("_i").alias("_src"), F.col("remainder").alias("_r"))
    return base.join(pool, [*spec.by, "_src"]).select(
        *spec.by, "rep", spec.index, spec.t, (F.col("trend") + F.col("season") + F.col("_r")).alias("sim"))
