"""Level, slope, season and remainder of every row under a fitted smoothing model.

Forms with additive errors and seasons are linear: all blocks of a series run at the
same time (``operators.affine``).  The others hand their state from
block to block and emit what they pass.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from chronoloom.models.smoothing import Ets, start_state
from chronoloom.operators.affine import affine_scan
from chronoloom.operators.blocks import block_arrays, cut_lineage
from chronoloom.series import SeriesSpec, require_gapless

_SYSTEM = "struct<A:array<double>,b:array<double>,hole:array<double>,x0:array<double>>"
_PARTS = ("level", "slope", "season", "remainder")


def state_form(params, start) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(A, b, hole, x0) on the state (level, slope, seasons with the next first, error) of an additive form."""
    alpha, beta, gamma, phi = params
    m = len(start) - 4
    size = m + 3
    ahead = np.zeros(size)
    ahead[0], ahead[1], ahead[2] = 1.0, phi, 1.0
    free = np.zeros((size, size))  # what happens without an error
    free[0, 0], free[0, 1], free[1, 1] = 1.0, phi, phi
    for i in range(m):
        free[2 + i, 2 + (i + 1) % m] = 1.0
    gain = np.zeros(size)
    gain[0], gain[1], gain[1 + m], gain[-1] = alpha, beta, gamma, 1.0
    return free - np.outer(gain, ahead), gain, free, np.r_[start[0], start[1], start[4:], 0.0]


def _parse(model: str) -> Ets:
    return Ets(*model[4:-1].split(","))


def _trace(y: np.ndarray, params, state: np.ndarray, s: Ets) -> tuple[np.ndarray, np.ndarray]:
    """Rows (level, slope, season, remainder) and the state after them; a missing value moves on by its forecast."""
    alpha, beta, gamma, phi = params
    level, slope, seasons = state[0], state[1], state[4:].copy()
    k, out = len(seasons), np.empty((len(y), 4))
    for i, v in enumerate(y):
        j = i % k
        base, own = level + phi * slope, seasons[j]
        mu = base * own if s.season == "M" else base + own
        e = 0.0 if np.isnan(v) else v - mu
        with np.errstate(all="ignore"):
            level = base + alpha * (e / own if s.season == "M" else e)
            slope = phi * slope + beta * (e / own if s.season == "M" else e)
            if s.season != "N":
                seasons[j] = own + gamma * (e / base if s.season == "M" else e)
        out[i] = level, slope, seasons[j], np.nan if np.isnan(v) else (e / mu if s.error == "M" else e)
    return out, np.r_[level, slope, state[2:4], np.roll(seasons, -(len(y) % k))]


def given_parameters(df: DataFrame, spec: SeriesSpec, y: str, s: Ets, alpha: float, beta: float = 0.0, gamma: float = 0.0, phi: float = 1.0,
                     m: int | None = None) -> DataFrame:
    """A model whose parameters are given, started from the first cycles of each key: model, params, start."""
    m = m or max(1, int(round(spec.m)))
    first = df.groupBy(*spec.by).agg(F.min(spec.t).alias("_t0"))
    head = df.join(first, spec.by).where(F.col(spec.t) < F.col("_t0") + max(10, 5 * m)).groupBy(*spec.by).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(spec.t, F.col(y).cast("double").alias("v")))), lambda x: x["v"]).alias("_head"))

    def begin(heads: pd.Series) -> pd.Series:
        made = [start_state(np.asarray(v, float), s, m) for v in heads]
        return pd.Series([[level, slope, 0.0, 0.0, *season] for level, slope, season in made])

    return head.select(*spec.by, F.lit(s.name).alias("model"), F.array(*[F.lit(float(v)) for v in (alpha, beta, gamma, phi)]).alias("params"),
                       pandas_udf(begin, "array<double>")("_head").alias("start"))


def components(df: DataFrame, spec: SeriesSpec, y: str, fit: DataFrame, block: int | None = None) -> DataFrame:
    """(keys, index, t, y, level, slope, season, remainder).

    ``fit`` has one row per key: model, params (alpha, beta, gamma, phi) and the
    start state; forms may differ by key.  The remainder is the one-step error,
    relative where the form's error is.  Season is 0 (or 1) where a form has none.
    """
    require_gapless(spec, "exponential smoothing")
    rows = df.select(*spec.by, spec.t, F.col(y).cast("double").alias("_v"))
    linear = F.startswith("model", F.lit("ETS(A")) & ~F.endswith("model", F.lit(",M)"))

    def system(params: pd.Series, start: pd.Series) -> pd.DataFrame:
        made = [state_form(p, np.asarray(s, float)) for p, s in zip(params, start)]
        return pd.DataFrame([(a.ravel(), b, h.ravel(), x) for a, b, h, x in made], columns=["A", "b", "hole", "x0"])

    flat = fit.where(linear)
    sizes = [r[0] for r in flat.select(F.size("start")).distinct().collect()]  # one season length for each size
    out = None
    for size in sizes:
        own = flat.where(F.size("start") == size)
        systems = own.select(*spec.by, pandas_udf(system, _SYSTEM)("params", "start").alias("s")).select(*spec.by, "s.*")
        part, _ = affine_scan(rows, spec.by, spec.t, "_v", systems, {"level": 0, "slope": 1, "season": size - 3, "remainder": size - 2}, ["_v"], block)
        part = part.withColumn("remainder", F.when(F.col("_v").isNotNull(), F.col("remainder")))
        out = part if out is None else out.unionByName(part)
    bent = fit.where(~linear).select(*spec.by, "model", "params", F.col("start").alias("_st"))
    if out is None or bent.take(1):
        other = _chained(rows, spec, bent, block)
        out = other if out is None else out.unionByName(other)
    return out.select(*spec.by, spec.index_expr(F.col(spec.t)).alias(spec.index), spec.t, F.col("_v").alias(y), *_PARTS)


def _chained(rows: DataFrame, spec: SeriesSpec, state: DataFrame, block: int | None) -> DataFrame:
    arrays = cut_lineage(block_arrays(rows.join(state.select(*spec.by), spec.by), spec.by, spec.t, ["_v"], block))
    first, final = arrays.agg(F.min("blk"), F.max("blk")).first()
    if first is None:
        return rows.limit(0).select(*spec.by, spec.t, "_v", *[F.lit(None).cast("double").alias(c) for c in _PARTS])

    def trace(ys: pd.Series, model: pd.Series, params: pd.Series, st: pd.Series) -> pd.DataFrame:
        made = [_trace(np.asarray(v, float), p, np.asarray(s, float), _parse(n)) for v, n, p, s in zip(ys, model, params, st)]
        return pd.DataFrame([(r.tolist(), s) for r, s in made], columns=["rows", "state"])

    step = pandas_udf(trace, "struct<rows:array<array<double>>,state:array<double>>")
    out = None
    for b in range(first, final + 1):
        part = state.join(arrays.where(F.col("blk") == b).drop("blk"), spec.by, "left").withColumn(
            "_r", F.when(F.col("pts").isNotNull(), step(F.coalesce(F.col("pts")["_v"], F.array().cast("array<double>")), "model", "params", "_st")))
        part = cut_lineage(part)
        done = part.where("pts IS NOT NULL").select(*spec.by, F.explode(F.arrays_zip("pts", F.col("_r.rows").alias("r"))).alias("_x"))
        done = done.select(*spec.by, F.col(f"_x.pts.{spec.t}").alias(spec.t), F.col("_x.pts._v").alias("_v"), *[F.col("_x.r")[i].alias(c) for i, c in enumerate(_PARTS)])
        out = done if out is None else out.unionByName(done)
        state = part.select(*spec.by, "model", "params", F.coalesce("_r.state", "_st").alias("_st"))
    return out
