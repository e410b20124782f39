"""Sample paths of unlike models from one state form.

Every model is y = c'x + e, x' = F x + g e with its own sigma: ARIMA, additive
smoothing, random walks, and any of them with a fixed season on top.  Draws belong to
(key, repetition, step), so the models of a key see the same shocks; their mean
path by path is the combined forecast with its distribution.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from chronoloom.functions.calendar import horizon
from chronoloom.functions.draws import normal
from chronoloom.models import arima_state, ets_components
from chronoloom.series import SeriesSpec

#: Columns of a form beside the keys: label, last period, matrix row by row, gain, readout, state, sigma.
FORM = ("model", "t_last", "F", "g", "c", "x", "sigma")
_KIND = "struct<F:array<double>,g:array<double>,c:array<double>,x:array<double>>"


def _form(out: DataFrame, spec: SeriesSpec) -> DataFrame:
    return out.select(*spec.by, "model", "t_last", "_f.F", "_f.g", "_f.c", "_f.x", "sigma")


def arima_form(df: DataFrame, spec: SeriesSpec, y: str, fit: DataFrame, label: str = "arima") -> DataFrame:
    """Forms of fitted ARIMA models, their states run over the rows."""
    def make(terms: pd.Series, beta: pd.Series, d: pd.Series, big_d: pd.Series, m: pd.Series, x: pd.Series) -> pd.DataFrame:
        rows = []
        for nm, b, di, bd, mi, xi in zip(terms, beta, d, big_d, m, x):
            _, gain, free = arima_state.state_form(nm, b, di, bd, mi)
            rows.append((free.ravel(), gain, free[0], xi))
        return pd.DataFrame(rows, columns=["F", "g", "c", "x"])

    ends = arima_state.end_states(df, spec, y, fit)
    out = fit.drop("model").join(ends, spec.by).withColumns({"_f": pandas_udf(make, _KIND)("terms", "beta", "d", "big_d", "m", "x"), "model": F.lit(label), "sigma": F.sqrt("sigma2")})
    return _form(out, spec)


def ets_form(fit: DataFrame, spec: SeriesSpec, label: str = "ets") -> DataFrame:
    """Forms of smoothing models with additive errors and seasons: params, end ``state``, sigma2, t_last."""
    def make(params: pd.Series, state: pd.Series) -> pd.DataFrame:
        rows = []
        for p, s in zip(params, state):
            _, gain, free, x = ets_components.state_form(p, np.asarray(s, float))
            readout = np.zeros(len(x))
            readout[:3] = 1.0, p[3], 1.0
            rows.append((free.ravel(), gain, readout, x))
        return pd.DataFrame(rows, columns=["F", "g", "c", "x"])

    return _form(fit.withColumns({"_f": pandas_udf(make, _KIND)("params", "state"), "sigma": F.sqrt("sigma2"), "model": F.lit(label)}), spec)


def with_season(form: DataFrame, spec: SeriesSpec, season: DataFrame, label: str) -> DataFrame:
    """A form for the adjusted series plus a fixed ``cycle`` (array, the next period's value first): the decomposition model."""
    def make(f: pd.Series, g: pd.Series, c: pd.Series, x: pd.Series, cycle: pd.Series) -> pd.DataFrame:
        rows = []
        for fi, gi, ci, xi, s in zip(f, g, c, x, cycle):
            n, m = len(xi), len(s)
            big = np.zeros((n + m, n + m))
            big[:n, :n] = np.asarray(fi, float).reshape(n, n)
            for i in range(m):
                big[n + i, n + (i + 1) % m] = 1.0
            rows.append((big.ravel(), np.r_[gi, np.zeros(m)], np.r_[ci, 1.0, np.zeros(m - 1)], np.r_[xi, s]))
        return pd.DataFrame(rows, columns=["F", "g", "c", "x"])

    out = form.drop("model").join(season.select(*spec.by, "cycle"), spec.by)
    return _form(out.withColumns({"_f": pandas_udf(make, _KIND)("F", "g", "c", "x", "cycle"), "model": F.lit(label)}), spec)


def paths(forms: DataFrame, spec: SeriesSpec, times: int, h: int | str | None, seed: int) -> DataFrame:
    """(keys, model, rep, index, t, h, sim): ``times`` paths of every form."""
    steps = horizon(h, spec.unit, spec.period)

    def run(f: pd.Series, g: pd.Series, c: pd.Series, x: pd.Series, sigma: pd.Series, z: pd.Series) -> pd.Series:
        out: list = [None] * len(x)
        sizes = x.map(len)
        for n in sizes.unique():
            at = np.flatnonzero(sizes == n)
            stack = lambda s, *shape: np.stack([np.asarray(s.iloc[i], float).reshape(shape) for i in at])
            big, gain, read, state = stack(f, n, n), stack(g, n), stack(c, n), stack(x, n)
            e = stack(z, steps) * sigma.iloc[at].to_numpy(float)[:, None]
            made = np.empty((len(at), steps))
            for k in range(steps):
                made[:, k] = (read * state).sum(axis=1) + e[:, k]
                state = (big @ state[..., None])[..., 0] + gain * e[:, k:k + 1]
            for row, i in enumerate(at):
                out[i] = made[row].tolist()
        return pd.Series(out)

    reps = forms.withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(times))))
    draws = F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda k: normal(seed, *[F.col(c) for c in spec.by], F.col("rep"), k))
    made = reps.withColumn("_s", pandas_udf(run, "array<double>")("F", "g", "c", "x", "sigma", draws))
    out = made.select(*spec.by, "model", "rep", "t_last", F.posexplode("_s").alias("_i", "sim"))
    t = (F.col("t_last") + F.col("_i") + 1).cast("long")
    return out.select(*spec.by, "model", "rep", spec.index_expr(t).alias(spec.index), t.alias(spec.t), (F.col("_i") + 1).alias("h"), "sim")


def combine(sims: DataFrame, spec: SeriesSpec) -> DataFrame:
    """The mean of the models, path by path."""
    return sims.groupBy(*spec.by, "rep", spec.index, spec.t, "h").agg(F.avg("sim").alias("sim"))
