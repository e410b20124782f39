"""What a fitted ARIMA says about rows: innovations, fitted values, refits, gaps.

Innovations solve e_t = u_t - theta_1 e_{t-1} - ..., a linear recursion that runs in
blocks (``operators.affine``).  Gaps are filled by the same scan over the whole
state of the model, in which a missing value moves on by its forecast.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from chronoloom.models.arima import differenced
from chronoloom.operators.affine import affine_scan, companion
from chronoloom.operators.blocks import cut_lineage, lag_columns
from chronoloom.series import SeriesSpec, require_gapless

_SYSTEM = "struct<A:array<double>,b:array<double>,hole:array<double>,x0:array<double>>"


def coefficient(name: str) -> Column:
    """A coefficient of a fit by its term; 0 where the key's model has no such term."""
    return F.coalesce(F.try_element_at(F.map_from_arrays("terms", "beta"), F.lit(name)), F.lit(0.0))


def lags_of(fit: DataFrame, prefix: str) -> list[int]:
    """Lags with a coefficient in the model of any key; as many as a model has terms."""
    names = fit.select(F.explode("terms").alias("x")).distinct().collect()
    return sorted(int(r.x[2:]) for r in names if r.x.startswith(prefix) and r.x[2:].isdigit())


def _split(terms, beta) -> tuple[float, dict[int, float], dict[int, float]]:
    own = dict(zip(terms, beta))
    pick = lambda p: {int(k[2:]): v for k, v in own.items() if k[:2] == p and k[2:].isdigit()}
    return own.get("constant", 0.0), pick("ar"), pick("ma")


def full_ar(ar: dict[int, float], d: int, big_d: int, m: int) -> np.ndarray:
    """Coefficients of y_{t-1}, y_{t-2}, ... once the differences are multiplied into the autoregression."""
    poly = np.zeros(max(ar, default=0) + 1)
    poly[0] = 1.0
    for k, c in ar.items():
        poly[k] -= c
    for _ in range(int(d)):
        poly = np.convolve(poly, [1.0, -1.0])
    if big_d:
        poly = np.convolve(poly, np.r_[1.0, np.zeros(int(m) - 1), -1.0])
    return -poly[1:]


def innovations_of(df: DataFrame, spec: SeriesSpec, y: str, fit: DataFrame, block: int | None = None) -> DataFrame:
    """(keys, t, _v, _w, _e): the rows' values, differences, and innovations under the coefficients of ``fit``.

    The first innovations, whose lags lie before the series, and those of
    periods with a missing value or a missing lag, are null and count as 0 in
    what follows.  Keys without a fit give no rows.
    """
    require_gapless(spec, "an ARIMA model")
    m = int(round(spec.m))
    ar = lags_of(fit, "ar")
    kinds = fit.select(*spec.by, "terms", "beta", "d", "big_d")
    base = df.select(*spec.by, spec.t, F.col(y).cast("double").alias("_v")).join(kinds, spec.by)
    rows = lag_columns(differenced(base, spec, "_v", F.col("d"), F.col("big_d"), m), spec, {f"_w{k}": ("_w", k) for k in ar})
    u = F.col("_w") - coefficient("constant")
    for k in ar:
        phi = coefficient(f"ar{k}")
        u = u - F.when(phi == 0, 0.0).otherwise(phi * F.col(f"_w{k}"))
    rows = rows.withColumn("_known", u)

    def system(terms: pd.Series, beta: pd.Series) -> pd.DataFrame:
        out = []
        for nm, b in zip(terms, beta):
            _, _, ma = _split(nm, b)
            theta = [ma.get(k, 0.0) for k in range(1, max(ma, default=1) + 1)]
            out.append((*companion(theta), [0.0] * len(theta)))
        return pd.DataFrame(out, columns=["A", "b", "hole", "x0"])

    systems = fit.select(*spec.by, pandas_udf(system, _SYSTEM)("terms", "beta").alias("s")).select(*spec.by, "s.*")
    out, _ = affine_scan(rows, spec.by, spec.t, "_known", systems, {"_e": 0}, ["_v", "_w", "_known"], block)
    return out.withColumn("_e", F.when(F.col("_known").isNotNull(), F.col("_e"))).drop("_known")


def augment_arima(df: DataFrame, spec: SeriesSpec, y: str, fit: DataFrame, block: int | None = None) -> DataFrame:
    """(keys, index, t, y, fitted, resid): one-step fitted values and innovations on the scale of y."""
    rows = innovations_of(df, spec, y, fit, block)
    return rows.select(*spec.by, spec.index_expr(F.col(spec.t)).alias(spec.index), spec.t, F.col("_v").alias("y"),
                       (F.col("_v") - F.col("_e")).alias("fitted"), F.col("_e").alias("resid"))


def refit_arima(df: DataFrame, spec: SeriesSpec, y: str, fit: DataFrame, block: int | None = None) -> DataFrame:
    """The same coefficients on other rows of the keys: a fit to forecast from, with its own sigma2 and criteria.

    No coefficient is estimated again, so sigma2 is the mean square of the
    innovations and the criteria count sigma2 as the only parameter.
    """
    m = int(round(spec.m))
    rows = cut_lineage(innovations_of(df, spec, y, fit, block))
    reach = max([m, 1, *lags_of(fit, "ar"), *lags_of(fit, "ma")])
    sums = rows.groupBy(*spec.by).agg(F.count("_e").alias("n"), F.avg(F.col("_e") * F.col("_e")).alias("sigma2"),
                                      F.max(F.when(F.col("_v").isNotNull(), F.col(spec.t))).alias("t_last"))
    tail = rows.join(sums.select(*spec.by, "t_last"), spec.by).where(F.col(spec.t) <= F.col("t_last"))
    last = lambda n, *cols: F.array_sort(F.collect_list(F.when(F.col(spec.t) > F.col("t_last") - n, F.struct(spec.t, *cols))))
    tail = tail.where(F.col(spec.t) > F.col("t_last") - max(reach, m + 3)).groupBy(*spec.by).agg(
        last(reach, "_w", F.coalesce("_e", F.lit(0.0)).alias("_e")).alias("_a"), last(m + 3, "_v").alias("_h"))
    base = F.col("n") * F.log("sigma2")
    sums = sums.withColumns({"loglik": -0.5 * (base + F.col("n") * (1 + np.log(2 * np.pi))), "aic": base + 2, "bic": base + F.log("n"),
                             "aicc": F.when(F.col("n") > 2, base + 2 + 4 / (F.col("n") - 2))})
    kept = fit.select(*spec.by, "model", "order", "terms", "beta", "se", "d", "big_d", "root", "m")
    return kept.join(sums, spec.by).join(tail, spec.by).select(
        *spec.by, "model", "order", "terms", "beta", "se", "n", "d", "big_d", "t_last", "root", "sigma2", "loglik", "aic", "aicc", "bic", "m",
        F.col("_a._w").alias("w_tail"), F.col("_a._e").alias("e_tail"), F.col("_h._v").alias("y_tail"))


def fitted_h(df: DataFrame, spec: SeriesSpec, y: str, fit: DataFrame, h: int, block: int | None = None) -> DataFrame:
    """(keys, index, t, y, fitted): forecasts ``h`` steps ahead of every row, from the rows up to ``h`` steps before it.

    All rows forecast at once: a step is an expression of the lags before the
    origin and of the steps already made.
    """
    m = int(round(spec.m))
    ar, ma = lags_of(fit, "ar"), lags_of(fit, "ma")
    delta = sorted({1, 2} | ({m, m + 1, m + 2} if m > 1 else set()))
    rows = innovations_of(df, spec, y, fit, block)
    w_lags = sorted({h + k - j for j in range(1, h + 1) for k in ar if k >= j})
    e_lags = sorted({h + k - j for j in range(1, h + 1) for k in ma if k >= j})
    y_lags = sorted({h + k - j for j in range(1, h + 1) for k in delta if k >= j})
    rows = lag_columns(rows, spec, {**{f"_w{k}": ("_w", k) for k in w_lags}, **{f"_e{k}": ("_e", k) for k in e_lags}, **{f"_y{k}": ("_v", k) for k in y_lags}})
    rows = rows.join(fit.select(*spec.by, "terms", "beta", "d", "big_d"), spec.by).withColumns(
        {"_c": coefficient("constant"), **{f"_ar{k}": coefficient(f"ar{k}") for k in ar}, **{f"_ma{k}": coefficient(f"ma{k}") for k in ma}})
    # weights of earlier values when differences are undone, by the orders of the key
    weights = {}
    for k in delta:
        w = F.lit(0.0)
        for d in range(3):
            for big in range(2 if m > 1 else 1):
                own = full_ar({}, d, big, m)
                if k <= len(own) and own[k - 1]:
                    w = F.when((F.col("d") == d) & (F.col("big_d") == big), float(own[k - 1])).otherwise(w)
        weights[f"_d{k}"] = w
    rows = rows.withColumns(weights)

    def times(c: str, v: Column) -> Column:  # a lag without weight may be missing
        return F.when(F.col(c) == 0, 0.0).otherwise(F.col(c) * v)

    for j in range(1, h + 1):
        w = F.col("_c")
        for k in ar:
            w = w + times(f"_ar{k}", F.col(f"_fw{j - k}") if k < j else F.col(f"_w{h + k - j}"))
        for k in ma:
            if k >= j:
                w = w + times(f"_ma{k}", F.coalesce(F.col(f"_e{h + k - j}"), F.lit(0.0)))
        rows = rows.withColumn(f"_fw{j}", w)
        v = F.col(f"_fw{j}")
        for k in delta:
            v = v + times(f"_d{k}", F.col(f"_fy{j - k}") if k < j else F.col(f"_y{h + k - j}"))
        rows = rows.withColumn(f"_fy{j}", v)
    return rows.select(*spec.by, spec.index_expr(F.col(spec.t)).alias(spec.index), spec.t, F.col("_v").alias("y"), F.col(f"_fy{h}").alias("fitted"))


def state_form(terms, beta, d: int, big_d: int, m: int, backward: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A, b, hole) on the state (y_t, y_{t-1}, ..., e_t, e_{t-1}, ..., 1).

    With a value the state takes it in; without one the value is its forecast
    and the innovation 0.  ``backward``: the same model on reversed time, where
    an odd number of differences turns the sign of the constant.
    """
    const, ar, ma = _split(terms, beta)
    phi = full_ar(ar, d, big_d, m)
    p, q = max(len(phi), 1), max(max(ma, default=0), 1)
    if backward and (int(d) + int(bool(big_d))) % 2:
        const = -const
    size = p + q + 1
    ahead = np.zeros(size)
    ahead[:len(phi)] = phi
    for k, c in ma.items():
        ahead[p + k - 1] = c
    ahead[-1] = const
    shift = np.zeros((size, size))
    for i in range(1, p):
        shift[i, i - 1] = 1.0
    for i in range(1, q):
        shift[p + i, p + i - 1] = 1.0
    shift[-1, -1] = 1.0
    known, hole, b = shift.copy(), shift.copy(), np.zeros(size)
    known[p], hole[0] = -ahead, ahead
    b[0] = b[p] = 1.0
    return known, b, hole


def psi_sums(hole: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Variance of a forecast 1..n steps ahead in units of sigma2."""
    out, x, total = np.empty(n), b.copy(), 0.0
    for i in range(n):
        total += x[0] ** 2
        out[i] = total
        x = hole @ x
    return out


def _scan(rows: DataFrame, spec: SeriesSpec, fit: DataFrame, backward: bool, block: int | None) -> tuple[DataFrame, DataFrame]:
    """The whole state run over rows (keys, t, ``_v``), forwards or backwards: (keys, t, ``_to``) and the last states.

    Values before the first known ones repeat these in mirrored order.
    """
    known = rows.where("_v IS NOT NULL")
    m = int(round(spec.m))
    reach = max([1, *lags_of(fit, "ar")]) + 2 + (m if m > 1 else 0)
    edge = F.max(spec.t) if backward else F.min(spec.t)
    far = F.abs(F.col(spec.t) - F.col("_edge"))
    heads = known.join(known.groupBy(*spec.by).agg(edge.alias("_edge")), spec.by).where(far < reach).groupBy(*spec.by).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(far.alias("i"), "_v"))), lambda x: x["_v"]).alias("_head"))

    def system(terms: pd.Series, beta: pd.Series, d: pd.Series, big_d: pd.Series, m: pd.Series, head: pd.Series) -> pd.DataFrame:
        out = []
        for nm, b, di, bd, mi, first in zip(terms, beta, d, big_d, m, head):
            step, gain, hole = state_form(nm, b, di, bd, mi, backward)
            size = len(gain)
            p = size - 1 - max(max(_split(nm, b)[2], default=0), 1)
            x0 = np.zeros(size)
            own = np.asarray(first, float)[:p]
            x0[:len(own)], x0[len(own):p], x0[-1] = own, own[-1], 1.0
            out.append((step.ravel(), gain, hole.ravel(), x0))
        return pd.DataFrame(out, columns=["A", "b", "hole", "x0"])

    systems = fit.join(heads, spec.by).select(*spec.by, pandas_udf(system, _SYSTEM)("terms", "beta", "d", "big_d", "m", "_head").alias("s")).select(*spec.by, "s.*")
    way = -F.col(spec.t) if backward else F.col(spec.t)
    out, last = affine_scan(rows.withColumn("_at", way.cast("long")), spec.by, "_at", "_v", systems, {"_to": 0}, [], block)
    return out.select(*spec.by, (-F.col("_at") if backward else F.col("_at")).alias(spec.t), "_to"), last


def end_states(df: DataFrame, spec: SeriesSpec, y: str, fit: DataFrame, block: int | None = None) -> DataFrame:
    """(keys, x): the state of ``state_form`` after the last row, with the innovations of ``innovations_of``.

    Missing values have moved on by their forecasts.
    """
    rows = cut_lineage(df.select(*spec.by, spec.t, F.col(y).cast("double").alias("_v")))
    values = _scan(rows, spec, fit, False, block)[0]
    shocks = innovations_of(rows, spec, "_v", fit, block).select(*spec.by, spec.t, "_e")
    m = int(round(spec.m))
    reach = max([m, 1, *lags_of(fit, "ar"), *lags_of(fit, "ma")]) + m + 2  # all lags, and the differences
    last = rows.groupBy(*spec.by).agg(F.max(spec.t).alias("_last"))
    tail = values.join(last, spec.by).where(F.col(spec.t) > F.col("_last") - reach).join(shocks, [*spec.by, spec.t]).groupBy(*spec.by).agg(
        F.reverse(F.array_sort(F.collect_list(F.struct(spec.t, "_to", F.coalesce("_e", F.lit(0.0)).alias("_e"))))).alias("_a"))

    def assemble(terms: pd.Series, beta: pd.Series, d: pd.Series, big_d: pd.Series, m: pd.Series, to: pd.Series, e: pd.Series) -> pd.Series:
        out = []
        for nm, b, di, bd, mi, ys, es in zip(terms, beta, d, big_d, m, to, e):
            size = len(state_form(nm, b, di, bd, mi)[1])
            q = max(max(_split(nm, b)[2], default=0), 1)
            p = size - 1 - q
            x = np.zeros(size)
            x[:min(p, len(ys))], x[p:p + min(q, len(es))], x[-1] = ys[:p], es[:q], 1.0
            out.append(x.tolist())
        return pd.Series(out)

    return fit.join(tail, spec.by).select(*spec.by, pandas_udf(assemble, "array<double>")(
        "terms", "beta", "d", "big_d", "m", F.col("_a._to"), F.col("_a._e")).alias("x"))


def interpolate_arima(df: DataFrame, spec: SeriesSpec, y: str, fit: DataFrame, block: int | None = None) -> DataFrame:
    """(keys, index, t, y, filled): missing values between known ones by a fitted model.

    Forecasts from the left edge of a gap and, on reversed time, from its
    right edge meet weighted by their precisions; for a random walk that is the
    straight line.  Gaps at the start or the end of a series have one edge
    and follow that forecast.  Series without any value stay null.
    """
    require_gapless(spec, "an ARIMA model")
    rows = cut_lineage(df.select(*spec.by, spec.t, F.col(y).cast("double").alias("_v")))
    out = rows
    for backward, name in ((False, "_forth"), (True, "_back")):
        out = out.join(_scan(rows, spec, fit, backward, block)[0].withColumnRenamed("_to", name), [*spec.by, spec.t], "left")
    # places in a gap: the known values on either side, found by running maxima over blocks
    edges = _edges(out, spec)
    inner = F.col("_v").isNull() & F.col("_i").isNotNull() & F.col("_j").isNotNull()
    width = edges.where(inner).agg(F.max(F.greatest("_i", "_j"))).first()[0] or 1  # the longest gap

    def sums(terms: pd.Series, beta: pd.Series, d: pd.Series, big_d: pd.Series, mi: pd.Series) -> pd.Series:
        made = []
        for nm, b, di, bd, k in zip(terms, beta, d, big_d, mi):
            _, gain, hole = state_form(nm, b, di, bd, k)
            made.append(psi_sums(hole, gain, int(width)))
        return pd.Series(made)

    psi = fit.select(*spec.by, pandas_udf(sums, "array<double>")("terms", "beta", "d", "big_d", "m").alias("_psi"))
    both = edges.join(psi, spec.by, "left")
    left, right = 1 / F.get("_psi", F.col("_i").cast("int") - 1), 1 / F.get("_psi", F.col("_j").cast("int") - 1)
    filled = (F.when(F.col("_v").isNotNull(), F.col("_v"))
              .when(F.col("_i").isNotNull() & F.col("_j").isNotNull(), (left * F.col("_forth") + right * F.col("_back")) / (left + right))
              .otherwise(F.when(F.col("_i").isNotNull(), F.col("_forth")).when(F.col("_j").isNotNull(), F.col("_back"))))
    return both.select(*spec.by, spec.index_expr(F.col(spec.t)).alias(spec.index), spec.t, F.col("_v").alias("y"), filled.alias("filled"))


def _edges(rows: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Steps from the known value before (``_i``) and to the known value after (``_j``) each row."""
    from pyspark.sql import Window
    from chronoloom.operators import blocks
    rows = rows.withColumn("_blk", F.floor(F.col(spec.t) / blocks.BLOCK))
    at = F.when(F.col("_v").isNotNull(), F.col(spec.t))
    by_block = rows.groupBy(*spec.by, "_blk").agg(F.max(at).alias("_hi"), F.min(at).alias("_lo"))
    outer = Window.partitionBy(*spec.by).orderBy("_blk")
    by_block = by_block.select(*spec.by, "_blk", F.max("_hi").over(outer.rowsBetween(Window.unboundedPreceding, -1)).alias("_hi"),
                               F.min("_lo").over(outer.rowsBetween(1, Window.unboundedFollowing)).alias("_lo"))
    inner = Window.partitionBy(*spec.by, "_blk").orderBy(spec.t)
    rows = rows.withColumns({"_before": F.max(at).over(inner.rowsBetween(Window.unboundedPreceding, 0)),
                             "_after": F.min(at).over(inner.rowsBetween(0, Window.unboundedFollowing))}).join(by_block, [*spec.by, "_blk"])
    return rows.withColumns({"_i": F.col(spec.t) - F.coalesce("_before", "_hi"), "_j": F.coalesce("_after", "_lo") - F.col(spec.t)}).drop(
        "_blk", "_before", "_after", "_hi", "_lo")


def tidy_arima(fit: DataFrame, spec: SeriesSpec) -> DataFrame:
    """One row per coefficient: term, estimate, std_error, statistic."""
    rows = fit.select(*spec.by, "model", F.explode(F.arrays_zip("terms", "beta", "se")).alias("x"))
    return rows.select(*spec.by, "model", F.col("x.terms").alias("term"), F.col("x.beta").alias("estimate"), F.col("x.se").alias("std_error"),
                       (F.col("x.beta") / F.when(F.col("x.se") > 0, F.col("x.se"))).alias("statistic"))


def roots_arima(fit: DataFrame, spec: SeriesSpec) -> DataFrame:
    """One row per inverse root: kind (ar, ma), number by falling size, real and imaginary part, size."""
    def roots(terms: pd.Series, beta: pd.Series) -> pd.Series:
        out = []
        for nm, b in zip(terms, beta):
            _, ar, ma = _split(nm, b)
            rows = []
            for kind, coefs, sign in (("ar", ar, -1.0), ("ma", ma, 1.0)):
                poly = np.zeros(max(coefs, default=0) + 1)
                poly[0] = 1.0
                for k, c in coefs.items():
                    poly[k] += sign * c
                found = sorted(np.roots(poly).tolist(), key=lambda z: (-round(abs(z), 9), -z.real, -z.imag))
                rows += [(kind, i + 1, z.real, z.imag, abs(z)) for i, z in enumerate(map(complex, found))]
            out.append(rows)
        return pd.Series(out)

    kind = "array<struct<kind:string,number:int,re:double,im:double,size:double>>"
    return fit.select(*spec.by, "model", F.explode(pandas_udf(roots, kind)("terms", "beta")).alias("x")).select(*spec.by, "model", "x.*")


def glance_arima(fit: DataFrame, spec: SeriesSpec) -> DataFrame:
    """One row per model: order, differences, sigma2, criteria, and the largest inverse root."""
    return fit.select(*spec.by, "model", "order", "d", "big_d", "n", "sigma2", "loglik", "aic", "aicc", "bic", F.col("root").alias("largest_inverse_root"))
