"""ARIMA and vector autoregressions by least squares on lags.

Innovations come from a long autoregression (Yule-Walker on autocorrelations);
orders are then regressions of the differenced series on its own lags and the
lagged innovations.  All candidate orders share one cross-product table.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from chronoloom.functions.calendar import horizon
from chronoloom.operators.blocks import cut_lineage, lag_columns
from chronoloom.operators.linalg import _solve, gram
from chronoloom.operators.stats import centred
from chronoloom.series import SeriesSpec, require_gapless


@dataclass(frozen=True)
class Order:
    p: int = 0
    q: int = 0
    P: int = 0
    Q: int = 0
    constant: bool = True


def differenced(df: DataFrame, spec: SeriesSpec, y: str, d: Column, big_d: Column, m: int) -> DataFrame:
    """Column ``_w``: y differenced ``d`` (0..2) and seasonally ``big_d`` (0..1)
    times; the orders may differ by key, one ordered pass serves all."""
    lags = {f"_y{k}": (y, k) for k in sorted({1, 2} | ({m, m + 1, m + 2} if m > 1 else set()))}
    base = lag_columns(df, spec, lags)

    def diff(a, b, c):
        return F.when(d == 0, a).when(d == 1, a - b).otherwise(a - 2 * b + c)

    plain = diff(F.col(y), F.col("_y1"), F.col("_y2"))
    if m > 1:
        seasonal = diff(F.col(y) - F.col(f"_y{m}"), F.col("_y1") - F.col(f"_y{m + 1}"), F.col("_y2") - F.col(f"_y{m + 2}"))
        plain = F.when(big_d == 1, seasonal).otherwise(plain)
    return base.withColumn("_w", plain).drop(*lags)


def long_lags(n: int, m: int) -> list[int]:
    """Lags of the long autoregression of ``n`` values: up to floor(10 log10 n), and m and 2m; none beyond n / 4."""
    plain = min(int(np.floor(10 * np.log10(n))), n // 4) if n > 0 else 0
    return sorted({*range(1, plain + 1), *(k for k in (m, 2 * m) if m > 1 and k <= n // 4)})


def innovations(base: DataFrame, spec: SeriesSpec, order: int | None = None, m: int = 1) -> DataFrame:
    """Column ``_e``: residuals of the long autoregression of ``_w``; ``_n`` values a key, ``_reach`` the longest lag used.

    Lags follow from each key's own length unless ``order`` is given.
    """
    rows = cut_lineage(base)  # missing values stay: lags count periods

    def own(n: int) -> list[int]:
        return long_lags(int(n), m) if order is None else list(range(1, order + 1))

    longest = rows.groupBy(*spec.by).agg(F.count("_w").alias("count")).agg(F.max("count")).first()[0] or 0
    lags = own(longest)
    apart = sorted({0, *lags, *(abs(i - j) for i in lags for j in lags)})
    mid = centred(rows, spec, "_w")
    sums = lag_columns(mid, spec, {f"_c{k}": ("_x", k) for k in apart if k}).withColumn("_c0", F.col("_x")).groupBy(*spec.by).agg(
        F.first("_n").alias("_n"), F.array(*[F.coalesce(F.sum(F.col("_x") * F.col(f"_c{k}")), F.lit(0.0)) for k in apart]).alias("_c"))

    def yule_walker(n: pd.Series, c: pd.Series) -> pd.Series:
        out = []
        for ni, ci in zip(n, c):
            at, use = dict(zip(apart, ci)), own(ni)
            phi = {k: 0.0 for k in use}
            if use and at[0] > 0:
                inv = np.linalg.pinv(np.array([[at[abs(i - j)] for j in use] for i in use]), hermitian=True)
                phi = dict(zip(use, inv @ np.array([at[k] for k in use])))
            out.append([phi.get(k) for k in lags])
        return pd.Series(out)

    phi = sums.select(*spec.by, pandas_udf(yule_walker, "array<double>")("_n", "_c").alias("_phi"))
    lagged = lag_columns(mid, spec, {f"_x{k}": ("_x", k) for k in lags}).join(phi, spec.by)
    # a lag that the key does not use has no coefficient
    terms = [F.when(F.col("_phi")[i].isNull(), 0.0).otherwise(F.col(f"_x{k}") * F.col("_phi")[i]) for i, k in enumerate(lags)]
    reach = F.greatest(F.lit(0), F.lit(0), *[F.when(F.col("_phi")[i].isNotNull(), k) for i, k in enumerate(lags)])
    return lagged.select(*spec.by, spec.t, "_w", (F.col("_x") - sum(terms, F.lit(0.0))).alias("_e"), "_n", reach.alias("_reach"))


def _largest_inverse_root(coefs: dict[int, float]) -> float:
    if not coefs:
        return 0.0
    poly = np.zeros(max(coefs) + 1)
    poly[0] = 1.0
    for lag, c in coefs.items():
        poly[lag] -= c
    return float(np.abs(np.roots(poly)).max()) if len(poly) > 1 else 0.0


def _pull_in(terms: list[str], beta, limit: float = 1 / 1.001) -> list[float]:
    """Coefficients whose inverse roots are at most ``limit``: c_k becomes c_k r^k, which moves all roots of a part by r."""
    out = dict(zip(terms, map(float, beta)))
    for prefix, sign in (("ar", 1.0), ("ma", -1.0)):
        own = {k: int(k[2:]) for k in out if k.startswith(prefix)}
        root = _largest_inverse_root({lag: sign * out[k] for k, lag in own.items()})
        if root > limit:
            for k, lag in own.items():
                out[k] *= (limit / root) ** lag
    return [out[k] for k in terms]


def _levels(candidates: list[Order]) -> list[Order]:
    """Highest orders to search, from those of the candidates down to what short series allow."""
    top = Order(*[max(getattr(c, k) for c in candidates) for k in ("p", "q", "P", "Q")])
    steps = [(9, 2), (9, 1), (3, 1), (2, 1), (9, 0), (3, 0), (2, 0), (1, 0), (0, 0)]
    levels = [top, *[Order(min(top.p, a), min(top.q, a), min(top.P, b), min(top.Q, b)) for a, b in steps]]
    return [x for x in dict.fromkeys(levels) if any(_within(c, x) for c in candidates)]


def _within(c: Order, top: Order) -> bool:
    return c.p <= top.p and c.q <= top.q and c.P <= top.P and c.Q <= top.Q


def _lags(plain: int, seasonal: int, m: int) -> list[int]:
    return sorted({*range(1, plain + 1), *(m * j for j in range(1, seasonal + 1))})


def fit_arima(df: DataFrame, spec: SeriesSpec, y: str, candidates: list[Order], d: int | DataFrame = 0, big_d: int = 0,
              long_order: int | None = None, m: int | None = None) -> DataFrame:
    """Fit every candidate to every series and keep the lowest AICc.

    ``d`` is a number or a frame (keys, d, big_d).  Candidates with a root on
    or inside the unit circle are rejected; where all of them are, the best one
    is kept with its roots moved just outside.  All candidates of a series share
    one sample; where that would be less than three rows a coefficient of the
    largest one, the highest orders are left out for that series.
    """
    require_gapless(spec, "an ARIMA model")
    m = m or int(round(spec.m))
    if m <= 1:  # no season
        candidates = [c for c in candidates if not (c.P or c.Q)] or candidates
    base = df.select(*spec.by, spec.t, F.col(y).cast("double").alias("_v"))
    if isinstance(d, DataFrame):
        base = base.join(d, spec.by)
    else:
        base = base.withColumns({"d": F.lit(d), "big_d": F.lit(big_d)})
    diff = differenced(base, spec, "_v", F.col("d"), F.col("big_d"), m)
    rows = innovations(diff, spec, long_order, m)
    levels = _levels(candidates)
    top = levels[0]
    ar, ma = _lags(top.p, top.P, m), _lags(top.q, top.Q, m)
    fits = []
    for i, x in enumerate(levels[:-1]):
        own_ar, own_ma = _lags(x.p, x.P, m), _lags(x.q, x.Q, m)
        lost = F.greatest(F.lit(max(own_ar, default=0)), F.col("_reach") + max(own_ma) if own_ma else F.lit(0))
        fits.append(F.when(F.col("_n") - lost >= 3 * (1 + len(own_ar) + len(own_ma)), i))
    lagged = lag_columns(rows, spec, {**{f"ar{k}": ("_w", k) for k in ar}, **{f"ma{k}": ("_e", k) for k in ma}})
    lagged = lagged.withColumn("_level", F.coalesce(*fits, F.lit(len(levels) - 1)))
    # lags beyond a key's level are not searched and must not cost it rows
    for name, lags, of in (("ar", ar, lambda x: _lags(x.p, x.P, m)), ("ma", ma, lambda x: _lags(x.q, x.Q, m))):
        for k in lags:
            used = F.col("_level").isin([i for i, x in enumerate(levels) if k in of(x)])
            lagged = lagged.withColumn(f"{name}{k}", F.when(used, F.col(f"{name}{k}")).otherwise(0.0))
    lagged = cut_lineage(lagged)
    cols = ["constant", *[f"ar{k}" for k in ar], *[f"ma{k}" for k in ma]]
    # differencing decides whether a constant makes sense
    grams = gram(lagged.withColumn("constant", F.lit(1.0)), spec.by, cols, "_w")
    kinds = base.groupBy(*spec.by).agg(F.first("d").alias("d"), F.first("big_d").alias("big_d"), F.max(spec.t).alias("t_last"))
    kinds = kinds.join(lagged.groupBy(*spec.by).agg(F.first("_level").alias("_level")), spec.by)
    cells = {}
    for c in sorted(candidates, key=lambda c: c.P + c.Q):  # a seasonal lag that is a plain one too makes no new candidate
        names = (["constant"] if c.constant else []) + [f"ar{k}" for k in _lags(c.p, c.P, m)] + [f"ma{k}" for k in _lags(c.q, c.Q, m)]
        cells.setdefault(tuple(names), (f"({c.p},{c.q})({c.P},{c.Q})" + ("+c" if c.constant else ""), c))

    def choose(p: pd.Series, n: pd.Series, g: pd.Series, diffs: pd.Series, level: pd.Series) -> pd.DataFrame:
        out = []
        for pi, ni, gi, di, li in zip(p, n, g, diffs, level):
            own = [(label, names) for names, (label, c) in cells.items() if _within(c, levels[li]) and not (c.constant and di > 1)]
            size = len(own)
            fit = _solve(pd.Series([pi] * size), pd.Series([ni] * size), pd.Series([gi] * size), pd.Series([[cols.index(x) for x in names] for _, names in own]))
            fit["order"], fit["terms"] = [label for label, _ in own], [list(names) for _, names in own]
            best = None
            # a candidate without a stable root is only used when nothing else is left
            for row in fit.sort_values(["aicc", "order"], na_position="last").itertuples(index=False):
                coefs = list(zip(row.terms, row.beta))
                root = max(_largest_inverse_root({int(k[2:]): v for k, v in coefs if k.startswith("ar")}),
                           _largest_inverse_root({int(k[2:]): -v for k, v in coefs if k.startswith("ma")}))
                if best is None or root <= 1 / 1.001:
                    best = (row.order, row.terms, row.beta, row.se, root, row.sigma2, row.loglik, row.aic, row.aicc, row.bic)
                if root <= 1 / 1.001:
                    break
            if best and best[4] > 1 / 1.001:  # nothing stable to choose from: as near as the circle allows
                best = (*best[:2], _pull_in(best[1], best[2]), best[3], 1 / 1.001, *best[5:])
            out.append(best or (None,) * 10)
        return pd.DataFrame(out, columns=["order", "terms", "beta", "se", "root", "sigma2", "loglik", "aic", "aicc", "bic"])

    kind = ("struct<order:string,terms:array<string>,beta:array<double>,se:array<double>,root:double,sigma2:double,loglik:double,aic:double,"
            "aicc:double,bic:double>")
    cand = grams.join(kinds, spec.by)
    best = cand.withColumn("_b", pandas_udf(choose, kind)("p", "n", "g", F.col("d") + F.col("big_d"), "_level")).where("_b.order IS NOT NULL")
    best = best.select(*spec.by, F.struct("_b.order", "_b.terms", "_b.beta", "_b.se", "n", "d", "big_d", "t_last", "_b.root", "_b.sigma2",
                                          "_b.loglik", "_b.aic", "_b.aicc", "_b.bic").alias("b"))
    tails = lagged.join(kinds.select(*spec.by, "t_last"), spec.by).where(F.col(spec.t) > F.col("t_last") - max([m, 1, *ar, *ma]))
    tails = tails.groupBy(*spec.by).agg(F.array_sort(F.collect_list(F.struct(spec.t, "_w", "_e"))).alias("_a"))
    hist = base.join(kinds.select(*spec.by, "t_last"), spec.by).where(F.col(spec.t) > F.col("t_last") - (m + 3))
    hist = hist.groupBy(*spec.by).agg(F.array_sort(F.collect_list(F.struct(spec.t, "_v"))).alias("_h"))
    out = best.join(tails, spec.by).join(hist, spec.by)
    return out.select(*spec.by, F.lit("arima").alias("model"), "b.*", F.lit(m).alias("m"), F.col("_a._w").alias("w_tail"),
                      F.col("_a._e").alias("e_tail"), F.col("_h._v").alias("y_tail"))


def grid_orders(p: int = 5, q: int = 5, big_p: int = 2, big_q: int = 2) -> list[Order]:
    return [Order(a, b, c, e, k) for a, b, c, e, k in product(range(p + 1), range(q + 1), range(big_p + 1), range(big_q + 1), (True, False))]


def _project(terms: pd.Series, beta: pd.Series, d: pd.Series, big_d: pd.Series, m: pd.Series, s2: pd.Series, w: pd.Series, e: pd.Series,
             y: pd.Series, h: pd.Series) -> pd.DataFrame:
    rows = []
    for nm, b, di, bd, mi, v, wt, et, yt, hi in zip(terms, beta, d, big_d, m, s2, w, e, y, h):
        ar = {int(n[2:]): c for n, c in zip(nm, b) if n.startswith("ar")}
        ma = {int(n[2:]): c for n, c in zip(nm, b) if n.startswith("ma")}
        const = next((c for n, c in zip(nm, b) if n == "constant"), 0.0)
        ws, es, ys = list(wt), [0.0 if x is None or np.isnan(x) else x for x in et], list(yt)
        poly = np.array([1.0])                              # (1-B)^d (1-B^m)^D
        for _ in range(int(di)):
            poly = np.convolve(poly, [1.0, -1.0])
        if bd:
            poly = np.convolve(poly, np.r_[1.0, np.zeros(int(mi) - 1), -1.0])
        full = np.zeros(max(ar, default=0) + 1)
        full[0] = 1.0
        for lag, c in ar.items():
            full[lag] -= c
        full = np.convolve(full, poly)
        psi = np.zeros(int(hi))
        means = []
        for i in range(int(hi)):
            x = const + sum(c * ws[-k] for k, c in ar.items()) + sum(c * es[-k] for k, c in ma.items())
            ws.append(x)
            es.append(0.0)
            nxt = x - sum(poly[k] * ys[-k] for k in range(1, len(poly)))
            ys.append(nxt)
            means.append(nxt)
            psi[i] = (1.0 if i == 0 else ma.get(i, 0.0)) - sum(full[k] * psi[i - k] for k in range(1, min(i, len(full) - 1) + 1))
        rows.append((means, np.sqrt(v * np.cumsum(psi ** 2))))
    return pd.DataFrame(rows, columns=["mean", "sigma"])


def forecast_arima(fit: DataFrame, spec: SeriesSpec, h: int | str | None = None) -> DataFrame:
    h = horizon(h, spec.unit, spec.period)
    step = pandas_udf(_project, "struct<mean:array<double>,sigma:array<double>>")
    out = fit.withColumn("_f", step("terms", "beta", "d", "big_d", "m", "sigma2", "w_tail", "e_tail", "y_tail", F.lit(h)))
    out = out.select(*spec.by, "model", "t_last", F.posexplode(F.arrays_zip(F.col("_f.mean").alias("mean"), F.col("_f.sigma").alias("sigma"))).alias("_i", "_x"))
    t = (F.col("t_last") + F.col("_i") + 1).cast("long")
    return out.select(*spec.by, "model", spec.index_expr(t).alias(spec.index), t.alias(spec.t), (F.col("_i") + 1).alias("h"), "_x.mean", "_x.sigma")


# ---- vector autoregression ----------------------------------------------

def fit_var(df: DataFrame, spec: SeriesSpec, ys: list[str], max_lag: int = 5, ic: str = "aicc") -> DataFrame:
    """VAR(p) for p = 0..max_lag on a common sample; lowest criterion kept."""
    lagged = lag_columns(df, spec, {f"_{y}{j}": (y, j) for j in range(1, max_lag + 1) for y in ys}).withColumn("_one", F.lit(1.0))
    cols = ["_one", *[f"_{y}{j}" for j in range(1, max_lag + 1) for y in ys]]
    g = gram(lagged, spec.by, cols, ys)
    kk = len(ys)

    def fit(n: pd.Series, flat: pd.Series) -> pd.DataFrame:
        rows = []
        for ni, gi in zip(n, flat):
            q = len(cols) + kk
            full = np.asarray(gi, float).reshape(q, q)
            best = None
            for p in range(max_lag + 1):
                r = 1 + kk * p
                xtx, xty, yty = full[:r, :r], full[:r, -kk:], full[-kk:, -kk:]
                b = np.linalg.pinv(xtx, hermitian=True) @ xty
                s = (yty - b.T @ xty) / ni
                det = np.linalg.slogdet(s)
                ll = -ni / 2 * (kk * np.log(2 * np.pi) + det[1] + kk)
                k = kk * r + kk * kk
                aic = -2 * ll + 2 * k
                aicc = aic + 2 * k * (k + 1) / (ni - k - 1) if ni > k + 1 else np.inf
                bic = -2 * ll + k * np.log(ni)
                crit = {"aic": aic, "aicc": aicc, "bic": bic}[ic]
                if det[0] > 0 and (best is None or crit < best[0]):
                    best = (crit, p, b.ravel(), s.ravel(), ll, aic, aicc, bic)
            rows.append(best[1:] if best else (None,) * 7)
        return pd.DataFrame(rows, columns=["p", "b", "s", "loglik", "aic", "aicc", "bic"])

    kind = "struct<p:int,b:array<double>,s:array<double>,loglik:double,aic:double,aicc:double,bic:double>"
    out = g.withColumn("_f", pandas_udf(fit, kind)("n", "g"))
    return out.select(*spec.by, "n", F.col("_f.p").alias("lags"), F.col("_f.b").alias("coef"), F.col("_f.s").alias("sigma"), "_f.loglik", "_f.aic", "_f.aicc", "_f.bic")


# ---- pooled non-linear autoregression ------------------------------------

def fit_pooled(df: DataFrame, spec: SeriesSpec, y: str, lags: list[int], trees: int = 20, depth: int = 4, seed: int = 11):
    """One tree ensemble on the lags of all series (scaled by their means, or mean sizes where the mean is 0).

    Series shorter than the longest lag do not teach but are forecast: values
    before their start count as their mean.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor
    scale = df.groupBy(*spec.by).agg(F.avg(y).alias("_m"), F.avg(F.abs(y)).alias("_s")).select(
        *spec.by, F.when(F.col("_m") != 0, F.col("_m")).when(F.col("_s") > 0, F.col("_s")).otherwise(F.lit(1.0)).alias("_scale"), F.col("_m"))
    base = df.select(*spec.by, spec.t, y).join(scale, spec.by).withColumns({
        "_z": F.col(y) / F.col("_scale"), "_fill": F.coalesce(F.col("_m") / F.col("_scale"), F.lit(0.0))})
    rows = lag_columns(base, spec, {f"_l{k}": ("_z", k) for k in lags})
    names = [f"_l{k}" for k in lags]
    asm = VectorAssembler(inputCols=names, outputCol="_x")
    known = F.col("_z").isNotNull()
    for n in names:
        known = known & F.col(n).isNotNull()
    train = asm.transform(rows.where(known))
    model = RandomForestRegressor(featuresCol="_x", labelCol="_z", numTrees=trees, maxDepth=depth, seed=seed, predictionCol="_p").fit(train)
    return model, base, asm


def forecast_pooled(model, base: DataFrame, asm, spec: SeriesSpec, lags: list[int], h: int) -> DataFrame:
    """Recursive forecast: one model pass over all series per step."""
    top = max(lags)
    last = base.groupBy(*spec.by).agg(F.max(spec.t).alias("_last"))
    tail = base.join(last, spec.by).where(F.col(spec.t) > F.col("_last") - top)
    cur = tail.groupBy(*spec.by, "_last", "_scale", "_fill").agg(
        F.reverse(F.array_sort(F.collect_list(F.struct(spec.t, F.coalesce("_z", "_fill").alias("_z")))))["_z"].alias("_a"))
    cur = cut_lineage(cur)
    for _ in range(h):
        row = cur.withColumns({f"_l{k}": F.coalesce(F.get("_a", F.lit(k - 1)), "_fill") for k in lags})
        pred = model.transform(asm.transform(row))
        cur = pred.select(*spec.by, "_last", "_scale", "_fill", F.concat(F.array("_p"), F.col("_a")).alias("_a"))
    steps = cur.select(*spec.by, "_last", "_scale", F.posexplode(F.reverse(F.slice("_a", 1, h))).alias("_i", "_z"))
    t = (F.col("_last") + F.col("_i") + 1).cast("long")
    return steps.select(*spec.by, F.lit("pooled_trees").alias("model"), spec.index_expr(t).alias(spec.index), t.alias(spec.t), (F.col("_i") + 1).alias("h"),
                        (F.col("_z") * F.col("_scale")).alias("mean"))
