"""Regression with ARMA errors from lagged cross products.

One pass over the rows gives, for each key, C_j = sum of v_t v_{t-j}' for
j = 0..lags, with v_t the regressors and the response, and the rows at both ends.
Everything else works on these sums: residual autocovariances are w' C_j w, the
errors' orders come from them (Yule-Walker, and Hannan-Rissanen where there are
moving averages), and so do the normal equations of the rows filtered by the errors' autoregressive
form, rows before the filter has all its lags left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from chronoloom.models import arima_state
from chronoloom.models.arima import forecast_arima
from chronoloom.operators.blocks import cut_lineage, halo_frame
from chronoloom.operators.linalg import _FIT, _solve
from chronoloom.operators.packed import add_up
from chronoloom.series import SeriesSpec, require_gapless

#: Periods that a task multiplies at a time.
ROWS = 4_096
_DOT = "aggregate(zip_with(_x, beta, (a, b) -> a * b), 0.0D, (s, v) -> s + v)"


def _row_vector(terms: dict[str, Column]) -> Column:
    return F.array(F.lit(1.0), *[c.cast("double") for c in terms.values()])


def lagged_products(rows: DataFrame, spec: SeriesSpec, width: int, lags: int, block: int | None = None) -> DataFrame:
    """(keys, c, head, tail) from rows (keys, t, ``_v``): lagged cross products, and the first and last ``lags`` rows.

    ``c`` holds C_0, C_1, ... row by row, then for each lag the pairs of known
    rows, then the number of rows.  Rows with a null in ``_v`` count as missing: they add nothing.
    """
    block = max(block or ROWS, lags, 1)
    key = F.to_json(F.struct(*spec.by)) if spec.by else F.lit("")
    laid, _ = halo_frame(rows.select(*spec.by, spec.t, "_v").withColumn("_key", key), spec.by, spec.t, lags, 0, block)
    laid = laid.select("_key", "_blk", F.col(spec.t).alias("_t"), "_home", F.when(F.forall("_v", lambda v: v.isNotNull()), F.col("_v")).alias("_v"))
    laid = laid.repartition("_key", "_blk").sortWithinPartitions("_key", "_blk", "_t")
    q, size = width, (lags + 1) * width * width

    def multiply(v: np.ndarray, known: np.ndarray, first: int) -> np.ndarray:
        out = np.zeros(size + lags + 2)
        n = len(v)
        for j in range(min(lags, n - 1) + 1):
            low = max(first, j)
            out[j * q * q:(j + 1) * q * q] = (v[low:].T @ v[low - j:n - j]).ravel()
            out[size + j] = np.count_nonzero(known[low:] & known[low - j:n - j])
        out[-1] = n - first
        return out

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, last, total = None, [], None, None

        def close():
            """Products of one block, and its edges."""
            nonlocal last, total
            home, known, v = (np.concatenate([h[i] for h in held]) for i in range(3))
            first = int(np.count_nonzero(~home))
            own = multiply(v, known, first)
            ready = []
            if group[0] != last:
                if last is not None:
                    ready.append((last, None, None, None, total))
                last, total = group[0], np.zeros(size + lags + 2)
            total += own
            tail = v[first:]
            ready.append((*group, tail[:lags].ravel(), tail[max(len(tail) - lags, 0):].ravel(), None))
            return ready

        def out(ready):
            names, blocks, heads, tails, sums = zip(*ready)
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(blocks, pa.int64()), pa.array(heads, pa.list_(pa.float64())),
                                               pa.array(tails, pa.list_(pa.float64())), pa.array(sums, pa.list_(pa.float64()))], ["id", "blk", "head", "tail", "x"])

        for part in parts:
            ready, n = [], part.num_rows
            if not n:
                continue
            values = part.column("_v")
            known = np.asarray(values.is_valid())
            v = np.zeros((n, q))
            v[known] = np.asarray(values.flatten()).reshape(-1, q)
            home, blk = np.asarray(part.column("_home")), np.asarray(part.column("_blk"))
            code = np.asarray(part.column("_key").dictionary_encode().indices)
            cuts = [0, *(np.flatnonzero((code[1:] != code[:-1]) | (blk[1:] != blk[:-1])) + 1).tolist(), n]
            for lo, hi in zip(cuts, cuts[1:]):
                own = (part.column("_key")[lo].as_py(), int(blk[lo]))
                if own != group:
                    if group:
                        ready += close()
                    group, held = own, []
                held.append((home[lo:hi], known[lo:hi], v[lo:hi]))
            if ready:
                yield out(ready)
        if group:
            yield out([*close(), (last, None, None, None, total)])

    made = cut_lineage(laid.mapInArrow(batches, "id string, blk long, head array<double>, tail array<double>, x array<double>"))
    sums = add_up(made.where("x IS NOT NULL").select("id", "x"), size + lags + 2)
    edges = made.where("x IS NULL")
    # a block has at least ``lags`` periods, so two blocks hold the ends; a last block of copies alone has no rows of its own
    span = edges.where(F.size("head") + F.size("tail") > 0).groupBy("id").agg(F.min("blk").alias("_lo"), F.max("blk").alias("_hi"))
    edges = edges.join(span, "id").where((F.col("blk") <= F.col("_lo") + 1) | (F.col("blk") >= F.col("_hi") - 1))
    ends = edges.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("blk", "head", "tail"))).alias("e"))
    ends = ends.select("id", F.slice(F.flatten("e.head"), 1, max(lags * q, 1)).alias("head"), F.reverse(F.slice(F.reverse(F.flatten("e.tail")), 1, max(lags * q, 1))).alias("tail"))
    out = sums.join(ends, "id", "left").withColumnRenamed("x", "c")
    if spec.by:
        types = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in spec.by)
        out = out.withColumn("_k", F.from_json("id", types))
    return out.select(*[F.col(f"_k.`{c}`").alias(c) for c in spec.by], "c", "head", "tail")


class Products:
    """The lagged cross products of one key."""

    def __init__(self, c, head, tail, q: int, lags: int):
        c = np.array(c, float)
        size = (lags + 1) * q * q
        self.c, self.n = c[:size].reshape(lags + 1, q, q), int(c[size])
        rows, pairs = int(c[-1]), c[size:-1]
        for j in range(lags + 1):  # products of missing rows are taken to be like the others
            if pairs[j] and rows > j:
                self.c[j] *= (rows - j) * self.n / rows / pairs[j]
        # where there are fewer rows than lags, the head is all of them
        self.head = np.asarray([] if head is None else head, float).reshape(-1, q)
        self.tail = np.asarray([] if tail is None else tail, float).reshape(-1, q)
        self.rows = rows

    def cross(self, i: int, j: int, first: int) -> np.ndarray:
        """Sum of v_{t-i} v_{t-j}' over t = first, ..., n - 1; i <= j <= first."""
        k = j - i
        s = self.c[k].copy()
        h = self.head[:first - i]
        if len(h) > k:
            s -= h[k:].T @ h[:len(h) - k]
        if i:
            end = len(self.tail)
            s -= self.tail[end - i:].T @ self.tail[end - i - k:end - k]
        return s

    def filtered(self, a: np.ndarray) -> tuple[np.ndarray, int]:
        """Cross product of a_0 v_t + a_1 v_{t-1} + ... over the rows that have all these lags, and their number."""
        r = len(a) - 1
        total = np.zeros_like(self.c[0])
        for i in range(r + 1):
            for j in range(i, r + 1):
                s = self.cross(i, j, r)
                total += a[i] * a[j] * (s if i == j else s + s.T)
        return total, max(self.n - r, 0)

    def autocovariances(self, w: np.ndarray, a: np.ndarray, top: int) -> np.ndarray:
        """Sums of u_t u_{t-j}, j = 0..top, for w'v filtered by ``a``, over the rows that have all lags."""
        d = len(a) - 1
        return np.array([sum(a[i] * a[k] * (w @ self.cross(min(i, j + k), max(i, j + k), d + j) @ w) for i in range(d + 1) for k in range(d + 1))
                         for j in range(top + 1)])


def levinson(g: np.ndarray, order: int) -> list[tuple[np.ndarray, float]]:
    """(coefficients, error variance times n) of the autoregressions of order 0..order."""
    phi, v = np.empty(0), g[0]
    out = [(phi, v)]
    for k in range(1, order + 1):
        if v <= 1e-12 * g[0] or g[0] <= 0:
            break
        kappa = (g[k] - phi @ g[k - 1:0:-1][:k - 1]) / v if k > 1 else g[1] / g[0]
        phi = np.append(phi - kappa * phi[::-1], kappa)
        v = v * (1 - kappa ** 2)
        out.append((phi, v))
    return out


def _stable(phi: np.ndarray) -> bool:
    return not len(phi) or np.abs(np.roots(np.r_[1.0, -phi])).max(initial=0.0) <= 1 / 1.001


def error_model(g: np.ndarray, n: int, max_ar: int, max_ma: int) -> tuple[np.ndarray, np.ndarray]:
    """(phi, theta) of the errors by AICc over all orders, from their autocovariances ``g``."""
    best = None
    ars = levinson(g, min(max_ar, len(g) - 1))
    long = levinson(g, max(min(len(g) - 1 - max_ma, int(10 * np.log10(max(n, 2))), n // 4), 0))[-1][0] if max_ma else np.empty(0)
    a = np.r_[1.0, -long]
    cross = lambda lag: sum(a[i] * g[abs(lag + i)] for i in range(len(a)))  # e_{t-k} with innovation t-l, lag = l - k
    own = lambda lag: sum(a[i] * a[j] * g[abs(lag + i - j)] for i in range(len(a)) for j in range(len(a)))
    c_lags = {lag: cross(lag) for lag in range(-max_ar, max_ma + 1)} if len(long) else {}
    o_lags = {lag: own(lag) for lag in range(max_ma)} if len(long) else {}
    for p in range(len(ars)):
        for q in range(max_ma + 1 if len(long) else 1):
            if q == 0:
                phi, theta, v = ars[p][0], np.empty(0), ars[p][1]
            else:
                m = np.empty((p + q, p + q))
                for i in range(p):
                    m[i, :p] = [g[abs(i - j)] for j in range(p)]
                    m[i, p:] = m[p:, i] = [c_lags[l - i] for l in range(q)]
                for k in range(q):
                    m[p + k, p:] = [o_lags[abs(k - l)] for l in range(q)]
                right = np.r_[g[1:p + 1], [c_lags[l] for l in range(1, q + 1)]]
                b = np.linalg.pinv(m, hermitian=True) @ right
                phi, theta, v = b[:p], b[p:], g[0] - b @ right
            if v <= 0 and g[0] > 0 or not _stable(phi) or not _stable(-theta):
                continue
            k = p + q + 1
            crit = n * np.log(max(v, 1e-300)) + 2 * k + 2 * k * (k + 1) / max(n - k - 1, 1)
            if best is None or crit < best[0] - 1e-9:
                best = (crit, phi, theta)
    return (best[1], best[2]) if best else (np.empty(0), np.empty(0))


def inverse_filter(phi: np.ndarray, theta: np.ndarray, d: int, top: int) -> np.ndarray:
    """Weights of the errors' autoregressive form; exact without moving averages, else up to ``top`` lags."""
    full = np.r_[1.0, -np.asarray(phi, float)]
    for _ in range(d):
        full = np.convolve(full, [1.0, -1.0])
    if not len(theta):
        return full
    out = np.zeros(top + 1)
    for i in range(top + 1):
        out[i] = (full[i] if i < len(full) else 0.0) - sum(theta[k] * out[i - k - 1] for k in range(min(len(theta), i)))
    return out


def arimax(df: DataFrame, spec: SeriesSpec, y: str, terms: dict[str, Column], max_order: int = 5, passes: int = 2, model: str = "arimax",
           max_ma: int = 0, d: int = 0, lags: int | None = None, block: int | None = None) -> DataFrame:
    """Regression whose errors are ARIMA(p, d, q), p up to ``max_order`` and q up to ``max_ma``.

    Rows are read once; ``lags`` (how far cross products reach) defaults to what
    the orders need, with moving averages to 30 more.  Rows with a null count as missing.
    """
    require_gapless(spec, "a regression with autoregressive errors")
    p, q = len(terms) + 1, len(terms) + 2
    reach = max_order + d + (max_ma + 30 if max_ma else 0)
    lags = max(lags or 0, reach)
    rows = df.select(*spec.by, spec.t, F.concat(_row_vector(terms), F.array(F.col(y).cast("double"))).alias("_v"))
    sums = lagged_products(rows, spec, q, lags, block)

    def fit(c: pd.Series, head: pd.Series, tail: pd.Series) -> pd.DataFrame:
        out = []
        for ci, hi, ti in zip(c, head, tail):
            own = Products(ci, hi, ti, q, lags)
            diff = inverse_filter(np.empty(0), np.empty(0), d, 0)
            top = min(lags, max(own.rows // 2 - 1, 0))
            solve = lambda a: _solve(pd.Series([p]), *[pd.Series([x]) for x in (own.filtered(a)[1], own.filtered(a)[0].ravel())], pd.Series([None])).iloc[0]
            phi, theta = np.empty(0), np.empty(0)
            best = solve(diff)
            for _ in range(passes):
                g = own.autocovariances(np.append(-np.asarray(best.beta), 1.0), diff, max(top - d, 0))
                phi, theta = error_model(g, max(own.n - d, 1), max_order, max_ma)
                best = solve(inverse_filter(phi, theta, d, top))
            out.append((*[best[name] for name in best.index], own.n, len(phi), list(phi), len(theta), list(theta)))
        names = ["beta", "se", "xtx_inv", "sse", "sst", "r2", "adj_r2", "sigma2", "loglik", "aic", "aicc", "bic"]
        return pd.DataFrame(out, columns=[*names, "n", "ar_order", "phi", "ma_order", "theta"])

    kind = _FIT[:-1] + ",n:long,ar_order:int,phi:array<double>,ma_order:int,theta:array<double>>"
    out = cut_lineage(sums.select(*spec.by, pandas_udf(fit, kind)("c", "head", "tail").alias("f")).select(*spec.by, F.lit(p).alias("p"), F.lit(1).alias("k"), "f.*"))
    return out.withColumns({"d": F.lit(d), "model": F.lit(model), "terms": F.array(*[F.lit(n) for n in ("intercept", *terms)])})


def _as_arima(fit: DataFrame, spec: SeriesSpec) -> DataFrame:
    """The error model of an ``arimax`` fit as an ARIMA fit without constant."""
    names = lambda prefix, col: F.transform(F.sequence(F.lit(1), F.greatest(F.size(col), F.lit(1))), lambda k: F.concat(F.lit(prefix), k.cast("string")))
    terms = F.concat(F.slice(names("ar", "phi"), F.lit(1), F.size("phi")), F.slice(names("ma", "theta"), F.lit(1), F.size("theta")))
    return fit.select(*spec.by, "model", F.lit("errors").alias("order"), terms.alias("terms"), F.concat("phi", "theta").alias("beta"),
                      F.lit(None).cast("array<double>").alias("se"), "d", F.lit(0).alias("big_d"), F.lit(None).cast("double").alias("root"),
                      F.lit(int(round(spec.m))).alias("m"), "sigma2")


def _plain(spec: SeriesSpec) -> SeriesSpec:
    return spec.with_(period=1)  # error models have no seasonal difference


def regression_residuals(df: DataFrame, spec: SeriesSpec, y: str, terms: dict[str, Column], fit: DataFrame) -> DataFrame:
    base = df.withColumn("_x", _row_vector(terms)).join(fit.select(*spec.by, "beta"), spec.by)
    return base.withColumn("regression", F.col(y) - F.expr(_DOT)).drop("_x", "beta")


def error_kinds(df: DataFrame, spec: SeriesSpec, y: str, terms: dict[str, Column], fit: DataFrame, max_order: int = 5) -> DataFrame:
    """Regression residuals and innovations of an ``arimax`` fit; the first rows of a key, which lack lags, have no innovation."""
    base = cut_lineage(regression_residuals(df, spec, y, terms, fit))
    inner = arima_state.innovations_of(base, _plain(spec), "regression", _as_arima(fit, spec))
    return base.join(inner.select(*spec.by, spec.t, F.col("_e").alias("innovation")), [*spec.by, spec.t], "left")


def forecast_arimax(future: DataFrame, resid: DataFrame, spec: SeriesSpec, terms: dict[str, Column], fit: DataFrame, h: int, max_order: int = 5) -> DataFrame:
    """Regression mean plus the forecast of the errors, whose variance is that of the forecast.

    ``resid`` holds the regression residuals.
    """
    errors = _as_arima(fit, spec)
    state = arima_state.refit_arima(resid, _plain(spec), "regression", errors).drop("sigma2").join(errors.select(*spec.by, "sigma2"), spec.by)
    path = forecast_arima(state, _plain(spec), h).select(*spec.by, spec.t, F.col("mean").alias("_error"), "sigma")
    base = future.withColumn("_x", _row_vector(terms)).join(fit.select(*spec.by, "model", "beta"), spec.by).join(path, [*spec.by, spec.t])
    return base.select(*spec.by, "model", spec.index, spec.t, "h", (F.expr(_DOT) + F.col("_error")).alias("mean"), "sigma")
