"""Regression with ARMA errors from lagged sums against rows."""
import numpy as np
import pytest
from helpers import SPEC
from pyspark.sql import functions as F

from chronoloom.models import arma_errors as ae, regression as rg


def data(spark, n=300, ar=(0.6,), ma=(), seed=5, d=0, holes=()):
    rng = np.random.default_rng(seed)
    out, arrays = [], {}
    for key, size in (("a", n), ("b", n // 2)):
        u, e = rng.normal(size=size + 50), np.zeros(size + 50)
        for t in range(5, size + 50):
            e[t] = sum(c * e[t - k - 1] for k, c in enumerate(ar)) + u[t] + sum(c * u[t - k - 1] for k, c in enumerate(ma))
        e = e[50:]
        for _ in range(d):
            e = np.cumsum(e)
        x = rng.normal(size=size)
        y = 3 + 2 * x + e
        y[list(holes)] = np.nan
        arrays[key] = (x, y)
        out += [(key, t + 1, t + 1, float(x[t]), None if np.isnan(y[t]) else float(y[t])) for t in range(size)]
    return spark.createDataFrame(out, "key string, idx long, t long, x double, y double"), arrays


def terms():
    return {"x": F.col("x")}


@pytest.mark.parametrize("block", [11, None])
def test_sums_equal_rows(spark, block):
    df, arrays = data(spark)
    rows = df.select("key", "t", F.array(F.lit(1.0), "x", "y").alias("_v"))
    a = np.array([1.0, -0.5, 0.2, 0.0, 0.1])
    for r in ae.lagged_products(rows, SPEC, 3, 6, block).collect():
        v = np.column_stack([np.ones(len(arrays[r.key][0])), *arrays[r.key]])
        own = ae.Products(r.c, r.head, r.tail, 3, 6)
        assert own.n == own.rows == len(v)
        for j in range(7):
            assert np.allclose(own.c[j], v[j:].T @ v[:len(v) - j])
        f = sum(c * v[4 - i:len(v) - i] for i, c in enumerate(a))
        got, n = own.filtered(a)
        assert np.allclose(got, f.T @ f) and n == len(f)


@pytest.mark.parametrize("block", [9, None])
def test_autoregressive_errors_equal_filtered_rows(spark, block):
    df, arrays = data(spark)
    for r in rg.arimax(df, SPEC, "y", terms(), max_order=3, passes=1, block=block).collect():
        x, y = arrays[r.key]
        v = np.column_stack([np.ones(len(x)), x])
        e = y - v @ np.linalg.lstsq(v, y, rcond=None)[0]
        g = np.array([e[j:] @ e[:len(e) - j] for j in range(4)])
        phi, theta = ae.error_model(g, len(e), 3, 0)
        assert np.allclose(r.phi, phi) and r.ar_order == len(phi) and not len(theta)
        a = np.r_[1.0, -phi]
        k = len(phi)
        w = sum(c * np.column_stack([v, y])[k - i:len(y) - i] for i, c in enumerate(a))
        beta, sse = np.linalg.lstsq(w[:, :2], w[:, 2], rcond=None)[:2]
        assert np.allclose(r.beta, beta) and np.isclose(r.sigma2, sse[0] / (len(w) - 2))


def test_moving_average_errors_and_differences(spark):
    df, _ = data(spark, 3_000, ar=(0.5,), ma=(0.6,))
    fit = rg.arimax(df, SPEC, "y", terms(), max_order=2, max_ma=2).where("key = 'a'").first()
    full = ae.inverse_filter(fit.phi, fit.theta, 0, 12)
    assert np.allclose(full, ae.inverse_filter([0.5], [0.6], 0, 12), atol=0.08)
    assert fit.ma_order >= 1 and fit.beta[1] == pytest.approx(2, abs=0.05) and fit.sigma2 == pytest.approx(1, abs=0.1)
    df, _ = data(spark, 2_000, ar=(0.5,), d=1)
    fit = rg.arimax(df, SPEC, "y", terms(), max_order=2, d=1).where("key = 'a'").first()
    assert fit.phi[0] == pytest.approx(0.5, abs=0.08) and fit.beta[1] == pytest.approx(2, abs=0.05)


def test_long_orders(spark):
    df, _ = data(spark, 4_000, ar=(0, 0, 0, 0, 0, 0, 0.8))
    fit = rg.arimax(df, SPEC, "y", terms(), max_order=9).where("key = 'a'").first()
    assert fit.ar_order >= 7 and fit.phi[6] == pytest.approx(0.8, abs=0.06)


def test_missing_rows_and_edges(spark):
    df, arrays = data(spark, 2_000, holes=(50, 51, 400))
    fit = rg.arimax(df, SPEC, "y", terms()).where("key = 'a'").first()
    assert fit.n == 1_997 and fit.beta[1] == pytest.approx(2, abs=0.06) and fit.phi[0] == pytest.approx(0.6, abs=0.06)
    assert rg.arimax(df.limit(0), SPEC, "y", terms()).count() == 0
    short = rg.arimax(df.where("t <= 4"), SPEC, "y", terms()).collect()
    assert len(short) == 2 and all(len(r.beta) == 2 for r in short)


@pytest.mark.parametrize("ma", [(), (0.5,)])
def test_innovations_and_forecasts(spark, ma):
    df, arrays = data(spark, 240, ma=ma)
    fit = rg.arimax(df, SPEC, "y", terms(), max_order=2, max_ma=len(ma)).cache()
    resid = rg.error_kinds(df, SPEC, "y", terms(), fit).cache()
    future = spark.createDataFrame([(k, n + h, n + h, h, 1.0) for k, n in (("a", 240), ("b", 120)) for h in range(1, 6)], "key string, idx long, t long, h int, x double")
    out = rg.forecast_arimax(future, resid, SPEC, terms(), fit, 5).orderBy("key", "h").collect()
    for r in fit.collect():
        x, y = arrays[r.key]
        e = y - r.beta[0] - r.beta[1] * x
        u = np.full(len(e), np.nan)
        for t in range(len(r.phi), len(e)):
            u[t] = e[t] - sum(c * e[t - k - 1] for k, c in enumerate(r.phi)) - sum(c * np.nan_to_num(u[t - k - 1]) for k, c in enumerate(r.theta) if t > k)
        got = [v.innovation for v in resid.where(F.col("key") == r.key).orderBy("t").collect()]
        assert np.allclose([np.nan if v is None else v for v in got], u, equal_nan=True)
        es, us, want = list(e), list(np.nan_to_num(u)), []
        for _ in range(5):
            es.append(sum(c * es[-k - 1] for k, c in enumerate(r.phi)) + sum(c * us[-k - 1] for k, c in enumerate(r.theta)))
            us.append(0.0)
            want.append(r.beta[0] + r.beta[1] + es[-1])
        mine = [v for v in out if v.key == r.key]
        assert np.allclose([v["mean"] for v in mine], want)
        assert np.isclose(mine[0].sigma, np.sqrt(r.sigma2)) and all(a.sigma <= b.sigma + 1e-12 for a, b in zip(mine, mine[1:]))
