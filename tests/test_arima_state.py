"""Uses of a fitted ARIMA against plain loops, for any cut into blocks."""
import numpy as np
import pytest
from helpers import SPEC, frame, noisy
from pyspark.sql import functions as F

from chronoloom.models import arima as ar
from chronoloom.models import arima_state as fitted
from chronoloom.operators.affine import affine_scan

MODELS = {  # key: (terms, beta, d, big_d)
    "a": (["constant", "ar1", "ma1", "ma4"], [0.2, 0.5, 0.3, 0.4], 0, 0), "b": (["ar1", "ar4", "ma2"], [0.4, 0.2, -0.5], 1, 1),
    "c": (["constant", "ma1"], [0.1, -0.6], 1, 0), "d": (["ar2"], [0.3], 2, 0), "e": ([], [], 1, 0)}


def fits(spark):
    rows = [(k, "arima", t, b, [0.1] * len(b), d, D, 4, "x", 0.5, 1.0) for k, (t, b, d, D) in MODELS.items()]
    return spark.createDataFrame(rows, "key string, model string, terms array<string>, beta array<double>, se array<double>, d int, big_d int, m int, "
                                       "order string, root double, sigma2 double")


def series(n=60, holes=()):
    out = {k: noisy(n + 3 * i, seed=i) for i, k in enumerate(MODELS)}
    for v in out.values():
        v[list(holes)] = np.nan
    return out


def plain(values, key):
    """(w, e) of one series."""
    terms, beta, d, D = MODELS[key]
    own = dict(zip(terms, beta))
    w = np.asarray(values, float)
    for lag in [1] * d + [4] * D:
        w = np.r_[[np.nan] * lag, w[lag:] - w[:-lag]]
    e = np.full(len(w), np.nan)
    for t in range(len(w)):
        x = w[t] - own.get("constant", 0.0)
        for name, c in own.items():
            k = int(name[2:]) if name != "constant" else 0
            if name.startswith("ar"):
                x -= c * (w[t - k] if t >= k else np.nan)
            if name.startswith("ma") and t >= k:
                x -= c * np.nan_to_num(e[t - k])
        e[t] = x
    return w, e


def ahead(values, key, h):
    """Forecasts 1..h steps after the last value."""
    terms, beta, d, D = MODELS[key]
    w, e = plain(values, key)
    own, w, e, v = dict(zip(terms, beta)), list(w), list(np.nan_to_num(e)), list(values)
    for _ in range(h):
        x = own.get("constant", 0.0) + sum(c * (w if n[0] == "a" else e)[-int(n[2:])] for n, c in own.items() if n != "constant")
        w.append(x)
        e.append(0.0)
        poly = np.array([1.0])
        for lag in [1] * d + [4] * D:
            poly = np.convolve(poly, np.r_[1.0, np.zeros(lag - 1), -1.0])
        v.append(x - sum(poly[k] * v[-k] for k in range(1, len(poly))))
    return v[-h:]


def columns(df, *names):
    out = {}
    for r in df.orderBy("key", "t").collect():
        out.setdefault(r.key, []).append([np.nan if r[n] is None else r[n] for n in names])
    return {k: np.array(v, float) for k, v in out.items()}


@pytest.mark.parametrize("block", [7, None])
def test_affine_scan_equals_loop(spark, block):
    rng = np.random.default_rng(2)
    own, systems, want = {}, [], {}
    for k, r in (("a", 1), ("b", 3), ("c", 3)):
        u = rng.normal(size=40)
        u[rng.random(40) < .2] = np.nan
        A, b, H, x0 = rng.normal(size=(r, r)) / 3, rng.normal(size=r), rng.normal(size=(r, r)) / 3, rng.normal(size=r)
        own[k] = u
        systems.append((k, A.ravel().tolist(), b.tolist(), H.ravel().tolist(), x0.tolist()))
        x, seen = x0, []
        for v in u:
            x = H @ x if np.isnan(v) else A @ x + b * v
            seen.append(x[0])
        want[k] = (seen, x)
    kinds = "key string, A array<double>, b array<double>, hole array<double>, x0 array<double>"
    out, last = affine_scan(frame(spark, own, start=-13), ["key"], "t", "y", spark.createDataFrame(systems, kinds), {"s": 0}, ["idx"], block)
    got = columns(out, "s")
    for k, (seen, x) in want.items():
        assert np.allclose(got[k][:, 0], seen)
        assert np.allclose(last.where(F.col("key") == k).first().x, x)
    empty, none = affine_scan(frame(spark, own).limit(0), ["key"], "t", "y", spark.createDataFrame(systems, kinds), {"s": 0})
    assert empty.count() == 0 and none.count() == 0


@pytest.mark.parametrize("block", [7, None])
@pytest.mark.parametrize("holes", [(), (20, 21, 33)])
def test_augment_equals_loop(spark, block, holes):
    own = series(holes=holes)
    got = columns(fitted.augment_arima(frame(spark, own), SPEC, "y", fits(spark), block), "y", "fitted", "resid")
    for k, v in own.items():
        _, e = plain(v, k)
        assert np.allclose(got[k][:, 2], e, equal_nan=True) and np.allclose(got[k][:, 1], v - e, equal_nan=True)


def test_refit_forecasts_from_new_rows(spark):
    own = series()
    again = fitted.refit_arima(frame(spark, own), SPEC, "y", fits(spark), 9)
    got = {}
    for r in ar.forecast_arima(again, SPEC, 5).orderBy("key", "h").collect():
        got.setdefault(r.key, []).append(r["mean"])
    for r in again.collect():
        _, e = plain(own[r.key], r.key)
        assert r.n == np.isfinite(e).sum() and np.isclose(r.sigma2, np.nanmean(e ** 2)) and r.t_last == len(own[r.key])
        assert np.allclose(got[r.key], ahead(own[r.key], r.key, 5))


def test_fitted_h_equals_forecasts_from_every_origin(spark):
    own = series(30)
    got = columns(fitted.fitted_h(frame(spark, own), SPEC, "y", fits(spark), 3), "fitted")
    for k, v in own.items():
        for t in range(len(v)):
            want = ahead(v[:t - 2], k, 3)[-1] if t >= 14 else None
            if want is not None:
                assert np.isclose(got[k][t, 0], want), (k, t)
    one = columns(fitted.fitted_h(frame(spark, own), SPEC, "y", fits(spark), 1), "fitted")
    aug = columns(fitted.augment_arima(frame(spark, own), SPEC, "y", fits(spark)), "fitted")
    for k in own:
        both = np.isfinite(aug[k])
        assert np.allclose(one[k][both], aug[k][both])


def test_interpolation(spark):
    own = series(holes=(0, 20, 21, 22, 40, 59))
    for block in (7, None):
        got = columns(fitted.interpolate_arima(frame(spark, own), SPEC, "y", fits(spark), block), "y", "filled")
        for k, v in own.items():
            known = np.isfinite(v)
            assert np.isfinite(got[k][:, 1]).all() and np.allclose(got[k][known, 1], v[known])
        walk, x = got["e"][:, 1], np.arange(len(own["e"]))
        inner = slice(1, 59)
        assert np.allclose(walk[inner], np.interp(x, x[np.isfinite(own["e"])], own["e"][np.isfinite(own["e"])])[inner])
    # a line goes on as a line under two differences, in a gap and at both ends
    line = {"d": 3.0 + 2.0 * np.arange(40)}
    line["d"][[0, 1, 10, 11, 12, 39]] = np.nan
    assert np.allclose(columns(fitted.interpolate_arima(frame(spark, line), SPEC, "y", fits(spark)), "filled")["d"][:, 0], 3.0 + 2.0 * np.arange(40))
    none = columns(fitted.interpolate_arima(frame(spark, {"a": [None, None]}), SPEC, "y", fits(spark)), "filled")
    assert np.isnan(none["a"]).all()


def test_fit_with_missing_values_counts_periods(spark):
    v = noisy(200, seed=8)
    w = v.copy()
    w[[60, 61, 120]] = np.nan
    fit = ar.fit_arima(frame(spark, {"k": w}), SPEC, "y", [ar.Order(1, 0, constant=False)], d=1).first()
    d = np.diff(w)
    ok = np.isfinite(d[1:]) & np.isfinite(d[:-1])
    assert np.isclose(fit.beta[0], (d[1:] * d[:-1])[ok].sum() / (d[:-1] ** 2)[ok].sum()) and fit.n == ok.sum()
    roots = fitted.roots_arima(fits(spark), SPEC).where("key = 'a'").orderBy("kind", "number").collect()
    assert [r.kind for r in roots] == ["ar"] + ["ma"] * 4 and np.isclose(roots[0].re, 0.5)
    assert fitted.tidy_arima(fits(spark), SPEC).count() == sum(len(m[0]) for m in MODELS.values())
