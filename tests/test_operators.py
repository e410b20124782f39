import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoloom.models import arima as ar
from chronoloom.models import regression as rg
from chronoloom.models import smoothing as sm
from chronoloom.operators import decompose as dc
from chronoloom.operators import loess as ls
from chronoloom.operators import features as ft
from chronoloom.operators import hierarchy as hy
from chronoloom.operators import index as ix
from chronoloom.operators import reconcile as rc
from chronoloom.operators import stats as st
from chronoloom.operators.blocks import lag_columns, row_numbers, running_sums
from chronoloom.operators.crossval import cross_validate
from chronoloom.operators.quantile import group_quantiles
from chronoloom.series import SeriesSpec, to_series
from helpers import SPEC, frame, noisy


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# ---- blocks ------------------------------------------------------------

@pytest.mark.parametrize("block", [3, 7, 1000])
def test_lags_do_not_depend_on_blocks(spark, block):
    y = list(range(40))
    out = lag_columns(frame(spark, {"a": y, "b": y[:5]}), SPEC, {"b2": ("y", 2), "f3": ("y", -3)}, block=block)
    for k, i, _, v, b, f in rows(out.select("key", "idx", "t", "y", "b2", "f3"), "key", "idx"):
        n = 40 if k == "a" else 5
        assert b == (v - 2 if v >= 2 else None)
        assert f == (v + 3 if v + 3 < n else None)
    assert out.count() == 45


@pytest.mark.parametrize("block", [4, 1000])
def test_running_sums_cross_blocks(spark, block):
    y = noisy(30)
    out = running_sums(frame(spark, {"a": y}), ["key"], "t", {"s": F.col("y")}, block=block)
    assert np.allclose([r["s"] for r in out.orderBy("t").collect()], np.cumsum(y))


def test_row_numbers_cross_buckets(spark):
    df = frame(spark, {"a": range(25), "b": range(3)})
    up = row_numbers(df, ["key"], F.col("t"), F.floor(F.col("t") / 4))
    down = row_numbers(df, ["key"], F.col("t"), F.floor(F.col("t") / 4), descending=True)
    assert all(r["rn"] == r["idx"] for r in up.collect())
    assert all(r["rn"] == (25 if r["key"] == "a" else 3) + 1 - r["idx"] for r in down.collect())


def test_group_quantiles_are_exact(spark):
    rng = np.random.default_rng(3)
    data = {"a": rng.normal(size=3000).round(2), "b": np.array([5.0]), "c": np.repeat([1.0, 2.0], 500)}
    df = frame(spark, data)
    got = {r["key"]: r for r in group_quantiles(df, ["key"], "y", {"q0": 0, "q10": 0.1, "q50": 0.5, "q93": 0.93, "q100": 1}).collect()}
    for k, v in data.items():
        for name, p in (("q0", 0), ("q10", 10), ("q50", 50), ("q93", 93), ("q100", 100)):
            assert got[k][name] == pytest.approx(np.percentile(v, p), abs=1e-12)


# ---- index -------------------------------------------------------------

def test_duplicates_raise(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 2.0)], "key string, idx long, y double")
    with pytest.raises(ValueError):
        to_series(df, "key", "idx", "int")


def test_gaps_fill_once(spark):
    df = spark.createDataFrame([("a", 1, 1, 1.0), ("a", 4, 4, 2.0), ("b", 2, 2, 3.0)], "key string, idx long, t long, y double")
    once, spec = ix.fill_gaps(df, SPEC.with_(gapless=False))
    twice, _ = ix.fill_gaps(once, spec)
    assert rows(once, "key", "t") == rows(twice, "key", "t")
    assert once.count() == 5 and spec.gapless
    assert ix.fill_gaps(df, SPEC, full=True)[0].count() == 8


def test_lag_needs_gapless(spark):
    with pytest.raises(ValueError):
        lag_columns(frame(spark, {"a": [1, 2]}), SPEC.with_(gapless=False), {"l": ("y", 1)})


def test_stretch_sizes(spark):
    out = ix.stretch(frame(spark, {"a": range(252)}), SPEC, init=3)
    assert out.select("fold").distinct().count() == 250
    assert out.count() == sum(range(3, 253))


def test_cross_validation_matches_folds(spark):
    y = noisy(20)
    got = {(r["model"], r["fold"]): r["error"] for r in cross_validate(frame(spark, {"a": y}), SPEC, "y", init=5, h=1).collect()}
    for i in range(5, 20):
        past, nxt = y[:i], y[i]
        want = {"mean": past.mean(), "naive": past[-1], "drift": past[-1] + (past[-1] - past[0]) / (i - 1)}
        for name, f in want.items():
            assert got[name, i - 4] == pytest.approx(nxt - f)


# ---- statistics --------------------------------------------------------

def test_acf_and_pacf(spark):
    y = noisy(60)
    x = y - y.mean()
    r = np.array([(x[k:] * x[:-k]).sum() / (x * x).sum() for k in range(1, 9)])
    df = frame(spark, {"a": y})
    assert np.allclose(st.acf(df, SPEC, "y", 8).first()["r"], r)
    full = np.concatenate([[1.0], r])
    want = [np.linalg.solve(np.array([[full[abs(i - j)] for j in range(k)] for i in range(k)]), full[1:k + 1])[-1] for k in range(1, 9)]
    assert np.allclose(st.pacf(df, SPEC, "y", 8).first()["p"], want)


def test_constant_series_give_null(spark):
    df = frame(spark, {"a": [5.0] * 12})
    assert st.acf(df, SPEC, "y", 3).first()["r"] == [None] * 3
    assert st.kpss(df, SPEC, "y", 12).first()["kpss_stat"] is None


def test_kpss_p_is_clamped(spark):
    df = spark.createDataFrame([(0.867,), (0.0236,), (0.40,)], "s double")
    p = [r[0] for r in df.select(st.interpolate_p(F.col("s"), st.KPSS_TABLE)).collect()]
    assert p[0] == 0.01 and p[1] == 0.10 and 0.05 < p[2] < 0.10


def test_flat_spot_and_crossings(spark):
    y = [0, 0, 0, 0, 10, 10, 0, 10, 10, 10]
    df = frame(spark, {"a": y})
    assert ft.flat_spot(df, SPEC, "y").first()["longest_flat_spot"] == 4
    assert ft.crossing_points(df, SPEC, "y").first()["n_crossing_points"] == sum(
        (a <= np.median(y)) != (b <= np.median(y)) for a, b in zip(y, y[1:]))


# ---- decomposition -----------------------------------------------------

def numpy_loess(x, y, w, q, at):
    n = len(x)
    order = np.argsort(np.abs(x - at), kind="stable")[:min(q, n)]
    left = min(max(at - q // 2, x[0]), x[-1] - q + 1) if n > q else x[0]
    sel = (x >= left) & (x <= left + q - 1) if n > q else np.ones(n, bool)
    d = x[sel] - at
    h = np.abs(d).max() + (max(0, (q - n) // 2))
    k = np.where(np.abs(d) / h > 0.999, 0, (1 - (np.abs(d) / h) ** 3) ** 3) * w[sel]
    a = np.vstack([np.ones_like(d), d]).T
    return np.linalg.lstsq(a * np.sqrt(k)[:, None], y[sel] * np.sqrt(k), rcond=None)[0][0] if order.size else np.nan


@pytest.mark.parametrize("q", [7, 15, 61])
def test_loess_matches_numpy(spark, q):
    y = noisy(40)
    got = [r["s"] for r in dc.loess(frame(spark, {"a": y}), SPEC, "y", q, "s").orderBy("t").collect()]
    x = np.arange(1, 41)
    # interior points are symmetric, so every tie rule agrees there and at the ends
    want = [numpy_loess(x, y, np.ones(40), q, t) for t in x]
    assert np.allclose(got, want, atol=1e-8)


@pytest.mark.parametrize("kw", [{}, {"s_window": "periodic"}, {"robust": True, "s_window": "periodic", "outer": 1}])
def test_stl_identity_and_shape(spark, kw):
    y = noisy(48)
    out = dc.stl(frame(spark, {"a": y}), SPEC, "y", **kw).orderBy("t").toPandas()
    assert len(out) == 48
    assert np.allclose(out.trend + out.season + out.remainder, y)
    assert np.allclose(out.season_adjust, y - out.season)
    assert out.remainder.std() < 0.8 and abs(out.season.mean()) < 0.2
    truth = 2 * np.sin(2 * np.pi * np.arange(48) / 4)
    assert np.corrcoef(out.season, truth)[0, 1] > 0.95


@pytest.mark.parametrize("s_window", [7, "periodic"])
def test_stl_does_not_depend_on_blocks(spark, s_window, monkeypatch):
    df = frame(spark, {"a": noisy(600)})
    out = []
    for block in (1, 10 ** 6):
        monkeypatch.setattr(dc, "LOESS_BLOCK", block)
        out.append(dc.stl(df, SPEC, "y", s_window=s_window).orderBy("t").toPandas())
    assert len(out[0]) == 600
    assert np.allclose(out[0][["trend", "season"]], out[1][["trend", "season"]])


@pytest.mark.parametrize("q", [7, 8, 101, 900, 2001])
def test_kernel_matches_explicit_lines(q):
    rng = np.random.default_rng(q)
    v, w = 1e6 + rng.normal(0, 1, 1200), rng.uniform(0, 1, 1200)
    w[300:420] = 0.0  # a stretch without weight, wider than the short spans
    v[50], v[51] = np.nan, np.inf
    got = ls.local_lines(v, w, 10, 10, 1209, q, 9, 1210)
    seen = np.isfinite(v)
    n = 1200
    at = np.arange(9, 1211)
    left = np.clip(at - q // 2, 10, max(10, 1209 - q + 1)) if n > q else np.full(len(at), 10)
    right = left + q - 1 if n > q else np.full(len(at), 1209)
    reach = np.maximum(at - left, right - at) + max((q - n) // 2, 0)
    want = ls._explicit(np.where(seen, v - 1e6, 0.0), np.where(seen, w, 0.0), 10, at, left, right, reach) + 1e6
    assert np.array_equal(np.isnan(got), np.isnan(want))
    assert np.nanmax(np.abs(got - want)) < 1e-6


def test_kernel_in_parts_equals_whole():
    """A part of a series with its surroundings gives the numbers of the whole."""
    v = np.random.default_rng(3).normal(0, 1, 5000)
    one = np.ones(5000)
    whole = ls.local_lines(v, one, 0, 0, 4999, 301, 0, 4999)
    part = ls.local_lines(v[1000:2000], one[:1000], 1000, 0, 4999, 301, 1300, 1699)
    assert np.allclose(whole[1300:1700], part)


def test_kernel_time_grows_with_n_log_n():
    """A season of 1,440 periods: ten times the rows take nowhere near a hundred times as long."""
    took = []
    for n in (20_000, 200_000):
        v = np.sin(np.arange(n) * 2 * np.pi / 1440)
        t0 = time.perf_counter()
        ls.stl_block(0, v, np.ones(n), np.zeros(n), 0, n - 1, 1440, 11, 1441, 2501)
        took.append(time.perf_counter() - t0)
    assert took[1] < 30 * took[0] + 1


@pytest.mark.parametrize("n", [1, 2, 3, 5, 9])
def test_stl_of_short_series(spark, n):
    """Shorter than a season or two: rows stay, nothing fails."""
    out = dc.stl(frame(spark, {"a": noisy(n), "b": noisy(40)}), SPEC, "y").toPandas()
    assert (out.key == "a").sum() == n and (out.key == "b").sum() == 40


def test_robust_seasons_share_their_weights(spark):
    """One outlier moves the seasons little in the robust form, and a lot in the plain one."""
    t = np.arange(240)
    clean = 10 + 2 * np.sin(2 * np.pi * t / 4) + 3 * np.sin(2 * np.pi * t / 12)
    y = clean + np.random.default_rng(5).normal(0, 0.1, 240)
    hit = y.copy()
    hit[117] += 60
    err = {}
    for robust in (False, True):
        a = dc.stl_multi(frame(spark, {"a": y}), SPEC, "y", [4, 12], robust=robust).orderBy("t").toPandas()
        b = dc.stl_multi(frame(spark, {"a": hit}), SPEC, "y", [4, 12], robust=robust).orderBy("t").toPandas()
        err[robust] = max(np.abs(a[c] - b[c]).max() for c in ("season_4", "season_12"))
        assert np.allclose(b.trend + b.season_4 + b.season_12 + b.remainder, hit)
    assert err[True] < 1.5 and err[False] > 5


def test_stl_rejects_nulls(spark):
    with pytest.raises(Exception, match="values in every period"):
        dc.stl(frame(spark, {"a": [1.0, None, 3.0, 4.0] * 4}), SPEC, "y").collect()


def test_henderson_weights():
    w = dc.henderson_weights(13)
    assert sum(w) == pytest.approx(1.0) and w[6] == pytest.approx(0.24006, abs=1e-5)


def test_interpolation_and_ends(spark):
    df = frame(spark, {"a": [None, 1.0, None, None, 4.0, None]})
    assert [r["y"] for r in dc.interpolate(df, SPEC, "y").orderBy("t").collect()] == [1.0, 1.0, 2.0, 3.0, 4.0, 4.0]


# ---- models ------------------------------------------------------------

def test_regression_matches_lstsq(spark):
    y = noisy(40)
    df = rg.with_trend(frame(spark, {"a": y, "b": y * 2}), SPEC)
    terms = {"trend": F.col("trend"), **rg.season_dummies(SPEC)}
    fit = {r["key"]: r for r in rg.tslm(df, SPEC, "y", terms).collect()}
    t = np.arange(1, 41)
    x = np.column_stack([np.ones(40), t, *[(t % 4 == j) for j in (1, 2, 3)]])
    b = np.linalg.lstsq(x, y, rcond=None)[0]
    assert np.allclose(fit["a"]["beta"], b) and np.allclose(fit["b"]["beta"], 2 * b)
    sse = ((y - x @ b) ** 2).sum()
    assert fit["a"]["aic"] == pytest.approx(40 * np.log(sse / 40) + 2 * (4 + 2))
    # dummies and full Fourier terms span the same space
    four = rg.tslm(df, SPEC, "y", {"trend": F.col("trend"), **rg.fourier_terms(2, 4)}).where("key = 'a'").first()
    assert four["sse"] == pytest.approx(sse)


def test_wide_gram_matches_narrow(spark):
    from chronoloom.operators import linalg
    y = noisy(60)
    df = rg.with_trend(frame(spark, {"a": y, "b": y + 1}), SPEC)
    cols = df.select("key", F.lit(1.0).alias("one"), "trend", "y")
    a = {r["key"]: r for r in linalg.gram(cols, ["key"], ["one", "trend"], "y").collect()}
    vec = cols.select("key", F.array("one", "trend", "y").alias("v"))
    for r in linalg.gram_arrays(vec, ["key"], "v", 2, 1).collect():
        assert r["n"] == a[r["key"]]["n"] and np.allclose(r["g"], a[r["key"]]["g"])


def test_arimax_recovers_ar_errors(spark):
    rng = np.random.default_rng(5)
    n = 600
    e = np.zeros(n)
    for i in range(1, n):
        e[i] = 0.7 * e[i - 1] + rng.normal()
    x = rng.normal(size=n)
    df = frame(spark, {"a": 3 + 2 * x + e}).join(
        spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(x)], "t long, x double"), "t")
    fit = rg.arimax(df, SPEC, "y", {"x": F.col("x")}).first()
    assert fit["beta"][1] == pytest.approx(2, abs=0.15) and fit["phi"][0] == pytest.approx(0.7, abs=0.12)


def test_smoothing_blocks_agree(spark):
    y = noisy(50)
    df = frame(spark, {"a": y, "b": y[:30] + 3})
    for s in (sm.Ets(), sm.Ets("A", "Ad", "N"), sm.Ets("M", "A", "M")):
        one = {r["key"]: r for r in sm.fit_ets(df, SPEC, "y", [s]).collect()}
        many = {r["key"]: r for r in sm.fit_ets(df, SPEC, "y", [s], block=20).collect()}
        for k in one:
            if s.season == "N":
                assert np.allclose(one[k]["params"], many[k]["params"])
                assert one[k]["aicc"] == pytest.approx(many[k]["aicc"])
            assert one[k]["n"] == many[k]["n"]


def test_ets_beats_coarse_search_and_stores_states(spark):
    y = noisy(60)
    s = sm.Ets("A", "A", "A")
    df = frame(spark, {"a": y})
    fit = sm.fit_ets(df, SPEC, "y", [s])
    path = sm.ets_states(df, SPEC, "y", fit, s).orderBy("t").toPandas()
    row = fit.first()
    assert ((y - path.fitted) ** 2).sum() == pytest.approx(row["state"][2])
    fc = sm.forecast_ets(fit, SPEC, 8).orderBy("h").toPandas()
    truth = 10 + 0.1 * np.arange(60, 68) + 2 * np.sin(2 * np.pi * np.arange(60, 68) / 4)
    assert np.abs(fc["mean"] - truth).mean() < 1.0 and (fc.sigma.diff().dropna() >= 0).all()


def test_arima_recovers_ar2(spark):
    rng = np.random.default_rng(2)
    y = np.zeros(800)
    for i in range(2, 800):
        y[i] = 0.5 * y[i - 1] + 0.3 * y[i - 2] + rng.normal()
    df = frame(spark, {"a": y + 5})
    fit = ar.fit_arima(df, SPEC.with_(period=1), "y", [ar.Order(2, 0)], m=1).first()
    coef = dict(zip(fit["terms"], fit["beta"]))
    assert coef["ar1"] == pytest.approx(0.5, abs=0.1) and coef["ar2"] == pytest.approx(0.3, abs=0.1)
    fc = ar.forecast_arima(ar.fit_arima(df, SPEC.with_(period=1), "y", [ar.Order(2, 0)], m=1), SPEC, 3).orderBy("h").collect()
    c = coef["constant"]
    v = list(y[-2:] + 5)
    for r in fc:
        v.append(c + coef["ar1"] * v[-1] + coef["ar2"] * v[-2])
        assert r["mean"] == pytest.approx(v[-1], rel=1e-6)


# ---- hierarchies -------------------------------------------------------

STRUCT = [["a", "b"], ["c"]]


def hier(spark, seed=0):
    rng = np.random.default_rng(seed)
    rows_ = [(f"a{i}", f"a{i}b{j}", f"c{k}", t, float(rng.gamma(3))) for i in range(2) for j in range(3) for k in range(2) for t in range(1, 6)]
    leaves = spark.createDataFrame(rows_, "a string, b string, c string, t long, y double")
    nodes = hy.label_margins(hy.aggregate_key(leaves, STRUCT, ["t"], [F.sum("y").alias("y")]), STRUCT)
    noise = F.pmod(F.hash("a", "b", "c", "t"), F.lit(100)) / 100.0
    return nodes.withColumn("mean", F.col("y") + noise).drop("y")


def coherent(df):
    pdf = df.toPandas()
    leaf = pdf[~(pdf.is_agg_a | pdf.is_agg_b | pdf.is_agg_c)]
    for _, r in pdf.iterrows():
        sel = leaf[leaf.t == r.t]
        for k in "abc":
            if not r[f"is_agg_{k}"]:
                sel = sel[sel[k] == r[k]]
        assert r["mean"] == pytest.approx(sel["mean"].sum(), rel=1e-6, abs=1e-6)


def test_level_count():
    assert len(hy.levels(STRUCT)) == 6 and len(hy.levels([["a"], ["b"], ["c"]])) == 8


def test_reconciliations_are_coherent(spark):
    fc = hier(spark).cache()
    dense = rc.min_trace(fc, STRUCT, ["t"], "ols")
    coherent(dense)
    coherent(rc.bottom_up(fc, STRUCT, ["t"]))
    cg = hy.label_margins(rc.min_trace_cg(fc, STRUCT, ["t"]), STRUCT)
    both = dense.withColumnRenamed("mean", "m1").join(cg.withColumnRenamed("mean", "m2"), ["a", "b", "c", "t", *hy.flags(STRUCT)])
    assert both.count() == fc.count()
    assert both.where(F.abs(F.col("m1") - F.col("m2")) > 1e-6).count() == 0
    # projecting twice changes nothing
    again = rc.min_trace(dense, STRUCT, ["t"], "ols")
    gap = dense.withColumnRenamed("mean", "m1").join(again.withColumnRenamed("mean", "m2"), ["a", "b", "c", "t", *hy.flags(STRUCT)])
    assert gap.where(F.abs(F.col("m1") - F.col("m2")) > 1e-8).count() == 0


def test_real_null_keys_are_not_margins(spark):
    df = spark.createDataFrame([(None, 1, 2.0), ("x", 1, 3.0)], "k string, t long, y double")
    out = hy.aggregate_key(df, [["k"]], ["t"], [F.sum("y").alias("y")])
    assert sorted((r["is_agg_k"], r["y"]) for r in out.collect()) == [(False, 2.0), (False, 3.0), (True, 5.0)]


def test_empty_frame(spark):
    empty = frame(spark, {"a": [1.0]}).limit(0)
    assert st.acf(empty, SPEC, "y", 3).count() == 0
    assert ix.new_data(empty, SPEC, 3).count() == 0
