"""Models: the same numbers whatever the block cut, no excluded parameters, no dropped series."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoloom.functions.special import chi2_tail, normal_cdf
from chronoloom.models import arima as ar
from chronoloom.models import smoothing as sm
from chronoloom.operators import linalg
from helpers import SPEC, frame, noisy


def growing(n=60):
    return np.cumsum(np.random.default_rng(1).normal(1, 0.1, n)) + 20


@pytest.mark.parametrize("form", [("A", "A", "N"), ("M", "N", "N"), ("A", "N", "A"), ("M", "Ad", "M")])
def test_blocks_change_nothing(spark, form):
    s = sm.Ets(*form)
    df = frame(spark, {"a": growing(), "b": noisy(50), "short": [1.0, 2.0], "negative": noisy(40) - 30})
    rows = lambda block: sorted((r.key, r.crit, tuple(r.params), tuple(r.state)) for r in sm.fit_ets(df, SPEC, "y", [s], block=block).collect())
    whole = rows(None)
    assert whole and whole == rows(7) == rows(25)
    alone = sorted((r.key, r.crit, tuple(r.params), tuple(r.state)) for r in sm.fit_ets(df.where("key = 'b'"), SPEC, "y", [s]).collect())
    assert alone == [r for r in whole if r[0] == "b"]


def test_population_like_data_reaches_the_edge(spark):
    best = sm.fit_ets(frame(spark, {"a": growing()}), SPEC, "y", [sm.Ets("A", "A", "N")]).first()
    assert best.params[0] > 0.99


def test_relative_errors_have_intervals(spark):
    df = frame(spark, {"a": noisy(60)})
    for s in (sm.Ets("M", "A", "M"), sm.Ets("M", "N", "N"), sm.Ets("A", "N", "M")):
        rows = sm.forecast_ets(sm.fit_ets(df, SPEC, "y", [s]), SPEC, 5).collect()
        assert all(r.sigma is not None and r.sigma > 0 for r in rows)
    # small relative errors: the simulation agrees with the closed form of the additive model
    a, m = (sm.forecast_ets(sm.fit_ets(df.withColumn("y", F.col("y") + 500), SPEC, "y", [sm.Ets(e, "N", "N")]), SPEC, 4).orderBy("h").collect() for e in "AM")
    assert all(abs(x.sigma / y.sigma - 1) < 0.1 for x, y in zip(a, m))


def test_random_walk_is_a_candidate(spark):
    y = growing()
    fit = ar.fit_arima(frame(spark, {"a": y}), SPEC, "y", [ar.Order(0, 0, constant=False)], d=1)
    row = fit.first()
    assert row.beta == [] and row.sigma2 == pytest.approx(float(np.mean(np.diff(y) ** 2)), rel=0.3)
    assert {round(r["mean"], 6) for r in ar.forecast_arima(fit, SPEC, 3).collect()} == {round(float(y[-1]), 6)}


def test_order_search_reaches_long_lags(spark):
    """An AR(4) is found, and innovations of a season longer than 12 periods are free of the season."""
    rng = np.random.default_rng(4)
    y, z = rng.normal(size=500), rng.normal(size=900)
    for i in range(4, 500):
        y[i] += 0.7 * y[i - 4]
    for i in range(24, 900):
        z[i] += 0.85 * z[i - 24]
    row = ar.fit_arima(frame(spark, {"a": y, "short": y[:9]}), SPEC.with_(period=1), "y", ar.grid_orders(), m=1).where("key = 'a'").first()
    assert dict(zip(row.terms, row.beta))["ar4"] == pytest.approx(0.7, abs=0.15)
    row = ar.fit_arima(frame(spark, {"a": z}), SPEC.with_(period=24), "y", [ar.Order(0, 0)], m=24).first()
    assert np.std(row.e_tail) < 1.35


def test_pooled_keeps_every_series(spark):
    df = frame(spark, {"zero": [0.0] * 12, "around": [1.0, -1.0] * 8, "short": [3.0, 4.0], "long": list(noisy(40))})
    model, base, asm = ar.fit_pooled(df, SPEC, "y", [1, 4])
    out = ar.forecast_pooled(model, base, asm, SPEC, [1, 4], 2).collect()
    assert {r.key for r in out} == {"zero", "around", "short", "long"} and all(r["mean"] is not None for r in out)


def test_chi_square_tails(spark):
    cases = [(x, k) for k in (1, 2, 9, 10, 200, 1500) for x in (0.01, 0.5 * k, k + 2.0, 2.0 * k, 4.0 * k)]
    got = spark.range(1).select(*[chi2_tail(F.lit(x) + 0 * F.col("id"), k).alias(f"c{i}") for i, (x, k) in enumerate(cases)]).first()
    for value, (x, k) in zip(got, cases):
        if k % 2 == 0:  # closed form
            want = math.fsum(math.exp(j * math.log(x / 2) - x / 2 - math.lgamma(j + 1)) for j in range(k // 2))
            assert value == pytest.approx(want, rel=1e-8, abs=1e-12), (x, k)
        elif k == 1:
            assert value == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-10)
    far = spark.range(1).select(chi2_tail(F.lit(500.0), 200), normal_cdf(F.lit(-7.0)), normal_cdf(F.lit(0.5))).first()
    assert far[0] == pytest.approx(1.2e-27, rel=0.05)
    assert far[1] == pytest.approx(0.5 * math.erfc(7 / math.sqrt(2)), abs=1e-14) and far[2] == pytest.approx(0.6914624612740131)


def test_wide_sums_with_many_interleaved_keys(spark):
    df = spark.range(30_000).select((F.col("id") % 10_000).alias("key"), F.array(F.lit(1.0), F.col("id") % 7 * 1.0, F.col("id") % 3 * 1.0).alias("x"))
    out = linalg.gram_arrays(df.repartition(4), ["key"], "x", 2, 1)
    assert out.count() == 10_000 and {r.n for r in out.select("n").distinct().collect()} == {3}
    row = out.where("key = 12").first()
    x = np.array([[1.0, i % 7, i % 3] for i in (12, 10_012, 20_012)])
    assert np.allclose(np.array(row.g).reshape(3, 3), x.T @ x)
