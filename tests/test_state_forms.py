"""Components and paths from state forms."""
import numpy as np
import pytest
from helpers import SPEC, frame, noisy
from pyspark.sql import functions as F
from test_arima_state import ahead, columns, fits, series

from chronoloom.models import ets_components as ec, paths as pt, smoothing as sm
from chronoloom.models.arima import forecast_arima
from chronoloom.models.simple import fit_simple, forecast_simple


@pytest.mark.parametrize("block", [7, None])
def test_components_of_mixed_forms(spark, block):
    own = {k: noisy(50 + i, seed=i) for i, k in enumerate("abcd")}
    df = frame(spark, own)
    forms = {"a": sm.Ets("A", "A", "A"), "b": sm.Ets("M", "A", "M"), "c": sm.Ets("A", "N", "N"), "d": sm.Ets("M", "Ad", "N")}
    fit = None
    for k, s in forms.items():
        one = sm.fit_ets(df.where(F.col("key") == k), SPEC, "y", [s]).select("key", "model", "params", "start", "state")
        fit = one if fit is None else fit.unionByName(one)
    fit = fit.cache()
    got = columns(ec.components(df, SPEC, "y", fit, block), "level", "slope", "season", "remainder")
    for r in fit.collect():
        s, v, c = forms[r.key], own[r.key], got[r.key]
        end, mu = sm.run(v, np.array([r.params]), np.array([r.start]), s, 4, True)
        e = (v - mu) / mu if s.error == "M" else v - mu
        assert np.allclose(c[:, 3], e) and np.allclose(c[-1, :2], end[0, :2])
        if s.season != "N":
            assert np.allclose(c[-4:, 2], end[0, 4:])
        assert np.allclose(end[0], r.state)


def test_components_edges(spark):
    fit = spark.createDataFrame([("a", "ETS(A,N,N)", [0.5, 0.0, 0.0, 1.0], [1.0, 0.0, 0.0, 0.0, 0.0])], "key string, model string, params array<double>, start array<double>")
    got = columns(ec.components(frame(spark, {"a": [1.0, None, 3.0]}), SPEC, "y", fit), "level", "remainder")["a"]
    assert np.allclose(got[:, 0], [1.0, 1.0, 2.0]) and np.isnan(got[1, 1])
    assert ec.components(frame(spark, {"a": [1.0]}).limit(0), SPEC, "y", fit).count() == 0
    assert ec.components(frame(spark, {"a": [1.0]}), SPEC, "y", fit.limit(0)).count() == 0


def test_paths_without_shocks_are_forecasts(spark):
    own = series()
    df, fit = frame(spark, own), fits(spark).withColumn("t_last", F.lit(0))
    ends = df.groupBy("key").agg(F.max("t").alias("t_last"))
    fit = fit.drop("t_last").join(ends, "key").withColumn("sigma2", F.lit(0.0))
    forms = pt.arima_form(df, SPEC, "y", fit).unionByName(pt.ets_form(_ets(spark, df), SPEC))
    out = {}
    for r in pt.paths(forms, SPEC, 2, 5, 1).orderBy("h").collect():
        out.setdefault((r.key, r.model, r.rep), []).append(r.sim)
    for k, v in own.items():
        assert np.allclose(out[k, "arima", 1], out[k, "arima", 2])
        assert np.allclose(out[k, "arima", 1], ahead(v, k, 5))
    want = {}
    for r in sm.forecast_ets(_ets(spark, df), SPEC, 5).orderBy("h").collect():
        want.setdefault(r.key, []).append(r["mean"])
    assert all(np.allclose(out[k, "ets", 1], w) for k, w in want.items())


def _ets(spark, df):
    return sm.fit_ets(df, SPEC, "y", [sm.Ets("A", "Ad", "A")]).withColumn("sigma2", F.lit(0.0))


def test_models_of_a_key_share_shocks_and_seasons_add(spark):
    df = frame(spark, {"a": noisy(40), "b": noisy(30, seed=3)})
    walk = df.groupBy("key").agg(F.max("t").alias("t_last"), F.max_by("y", "t").alias("y")).select(
        "key", "t_last", F.array(*map(F.lit, (1.0, 0.0, 0.0, 1.0))).alias("params"), F.array("y", *map(F.lit, (0.0, 0.0, 0.0, 0.0))).alias("state"), F.lit(4.0).alias("sigma2"))
    form = pt.ets_form(walk, SPEC, "walk")
    cycle = df.select("key").distinct().withColumn("cycle", F.array(*map(F.lit, (1.0, 2.0, 3.0, 4.0))))
    sims = pt.paths(form.unionByName(pt.with_season(form, SPEC, cycle, "season")), SPEC, 400, 12, 9).cache()
    assert sims.agg(F.max("h")).first()[0] == 12
    p = sims.groupBy("key", "rep", "h").pivot("model").agg(F.first("sim")).toPandas()
    assert np.allclose(p.season - p.walk, (p.h - 1) % 4 + 1)
    spread = p.groupby(["key", "h"]).walk.std()
    assert np.allclose(spread["a"].loc[[1, 4, 9]], [2, 4, 6], rtol=0.15)
    both = pt.combine(sims, SPEC)
    assert both.count() == 2 * 400 * 12


def test_horizons(spark):
    fit = fit_simple(frame(spark, {"a": noisy(20)}), SPEC, "y", {"naive": "naive"})
    spec = SPEC.with_(unit="quarter", index="idx")
    assert forecast_simple(fit, spec, "2 years").count() == 8 and forecast_simple(fit, spec).count() == 8 and forecast_simple(fit, spec, 3).count() == 3
    assert forecast_arima(fits(spark).limit(0).withColumns({"t_last": F.lit(1), "w_tail": F.array(F.lit(1.0)), "e_tail": F.array(F.lit(1.0)), "y_tail": F.array(F.lit(1.0))}), spec).count() == 0


def test_decomposition_forecasts_compose(spark):
    """Two seasons and smoothing: means add up, and so do the variances that are asked for."""
    from chronoloom.models.decomposition import decomposition_forecast, plain, seasonal, smoothing
    n = np.arange(48)
    df = frame(spark, {"a": noisy(48), "b": noisy(48, seed=2)}).withColumns({
        "s4": F.element_at(F.array(*map(F.lit, (1.0, 2.0, 3.0, -6.0))), F.pmod("t", F.lit(4)).cast("int") + 1),
        "s6": F.element_at(F.array(*map(F.lit, (0.5, 0.1, 0.0, -0.1, -0.2, -0.3))), F.pmod("t", F.lit(6)).cast("int") + 1)})
    df = df.withColumn("adj", F.col("y") - F.col("s4") - F.col("s6")).cache()
    specs = [sm.Ets(), sm.Ets("A", "A")]
    out = {(r.key, r.h): r for r in decomposition_forecast(df, SPEC, 12, {"adj": smoothing(*specs), "s4": seasonal(4), "s6": seasonal(6)}).collect()}
    own = {(r.key, r.h): r for r in sm.forecast_ets(sm.fit_ets(df, SPEC, "adj", specs, m=1), SPEC, 12).collect()}
    last = {(r.key, r.t): (r.s4, r.s6) for r in df.collect()}
    assert len(out) == 24
    for (k, h), r in out.items():
        want = own[k, h]["mean"] + last[k, 48 - 3 + (h - 1) % 4][0] + last[k, 48 - 5 + (h - 1) % 6][1]
        assert np.isclose(r["mean"], want) and np.isclose(r.sigma, own[k, h].sigma)
    wide = decomposition_forecast(df, SPEC, 3, {"adj": plain("naive"), "y": seasonal(4)}, season_sigma=True).where("h = 1 AND key = 'a'").first()
    one = {m: forecast_simple(fit_simple(df, SPEC, c, {m: m}), SPEC, 1).where("key = 'a'").first().sigma for m, c in (("naive", "adj"), ("snaive", "y"))}
    assert np.isclose(wide.sigma ** 2, one["naive"] ** 2 + one["snaive"] ** 2)
    assert decomposition_forecast(df.limit(0), SPEC, 3, {"adj": plain("naive")}).count() == 0
