"""Regressions and what is read from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.functions import transforms as tr
from chronoloom.models import regression as rg
from chronoloom.operators.forecast import back_transform
from chronoloom.operators.index import fill_gaps, index_by, new_data, scenarios
from chronoloom.plans.base import OM, PA, cents, events_hourly, orders_monthly, part_attrs, with_ctes
from chronoloom.plans.catalog import query
from chronoloom.plans.linear_sql import ols_ctes, tidy_sql
from chronoloom.series import to_series
from chronoloom.sources.tables import read_table

_TREND = OM + ",\nti AS (SELECT *, CAST(t - min(t) OVER (PARTITION BY priority) + 1 AS DOUBLE) AS i FROM om)"


# terms and their SQL, in the order of the design
_TREND_X = {"trend": "i"}
_KNOTS_X = {f"knot{k}": f"greatest(i - {k}, 0)" for k in (20, 50)}
_SEASON_X = {f"season{j + 1}": f"CAST(t % 12 = {j} AS INTEGER)" for j in range(1, 12)}


def _fourier_x(k):
    out = {}
    for j in range(1, k + 1):
        out[f"C{j}_12"] = f"cos(2 * pi() * {j} * i / 12)"
        if j != 6:
            out[f"S{j}_12"] = f"sin(2 * pi() * {j} * i / 12)"
    return out


def recursive(*ctes, body):
    return with_ctes(*ctes, body=body).replace("WITH ", "WITH RECURSIVE ", 1)


def _tidy_query(xs):
    return recursive(_TREND, ols_ctes("ols", "ti", "priority", list(xs.values()), "y"), body=tidy_sql("ols", "priority", list(xs)))


def _monthly(spark, d):
    df, spec = orders_monthly(spark, d)
    return rg.with_trend(df, spec), spec


def _trend():
    return {"trend": F.col(rg.TREND)}


@query("tslm", with_ctes(_TREND, body="""SELECT priority, regr_intercept(y, i) AS b0, regr_slope(y, i) AS b1, regr_r2(y, i) AS r2,
  (regr_syy(y, i) - regr_slope(y, i) * regr_sxy(y, i)) / (count(*) - 2) AS sigma2 FROM ti GROUP BY priority"""))
def tslm(spark, d):
    df, spec = _monthly(spark, d)
    fit = rg.tslm(df, spec, "y", _trend())
    return fit.select("priority", F.col("beta")[0].alias("b0"), F.col("beta")[1].alias("b1"), "r2", "sigma2")


@query("lm", with_ctes(PA, body="SELECT brand, regr_intercept(price, qty) AS b0, regr_slope(price, qty) AS b1, regr_r2(price, qty) AS r2 FROM pa GROUP BY brand"))
def lm(spark, d):
    df, spec = part_attrs(spark, d)
    fit = rg.tslm(df, spec, "price", {"qty": F.col("qty")}, "lm")
    return fit.select("brand", F.col("beta")[0].alias("b0"), F.col("beta")[1].alias("b1"), "r2")


@query("season_dummies", with_ctes(OM, """sm AS (SELECT priority, t % 12 AS s, avg(y) AS m FROM om GROUP BY ALL)""",
    body="""SELECT a.priority, CASE WHEN a.s = 0 THEN 'intercept' ELSE 'season' || (a.s + 1) END AS term,
  CASE WHEN a.s = 0 THEN a.m ELSE a.m - b.m END AS estimate FROM sm a JOIN sm b ON a.priority = b.priority AND b.s = 0"""))
def season_dummies(spark, d):
    df, spec = _monthly(spark, d)
    fit = rg.tslm(df, spec, "y", rg.season_dummies(spec))
    return rg.tidy(fit, spec.by).select("priority", "term", "estimate")


@query("fourier_terms", with_ctes(_TREND, body="SELECT priority, month, " + ", ".join(
    f"round(cos(2 * pi() * {k} * i / 12), 9) + 0.0 AS c{k}, round(sin(2 * pi() * {k} * i / 12), 9) + 0.0 AS s{k}" for k in (1, 2)) + " FROM ti"))
def fourier_terms(spark, d):
    df, spec = _monthly(spark, d)
    terms = rg.fourier_terms(2, 12)
    return df.select("priority", "month", *[(F.round(c, 9) + 0.0).alias(n.split("_")[0].lower()) for n, c in terms.items()])


@query("knots", with_ctes(_TREND, body="SELECT priority, month, i AS trend, greatest(i - 20, 0) AS knot20, greatest(i - 50, 0) AS knot50 FROM ti"))
def knots(spark, d):
    df, spec = _monthly(spark, d)
    return df.select("priority", "month", "trend", *[c.alias(n) for n, c in rg.knots([20, 50]).items()])


@query("tslm_piecewise", _tidy_query({**_TREND_X, **_KNOTS_X}))
def tslm_piecewise(spark, d):
    df, spec = _monthly(spark, d)
    return rg.tidy(rg.tslm(df, spec, "y", {**_trend(), **rg.knots([20, 50])}), spec.by)


@query("tslm_fourier", _tidy_query({**_TREND_X, **_fourier_x(6)}))
def tslm_fourier(spark, d):
    df, spec = _monthly(spark, d)
    return rg.tidy(rg.tslm(df, spec, "y", {**_trend(), **rg.fourier_terms(6, 12)}), spec.by)


@query("report", _tidy_query({**_TREND_X, **_SEASON_X}))
def report(spark, d):
    df, spec = _monthly(spark, d)
    return rg.tidy(rg.tslm(df, spec, "y", {**_trend(), **rg.season_dummies(spec)}), spec.by)


@query("tidy", with_ctes(_TREND, body="""SELECT priority, 'trend' AS term, regr_slope(y, i) AS estimate,
  sqrt((regr_syy(y, i) - regr_slope(y, i) * regr_sxy(y, i)) / (count(*) - 2) / regr_sxx(y, i)) AS std_error FROM ti GROUP BY priority"""))
def tidy(spark, d):
    df, spec = _monthly(spark, d)
    return rg.tidy(rg.tslm(df, spec, "y", _trend()), spec.by).where("term = 'trend'").select("priority", "term", "estimate", "std_error")


@query("glance", with_ctes(_TREND, """ft AS (SELECT priority, count(*) AS n, regr_slope(y, i) AS b, regr_intercept(y, i) AS a, regr_sxx(y, i) AS sxx, avg(i) AS mi,
   regr_syy(y, i) - regr_slope(y, i) * regr_sxy(y, i) AS sse, regr_r2(y, i) AS r2 FROM ti GROUP BY priority),
cv AS (SELECT priority, avg(pow((y - a - b * i) / (1 - 1.0 / n - (i - mi) * (i - mi) / sxx), 2)) AS cv FROM ti JOIN ft USING (priority) GROUP BY 1)""",
    body="""SELECT priority, 1 - (1 - r2) * (n - 1) / (n - 2) AS adj_r2, sse / (n - 2) AS sigma2, cv, n * ln(sse / n) + 6 AS aic,
  n * ln(sse / n) + 6 + 24 / (n - 4)::DOUBLE AS aicc, n * ln(sse / n) + 6 + 3 * (ln(n) - 2) AS bic FROM ft JOIN cv USING (priority)"""))
def glance(spark, d):
    df, spec = _monthly(spark, d)
    fit = rg.tslm(df, spec, "y", _trend())
    out = rg.glance(fit, rg.augment(df, spec, "y", _trend(), fit), spec.by)
    return out.select("priority", "adj_r2", "sigma2", "cv", "aic", "aicc", "bic")


_CHOICES = {"trend": _TREND_X, "trend_season": {**_TREND_X, **_SEASON_X}, "harmonic": {**_TREND_X, **_fourier_x(2)}}


def _aicc_sql(name, xs):
    k = len(xs) + 2
    return f"SELECT priority, '{name}' AS model, n * ln(sse / n) + 2 * {k} + 2.0 * {k} * {k + 1} / (n - {k} - 1) AS aicc FROM ols_{name}"


@query("select_model", recursive(_TREND, *[ols_ctes(f"ols_{n}", "ti", "priority", list(xs.values()), "y") for n, xs in _CHOICES.items()],
                                 "al AS (" + " UNION ALL ".join(_aicc_sql(n, xs) for n, xs in _CHOICES.items()) + ")",
                                 body="SELECT priority, min_by(model, aicc) AS model, min(aicc) AS aicc FROM al GROUP BY priority"))
def select_model(spark, d):
    """Lowest AICc of three specifications for every series."""
    df, spec = _monthly(spark, d)
    specs = {"trend": _trend(), "trend_season": {**_trend(), **rg.season_dummies(spec)},
             "harmonic": {**_trend(), **rg.fourier_terms(2, 12)}}
    out = None
    for name, terms in specs.items():
        part = rg.tslm(df, spec, "y", terms, name).select(*spec.by, "model", "aicc")
        out = part if out is None else out.unionByName(part)
    return out.groupBy(*spec.by).agg(F.min_by("model", "aicc").alias("model"), F.min("aicc").alias("aicc"))


@query("tslm_forecast", with_ctes(_TREND, """ft AS (SELECT priority, count(*) AS n, regr_slope(y, i) AS b, regr_intercept(y, i) AS a, regr_sxx(y, i) AS sxx, avg(i) AS mi,
   regr_syy(y, i) - regr_slope(y, i) * regr_sxy(y, i) AS sse, max(i) AS il, max(t) AS tl FROM ti GROUP BY priority)""",
    body="""SELECT priority, make_date((tl + h) // 12, (tl + h) % 12 + 1, 1) AS month, a + b * (il + h) AS mean,
  sqrt(sse / (n - 2) * (1 + 1.0 / n + (il + h - mi) * (il + h - mi) / sxx)) AS sigma FROM ft, (SELECT unnest(range(1, 13)) AS h)"""))
def tslm_forecast(spark, d):
    df, spec = _monthly(spark, d)
    fit = rg.tslm(df, spec, "y", _trend())
    future = rg.with_trend(new_data(df, spec, 12), spec, df)
    return rg.forecast_tslm(future, spec, _trend(), fit).select("priority", "month", "mean", "sigma")


@query("reg_transform", with_ctes(_TREND, """ft AS (SELECT priority, count(*) AS n, regr_slope(ln(y + 1), i) AS b, regr_intercept(ln(y + 1), i) AS a, regr_sxx(ln(y + 1), i) AS sxx,
   avg(i) AS mi, regr_syy(ln(y + 1), i) - regr_slope(ln(y + 1), i) * regr_sxy(ln(y + 1), i) AS sse, max(i) AS il, max(t) AS tl FROM ti GROUP BY priority),
fc AS (SELECT priority, tl + h AS t, a + b * (il + h) AS mu, sse / (n - 2) * (1 + 1.0 / n + (il + h - mi) * (il + h - mi) / sxx) AS s2 FROM ft, (SELECT unnest(range(1, 13)) AS h))""",
    body="SELECT priority, make_date(t // 12, t % 12 + 1, 1) AS month, exp(mu) * (1 + s2 / 2) AS mean, exp(mu) AS median FROM fc"))
def reg_transform(spark, d):
    df, spec = _monthly(spark, d)
    fit = rg.tslm(df, spec, tr.log.forward(F.col("y") + 1), _trend())
    future = rg.with_trend(new_data(df, spec, 12), spec, df)
    return back_transform(rg.forecast_tslm(future, spec, _trend(), fit), tr.log).select("priority", "month", "mean", "median")


@query("scenario_forecast", recursive(PA, ols_ctes("ols", "pa", "brand", ["qty", "discount"], "price"),
    """me AS (SELECT brand, avg(qty) AS mq, avg(discount) AS md, max(t) AS tl FROM pa GROUP BY brand),
fu AS (SELECT brand, scenario, tl + h AS t, [1.0::DOUBLE, mq * f, md] AS x FROM me, (SELECT unnest(range(1, 5)) AS h), (VALUES ('Increase', 1.1::DOUBLE), ('Decrease', 0.9::DOUBLE)) v(scenario, f))""",
    body="""SELECT brand, scenario, 'tslm' AS model, make_date(t // 4, t % 4 * 3 + 1, 1) AS quarter, list_dot_product(x, beta) AS mean,
  sqrt(sse / (n - 3) * (1 + list_sum([x[i] * list_dot_product(inv[i], x) FOR i IN [1, 2, 3]]))) AS sigma FROM fu JOIN ols USING (brand)"""))
def scenario_forecast(spark, d):
    df, spec = part_attrs(spark, d)
    terms = {"qty": F.col("qty"), "discount": F.col("discount")}
    fit = rg.tslm(df, spec, "price", terms)
    means = df.groupBy("brand").agg(F.avg("qty").alias("mq"), F.avg("discount").alias("md"))
    future = new_data(df, spec, 4).join(means, "brand")
    cases = scenarios(future, {"Increase": {"qty": F.col("mq") * 1.1, "discount": F.col("md")},
                               "Decrease": {"qty": F.col("mq") * 0.9, "discount": F.col("md")}})
    return rg.forecast_tslm(cases, spec, terms, fit, extra=["scenario"]).drop("t")


@query("lagged_predictors", recursive(PA, """pf AS (SELECT brand, unnest(range(min(t), max(t) + 1)) AS t FROM pa GROUP BY brand),
pl AS (SELECT brand, t, qty, price, lag(qty) OVER w AS qty1, lag(qty, 2) OVER w AS qty2 FROM pf LEFT JOIN pa USING (brand, t) WINDOW w AS (PARTITION BY brand ORDER BY t))""",
    ols_ctes("ols", "pl", "brand", ["qty", "qty1", "qty2"], "price"), body=tidy_sql("ols", "brand", ["qty", "qty1", "qty2"])))
def lagged_predictors(spark, d):
    from chronoloom.operators.blocks import lag_columns
    df, spec = part_attrs(spark, d)
    df, spec = fill_gaps(df, spec)
    lagged = lag_columns(df, spec, {"qty1": ("qty", 1), "qty2": ("qty", 2)})
    fit = rg.tslm(lagged, spec, "price", {c: F.col(c) for c in ("qty", "qty1", "qty2")})
    return rg.tidy(fit, spec.by)


# ---- regression with autoregressive errors ------------------------------

def _hourly_terms():
    weekend = (F.weekday("hour") >= 5).cast("double")
    return {"weekend": weekend, **rg.fourier_terms(3, 24)}


def _hourly(spark, d):
    df, spec = events_hourly(spark, d)
    return rg.with_trend(df.withColumn("y", F.col("n").cast("double")), spec), spec


@query("arimax")
def arimax(spark, d):
    df, spec = _hourly(spark, d)
    fit = rg.arimax(df, spec, "y", _hourly_terms())
    return fit.select("event_type", "model", "ar_order", "phi", "beta", "sigma2", "aicc")


@query("error_kinds")
def error_kinds(spark, d):
    df, spec = _hourly(spark, d)
    fit = rg.arimax(df, spec, "y", _hourly_terms())
    return rg.error_kinds(df, spec, "y", _hourly_terms(), fit).select("event_type", "hour", "regression", "innovation")


@query("arimax_forecast")
def arimax_forecast(spark, d):
    df, spec = _hourly(spark, d)
    fit = rg.arimax(df, spec, "y", _hourly_terms()).persist()
    resid = rg.error_kinds(df, spec, "y", _hourly_terms(), fit)
    future = rg.with_trend(new_data(df, spec, 48), spec, df)
    return rg.forecast_arimax(future, resid, spec, _hourly_terms(), fit, 48).drop("t")


def events_minutely(spark, d):
    """All events per minute: one long series."""
    e = read_table(spark, d, "events").select("ts", "value")
    m = index_by(e.withColumn("series", F.lit("all")), ["series"], "ts", "minute",
                 [F.count("*").alias("n"), (F.sum(cents("value")) / 1e2).alias("value")], "minute")
    df, spec = to_series(m, ["series"], "minute", "minute", check=False)
    df, spec = fill_gaps(df, spec, {"n": 0, "value": 0.0})
    return rg.with_trend(df.withColumn("y", F.log1p(F.col("value"))), spec), spec


def minutely_terms():
    """Day K=10, week K=5, 30 days K=3 and three regressors."""
    hour = F.hour("minute")
    extra = {"weekend": (F.weekday("minute") >= 5).cast("double"), "daytime": hour.between(8, 19).cast("double"),
             "n": F.col("n").cast("double")}
    return {**extra, **rg.fourier_terms(10, 1440), **rg.fourier_terms(5, 7 * 1440), **rg.fourier_terms(3, 30.5 * 1440)}


@query("dynamic_harmonic_regression")
def dynamic_harmonic_regression(spark, d):
    df, spec = events_minutely(spark, d)
    fit = rg.arimax(df, spec, "y", minutely_terms())
    return rg.tidy(fit, spec.by).select("series", "term", "estimate", "std_error")
