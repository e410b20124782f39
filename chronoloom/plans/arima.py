"""ARIMA, vector and pooled non-linear autoregressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.models import arima as ar
from chronoloom.models import arima_state as fitted
from chronoloom.operators import decompose as dc
from chronoloom.operators import stats as st
from chronoloom.operators.blocks import cut_lineage
from chronoloom.operators.index import fill_gaps
from chronoloom.plans.arima_sql import arma11_ctes, gap_sql, innovation_ctes
from chronoloom.plans.base import EH, LAST_DAY, OM, events_hourly, orders_monthly, part_attrs, split
from chronoloom.plans.catalog import query
from chronoloom.plans.features import acf_cte, chi2_sql

_COLS = ("priority", "order", "terms", "beta", "d", "big_d", "sigma2", "loglik", "aic", "aicc", "bic", "root")


@query("arima")
def arima(spark, d):
    """Fixed orders: (2,1,0) and the seasonal (0,1,1)(0,1,1)."""
    df, spec = orders_monthly(spark, d)
    a = ar.fit_arima(df, spec, "y", [ar.Order(2, 0, constant=False)], d=1).select(*_COLS)
    b = ar.fit_arima(df, spec, "y", [ar.Order(0, 1, 0, 1, constant=False)], d=1, big_d=1).select(*_COLS)
    return a.unionByName(b)


def auto(df, spec):
    """Differences by the tests, orders by an exhaustive AICc search."""
    strength = dc.nsdiffs(dc.strengths(cut_lineage(dc.stl(df, spec, "y", s_window="periodic")), spec), spec)
    d = st.ndiffs(df, spec, "y").join(strength, spec.by).select(*spec.by, F.col("ndiffs").alias("d"), F.col("nsdiffs").alias("big_d"))
    return ar.fit_arima(df, spec, "y", ar.grid_orders(), d=cut_lineage(d))


@query("arima_auto")
def arima_auto(spark, d):
    df, spec = orders_monthly(spark, d)
    return auto(df, spec).select(*_COLS)


@query("arima_forecast")
def arima_forecast(spark, d):
    df, spec = orders_monthly(spark, d)
    fit = ar.fit_arima(df, spec, "y", ar.grid_orders(), d=1)
    return ar.forecast_arima(fit, spec, 12).drop("t")


LONG = 6  # lags of the long autoregression of the fits that are checked in SQL


def arma11(df, spec):
    return ar.fit_arima(df, spec, "y", [ar.Order(1, 1, constant=False)], d=1, long_order=LONG)


_FIT11 = "WITH RECURSIVE " + OM + ",\n" + arma11_ctes("om", LONG)
_RES11 = _FIT11 + ",\n" + innovation_ctes("om")


@query("arima_augment", _RES11 + "\nSELECT priority, month, y, y - e AS fitted, e AS resid FROM ar_e")
def arima_augment(spark, d):
    """One-step fitted values and innovations of ARIMA(1,1,1)."""
    df, spec = orders_monthly(spark, d)
    return fitted.augment_arima(df, spec, "y", arma11(df, spec)).drop("t")


@query("arima_ljung_box", _RES11 + ",\nre AS (SELECT priority, t, e FROM ar_e WHERE e IS NOT NULL),\n" + acf_cte("ac", "re", "priority", "e", 10) + f"""
SELECT priority, stat, greatest(0, {chi2_sql('stat', 8)}) AS pvalue FROM (
  SELECT priority, sum(n * (n + 2) * acf * acf / (n - lag)) AS stat FROM ac GROUP BY priority)""")
def arima_ljung_box(spark, d):
    """White-noise test of the innovations, two coefficients taken off."""
    df, spec = orders_monthly(spark, d)
    res = fitted.augment_arima(df, spec, "y", arma11(df, spec)).where("resid IS NOT NULL")
    return st.portmanteau(st.acf(res, spec, "resid", 10), spec, 10, 2)


@query("arima_refit", "WITH RECURSIVE " + OM + f",\ntr AS (SELECT * FROM om WHERE month < DATE '{LAST_DAY}'),\n" + arma11_ctes("tr", LONG) + ",\n"
       + innovation_ctes("om") + f"""
SELECT priority, CAST(n AS BIGINT) AS n, sigma2, rmse, mae, next AS mean FROM
  (SELECT priority, count(e) AS n, avg(e * e) AS sigma2, sqrt(avg(e * e) FILTER (month >= DATE '{LAST_DAY}')) AS rmse,
     avg(abs(e)) FILTER (month >= DATE '{LAST_DAY}') AS mae, max_by(y + phi * w + theta * e, t) AS next FROM ar_e JOIN ar_f USING (priority) GROUP BY priority)""")
def arima_refit(spark, d):
    """Coefficients from training, innovations over all rows: errors of the test rows, and the next month's forecast."""
    df, spec = orders_monthly(spark, d)
    train, _ = split(df)
    fit = arma11(train, spec)
    again = fitted.refit_arima(df, spec, "y", fit)
    e = F.when(F.col("month") >= F.lit(LAST_DAY).cast("date"), F.col("resid"))
    scores = fitted.augment_arima(df, spec, "y", fit).groupBy("priority").agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"))
    ahead = ar.forecast_arima(again, spec, 1).select("priority", "mean")
    return again.select("priority", "n", "sigma2").join(scores, "priority").join(ahead, "priority")


@query("arima_fitted_h", _RES11 + """
SELECT priority, month, y, y3 + w3 * (phi + phi * phi + phi * phi * phi) + theta * coalesce(e3, 0) * (1 + phi + phi * phi) AS fitted FROM (
  SELECT priority, t, month, y, lag(y, 3) OVER p AS y3, lag(w, 3) OVER p AS w3, lag(e, 3) OVER p AS e3 FROM ar_e WINDOW p AS (PARTITION BY priority ORDER BY t))
JOIN ar_f USING (priority)""")
def arima_fitted_h(spark, d):
    """Fitted values three steps ahead of ARIMA(1,1,1)."""
    df, spec = orders_monthly(spark, d)
    return fitted.fitted_h(df, spec, "y", arma11(df, spec), 3).drop("t")


@query("arima_tidy", _FIT11 + """
SELECT priority, 'arima' AS model, term, estimate, std_error, estimate / std_error AS statistic FROM (
  SELECT priority, unnest(['ar1', 'ma1']) AS term, unnest([phi, theta]) AS estimate, unnest([sqrt(sbb / det * s2), sqrt(saa / det * s2)]) AS std_error FROM ar_f)""")
def arima_tidy(spark, d):
    df, spec = orders_monthly(spark, d)
    return fitted.tidy_arima(arma11(df, spec), spec)


@query("arima_roots", _FIT11 + """
SELECT priority, 'arima' AS model, kind, CAST(1 AS INTEGER) AS number, re, 0.0::DOUBLE AS im, abs(re) AS size FROM (
  SELECT priority, unnest(['ar', 'ma']) AS kind, unnest([phi, -theta]) AS re FROM ar_f)""")
def arima_roots(spark, d):
    """Inverse roots of the autoregressive and the moving-average part."""
    df, spec = orders_monthly(spark, d)
    return fitted.roots_arima(arma11(df, spec), spec)


@query("arima_glance", _FIT11 + """
SELECT priority, 'arima' AS model, '(1,1)(0,0)' AS "order", CAST(1 AS INTEGER) AS d, CAST(0 AS INTEGER) AS big_d, n, s2 AS sigma2,
  -0.5 * n * (ln(2 * pi() * sse / n) + 1) AS loglik, n * ln(sse / n) + 6 AS aic, n * ln(sse / n) + 6 + 24.0 / (n - 4) AS aicc,
  n * ln(sse / n) + 6 + 3 * (ln(n) - 2) AS bic, greatest(abs(phi), abs(theta)) AS largest_inverse_root FROM ar_f""")
def arima_glance(spark, d):
    df, spec = orders_monthly(spark, d)
    return fitted.glance_arima(arma11(df, spec), spec)


@query("interpolate_arima", "WITH RECURSIVE " + EH + ",\n" + gap_sql("eh", "event_type", "hour"))
def interpolate_arima(spark, d):
    """Missing hours by ARIMA(1,1,0): forecasts from both edges of a gap, weighted by their precisions."""
    df, spec = events_hourly(spark, d)
    fit = ar.fit_arima(df, spec, "y", [ar.Order(1, 0, constant=False)], d=1, long_order=2)
    return fitted.interpolate_arima(df, spec, "y", fit).select("event_type", "hour", "filled")


@query("var")
def var(spark, d):
    df, spec = part_attrs(spark, d)
    df, spec = fill_gaps(df, spec, {"qty": 0.0, "price": 0.0})
    bic = ar.fit_var(df, spec, ["qty", "price"], ic="bic").withColumn("ic", F.lit("bic"))
    return bic.unionByName(ar.fit_var(df, spec, ["qty", "price"], ic="aicc").withColumn("ic", F.lit("aicc")))


@query("nnetar")
def nnetar(spark, d):
    df, spec = orders_monthly(spark, d)
    lags = [1, 2, 12]
    model, base, asm = ar.fit_pooled(df, spec, "y", lags)
    return ar.forecast_pooled(model, base, asm, spec, lags, 6).drop("t")
