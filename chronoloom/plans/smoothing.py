"""Exponential smoothing, intermittent demand, and uses of fitted states."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.models import ets_components as parts
from chronoloom.models import smoothing as sm
from chronoloom.operators.crossval import summarise_errors
from chronoloom.operators.index import stretch
from chronoloom.plans.base import LAST_DAY, OM, UD, orders_monthly, split, user_daily, with_ctes
from chronoloom.plans.catalog import query

ALPHAS = [round(0.1 * i, 1) for i in range(1, 10)]
HOLT = [(a, b, 1.0) for a in (0.1, 0.3, 0.5, 0.7, 0.9) for b in (0.05, 0.1, 0.2)]
DAMPED = [(a, b, p) for a in (0.1, 0.5, 0.9) for b in (0.05, 0.2) for p in (0.8, 0.9, 0.98)]


def ses_sql(src, last=True):
    return f"""i AS (SELECT *, row_number() OVER (PARTITION BY priority ORDER BY t) AS i, count(*) OVER (PARTITION BY priority) AS n FROM {src}),
r AS (SELECT priority, a, CAST(0 AS BIGINT) AS i, n, y AS l, 0.0::DOUBLE AS sse FROM i, (SELECT unnest({ALPHAS}::DOUBLE[]) AS a) WHERE i = 1
  UNION ALL SELECT r.priority, a, i.i, r.n, l + a * (y - l), sse + (y - l) * (y - l) FROM r JOIN i ON r.priority = i.priority AND i.i = r.i + 1),
b AS (SELECT priority, arg_min({{'a': a, 'l': l, 'sse': sse}}, sse) AS b FROM r WHERE i = n GROUP BY priority)"""


@query("ses", "WITH RECURSIVE " + OM + ",\n" + ses_sql("om") + "\nSELECT priority, b.a AS alpha, b.l AS level, b.sse AS sse FROM b")
def ses(spark, d):
    df, spec = orders_monthly(spark, d)
    return sm.ses_grid(df, spec, "y", ALPHAS).select("priority", "alpha", "level", "sse")


def _holt_sql(cands):
    rows = ", ".join(f"({a}::DOUBLE, {b}::DOUBLE, {p}::DOUBLE)" for a, b, p in cands)
    return "WITH RECURSIVE " + OM + f""",
i AS (SELECT *, row_number() OVER (PARTITION BY priority ORDER BY t) AS i, count(*) OVER (PARTITION BY priority) AS n FROM om),
r AS (SELECT priority, ca, cb, cp, CAST(0 AS BIGINT) AS i, n, y AS l, 0.0::DOUBLE AS b, 0.0::DOUBLE AS sse FROM i, (VALUES {rows}) c(ca, cb, cp) WHERE i = 1
  UNION ALL SELECT r.priority, ca, cb, cp, i.i, r.n, l + cp * b + ca * (y - l - cp * b), cp * b + cb * (y - l - cp * b), sse + (y - l - cp * b) * (y - l - cp * b)
  FROM r JOIN i ON r.priority = i.priority AND i.i = r.i + 1),
g AS (SELECT priority, arg_min({{'a': ca, 'b': cb, 'p': cp, 'l': l, 's': b, 'sse': sse}}, sse) AS x FROM r WHERE i = n GROUP BY priority)
SELECT priority, x.a AS alpha, x.b AS beta, x.p AS phi, x.l AS level, x.s AS slope, x.sse AS sse FROM g"""


_TCOLS = ("priority", "alpha", "beta", "phi", "level", "slope", "sse")


@query("holt", _holt_sql(HOLT))
def holt(spark, d):
    df, spec = orders_monthly(spark, d)
    return sm.trend_grid(df, spec, "y", HOLT).select(*_TCOLS)


@query("damped_holt", _holt_sql(DAMPED))
def damped_holt(spark, d):
    df, spec = orders_monthly(spark, d)
    return sm.trend_grid(df, spec, "y", DAMPED).select(*_TCOLS)


_FIT = ("priority", "model", "params", "sigma2", "k", "aic", "aicc", "bic")


@query("holt_winters")
def holt_winters(spark, d):
    """Additive, multiplicative and damped seasonal forms side by side."""
    df, spec = orders_monthly(spark, d)
    out = None
    for s in (sm.Ets("A", "A", "A"), sm.Ets("M", "A", "M"), sm.Ets("M", "Ad", "M"), sm.Ets("M", "N", "A")):
        part = sm.fit_ets(df, spec, "y", [s]).select(*_FIT)
        out = part if out is None else out.unionByName(part)
    return out


@query("ets_auto")
def ets_auto(spark, d):
    df, spec = orders_monthly(spark, d)
    return sm.ets_auto(df, spec, "y").select(*_FIT)


@query("ets_forecast")
def ets_forecast(spark, d):
    df, spec = orders_monthly(spark, d)
    return sm.forecast_ets(sm.ets_auto(df, spec, "y"), spec, 12).drop("t")


@query("croston", "WITH RECURSIVE " + UD + """,
z AS (SELECT user_id, event_type, t, y, min(t) OVER (PARTITION BY user_id, event_type) - 1 AS o FROM ud),
nz AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY t) AS i, count(*) OVER (PARTITION BY user_id, event_type) AS n,
   CAST(t - coalesce(lag(t) OVER (PARTITION BY user_id, event_type ORDER BY t), o) AS DOUBLE) AS gap FROM z WHERE y <> 0),
r AS (SELECT user_id, event_type, i, n, y AS z, gap AS p FROM nz WHERE i = 1
  UNION ALL SELECT r.user_id, r.event_type, nz.i, r.n, z + 0.1::DOUBLE * (y - z), p + 0.1::DOUBLE * (gap - p) FROM r
  JOIN nz ON r.user_id = nz.user_id AND r.event_type = nz.event_type AND nz.i = r.i + 1)
SELECT user_id, event_type, z AS size, p AS gap, z / p AS mean FROM r WHERE i = n""")
def croston(spark, d):
    df, spec = user_daily(spark, d)
    return sm.croston(df, spec, "y")


_SES_PATH = f"""tr AS (SELECT * FROM om WHERE month < DATE '{LAST_DAY}')"""


@query("refit", "WITH RECURSIVE " + OM + ",\n" + _SES_PATH + ",\n" + ses_sql("tr") + f""",
te AS (SELECT *, row_number() OVER (PARTITION BY priority ORDER BY t) AS i FROM om WHERE month >= DATE '{LAST_DAY}'),
q AS (SELECT te.priority, te.i, te.y, b.b.a AS a, b.b.l AS f FROM te JOIN b USING (priority) WHERE te.i = 1
  UNION ALL SELECT q.priority, te.i, te.y, a, f + a * (q.y - f) FROM q JOIN te ON q.priority = te.priority AND te.i = q.i + 1)
SELECT priority, sqrt(avg((y - f) * (y - f))) AS rmse, avg(abs(y - f)) AS mae FROM q GROUP BY priority""")
def refit(spark, d):
    """Parameters from training, state carried over the test rows."""
    df, spec = orders_monthly(spark, d)
    train, test = split(df)
    fit = sm.ses_grid(train, spec, "y", ALPHAS)
    fit = fit.select("priority", F.array("alpha", F.lit(0.0), F.lit(0.0), F.lit(1.0)).alias("params"),
                     F.array("level", F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(0.0)).alias("start"))
    path = sm.ets_states(test, spec, "y", fit, sm.Ets())
    e = F.col("y") - F.col("fitted")
    return test.join(path, ["priority", "t"]).groupBy("priority").agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"))


@query("fitted")
def fitted(spark, d):
    df, spec = orders_monthly(spark, d)
    s = sm.Ets("A", "A", "A")
    fit = sm.fit_ets(df, spec, "y", [s])
    path = sm.ets_states(df, spec, "y", fit, s)
    return df.join(path, ["priority", "t"]).select("priority", "month", "y", "fitted", (F.col("y") - F.col("fitted")).alias("resid"))


@query("fitted_h", with_ctes(OM, body="""SELECT priority, month, y, CASE WHEN lag(t, 3) OVER w IS NOT NULL THEN lag(y, 3) OVER w + 3 * (lag(y, 3) OVER w - first_value(y) OVER w)
  / nullif(lag(i, 3) OVER w - 1, 0) END AS fitted FROM (SELECT *, row_number() OVER (PARTITION BY priority ORDER BY t) AS i FROM om) WINDOW w AS (PARTITION BY priority ORDER BY t)"""))
def fitted_h(spark, d):
    """Three-step fitted values of the drift model."""
    from chronoloom.operators.crossval import cross_validate
    df, spec = orders_monthly(spark, d)
    steps = cross_validate(df, spec, "y", init=1, h=3, models=("drift",)).where("h = 3")
    return df.join(steps.select("priority", "t", F.col("mean").alias("fitted")), ["priority", "t"], "left").select("priority", "month", "y", "fitted")


@query("backcast", with_ctes(OM, body="""SELECT priority, make_date((t0 - h) // 12, (t0 - h) % 12 + 1, 1) AS month, CAST(h AS INTEGER) AS h, y0 + h * (y0 - y1) / (n - 1) AS mean FROM (
  SELECT priority, min(t) AS t0, min_by(y, t) AS y0, max_by(y, t) AS y1, count(*) AS n FROM om GROUP BY 1), (SELECT unnest(range(1, 16)) AS h)"""))
def backcast(spark, d):
    """Reverse time, fit drift, forecast, map the steps back."""
    from chronoloom.models.simple import fit_simple, forecast_simple
    df, spec = orders_monthly(spark, d)
    back = df.select("priority", (-F.col("t")).alias("t"), "y")
    rspec = spec.with_(unit="int", index="t", period=1)
    fc = forecast_simple(fit_simple(back, rspec, "y", {"drift": "drift"}), rspec.with_(index="rt"), 15)
    return fc.select("priority", spec.index_expr(-F.col("t")).alias("month"), "h", "mean")


@query("cross_validate_ets")
def cross_validate_ets(spark, d):
    """One-step errors of three smoothing models on expanding folds."""
    df, spec = orders_monthly(spark, d)
    quarterly = df.groupBy("priority", F.trunc("month", "quarter").alias("quarter")).agg(F.sum("y").alias("y"))
    from chronoloom.series import to_series
    q, qspec = to_series(quarterly, ["priority"], "quarter", "quarter", check=False, gapless=True)
    folds = stretch(q, qspec, init=10).select("priority", "fold", "quarter", "t", "y")
    fspec = qspec.with_(keys=("priority", "fold"))
    out = None
    for name, s in (("ses", sm.Ets()), ("holt", sm.Ets("A", "A")), ("damped", sm.Ets("A", "Ad"))):
        fc = sm.forecast_ets(sm.fit_ets(folds, fspec, "y", [s], m=1), fspec, 1)
        e = fc.join(q.select("priority", "t", "y"), ["priority", "t"]).select(F.lit(name).alias("model"), "y", (F.col("y") - F.col("mean")).alias("error"))
        out = e if out is None else out.unionByName(e)
    return summarise_errors(out, ["model"])


@query("components_ets", _holt_sql(HOLT).rsplit("SELECT priority, x.a", 1)[0].rstrip() + """,
q AS (SELECT i.priority, i.i, i.t, i.month, i.y, x.a AS ca, x.b AS cb, y AS l, 0.0::DOUBLE AS b, 0.0::DOUBLE AS e FROM i JOIN g USING (priority) WHERE i.i = 1
  UNION ALL SELECT q.priority, i.i, i.t, i.month, i.y, ca, cb, l + b + ca * (i.y - l - b), b + cb * (i.y - l - b), i.y - l - b
  FROM q JOIN i ON i.priority = q.priority AND i.i = q.i + 1)
SELECT priority, month, y, l AS level, b AS slope, 0.0::DOUBLE AS season, e AS remainder FROM q""")
def components_ets(spark, d):
    """Level, slope and one-step error of Holt's method with the parameters of the grid."""
    df, spec = orders_monthly(spark, d)
    first = df.groupBy("priority").agg(F.min_by("y", "t").alias("y0"))
    zero = F.lit(0.0)
    fit = sm.trend_grid(df, spec, "y", HOLT).join(first, "priority").select(
        "priority", F.lit("ETS(A,A,N)").alias("model"), F.array("alpha", "beta", zero, F.lit(1.0)).alias("params"), F.array("y0", zero, zero, zero, zero).alias("start"))
    return parts.components(df, spec, "y", fit).drop("t")


@query("components_holt_winters", "WITH RECURSIVE " + OM + """,
i AS (SELECT *, row_number() OVER (PARTITION BY priority ORDER BY t) AS i, count(*) OVER (PARTITION BY priority) AS n FROM om),
hd AS (SELECT priority, y, (i - 1) // 12 AS c, (i - 1) % 12 AS j FROM i WHERE i <= 12 * least(n // 12, 5)),
mc AS (SELECT priority, c, avg(y) AS m FROM hd GROUP BY ALL),
sl AS (SELECT priority, max(c) AS c1, min_by(m, c) AS m0, (max_by(m, c) - min_by(m, c)) / (12 * max(c)) AS b FROM mc GROUP BY priority),
sj AS (SELECT hd.priority, j, avg(y - m - b * (j - 5.5)) AS s FROM hd JOIN mc USING (priority, c) JOIN sl ON sl.priority = hd.priority GROUP BY ALL),
st AS (SELECT priority, any_value(m0 - b * 6.5) AS l, any_value(b) AS b, list(s - a ORDER BY j) AS s FROM
  (SELECT *, avg(s) OVER (PARTITION BY priority) AS a FROM sj JOIN sl USING (priority)) GROUP BY priority),
r AS (SELECT priority, 0 AS i, NULL::DATE AS month, NULL::DOUBLE AS y, l, b, s, 0.0::DOUBLE AS e FROM st
  UNION ALL SELECT priority, i, month, y, mu - s1 + 0.3::DOUBLE * e, b + 0.05::DOUBLE * e, list_append(s[2:12], s1 + 0.2::DOUBLE * e), e FROM (
    SELECT r.priority, i.i, i.month, i.y, r.b, r.s, r.s[1] AS s1, r.l + r.b + r.s[1] AS mu, i.y - r.l - r.b - r.s[1] AS e FROM r JOIN i ON i.priority = r.priority AND i.i = r.i + 1))
SELECT priority, month, y, l AS level, b AS slope, s[12] AS season, e AS remainder FROM r WHERE i > 0""")
def components_holt_winters(spark, d):
    """Components of the additive seasonal form with given parameters."""
    df, spec = orders_monthly(spark, d)
    fit = parts.given_parameters(df, spec, "y", sm.Ets("A", "A", "A"), 0.3, 0.05, 0.2)
    return parts.components(df, spec, "y", fit).drop("t")


@query("forecast_horizon", with_ctes(OM, body="""SELECT f.priority, asked, h, f.month, model, CASE model WHEN 'naive' THEN y1 WHEN 'drift' THEN y1 + h * slope ELSE s.y END AS mean FROM (
  SELECT *, make_date((t1 + h) // 12, (t1 + h) % 12 + 1, 1) AS month, t1 - 11 + (h - 1) % 12 AS ts FROM (
    SELECT priority, max(t) AS t1, max_by(y, t) AS y1, (max_by(y, t) - min_by(y, t)) / (count(*) - 1) AS slope FROM om GROUP BY priority),
    (SELECT '3 years' AS asked, CAST(unnest(range(1, 37)) AS INTEGER) AS h UNION ALL SELECT 'default', CAST(unnest(range(1, 25)) AS INTEGER)),
    (SELECT unnest(['naive', 'drift', 'snaive']) AS model)) f JOIN om s ON s.priority = f.priority AND s.t = f.ts"""))
def forecast_horizon(spark, d):
    """Forecasts for "3 years", and for the default of two seasons."""
    from chronoloom.models.simple import fit_simple, forecast_simple
    df, spec = orders_monthly(spark, d)
    fit = fit_simple(df, spec, "y", {k: k for k in ("naive", "drift", "snaive")})
    both = forecast_simple(fit, spec, "3 years").withColumn("asked", F.lit("3 years")).unionByName(
        forecast_simple(fit, spec).withColumn("asked", F.lit("default")))
    return both.select("priority", "asked", "h", "month", "model", "mean")
