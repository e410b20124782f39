"""Benchmark models, forecasts, intervals and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.functions.special import level_z, z_value
from chronoloom.functions import transforms
from chronoloom.models.simple import augment_simple, fit_simple, forecast_simple
from chronoloom.operators import accuracy as acc
from chronoloom.operators.crossval import cross_validate, summarise_errors
from chronoloom.operators.forecast import back_transform, combination, hilo
from chronoloom.operators.reshape import union_all
from chronoloom.plans.base import LAST_DAY, OM, orders_monthly, split, with_ctes
from chronoloom.plans.catalog import query

FOUR = {"mean": "mean", "naive": "naive", "snaive": "snaive", "drift": "drift"}
H = 12


def fit_ctes(train: str = "tr", y: str = "y") -> str:
    return f"""fl AS (SELECT priority, t, {y} AS y, lag({y}) OVER w AS l1, lag({y}, 12) OVER w AS lm FROM {train}
  WINDOW w AS (PARTITION BY priority ORDER BY t)),
fit AS (SELECT priority, count(y) AS n, avg(y) AS mean_y, var_samp(y) AS var_y, max(t) AS t_last, max_by(y, t) AS last_y,
          min_by(y, t) AS first_y, avg((y - l1) * (y - l1)) AS s1, var_samp(y - l1) AS sd, avg((y - lm) * (y - lm)) AS sm
        FROM fl GROUP BY priority),
mt AS (SELECT priority, 'mean' AS model, mean_y AS level, 0.0::DOUBLE AS slope, var_y AS sigma2, n, t_last FROM fit
  UNION ALL SELECT priority, 'naive', last_y, 0.0, s1, n, t_last FROM fit
  UNION ALL SELECT priority, 'snaive', NULL, 0.0, sm, n, t_last FROM fit
  UNION ALL SELECT priority, 'drift', last_y, (last_y - first_y) / (n - 1), sd, n, t_last FROM fit)"""


TR = OM + f""",
tr AS (SELECT * FROM om WHERE month < DATE '{LAST_DAY}'),
te AS (SELECT * FROM om WHERE month >= DATE '{LAST_DAY}')"""
FIT = TR + ",\n" + fit_ctes()
FC = f"""fc AS (
  SELECT mt.priority, mt.model, mt.t_last + h.h AS t, CAST(h.h AS INTEGER) AS h,
         CASE model WHEN 'snaive' THEN s.y WHEN 'drift' THEN level + h.h * slope ELSE level END AS mean,
         sqrt(sigma2 * CASE model WHEN 'mean' THEN 1 + 1.0 / n WHEN 'naive' THEN h.h
              WHEN 'snaive' THEN (h.h - 1) // 12 + 1 ELSE h.h * (1 + h.h / (n - 1)::DOUBLE) END) AS sigma
  FROM mt JOIN (SELECT unnest(range(1, {H} + 1)) AS h) h ON true
  LEFT JOIN tr s ON s.priority = mt.priority AND s.t = mt.t_last + h.h - 12 * ((h.h - 1) // 12 + 1)),
fcm AS (SELECT *, make_date(t // 12, t % 12 + 1, 1) AS month FROM fc)"""
FCS = FIT + ",\n" + FC


def whole(sql: str) -> str:
    """The same on all rows: nothing is held back where nothing is scored."""
    return sql.replace(f" WHERE month < DATE '{LAST_DAY}')", ")")


FIT_ALL, FCS_ALL = whole(FIT), whole(FCS)


def train_fit(spark, d, models=FOUR, scored=True):
    """Models fitted on the training months if forecasts are scored, else on all."""
    df, spec = orders_monthly(spark, d)
    train, test = split(df) if scored else (df, df.limit(0))
    return fit_simple(train, spec, "y", models), train, test, spec


def forecasts(spark, d, models=FOUR, h=H, scored=True):
    fit, train, test, spec = train_fit(spark, d, models, scored)
    return forecast_simple(fit, spec, h), train, test, spec


@query("train_test_split", OM and with_ctes(OM, body=f"""
SELECT priority, month, y, CASE WHEN month < DATE '{LAST_DAY}' THEN 'train' ELSE 'test' END AS part FROM om"""))
def train_test_split(spark, d):
    df, _ = orders_monthly(spark, d)
    train, test = split(df)
    return union_all({"train": train, "test": test}, "part").select("priority", "month", "y", "part")


@query("model", with_ctes(FIT_ALL, body="SELECT priority, model, level, slope, sigma2, n FROM mt"))
def model(spark, d):
    fit, *_ = train_fit(spark, d, scored=False)
    return fit.select("priority", "model", "level", "slope", "sigma2", "n")


def _single(name):
    body = f"SELECT priority, model, month, h, mean, sigma FROM fcm WHERE model = '{name}'"

    @query({"mean": "mean_model"}.get(name, name), with_ctes(FCS_ALL, body=body))
    def run(spark, d):
        fc, *_ = forecasts(spark, d, {name: name}, scored=False)
        return fc.select("priority", "model", "month", "h", "mean", "sigma")


for _name in FOUR:
    _single(_name)


@query("forecast", with_ctes(FCS_ALL, body="SELECT priority, model, month, h, mean, sigma FROM fcm"))
def forecast(spark, d):
    fc, *_ = forecasts(spark, d, scored=False)
    return fc.select("priority", "model", "month", "h", "mean", "sigma")


@query("hilo", with_ctes(FCS_ALL, body="SELECT priority, model, month, mean, " + ", ".join(
    f"mean - {level_z(v)!r} * sigma AS lo{v}, mean + {level_z(v)!r} * sigma AS hi{v}" for v in (80, 95, 99)) + " FROM fcm"))
def hilo_(spark, d):
    fc, *_ = forecasts(spark, d, scored=False)
    return hilo(fc, (80, 95, 99)).drop("t", "h", "sigma")


ERR = FCS + """,
sc AS (SELECT priority, avg(abs(y - lm)) AS sa, avg((y - lm) * (y - lm)) AS sq FROM fl GROUP BY priority),
er AS (SELECT fc.priority, fc.model, fc.t, fc.h, te.y, te.y - mean AS e, sa, sq, mean, sigma
       FROM fc JOIN te USING (priority, t) JOIN sc USING (priority)),
ec AS (SELECT *, e - avg(e) OVER (PARTITION BY priority, model) AS dv FROM er),
el AS (SELECT *, lag(dv) OVER (PARTITION BY priority, model ORDER BY t) AS pv FROM ec)"""
MEASURES = """avg(e) AS me, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae, avg(100 * e / nullif(y, 0)) AS mpe,
  avg(abs(100 * e / nullif(y, 0))) AS mape, avg(abs(e) / nullif(sa, 0)) AS mase, sqrt(avg(e * e / nullif(sq, 0))) AS rmsse"""


@query("accuracy", with_ctes(ERR, body=f"""SELECT priority, model, {MEASURES},
  coalesce(sum(dv * pv), 0) / nullif(sum(dv * dv), 0) AS acf1 FROM el GROUP BY ALL"""))
def accuracy(spark, d):
    fc, train, test, spec = forecasts(spark, d)
    return acc.accuracy(fc, test, train, spec)


@query("accuracy_by_h", with_ctes(ERR, body=f"SELECT model, h, {MEASURES} FROM er GROUP BY ALL"))
def accuracy_by_h(spark, d):
    fc, train, test, spec = forecasts(spark, d)
    return acc.accuracy(fc, test, train, spec, by=["model", "h"], names=acc.POINT[:-1])


@query("accuracy_named_measures", with_ctes(ERR, body="""SELECT model, avg(rmse) AS rmse, avg(mase) AS mase FROM (
  SELECT priority, model, sqrt(avg(e * e)) AS rmse, avg(abs(e) / nullif(sa, 0)) AS mase FROM er GROUP BY ALL) GROUP BY model"""))
def accuracy_named(spark, d):
    fc, train, test, spec = forecasts(spark, d)
    per_series = acc.accuracy(fc, test, train, spec, names=("rmse", "mase"))
    return per_series.groupBy("model").agg(F.avg("rmse").alias("rmse"), F.avg("mase").alias("mase"))


AUG = TR + """,
au AS (SELECT priority, month, t, y, avg(y) OVER (PARTITION BY priority) AS f_mean, lag(y) OVER w AS f_naive,
              lag(y, 12) OVER w AS f_snaive,
              lag(y) OVER w + (last_value(y) OVER f - first_value(y) OVER f) / (count(*) OVER (PARTITION BY priority) - 1) AS f_drift
       FROM tr WINDOW w AS (PARTITION BY priority ORDER BY t),
         f AS (PARTITION BY priority ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
ag AS (SELECT priority, month, t, y, 'mean' AS model, f_mean AS fitted FROM au
  UNION ALL SELECT priority, month, t, y, 'naive', f_naive FROM au
  UNION ALL SELECT priority, month, t, y, 'snaive', f_snaive FROM au
  UNION ALL SELECT priority, month, t, y, 'drift', f_drift FROM au)"""


@query("augment", with_ctes(whole(AUG), body="SELECT priority, model, month, y, fitted, y - fitted AS resid FROM ag"))
def augment(spark, d):
    df, spec = orders_monthly(spark, d)
    return augment_simple(df, spec, "y", FOUR).drop("t")


@query("training_accuracy", with_ctes(AUG, body="""SELECT priority, model, avg(y - fitted) AS me,
  sqrt(avg((y - fitted) * (y - fitted))) AS rmse, avg(abs(y - fitted)) AS mae FROM ag GROUP BY ALL"""))
def training_accuracy(spark, d):
    df, spec = orders_monthly(spark, d)
    train = split(df)[0]
    aug = augment_simple(train, spec, "y", FOUR)
    return acc.training_accuracy(aug, train, spec, names=("me", "rmse", "mae"))


@query("quantile_score", with_ctes(ERR, body=f"""SELECT model, avg(CASE WHEN y < q THEN 2 * 0.9 * (q - y) ELSE 2 * 0.1 * (y - q) END) AS qs
  FROM (SELECT *, mean + ({z_value(0.1)!r}) * sigma AS q FROM er) GROUP BY model"""))
def quantile_score(spark, d):
    fc, train, test, spec = forecasts(spark, d)
    rows = fc.join(test.select("priority", "t", "y"), ["priority", "t"])
    q = acc.normal_quantile(F.col("mean"), F.col("sigma"), 0.1)
    return rows.groupBy("model").agg(F.avg(acc.quantile_score(F.col("y"), q, 0.1)).alias("qs"))


@query("winkler_score", with_ctes(ERR, body=f"""SELECT model, avg(hi - lo + CASE WHEN y < lo THEN 10 * (lo - y)
   WHEN y > hi THEN 10 * (y - hi) ELSE 0 END) AS winkler
  FROM (SELECT *, mean - {level_z(80)!r} * sigma AS lo, mean + {level_z(80)!r} * sigma AS hi FROM er) GROUP BY model"""))
def winkler_score(spark, d):
    fc, train, test, spec = forecasts(spark, d)
    rows = hilo(fc, (80,)).join(test.select("priority", "t", "y"), ["priority", "t"])
    return rows.groupBy("model").agg(
        F.avg(acc.winkler_score(F.col("y"), F.col("lo80"), F.col("hi80"), 80)).alias("winkler"))


# normal CDF by the power series of the incomplete gamma function
CRPS_SQL = ERR + """,
zz AS (SELECT *, (y - mean) / sigma AS z, (y - mean) / sigma * (y - mean) / sigma / 2 AS x FROM er),
ph AS (SELECT *, CASE WHEN x <= 0 THEN 0.5 ELSE 0.5 + sign(z) * 0.5 * least(1, list_sum(list_transform(range(0, 200),
        lambda k: exp(k * ln(x) + 0.5 * ln(x) - x - lgamma(k + 1.5))))) END AS cdf FROM zz),
cr AS (SELECT model, priority, sigma * (z * (2 * cdf - 1) + 2 * exp(-z * z / 2) / sqrt(2 * pi()) - 1 / sqrt(pi())) AS v FROM ph),
cs AS (SELECT model, avg(v) AS crps FROM cr GROUP BY model)"""


def _crps(spark, d):
    fc, train, test, spec = forecasts(spark, d)
    rows = fc.join(test.select("priority", "t", "y"), ["priority", "t"])
    return rows.groupBy("model").agg(F.avg(acc.crps_normal(F.col("y"), F.col("mean"), F.col("sigma"))).alias("crps"))


@query("crps", with_ctes(CRPS_SQL, body="SELECT model, crps FROM cs"))
def crps(spark, d):
    return _crps(spark, d)


@query("skill_score", with_ctes(CRPS_SQL, body="""SELECT cs.model, cs.crps, 1 - cs.crps / b.crps AS skill FROM cs,
  (SELECT crps FROM cs WHERE model = 'naive') b"""))
def skill_score(spark, d):
    return acc.skill(_crps(spark, d), [], "naive", "crps")


@query("cross_validate", with_ctes(OM, body="""SELECT model, h, avg(e) AS me, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae, count(e) AS n FROM (
  SELECT model, h, a.y - CASE model WHEN 'mean' THEN s / i WHEN 'naive' THEN f.y ELSE f.y + h * (f.y - y1) / nullif(i - 1, 0) END AS e
  FROM (SELECT priority, t, y, row_number() OVER w AS i, sum(y) OVER w AS s, first_value(y) OVER w AS y1 FROM om
        WINDOW w AS (PARTITION BY priority ORDER BY t)) f
  JOIN (SELECT unnest(['mean', 'naive', 'drift']) AS model) m ON true
  JOIN (SELECT CAST(unnest(range(1, 5)) AS INTEGER) AS h) h ON true
  JOIN om a ON a.priority = f.priority AND a.t = f.t + h.h
  WHERE i >= 10) GROUP BY ALL"""))
def cross_validate_(spark, d):
    df, spec = orders_monthly(spark, d)
    return summarise_errors(cross_validate(df, spec, "y", init=10, step=1, h=4), ["model", "h"])


@query("combination", with_ctes(FCS_ALL, body="SELECT priority, month, h, avg(mean) AS mean, 'combination' AS model FROM fcm WHERE model <> 'mean' GROUP BY ALL"))
def combination_(spark, d):
    fc, *_ = forecasts(spark, d, {"naive": "naive", "snaive": "snaive", "drift": "drift"}, scored=False)
    return combination(fc, ["priority", "month", "h"])


@query("back_transform", with_ctes(
    OM, "tr AS (SELECT priority, t, ln(y + 1) AS y FROM om)", fit_ctes(), FC,
    body=f"""SELECT priority, month, h, exp(mean) * (1 + sigma * sigma / 2) AS mean, exp(mean) AS median,
  exp(mean - {level_z(80)!r} * sigma) AS lo80, exp(mean + {level_z(80)!r} * sigma) AS hi80 FROM fcm WHERE model = 'drift'"""))
def back_transform_(spark, d):
    df, spec = orders_monthly(spark, d)
    train = df.withColumn("y", transforms.log.forward(F.col("y") + 1))
    fc = forecast_simple(fit_simple(train, spec, "y", {"drift": "drift"}), spec, H)
    return back_transform(fc, transforms.log, (80,)).select("priority", "month", "h", "mean", "median", "lo80", "hi80")


@query("rw", with_ctes(FCS_ALL, body="SELECT priority, 'rw' AS model, month, h, mean, sigma FROM fcm WHERE model = 'naive'"))
def rw(spark, d):
    fc, *_ = forecasts(spark, d, {"rw": "naive"}, scored=False)
    return fc.select("priority", "model", "month", "h", "mean", "sigma")


@query("residuals", with_ctes(OM, body="""SELECT priority, month, ln(y + 1) - l AS innov, y - (exp(l) - 1) AS resid FROM (
  SELECT *, lag(ln(y + 1)) OVER (PARTITION BY priority ORDER BY t) AS l FROM om)"""))
def residuals(spark, d):
    """Innovations on the model (log) scale, residuals on the response scale."""
    df, spec = orders_monthly(spark, d)
    logged = df.withColumn("w", transforms.log.forward(F.col("y") + 1))
    aug = augment_simple(logged, spec, "w", {"naive": "naive"})
    back = transforms.log.inverse(F.col("w")) - 1 - (transforms.log.inverse(F.col("fitted")) - 1)
    return aug.select("priority", "month", F.col("resid").alias("innov"), back.alias("resid"))
