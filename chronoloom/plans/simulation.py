"""Sample paths, bootstraps and the distributions made from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.models import paths as pt
from chronoloom.models import smoothing as sm
from chronoloom.models.simple import augment_simple, fit_simple
from chronoloom.operators import decompose as dc
from chronoloom.operators import simulate as si
from chronoloom.operators.accuracy import crps_sample
from chronoloom.operators.blocks import cut_lineage
from chronoloom.operators.forecast import sample_distribution, sum_distributions
from chronoloom.operators.index import difference
from chronoloom.plans.arima import LONG, arma11
from chronoloom.plans.arima_sql import arma11_ctes, innovation_ctes
from chronoloom.plans.base import OM, orders_monthly, split, with_ctes
from chronoloom.plans.catalog import query
from chronoloom.plans.simple import FCS_ALL, FIT, forecasts, whole
from chronoloom.plans.smoothing import ALPHAS, ses_sql

TIMES, H, SEED = 100, 12, 7

_SIM = FIT + f""",
rs AS (SELECT priority, row_number() OVER (PARTITION BY priority ORDER BY t) - 1 AS pos, y - l1 AS e FROM fl WHERE l1 IS NOT NULL),
pl AS (SELECT priority, pos, e - avg(e) OVER (PARTITION BY priority) AS innov, count(*) OVER (PARTITION BY priority) AS n FROM rs),
ce AS (SELECT m.priority, m.model, rep.rep, h.h, m.level, m.slope, m.t_last, ('0x' || substr(md5('{SEED}|' || m.priority || '|' || rep.rep || '|' || h.h), 1, 8))::BIGINT AS hv
  FROM mt m, (SELECT CAST(unnest(range(1, {TIMES} + 1)) AS INTEGER) AS rep) rep, (SELECT CAST(unnest(range(1, {H} + 1)) AS INTEGER) AS h) h WHERE m.model IN ('naive', 'drift')),
sim AS (SELECT ce.priority, ce.model, rep, h, make_date((t_last + h) // 12, (t_last + h) % 12 + 1, 1) AS month, t_last + h AS t,
   level + h * slope + sum(innov) OVER (PARTITION BY ce.priority, ce.model, rep ORDER BY h) AS sim
  FROM ce JOIN (SELECT priority, any_value(n) AS n FROM pl GROUP BY 1) z ON z.priority = ce.priority JOIN pl ON pl.priority = ce.priority AND pl.pos = ce.hv % z.n)"""


_SIM_ALL = whole(_SIM)


def _paths(spark, d, models=("naive", "drift"), scored=False):
    df, spec = orders_monthly(spark, d)
    train, test = split(df) if scored else (df, None)
    named = {m: m for m in models}
    pool = si.residual_pool(augment_simple(train, spec, "y", {"naive": "naive"}), spec)
    return si.simulate_walk(fit_simple(train, spec, "y", named), spec, TIMES, H, SEED, pool), test, spec


@query("simulate", with_ctes(_SIM_ALL, body="SELECT priority, model, rep, month, h, sim FROM sim WHERE model = 'naive'"))
def simulate(spark, d):
    return _paths(spark, d, ("naive",))[0].drop("t")


_DIST = "avg(sim) AS mean, quantile_cont(sim, 0.1) AS lo80, quantile_cont(sim, 0.9) AS hi80, quantile_cont(sim, 0.025) AS lo95, quantile_cont(sim, 0.975) AS hi95"


@query("bootstrap_forecast", with_ctes(_SIM_ALL, body=f"SELECT priority, month, {_DIST} FROM sim WHERE model = 'naive' GROUP BY ALL"))
def bootstrap_forecast(spark, d):
    return sample_distribution(_paths(spark, d, ("naive",))[0], ["priority", "month"])


@query("sample_dist", with_ctes(_SIM_ALL, body=f"SELECT priority, model, month, {_DIST} FROM sim GROUP BY ALL"))
def sample_dist(spark, d):
    return sample_distribution(_paths(spark, d)[0], ["priority", "model", "month"])


@query("aggregate_interval", with_ctes(_SIM_ALL, body=f"SELECT priority, model, {_DIST} FROM (SELECT priority, model, rep, sum(sim) AS sim FROM sim GROUP BY ALL) GROUP BY ALL"))
def aggregate_interval(spark, d):
    total = _paths(spark, d)[0].groupBy("priority", "model", "rep").agg(F.sum("sim").alias("sim"))
    return sample_distribution(total, ["priority", "model"])


@query("combine_samples", with_ctes(_SIM_ALL, body=f"SELECT priority, month, {_DIST} FROM (SELECT priority, month, rep, avg(sim) AS sim FROM sim GROUP BY ALL) GROUP BY ALL"))
def combine_samples(spark, d):
    both = _paths(spark, d)[0].groupBy("priority", "month", "rep").agg(F.avg("sim").alias("sim"))
    return sample_distribution(both, ["priority", "month"])


@query("crps_sample", with_ctes(_SIM, """v AS (SELECT s.priority, s.model, s.t, s.sim, te.y, row_number() OVER (PARTITION BY s.priority, s.model, s.t ORDER BY s.sim) AS i FROM sim s JOIN te USING (priority, t))""",
    body="""SELECT model, avg(crps) AS crps FROM (SELECT priority, model, t, avg(abs(sim - y)) - (2 * sum(sim * i) - (count(*) + 1) * sum(sim)) / (count(*) * count(*)) AS crps
  FROM v GROUP BY ALL) GROUP BY model"""))
def crps_samples(spark, d):
    paths, test, spec = _paths(spark, d, scored=True)
    rows = paths.join(test.select("priority", "t", "y"), ["priority", "t"])
    return crps_sample(rows, ["priority", "model", "t"], "y").groupBy("model").agg(F.avg("crps").alias("crps"))


@query("sum_distributions", with_ctes(FCS_ALL, body="SELECT model, month, sum(mean) AS mean, sqrt(sum(sigma * sigma)) AS sigma FROM fcm GROUP BY ALL"))
def sum_distributions_(spark, d):
    fc, *_ = forecasts(spark, d, scored=False)
    return sum_distributions(fc, ["model", "month"])


@query("as_forecast", with_ctes(FCS_ALL, body="SELECT priority, model, month, mean, sigma * sigma AS variance FROM fcm WHERE model = 'naive'"))
def as_forecast(spark, d):
    """Plain columns get forecast roles again: key, index, mean, distribution."""
    fc, *_ = forecasts(spark, d, {"naive": "naive"}, scored=False)
    plain = fc.select("priority", "model", "month", "mean", (F.col("sigma") * F.col("sigma")).alias("variance"))
    dist = plain.withColumn("dist", F.struct(F.lit("normal").alias("family"), F.col("mean").alias("mu"), F.sqrt("variance").alias("sigma")))
    return dist.select("priority", "model", "month", F.col("dist.mu").alias("mean"), F.pow("dist.sigma", F.lit(2.0)).alias("variance"))


@query("simulate_ets")
def simulate_ets(spark, d):
    df, spec = orders_monthly(spark, d)
    fit = sm.ets_auto(df, spec, "y")
    return si.simulate_ets(fit, spec, TIMES, H, SEED).drop("t")


def _boot(spark, d, times):
    df, spec = orders_monthly(spark, d)
    dcmp = cut_lineage(dc.stl(df, spec, "y", s_window="periodic"))
    return si.block_bootstrap(dcmp, spec, times, SEED), spec.with_(keys=("priority", "rep"))


@query("block_bootstrap")
def block_bootstrap(spark, d):
    return _boot(spark, d, 10)[0].drop("t")


@query("bagging")
def bagging(spark, d):
    """Automatic smoothing of every replicate, forecasts pooled."""
    paths, spec = _boot(spark, d, 20)
    fc = sm.forecast_ets(sm.ets_auto(paths, spec, "sim"), spec, H)
    return fc.groupBy("priority", "month").agg(F.avg("mean").alias("mean"), F.min("mean").alias("lo"), F.max("mean").alias("hi"))



_REPS, _AHEAD = 50, 6
_UNIT = lambda side: f"(('0x' || substr(md5('{SEED}|{side}|' || priority || '|' || rep || '|' || h), 1, 8))::BIGINT + 0.5) / 4294967296.0"
_COMBINED = "WITH RECURSIVE " + ",\n".join([OM, arma11_ctes("om", LONG), innovation_ctes("om"), ses_sql("om")]) + f""",
zz AS (SELECT priority, rep, h, sqrt(-2 * ln({_UNIT("u")})) * cos(2 * pi() * {_UNIT("v")}) AS z FROM (SELECT DISTINCT priority FROM om),
  (SELECT unnest(range(1, {_REPS + 1})) AS rep), (SELECT unnest(range(1, {_AHEAD + 1})) AS h)),
en AS (SELECT priority, max_by(y, t) AS y, max_by(w, t) AS w, max_by(e, t) AS e FROM ar_e GROUP BY priority),
pa AS (SELECT priority, rep, 0 AS h, en.y, en.w, en.e FROM en, (SELECT unnest(range(1, {_REPS + 1})) AS rep)
  UNION ALL SELECT p.priority, p.rep, z.h, p.y + phi * p.w + theta * p.e + sqrt(s2) * z.z, phi * p.w + theta * p.e + sqrt(s2) * z.z, sqrt(s2) * z.z
  FROM pa p JOIN zz z ON z.priority = p.priority AND z.rep = p.rep AND z.h = p.h + 1 JOIN ar_f f ON f.priority = p.priority),
nn AS (SELECT priority, count(*) AS n FROM om GROUP BY priority),
ps AS (SELECT b.priority, z.rep, z.h, b.b.l + sqrt(b.b.sse / (n - 1)) * (z.z + b.b.a * coalesce(sum(z.z) OVER (PARTITION BY z.priority, z.rep ORDER BY z.h
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS y FROM b JOIN zz z USING (priority) JOIN nn USING (priority)),
ma AS (SELECT *, count(*) OVER w AS c, (sum(y) OVER w - 0.5 * first_value(y) OVER w - 0.5 * last_value(y) OVER w) / 12 AS tr FROM om
  WINDOW w AS (PARTITION BY priority ORDER BY t ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)),
sf AS (SELECT priority, t % 12 AS p, avg(y - tr) FILTER (c = 13) AS f FROM ma GROUP BY ALL),
sn AS (SELECT priority, p, f - avg(f) OVER (PARTITION BY priority) AS s FROM sf),
ad AS (SELECT om.priority, om.t, om.y - s AS a, om.y - s - lag(om.y - s) OVER (PARTITION BY om.priority ORDER BY om.t) AS d FROM om JOIN sn ON sn.priority = om.priority AND sn.p = om.t % 12),
ae AS (SELECT priority, max(t) AS t1, max_by(a, t) AS a, sqrt(avg(d * d)) AS sd FROM ad GROUP BY priority),
pd AS (SELECT ae.priority, z.rep, z.h, ae.a + sd * sum(z.z) OVER (PARTITION BY z.priority, z.rep ORDER BY z.h) + s AS y
  FROM ae JOIN zz z USING (priority) JOIN sn ON sn.priority = ae.priority AND sn.p = (t1 + z.h) % 12),
cm AS (SELECT priority, rep, h, avg(y) AS sim FROM (SELECT priority, rep, h, y FROM pa WHERE h > 0 UNION ALL SELECT * FROM ps UNION ALL SELECT * FROM pd) GROUP BY ALL)"""


@query("combine_models", _COMBINED + """
SELECT priority, CAST(h AS INTEGER) AS h, avg(sim) AS mean, stddev_pop(sim) AS sd FROM cm GROUP BY priority, h
UNION ALL SELECT priority, 0, avg(s), stddev_pop(s) FROM (SELECT priority, rep, sum(sim) AS s FROM cm GROUP BY ALL) GROUP BY priority""")
def combine_models(spark, d):
    """Mean of ARIMA(1,1,1), simple smoothing and a decomposition forecast, path by path; step 0 is the sum over the horizon."""
    df, spec = orders_monthly(spark, d)
    zero, one = F.lit(0.0), F.lit(1.0)
    arima = pt.arima_form(df, spec, "y", arma11(df, spec))
    ses = sm.ses_grid(df, spec, "y", ALPHAS).select("priority", "t_last", F.array("alpha", zero, zero, one).alias("params"),
                                                    F.array("level", zero, zero, zero, zero).alias("state"), (F.col("sse") / (F.col("n") - 1)).alias("sigma2"))
    dcmp = dc.classical(df, spec, "y")
    steps = difference(dcmp, spec, "season_adjust", "_d")
    walk = steps.groupBy("priority").agg(F.max("t").alias("t_last"), F.max_by("season_adjust", "t").alias("a"), F.avg(F.col("_d") * F.col("_d")).alias("sigma2"))
    walk = walk.select("priority", "t_last", F.array(one, zero, zero, one).alias("params"), F.array("a", zero, zero, zero, zero).alias("state"), "sigma2")
    tail = dcmp.join(walk.select("priority", "t_last"), "priority").where(F.col("t") > F.col("t_last") - 12)
    cycle = tail.groupBy("priority").agg(F.transform(F.array_sort(F.collect_list(F.struct("t", "season"))), lambda x: x["season"]).alias("cycle"))
    forms = arima.unionByName(pt.ets_form(ses, spec, "ses")).unionByName(pt.with_season(pt.ets_form(walk, spec), spec, cycle, "decomposition"))
    sims = cut_lineage(pt.combine(pt.paths(forms, spec, _REPS, _AHEAD, SEED), spec))
    step = sims.groupBy("priority", "h").agg(F.avg("sim").alias("mean"), F.stddev_pop("sim").alias("sd"))
    total = sims.groupBy("priority", "rep").agg(F.sum("sim").alias("s")).groupBy("priority").agg(
        F.lit(0).alias("h"), F.avg("s").alias("mean"), F.stddev_pop("s").alias("sd"))
    return step.unionByName(total)
