"""Decompositions, their forecasts and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.models.simple import fit_simple, forecast_simple
from chronoloom.operators import decompose as dc
from chronoloom.operators import features as ft
from chronoloom.operators import stats as st
from chronoloom.operators.blocks import cut_lineage
from chronoloom.plans.base import EH, OM, SD, events_hourly, orders_monthly, ship_daily, with_ctes
from chronoloom.plans.catalog import query
from chronoloom.plans.stl_sql import STL_NAIVE, STRENGTHS, multi_query, stl_query, x11_query

_COLS = ("priority", "month", "y", "trend", "season", "remainder", "season_adjust")


def _classical_sql(op, inv):
    return with_ctes(OM, """ma AS (SELECT *, count(*) OVER w AS c, (sum(y) OVER w - 0.5 * first_value(y) OVER w - 0.5 * last_value(y) OVER w) / 12 AS tr FROM om
  WINDOW w AS (PARTITION BY priority ORDER BY t ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)),
mt AS (SELECT priority, month, t, y, CASE WHEN c = 13 THEN tr END AS trend FROM ma)""",
        f"sf AS (SELECT priority, t % 12 AS p, avg(y {op} trend) AS f FROM mt GROUP BY ALL)",
        f"sn AS (SELECT priority, p, f {op} avg(f) OVER (PARTITION BY priority) AS season FROM sf)",
        body=f"""SELECT priority, month, y, trend, season, y {op} {'(trend * season)' if op == '/' else '(trend + season)'} AS remainder,
  y {op} season AS season_adjust FROM mt JOIN sn ON mt.priority = sn.priority AND t % 12 = p""").replace("SELECT priority, month, y, trend, season, y", "SELECT mt.priority, month, y, trend, season, y")


@query("classical_decompose", _classical_sql("-", "+"))
def classical_additive(spark, d):
    df, spec = orders_monthly(spark, d)
    return dc.classical(df, spec, "y").select(*_COLS)


@query("classical_multiplicative", _classical_sql("/", "*"))
def classical_multiplicative(spark, d):
    df, spec = orders_monthly(spark, d)
    return dc.classical(df, spec, "y", kind="multiplicative").select(*_COLS)


@query("stl", stl_query(OM, "om", "priority"))
def stl(spark, d):
    df, spec = orders_monthly(spark, d)
    return dc.stl(df, spec, "y").select(*_COLS)


@query("stl_periodic", stl_query(SD, "sd", "flag", "day", 7, s_window="periodic"))
def stl_periodic(spark, d):
    df, spec = ship_daily(spark, d)
    return dc.stl(df, spec, "y", s_window="periodic").select("flag", "day", "y", "trend", "season", "remainder", "season_adjust")


@query("stl_robust", stl_query(OM, "om", "priority", robust=True))
def stl_robust(spark, d):
    df, spec = orders_monthly(spark, d)
    return dc.stl(df, spec, "y", robust=True).select(*_COLS)


@query("stl_multiple_seasons", multi_query(EH, "eh", "event_type", "hour", "n", [24, 168]))
def stl_multiple(spark, d):
    df, spec = events_hourly(spark, d)
    return dc.stl_multi(df, spec, "n", [24, 168])


@query("stl_multiple_robust", multi_query(EH, "eh", "event_type", "hour", "n", [24, 168], robust=True))
def stl_multiple_robust(spark, d):
    """Two seasons whose weights come from one common remainder."""
    df, spec = events_hourly(spark, d)
    return dc.stl_multi(df, spec, "n", [24, 168], robust=True)


@query("components", stl_query(OM, "om", "priority", body="""SELECT priority, month, om.y, trend, season, remainder, trend + season + remainder AS identity
FROM om JOIN (SELECT * EXCLUDE (y) FROM {d}) USING (priority, t)"""))
def components(spark, d):
    """Every component, and what they add up to."""
    df, spec = orders_monthly(spark, d)
    out = dc.stl(df, spec, "y")
    return out.select("priority", "month", "y", "trend", "season", "remainder", (F.col("trend") + F.col("season") + F.col("remainder")).alias("identity"))


@query("x11", x11_query(OM, "om"))
def x11(spark, d):
    df, spec = orders_monthly(spark, d)
    return dc.x11(df, spec, "y").select(*_COLS)


@query("feat_stl", stl_query(OM, "om", "priority", more=STRENGTHS, body="SELECT * FROM zs JOIN zp USING (priority) JOIN ze USING (priority)"))
def feat_stl(spark, d):
    df, spec = orders_monthly(spark, d)
    return _stl_features(df, spec)


def _stl_features(df, spec):
    dcmp = dc.stl(df, spec, "y")
    r = st.acf(dcmp, spec, "remainder", 10).select(
        *spec.by, F.col("r")[0].alias("stl_e_acf1"), F.aggregate("r", F.lit(0.0), lambda s, v: s + v * v).alias("stl_e_acf10"))
    return ft.join_features([dc.strengths(dcmp, spec), r], spec.by)


@query("nsdiffs", stl_query(OM, "om", "priority", more=STRENGTHS, body="SELECT priority, CASE WHEN seasonal_strength > 0.64 THEN 1 ELSE 0 END AS nsdiffs FROM zs"))
def nsdiffs(spark, d):
    df, spec = orders_monthly(spark, d)
    return dc.nsdiffs(dc.strengths(dc.stl(df, spec, "y"), spec), spec)


def feature_frame(df, spec):
    """Every feature family, one row per series; shared parts are kept once."""
    df = df.persist()
    kinds = ft.acf_kinds(df, spec, "y").persist()
    frames = [ft.quantiles(df, spec, "y"), ft.feat_acf(kinds, spec), ft.feat_pacf(kinds, spec), _stl_features(df, spec),
              ft.guerrero(df, spec, "y"), ft.tiled(df, spec, "y"), ft.shifts(df, spec, "y"), ft.crossing_points(df, spec, "y"),
              ft.flat_spot(df, spec, "y"), ft.intermittency(df, spec, "y"), ft.hurst(df, spec, "y"), st.kpss(df, spec, "y"),
              st.pp(df, spec, "y"), st.ndiffs(df, spec, "y"), st.arch_lm(df, spec, "y"),
              ft.spectral_entropy(kinds.where("d = 0"), spec)]
    # one row per series each: cut here, so that the families are separate jobs
    return ft.join_features([cut_lineage(f) for f in frames], spec.by)


@query("feature_set")
def feature_set(spark, d):
    df, spec = orders_monthly(spark, d)
    return feature_frame(df, spec)


def _pca(spark, d):
    from chronoloom.plans.base import trade_leaves
    from chronoloom.operators.index import fill_gaps
    leaves, spec = trade_leaves(spark, d)
    df, spec = fill_gaps(leaves, spec, {"y": 0.0})
    kinds = ft.acf_kinds(df, spec, "y")
    feats = ft.join_features([ft.feat_acf(kinds, spec), ft.tiled(df, spec, "y"), ft.crossing_points(df, spec, "y"),
                              ft.flat_spot(df, spec, "y")], spec.by)
    cols = [c for c in feats.columns if c not in spec.keys]
    feats = feats.persist()
    return ft.pca_scores(feats, spec.by, cols), df, spec


@query("pca_features")
def pca_features(spark, d):
    scores, _, spec = _pca(spark, d)
    return scores.select(*spec.by, F.abs("pc1").alias("pc1"), F.abs("pc2").alias("pc2"))


@query("augment_join")
def augment_join(spark, d):
    """The four series farthest out on the first component, with their rows."""
    scores, df, spec = _pca(spark, d)
    top = scores.select(*spec.by, F.abs("pc1").alias("pc1")).orderBy(F.desc("pc1"), *spec.by).limit(4)
    return df.join(F.broadcast(top), spec.by).select(*spec.by, "month", "y", "pc1")


@query("decomposition_forecast", stl_query(OM, "om", "priority", body=STL_NAIVE))
def decomposition_forecast(spark, d):
    df, spec = orders_monthly(spark, d)
    return stl_forecast(df, spec, 12)


def stl_forecast(df, spec, h, s_window=11):
    """Naive on the seasonally adjusted series plus the last cycle's season."""
    dcmp = dc.stl(df, spec, "y", s_window=s_window).persist()
    adjusted = forecast_simple(fit_simple(dcmp, spec, "season_adjust", {"stl_naive": "naive"}), spec, h)
    season = forecast_simple(fit_simple(dcmp, spec, "season", {"season": "snaive"}), spec, h)
    out = adjusted.join(season.select(*spec.by, spec.t, F.col("mean").alias("_s")), [*spec.by, spec.t])
    return out.select(*spec.by, "model", spec.index, "h", (F.col("mean") + F.col("_s")).alias("mean"), "sigma")


@query("interpolate", with_ctes(EH, body="""SELECT event_type, hour, coalesce(y, pv + (nv - pv) * (t - pt) / (nt - pt)::DOUBLE, pv, nv) AS y FROM (
  SELECT *, last_value(y IGNORE NULLS) OVER p AS pv, last_value(CASE WHEN y IS NOT NULL THEN t END IGNORE NULLS) OVER p AS pt,
    first_value(y IGNORE NULLS) OVER n AS nv, first_value(CASE WHEN y IS NOT NULL THEN t END IGNORE NULLS) OVER n AS nt FROM eh
  WINDOW p AS (PARTITION BY event_type ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         n AS (PARTITION BY event_type ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""))
def interpolate(spark, d):
    df, spec = events_hourly(spark, d)
    return dc.interpolate(df, spec, "y").select("event_type", "hour", "y")


_BRIDGE = """SELECT flag, day, t, sd.y, remainder, outlier, coalesce(v, pv + (nv - pv) * (t - pt) / (nt - pt)::DOUBLE, pv, nv) AS clean FROM (
  SELECT *, last_value(v IGNORE NULLS) OVER p AS pv, last_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER p AS pt,
    first_value(v IGNORE NULLS) OVER n AS nv, first_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER n AS nt
  FROM (SELECT *, CASE WHEN NOT outlier THEN y END AS v FROM (SELECT *, remainder < q1 - 3 * (q3 - q1) OR remainder > q3 + 3 * (q3 - q1) AS outlier
    FROM (SELECT *, quantile_cont(remainder, 0.25) OVER k AS q1, quantile_cont(remainder, 0.75) OVER k AS q3 FROM {d} WINDOW k AS (PARTITION BY flag))))
  WINDOW p AS (PARTITION BY flag ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         n AS (PARTITION BY flag ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) JOIN sd USING (flag, t)"""


@query("clean_outliers", stl_query(SD, "sd", "flag", "day", 7, s_window="periodic", robust=True, body=_BRIDGE))
def clean_outliers(spark, d):
    df, spec = ship_daily(spark, d)
    return dc.clean_outliers(df, spec, "y")


@query("decomposition_forecast_log", with_ctes(OM, """ly AS (SELECT priority, t, ln(y) AS y FROM om)""",
    """ma AS (SELECT *, count(*) OVER w AS c, (sum(y) OVER w - 0.5 * first_value(y) OVER w - 0.5 * last_value(y) OVER w) / 12 AS tr FROM ly
  WINDOW w AS (PARTITION BY priority ORDER BY t ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING))""",
    "sf AS (SELECT priority, t % 12 AS p, avg(y - tr) FILTER (c = 13) AS f FROM ma GROUP BY ALL)",
    "sn AS (SELECT priority, p, f - avg(f) OVER (PARTITION BY priority) AS s FROM sf)",
    "ad AS (SELECT ly.priority, ly.t, y - s AS a FROM ly JOIN sn ON sn.priority = ly.priority AND sn.p = ly.t % 12)",
    "en AS (SELECT priority, max(t) AS t1, max_by(a, t) AS a1, (max_by(a, t) - min_by(a, t)) / (count(*) - 1) AS b FROM ad GROUP BY priority)",
    body="""SELECT en.priority, make_date((t1 + h) // 12, (t1 + h) % 12 + 1, 1) AS month, h, exp(a1 + h * b + s) AS median
  FROM en, (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS h) JOIN sn ON sn.p = (t1 + h) % 12 AND sn.priority = en.priority"""))
def decomposition_forecast_log(spark, d):
    """Logarithms decomposed; drift on the adjusted series, the last cycle again on top, back on the scale of the data."""
    from chronoloom.functions.transforms import box_cox_transform
    from chronoloom.models.decomposition import decomposition_forecast as compose, plain, seasonal
    df, spec = orders_monthly(spark, d)
    dcmp = dc.classical(df.withColumn("y", F.log("y")), spec, "y")
    out = compose(dcmp, spec, 12, {"season_adjust": plain("drift"), "season": seasonal(12)}, transform=box_cox_transform(0))
    return out.select("priority", "month", "h", "median")
