"""Hierarchical and grouped series, and coherent forecasts for them."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.models.simple import augment_simple, fit_simple, forecast_simple
from chronoloom.operators import hierarchy as hy
from chronoloom.operators import reconcile as rc
from chronoloom.operators.accuracy import accuracy
from chronoloom.operators.index import fill_gaps
from chronoloom.plans.base import TL, trade_leaves, with_ctes
from chronoloom.plans.catalog import query
from chronoloom.series import SeriesSpec

NESTED = [["region", "nation"]]
CROSSED = [["region"], ["segment"]]
MIXED = [["region", "nation"], ["segment"]]
SPLIT_T = 2000 * 12 + 7


def _sets_sql(structure, extra="month, t"):
    keys = hy.structure_keys(structure)
    sets = ", ".join("(" + ", ".join([extra, *s]) + ")" for s in hy.levels(structure))
    fl = ", ".join(f"grouping({k}) = 1 AS is_agg_{k}" for k in keys)
    return f"SELECT {', '.join(keys)}, {extra}, {fl}, sum(y) AS y FROM tl GROUP BY GROUPING SETS ({sets})"


def _agg(spark, d, structure):
    df, _ = trade_leaves(spark, d)
    keys = hy.structure_keys(structure)
    leaves = df.groupBy(*keys, "month", "t").agg(F.sum("y").alias("y"))
    return hy.aggregate_key(leaves, structure, ["month", "t"], [F.sum("y").alias("y")])


def _register(name, structure):
    @query(name, with_ctes(TL, body=_sets_sql(structure)))
    def run(spark, d):
        return _agg(spark, d, structure)


_register("aggregate_key_nested", NESTED)
_register("aggregate_key_crossed", CROSSED)
_register("aggregate_key_mixed", MIXED)
_register("aggregate_key_single", [["segment"]])


@query("is_aggregated", with_ctes(TL, body="SELECT region, month, sum(y) AS y FROM tl GROUP BY ALL"))
def is_aggregated(spark, d):
    return hy.at_level(_agg(spark, d, MIXED), MIXED, ["region"]).select("region", "month", "y")


# ---- coherent forecasts ------------------------------------------------

def base_forecasts(spark, d, structure, kind="snaive", h=12, scored=False):
    """Every node as an ordinary series: fit on all rows, or on those before the split if scored, then forecast."""
    nodes = hy.label_margins(_agg(spark, d, structure), structure)
    keys = tuple([*hy.structure_keys(structure), *hy.flags(structure)])
    spec = SeriesSpec(keys, "month", "month")
    # a node without orders in a month has value 0 there, on the common span
    full, spec = fill_gaps(nodes, spec, {"y": 0.0}, full=True)
    train, test = (full.where(F.col("t") < SPLIT_T), full.where(F.col("t") >= SPLIT_T)) if scored else (full, None)
    fit = fit_simple(train, spec, "y", {"base": kind})
    return forecast_simple(fit, spec, h), train, test, spec


def _base_sql(structure, h=12, scored=False):
    keys = hy.structure_keys(structure)
    ids = ", ".join([*keys, *hy.flags(structure)])
    on = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in [*keys, *hy.flags(structure)])
    return f"""nd AS ({_sets_sql(structure)}),
nk AS (SELECT DISTINCT {ids} FROM nd),
sp AS (SELECT unnest(range(min(t), max(t) + 1)) AS t FROM tl),
nf AS (SELECT a.*, a0.t, coalesce(b.y, 0.0) AS y FROM nk a JOIN sp a0 ON true LEFT JOIN nd b ON {on} AND a0.t = b.t),
en AS (SELECT {SPLIT_T if scored else "max(t) + 1"} AS t_end FROM sp),
fb AS (SELECT {ids}, t + 12 AS t, y AS mean FROM nf, en WHERE t >= t_end - 12 AND t < t_end - 12 + {h})"""


_N = _base_sql(NESTED)
_M = _base_sql(MIXED)
_M_SCORED = _base_sql(MIXED, scored=True)
_MON = "make_date(t // 12, t % 12 + 1, 1) AS month"


def _leaf_rollup(structure, leaf_sql):
    """SQL that sums leaf means (columns keys, t, mean) at every level."""
    keys = hy.structure_keys(structure)
    sets = ", ".join("(" + ", ".join(["t", *s]) + ")" for s in hy.levels(structure))
    fl = ", ".join(f"grouping({k}) = 1 AS is_agg_{k}" for k in keys)
    return f"SELECT {', '.join(keys)}, t, {fl}, sum(mean) AS mean FROM ({leaf_sql}) GROUP BY GROUPING SETS ({sets})"


@query("bottom_up", with_ctes(TL, _M, body=_leaf_rollup(
    MIXED, "SELECT * FROM fb WHERE NOT is_agg_region AND NOT is_agg_nation AND NOT is_agg_segment")))
def bottom_up(spark, d):
    fc, *_ = base_forecasts(spark, d, MIXED)
    return hy.null_margins(rc.bottom_up(fc.drop("sigma"), MIXED, ["t"]), MIXED)


def _td(name, method, share_sql):
    leaf = "SELECT s.region, s.nation, f.t, s.share * f.mean AS mean FROM sh s JOIN (SELECT t, mean FROM fb WHERE is_agg_region) f ON true"

    @query(name, with_ctes(TL, _N, f"sh AS ({share_sql})", body=_leaf_rollup(NESTED, leaf)))
    def run(spark, d):
        fc, train, _, _ = base_forecasts(spark, d, NESTED)
        return rc.top_down(fc.drop("sigma"), NESTED, ["t"], train, method=method)


_td("top_down_average_proportions", "average_proportions", f"""SELECT l.region, l.nation, sum(l.y / nullif(g.y, 0)) / count(*) AS share
  FROM nf l JOIN nf g ON g.is_agg_region AND l.t = g.t WHERE NOT l.is_agg_nation GROUP BY ALL""")
_td("top_down_proportion_averages", "proportion_averages", f"""SELECT l.region, l.nation, sum(l.y) / sum(g.y) AS share
  FROM nf l JOIN nf g ON g.is_agg_region AND l.t = g.t WHERE NOT l.is_agg_nation GROUP BY ALL""")

_SHARES = """r AS (SELECT region, t, mean, mean / nullif(sum(mean) OVER (PARTITION BY t), 0) AS share FROM fb WHERE NOT is_agg_region AND is_agg_nation),
n AS (SELECT region, nation, t, mean / nullif(sum(mean) OVER (PARTITION BY region, t), 0) AS share FROM fb WHERE NOT is_agg_nation)"""


@query("top_down", with_ctes(TL, _N, _SHARES, body=_leaf_rollup(NESTED, """SELECT n.region, n.nation, t, g.mean * r.share * n.share AS mean
  FROM n JOIN r USING (region, t) JOIN (SELECT t, mean FROM fb WHERE is_agg_region) g USING (t)""")))
def top_down(spark, d):
    fc, *_ = base_forecasts(spark, d, NESTED)
    return rc.top_down(fc.drop("sigma"), NESTED, ["t"])


@query("middle_out", with_ctes(TL, _N, _SHARES, body=_leaf_rollup(NESTED, """SELECT n.region, n.nation, t, r.mean * n.share AS mean
  FROM n JOIN r USING (region, t)""")))
def middle_out(spark, d):
    fc, *_ = base_forecasts(spark, d, NESTED)
    return rc.middle_out(fc.drop("sigma"), NESTED, ["t"], split=1)


def _coherent(fc, structure, *args):
    return hy.null_margins(rc.min_trace(fc, structure, *args), structure)


def _residuals(train, spec):
    return augment_simple(train, spec, "y", {"base": "snaive"})


# Least squares over all nodes: (S'S) b = S'y, S'S counting the levels that two leaves share; list elimination
_OLS = """dr AS (SELECT region, nation, segment, is_agg_region, is_agg_nation, is_agg_segment, max_by(y, t) AS last_y,
  (max_by(y, t) - min_by(y, t)) / (count(*) - 1) AS slope, max(t) AS tl FROM nf GROUP BY ALL),
fd AS (SELECT region, nation, segment, h, tl + h AS t, last_y + h * slope AS mean FROM dr, (SELECT unnest(range(1, 13)) AS h)),
lv AS (SELECT region, nation, segment, row_number() OVER (ORDER BY region, nation, segment) AS i FROM dr
  WHERE NOT is_agg_region AND NOT is_agg_nation AND NOT is_agg_segment),
rh AS (SELECT i, list(v ORDER BY h) AS r FROM (SELECT i, h, sum(mean) AS v FROM lv JOIN fd ON (fd.region IS NULL OR fd.region = lv.region)
    AND (fd.nation IS NULL OR fd.nation = lv.nation) AND (fd.segment IS NULL OR fd.segment = lv.segment) GROUP BY ALL) GROUP BY i),
ss AS (SELECT a.i, list((1 + CAST(a.region = b.region AS INTEGER) + CAST(a.region = b.region AND a.nation = b.nation AS INTEGER) + CAST(a.segment = b.segment AS INTEGER)
    + CAST(a.region = b.region AND a.segment = b.segment AS INTEGER) + CAST(a.i = b.i AS INTEGER))::DOUBLE ORDER BY b.i) AS r FROM lv a, lv b GROUP BY a.i),
gj AS (SELECT 0 AS k, list(list_concat(ss.r, rh.r) ORDER BY i) AS m FROM ss JOIN rh USING (i)
  UNION ALL SELECT k + 1, [CASE WHEN i = k + 1 THEN [v / m[k + 1][k + 1] FOR v IN m[k + 1]]
    ELSE [m[i][j] - m[i][k + 1] * m[k + 1][j] / m[k + 1][k + 1] FOR j IN range(1, len(m[1]) + 1)] END FOR i IN range(1, len(m) + 1)]
  FROM gj WHERE k < len(m)),
lf AS (SELECT region, nation, segment, t, m[i][len(m) + h] AS mean FROM gj, lv, (SELECT DISTINCT h, t FROM fd) WHERE k = len(m))"""


@query("min_trace_ols", with_ctes(TL, _M, _OLS, body="SELECT 'base' AS model, * REPLACE (round(mean, 9) + 0.0 AS mean) FROM (" + _leaf_rollup(MIXED, "SELECT * FROM lf") + ")").replace("WITH ", "WITH RECURSIVE ", 1))
def min_trace_ols(spark, d):
    fc, *_ = base_forecasts(spark, d, MIXED, "drift")
    # zeros come out as rounding noise
    return _coherent(fc.drop("sigma"), MIXED, ["model", "t"], "ols").withColumn("mean", F.round("mean", 9) + 0.0)


@query("min_trace_shrink")
def min_trace_shrink(spark, d):
    fc, train, _, spec = base_forecasts(spark, d, MIXED)
    return _coherent(fc.drop("sigma"), MIXED, ["model", "t"], "mint_shrink", _residuals(train, spec))


@query("reconciled_distribution")
def reconciled_distribution(spark, d):
    fc, train, _, spec = base_forecasts(spark, d, MIXED)
    return _coherent(fc, MIXED, ["model", "t"], "mint_shrink", _residuals(train, spec))


@query("reconcile", with_ctes(TL, _M, body=f"""SELECT *, 'base' AS model FROM fb UNION ALL BY NAME
  SELECT *, 'bu' AS model FROM ({_leaf_rollup(MIXED, 'SELECT * FROM fb WHERE NOT is_agg_region AND NOT is_agg_nation AND NOT is_agg_segment')})"""))
def reconcile(spark, d):
    fc, *_ = base_forecasts(spark, d, MIXED)
    fc = fc.drop("sigma", "h", "month")
    return hy.null_margins(rc.reconcile(fc, {"bu": rc.bottom_up(fc, MIXED, ["t"])}), MIXED)


@query("level_accuracy", with_ctes(TL, _M_SCORED, body=f"""SELECT is_agg_region, is_agg_nation, is_agg_segment, avg(rmse) AS rmse, avg(mase) AS mase FROM (
  SELECT f.region, f.nation, f.segment, f.is_agg_region, f.is_agg_nation, f.is_agg_segment,
         sqrt(avg((a.y - f.mean) * (a.y - f.mean))) AS rmse, avg(abs(a.y - f.mean)) / nullif(any_value(s.sa), 0) AS mase
  FROM fb f JOIN nf a ON a.t = f.t AND a.region IS NOT DISTINCT FROM f.region AND a.nation IS NOT DISTINCT FROM f.nation
     AND a.segment IS NOT DISTINCT FROM f.segment
  JOIN (SELECT region, nation, segment, avg(abs(y - ly)) AS sa FROM (SELECT *, lag(y, 12) OVER (PARTITION BY region, nation, segment ORDER BY t) AS ly
        FROM nf WHERE t < {SPLIT_T}) GROUP BY 1, 2, 3) s ON s.region IS NOT DISTINCT FROM f.region AND s.nation IS NOT DISTINCT FROM f.nation
     AND s.segment IS NOT DISTINCT FROM f.segment
  GROUP BY 1, 2, 3, 4, 5, 6) GROUP BY 1, 2, 3"""))
def level_accuracy(spark, d):
    fc, train, test, spec = base_forecasts(spark, d, MIXED, scored=True)
    scores = accuracy(fc, test, train, spec, by=spec.by, names=("rmse", "mase"))
    return scores.groupBy(*hy.flags(MIXED)).agg(F.avg("rmse").alias("rmse"), F.avg("mase").alias("mase"))
