"""Plot-data tables, autocorrelation, tests and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.functions.draws import normal
from chronoloom.models.simple import augment_simple
from chronoloom.operators import features as ft
from chronoloom.operators import stats as st
from chronoloom.operators.reshape import pivot_wider
from chronoloom.plans.base import (
    OM, PA, SD, TL, UD, orders_monthly, part_attrs, ship_daily, trade_leaves, user_daily, with_ctes)
from chronoloom.plans.catalog import query
from chronoloom.plans.linear_sql import ols_ctes
from chronoloom.plans.relational import SEGMENTS


# ---- tables behind plots -----------------------------------------------

@query("season_frame", with_ctes(SD, body="""SELECT flag, day, CAST(year(day) * 12 + month(day) - 1 AS BIGINT) AS cycle, CAST(day(day) AS BIGINT) AS position, n FROM sd"""))
def season_frame(spark, d):
    df, spec = ship_daily(spark, d)
    return ft.season_frame(df, spec, "month").select("flag", "day", "cycle", "position", "n")


@query("subseries_frame", with_ctes(OM, body="SELECT priority, month, y, t % 12 + 1 AS season, avg(y) OVER (PARTITION BY priority, t % 12) AS season_mean FROM om"))
def subseries_frame(spark, d):
    df, spec = orders_monthly(spark, d)
    return ft.subseries_frame(df, spec, "y").select("priority", "month", "y", "season", "season_mean")


def _corr_sql(cols, src, by=""):
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    lead = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return " UNION ALL ".join(f"SELECT {lead}'{a}' AS x, '{b}' AS y, corr({a}, {b}) AS corr FROM {src}{group}" for a, b in pairs)


@query("pairs_corr", with_ctes(PA, body=_corr_sql(["qty", "price", "discount", "tax"], "pa", "brand")))
def pairs_corr(spark, d):
    df, _ = part_attrs(spark, d)
    return ft.pair_correlations(df, ["brand"], ["qty", "price", "discount", "tax"])


_WIDE = "w AS (SELECT month, " + ", ".join(f"max(y) FILTER (segment = '{s}') AS {s}" for s in SEGMENTS) + \
    " FROM (SELECT month, segment, sum(y) AS y FROM tl GROUP BY ALL) GROUP BY month)"


@query("pairs_corr_series", with_ctes(TL, _WIDE, body=_corr_sql(SEGMENTS, "w")))
def pairs_corr_series(spark, d):
    df, _ = trade_leaves(spark, d)
    wide = pivot_wider(df.groupBy("month", "segment").agg(F.sum("y").alias("y")), ["month"], "segment", SEGMENTS, "y")
    return ft.pair_correlations(wide, [], SEGMENTS)


_NAIVE_RES = "rs AS (SELECT priority, month, t, y, lag(y) OVER (PARTITION BY priority ORDER BY t) AS fitted FROM om)"


def _residuals(spark, d):
    df, spec = orders_monthly(spark, d)
    return augment_simple(df, spec, "y", {"naive": "naive"}).drop("model"), spec


@query("histogram", with_ctes(OM, _NAIVE_RES, """rr AS (SELECT priority, y - fitted AS e FROM rs WHERE fitted IS NOT NULL),
rg AS (SELECT priority, min(e) AS lo, (max(e) - min(e)) / 30 AS wd FROM rr GROUP BY 1)""", body="""
SELECT priority, CAST(least(floor((e - lo) / wd), 29) AS BIGINT) AS bin, count(*) AS n, lo + wd * CAST(least(floor((e - lo) / wd), 29) AS BIGINT) AS left
FROM rr JOIN rg USING (priority) GROUP BY ALL"""))
def histogram(spark, d):
    res, _ = _residuals(spark, d)
    return ft.histogram(res, ["priority"], "resid")


@query("abline_fit_pairs", with_ctes(OM, body="SELECT priority, quarter(month) AS season, y, lag(y, 12) OVER (PARTITION BY priority ORDER BY t) AS fitted FROM om"))
def abline_fit_pairs(spark, d):
    df, spec = orders_monthly(spark, d)
    aug = augment_simple(df, spec, "y", {"snaive": "snaive"})
    return aug.select("priority", F.quarter("month").cast("long").alias("season"), "y", "fitted")


# ---- autocorrelation and tests -----------------------------------------

def acf_cte(name: str, src: str, keys: str, y: str, lags: int) -> str:
    on = " AND ".join(f"a.{k.strip()} = b.{k.strip()}" for k in keys.split(","))
    ak = ", ".join(f"a.{k.strip()}" for k in keys.split(","))
    return f"""{name}_c AS (SELECT {keys}, t, {y} - avg({y}) OVER (PARTITION BY {keys}) AS x FROM {src} WHERE {y} IS NOT NULL),
{name}_0 AS (SELECT {keys}, count(x) AS n, sum(x * x) AS c0 FROM {name}_c GROUP BY ALL),
{name}_k AS (SELECT {ak}, k.k AS k, sum(a.x * b.x) AS ck FROM {name}_c a JOIN (SELECT unnest(range(1, {lags} + 1)) AS k) k ON true
  JOIN {name}_c b ON {on} AND a.t = b.t + k.k GROUP BY ALL),
{name} AS (SELECT {keys}, CAST(k AS INTEGER) AS lag, n, coalesce(ck, 0) / nullif(c0, 0) AS acf
  FROM (SELECT z.*, k.k FROM {name}_0 z JOIN (SELECT unnest(range(1, {lags} + 1)) AS k) k ON true) g LEFT JOIN {name}_k USING ({keys}, k))"""


@query("acf", with_ctes(OM, acf_cte("ac", "om", "priority", "y", 24), body="SELECT priority, lag, acf FROM ac"))
def acf(spark, d):
    df, spec = orders_monthly(spark, d)
    return st.acf_table(st.acf(df, spec, "y", 24), spec)


def pacf_cte(name: str, acf: str, keys: str, lags: int) -> str:
    return f"""{name}_r AS (SELECT {keys}, list(acf ORDER BY lag) AS r FROM {acf} GROUP BY ALL),
{name} AS (
  SELECT {keys}, r, CAST(1 AS BIGINT) AS k, r[1] AS a, [r[1]] AS phi FROM {name}_r
  UNION ALL
  SELECT {keys}, r, k + 1, a2, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - a2 * phi[k + 1 - j]), a2) FROM (
    SELECT *, (r[k + 1] - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 1 - j])))
              / (1 - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[j]))) AS a2 FROM {name} WHERE k < {lags}))"""


@query("pacf", "WITH RECURSIVE " + ",\n".join([OM, acf_cte("ac", "om", "priority", "y", 24), pacf_cte("pc", "ac", "priority", 24)])
       + "\nSELECT priority, CAST(k AS INTEGER) AS lag, a AS pacf FROM pc")
def pacf(spark, d):
    df, spec = orders_monthly(spark, d)
    return st.acf_table(st.pacf(df, spec, "y", 24), spec, "p", "pacf")


_D12 = "dd AS (SELECT * FROM (SELECT priority, t, y - lag(y, 12) OVER (PARTITION BY priority ORDER BY t) AS v FROM om) WHERE v IS NOT NULL)"


@query("ts_display", "WITH RECURSIVE " + ",\n".join([OM, _D12, acf_cte("ac", "dd", "priority", "v", 36), pacf_cte("pc", "ac", "priority", 36)])
       + "\nSELECT priority, ac.lag, acf, a AS pacf FROM ac JOIN pc USING (priority) WHERE pc.k = ac.lag")
def ts_display(spark, d):
    from chronoloom.operators.index import difference
    df, spec = orders_monthly(spark, d)
    diff = difference(df, spec, "y", "v", 12).where("v IS NOT NULL")
    arrays = st.acf(diff, spec, "v", 36).withColumn("p", st.partial_from(F.col("r")))
    cells = arrays.select("priority", F.posexplode(F.arrays_zip("r", "p")).alias("i", "c"))
    return cells.select("priority", (F.col("i") + 1).alias("lag"), F.col("c.r").alias("acf"), F.col("c.p").alias("pacf"))


@query("ts_residuals", with_ctes(OM, _NAIVE_RES, "re AS (SELECT priority, t, y - fitted AS e FROM rs WHERE fitted IS NOT NULL)",
                                 acf_cte("ac", "re", "priority", "e", 24), body="SELECT priority, lag, acf FROM ac"))
def ts_residuals(spark, d):
    res, spec = _residuals(spark, d)
    return st.acf_table(st.acf(res.where("resid IS NOT NULL"), spec, "resid", 24), spec)


# upper chi-square tail by the power series of the incomplete gamma function
def chi2_sql(x: str, dof: int) -> str:
    """Tail in closed form: a finite sum for even degrees of freedom, one plus an error function for odd ones.

    The error function comes from its own series in ascending order near 0 and from the Mills ratio far out.
    """
    h = f"(({x}) / 2)"
    if dof % 2 == 0:
        return f"(CASE WHEN {h} <= 0 THEN 1 ELSE list_sum(list_transform(range(0, {dof // 2}), lambda k: exp(k * ln({h}) - {h} - lgamma(k + 1)))) END)"
    steps = f"coalesce(list_sum(list_transform(range(1, {(dof + 1) // 2}), lambda k: exp((k - 0.5) * ln({h}) - {h} - lgamma(k + 0.5)))), 0)"
    near = f"1 - list_sum(list_transform(range(0, 120), lambda k: exp((k + 0.5) * ln({h}) - {h} - lgamma(k + 1.5))))"
    mills = f"list_reduce(list_prepend(0.0::DOUBLE, [k::DOUBLE FOR k IN range(80, 0, -1)]), lambda s, k: k / (sqrt({x}) + s))"
    far = f"sqrt(2 / pi()) * exp(-{h}) / (sqrt({x}) + {mills})"
    return f"(CASE WHEN {h} <= 0 THEN 1 WHEN {h} < 8 THEN {near} + {steps} ELSE {far} + {steps} END)"


def _test_sql(stat, dof):
    return with_ctes(OM, _NAIVE_RES, "re AS (SELECT priority, t, y - fitted AS e FROM rs WHERE fitted IS NOT NULL)",
                     acf_cte("ac", "re", "priority", "e", 10),
                     body=f"SELECT priority, stat, greatest(0, {chi2_sql('stat', dof)}) AS pvalue FROM (SELECT priority, {stat} AS stat FROM ac GROUP BY priority)")


@query("box_pierce", _test_sql("sum(n * acf * acf)", 10))
def box_pierce(spark, d):
    res, spec = _residuals(spark, d)
    return st.portmanteau(st.acf(res.where("resid IS NOT NULL"), spec, "resid", 10), spec, 10, 0, "box_pierce")


@query("ljung_box", _test_sql("sum(n * (n + 2) * acf * acf / (n - lag))", 9))
def ljung_box(spark, d):
    res, spec = _residuals(spark, d)
    return st.portmanteau(st.acf(res.where("resid IS NOT NULL"), spec, "resid", 10), spec, 10, 1)


def _interp_sql(x, table):
    cases = [f"WHEN {x} <= {table[0][0]} THEN {table[0][1]}"]
    for (x0, p0), (x1, p1) in zip(table, table[1:]):
        cases.append(f"WHEN {x} <= {x1} THEN {p0} + ({x} - ({x0})) * (({p1} - {p0}) / ({x1} - ({x0})))")
    return f"CASE WHEN {x} IS NULL THEN NULL {' '.join(cases)} ELSE {table[-1][1]} END"


def kpss_cte(name, src, keys, y):
    return acf_cte(f"{name}_a", src, keys, y, 12) + f""",
{name}_s AS (SELECT {keys}, sum(s * s) AS ss FROM (SELECT {keys}, sum(x) OVER (PARTITION BY {keys} ORDER BY t) AS s FROM {name}_a_c) GROUP BY ALL),
{name}_v AS (SELECT {keys}, n, c0 / n + sum(CASE WHEN lag <= l THEN 2 * (1 - lag / (l + 1)) * acf * c0 ELSE 0 END) / n AS lrv FROM (
   SELECT a.*, z.c0, floor(4 * pow(a.n / 100, 0.25)) AS l FROM {name}_a a JOIN {name}_a_0 z USING ({keys})) GROUP BY {keys}, n, c0),
{name} AS (SELECT {keys}, ss / (n * n) / nullif(lrv, 0) AS kpss_stat FROM {name}_s JOIN {name}_v USING ({keys})),
{name}_p AS (SELECT *, {_interp_sql('kpss_stat', st.KPSS_TABLE)} AS kpss_pvalue FROM {name})"""


@query("kpss", with_ctes(SD, kpss_cte("kp", "sd", "flag", "y"), body="SELECT flag, kpss_stat, kpss_pvalue FROM kp_p"))
def kpss(spark, d):
    df, spec = ship_daily(spark, d)
    return st.kpss(df, spec, "y")


_KINDS = """kd AS (SELECT priority, 0 AS d, t, y AS v FROM om
  UNION ALL SELECT priority, 1, t, v FROM (SELECT priority, t, y - lag(y) OVER (PARTITION BY priority ORDER BY t) AS v FROM om) WHERE v IS NOT NULL
  UNION ALL SELECT priority, 2, t, v FROM (SELECT priority, t, y - 2 * lag(y) OVER (PARTITION BY priority ORDER BY t)
      + lag(y, 2) OVER (PARTITION BY priority ORDER BY t) AS v FROM om) WHERE v IS NOT NULL)"""


@query("ndiffs", with_ctes(OM, _KINDS, kpss_cte("kp", "kd", "priority, d", "v"), body="""SELECT priority,
  CAST(coalesce(min(d) FILTER (kpss_pvalue >= 0.05), 2) AS INTEGER) AS ndiffs FROM kp_p GROUP BY priority"""))
def ndiffs(spark, d):
    df, spec = orders_monthly(spark, d)
    return st.ndiffs(df, spec, "y")


@query("pp", with_ctes(OM, """lg AS (SELECT priority, t, y, lag(y) OVER (PARTITION BY priority ORDER BY t) AS l FROM om),
rg AS (SELECT priority, regr_slope(y, l) AS b, regr_intercept(y, l) AS a, regr_sxx(y, l) AS sxx FROM lg GROUP BY 1),
re AS (SELECT priority, t, y - a - b * l AS e FROM lg JOIN rg USING (priority) WHERE l IS NOT NULL),
c0 AS (SELECT priority, count(e) AS n, sum(e * e) AS c0, floor(4 * pow(count(e) / 100, 0.25)) AS lg FROM re GROUP BY 1),
ck AS (SELECT a.priority, k.k, sum(a.e * b.e) AS ck FROM re a JOIN (SELECT unnest(range(1, 13)) AS k) k ON true
       JOIN re b ON a.priority = b.priority AND a.t = b.t + k.k GROUP BY ALL),
lr AS (SELECT priority, any_value(n) AS n, any_value(c0) AS c0, (any_value(c0) + sum(CASE WHEN k <= lg THEN 2 * (1 - k / (lg + 1)) * ck ELSE 0 END)) / any_value(n) AS lam2
       FROM c0 JOIN ck USING (priority) GROUP BY 1),
st AS (SELECT priority, sqrt(c0 / n / lam2) * (b - 1) / sqrt(c0 / (n - 2) / sxx)
    - (lam2 - c0 / n) * n * sqrt(c0 / (n - 2) / sxx) / (2 * sqrt(lam2) * sqrt(c0 / (n - 2))) AS pp_stat FROM lr JOIN rg USING (priority))""",
    body=f"SELECT priority, pp_stat, {_interp_sql('pp_stat', st.PP_TABLE)} AS pp_pvalue FROM st"))
def pp(spark, d):
    df, spec = orders_monthly(spark, d)
    return st.pp(df, spec, "y")


# ---- features ----------------------------------------------------------

@query("quantiles", with_ctes(SD, body="SELECT flag, " + ", ".join(
    f"quantile_cont(y, {p / 100}) AS q{p}" for p in (0, 25, 50, 75, 100)) + " FROM sd GROUP BY flag"))
def quantiles(spark, d):
    df, spec = ship_daily(spark, d)
    return ft.quantiles(df, spec, "y")


_KACF = acf_cte("ka", "kd", "priority, d", "v", 12)


@query("feat_acf", with_ctes(OM, _KINDS, _KACF, body="SELECT priority, " + ", ".join(
    f"max(acf) FILTER (d = {k} AND lag = 1) AS {p}acf1, sum(acf * acf) FILTER (d = {k} AND lag <= 10) AS {p}acf10"
    for k, p in ((0, ""), (1, "diff1_"), (2, "diff2_"))) + ", max(acf) FILTER (d = 0 AND lag = 12) AS season_acf1 FROM ka GROUP BY priority"))
def feat_acf(spark, d):
    df, spec = orders_monthly(spark, d)
    return ft.feat_acf(ft.acf_kinds(df, spec, "y"), spec)


@query("feat_pacf", "WITH RECURSIVE " + ",\n".join([OM, _KINDS, _KACF, pacf_cte("pc", "ka", "priority, d", 12)]) + "\nSELECT priority, " + ", ".join(
    f"sum(a * a) FILTER (d = {k} AND k <= 5) AS {p}pacf5" for k, p in ((0, ""), (1, "diff1_"), (2, "diff2_")))
    + ", max(a) FILTER (d = 0 AND k = 12) AS season_pacf FROM pc GROUP BY priority")
def feat_pacf(spark, d):
    df, spec = orders_monthly(spark, d)
    return ft.feat_pacf(ft.acf_kinds(df, spec, "y"), spec)


@query("guerrero", with_ctes(OM, """bl AS (SELECT priority, (tl - t) // 12 AS b, avg(y) AS m, stddev_samp(y) AS s, count(*) AS n FROM (
   SELECT *, max(t) OVER (PARTITION BY priority) AS tl FROM om) GROUP BY ALL HAVING count(*) = 12 AND avg(y) > 0),
cv AS (SELECT priority, lam, stddev_samp(s / pow(m, 1 - lam)) / avg(s / pow(m, 1 - lam)) AS cv FROM bl
   JOIN (SELECT CAST(round(-0.9 + 0.1 * unnest(range(0, 30)), 1) AS DOUBLE) AS lam) g ON true GROUP BY ALL)""",
    body="SELECT priority, arg_min(lam, cv) AS lambda_guerrero FROM cv GROUP BY priority"))
def guerrero(spark, d):
    df, spec = orders_monthly(spark, d)
    return ft.guerrero(df, spec, "y")


@query("var_tiled", with_ctes(SD, """z AS (SELECT flag, (t - min(t) OVER w) // 7 AS b, (y - avg(y) OVER w) / stddev_samp(y) OVER w AS z FROM sd
  WINDOW w AS (PARTITION BY flag)), bl AS (SELECT flag, b, avg(z) AS m, var_samp(z) AS v FROM z GROUP BY ALL)""",
    body="SELECT flag, var_samp(m) AS var_tiled_mean, var_samp(v) AS var_tiled_var FROM bl GROUP BY flag"))
def var_tiled(spark, d):
    df, spec = ship_daily(spark, d)
    return ft.tiled(df, spec, "y")


_BIN = "CAST(least(floor((y - lo) / nullif((hi - lo) / 10, 0)), 9) AS BIGINT)"


@query("shifts", with_ctes(SD, f"""b AS (SELECT *, {_BIN} AS bin FROM (SELECT *, min(y) OVER (PARTITION BY flag) AS lo, max(y) OVER (PARTITION BY flag) AS hi FROM sd)),
w AS (SELECT flag, row_number() OVER o AS i, count(*) OVER p AS n0, count(*) OVER a AS n1, abs(avg(y) OVER a - avg(y) OVER p) AS lv,
   abs(var_samp(y) OVER a - var_samp(y) OVER p) AS vr, list(bin) OVER p AS h0, list(bin) OVER a AS h1 FROM b
   WINDOW o AS (PARTITION BY flag ORDER BY t), p AS (PARTITION BY flag ORDER BY t ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
     a AS (PARTITION BY flag ORDER BY t ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING)),
k AS (SELECT *, list_sum(list_transform(range(0, 10), lambda b: (len(list_filter(h0, lambda v: v = b)) + 0.5) / 12.0
   * ln((len(list_filter(h0, lambda v: v = b)) + 0.5) / (len(list_filter(h1, lambda v: v = b)) + 0.5)))) AS kl FROM w WHERE n0 = 7 AND n1 = 7)""",
    body="""SELECT flag, max(lv) AS shift_level_max, max(vr) AS shift_var_max, max(kl) AS shift_kl_max FROM k GROUP BY flag"""))
def shifts(spark, d):
    df, spec = ship_daily(spark, d)
    out = ft.shifts(df, spec, "y")
    return out.select("flag", "shift_level_max", "shift_var_max", "shift_kl_max")


@query("shift_index", with_ctes(OM, """w AS (SELECT priority, row_number() OVER o AS i, count(*) OVER p AS n0, count(*) OVER a AS n1,
   abs(avg(y) OVER a - avg(y) OVER p) AS lv, abs(var_samp(y) OVER a - var_samp(y) OVER p) AS vr FROM om
   WINDOW o AS (PARTITION BY priority ORDER BY t), p AS (PARTITION BY priority ORDER BY t ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING),
     a AS (PARTITION BY priority ORDER BY t ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING))""",
    body="SELECT priority, arg_max(i, lv) AS shift_level_index, arg_max(i, vr) AS shift_var_index FROM w WHERE n0 = 12 AND n1 = 12 GROUP BY priority"))
def shift_index(spark, d):
    df, spec = orders_monthly(spark, d)
    return ft.shifts(df, spec, "y").select("priority", "shift_level_index", "shift_var_index")


@query("n_crossing_points", with_ctes(SD, """u AS (SELECT flag, t, y <= quantile_cont(y, 0.5) OVER (PARTITION BY flag) AS u FROM sd),
  l AS (SELECT flag, u, lag(u) OVER (PARTITION BY flag ORDER BY t) AS p FROM u)""",
    body="SELECT flag, count(*) FILTER (u <> p) AS n_crossing_points FROM l GROUP BY flag"))
def n_crossing_points(spark, d):
    df, spec = ship_daily(spark, d)
    return ft.crossing_points(df, spec, "y")


@query("longest_flat_spot", with_ctes(SD, f"""b AS (SELECT flag, t, coalesce({_BIN}, 0) AS bin FROM (SELECT *, min(y) OVER (PARTITION BY flag) AS lo, max(y) OVER (PARTITION BY flag) AS hi FROM sd)),
  r AS (SELECT flag, bin, t - row_number() OVER (PARTITION BY flag, bin ORDER BY t) AS g FROM b), c AS (SELECT flag, count(*) AS n FROM r GROUP BY flag, bin, g)""",
    body="SELECT flag, max(n) AS longest_flat_spot FROM c GROUP BY flag"))
def longest_flat_spot(spark, d):
    df, spec = ship_daily(spark, d)
    return ft.flat_spot(df, spec, "y")


@query("intermittency", with_ctes(UD, """z AS (SELECT *, y = 0 AS z, t - row_number() OVER (PARTITION BY user_id, event_type, y = 0 ORDER BY t) AS g,
   min(t) OVER w AS t0, max(t) OVER w AS t1 FROM ud WINDOW w AS (PARTITION BY user_id, event_type)),
  r AS (SELECT user_id, event_type, z, count(*) AS n, min(t) = any_value(t0) AS is_first, max(t) = any_value(t1) AS is_last FROM z GROUP BY user_id, event_type, z, g),
  a AS (SELECT user_id, event_type, coalesce(avg(n) FILTER (z), 0) AS zero_run_mean, coalesce(max(n) FILTER (z AND is_first), 0) / sum(n) AS zero_start_prop,
   coalesce(max(n) FILTER (z AND is_last), 0) / sum(n) AS zero_end_prop FROM r GROUP BY ALL),
  v AS (SELECT user_id, event_type, var_samp(y) / (avg(y) * avg(y)) AS nonzero_squared_cv FROM ud WHERE y <> 0 GROUP BY ALL)""",
    body="SELECT * FROM a JOIN v USING (user_id, event_type)"))
def intermittency(spark, d):
    df, spec = user_daily(spark, d)
    return ft.intermittency(df, spec, "y")


_ARCH = ", ".join(f"lag(q, {k}) OVER w AS q{k}" for k in range(1, 13))


@query("stat_arch_lm", with_ctes(OM, f"""cq AS (SELECT priority, t, pow(y - avg(y) OVER (PARTITION BY priority), 2) AS q FROM om),
lq AS (SELECT priority, t, q, {_ARCH} FROM cq WINDOW w AS (PARTITION BY priority ORDER BY t))""", ols_ctes("ols", "lq", "priority", [f"q{k}" for k in range(1, 13)], "q"),
    body="SELECT priority, 1 - sse / sst AS stat_arch_lm FROM ols").replace("WITH ", "WITH RECURSIVE ", 1))
def stat_arch_lm(spark, d):
    df, spec = orders_monthly(spark, d)
    return st.arch_lm(df, spec, "y")


@query("spectral_entropy")
def spectral_entropy(spark, d):
    df, spec = orders_monthly(spark, d)
    return ft.spectral_entropy(st.acf(df, spec, "y", 18), spec)


@query("coef_hurst", with_ctes(SD, """b AS (SELECT flag, s, (t - t0) // s AS b, avg(y) AS m, count(*) AS n FROM (SELECT *, min(t) OVER (PARTITION BY flag) AS t0 FROM sd)
  JOIN (SELECT unnest([1, 2, 4, 8, 16]) AS s) g ON true GROUP BY ALL), v AS (SELECT flag, s, var_samp(m) AS v FROM b WHERE n = s GROUP BY ALL)""",
    body="SELECT flag, 1 + regr_slope(ln(v), ln(s)) / 2 AS coef_hurst FROM v GROUP BY flag"))
def coef_hurst(spark, d):
    df, spec = ship_daily(spark, d)
    return ft.hurst(df, spec, "y")


def _draw(kind):
    return f"((('0x' || substr(md5('30|{kind}|' || priority || '|' || t), 1, 8))::BIGINT + 0.5) / 4294967296.0)"


@query("white_noise", with_ctes(OM, body=f"SELECT priority, month, sqrt(-2 * ln({_draw('u')})) * cos(2 * pi() * {_draw('v')}) AS wn FROM om"))
def white_noise(spark, d):
    df, _ = orders_monthly(spark, d)
    return df.select("priority", "month", normal(30, F.col("priority"), F.col("t")).alias("wn"))
