"""Autocorrelation and the tests built on it.

Autocovariances of all lags come from one ordered pass: lag columns inside
time blocks, then one partial aggregation per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chronoloom.functions.special import chi2_tail
from chronoloom.operators.blocks import lag_columns, running_sums
from chronoloom.series import SeriesSpec

# KPSS level critical values and p-values.
KPSS_TABLE = [(0.347, 0.10), (0.463, 0.05), (0.574, 0.025), (0.739, 0.01)]
# Phillips-Perron (constant) critical values and p-values.
PP_TABLE = [(-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)]


def interpolate_p(stat: Column, table) -> Column:
    """Linear interpolation of a p-value, clamped to the table's ends."""
    out = F.when(stat <= table[0][0], F.lit(table[0][1]))
    for (x0, p0), (x1, p1) in zip(table, table[1:]):
        out = out.when(stat <= x1, p0 + (stat - x0) * ((p1 - p0) / (x1 - x0)))
    return F.when(stat.isNotNull(), out.otherwise(F.lit(table[-1][1])))


def centred(df: DataFrame, spec: SeriesSpec, y: str) -> DataFrame:
    stats = df.groupBy(*spec.by).agg(F.avg(y).alias("_mean"), F.count(y).alias("_n"))
    return df.select(*spec.by, spec.t, y).join(stats, spec.by).withColumn("_x", F.col(y) - F.col("_mean"))


def autocov_sums(base: DataFrame, spec: SeriesSpec, x: str, lags: int, extra=()) -> DataFrame:
    """Per key: ``c`` = array of sum(x_t x_{t-k}) for k = 0..lags, and ``n``."""
    lagged = lag_columns(base, spec, {f"_l{k}": (x, k) for k in range(1, lags + 1)})
    sums = [F.sum(F.col(x) * F.col(x))] + [F.coalesce(F.sum(F.col(x) * F.col(f"_l{k}")), F.lit(0.0))
                                           for k in range(1, lags + 1)]
    return lagged.groupBy(*spec.by).agg(F.count(x).alias("n"), F.array(*sums).alias("c"), *extra)


def acf(df: DataFrame, spec: SeriesSpec, y: str, lags: int) -> DataFrame:
    """Per key: ``n`` and ``r``, the autocorrelations at lags 1..lags."""
    out = autocov_sums(centred(df, spec, y), spec, "_x", lags)
    c0 = F.nullif(F.col("c")[0], F.lit(0.0))
    return out.select(*spec.by, "n", F.transform(F.slice("c", 2, lags), lambda v: v / c0).alias("r"))


def acf_table(arrays: DataFrame, spec: SeriesSpec, col: str = "r", name: str = "acf") -> DataFrame:
    return arrays.select(*spec.by, F.posexplode(col).alias("_p", name)).select(
        *spec.by, (F.col("_p") + 1).alias("lag"), name)


def partial_from(r: Column) -> Column:
    """Durbin-Levinson on an autocorrelation array; partials at lags 1..L."""
    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    empty = F.array().cast("array<double>")

    def step(s, k):
        phi = s["phi"]
        a = (r[k - 1] - dot(phi, F.reverse(F.slice(r, F.lit(1), k - 1)))) / (1.0 - dot(phi, F.slice(r, F.lit(1), k - 1)))
        new = F.concat(F.zip_with(phi, F.reverse(phi), lambda p, q: p - a * q), F.array(a))
        return F.struct(new.alias("phi"), F.concat(s["out"], F.array(a)).alias("out"))

    return F.aggregate(F.sequence(F.lit(1), F.size(r)), F.struct(empty.alias("phi"), empty.alias("out")), step)["out"]


def levinson(r: Column, order: Column) -> Column:
    """Autoregressive coefficients of ``order`` from autocorrelations."""
    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    empty = F.array().cast("array<double>")

    def step(phi, k):
        a = (r[k - 1] - dot(phi, F.reverse(F.slice(r, F.lit(1), k - 1)))) / (1.0 - dot(phi, F.slice(r, F.lit(1), k - 1)))
        return F.concat(F.zip_with(phi, F.reverse(phi), lambda p, q: p - a * q), F.array(a))

    return F.when(order < 1, empty).otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(order, F.lit(1))), empty, step))


def pacf(df: DataFrame, spec: SeriesSpec, y: str, lags: int) -> DataFrame:
    return acf(df, spec, y, lags).select(*spec.by, "n", partial_from(F.col("r")).alias("p"))


def portmanteau(arrays: DataFrame, spec: SeriesSpec, lag: int, dof: int = 0, kind: str = "ljung_box") -> DataFrame:
    """Box-Pierce or Ljung-Box statistic and p-value from an ``acf`` frame."""
    r = F.slice("r", 1, lag)
    n = F.col("n")
    if kind == "box_pierce":
        stat = n * F.aggregate(r, F.lit(0.0), lambda s, v: s + v * v)
    else:
        terms = F.transform(r, lambda v, i: v * v / (n - (i + 1)))
        stat = n * (n + 2) * F.aggregate(terms, F.lit(0.0), lambda s, v: s + v)
    return arrays.select(*spec.by, stat.alias("stat")).withColumn("pvalue", chi2_tail(F.col("stat"), lag - dof))


def bartlett_lags(n: int) -> int:
    return int(4 * (n / 100.0) ** 0.25)


def _longest(df: DataFrame, spec: SeriesSpec) -> int:
    row = df.groupBy(*spec.by).agg(F.count("*").alias("n")).agg(F.max("n")).first()
    return int(row[0] or 0)


def _long_run(c: Column, n: Column) -> Column:
    """Bartlett long-run variance from autocovariance sums."""
    lag = F.floor(4.0 * F.pow(n / 100.0, 0.25))
    weighted = F.transform(c, lambda v, i: F.when(i == 0, v).when(i <= lag, 2.0 * v * (1.0 - i / (lag + 1))).otherwise(0.0))
    return F.aggregate(weighted, F.lit(0.0), lambda s, v: s + v) / n


def kpss(df: DataFrame, spec: SeriesSpec, y: str, longest: int | None = None) -> DataFrame:
    """Level-stationarity statistic and p-value (clamped to [.01, .10])."""
    lags = max(1, bartlett_lags(longest or _longest(df, spec)))
    base = running_sums(centred(df, spec, y), spec.by, spec.t, {"_s": F.col("_x")})
    out = autocov_sums(base, spec, "_x", lags, [F.sum(F.col("_s") * F.col("_s")).alias("_ss")])
    lrv = _long_run(F.col("c"), F.col("n"))
    stat = F.col("_ss") / (F.col("n") * F.col("n")) / F.nullif(lrv, F.lit(0.0))
    out = out.select(*spec.by, stat.alias("kpss_stat"))
    return out.withColumn("kpss_pvalue", interpolate_p(F.col("kpss_stat"), KPSS_TABLE))


def pp(df: DataFrame, spec: SeriesSpec, y: str, longest: int | None = None) -> DataFrame:
    """Phillips-Perron Z-tau statistic (constant) and p-value."""
    lags = max(1, bartlett_lags(longest or _longest(df, spec)))
    base = lag_columns(df.select(*spec.by, spec.t, y), spec, {"_l": (y, 1)})
    fit = base.groupBy(*spec.by).agg(
        F.regr_slope(y, "_l").alias("_b"), F.regr_intercept(y, "_l").alias("_a"),
        F.regr_sxx(y, "_l").alias("_sxx"))
    res = base.join(fit, spec.by).withColumn("_e", F.col(y) - F.col("_a") - F.col("_b") * F.col("_l"))
    out = autocov_sums(res, spec, "_e", lags, [F.first("_b").alias("_b"), F.first("_sxx").alias("_sxx")])
    n = F.col("n")
    s2 = F.col("c")[0] / (n - 2)
    g0 = F.col("c")[0] / n
    lam2 = _long_run(F.col("c"), n)
    se = F.sqrt(s2 / F.col("_sxx"))
    tau = (F.col("_b") - 1.0) / se
    stat = F.sqrt(g0 / lam2) * tau - (lam2 - g0) * n * se / (2.0 * F.sqrt(lam2) * F.sqrt(s2))
    out = out.select(*spec.by, stat.alias("pp_stat"))
    return out.withColumn("pp_pvalue", interpolate_p(F.col("pp_stat"), PP_TABLE))


def differenced_kinds(df: DataFrame, spec: SeriesSpec, y: str) -> tuple[DataFrame, SeriesSpec]:
    """The series and its first and second difference as three series."""
    base = lag_columns(df.select(*spec.by, spec.t, y), spec, {"_l1": (y, 1), "_l2": (y, 2)})
    cells = F.array(
        F.struct(F.lit(0).alias("d"), F.col(y).alias("v")),
        F.struct(F.lit(1).alias("d"), (F.col(y) - F.col("_l1")).alias("v")),
        F.struct(F.lit(2).alias("d"), (F.col(y) - 2 * F.col("_l1") + F.col("_l2")).alias("v")))
    out = base.withColumn("_k", F.explode(cells)).where("_k.v IS NOT NULL")
    return (out.select(*spec.by, "_k.d", spec.t, F.col("_k.v").alias(y)),
            spec.with_(keys=(*spec.keys, "d")))


def ndiffs(df: DataFrame, spec: SeriesSpec, y: str, alpha: float = 0.05) -> DataFrame:
    """Fewest differences (0..2) after which KPSS no longer rejects."""
    kinds, kspec = differenced_kinds(df, spec, y)
    tests = kpss(kinds, kspec, y, _longest(df, spec))
    ok = F.min(F.when((F.col("kpss_pvalue") >= alpha) | F.col("kpss_pvalue").isNull(), F.col("d")))
    return tests.groupBy(*spec.by).agg(F.coalesce(ok, F.lit(2)).alias("ndiffs"))


def arch_lm(df: DataFrame, spec: SeriesSpec, y: str, lags: int = 12) -> DataFrame:
    """R^2 of the squared centred series on its own ``lags`` lags."""
    from chronoloom.operators.linalg import gram, solve
    base = centred(df, spec, y).withColumn("_q", F.col("_x") * F.col("_x"))
    base = lag_columns(base.select(*spec.by, spec.t, "_q"), spec, {f"_q{k}": ("_q", k) for k in range(1, lags + 1)})
    base = base.where(F.col(f"_q{lags}").isNotNull()).withColumn("_one", F.lit(1.0))
    fit = solve(gram(base, spec.by, ["_one", *[f"_q{k}" for k in range(1, lags + 1)]], "_q"))
    return fit.select(*spec.by, F.col("r2").alias("stat_arch_lm"))
