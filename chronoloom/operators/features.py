"""One-row-per-series features."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from chronoloom.operators.blocks import lag_columns, running_sums, windowed
from chronoloom.operators.quantile import group_quantiles
from chronoloom.operators.stats import acf, differenced_kinds, levinson, partial_from
from chronoloom.series import SeriesSpec

LAMBDAS = [round(-0.9 + 0.1 * i, 1) for i in range(30)]


def quantiles(df: DataFrame, spec: SeriesSpec, y: str) -> DataFrame:
    return group_quantiles(df, spec.by, y, {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q100": 1.0})


def _squares(r: Column, n: int) -> Column:
    return F.aggregate(F.slice(r, 1, n), F.lit(0.0), lambda s, v: s + v * v)


def acf_kinds(df: DataFrame, spec: SeriesSpec, y: str) -> DataFrame:
    """Autocorrelations of the series and its differences, long by ``d``."""
    kinds, kspec = differenced_kinds(df, spec, y)
    return acf(kinds, kspec, y, max(10, int(round(spec.m))))


def _by_kind(arrays: DataFrame, spec: SeriesSpec, cols: dict[int, dict[str, Column]]) -> DataFrame:
    return arrays.groupBy(*spec.by).agg(*[
        F.max(F.when(F.col("d") == d, c)).alias(name) for d, named in cols.items() for name, c in named.items()])


def feat_acf(arrays: DataFrame, spec: SeriesSpec) -> DataFrame:
    r, m = F.col("r"), int(round(spec.m))
    pair = {d: {f"{p}acf1": r[0], f"{p}acf10": _squares(r, 10)} for d, p in ((0, ""), (1, "diff1_"), (2, "diff2_"))}
    if m > 1:
        pair[0]["season_acf1"] = r[m - 1]
    return _by_kind(arrays, spec, pair)


def feat_pacf(arrays: DataFrame, spec: SeriesSpec) -> DataFrame:
    m = int(round(spec.m))
    base = arrays.withColumn("_p", partial_from(F.col("r")))
    p = F.col("_p")
    named = {d: {f"{x}pacf5": _squares(p, 5)} for d, x in ((0, ""), (1, "diff1_"), (2, "diff2_"))}
    if m > 1:
        named[0]["season_pacf"] = p[m - 1]
    return _by_kind(base, spec, named)


def guerrero(df: DataFrame, spec: SeriesSpec, y: str) -> DataFrame:
    """Box-Cox exponent with the steadiest block spread, on a grid."""
    m = max(2, int(round(spec.m)))
    last = df.groupBy(*spec.by).agg(F.max(spec.t).alias("_last"))
    blocks = (df.join(last, spec.by)
                .groupBy(*spec.by, F.floor((F.col("_last") - F.col(spec.t)) / m).alias("_b"))
                .agg(F.avg(y).alias("_mean"), F.stddev_samp(y).alias("_sd"), F.count(y).alias("_n"))
                .where((F.col("_n") == m) & (F.col("_mean") > 0)))
    grid = blocks.withColumn("lam", F.explode(F.array(*[F.lit(v) for v in LAMBDAS])))
    ratio = F.col("_sd") / F.pow(F.col("_mean"), 1.0 - F.col("lam"))
    cv = grid.groupBy(*spec.by, "lam").agg((F.stddev_samp(ratio) / F.avg(ratio)).alias("_cv"))
    return cv.groupBy(*spec.by).agg(F.min_by("lam", F.col("_cv")).alias("lambda_guerrero"))


def origin(df: DataFrame, spec: SeriesSpec, y: str) -> DataFrame:
    """Rows with the series start, mean and standard deviation attached."""
    stats = df.groupBy(*spec.by).agg(F.min(spec.t).alias("_t0"), F.avg(y).alias("_mu"), F.stddev_samp(y).alias("_sd"))
    return df.select(*spec.by, spec.t, y).join(stats, spec.by)


def tiled(df: DataFrame, spec: SeriesSpec, y: str) -> DataFrame:
    """Variance of the block means and of the block variances (scaled series)."""
    b = int(round(spec.m)) if spec.m > 1 else 10
    z = (F.col(y) - F.col("_mu")) / F.nullif(F.col("_sd"), F.lit(0.0))
    blocks = (origin(df, spec, y).withColumn("_z", z)
              .groupBy(*spec.by, F.floor((F.col(spec.t) - F.col("_t0")) / b).alias("_b"))
              .agg(F.avg("_z").alias("_m"), F.var_samp("_z").alias("_v")))
    return blocks.groupBy(*spec.by).agg(F.var_samp("_m").alias("var_tiled_mean"), F.var_samp("_v").alias("var_tiled_var"))


def shifts(df: DataFrame, spec: SeriesSpec, y: str, bins: int = 10) -> DataFrame:
    """Largest change of mean, variance and histogram between adjacent windows.

    The divergence compares histograms on ``bins`` equal-width bins of the
    series range, with half a count added to each bin.
    """
    w = int(round(spec.m)) if spec.m > 1 else 10
    rng = df.groupBy(*spec.by).agg(F.min(y).alias("_lo"), F.max(y).alias("_hi"), F.min(spec.t).alias("_t0"))
    base = df.select(*spec.by, spec.t, y).join(rng, spec.by)
    base = base.withColumn("_bin", F.least(F.floor((F.col(y) - F.col("_lo")) / F.nullif((F.col("_hi") - F.col("_lo")) / bins, F.lit(0.0))), F.lit(bins - 1)))

    def past(win):
        return win.rowsBetween(-w, -1)

    def ahead(win):
        return win.rowsBetween(0, w - 1)

    cols = {
        "_n0": lambda x: F.count(y).over(past(x)), "_n1": lambda x: F.count(y).over(ahead(x)),
        "_m0": lambda x: F.avg(y).over(past(x)), "_m1": lambda x: F.avg(y).over(ahead(x)),
        "_v0": lambda x: F.var_samp(y).over(past(x)), "_v1": lambda x: F.var_samp(y).over(ahead(x)),
        "_h0": lambda x: F.collect_list("_bin").over(past(x)), "_h1": lambda x: F.collect_list("_bin").over(ahead(x)),
    }
    out = windowed(base, spec, cols, before=w, after=w).where((F.col("_n0") == w) & (F.col("_n1") == w))

    def share(h, b):
        return (F.size(F.filter(h, lambda v: v == b)) + 0.5) / (w + bins / 2)

    kl = F.aggregate(F.sequence(F.lit(0), F.lit(bins - 1)), F.lit(0.0),
                     lambda s, b: s + share(F.col("_h0"), b) * F.log(share(F.col("_h0"), b) / share(F.col("_h1"), b)))
    out = out.select(*spec.by, (F.col(spec.t) - F.col("_t0") + 1).alias("_i"),
                     F.abs(F.col("_m1") - F.col("_m0")).alias("_level"), F.abs(F.col("_v1") - F.col("_v0")).alias("_var"),
                     kl.alias("_kl"))

    def top(c):
        return F.max(F.struct(F.col(c).alias("v"), (-F.col("_i")).alias("i")))

    best = out.groupBy(*spec.by).agg(top("_level").alias("l"), top("_var").alias("v"), top("_kl").alias("k"))
    return best.select(*spec.by, F.col("l.v").alias("shift_level_max"), (-F.col("l.i")).alias("shift_level_index"),
                       F.col("v.v").alias("shift_var_max"), (-F.col("v.i")).alias("shift_var_index"),
                       F.col("k.v").alias("shift_kl_max"), (-F.col("k.i")).alias("shift_kl_index"))


def crossing_points(df: DataFrame, spec: SeriesSpec, y: str) -> DataFrame:
    """Times the series crosses its median."""
    med = group_quantiles(df, spec.by, y, {"_med": 0.5})
    base = df.select(*spec.by, spec.t, y).join(med, spec.by).withColumn("_u", (F.col(y) <= F.col("_med")).cast("int"))
    base = lag_columns(base, spec, {"_pu": ("_u", 1)})
    return base.groupBy(*spec.by).agg(F.count_if(F.col("_u") != F.col("_pu")).alias("n_crossing_points"))


def _runs(df: DataFrame, spec: SeriesSpec, label: str) -> DataFrame:
    """Number the runs of equal ``label`` along time (``_run``)."""
    base = lag_columns(df, spec, {"_prev": (label, 1)})
    change = F.when(F.col(label) == F.col("_prev"), 0).otherwise(1)
    return running_sums(base, spec.by, spec.t, {"_run": change})


def flat_spot(df: DataFrame, spec: SeriesSpec, y: str, bins: int = 10) -> DataFrame:
    """Longest run inside one of ten equal-width bins."""
    rng = df.groupBy(*spec.by).agg(F.min(y).alias("_lo"), F.max(y).alias("_hi"))
    bin_no = F.least(F.floor((F.col(y) - F.col("_lo")) / F.nullif((F.col("_hi") - F.col("_lo")) / bins, F.lit(0.0))), F.lit(bins - 1))
    base = df.select(*spec.by, spec.t, y).join(rng, spec.by).withColumn("_bin", F.coalesce(bin_no, F.lit(0)))
    runs = _runs(base, spec, "_bin").groupBy(*spec.by, "_run").agg(F.count("*").alias("_len"))
    return runs.groupBy(*spec.by).agg(F.max("_len").alias("longest_flat_spot"))


def intermittency(df: DataFrame, spec: SeriesSpec, y: str) -> DataFrame:
    """Shape of the zeros: mean run, CV^2 of the rest, leading/trailing share."""
    base = df.select(*spec.by, spec.t, y).withColumn("_z", (F.col(y) == 0).cast("int"))
    runs = _runs(base, spec, "_z").groupBy(*spec.by, "_run").agg(
        F.count("*").alias("_len"), F.max("_z").alias("_z"), F.sum(y).alias("_s"), F.sum(F.col(y) * F.col(y)).alias("_ss"))
    ends = runs.groupBy(*spec.by).agg(
        F.avg(F.when(F.col("_z") == 1, F.col("_len"))).alias("_zrm"), F.sum("_len").alias("_n"),
        F.sum(F.when(F.col("_z") == 0, F.col("_len"))).alias("_nz"), F.sum("_s").alias("_s"), F.sum("_ss").alias("_ss"),
        F.min_by(F.struct("_z", "_len"), "_run").alias("_first"), F.max_by(F.struct("_z", "_len"), "_run").alias("_last"))
    mean = F.col("_s") / F.col("_nz")
    var = (F.col("_ss") - F.col("_nz") * mean * mean) / F.nullif(F.col("_nz") - 1, F.lit(0))
    return ends.select(
        *spec.by, F.coalesce("_zrm", F.lit(0.0)).alias("zero_run_mean"), (var / (mean * mean)).alias("nonzero_squared_cv"),
        (F.when(F.col("_first._z") == 1, F.col("_first._len")).otherwise(0) / F.col("_n")).alias("zero_start_prop"),
        (F.when(F.col("_last._z") == 1, F.col("_last._len")).otherwise(0) / F.col("_n")).alias("zero_end_prop"))


def hurst(df: DataFrame, spec: SeriesSpec, y: str, sizes=(1, 2, 4, 8, 16)) -> DataFrame:
    """Long-memory exponent: slope of log variance of block means on log size."""
    base = origin(df, spec, y).withColumn("_size", F.explode(F.array(*[F.lit(s) for s in sizes])))
    means = (base.groupBy(*spec.by, "_size", F.floor((F.col(spec.t) - F.col("_t0")) / F.col("_size")).alias("_b"))
                 .agg(F.avg(y).alias("_m"), F.count(y).alias("_n")).where(F.col("_n") == F.col("_size")))
    var = means.groupBy(*spec.by, "_size").agg(F.var_samp("_m").alias("_v")).where("_v > 0")
    return var.groupBy(*spec.by).agg((1.0 + F.regr_slope(F.log("_v"), F.log("_size")) / 2.0).alias("coef_hurst"))


def spectral_entropy(arrays: DataFrame, spec: SeriesSpec, freqs: int = 250) -> DataFrame:
    """Entropy of the normalised autoregressive spectrum.

    ``arrays`` is an ``acf`` frame; the order minimises AIC over the lags.
    """
    r = F.col("r")
    part = partial_from(r)
    base = arrays.withColumn("_p", part)
    # innovation variance ratio at each order is the running product of 1 - p^2
    steps = F.aggregate("_p", F.struct(F.lit(0).alias("k"), F.lit(1.0).alias("v"), F.lit(0).alias("best"), F.lit(0.0).alias("aic")),
                        lambda s, p: _pick_order(s, p, F.col("n")))
    base = base.withColumn("_order", steps["best"]).withColumn("_phi", levinson(r, F.col("_order")))

    def power(i):
        w = i * (math.pi / freqs)
        re = F.aggregate(F.transform("_phi", lambda c, k: c * F.cos(w * (k + 1))), F.lit(0.0), lambda s, v: s + v)
        im = F.aggregate(F.transform("_phi", lambda c, k: c * F.sin(w * (k + 1))), F.lit(0.0), lambda s, v: s + v)
        return 1.0 / ((1.0 - re) * (1.0 - re) + im * im)

    base = base.withColumn("_s", F.transform(F.sequence(F.lit(0), F.lit(freqs)), power))
    total = F.aggregate("_s", F.lit(0.0), lambda s, v: s + v)
    base = base.withColumn("_tot", total)
    ent = F.aggregate("_s", F.lit(0.0), lambda s, v: s - v / F.col("_tot") * F.log(v / F.col("_tot")))
    return base.select(*spec.by, (ent / math.log(freqs + 1)).alias("spectral_entropy"))


def _pick_order(s: Column, p: Column, n: Column) -> Column:
    v = s["v"] * (1.0 - p * p)
    k = s["k"] + 1
    aic = n * F.log(v) + 2.0 * k
    better = aic < s["aic"]
    return F.struct(k.alias("k"), v.alias("v"), F.when(better, k).otherwise(s["best"]).alias("best"),
                    F.when(better, aic).otherwise(s["aic"]).alias("aic"))


def season_frame(df: DataFrame, spec: SeriesSpec, period: str | int) -> DataFrame:
    """Cycle number and position inside the cycle of a named or whole period."""
    from chronoloom.functions.calendar import NAMED_PERIODS, period_number, period_start
    if isinstance(period, str):
        assert period in NAMED_PERIODS
        out = df.withColumn("cycle", period_number(F.col(spec.index), period))
        start = period_number(period_start(F.col("cycle"), period), spec.unit)
        return out.withColumn("position", F.col(spec.t) - start + 1)
    return df.withColumns({"cycle": F.floor(F.col(spec.t) / period), "position": F.pmod(F.col(spec.t), F.lit(period)) + 1})


def subseries_frame(df: DataFrame, spec: SeriesSpec, y: str, m: int | None = None) -> DataFrame:
    """Rows with their season position and that position's mean."""
    m = m or int(round(spec.m))
    base = df.withColumn("season", F.pmod(F.col(spec.t), F.lit(m)) + 1)
    means = base.groupBy(*spec.by, "season").agg(F.avg(y).alias("season_mean"))
    return base.join(means, [*spec.by, "season"])


def pair_correlations(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Correlation of every pair of the declared columns, one aggregation."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    agg = df.groupBy(*by).agg(*[F.corr(a, b).alias(f"_c{i}") for i, (a, b) in enumerate(pairs)])
    cells = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"_c{i}").alias("corr"))
                      for i, (a, b) in enumerate(pairs)])
    return agg.select(*by, F.explode(cells).alias("_p")).select(*by, "_p.*")


def histogram(df: DataFrame, by: list[str], x: str, bins: int = 30) -> DataFrame:
    """Counts on ``bins`` equal-width bins of each group's range."""
    rng = df.groupBy(*by).agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    base = df.where(F.col(x).isNotNull()).join(rng, by)
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.coalesce(F.least(F.floor((F.col(x) - F.col("_lo")) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1)), F.lit(0))
    return base.groupBy(*by, b.alias("bin")).agg(F.count("*").alias("n"), F.first(F.col("_lo") + width * b).alias("left"))


def join_features(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """One wide row per series; a stack and one grouping instead of many joins."""
    out, names = None, []
    for f in frames:
        cols = [c for c in f.columns if c not in keys]
        names += cols
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out.groupBy(*keys).agg(*[F.max(c).alias(c) for c in names])


def pca_scores(features: DataFrame, keys: list[str], cols: list[str], k: int = 2) -> DataFrame:
    """Standardise, project on the first ``k`` components, scores per series.

    Constant columns carry no information and are left out.
    """
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array
    spread = features.agg(*[F.coalesce(F.stddev_samp(c), F.lit(0.0)).alias(c) for c in cols]).first()
    used = [c for c in cols if spread[c] and spread[c] > 1e-12]
    clean = features.na.fill(0.0, used)
    vec = VectorAssembler(inputCols=used, outputCol="_raw").transform(clean)
    scaled = StandardScaler(inputCol="_raw", outputCol="_std", withMean=True).fit(vec).transform(vec)
    out = PCA(k=k, inputCol="_std", outputCol="_pc").fit(scaled).transform(scaled).withColumn("_pc", vector_to_array("_pc"))
    return out.select(*keys, *cols, *[F.col("_pc")[i].alias(f"pc{i + 1}") for i in range(k)])
