"""Decompositions: classical, loess-based, fixed-filter; and their uses."""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, NumericType, StructField, StructType

from chronoloom.operators.blocks import BLOCK, cut_lineage, halo_frame, windowed
from chronoloom.operators.loess import local_lines, stl_block
from chronoloom.operators.quantile import group_quantiles
from chronoloom.series import SeriesSpec, require_gapless

LOESS_BLOCK = 1024  # smaller than BLOCK: smoothing is heavy per row, so long series are spread wider; 8 reaches at least


def next_odd(x: float) -> int:
    n = ceil(x)
    return n if n % 2 else n + 1


def _constants(values: list[float]) -> Column:
    """A constant array as one expression (cheap to build for long filters)."""
    return F.expr("array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")")


# ---- moving averages ---------------------------------------------------

def weighted_mean(window: Window, t: str, v: str, weights: list[float], keep_ends: bool = True) -> Column:
    """Centred weighted mean of ``v``; near the ends (or next to NULLs) the
    weights that are left are scaled up, or the result is NULL."""
    half = len(weights) // 2
    pts = F.collect_list(F.when(F.col(v).isNotNull(), F.struct(F.col(t).alias("t"), F.col(v).alias("v")))).over(
        window.rowsBetween(-half, half))
    w = _constants(weights)
    sums = F.aggregate(
        pts, F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("b")),
        lambda s, p: F.struct(
            (s["a"] + p["v"] * F.element_at(w, (p["t"] - F.col(t) + half + 1).cast("int"))).alias("a"),
            (s["b"] + F.element_at(w, (p["t"] - F.col(t) + half + 1).cast("int"))).alias("b")))
    value = sums["a"] / F.nullif(sums["b"], F.lit(0.0))
    return value if keep_ends else F.when(F.size(pts) == len(weights), value)


def centred_weights(m: int) -> list[float]:
    """2 x m moving average for even m, plain m for odd."""
    if m % 2:
        return [1.0 / m] * m
    return [0.5 / m] + [1.0 / m] * (m - 1) + [0.5 / m]


def henderson_weights(n_terms: int) -> list[float]:
    """Closed-form symmetric weights of the Henderson trend filter."""
    half = n_terms // 2
    n = half + 2
    n2 = n * n
    den = 8 * n * (n2 - 1) * (4 * n2 - 1) * (4 * n2 - 9) * (4 * n2 - 25)
    return [315.0 * ((n - 1) ** 2 - j * j) * (n2 - j * j) * ((n + 1) ** 2 - j * j) * (3 * n2 - 16 - 11 * j * j) / den
            for j in range(-half, half + 1)]


def _position(spec: SeriesSpec, m: int) -> dict[str, Column]:
    return {"_p": F.pmod(F.col(spec.t), F.lit(m)), "_c": F.floor(F.col(spec.t) / m)}


def _finish(df: DataFrame, spec: SeriesSpec, y: str, multiplicative: bool = False) -> DataFrame:
    if multiplicative:
        rem, adj = F.col(y) / (F.col("trend") * F.col("season")), F.col(y) / F.col("season")
    else:
        rem, adj = F.col(y) - F.col("trend") - F.col("season"), F.col(y) - F.col("season")
    index = [spec.index] if spec.index in df.columns else []
    return df.select(*spec.by, *index, spec.t, y, "trend", "season", rem.alias("remainder"), adj.alias("season_adjust"))


def classical(df: DataFrame, spec: SeriesSpec, y: str, m: int | None = None, kind: str = "additive") -> DataFrame:
    """Centred moving-average trend and constant season."""
    require_gapless(spec, "a decomposition")
    m = m or int(round(spec.m))
    mult = kind == "multiplicative"
    half = m // 2
    w = centred_weights(m)
    base = windowed(df, spec, {"trend": lambda win: weighted_mean(win, spec.t, y, w, keep_ends=False)}, half, half)
    detrended = F.col(y) / F.col("trend") if mult else F.col(y) - F.col("trend")
    base = base.withColumns({"_d": detrended, "_p": F.pmod(F.col(spec.t), F.lit(m))})
    season = base.groupBy(*spec.by, "_p").agg(F.avg("_d").alias("_f"))
    level = season.groupBy(*spec.by).agg(F.avg("_f").alias("_l"))
    season = season.join(level, spec.by).withColumn("season", F.col("_f") / F.col("_l") if mult else F.col("_f") - F.col("_l"))
    out = base.join(season.select(*spec.by, "_p", "season"), [*spec.by, "_p"])
    return _finish(out, spec, y, mult)


# ---- loess -------------------------------------------------------------

def _in_blocks(df: DataFrame, spec: SeriesSpec, reach: int, smooth, names: list[str]) -> DataFrame:
    """Add the columns ``names`` of numpy work on blocks of consecutive periods with ``reach`` periods around them.

    ``smooth(columns)`` gets the columns of a block in order of time as numpy
    arrays and returns one array for each name.
    """
    cut, _ = halo_frame(df, spec.by, spec.t, reach, reach, max(LOESS_BLOCK, 8 * reach))
    fields = [df.schema[c] for c in df.columns if c not in names]
    keep, t = [f.name for f in fields], spec.t
    numbers = [c for c in df.columns if c not in spec.by and isinstance(df.schema[c].dataType, NumericType)]

    def one(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column(t).to_numpy(), kind="stable")
        # a number is a plain array; NULL is NaN
        arrays = {c: table.column(c).to_numpy()[order] for c in numbers}
        home = table.column("_home").to_numpy()[order]
        out = table.select(keep).take(pa.array(order[home]))
        for name, values in zip(names, smooth(arrays)):
            out = out.append_column(name, pa.array(values[home], pa.float64(), from_pandas=True))
        return out

    return cut.groupBy(*spec.by, "_blk").applyInArrow(one, StructType([*fields, *[StructField(n, DoubleType()) for n in names]]))


def loess(df: DataFrame, spec: SeriesSpec, v: str, q: int, out: str, weight: str | None = None) -> DataFrame:
    """Local linear smooth of each series with span ``q`` periods; NULLs weigh nothing."""
    require_gapless(spec, "loess")
    ends = df.groupBy(*spec.by).agg(F.min(spec.t).alias("_from"), F.max(spec.t).alias("_to"))
    base = df.join(ends, spec.by).withColumns({"_v": F.col(v).cast("double"), "_wt": F.col(weight) if weight else F.lit(1.0)})
    t = spec.t

    def smooth(c):
        return [local_lines(c["_v"], c["_wt"], int(c[t][0]), int(c["_from"][0]), int(c["_to"][0]), q, int(c[t][0]), int(c[t][-1]))]

    return _in_blocks(base, spec, q - 1, smooth, [out]).drop("_from", "_to", "_v", "_wt")


def _stl_pass(df: DataFrame, spec: SeriesSpec, m: int, s_window, t_window: int, l_window: int) -> DataFrame:
    """One inner pass over (keys, t, _y, _w, _tr, _lo, _hi): new _se and _tr, with one shuffle of blocks.

    A constant season takes its means over all blocks first.
    """
    base = df.select(*spec.by, spec.t, "_y", "_w", "_lo", "_hi", F.col("_tr").alias("_tr0"))
    constant = s_window == "periodic"
    q = None if constant else int(s_window)
    if constant:
        base = base.withColumn("_p", F.pmod(F.col(spec.t), F.lit(m)))
        means = base.groupBy(*spec.by, "_p").agg(
            (F.sum((F.col("_y") - F.col("_tr0")) * F.col("_w")) / F.nullif(F.sum("_w"), F.lit(0.0))).alias("_f"))
        base = base.join(means, [*spec.by, "_p"]).drop("_p")
    t = spec.t

    def smooth(c):
        return stl_block(int(c[t][0]), c["_y"], c["_w"], c["_tr0"], int(c["_lo"][0]), int(c["_hi"][0]), m, q, l_window, t_window, c.get("_f"))

    reach = (0 if constant else q * m) + 2 * m + l_window + t_window
    return _in_blocks(base, spec, reach, smooth, ["_se", "_tr"]).select(*spec.by, spec.t, "_y", "_w", "_lo", "_hi", "_se", "_tr")


def stl(df: DataFrame, spec: SeriesSpec, y: str, m: int | None = None, s_window=11, t_window: int | None = None,
        robust: bool = False, inner: int = 2, outer: int = 5) -> DataFrame:
    """Seasonal-trend decomposition by loess.

    ``s_window`` is a number of cycles or ``"periodic"``; ``m`` = 1 fits a
    trend only.  Robust fits re-weight by the remainder ``outer`` times.
    """
    require_gapless(spec, "a decomposition")
    m = m or int(round(spec.m))
    s_eff = 10 ** 6 if s_window == "periodic" else s_window
    t_window = t_window or (next_odd(1.5 * m / (1 - 1.5 / s_eff)) if m > 1 else 21)
    l_window = next_odd(m)
    ends = df.groupBy(*spec.by).agg(F.min(spec.t).alias("_lo"), F.max(spec.t).alias("_hi"))
    checked = F.coalesce(F.col(y).cast("double"), F.raise_error(F.lit("a decomposition needs values in every period")).cast("double"))
    cur = df.select(*spec.by, spec.t, checked.alias("_y")).join(ends, spec.by).withColumns(
        {"_w": F.lit(1.0), "_tr": F.lit(0.0), "_se": F.lit(0.0)})

    def run(cur: DataFrame, passes: int) -> DataFrame:
        for _ in range(passes):
            if m > 1:
                cur = _stl_pass(cur, spec, m, s_window, t_window, l_window)
            else:
                cur = loess(cur.drop("_tr"), spec, "_y", t_window, "_tr", "_w")
        return cur

    cur = run(cur, 1 if (robust or m == 1) else inner)
    for _ in range(outer if robust else 0):
        cur = cut_lineage(cur.withColumn("_r", F.abs(F.col("_y") - F.col("_tr") - F.col("_se"))))
        cur = run(_bisquare(cur, spec), 1)
    out = cur.select(*spec.by, spec.t, F.col("_y").alias(y), F.col("_tr").alias("trend"), F.col("_se").alias("season"))
    return _finish(out.withColumn(spec.index, spec.index_expr(F.col(spec.t))), spec, y)


def _bisquare(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Replace ``_w`` by bisquare weights of the absolute remainders ``_r``: 0 from six medians on."""
    med = group_quantiles(df, spec.by, "_r", {"_h": 0.5})
    u = F.col("_r") / F.nullif(6.0 * F.col("_h"), F.lit(0.0))
    bi = F.when(u.isNull() | (u <= 0.001), 1.0).when(u > 0.999, 0.0).otherwise((1.0 - u * u) * (1.0 - u * u))
    return df.join(med, spec.by).withColumn("_w", bi).drop("_r", "_h")


def stl_multi(df: DataFrame, spec: SeriesSpec, y: str, periods: list[int], rounds: int = 2, robust: bool = False,
              outer: int = 3) -> DataFrame:
    """Several seasons: strip one after another, shortest first.

    The rounds take the place of the inner passes: every season is smoothed
    once per round, given the trend and the others of the round before.  Robust
    fits take one such round and ``outer`` more whose weights come from the
    remainder that all seasons leave together, so an outlier counts little in
    every season; what it moved at first goes away over these rounds.
    """
    require_gapless(spec, "a decomposition")
    periods = sorted(periods)
    ends = df.groupBy(*spec.by).agg(F.min(spec.t).alias("_lo"), F.max(spec.t).alias("_hi"))
    checked = F.coalesce(F.col(y).cast("double"), F.raise_error(F.lit("a decomposition needs values in every period")).cast("double"))
    names = [f"season_{p}" for p in periods]
    base = df.select(*spec.by, spec.t, checked.alias("_yy")).join(ends, spec.by).withColumns(
        {"_w": F.lit(1.0), "_t": F.lit(0.0), **{n: F.lit(0.0) for n in names}})

    def all_seasons(base: DataFrame) -> DataFrame:
        for i, (p, name) in enumerate(zip(periods, names)):
            s_window = 11 + 4 * i
            others = sum((F.col(n) for n in names if n != name), F.lit(0.0))
            part = base.select(*spec.by, spec.t, (F.col("_yy") - others).alias("_y"), "_w", F.col("_t").alias("_tr"), "_lo", "_hi")
            part = _stl_pass(part, spec, p, s_window, next_odd(1.5 * p / (1 - 1.5 / s_window)), next_odd(p))
            part = part.select(*spec.by, spec.t, F.col("_se").alias("_s"), F.col("_tr").alias("_t"))
            base = base.drop("_t").join(part, [*spec.by, spec.t]).withColumn(name, F.col("_s")).drop("_s")
            base = cut_lineage(base)
        return base

    total = sum((F.col(n) for n in names), F.lit(0.0))
    for _ in range(1 if robust else rounds):
        base = all_seasons(base)
    for _ in range(outer if robust else 0):
        base = all_seasons(_bisquare(base.withColumn("_r", F.abs(F.col("_yy") - F.col("_t") - total)), spec))
    return base.select(*spec.by, spec.index_expr(F.col(spec.t)).alias(spec.index), spec.t, F.col("_yy").alias(y),
                       F.col("_t").alias("trend"), *names,
                       (F.col("_yy") - F.col("_t") - total).alias("remainder"), (F.col("_yy") - total).alias("season_adjust"))


# ---- fixed filters -----------------------------------------------------

def x11(df: DataFrame, spec: SeriesSpec, y: str, m: int | None = None) -> DataFrame:
    """Additive X-11 filter sequence with fixed weights.

    2 x m trend, 3 x 3 seasonal filter, Henderson trend, 3 x 5 seasonal filter,
    Henderson trend.  Ends use the symmetric weights that are left, rescaled.
    """
    require_gapless(spec, "a decomposition")
    m = m or int(round(spec.m))
    n_h = 13 if m == 12 else next_odd(m + 1)
    half, hh = m // 2, n_h // 2
    s33 = [1 / 9, 2 / 9, 3 / 9, 2 / 9, 1 / 9]
    s35 = [1 / 15, 2 / 15, 3 / 15, 3 / 15, 3 / 15, 2 / 15, 1 / 15]
    base = windowed(df, spec, {"_t1": lambda w: weighted_mean(w, spec.t, y, centred_weights(m), keep_ends=False)}, half, half)

    def seasonal(frame, trend, weights, out):
        frame = frame.withColumns({"_si": F.col(y) - F.col(trend), **_position(spec, m)})
        k = len(weights) // 2
        frame = windowed(frame, spec, {"_raw": lambda w: weighted_mean(w, "_c", "_si", weights)}, k, k, by=[*spec.by, "_p"], t="_c",
                         block=max(1, BLOCK // m))
        frame = windowed(frame, spec, {"_lvl": lambda w: weighted_mean(w, spec.t, "_raw", centred_weights(m))}, half, half)
        return frame.withColumn(out, F.col("_raw") - F.col("_lvl"))

    def trend(frame, season, out):
        frame = frame.withColumn("_sa", F.col(y) - F.col(season))
        return windowed(frame, spec, {out: lambda w: weighted_mean(w, spec.t, "_sa", henderson_weights(n_h))}, hh, hh)

    base = trend(seasonal(base, "_t1", s33, "_s1"), "_s1", "_t2")
    base = trend(seasonal(base, "_t2", s35, "season"), "season", "trend")
    return _finish(base, spec, y)


# ---- uses of a decomposition -------------------------------------------

def strengths(dcmp: DataFrame, spec: SeriesSpec, m: int | None = None) -> DataFrame:
    """Trend and seasonal strength, peaks, spikiness, linearity, curvature.

    Season positions run 1..m, counted from the period number (January = 1).
    """
    m = m or int(round(spec.m))
    stats = dcmp.groupBy(*spec.by).agg(F.avg("remainder").alias("_rm"), F.min(spec.t).alias("_t0"), F.count("*").alias("_n"))
    base = dcmp.join(stats, spec.by)
    r = F.col("remainder") - F.col("_rm")
    c = F.col(spec.t) - F.col("_t0") - (F.col("_n") - 1) / 2.0
    q = c * c - (F.col("_n") * F.col("_n") - 1) / 12.0
    agg = base.groupBy(*spec.by).agg(
        F.var_samp("remainder").alias("_vr"), F.var_samp(F.col("trend") + F.col("remainder")).alias("_vt"),
        F.var_samp(F.col("season") + F.col("remainder")).alias("_vs"), F.var_samp(r * r).alias("_v4"),
        F.sum(F.col("trend") * c).alias("_lin"), F.sum(F.col("trend") * q).alias("_cur"), F.first("_n").alias("_n"))
    pos = dcmp.groupBy(*spec.by, (F.pmod(F.col(spec.t), F.lit(m)) + 1).alias("_p")).agg(F.avg("season").alias("_s"))
    peaks = pos.groupBy(*spec.by).agg(F.max_by("_p", "_s").alias("seasonal_peak"), F.min_by("_p", "_s").alias("seasonal_trough"))
    n = F.col("_n").cast("double")

    def strength(v):
        return F.greatest(F.lit(0.0), 1.0 - F.col("_vr") / F.nullif(F.col(v), F.lit(0.0)))

    return agg.join(peaks, spec.by).select(
        *spec.by, strength("_vt").alias("trend_strength"), strength("_vs").alias("seasonal_strength"), "seasonal_peak", "seasonal_trough",
        (F.col("_v4") / ((n - 2) * (n - 2))).alias("spikiness"),
        (F.col("_lin") / F.sqrt(n * (n * n - 1) / 12.0)).alias("linearity"),
        (F.col("_cur") / F.sqrt(n * (n * n - 1) * (n * n - 4) / 180.0)).alias("curvature"))


def nsdiffs(strength: DataFrame, spec: SeriesSpec, limit: float = 0.64) -> DataFrame:
    return strength.select(*spec.by, F.when(F.col("seasonal_strength") > limit, 1).otherwise(0).alias("nsdiffs"))


def neighbours(df: DataFrame, spec: SeriesSpec, y: str) -> DataFrame:
    """Nearest known value before and after each row: structs _pv, _nx (t, v)."""
    known = F.when(F.col(y).isNotNull(), F.struct(F.col(spec.t).alias("t"), F.col(y).cast("double").alias("v")))
    base = df.withColumns({"_k": known, "_blk": F.floor(F.col(spec.t) / BLOCK)})
    edges = base.groupBy(*spec.by, "_blk").agg(F.max_by("_k", F.when(F.col("_k").isNotNull(), F.col(spec.t))).alias("_e1"),
                                               F.min_by("_k", F.when(F.col("_k").isNotNull(), F.col(spec.t))).alias("_e0"))
    w = Window.partitionBy(*spec.by).orderBy("_blk")
    edges = edges.select(*spec.by, "_blk",
                         F.last("_e1", True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("_b1"),
                         F.first("_e0", True).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("_b0"))
    inner = Window.partitionBy(*spec.by, "_blk").orderBy(spec.t)
    base = base.withColumns({
        "_pv": F.last("_k", True).over(inner.rowsBetween(Window.unboundedPreceding, 0)),
        "_nx": F.first("_k", True).over(inner.rowsBetween(0, Window.unboundedFollowing))})
    out = base.join(edges, [*spec.by, "_blk"])
    return out.withColumns({"_pv": F.coalesce("_pv", "_b1"), "_nx": F.coalesce("_nx", "_b0")}).drop("_k", "_blk", "_b0", "_b1")


def interpolate(df: DataFrame, spec: SeriesSpec, y: str, out: str | None = None) -> DataFrame:
    """Fill NULLs by the random-walk bridge: a straight line across each gap,
    the nearest value beyond the ends."""
    base = neighbours(df, spec, y)
    share = (F.col(spec.t) - F.col("_pv.t")) / F.nullif(F.col("_nx.t") - F.col("_pv.t"), F.lit(0))
    line = F.col("_pv.v") + (F.col("_nx.v") - F.col("_pv.v")) * share
    return base.withColumn(out or y, F.coalesce(F.col(y).cast("double"), line, F.col("_pv.v"), F.col("_nx.v"))).drop("_pv", "_nx")


def clean_outliers(df: DataFrame, spec: SeriesSpec, y: str, m: int | None = None, k: float = 3.0) -> DataFrame:
    """Robust decomposition, k-IQR rule on the remainder, bridge the holes.

    Adds ``outlier`` and ``clean``.
    """
    dcmp = cut_lineage(stl(df, spec, y, m, s_window="periodic", robust=True))
    q = group_quantiles(dcmp, spec.by, "remainder", {"_q1": 0.25, "_q3": 0.75})
    iqr = F.col("_q3") - F.col("_q1")
    flagged = dcmp.join(q, spec.by).withColumn(
        "outlier", (F.col("remainder") < F.col("_q1") - k * iqr) | (F.col("remainder") > F.col("_q3") + k * iqr))
    holes = flagged.withColumn("_v", F.when(~F.col("outlier"), F.col(y)))
    return interpolate(holes, spec, "_v", "clean").select(*spec.by, spec.index, spec.t, y, "remainder", "outlier", "clean")
