"""Exponential smoothing and intermittent demand.

The candidate parameters of every series are scored together: one Arrow batch
carries blocks of series, and the recursion runs once per period for all
candidates as array arithmetic.  States travel from block to block as columns,
so a long series is never held whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from chronoloom.functions.calendar import horizon
from chronoloom.operators.blocks import block_arrays, cut_lineage
from chronoloom.series import SeriesSpec, require_gapless


@dataclass(frozen=True)
class Ets:
    """error A/M, trend N/A/Ad, season N/A/M; ``phi`` fixes the damping."""

    error: str = "A"
    trend: str = "N"
    season: str = "N"
    phi: float | None = None

    @property
    def name(self) -> str:
        return f"ETS({self.error},{self.trend},{self.season})"


# Search ranges of alpha, beta*, gamma* (beta = beta* alpha, gamma = gamma* (1 - alpha)) and phi.
RANGES = {"alpha": (0.0001, 0.9999), "beta": (0.0001, 0.9999), "gamma": (0.0001, 0.9999), "phi": (0.80, 0.98)}
POINTS, ROUNDS, SHRINK = 5, 6, 2.5
WIDTH = 20_000  # candidate rows advanced together


def free_parameters(s: Ets) -> list[str]:
    out = ["alpha"]
    if s.trend != "N":
        out.append("beta")
    if s.season != "N":
        out.append("gamma")
    if s.trend == "Ad" and s.phi is None:
        out.append("phi")
    return out


def grid(s: Ets, centre: dict[str, float] | None, round_no: int) -> np.ndarray:
    """Candidates (rows) x (alpha, beta, gamma, phi) around ``centre``."""
    axes = []
    free = free_parameters(s)
    for p in ("alpha", "beta", "gamma", "phi"):
        lo, hi = RANGES[p]
        if p not in free:
            axes.append(np.array([s.phi if p == "phi" and s.phi else (1.0 if p == "phi" else 0.0)]))
        elif centre is None:
            axes.append(np.linspace(lo, hi, POINTS))
        else:
            half = (hi - lo) / 2.0 / SHRINK ** round_no
            axes.append(np.clip(np.linspace(centre[p] - half, centre[p] + half, POINTS), lo, hi))
    return np.stack([a.ravel() for a in np.meshgrid(*axes, indexing="ij")], axis=1)


def start_state(y: np.ndarray, s: Ets, m: int) -> tuple[float, float, np.ndarray]:
    """Level, slope and season from the first cycles."""
    if s.season == "N" or m < 2 or len(y) < 2 * m:
        n = min(10, len(y))
        if s.trend == "N" or n < 2:
            return float(y[0]), 0.0, np.full(max(m, 1), 1.0 if s.season == "M" else 0.0)
        b, a = np.polyfit(np.arange(1, n + 1), y[:n], 1)
        return float(a), float(b), np.full(max(m, 1), 1.0 if s.season == "M" else 0.0)
    cycles = min(len(y) // m, 5)
    head = y[:cycles * m].reshape(cycles, m)
    means = head.mean(axis=1)
    slope = (means[-1] - means[0]) / ((cycles - 1) * m)
    line = means[:, None] + slope * (np.arange(m) - (m - 1) / 2)[None, :]
    if s.season == "M":
        season = (head / np.where(line == 0, np.nan, line)).mean(axis=0)
        season = np.nan_to_num(season / np.nanmean(season), nan=1.0)
    else:
        season = (head - line).mean(axis=0)
        season = season - season.mean()
    level = means[0] - slope * ((m - 1) / 2 + 1)
    return float(level), float(slope if s.trend != "N" else 0.0), season


def run(y: np.ndarray, p: np.ndarray, state: np.ndarray, s: Ets, m: int, fitted: bool = False):
    """Advance all candidates over ``y``.

    ``state`` has one row per candidate: level, slope, sum of squared errors,
    sum of log |mu|, then the m seasonal values, next season first.  ``y`` may
    hold several series of one length as rows; each owns an equal share of the
    candidate rows, in order.
    """
    alpha, beta, gamma, phi = p.T
    lvl, b, sse, slog = (state[:, i].copy() for i in range(4))
    sea = state[:, 4:].copy()
    k = sea.shape[1]
    many = y if y.ndim == 2 else y[None, :]
    steps, share = many.shape[1], len(p) // len(many)
    out = np.empty(steps) if fitted else None
    for i in range(steps):
        v = many[0, i] if len(many) == 1 else np.repeat(many[:, i], share)
        j = i % k
        base = lvl + phi * b
        sj = sea[:, j]
        mu = base * sj if s.season == "M" else base + sj
        e = v - mu
        with np.errstate(all="ignore"):
            if s.error == "M":
                sse += (e / mu) ** 2
                slog += np.log(np.abs(mu))
            else:
                sse += e * e
            el = e / sj if s.season == "M" else e
            es = e / base if s.season == "M" else e
        lvl, b = base + alpha * el, phi * b + beta * el
        if s.season != "N":
            sea[:, j] = sj + gamma * es
        if fitted:
            out[i] = mu[0]
    shift = steps % k
    sea = np.roll(sea, -shift, axis=1)
    new = np.column_stack([lvl, b, sse, slog, sea])
    return (new, out) if fitted else new


def criterion(state: np.ndarray, n: int, s: Ets) -> np.ndarray:
    """T ln(sum of squares), plus 2 sum ln |mu| for relative errors."""
    with np.errstate(all="ignore"):
        c = n * np.log(np.maximum(state[:, 2], 1e-300))
        if s.error == "M":
            c = c + 2.0 * state[:, 3]
    return np.where(np.isfinite(c), c, np.inf)


def _search(ys: np.ndarray, s: Ets, m: int) -> list[tuple]:
    """Grid search with refinement for series (rows) of one length."""
    starts = []
    for y in ys:
        lvl, b, sea = start_state(y, s, m)
        starts.append(np.concatenate([[lvl, b, 0.0, 0.0], sea]))
    starts = np.array(starts)
    best: list = [None] * len(ys)
    for r in range(ROUNDS if free_parameters(s) else 1):
        cands = [_candidates(s, _as_centre(b[1]) if b else None, r) for b in best]
        g = len(cands[0])
        end = run(ys, np.concatenate(cands), np.repeat(starts, g, axis=0), s, m)
        crit = criterion(end, ys.shape[1], s).reshape(len(ys), g)
        for i, c in enumerate(crit.argmin(axis=1)):
            if best[i] is None or crit[i, c] < best[i][0]:
                best[i] = (float(crit[i, c]), cands[i][c], end[i * g + c], starts[i])
    return best


_OUT = ("array<struct<model:string,crit:double,params:array<double>,state:array<double>,start:array<double>,k:int,"
        "sigma2:double,aic:double,aicc:double,bic:double,m:int>>")


def _fitter(specs: list[Ets], m: int):
    def fit(ys: pd.Series) -> pd.Series:
        rows = [[] for _ in ys]
        data = [np.asarray(y, float) for y in ys]
        lengths: dict[int, list[int]] = {}
        for i, y in enumerate(data):
            lengths.setdefault(len(y), []).append(i)
        for n, members in lengths.items():
            for s in specs:
                use = [i for i in members if _allowed(s, m, n, data[i].min(initial=np.inf))]
                width = max(1, WIDTH // max(1, POINTS ** len(free_parameters(s))))
                for lo in range(0, len(use), width):
                    part = use[lo:lo + width]
                    for i, (crit, p, state, start) in zip(part, _search(np.stack([data[i] for i in part]), s, m)):
                        if np.isfinite(crit):
                            rows[i].append(_row(s, crit, p, state, start, n, m))
        return pd.Series(rows)
    return pandas_udf(fit, _OUT)


def fit_ets(df: DataFrame, spec: SeriesSpec, y: str, specs: list[Ets], m: int | None = None, name: str | None = None,
            block: int | None = None) -> DataFrame:
    """Fit every spec to every series; the lowest AICc wins when several.

    A series that fits one block is searched inside one Arrow row.  Longer
    ones carry all candidates' states from block to block, so the search still
    sees every period while no task holds more than a block.  Both ways start
    from the same first periods, apply the same conditions and take the same
    steps, so where blocks are cut does not change a result.
    """
    require_gapless(spec, "exponential smoothing")
    m = m or max(1, int(round(spec.m)))
    arrays = block_arrays(df.select(*spec.by, spec.t, F.col(y).cast("double").alias("_y")), spec.by, spec.t, ["_y"], block)
    # spread the compute-heavy rows: many short series per task is fine, few tasks is not
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    arrays = arrays.repartition(tasks, *spec.by, "blk").persist()
    first, last = arrays.agg(F.min("blk"), F.max("blk")).first()
    ends = arrays.groupBy(*spec.by).agg(F.sum(F.size("pts")).alias("n"), F.max(F.element_at("pts", -1)[spec.t]).alias("t_last"),
                                        F.min(F.element_at("pts", 1)[spec.t]).alias("t_first"))
    if first == last:
        fit = arrays.select(*spec.by, F.size("pts").cast("long").alias("n"), F.element_at("pts", -1)[spec.t].alias("t_last"),
                            F.element_at("pts", 1)[spec.t].alias("t_first"), _fitter(specs, m)(F.col("pts")["_y"]).alias("_f"))
    else:
        fit = ends
        keys = ends.select(*spec.by, "n", F.col("t_first").alias("_t0"))
        rows = df.select(*spec.by, spec.t, F.col(y).cast("double").alias("_y")).join(keys, spec.by)
        heads = rows.where(F.col(spec.t) < F.col("_t0") + max(10, 5 * m)).groupBy(*spec.by).agg(
            F.array_sort(F.collect_list(F.struct(spec.t, "_y"))).alias("_h"))
        lows = rows.groupBy(*spec.by).agg(F.min("_y").alias("_low"))
        begin = cut_lineage(heads.join(lows, spec.by).join(keys.drop("_t0"), spec.by).select(*spec.by, "n", "_low", F.col("_h._y").alias("_head")))
        for i, s in enumerate(specs):
            fit = fit.join(_search_blocks(arrays, spec, s, m, first, last, begin).withColumnRenamed("_f", f"_f{i}"), spec.by)
        fit = fit.withColumn("_f", F.flatten(F.array(*[F.col(f"_f{i}") for i in range(len(specs))])))
    best = F.array_min(F.transform("_f", lambda x: F.struct(x["aicc"].alias("a"), x.alias("x"))))["x"]
    out = fit.withColumn("_b", best).where("_b IS NOT NULL").select(*spec.by, "n", "t_first", "t_last", "_b.*")
    return out.withColumn("model", F.lit(name)) if name else out


def _candidates(s: Ets, centre, r: int) -> np.ndarray:
    cand = grid(s, centre, r)
    cand[:, 2] = cand[:, 2] * (1.0 - cand[:, 0])        # gamma = gamma* (1 - alpha)
    cand[:, 1] = cand[:, 1] * cand[:, 0]                # beta = beta* alpha
    return cand


def _as_centre(a) -> dict[str, float]:
    return {"alpha": a[0], "beta": a[1] / a[0] if a[0] else 0.0, "gamma": a[2] / (1 - a[0]) if a[0] < 1 else 0.0, "phi": a[3]}


def _allowed(s: Ets, m: int, n: int, low: float) -> bool:
    """Whether a series of ``n`` periods with smallest value ``low`` can have this form."""
    if n < 3 or (s.season != "N" and (m < 2 or n < 2 * m)):
        return False
    return low > 0 or not (s.season == "M" or s.error == "M")


def _search_blocks(arrays: DataFrame, spec: SeriesSpec, s: Ets, m: int, first: int, last: int, heads: DataFrame) -> DataFrame:
    """The same search for series of several blocks: one pass per block and
    round; the candidates' states are the only thing carried."""
    def begin(ys: pd.Series) -> pd.Series:
        return pd.Series([np.concatenate([[l, b, 0.0, 0.0], sea]) for l, b, sea in
                          (start_state(np.asarray(v, float), s, m) for v in ys)])

    def advance(ys: pd.Series, best: pd.Series, rnd: pd.Series, flat: pd.Series) -> pd.Series:
        rows = []
        for v, p, r, f in zip(ys, best, rnd, flat):
            cand = _candidates(s, None if p is None or len(p) == 0 else _as_centre(p), int(r))
            st = np.asarray(f, float)
            st = st.reshape(len(cand), -1) if len(st) % len(cand) == 0 and len(st) > 4 + max(m, 1) else np.tile(st, (len(cand), 1))
            rows.append(run(np.asarray(v, float), cand, st, s, m).ravel())
        return pd.Series(rows)

    def choose(best: pd.Series, rnd: pd.Series, flat: pd.Series, n: pd.Series, start: pd.Series, low: pd.Series) -> pd.Series:
        rows = []
        for p, r, f, ni, st0, lo in zip(best, rnd, flat, n, start, low):
            cand = _candidates(s, None if p is None or len(p) == 0 else _as_centre(p), int(r))
            st = np.asarray(f, float).reshape(len(cand), -1)
            crit = criterion(st, int(ni), s)
            i = int(np.argmin(crit))
            good = np.isfinite(crit[i]) and _allowed(s, m, int(ni), lo)
            rows.append([_row(s, float(crit[i]), cand[i], st[i], np.asarray(st0), int(ni), m)] if good else [])
        return pd.Series(rows)

    state = cut_lineage(heads.select(*spec.by, "n", "_low", pandas_udf(begin, "array<double>")("_head").alias("_st"))
                        .withColumn("_p", F.lit(None).cast("array<double>")))
    step, pick = pandas_udf(advance, "array<double>"), pandas_udf(choose, _OUT)
    for r in range(ROUNDS if free_parameters(s) else 1):
        cur = state.withColumn("_c", F.col("_st"))
        for b in range(first, last + 1):
            joined = cur.join(arrays.where(F.col("blk") == b).select(*spec.by, F.col("pts._y").alias("_v")), spec.by, "left")
            moved = step(F.coalesce("_v", F.array().cast("array<double>")), "_p", F.lit(r), "_c")
            cur = cut_lineage(joined.withColumn("_c", moved).drop("_v"))
        state = cur.withColumn("_f", pick("_p", F.lit(r), "_c", "n", "_st", "_low"))
        state = cut_lineage(state.withColumn("_p", F.get("_f", F.lit(0))["params"]).drop("_c"))
        result = state
        state = state.drop("_f")
    return result.select(*spec.by, "_f")


def _row(s: Ets, crit: float, p, state, start, n: int, m: int) -> dict:
    k = len(free_parameters(s)) + 1 + (s.trend != "N") + (m - 1 if s.season != "N" else 0) + 1
    aic = crit + 2 * k
    aicc = aic + 2 * k * (k + 1) / (n - k - 1) if n > k + 1 else np.inf
    return dict(model=s.name, crit=crit, params=list(map(float, p)), state=list(map(float, state)), start=list(map(float, start)), k=k,
                sigma2=float(state[2]) / max(n - (k - 1), 1), aic=aic, aicc=aicc, bic=crit + k * np.log(n), m=len(start) - 4)


PATHS = 2_000  # simulated paths behind the sigma of a form without a closed formula


def _path_sigma(h: int):
    """Standard deviation of simulated paths at steps 1..h, from stored states."""
    def sigma(model: pd.Series, params: pd.Series, state: pd.Series, s2: pd.Series) -> pd.Series:
        rows = []
        for name, p, st, v in zip(model, params, state, s2):
            if not name.startswith("ETS("):
                rows.append(None)
                continue
            error, _, season = name[4:-1].split(",")
            if error == "A" and season != "M" or v is None or not np.isfinite(v):
                rows.append(None)
                continue
            alpha, beta, gamma, phi = p
            lvl, b = np.full(PATHS, st[0]), np.full(PATHS, st[1])
            sea = np.tile(np.asarray(st[4:], float), (PATHS, 1))
            noise = np.random.default_rng(7).standard_normal((h, PATHS)) * np.sqrt(v)
            out = []
            with np.errstate(all="ignore"):
                for i in range(h):
                    j = i % sea.shape[1]
                    base, sj = lvl + phi * b, sea[:, j].copy()
                    mu = base * sj if season == "M" else base + sj
                    e = mu * noise[i] if error == "M" else noise[i]
                    out.append(float(np.std(mu + e)))
                    el, es = (e / sj, e / base) if season == "M" else (e, e)
                    lvl, b = base + alpha * el, phi * b + beta * el
                    if season != "N":
                        sea[:, j] = sj + gamma * es
            rows.append(out)
        return pd.Series(rows)
    return pandas_udf(sigma, "array<double>")


def forecast_ets(fit: DataFrame, spec: SeriesSpec, h: int | str | None = None) -> DataFrame:
    """Point forecasts and sigmas from stored states: closed form for additive
    errors and seasons, simulated paths for the other forms."""
    h = horizon(h, spec.unit, spec.period)
    name = F.coalesce(F.col("spec_name"), F.col("model")) if "spec_name" in fit.columns else F.col("model")
    plain = F.startswith(name, F.lit("ETS(A")) & ~F.endswith(name, F.lit(",M)"))
    drawn = _path_sigma(h)(name, "params", "state", "sigma2") if "model" in fit.columns else F.lit(None)
    out = fit.withColumn("_drawn", F.when(~plain & F.startswith(name, F.lit("ETS(")), drawn))
    out = out.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(h))))
    phi = F.col("params")[3]
    damp = F.when(phi == 1.0, F.col("h").cast("double")).otherwise(phi * (1.0 - F.pow(phi, F.col("h"))) / (1.0 - phi))
    base = F.col("state")[0] + damp * F.col("state")[1]
    sea = F.col("state")[4 + F.pmod(F.col("h") - 1, F.col("m"))]
    kind = F.coalesce(F.col("spec_name"), F.col("model")) if "spec_name" in fit.columns else F.col("model")
    mult = F.endswith(kind, F.lit(",M)"))
    none = F.endswith(kind, F.lit(",N)"))
    mean = F.when(mult, base * sea).when(none, base).otherwise(base + sea)
    var = F.expr("""sigma2 * (1 + aggregate(slice(sequence(0, h), 2, h - 1), 0.0D, (s, j) -> s + pow(
        params[0] + params[1] * if(params[3] = 1, j, params[3] * (1 - pow(params[3], j)) / (1 - params[3]))
        + if(m > 1 AND j % m = 0, params[2], 0.0D), 2)))""")
    t = (F.col("t_last") + F.col("h")).cast("long")
    sigma = F.when(F.startswith(kind, F.lit("ETS(A")) & ~mult, F.sqrt(var)).otherwise(F.get("_drawn", F.col("h") - 1))
    return out.select(*spec.by, "model", spec.index_expr(t).alias(spec.index), t.alias(spec.t), "h", mean.alias("mean"), sigma.alias("sigma"))


def ets_states(df: DataFrame, spec: SeriesSpec, y: str, fit: DataFrame, s: Ets, start: str = "start") -> DataFrame:
    """Run stored parameters over the rows: fitted values and end states.

    Returns (keys, t, fitted) from the stored ``start`` state; blocks of long
    series are chained through the state column.
    """
    arrays = block_arrays(df.select(*spec.by, spec.t, F.col(y).cast("double").alias("_y")), spec.by, spec.t, ["_y"])
    first, final = arrays.agg(F.min("blk"), F.max("blk")).first()
    m = 1

    def advance(ys: pd.Series, ps: pd.Series, st: pd.Series) -> pd.DataFrame:
        rows = []
        for yy, p, state in zip(ys, ps, st):
            new, fitted = run(np.asarray(yy, float), np.asarray([p], float), np.asarray([state], float), s, m, True)
            rows.append((fitted, new[0]))
        return pd.DataFrame(rows, columns=["fitted", "state"])

    step = pandas_udf(advance, "struct<fitted:array<double>,state:array<double>>")
    state = fit.select(*spec.by, "params", F.col(start).alias("_st"))
    out = None
    for b in range(first, final + 1):
        part = state.join(arrays.where(F.col("blk") == b).drop("blk"), spec.by).withColumn("_r", step(F.col("pts")["_y"], "params", "_st"))
        if final > first:
            part = cut_lineage(part)
        rows = part.select(*spec.by, F.explode(F.arrays_zip(F.col(f"pts.{spec.t}").alias("t"), F.col("_r.fitted").alias("f"))).alias("_x"))
        rows = rows.select(*spec.by, F.col("_x.t").alias(spec.t), F.col("_x.f").alias("fitted"))
        out = rows if out is None else out.unionByName(rows)
        if b < final:
            moved = part.select(*spec.by, F.col("_r.state").alias("_new"))
            state = state.join(moved, spec.by, "left").select(*spec.by, "params", F.coalesce("_new", "_st").alias("_st"))
    return out


# The specifications tried by the automatic choice.
AUTO_NONSEASONAL = [Ets("A", "N", "N"), Ets("A", "A", "N"), Ets("A", "Ad", "N"), Ets("M", "N", "N"), Ets("M", "A", "N"), Ets("M", "Ad", "N")]
AUTO_SEASONAL = [Ets("A", "N", "A"), Ets("A", "A", "A"), Ets("A", "Ad", "A"), Ets("M", "N", "M"), Ets("M", "A", "M"), Ets("M", "N", "A"), Ets("M", "A", "A")]


def ets_auto(df: DataFrame, spec: SeriesSpec, y: str, season: bool = True, m: int | None = None) -> DataFrame:
    """Automatic choice by AICc; ``model`` keeps the chosen specification."""
    m = m or max(1, int(round(spec.m)))
    return fit_ets(df, spec, y, AUTO_NONSEASONAL + (AUTO_SEASONAL if season and m > 1 else []), m)


# ---- fixed-grid recursions inside the JVM --------------------------------

def ses_grid(df: DataFrame, spec: SeriesSpec, y: str, alphas: list[float]) -> DataFrame:
    """Simple smoothing: best alpha of a grid, end level, sum of squares.

    A JVM recursion over ordered blocks; the candidates are extra rows.
    """
    from chronoloom.operators.blocks import block_scan
    first = df.groupBy(*spec.by).agg(F.min_by(F.col(y).cast("double"), spec.t).alias("_y0"), F.count(y).alias("n"), F.max(spec.t).alias("t_last"))
    start = first.withColumn("alpha", F.explode(F.array(*[F.lit(a) for a in alphas])))
    start = start.withColumn("state", F.struct(F.col("_y0").alias("l"), F.lit(0.0).alias("sse"), F.col("alpha").alias("a")))
    done = block_scan(df.select(*spec.by, spec.t, F.col(y).cast("double").alias("_v")), start, spec.by, spec.t, ["_v"],
                      lambda s, p: F.struct((s["l"] + s["a"] * (p["_v"] - s["l"])).alias("l"),
                                            (s["sse"] + (p["_v"] - s["l"]) * (p["_v"] - s["l"])).alias("sse"), s["a"].alias("a")))
    best = done.groupBy(*spec.by).agg(F.min_by(F.struct("alpha", "n", "t_last", F.col("state.l").alias("level"), F.col("state.sse").alias("sse")),
                                               F.struct("state.sse", "alpha")).alias("b"))
    return best.select(*spec.by, "b.*")


def trend_grid(df: DataFrame, spec: SeriesSpec, y: str, candidates: list[tuple[float, float, float]]) -> DataFrame:
    """Holt (phi = 1) and damped Holt on a grid of (alpha, beta, phi)."""
    from chronoloom.operators.blocks import block_scan
    first = df.groupBy(*spec.by).agg(F.min_by(F.col(y).cast("double"), spec.t).alias("_y0"), F.count(y).alias("n"), F.max(spec.t).alias("t_last"))
    cells = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(p).alias("p")) for a, b, p in candidates])
    start = first.withColumn("c", F.explode(cells))
    start = start.withColumn("state", F.struct(F.col("_y0").alias("l"), F.lit(0.0).alias("b"), F.lit(0.0).alias("sse"), F.col("c").alias("c")))

    def step(s, p):
        c = s["c"]
        base = s["l"] + c["p"] * s["b"]
        e = p["_v"] - base
        return F.struct((base + c["a"] * e).alias("l"), (c["p"] * s["b"] + c["b"] * e).alias("b"), (s["sse"] + e * e).alias("sse"), c.alias("c"))

    done = block_scan(df.select(*spec.by, spec.t, F.col(y).cast("double").alias("_v")), start, spec.by, spec.t, ["_v"], step)
    best = done.groupBy(*spec.by).agg(F.min_by(F.struct("state", "n", "t_last"), F.struct("state.sse", "c")).alias("b"))
    return best.select(*spec.by, F.col("b.state.c.a").alias("alpha"), F.col("b.state.c.b").alias("beta"), F.col("b.state.c.p").alias("phi"),
                       F.col("b.state.l").alias("level"), F.col("b.state.b").alias("slope"), F.col("b.state.sse").alias("sse"),
                       F.col("b.n").alias("n"), F.col("b.t_last").alias("t_last"))


def croston(df: DataFrame, spec: SeriesSpec, y: str, alpha: float = 0.1) -> DataFrame:
    """Smoothed demand size over smoothed gap between demands."""
    from chronoloom.operators.blocks import block_scan
    origin = df.groupBy(*spec.by).agg((F.min(spec.t) - 1).alias("_o"))
    start = origin.withColumn("state", F.struct(F.lit(None).cast("double").alias("z"), F.lit(None).cast("double").alias("p"), F.col("_o").cast("long").alias("q")))
    rows = df.where(F.col(y) != 0).select(*spec.by, spec.t, F.col(y).cast("double").alias("_v"))

    def step(s, x):
        gap = (x[spec.t] - s["q"]).cast("double")
        return F.struct(F.coalesce(s["z"] + alpha * (x["_v"] - s["z"]), x["_v"]).alias("z"),
                        F.coalesce(s["p"] + alpha * (gap - s["p"]), gap).alias("p"), x[spec.t].cast("long").alias("q"))

    done = block_scan(rows, start, spec.by, spec.t, ["_v"], step)
    return done.select(*spec.by, F.col("state.z").alias("size"), F.col("state.p").alias("gap"), (F.col("state.z") / F.col("state.p")).alias("mean"))
